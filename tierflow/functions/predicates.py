"""Row predicates shared by the merge operators."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def _pair(left: str, right: str, name: str) -> tuple[Column, Column]:
    return F.col(f"{left}.{name}"), F.col(f"{right}.{name}")


def keys_equal(left: str, right: str, keys: Sequence[str], null_safe: bool = True) -> Column:
    """All keys equal between two aliased frames; null-safe means NULL matches NULL.

    The comparison is per column, never by hash, so distinct keys cannot collide. Spark
    plans both forms as equi joins. The null-safe form hashes ``coalesce(key)`` rather than
    the bare key, hence a side that was just grouped by the key gets an exchange of its own
    and AQE may still split a hot partition of the other side.
    """
    pairs = [_pair(left, right, name) for name in keys]
    return reduce(and_, [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])


def changed(left: str, right: str, cols: Sequence[str], null_safe: bool = True) -> Column:
    """Any column differs. Without ``null_safe`` a NULL on either side is no difference."""
    pairs = [_pair(left, right, name) for name in cols]
    differs = reduce(or_, [~a.eqNullSafe(b) if null_safe else a != b for a, b in pairs])
    return F.coalesce(differs, F.lit(False))


def no_null(cols: Sequence[str]) -> Column:
    return reduce(and_, [F.col(name).isNotNull() for name in cols])


def moment(value: datetime | str | Column) -> Column:
    """A time-zone free timestamp; a Python datetime keeps its wall-clock reading."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    text = value.isoformat(sep=" ") if isinstance(value, datetime) else value
    return F.lit(text).cast("timestamp_ntz")
