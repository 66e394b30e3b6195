"""Column expressions of the order tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Divisors of the two derived measures.
NOS_DIVISOR = 10000
MT_DIVISOR = 1000


def whole_number(value: Column, strict: bool = True) -> Column:
    """Text or number to a whole decimal, halves away from zero; lenient mode gives NULL on bad text."""
    return value.cast("decimal(38,0)") if strict else value.try_cast("decimal(38,0)")


def calendar_date(value: Column, strict: bool = True) -> Column:
    return value.cast("date") if strict else value.try_cast("date")


def qty_in_nos(quantity: Column) -> Column:
    return (quantity.cast("decimal(38,0)") / F.lit(NOS_DIVISOR)).cast("decimal(38,6)")


def qty_in_mt(kgs: Column) -> Column:
    return (kgs.cast("decimal(38,0)") / F.lit(MT_DIVISOR)).cast("decimal(38,6)")


def tokens(line: Column) -> Column:
    """Split at every single whitespace character; empty tokens stay."""
    return F.split(line, r"\s")
