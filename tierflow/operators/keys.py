"""Surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierflow.session import scratch_path
from tierflow.sources.tables import stage

# monotonically_increasing_id(): partition number above, row position below this bit.
_POSITION_BITS = 33


def assign_surrogate_keys(df: DataFrame, natural_key: str | Sequence[str], key_col: str,
                          start: int = 1) -> DataFrame:
    """Number the rows start, start + 1, ... without gaps in natural-key order.

    The rows are range-partitioned and sorted; each gets its position within its partition, and
    the row counts of the partitions before it are added. No window spans the table: the only
    ungrouped window runs over one row per partition. Other columns break ties of the natural
    key, and a row tag splits identical rows, so that a hot key spreads over partitions.

    The tagged and the placed rows are written to the shared folder: a range partitioning
    samples its input and could cut elsewhere when recomputed, after the loss of an executor too.
    """
    spark = df.sparkSession
    natural_key = [natural_key] if isinstance(natural_key, str) else list(natural_key)
    order = [*natural_key, *[c for c in df.columns if c not in natural_key], "_tag"]
    tagged = stage(df.withColumn("_tag", F.monotonically_increasing_id()), scratch_path(spark, "tagged"))
    placed = stage(
        tagged.repartitionByRange(*[F.col(c).asc_nulls_last() for c in order])
        .sortWithinPartitions(*[F.col(c).asc_nulls_last() for c in order])
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_place", _POSITION_BITS))
        .withColumn("_position", F.col("_place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))),
        scratch_path(spark, "placed"),
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    # One row per partition: at most spark.sql.shuffle.partitions rows are broadcast.
    return placed.join(F.broadcast(offsets), "_part").select(
        (F.lit(start) + F.col("_offset") + F.col("_position")).cast("bigint").alias(key_col), *df.columns)


def next_key(table: DataFrame, key_col: str) -> int:
    """The number after the largest key in use; 1 for an empty table."""
    return (table.agg(F.max(key_col)).first()[0] or 0) + 1
