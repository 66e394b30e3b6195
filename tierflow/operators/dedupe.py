"""One row per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierflow.operators.digest import row_hash
from tierflow.session import scratch_path
from tierflow.sources.tables import stage

# (column, "asc" | "desc", where NULLs go: "first" | "last")
Order = tuple[str, str, str]


def ordering(order: Sequence[Order]) -> list[Column]:
    return [getattr(F.col(name), f"{way}_nulls_{nulls}")() for name, way, nulls in order]


def dedupe_latest(df: DataFrame, partition_cols: Sequence[str], order: Sequence[Order]) -> DataFrame:
    """Keep the first row of each group in the given order; NULL group values are equal.

    Columns that are neither grouped nor ordered break ties, so the kept row does not depend
    on the partitioning. ``= 1`` lets Spark keep one row per group in each map task before the
    shuffle (WindowGroupLimit): a hot group reaches the reducer as one row per map task.
    """
    used = {*partition_cols, *(name for name, _, _ in order)}
    order = [term for term in order if term[0] not in partition_cols]
    ties = [(name, "asc", "last") for name in df.columns if name not in used]
    window = Window.partitionBy(*partition_cols).orderBy(*ordering([*order, *ties]) or [F.lit(1)])
    return df.withColumn("_row_num", F.row_number().over(window)).where("_row_num = 1").drop("_row_num")


def groups_taken(stored: DataFrame, batch: DataFrame, partition_cols: Sequence[str], order: Sequence[Order],
                 part_col: str) -> DataFrame:
    """``part_col`` of the groups whose row by ``dedupe_latest`` of both frames is one of the batch alone.

    Both have the same columns in the same types, ``part_col`` follows from the group, and ``stored`` holds a group once. Groups
    are told by 128-bit digests, so that of a row only these and the columns that decide are shuffled; two
    groups are taken for one with a chance of about one in 2 ** 128 a pair.
    """
    names = [c for c in stored.columns if c != part_col]
    deciding = [term for term in order if term[0] not in partition_cols]
    used = {*partition_cols, *(name for name, _, _ in order)}
    deciding += [(name, "asc", "last") for name in names if name not in used]
    group = [row_hash(partition_cols, seed).alias(f"_h{seed}") for seed in (0, 1)]
    rows = [df.select(*group, F.col(part_col).alias("_part"), *[name for name, _, _ in deciding], F.lit(new).alias("_new"))
            for df, new in ((stored, False), (batch, True))]
    # A stored row goes before an equal one of the batch.
    first = dedupe_latest(rows[0].unionByName(rows[1]), ["_h0", "_h1"], [*deciding, ("_new", "asc", "last")])
    return first.where("_new").select(F.col("_part").alias(part_col)).distinct()


# Up to so many groups of copies are looked for one by one.
FEW_GROUPS = 100_000


def dedupe_few(df: DataFrame, partition_cols: Sequence[str], order: Sequence[Order]) -> DataFrame:
    """``dedupe_latest`` of rows that are expected to have few copies; the frame is read more than once.

    Groups of several rows are found by a hash of the group's values, so that eight bytes a row are
    shuffled; only rows of these hashes are compared, the others stay where they are read.
    """
    value = F.xxhash64(*partition_cols, *[F.col(c).isNull() for c in partition_cols])
    hashed = df.withColumn("_hash", value)
    several = hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_hash")
    several = stage(several, scratch_path(df.sparkSession, "copies"))
    found = several.limit(FEW_GROUPS + 1).count()
    if not found:
        return df
    if found > FEW_GROUPS:
        return dedupe_latest(df, partition_cols, order)
    several = F.broadcast(several)
    copies = hashed.join(several, "_hash", "left_semi").drop("_hash")
    return hashed.join(several, "_hash", "left_anti").drop("_hash").unionByName(dedupe_latest(copies, partition_cols, order))
