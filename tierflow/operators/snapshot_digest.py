"""The difference of two large snapshots that are mostly equal.

Both are read once to compare digests of buckets of keys; then only the rows of buckets that differ
are shuffled and joined. Buckets follow from the keys, so that a row's key is in one bucket on either
side. With c changed keys spread at random over b buckets, some c / b of the rows are joined: choose b
well above the changes to expect.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.operators.digest import PIECES, row_hash, set_digest
from tierflow.operators.merge import snapshot_diff
from tierflow.session import scratch_path
from tierflow.sources.tables import stage

# The list of buckets that differ is joined to both snapshots; so many ids are below Spark's limit for broadcasts.
MOST_BUCKETS = 1 << 20


def key_bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(row_hash(keys, seed=1), F.lit(buckets)).cast("int")


def bucket_digests(rows: DataFrame, keys: Sequence[str], cols: Sequence[str], buckets: int) -> DataFrame:
    """(bucket, digest): the row count and two digests of whole rows, summed in the map tasks."""
    everything = [*keys, *cols]
    parts = [F.count(F.lit(1)).alias("rows"), *set_digest(row_hash(everything), "a"), *set_digest(row_hash(everything, seed=2), "b")]
    found = rows.groupBy(key_bucket(keys, buckets).alias("bucket")).agg(*parts)
    return found.select("bucket", F.struct("rows", *[f"{s}_{i}" for s in "ab" for i in range(PIECES)]).alias("digest"))


def differing_buckets(old: DataFrame, new: DataFrame, keys: Sequence[str], cols: Sequence[str], buckets: int) -> DataFrame:
    one, other = (bucket_digests(rows, keys, cols, buckets) for rows in (old, new))
    return one.alias("o").join(other.alias("n"), "bucket", "full_outer").where(
        ~F.col("o.digest").eqNullSafe(F.col("n.digest"))).select("bucket")


def differing_rows(rows: DataFrame, keys: Sequence[str], buckets: int, differ: DataFrame) -> DataFrame:
    """The rows of buckets that differ; the others are left where they are read."""
    return rows.withColumn("_bucket", key_bucket(keys, buckets)).join(
        differ.withColumnRenamed("bucket", "_bucket"), "_bucket", "left_semi").drop("_bucket")


def snapshot_diff_digest(old: DataFrame, new: DataFrame, keys: Sequence[str], cols: Sequence[str] | None = None,
                         buckets: int = 1 << 12) -> DataFrame:
    """``snapshot_diff`` of snapshots of which most buckets are equal.

    Keys have to be unique; repeated ones fail the job if they lie in a bucket that differs. A bucket
    that differs goes unnoticed only if two 64-bit hashes agree by chance. The list of buckets and
    the rows in question are written to the shared folder, as each is read more than once.
    """
    if not 0 < buckets <= MOST_BUCKETS:
        raise ValueError(f"buckets must be 1 to {MOST_BUCKETS}, not {buckets}")
    cols = list(cols or [c for c in new.columns if c not in keys])
    spark = old.sparkSession
    differ = stage(differing_buckets(old, new, keys, cols, buckets), scratch_path(spark, "buckets"))
    one, other = (stage(differing_rows(rows.select(*keys, *cols), keys, buckets, differ), scratch_path(spark, name))
                  for rows, name in ((old, "old-rows"), (new, "new-rows")))
    return snapshot_diff(one, other, keys, cols)
