"""Digests of row sets and snapshots that are mostly equal."""

import random

import pytest
from pyspark.sql import functions as F

from tierflow.operators.digest import content_digest, differing, reconcile_contents
from tierflow.operators.merge import snapshot_diff
from tierflow.operators.snapshot_digest import differing_buckets, differing_rows, key_bucket, snapshot_diff_digest
from tierflow.sources.tables import stage

SCHEMA = "k string, part int, a string, b double"
KEYS = ["k", "part"]


def digest(df):
    return df.agg(*content_digest(df.columns)).first().asDict()


def test_digest_depends_on_contents_only(spark):
    rows = [(None, 1, "x", 1.0), ("1", None, "x", 1.0), ("1", None, "x", 1.0), ("a", 2, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert digest(df) == digest(spark.createDataFrame(rows[::-1], SCHEMA).repartition(3))
    assert digest(df.limit(0)) == {name: 0 for name in digest(df)}

    def wrong(other):
        return differing(df.columns, digest(df), digest(spark.createDataFrame(other, SCHEMA)))
    assert wrong(rows) == []
    assert wrong(rows[:1] + rows[1:2] + rows[:1] + rows[3:]) == ["k", "part", "(rows)"]  # another row repeats
    assert wrong([("1", None, "x", 1.0), (None, 1, "x", 1.0), *rows[2:]]) == []
    assert wrong([(None, None, "x", 1.0), ("1", 1, "x", 1.0), *rows[2:]]) == ["(rows)"]  # NULLs changed places
    assert wrong([*rows[:3], ("a", 2, None, 0.5)]) == ["b", "(rows)"]


def test_reconcile_finds_one_changed_cell_with_equal_counts(spark):
    df = spark.range(5000).select("id", (F.col("id") % 7).alias("v"))
    other = df.withColumn("v", F.when(F.col("id") == 77, 99).otherwise(F.col("v")))
    found = {r.column_name: (r.source_rows, r.target_rows, r.agree) for r in reconcile_contents(df, other, ["id", "v"]).collect()}
    assert found == {"id": (5000, 5000, True), "v": (5000, 5000, False), "(rows)": (5000, 5000, False)}


@pytest.mark.parametrize("buckets", [1, 7, 5000])
def test_equals_the_full_comparison(spark, rows, buckets):
    rng = random.Random(buckets)
    keys = list(dict.fromkeys((rng.choice([str(i), None]), rng.choice([i, None])) for i in range(400)))

    def state(share):
        return [(*key, rng.choice(["x", None]) if rng.random() < share else "x", 1.0) for key in keys if rng.random() > share / 2]
    old, new = (spark.createDataFrame(state(share), SCHEMA) for share in (0.0, 0.1))
    assert rows(snapshot_diff_digest(old, new, KEYS, buckets=buckets)) == rows(snapshot_diff(old, new, KEYS))
    assert rows(snapshot_diff_digest(old, old, KEYS, buckets=buckets)) == []
    assert rows(snapshot_diff_digest(old, new.limit(0), KEYS, ["a"], buckets)) == rows(snapshot_diff(old, new.limit(0), KEYS, ["a"]))


def test_equal_buckets_are_not_shuffled(spark, tmp_path):
    old = stage(spark.range(50_000, numPartitions=4).selectExpr("cast(id AS string) AS k", "1 AS part", "'x' AS a", "1.0D AS b"),
                str(tmp_path / "old"))
    new = stage(old.withColumn("a", F.when(F.col("k").isin("5", "50", "500"), "y").otherwise(F.col("a"))), str(tmp_path / "new"))
    differ = stage(differing_buckets(old, new, KEYS, ["a", "b"], 1000), str(tmp_path / "differ"))
    touched = {r[0] for r in new.where("a = 'y'").select(key_bucket(KEYS, 1000)).collect()}
    assert {r.bucket for r in differ.collect()} == touched
    left = differing_rows(old, KEYS, 1000, differ)
    assert left.count() < 50_000 * 4 / 1000 * 1.5
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert snapshot_diff_digest(old, new, KEYS, buckets=1000).count() == 6


def test_repeated_keys_and_bucket_counts(spark):
    old = spark.createDataFrame([("1", 1, "x", 1.0)], SCHEMA)
    new = spark.createDataFrame([("1", 1, "y", 1.0), ("1", 1, "z", 1.0)], SCHEMA)
    with pytest.raises(Exception, match="several rows of one key"):
        snapshot_diff_digest(old, new, KEYS).collect()
    with pytest.raises(ValueError):
        snapshot_diff_digest(old, old, KEYS, buckets=0)
