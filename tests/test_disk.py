"""What a job holds on disk: shuffles go with their step, scratch tables with the work that reads them."""

import glob
import os
import time

import pytest
from pyspark.sql import functions as F

from tierflow.operators import netchange
from tierflow.operators.dedupe import dedupe_latest, groups_taken
from tierflow.operators.merge import scd1_merge
from tierflow.plans import registry, sample, silver
from tierflow.session import FREE_SHUFFLES, scratch_path, scratch_scope, shared_dir
from tierflow.sources.tables import stage

from test_shuffles import KEYS, folder, large, rows, run  # noqa: F401


def shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in dirs for f in glob.glob(f"{d}/*/shuffle_*")}


def test_a_staged_step_leaves_no_shuffle_files(large, tmp_path):  # noqa: F811
    before = shuffle_files(large)
    one, other = rows(large, tmp_path / "a", 0, 60, 1), rows(large, tmp_path / "b", 40, 100, 2)
    found = stage(one.join(other, KEYS, "left").groupBy("k").count(), str(tmp_path / "found"))
    until = time.time() + 20
    while shuffle_files(large) - before and time.time() < until:  # deleted beside the job
        time.sleep(0.2)
    assert not shuffle_files(large) - before
    assert found.count() == 60 and large.conf.get(FREE_SHUFFLES, "false") == "false"


def test_scratch_tables_go_with_their_scope(spark):
    kept = stage(spark.range(3), scratch_path(spark, "kept"))
    with scratch_scope(spark):
        path = scratch_path(spark, "passing")
        with scratch_scope(spark):
            inner = scratch_path(spark, "inner")
            assert stage(spark.range(2), inner).count() == 2
        assert not os.path.exists(inner)
        assert stage(spark.range(5), path).count() == 5
    assert not os.path.exists(path) and kept.count() == 3
    with pytest.raises(ValueError), scratch_scope(spark):
        path = scratch_path(spark, "failing")
        stage(spark.range(1), path)
        raise ValueError
    assert not os.path.exists(path)


READ_BY = {
    "silver_dedupe_incremental": ["silver"], "scd2_rerun_load": ["scd2-fact", "dates"], "scd2_partitioned_load": ["scd2-fact", "dates"],
    "scd1_partitioned_load": ["fact-by-year", "dates"], "stream_cdc_apply": ["silver", "checkpoint"],
    "scd1_merge_latest": ["fact-states", "latest", "dates"], "cdc_apply_sequenced": ["keyed", "net-changes"],
    "cdc_apply_sequenced_upsert": ["keyed", "net-changes"], "scd2_merge": ["fact-rows", "dates"]}


@pytest.mark.parametrize("name", READ_BY)
def test_a_job_leaves_the_tables_its_result_is_read_from(spark, folder, name):  # noqa: F811
    before = set(os.listdir(shared_dir(spark)))
    found = registry.QUERIES[name](spark, folder)
    left = {f.rsplit("-", 1)[0]: f for f in set(os.listdir(shared_dir(spark))) - before}
    assert set(left) <= set(READ_BY[name])
    assert found.count() > 0
    for table in (left.get("silver"), left.get("scd2-fact")):
        if table:  # nothing of a published run but the list of its months
            assert not glob.glob(f"{shared_dir(spark)}/{table}/staged/*/*.parquet") or \
                os.listdir(f"{shared_dir(spark)}/{table}/staged") == ["touched"]


def test_a_load_of_known_rows_takes_no_whole_rows(spark, tmp_path, monkeypatch):
    table, given = str(tmp_path / "silver"), []
    silver.silver_create(spark, table)
    batch = spark.createDataFrame([(i, d, t) for i in range(4) for d in ("2024-01-05", "2024-02-05", None) for t in ("A", None)],
                                  "invoice_no string, invoice_date string, type string")
    batch = batch.select(*[F.col(c) if c in batch.columns else F.lit(1 if c in ("quantity", "kgs") else None).cast(f.dataType).alias(c)
                           for c, f in zip(silver.SL_ORDERDETAILS.fieldNames(), silver.SL_ORDERDETAILS.fields, strict=True)])
    monkeypatch.setattr(silver, "dedupe_latest", lambda df, *more, real=dedupe_latest: given.append(df.count()) or real(df, *more))
    assert silver.silver_load(spark, table, batch, "a")
    stored = sorted(map(str, silver.read_silver(spark, table).collect()))
    assert silver.silver_load(spark, table, batch, "b")
    assert sorted(map(str, silver.read_silver(spark, table).collect())) == stored and len(stored) == 12
    # A group of one month gets a row that comes first: its month alone is compared.
    first = batch.where("invoice_no = '1' AND invoice_date = '2024-02-05' AND type IS NULL").withColumn("type", F.lit("0"))
    assert silver.silver_load(spark, table, batch.unionByName(first), "c")
    assert given == [24, 0, 4 + 9]
    assert silver.read_silver(spark, table).where("type = '0'").count() == 1


def test_groups_taken_is_what_a_choice_among_all_rows_changes(spark):
    import random
    rng, order = random.Random(3), [("b", "asc", "last"), ("c", "desc", "first")]

    def made(n):
        return [(rng.choice(["x", "y", "z", None]), rng.randrange(4), rng.choice([1, 2, None]), rng.choice(["p", "q", None]),
                 rng.choice(["s", "t", None])) for _ in range(n)]
    schema = "a string, part int, b int, c string, d string"
    for _ in range(6):
        stored = dedupe_latest(spark.createDataFrame(made(12), schema), ["a", "part"], order).localCheckpoint()
        batch = spark.createDataFrame(made(6), schema)
        after = dedupe_latest(stored.unionByName(batch), ["a", "part"], order)
        changed = {r["part"] for r in after.exceptAll(stored).collect()}
        assert {r[0] for r in groups_taken(stored, batch, ["a", "part"], order, "part").collect()} == changed


@pytest.mark.parametrize("upsert", [False, True])
def test_folded_changes_are_shuffled_once(large, tmp_path, upsert):  # noqa: F811
    table, batch = rows(large, tmp_path / "t", 0, 60, 1), rows(large, tmp_path / "b", 40, 100, 2)
    feed = batch.withColumns({"_action": F.lit("INSERT"), "_is_update": F.col("k") < "5", "seq": F.lit(1)})
    plan = run(netchange.cdc_apply_sequenced(table, feed, KEYS, "seq", upsert_on_insert=upsert))
    assert any("_net" in line for line in plan.split("\n") if "ReusedExchange" in line)


def test_chosen_rows_replace_matched_ones_unshuffled(large, tmp_path, monkeypatch):  # noqa: F811
    monkeypatch.setattr("tierflow.operators.merge.SMALL_BATCH", 0)
    table, one = rows(large, tmp_path / "t", 0, 60, 1), rows(large, tmp_path / "b", 40, 100, 2)
    batch = one.unionByName(one.withColumn("v", F.lit(3)))
    ways = [scd1_merge(table, batch, KEYS, on_duplicate="latest", latest_by=[("v", "desc", "last")], replace=replace)
            for replace in (False, True)]
    assert sorted(ways[0].collect()) == sorted(ways[1].collect())
    assert run(ways[1]).count("Exchange") == 2
    assert ways[1].groupBy("v").count().orderBy("v").collect() == [(1, 40), (3, 60)]


def test_lines_lie_by_order_when_they_are_grouped(large, folder, monkeypatch):  # noqa: F811
    monkeypatch.setattr(sample, "_written", lambda rows, name: rows)
    plan = run(sample.keyed_orders(large, folder))
    order, part, supplier = (plan.index(f"hashpartitioning({key}") for key in ("l_orderkey", "l_partkey", "l_suppkey"))
    assert order < min(part, supplier)  # plans are printed from their end
    assert plan.count("hashpartitioning(l_") == 3
