"""How often rows are shuffled or rewritten."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tierflow.operators.dedupe import dedupe_few, dedupe_latest
from tierflow.operators.interval import join_valid_at
from tierflow.operators.merge import cdc_apply, scd1_merge, scd2_merge, snapshot_diff
from tierflow.plans import registry, sample
from tierflow.sources.tables import stage

LARGE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
}
KEYS = ["k", "n"]


@pytest.fixture
def large(spark):
    before = {name: spark.conf.get(name, None) for name in LARGE}
    for name, value in LARGE.items():
        spark.conf.set(name, value)
    yield spark
    for name, value in before.items():
        spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


def run(df):
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    return execution.executedPlan().toString().split("== Initial Plan ==")[0]


def rows(spark, path, first, last, value):
    return stage(spark.range(first, last, numPartitions=3).select(
        F.col("id").cast("string").alias("k"), (F.col("id") % 3).alias("n"), F.lit(value).alias("v")), str(path))


@pytest.mark.parametrize("merge", ["scd1", "scd2", "cdc"])
def test_the_batch_is_shuffled_once_for_both_joins(large, tmp_path, merge):
    table, batch = rows(large, tmp_path / "t", 0, 60, 1), rows(large, tmp_path / "b", 40, 100, 2)
    if merge == "scd1":
        merged = scd1_merge(table, batch, KEYS)
    elif merge == "scd2":
        table = table.withColumns({"start_date": F.lit("2020-01-01").cast("timestamp_ntz"),
                                   "end_date": F.lit(None).cast("timestamp_ntz"), "active_flag": F.lit("Y")})
        merged = scd2_merge(table, batch, KEYS, ["v"], "2024-01-01 00:00:00")
    else:
        feed = batch.withColumns({"_action": F.lit("INSERT"), "_is_update": F.lit(False)})
        merged = cdc_apply(table, feed, KEYS, upsert_on_insert=True)
    plan = run(merged)
    assert any("_row" in line for line in plan.split("\n") if "ReusedExchange" in line)
    assert merged.groupBy("v").count().orderBy("v").collect() == [(1, 60 if merge == "scd2" else 40), (2, 60)]


def test_a_diff_shuffles_each_snapshot_once(large, tmp_path):
    old, new = rows(large, tmp_path / "o", 0, 60, 1), rows(large, tmp_path / "n", 40, 100, 2)
    diff = snapshot_diff(old, new, KEYS)
    assert run(diff).count("Exchange") == 1
    assert sorted(diff.groupBy("_action", "_is_update").count().collect()) == [
        ("DELETE", False, 40), ("DELETE", True, 20), ("INSERT", False, 40), ("INSERT", True, 20)]


@pytest.mark.parametrize("most", [0, 100])
def test_few_copies_are_found_by_hash(spark, monkeypatch, most):
    monkeypatch.setattr("tierflow.operators.dedupe.FEW_GROUPS", most)
    df = spark.createDataFrame(
        [("a", None, 1), ("a", None, 2), (None, "a", 3), (None, None, 4), (None, None, 5), ("b", "b", 6)], "x string, y string, z int")
    order = [("z", "desc", "last")]
    expected = sorted(dedupe_latest(df, ["x", "y"], order).collect(), key=str)
    assert sorted(dedupe_few(df, ["x", "y"], order).collect(), key=str) == expected
    assert [r["z"] for r in expected if r["x"] == "a"] == [2] and len(expected) == 4


def test_listed_versions_are_not_broadcast(spark, tmp_path):
    """Their list is larger than the files that Spark goes by."""
    table = stage(spark.range(100).selectExpr(
        "id AS k", "TIMESTAMP_NTZ '1990-01-01 00:00:00' AS start", "cast(NULL AS timestamp_ntz) AS end"), str(tmp_path / "v"))
    lines = stage(spark.range(400).selectExpr("id % 100 AS k", "make_date(1990 + id % 30, 1, 1) AS day"), str(tmp_path / "r"))
    found = join_valid_at(lines, table, ["k"], "day", "start", "end")
    assert "BroadcastHashJoin" not in run(found)
    assert found.count() == 400


@pytest.fixture
def folder(spark, tmp_path):
    """Tables of ten months: 40 orders of three lines, two of which have one part."""
    ids = spark.range(40)
    tables = {
        "nation": spark.sql("SELECT 1 AS n_nationkey, 'N' AS n_name, 0 AS n_regionkey"),
        "supplier": spark.sql("SELECT 1L AS s_suppkey, 's' AS s_name, 1 AS s_nationkey"),
        "part": spark.range(5).selectExpr("id AS p_partkey", "cast(id AS int) AS p_size"),
        "customer": ids.selectExpr("id AS c_custkey", "'BUILDING' AS c_mktsegment", "1 AS c_nationkey"),
        "orders": ids.selectExpr(
            "id AS o_orderkey", "id AS o_custkey", "cast(make_date(1995, 1 + cast(id % 10 AS int), 3) AS timestamp_ntz) AS o_orderdate",
            "element_at(array('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW'), 1 + cast(floor(id / 10) AS int)) AS o_orderpriority"),
        "lineitem": spark.range(120).selectExpr(
            "cast(floor(id / 3) AS bigint) AS l_orderkey", "cast(id % 3 / 2 AS bigint) AS l_partkey", "1L AS l_suppkey",
            "IF(id % 7 = 0, 'A', 'N') AS l_returnflag", "'O' AS l_linestatus", "cast(id AS double) AS l_quantity",
            "TIMESTAMP_NTZ '1995-12-01 00:00:00' AS l_shipdate")}
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_order_lines_are_not_shuffled_again_by_the_text_of_their_keys(large, folder, monkeypatch):
    monkeypatch.setattr(sample, "_written", lambda rows, name: rows)
    keyed = sample.keyed_orders(large, folder)
    plan = run(keyed)
    assert "hashpartitioning(l_orderkey" in plan and "hashpartitioning(invoice_no" not in plan
    # Of copies the first stays, in the order of the columns.
    assert sorted(r[:] for r in keyed.where("invoice_no IN ('0', '1')").select("invoice_no", "product_group_code", "quantity").collect()) == [
        ("0", "0", 0), ("0", "1", 2), ("1", "0", 3), ("1", "1", 5)]


def test_the_stream_rewrites_each_month_once(large, folder, monkeypatch):
    months = Counter()

    def spy(*args, real=registry.apply_batches, **options):
        write = real(*args, **options)

        def wrapped(batch, batch_id):
            months.update(r[0] for r in batch.select("invoice_month").distinct().collect())
            write(batch, batch_id)
        return wrapped

    monkeypatch.setattr(registry, "apply_batches", spy)
    monkeypatch.setattr(registry, "FILES_PER_BATCH", 1)
    found = registry.QUERIES["stream_cdc_apply"](large, folder)
    assert len(months) == 10 and set(months.values()) == {1}
    assert found.count() == registry.QUERIES["cdc_apply"](large, folder).exceptAll(found).count() + found.count()


def test_the_appended_fact_is_derived_once(large, folder, monkeypatch):
    calls = []
    monkeypatch.setattr(sample, "keyed_orders", lambda *given, real=sample.keyed_orders: calls.append(1) or real(*given))
    assert registry.QUERIES["fact_append"](large, folder).count() == 160
    assert len(calls) == 1


def merged_ways(large, monkeypatch, table, batch, merge):
    """The merge by joins, and with the batch taken as it is."""
    monkeypatch.setattr("tierflow.operators.merge.SMALL_BATCH", 0)
    feed = batch.withColumns({"_action": F.lit("INSERT"), "_is_update": F.lit(False)})
    if merge == "scd1":
        return [scd1_merge(table, batch, KEYS, replace=replace) for replace in (False, True)]
    return [cdc_apply(table, feed, KEYS, upsert_on_insert=True, replace=replace) for replace in (False, True)]


@pytest.mark.parametrize("merge", ["scd1", "cdc"])
def test_a_batch_that_replaces_rows_is_not_shuffled(large, tmp_path, monkeypatch, merge):
    nulls = large.createDataFrame([(None, 1, 7)], "k string, n bigint, v int")
    table = stage(rows(large, tmp_path / "t", 0, 60, 1).unionByName(nulls), str(tmp_path / "table"))
    new = large.createDataFrame([("new", 1, 8), ("new", 1, 9), (None, 1, 10)], "k string, n bigint, v int")
    batch = stage(rows(large, tmp_path / "b", 40, 100, 2).unionByName(new), str(tmp_path / "batch"))
    joins, replaced = merged_ways(large, monkeypatch, table, batch, merge)
    assert sorted(map(str, joins.collect())) == sorted(map(str, replaced.collect()))
    assert run(replaced).count("Exchange") == 2 and run(joins).count("Exchange") > 4


@pytest.mark.parametrize("merge", ["scd1", "cdc"])
def test_repeated_keys_are_merged_as_without_replacing(large, tmp_path, monkeypatch, merge):
    table = rows(large, tmp_path / "t", 0, 60, 1)
    twice = table.unionByName(table.where("k = '50'"))
    batch = rows(large, tmp_path / "b", 40, 100, 2)
    joins, replaced = merged_ways(large, monkeypatch, twice, batch, merge)
    assert sorted(joins.collect()) == sorted(replaced.collect())
    assert replaced.where("k = '50' AND v = 2").count() == 2
    with pytest.raises(Exception, match="several source rows"):
        merged_ways(large, monkeypatch, table, batch.unionByName(batch.where("k = '50'")), merge)


def test_a_feed_with_other_changes_is_not_taken_as_it_is(large, tmp_path, monkeypatch):
    monkeypatch.setattr("tierflow.operators.merge.SMALL_BATCH", 0)
    table, batch = rows(large, tmp_path / "t", 0, 60, 1), rows(large, tmp_path / "b", 40, 100, 2)
    feed = batch.withColumns({"_action": F.lit("INSERT"), "_is_update": F.col("k") > "7"})
    ways = [cdc_apply(table, feed, KEYS, upsert_on_insert=True, replace=replace) for replace in (False, True)]
    assert sorted(ways[0].collect()) == sorted(ways[1].collect())


def test_fact_states_are_looked_up_once(large, folder, monkeypatch):
    names = []
    monkeypatch.setattr(sample, "_written", lambda df, name, real=sample._written: names.append(name) or real(df, name))
    doubled = {name: df.unionByName(df) if name in ("customer", "product") else df for name, df in sample.dims(large, folder).items()}
    monkeypatch.setattr(sample, "dims", lambda *given: doubled)
    names.clear()
    found = sample.fact1_states(large, folder)
    assert names == ["fact-states"]
    for state, orders in zip(found, sample.silver_states(large, folder), strict=True):
        expected = sample.enrich_star(orders, doubled)
        assert state.schema == expected.schema or [f.dataType for f in state.schema] == [f.dataType for f in expected.schema]
        assert state.columns == expected.columns
        assert sorted(map(str, state.collect())) == sorted(map(str, expected.collect()))


def test_versioned_states_are_written_once(large, folder, monkeypatch):
    names = []
    monkeypatch.setattr(sample, "_written", lambda df, name, real=sample._written: names.append(name) or real(df, name))
    before, batch = sample.fact2_states(large, folder)
    assert names == ["dates", "fact-rows"]
    assert before.count() and batch.count()


def test_a_load_compares_its_rows_once(large, folder, monkeypatch):
    calls, staged = [], []
    monkeypatch.setattr("tierflow.plans.silver.dedupe_latest", lambda *given, real=dedupe_latest: calls.append(1) or real(*given))
    monkeypatch.setattr(registry, "stage", lambda df, path, real=stage: staged.append(path) or real(df, path))
    found = registry.QUERIES["silver_dedupe_incremental"](large, folder)
    assert len(calls) == 3 and len(staged) == 1
    assert sorted(map(str, found.collect())) == sorted(map(str, registry.QUERIES["silver_dedupe"](large, folder).collect()))
