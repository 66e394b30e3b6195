"""Hot keys: a third of the rows share one key, and lookups are too large to broadcast.

The runtime thresholds are lowered so that small tables show what large ones would: each join
of the large side has to be split (``skew=true``), each grouping reduced before its shuffle.
"""

import pytest
from pyspark.sql import functions as F

from tierflow.operators.dedupe import dedupe_latest
from tierflow.operators.enrich import enrich_star
from tierflow.operators.keys import assign_surrogate_keys
from tierflow.operators.merge import cdc_apply, scd1_merge, scd2_merge, snapshot_diff
from tierflow.sources.tables import stage

N = 60000
SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def tight(spark):
    before = {name: spark.conf.get(name, None) for name in SMALL}
    for name, value in SMALL.items():
        spark.conf.set(name, value)
    yield spark
    for name, value in before.items():
        spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


def run(df):
    """Execute the frame; its final plan."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    return execution.executedPlan().toString().split("== Initial Plan ==")[0]


def splits(df):
    return run(df).count("skew=true")


@pytest.fixture
def hot(tight, tmp_path):
    """(NULL, 1) holds a third of the rows; the other keys are unique."""
    df = tight.range(N, numPartitions=16).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id").cast("string")).alias("invoice_no"),
        F.lit(1).cast("bigint").alias("product_id"), F.col("id").cast("int").alias("quantity"))
    return stage(df, str(tmp_path / "hot"))


@pytest.fixture
def batch(tight, tmp_path):
    df = tight.range(0, N * 2, 4, numPartitions=8).select(
        F.col("id").cast("string").alias("invoice_no"), F.lit(1).cast("bigint").alias("product_id"),
        F.lit(-1).alias("quantity"))
    return stage(df, str(tmp_path / "batch"))


KEYS = ["invoice_no", "product_id"]


def total(df):
    return df.agg(F.count("*"), F.sum("quantity"), F.count("invoice_no")).first()[:]


def brute_upsert(spark, hot, batch):
    hot.createOrReplaceTempView("hot")
    batch.createOrReplaceTempView("batch")
    return spark.sql("""
        SELECT h.invoice_no, h.product_id, coalesce(b.quantity, h.quantity) AS quantity FROM hot h LEFT JOIN batch b
          ON h.invoice_no = b.invoice_no AND h.product_id = b.product_id
        UNION ALL SELECT b.* FROM batch b WHERE NOT EXISTS (SELECT 1 FROM hot h WHERE h.invoice_no = b.invoice_no)""")


def test_scd1_splits_a_hot_target_key(tight, hot, batch):
    merged = scd1_merge(hot, batch, KEYS)
    assert total(merged) == total(brute_upsert(tight, hot, batch))
    assert splits(merged) >= 1


def test_scd1_splits_a_hot_new_key(hot, batch):
    merged = scd1_merge(batch, hot, KEYS)
    assert merged.where("invoice_no IS NULL").count() == N // 3
    assert splits(merged) >= 1


def test_cdc_splits_a_hot_key(tight, hot, batch):
    feed = batch.withColumns({"_action": F.lit("INSERT"), "_is_update": F.lit(False)})
    merged = cdc_apply(hot, feed, KEYS, upsert_on_insert=True)
    assert total(merged) == total(brute_upsert(tight, hot, batch))
    assert splits(merged) >= 1


def versions(df):
    return df.withColumns({"start_date": F.lit("2020-01-01").cast("timestamp_ntz"),
                           "end_date": F.lit(None).cast("timestamp_ntz"), "active_flag": F.lit("Y")})


def test_scd2_splits_hot_target_and_source_keys(hot, batch):
    merged = scd2_merge(versions(hot), batch, KEYS, ["quantity"], "2024-01-01 00:00:00")
    changed = batch.join(hot, KEYS, "left_semi").count()
    new = batch.count() - changed
    assert total(merged)[0] == N + changed + new
    assert splits(merged) >= 1
    # The other way round all NULL keys are new, as they match nothing.
    merged = scd2_merge(versions(batch), hot, KEYS, ["quantity"], "2024-01-01 00:00:00")
    assert merged.where("invoice_no IS NULL").count() == N // 3
    assert splits(merged) >= 1


@pytest.mark.parametrize("how, with_employee", [("left", False), ("inner", False), ("inner", True)])
def test_star_splits_hot_lookup_keys(tight, tmp_path, how, with_employee):
    third = (F.col("id") % 3) == 0

    def key(prefix):
        return F.when(third, F.lit(f"{prefix}0")).otherwise(F.concat(F.lit(prefix), (F.col("id") % 5000).cast("string")))

    orders = stage(tight.range(N, numPartitions=16).select(
        key("c").alias("customer_no"), key("m").alias("company_name"), key("g").alias("product_group_code"),
        F.col("id").cast("string").alias("invoice_no"),
        F.date_add(F.lit("2000-01-01").cast("date"), F.when(third, 0).otherwise(F.col("id") % 5000).cast("int"))
        .alias("invoice_date"),
        F.lit("Y").alias("csp_yes_no"), F.lit("t").alias("type"), F.lit("u").alias("uom"),
        F.lit(1).cast("decimal(38,0)").alias("quantity"), F.lit(1).cast("decimal(38,0)").alias("kgs")),
        str(tmp_path / "orders"))
    ids = tight.range(5000, numPartitions=4)

    def lookup(name, id_col, key_col, prefix):
        frame = ids.select(F.col("id").alias(id_col), F.concat(F.lit(prefix), F.col("id").cast("string")).alias(key_col),
                           F.col("id").cast("string").alias("kam_emp_no"))
        return stage(frame, str(tmp_path / name))

    dims = {
        "product": lookup("product", "product_id", "product_group_code", "g"),
        "customer": lookup("customer", "customerid", "customer_no", "c"),
        "company": lookup("company", "company_id", "company_name", "m"),
        "plant": lookup("plant", "plant_id", "company_name", "m"),
        "employee": stage(ids.select(F.col("id").cast("string").alias("emp_no")), str(tmp_path / "employee")),
        "date": stage(ids.select(F.col("id").cast("int").alias("date_id"), F.date_add(
            F.lit("2000-01-01").cast("date"), F.col("id").cast("int")).alias("fulldate")), str(tmp_path / "date")),
    }
    found = enrich_star(orders, dims, how, with_employee)
    customer = "customer_id" if with_employee else "customerid"
    assert found.where(f"plant_id = company_id AND {customer} = product_id AND date_id = plant_id").count() == N
    assert splits(found) == (5 if with_employee else 4)


def test_dedupe_reduces_a_hot_group_before_the_shuffle(hot):
    plan = run(dedupe_latest(hot, KEYS, [("quantity", "asc", "last")]))
    below = plan[plan.index("Exchange hashpartitioning(invoice_no"):]
    assert "WindowGroupLimit" in below and "Partial" in below
    assert dedupe_latest(hot, KEYS, [("quantity", "asc", "last")]).count() == N - N // 3 + 1


def test_diff_of_hot_keys_fails_instead_of_pairing_them(hot):
    with pytest.raises(Exception, match="several rows of one key"):
        snapshot_diff(hot, hot, KEYS).collect()


def test_surrogate_keys_spread_copies(tight, hot, tmp_path):
    copies = hot.select("invoice_no")
    keyed = assign_surrogate_keys(copies, "invoice_no", "sk")
    found = keyed.agg(F.min("sk"), F.max("sk"), F.count_distinct("sk")).first()[:]
    assert found == (1, N, N)


@pytest.mark.parametrize("merge", ["scd1", "scd2"])
def test_a_small_batch_leaves_the_table_unshuffled(spark, tmp_path, merge):
    table = stage(versions(spark.range(100000).selectExpr(
        "cast(id AS string) invoice_no", "1L AS product_id", "cast(id AS int) quantity")), str(tmp_path / "table"))
    batch = stage(spark.range(0, 200000, 1000).selectExpr(
        "cast(id AS string) invoice_no", "1L AS product_id", "-1 AS quantity"), str(tmp_path / "batch"))
    if merge == "scd1":
        merged = scd1_merge(table, batch, KEYS, ["quantity"])
    else:
        merged = scd2_merge(table, batch, KEYS, ["quantity"], "2024-01-01 00:00:00")
    assert merged.where("quantity = -1").count() == 200
    plan = run(merged)
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    # The known keys are cut down by the broadcast batch below their exchange.
    known = plan[plan.rindex("Exchange hashpartitioning(invoice_no"):]
    assert "LeftSemi" in known


def shuffles(df, name):
    """Whether the plan has an exchange fed by a scan of that table, with nothing but one input between."""
    lines = run(df).split("\n")

    def depth(line):
        return len(line) - len(line.lstrip(" :+-*"))

    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line and "ReusedExchange" not in line:
            below = []
            for other in lines[i + 1:]:
                if depth(other) <= depth(line):
                    break
                below.append(other)
            first = next((other for other in below if "FileScan" in other or "Exchange" in other or "Join" in other), "")
            if "FileScan" in first and name in first:
                return True
    return False


@pytest.mark.parametrize("merge", ["scd1", "scd2", "cdc"])
def test_a_bucketed_table_is_not_shuffled(tight, hot, batch, merge):
    name = f"bucketed_{merge}"
    table = versions(hot) if merge == "scd2" else hot
    table.where("invoice_no IS NOT NULL").write.bucketBy(16, *KEYS).sortBy(*KEYS).saveAsTable(name)
    table = tight.read.table(name)
    if merge == "scd1":
        merged = scd1_merge(table, batch, KEYS, bucketed=True)
        wanted = scd1_merge(table, batch, KEYS)
    elif merge == "scd2":
        merged = scd2_merge(table, batch, KEYS, ["quantity"], "2024-01-01 00:00:00", bucketed=True)
        wanted = scd2_merge(table, batch, KEYS, ["quantity"], "2024-01-01 00:00:00")
    else:
        feed = batch.withColumns({"_action": F.lit("INSERT"), "_is_update": F.lit(False)})
        merged = cdc_apply(table, feed, KEYS, upsert_on_insert=True, bucketed=True)
        wanted = cdc_apply(table, feed, KEYS, upsert_on_insert=True)
    assert total(merged) == total(wanted)
    assert shuffles(wanted, name) and not shuffles(merged, name)
    tight.sql(f"DROP TABLE {name}")
