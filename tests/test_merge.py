"""Merges on small tables with results worked out by hand."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tierflow.operators import merge
from tierflow.operators.merge import (
    cdc_apply, drop_update_deletes, row_changes, scd1_merge, scd2_merge, scd2_parts, snapshot_diff)
from tierflow.plans import silver
from tierflow.schemas import SL_ORDERDETAILS

OLD, RUN = "2020-01-01 00:00:00", "2024-06-01 12:00:00"
KEYS = ["invoice_no", "product_id"]
VERSIONED = ("invoice_no string, product_id bigint, customer_id bigint, employee_id string, quantity int, "
             "start_date timestamp_ntz, end_date timestamp_ntz, active_flag string")


def versioned(spark, *data):
    cols = "invoice_no string, product_id bigint, customer_id bigint, employee_id string, quantity int, " \
           "start_date string, end_date string, active_flag string"
    df = spark.createDataFrame(list(data), cols)
    return df.selectExpr("invoice_no", "product_id", "customer_id", "employee_id", "quantity",
                         "cast(start_date as timestamp_ntz) start_date", "cast(end_date as timestamp_ntz) end_date",
                         "active_flag")


@pytest.fixture
def scd2_tables(spark):
    target = versioned(
        spark,
        ("A", 1, 10, "7", 5, OLD, None, "Y"), ("B", 1, 10, "7", 5, OLD, None, "Y"),
        ("C", 1, 10, "7", 5, OLD, None, "Y"), ("D", 1, 10, "7", 5, OLD, OLD, "N"),
        ("E", 1, None, "7", 5, OLD, None, "Y"))
    source = spark.createDataFrame(
        [("A", 1, 10, "7", 6), ("B", 1, 11, "7", 5), ("C", 1, 10, "8", 5), ("D", 1, 10, "7", 9),
         ("E", 1, 12, "7", 5), ("F", 1, 10, "7", 5)],
        "invoice_no string, product_id bigint, customer_id bigint, employee_id string, quantity int")
    return target, source


def short(df):
    picked = df.selectExpr("invoice_no", "customer_id", "employee_id", "quantity", "active_flag",
                           f"end_date = timestamp_ntz'{RUN}' AS closed_now", f"start_date = timestamp_ntz'{RUN}' AS new")
    return sorted([tuple(r) for r in picked.collect()], key=repr)


def test_scd2_default(scd2_tables):
    target, source = scd2_tables
    merged = scd2_merge(target, source, KEYS, ["customer_id", "employee_id", "quantity"], RUN)
    assert short(merged) == sorted([
        ("A", 10, "7", 5, "N", True, False), ("A", 10, "7", 6, "Y", None, True),
        ("B", 10, "7", 5, "N", True, False), ("B", 11, "7", 5, "Y", None, True),
        ("C", 10, "7", 5, "N", True, False), ("C", 10, "8", 5, "Y", None, True),
        ("D", 10, "7", 5, "N", False, False),
        ("E", None, "7", 5, "N", True, False), ("E", 12, "7", 5, "Y", None, True),
        ("F", 10, "7", 5, "Y", None, True)], key=repr)


def test_scd2_compat(scd2_tables):
    target, source = scd2_tables
    merged = scd2_merge(target, source, KEYS, ["customer_id", "quantity"], RUN, null_safe=False,
                        version_cols=["quantity"])
    assert short(merged) == sorted([
        ("A", 10, "7", 5, "N", True, False), ("A", 10, "7", 6, "Y", None, True),
        ("B", 10, "7", 5, "N", True, False), ("C", 10, "7", 5, "Y", None, False),
        ("D", 10, "7", 5, "N", False, False), ("E", None, "7", 5, "Y", None, False),
        ("F", 10, "7", 5, "Y", None, True)], key=repr)


def test_scd2_parts_leave_out_closed_history(scd2_tables):
    target, source = scd2_tables
    opened, closed = scd2_parts(target, source, KEYS, ["customer_id", "employee_id", "quantity"], RUN)
    assert opened.count() == 5 and closed.count() == 4
    assert {r.invoice_no for r in closed.collect()} == {"A", "B", "C", "E"}


def test_scd2_null_key_matches_nothing(spark):
    target = versioned(spark, (None, 1, 10, "7", 5, OLD, None, "Y"))
    source = spark.createDataFrame(
        [(None, 1, 10, "7", 6), (None, 1, 10, "7", 6)],
        "invoice_no string, product_id bigint, customer_id bigint, employee_id string, quantity int")
    merged = scd2_merge(target, source, KEYS, ["customer_id", "employee_id", "quantity"], RUN)
    assert short(merged) == [(None, 10, "7", 5, "Y", None, False)] + [(None, 10, "7", 6, "Y", None, True)] * 2


def test_scd2_two_source_rows_for_a_current_row_fail(scd2_tables):
    target, source = scd2_tables
    twice = source.unionByName(source.where("invoice_no = 'A'"))
    with pytest.raises(PySparkException, match="several source rows"):
        scd2_merge(target, twice, KEYS, ["customer_id", "employee_id", "quantity"], RUN).collect()


def test_scd2_copies_of_an_unseen_or_closed_key_do_not_fail(scd2_tables):
    target, source = scd2_tables
    twice = source.unionByName(source.where("invoice_no IN ('D', 'F')"))
    merged = scd2_merge(target, twice, KEYS, ["customer_id", "employee_id", "quantity"], RUN)
    counts = {r.invoice_no: r["count"] for r in merged.groupBy("invoice_no").count().collect()}
    assert counts == {"A": 2, "B": 2, "C": 2, "D": 1, "E": 2, "F": 2}


FACT = "invoice_no string, product_id bigint, quantity int"


def test_scd1_keys_are_null_safe(spark, rows):
    target = spark.createDataFrame([(None, 1, 5), ("X", 1, 5), ("Z", 1, 5)], FACT)
    source = spark.createDataFrame([(None, 1, 6), ("X", 1, 6), ("Y", 1, 6)], FACT)
    assert rows(scd1_merge(target, source, KEYS)) == sorted(
        [(None, 1, 6), ("X", 1, 6), ("Y", 1, 6), ("Z", 1, 5)], key=repr)


def test_scd1_duplicates(spark, rows):
    target = spark.createDataFrame([("X", 1, 5), ("X", 1, 4), ("Z", 1, 5)], FACT)
    source = spark.createDataFrame([("X", 1, 6), ("Y", 1, 6), ("Y", 1, 7)], FACT)
    # Both target rows are overwritten, both rows of a new key are added.
    assert rows(scd1_merge(target, source, KEYS)) == [
        ("X", 1, 6), ("X", 1, 6), ("Y", 1, 6), ("Y", 1, 7), ("Z", 1, 5)]
    clash = source.unionByName(spark.createDataFrame([("X", 1, 7)], FACT))
    with pytest.raises(PySparkException, match="several source rows"):
        scd1_merge(target, clash, KEYS).collect()
    latest = scd1_merge(target, clash, KEYS, on_duplicate="latest", latest_by=[("quantity", "desc", "last")])
    assert rows(latest) == [("X", 1, 7), ("X", 1, 7), ("Y", 1, 7), ("Z", 1, 5)]


def test_scd1_only_given_columns(spark, rows):
    target = spark.createDataFrame([("X", 1, 5, "a")], FACT + ", note string")
    source = spark.createDataFrame([("X", 1, 6, "b")], FACT + ", note string")
    assert rows(scd1_merge(target, source, KEYS, ["quantity"])) == [("X", 1, 6, "a")]


FEED = "id int, quantity int, _action string, _is_update boolean"
FEED_ROWS = [(1, 6, "INSERT", True), (2, 5, "INSERT", True), (3, 5, "DELETE", False), (4, 5, "DELETE", True),
             (5, 5, "INSERT", False), (6, 5, "INSERT", True), (7, 9, "INSERT", False)]


@pytest.mark.parametrize("options, wanted", [
    ({}, [(1, 6), (2, 5), (4, 5), (5, 5), (7, 5)]),
    ({"compat": True}, [(1, 6), (2, 5), (3, 5), (5, 5), (7, 5)]),
    ({"upsert_on_insert": True}, [(1, 6), (2, 5), (4, 5), (5, 5), (7, 9)]),
])
def test_cdc_apply(spark, rows, options, wanted):
    target = spark.createDataFrame([(k, 5) for k in (1, 2, 3, 4, 7)], "id int, quantity int")
    assert rows(cdc_apply(target, spark.createDataFrame(FEED_ROWS, FEED), ["id"], **options)) == wanted


def test_cdc_two_changes_of_a_row_fail(spark):
    target = spark.createDataFrame([(1, 5)], "id int, quantity int")
    pair = spark.createDataFrame([(1, 5, "DELETE", True), (1, 6, "INSERT", True)], FEED)
    with pytest.raises(PySparkException, match="several source rows"):
        cdc_apply(target, pair, ["id"], compat=True).collect()
    assert [tuple(r) for r in cdc_apply(target, drop_update_deletes(pair), ["id"]).collect()] == [(1, 6)]


def test_snapshot_diff(spark, rows):
    schema = "id int, a string, b int"
    old = spark.createDataFrame([(1, "x", 1), (2, "x", None), (3, "x", 3), (None, "n", 1)], schema)
    new = spark.createDataFrame([(1, "x", 1), (2, "x", 2), (4, "x", 4), (None, "m", 1)], schema)
    assert rows(snapshot_diff(old, new, ["id"])) == sorted([
        (2, "x", None, "DELETE", True), (2, "x", 2, "INSERT", True), (3, "x", 3, "DELETE", False),
        (4, "x", 4, "INSERT", False), (None, "n", 1, "DELETE", True), (None, "m", 1, "INSERT", True)], key=repr)
    with pytest.raises(PySparkException, match="several rows of one key"):
        snapshot_diff(old.unionByName(old), new, ["id"]).collect()


def test_row_changes(spark, rows):
    old = spark.createDataFrame([(1, 5), (2, None), (3, None)], "id int, v int")
    new = spark.createDataFrame([(1, 6), (2, None), (3, 1), (4, 1)], "id int, v int")
    assert rows(row_changes(old, new, ["id"], ["v"])) == [(1, 6), (3, 1)]


def cdc_case(spark, *changes, **options):
    table = spark.createDataFrame([("A", 1, 5), ("B", 1, 5), ("C", 1, 5)], "invoice_no string, product_id int, quantity int")
    feed = spark.createDataFrame(list(changes), "invoice_no string, product_id int, quantity int, _action string, _is_update boolean")
    return sorted(tuple(r) for r in cdc_apply(table, feed, KEYS, **options).collect())


def test_a_key_deleted_and_added_again_stays(spark):
    changes = [("A", 1, 5, "DELETE", False), ("A", 1, 5, "INSERT", False), ("B", 1, 5, "DELETE", False),
               ("B", 1, 9, "INSERT", False), ("C", 1, 5, "DELETE", False), ("D", 1, 1, "DELETE", False), ("D", 1, 2, "INSERT", False)]
    wanted = [("A", 1, 5), ("B", 1, 9), ("D", 1, 2)]
    assert cdc_case(spark, *changes) == wanted
    assert cdc_case(spark, *changes, upsert_on_insert=True) == wanted
    # literally: true deletes do nothing, and inserts of known keys neither
    assert cdc_case(spark, *changes, compat=True) == [("A", 1, 5), ("B", 1, 5), ("C", 1, 5), ("D", 1, 2)]


def test_random_feeds_with_deletes_and_inserts_of_a_key(spark):
    rng = random.Random(12)
    for _ in range(6):
        changes, expected = [], {"A": [5], "B": [5], "C": [5]}
        for key in "ABCDE":
            held = key in expected
            deleted, inserts = rng.random() < 0.5, rng.choice([[], [7], [8, 9]])
            changes += [(key, 1, 5, "DELETE", False)] * deleted + [(key, 1, q, "INSERT", False) for q in inserts]
            if deleted:
                expected.pop(key, None)
            if inserts and (deleted or not held):
                expected[key] = inserts
        rng.shuffle(changes)
        wanted = sorted((k, 1, q) for k, found in expected.items() for q in found)
        if changes:
            assert cdc_case(spark, *changes) == wanted


def test_row_changes_refuse_repeated_keys(spark):
    table = spark.createDataFrame([(None, 1, 5)] * 3, "invoice_no string, product_id int, quantity int")
    with pytest.raises(PySparkException, match="several rows of one key"):
        row_changes(table, table, KEYS, ["quantity"]).collect()


FEED_COLS = f"{', '.join(f'{c} string' for c in silver.COPY_COLS[:1] + silver.COPY_COLS[2:6])}, kgs int, _action string, _is_update boolean"


def order_feed(spark, *changes):
    """Changes of (key, weight, action, is an update) as silver rows."""
    rows = [(k, "c", "m", "p", "Y", kgs, action, update) for k, kgs, action, update in changes]
    missing = {c: F.lit(None).cast(SL_ORDERDETAILS[c].dataType) for c in ("invoice_date", "type", "uom", "quantity", "insert_date", "update_date")}
    return spark.createDataFrame(rows, FEED_COLS).withColumns(missing)


@pytest.mark.parametrize("compat", [False, True])
def test_changes_of_a_feed_are_counted_once(spark, monkeypatch, compat):
    table = silver.silver_rows(order_feed(spark, ("1", 1, "", True), ("2", 1, "", True), (None, 1, "", True))).select(*SL_ORDERDETAILS.fieldNames())
    asked = []
    for module, name in ((silver, "dedupe_few"), (merge, "_repeated")):
        real = getattr(module, name)
        monkeypatch.setattr(module, name, lambda *given, name=name, real=real: asked.append(name) or real(*given))

    def applied(*changes):
        found = silver.silver_apply(table, order_feed(spark, *changes), compat).select("invoice_no", "kgs").collect()
        return sorted(((r[0], int(r[1])) for r in found), key=str), [asked.pop() for _ in asked[:]][::-1]

    single = [("1", 5, "INSERT", True), ("2", 1, "DELETE", compat), (None, 6, "INSERT", True), ("4", 4, "INSERT", False)]
    assert applied(*single) == ([("1", 5), ("4", 4), (None, 6)], [])
    # a copy, and a key that is deleted and added again
    assert applied(*single, single[0]) == ([("1", 5), ("4", 4), (None, 6)], ["dedupe_few", "_repeated"])
    again, looked = applied(*single, ("2", 7, "INSERT", False))
    assert again == ([("1", 5), ("4", 4), (None, 6)] if compat else [("1", 5), ("2", 7), ("4", 4), (None, 6)])
    assert looked == (["dedupe_few"] if compat else []) + ["_repeated"]
    with pytest.raises(Exception, match="several source rows match one target row"):
        applied(*single, ("1", 8, "INSERT", True))
