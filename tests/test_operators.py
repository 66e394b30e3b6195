"""Deduplication, star lookup, surrogate keys, types."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tierflow import schemas
from tierflow.functions.scalars import calendar_date, qty_in_mt, qty_in_nos, tokens, whole_number
from tierflow.operators.dedupe import dedupe_latest
from tierflow.operators.enrich import enrich_star
from tierflow.operators.keys import assign_surrogate_keys, next_key
from tierflow.plans import gold, sample, silver

SF_DIR = "/root/testdata/sf0.001"


def test_dedupe_keeps_lowest_type_oldest_insert_latest_update(spark, rows):
    schema = "k string, type string, ins int, upd int"
    df = spark.createDataFrame(
        [("g", "b", 1, 1), ("g", "a", 2, 1), ("g", "a", 1, 1), ("g", "a", 1, 2), ("g", "a", 1, None),
         ("g", None, 0, 9), (None, "z", 1, 1), (None, "z", 2, 1)], schema)
    order = [("type", "asc", "last"), ("ins", "asc", "last"), ("upd", "desc", "first")]
    assert rows(dedupe_latest(df, ["k"], order)) == [("g", "a", 1, None), (None, "z", 1, 1)]


def test_silver_dedupe_compares_bronze_text(spark):
    bronze = spark.createDataFrame([("2",), ("2.4",), ("2",)], "quantity string").withColumns({
        f.name: F.lit("2024-01-01" if f.name == "invoice_date" else "1").cast(f.dataType)
        if f.dataType == schemas.TEXT else F.lit(None).cast(f.dataType)
        for f in schemas.BZ_ORDERDETAILS.fields if f.name != "quantity"})
    found = silver.silver_dedupe(bronze)
    assert [(f.name, f.dataType) for f in found.schema] == [(f.name, f.dataType) for f in schemas.SL_ORDERDETAILS]
    assert [r.quantity for r in found.collect()] == [Decimal(2), Decimal(2)]


@pytest.fixture
def star(spark):
    orders = spark.createDataFrame(
        [("c1", "m1", "g1", "i1", 20000, 1500), (None, "m9", "g1", "i2", 1, 1), ("c9", None, "g1", "i3", 1, 1),
         ("c1", "m1", "g9", "i4", 1, 1), ("c2", "m2", "g1", "i5", 1, 1)],
        "customer_no string, company_name string, product_group_code string, invoice_no string, quantity int, kgs int"
    ).withColumns({
        "invoice_date": F.lit("2024-01-01").cast("date"), "csp_yes_no": F.lit("Y"), "type": F.lit("t"),
        "uom": F.lit("kg"), "quantity": F.col("quantity").cast("decimal(38,0)"),
        "kgs": F.col("kgs").cast("decimal(38,0)")})
    dims = {
        "product": spark.createDataFrame([(1, "g1"), (2, "g1")], "product_id bigint, product_group_code string"),
        "date": spark.createDataFrame([(7, "2024-01-01 10:00:00")], "date_id int, fulldate string"),
        "customer": spark.createDataFrame([(10, "c1", "e1"), (20, "c2", "e9"), (30, None, "e1")],
                                          "customerid bigint, customer_no string, kam_emp_no string"),
        "company": spark.createDataFrame([(100, "m1"), (200, "m2"), (900, None)],
                                         "company_id bigint, company_name string"),
        "plant": spark.createDataFrame([(1000, "m1"), (1001, "m1"), (9000, "m9"), (9001, None)],
                                       "plant_id bigint, company_name string"),
        "employee": spark.createDataFrame([("e1",)], "emp_no string"),
    }
    return orders, dims


def test_star_left(star, rows):
    found = enrich_star(*star)
    assert found.schema.fieldNames() == schemas.GL_ORDERDETAILS_FS1.fieldNames()
    assert [f.dataType for f in found.schema.fields] == [f.dataType for f in schemas.GL_ORDERDETAILS_FS1.fields]
    one = found.where("product_id = 1")
    assert rows(one, "invoice_no", "customerid", "company_id", "plant_id", "date_id") == sorted([
        ("i1", 10, 100, 1000, 7), ("i1", 10, 100, 1001, 7), ("i2", None, None, 9000, 7),
        ("i3", None, None, None, 7), ("i5", 20, 200, None, 7)], key=repr)
    assert found.count() == 2 * one.count()
    assert rows(one.where("plant_id = 1000"), "qty_in_nos", "qty_in_mt") == [(Decimal("2.000000"), Decimal("1.500000"))]


def test_star_inner_with_employee(star, rows):
    found = enrich_star(*star, "inner", with_employee=True)
    assert found.schema.fieldNames() == schemas.GL_ORDERDETAILS_FS2.fieldNames()[:15]
    assert rows(found.where("product_id = 1"), "invoice_no", "customer_id", "employee_id", "plant_id") == [
        ("i1", 10, "e1", 1000), ("i1", 10, "e1", 1001)]


@pytest.mark.parametrize("parts", [1, 3, 9])
def test_surrogate_keys_do_not_depend_on_partitioning(spark, rows, parts):
    df = spark.createDataFrame([(c,) for c in "gbfadec"], "code string").repartition(parts)
    assert rows(assign_surrogate_keys(df, "code", "sk", start=11), "code", "sk") == [
        (c, 11 + i) for i, c in enumerate("abcdefg")]


def test_surrogate_keys_of_copies_and_nothing(spark):
    df = spark.range(1000).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS code", "1 AS x").repartition(7)
    keyed = assign_surrogate_keys(df, ["code"], "sk")
    assert sorted(r.sk for r in keyed.collect()) == list(range(1, 1001))
    assert [r.code for r in keyed.orderBy("sk").collect()] == sorted(r.code for r in df.collect())
    assert assign_surrogate_keys(df.where("false"), ["code"], "sk").isEmpty()
    assert next_key(keyed, "sk") == 1001 and next_key(keyed.where("false"), "sk") == 1


def test_dim_product_continues_numbering(spark):
    names = ["product_no", "type", "product_group_code", "rm_type", "product_vertical", "product_mvertical"]
    products = spark.createDataFrame([("p2",) * 6, ("p1",) * 6], names)
    found = gold.dim_product_rows(products, "2024-01-01 00:00:00", start=8).orderBy("gl_product_id")
    assert sorted(found.columns) == sorted(schemas.DIM_PRODUCT.fieldNames())
    assert [(r.gl_product_id, r.product_no, r.active_flag, r.end_date) for r in found.collect()] == [
        (8, "p1", "Y", None), (9, "p2", "Y", None)]


def test_scalars(spark):
    df = spark.createDataFrame([("2.5", "2024-01-31"), ("-2.5", "x"), ("n/a", None)], "n string, d string")
    found = df.select(whole_number(F.col("n"), strict=False), calendar_date(F.col("d"), strict=False)).collect()
    assert [r[0] for r in found] == [Decimal(3), Decimal(-3), None]
    assert [str(r[1]) for r in found] == ["2024-01-31", "None", "None"]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.select(whole_number(F.col("n"))).collect()
    one = spark.range(1)
    assert one.select(tokens(F.lit("a  b "))).first()[0] == ["a", "", "b", ""]
    assert one.select(tokens(F.lit(""))).first()[0] == [""]
    assert one.select(qty_in_nos(F.lit(15)), qty_in_mt(F.lit(1))).first()[:] == (
        Decimal("0.001500"), Decimal("0.001000"))


def test_tables_are_created_empty_and_replaced(spark):
    for _ in range(2):
        schemas.create_or_replace_table(spark, "gl_orderdetails_fs2", schemas.GL_ORDERDETAILS_FS2,
                                        partition_by=["active_flag"])
        found = spark.read.table("gl_orderdetails_fs2")
        assert found.isEmpty() and set(found.columns) == set(schemas.GL_ORDERDETAILS_FS2.fieldNames())
        spark.createDataFrame([], schemas.GL_ORDERDETAILS_FS2).write.mode("append").insertInto("gl_orderdetails_fs2")
    spark.sql("DROP TABLE gl_orderdetails_fs2")
    spark.createDataFrame([(1, "a")], "n int, s string").write.saveAsTable("by_name")
    schemas.append_by_name(spark.createDataFrame([("b", 2)], "s string, n int"), "by_name")
    assert sorted(map(tuple, spark.table("by_name").collect())) == [(1, "a"), (2, "b")]
    with pytest.raises(Exception, match="column"):
        schemas.append_by_name(spark.createDataFrame([("b",)], "s string"), "by_name")
    spark.sql("DROP TABLE by_name")
    assert [f.name for f in schemas.empty_table(spark, schemas.DIM_PRODUCT).schema.fields if not f.nullable] == [
        "gl_product_id"]


def test_star_reads_only_its_columns_and_broadcasts_small_lookups(spark):
    plan = enrich_star(sample.order_rows(spark, SF_DIR), sample.dims(spark, SF_DIR))._jdf.queryExecution()
    plan = plan.executedPlan().toString()
    lineitem = next(line for line in plan.split("\n") if "FileScan" in line and "l_orderkey" in line)
    read = lineitem[lineitem.index("ReadSchema"):]
    assert "l_quantity" in read and not any(c in read for c in ("l_tax", "l_discount", "l_extendedprice"))
    assert "SortMergeJoin" not in plan and "PushedFilters: [IsNotNull(c_mktsegment), Not(EqualTo(c_mktsegment" in plan
