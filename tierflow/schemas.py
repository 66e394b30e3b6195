"""Table schemas and typed empty tables.

The column names and types below are fixed values of the data model.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

KEY = T.LongType()
TEXT = T.StringType()
DATE = T.DateType()
MOMENT = T.TimestampNTZType()
WHOLE = T.DecimalType(38, 0)
MEASURE = T.DecimalType(38, 6)


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


# Business columns of an order line, as the source system delivers them (all text).
ORDER_DETAILS = _schema(
    ("customer_no", TEXT), ("company_name", TEXT), ("product_group_code", TEXT), ("invoice_no", TEXT),
    ("invoice_date", TEXT), ("csp_yes_no", TEXT), ("type", TEXT), ("uom", TEXT),
    ("quantity", TEXT), ("kgs", TEXT), ("lastmodifieddate", MOMENT),
)

BZ_ORDERDETAILS = T.StructType(ORDER_DETAILS.fields[:-1]).add("insert_date", MOMENT).add("update_date", MOMENT)

SL_ORDERDETAILS = _schema(
    ("customer_no", TEXT), ("company_name", TEXT), ("product_group_code", TEXT), ("invoice_no", TEXT),
    ("invoice_date", DATE), ("csp_yes_no", TEXT), ("type", TEXT), ("uom", TEXT),
    ("quantity", WHOLE), ("kgs", WHOLE), ("insert_date", MOMENT), ("update_date", MOMENT),
)

_FACT_TAIL = (
    ("invoice_no", TEXT), ("invoice_date", DATE), ("csp_yes_no", TEXT), ("type", TEXT), ("uom", TEXT),
    ("quantity", WHOLE), ("kgs", WHOLE), ("qty_in_nos", MEASURE), ("qty_in_mt", MEASURE),
)

GL_ORDERDETAILS_FS1 = _schema(
    ("customerid", KEY), ("company_id", KEY), ("product_id", KEY), ("plant_id", KEY),
    ("date_id", T.IntegerType()), *_FACT_TAIL,
)

GL_ORDERDETAILS_FS2 = _schema(
    ("customer_id", KEY), ("company_id", KEY), ("product_id", KEY), ("plant_id", KEY),
    ("date_id", T.IntegerType()), ("employee_id", TEXT), *_FACT_TAIL,
    ("start_date", MOMENT), ("end_date", MOMENT), ("active_flag", TEXT),
)

DIM_PRODUCT = T.StructType(
    [T.StructField("gl_product_id", KEY, False)]
    + _schema(
        ("product_no", TEXT), ("type", TEXT), ("product_group_code", TEXT), ("rm_type", TEXT),
        ("product_vertical", TEXT), ("product_mvertical", TEXT),
        ("start_date", MOMENT), ("end_date", MOMENT), ("active_flag", TEXT),
    ).fields
)

# The run ledger. ``watermark`` is the highest source change time the run has read.
INGESTION_HISTORY = T.StructType(
    [T.StructField("run_id", T.LongType(), False)]
    + _schema(
        ("run_start", MOMENT), ("run_end", MOMENT), ("duration", T.DoubleType()),
        ("source_server_name", TEXT), ("source_database_name", TEXT),
        ("source_schema_name", TEXT), ("source_table_name", TEXT),
        ("target_database_name", TEXT), ("target_schema_name", TEXT), ("target_table_name", TEXT),
        ("snowflake_flag", T.BooleanType()), ("triggered_by", TEXT), ("status", TEXT), ("error", TEXT),
        ("source_nbr_of_records", T.LongType()), ("target_nbr_of_records", T.LongType()),
        ("created_date", MOMENT), ("created_by", TEXT), ("modified_date", MOMENT), ("modified_by", TEXT),
        ("watermark", MOMENT),
    ).fields
)

CUSTOMER_REVIEWS = _schema(*[(name, TEXT) for name in (
    "url", "product_name", "reviewer_name", "review_title", "review_text",
    "review_rating", "verified_purchase", "review_date", "helpful_count", "uniq_id",
)])

PEOPLE = _schema(("userID", T.IntegerType()), ("name", TEXT), ("age", T.IntegerType()), ("friends", T.IntegerType()))


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def create_or_replace_table(spark: SparkSession, name: str, schema: T.StructType, fmt: str = "parquet",
                            partition_by: Sequence[str] = ()) -> None:
    """Create the table empty; a table of that name is replaced."""
    writer = empty_table(spark, schema).write.format(fmt).mode("overwrite")
    writer.partitionBy(*partition_by).saveAsTable(name) if partition_by else writer.saveAsTable(name)


def append_by_name(df: DataFrame, name: str) -> None:
    """Append to a catalog table; columns are matched by name, and other types or columns fail."""
    df.write.mode("append").saveAsTable(name)
