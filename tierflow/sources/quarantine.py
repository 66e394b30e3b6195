"""CSV records checked against a schema, so that none is lost or changed in silence.

A plain read with a schema turns what doesn't fit into NULLs: numbers that aren't, missing fields; and
surplus fields vanish. Here a record is read as text, cast field by field, and told why if it
doesn't fit. Both kinds go on in one stream; ``streaming.sinks.split_batches`` writes them apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.sources.streams import csv_stream

# Name under which the counts of good and bad records are observed.
OBSERVED = "records"
_RECORD = "_record"


def checked_csv_stream(spark: SparkSession, path: str, schema: T.StructType, **options) -> DataFrame:
    """The records of a ``csv_stream``: the columns of the schema, then reason, record and file.

    ``reason`` is NULL for a record that fits. Else it says what is wrong: too few or too many fields,
    and each field whose text is no value of its type; ``record`` then holds the fields as they were
    read, as JSON, or the whole line if its fields don't match the schema. An empty field is NULL and
    fits any column that may be NULL. ``file`` is where the record is from. The counts of good and bad
    records are observed as ``records`` in the progress of the query.
    """
    raw = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields] + [T.StructField(_RECORD, T.StringType())])
    lines = csv_stream(spark, path, raw, columnNameOfCorruptRecord=_RECORD, mode="PERMISSIVE", **options)
    return check_fields(lines.withColumn("file", F.col("_metadata.file_path")), schema, _RECORD)


def check_fields(raw: DataFrame, schema: T.StructType, record: str) -> DataFrame:
    """Cast text columns to the schema and say what doesn't fit; ``record`` is the line of a malformed one."""
    malformed = F.col(record).isNotNull()
    wrong = [F.when(malformed, F.lit("malformed record"))]
    for f in schema.fields:
        text, value = F.col(f.name), F.col(f.name).try_cast(f.dataType)
        wrong.append(F.when(~malformed & text.isNotNull() & value.isNull(), F.lit(f"{f.name} is no {f.dataType.simpleString()}")))
        if not f.nullable:
            wrong.append(F.when(~malformed & text.isNull(), F.lit(f"{f.name} is missing")))
    reason = F.nullif(F.concat_ws("; ", *wrong), F.lit(""))
    fields = F.to_json(F.struct(*[F.col(f.name) for f in schema.fields]))
    found = raw.withColumn("reason", reason).select(
        *[F.when(F.col("reason").isNull(), F.col(f.name).try_cast(f.dataType)).alias(f.name) for f in schema.fields], "reason",
        F.when(F.col("reason").isNotNull(), F.coalesce(F.col(record), fields)).alias("record"), "file")
    bad = F.count(F.when(F.col("reason").isNotNull(), 1))
    return found.observe(OBSERVED, (F.count(F.lit(1)) - bad).alias("good"), bad.alias("bad"))
