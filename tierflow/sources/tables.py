"""Batch sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tierflow.session import shuffles_freed


def read_table(spark: SparkSession, fmt: str, options: Mapping[str, Any] | None = None,
               path: str | None = None) -> DataFrame:
    """Read through any installed reader format; ``fmt="table"`` reads the catalog table ``path``."""
    if fmt == "table":
        return spark.read.options(**(options or {})).table(path)
    return spark.read.format(fmt).options(**(options or {})).load(path)


@dataclass(frozen=True)
class JdbcSplit:
    """Split a JDBC scan into ``partitions`` ranges of a numeric, date or timestamp column."""

    column: str
    lower: Any
    upper: Any
    partitions: int


def jdbc_options(url: str, table: str | None = None, query: str | None = None,
                 split: JdbcSplit | None = None, options: Mapping[str, Any] | None = None) -> dict[str, str]:
    """Reader options for one table or one query; a split query is wrapped, as Spark asks for."""
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    given = {"url": url, **(options or {})}
    if split:
        given |= {"dbtable": table or f"({query}) split_query", "partitionColumn": split.column,
                  "lowerBound": split.lower, "upperBound": split.upper, "numPartitions": split.partitions}
    else:
        given |= {"dbtable": table} if table else {"query": query}
    return {name: str(value) for name, value in given.items()}


def read_jdbc(spark: SparkSession, url: str, table: str | None = None, query: str | None = None,
              split: JdbcSplit | None = None, predicates: Sequence[str] | None = None,
              options: Mapping[str, Any] | None = None) -> DataFrame:
    """Read a table or a query result over JDBC.

    Filters on the result are pushed to the database. Without ``split`` or ``predicates`` the
    scan is one task. ``predicates`` gives one task per condition and suits a column whose
    values are too uneven for ranges; the conditions must cover each row exactly once.
    """
    if predicates:
        if split or query:
            raise ValueError("predicates go with a table and without a split")
        properties = {name: str(value) for name, value in (options or {}).items()}
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=properties)
    return spark.read.format("jdbc").options(**jdbc_options(url, table, query, split, options)).load()


# Tables of a job lie on disk beside its shuffles, so they are compressed more than Spark's default does.
COMPRESSION = "zstd"


def stage(df: DataFrame, path: str, compression: str | None = COMPRESSION) -> DataFrame:
    """Write a frame once and read it back: its lineage ends and its size is known to the planner.

    The shuffles that led to it are deleted. ``compression=None`` leaves that to the session.
    """
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    with shuffles_freed(df.sparkSession):
        (writer.option("compression", compression) if compression else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
