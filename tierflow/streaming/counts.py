"""Token counts, for static and streaming lines alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.functions.scalars import tokens


def line_token_count(lines: DataFrame, col: str = "value") -> DataFrame:
    """Rows per token list: lines with the same tokens count together."""
    return lines.select(tokens(F.col(col)).alias("word")).groupBy("word").count()


def word_count(lines: DataFrame, col: str = "value") -> DataFrame:
    """Occurrences per token."""
    return lines.select(F.explode(tokens(F.col(col))).alias("word")).groupBy("word").count()
