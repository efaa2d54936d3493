"""Line scan. Markdown files are plain lines too, so both names read the same way."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelens.functions.predicates import text_contains
from lakelens.sources.position import with_split_position


def read_text(spark: SparkSession, path: str | list[str], contains: str | None = None, position: bool = False) -> DataFrame:
    """Lines as `value`; `\\n`, `\\r\\n` and `\\r` all end a line. `contains` keeps lines with that text.

    `position` adds the pager's columns.
    """
    lines = spark.read.text(path)
    lines = with_split_position(lines) if position else lines
    return lines if not contains else lines.filter(text_contains(F.col("value"), contains))


read_markdown = read_text
