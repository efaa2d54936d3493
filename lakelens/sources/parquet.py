"""Parquet scan and schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lakelens.sources.position import with_row_position

SCHEMA_OF_SCHEMA = "name string, type string, nullable boolean"


def read_parquet(spark: SparkSession, path: str | list[str], position: bool = False) -> DataFrame:
    """Typed rows of a file, a folder, a glob or a list of them. `position` adds the pager's columns.

    Files of differing schemas have the columns of all; a column of two types is an error.
    """
    rows = spark.read.option("mergeSchema", "true").parquet(*([path] if isinstance(path, str) else path))
    return with_row_position(rows) if position else rows


def schema_of(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """One row per top-level column: name, Spark type, nullability."""
    rows = [(field.name, field.dataType.simpleString(), field.nullable) for field in schema.fields]
    return spark.createDataFrame(rows, SCHEMA_OF_SCHEMA)


def parquet_schema(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Column names and types from the file footers; no rows are read."""
    return schema_of(spark, read_parquet(spark, path).schema)
