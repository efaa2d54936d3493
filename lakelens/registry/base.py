"""Registers a query together with the SQL it has to agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query; without SQL only its rows are checked."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return register


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that both engines report the same type."""
    return df.select(
        *[
            F.col(field.name).cast("double").alias(field.name)
            if isinstance(field.dataType, T.DecimalType)
            else F.col(field.name)
            for field in df.schema.fields
        ]
    )
