"""Rectangularity of delimited data: every record has as many fields as the first one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakelens.sources.csv import field_count, scan_records
from lakelens.sources.position import BLOCK, FILE, ROW


def bad_records(records: DataFrame, column: str, expected: int, delimiter: str = ",") -> DataFrame:
    """Records (one per row, line breaks inside quotes allowed) whose field count is not `expected`.

    Blank records do not count. Adds `n_fields` and `expected`.
    """
    counted = records.filter(F.col(column) != "").withColumn("n_fields", field_count(F.col(column), delimiter))
    return counted.filter(F.col("n_fields") != expected).withColumn("expected", F.lit(expected))


def check_csv_files(spark: SparkSession, path: str | list[str], delimiter: str = ",") -> DataFrame:
    """One row per file that is not rectangular: its first bad record and how many there are.

    Records are reduced to one row per (file, block, field count) before anything is shuffled, so a file of
    any size costs its blocks. `record` counts from 1, header included.
    """
    if not delimiter:
        raise ValueError("The delimiter must not be empty.")
    counted = scan_records(spark, path, delimiter)
    groups = counted.groupBy(FILE, BLOCK, "n_fields").agg(
        F.count("*").alias("records"), F.min(ROW).alias("first_row")
    )
    in_block = Window.partitionBy(FILE, BLOCK)
    in_file = Window.partitionBy(FILE).orderBy(BLOCK, "first_row")
    earlier_blocks = Window.partitionBy(FILE).orderBy(BLOCK).rangeBetween(Window.unboundedPreceding, -1)
    placed = groups.select(
        "*",
        F.first("n_fields").over(in_file).alias("expected"),
        F.coalesce(F.sum("records").over(earlier_blocks), F.lit(0)).alias("before"),
        F.min("first_row").over(in_block).alias("block_start"),
    )
    bad = placed.filter(F.col("n_fields") != F.col("expected")).withColumn(
        "record", F.col("before") + F.col("first_row") - F.col("block_start") + 1
    )
    return bad.groupBy(F.col(FILE).alias("file")).agg(
        F.min("record").alias("record"),
        F.min_by("n_fields", "record").alias("n_fields"),
        F.min("expected").alias("expected"),
        F.sum("records").alias("bad_records"),
    )
