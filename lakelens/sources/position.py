"""Where a row sits in the lake: file, block inside the file, row inside the block.

The first two are read from the scan's hidden metadata. Parquet also knows the row's index in its file; for
line-based files the row order inside a block is taken by the pager, after filtering.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILE = "_pos_file"
BLOCK = "_pos_block"
ROW = "_pos_row"
# Row order inside a block where a scan has shuffled its lines; the block alone does not tell it then.
LINE = "_pos_line"
POSITION = [FILE, BLOCK, ROW]
PARQUET_BLOCK_BITS = 20


def with_split_position(scan: DataFrame) -> DataFrame:
    """Adds file and split start to a CSV, text or XML scan."""
    return scan.withColumns(
        {FILE: F.col("_metadata.file_path"), BLOCK: F.col("_metadata.file_block_start")}
    )


def with_row_position(scan: DataFrame) -> DataFrame:
    """Adds file, row block and row index to a Parquet scan."""
    index = F.col("_metadata.row_index")
    return scan.withColumns(
        {FILE: F.col("_metadata.file_path"), BLOCK: F.shiftright(index, PARQUET_BLOCK_BITS), ROW: index}
    )


def user_columns(df: DataFrame) -> list[str]:
    return [name for name in df.columns if name not in (*POSITION, LINE)]


def input_files(df: DataFrame) -> list[str]:
    """Sorted input files, spelled as the scan metadata spells them; known from the listing, unread."""
    return sorted(re.sub(r"^(\w+):///", r"\1:/", name) for name in df.inputFiles())


def whole_scan(df: DataFrame) -> bool:
    """Whether the rows are all those of a scan: nothing but projections stands above it."""
    plan = df._jdf.queryExecution().analyzed().toString()
    return all(re.match(r"[\s:+|-]*(Project|Relation|SubqueryAlias)\b", line) for line in plan.splitlines() if line.strip())
