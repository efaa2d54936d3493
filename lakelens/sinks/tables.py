"""Saves: path and format checks, no silent overwrite, and a catalogue entry for every save."""

from __future__ import annotations

from collections import Counter
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelens.functions.text import fold_literal
from lakelens.operators.catalog import CATALOG_SCHEMA, append_entries
from lakelens.operators.csv_check import check_csv_files
from lakelens.operators.json_rows import json_rows_to_table
from lakelens.operators.paths import check_extension, normalize_path
from lakelens.session import scratch_path
from lakelens.sources.files import file_inventory

# File extensions of the save formats.
EXTENSIONS = {"txt": [".txt"], "md": [".md"], "csv": [".csv"], "parquet": [".parquet"]}
INDEX_PATH = "saved-files-index.parquet"


def lake_path(root: str, path: str) -> str:
    return f"{root.rstrip('/')}/{path}"


def write_csv(df: DataFrame, target: str, delimiter: str = ",", header: bool = True, mode: str = "errorifexists") -> None:
    """Delimited files with quotes doubled and blanks kept."""
    if not delimiter:
        raise ValueError("The delimiter must not be empty.")
    df.write.mode(mode).csv(
        target,
        sep=delimiter,
        header=header,
        quote='"',
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def save_table(
    df: DataFrame,
    root: str,
    path: str,
    format: str,
    description: str | None = None,
    overwrite: bool = False,
    delimiter: str = ",",
    index_path: str = INDEX_PATH,
    verbatim: bool = False,
) -> DataFrame:
    """Writes a frame as `txt`, `md`, `csv` or `parquet` below `root` and returns its catalogue entry.

    `verbatim` stores the lines of a CSV text as they are.

    The target is a folder of part files, written in parallel. It must not exist unless `overwrite`.
    """
    check_extension(path, EXTENSIONS[format])
    normalized, index = normalize_path(path), normalize_path(index_path)
    if fold_literal(normalized) == fold_literal(index):
        raise ValueError("The path is the catalogue's own and cannot be overwritten.")
    target = lake_path(root, normalized)
    mode = "overwrite" if overwrite else "errorifexists"
    try:
        if format == "parquet":
            df.write.mode(mode).parquet(target)
        elif format == "csv" and not verbatim:
            write_csv(df, target, delimiter, mode=mode)
        else:
            df.write.mode(mode).text(target)
    except AnalysisException as error:
        if error.getCondition() == "PATH_ALREADY_EXISTS":
            raise FileExistsError(f"'{normalized}' exists already: pass overwrite=True to replace it.") from error
        raise
    spark = df.sparkSession
    size = file_inventory(spark, target).agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    saved_at = datetime.now(timezone.utc)
    entry = spark.createDataFrame(
        [(normalized, normalized.rsplit("/", 1)[-1], format, size, saved_at, description)], CATALOG_SCHEMA
    )
    append_entries(entry, lake_path(root, index))
    return entry


def _lines(spark: SparkSession, content: DataFrame | str) -> DataFrame:
    return spark.createDataFrame([(content,)], "value string") if isinstance(content, str) else content


def save_text(spark: SparkSession, content: DataFrame | str, root: str, path: str, **options) -> DataFrame:
    """Lines (one text column) or a given text as `.txt`."""
    return save_table(_lines(spark, content), root, path, "txt", **options)


def save_markdown(spark: SparkSession, content: DataFrame | str, root: str, path: str, **options) -> DataFrame:
    """Lines (one text column) or a given text as `.md`."""
    return save_table(_lines(spark, content), root, path, "md", **options)


def save_csv(spark: SparkSession, content: DataFrame | str, root: str, path: str, **options) -> DataFrame:
    """A frame as `.csv`. A given CSV text is checked for equal field counts and stored as it is."""
    if not isinstance(content, str):
        return save_table(content, root, path, "csv", **options)
    delimiter = options.pop("delimiter", ",")
    if not content.strip():
        raise ValueError("The CSV content must not be blank.")
    check_extension(path, EXTENSIONS["csv"])
    draft = scratch_path(spark, "draft")
    lines = _lines(spark, content)
    lines.write.text(draft)
    bad = check_csv_files(spark, draft, delimiter).first()
    if bad is not None:
        raise ValueError(f"Invalid CSV: record {bad.record} has {bad.n_fields} fields, expected {bad.expected}.")
    return save_table(lines, root, path, "csv", verbatim=True, **options)


def save_parquet(spark: SparkSession, content: DataFrame, root: str, path: str, json_column: str | None = None, **options) -> DataFrame:
    """A frame as `.parquet`; with `json_column`, its JSON object rows are typed first."""
    check_extension(path, EXTENSIONS["parquet"])
    table = json_rows_to_table(content, json_column) if json_column else content
    alike = sorted(name for name, times in Counter(name.lower() for name in table.columns).items() if times > 1)
    if alike:
        raise ValueError(f"Column names differ only by case: {', '.join(alike)}.")
    return save_table(table, root, path, "parquet", **options)
