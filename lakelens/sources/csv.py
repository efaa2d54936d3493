"""CSV scan: every cell is text, an empty field is '' and a field missing from a short row is NULL."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelens.functions.predicates import build_predicate
from lakelens.sources.csv_records import assembled_records, ends_inside_quotes
from lakelens.sources.position import BLOCK, FILE, LINE, ROW, input_files, with_split_position

RAW_RECORD = "_raw_record"


def _options(delimiter: str, header: bool, multiline: bool) -> dict:
    return {
        "sep": delimiter,
        "header": header,
        "quote": '"',
        "escape": '"',
        "multiLine": multiline,
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": RAW_RECORD,
    }


def field_count(record: Column, delimiter: str = ",") -> Column:
    """Number of fields of one complete record; delimiters inside quotes do not count."""
    sep = re.escape(delimiter)
    other = f"[^{sep}]+" if len(delimiter) == 1 else f"(?s:(?!{sep}).)++"
    # Quoted fields and all other text vanish, the delimiters between fields stay.
    delimiters = F.regexp_replace(F.replace(record, F.lit('""'), F.lit("")), rf'(^|{sep})"[^"]*"|{other}', "$1")
    plain = F.length(record) - F.length(F.replace(record, F.lit(delimiter), F.lit("")))
    length = F.when(F.contains(record, F.lit('"')), F.length(delimiters)).otherwise(plain)
    return (length / len(delimiter)).cast("int") + 1


def _same_header(cells: Column, header: list[str]) -> Column:
    """Whether the parsed record has these names, ignoring case and a byte order mark."""
    found = [F.lower(F.coalesce(cells[f"_{i}"], F.lit(""))) for i in range(len(header))]
    found[0] = F.regexp_replace(found[0], "^\ufeff", "")
    same = [name == F.lit(expected.lower()) for name, expected in zip(found, header)]
    return reduce(Column.__and__, same, cells[RAW_RECORD].isNull())


def _other_header() -> Column:
    return F.raise_error(F.concat(F.lit("CSV header differs from that of the first file: "), F.col(FILE))).cast("boolean")


def files_with_long_records(spark: SparkSession, path: str | list[str], delimiter: str = ",", header: list[str] | None = None) -> DataFrame:
    """Files, as FILE, in which a record spans lines or a line holds only blanks, which the line-wise reader drops.

    Any other file has to begin with the given header.
    """
    line = F.col("value")
    blank = (line != "") & (F.trim(line) == "")
    long = ends_inside_quotes(line, re.escape(delimiter)) | blank
    lines = with_split_position(spark.read.text(path)).withColumn(LINE, F.monotonically_increasing_id())
    at = F.when((F.col(BLOCK) == 0) & (line != ""), F.col(LINE))
    sums = [F.bool_or(long).alias("_long")]
    wanted = F.col("_long")
    if header:
        options = {name: str(value) for name, value in _options(delimiter, False, False).items()}
        same = _same_header(F.from_csv(line, _raw_schema(len(header)), options), header)
        # Only lines that hold the first name are parsed.
        likely = F.contains(F.lower(line), F.lit(header[0].lower())) if '"' not in header[0] else F.lit(True)
        sums += [F.min(at).alias("_first"), F.min(F.when(likely, F.when(same, at))).alias("_named")]
        good = F.col("_first").isNull() | F.col("_first").eqNullSafe(F.col("_named"))
        wanted = F.when(F.col("_long"), F.lit(True)).when(good, F.lit(False)).otherwise(_other_header())
    return lines.groupBy(FILE).agg(*sums).filter(wanted).select(FILE)


def _first_record(spark: SparkSession, path: str | list[str], delimiter: str, multiline: bool) -> list[str]:
    rows = with_split_position(spark.read.options(**_options(delimiter, False, multiline)).csv(path))
    heads, files = rows.filter(F.col(BLOCK) == 0), input_files(rows)
    row = None
    if files:
        heads_of_first = heads.filter(F.col(FILE) == files[0]).drop(FILE, BLOCK)
        row = heads_of_first.first() or heads.drop(FILE, BLOCK).first()
    cells = [] if row is None else ["" if cell is None else cell for cell in row]
    return [cells[0].removeprefix("\ufeff"), *cells[1:]] if cells else []


def _cells(raw: DataFrame, width: int) -> list[Column]:
    """Text cells of a raw scan.

    The parser yields NULL for an empty field and for a missing one. A record of the expected width has no
    missing field; for any other the raw record tells how many fields it has.
    """
    complete = F.col(RAW_RECORD).isNull()
    return [
        F.coalesce(F.col(f"_{i}"), F.when(complete | (F.col("_present") > i), F.lit(""))).alias(f"_{i}")
        for i in range(width)
    ]


def _raw_schema(width: int) -> str:
    return ", ".join(f"{name} string" for name in [*(f"_{i}" for i in range(width)), RAW_RECORD])


def _scan(
    spark: SparkSession, path: str | list[str], delimiter: str, header: list[str] | None, width: int, multiline: bool, checked: bool = True
) -> DataFrame:
    """Raw cells of the line-wise or the multi-line reader; `checked` files have to have the given header."""
    reader = spark.read.options(**_options(delimiter, header is not None, multiline))
    internal = [f"_{i}" for i in range(width)]
    # Spark compares headers by name, which a repeated or empty name does not allow.
    if header is None or not checked or "" in header or len({name.lower() for name in header}) < width:
        return with_split_position(reader.schema(_raw_schema(width)).csv(path))
    schema = T.StructType([T.StructField(name, T.StringType()) for name in [*header, RAW_RECORD]])
    raw = with_split_position(reader.schema(schema).option("enforceSchema", "false").csv(path))
    return raw.toDF(*internal, RAW_RECORD, FILE, BLOCK)


def _assembled_scan(
    spark: SparkSession,
    path: str | list[str],
    delimiter: str,
    header: list[str] | None,
    width: int,
    files: DataFrame,
) -> DataFrame:
    """The named files, with records of several lines, split like any other file."""
    lines = with_split_position(spark.read.option("lineSep", "\n").text(path)).join(files, FILE, "left_semi")
    records = assembled_records(lines, re.escape(delimiter))
    options = {name: str(value) for name, value in _options(delimiter, False, False).items()}
    cells = F.from_csv(F.col("record"), _raw_schema(width), options).alias("_cells")
    rows = records.select(cells, FILE, BLOCK, LINE, "is_first").select("_cells.*", FILE, BLOCK, LINE, "is_first")
    if header is not None:
        same = _same_header(F.struct(*[F.col(name) for name in (*(f"_{i}" for i in range(width)), RAW_RECORD)]), header)
        rows = rows.filter(F.when(~F.col("is_first"), F.lit(True)).when(same, F.lit(False)).otherwise(_other_header()))
    return rows.drop("is_first")


def _records(
    spark: SparkSession,
    path: str | list[str],
    delimiter: str,
    header: list[str] | None,
    width: int,
    multiline: bool | None,
    numbered: bool = False,
) -> DataFrame:
    """Raw cells with their position, each file read the way its records need."""
    args = (spark, path, delimiter, header, width)
    if multiline is not None:
        raw = _scan(*args, multiline)
    else:
        # Part of the plan, not a job of its own: where no file is long, the second branch ends before it reads.
        # At most one name per file of the listing, which the driver holds already, goes to every task.
        long = F.broadcast(files_with_long_records(spark, path, delimiter, header))
        raw = _assembled_scan(*args, long)
        if numbered:
            in_block = Window.partitionBy(FILE, BLOCK).orderBy(LINE)
            raw = raw.withColumn(LINE, F.row_number().over(in_block).cast("bigint"))
        plain = _scan(*args, False, checked=False).join(long, FILE, "left_anti")
        raw = plain.unionByName(raw, allowMissingColumns=True)
    return raw.withColumn("_present", field_count(F.col(RAW_RECORD), delimiter))


def scan_records(spark: SparkSession, path: str | list[str], delimiter: str) -> DataFrame:
    """One row per record: file, block, `n_fields` and a row number without gaps inside the block."""
    # With a schema of one column the parser hands over every wider record as raw text.
    raw = _records(spark, path, delimiter, None, 1, None, numbered=True)
    row = F.monotonically_increasing_id()
    row = F.coalesce(LINE, row) if LINE in raw.columns else row
    # A scan must use some column besides the raw record; every record has at least one field.
    at_least = F.when(F.col("_0").isNull(), F.lit(0)).otherwise(F.lit(1))
    fields = F.greatest(F.coalesce("_present", F.lit(1)), at_least)
    return raw.select(FILE, BLOCK, row.alias(ROW), fields.alias("n_fields"))


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    delimiter: str = ",",
    has_header: bool = True,
    filters: Iterable | None = None,
    multiline: bool | None = None,
    position: bool = False,
) -> DataFrame:
    """All-text rows of delimited files, which must agree in their header.

    Without a header the columns are `column_0 …`, as many as the first record has fields. When a header
    repeats a name, the column holds the last value and a filter looks at the first. `position` adds the
    pager's columns.

    `multiline=None` tells files with records that span lines from others while the plan runs; opening them starts no job but
    for the first record. Files without any are read line by line, the others
    have their records put together first; both are split over many tasks. False skips the check and takes
    every line as a record, True leaves it to Spark's multi-line reader, which gives a file to one task.
    """
    first = _first_record(spark, path, delimiter, multiline is not False)
    names = first if has_header else [f"column_{i}" for i in range(len(first))]
    if not names:
        return spark.createDataFrame([], T.StructType([]))
    raw = _records(spark, path, delimiter, names if has_header else None, len(names), multiline)
    where_at = [name for name in (FILE, BLOCK, LINE) if name in raw.columns]
    rows = raw.select(*_cells(raw, len(names)), *where_at)
    predicate = build_predicate(rows.schema, filters, names)
    if predicate is not None:
        rows = rows.filter(predicate)
    last = {name: index for index, name in enumerate(names)}
    kept = [F.col(f"_{last[name]}").alias(name) for name in dict.fromkeys(names)]
    return rows.select(*kept, *(where_at if position else []))
