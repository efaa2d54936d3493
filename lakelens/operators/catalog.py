"""The catalogue of saved files: one entry per path, ignoring case, the one appended last counting.

Entries carry the number of their append; within one append, the later time counts. They are appended to a Parquet log and resolved when read. An append never rewrites other entries, so
several jobs can save at once and a lost executor leaves no half-written catalogue.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelens.functions.text import fold, fold_literal

# Catalogue columns, format names and their aliases.
CATALOG_SCHEMA = (
    "path string, name string, format string, sizeBytes bigint, savedAt timestamp, description string"
)
SEQUENCE = "_sequence"
COLUMNS = ["path", "name", "format", "sizeBytes", "savedAt", "description"]
FORMAT_ALIASES = {"markdown": "md", "text": "txt"}


def _newest(entries: DataFrame, *precedence: Column) -> DataFrame:
    """One row per path ignoring case. Each task keeps one candidate per path before the shuffle."""
    entry = F.struct(*COLUMNS)
    rank = F.struct(*precedence, "savedAt", *[F.col(name) for name in COLUMNS if name != "savedAt"])
    best = entries.groupBy(fold(F.col("path")).alias("_key")).agg(F.max_by(entry, rank).alias("_entry"))
    return best.select("_entry.*")


def latest(entries: DataFrame) -> DataFrame:
    """The last entry of every path: of the last append, where entries carry its number, else the newest."""
    return _newest(entries, *[F.coalesce(SEQUENCE, F.lit(0)) for name in entries.columns if name == SEQUENCE])


def upsert(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Existing entries with `new` ones in place of those with the same path, whatever their time."""
    both = existing.select(*COLUMNS, F.lit(0).alias("_generation")).unionAll(
        new.select(*COLUMNS, F.lit(1).alias("_generation"))
    )
    return _newest(both, F.col("_generation"))


def append_entries(entries: DataFrame, index: str) -> None:
    number = F.lit(_last_append(entries.sparkSession, index) + 1).cast("bigint").alias(SEQUENCE)
    entries.select(*COLUMNS, number).write.mode("append").parquet(index)


def _log(spark: SparkSession, index: str) -> DataFrame | None:
    try:
        return spark.read.schema(f"{CATALOG_SCHEMA}, {SEQUENCE} bigint").parquet(index)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _last_append(spark: SparkSession, index: str) -> int:
    log = _log(spark, index)
    return 0 if log is None else log.agg(F.max(SEQUENCE)).first()[0] or 0


def load_catalog(spark: SparkSession, index: str) -> DataFrame:
    """Resolved entries; a catalogue that does not exist yet is empty."""
    log = _log(spark, index)
    return spark.createDataFrame([], CATALOG_SCHEMA) if log is None else latest(log)


def parsed_entries(raw: DataFrame) -> DataFrame:
    """All-text entries to typed ones: a bad size is 0, a bad time NULL, missing text ''."""
    return raw.select(
        *[F.coalesce(F.col(name), F.lit("")).alias(name) for name in ("path", "name", "format")],
        F.coalesce(F.trim("sizeBytes").try_cast("bigint"), F.lit(0)).alias("sizeBytes"),
        F.trim("savedAt").try_cast("timestamp").alias("savedAt"),
        "description",
    )


def read_catalog_csv(spark: SparkSession, path: str) -> DataFrame:
    """A catalogue kept as CSV with a header line."""
    schema = ", ".join(f"{name} string" for name in COLUMNS)
    raw = spark.read.schema(schema).csv(path, header=True, quote='"', escape='"', multiLine=True)
    return parsed_entries(raw)


def write_catalog_csv(entries: DataFrame, path: str) -> None:
    """The catalogue as CSV, times in ISO 8601."""
    stamped = entries.select(
        *[
            F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias(name) if name == "savedAt" else name
            for name in COLUMNS
        ]
    )
    stamped.write.csv(path, header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False,
                      ignoreTrailingWhiteSpace=False)


def normalize_format(name: str | None) -> str | None:
    cleaned = (name or "").strip().lstrip(".").lower()
    return FORMAT_ALIASES.get(cleaned, cleaned) or None


def search(entries: DataFrame, name: str | None = None, format: str | None = None) -> DataFrame:
    """Entries whose name contains `name` and whose format is `format`, both ignoring case and optional."""
    if name and name.strip():
        entries = entries.filter(F.contains(fold(F.col("name")), F.lit(fold_literal(name.strip()))))
    wanted = normalize_format(format)
    if wanted is not None:
        entries = entries.filter(fold(F.col("format")) == fold_literal(wanted))
    return entries
