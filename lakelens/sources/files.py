"""File inventory of a lake folder and the metadata of one file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_inventory(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """Path, size and modification time of every file; file contents are not read."""
    reader = spark.read.format("binaryFile")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.load(path).select("path", "length", "modificationTime")


def list_directory(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """Entries below a folder: name relative to it, whether a directory, length, last modified.

    Directories are derived from the paths of the files inside them, so an empty one does not appear.
    """
    root = path.replace("\\", "/").rstrip("/").split(":", 1)[-1].lstrip("/")
    files = file_inventory(spark, path)
    inside = F.element_at(F.split(F.col("path"), "/" + _quoted(root) + "/", 2), -1)
    files = files.withColumn("name", inside)
    parts = F.split(F.col("name"), "/")
    depth = F.size(parts)
    parents = F.when(depth > 1, F.transform(F.sequence(F.lit(1), depth - 1), lambda n: F.array_join(F.slice(parts, 1, n), "/")))
    directories = (
        files.select(F.explode(parents).alias("name"))
        .distinct()
        .select(
            "name",
            F.lit(True).alias("is_directory"),
            F.lit(None).cast("bigint").alias("length"),
            F.lit(None).cast("timestamp").alias("last_modified"),
        )
    )
    leaves = files.select(
        "name", F.lit(False).alias("is_directory"), "length", F.col("modificationTime").alias("last_modified")
    )
    entries = leaves.unionByName(directories)
    return entries if recursive else entries.filter(~F.contains("name", F.lit("/")))


def file_info(spark: SparkSession, path: str) -> DataFrame:
    """Size and modification time of one file, or of every part file of a saved table."""
    return file_inventory(spark, path)


def _quoted(text: str) -> str:
    return r"\Q" + text + r"\E"
