"""Column expressions and small helpers the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelens.session import scratch_path

#: A word is a run of characters other than the blank, tab and the four other ASCII line and page breaks.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: A bit table of hashes has 2 ** TABLE_POWER words of 64 bits (2 MiB), however many hashes fill it.
TABLE_POWER = 18


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(text, UPPER, UPPER.lower())


def word_count(text: Column) -> Column:
    """Number of words, 0 for null."""
    pieces = F.size(F.split(text, GAP))
    outer = F.when(text.rlike(f"^{GAP}"), 1).otherwise(0) + F.when(text.rlike(rf"{GAP}\z"), 1).otherwise(0)
    return F.when(text.isNull() | ~text.rlike(WORD), F.lit(0)).otherwise(pieces - outer).cast("long")


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows as a Parquet table in the shared scratch folder: cuts lineage and outlives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def perhaps_among(df: DataFrame, mark: Column, hashes: DataFrame, word: str = "word", bits: str = "bits", perhaps: str = "perhaps") -> DataFrame:
    """`df` and whether its 64-bit hash `mark` can be in the only column of `hashes`: false is certain, true has to be looked up.

    Broadcasts a bit table of bounded size instead of the hashes. The last three are names that no column of `df` has.
    """
    place = lambda h: F.shiftrightunsigned(h, 64 - TABLE_POWER)
    bit = lambda h: F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(63).cast("int"))
    one = F.col(hashes.columns[0])
    table = hashes.select(place(one).alias(word), bit(one).alias(bits)).groupBy(word).agg(F.bit_or(bits).alias(bits))
    found = df.withColumn(word, place(mark)).withColumn(perhaps, bit(mark)).join(F.broadcast(table), word, "left")
    there = F.coalesce(F.col(perhaps).bitwiseAND(F.col(bits)) != 0, F.lit(False))
    return found.select(*[F.col(f"`{name.replace('`', '``')}`") for name in df.columns], there.alias(perhaps))
