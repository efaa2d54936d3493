"""Column profiles and keyword lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelens.functions.predicates import text_contains
from lakelens.functions.text import cell_text


def profile_nulls(df: DataFrame, columns: list[str] | None = None, approx_distinct: bool = True) -> DataFrame:
    """One row per column: rows, NULL or empty cells and their share, smallest and largest value as text.

    All columns are profiled in one pass; distinct counts are estimates, so no value set is shuffled.
    """
    fields = [field for field in df.schema.fields if columns is None or field.name in columns]
    measures, profiles = [F.count("*").alias("rows")], []
    for i, field in enumerate(fields):
        cell = F.col("`" + field.name.replace("`", "``") + "`")
        empty = cell.isNull()
        if isinstance(field.dataType, T.StringType):
            empty = empty | (cell == "")
        measures.append(F.count_if(empty).alias(f"empty_{i}"))
        ordered = isinstance(field.dataType, T.AtomicType) and not isinstance(field.dataType, T.VariantType)
        if ordered:
            measures += [F.min(cell).alias(f"min_{i}"), F.max(cell).alias(f"max_{i}")]
        if approx_distinct and ordered:
            measures.append(F.approx_count_distinct(cell).alias(f"distinct_{i}"))

        def text(prefix: str):
            return cell_text(F.col(f"{prefix}_{i}"), field.dataType) if ordered else F.lit(None).cast("string")

        profile = [
            F.lit(field.name).alias("column"),
            F.col("rows"),
            F.col(f"empty_{i}").alias("null_or_empty"),
            F.round(F.try_divide(F.col(f"empty_{i}"), F.col("rows")), 6).alias("null_ratio"),
            text("min").alias("min"),
            text("max").alias("max"),
        ]
        if approx_distinct:
            known = F.col(f"distinct_{i}") if ordered else F.lit(None).cast("bigint")
            profile.append(known.alias("approx_distinct"))
        profiles.append(F.struct(*profile))
    return df.agg(*measures).select(F.inline(F.array(*profiles)))


def sample_rows(df: DataFrame, count: int = 20, by: list[str] | None = None) -> DataFrame:
    """The rows with the smallest hashes: a sample that depends on their content alone, not on order or partitions.

    `by` names the columns that are hashed as text, all by default; equal rows come into the sample together.
    """
    types = {field.name: field.dataType for field in df.schema.fields}
    names = df.columns if by is None else by
    cells = [F.coalesce(cell_text(F.col("`" + name.replace("`", "``") + "`"), types[name]), F.lit("")) for name in names]
    return df.orderBy(F.md5(F.concat_ws("\x01", *cells)), *cells).limit(count)


#: Standard error of a distinct estimate with 2^12 registers.
SKETCH_BITS = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)


def distinct_sketches(df: DataFrame, columns: list[str], keys: list[str] | None = None) -> DataFrame:
    """(*keys, column, sketch): one mergeable HyperLogLog sketch of a few KB per key and column, whatever the number of values."""
    types = {field.name: field.dataType for field in df.schema.fields}
    cells = [F.struct(F.lit(name).alias("column"), cell_text(F.col(f"`{name}`"), types[name]).alias("cell")) for name in columns]
    each = df.select(*(keys or []), F.inline(F.array(*cells)))
    return each.groupBy(*(keys or []), "column").agg(F.hll_sketch_agg("cell", F.lit(SKETCH_BITS)).alias("sketch"))


def merged_distinct(sketches: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """(*keys, column, distinct): estimates of the union of sketches, so parts of a table are read once only."""
    return sketches.groupBy(*(keys or []), "column").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct"))


def keyword_compare(
    df: DataFrame, text: str, keyword: str, key: str, period: str, value: str, periods: list | None = None
) -> DataFrame:
    """Totals of the rows whose text contains a keyword, one row per key and one column per period."""
    hits = df.filter(text_contains(F.col(text), keyword))
    return hits.groupBy(key).pivot(period, periods).agg(F.sum(value))
