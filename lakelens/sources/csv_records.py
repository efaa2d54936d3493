"""Records of delimited files whose quoted fields span lines, found without reading a file in one task.

A line either leaves the quote state as it is, flips it, or sets it. The state at any line follows from the
last line that set it and the flips since, so running sums inside each split, and then over one row per
split, tell where every record starts, and the lines of each record are then brought together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakelens.sources.position import BLOCK, FILE, LINE

SPLIT = [FILE, BLOCK]


def _without_quoted_fields(line: Column, sep: str) -> Column:
    """The line after dropping escaped quotes and the content of every complete quoted field."""
    return F.regexp_replace(F.replace(line, F.lit('""'), F.lit("")), rf'(^|{sep})"[^"]*"', "$1")


def ends_inside_quotes(line: Column, sep: str) -> Column:
    """True for a line that, begun outside quotes, leaves a quoted field open; `sep` is a regex."""
    has_quote = F.contains(line, F.lit('"'))
    return has_quote & _without_quoted_fields(line, sep).rlike(f'(^|{sep})"')


def _with_state(rows: DataFrame, group: list[str], order: str) -> DataFrame:
    """Adds the state after each row, as far as it is known: `_fixed` is 0 or 1 once some row has set it,
    until then `_parity` counts the flips modulo 2.

    Rows come with `_set` (0, 1 or NULL) and `_flip` (0 or 1).
    """
    upto = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    flips = rows.withColumn("_flips", F.sum("_flip").over(upto))
    last = flips.select(
        "*",
        F.last("_set", ignorenulls=True).over(upto).alias("_last_set"),
        F.last(F.when(F.col("_set").isNotNull(), F.col("_flips")), ignorenulls=True).over(upto).alias("_then"),
    )
    return last.select(
        *rows.columns,
        ((F.col("_last_set") + F.col("_flips") - F.col("_then")) % 2).alias("_fixed"),
        (F.col("_flips") % 2).alias("_parity"),
    )


def _marked(lines: DataFrame, sep: str) -> DataFrame:
    """Lines numbered in scan order, with what each does to the quote state."""
    value = F.col("value")
    quoted = F.contains(value, F.lit('"'))
    from_outside = F.when(quoted, ends_inside_quotes(value, sep)).otherwise(F.lit(False))
    from_inside = F.when(quoted, ends_inside_quotes(F.concat(F.lit('"'), value), sep)).otherwise(F.lit(True))
    numbered = lines.select(*SPLIT, F.monotonically_increasing_id().alias(LINE), "value")
    both = numbered.select("*", from_outside.alias("_o"), from_inside.alias("_i"))
    return both.select(
        *SPLIT,
        LINE,
        "value",
        F.when(F.col("_o") == F.col("_i"), F.col("_o").cast("int")).alias("_set"),
        (F.col("_o") & ~F.col("_i")).cast("int").alias("_flip"),
    )


def _split_starts(marked: DataFrame) -> DataFrame:
    """For every split its state at the start and, when that is inside a record, the split it began in.

    Only line numbers and flags are shuffled; the running sums over a file see one row per split.
    """
    known = _with_state(marked.drop("value"), SPLIT, LINE)
    if_inside = F.coalesce(F.col("_fixed"), (F.col("_parity") + 1) % 2)
    splits = known.groupBy(*SPLIT).agg(
        F.max_by("_fixed", LINE).alias("_set"),
        F.max_by("_parity", LINE).alias("_odd"),
        (F.min(if_inside) == 0).alias("_leaves"),
    )
    splits = splits.withColumn("_flip", F.when(F.col("_set").isNull(), F.col("_odd")).otherwise(F.lit(0))).drop("_odd")
    in_order = Window.partitionBy(FILE).orderBy(BLOCK)
    state = F.coalesce("_fixed", "_parity")
    started = _with_state(splits, [FILE], BLOCK).withColumn("_start", F.coalesce(F.lag(state).over(in_order), F.lit(0)))
    begun = F.when((F.col("_start") == 0) | F.col("_leaves"), F.col(BLOCK))
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    return started.select(*SPLIT, "_start", F.last(begun, ignorenulls=True).over(earlier).alias("_open_block"))


def assembled_records(lines: DataFrame, sep: str) -> DataFrame:
    """One row per record: file, block and line of its start, `record` and whether it `is_first` in its file.

    `lines` are split-positioned lines cut at `\\n`, as `value`; blank lines are no records.
    """
    marked = _marked(lines, sep)
    in_split = Window.partitionBy(*SPLIT).orderBy(LINE)
    upto = in_split.rowsBetween(Window.unboundedPreceding, 0)
    known = _with_state(marked.join(_split_starts(marked), SPLIT), SPLIT, LINE)
    after = F.coalesce(F.col("_fixed"), (F.col("_start") + F.col("_parity")) % 2)
    begins = F.coalesce(F.lag(after).over(in_split), F.col("_start")) == 0
    filled = F.trim(F.col("value"), F.lit("\r")) != ""
    placed = known.select(
        *SPLIT,
        LINE,
        "value",
        "_open_block",
        begins.alias("_begins"),
        (filled & (F.sum(filled.cast("int")).over(upto) == 1) & (F.col(BLOCK) == 0)).alias("is_first"),
    )
    begin_line = F.when(F.col("_begins"), F.col(LINE))
    placed = placed.select(
        "*",
        F.last(begin_line, ignorenulls=True).over(upto).alias("_record"),
        F.max(begin_line).over(Window.partitionBy(*SPLIT)).alias("_last_record"),
    )
    headless = F.col("_record").isNull()
    pieces = placed.select(
        *SPLIT,
        "_record",
        F.when(headless, F.col("_open_block")).otherwise(F.col(BLOCK)).alias("_begun"),
        (headless | (F.col("_record") == F.col("_last_record"))).alias("_crossing"),
        F.struct(F.col(BLOCK).alias("block"), F.col(LINE).alias("line"), "value").alias("_piece"),
        (F.col("is_first") & F.col("_begins")).alias("is_first"),
    )
    # The last record of a split may go on in later splits, whose lines before their first record belong to
    # it; such a record is known by its block alone. All others are put together where their split is.
    # Both branches read the same shuffled lines, so the shuffle is made once.
    both = [F.array_sort(F.collect_list("_piece")).alias("_pieces"), F.max("is_first").alias("is_first")]
    own = ~F.col("_crossing") & (F.col("_begun") == F.col(BLOCK))
    inside = pieces.filter(own).groupBy(*SPLIT, "_record").agg(*both).drop("_record")
    across = pieces.filter("_crossing").groupBy(FILE, F.col("_begun").alias(BLOCK)).agg(*both)
    records = inside.unionByName(across).select(
        *SPLIT,
        F.col("_pieces")[0]["line"].alias(LINE),
        F.regexp_replace(F.array_join(F.transform("_pieces", lambda p: p["value"]), "\n"), r"\r$", "").alias("record"),
        "is_first",
    )
    return records.filter(F.col("record") != "")
