"""Records of XML files, found without reading a file in one task.

The text is cut before every `<`. A tag raises or lowers the depth by one, so running sums inside each split,
and then over one row per split, give every tag its depth; the root's children begin at depth one. This holds
where no comment, CDATA section or processing instruction contains a `<`; files with such are left out.

Most files are plainer: the root holds nothing but records of one spelling, none within another. There every end
tag of that name ends a record, so a text scan cut at it yields whole records, and nothing is shuffled. One pass over the
files tells which are so; it sums a few flags per file.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakelens.session import scratch_path
from lakelens.sources.position import BLOCK, FILE, LINE, with_split_position

SPLIT = [FILE, BLOCK]
# The inside of a tag up to its `>`, skipping quoted attribute values, where the last character is a slash.
_EMPTY_ELEMENT = r"""^(?:[^>"']++|"[^"]*+"|'[^']*+')*+(?<=/)>"""


#: Longer records are cut by depth.
MOST_BYTES = 64 << 20
# Attributes of a tag; the head of a file up to and with its root's tag; parts that hold no `<`.
_ATTRIBUTES = r"""(?:[^<>"']|"[^"<]*"|'[^'<]*')*"""
_HEAD = rf"\ufeff?\s*<[\p{{L}}_:][^\s<>/]*(?=[\s>]){_ATTRIBUTES}(?<!/)>"
_PLAIN_PART = r"(?s)<!--[^<]*?-->|<!\[CDATA\[[^<]*?\]\]>|<\?[^<]*?\?>"


def _ended(spark: SparkSession, path: str | list[str], tag: str) -> DataFrame:
    """The text up to every end tag of that name, and what is left after the last; without any that is too long."""
    reader = spark.read.option("mapreduce.input.linerecordreader.line.maxlength", str(MOST_BYTES))
    return with_split_position(reader.option("lineSep", f"</{tag}>").text(path))


def uneven_files(spark: SparkSession, path: str | list[str], tag: str) -> DataFrame:
    """Names of the files, as FILE, that hold more than a root with records of that spelling, one after the other."""
    value, name = F.col("value"), re.escape(tag)
    bare = F.when(F.contains(value, F.lit("<!")) | F.contains(value, F.lit("<?")), F.regexp_replace(value, _PLAIN_PART, "")).otherwise(value)
    opening = rf"\s*<{name}(?=[\s>]){_ATTRIBUTES}(?<!/)>"
    ended = _ended(spark, path, tag)
    size, length = F.col("_metadata.file_size").alias("_size"), F.octet_length("value") + len(f"</{tag}>".encode())
    lines = ended.select(FILE, bare.alias("value"), size, length.alias("_length"))
    first = value.rlike(rf"^{_HEAD}{opening}")
    record = (first | value.rlike(rf"^{opening}")) & (F.size(F.split(value, rf"<{name}(?=[\s/>])")) == 2)
    whole = ~F.contains(value, F.lit("<!")) & ~F.contains(value, F.lit("<?"))
    flags = lines.select(FILE, "_size", "_length", first.alias("_first"), (record & whole).alias("_record"), value.rlike(r"^\s*</[^<>]+>\s*$").alias("_end"))
    sums = flags.groupBy(FILE).agg(
        F.bool_and(F.col("_record") | F.col("_end")).alias("_even"), F.count_if("_first").alias("_firsts"), F.count_if("_end").alias("_ends"),
        # Only the last piece lacks the end tag; a piece that was too long is missing.
        (F.sum("_length") - len(f"</{tag}>".encode()) == F.max("_size")).alias("_all"),
    )
    path_of = scratch_path(spark, "uneven")
    sums.filter("NOT _even OR _firsts <> 1 OR _ends <> 1 OR NOT _all").select(FILE).write.parquet(path_of)
    return spark.read.schema(f"{FILE} string").parquet(path_of)


def even_records(spark: SparkSession, path: str | list[str], tag: str, uneven: DataFrame | None) -> DataFrame:
    """The records of all files but the uneven ones, as `split_records` gives them."""
    lines = _ended(spark, path, tag).withColumn(LINE, F.monotonically_increasing_id())
    lines = lines if uneven is None else lines.join(uneven, FILE, "left_anti")
    start = F.regexp_instr("value", F.lit(rf"<{re.escape(tag)}(?=[\s>])"))
    # NULL where there is none, as a caller's filter on cells may be tried before this one.
    record = F.when(start > 0, F.concat(F.substring(F.col("value"), start, F.length("value")), F.lit(f"</{tag}>")))
    return lines.filter(start > 0).select(FILE, BLOCK, LINE, record.alias("record"), F.lit(tag).alias("tag"))


def _pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return with_split_position(spark.read.option("lineSep", "<").text(path))


def files_to_keep_whole(spark: SparkSession, path: str | list[str], among: DataFrame) -> DataFrame:
    """Names of the files among some that cannot be cut, as FILE: a `<` in them need not begin a tag.

    That is so where a comment, a section or an instruction holds one, or where there is a DOCTYPE. Files whose tags
    do not balance are named too, so that the parser refuses them.
    """
    value = F.col("value")
    open_ended = (
        (F.startswith(value, F.lit("!--")) & ~F.contains(value, F.lit("-->")))
        | (F.startswith(value, F.lit("![CDATA[")) & ~F.contains(value, F.lit("]]>")))
        | (F.startswith(value, F.lit("?")) & ~F.contains(value, F.lit("?>")))
        | F.startswith(value, F.lit("!DOCTYPE"))
    )
    path_of = scratch_path(spark, "whole")
    ends = _pieces(spark, path).join(among, FILE, "left_semi").groupBy(FILE).agg(F.bool_or(open_ended).alias("_open"), F.sum(_step(value)).alias("_depth"))
    ends.filter("_open OR _depth <> 0").select(FILE).write.parquet(path_of)
    return spark.read.schema(f"{FILE} string").parquet(path_of)


def _opens(value: Column) -> Column:
    return value.rlike(r"^[\p{L}_:]")


def _step(value: Column) -> Column:
    """The change of depth a piece makes."""
    raises = _opens(value) & ~value.rlike(_EMPTY_ELEMENT)
    return F.when(F.startswith(value, F.lit("/")), F.lit(-1)).otherwise(raises.cast("int"))


def _marked(pieces: DataFrame) -> DataFrame:
    """Numbered pieces, whether each opens an element, and the change of depth it makes."""
    value = F.col("value")
    return pieces.select(
        *SPLIT,
        F.monotonically_increasing_id().alias(LINE),
        "value",
        _opens(value).alias("_opens"),
        _step(value).alias("_step"),
    )


def _depth_before() -> Column:
    """Depth before a piece, counted from the start of its split."""
    before = Window.partitionBy(*SPLIT).orderBy(LINE).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("_step").over(before), F.lit(0))


def _split_starts(marked: DataFrame) -> DataFrame:
    """For every split its depth at the start and the split in which the record open there began."""
    local = marked.select(*SPLIT, "_opens", "_step", _depth_before().alias("_depth"))
    local = local.groupBy(*SPLIT, "_depth").agg(F.sum("_step").alias("_step"), F.max("_opens").alias("_opens"))
    splits = local.groupBy(*SPLIT).agg(
        F.sum("_step").alias("_step"), F.collect_set(F.when(F.col("_opens"), F.col("_depth"))).alias("_openings")
    )
    earlier = Window.partitionBy(FILE).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    started = splits.withColumn("_start", F.coalesce(F.sum("_step").over(earlier), F.lit(0)))
    begun = F.when(F.array_contains("_openings", 1 - F.col("_start")), F.col(BLOCK))
    return started.select(*SPLIT, "_start", F.last(begun, ignorenulls=True).over(earlier).alias("_open_block"))


def split_records(spark: SparkSession, path: str | list[str], among: DataFrame, whole: DataFrame) -> DataFrame:
    """One row per child of the root: file, block and line of its start, its XML as `record`, its local `tag`.

    Files are those of `among` that are not in `whole`.
    """
    marked = _marked(_pieces(spark, path).join(among, FILE, "left_semi").join(whole, FILE, "left_anti"))
    known = marked.join(_split_starts(marked), SPLIT)
    known = known.withColumn("_depth", F.col("_start") + _depth_before())
    begin_line = F.when(F.col("_opens") & (F.col("_depth") == 1), F.col(LINE))
    upto = Window.partitionBy(*SPLIT).orderBy(LINE).rowsBetween(Window.unboundedPreceding, 0)
    placed = known.select(
        *SPLIT,
        LINE,
        "value",
        "_open_block",
        ((F.col("_depth") > 1) | begin_line.isNotNull()).alias("_inside"),
        F.last(begin_line, ignorenulls=True).over(upto).alias("_record"),
        F.max(begin_line).over(Window.partitionBy(*SPLIT)).alias("_last_record"),
    )
    # The last record of a split may go on in later splits; it is known by its block alone.
    headless = F.col("_record").isNull()
    pieces = placed.filter("_inside").select(
        FILE,
        F.when(headless, F.col("_open_block")).otherwise(F.col(BLOCK)).alias("_block"),
        F.when(headless | (F.col("_record") == F.col("_last_record")), F.lit(-1)).otherwise(F.col("_record")).alias("_id"),
        F.struct(F.col(BLOCK).alias("block"), F.col(LINE).alias("line"), "value").alias("_piece"),
    )
    joined = pieces.groupBy(FILE, "_block", "_id").agg(F.array_sort(F.collect_list("_piece")).alias("_pieces"))
    text = F.concat(F.lit("<"), F.array_join(F.transform("_pieces", lambda p: p["value"]), "<"))
    # What follows the closing tag is space between records.
    return joined.select(
        FILE,
        F.col("_block").alias(BLOCK),
        F.col("_pieces")[0]["line"].alias(LINE),
        text.alias("record"),
        F.regexp_extract(F.col("_pieces")[0]["value"], r"^(?:[^\s/>:]+:)?([^\s/>]+)", 1).alias("tag"),
    )
