"""Pages in file order over filtered rows, with a truthful `truncated` flag.

A page is found in three steps that stay small at any table size: (1) count matching rows over growing
batches of files until the page is covered, (2) sum the matches per block of those files and keep the blocks
the page touches, (3) order only the rows of these blocks. Counting reads nothing but the filter columns and
opens no later files. An unfiltered Parquet page needs less: a file's rows are numbered, so the page is a range of row
numbers, and only which file it lies in is counted, from the footers; with one file nothing is.

A `Walk` goes through all pages of a table. It counts the matches per file once and keeps them as a table; the
matches per block of the files a page lies in are counted when the walk comes to them and serve all pages there. So a page
in the middle of a table costs what the first one does.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from lakelens.functions.predicates import checked_conditions, where
from lakelens.operators.project import project_existing
from lakelens.session import scratch_path
from lakelens.sources.position import BLOCK, FILE, LINE, POSITION, ROW, input_files, user_columns, whole_scan

# Page size limits.
DEFAULT_ROWS = 200
MAX_ROWS = 10_000

FIRST_FILES = 8
FILE_GROWTH = 4
MAX_FILES = 16_384


@dataclass(frozen=True)
class Page:
    """One page: at most `MAX_ROWS` rows on the driver."""

    columns: list[str]
    rows: list[Row] = field(repr=False)
    truncated: bool
    offset: int
    next_offset: int | None
    total_rows: int | None = None


def clamp_rows(max_rows: int | None) -> int:
    return min(max(DEFAULT_ROWS if max_rows is None else max_rows, 1), MAX_ROWS)


def _covering_files(df: DataFrame, files: list[str], offset: int, end: int) -> tuple[str, str, int] | None:
    """First and last file the rows [offset, end) can lie in, and the matches before that first file."""
    if len(files) <= FIRST_FILES:
        return (files[0], files[-1], 0) if files else None
    seen, start, size = 0, 0, FIRST_FILES
    first, before = None, 0
    while start < len(files):
        batch = files[start : start + size]
        matches = df.filter(F.col(FILE).between(batch[0], batch[-1])).count()
        if first is None and seen + matches > offset:
            first, before = batch[0], seen
        seen += matches
        if seen >= end:
            break
        start, size = start + size, min(size * FILE_GROWTH, MAX_FILES)
    return None if first is None else (first, batch[-1], before)


def _bounds(df: DataFrame, keys: list[str], offset: int, end: int) -> Row:
    """First and last key that hold rows [offset, end), and the matches before the first one.

    The running sum sees one row per file or file block, no more than the scan has tasks.
    """
    return _located(df.groupBy(*keys).agg(F.count("*").alias("matches")), keys, offset, end)


def _located(counts: DataFrame, keys: list[str], offset: int, end: int) -> Row:
    """`_bounds` of matches that are counted already."""
    running = F.sum("matches").over(Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, 0))
    touched = (
        counts.withColumn("upto", running)
        .withColumn("before", F.col("upto") - F.col("matches"))
        .filter((F.col("upto") > offset) & (F.col("before") < end))
    )
    key = F.struct(*keys)
    return touched.agg(F.min(key).alias("first"), F.max(key).alias("last"), F.min("before").alias("before")).first()


def _within_files(df: DataFrame, first: str, last: str) -> DataFrame:
    """Rows of a range of files; the others are dropped from the listing."""
    return df.filter(F.col(FILE).between(first, last))


def _nothing(df: DataFrame) -> DataFrame:
    empty = df.limit(0)
    return empty if ROW in df.columns else empty.withColumn(ROW, F.lit(None).cast("bigint"))


def _numbered(df: DataFrame, files: list[str], offset: int, end: int) -> DataFrame:
    """Rows [offset, end) of an unfiltered Parquet scan, by row number."""
    covering = _covering_files(df, files, offset, end)
    if covering is None:
        return _nothing(df)
    first, last, skipped = covering
    if first != last:
        bounds = _bounds(_within_files(df, first, last), [FILE], offset - skipped, end - skipped)
        if bounds["first"] is None:
            return _nothing(df)
        first, last, skipped = bounds["first"][FILE], bounds["last"][FILE], skipped + bounds["before"]
    start, count = offset - skipped, end - offset
    # No file gives more rows than the page has.
    here = (F.col(FILE) == first) & F.col(ROW).between(start, start + count - 1)
    rows = _within_files(df, first, last).filter(here | ((F.col(FILE) > first) & (F.col(ROW) < count)))
    return rows.orderBy(*POSITION).limit(count)


def _slice(df: DataFrame, files: list[str], offset: int, end: int) -> DataFrame:
    """Rows [offset, end) of `df` in file order, position columns included."""
    covering = _covering_files(df, files, offset, end)
    if covering is None:
        return _nothing(df)
    first_file, last_file, skipped = covering
    located = _within_files(df, first_file, last_file)
    by_row_index = ROW in df.columns
    if not by_row_index and first_file != last_file:
        # Where a split starts depends on which files are read, so the files are settled before the splits.
        bounds = _bounds(located, [FILE], offset - skipped, end - skipped)
        if bounds["first"] is None:
            return _nothing(df)
        located = _within_files(df, bounds["first"][FILE], bounds["last"][FILE])
        skipped += bounds["before"]
    bounds = _bounds(located, [FILE, BLOCK], offset - skipped, end - skipped)
    return _of_blocks(located, bounds, offset - skipped, end - skipped)


def _of_blocks(located: DataFrame, bounds: Row, offset: int, end: int) -> DataFrame:
    """Rows [offset, end) of `located`, which lie in the blocks that `bounds` names."""
    first, last = bounds["first"], bounds["last"]
    if first is None:
        return _nothing(located)
    after_first = (F.col(FILE) > first[FILE]) | ((F.col(FILE) == first[FILE]) & (F.col(BLOCK) >= first[BLOCK]))
    before_last = (F.col(FILE) < last[FILE]) | ((F.col(FILE) == last[FILE]) & (F.col(BLOCK) <= last[BLOCK]))
    if ROW in located.columns:
        rows = _within_files(located, first[FILE], last[FILE]).filter(after_first & before_last)
    else:
        in_scan_order = F.monotonically_increasing_id()
        line = F.coalesce(LINE, in_scan_order) if LINE in located.columns else in_scan_order
        rows = located.filter(after_first & before_last).withColumn(ROW, line)
    return rows.orderBy(*POSITION).offset(offset - bounds["before"]).limit(end - offset)


class Walk:
    """Pages of one table, one after the other or at any offset, without counting anything twice."""

    def __init__(self, df: DataFrame, filters: Iterable | None = None):
        self.rows = where(df, filters)
        self.columns = user_columns(df)
        path = scratch_path(df.sparkSession, "directory")
        counts = self.rows.groupBy(FILE).agg(F.count("*").alias("matches"))
        # The running sum sees one row per file.
        upto = F.sum("matches").over(Window.orderBy(FILE).rowsBetween(Window.unboundedPreceding, 0))
        counts.withColumn("upto", upto).write.parquet(path)
        self.files = df.sparkSession.read.schema(f"{FILE} string, matches long, upto long").parquet(path)
        self.blocks: tuple[tuple[str, str], DataFrame] | None = None

    def total(self) -> int:
        """All matches."""
        return self.files.agg(F.max("upto")).first()[0] or 0

    def _blocks(self, located: DataFrame, first: str, last: str) -> DataFrame:
        """Matches per block of a range of files, kept for the pages that follow there."""
        if self.blocks is None or self.blocks[0] != (first, last):
            path = scratch_path(located.sparkSession, "directory")
            located.groupBy(FILE, BLOCK).agg(F.count("*").alias("matches")).write.parquet(path)
            kept = located.sparkSession.read.schema(f"{FILE} string, {BLOCK} long, matches long").parquet(path)
            self.blocks = (first, last), kept
        return self.blocks[1]

    def frame(self, offset: int = 0, max_rows: int | None = None, peek: bool = False) -> DataFrame:
        """The rows of one page; `peek` adds the row after it."""
        start = max(offset, 0)
        end = start + clamp_rows(max_rows) + (1 if peek else 0)
        touched = self.files.filter((F.col("upto") > start) & (F.col("upto") - F.col("matches") < end))
        first, last, before = touched.agg(F.min(FILE), F.max(FILE), F.min(F.col("upto") - F.col("matches"))).first()
        if first is None:
            return _nothing(self.rows).select(*self.columns)
        located = _within_files(self.rows, first, last)
        bounds = _located(self._blocks(located, first, last), [FILE, BLOCK], start - before, end - before)
        return _of_blocks(located, bounds, start - before, end - before).select(*[F.col(f"`{name}`") for name in self.columns])

    def page(self, offset: int = 0, max_rows: int | None = None) -> Page:
        """One page; its `next_offset` is that of the page after it."""
        count, skip = clamp_rows(max_rows), max(offset, 0)
        found = self.frame(skip, count, peek=True).collect()
        truncated = len(found) > count
        return Page(self.columns, found[:count], truncated, skip, skip + count if truncated else None)

    def pages(self, max_rows: int | None = None) -> Iterator[Page]:
        """All pages from the first on."""
        offset: int | None = 0
        while offset is not None:
            found = self.page(offset, max_rows)
            yield found
            offset = found.next_offset


def page_frame(
    df: DataFrame, filters: Iterable | None = None, max_rows: int | None = None, offset: int = 0, peek: bool = False
) -> DataFrame:
    """Rows of one page of a positioned scan, in file order; `peek` adds the row after the page, if any."""
    count, skip = clamp_rows(max_rows), max(offset, 0)
    conditions = checked_conditions(filters)
    end = skip + count + (1 if peek else 0)
    if not conditions and ROW in df.columns and whole_scan(df):
        rows = _numbered(df, input_files(df), skip, end)
    else:
        rows = _slice(where(df, conditions), input_files(df), skip, end)
    return rows.select(*[F.col(f"`{name}`") for name in user_columns(df)])


def page_flags(
    df: DataFrame, filters: Iterable | None = None, max_rows: int | None = None, offset: int = 0
) -> DataFrame:
    """One row: rows on the page, `truncated`, `offset`, `next_offset`; no second look at the table."""
    count, skip = clamp_rows(max_rows), max(offset, 0)
    found = page_frame(df, filters, count, skip, peek=True).agg(F.count("*").alias("found"))
    truncated = F.col("found") > count
    return found.select(
        F.least("found", F.lit(count)).alias("rows"),
        truncated.alias("truncated"),
        F.lit(skip).cast("bigint").alias("offset"),
        F.when(truncated, F.lit(skip + count).cast("bigint")).alias("next_offset"),
    )


def page(
    df: DataFrame,
    filters: Iterable | None = None,
    max_rows: int | None = None,
    offset: int = 0,
    columns: list[str] | None = None,
    project=project_existing,
    with_total: bool = False,
) -> Page:
    """Filter, skip, take, then project. `with_total` counts the unfiltered rows."""
    count, skip = clamp_rows(max_rows), max(offset, 0)
    rows = project(page_frame(df, filters, count, skip, peek=True), columns)
    found = rows.collect()
    truncated = len(found) > count
    return Page(
        columns=rows.columns,
        rows=found[:count],
        truncated=truncated,
        offset=skip,
        next_offset=skip + count if truncated else None,
        total_rows=df.count() if with_total else None,
    )


def page_after(
    df: DataFrame, last: tuple[str, int] | None, filters: Iterable | None = None, max_rows: int | None = None
) -> DataFrame:
    """The page that follows a Parquet row given by (file, row index); earlier files are not opened.

    Position columns stay in the result, so its last row names the start of the next page.
    """
    count = clamp_rows(max_rows)
    matching, files = where(df, filters), input_files(df)
    if last is not None:
        file, row = last
        matching = matching.filter((F.col(FILE) > file) | ((F.col(FILE) == file) & (F.col(ROW) > row)))
        files = [name for name in files if name >= file]
    return _slice(matching, files, 0, count)


def total_count(df: DataFrame) -> DataFrame:
    """Number of unfiltered rows; Parquet answers from its footers."""
    return df.agg(F.count("*").alias("total_rows"))
