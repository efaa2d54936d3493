"""One lake folder with the operations a caller uses by name."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, SparkSession

from lakelens.operators import catalog
from lakelens.operators.paging import Page, Walk, clamp_rows, page
from lakelens.operators.project import project_existing, project_requested
from lakelens.sinks import tables
from lakelens.sinks.tables import INDEX_PATH, lake_path
from lakelens.sources.csv import read_csv
from lakelens.sources.files import file_info, list_directory
from lakelens.sources.parquet import parquet_schema, read_parquet
from lakelens.sources.text import read_text
from lakelens.sources.xml import read_xml, xml_schema

# Formats whose content a search returns when it finds one file.
READABLE = ["csv", "parquet", "txt", "md"]


@dataclass(frozen=True)
class SearchResult:
    """Entries found; with exactly one, its first page or a message why there is none."""

    files: DataFrame
    content: Page | None = field(default=None, repr=False)
    message: str | None = None


class Lake:
    """Reads, pages, saves and finds files below `root`, any URI Spark can open."""

    def __init__(self, spark: SparkSession, root: str, index_path: str = INDEX_PATH):
        self.spark = spark
        self.root = root
        self.index_path = index_path

    def _at(self, path: str) -> str:
        return lake_path(self.root, path) if path else self.root

    def list_directory(self, path: str = "", recursive: bool = False) -> DataFrame:
        return list_directory(self.spark, self._at(path), recursive)

    def get_file_info(self, path: str) -> DataFrame:
        return file_info(self.spark, self._at(path))

    def get_parquet_schema(self, path: str) -> DataFrame:
        return parquet_schema(self.spark, self._at(path))

    def get_xml_schema(self, path: str, record: str | None = None) -> DataFrame:
        return xml_schema(self.spark, self._at(path), record)

    def read_csv(
        self,
        path: str,
        max_rows: int | None = None,
        delimiter: str = ",",
        has_header: bool = True,
        offset: int = 0,
        filters: Iterable | None = None,
        multiline: bool | None = None,
    ) -> Page:
        """`multiline=None` finds files with records that span lines while it reads; False takes every line as a record."""
        rows = read_csv(self.spark, self._at(path), delimiter, has_header, filters, multiline, position=True)
        return page(rows, None, max_rows, offset)

    def read_parquet(
        self,
        path: str,
        max_rows: int | None = None,
        columns: list[str] | None = None,
        offset: int = 0,
        filters: Iterable | None = None,
    ) -> Page:
        rows = read_parquet(self.spark, self._at(path), position=True)
        return page(rows, filters, max_rows, offset, columns, project_existing, with_total=True)

    def read_text(self, path: str, max_lines: int | None = None, offset: int = 0, contains: str | None = None) -> Page:
        return page(read_text(self.spark, self._at(path), contains, position=True), None, max_lines, offset)

    read_markdown = read_text

    def read_xml(
        self,
        path: str,
        max_rows: int | None = None,
        record: str | None = None,
        columns: list[str] | None = None,
        offset: int = 0,
        filters: Iterable | None = None,
    ) -> Page:
        rows = read_xml(self.spark, self._at(path), record, columns, filters, position=True)
        return page(rows, None, max_rows, offset, None, project_requested)

    def walk(self, path: str, format: str = "csv", filters: Iterable | None = None, **read) -> Walk:
        """All pages of a file or folder (csv, parquet, txt, md, xml), its matches counted once; `read` goes to the reader."""
        readers = {"csv": read_csv, "parquet": read_parquet, "txt": read_text, "md": read_text, "xml": read_xml}
        if format not in readers:
            raise ValueError(f"Format '{format}' has no pages. Allowed: {', '.join(readers)}.")
        return Walk(readers[format](self.spark, self._at(path), position=True, **read), filters)

    def save_text(self, path: str, content: DataFrame | str, **options) -> DataFrame:
        return tables.save_text(self.spark, content, self.root, path, index_path=self.index_path, **options)

    def save_markdown(self, path: str, content: DataFrame | str, **options) -> DataFrame:
        return tables.save_markdown(self.spark, content, self.root, path, index_path=self.index_path, **options)

    def save_csv(self, path: str, content: DataFrame | str, **options) -> DataFrame:
        return tables.save_csv(self.spark, content, self.root, path, index_path=self.index_path, **options)

    def save_parquet(self, path: str, content: DataFrame, json_column: str | None = None, **options) -> DataFrame:
        return tables.save_parquet(
            self.spark, content, self.root, path, json_column, index_path=self.index_path, **options
        )

    def catalog(self) -> DataFrame:
        return catalog.load_catalog(self.spark, self._at(self.index_path))

    def search_file(
        self, name: str | None = None, format: str | None = None, max_rows: int | None = None, delimiter: str = ","
    ) -> SearchResult:
        """Finds saved files; a single hit also brings its first page."""
        files = catalog.search(self.catalog(), name, format)
        hits: list[Row] = files.limit(2).collect()
        if len(hits) != 1:
            return SearchResult(files)
        hit, count = hits[0], clamp_rows(max_rows)
        if hit.format not in READABLE:
            return SearchResult(files, message=f"'{hit.format}' files cannot be read as text; only metadata is given.")
        if hit.format == "csv":
            return SearchResult(files, self.read_csv(hit.path, count, delimiter))
        if hit.format == "parquet":
            return SearchResult(files, self.read_parquet(hit.path, count))
        return SearchResult(files, self.read_text(hit.path, count))
