"""Tabular XML: a root element whose children are records.

Column names come from the first record, read from the head of the first file. Every file is cut into the root's
children over many tasks and each child is parsed by Spark's XML functions: files of nothing but records at their end tags,
others by the depth of their tags. Files that cannot be cut, because a comment, a section or an instruction in them
holds a `<`, are read as a whole, one file to a task, with the same rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import islice

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelens.functions.predicates import where
from lakelens.operators.project import project_requested
from lakelens.sources.position import BLOCK, FILE, LINE, input_files, with_split_position
from lakelens.sources import xml_records
from lakelens.sources.xml_records import XmlRecord, iter_records, root_tag
from lakelens.sources.xml_split import even_records, files_to_keep_whole, split_records, uneven_files
from lakelens.sources.xml_text import BREAK, cell_text, decoded, shielded

# Executors need not have this package installed: the record reader travels with the job.
cloudpickle.register_pickle_by_value(xml_records)

HEAD_TAGS = 4_096
ATTRIBUTE = "@"
PIECE_BYTES = 1 << 20
BATCH_RECORDS = 10_000
# The parser's name for text beside child elements.
VALUE_TAG = "_VALUE"
XML_SCHEMA = "name string, is_attribute boolean"


def _head(pieces: DataFrame, file: str, tags: int) -> list[bytes]:
    """The first `tags` tags of a file, cut after each `>`; long lines do no harm."""
    head = pieces.filter((F.col(FILE) == file) & (F.col(BLOCK) == 0)).select("value").limit(tags)
    return [(row[0] + ">").encode() for row in head.collect()]


def _from_first_tag(spark: SparkSession, path: str | list[str], record: str, tags: int) -> list[bytes]:
    """The first tag of that name and the tags after it, wherever in the files it is."""
    pieces = with_split_position(spark.read.option("lineSep", "<").text(path))
    opening = F.col("value").rlike(rf"(?i)^(?:[^\s/>:]+:)?{re.escape(record)}(?=[\s/>])")
    file = pieces.filter(opening).agg(F.min(FILE)).first()[0]
    if file is None:
        return []
    inside = pieces.filter(F.col(FILE) == file).withColumn(LINE, F.monotonically_increasing_id())
    first = inside.filter(opening).agg(F.min(F.struct(BLOCK, LINE))).first()[0]
    same_block = (F.col(BLOCK) == first[BLOCK]) & (F.col(LINE) >= first[LINE])
    following = inside.filter(same_block | (F.col(BLOCK) > first[BLOCK]))
    return [("<" + row[0]).encode() for row in following.orderBy(BLOCK, LINE).limit(tags).select("value").collect()]


def _first_records(
    spark: SparkSession, path: str | list[str], record: str | None, namespaces: dict[str, str] | None = None
) -> list[XmlRecord]:
    """Records at the head of the first file, else the first one wherever it is, read on to its end."""
    namespaces = {} if namespaces is None else namespaces
    pieces = with_split_position(spark.read.option("lineSep", ">").text(path))
    for file in input_files(pieces):
        tags = HEAD_TAGS
        while True:
            namespaces.clear()
            head = _head(pieces, file, tags)
            records = list(iter_records(head, record, namespaces))
            if records:
                return records
            if record is not None or len(head) < tags:
                break
            tags *= 8
        if record is not None:
            break
    tags = HEAD_TAGS
    while record is not None:
        found = _from_first_tag(spark, path, record, tags)
        records = list(islice(iter_records([root_tag(namespaces), *found], record), 1))
        if records or len(found) < tags:
            return records
        tags *= 8
    return []


def xml_schema(spark: SparkSession, path: str | list[str], record: str | None = None) -> DataFrame:
    """Columns of the first record and whether each is an attribute; no rows if there is no record."""
    records = _first_records(spark, path, record)
    return spark.createDataFrame(records[0].columns() if records else [], XML_SCHEMA)


def _child_text(name: str) -> Column:
    """First child of that name: '' when empty, NULL when absent."""
    every = F.col(f"`{name}`")
    return F.when(F.size(every) > 0, cell_text(F.coalesce(F.try_element_at(every, F.lit(1)), F.lit(""))))


def _raw_schema(names: list[str]) -> T.StructType:
    fields = []
    for name in names:
        fields.append(T.StructField(ATTRIBUTE + name, T.StringType()))
        fields.append(T.StructField(name, T.ArrayType(T.StringType())))
    return T.StructType(fields)


OPTIONS = {
    "ignoreNamespace": "true",
    "ignoreSurroundingSpaces": "false",
    "attributePrefix": ATTRIBUTE,
    "mode": "FAILFAST",
}


def _split_rows(records: DataFrame, names: list[str]) -> DataFrame:
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in _raw_schema(names).fields)
    parsed = F.from_xml(shielded(F.col("record")), schema, OPTIONS)
    raw = records.select(parsed.alias("_cells"), FILE, BLOCK, LINE).select("_cells.*", FILE, BLOCK, LINE)
    cells = [F.coalesce(decoded(F.col(f"`{ATTRIBUTE}{name}`")), _child_text(name)).alias(name) for name in names]
    return raw.select(*cells, FILE, BLOCK, LINE)


def _whole_schema(names: list[str]) -> T.StructType:
    texts, places = [*names, FILE], [BLOCK, LINE]
    return T.StructType(
        [T.StructField(n, T.StringType()) for n in texts] + [T.StructField(n, T.LongType()) for n in places]
    )


def _whole_rows(
    spark: SparkSession, path: str | list[str], record: str | None, names: list[str], whole: DataFrame
) -> DataFrame:
    """Rows of files that are not cut, one file at a time."""
    keys, schema = [name.upper() for name in names], _whole_schema(names)

    def rows_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, content in zip(batch[FILE], batch["content"]):
                pieces = (content[i : i + PIECE_BYTES] for i in range(0, len(content), PIECE_BYTES))
                rows = []
                for index, found in enumerate(iter_records(pieces, record, complete=True)):
                    values = found.values()
                    rows.append([*(values.get(key) for key in keys), file, 0, index])
                    if len(rows) == BATCH_RECORDS:
                        yield pd.DataFrame(rows, columns=schema.names)
                        rows = []
                yield pd.DataFrame(rows, columns=schema.names)

    files = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias(FILE), "content")
    return files.join(whole, FILE, "left_semi").mapInPandas(rows_of, schema)


def _all_records(spark: SparkSession, path: str | list[str], record: str | None, tag: str) -> tuple[DataFrame, DataFrame | None]:
    """The records of all files that can be cut, and the names of those that cannot."""
    uneven = uneven_files(spark, path, tag)
    if uneven.isEmpty():
        return even_records(spark, path, tag, None), None
    whole = files_to_keep_whole(spark, path, uneven)
    split = split_records(spark, path, uneven, whole)
    if record is not None:
        split = split.filter(F.upper("tag") == record.upper())
    return even_records(spark, path, tag, uneven).unionByName(split), whole


def xml_columns(spark: SparkSession, path: str | list[str], record: str | None = None) -> list[str]:
    """Columns of the first record of every file: those of the first file in its order, then others by name.

    One record per file is looked at; names that differ by case are one column.
    """
    head = _first_records(spark, path, record)
    if not head:
        return []
    records, whole = _all_records(spark, path, record, head[0].name)
    first = records.groupBy(FILE).agg(F.min_by("record", F.struct(BLOCK, LINE)).alias("record"))
    cells = first.select(F.from_xml(shielded(F.col("record")), "variant", OPTIONS).alias("cells"))
    keys = cells.lateralJoin(spark.tvf.variant_explode(F.col("cells").outer())).select(F.ltrim("key", F.lit(ATTRIBUTE)).alias("name"))
    if whole is not None:

        def names_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for content in batch["content"]:
                    pieces = (content[i : i + PIECE_BYTES] for i in range(0, len(content), PIECE_BYTES))
                    for found in islice(iter_records(pieces, record), 1):
                        yield pd.DataFrame({"name": [name for name, _ in found.columns()]})

        files = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias(FILE), "content")
        keys = keys.unionByName(files.join(whole, FILE, "left_semi").select("content").mapInPandas(names_of, "name string"))
    known = [name for name, _ in head[0].columns()]
    others = keys.filter(F.col("name") != VALUE_TAG).groupBy(F.upper("name").alias("folded")).agg(F.min("name").alias("name")).orderBy("folded")
    upper = {name.upper() for name in known}
    return known + [row["name"] for row in others.collect() if row["folded"] not in upper and row["name"] != BREAK[1:-2]]


def read_xml(
    spark: SparkSession,
    path: str | list[str],
    record: str | None = None,
    columns: list[str] | None = None,
    filters: Iterable | None = None,
    position: bool = False,
) -> DataFrame:
    """Text rows of the records; attributes first, then child elements.

    `record` names the record element, whatever its case; otherwise every child of the root is one. `columns` are
    returned in the requested order and spelling, NULL where a record has none.
    """
    head = _first_records(spark, path, record)
    if not head:
        return spark.createDataFrame([], T.StructType([T.StructField(n, T.StringType()) for n in columns or []]))
    known = [name for name, _ in head[0].columns()]
    upper = {name.upper() for name in known}
    names = known + [name for name in dict.fromkeys(columns or []) if name.upper() not in upper]
    records, whole = _all_records(spark, path, record, head[0].name)
    rows = _split_rows(records, names)
    if whole is not None:
        rows = rows.unionByName(_whole_rows(spark, path, record, names, whole))
    where(rows.select(*known), filters)
    rows = where(rows, filters)
    kept = columns or known
    if position:
        kept = [*kept, *[name for name in rows.columns if name in (FILE, BLOCK, LINE)]]
    return project_requested(rows, kept)
