"""Saves read back, checks, JSON typing and the catalogue."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakelens.functions.predicates import where
from lakelens.lake import Lake
from lakelens.operators.catalog import append_entries, load_catalog, parsed_entries, read_catalog_csv, search, upsert, write_catalog_csv
from lakelens.operators.csv_check import bad_records, check_csv_files
from lakelens.operators.json_rows import infer_json_types, json_rows_to_table
from lakelens.operators.paths import normalized_path
from lakelens.operators.payload import check_payloads
from lakelens.operators.profile import SKETCH_ERROR, distinct_sketches, keyword_compare, merged_distinct, profile_nulls, sample_rows
from lakelens.registry.base import plain, query, table
from lakelens.session import scratch_path
from lakelens.sources.csv import read_csv
from lakelens.sources.parquet import read_parquet
from lakelens.sources.text import read_text
from lakelens.streaming.streams import write_catalog, write_filtered


def _lake(spark) -> Lake:
    return Lake(spark, scratch_path(spark, "lake"))


@query(
    "sink_text_roundtrip",
    "SELECT unnest(string_split(text, chr(10))) AS value FROM documents",
)
def sink_text_roundtrip(spark, sf_dir):
    lake = _lake(spark)
    lake.save_text("notes/all.txt", table(spark, sf_dir, "documents").select("text"))
    return read_text(spark, f"{lake.root}/notes/all.txt")


@query("sink_markdown_roundtrip", "SELECT unnest(string_split(text, chr(10))) AS value FROM conversations")
def sink_markdown_roundtrip(spark, sf_dir):
    lake = _lake(spark)
    lake.save_markdown("notes/talk.md", table(spark, sf_dir, "conversations").select("text"))
    return read_text(spark, f"{lake.root}/notes/talk.md")


@query(
    "sink_csv_roundtrip",
    "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name || ', \"' || p_brand || '\"' AS label, "
    "' ' || p_type AS p_type FROM part",
)
def sink_csv_roundtrip(spark, sf_dir):
    lake = _lake(spark)
    label = F.concat("p_name", F.lit(', "'), "p_brand", F.lit('"')).alias("label")
    part = table(spark, sf_dir, "part")
    lake.save_csv("export/part.csv", part.select("p_partkey", label, F.concat(F.lit(" "), "p_type").alias("p_type")))
    return read_csv(spark, f"{lake.root}/export/part.csv")


@query("sink_parquet_roundtrip", "SELECT event_id, user_id, event_type, value FROM events")
def sink_parquet_roundtrip(spark, sf_dir):
    lake = _lake(spark)
    events = table(spark, sf_dir, "events")
    rows = events.select(F.to_json(F.struct("event_id", "user_id", "event_type", "value")).alias("json"))
    lake.save_parquet("export/events.parquet", rows, json_column="json")
    return read_parquet(spark, f"{lake.root}/export/events.parquet")


@query(
    "infer_json_types",
    "SELECT 'events' AS source, key AS \"column\", CASE WHEN bool_and(kind IN ('BIGINT', 'UBIGINT')) THEN 'bigint' "
    "ELSE 'string' END AS type FROM (SELECT key, json_type(props, '$.' || key) AS kind FROM "
    "(SELECT props, unnest(json_keys(props)) AS key FROM events)) GROUP BY key "
    "UNION ALL SELECT * FROM (VALUES ('orders', 'o_orderkey', 'bigint'), ('orders', 'o_custkey', 'bigint'), "
    "('orders', 'o_orderstatus', 'string'), ('orders', 'o_totalprice', 'double'), "
    "('orders', 'o_orderdate', 'string'), ('orders', 'o_orderpriority', 'string'), "
    "('mixed', 'id', 'bigint'), ('mixed', 'flag', 'boolean'), ('mixed', 'mark', 'string'), ('mixed', 'none', 'string'), "
    "('mixed', 'size', 'double')) AS t(source, \"column\", type)",
)
def json_types(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    even = F.col("doc_id") % 2 == 0
    mixed = documents.select(
        F.concat(
            F.lit('{"id":'), "doc_id", F.lit(',"flag":'), even.cast("string"), F.lit(',"none":null,"mark":'),
            F.when(even, F.col("n_chars").cast("string")).otherwise(F.concat(F.lit('"'), "lang", F.lit('"'))),
            F.lit(',"size":'), F.when(even, F.lit("1")).otherwise(F.lit("2.5")), F.lit("}"),
        ).alias("json")
    )
    sources = {
        "events": table(spark, sf_dir, "events").select(F.col("props").alias("json")),
        "orders": table(spark, sf_dir, "orders").select(F.to_json(F.struct("*")).alias("json")),
        "mixed": mixed,
    }
    found = [
        infer_json_types(rows, "json").select(F.lit(name).alias("source"), "column", "type")
        for name, rows in sources.items()
    ]
    return found[0].unionAll(found[1]).unionAll(found[2])


@query(
    "csv_field_count_check",
    "SELECT l_orderkey, l_linenumber, CAST(5 AS INTEGER) AS n_fields, CAST(4 AS INTEGER) AS expected FROM lineitem "
    "WHERE l_partkey % 7 = 0",
)
def csv_field_count_check(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    quoted = F.concat(F.lit('"'), "l_returnflag", F.lit(', ""x"", '), "l_linestatus", F.lit('"'))
    line = F.concat_ws(",", "l_orderkey", quoted, "l_quantity", F.lit(""))
    line = F.when(F.col("l_partkey") % 7 == 0, F.concat(line, F.lit(",extra"))).otherwise(line)
    records = items.select("l_orderkey", "l_linenumber", line.alias("line"))
    return bad_records(records, "line", 4).select("l_orderkey", "l_linenumber", "n_fields", "expected")


@query(
    "payload_check",
    "SELECT doc_id, doc_id % 2 = 0 AS valid, CASE doc_id % 4 WHEN 1 THEN 'not a pdf' WHEN 3 THEN 'not base64' END "
    "AS reason FROM documents",
)
def payload_check(spark, sf_dir):
    text, kind = F.col("text"), F.col("doc_id") % 4
    document = F.base64(F.encode(F.concat(F.lit("%PDF-"), text), "UTF-8"))
    payload = (
        F.when(kind == 1, F.base64(F.encode(F.concat(F.lit("x"), text), "UTF-8")))
        .when(kind == 3, F.concat(F.lit("***"), text))
        .otherwise(document)
    )
    return check_payloads(table(spark, sf_dir, "documents").select("doc_id", payload.alias("payload")), "payload")


@query(
    "normalize_paths",
    "SELECT page_id, CASE WHEN page_id % 5 = 0 THEN NULL ELSE array_to_string(list_filter(list_transform("
    "string_split(replace(url, chr(92), '/'), '/'), lambda s: trim(s)), lambda s: s <> ''), '/') || '/x.txt' END "
    "AS path FROM pages",
)
def normalize_paths(spark, sf_dir):
    climbing = F.when(F.col("page_id") % 5 == 0, F.lit("/../")).otherwise(F.lit("\\"))
    raw = F.concat(F.lit("// "), "url", climbing, F.lit(" /x.txt "))
    return table(spark, sf_dir, "pages").select("page_id", normalized_path(raw).alias("path"))


def _document_entries(spark, sf_dir):
    """Saved-file entries derived from the documents: few paths, saved again and again, in either case."""
    saved = F.concat_ws("/", "source", F.concat("lang", F.lit("."), _extension()))
    return table(spark, sf_dir, "documents").select(
        F.when(F.col("doc_id") % 2 == 0, saved).otherwise(F.upper(saved)).alias("path"),
        F.concat("lang", F.lit("."), _extension()).alias("name"),
        _extension().alias("format"),
        F.col("n_chars").alias("sizeBytes"),
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("doc_id")).alias("savedAt"),
        F.concat(F.lit("document "), "doc_id").alias("description"),
        "doc_id",
    )


def _extension():
    return F.element_at(F.array(F.lit("csv"), F.lit("md"), F.lit("txt")), (F.col("doc_id") % 3 + 1).cast("int"))


EXTENSION = "list_extract(['csv', 'md', 'txt'], CAST(doc_id % 3 + 1 AS BIGINT))"
NEWEST = (
    "SELECT path, sizeBytes AS size_bytes, description FROM (SELECT CASE WHEN doc_id % 2 = 0 THEN saved "
    "ELSE upper(saved) END AS path, n_chars AS sizeBytes, 'document ' || doc_id AS description, row_number() OVER "
    "(PARTITION BY upper(saved) ORDER BY {order} DESC) AS place FROM (SELECT *, source || '/' || lang || '.' || "
    f"{EXTENSION} AS saved FROM documents)) WHERE place = 1"
)


def _resolved(entries):
    return entries.select("path", F.col("sizeBytes").alias("size_bytes"), "description")


@query("catalog_upsert", NEWEST.format(order="doc_id % 10 = 0, doc_id"))
def catalog_upsert(spark, sf_dir):
    entries = _document_entries(spark, sf_dir)
    is_new = F.col("doc_id") % 10 == 0
    return _resolved(upsert(entries.filter(~is_new), entries.filter(is_new)))


@query("stream_catalog_upsert", NEWEST.format(order="doc_id"))
def stream_catalog_upsert(spark, sf_dir):
    log, index = scratch_path(spark, "log"), scratch_path(spark, "index")
    append_entries(_document_entries(spark, sf_dir), log)
    entries = spark.readStream.schema(spark.read.parquet(log).schema).parquet(log)
    write_catalog(entries, index, scratch_path(spark, "checkpoint")).awaitTermination()
    return _resolved(load_catalog(spark, index))


@query(
    "stream_filter",
    "SELECT event_id, user_id, value FROM events WHERE upper(event_type) = 'PURCHASE' AND value > 10",
)
def stream_filter(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    stream = spark.readStream.schema(events.schema).parquet(f"{sf_dir.rstrip('/')}/events.parquet*")
    target = scratch_path(spark, "stream")
    conditions = [("event_type", "eq", "purchase"), ("value", "gt", "10")]
    columns = ["event_id", "user_id", "value"]
    write_filtered(stream, conditions, target, scratch_path(spark, "checkpoint"), columns).awaitTermination()
    return spark.read.schema(events.select(*columns).schema).parquet(target)


@query(
    "catalog_parse",
    "SELECT CAST(doc_id AS VARCHAR) AS path, '' AS name, CASE WHEN doc_id % 5 = 0 THEN 0 ELSE n_chars END "
    "AS size_bytes, doc_id % 7 = 0 AS bad_time, CASE WHEN doc_id % 7 <> 0 THEN 1704067200 + doc_id END AS saved_at "
    "FROM documents",
)
def catalog_parse(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    moment = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("doc_id"))
    raw = documents.select(
        F.col("doc_id").cast("string").alias("path"),
        F.lit(None).cast("string").alias("name"),
        "lang",
        F.when(F.col("doc_id") % 5 == 0, F.lit("n/a")).otherwise(F.col("n_chars").cast("string")).alias("sizeBytes"),
        F.when(F.col("doc_id") % 7 == 0, F.lit("soon"))
        .otherwise(F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"))
        .alias("savedAt"),
        F.col("lang").alias("format"),
        F.lit("").alias("description"),
    )
    entries = parsed_entries(raw)
    return entries.select(
        "path", "name", F.col("sizeBytes").alias("size_bytes"), F.col("savedAt").isNull().alias("bad_time"),
        F.unix_seconds("savedAt").alias("saved_at"),
    )


def _searched(entries):
    return entries.select("path", "format", "description")


ENTRIES = (
    "SELECT CASE WHEN doc_id % 2 = 0 THEN saved ELSE upper(saved) END AS path, format, 'document ' || doc_id "
    "AS description FROM (SELECT *, source || '/' || lang || '.' || format AS saved FROM "
    f"(SELECT *, {EXTENSION} AS format FROM documents)) WHERE "
)


@query("catalog_search", ENTRIES + "contains(upper(lang), 'FR') AND format = 'csv'")
def catalog_search(spark, sf_dir):
    return _searched(search(_document_entries(spark, sf_dir), " fr", ".CSV"))


@query("catalog_search_alias", ENTRIES + "format = 'md'")
def catalog_search_alias(spark, sf_dir):
    return _searched(search(_document_entries(spark, sf_dir), None, "Markdown"))


@query(
    "search_fetch",
    "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, "
    "CAST(o_totalprice AS VARCHAR) AS o_totalprice, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%g') AS o_orderdate, "
    "o_orderpriority FROM orders WHERE o_orderstatus = 'O' ORDER BY orders.o_orderkey LIMIT 500",
)
def search_fetch(spark, sf_dir):
    lake = _lake(spark)
    orders = table(spark, sf_dir, "orders")
    lake.save_csv("report/open-orders.csv", where(orders, [("o_orderstatus", "eq", "O")]))
    lake.save_parquet("report/all-orders.parquet", orders)
    found = lake.search_file("OPEN", "csv", max_rows=500)
    return spark.createDataFrame(found.content.rows)


@query(
    "extract_chain",
    "SELECT o_orderpriority, count(*) AS orders, CAST(sum(o_custkey) AS BIGINT) AS customers FROM orders "
    "WHERE o_orderstatus = 'O' AND o_totalprice > 1000 GROUP BY o_orderpriority",
)
def extract_chain(spark, sf_dir):
    lake = _lake(spark)
    wanted = where(table(spark, sf_dir, "orders"), [("o_orderstatus", "eq", "O"), ("o_totalprice", "gt", "1000")])
    lake.save_parquet("extract/orders.parquet", wanted.select("o_orderpriority", "o_custkey"))
    saved = search(lake.catalog(), "orders", "parquet").first()
    rows = read_parquet(spark, f"{lake.root}/{saved.path}")
    return rows.groupBy("o_orderpriority").agg(F.count("*").alias("orders"), F.sum("o_custkey").alias("customers"))


def _profile_sql(source: str, columns: dict[str, bool]) -> str:
    parts = []
    for name, is_text in columns.items():
        empty = f"{name} IS NULL OR {name} = ''" if is_text else f"{name} IS NULL"
        parts.append(
            f"SELECT '{name}' AS \"column\", count(*) AS rows, count(*) FILTER ({empty}) AS null_or_empty, "
            f"round(count(*) FILTER ({empty}) / count(*), 6) AS null_ratio, CAST(min({name}) AS VARCHAR) AS min, "
            f"CAST(max({name}) AS VARCHAR) AS max FROM {source}"
        )
    return " UNION ALL ".join(parts)


@query(
    "profile_nulls",
    _profile_sql(
        "(SELECT doc_id, lang, source, n_chars, CASE WHEN doc_id % 4 = 0 THEN '' WHEN doc_id % 4 = 1 THEN NULL "
        "ELSE text END AS text FROM documents)",
        {"doc_id": False, "lang": True, "source": True, "n_chars": False, "text": True},
    ),
)
def profile(spark, sf_dir):
    quarter = F.col("doc_id") % 4
    text = F.when(quarter == 0, F.lit("")).when(quarter > 1, F.col("text"))
    return profile_nulls(table(spark, sf_dir, "documents").withColumn("text", text), approx_distinct=False)


@query(
    "keyword_compare",
    "SELECT p_brand, "
    + ", ".join(
        f"CAST(sum(CASE WHEN year(l_shipdate) = {year} THEN CAST(l_extendedprice AS DECIMAL(18, 2)) END) AS DOUBLE) "
        f'AS "{year}"'
        for year in range(1995, 2002)
    )
    + " FROM lineitem JOIN part ON l_partkey = p_partkey WHERE contains(upper(p_name), 'WIDGET') GROUP BY p_brand",
)
def keyword(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand")
    items = table(spark, sf_dir, "lineitem").select(
        "l_partkey", F.year("l_shipdate").alias("year"), F.col("l_extendedprice").cast("decimal(18,2)").alias("price")
    )
    years = list(range(1995, 2002))
    return plain(keyword_compare(items.join(part, "l_partkey"), "p_name", "widget", "p_brand", "year", "price", years))


@query(
    "json_raw_values",
    "SELECT doc_id AS id, CASE doc_id % 4 WHEN 0 THEN '[' || doc_id || ', ' || n_chars || ' ]' WHEN 1 THEN '{\"k\" : \"}\\\"' || lang || '\", \"v\":[1.0]}' "
    "WHEN 2 THEN n_chars || 'e2' ELSE 'a\"b ' || lang END AS mark, CASE WHEN doc_id % 3 = 0 THEN '-0.50' ELSE lang END AS other FROM documents",
)
def json_raw_values(spark, sf_dir):
    kind = F.col("doc_id") % 4
    mark = (
        F.when(kind == 0, F.format_string("[%s, %s ]", "doc_id", "n_chars"))
        .when(kind == 1, F.format_string('{"k" : "}\\"%s", "v":[1.0]}', "lang"))
        .when(kind == 2, F.format_string("%se2", "n_chars"))
        .otherwise(F.format_string('"a\\"b %s"', "lang"))
    )
    other = F.when(F.col("doc_id") % 3 == 0, F.lit("-0.50")).otherwise(F.format_string('"%s"', "lang"))
    json = F.format_string('{ "id":%s , "mark" : %s, "other":%s}', "doc_id", mark, other)
    return json_rows_to_table(table(spark, sf_dir, "documents").select(json.alias("json")), "json").select("id", "mark", "other")


@query(
    "csv_files_check",
    "SELECT count(*) AS bad_records, CAST(2 AS INTEGER) AS expected, CAST(3 AS INTEGER) AS n_fields FROM lineitem WHERE l_partkey % 7 = 0",
)
def csv_files_check(spark, sf_dir):
    """Written files, each with its header as the first record."""
    path = scratch_path(spark, "csv")
    items = table(spark, sf_dir, "lineitem").repartitionByRange(4, "l_orderkey")
    value = F.concat("l_returnflag", F.when(F.col("l_partkey") % 7 == 0, F.lit(",extra")).otherwise(F.lit("")))
    items.select("l_orderkey", value.alias("flag")).write.csv(path, header=True, quote="\u0000")
    found = check_csv_files(spark, path)
    return found.agg(F.sum("bad_records").alias("bad_records"), F.min("expected").alias("expected"), F.max("n_fields").alias("n_fields"))


@query(
    "catalog_index_file",
    "SELECT 'docs/' || doc_id || '.txt' AS path, doc_id || ' \"' || lang || '\", a' || chr(10) || 'b' AS name, lang AS format, n_chars AS \"sizeBytes\", "
    "TIMESTAMP '2024-05-06 07:08:09.25' AS \"savedAt\", CASE WHEN doc_id % 2 = 0 THEN 'even; , ' || lang END AS description FROM documents WHERE lang = 'en'",
)
def catalog_index_file(spark, sf_dir):
    """A catalogue written as an index file, read back and searched."""
    entries = table(spark, sf_dir, "documents").select(
        F.format_string("docs/%s.txt", "doc_id").alias("path"),
        F.format_string('%s "%s", a\nb', "doc_id", "lang").alias("name"),
        F.col("lang").alias("format"),
        F.col("n_chars").alias("sizeBytes"),
        F.to_timestamp(F.lit("2024-05-06 07:08:09.25")).alias("savedAt"),
        F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("even; , "), "lang")).alias("description"),
    )
    path = scratch_path(spark, "index")
    write_catalog_csv(entries, path)
    return search(read_catalog_csv(spark, path), '"EN", A', ".en").withColumn("savedAt", F.col("savedAt").cast("timestamp_ntz"))


@query(
    "profile_samples",
    "SELECT doc_id, lang, source, n_chars FROM documents ORDER BY md5(concat_ws(chr(1), doc_id, lang)), doc_id LIMIT 50",
)
def profile_samples(spark, sf_dir):
    return sample_rows(table(spark, sf_dir, "documents"), 50, ["doc_id", "lang"]).select("doc_id", "lang", "source", "n_chars")


@query(
    "profile_distinct",
    "SELECT 'doc_id' AS \"column\", count(DISTINCT doc_id) AS exact, true AS within FROM documents UNION ALL "
    "SELECT 'lang', count(DISTINCT lang), true FROM documents UNION ALL SELECT 'source', count(DISTINCT source), true FROM documents UNION ALL "
    "SELECT 'text', count(DISTINCT text), true FROM documents UNION ALL SELECT 'n_chars', count(DISTINCT n_chars), true FROM documents",
)
def profile_distinct(spark, sf_dir):
    """Sketches per language, merged over all languages, against exact counts: within five standard errors."""
    documents = table(spark, sf_dir, "documents")
    columns = ["doc_id", "lang", "source", "text", "n_chars"]
    estimated = merged_distinct(distinct_sketches(documents, columns, ["lang"]).withColumnRenamed("lang", "part"))
    cells = [F.struct(F.lit(name).alias("column"), F.col(name).cast("string").alias("cell")) for name in columns]
    exact = documents.select(F.inline(F.array(*cells))).groupBy("column").agg(F.count_distinct("cell").alias("exact"))
    close = F.abs(F.col("distinct") - F.col("exact")) <= 5 * SKETCH_ERROR * F.col("exact") + 1
    return exact.join(estimated, "column").select("column", "exact", close.alias("within"))
