"""The registered queries of this package: thin digests over the operators, on whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from lakelens.llm import secret_spans, toxicity
from lakelens.llm.centroids import centroid_clusters
from lakelens.llm.columns import written
from lakelens.llm.decontamination import contaminated
from lakelens.llm.licence_scan import TEMPLATES, scan_licences
from lakelens.llm.mixing import mix
from lakelens.llm.near_duplicates import near_duplicates
from lakelens.llm.repeated_bytes import remove_repeats
from lakelens.llm.token_files import read_token_files, token_folder, write_token_files
from lakelens.llm.top_k import top_k
from lakelens.llm.url_filters import judge_urls, rule_table
from lakelens.llm.vector_codes import vector_codes
from lakelens.llm.vector_sql import cluster_sql, code_sql
from lakelens.llm.warc import archive_folder, read_records, transactions, with_revisited, write_archives
from lakelens.registry.base import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query; those without SQL are tested against brute force in `tests/llm`."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return register


@query("op1_licence_scan")
def op1_licence_scan(spark, sf_dir):
    templates = spark.createDataFrame(TEMPLATES, "license string, text string")
    return scan_licences(table(spark, sf_dir, "documents"), templates)


@query("op2_source_mix")
def op2_source_mix(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


@query(
    "op3_url_filters",
    """
    WITH cut AS (
      SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
    parted AS (
      SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
    rules(r_host, r_path, r_verdict) AS (
      VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
    pairs AS (SELECT DISTINCT host, path FROM parted),
    best AS (
      SELECT host, path, arg_max(r_host || r_path, length(r_host || r_path)) AS rule, arg_max(r_verdict, length(r_host || r_path)) AS verdict
      FROM pairs JOIN rules ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path) GROUP BY ALL)
    SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parted LEFT JOIN best USING (host, path)
    """,
)
def op3_url_filters(spark, sf_dir):
    return judge_urls(table(spark, sf_dir, "pages"), rule_table(spark, URL_RULES))


@query("op4_decontamination")
def op4_decontamination(spark, sf_dir):
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row")


@query("op5_toxicity")
def op5_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), toxicity.score(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query("op6_secret_spans")
def op6_secret_spans(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = secret_spans.find_secrets(docs, secret_spans.train(docs))
    joined = "array_join(transform({}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"
    base = "filter(spans, s -> s.kind != 'random')"
    counts = [f"CAST(size(filter(spans, s -> s.kind = '{k}')) AS BIGINT) AS n_{k}" for k in ("assign", "access", "hex", "random")]
    return found.selectExpr("doc_id", *counts, f"sha2({joined.format(base)}, 256) AS base_sha256", f"{joined.format('spans')} AS spans")


@query("op7_token_files")
def op7_token_files(spark, sf_dir):
    folder = token_folder(spark)
    files = write_token_files(table(spark, sf_dir, "documents"), VOCABULARY, folder)
    return read_token_files(written(files, "token-files"), folder)


@query("op8_near_duplicates")
def op8_near_duplicates(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), percent=85).drop("row", "chosen")


@query(
    "op9_top_k",
    """
    WITH usable AS (
      SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    pairs AS (
      SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM usable q JOIN usable c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
    """,
)
def op9_top_k(spark, sf_dir):
    return top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


@query("op10_warc")
def op10_warc(spark, sf_dir):
    folder = archive_folder(spark)
    archives = write_archives(table(spark, sf_dir, "pages"), folder)
    records = written(read_records(archives, folder, keep_payload=False), "warc-records")
    return with_revisited(transactions(records)).selectExpr(
        "capture_id AS page_id",
        "response.payload_bytes",
        "response.digest AS payload_digest",
        "response.type AS record_type",
        "refers_to",
    )


@query("op11_centroid_clusters", cluster_sql())
def op11_centroid_clusters(spark, sf_dir):
    return centroid_clusters(table(spark, sf_dir, "embeddings"))


@query(
    "op12_suffix_dedup",
    """
    WITH docs AS MATERIALIZED (SELECT doc_id, row_number() OVER () AS r, lower(hex(encode(coalesce(text, '')))) AS h FROM documents),
    starts AS MATERIALIZED (
      SELECT r, i, md5_number(substr(h, 2 * i + 1, 800)) AS m FROM (SELECT r, h, unnest(range(0, length(h) // 2 - 399)) AS i FROM docs WHERE length(h) >= 800)),
    again AS (SELECT r, i FROM starts JOIN (SELECT m FROM starts GROUP BY m HAVING count(*) > 1) USING (m)),
    marked AS (SELECT r, i, CASE WHEN i - lag(i) OVER w <= 400 THEN 0 ELSE 1 END AS fresh FROM again WINDOW w AS (PARTITION BY r ORDER BY i)),
    numbered AS (SELECT r, i, sum(fresh) OVER (PARTITION BY r ORDER BY i) AS s FROM marked),
    spans AS MATERIALIZED (SELECT r, s, min(i) AS a, max(i) + 400 AS b FROM numbered GROUP BY r, s),
    pieces AS (
      SELECT r, s, substr(h, 2 * coalesce(lag(b) OVER w, 0) + 1, 2 * (a - coalesce(lag(b) OVER w, 0))) AS kept, b, row_number() OVER (PARTITION BY r ORDER BY s DESC) AS last_first
      FROM spans JOIN docs USING (r) WINDOW w AS (PARTITION BY r ORDER BY s)),
    changed AS (
      SELECT r, string_agg(kept || CASE WHEN last_first = 1 THEN substr(h, 2 * p.b + 1) ELSE '' END, '' ORDER BY s) AS kept, count(*) AS n_spans
      FROM pieces p JOIN docs USING (r) GROUP BY r),
    sums AS (SELECT r, sum(b - a) AS n_removed FROM spans GROUP BY r)
    SELECT doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
    FROM docs LEFT JOIN changed USING (r) LEFT JOIN sums USING (r)
    """,
)
def op12_suffix_dedup(spark, sf_dir):
    return remove_repeats(table(spark, sf_dir, "documents"))


@query("op13_vector_codes", code_sql())
def op13_vector_codes(spark, sf_dir):
    return vector_codes(table(spark, sf_dir, "embeddings"))


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)
