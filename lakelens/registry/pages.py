"""Pages in file order; the test tables are stored in key order."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakelens.functions.predicates import where
from lakelens.operators.paging import Walk, page_after, page_flags, page_frame, total_count
from lakelens.registry.base import plain, query, table, table_path
from lakelens.session import scratch_path
from lakelens.sinks.tables import write_csv
from lakelens.sources.csv import read_csv
from lakelens.sources.parquet import read_parquet
from lakelens.sources.position import FILE
from lakelens.sources.text import read_text

DEAR = [("o_totalprice", "gt", "300000"), ("o_orderstatus", "ne", "P")]
DEAR_SQL = "o_totalprice > 300000 AND o_orderstatus <> 'P'"


def _orders(spark, sf_dir):
    return read_parquet(spark, table_path(sf_dir, "orders"), position=True)


@query("page_first", "SELECT event_id, event_type FROM events ORDER BY event_id LIMIT 200")
def page_first(spark, sf_dir):
    events = read_parquet(spark, table_path(sf_dir, "events"), position=True)
    return page_frame(events).select("event_id", "event_type")


@query("page_offset", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 100 OFFSET 1000")
def page_offset(spark, sf_dir):
    return page_frame(_orders(spark, sf_dir), None, 100, 1000).select("o_orderkey", "o_custkey")


@query(
    "page_filtered",
    f"SELECT o_orderkey, o_totalprice FROM orders WHERE {DEAR_SQL} ORDER BY o_orderkey LIMIT 50 OFFSET 120",
)
def page_filtered(spark, sf_dir):
    return page_frame(_orders(spark, sf_dir), DEAR, 50, 120).select("o_orderkey", "o_totalprice")


@query("page_past_end", "SELECT o_orderkey FROM orders WHERE false")
def page_past_end(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    return page_frame(orders, None, 100, 1 << 50).select("o_orderkey")


@query(
    "page_flags",
    f"SELECT least(count(*) - 200, 150) AS rows, count(*) > 350 AS truncated, CAST(200 AS BIGINT) AS \"offset\", "
    f"CASE WHEN count(*) > 350 THEN CAST(350 AS BIGINT) END AS next_offset FROM orders WHERE {DEAR_SQL}",
)
def flags(spark, sf_dir):
    return page_flags(_orders(spark, sf_dir), DEAR, 150, 200)


@query("page_after", "SELECT o_orderkey FROM orders WHERE o_custkey < 500 AND o_orderkey > 499 ORDER BY 1 LIMIT 75")
def keyset(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    first_file = orders.agg(F.min(FILE)).first()[0]
    return page_after(orders, (first_file, 499), [("o_custkey", "lt", "500")], 75).select("o_orderkey")


@query("total_count", "SELECT count(*) AS total_rows FROM lineitem")
def total(spark, sf_dir):
    return total_count(table(spark, sf_dir, "lineitem"))


@query(
    "agg_all_pages",
    "SELECT o_orderpriority, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS amount "
    "FROM orders GROUP BY o_orderpriority",
)
def agg_all_pages(spark, sf_dir):
    rows = table(spark, sf_dir, "orders")
    amount = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("amount")
    return plain(rows.groupBy("o_orderpriority").agg(F.count("*").alias("orders"), amount))


def _walked(walk: Walk, offset: int, pages: int, rows: int):
    """Consecutive pages of a walk, each begun where the one before says."""
    found = [walk.frame(offset + i * rows, rows) for i in range(pages)]
    out = found[0]
    for page in found[1:]:
        out = out.unionByName(page)
    return out


@query(
    "walk_csv",
    "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus FROM orders WHERE o_totalprice > 100000 ORDER BY orders.o_orderkey LIMIT 360 OFFSET 40",
)
def walk_csv(spark, sf_dir):
    """Four pages in the middle of a filtered CSV folder, its matches counted once."""
    path = scratch_path(spark, "csv")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("price"))
    write_csv(orders.repartitionByRange(6, "o_orderkey").sortWithinPartitions("o_orderkey"), path)
    walk = Walk(read_csv(spark, path, position=True), [("price", "gt", "100000")])
    return _walked(walk, 40, 4, 90).select("o_orderkey", "o_orderstatus")


@query("walk_text", "SELECT event_type || ' ' || event_id AS value FROM events WHERE event_type LIKE '%e%' ORDER BY event_id LIMIT 300 OFFSET 500")
def walk_text(spark, sf_dir):
    path = scratch_path(spark, "text")
    lines = table(spark, sf_dir, "events").repartitionByRange(5, "event_id").sortWithinPartitions("event_id")
    lines.select(F.concat_ws(" ", "event_type", "event_id").alias("value")).write.text(path)
    return _walked(Walk(read_text(spark, path, position=True), [("value", "contains", "e")]), 500, 3, 100)
