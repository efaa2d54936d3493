"""Scans, schemas and projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakelens.operators.project import project_existing, project_requested
from lakelens.plans.model import read_folder
from lakelens.functions.predicates import where
from lakelens.registry.base import query, table, table_path
from lakelens.session import scratch_path
from lakelens.sinks.tables import write_csv
from lakelens.sources.csv import read_csv
from lakelens.sources.files import file_info, file_inventory
from lakelens.sources.parquet import parquet_schema, read_parquet
from lakelens.sources.text import read_markdown, read_text
from lakelens.sources.xml import read_xml, xml_schema

LINES = "SELECT unnest(string_split({column}, chr(10))) AS value FROM {table}"


@query(
    "scan_csv",
    "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, "
    "CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) AS o_totalprice, "
    "strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%g') AS o_orderdate, "
    "CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderpriority END AS o_orderpriority FROM orders",
)
def scan_csv(spark, sf_dir):
    path = scratch_path(spark, "csv")
    priority = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("o_orderpriority")
    price = F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice")
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", price, "o_orderdate", priority]
    write_csv(table(spark, sf_dir, "orders").select(*columns), path)
    return read_csv(spark, path)


@query(
    "scan_csv_multiline",
    "SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, text FROM documents",
)
def scan_csv_multiline(spark, sf_dir):
    path = scratch_path(spark, "csv")
    write_csv(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"), path, ";")
    return read_csv(spark, path, ";")


@query(
    "scan_csv_noheader",
    "SELECT CAST(c_custkey AS VARCHAR) AS column_0, c_name AS column_1, CAST(c_nationkey AS VARCHAR) AS column_2, "
    "c_mktsegment AS column_3 FROM customer",
)
def scan_csv_noheader(spark, sf_dir):
    path = scratch_path(spark, "csv")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    write_csv(customer, path, "|", header=False)
    return read_csv(spark, path, "|", has_header=False)


@query("scan_parquet", "SELECT * FROM orders")
def scan_parquet(spark, sf_dir):
    return read_parquet(spark, table_path(sf_dir, "orders"))


@query(
    "schema_parquet",
    "SELECT * FROM (VALUES ('p_partkey', 'bigint', true), ('p_name', 'string', true), ('p_brand', 'string', true), "
    "('p_type', 'string', true), ('p_size', 'int', true), ('p_retailprice', 'double', true)) "
    "AS t(name, type, nullable)",
)
def schema_parquet(spark, sf_dir):
    return parquet_schema(spark, table_path(sf_dir, "part"))


@query("scan_text", LINES.format(column="text", table="documents"))
def scan_text(spark, sf_dir):
    path = scratch_path(spark, "text")
    table(spark, sf_dir, "documents").select("text").write.text(path)
    return read_text(spark, path)


@query("scan_markdown", LINES.format(column="text", table="conversations"))
def scan_markdown(spark, sf_dir):
    path = scratch_path(spark, "markdown")
    table(spark, sf_dir, "conversations").select("text").write.text(path)
    return read_markdown(spark, path)


@query(
    "text_contains",
    f"SELECT value FROM ({LINES.format(column='text', table='documents')}) WHERE contains(upper(value), 'THE ')",
)
def text_contains(spark, sf_dir):
    path = scratch_path(spark, "text")
    table(spark, sf_dir, "documents").select("text").write.text(path)
    return read_text(spark, path, contains="the ")


def _customers_as_xml(spark, sf_dir) -> str:
    path = scratch_path(spark, "xml")
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("@id"),
        F.concat(F.col("c_name"), F.lit(" <&> "), F.col("c_mktsegment")).alias("Name"),
        F.col("c_nationkey").alias("Nation"),
        F.when(F.col("c_nationkey") != 3, F.col("c_nationkey") * 10).alias("Tier"),
        F.when(F.col("c_nationkey") == 4, F.lit("")).otherwise(F.col("c_mktsegment")).alias("Segment"),
    )
    customer.write.xml(path, rootTag="Customers", rowTag="Customer", attributePrefix="@")
    return path


@query(
    "scan_xml",
    "SELECT CAST(c_custkey AS VARCHAR) AS id, c_name || ' <&> ' || c_mktsegment AS \"Name\", "
    "CASE WHEN c_nationkey <> 3 THEN CAST(c_nationkey * 10 AS VARCHAR) END AS \"Tier\", "
    "CASE WHEN c_nationkey = 4 THEN '' ELSE c_mktsegment END AS \"Segment\" FROM customer",
)
def scan_xml(spark, sf_dir):
    return read_xml(spark, _customers_as_xml(spark, sf_dir), "customer", ["id", "Name", "Tier", "Segment"])


@query(
    "scan_xml_strict",
    "SELECT CAST(c_custkey AS VARCHAR) AS id, c_name || ' <&> ' || c_mktsegment AS \"Name\" FROM customer",
)
def scan_xml_strict(spark, sf_dir):
    path = _customers_as_xml(spark, sf_dir)
    columns = ["id", "Name", "Nation"]
    rows = read_xml(spark, path, None, columns, [("Nation", "gte", "0")])
    return rows.select("id", "Name")


@query(
    "schema_xml",
    "SELECT * FROM (VALUES ('id', true), ('Name', false), ('Nation', false), ('Segment', false)) AS t(name, is_attribute) "
    "UNION ALL SELECT 'Tier', false WHERE (SELECT arg_min(c_nationkey, c_custkey) FROM customer) <> 3",
)
def schema_xml(spark, sf_dir):
    return xml_schema(spark, _customers_as_xml(spark, sf_dir))


@query("file_inventory")
def inventory(spark, sf_dir):
    return file_inventory(spark, sf_dir)


@query("file_info")
def info(spark, sf_dir):
    return file_info(spark, table_path(sf_dir, "lineitem"))


def _orders_by_status(spark, sf_dir) -> str:
    path = scratch_path(spark, "folder")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    orders.write.partitionBy("o_orderstatus").csv(path, sep=";", header=True)
    return path


@query(
    "scan_folder",
    "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority, 'o_orderstatus=' || o_orderstatus "
    "AS project_file FROM orders",
)
def scan_folder(spark, sf_dir):
    return read_folder(spark, _orders_by_status(spark, sf_dir))


@query(
    "scan_folder_some",
    "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority, 'o_orderstatus=' || o_orderstatus "
    "AS project_file FROM orders WHERE o_orderstatus IN ('O', 'P')",
)
def scan_folder_some(spark, sf_dir):
    return read_folder(spark, _orders_by_status(spark, sf_dir), files=["o_orderstatus=O", "o_orderstatus=P"])


@query("project_parquet", "SELECT o_orderkey, o_totalprice, o_orderdate FROM orders")
def project_parquet(spark, sf_dir):
    rows = read_parquet(spark, table_path(sf_dir, "orders"))
    return project_existing(rows, ["O_ORDERDATE", "o_totalprice", "no_such_column", "o_orderkey"])


@query(
    "project_xml_style",
    'SELECT p_name AS "P_NAME", CAST(NULL AS VARCHAR) AS missing, p_partkey FROM part',
)
def project_xml_style(spark, sf_dir):
    rows = read_parquet(spark, table_path(sf_dir, "part"))
    return project_requested(rows, ["P_NAME", "missing", "p_partkey"])


@query("filter_nonprojected", "SELECT o_orderkey, o_custkey FROM orders WHERE o_totalprice >= 250000")
def filter_nonprojected(spark, sf_dir):
    rows = where(read_parquet(spark, table_path(sf_dir, "orders")), [("o_totalprice", "gte", "250000")])
    return project_existing(rows, ["o_orderkey", "o_custkey"])


@query(
    "folder_xml",
    "SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS \"Name\", CASE WHEN c_nationkey < 10 THEN c_mktsegment END AS \"Segment\", "
    "CASE WHEN c_nationkey >= 10 THEN CAST(c_nationkey AS VARCHAR) END AS \"Nation\", "
    "CASE WHEN c_nationkey < 10 THEN 'low' ELSE 'high' END AS project_file FROM customer",
)
def folder_xml(spark, sf_dir):
    """A folder of two XML tables whose records differ in their columns."""
    root = scratch_path(spark, "folder")
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("@id"), F.col("c_name").alias("Name"), "c_mktsegment", "c_nationkey")
    low = customer.filter("c_nationkey < 10").select("@id", "Name", F.col("c_mktsegment").alias("Segment"))
    high = customer.filter("c_nationkey >= 10").select("@id", "Name", F.col("c_nationkey").alias("Nation"))
    for name, rows in (("low", low), ("high", high)):
        rows.write.xml(f"{root}/{name}.xml", rootTag="Customers", rowTag="Customer", attributePrefix="@")
    return read_folder(spark, root, "xml", record="customer").select("id", "Name", "Segment", "Nation", "project_file")
