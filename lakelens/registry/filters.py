"""One query per filter operator, and the flagship: open orders above an amount."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakelens.functions.predicates import where
from lakelens.functions.text import cell_text
from lakelens.operators.project import project_existing
from lakelens.registry.base import query, table


@query(
    "open_orders_over",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'O' AND o_totalprice > 1000",
)
def open_orders_over(spark, sf_dir):
    rows = where(table(spark, sf_dir, "orders"), [("o_orderstatus", "eq", "o"), ("o_totalprice", "gt", "1000")])
    return project_existing(rows, ["o_orderkey", "o_custkey", "o_totalprice"])


# name: (table, kept columns, conditions, SQL condition)
SIMPLE = {
    "filter_eq": ("orders", "o_orderkey, o_orderpriority", [("o_orderpriority", "=", "1-urgent")],
                  "upper(o_orderpriority) = '1-URGENT'"),
    "filter_gt": ("orders", "o_orderkey, o_custkey", [("o_custkey", "gt", "100.5")], "o_custkey > 100.5"),
    "filter_gte": ("lineitem", "l_orderkey, l_quantity", [("l_quantity", ">=", "25")], "l_quantity >= 25"),
    "filter_lt": ("lineitem", "l_orderkey, l_linenumber", [("l_linenumber", "<", "2.5")], "l_linenumber < 2.5"),
    "filter_lte": ("lineitem", "l_orderkey, l_discount", [("l_discount", "lte", "0.05")], "l_discount <= 0.05"),
    "filter_contains": ("part", "p_partkey, p_name", [("p_name", "contains", "RI")], "contains(upper(p_name), 'RI')"),
    "filter_startswith": ("part", "p_partkey, p_type", [("P_TYPE", "startswith", "eco")],
                          "starts_with(upper(p_type), 'ECO')"),
    "filter_endswith": ("customer", "c_custkey, c_name", [("c_name", "endswith", "07")], "ends_with(c_name, '07')"),
    "filter_and": (
        "lineitem", "l_orderkey, l_partkey",
        [("l_returnflag", "eq", "r"), ("l_quantity", "gt", "10"), ("l_shipdate", "lt", "1998-01-01"),
         ("l_discount", "ne", "0")],
        "l_returnflag = 'R' AND l_quantity > 10 AND l_shipdate < TIMESTAMP '1998-01-01' AND l_discount <> 0",
    ),
    "filter_timestamp": (
        "events", "event_id, ts", [("ts", "gte", "2024-01-10T12:00:00+02:00"), ("ts", "lt", "01/20/2024 06:30")],
        "ts >= TIMESTAMP '2024-01-10 10:00:00' AND ts < TIMESTAMP '2024-01-20 06:30:00'",
    ),
    "filter_text_order": ("part", "p_partkey, p_brand", [("p_brand", "gt", "brand#2_")], "upper(p_brand) > 'BRAND#2_'"),
    "filter_number_text": ("orders", "o_orderkey, o_custkey", [("o_custkey", "contains", "77")],
                           "contains(CAST(o_custkey AS VARCHAR), '77')"),
}


def _register(name: str, source: str, columns: str, conditions: list, condition: str) -> None:
    @query(name, f"SELECT {columns} FROM {source} WHERE {condition}")
    def run(spark, sf_dir):
        return where(table(spark, sf_dir, source), conditions).select(*columns.split(", "))


for _name, _spec in SIMPLE.items():
    _register(_name, *_spec)

# The tables hold no NULL and no empty text, so both are derived from the order priority.
GAPS = (
    "SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN NULL WHEN o_orderpriority = '1-URGENT' THEN '' "
    "ELSE o_orderpriority END AS priority FROM orders"
)


def _with_gaps(spark, sf_dir):
    given = F.col("o_orderpriority")
    priority = F.when(given == "5-LOW", F.lit(None)).when(given == "1-URGENT", F.lit("")).otherwise(given)
    return table(spark, sf_dir, "orders").select("o_orderkey", priority.alias("priority"))


@query("filter_ne", f"SELECT * FROM ({GAPS}) WHERE priority IS DISTINCT FROM '2-HIGH'")
def filter_ne(spark, sf_dir):
    return where(_with_gaps(spark, sf_dir), [("priority", "ne", "2-high")])


@query("filter_isnull", f"SELECT * FROM ({GAPS}) WHERE priority IS NULL OR priority = ''")
def filter_isnull(spark, sf_dir):
    return where(_with_gaps(spark, sf_dir), [("priority", "isnull")])


@query("filter_isnotnull", f"SELECT * FROM ({GAPS}) WHERE priority <> ''")
def filter_isnotnull(spark, sf_dir):
    return where(_with_gaps(spark, sf_dir), [("priority", "isnotnull")])


MIXED = (
    "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority "
    "WHEN o_orderkey % 3 = 1 THEN CAST(o_custkey AS VARCHAR) ELSE ' 1,' || CAST(o_custkey AS VARCHAR) || '.50 ' END "
    "AS cell FROM orders"
)


@query(
    "filter_dynamic_numeric",
    "SELECT o_orderkey, cell FROM (SELECT *, try_cast(trim(replace(cell, ',', '')) AS DECIMAL(28, 10)) AS number "
    f"FROM ({MIXED})) WHERE CASE WHEN number IS NOT NULL THEN number > 100 ELSE upper(cell) > '1E2' END",
)
def filter_dynamic_numeric(spark, sf_dir):
    customer = F.col("o_custkey").cast("string")
    third = F.col("o_orderkey") % 3
    cell = (
        F.when(third == 0, F.col("o_orderpriority"))
        .when(third == 1, customer)
        .otherwise(F.concat(F.lit(" 1,"), customer, F.lit(".50 ")))
    )
    mixed = table(spark, sf_dir, "orders").select("o_orderkey", cell.alias("cell"))
    return where(mixed, [("cell", "gt", "1e2")])


@query(
    "cell_text_types",
    "SELECT l_orderkey, l_linenumber, regexp_replace(CAST(l_extendedprice AS VARCHAR), '\\.0$', '') AS price, "
    "CASE WHEN l_quantity / 1000000 >= 0.0001 THEN 'plain' ELSE regexp_replace(replace(CAST(l_quantity / 1000000 AS VARCHAR), '.0e', 'e'), 'e', 'E') END AS small, "
    "strftime(l_shipdate, '%m/%d/%Y %H:%M:%S') AS shipped, CAST(l_discount > 0.05 AS VARCHAR) AS cheap FROM lineitem",
)
def cell_text_types(spark, sf_dir):
    """Reals, plain and with an exponent, timestamps and booleans as the text that filters compare."""
    rows = table(spark, sf_dir, "lineitem").withColumn("cheap", F.col("l_discount") > 0.05).withColumn("small", F.col("l_quantity") / 1000000)
    types = {field.name: field.dataType for field in rows.schema.fields}
    text = lambda name: cell_text(F.col(name), types[name])
    small = F.when(F.col("small") >= 0.0001, F.lit("plain")).otherwise(text("small"))
    return rows.select(
        "l_orderkey", "l_linenumber", text("l_extendedprice").alias("price"), small.alias("small"), text("l_shipdate").alias("shipped"), text("cheap").alias("cheap")
    )
