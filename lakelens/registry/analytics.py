"""The project-control measures on tables derived from the test data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakelens.plans import measures
from lakelens.plans.evm import critical_flags, evm, missing_cutoff
from lakelens.plans.model import CostModel, in_projects, project_ids, scoped, with_dimensions
from lakelens.registry.base import plain, query, table


def _money(name: str) -> Column:
    return F.col(name).cast("decimal(12,2)")


def _share(name: str, factor: str) -> Column:
    return F.round(_money(name) * F.lit(factor).cast("decimal(4,2)"), 2)


def cost_model(spark, sf_dir) -> CostModel:
    """Projects are nations, products parts, work breakdown elements suppliers."""
    nation, customer = table(spark, sf_dir, "nation"), table(spark, sf_dir, "customer")
    orders, lineitem = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    key = F.col("n_nationkey")
    cutoff = F.when(key % 10 != 9, F.date_add(F.lit("1998-06-30").cast("date"), key * 10))
    placed = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    items = lineitem.join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
    keys = [
        F.col("c_nationkey").alias("ProjectId"),
        F.col("l_partkey").alias("ProductId"),
        F.col("l_suppkey").alias("WorkBreakdownElementId"),
    ]
    ordered, shipped = F.col("o_orderdate").cast("date"), F.col("l_shipdate").cast("date")
    price = F.col("l_extendedprice")
    kept = F.lit(1).cast("decimal(4,2)") - F.col("l_discount").cast("decimal(4,2)")

    def dated(day: Column, of: str = "") -> list[Column]:
        return [day.alias(f"{of}Date"), F.year(day).alias(f"{of}Year"), F.month(day).alias(f"{of}Month")]

    order_keys = [
        F.col("c_nationkey").alias("ProjectId"),
        F.col("o_custkey").alias("ProductId"),
        (F.col("o_custkey") % 20).alias("WorkBreakdownElementId"),
    ]

    return CostModel(
        projects=nation.select(key.alias("ProjectId"), F.col("n_name").alias("MnemoncId"), cutoff.alias("CutoffDate")),
        products=table(spark, sf_dir, "part").select(F.col("p_partkey").alias("ProductId"), F.col("p_name").alias("Description")),
        work_breakdown_elements=table(spark, sf_dir, "supplier").select(
            F.col("s_suppkey").alias("WorkBreakdownElementId"), F.col("s_name").alias("Description")
        ),
        requirements=items.select(
            *keys, *dated(ordered), _money("l_extendedprice").alias("CostAmount"),
            _share("l_extendedprice", "1.20").alias("EarnAmount"),
        ),
        orders=placed.select(
            *order_keys, *dated(ordered), _money("o_totalprice").alias("CostAmount"),
            F.col("o_orderkey").alias("MnemonicId"),
        ),
        accountings=items.filter(F.col("l_linestatus") == "F").select(
            *keys, *dated(shipped), F.round(price.cast("decimal(12,2)") * kept, 2).alias("CostAmount"),
            _share("l_extendedprice", "1.10").alias("JPSAmount"), _money("l_extendedprice").alias("JISAmount"),
            _money("l_quantity").alias("JPSQuantity"), _money("l_quantity").alias("JISQuantity"),
            _money("l_extendedprice").alias("EVAmount"),
        ),
        purchase_requests=placed.filter(F.col("o_orderstatus") == "P").select(
            *order_keys, *dated(ordered, "Creation"), *dated(F.date_add(ordered, 40), "Delivery"),
            _money("o_totalprice").alias("CostAmount"),
        ),
        certificates=placed.select(
            F.col("c_nationkey").alias("ProjectId"), F.col("o_orderpriority").alias("CertificateType"),
            _money("o_totalprice").alias("NetAmount"), _share("o_totalprice", "1.22").alias("GrossAmount"),
        ),
    )


MODEL = """
WITH placed AS (SELECT * FROM orders JOIN customer ON o_custkey = c_custkey),
items AS (SELECT * FROM lineitem JOIN placed ON l_orderkey = o_orderkey),
project AS (SELECT n_nationkey AS ProjectId, n_name AS MnemoncId, CASE WHEN n_nationkey % 10 <> 9
  THEN DATE '1998-06-30' + CAST(n_nationkey * 10 AS INTEGER) END AS CutoffDate FROM nation),
requirement AS (SELECT c_nationkey AS ProjectId, l_partkey AS ProductId, l_suppkey AS WorkBreakdownElementId,
  CAST(o_orderdate AS DATE) AS Date,
  CAST(l_extendedprice AS DECIMAL(18, 2)) AS CostAmount,
  round(CAST(l_extendedprice AS DECIMAL(18, 2)) * CAST(1.20 AS DECIMAL(4, 2)), 2) AS EarnAmount FROM items),
committed AS (SELECT c_nationkey AS ProjectId, o_custkey AS ProductId, o_custkey % 20 AS WorkBreakdownElementId,
  CAST(o_totalprice AS DECIMAL(18, 2)) AS CostAmount,
  o_orderkey AS MnemonicId FROM placed),
accounting AS (SELECT c_nationkey AS ProjectId, l_partkey AS ProductId, l_suppkey AS WorkBreakdownElementId,
  CAST(l_shipdate AS DATE) AS Date,
  round(CAST(l_extendedprice AS DECIMAL(18, 2)) * (CAST(1 AS DECIMAL(4, 2)) - CAST(l_discount AS DECIMAL(4, 2))), 2) AS CostAmount,
  round(CAST(l_extendedprice AS DECIMAL(18, 2)) * CAST(1.10 AS DECIMAL(4, 2)), 2) AS JPSAmount,
  CAST(l_extendedprice AS DECIMAL(18, 2)) AS JISAmount, CAST(l_quantity AS DECIMAL(18, 2)) AS Quantity,
  CAST(l_extendedprice AS DECIMAL(18, 2)) AS EVAmount FROM items WHERE l_linestatus = 'F'),
request AS (SELECT c_nationkey AS ProjectId, o_custkey AS ProductId, o_custkey % 20 AS WorkBreakdownElementId,
  CAST(o_orderdate AS DATE) AS CreationDate, CAST(o_orderdate AS DATE) + 40 AS DeliveryDate,
  CAST(o_totalprice AS DECIMAL(18, 2)) AS CostAmount FROM placed
  WHERE o_orderstatus = 'P'),
certificate AS (SELECT c_nationkey AS ProjectId, o_orderpriority AS CertificateType,
  CAST(o_totalprice AS DECIMAL(18, 2)) AS NetAmount,
  round(CAST(o_totalprice AS DECIMAL(18, 2)) * CAST(1.22 AS DECIMAL(4, 2)), 2) AS GrossAmount FROM placed)
"""


def _sum(amount: str, name: str) -> str:
    return f"CAST(sum({amount}) AS DOUBLE) AS {name}"


def _register_total(name: str, wanted: list[str], source: str, sums: list[str]) -> None:
    @query(name, f"{MODEL} SELECT ProjectId, {', '.join(sums)} FROM {source} GROUP BY ProjectId")
    def run(spark, sf_dir):
        return plain(measures.totals(cost_model(spark, sf_dir), wanted))


_register_total("agg_actual_cost", ["actual_cost"], "accounting", [_sum("CostAmount", "actual_cost")])
_register_total("agg_planned_cost", ["planned_cost"], "requirement", [_sum("CostAmount", "planned_cost")])
_register_total("agg_committed_cost", ["committed_cost"], "committed", [_sum("CostAmount", "committed_cost")])
_register_total("agg_requested_cost", ["requested_cost"], "request", [_sum("CostAmount", "requested_cost")])
_register_total("agg_planned_revenue", ["planned_revenue"], "requirement", [_sum("EarnAmount", "planned_revenue")])
_register_total(
    "agg_revenue",
    ["revenue_external", "revenue_internal", "quantity_external", "quantity_internal"],
    "accounting",
    [_sum("JPSAmount", "revenue_external"), _sum("JISAmount", "revenue_internal"),
     _sum("Quantity", "quantity_external"), _sum("Quantity", "quantity_internal")],
)


@query(
    "margin_actual",
    f"{MODEL} SELECT ProjectId, {_sum('JPSAmount', 'revenue_external')}, {_sum('CostAmount', 'actual_cost')}, "
    "CAST(sum(JPSAmount) - sum(CostAmount) AS DOUBLE) AS margin FROM accounting GROUP BY ProjectId",
)
def margin_actual(spark, sf_dir):
    return plain(measures.margin_actual(cost_model(spark, sf_dir)))


@query(
    "margin_planned",
    f"{MODEL} SELECT ProjectId, {_sum('EarnAmount', 'planned_revenue')}, {_sum('CostAmount', 'planned_cost')}, "
    "CAST(sum(EarnAmount) - sum(CostAmount) AS DOUBLE) AS margin FROM requirement GROUP BY ProjectId",
)
def margin_planned(spark, sf_dir):
    return plain(measures.margin_planned(cost_model(spark, sf_dir)))


SUMS = (
    MODEL
    + ", planned AS (SELECT ProjectId, sum(CostAmount) AS p FROM requirement GROUP BY ProjectId), "
    "actual AS (SELECT ProjectId, sum(CostAmount) AS a FROM accounting GROUP BY ProjectId), "
    "ordered AS (SELECT ProjectId, sum(CostAmount) AS c FROM committed GROUP BY ProjectId), "
    "sides AS (SELECT ProjectId, p, c, a FROM planned FULL JOIN ordered USING (ProjectId) FULL JOIN actual USING (ProjectId))"
)


@query(
    "cost_progress_pct",
    f"{SUMS} SELECT ProjectId, CAST(a AS DOUBLE) AS actual_cost, CAST(p AS DOUBLE) AS planned_cost, "
    "round(CAST(a AS DOUBLE) / nullif(CAST(p AS DOUBLE), 0) * 100, 6) AS progress_pct FROM sides "
    "WHERE a IS NOT NULL OR p IS NOT NULL",
)
def cost_progress_pct(spark, sf_dir):
    return plain(measures.cost_progress(cost_model(spark, sf_dir)))


@query(
    "variance_3way",
    f"{SUMS} SELECT ProjectId, CAST(p AS DOUBLE) AS planned_cost, CAST(c AS DOUBLE) AS committed_cost, "
    "CAST(a AS DOUBLE) AS actual_cost, CAST(coalesce(p, 0) - coalesce(a, 0) AS DOUBLE) AS planned_vs_actual, "
    "CAST(coalesce(p, 0) - coalesce(c, 0) AS DOUBLE) AS planned_vs_committed, "
    "CAST(coalesce(c, 0) - coalesce(a, 0) AS DOUBLE) AS committed_vs_actual FROM sides",
)
def variance_3way(spark, sf_dir):
    return plain(measures.variance_three_way(cost_model(spark, sf_dir)))


EVM = (
    MODEL
    + ", plan AS (SELECT ProjectId, sum(CostAmount) AS bac, sum(CostAmount) FILTER (Date <= CutoffDate) AS pv "
    "FROM requirement JOIN project USING (ProjectId) GROUP BY ProjectId), "
    "done AS (SELECT ProjectId, sum(CostAmount) FILTER (Date <= CutoffDate) AS ac, "
    "sum(EVAmount) FILTER (Date <= CutoffDate) AS ev FROM accounting JOIN project USING (ProjectId) GROUP BY ProjectId), "
    "earned AS (SELECT ProjectId, CutoffDate, bac, pv, ac, ev, ac + (bac - ev) AS eac, "
    "round(CAST(ev AS DOUBLE) / nullif(CAST(ac AS DOUBLE), 0), 6) AS cpi, "
    "round(CAST(ev AS DOUBLE) / nullif(CAST(pv AS DOUBLE), 0), 6) AS spi "
    "FROM project LEFT JOIN plan USING (ProjectId) LEFT JOIN done USING (ProjectId))"
)


@query(
    "evm",
    EVM + " SELECT ProjectId, CAST(CutoffDate AS VARCHAR) AS CutoffDate, "
    + ", ".join(f"CAST({name} AS DOUBLE) AS {name}" for name in ("bac", "pv", "ac", "ev", "eac"))
    + ", cpi, spi, CAST(eac - bac AS DOUBLE) AS vac FROM earned",
)
def earned_value(spark, sf_dir):
    return plain(evm(cost_model(spark, sf_dir)).withColumn("CutoffDate", F.col("CutoffDate").cast("string")))


@query(
    "evm_flags",
    EVM + " SELECT ProjectId, cpi < 1 AS cost_critical, spi < 1 AS schedule_critical, cpi < 1 OR spi < 1 AS critical "
    "FROM earned",
)
def evm_flags(spark, sf_dir):
    return critical_flags(evm(cost_model(spark, sf_dir)))


@query("missing_cutoff", MODEL + " SELECT ProjectId, MnemoncId FROM project WHERE CutoffDate IS NULL")
def projects_without_cutoff(spark, sf_dir):
    return missing_cutoff(cost_model(spark, sf_dir).projects).select("ProjectId", "MnemoncId")


@query(
    "project_lookup",
    MODEL + " SELECT ProjectId, MnemonicId, CAST(CostAmount AS DOUBLE) AS CostAmount FROM committed "
    "JOIN project USING (ProjectId) WHERE MnemoncId = 'NATION_7'",
)
def project_lookup(spark, sf_dir):
    model = cost_model(spark, sf_dir)
    rows = in_projects(model.orders, project_ids(model.projects, ["nation_7"]))
    return plain(rows.select("ProjectId", "MnemonicId", "CostAmount"))


@query(
    "project_scope",
    f"{SUMS} SELECT ProjectId, CAST(p AS DOUBLE) AS planned_cost, CAST(a AS DOUBLE) AS actual_cost FROM sides "
    "WHERE ProjectId IN (1, 3, 5)",
)
def project_scope(spark, sf_dir):
    model = scoped(cost_model(spark, sf_dir), ["NATION_1", "NATION_3", "nation_5"])
    return plain(measures.totals(model, ["planned_cost", "actual_cost"]))


def _register_dimensions(name: str, fact: str, source: str) -> None:
    @query(
        name,
        MODEL + " SELECT ProjectId, ProductId, WorkBreakdownElementId, CAST(CostAmount AS DOUBLE) AS CostAmount, "
        f"MnemoncId AS project, p_name AS product, s_name AS element FROM {source} LEFT JOIN project USING (ProjectId) "
        "LEFT JOIN part ON p_partkey = ProductId LEFT JOIN supplier ON s_suppkey = WorkBreakdownElementId",
    )
    def run(spark, sf_dir):
        model = cost_model(spark, sf_dir)
        rows = getattr(model, fact).select("ProjectId", "ProductId", "WorkBreakdownElementId", "CostAmount")
        columns = {
            "projects": {"MnemoncId": "project"},
            "products": {"Description": "product"},
            "work_breakdown_elements": {"Description": "element"},
        }
        return plain(with_dimensions(rows, model, columns))


_register_dimensions("join_dims", "accountings", "accounting")
_register_dimensions("join_dims_requirements", "requirements", "requirement")
_register_dimensions("join_dims_orders", "orders", "committed")
_register_dimensions("join_dims_requests", "purchase_requests", "request")


@query(
    "join_dims_certificates",
    MODEL + " SELECT ProjectId, CertificateType, CAST(NetAmount AS DOUBLE) AS NetAmount, MnemoncId AS project "
    "FROM certificate LEFT JOIN project USING (ProjectId)",
)
def join_dims_certificates(spark, sf_dir):
    model = cost_model(spark, sf_dir)
    rows = model.certificates.select("ProjectId", "CertificateType", "NetAmount")
    return plain(with_dimensions(rows, model, {"projects": {"MnemoncId": "project"}}))


def _register_request_period(name: str, period: str) -> None:
    @query(
        name,
        MODEL + f" SELECT ProjectId, CAST(year({period}Date) AS INTEGER) AS \"Year\", "
        f"CAST(month({period}Date) AS INTEGER) AS \"Month\", {_sum('CostAmount', 'requested_cost')} FROM request GROUP BY ALL",
    )
    def run(spark, sf_dir):
        keys = ["ProjectId", "Year", "Month"]
        return plain(measures.totals(cost_model(spark, sf_dir), ["requested_cost"], keys, period))


_register_request_period("agg_requested_by_month", "Creation")
_register_request_period("agg_requested_by_delivery", "Delivery")


@query(
    "agg_by_month",
    MODEL + f" SELECT ProjectId, CAST(year(Date) AS INTEGER) AS \"Year\", CAST(month(Date) AS INTEGER) AS \"Month\", {_sum('CostAmount', 'actual_cost')}, "
    f"{_sum('JPSAmount', 'revenue_external')} FROM accounting GROUP BY ALL",
)
def agg_by_month(spark, sf_dir):
    keys = ["ProjectId", "Year", "Month"]
    return plain(measures.totals(cost_model(spark, sf_dir), ["actual_cost", "revenue_external"], keys))


@query(
    "agg_certificates",
    MODEL + f" SELECT ProjectId, CertificateType, count(*) AS certificates, {_sum('NetAmount', 'NetAmount')}, "
    f"{_sum('GrossAmount', 'GrossAmount')} FROM certificate GROUP BY ProjectId, CertificateType",
)
def agg_certificates(spark, sf_dir):
    return plain(measures.certificate_totals(cost_model(spark, sf_dir).certificates))


SHARES = {name: f"0.{i + 11}" for i, name in enumerate(measures.CERTIFICATE_AMOUNTS)}


@query(
    "agg_certificate_amounts",
    MODEL + "SELECT c_nationkey AS ProjectId, o_orderpriority AS CertificateType, count(*) AS certificates, "
    + ", ".join(f"CAST(sum(round(CAST(o_totalprice AS DECIMAL(18, 2)) * CAST({share} AS DECIMAL(4, 2)), 2)) AS DOUBLE) AS {name}" for name, share in SHARES.items())
    + " FROM placed GROUP BY c_nationkey, o_orderpriority",
)
def agg_certificate_amounts(spark, sf_dir):
    """All twelve amounts of a certificate, each another share of the price."""
    placed = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    amounts = [_share("o_totalprice", share).alias(name) for name, share in SHARES.items()]
    return plain(measures.certificate_totals(placed.select(F.col("c_nationkey").alias("ProjectId"), F.col("o_orderpriority").alias("CertificateType"), *amounts)))
