"""Cost, revenue and margin measures.

Facts are never joined with each other: each is narrowed to its keys and amounts, the narrow rows are
unioned and one grouped sum gives every measure. Partial sums leave at most one row per key and task to
shuffle, so a project with a third of all rows is no heavier than the rest.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelens.plans.model import PROJECT, CostModel

# The documented measures, as (table, amount column).
MEASURES = {
    "actual_cost": ("accountings", "CostAmount"),
    "planned_cost": ("requirements", "CostAmount"),
    "committed_cost": ("orders", "CostAmount"),
    "requested_cost": ("purchase_requests", "CostAmount"),
    "revenue_external": ("accountings", "JPSAmount"),
    "revenue_internal": ("accountings", "JISAmount"),
    "quantity_external": ("accountings", "JPSQuantity"),
    "quantity_internal": ("accountings", "JISQuantity"),
    "planned_revenue": ("requirements", "EarnAmount"),
}
CERTIFICATE_AMOUNTS = [
    "NetAmount",
    "RoundedAmount",
    "RoundedWithVatAmount",
    "GrossAmount",
    "AnticipationRecoveryAmount",
    "WorkersInsuranceAmount",
    "WithholdingdGuaranteeAmount",
    "AccountingRevisionAmount",
    "DefinitiveAccountingRevisionAmount",
    "Open1Amount",
    "Open2Amount",
    "Open3Amount",
]


def _key(table: DataFrame, name: str, period: str) -> Column:
    """A key column; tables with several dates name their periods after them."""
    own = name if name in table.columns or name not in ("Date", "Month", "Year") else period + name
    return F.col(own).alias(name)


def totals(
    model: CostModel, measures: list[str], keys: list[str] | None = None, request_period: str = "Creation"
) -> DataFrame:
    """Sums of the named measures per key, over all rows of their tables; NULL where a table has no row.

    The date, month and year of a purchase request are those of its creation, or with `request_period`
    "Delivery" those of its delivery.
    """
    keys = [PROJECT] if keys is None else keys
    by_table: dict[str, dict[str, str]] = {}
    for measure in measures:
        table, amount = MEASURES[measure]
        by_table.setdefault(table, {})[measure] = amount
    narrow = [
        facts.select(*[_key(facts, key, request_period) for key in keys], *[F.col(amount).alias(name) for name, amount in wanted.items()])
        for facts, wanted in ((getattr(model, table), wanted) for table, wanted in by_table.items())
    ]
    rows = reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), narrow)
    return rows.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in measures])


def _zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def margin_actual(model: CostModel, keys: list[str] | None = None) -> DataFrame:
    """External revenue minus actual cost."""
    sums = totals(model, ["revenue_external", "actual_cost"], keys)
    return sums.withColumn("margin", _zero("revenue_external") - _zero("actual_cost"))


def margin_planned(model: CostModel, keys: list[str] | None = None) -> DataFrame:
    """Planned revenue minus planned cost."""
    sums = totals(model, ["planned_revenue", "planned_cost"], keys)
    return sums.withColumn("margin", _zero("planned_revenue") - _zero("planned_cost"))


def ratio(numerator: str, denominator: str) -> Column:
    """Quotient to six decimals; NULL when the denominator is zero or absent."""
    return F.round(F.try_divide(F.col(numerator).cast("double"), F.col(denominator).cast("double")), 6)


def cost_progress(model: CostModel, keys: list[str] | None = None) -> DataFrame:
    """Actual cost in percent of planned cost."""
    sums = totals(model, ["actual_cost", "planned_cost"], keys)
    percent = F.try_divide(F.col("actual_cost").cast("double"), F.col("planned_cost").cast("double")) * 100
    return sums.withColumn("progress_pct", F.round(percent, 6))


def variance_three_way(model: CostModel, keys: list[str] | None = None) -> DataFrame:
    """Planned, committed and actual cost with their three differences; an absent side counts as zero."""
    sums = totals(model, ["planned_cost", "committed_cost", "actual_cost"], keys)
    return sums.withColumns(
        {
            "planned_vs_actual": _zero("planned_cost") - _zero("actual_cost"),
            "planned_vs_committed": _zero("planned_cost") - _zero("committed_cost"),
            "committed_vs_actual": _zero("committed_cost") - _zero("actual_cost"),
        }
    )


def certificate_totals(certificates: DataFrame, amounts: list[str] | None = None) -> DataFrame:
    """Amounts per project and certificate type, for those amount columns the table has."""
    wanted = amounts or [name for name in CERTIFICATE_AMOUNTS if name in certificates.columns]
    return certificates.groupBy(PROJECT, "CertificateType").agg(
        F.count("*").alias("certificates"), *[F.sum(name).alias(name) for name in wanted]
    )
