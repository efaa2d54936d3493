"""Earned value per project at its cutoff date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakelens.plans.measures import ratio
from lakelens.plans.model import PROJECT, CostModel

CUTOFF = "CutoffDate"


def _daily_amounts(model: CostModel) -> DataFrame:
    """Planned, actual and earned amounts per project and date: one shuffle of partial sums."""
    planned = model.requirements.select(PROJECT, "Date", F.col("CostAmount").alias("planned"))
    actual = model.accountings.select(
        PROJECT, "Date", F.col("CostAmount").alias("actual"), F.col(model.ev_column).alias("earned")
    )
    rows = planned.unionByName(actual, allowMissingColumns=True)
    return rows.groupBy(PROJECT, "Date").agg(*[F.sum(name).alias(name) for name in ("planned", "actual", "earned")])


def evm(model: CostModel) -> DataFrame:
    """PV, AC and EV up to the cutoff, BAC over all time, and CPI, SPI, EAC, VAC for every project.

    The amounts meet the cutoff dates once, after being summed per project and date. A project without a cutoff has
    NULL everywhere but in BAC. VAC is EAC - BAC, so above zero the project overruns.
    """
    projects = model.projects.select(PROJECT, CUTOFF).distinct()
    due = F.col("Date") <= F.col(CUTOFF)
    whole = projects.join(_daily_amounts(model), PROJECT, "left").groupBy(PROJECT, CUTOFF).agg(
        F.sum("planned").alias("bac"),
        F.sum(F.when(due, F.col("planned"))).alias("pv"),
        F.sum(F.when(due, F.col("actual"))).alias("ac"),
        F.sum(F.when(due, F.col("earned"))).alias("ev"),
    )
    estimated = whole.withColumn("eac", F.col("ac") + (F.col("bac") - F.col("ev")))
    return estimated.withColumns(
        {"cpi": ratio("ev", "ac"), "spi": ratio("ev", "pv"), "vac": F.col("eac") - F.col("bac")}
    )


def critical_flags(indices: DataFrame) -> DataFrame:
    """Whether CPI or SPI is below 1; NULL where the index is."""
    return indices.select(
        PROJECT,
        (F.col("cpi") < 1).alias("cost_critical"),
        (F.col("spi") < 1).alias("schedule_critical"),
        ((F.col("cpi") < 1) | (F.col("spi") < 1)).alias("critical"),
    )


def missing_cutoff(projects: DataFrame) -> DataFrame:
    """Projects for which earned value cannot be computed."""
    return projects.filter(F.col(CUTOFF).isNull())
