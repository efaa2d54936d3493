"""The project-control measures on a small hand-made model, and the shape of their plans."""

from __future__ import annotations

import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakelens.plans import measures
from lakelens.plans.evm import critical_flags, evm, missing_cutoff
from lakelens.plans.model import CostModel, in_projects, project_ids, read_folder, read_model, scoped, with_dimensions

DAY = dt.date


@pytest.fixture(scope="module")
def model(spark):
    def frame(rows, schema):
        return spark.createDataFrame(rows, schema)

    fact = "ProjectId string, ProductId int, WorkBreakdownElementId int, Date date, "
    money = "decimal(12,2)"
    return CostModel(
        projects=frame(
            [("g1", "Alfa", DAY(2024, 6, 30)), ("g2", "Beta", None), ("g3", "Gamma", DAY(2024, 1, 1))],
            "ProjectId string, MnemoncId string, CutoffDate date",
        ),
        products=frame([(1, "brick"), (2, "sand")], "ProductId int, Description string"),
        work_breakdown_elements=frame([(7, "roof")], "WorkBreakdownElementId int, Description string"),
        requirements=frame(
            [
                ("g1", 1, 7, DAY(2024, 5, 1), Decimal(100), Decimal(150)),
                ("g1", 2, 7, DAY(2024, 6, 30), Decimal(50), Decimal(60)),
                ("g1", 2, 8, DAY(2024, 7, 1), Decimal(50), Decimal(40)),
                ("g2", 1, 7, DAY(2024, 5, 1), Decimal(30), Decimal(35)),
            ],
            fact + f"CostAmount {money}, EarnAmount {money}",
        ),
        orders=frame([("g1", Decimal(80)), ("g4", Decimal(5))], f"ProjectId string, CostAmount {money}"),
        accountings=frame(
            [
                ("g1", 1, 7, DAY(2024, 5, 3), Decimal(120), Decimal(130), Decimal(10), Decimal(90)),
                ("g1", 9, 7, DAY(2024, 8, 3), Decimal(20), Decimal(25), Decimal(5), Decimal(10)),
                ("g2", 1, 7, DAY(2024, 5, 3), Decimal(10), Decimal(0), Decimal(0), Decimal(1)),
            ],
            fact + f"CostAmount {money}, JPSAmount {money}, JISAmount {money}, EVAmount {money}",
        ),
        purchase_requests=frame([("g1", Decimal(3))], f"ProjectId string, CostAmount {money}"),
        certificates=frame(
            [("g1", "A", Decimal(5), Decimal(6)), ("g1", "A", Decimal(7), Decimal(8)), ("g1", "B", Decimal(1), None)],
            f"ProjectId string, CertificateType string, NetAmount {money}, GrossAmount {money}",
        ),
    )


def by_project(df):
    return {row["ProjectId"]: row.asDict() for row in df.collect()}


def test_earned_value(model):
    rows = by_project(evm(model))
    first = rows["g1"]
    assert [first[n] for n in ("bac", "pv", "ac", "ev", "eac", "vac")] == [200, 150, 120, 90, 230, 30]
    assert (first["cpi"], first["spi"]) == (0.75, 0.6)
    assert rows["g2"]["bac"] == 30 and all(rows["g2"][n] is None for n in ("pv", "ac", "ev", "eac", "cpi", "spi"))
    assert rows["g3"]["bac"] is None
    flags = by_project(critical_flags(evm(model)))
    assert flags["g1"]["critical"] is True and flags["g2"]["critical"] is None
    assert [r["ProjectId"] for r in missing_cutoff(model.projects).collect()] == ["g2"]


def test_measures(model):
    assert by_project(measures.margin_actual(model))["g1"]["margin"] == 15
    assert by_project(measures.margin_planned(model))["g1"]["margin"] == 50
    assert by_project(measures.cost_progress(model))["g1"]["progress_pct"] == 70
    variance = by_project(measures.variance_three_way(model))
    assert variance["g1"]["planned_vs_actual"] == 60 and variance["g1"]["committed_vs_actual"] == -60
    assert variance["g4"]["planned_cost"] is None and variance["g4"]["committed_vs_actual"] == 5
    certificates = measures.certificate_totals(model.certificates).orderBy("CertificateType").collect()
    assert [(r.certificates, r.NetAmount, r.GrossAmount) for r in certificates] == [(2, 12, 14), (1, 1, None)]


def test_scope(model):
    assert {r["ProjectId"] for r in project_ids(model.projects, ["ALFA", "nope"]).collect()} == {"g1"}
    assert in_projects(model.orders, project_ids(model.projects, ["none"])).count() == 0
    assert set(by_project(measures.totals(scoped(model, ["beta"]), ["planned_cost"]))) == {"g2"}


def test_several_projects(model):
    ids = project_ids(model.projects, ["alfa", "beta"])
    assert in_projects(model.requirements, ids).count() == 4


def test_dimensions_keep_every_fact_row(model):
    columns = {"products": {"Description": "product"}, "projects": {"MnemoncId": "code"}}
    rows = with_dimensions(model.accountings, model, columns).select("ProductId", "product", "code").collect()
    assert sorted(map(tuple, rows), key=str) == [(1, "brick", "Alfa"), (1, "brick", "Beta"), (9, None, "Alfa")]


def test_folder_of_projects(spark, lake_file):
    lake_file("g 1.csv", "ProjectId;CostAmount\ng1;5\n", "Orders")
    folder = lake_file("g2.csv", "ProjectId;CostAmount\ng2;7\ng2;8\n", "Orders").rsplit("/", 1)[0]
    rows = read_folder(spark, folder)
    assert sorted(map(tuple, rows.collect())) == [("g1", "5", "g 1"), ("g2", "7", "g2"), ("g2", "8", "g2")]
    assert read_folder(spark, folder, files=["g2"]).count() == 2


def test_model_from_folders(spark, lake_file):
    facts = "ProjectId;ProductId;WorkBreakdownElementId;Date;Month;Year;CostAmount"
    lake_file("g1.csv", "ProjectId;MnemoncId;CutoffDate\ng1;Alfa;2024-06-30\n", "Projects")
    lake_file("g2.csv", "ProjectId;MnemoncId;CutoffDate\ng2;Beta;\n", "Projects")
    lake_file("g1.csv", "ProductId;Description;PlannedUnitCost;IsSafetyBurden\n1;brick;2.5;True\n", "Products")
    lake_file("g1.csv", "WorkBreakdownElementId;Description\n7;roof\n", "WorkBreakdownElements")
    lake_file("g1.csv", f"{facts};EarnAmount\ng1;1;7;05/01/2024 00:00:00;5;2024;100.25;150\n", "BuildingRequirements")
    lake_file("g2.csv", f"{facts};EarnAmount\ng2;1;7;2024-05-01;5;2024;30;\n", "BuildingRequirements")
    lake_file("g1.csv", f"{facts}\ng1;1;7;2024-05-01;5;2024;80\n", "Orders")
    lake_file("g1.csv", f"{facts};JPSAmount;EVAmount\ng1;1;7;2024-05-03T08:00:00;5;2024;120;130;90\n", "EarnCostAccountings")
    lake_file("g1.csv", "ProjectId;CreationDate;CostAmount\ng1;2024-01-01;3\n", "PurchaseRequests")
    path = lake_file("g1.csv", "ProjectId;CertificateType;NetAmount\ng1;A;5\n", "PaymentCertificates")
    found = read_model(spark, path.rsplit("/", 2)[0])
    first = by_project(evm(found))["g1"]
    assert [first[n] for n in ("bac", "pv", "ac", "ev")] == [Decimal("100.25"), Decimal("100.25"), 120, 90]
    assert by_project(measures.totals(found, ["planned_revenue"]))["g2"]["planned_revenue"] is None
    assert found.products.first().IsSafetyBurden is True
    only = read_model(spark, path.rsplit("/", 2)[0], projects=["g2"])
    assert set(by_project(measures.totals(only, ["planned_cost"]))) == {"g2"}


def test_hot_product_is_split(spark, model):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    previous = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        hot = F.when(F.col("id") % 3 < 2, F.lit(1)).otherwise((F.col("id") % 1000).cast("int"))
        fact = spark.range(0, 60_000, 1, 8).select(hot.alias("ProductId"), F.uuid().alias("note"))
        joined = with_dimensions(fact, model, {"products": {"Description": "product"}})
        assert len(joined.collect()) == 60_000
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"SortMergeJoin.*skew=true", plan)
    finally:
        for name, value in previous.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_facts_are_summed_before_they_meet(model, capsys):
    measures.variance_three_way(model).explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange") == 1 and "Join" not in plan
