"""The project-control tables and how they relate.

Requirements hold planned cost and revenue, orders committed cost, accountings actual cost and revenue,
purchase requests requested cost. Every fact refers to projects, products and work breakdown elements;
certificates refer to projects only.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, fields, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelens.functions.text import fold, fold_literal
from lakelens.sources.csv import read_csv
from lakelens.sources.files import file_inventory
from lakelens.sources.parquet import read_parquet
from lakelens.sources.xml import read_xml, xml_columns
from lakelens.sources.position import FILE, user_columns

# Folder of each table in the documented lake.
FOLDERS = {
    "projects": "Projects",
    "products": "Products",
    "work_breakdown_elements": "WorkBreakdownElements",
    "requirements": "BuildingRequirements",
    "orders": "Orders",
    "accountings": "EarnCostAccountings",
    "purchase_requests": "PurchaseRequests",
    "certificates": "PaymentCertificates",
}
PROJECT = "ProjectId"
PRODUCT = "ProductId"
ELEMENT = "WorkBreakdownElementId"
# Type of amounts and quantities kept as text.
AMOUNT = "decimal(30,12)"


@dataclass(frozen=True)
class CostModel:
    """The eight tables; `ev_column` names the earned value among the accountings."""

    projects: DataFrame
    products: DataFrame
    work_breakdown_elements: DataFrame
    requirements: DataFrame
    orders: DataFrame
    accountings: DataFrame
    purchase_requests: DataFrame
    certificates: DataFrame
    ev_column: str = "EVAmount"


def read_folder(
    spark: SparkSession,
    path: str,
    format: str = "csv",
    delimiter: str = ";",
    files: Iterable[str] | None = None,
    record: str | None = None,
) -> DataFrame:
    """All files of a folder as one table, with `project_file`, the file's name without its extension.

    A saved table (a folder of part files) counts as one file. `files` keeps the named ones; they are chosen from
    the listing, and the others are not opened. XML files may differ in their columns: the table has those of every
    file's first record, NULL where a file lacks one.
    """
    whole = F.regexp_replace(F.col(FILE), "/part-[^/]*$", "")
    stem = F.regexp_replace(F.url_decode(F.element_at(F.split(whole, "/"), -1)), r"\.[^.]*$", "")
    chosen: str | list[str] = f"{path.rstrip('/')}/*"
    if files is not None:
        listed = file_inventory(spark, path).select(F.col("path").alias(FILE)).filter(stem.isin(list(files)))
        chosen = sorted(row[0] for row in listed.select(whole).distinct().collect()) or chosen
    if format == "csv":
        rows = read_csv(spark, chosen, delimiter=delimiter, multiline=None if files is None or isinstance(chosen, list) else False, position=True)
    elif format == "xml":
        rows = read_xml(spark, chosen, record, xml_columns(spark, chosen, record), position=True)
    else:
        rows = read_parquet(spark, chosen, position=True)
    if files is not None and not isinstance(chosen, list):
        rows = rows.limit(0)
    return rows.select(*[F.col(f"`{column}`") for column in user_columns(rows)], stem.alias("project_file"))


def _typed(name: str) -> Column:
    """A text cell as the type its column name stands for; text that does not fit fails the job."""
    cell = F.col(f"`{name}`")
    filled = F.when(F.trim(cell) != "", F.trim(cell))
    if name.endswith(("Amount", "Quantity", "Perc", "UnitCost")):
        return F.replace(filled, F.lit(","), F.lit("")).cast(AMOUNT)
    if name.endswith("Date"):
        slashed = F.to_timestamp(F.when(F.contains(filled, F.lit("/")), filled), "MM/dd/yyyy[ HH:mm:ss]")
        dashed = F.when(~F.contains(filled, F.lit("/")), filled)
        return F.coalesce(slashed.cast("date"), dashed.cast("date"))
    if name.endswith(("Month", "Year")):
        return filled.cast("int")
    return F.lower(filled).cast("boolean") if name.startswith("Is") or name.endswith("IsCurrent") else cell


def read_model(
    spark: SparkSession, root: str, format: str = "csv", delimiter: str = ";", projects: Iterable[str] | None = None
) -> CostModel:
    """The eight folders of a lake. CSV cells are typed by their column names.

    `projects` keeps the files named after these project ids; the others are not opened. The project,
    product and work breakdown tables are read whole.
    """
    files = None if projects is None else list(projects)
    tables = {}
    for table, folder in FOLDERS.items():
        whole = table in ("projects", "products", "work_breakdown_elements")
        rows = read_folder(spark, f"{root.rstrip('/')}/{folder}", format, delimiter, None if whole else files)
        rows = rows.drop("project_file")
        if format == "csv":
            rows = rows.select(*[_typed(name).alias(name) for name in rows.columns])
        tables[table] = rows
    return CostModel(**tables)


def project_ids(projects: DataFrame, codes: Iterable[str], code: str = "MnemoncId") -> DataFrame:
    """Ids of the projects with the given codes, ignoring case."""
    wanted = [fold_literal(value) for value in codes]
    return projects.filter(fold(F.col(code)).isin(wanted)).select(PROJECT).distinct()


def in_projects(fact: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of the given projects."""
    return fact.join(ids, PROJECT, "left_semi")


def scoped(model: CostModel, codes: Iterable[str], code: str = "MnemoncId") -> CostModel:
    """The model restricted to some projects; products and work breakdown elements stay whole."""
    ids = project_ids(model.projects, codes, code)
    facts = [f.name for f in fields(model) if f.name not in ("products", "work_breakdown_elements", "ev_column")]
    return replace(model, **{name: in_projects(getattr(model, name), ids) for name in facts})


def with_dimensions(fact: DataFrame, model: CostModel, columns: dict[str, dict[str, str]]) -> DataFrame:
    """Fact rows with columns of their dimensions: {table: {dimension column: result name}}.

    Left joins, many to one. No side is forced: Spark broadcasts a dimension it knows to be small and
    otherwise sorts and merges, splitting skewed keys.
    """
    keys = {"projects": PROJECT, "products": PRODUCT, "work_breakdown_elements": ELEMENT}
    for table, wanted in columns.items():
        key = keys[table]
        renamed: list[Column] = [F.col(name).alias(alias) for name, alias in wanted.items()]
        fact = fact.join(getattr(model, table).select(key, *renamed), key, "left")
    return fact
