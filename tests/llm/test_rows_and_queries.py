"""Every registered query of the subpackage: against its SQL, and on empty tables."""

from __future__ import annotations

import os
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module
from lakelens.llm.queries import ORACLE, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_registered():
    names = set(entry_module.queries())
    assert set(QUERIES) <= names and "pipeline" in names
    assert {n.split("_")[0] for n in QUERIES if n != "pipeline"} == {f"op{i}" for i in range(1, 14)}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, name):
    duck = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        duck.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    found = QUERIES[name](spark, SF)
    result = duck.execute(ORACLE[name])
    names = [column[0] for column in result.description]
    assert sorted(found.columns) == sorted(names)
    rows = Counter(tuple(row[c] for c in names) for row in found.collect())
    assert rows == Counter(result.fetchall())


@pytest.fixture(scope="module")
def empty_dir(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("empty")
    for table in ("documents", "embeddings", "pages", "benchmark", "labels"):
        spark.read.parquet(f"{SF}/{table}.parquet").limit(0).write.parquet(f"{folder}/{table}.parquet")
    return str(folder)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty_dir, name):
    assert QUERIES[name](spark, empty_dir).count() == 0


def test_native_plan(spark, capsys):
    QUERIES["op3_url_filters"](spark, SF).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "MapInPandas" not in plan and "NestedLoop" not in plan
