"""Every registered query against its SQL in DuckDB, on whole tables."""

from __future__ import annotations

import datetime as dt
import math
import os
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module
from lakelens.registry.base import ORACLE, QUERIES

QUERY_SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ONLY_ROWS = {"file_inventory", "file_info"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(QUERY_SF).glob("*.parquet"):
        files = f"{path}/*.parquet" if path.is_dir() else path
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{files}')")
    return connection


def normal(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def as_bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(normal(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    assert set(QUERIES) - set(ORACLE) == ONLY_ROWS


def test_entry(spark):
    assert entry_module.entry(spark).columns == ["o_orderkey", "o_custkey", "o_totalprice"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name, capsys):
    found = QUERIES[name](spark, QUERY_SF)
    rows = found.collect()
    found.explain()
    plan = capsys.readouterr().out
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "Python" not in plan and "MapInPandas" not in plan
    sql = ORACLE.get(name)
    if sql is None:
        assert rows
        return
    result = duck.execute(sql)
    names = [column[0] for column in result.description]
    assert sorted(found.columns) == sorted(names)
    expected = result.fetchall()
    assert len(rows) == len(expected)
    assert as_bag(found.columns, rows) == as_bag(names, expected)
