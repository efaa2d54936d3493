"""The filter language: parsing, every operator on every column kind, and a randomised comparison of the
text-cell comparator with a plain Python model of the documented rules."""

from __future__ import annotations

import datetime as dt
import operator
import random
import re
from decimal import Decimal, localcontext

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelens.functions.instants import parse_instant
from lakelens.functions.numbers import MAX_MAGNITUDE, compare_number, parse_number
from lakelens.functions.predicates import (
    FilterCondition,
    build_predicate,
    checked_conditions,
    condition_column,
    parse_operator,
    where,
)
from lakelens.functions.text import cell_text


def ids(df, *conditions):
    return sorted(row["id"] for row in where(df, conditions).collect())


def test_parsing():
    assert parse_operator(" GTE ") == "gte"
    assert [parse_operator(a) for a in ("=", "==", "!=", "<>", ">", ">=", "<", "<=")] == [
        "eq", "eq", "ne", "ne", "gt", "gte", "lt", "lte",
    ]
    with pytest.raises(ValueError, match="startswith"):
        parse_operator("like")
    with pytest.raises(ValueError, match="needs a value"):
        checked_conditions([("a", "eq")])
    with pytest.raises(ValueError, match="column"):
        checked_conditions([("  ", "isnull")])
    assert checked_conditions([{"column": "a", "operator": "isnull"}]) == [FilterCondition("a", "isnull", None)]
    assert checked_conditions(None) == []


@pytest.mark.parametrize(
    "text,number",
    [("1,000", "1000"), ("5-", "-5"), ("1e3", "1000"), (" 7 ", "7"), (".5", "0.5"), ("5.", "5"), ("+2", "2"),
     ("+5-", None), (",5", None), ("abc", None), ("", None), ("1 2", None), ("1e40", None), ("٣", None)],
)
def test_number_grammar(text, number):
    assert parse_number(text) == (None if number is None else Decimal(number))


@pytest.mark.parametrize(
    "text,expected",
    [
        ("2024-01-31", dt.datetime(2024, 1, 31)),
        ("2024-01-31T10:00:00+02:00", dt.datetime(2024, 1, 31, 8)),
        ("2024-01-31 10:00:00Z", dt.datetime(2024, 1, 31, 10)),
        ("01/31/2024", dt.datetime(2024, 1, 31)),
        ("01/31/2024 10:05", dt.datetime(2024, 1, 31, 10, 5)),
        ("yesterday", None),
        ("20240131", None),
    ],
)
def test_instants(text, expected):
    assert parse_instant(text) == expected


@pytest.fixture(scope="module")
def cells(spark):
    texts = ["abc", "", None, "1,000", "5-", "1e3", " 7 ", "99", "100", "100.00", "_x", "Zeta", "Straße", "STRASSE"]
    return spark.createDataFrame(list(enumerate(texts)), "id int, t string").cache()


@pytest.mark.parametrize(
    "condition,expected",
    [
        (("t", "gt", "100"), [0, 3, 5, 10, 11, 12, 13]),
        (("t", "lt", "100"), [1, 4, 6, 7]),
        (("t", "eq", "100"), [8, 9]),
        (("T", "eq", "1000"), [3, 5]),
        (("t", "eq", "ABC"), [0]),
        (("t", "ne", "abc"), [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13]),
        (("t", "isnull"), [1, 2]),
        (("t", "isnotnull"), [0, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13]),
        (("t", "contains", ""), [0, 1, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13]),
        (("t", "contains", "RASS"), [13]),
        (("t", "contains", "raß"), [12]),
        (("t", "startswith", "1"), [3, 5, 8, 9]),
        (("t", "endswith", "TA"), [11]),
        (("t", "gt", "zeta"), [10]),
        (("t", "lte", "5-"), [1, 4]),
    ],
)
def test_text_cells(cells, condition, expected):
    assert ids(cells, condition) == sorted(expected)


def test_typed_columns(spark):
    rows = [
        (1, 10, 1.5, Decimal("1.50"), True, dt.date(2024, 1, 31), dt.datetime(2024, 1, 31, 8)),
        (2, 20, 2.5, Decimal("2.50"), False, dt.date(2024, 2, 1), dt.datetime(2024, 1, 31, 8, 0, 1)),
        (3, None, None, None, None, None, None),
    ]
    schema = "id int, n int, d double, m decimal(9,2), b boolean, day date, ts timestamp_ntz"
    df = spark.createDataFrame(rows, schema).withColumns(
        {"f": F.col("d").cast("float"), "z": F.col("ts").cast("timestamp")}
    )
    assert ids(df, ("n", "gt", "10.5")) == [2]
    assert ids(df, ("n", "gte", "10.5")) == [2]
    assert ids(df, ("n", "lt", "10.5")) == [1]
    assert ids(df, ("n", "lte", "10.5")) == [1]
    assert ids(df, ("n", "eq", "10.5")) == []
    assert ids(df, ("n", "ne", "10.5")) == [1, 2, 3]
    assert ids(df, ("n", "ne", "10")) == [2, 3]
    assert ids(df, ("n", "lt", "99999999999")) == [1, 2]
    assert ids(df, ("n", "gt", "99999999999")) == []
    assert ids(df, ("n", "gt", "-99999999999")) == [1, 2]
    assert ids(df, ("n", "gt", "abc")) == []
    assert ids(df, ("n", "lt", "abc")) == [1, 2]
    assert ids(df, ("m", "gt", "1.505")) == [2]
    assert ids(df, ("m", "eq", "1.5")) == [1]
    assert ids(df, ("m", "contains", ".50")) == [1, 2]
    assert ids(df, ("f", "eq", "1.5"), ("d", "eq", "1.50")) == [1]
    assert ids(df, ("b", "eq", "TRUE")) == [1]
    assert ids(df, ("day", "eq", "2024-01-31")) == [1]
    assert ids(df, ("day", "gt", "2024-01-31T10:00:00")) == [2]
    assert ids(df, ("day", "gte", "2024-01-31T10:00:00")) == [2]
    assert ids(df, ("day", "lt", "2024-01-31T10:00:00")) == [1]
    for name in ("ts", "z"):
        assert ids(df, (name, "eq", "2024-01-31T10:00:00+02:00")) == [1]
        assert ids(df, (name, "gt", "2024-01-31 08:00")) == [2]
        assert ids(df, (name, "startswith", "01/31/2024 08")) == [1, 2]
        assert ids(df, (name, "lt", "not a date")) == [1, 2]
    assert ids(df, ("n", "isnull")) == [3]
    struct = df.select("id", F.struct("n", F.struct("m").alias("in.ner")).alias("s"))
    assert ids(struct, ("S.N", "gt", "10")) == [2]
    with pytest.raises(ValueError, match="zz"):
        where(struct, [("s.zz", "eq", "1")])
    nested = df.select("id", F.array("n").alias("a"))
    assert ids(nested, ("a", "isnotnull")) == [1, 2, 3]
    with pytest.raises(ValueError, match="isnull"):
        where(nested, [("a", "eq", "1")])


def test_cell_text_of_reals(spark):
    numbers = [0.0, 1.0, 1234567.0, 12345678.9, 1e14, 1e15, 1.5e20, 1e-4, 1.25e-5, 1e-7, -2.5, 0.015625]
    expected = ["0", "1", "1234567", "12345678.9", "100000000000000", "1E+15", "1.5E+20", "0.0001", "1.25E-05",
                "1E-07", "-2.5", "0.015625"]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(numbers)], "id int, n double")
    found = df.orderBy("id").select(cell_text(F.col("n"), T.DoubleType())).collect()
    assert [r[0] for r in found] == expected


# A plain model of the documented rules, kept apart from the library's code.
MODEL_NUMBER = re.compile(
    r"[ \t\n\x0b\f\r]*([+-]?)(\d[\d,]*(?:\.\d*)?|\.\d+)((?:[eE][+-]?\d+)?)([+-]?)[ \t\n\x0b\f\r]*", re.ASCII
)


def model_number(text):
    found = MODEL_NUMBER.fullmatch(text)
    if not found or (found[1] and found[4]):
        return None
    number = Decimal((found[1] or found[4]) + found[2].replace(",", "") + found[3])
    if abs(number) > 2**96 - 1:
        return None
    with localcontext(prec=80):
        return number.quantize(Decimal("1e-28"))


def model_match(cell, op, value):
    if cell is None:
        return op == "ne"
    left, right = model_number(cell), model_number(value)
    if left is None or right is None:
        left, right = cell.upper(), value.upper()
    return {
        "eq": left == right, "ne": left != right, "gt": left > right,
        "gte": left >= right, "lt": left < right, "lte": left <= right,
    }[op]


def test_random_cells_against_model(spark):
    rng = random.Random(7)
    alphabet = "0123456789" * 3 + ",.+-e _aBzZ"
    texts = {"".join(rng.choice(alphabet) for _ in range(rng.randint(0, 6))) for _ in range(2500)}
    texts |= {"0.00000000000000001", "0.00000000000000002", "12345678901234567890.5", "1e-20", "100.000", "0E99", "-0.0e50", "5e28", "8e28", "7e27", "79228162514264337593543950335"}
    cells = [*sorted(texts), None]
    df = spark.createDataFrame(list(enumerate(cells)), "id int, t string")
    checks = [
        (op, value)
        for value in ("100", "0", "-3", "1,2", "5-", "1e2", ".5", "abc", "_", "", "0.00000000000000001", "1e11", "6e28")
        for op in ("eq", "ne", "gt", "gte", "lt", "lte")
    ]
    columns = [
        F.coalesce(condition_column(F.col("t"), T.StringType(), op, value), F.lit(False)) for op, value in checks
    ]
    rows = df.select("id", F.array(*columns).alias("m")).collect()
    wrong = [
        (cells[row["id"]], check)
        for row in rows
        for check, found in zip(checks, row["m"])
        if found != model_match(cells[row["id"]], *check)
    ]
    assert len(rows) == len(cells)
    assert wrong == []


def test_typed_filters_reach_the_scan(spark, sf_dir, capsys):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    conditions = [
        ("o_totalprice", "gt", "1000"), ("o_orderkey", "lte", "500.5"), ("o_orderdate", "gte", "1997-01-01"),
        ("o_custkey", "ne", "7"), ("o_orderpriority", "isnotnull"),
    ]
    where(orders, conditions).select("o_orderkey").explain("formatted")
    plan = capsys.readouterr().out
    pushed = next(line for line in plan.splitlines() if line.startswith("PushedFilters"))
    for part in ("GreaterThan(o_totalprice,1000.0)", "LessThanOrEqual(o_orderkey,500)", "GreaterThanOrEqual(o_orderdate",
                 "Or(Not(EqualTo(o_custkey,7)),IsNull(o_custkey))", "IsNotNull(o_orderpriority)"):
        assert part in pushed
    assert "Python" not in plan
    assert build_predicate(orders.schema, []) is None


def test_text_of_times_in_another_zone(spark):
    df = spark.sql("SELECT 1 AS id, timestamp_seconds(1706688000) AS z, timestamp_ntz'2024-03-10 02:30:00' AS n")
    previous = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert ids(df, ("z", "startswith", "01/31/2024 08:00:00"), ("z", "eq", "2024-01-31T08:00:00Z")) == [1]
        assert ids(df, ("n", "startswith", "03/10/2024 02:30"), ("n", "gt", "2024-03-10 02:29")) == [1]
    finally:
        spark.conf.set("spark.sql.session.timeZone", previous)


def _long_number(rng):
    whole = "".join(rng.choice("0123456789") for _ in range(rng.choice([1, 2, 5, 20, 27, 29])))
    part = "".join(rng.choice("0123456789") for _ in range(rng.choice([0, 1, 3, 15, 16, 30, 60])))
    exponent = rng.choice(["", "", "", "e0", "e-3", "E+5", "e-40", "e20"])
    return rng.choice(["", "-", "+", ""]) + whole + ("." + part if part else "") + exponent


def test_numbers_of_any_length(spark):
    """Order and equality against exact decimals, past 28 digits and up to the largest magnitude."""
    rng = random.Random(2)
    edge = str(MAX_MAGNITUDE)
    cells = [_long_number(rng) for _ in range(300)] + ["0", "-0", "0.000", "0e99", "1,000", "5-", " 7 ", ".5", "abc", "", None]
    cells += [edge, edge + ".000", edge[:-1] + "4.99999999999", edge[:-1] + "6", "-" + edge, "1e-30", "-1e-30", "1e99999999999999999999"]
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    values = ["0", "12345.678", edge[:-1] + "4.9999999", "-0." + "0" * 33 + "1", "9" * 20, *[c for c in rng.sample(cells[:300], 8)]]
    for number in filter(None, map(parse_number, values)):
        found = df.select("c", *[compare_number(F.col("c"), number, f).alias(f.__name__) for f in (operator.lt, operator.eq, operator.ge)]).collect()
        for row in found:
            cell = None if row["c"] is None or "e99999" in row["c"] else parse_number(row["c"])
            assert tuple(row)[1:] == ((None,) * 3 if cell is None else (cell < number, cell == number, cell >= number)), (row, number)


def test_order_beyond_the_basic_plane(spark):
    rng = random.Random(3)
    cells = ["".join(rng.choice("aZ_￮\U0001f600\U00010000é漢") for _ in range(rng.randrange(4))) for _ in range(300)]
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    for value in ("\U0001f600", "￮", "a", "漢", "Z\U00010000a"):
        for op, holds in (("lt", operator.lt), ("gte", operator.ge)):
            expected = [c for c in cells if holds(c.upper().encode("utf-16-be"), value.upper().encode("utf-16-be"))]
            assert sorted(row["c"] for row in where(df, [("c", op, value)]).collect()) == sorted(expected)
