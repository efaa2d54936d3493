"""The filter language: eleven operators, AND-composed, compiled to one Catalyst expression.

A value is classified once, when the plan is built. Typed columns get a typed literal of their own type,
so the comparison reaches the Parquet scan; only text columns decide per cell between numeric and text order.
"""

from __future__ import annotations

import operator
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from datetime import datetime, time, timedelta
from decimal import ROUND_CEILING, ROUND_FLOOR, Decimal, localcontext
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelens.functions.instants import parse_instant
from lakelens.functions.numbers import compare_number, parse_number
from lakelens.functions.text import cell_text, fold, fold_literal

# Operator names and their aliases.
OPERATORS = ["eq", "ne", "gt", "gte", "lt", "lte", "contains", "startswith", "endswith", "isnull", "isnotnull"]
ALIASES = {"=": "eq", "==": "eq", "!=": "ne", "<>": "ne", ">": "gt", ">=": "gte", "<": "lt", "<=": "lte"}

_COMPARE: dict[str, Callable] = {
    "eq": operator.eq,
    "ne": operator.ne,
    "gt": operator.gt,
    "gte": operator.ge,
    "lt": operator.lt,
    "lte": operator.le,
}
_SEARCH: dict[str, Callable[[Column, Column], Column]] = {
    "contains": F.contains,
    "startswith": F.startswith,
    "endswith": F.endswith,
}
_INTEGRAL_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}


@dataclass(frozen=True)
class FilterCondition:
    """One condition; `value` is text, also for numbers and dates."""

    column: str
    operator: str
    value: str | None = None


def as_condition(raw) -> FilterCondition:
    """Accepts a FilterCondition, a mapping with column/operator/value, or a tuple."""
    if isinstance(raw, FilterCondition):
        return raw
    if isinstance(raw, Mapping):
        return FilterCondition(raw.get("column"), raw.get("operator"), raw.get("value"))
    return FilterCondition(*raw)


def parse_operator(name: str | None) -> str:
    cleaned = (name or "").strip().lower()
    cleaned = ALIASES.get(cleaned, cleaned)
    if cleaned not in OPERATORS:
        raise ValueError(f"Unknown filter operator '{name}'. Allowed: {', '.join(OPERATORS)}.")
    return cleaned


def resolve_column(name: str, available: list[str]) -> int:
    """Position of the first column with that name, ignoring case."""
    wanted = fold_literal(name)
    for position, candidate in enumerate(available):
        if fold_literal(candidate) == wanted:
            return position
    raise ValueError(f"Filter column '{name}' not found. Available columns: {', '.join(available)}.")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _resolve(name: str, schema: T.StructType, available: list[str]) -> tuple[Column, T.DataType]:
    """Column and type of a filter column; a dotted name reaches into structs."""
    names = [fold_literal(candidate) for candidate in available]
    head, _, rest = name.partition(".")
    if rest and fold_literal(name) not in names and fold_literal(head) in names:
        column, data_type = _resolve(head, schema, available)
        while rest and isinstance(data_type, T.StructType):
            head, _, rest = rest.partition(".")
            field = data_type.fields[resolve_column(head, data_type.names)]
            column, data_type = column.getField(field.name), field.dataType
        if not rest:
            return column, data_type
    field = schema.fields[resolve_column(name, available)]
    return F.col(_quoted(field.name)), field.dataType


def _number_literal(number: Decimal, scale: int, op: str) -> Decimal:
    """The value on the column's own grid that keeps `column op value` unchanged for gt/gte/lt/lte."""
    step = Decimal(1).scaleb(-scale)
    rounding = ROUND_FLOOR if op in ("gt", "lte") else ROUND_CEILING
    with localcontext() as context:
        context.prec = 80
        return number.quantize(step, rounding=rounding)


def _constant(column: Column, truth: bool) -> Column:
    """A comparison whose outcome is known for every non-null cell."""
    return column.isNotNull() if truth else F.lit(False)


def _compare_on_grid(column: Column, op: str, number: Decimal, scale: int, low: Decimal, high: Decimal, literal) -> Column:
    """Compares a column whose values are multiples of 10^-scale in [low, high] with any number."""
    if number > high or number < low:
        return _constant(column, op == "ne" or (op in ("lt", "lte")) == (number > high) and op != "eq")
    on_grid = _number_literal(number, scale, op)
    if op in ("eq", "ne") and on_grid != number:
        return _constant(column, op == "ne")
    return _COMPARE[op](column, literal(on_grid))


def _compare_numeric(column: Column, data_type: T.DataType, op: str, number: Decimal) -> Column:
    for kind, bits in _INTEGRAL_BITS.items():
        if isinstance(data_type, kind):
            low, high = Decimal(-(2 ** (bits - 1))), Decimal(2 ** (bits - 1) - 1)
            return _compare_on_grid(
                column, op, number, 0, low, high, lambda v: F.lit(int(v)).cast(data_type)
            )
    if isinstance(data_type, T.DecimalType):
        high = (Decimal(10) ** data_type.precision - 1).scaleb(-data_type.scale)
        return _compare_on_grid(
            column, op, number, data_type.scale, -high, high, lambda v: F.lit(f"{v:f}").cast(data_type)
        )
    return _COMPARE[op](column, F.lit(float(number)).cast(data_type))


def _compare_instant(column: Column, data_type: T.DataType, op: str, moment: datetime) -> Column:
    if isinstance(data_type, T.DateType):
        day = moment.date()
        if moment.time() != time(0):
            if op in ("eq", "ne"):
                return _constant(column, op == "ne")
            day += timedelta(days=0 if op in ("gt", "lte") else 1)
        return _COMPARE[op](column, F.lit(day))
    text = moment.isoformat(sep=" ")
    if isinstance(data_type, T.TimestampNTZType):
        return _COMPARE[op](column, F.lit(text).cast("timestamp_ntz"))
    return _COMPARE[op](column, F.lit(text + "+00:00").cast("timestamp"))


def _compare_text(text: Column, op: str, value: str) -> Column:
    """Ordinal order of UTF-16 code units.

    It differs from Spark's order of code points only between a character beyond the basic plane and one from U+E000 on,
    so a value without either is compared as it is.
    """
    folded, literal = fold(text), fold_literal(value)
    if op in ("eq", "ne") or all(ch < "\ue000" for ch in literal):
        return _COMPARE[op](folded, F.lit(literal))
    return _COMPARE[op](F.encode(folded, "UTF-16BE"), F.lit(literal.encode("utf-16-be")))


def _compare(column: Column, data_type: T.DataType, op: str, value: str) -> Column:
    """The six ordering operators; NULL cells give NULL."""
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        moment = parse_instant(value)
        if moment is not None:
            return _compare_instant(column, data_type, op, moment)
    elif isinstance(data_type, T.NumericType):
        number = parse_number(value)
        if number is not None:
            return _compare_numeric(column, data_type, op, number)
    elif isinstance(data_type, T.StringType):
        number = parse_number(value)
        if number is not None:
            return F.coalesce(compare_number(column, number, _COMPARE[op]), _compare_text(column, op, value))
    return _compare_text(cell_text(column, data_type), op, value)


def condition_column(column: Column, data_type: T.DataType, op: str, value: str | None) -> Column:
    """One condition on one column. Rows for which it is not TRUE do not match."""
    is_text = isinstance(data_type, T.StringType)
    if op == "isnull":
        return column.isNull() | (column == "") if is_text else column.isNull()
    if op == "isnotnull":
        return column.isNotNull() & (column != "") if is_text else column.isNotNull()
    if isinstance(data_type, (T.BinaryType, T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        raise ValueError(f"Only isnull and isnotnull apply to a column of type {data_type.simpleString()}.")
    if op in _SEARCH:
        text = cell_text(column, data_type)
        return _SEARCH[op](fold(text), F.lit(fold_literal(value)))
    outcome = _compare(column, data_type, op, value)
    return outcome | column.isNull() if op == "ne" else outcome


def checked_conditions(conditions: Iterable | None) -> list[FilterCondition]:
    """Conditions with canonical operators; raises on a blank column, unknown operator or missing value."""
    checked = []
    for raw in conditions or []:
        condition = as_condition(raw)
        if not (condition.column or "").strip():
            raise ValueError("Every filter needs a column.")
        op = parse_operator(condition.operator)
        if condition.value is None and op not in ("isnull", "isnotnull"):
            raise ValueError(f"Operator '{condition.operator}' needs a value (column '{condition.column}').")
        value = None if condition.value is None else str(condition.value)
        checked.append(FilterCondition(condition.column, op, value))
    return checked


def build_predicate(
    schema: T.StructType, conditions: Iterable | None, names: list[str] | None = None
) -> Column | None:
    """All conditions AND-ed, or None when there are none.

    `names` are the user-facing column names when they differ from the schema's own (a CSV header may
    repeat a name; conditions then apply to its first column).
    """
    available = names if names is not None else schema.names
    parts = []
    for condition in checked_conditions(conditions):
        column, data_type = _resolve(condition.column, schema, available)
        parts.append(condition_column(column, data_type, condition.operator, condition.value))
    return reduce(operator.and_, parts) if parts else None


def where(df: DataFrame, conditions: Iterable | None) -> DataFrame:
    """Rows matching every condition; no conditions keep every row. Works on batch and streaming frames."""
    predicate = build_predicate(df.schema, conditions)
    return df if predicate is None else df.filter(predicate)


def text_contains(column: Column, text: str | None) -> Column:
    """Case-insensitive substring test of the line readers; no text matches every line."""
    return F.lit(True) if not text else F.contains(fold(column), F.lit(fold_literal(text)))
