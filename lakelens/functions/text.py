"""Case folding and the text form of a cell."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Sharp s upper-cases to two letters in Java but stays itself under a simple case mapping, so it is
# carried through `upper` behind a private-use character.
SHARP_S = "ß"
SHARP_S_MARK = "\ue0df"


def fold(column: Column) -> Column:
    """Upper-case form used for every case-insensitive comparison.

    Upper rather than lower: the ordering compares upper-cased code points, which puts `_` after `Z`.
    """
    marked = F.replace(column, F.lit(SHARP_S), F.lit(SHARP_S_MARK))
    return F.replace(F.upper(marked), F.lit(SHARP_S_MARK), F.lit(SHARP_S))


def fold_literal(value: str) -> str:
    """`fold` for a constant: one character in, one character out."""
    return "".join(u if len(u := ch.upper()) == 1 else ch for ch in value)


def _real_text(column: Column) -> Column:
    """Shortest round-trip digits, plain from 0.0001 up to 1E+15, otherwise `d.dE+nn`."""
    shortest = column.cast("string")
    magnitude = F.abs(column.cast("double"))
    plain = shortest.try_cast("decimal(38,22)").cast("string")
    plain = F.regexp_replace(F.regexp_replace(plain, r"(\.\d*?)0+$", "$1"), r"\.$", "")
    scientific = F.regexp_replace(shortest, r"\.0E", "E")
    scientific = F.regexp_replace(scientific, r"E(\d)", "E+$1")
    scientific = F.regexp_replace(scientific, r"E([+-])(\d)$", "E$10$2")
    return (
        F.when(magnitude == 0, F.lit("0"))
        .when((magnitude >= 1e-4) & (magnitude < 1e15), plain)
        .otherwise(scientific)
    )


def cell_text(column: Column, data_type: T.DataType) -> Column:
    """Culture-free text of a cell; NULL stays NULL."""
    if isinstance(data_type, T.StringType):
        return column
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return _real_text(column)
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        if isinstance(data_type, T.TimestampType):
            column = F.to_utc_timestamp(column, F.current_timezone())
        return F.regexp_replace(
            F.concat(column.cast("string"), F.lit(" 00:00:00")),
            r"^(\d+)-(\d+)-(\d+) (\d+:\d+:\d+).*$",
            "$2/$3/$1 $4",
        )
    return column.cast("string")
