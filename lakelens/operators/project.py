"""The two projection rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakelens.functions.text import fold_literal


def _quoted(name: str):
    return F.col("`" + name.replace("`", "``") + "`")


def project_existing(df: DataFrame, columns: list[str] | None) -> DataFrame:
    """Named columns in table order and spelling, ignoring case; unknown names are dropped."""
    if not columns:
        return df
    wanted = {fold_literal(name) for name in columns}
    return df.select(*[_quoted(name) for name in df.columns if fold_literal(name) in wanted])


def project_requested(df: DataFrame, columns: list[str] | None) -> DataFrame:
    """Named columns in requested order and spelling; an unknown name becomes a column of NULLs."""
    if not columns:
        return df
    known: dict[str, str] = {}
    for name in df.columns:
        known.setdefault(fold_literal(name), name)
    return df.select(
        *[
            (_quoted(known[key]) if (key := fold_literal(name)) in known else F.lit(None).cast("string")).alias(name)
            for name in dict.fromkeys(columns)
        ]
    )
