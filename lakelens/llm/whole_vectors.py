"""Vectors as integers: the floor of each scaled component, packed for numpy, and exact sums of them over all tasks."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Components saturate here, so that the squared distance of any two vectors of up to 64 components fits a long.
MOST = 2**27


def usable(vector: Column) -> Column:
    """True for a vector without null or non-finite components; false for null."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return F.coalesce(vector.isNotNull() & fine, F.lit(False))


def whole(vector: Column, scale: float) -> Column:
    """floor(scale * x) of each component, x as double."""
    bounded = lambda x: F.greatest(F.least(F.lit(float(scale)) * x.cast("double"), F.lit(float(MOST))), F.lit(float(-MOST)))
    return F.transform(vector, lambda x: F.floor(bounded(x)).cast("int"))


def matrix(vectors: pd.Series) -> np.ndarray:
    """Rows of integers from a column of arrays of equal length."""
    return np.stack([np.asarray(v, np.int64) for v in vectors])


def packed(rows: np.ndarray, kind: str) -> list[bytes]:
    """One byte string per row."""
    return [row.tobytes() for row in np.ascontiguousarray(rows, kind)]


def unpacked(data: pd.Series, kind: str) -> np.ndarray:
    """The rows that `packed` made."""
    return np.frombuffer(b"".join(data), kind).reshape(len(data), -1)


def exact_sums(parts: DataFrame, keys: list[str]) -> list:
    """(*keys, place, total, n) of every key and component; `parts` has the keys, n and an array `sums` per task.

    One row per key and component reaches the driver, however many rows there are.
    """
    each = parts.select(*keys, "n", F.posexplode("sums").alias("place", "x"))
    wide = F.sum(F.col("x").cast("decimal(38,0)")).alias("total")
    return each.groupBy(*keys, "place").agg(wide, F.sum("n").alias("n")).collect()


def as_long(total: Column) -> Column:
    """A sum of decimals as a long, saturated."""
    most = F.lit(2**63 - 1).cast("decimal(38,0)")
    return F.least(total, most).cast("long")
