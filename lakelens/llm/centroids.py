"""Exact integer k-means, its distances filtered by a PCA rotation.

The vectors are rotated once onto the principal axes of all of them (covariances summed over all tasks). Each keeps its
`leading` rotated coordinates and the norm of the rest. For a vector v and a centroid c, by the triangle inequality in the rest,

    |lead(v) - lead(c)|^2 + (rest(v) - rest(c))^2 <= |v - c|^2.

A round takes the centroids of a vector in the order of this bound, evaluates the first in integers, and goes on only
while the bound does not exceed the best distance so far; equal distances go to the smaller number. Assignments are those of
plain integer k-means, whatever the rotation; the bound is lowered by more than its rounding error.

The rotated vectors are written to the shared scratch folder once. A round reads them, sums per task and then per
centroid and component, and sends k * dims sums to the driver.

Defined results: components become floor(scale * x), x as double, and saturate at 2^27. Vectors that are null, of another
length, or hold null or non-finite components take no part. The first centroids are the k vectors with the least sha256 of
`seed:id`; repeated ids among them are taken by their components, and null ids come last. Rows with null or
repeated ids are vectors like others. Fewer than k vectors give as many centroids. Sums beyond a long saturate. An
empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakelens.llm.columns import written
from lakelens.llm.shared import shipped
from lakelens.llm.whole_vectors import exact_sums, matrix, packed, unpacked, usable, whole

LEADING = 16
RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
#: The share of the squared norms by which a bound is lowered; rounding stays far below it.
ROUNDING = 1e-9


@dataclass(frozen=True)
class Rotation:
    """A centre and the leading principal axes, as orthonormal columns."""

    centre: np.ndarray
    axes: np.ndarray

    def turned(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The leading coordinates of each row, and the norm of what they leave."""
        moved = rows - self.centre
        lead = moved @ self.axes
        return lead, np.sqrt(((moved - lead @ self.axes.T) ** 2).sum(axis=1))


def nearest(v: np.ndarray, lead: np.ndarray, rest: np.ndarray, centroids: np.ndarray, rotation: Rotation) -> tuple[np.ndarray, np.ndarray, int]:
    """The nearest centroid of each row, its squared distance, and how many distances were evaluated."""
    c_lead, c_rest = rotation.turned(centroids)
    norms = (lead**2).sum(axis=1) + rest**2
    c_norms = (c_lead**2).sum(axis=1) + c_rest**2
    bound = norms[:, None] - 2 * lead @ c_lead.T - 2 * rest[:, None] * c_rest + c_norms
    bound -= ROUNDING * (norms[:, None] + c_norms + 1)
    order = np.argsort(bound, axis=1, kind="stable")
    alive = np.arange(len(v))
    label = order[:, 0].copy()
    best = ((v - centroids[label]) ** 2).sum(axis=1)
    evaluated = len(v)
    for turn in range(1, len(centroids)):
        tried = order[alive, turn]
        going = bound[alive, tried] <= best[alive]
        alive, tried = alive[going], tried[going]
        if not len(alive):
            break
        evaluated += len(alive)
        distance = ((v[alive] - centroids[tried]) ** 2).sum(axis=1)
        better = (distance < best[alive]) | ((distance == best[alive]) & (tried < label[alive]))
        best[alive[better]], label[alive[better]] = distance[better], tried[better]
    return label, best, evaluated


def _rotation(vectors: DataFrame, dims: int, leading: int) -> Rotation:
    """The principal axes of all vectors, from sums of products."""

    def products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((dims + 1, dims + 1))
        for batch in batches:
            rows = matrix(batch["v"]).astype(np.float64)
            wide = np.hstack([rows, np.ones((len(rows), 1))])
            total += wide.T @ wide
        yield pd.DataFrame({"i": np.arange(dims + 1), "sums": list(total)})

    each = vectors.select("v").mapInPandas(products, "i int, sums array<double>").select("i", F.posexplode("sums").alias("j", "x"))
    total = np.zeros((dims + 1, dims + 1))
    for i, j, x in each.groupBy("i", "j").agg(F.sum("x")).collect():
        total[i, j] = x
    n = max(total[dims, dims], 1.0)
    centre = total[:dims, dims] / n
    _, axes = np.linalg.eigh(total[:dims, :dims] / n - np.outer(centre, centre))
    return Rotation(centre, np.ascontiguousarray(axes[:, ::-1][:, :leading]))


def centroid_clusters(
    rows: DataFrame,
    k: int = 8,
    rounds: int = 10,
    dims: int = 64,
    scale: float = 1024.0,
    seed: int = 3,
    leading: int = LEADING,
    row_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """One row per usable vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    spark = shipped(rows.sparkSession)
    vectors = (
        rows.select(F.col(row_id).cast("long").alias("vec_id"), F.col(vector).alias("v"))
        .where((F.size("v") == dims) & usable(F.col("v")))
        .select("vec_id", whole(F.col("v"), scale).alias("v"))
    )
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = vectors.orderBy(mark.asc_nulls_last(), "v").limit(k).collect()
    if not first:
        return spark.createDataFrame([], RESULT)
    centroids = np.array([row["v"] for row in first], np.int64)
    rotation = _rotation(vectors, dims, min(leading, dims))

    def turned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            v = matrix(batch["v"])
            lead, rest = rotation.turned(v)
            yield pd.DataFrame({"vec_id": batch["vec_id"], "v": packed(v, "<i4"), "lead": packed(lead, "<f8"), "rest": rest})

    # Ids go through Python as text, which keeps nulls and long values apart.
    text_ids = vectors.withColumn("vec_id", F.col("vec_id").cast("string"))
    placed = written(text_ids.mapInPandas(turned, "vec_id string, v binary, lead binary, rest double"), "rotated")

    def assigned(batch: pd.DataFrame, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        v = unpacked(batch["v"], "<i4").astype(np.int64)
        label, best, _ = nearest(v, unpacked(batch["lead"], "<f8"), batch["rest"].to_numpy(np.float64), centroids, rotation)
        return v, label, best

    def task_sums(centroids: np.ndarray):
        def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            sums, n = np.zeros(centroids.shape, np.int64), np.zeros(len(centroids), np.int64)
            for batch in batches:
                v, label, _ = assigned(batch, centroids)
                np.add.at(sums, label, v)
                n += np.bincount(label, minlength=len(n))
            there = np.flatnonzero(n)
            if len(there):
                yield pd.DataFrame({"cluster": there, "n": n[there], "sums": list(sums[there])})

        return summed

    for _ in range(rounds):
        parts = placed.drop("vec_id").mapInPandas(task_sums(centroids), "cluster int, n long, sums array<long>")
        centroids = centroids.copy()
        for cluster, place, total, n in exact_sums(parts, ["cluster"]):
            centroids[cluster, place] = int(total) // n

    def final(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            _, label, best = assigned(batch, centroids)
            yield pd.DataFrame({"vec_id": batch["vec_id"], "cluster": label, "distance": best})

    ended = written(placed.mapInPandas(final, "vec_id string, cluster int, distance long"), "clusters")
    sums = ended.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()
    inertia = {row["cluster"]: min(int(row["total"]), 2**63 - 1) for row in sums}
    every = min(sum(int(row["total"]) for row in sums), 2**63 - 1)
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    named = spark.createDataFrame([(c, total, every, digest[c]) for c, total in inertia.items()], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # k rows at most.
    return ended.join(F.broadcast(named), "cluster").select(
        F.col("vec_id").cast("long").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
