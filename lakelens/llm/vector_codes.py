"""Vector codes: product quantisation in exact integers, its searches pruned by LAESA pivots.

A vector is cut into equal consecutive parts, and every part is coded by the nearest of `entries` codebook entries of its place.
Each place has a few fixed pivots, chosen among its first entries so that they lie far apart. The distances
of every part to them are computed once and stored. A round computes the distances of the current entries to the pivots;
for a part x and an entry e,

    max over pivots p of | d(x, p) - d(e, p) | <= d(x, e),

so the entries of a part are evaluated in the order of this bound, in integers, a few at a time, until the next bound exceeds the
best distance so far. Equal distances go to the lower index. The result is that of a full search; bounds are lowered by
more than their rounding error.

The parts with their pivot distances are written to the shared scratch folder once. A round reads them, sums per task
and then per place, entry and component; one sum for each of these reaches the driver.

Defined results: components become floor(scale * x), x as double, and saturate at 2^27. Vectors that are null or hold null or
non-finite components take no part. All vectors must have one length that `parts` divides: that of the smallest id which has such a
length; others take no part. Null ids sort last, repeated ids by their components; rows with such ids are vectors like others. Fewer
than `entries` vectors give as many entries. Errors of equal labels are summed, null labels together; sums beyond a
long saturate. An empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakelens.llm.columns import written
from lakelens.llm.shared import shipped
from lakelens.llm.whole_vectors import as_long, exact_sums, matrix, packed, unpacked, usable, whole

PIVOTS = 8
#: Entries of a part that are evaluated at once.
STEP = 8
BLOCK_ROWS = 2_048
RESULT = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
#: The share of the pivot distances by which a bound is lowered; stored distances have 24 bits.
ROUNDING = 1e-6


def pivots_of(entries: np.ndarray, count: int = PIVOTS) -> np.ndarray:
    """Entries far apart: each next one is the farthest from those taken, the lower index on ties."""
    taken, reach = [0], ((entries - entries[0]) ** 2).sum(axis=1)
    while len(taken) < min(count, len(entries)) and reach.max() > 0:
        taken.append(int(reach.argmax()))
        reach = np.minimum(reach, ((entries - entries[taken[-1]]) ** 2).sum(axis=1))
    return entries[taken]


def distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Euclidean distance of every row to every pivot."""
    return np.sqrt(np.stack([((rows - p) ** 2).sum(axis=1) for p in pivots], axis=1).astype(np.float64))


def nearest(rows: np.ndarray, known: np.ndarray, entries: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The nearest entry of each row, its squared distance, and how many distances were evaluated."""
    to_pivots = distances(entries, pivots)
    bound = np.zeros((len(rows), len(entries)))
    for p in range(len(pivots)):
        np.maximum(bound, np.abs(known[:, p, None] - to_pivots[:, p]), out=bound)
    bound -= ROUNDING * (known.max(axis=1)[:, None] + to_pivots.max() + 1)
    order = np.argsort(bound, axis=1, kind="stable")
    best = np.full(len(rows), np.iinfo(np.int64).max)
    label = np.zeros(len(rows), np.int64)
    alive, evaluated = np.arange(len(rows)), 0
    for a in range(0, len(entries), STEP):
        tried = order[alive, a : a + STEP]
        going = np.maximum(bound[alive, tried[:, 0]], 0.0) ** 2 <= best[alive]
        alive, tried = alive[going], tried[going]
        if not len(alive):
            break
        evaluated += tried.size
        found = ((rows[alive][:, None, :] - entries[tried]) ** 2).sum(axis=2)
        least = found.min(axis=1)
        at = np.where(found == least[:, None], tried, len(entries)).min(axis=1)
        better = (least < best[alive]) | ((least == best[alive]) & (at < label[alive]))
        best[alive[better]], label[alive[better]] = least[better], at[better]
    return label, best, evaluated


def vector_codes(
    rows: DataFrame,
    parts: int = 4,
    entries: int = 256,
    rounds: int = 4,
    scale: float = 1024.0,
    pivots: int = PIVOTS,
    row_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """One row per usable vector: vec_id, code, error, label_error, codebooks_sha256."""
    spark = shipped(rows.sparkSession)
    fine = rows.select(F.col(row_id).cast("long").alias("vec_id"), F.col(vector).alias("v"), F.col(label).cast("string").alias("label"))
    fine = fine.where(usable(F.col("v")) & (F.size("v") > 0) & (F.size("v") % parts == 0))
    one = fine.select("vec_id", F.size("v").alias("n"), "v").orderBy(F.col("vec_id").asc_nulls_last(), "v").first()
    if one is None:
        return spark.createDataFrame([], RESULT)
    width = one["n"] // parts
    vectors = fine.where(F.size("v") == one["n"]).select("vec_id", "label", whole(F.col("v"), scale).alias("v"))
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()
    cut = np.array([row["v"] for row in first], np.int64).reshape(len(first), parts, width)
    books = [np.ascontiguousarray(cut[:, p]) for p in range(parts)]
    fixed = [pivots_of(book, pivots) for book in books]
    digits = max(2, len(f"{max(len(first) - 1, 0):x}"))

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            v = matrix(batch["v"])
            out = batch[["vec_id", "label"]].copy()
            out["v"] = packed(v, "<i4")
            for p in range(parts):
                out[f"d{p}"] = packed(distances(v[:, p * width : (p + 1) * width], fixed[p]), "<f4")
            yield out

    pieces = [f"d{p}" for p in range(parts)]
    text_ids = vectors.withColumn("vec_id", F.col("vec_id").cast("string"))
    schema = "vec_id string, label string, v binary, " + ", ".join(f"{name} binary" for name in pieces)
    placed = written(text_ids.mapInPandas(measured, schema), "pivot-distances")

    def coded(batch: pd.DataFrame, books: list[np.ndarray]) -> Iterator[tuple[pd.DataFrame, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]]:
        """Blocks of the batch with each part's vectors, labels and squared distances."""
        for a in range(0, len(batch), BLOCK_ROWS):
            block = batch.iloc[a : a + BLOCK_ROWS]
            v = unpacked(block["v"], "<i4").astype(np.int64)
            found = []
            for p in range(parts):
                part = v[:, p * width : (p + 1) * width]
                found.append((part, *nearest(part, unpacked(block[f"d{p}"], "<f4").astype(np.float64), books[p], fixed[p])[:2]))
            yield block, found

    def task_sums(books: list[np.ndarray]):
        def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            sums = np.zeros((parts, len(first), width), np.int64)
            n = np.zeros((parts, len(first)), np.int64)
            for batch in batches:
                for _, found in coded(batch, books):
                    for p, (part, entry, _) in enumerate(found):
                        np.add.at(sums[p], entry, part)
                        n[p] += np.bincount(entry, minlength=len(first))
            part, entry = np.nonzero(n)
            if len(part):
                yield pd.DataFrame({"part": part, "entry": entry, "n": n[part, entry], "sums": list(sums[part, entry])})

        return summed

    for _ in range(rounds):
        summed = placed.drop("vec_id", "label").mapInPandas(task_sums(books), "part int, entry int, n long, sums array<long>")
        books = [book.copy() for book in books]
        for part, entry, place, total, n in exact_sums(summed, ["part", "entry"]):
            books[part][entry, place] = int(total) // n

    def final(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for block, found in coded(batch, books):
                out = block[["vec_id", "label"]].copy()
                out["code"] = ["".join(f"{x:0{digits}x}" for x in row) for row in zip(*(entry.tolist() for _, entry, _ in found))]
                out["error"] = sum(best for _, _, best in found)
                yield out

    ended = written(placed.mapInPandas(final, "vec_id string, label string, code string, error long"), "codes")
    sums = ended.groupBy(F.col("label").alias("its")).agg(as_long(F.sum(F.col("error").cast("decimal(38,0)"))).alias("label_error"))
    digest = hashlib.sha256(",".join(str(x) for book in books for x in book.ravel().tolist()).encode()).hexdigest()
    return ended.join(sums, F.col("label").eqNullSafe(F.col("its"))).select(
        F.col("vec_id").cast("long").alias("vec_id"), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )
