"""Exact top-k by integer inner product: ball-tree branch and bound per shard, with kth scores shared between shards.

Rows are dealt evenly over shards. A shard builds a ball tree (median splits on the widest component, a centre and a
radius per node). No point of a node scores above `query . centre + |query| * radius`. A block of queries goes down the
tree level by level, dropping nodes whose bound is below the query's kth score; the leaves that are left are visited in
the order of their bounds, and the kth score rises with each visit. Equal bounds are kept, as ties go to smaller ids.

The search runs in two waves. In the first every query visits one shard; its kth score there is a lower bound of the
final one and goes with the query to all other shards. Queries stream through a shard in blocks; neither side is
collected, and a shard's size does not grow with the input.

Defined results: components become floor(scale * x), x as double. Vectors that are null or hold null or non-finite
components, and rows without an id, take no part. Vectors are compared with those of equal length only. A query's own
row is every row with its id; other repeated rows are candidates of their own, and repeated query rows count once per
distinct vector. Components and scores beyond a long saturate. With fewer than k candidates all of them are returned.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakelens.llm.columns import written
from lakelens.llm.shared import shipped

SHARD_ROWS = 65_536
LEAF_ROWS = 128
QUERY_BLOCK = 2_048
LONG = 2**63 - 1
#: Below this every partial sum of products is an exact double.
EXACT = 2.0**52
LOWEST = np.iinfo(np.int64).min


class BallTree:
    """Nodes in breadth-first order; children of node i are kids[i], leaves cover rows[start[i]:stop[i]]."""

    def __init__(self, points: np.ndarray, leaf_rows: int = LEAF_ROWS):
        near = points.astype(np.float64)
        self.order = np.arange(len(points))
        self.start, self.stop, self.kids, centres, radii = [0], [len(points)], [], [], []
        i = 0
        while i < len(self.start):
            a, b = self.start[i], self.stop[i]
            part = near[self.order[a:b]]
            centre = part.mean(axis=0)
            centres.append(centre)
            radii.append(math.sqrt(((part - centre) ** 2).sum(axis=1).max()))
            spread = part.max(axis=0) - part.min(axis=0) if part.shape[1] else np.zeros(1)
            if b - a <= leaf_rows or not spread.max() > 0:
                self.kids.append(())
            else:
                half = (b - a) // 2
                split = np.argpartition(part[:, spread.argmax()], half)
                self.order[a:b] = self.order[a:b][split]
                self.kids.append((len(self.start), len(self.start) + 1))
                self.start += [a, a + half]
                self.stop += [a + half, b]
            i += 1
        self.centres, self.radii = np.array(centres), np.array(radii)

    def levels(self) -> Iterator[list[int]]:
        level = [0]
        while level:
            yield level
            level = [kid for node in level for kid in self.kids[node]]


class Shard:
    """The rows of one shard that have vectors of one length."""

    def __init__(self, ids: np.ndarray, points: np.ndarray):
        self.tree = BallTree(points)
        self.ids, self.points = ids[self.tree.order], points[self.tree.order]
        self.largest = float(np.abs(points.astype(np.float64)).max()) if points.size else 0.0
        self.exact = None

    def scores(self, queries: np.ndarray, a: int, b: int) -> np.ndarray:
        most = float(np.abs(queries.astype(np.float64)).max()) if queries.size else 0.0
        if most * self.largest * queries.shape[1] < EXACT:
            return (queries.astype(np.float64) @ self.points[a:b].astype(np.float64).T).astype(np.int64)
        whole = queries.astype(object) @ self.points[a:b].astype(object).T
        return np.clip(whole, -LONG - 1, LONG).astype(np.int64)

    def search(self, own: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query row, id, score) of the k best of each query among those that reach its floor."""
        tree, floor = self.tree, floor.copy()
        near = queries.astype(np.float64)
        norms = np.sqrt((near**2).sum(axis=1))
        bound = np.full((len(queries), len(tree.kids)), -np.inf)
        alive = np.zeros(bound.shape, bool)
        alive[:, 0] = True
        leaves = []
        for level in tree.levels():
            reach = near @ tree.centres[level].T + norms[:, None] * tree.radii[level]
            reach += 1e-9 * (np.abs(reach) + norms[:, None] * (tree.radii[level] + np.sqrt((tree.centres[level] ** 2).sum(axis=1)))) + 1e-6
            bound[:, level] = reach
            alive[:, level] &= reach >= floor[:, None]
            for node in level:
                for kid in tree.kids[node]:
                    alive[:, kid] = alive[:, node]
                if not tree.kids[node]:
                    leaves.append(node)
        leaves = np.array(leaves)
        reach = np.where(alive[:, leaves], bound[:, leaves], -np.inf)
        ranked = np.argsort(-reach, axis=1, kind="stable")
        rows = np.arange(len(queries))
        found = (np.empty(0, np.int64),) * 3
        for turn in range(len(leaves)):
            leaf = ranked[:, turn]
            best = reach[rows, leaf]
            going = (best >= floor) & (best > -np.inf)
            if not going.any():
                break
            parts = [found]
            for at in np.unique(leaf[going]):
                asked = rows[going & (leaf == at)]
                a, b = tree.start[leaves[at]], tree.stop[leaves[at]]
                for c in range(a, b, 4 * LEAF_ROWS):
                    score = self.scores(queries[asked], c, min(b, c + 4 * LEAF_ROWS))
                    ids = self.ids[c : min(b, c + 4 * LEAF_ROWS)]
                    q, p = np.nonzero((score >= floor[asked][:, None]) & (ids[None, :] != own[asked][:, None]))
                    parts.append((asked[q], ids[p], score[q, p]))
            found = _best(*map(np.concatenate, zip(*parts)), k)
            counts = np.bincount(found[0], minlength=len(queries))
            full = counts >= k
            last = np.cumsum(counts) - 1
            floor[full] = np.maximum(floor[full], found[2][last[full]])
        return found


def _best(rows: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of every query row, in order of row, falling score, rising id."""
    order = np.lexsort((ids, -scores.astype(np.float64) if len(scores) and scores.min() == LOWEST else -scores, rows))
    rows, ids, scores = rows[order], ids[order], scores[order]
    first = np.searchsorted(rows, rows, side="left")
    keep = np.arange(len(rows)) - first < k
    return rows[keep], ids[keep], scores[keep]


def _whole(vectors: pd.Series, scale: float) -> np.ndarray:
    near = np.floor(scale * np.stack([np.asarray(v, np.float64) for v in vectors]))
    if near.size and np.abs(near).max() >= 2.0**62:
        return np.array([[max(-LONG - 1, min(LONG, int(x))) for x in row] for row in near], object)
    return near.astype(np.int64)


def top_k(
    rows: DataFrame, queries: Column, k: int = 20, scale: float = 64.0, row_id: str = "vec_id", vector: str = "embedding", shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """The k best candidates of every row for which `queries` holds: query_id, rank, vec_id, score.

    `queries` is a condition on the columns id and v of the usable rows.
    """
    spark = shipped(rows.sparkSession)
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    usable = rows.select(F.col(row_id).cast("long").alias("id"), F.col(vector).alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull() & fine)
    total = usable.count()
    cores = spark.sparkContext.defaultParallelism
    shards = max(1, math.ceil(total / shard_rows), min(2 * cores, math.ceil(total / 1024)))
    held = written(
        usable.repartition(shards).select(F.spark_partition_id().alias("shard"), F.lit(0).alias("kind"), "id", "v", F.lit(None).cast("long").alias("floor")),
        "shards",
    )
    asked = held.where(queries).select("id", "v").distinct()
    home = F.pmod(F.xxhash64("id", "v"), F.lit(shards)).cast("int")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, parts, trees = None, [], {}
        for batch in batches:
            for shard, part in batch.groupby("shard", sort=True):
                if shard != at:
                    at, parts, trees = shard, [], {}
                points, wanted = part[part["kind"] == 0], part[part["kind"] == 1]
                if len(points):
                    parts.append(points)
                if not len(wanted):
                    continue
                if parts:
                    known = pd.concat(parts)
                    for length, same in known.groupby(known["v"].map(len)):
                        trees[length] = Shard(same["id"].to_numpy(np.int64), _whole(same["v"], scale))
                    parts = []
                for length, same in wanted.groupby(wanted["v"].map(len)):
                    if length not in trees:
                        continue
                    for a in range(0, len(same), QUERY_BLOCK):
                        block = same.iloc[a : a + QUERY_BLOCK]
                        own = block["id"].to_numpy(np.int64)
                        floor = np.array([LOWEST if x is None else int(x) for x in block["floor"]], np.int64)
                        at_row, ids, scores = trees[length].search(own, _whole(block["v"], scale), floor, k)
                        places = block["place"].to_numpy()
                        yield pd.DataFrame({"query_id": own[at_row], "place": places[at_row], "vec_id": ids, "score": scores})

    def wave(sent: DataFrame) -> DataFrame:
        both = held.withColumn("place", F.lit(0).cast("long")).unionByName(sent)
        dealt = both.withColumn("floor", F.col("floor").cast("string")).repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "kind")
        return dealt.mapInPandas(search, "query_id long, place long, vec_id long, score long")

    asked = asked.withColumn("place", F.xxhash64("v")).withColumn("home", home)
    first = written(
        wave(asked.select(F.col("home").alias("shard"), F.lit(1).alias("kind"), "id", "v", F.lit(None).cast("long").alias("floor"), "place")), "top-first"
    )
    floors = first.groupBy("query_id", "place").agg(F.min("score").alias("floor"), F.count("*").alias("n")).where(F.col("n") >= k).drop("n")
    others = F.explode(F.filter(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: s != F.col("home")))
    sent = (
        asked.withColumnRenamed("id", "query_id")
        .join(floors, ["query_id", "place"], "left")
        .select(others.alias("shard"), F.lit(1).alias("kind"), F.col("query_id").alias("id"), "v", "floor", "place")
    )
    best = Window.partitionBy("query_id", "place").orderBy(F.desc("score"), "vec_id")
    return (
        first.unionByName(wave(sent))
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
