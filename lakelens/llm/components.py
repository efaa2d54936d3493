"""Connected components of an edge table, by alternating large and small stars.

First every task joins an equal share of the edges, of bounded size, to stars: a node and the least one that the task's edges connect
it with. Where one share holds all edges that is the result; otherwise rounds follow.
Each round joins every edge with the least neighbour of its ends and sums nothing on the driver but a checksum; the
edges of a round are written to the shared scratch folder, so a lost executor costs one round at most.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakelens.llm.columns import written
from lakelens.llm.shared import shipped, tidy

#: Edges that one task joins before the rounds, at most.
SHARE_EDGES = 100_000


def _stars(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(u, v) for every node u that the edges (a, b) connect with a lesser one, and the least of these."""
    lesser = {}

    def least(node):
        while (other := lesser.get(node, node)) != node:
            lesser[node] = lesser.get(other, other)
            node = other
        return node

    for batch in batches:
        for a, b in zip(batch["a"], batch["b"]):
            a, b = least(a), least(b)
            if a != b:
                lesser[max(a, b)] = min(a, b)
    yield pd.DataFrame({"u": list(lesser), "v": [least(node) for node in list(lesser)]})


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b) that is not its component's least node, the root."""
    shipped(edges.sparkSession)
    edges = edges.select("a", "b").where("a <> b")
    shares = max(1, math.ceil(edges.count() / SHARE_EDGES))
    kind = edges.schema["a"].dataType.simpleString()
    stars, seen = written(edges.repartition(shares).mapInPandas(tidy(_stars), f"u {kind}, v {kind}"), "edges"), None
    while shares > 1 and (state := _state(stars)) != seen:
        seen = state
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            stars.join(least, "u").select("u", F.col("m").alias("v"))
        )
        large = written(large.where("u <> v").distinct(), "edges")
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            lowest.select("u", F.col("m").alias("v"))
        )
        stars = written(small.distinct(), "edges")
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
