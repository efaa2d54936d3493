"""Centroid clusters and vector codes against plain full searches in Python integers."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakelens.llm import centroids, vector_codes as codes
from lakelens.llm.whole_vectors import MOST

SCHEMA = "vec_id long, embedding array<double>, label string, distance string, v string"


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def whole(v):
    return tuple(math.floor(max(-float(MOST), min(float(MOST), 1024.0 * x))) for x in v)


def gap(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b))


def nearest(v, entries):
    return min((gap(v, e), i) for i, e in enumerate(entries))


def moved(entries, groups):
    return [tuple(sum(c) // len(own) for c in zip(*own)) if (own := groups.get(i)) else e for i, e in enumerate(entries)]


def clusters(rows, k, rounds, dims):
    kept = [(i, whole(v)) for i, v, _ in rows if usable(v) and len(v) == dims]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    centres = [v for _, v in order[:k]]
    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[nearest(v, centres)[1]].append(v)
        centres = moved(centres, groups)
    last = [(i, *nearest(v, centres)) for i, v in kept]
    inertia = Counter()
    for _, d, c in last:
        inertia[c] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, c, d, inertia[c], sum(inertia.values()), digest[c]) for i, d, c in last), key=str)


def coded(rows, parts, size, rounds):
    fine = sorted(((i, whole(v), label) for i, v, label in rows if usable(v) and v and len(v) % parts == 0), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in fine if len(r[1]) == len(fine[0][1])] if fine else []
    width = len(kept[0][1]) // parts if kept else 0
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for _, v, _ in kept[:size]] for p in range(parts)]
    for _ in range(rounds):
        for p in range(parts):
            groups = defaultdict(list)
            for _, v, _ in kept:
                groups[nearest(cut(v, p), books[p])[1]].append(cut(v, p))
            books[p] = moved(books[p], groups)
    found, by_label = [], Counter()
    for i, v, label in kept:
        best = [nearest(cut(v, p), books[p]) for p in range(parts)]
        found.append((i, "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best), label))
        by_label[label] += found[-1][2]
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    return sorted(((i, code, error, by_label[label], digest) for i, code, error, label in found), key=str)


def make_rows(dims, n=260):
    rng = random.Random(dims)
    rows = [(i, [rng.gauss(i % 3, 0.3) for _ in range(dims)], rng.choice(["a", "b", None])) for i in range(n)]
    rows += [(1000 + i, [0.5] * dims, "hot") for i in range(n // 2)]  # a third of all rows is one vector
    rows += [(2000, None, "a"), (2001, [math.nan] * dims, "a"), (2002, [math.inf] * dims, "a"), (2003, [None] * dims, "a"), (2004, [1.0], "a"), (2005, [], "a")]
    return rows + [(None, [0.25] * dims, None), (None, [0.75] * dims, "b"), (3, rows[3][1], "a"), (3, [9.0] * dims, "b"), (4000, [1e30] * dims, "b")]


def frame(spark, rows):
    return spark.createDataFrame([(*row, "x", "y") for row in rows], SCHEMA).repartition(5)


@pytest.mark.parametrize("k, leading", [(8, 4), (3, 16)])
def test_clusters(spark, k, leading):
    rows = make_rows(8)
    found = centroids.centroid_clusters(frame(spark, rows), k, 4, 8, leading=leading).collect()
    assert sorted(map(tuple, found), key=str) == clusters(rows, k, 4, 8)


@pytest.mark.parametrize("size", [16, 600])
def test_codes(spark, size):
    rows = make_rows(8)
    found = codes.vector_codes(frame(spark, rows), 4, size, 2).collect()
    expected = coded(rows, 4, size, 2)
    if size > 256:  # more entries than two digits name
        assert all(len(row["code"]) == 12 for row in found)
        assert sorted(row["error"] for row in found) == sorted(row[2] for row in expected)
    else:
        assert sorted(map(tuple, found), key=str) == expected


def test_few_vectors(spark):
    rows = [(7, [0.1, 0.2, 0.3, 0.4], "a"), (5, [1.0, 2.0, 3.0, 4.0], None)]
    assert sorted(map(tuple, centroids.centroid_clusters(frame(spark, rows), 8, 3, 4).collect()), key=str) == clusters(rows, 8, 3, 4)
    assert sorted(map(tuple, codes.vector_codes(frame(spark, rows)).collect()), key=str) == coded(rows, 4, 256, 4)
    odd = [(1, [1.0, 2.0, 3.0], "a"), (2, None, "a")]
    assert codes.vector_codes(frame(spark, odd)).count() == 0
    assert centroids.centroid_clusters(frame(spark, odd), dims=4).count() == 0


def test_pruning():
    """The bounds are below the distances, and spare evaluations where the vectors have any structure."""
    rng = np.random.default_rng(4)
    rows = (rng.normal(0, 1, (3000, 16)) * np.geomspace(400, 4, 16)).astype(np.int64)
    entries = rows[:64]
    pivots = codes.pivots_of(entries)
    known = codes.distances(rows, pivots)
    assert (np.abs(known[:, None, :] - codes.distances(entries, pivots)).max(axis=2) <= codes.distances(rows, entries) + 1e-6).all()
    label, best, tried = codes.nearest(rows, known, entries, pivots)
    every = ((rows[:, None, :] - entries) ** 2).sum(axis=2)
    assert (label == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all() and tried < 0.6 * every.size
    turned = centroids.Rotation(rows.mean(axis=0), np.linalg.eigh(np.cov(rows.T))[1][:, ::-1][:, :4])
    label, best, tried = centroids.nearest(rows, *turned.turned(rows), entries, turned)
    assert (label == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all() and tried < 0.3 * every.size


def test_clusters_on_the_table(spark):
    """Reruns agree, whatever the partitions."""
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    one, two = (centroids.centroid_clusters(df).orderBy("vec_id").collect() for df in (rows, rows.repartition(7).withColumn("cluster", F.lit(1))))
    assert one == two
