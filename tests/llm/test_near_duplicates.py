"""Near duplicates against all pairs, and the parts they are made of."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lakelens.llm import near_duplicates as operator
from lakelens.llm import components as stars
from lakelens.llm.columns import perhaps_among
from lakelens.llm.components import components
from lakelens.llm.near_duplicates import SIZE, least_shared, missed, near_duplicates, sketches
from lakelens.llm.shingles import shingle_sets

SCHEMA = "doc_id long, text string, node string"


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c < "\x80" else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


def groups(rows):
    """component id per row, by comparing all pairs."""
    sets = [shingles(text) for _, text, *_ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= 85 * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, *_) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return [least.get(find(i)) if sets[i] else rows[i][0] for i in range(len(rows))], sets


def make_rows(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 6, 30, 120, 400]))]
        for _ in range(rng.choice([1, 1, 2, 6])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((len(rows), rng.choice([" ", "\n", " \t"]).join(copy), "x"))
    base = [rng.choice(vocabulary) for _ in range(200)]
    for _ in range(60):  # a group of copies whose links stand on both sides of the bound
        copy = list(base)
        for _ in range(rng.randint(0, 5)):
            copy[rng.randrange(200)] = rng.choice(vocabulary)
        rows.append((len(rows), " ".join(copy), "x"))
    rows += [(900, None, ""), (901, "", ""), (902, " \n\t", ""), (903, "One two", ""), (904, "oNE  two", ""), (905, "one two three", "")]
    rows += [(906, "same id and text here now", ""), (906, "same id and text here now", ""), (None, rows[0][1], ""), (None, "only null ids here in this", "")]
    rows += [(907, "É" * 10 + " é a b c", ""), (908, "é" * 10 + " é a b c", ""), (909, " ".join(vocabulary * 100), "")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    rows = make_rows(seed)
    found = near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    expected, sets = groups(rows)
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in found), key=str) == sorted(
        ((row[0], len(s), c, row[0] == c) for row, s, c in zip(rows, sets, expected)), key=str
    )


def test_stage_keeps_one(spark):
    """One row of each group, also if several share the smallest id or all ids are null."""
    base = [[f"u{g}x{i}" for i in range(100)] for g in range(4)]
    near = lambda g: " ".join([*base[g][:99], "other"])
    whole = lambda g: " ".join(base[g])
    rows = [(1, whole(0), ""), (1, near(0), ""), (2, whole(0), ""), (None, whole(1), ""), (None, near(1), ""), (None, whole(2), ""), (3, near(2), "")]
    rows += [(None, whole(3), ""), (None, whole(3), ""), (None, None, ""), (5, "", "")]
    kept = corpus_pipeline.remove_near_duplicates(spark, spark.createDataFrame(rows, SCHEMA), "").collect()
    groups_of = sorted((r["text"].split()[0][:2], r["doc_id"]) for r in kept if r["text"])
    assert groups_of == [("u0", 1), ("u1", None), ("u2", 3), ("u3", None)] and len(kept) == 6


def test_sketch_agrees_as_sets_do():
    rng = np.random.default_rng(1)
    agreed = []
    for _ in range(60):
        items = rng.integers(0, 1 << 62, 300, dtype=np.uint64)
        a, b = sketches([np.unique(items[:250]), np.unique(items[50:])])
        agreed.append((a == b).mean())
    assert abs(np.mean(agreed) - 200 / 300) < 0.02
    assert (sketches([np.array([7], np.uint64)]) < 2**63).all()  # one element fills every coordinate
    assert sketches([np.arange(5, dtype=np.uint64)]).shape == (1, SIZE)


def test_shingles_of_batches():
    texts = ["", "a", "a b c d e f", " A  b\tc d E f ", "x " * 50]
    assert [len(s) for s in shingle_sets(texts)] == [len(shingles(t)) for t in texts]
    assert (shingle_sets(texts)[2] == shingle_sets(texts)[3]).all()


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100 + i, 100) for i in range(50)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}

    def find(i):
        return i if root.get(i, i) == i else find(root[i])

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    nodes = {n for e in edges for n in e}
    assert {n: found.get(n, n) for n in nodes} == {n: find(n) for n in nodes}


@pytest.mark.parametrize(("share", "least", "most"), [(1000, 1, 1), (20, 2, 30)])
def test_components_in_shares(spark, monkeypatch, share, least, most):
    """Edges that fit one share take one step; rounds join those of several. Chains, a star, repeats, loops and nulls."""
    chain = lambda start, n: [(i + 1, i) if i % 3 else (i, i + 1) for i in range(start, start + n)]
    edges = chain(0, 60) + chain(100, 20) + [(200, 200 + i) for i in range(1, 30)] + [(5, 5), (7, 8), (None, 3), (4, None), (300, 300)]
    named = spark.createDataFrame(edges, "a long, b long").select(*[F.unhex(F.lpad(F.hex(c), 16, "0")).alias(c) for c in "ab"])
    steps = []
    write = stars.written
    monkeypatch.setattr(stars, "SHARE_EDGES", share)
    monkeypatch.setattr(stars, "written", lambda df, label: (steps.append(label), write(df, label))[1])
    found = sorted((int.from_bytes(r["node"]), int.from_bytes(r["root"])) for r in components(named).collect())
    assert found == [(i, 0) for i in range(1, 61)] + [(100 + i, 100) for i in range(1, 21)] + [(200 + i, 200) for i in range(1, 30)]
    assert least <= len(steps) <= most
    assert components(named.where("a = b")).collect() == []


def test_rounds_without_links(spark, monkeypatch):
    """Components are joined anew only where a round or the last comparison has found a link."""
    joined, join = [], operator.components
    monkeypatch.setattr(operator, "components", lambda edges: (joined.append(1), join(edges))[1])
    monkeypatch.setattr(operator, "LARGE_KEY", 2)
    rng = random.Random(4)
    rows = []
    for i in range(150):  # texts that share keys and are no links
        words = [f"t{j}" for j in range(300)]
        for slot in range(24):
            words[6 + 12 * slot] = f"slot{slot}v{rng.randrange(40)}"
        rows.append((i, " ".join(words), "x"))
    found = near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert all(r["kept"] for r in found) and len(found) == 150 and len(joined) == 1


def test_pairs_between_the_bounds(spark):
    """The pipeline's stage takes pairs of similarity 0.80 to 0.85 for near copies; the operator at 85 does not."""
    rng = random.Random(11)
    rows = []
    for i in range(40):
        base = [f"v{i}x{j}" for j in range(rng.randint(150, 300))]
        copy = base[: len(base) - round(len(base) * rng.uniform(0.16, 0.185))]
        rows += [(2 * i, " ".join(base), "x"), (2 * i + 1, " ".join(copy), "x")]
        ratio = len(shingles(rows[-1][1])) / len(shingles(rows[-2][1]))
        assert 0.8 <= ratio < 0.85
    docs = spark.createDataFrame(rows, SCHEMA)
    assert {r["doc_id"] for r in corpus_pipeline.remove_near_duplicates(spark, docs, "").collect()} == {2 * i for i in range(40)}
    assert all(r["kept"] for r in near_duplicates(docs, percent=85).collect())
    assert missed(85, least_shared(85)) < 5e-6 and missed(80, least_shared(80)) < 5e-6 and least_shared(85) == 3


def forms(n, seed):
    """One form of 300 words with five slots of 60 values: two of them are linked if they share a value at least."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = [f"t{j}" for j in range(300)]
        for slot in range(5):
            words[30 + 55 * slot] = f"slot{slot}v{rng.randrange(60)}"
        rows.append((i, " ".join(words), "x"))
    return rows


def test_forms(spark, monkeypatch):
    """Equal to all pairs, with pairs that grow as the documents do."""
    counts = []
    compare = operator.links
    monkeypatch.setattr(operator, "links", lambda pairs, sets, percent: (counts.append(pairs.count()), compare(pairs, sets, percent))[1])
    made = {}
    for n in (250, 1000):
        counts.clear()
        rows = forms(n, n)
        found = {r["doc_id"]: r["component_id"] for r in near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
        made[n] = sum(counts)
        if n == 250:
            assert [found[i] for i in range(n)] == groups(rows)[0]
    assert made[1000] < 8 * made[250] + 1000


def test_parities_bound_the_difference():
    rng = np.random.default_rng(3)
    for size in (1, 30, 900, 6000):
        a, b = (np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64)) for _ in range(2))
        b = np.unique(np.concatenate([a[: size // 2], b[size // 2 :]]))
        one, other = operator._short(a), operator._short(b)
        differing = sum(int(x).bit_count() for x in (operator.parities(one) ^ operator.parities(other)).view(np.uint64))
        assert differing <= len(np.setxor1d(operator._long(one), operator._long(other)))
    assert (operator.parities(b"") == 0).all()


def test_members_without_links_are_not_paired(spark, monkeypatch):
    """Texts that share keys and shingles with all others of a large group, and are no links."""
    rng = random.Random(4)
    rows = []
    for i in range(300):
        words = [f"t{j}" for j in range(300)]
        for slot in range(24):
            words[6 + 12 * slot] = f"slot{slot}v{rng.randrange(3)}"
        rows.append((i, " ".join(words), "x"))
    sets = [shingles(text) for _, text, _ in rows]
    linked = [(i, j) for j in range(300) for i in range(j) if 9 * len(sets[i] & sets[j]) >= 4 * (len(sets[i]) + len(sets[j]))]
    joined, compare = [], operator.links
    monkeypatch.setattr(operator, "links", lambda pairs, sets, percent: (joined.append(pairs.count()), compare(pairs, sets, percent))[1])
    found = {r["doc_id"]: r["component_id"] for r in near_duplicates(spark.createDataFrame(rows, SCHEMA), 80).collect()}
    assert joined[-1] <= 10 * len(rows) and all(found[i] == found[j] for i, j in linked)
    assert len(set(found.values())) >= len(rows) - len(linked)


def test_perhaps_among(spark):
    """No hash of the table is ruled out, most others are; a null hash is in no table."""
    rows = spark.range(5000).select("id", F.xxhash64("id").alias("h")).unionByName(spark.createDataFrame([(None, None)], "id long, h long"))
    marked = perhaps_among(rows, F.col("h"), rows.where("id < 100").select("h"))
    assert marked.columns == ["id", "h", "perhaps"] and marked.where("perhaps AND id < 100").count() == 100
    assert marked.where("perhaps").count() < 120 and marked.where("perhaps IS NULL").count() == 0 and marked.count() == 5001


def test_stage_with_clashing_columns(spark):
    rows = [(i, f"text number {i} of these few words here", i, i, i) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, word int, Bits int, perhaps int")
    gone = docs.where("doc_id < 7").select("doc_id", F.xxhash64("doc_id", "text").alias("row"))
    kept = corpus_pipeline._without(docs, gone)
    assert sorted(map(tuple, kept.collect())) == rows[7:] and kept.columns == docs.columns
