"""Suffix arrays against sorted suffixes, and removed bytes against counts of all strings."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from lakelens.llm import repeated_bytes, suffix_arrays
from lakelens.llm.repeated_bytes import remove_repeats, segments
from lakelens.llm.suffix_arrays import permuted_prefixes, repeated_places, suffix_array


def common(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


@pytest.mark.parametrize("few", [4096, 1])
def test_suffix_array(monkeypatch, few):
    """Both kinds of scan, on random, repeated and constant strings."""
    monkeypatch.setattr(suffix_arrays, "FEW", few)
    monkeypatch.setattr(suffix_arrays, "BUCKET", 64 if few > 1 else 0)
    rng = random.Random(few)
    for _ in range(300):
        s = [rng.randint(1, rng.choice([1, 2, 3, 5])) for _ in range(rng.randint(0, 120))]
        s = (s * 3)[: len(s)] + [0] if rng.random() < 0.4 else s + [0]
        sa = suffix_array(np.array(s))
        assert sa.tolist() == sorted(range(len(s)), key=lambda i: s[i:])
        before, length = permuted_prefixes(np.array(s), sa)
        assert all(b < 0 or n == common(s[i:], s[b:]) for i, (b, n) in enumerate(zip(before.tolist(), length.tolist())))


def test_repeated_places():
    rng = random.Random(1)
    for _ in range(200):
        width, texts = rng.choice([3, 5]), [bytes(rng.choice(b"ab\0") for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(0, 5))]
        counts = Counter(t[i : i + width] for t in texts for i in range(len(t) - width + 1))
        assert [p.tolist() for p in repeated_places(texts, width)] == [[i for i in range(len(t) - width + 1) if counts[t[i : i + width]] > 1] for t in texts]


def test_segments_hold_each_string_once():
    rng = random.Random(2)
    texts = [bytes(rng.choice(b"abc ") for _ in range(n)) for n in (0, 19, 20, 21, 300, 500)] + [b"a" * 90]
    first, count, anchor, key = segments(b"".join(texts), [len(t) for t in texts], 20)
    places = [p for a, n in zip(first.tolist(), count.tolist()) for p in range(a, a + n)]
    starts = np.cumsum([0, *map(len, texts)])[:-1]
    assert places == [s + i for s, t in zip(starts.tolist(), texts) for i in range(len(t) - 19)]
    assert ((anchor >= first + count - 1) & (anchor < first + 20)).all() and len(key) == len(first)


def removed(rows, width):
    counts = Counter()
    for _, text in rows:
        data = (text or "").encode()
        counts.update(data[i : i + width] for i in range(len(data) - width + 1))
    out = []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - width + 1):
            if counts[data[i : i + width]] > 1:
                gone[i : i + width] = b"\1" * width
        spans = sum(1 for i in range(len(data)) if gone[i] and not (i and gone[i - 1]))
        kept = bytes(x for x, g in zip(data, gone) if not g)
        out.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def make_rows(seed, n):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 5))) for _ in range(30)]
    passages = [" ".join(rng.choice(words) for _ in range(rng.randint(3, 30))) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = [rng.choice([rng.choice(passages), " ".join(rng.choice(words) for _ in range(rng.randint(1, 8)))]) for _ in range(rng.randint(0, 5))]
        kind = rng.random()
        text = " ".join(parts)
        if kind < 0.1:
            text = rng.choice(["a", "ab\0"]) * rng.randint(0, 90)  # runs of every length
        elif kind < 0.4 and rows:
            text = rng.choice(rows)[1]  # exact copies
        rows.append((i if kind < 0.9 else None, text if kind < 0.97 else None))
    return rows + [(5, rows[0][1]), (5, rows[0][1]), (6, "é" * 4000), (7, "é" * 3999 + "x")]


def test_pieces_of_long_texts(monkeypatch):
    monkeypatch.setattr(repeated_bytes, "PIECE_BYTES", 100)
    texts = [b"x" * n for n in (0, 19, 20, 99, 119, 120, 121, 700, 5)]
    seen = Counter()
    for owners, data, sizes in repeated_bytes._pieces(texts, 20):
        assert len(data) == sum(sizes)
        seen.update((i, a + place) for (i, a), size in zip(owners, sizes) for place in range(size - 19))
    assert seen == Counter((i, place) for i, t in enumerate(texts) for place in range(len(t) - 19))


@pytest.mark.parametrize("width, key_bytes", [(20, 4 << 20), (20, 100), (40, 1000)])
def test_against_all_strings(spark, width, key_bytes):
    """Also with keys too large for a shard."""
    rows = make_rows(width, 150)
    df = spark.createDataFrame([(*row, 1, 2) for row in rows], "doc_id long, text string, id int, n_bytes int")
    found = remove_repeats(df, width, step_bytes=500, key_bytes=key_bytes).collect()
    assert sorted(map(tuple, found), key=str) == removed(rows, width)


def test_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    found = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, found.collect()), key=str) == removed(rows, 400)
    with pytest.raises(ValueError):
        remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), 10)
