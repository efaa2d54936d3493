"""Toxicity by compression distance: two zstandard dictionaries, one of ordinary and one of toxic text.

A match of a few bytes saves zstandard nothing in a window of ordinary length, so words are first written in a wide code: three
five-byte hashes, of the word's first four letters, its first six and the whole word. The ordinary dictionary holds the codes
that most ordinary documents share; the toxic dictionary holds the same and those that occur in toxic documents more
often than chance allows (a G-test against twice the logarithm of the number of codes tried). Both compress every
window of WINDOW words, and the difference of the two lengths, in bytes, says how much better toxic text explains the window.
Windows without any code that only the toxic dictionary has get no shorter by it and count as 0 without being compressed.

A document's score is a logistic function of its largest and second largest window difference, their sum above one
byte, and its number of windows. The function is fitted on differences that come from dictionaries trained without the
document (two folds), so the thresholds hold for unseen text; the final dictionaries use both folds.

Training reads at most MOST_TOXIC + MOST_ORDINARY labelled documents, those with the smallest hash of their id. Where that
leaves some out, the fit weighs each kind by how many documents are so labelled over how many were read, so the scores
follow the share of toxic documents in all labels, whatever the input's size. All else covers every document and every word.

Defined results: null and empty texts, and texts without letters, have no window and get the score of a document
without evidence. Documents with several labels count as toxic if any of them is; null labels are left out. Without
toxic or without ordinary examples every score is the share of toxic ones (0 without any example). Only the named
columns are read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelens.llm.columns import written
from lakelens.llm.shared import shipped, tidy
from lakelens.llm.shingles import steps

MOST_TOXIC, MOST_ORDINARY = 4_000, 8_000
WINDOW = 8
LEVEL = 19
CODE_BYTES = 5
MOST_COMMON, MOST_MARKED = 8_000, 4_000
FEATURES = 4
KEPT_WORDS = 100_000


def codes(word: str) -> list[bytes]:
    parts = ("4" + word[:4], "6" + word[:6], "$" + word)
    return [xxhash.xxh3_64_intdigest(part).to_bytes(8, "little")[:CODE_BYTES] for part in parts]


def words_of(texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words (runs of letters, lower case), every word's index among them, and the bounds of each text's words."""
    column = pc.fill_null(pa.array(texts, pa.large_string()), "")
    split = pc.ascii_split_whitespace(pc.replace_substring_regex(pc.utf8_lower(column), r"[^\p{L}]+", " "))
    coded, offsets = split.flatten().dictionary_encode(), split.offsets.to_numpy()
    names, at = coded.dictionary.to_pylist(), coded.indices.to_numpy()
    keep = np.array([name != "" for name in names], bool)[at] if len(at) else np.zeros(0, bool)
    before = np.concatenate([[0], np.cumsum(keep)])
    return names, at[keep], before[offsets - offsets[0]]


@dataclass(frozen=True)
class Model:
    common: bytes
    marked: bytes
    weights: tuple[float, ...] = ()
    centre: tuple[float, ...] = ()
    scale: tuple[float, ...] = ()
    share: float = 0.0

    def scores(self, features: np.ndarray) -> np.ndarray:
        if not self.weights:
            return np.full(len(features), self.share)
        z = (features - np.array(self.centre)) / np.array(self.scale) @ np.array(self.weights[1:]) + self.weights[0]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Comparer:
    """Window differences under a model's two dictionaries, with the codes of words seen lately kept."""

    def __init__(self, model: Model):
        settings = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_checksum=0, write_content_size=0, write_dict_id=0
        )

        def compressor(content: bytes):
            words = zstandard.ZstdCompressionDict(content.ljust(8, b"\0"), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            words.precompute_compress(compression_params=settings)
            return zstandard.ZstdCompressor(dict_data=words, compression_params=settings)

        self.ordinary, self.toxic = compressor(model.common), compressor(model.common + model.marked)
        self.marked = {model.marked[i : i + CODE_BYTES] for i in range(0, len(model.marked), CODE_BYTES)}
        self.known: dict[str, tuple[bytes, bool]] = {}

    def _word(self, word: str) -> tuple[bytes, bool]:
        if word not in self.known:
            parts = codes(word)
            self.known[word] = b"".join(parts), not self.marked.isdisjoint(parts)
        return self.known[word]

    def features(self, texts: list[str | None]) -> np.ndarray:
        rows = np.zeros((len(texts), FEATURES))
        if len(self.known) > KEPT_WORDS:
            self.known.clear()
        names, at, bounds = words_of(texts)
        known = [self._word(name) if name else (b"", False) for name in names]
        hits = np.flatnonzero(np.array([mark for _, mark in known], bool)[at]) if len(at) else np.zeros(0, np.int64)
        owner = np.searchsorted(bounds, hits, side="right") - 1
        rows[:, 3] = np.log1p(-(-np.diff(bounds) // WINDOW))
        for text, window in sorted(set(zip(owner.tolist(), ((hits - bounds[owner]) // WINDOW).tolist()))):
            a = bounds[text] + window * WINDOW
            data = b"".join([known[i][0] for i in at[a : min(a + WINDOW, bounds[text + 1])].tolist()])
            gain = len(self.ordinary.compress(data)) - len(self.toxic.compress(data))
            row = rows[text]
            row[0], row[1] = max(row[0], gain), max(min(row[0], gain), row[1])
            row[2] += max(0, gain - 1)
        rows[:, 2] = np.log1p(rows[:, 2])
        return rows


def held_out(doc_id: Column) -> Column:
    """Documents that are kept out of training: crc32 of the id as text is divisible by five."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def _sample(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str) -> tuple[DataFrame, dict[bool, int]]:
    """The labelled texts to learn from, one per id (that of the least hash), and how many ids have each label."""
    judged = (
        labels.select(F.col(doc_id).alias("doc_id"), F.col(label).alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg((F.max("label") > 0).alias("toxic"))
        .withColumn("hash", F.xxhash64(F.lit(7), "doc_id"))
    )
    most = {True: MOST_TOXIC, False: MOST_ORDINARY}
    labelled = {row["toxic"]: row["count"] for row in judged.groupBy("toxic").count().collect()}
    some = [judged.where(F.col("toxic") == t).orderBy("hash", "doc_id").limit(n) for t, n in most.items()]
    chosen = written(some[0].unionByName(some[1]), "labelled")
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    parts = 2 * docs.sparkSession.sparkContext.defaultParallelism
    fold = F.pmod(F.col("hash"), F.lit(2)).cast("int").alias("fold")
    # At most MOST_TOXIC + MOST_ORDINARY ids go to every task; an id on many rows is reduced to one text before the shuffle.
    one = (
        texts.join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "toxic", "hash")
        .agg(F.min(F.struct(F.xxhash64("text").alias("mark"), "text")).alias("one"))
    )
    return written(one.select("toxic", fold, F.col("one.text").alias("text")).repartition(parts), "sample"), labelled


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents of each kind that have a code, per task."""
    counts: Counter = Counter()
    for batch in batches:
        texts = batch["text"].tolist()
        kinds = (2 * batch["toxic"].astype(int) + batch["fold"]).tolist()
        for a, b in steps(texts):
            names, at, bounds = words_of(texts[a:b])
            known = [codes(name) if name else [] for name in names]
            for i, kind in enumerate(kinds[a:b]):
                own = {code for word in np.unique(at[bounds[i] : bounds[i + 1]]).tolist() for code in known[word]}
                counts.update((code, kind) for code in own)
    pairs = list(counts.items())
    for a in range(0, len(pairs), 100_000):
        some = pairs[a : a + 100_000]
        yield pd.DataFrame({"code": [p[0][0] for p in some], "kind": [p[0][1] for p in some], "n": [p[1] for p in some]})


def _g_test(a: Column, b: Column, toxic: float, ordinary: float) -> Column:
    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    n, k = toxic + ordinary, a + b
    return 2 * (
        part(a, k * toxic / n) + part(b, k * ordinary / n) + part(toxic - a, (n - k) * toxic / n) + part(ordinary - b, (n - k) * ordinary / n)
    )


def _dictionaries(counts: DataFrame, sizes: dict[int, int], weights: dict[bool, float], folds: tuple[int, ...]) -> Model:
    toxic, ordinary = (float(sum(sizes.get(2 * t + f, 0) for f in folds)) for t in (1, 0))
    share = weights[True] * toxic / max(1.0, weights[True] * toxic + weights[False] * ordinary)
    if not toxic or not ordinary:
        return Model(b"", b"", share=share)
    a, b = (sum((F.col(f"k{2 * t + f}") for f in folds), F.lit(0)) for t in (1, 0))
    table = counts.select("code", a.cast("double").alias("a"), b.cast("double").alias("b"))
    common = table.where("b >= 2").orderBy(F.desc("b"), "code").limit(MOST_COMMON).collect()
    tried = table.where("a >= 2")
    marked = (
        tried.where((F.col("a") / toxic > 4 * (F.col("b") + 0.5) / ordinary) & (F.col("a") >= 3))
        .withColumn("g", _g_test(F.col("a"), F.col("b"), toxic, ordinary))
        .where(F.col("g") > 2 * math.log(max(2, tried.count())))
        .orderBy(F.desc("g"), "code")
        .limit(MOST_MARKED)
        .collect()
    )
    return Model(b"".join(bytes(r["code"]) for r in reversed(common)), b"".join(bytes(r["code"]) for r in reversed(marked)), share=share)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    centre, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    z = np.hstack([np.ones((len(x), 1)), (x - centre) / scale])
    w, penalty = np.zeros(z.shape[1]), np.diag([1e-6] + [ridge] * x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve(z.T @ (z * (weight * (p * (1 - p) + 1e-9))[:, None]) + penalty, z.T @ (weight * (y - p)) - penalty @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w, centre, scale


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    shipped(docs.sparkSession)
    sample, labelled = _sample(docs, labels, doc_id, text, label)
    sizes = {2 * int(r["toxic"]) + r["fold"]: r["count"] for r in sample.groupBy("toxic", "fold").count().collect()}
    weights = {t: max(1.0, labelled.get(t, 0) / max(1, sum(sizes.get(2 * int(t) + fold, 0) for fold in (0, 1)))) for t in (True, False)}
    kinds = [F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(f"k{k}") for k in range(4)]
    counts = written(sample.mapInPandas(_counted, "code binary, kind int, n long").groupBy("code").agg(*kinds).where("k0 + k1 + k2 + k3 >= 2"), "codes")
    model = _dictionaries(counts, sizes, weights, (0, 1))
    if not model.marked:
        return model
    others = {fold: _dictionaries(counts, sizes, weights, (1 - fold,)) for fold in (0, 1)}
    if not all(other.marked for other in others.values()):
        others = {0: model, 1: model}

    def crossed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        comparers = {fold: Comparer(other) for fold, other in others.items()}
        for batch in batches:
            for fold, part in batch.groupby("fold"):
                texts, toxic = part["text"].tolist(), part["toxic"].to_numpy()
                for a, b in steps(texts):
                    rows = comparers[fold].features(texts[a:b])
                    yield pd.DataFrame(rows, columns=[f"f{i}" for i in range(FEATURES)]).assign(toxic=toxic[a:b].astype(float))

    schema = ", ".join(f"f{i} double" for i in range(FEATURES)) + ", toxic double"
    rows = sample.mapInPandas(crossed, schema).toPandas().sort_values([f"f{i}" for i in range(FEATURES)]).to_numpy()
    w, centre, scale = _logistic(rows[:, :FEATURES], rows[:, FEATURES], np.where(rows[:, FEATURES] > 0, weights[True], weights[False]))
    return Model(model.common, model.marked, tuple(w.tolist()), tuple(centre.tolist()), tuple(scale.tolist()), model.share)


def score(model: Model, text: Column) -> Column:
    """The score of a text, 0 to 1; reads whole texts, a few million characters at a time."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        yield from tidy(scores)(batches)

    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        comparer = Comparer(model)
        for texts in batches:
            values = texts.tolist()
            parts = [model.scores(comparer.features(values[a:b])) for a, b in steps(values)]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return scored(text)
