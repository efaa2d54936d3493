"""Secrets in texts: fixed patterns, and character Markov models of random strings and of ordinary words.

Patterns (fixed values) give the base spans of three kinds: assign, access and hex. The model adds spans of kind `random`:
runs of token characters of at least LEAST_CHARS characters that no base span touches, hold a digit and two of the three
character classes, and whose log-likelihood under a character Markov model of random strings (the uniform one or the
learned one, whichever fits better) exceeds the one under a model of ordinary identifiers by at least a threshold a character.

Training. Both models are first-order chains over character classes with additive smoothing, trained from labelled samples: the
values of base spans (random) and runs of token characters that touch no base span (ordinary). The counts cover every
document; they are summed per task into tables of fixed size. The threshold lies three standard deviations below the mean score of
uniformly random runs of the least length, never below 0. Where the documents hold too few secrets to learn from, the
uniform model over letters and digits stands alone.

Defined results: a null text is empty and has no span. Positions are code points, ends exclusive. Texts of any length are
searched whole. Repeated rows give equal results. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakelens.llm.columns import written
from lakelens.llm.shared import shipped
from lakelens.llm.shingles import steps

# The patterns of the base spans, and the least length of what they catch.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_CHARS, ACCESS_CHARS = 6, 20
KINDS = ("assign", "access", "hex", "random")

#: Texts without a match of this need no closer look.
HINT = r"(?i:passw|secret|token|api_?key)|AKIA|[0-9a-f]{24}|[A-Za-z0-9+/_=-]{20}"
LEAST_CHARS = 20
RUN = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST_CHARS},}}")
WORD = re.compile(r"[A-Za-z0-9+/_=-]{8,}")
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
PLACE = {c: i for i, c in enumerate(ALPHABET)}
STATES = len(ALPHABET)
#: Smoothing, and the least number of characters seen from which the random model is learned.
PRIOR, LEAST_SEEN = 0.5, 2_000


def base_spans(text: str) -> list[tuple[int, int, int, int, int]]:
    """(start, kind, end, value start, value end) by start, then kind."""
    spans = [(m.start(), 0, m.end(), *m.span(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_CHARS]
    spans += [(m.start(), 1, m.end(), *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_CHARS]
    spans += [(m.start(), 2, m.end(), *m.span()) for m in HEX.finditer(text)]
    return sorted(spans)


def _hinted(texts: list[str]) -> list[int]:
    return np.flatnonzero(pc.match_substring_regex(pa.array(texts, pa.large_string()), HINT).to_numpy(zero_copy_only=False)).tolist()


def _pairs(run: str) -> np.ndarray:
    at = np.fromiter((PLACE.get(c, 0) for c in run), np.int64, len(run))
    return at[:-1] * STATES + at[1:]


def _outside(text: str, spans: list[tuple], pattern: re.Pattern) -> Iterator[tuple[int, int]]:
    """Matches of a pattern that touch no span; spans are sorted by start."""
    at, reach = 0, 0
    for m in pattern.finditer(text):
        while at < len(spans) and spans[at][0] < m.end():
            reach, at = max(reach, spans[at][2]), at + 1
        if reach <= m.start():
            yield m.span()


@dataclass(frozen=True)
class Model:
    #: Log-likelihood ratios of every pair of characters, a row per random model; the least mean ratio of a random run.
    ratios: np.ndarray
    threshold: float

    def mean_ratio(self, run: str) -> float:
        pairs = _pairs(run)
        return float(self.ratios[:, pairs].mean(axis=1).max()) if len(pairs) else -math.inf

    def spans(self, text: str) -> list[tuple]:
        found = base_spans(text)
        for a, b in list(_outside(text, found, RUN)):
            run = text[a:b]
            mixed = sum((any(c.islower() for c in run), any(c.isupper() for c in run), any(c.isdigit() for c in run)))
            if mixed >= 2 and any(c.isdigit() for c in run) and self.mean_ratio(run) >= self.threshold:
                found.append((a, 3, b, a, b))
        return sorted(found)


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Character pairs of labelled runs (1 random, 0 ordinary) in a task's documents."""
    counts = np.zeros((2, STATES * STATES), np.int64)
    for batch in batches:
        texts = [text or "" for text in batch["text"]]
        for a, b in steps(texts):
            part = texts[a:b]
            spans = {i: base_spans(part[i]) for i in _hinted(part)}
            for i, own in spans.items():
                for _, _, _, start, end in own:
                    np.add.at(counts[1], _pairs(part[i][start:end]), 1)
            # Ordinary words repeat, so each distinct one is coded once per step and counted as often as it occurs.
            split = pc.ascii_split_whitespace(pa.array([text for i, text in enumerate(part) if not spans.get(i)], pa.large_string())).flatten()
            seen = pc.value_counts(split)
            words = zip(seen.field("values").to_pylist(), seen.field("counts").to_pylist())
            coded = [(_pairs(m[0]), n) for word, n in words if len(word) >= 8 for m in WORD.finditer(word) if n]
            for i, own in spans.items():
                coded += [(_pairs(part[i][start:end]), 1) for start, end in (_outside(part[i], own, WORD) if own else ())]
            if coded:
                weights = np.repeat([n for _, n in coded], [len(p) for p, _ in coded])
                counts[0] += np.bincount(np.concatenate([p for p, _ in coded]), weights, STATES * STATES).astype(np.int64)
    label, pair = np.nonzero(counts)
    yield pd.DataFrame({"label": label, "pair": pair, "n": counts[label, pair]})


def train(docs: DataFrame, text: str = "text") -> Model:
    """Counts over all documents; the two tables of STATES * STATES sums are all that reaches the driver."""
    shipped(docs.sparkSession)
    parts = docs.select(F.col(text).alias("text")).mapInPandas(_counted, "label int, pair int, n long")
    counts = np.zeros((2, STATES * STATES))
    for row in written(parts.groupBy("label", "pair").agg(F.sum("n").alias("n")), "pairs").collect():
        counts[row["label"], row["pair"]] = row["n"]

    def chain(seen: np.ndarray) -> np.ndarray:
        table = seen.reshape(STATES, STATES) + PRIOR
        return (table / table.sum(axis=1, keepdims=True)).ravel()

    ordinary = chain(counts[0])
    # Secrets in a corpus may all be of one alphabet; strings over letters and digits are random as well.
    even = np.full((STATES, STATES), 1e-3)
    even[:62, :62] = 1.0
    even = (even / even.sum(axis=1, keepdims=True)).ravel()
    models = [even, chain(counts[1])] if counts[1].sum() >= LEAST_SEEN else [even]
    ratios = np.log(np.array(models)) - np.log(ordinary)
    weight = even / even.sum()
    mean = float((weight * ratios[0]).sum())
    spread = math.sqrt(float((weight * (ratios[0] - mean) ** 2).sum()))
    return Model(ratios, max(0.0, mean - 3 * spread / math.sqrt(LEAST_CHARS - 1)))


def find_secrets(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, spans (start, kind, end) in order, of every row."""

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [text or "" for text in batch["text"]]
            spans: list[list[tuple]] = [[] for _ in texts]
            for a, b in steps(texts):
                for i in _hinted(texts[a:b]):
                    spans[a + i] = [(s[0], KINDS[s[1]], s[2]) for s in model.spans(texts[a + i])]
            as_rows = [[{"start": s, "kind": k, "end": e} for s, k, e in own] for own in spans]
            yield pd.DataFrame({"doc_id": batch["doc_id"].to_numpy(), "spans": pd.Series(as_rows, dtype=object)})

    shipped(docs.sparkSession)
    kind = docs.schema[doc_id].dataType
    rows = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text"))
    result = rows.mapInPandas(found, "doc_id string, spans array<struct<start long, kind string, end long>>")
    return result.withColumn("doc_id", F.col("doc_id").cast(kind))


def digest(spans: list[tuple[int, str, int]]) -> str:
    """Lower-case hex SHA-256 of spans joined as kind:start:end, for tests and callers outside Spark."""
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, k, e in spans).encode()).hexdigest()
