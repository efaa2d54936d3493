"""What tasks hold at once stays bounded, and bounding it changes no result."""

from __future__ import annotations

from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
import public_tokenizers

from lakelens.llm import decontamination, shared, token_files

VOCABULARY = Path(public_tokenizers.path("byte_bpe_50k.json")).read_text(encoding="utf-8")


def test_scans_are_small(spark):
    before = spark.conf.get(shared.SCAN_SETTING)
    try:
        for given, kept in ((4096, shared.SCAN_ROWS), (100, 100)):
            spark.conf.set(shared.SCAN_SETTING, given)
            shared.shipped(spark)
            assert int(spark.conf.get(shared.SCAN_SETTING)) == kept
    finally:
        spark.conf.set(shared.SCAN_SETTING, before)


def test_documents_are_searched_in_steps(monkeypatch):
    held = []

    class Counted(decontamination.Canonical):
        def __init__(self, texts):
            held.append(sum(map(len, texts)))
            super().__init__(texts)

    monkeypatch.setattr(decontamination, "Canonical", Counted)
    text = "some words that stand for nothing at all, " * 2_000
    batch = pd.DataFrame({"doc": ["a"] * 20, "row": range(20), "text": [text] * 20})
    table = np.full(decontamination.TABLE_BITS // 8, 255, np.uint8)
    found = pd.concat(decontamination._hits(table, [], [])(iter([batch])))
    assert sum(held) == 20 * len(text) and max(held) <= (1 << 19) + len(text)
    assert found.groupby("row").size().nunique() == 1 and found["row"].nunique() == 20


class Counting:
    """A tokenizer that notes how many texts it sees at once."""

    def __init__(self, tokenizer):
        self.tokenizer, self.most = tokenizer, 0

    def __getattr__(self, name):
        return getattr(self.tokenizer, name)

    def encode_batch_fast(self, texts, **options):
        self.most = max(self.most, len(texts))
        return self.tokenizer.encode_batch_fast(texts, **options)


@pytest.mark.parametrize("collide", [False, True])
def test_pieces_go_through_the_tokenizer_in_portions(monkeypatch, collide):
    """Also where all pieces have one hash, so that only the pieces themselves tell them apart."""
    if collide:
        monkeypatch.setattr(token_files, "hashes_of", lambda words: np.zeros(len(words), np.uint64))
    encoder = token_files.Encoder(VOCABULARY)
    plain, encoder.tokenizer = encoder.tokenizer, Counting(encoder.tokenizer)
    many = " ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}x" for i in range(600 if collide else 17_000))
    texts = [many, "He said: yes, yes. He said no!", "", "a  b\n\nc\tyes. no!", many[: len(many) // 2]]
    monkeypatch.setattr(token_files, "RUN", 100)
    for _ in range(2):
        ids, lengths = encoder.encode(texts, 2)
        parts = np.split(ids, np.cumsum(lengths)[:-1])
        assert [part.tolist() for part in parts] == [plain.encode(text, add_special_tokens=False).ids + [2] for text in texts]
    assert 0 < encoder.tokenizer.most <= 32


def test_pieces_are_kept_between_steps(monkeypatch):
    """Of more distinct pieces than a few steps hold, none goes through the tokenizer again."""
    encoder, asked = token_files.Encoder(VOCABULARY), []
    new = encoder._new
    monkeypatch.setattr(encoder, "_new", lambda words: (asked.append(len(words)), new(words))[1])
    texts = ["w" + " w".join(map(str, range(a, a + 50_000))) for a in range(100_000, 600_000, 50_000)]
    first = [encoder.encode([text], 2)[0] for text in texts]
    assert sum(asked) >= 500_000
    asked.clear()
    again = [encoder.encode([text], 2)[0] for text in texts[:3]]
    assert sum(asked) == 0 and all((a == b).all() for a, b in zip(first, again))


def test_table_of_pieces():
    """Hashes that share their place; the table grows and every piece is found, of two with one hash at least one."""
    rng, pieces = np.random.default_rng(2), token_files.Pieces("<u2")
    names = np.array([f"p{i}" for i in range(6_000)], object)
    hashes = rng.integers(0, 1 << 63, len(names), dtype=np.uint64) * np.uint64(2)
    hashes[1_000:1_200] = (hashes[:200] & np.uint64(1023)) + (np.arange(1, 201, dtype=np.uint64) << np.uint64(40))
    hashes[1_300] = hashes[1_299]
    ids, lengths = rng.integers(0, 1 << 16, 3 * len(names)).astype("<u2"), np.full(len(names), 3)
    assert (pieces.find(pa.array(names), hashes) == -1).all()
    for a, b in [(0, 7), (7, 1_400), (1_400, 1_400), (1_400, 6_000)]:
        pieces.add(pa.array(names[a:b], pa.large_string()), hashes[a:b], ids[3 * a : 3 * b], lengths[a:b])
    found = pieces.find(pa.array(names, pa.large_string()), hashes)
    assert sorted(found[1_299:1_301].tolist()) in ([-1, 1_299], [-1, 1_300])
    assert (np.delete(found, [1_299, 1_300]) == np.delete(np.arange(6_000), [1_299, 1_300])).all()
    assert (pieces.take(found[:1_299])[0] == ids[:3_897]).all() and 2 * len(pieces) <= len(pieces.table)
    assert (pieces.find(pa.array(["other"], pa.large_string()), hashes[:1]) == -1).all()
