"""Top-k search, token files, Elias-Fano codes and WARC archives."""

from __future__ import annotations

import base64
import gc
import hashlib
import math
import random
import tracemalloc
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakelens.llm import token_files
from lakelens.llm.elias_fano import EliasFano
from lakelens.llm.shared import file_store
from lakelens.llm.token_files import TokenFile, read_token_files, token_folder, write_token_files
from lakelens.llm.top_k import top_k
from lakelens.llm.warc import archive_folder, read_records, transactions, with_revisited, write_archives

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def best(rows, k):
    usable = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in {(i, tuple(v)) for i, v in usable if i % 20 == 0}:
        scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in usable if i != q and len(a) == len(b))[:k]
        out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize("shard_rows", [65_536, 100])
def test_top_k(spark, shard_rows):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(700)]
    rows += [(i, [0.5, 0.25, 0.0, 0.0, 0.0, 1.0]) for i in range(1000, 1350)]  # a third of all rows is one vector
    rows += [(2000, None), (2020, [math.nan] * 6), (2040, [math.inf] * 6), (2060, [None] * 6), (2080, [1.0, 2.0]), (2081, [1.0, 1.0]), (None, [0.1] * 6)]
    rows += [(2100, []), (40, rows[40][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x"))
    found = top_k(df, F.col("id") % 20 == 0, shard_rows=shard_rows).collect()
    assert sorted(map(tuple, found)) == best(rows, 20)


def test_few_candidates_and_large_numbers(spark):
    rows = [(0, [1e9, -1e9]), (1, [1e9, 1e9]), (2, [3.0, 4.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, top_k(df, F.col("id") % 20 == 0).collect())) == best(rows, 20)


@pytest.mark.parametrize("numbers", [[], [0], [5, 5, 5], [0, 1, 2, 2**40], [0] * 600 + [2**62], list(range(0, 90_000, 7))])
def test_elias_fano(numbers):
    data = EliasFano.of(np.array(numbers, np.uint64)).to_bytes()
    code, used = EliasFano.from_bytes(memoryview(data + b"rest"))
    assert used == len(data) and code.all().tolist() == numbers
    assert [code[i] for i in range(len(code))] == numbers
    if len(numbers) > 1000:
        assert len(data) < len(numbers) * (3 + math.log2(numbers[-1] / len(numbers))) / 8 + 32
    with pytest.raises(IndexError):
        code[len(numbers)]


TEXTS = ["", "plain words, and more.", "  two  spaces\n\nand\tlines \n x", "é\u00a0ß²Ⅷ 中文 \u2003y", "<|endoftext|> in <|endoftext|>", "a\x00b \x01 \x02 \x1c c", "it's we'll  ", "word " * 3000]


def test_token_files(spark):
    rng = random.Random(6)
    parts = [" ", "\n", "  ", "a", "the", ",", "'s", "é", "\u3000", "1", "\t", "<|endoftext|>", "\x1e", "longword"]
    texts = TEXTS + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(300)] + [None]
    rows = [(7 * i - 900, text, "x") for i, text in enumerate(texts)] + [(None, "null id", ""), (None, None, ""), (-900, "again", ""), (2**62, "far", "")]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string").repartition(5)
    folder = token_folder(spark)
    files = write_token_files(docs, VOCABULARY, folder)
    found = sorted(map(tuple, read_token_files(files, folder).collect()), key=lambda r: r[1])
    plain = Tokenizer.from_file(VOCABULARY)
    coded = {}
    for doc_id, text, _ in rows:
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        coded.setdefault(doc_id, []).append((len(ids), zlib.crc32(ids.tobytes())))
    order = [doc_id for doc_id, *_ in found]
    assert order == sorted((r[0] for r in rows), key=lambda d: (d is not None, d or 0))
    assert [r[1] for r in found] == list(np.cumsum([0, *(r[2] for r in found[:-1])]))
    for doc_id, parts in coded.items():
        assert sorted((n, c) for d, _, n, c in found if d == doc_id) == sorted(parts)


def test_one_document_by_select(spark):
    docs = spark.createDataFrame([(i, f"text number {i} " * (i % 5)) for i in range(50)] + [(None, "n")], "doc_id long, text string").coalesce(1)
    folder = token_folder(spark)
    row = write_token_files(docs, VOCABULARY, folder).orderBy("first").first()
    store, base = file_store(folder)
    data = TokenFile(store.open_input_stream(f"{base}/{row['file']}", compression=None).read())
    plain, names = Tokenizer.from_file(VOCABULARY), data.doc_ids()
    assert [data.doc_id(i) for i in range(data.documents)] == names and names[0] is None
    for i in range(1, data.documents):
        text = f"text number {names[i]} " * (names[i] % 5)
        assert data.document(i).tolist() == [*plain.encode(text, add_special_tokens=False).ids, 2]


def test_warc(spark):
    rows = [(i, f"http://h{i}.example/p?q={i}#f", f"page {i % 40} é") for i in range(60)]
    rows += [(100 + i, "http://copy/", "the same page") for i in range(60)] + [(500, None, None), (501, "u\nv", ""), (None, "x", "page 1 é"), (502, "long", "y" * 300_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("x")).repartition(6)
    folder = archive_folder(spark)
    archives = write_archives(pages, folder)
    found = with_revisited(transactions(read_records(archives, folder))).collect()
    largest = {}
    for page_id, _, html in rows:
        largest[html or ""] = max(largest.get(html or "", -1), -1 if page_id is None else page_id)
    expected = []
    for page_id, url, html in rows:
        data, first = (html or "").encode(), largest[html or ""]
        kept = first == page_id
        expected.append(
            (page_id, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if kept else "revisit", None if kept else first,
             data if kept else None, None if url is None else url.replace("\n", "%0A"))
        )
    got = [
        (r["capture_id"], r["response"]["payload_bytes"], r["response"]["digest"], r["response"]["type"], r["refers_to"],
         None if r["response"]["payload"] is None else bytes(r["response"]["payload"]), r["request"]["target"])
        for r in found
    ]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert archives.agg(F.sum("records")).first()[0] == 3 * len(rows)


def test_short_payloads_are_responses(spark):
    pages = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, "c", "long enough"), (4, "d", "long enough")], "page_id long, url string, html string")
    folder = archive_folder(spark)
    found = with_revisited(transactions(read_records(write_archives(pages, folder, revisit_from=5), folder))).collect()
    assert {r["capture_id"]: r["refers_to"] for r in found} == {1: None, 2: None, 3: 4, 4: None}


def test_many_equal_rows(spark, monkeypatch):
    """Rows of one id and one text, and empty ones without id, are dealt over several ranges; the files still follow each other."""
    monkeypatch.setattr(token_files, "RANGE_CHARS", 2_000)
    docs = spark.createDataFrame([(None, "")] * 500 + [(1, "same words")] * 1500 + [(2, "end")], "doc_id long, text string").repartition(6)
    folder = token_folder(spark)
    files = write_token_files(docs, VOCABULARY, folder)
    assert files.count() >= 5 and files.agg(F.max("documents")).first()[0] < 1000
    found = sorted(map(tuple, read_token_files(files, folder).collect()), key=lambda r: r[1])
    assert [r[0] for r in found] == [None] * 500 + [1] * 1500 + [2]
    assert [r[1] for r in found] == [sum(r[2] for r in found[:i]) for i in range(len(found))]


def test_known_pieces_are_small():
    """What an encoder keeps of many pieces is some ten bytes each, and their ids stay right when they come back from the older ones."""
    encoder, rng = token_files.Encoder(Path(VOCABULARY).read_text(encoding="utf-8")), random.Random(8)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(9)) for _ in range(30_000)]
    texts = [" ".join(words[a : a + 500]) + "." for a in range(0, len(words), 500)]
    tracemalloc.start()
    first = encoder.encode(texts, 2)
    gc.collect()
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 80 * len(words)
    encoder.older, encoder.recent = encoder.recent, token_files.Pieces(encoder.kind)
    again = encoder.encode(texts, 2)
    plain = [i for text in texts for i in [*encoder.tokenizer.encode(text, add_special_tokens=False).ids, 2]]
    assert first[0].tolist() == plain == again[0].tolist() and first[1].tolist() == again[1].tolist()
