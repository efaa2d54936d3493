"""Removal of repeated byte strings: every byte covered by a string of `width` bytes that begins anywhere else too.

A shard's suffix array with its permuted common prefixes tells which strings of `width` bytes repeat in the shard
(`suffix_arrays`). Strings are dealt to shards by their content, so that equal ones meet:

Anchors. Each string of `width` bytes has an anchor, the place of the least hash of eight bytes among its first places (the leftmost on
ties). Neighbouring strings mostly share it; those that do make one segment. The anchor's next `context` bytes give the segment's key,
so equal strings lie in segments of one key, at one offset from the anchor. A key that occurs once holds nothing that repeats.

Counts. Equal segments (key and a hash of the bytes) are summed before anything else: a segment that occurs twice repeats as a whole, and goes
to its shard once, however many copies there are. Segments of keys with a single content need no shard.

Shards. The remaining contents are cut from the texts and sent by key. A task takes whole keys, STEP_BYTES at a time. Equal strings have equal
offsets from their anchors, so of BLOCK neighbouring offsets only those matter whose strings' common bytes occur twice in the key;
the suffixes of what is left are sorted. A key with more than `key_bytes` of different contents goes another way that can be split: its strings are
hashed (128 bits) and counted over all tasks.

Spans. The repeated places come back to every segment they belong to, are united per text and removed.

Texts are known by 87 bits of hashes, segments by 128. Nothing is collected on the driver; what a task holds at once is a text
with its own segments, or STEP_BYTES plus `key_bytes` of segments.

Defined results: a null text is empty. Texts shorter than `width` stay as they are. Rows with equal texts are copies of one
another, whatever their ids, null or repeated; each gives its own row. Matches never cross rows. An empty table gives no
rows. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelens.llm.columns import written
from lakelens.llm.shared import shipped, tidy
from lakelens.llm.shingles import FACTORS, mixed
from lakelens.llm.suffix_arrays import repeated_places

WIDTH = 400
STEP_BYTES = 1 << 20
PIECE_BYTES = 1 << 21
KEY_BYTES = 4 << 20
SHARD_BYTES = 8 << 20
GRAM = 8
BLOCK = 32
#: Bits of a second hash by which texts are known.
MORE_BITS = 23
PLACE = np.uint64((1 << 24) - 1)


def anchor_width(width: int) -> tuple[int, int]:
    """(bytes of context after an anchor, places an anchor can have in a string)."""
    context = max(GRAM, width * 2 // 5)
    return context, width - context + 1


def grams(data: bytes) -> np.ndarray:
    """The eight bytes from every place on, as a number."""
    padded = data + bytes(2 * GRAM)
    out = np.empty(len(data), np.uint64)
    for i in range(min(GRAM, len(data))):
        row = np.frombuffer(padded, "<u8", count=(len(data) - i + GRAM - 1) // GRAM, offset=i)
        out[i::GRAM] = row
    return out


def _least(values: np.ndarray, window: int) -> np.ndarray:
    """The least of every `window` neighbouring values."""
    n = len(values) - window + 1
    blocks = -(-len(values) // window)
    whole = np.full(blocks * window, np.uint64(2**64 - 1))
    whole[: len(values)] = values
    rows = whole.reshape(blocks, window)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[window - 1 : window - 1 + n])


def segments(data: bytes, sizes: list[int], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first place, number of strings, anchor, key) of the segments of joined texts."""
    context, places = anchor_width(width)
    number = grams(data)
    hashed = (mixed(number) & ~PLACE) | np.arange(len(number), dtype=np.uint64)
    if len(hashed) < places:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    anchors = (_least(hashed, places) & PLACE).astype(np.int64)
    ends = np.cumsum(np.array(sizes, np.int64))
    starts = ends - np.array(sizes, np.int64)
    inside = np.zeros(len(anchors) + 1, np.int8)
    for a, b in zip(starts.tolist(), (ends - width + 1).tolist()):
        if b > a:
            inside[a] += 1
            inside[b] -= 1
    inside = np.cumsum(inside[:-1], dtype=np.int8) > 0
    begins = inside.copy()
    begins[1:] &= (anchors[1:] != anchors[:-1]) | ~inside[:-1]
    begins[starts[np.array(sizes) >= width]] = True
    first = np.flatnonzero(begins)
    count = np.add.reduceat(inside.astype(np.int64), first) if len(first) else np.zeros(0, np.int64)
    at = anchors[first]
    key = np.zeros(len(first), np.uint64)
    for i in (*range(0, context - GRAM, GRAM), context - GRAM):
        key = mixed(key ^ number[at + i]) * FACTORS[0]
    return first, count, at, mixed(key)


def _pieces(texts: list[bytes], width: int) -> Iterator[tuple[list[tuple[int, int]], bytes, list[int]]]:
    """Joined texts of about PIECE_BYTES; long texts come in parts that overlap by width - 1 bytes."""
    owners, parts, held = [], [], 0
    for i, text in enumerate(texts):
        for a in range(0, max(1, len(text) - width + 1), PIECE_BYTES):
            part = text if len(text) < PIECE_BYTES + width else text[a : a + PIECE_BYTES + width - 1]
            if len(part) < width:
                continue
            owners.append((i, a))
            parts.append(part)
            held += len(part)
            if held >= PIECE_BYTES:
                yield owners, b"".join(parts), [len(p) for p in parts]
                owners, parts, held = [], [], 0
            if len(text) < PIECE_BYTES + width:
                break
    if parts:
        yield owners, b"".join(parts), [len(p) for p in parts]


def _found(width: int):
    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [text.encode() for text in batch["text"]]
            ids, more = batch["id"].to_numpy(np.int64), batch["more"].to_numpy(np.int64)
            for owners, data, sizes in _pieces(texts, width):
                first, count, _, key = segments(data, sizes, width)
                of = np.searchsorted(np.cumsum(sizes), first, side="right")
                owner, offset = np.array([o for o, _ in owners]), np.array([a for _, a in owners])
                start = first - (np.cumsum(sizes) - sizes)[of] + offset[of]
                view = memoryview(data)
                content = np.fromiter(
                    (xxhash.xxh3_64_intdigest(view[a : a + n + width - 1]) for a, n in zip(first.tolist(), count.tolist())), np.uint64, len(first)
                )
                # Contiguous segments of one content, as in runs of one character, are one row.
                same = np.zeros(len(first), bool)
                same[1:] = (content[1:] == content[:-1]) & (key[1:] == key[:-1]) & (count[1:] == count[:-1]) & (of[1:] == of[:-1])
                same[1:] &= first[1:] == first[:-1] + count[:-1]
                head = np.flatnonzero(~same)
                times = np.diff(np.append(head, len(first)))
                yield pd.DataFrame(
                    {
                        "id": ids[owner[of[head]]],
                        "more": more[owner[of[head]]],
                        "key": key[head].astype(np.int64),
                        "content": content[head].astype(np.int64),
                        "start": start[head],
                        "strings": count[head],
                        "times": times,
                    }
                )

    return found


def _cut(width: int):
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = []
            for text, starts, strings in zip(batch["text"], batch["start"], batch["strings"]):
                data = text.encode()
                parts += [data[a : a + n + width - 1] for a, n in zip(starts.tolist(), strings.tolist())]
            yield pd.DataFrame({name: np.concatenate(batch[name].to_numpy()) for name in ("key", "content", "once")} | {"bytes": parts})

    return cut


def shared_parts(keys: list[int], texts: list[bytes], width: int) -> list[tuple[int, int, int]]:
    """(segment, first place, number of strings) of what can repeat among the segments of the same key."""
    data, sizes = b"".join(texts), [len(t) for t in texts]
    first, count, anchor, _ = segments(data, sizes, width)
    view, block = memoryview(data), min(BLOCK, width // 4)
    common = width - block + 1
    found, seen = [], {}
    for i, (s, n, a) in enumerate(zip(first.tolist(), count.tolist(), anchor.tolist())):
        for j in range((a - s) // block, (a - s - n + 1) // block - 1, -1):
            c = a - block * j
            mark = keys[i], j, xxhash.xxh3_64_intdigest(view[c : c + common])
            seen[mark] = seen.get(mark, 0) + 1
            low = max(s, c - block + 1)
            found.append((i, low - s, min(s + n, c + 1) - low, mark))
    parts: list[tuple[int, int, int]] = []
    for i, low, n, mark in found:
        if seen[mark] > 1:
            if parts and parts[-1][0] == i and parts[-1][1] + parts[-1][2] == low:
                parts[-1] = i, parts[-1][1], parts[-1][2] + n
            else:
                parts.append((i, low, n))
    return parts


def _sorted(width: int, step_bytes: int):
    """Ranges of repeated places of the segments of whole keys, which come in order; only of those that occur once."""

    def search(held: list[tuple[int, int, bool, bytes]]) -> pd.DataFrame:
        parts = shared_parts([key for key, *_ in held], [data for *_, data in held], width)
        rows = []
        for (i, low, _), places in zip(parts, repeated_places([held[i][3][low : low + n + width - 1] for i, low, n in parts], width)):
            key, content, once, _ = held[i]
            if once and len(places):
                breaks = np.flatnonzero(np.diff(places) > 1)
                rows.append((key, content, low + places[np.append(0, breaks + 1)], low + places[np.append(breaks, len(places) - 1)] + 1))
        return pd.DataFrame(rows, columns=["key", "content", "a", "b"])

    def sort(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for batch in batches:
            for key, content, once, data in zip(batch["key"], batch["content"], batch["once"], batch["bytes"]):
                if size >= step_bytes and key != held[-1][0]:
                    yield search(held)
                    held, size = [], 0
                held.append((key, content, once, data))
                size += len(data)
        if held:
            yield search(held)

    return sort


def _hashed(width: int):
    def strings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, content, once, data in zip(batch["key"], batch["content"], batch["once"], batch["bytes"]):
                n = len(data) - width + 1
                marks = [xxhash.xxh3_128_digest(data[i : i + width]) for i in range(n)]
                yield pd.DataFrame({"key": np.full(n, key), "content": np.full(n, content), "once": np.full(n, once), "place": np.arange(n), "mark": marks})

    return strings


def _removed(width: int):
    """(n_removed, n_spans, kept_sha256) of a text and the ranges of places at which a repeated string begins."""

    def removed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text, starts, ends in zip(batch["text"], batch["a"], batch["b"]):
                data, kept, end, gone, spans = memoryview(text.encode()), hashlib.sha256(), 0, 0, 0
                for a, b in sorted(zip(starts.tolist(), (ends + width - 1).tolist())):
                    if a > end or not spans:
                        kept.update(data[end:a])
                        spans += 1
                    gone += max(0, b - max(a, end))
                    end = max(end, b)
                kept.update(data[end:])
                rows.append((gone, spans, kept.hexdigest()))
            yield pd.concat([batch[["id", "more"]].reset_index(drop=True), pd.DataFrame(rows, columns=["n_removed", "n_spans", "kept_sha256"])], axis=1)

    return removed


def _identity(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("id"), F.shiftright(F.xxhash64(F.lit(1), text), 64 - MORE_BITS).alias("more")]


def remove_repeats(
    docs: DataFrame,
    width: int = WIDTH,
    step_bytes: int = STEP_BYTES,
    key_bytes: int = KEY_BYTES,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    if width < 2 * GRAM:
        raise ValueError(f"Strings need {2 * GRAM} bytes at least.")
    spark = shipped(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = rows.select("doc_id", "text", *_identity(F.col("text")), F.octet_length("text").cast("long").alias("n_bytes"))
    long_ = rows.where(F.col("n_bytes") >= width).select("id", "more", "text")

    every = written(
        long_.mapInPandas(tidy(_found(width)), "id long, more long, key long, content long, start long, strings long, times long"), "segments"
    )
    many = every.groupBy("key").agg(F.sum("times").alias("n")).where("n > 1").select("key")
    # Rows of equal texts are one row from here on.
    some = written(
        every.join(many, "key", "left_semi")
        .groupBy("id", "more", "key", "content", "start", "strings")
        .agg(F.sum("times").alias("n"), F.max("times").alias("times")),
        "candidates",
    )
    contents = written(
        some.groupBy("key", "content").agg(F.sum("n").alias("n"), F.min(F.struct("id", "more", "start", "strings")).alias("at")), "contents"
    )
    sizes = contents.groupBy("key").agg(F.count("*").alias("contents"), F.sum(F.col("at.strings") + (width - 1)).alias("bytes")).where("contents > 1")

    wanted = (
        contents.join(sizes.select("key"), "key", "left_semi")
        .select("at.id", "at.more", F.struct("key", "content", (F.col("n") == 1).alias("once"), "at.start", "at.strings").alias("w"))
        .groupBy("id", "more")
        .agg(F.collect_list("w").alias("wanted"))
    )
    texts = long_.groupBy("id", "more").agg(F.first("text").alias("text"))
    of_segment = "key long, content long, once boolean"
    cut = written(texts.join(wanted, ["id", "more"]).select("text", *[f"wanted.{name}" for name in ("key", "content", "once", "start", "strings")]).mapInPandas(tidy(_cut(width)), f"{of_segment}, bytes binary"), "cut")
    big = written(sizes.where(F.col("bytes") > key_bytes).select("key"), "large-keys")
    total = cut.agg(F.sum(F.length("bytes"))).first()[0] or 0
    shards = max(spark.sparkContext.defaultParallelism, math.ceil(total / SHARD_BYTES))
    small = cut.join(big, "key", "left_anti").repartition(shards, "key").sortWithinPartitions("key")
    near = small.mapInPandas(tidy(_sorted(width, step_bytes)), "key long, content long, a array<long>, b array<long>")

    marks = written(cut.join(big, "key", "left_semi").mapInPandas(tidy(_hashed(width)), f"{of_segment}, place long, mark binary"), "marks")
    twice = marks.groupBy("mark").agg(F.count("*").alias("n")).where("n > 1").select("mark")
    far = marks.where("once").join(twice, "mark", "left_semi").groupBy("key", "content").agg(F.collect_list("place").alias("a"))

    part = near.unionByName(far.withColumn("b", F.transform("a", lambda x: x + 1)))
    both = contents.where("n > 1").select("key", "content", F.lit(None).cast("array<long>").alias("a"), F.lit(None).cast("array<long>").alias("b"))
    found = written(both.unionByName(part), "repeated")
    whole = F.array(F.struct(F.col("start").alias("a"), (F.col("start") + F.col("strings") * F.col("times")).alias("b")))
    inner = F.zip_with("a", "b", lambda x, y: F.struct((F.col("start") + x).alias("a"), (F.col("start") + y).alias("b")))
    ranges = (
        some.join(found, ["key", "content"])
        .select("id", "more", F.explode(F.when(F.col("a").isNull(), whole).otherwise(inner)).alias("r"))
        .groupBy("id", "more")
        .agg(F.collect_list("r").alias("ranges"))
    )
    changed = texts.join(ranges, ["id", "more"]).select("id", "more", "text", "ranges.a", "ranges.b").mapInPandas(tidy(_removed(width)), "id long, more long, n_removed long, n_spans long, kept_sha256 string")
    changed = written(changed, "changed")
    kept = rows.select("doc_id", "id", "more", "n_bytes", F.sha2("text", 256).alias("own")).join(changed, ["id", "more"], "left")
    return kept.select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("kept_sha256", "own").alias("kept_sha256"),
    )
