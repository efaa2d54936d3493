"""Token ids of whole documents in binary files: one concatenated id array, Elias-Fano document boundaries.

Documents are dealt over tasks by ranges of (doc_id, text hash, row number), so files follow each other in ascending doc_id order
and no id, however often it occurs with one text or many, has to fit one task. A task writes a file whenever enough ids have come together;
it goes to a temporary name and is then renamed, and only the files that a finished task reports are in the listing.

A file: magic, counts and the width of an id (2 bytes where the vocabulary allows, else 4); the ids, little-endian; the
end of every document in the id array as Elias-Fano code; the doc_ids that are not null, less the smallest, as Elias-Fano
code. `TokenFile` gives any document's ids by select, without decoding the rest.

Words repeat, so ids are kept by piece: a text is cut only where the tokenizer's own pre-tokenizer always cuts, before a
single white space between two other characters (longer white space is cut before its last character), and new pieces
go through the tokenizer together. Texts with control separators or special-token strings go through it whole.

Defined results: a null text is empty and consists of the end id. Null doc_ids come first. Rows with equal doc_ids are
documents of their own, ordered by a hash of their text. An empty table gives no file and no row. Only the named
columns are read.
"""

from __future__ import annotations

import gc
import math
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakelens.llm.columns import written
from lakelens.llm.elias_fano import EliasFano
from lakelens.llm.shared import file_store, give_back, shipped, tidy
from lakelens.session import scratch_path

MAGIC = b"LLIDSEF1"
HEAD = struct.Struct("<8sQQQqB")
#: Characters a range of documents holds; ids after which a file is closed.
RANGE_CHARS = 64 << 20
FILE_IDS = 8 << 20
#: Characters tokenized together, and pieces whose ids a worker keeps.
STEP_CHARS = 2 << 20
KEPT_PIECES = 1_600_000
#: New pieces that the tokenizer sees as one text, and such texts that it sees at once.
RUN, RUNS = 1_000, 32

#: White space that is not one blank or line feed between other characters, and the separators used below.
SPACES = r"\t\x0b-\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
UNEVEN = rf"[ \n][ \n]|[\x00-\x02{SPACES}]"
#: Texts with these go through the tokenizer whole; its white space is not Python's there.
WHOLE = re.compile(r"[\x1c-\x1f]")
PIECES = re.compile(r"\s+(?=\s\S)|\s+\Z| ?\S+|\s")
CUT, END, OTHER = "\0", "\1", "\2"
STOPS = frozenset(".,;:!?")
_encoders: dict[int, Encoder] = {}


def hashes_of(words: list[str] | np.ndarray) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


class Pieces:
    """Pieces and their ids, each kind in one array, and where the ids of each piece are.

    A piece is looked up by a hash and then compared itself. The table that leads from hashes to numbers grows with the pieces and is
    at most half full; a number is in the first place from its hash's own that was free.
    """

    def __init__(self, kind: str):
        self.table = np.full(1 << 10, -1, np.int32)
        self.names, self.hashes = pa.array([], pa.large_string()), np.zeros(0, np.uint64)
        self.ids, self.lengths, self.starts = np.zeros(0, kind), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def __len__(self) -> int:
        return len(self.names)

    def find(self, names: pa.Array, hashes: np.ndarray) -> np.ndarray:
        """The number of each piece, -1 for those not known."""
        found, left = np.full(len(names), -1, np.int64), np.arange(len(names))
        places = self._places(hashes)
        while len(left):
            numbers = self.table[places]
            taken = numbers >= 0
            left, places, numbers = left[taken], places[taken], numbers[taken]
            hit = self.hashes[numbers] == hashes[left]
            found[left[hit]] = numbers[hit]
            left, places = left[~hit], self._next(places[~hit])
        there = np.flatnonzero(found >= 0)
        same = pc.equal(names.take(pa.array(there)), self.names.take(pa.array(found[there]))).to_numpy(zero_copy_only=False)
        found[there[~same]] = -1
        return found

    def add(self, names: pa.Array, hashes: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Their numbers. None of them may be known."""
        numbers = len(self) + np.arange(len(names))
        self.names, self.hashes = pa.concat_arrays([self.names, names]), np.concatenate([self.hashes, hashes])
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths) - lengths])
        self.ids, self.lengths = np.concatenate([self.ids, ids]), np.concatenate([self.lengths, lengths])
        if 2 * len(self) > len(self.table):
            self.table = np.full(1 << (4 * len(self)).bit_length(), -1, np.int32)
            self._enter(np.arange(len(self)))
        else:
            self._enter(numbers)
        return numbers

    def _places(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes & np.uint64(len(self.table) - 1)).astype(np.int64)

    def _next(self, places: np.ndarray) -> np.ndarray:
        return (places + 1) & (len(self.table) - 1)

    def _enter(self, numbers: np.ndarray) -> None:
        places = self._places(self.hashes[numbers])
        while len(numbers):
            free = self.table[places] < 0
            self.table[places[free]] = numbers[free]
            other = self.table[places] != numbers
            numbers, places = numbers[other], self._next(places[other])

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these pieces one after the other, and how many each has."""
        lengths = self.lengths[numbers]
        ends = np.cumsum(lengths)
        kind = np.int32 if len(self.ids) + lengths.sum() < 1 << 31 else np.int64
        places = np.repeat((self.starts[numbers] - (ends - lengths)).astype(kind), lengths)
        places += np.arange(len(places), dtype=kind)
        return self.ids[places], lengths


class Encoder:
    """Ids of texts, with the ids of pieces seen lately kept."""

    def __init__(self, vocabulary: str):
        # A task has one core, and every thread would keep memory of its own.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.kind = "<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"
        added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.uneven = "|".join([UNEVEN, *map(re.escape, added)])
        self.whole = re.compile("|".join([WHOLE.pattern, *map(re.escape, added)]))
        self.recent, self.older = Pieces(self.kind), Pieces(self.kind)
        # A byte-level vocabulary spells a token with one character a byte, so ids tell where words end.
        spelled = self.tokenizer.get_vocab(with_added_tokens=True)
        self.bytes_of = np.zeros(max(spelled.values(), default=0) + 1, np.int64)
        self.bytes_of[list(spelled.values())] = [len(token) for token in spelled]
        self.by_bytes = '"type":"ByteLevel"' in re.sub(r"\s", "", str(self.tokenizer.pre_tokenizer.__getstate__(), "utf-8")) if self.tokenizer.pre_tokenizer else False

    @classmethod
    def of(cls, vocabulary: str) -> Encoder:
        key = zlib.crc32(vocabulary.encode())
        if key not in _encoders:
            _encoders.clear()
            _encoders[key] = cls(vocabulary)
        return _encoders[key]

    def _new(self, words: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The same pieces in some order, their ids and how many each has. Those that begin with a blank are joined to texts."""
        joined, alone, done = [], [], []
        for word in words:
            (joined if self.by_bytes and word[0] == " " and len(word) > 1 and not word[1].isspace() else alone).append(word)
        runs = [joined[a : a + RUN] for a in range(0, len(joined), RUN)]
        for a in range(0, len(runs), RUNS):
            together = self.tokenizer.encode_batch_fast(["".join(run) for run in runs[a : a + RUNS]], add_special_tokens=False)
            for some, encoding in zip(runs[a : a + RUNS], together):
                ids = np.array(encoding.ids, self.kind)
                upto, ends = np.cumsum(self.bytes_of[ids]), np.cumsum(pc.binary_length(pa.array(some, pa.large_string())).to_numpy())
                last = np.searchsorted(upto, ends)
                if len(upto) and last[-1] == len(upto) - 1 and (upto[last] == ends).all():
                    done.append((some, ids, np.diff(last, prepend=-1)))
                else:
                    alone += some
        for a in range(0, len(alone), RUN):
            some = alone[a : a + RUN]
            encoding = self.tokenizer.encode(some, is_pretokenized=True, add_special_tokens=False)
            done.append((some, np.array(encoding.ids, self.kind), np.bincount(np.array(encoding.word_ids, np.int64), minlength=len(some))))
        if not done:
            return [], np.zeros(0, self.kind), np.zeros(0, np.int64)
        names, ids, lengths = zip(*done)
        return [word for some in names for word in some], np.concatenate(ids), np.concatenate(lengths)

    def known(self, names: pa.Array) -> np.ndarray:
        """The numbers of distinct pieces in `recent`. A word and the stop or comma after it are looked for apart."""
        words = names.to_numpy(zero_copy_only=False)
        hashes = hashes_of(words)
        found = self.recent.find(names, hashes)
        missing = np.flatnonzero(found < 0)
        before = self.older.find(names.take(pa.array(missing)), hashes[missing])
        again = missing[before >= 0]
        if len(again):
            found[again] = self.recent.add(names.take(pa.array(again)), hashes[again], *self.older.take(before[before >= 0]))
        missing = missing[before < 0]
        if not len(missing):
            return found
        wanted = words[missing].tolist()
        # What comes before the stop ends in a letter, so it is none of `ended` itself.
        ended = dict.fromkeys([piece for piece in wanted if piece[-1] in STOPS and len(piece) > 2 and piece[-2].isalpha()])
        parts = list(dict.fromkeys([part for piece in ended for part in (piece[:-1], piece[-1])]))
        at = self.recent.find(pa.array(parts, pa.large_string()), hashes_of(parts))
        number = {part: place for part, place in zip(parts, at.tolist()) if place >= 0}
        plain = [piece for piece in wanted if piece not in ended]
        fresh, ids, lengths = self._new(list(dict.fromkeys(plain + [part for part in parts if part not in number])))
        number.update(zip(fresh, self._add(fresh, ids, lengths)))
        if ended:
            both = np.array([number[part] for piece in ended for part in (piece[:-1], piece[-1])], np.int64)
            ids, lengths = self.recent.take(both)
            number.update(zip(ended, self._add(list(ended), ids, lengths.reshape(-1, 2).sum(axis=1))))
        found[missing] = [number[piece] for piece in wanted]
        return found

    def _add(self, words: list[str], ids: np.ndarray, lengths: np.ndarray) -> list[int]:
        return self.recent.add(pa.array(words, pa.large_string()), hashes_of(words), ids, lengths).tolist()

    def _uneven(self, text: str) -> np.ndarray:
        if self.whole.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind)
        cut = pa.array(PIECES.findall(text), pa.large_string()).dictionary_encode()
        return self.recent.take(self.known(cut.dictionary)[cut.indices.to_numpy()])[0]

    def encode(self, texts: list[str], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, the end id after each, and the number of ids of each."""
        if len(self.recent) > KEPT_PIECES // 2:
            self.older, self.recent = self.recent, Pieces(self.kind)
        column = pa.array(texts, pa.large_string())
        others = {}
        for i in np.flatnonzero(pc.match_substring_regex(column, self.uneven).to_numpy(zero_copy_only=False)).tolist():
            others[i] = self._uneven(texts[i])
        if others:
            column = pa.array([f"{OTHER}{i}" if i in others else text for i, text in enumerate(texts)], pa.large_string())
        column = pc.binary_join_element_wise(column, pa.scalar(END, pa.large_string()), pa.scalar(CUT, pa.large_string()))
        column = pc.replace_substring(pc.replace_substring(column, " ", f"{CUT} "), "\n", f"{CUT}\n{CUT}")
        cut = pc.split_pattern(column, CUT)
        coded = cut.flatten().dictionary_encode()
        bounds = cut.offsets.to_numpy() - cut.offsets[0].as_py()
        del column, cut
        # What is of this step alone gets the numbers after those of the pieces.
        own = {"": np.zeros(0, self.kind), END: np.array([end_id], self.kind)} | {f"{OTHER}{i}": ids for i, ids in others.items()}
        names = coded.dictionary
        marks = pc.or_(pc.equal(names, ""), pc.or_(pc.starts_with(names, END), pc.starts_with(names, OTHER)))
        step, numbers = marks.to_numpy(zero_copy_only=False), np.empty(len(names), np.int64)
        numbers[~step] = self.known(names.filter(pc.invert(marks)))
        numbers[step] = len(self.recent) + np.arange(step.sum())
        every = Pieces(self.kind)
        mine = [own[name] for name in names.filter(marks).to_pylist()]
        sizes = np.array([len(ids) for ids in mine], np.int64)
        every.ids = np.concatenate([self.recent.ids, *mine])
        every.lengths = np.concatenate([self.recent.lengths, sizes])
        every.starts = np.concatenate([self.recent.starts, len(self.recent.ids) + np.cumsum(sizes) - sizes])
        ids, lengths = every.take(numbers[coded.indices.to_numpy()])
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return ids, np.diff(ends[bounds])


def pack(doc_ids: list[int | None], ids: np.ndarray, lengths: np.ndarray) -> bytes:
    """One file. doc_ids ascend, nulls first; `ids` are those of all documents, `lengths` how many each has."""
    return b"".join(packed(doc_ids, [ids], lengths))


def packed(doc_ids: list[int | None], ids: list[np.ndarray], lengths: np.ndarray) -> Iterator[bytes]:
    """A file's parts; `ids` are arrays whose ids follow each other."""
    known = np.array([d for d in doc_ids if d is not None], np.int64)
    least = int(known[0]) if len(known) else 0
    yield HEAD.pack(MAGIC, len(doc_ids), sum(map(len, ids)), len(doc_ids) - len(known), least, ids[0].itemsize)
    for some in ids:
        yield some.tobytes()
    yield EliasFano.of(np.cumsum(lengths)).to_bytes()
    apart = known.astype(np.uint64) - np.int64(least).astype(np.uint64)
    yield EliasFano.of(apart).to_bytes()


class TokenFile:
    def __init__(self, data: bytes):
        view = memoryview(data)
        magic, self.documents, self.tokens, self.nulls, self.least, width = HEAD.unpack_from(view)
        if magic != MAGIC:
            raise ValueError("Not a token file.")
        a = HEAD.size + self.tokens * width
        self.ids = np.frombuffer(view[HEAD.size : a], f"<u{width}")
        self.ends, used = EliasFano.from_bytes(view[a:])
        self.names, _ = EliasFano.from_bytes(view[a + used :])

    def offsets(self, i: int) -> tuple[int, int]:
        """Start and end of document i in the id array."""
        return (self.ends[i - 1] if i else 0), self.ends[i]

    def document(self, i: int) -> np.ndarray:
        a, b = self.offsets(i)
        return self.ids[a:b]

    def doc_id(self, i: int) -> int | None:
        if i < self.nulls:
            return None
        return (self.least + self.names[i - self.nulls] + 2**63) % 2**64 - 2**63

    def doc_ids(self) -> list[int | None]:
        return [None] * self.nulls + (self.names.all() + np.int64(self.least).astype(np.uint64)).astype(np.int64).tolist()


def write_token_files(
    docs: DataFrame, vocabulary_path: str, folder: str, end_id: int = 2, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Writes the files; returns file, first (ids in all files before it), documents, tokens, one row per file."""
    spark = shipped(docs.sparkSession)
    vocabulary = Path(vocabulary_path).read_text(encoding="utf-8")
    chosen = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    chars = chosen.agg(F.sum(F.length("text"))).first()[0] or 0
    ranges = max(1, math.ceil(chars / RANGE_CHARS), min(4 * spark.sparkContext.defaultParallelism, math.ceil(chars / (1 << 20))))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, (store, base) = Encoder.of(vocabulary), file_store(folder)
        store.create_dir(base, recursive=True)
        doc_ids, ids, lengths, held, done, shard = [], [], [], 0, [], None

        def flush():
            name = f"{shard:06d}-{len(done):06d}-{uuid.uuid4().hex}.ids"
            with store.open_output_stream(f"{base}/.{name}.partial", compression=None) as out:
                for part in packed(doc_ids, ids, np.concatenate(lengths)):
                    out.write(part)
            store.move(f"{base}/.{name}.partial", f"{base}/{name}")
            done.append((name, shard, len(done), len(doc_ids), held))

        for batch in batches:
            shard = int(batch["range"].iloc[0])
            for some_ids, texts in _steps(batch):
                coded, counts = encoder.encode(texts, end_id)
                doc_ids += [None if d is None else int(d) for d in some_ids]
                ids.append(coded)
                lengths.append(counts)
                held += len(coded)
                give_back()
                if held >= FILE_IDS:
                    flush()
                    doc_ids, ids, lengths, held = [], [], [], 0
        if doc_ids:
            flush()
        yield pd.DataFrame(done, columns=["file", "range", "part", "documents", "tokens"])

    dealt = (
        chosen.withColumn("hash", F.xxhash64("text"))
        # Rows of one id and text are split by their number alone.
        .withColumn("number", F.monotonically_increasing_id())
        .repartitionByRange(ranges, "doc_id", "hash", "number")
        .sortWithinPartitions("doc_id", "hash")
        .select(F.spark_partition_id().alias("range"), F.col("doc_id").cast("string").alias("doc_id"), "text")
    )
    files = written(dealt.mapInPandas(tidy(write), "file string, range int, part int, documents long, tokens long"), "token-list")
    before = Window.orderBy("range", "part").rowsBetween(Window.unboundedPreceding, -1)
    return files.select("file", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("first"), "documents", "tokens")


def _steps(batch: pd.DataFrame) -> Iterator[tuple[list, list[str]]]:
    ids, texts, chars = [], [], 0
    for d, text in zip(batch["doc_id"], batch["text"]):
        ids.append(d)
        texts.append(text)
        chars += len(text)
        if chars >= STEP_CHARS:
            yield ids, texts
            ids, texts, chars = [], [], 0
    if ids:
        yield ids, texts


def read_token_files(files: DataFrame, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (of 32-bit little-endian ids), per document."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        _encoders.clear()  # a worker that has written files keeps its encoder between tasks
        gc.collect()
        give_back()
        store, base = file_store(folder)
        for batch in batches:
            for name, first in zip(batch["file"], batch["first"]):
                with store.open_input_stream(f"{base}/{name}", compression=None) as source:
                    data = TokenFile(source.read())
                ends = data.ends.all().astype(np.int64)
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                sums = [zlib.crc32(data.ids[a:b].astype("<u4")) for a, b in zip(starts.tolist(), ends.tolist())]
                names = pd.array(data.doc_ids(), "Int64")
                yield pd.DataFrame({"doc_id": names, "start": starts + int(first), "n_tokens": ends - starts, "ids_crc32": sums})

    shipped(files.sparkSession)
    listed = files.select("file", "first")
    return listed.repartition(max(1, min(files.count(), 50_000))).mapInPandas(tidy(read), "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_folder(spark) -> str:
    return scratch_path(spark, "ids")
