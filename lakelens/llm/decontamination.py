"""Benchmark decontamination by template windows: finds benchmark items in documents, also with other numbers and names.

Canonical form. Words lose the punctuation around them and their case; numbers become <num>, units after a number <unit>,
capitalised words inside a sentence <name>. The value behind a placeholder is its slot. A text's template windows are its runs of
five canonical words with at most two placeholders; a text of fewer words has its whole sequence as one window. A capitalised word that
begins a sentence may be a name or not: windows with such words have a second form in which they are <name>, and either form may match.

Few windows. Items with fewer than LEAST_TEMPLATES distinct template windows (short questions, numbers, lists of names) are looked for in two
more ways. Literally, numbers and names included: by all runs of five words, or by the one run of all the
item's words, anywhere in a document; an item of one or two words has to stand as a line or sentence of its own. And in template form as a whole,
or by all runs of WHOLE words if it is longer, with any number of placeholders, its first word taken as it is or as a name: such a run needs
LEAST_LITERALS words that are no placeholders, and to stand by itself, from a capital to a sentence's end or the next capital, or else ENOUGH_LITERALS.

Search. A bit table of fixed size, filled from the hashes of all item windows, goes to every task, which emits only the
document windows that hit it. These meet the item windows in an equi-join on the full 64-bit hash. Per document and item
the hits are split into occurrences: those along one offset, or the longest chain that ascends in the document and in the item
within a band of offsets, so a window that the item holds twice counts where it stands. An occurrence counts when it covers at least `cover` of the item's
distinct windows and its slots are consistent: one item value always stands for one document value of the same kind and the other
way round.

Defined results: null and empty texts have no window and match nothing, as items without words. Null ids are kept as they are; rows with the same id and text give one
result, and so do repeated items. Empty tables give no rows. Only the named columns are read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakelens.llm.columns import written
from lakelens.llm.shared import shipped, tidy
from lakelens.llm.shingles import FACTORS, WIDTH, mixed, steps

COVER = 0.8
MOST_SLOTS = 2
#: Items with fewer distinct template windows are looked for literally; items of up to ALONE words as a line or sentence.
LEAST_TEMPLATES, ALONE = 3, 2
WHOLE, LEAST_LITERALS, ENOUGH_LITERALS = 12, 3, 5
LITERAL_SALT = np.uint64(0x9E3779B97F4A7C15)
#: Characters of documents taken together.
STEP_CHARS = 1 << 19
#: Bits of the table that goes to every task: 2 MiB, whatever the benchmark's size.
TABLE_BITS = 1 << 24

NUMBER = regex.compile(r"[+-]?[$€£]?\p{N}[\p{N}.,:/]*%?")
FUSED = regex.compile(r"([+-]?\p{N}[\p{N}.,]*)([\p{L}°]+)")
# Number words and units that stand for a placeholder.
NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen "
    "nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split()
)
UNITS = frozenset(
    "mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers kilometre "
    "kilometres mg g kg t lb lbs oz gram grams kilogram kilograms pound pounds ounce ounces ton tons ml l liter liters litre "
    "litres gallon gallons s sec min h hr second seconds minute minutes hour hours day days week weeks month months year years "
    "mph kph km/h m/s hz khz mhz ghz b kb mb gb tb w kw kwh v a k c f °c °f percent dollar dollars euro euros cent cents usd eur gbp".split()
)
LITERAL, NUM, UNIT, NAME = range(4)


PUNCTUATION = "\"'“”‘’`«»()[]{}<>.,;:!?¡¿*_~|/\\&#-–—…%$"
ENDS = r"""[.!?:;]["'”’)\]}»]*$"""
TEMPLATE, LITERALLY, AS_WHOLE = range(3)


def _word_code(kind: int, core: str) -> int:
    return xxhash.xxh3_64_intdigest(("", "<num>", "<unit>", "<name>")[kind] or "=" + core)


def _words(names: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Core, flags (there, ends a sentence, number, unit, capitalised, number with its unit) and literal code of every word."""
    flag = lambda column: column.to_numpy(zero_copy_only=False)
    bare = pc.utf8_trim(names, "\x1e")
    core = pc.utf8_trim(bare, PUNCTUATION)
    low = pc.utf8_lower(core)
    cores, flags = low.to_pylist(), np.zeros((len(names), 6), bool)
    flags[:, 0] = flag(pc.not_equal(core, ""))
    flags[:, 1] = flag(pc.or_(pc.ends_with(names, "\x1e"), pc.match_substring_regex(names, ENDS)))
    flags[:, 2] = flag(pc.is_in(low, pa.array(sorted(NUMBER_WORDS), low.type)))
    flags[:, 3] = flag(pc.is_in(low, pa.array(sorted(UNITS), low.type)))
    flags[:, 4] = flag(pc.match_substring_regex(core, r"^\p{Lu}\p{L}*\p{Ll}\p{L}*$")) & ~flag(pc.match_substring_regex(core, r"^.\p{L}*\p{Lu}"))
    for i in np.flatnonzero(flag(pc.match_substring_regex(bare, r"\p{N}"))).tolist():
        own, whole = core[i].as_py(), bare[i].as_py()
        own = whole if NUMBER.fullmatch(whole) else own
        fused = FUSED.fullmatch(own) if own[:1] in "+-0123456789" else None
        cores[i] = own.lower()
        flags[i, 0], flags[i, 2] = own != "", NUMBER.fullmatch(own) is not None
        flags[i, 5] = fused is not None and cores[i][len(fused[1]) :] in UNITS
    literal = np.fromiter((xxhash.xxh3_64_intdigest("=" + c) for c in cores), np.uint64, len(cores))
    return cores, flags, literal


class Canonical:
    """Canonical words of many texts: hash, kind, value and the text each belongs to."""

    def __init__(self, texts: list[str]):
        column = pc.replace_substring(pa.array(texts, pa.large_string()), "\n", "\x1e ")
        split = pc.ascii_split_whitespace(column)
        coded, offsets = split.flatten().dictionary_encode(), split.offsets.to_numpy()
        self.cores, flags, literal = _words(coded.dictionary)
        at = coded.indices.to_numpy()
        there, ends, number, unit, capital, fused = (flags[at, j] if len(at) else np.zeros(0, bool) for j in range(6))
        kept = np.flatnonzero(there)
        before = np.concatenate([[0], np.cumsum(there)])
        self.bounds = before[offsets - offsets[0]]
        ended = np.concatenate([[0], np.cumsum(ends)])
        previous = np.concatenate([[-1], kept[:-1]]) if len(kept) else kept
        first = np.zeros(len(kept), bool)
        first[self.bounds[:-1][self.bounds[:-1] < len(kept)]] = True
        starts = first | (ended[kept] > ended[np.maximum(previous, 0)])
        number, unit, fused = (x[kept] for x in (number, unit, fused))
        after_number = np.concatenate([[False], number[:-1]]) & ~first if len(kept) else number
        self.capital = capital[kept]
        self.kind = np.where(number | fused, NUM, np.where(unit & after_number, UNIT, np.where(self.capital & ~starts, NAME, LITERAL)))
        self.word, self.starts = at[kept], starts
        #: Words that may be names or not, as they begin a sentence.
        self.maybe = self.capital & starts & (self.kind == LITERAL)
        placeholder = np.array([0, *[_word_code(k, "") for k in (NUM, UNIT, NAME)]], np.uint64)
        self.literal = literal[self.word] if len(kept) else np.zeros(0, np.uint64)
        self.codes = np.where(self.kind == LITERAL, self.literal, placeholder[self.kind])
        self.named = np.where(self.maybe, placeholder[NAME], self.codes)

    def _runs(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, first word within the text, place) of every run of so many words."""
        n = np.diff(self.bounds)
        counts = np.maximum(n - width + 1, 0)
        text = np.repeat(np.arange(len(n)), counts)
        first = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        return text, first, self.bounds[:-1][text] + first

    def _among(self, marks: np.ndarray, at: np.ndarray, width: int | np.ndarray) -> np.ndarray:
        """How many of the words in each run are marked."""
        upto = np.concatenate([[0], np.cumsum(marks)])
        return upto[at + width] - upto[at]

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(text, first word, hash, hash of the first form, number of words, form) of every window with few enough placeholders."""
        text, first, at = self._runs(WIDTH)
        n = np.diff(self.bounds)
        short = np.flatnonzero((n > 0) & (n < WIDTH))
        forms = []
        for codes in (self.codes, self.named):
            runs = np.zeros(max(0, len(codes) - WIDTH + 1), np.uint64)
            for place in range(WIDTH):
                runs += codes[place : len(codes) - WIDTH + 1 + place] * FACTORS[place]
            alone = [
                (codes[a:b] * FACTORS[WIDTH : WIDTH + b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
                for a, b in zip(self.bounds[short].tolist(), self.bounds[short + 1].tolist())
            ]
            forms.append(mixed(np.concatenate([runs[at], np.array(alone, np.uint64)])).astype(np.int64))
        text, first, width = np.append(text, short), np.append(first, np.zeros(len(short), int)), np.append(np.full(len(at), WIDTH), n[short])
        at = np.append(at, self.bounds[short])
        slots, doubtful = self._among(self.kind != LITERAL, at, width), self._among(self.maybe, at, width)
        plain = np.flatnonzero(slots <= MOST_SLOTS)
        other = np.flatnonzero((doubtful > 0) & (slots + doubtful <= MOST_SLOTS))
        both = np.concatenate([plain, other])
        form = np.repeat([0, 1], [len(plain), len(other)])
        return text[both], first[both], np.concatenate([forms[0][plain], forms[1][other]]), forms[0][both], width[both], form

    def whole_windows(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(text, first word, hash, form) of the runs of so many words that can be a whole item, first word as it is or as a name."""
        text, first, at = self._runs(width)
        total = len(self.codes)
        after = at + width
        bounded = (after == self.bounds[1:][text]) | (self.starts | self.capital)[np.minimum(after, max(total - 1, 0))] if len(at) else np.zeros(0, bool)
        bounded &= (self.starts | self.capital)[at]
        kept, hashes = [], []
        for form, codes in enumerate((self.codes, self.named)):
            runs = np.full(len(at), width, np.uint64)
            for place in range(width):
                own = codes if place or form else np.where(self.kind == NAME, self.literal, codes)
                runs = mixed(runs ^ own[at + place]) * FACTORS[0]
            literals = self._among((self.kind == LITERAL) & ~(self.maybe & bool(form)), at, width)
            if not form:
                literals = literals + (self.kind[at] == NAME)
            kept.append(np.flatnonzero((literals >= ENOUGH_LITERALS) | (bounded & (literals >= LEAST_LITERALS))))
            hashes.append(mixed(runs ^ LITERAL_SALT)[kept[-1]].astype(np.int64))
        both = np.concatenate(kept)
        return text[both], first[both], np.concatenate(hashes), np.repeat([0, 1], [len(k) for k in kept])

    def literal_windows(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, first word within the text, hash) of every run of so many words as they stand."""
        n, total = np.diff(self.bounds), len(self.literal)
        runs = np.full(max(0, total - width + 1), width, np.uint64)
        for place in range(width):
            runs += self.literal[place : total - width + 1 + place] * FACTORS[place + (WIDTH if width < WIDTH else 0)]
        counts = np.maximum(n - width + 1, 0)
        text = np.repeat(np.arange(len(n)), counts)
        first = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        at = self.bounds[:-1][text] + first
        if width <= ALONE and len(at):
            ends = at + width == self.bounds[1:][text]
            good = self.starts[at] & (ends | self.starts[np.minimum(at + width, total - 1)])
            text, first, at = text[good], first[good], at[good]
        return text, first, mixed(runs[at] ^ LITERAL_SALT).astype(np.int64)

    def slots(self, text: int, first: int, width: int, form: int = 0, whole: bool = False) -> list[str]:
        """Kind and value of the placeholders in a window; a whole item's first word is none in the first form."""
        a = self.bounds[text] + first
        kinds = np.where(self.maybe[a : a + width] & bool(form), NAME, self.kind[a : a + width])
        if whole and not form and kinds[0] == NAME:
            kinds[0] = LITERAL
        return [f"{kinds[i]}{self.cores[self.word[a + i]]}" for i in np.flatnonzero(kinds != LITERAL).tolist()]


def _item_windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for a, b in steps(batch["text"].tolist()):
            part = batch.iloc[a:b]
            form = Canonical([text or "" for text in part["text"]])
            text, first, hashes, marks, width, forms = form.windows()
            n = np.diff(form.bounds)
            distinct = np.bincount(np.unique(np.column_stack([text, marks]), axis=0)[:, 0], minlength=len(n)) if len(text) else np.zeros(len(n), int)
            few = distinct < LEAST_TEMPLATES
            some = np.flatnonzero(~few[text] | (n[text] < WIDTH))
            text, first, hashes, marks, width, forms = (x[some] for x in (text, first, hashes, marks, width, forms))
            slots = [form.slots(*x) for x in zip(text.tolist(), first.tolist(), width.tolist(), forms.tolist())]
            yield _windows(part, text, first, hashes, marks, width, TEMPLATE, slots)
            for size in range(1, WIDTH + 1):
                text, first, hashes = form.literal_windows(size)
                own = np.flatnonzero(few[text] & (np.minimum(n[text], WIDTH) == size))
                yield _windows(part, text[own], first[own], hashes[own], hashes[own], np.full(len(own), size), LITERALLY, [[] for _ in own])
            for size in sorted({min(int(x), WHOLE) for x in n[few] if x >= LEAST_LITERALS}):
                text, first, hashes, forms = form.whole_windows(size)
                own = np.flatnonzero(few[text] & (np.minimum(n[text], WHOLE) == size))
                slots = [form.slots(t, f, size, k, True) for t, f, k in zip(text[own].tolist(), first[own].tolist(), forms[own].tolist())]
                # The two forms of a run are one window.
                yield _windows(part, text[own], first[own], hashes[own], first[own], np.full(len(own), size), AS_WHOLE, slots)


def _windows(
    part: pd.DataFrame, text: np.ndarray, first: np.ndarray, hashes: np.ndarray, marks: np.ndarray, width: np.ndarray, route: int, slots: list
) -> pd.DataFrame:
    """Windows of items; equal marks are one window of the item."""
    columns = {"item": part["item"].to_numpy()[text], "i_row": part["i_row"].to_numpy()[text], "route": np.full(len(text), route), "width": width}
    return pd.DataFrame(columns | {"i_at": first, "hash": hashes, "mark": marks, "i_slots": pd.Series(slots, dtype=object)})


def _hits(table: np.ndarray, literal: list[int], whole: list[int]):
    def seen(hashes: np.ndarray) -> np.ndarray:
        bit = hashes.astype(np.uint64) & np.uint64(TABLE_BITS - 1)
        return np.flatnonzero((table[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1)

    def rows(part: pd.DataFrame, text: np.ndarray, first: np.ndarray, hashes: np.ndarray, slots: list) -> pd.DataFrame:
        columns = {"doc": part["doc"].to_numpy()[text], "row": part["row"].to_numpy()[text], "d_at": first, "hash": hashes}
        return pd.DataFrame(columns | {"d_slots": pd.Series(slots, dtype=object)})

    def hits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a, b in steps(batch["text"].tolist(), STEP_CHARS):
                part = batch.iloc[a:b]
                form = Canonical([text or "" for text in part["text"]])
                text, first, hashes, _, width, forms = form.windows()
                some = seen(hashes)
                yield rows(part, text[some], first[some], hashes[some], [form.slots(text[i], first[i], width[i], forms[i]) for i in some.tolist()])
                for size in literal:
                    text, first, hashes = form.literal_windows(size)
                    some = seen(hashes)
                    yield rows(part, text[some], first[some], hashes[some], [[] for _ in some])
                for size in whole:
                    text, first, hashes, forms = form.whole_windows(size)
                    some = seen(hashes)
                    yield rows(part, text[some], first[some], hashes[some], [form.slots(text[i], first[i], size, forms[i], True) for i in some.tolist()])

    return hits


def _consistent(chain: list) -> int | None:
    """The number of slots, if one item value always stands for one document value and the other way round."""
    there, back = defaultdict(set), defaultdict(set)
    for m in chain:
        for old, new in zip(m["i_slots"], m["d_slots"]):
            there[old].add(new)
            back[new].add(old)
    return len(there) if all(len(v) == 1 for v in (*there.values(), *back.values())) else None


def _chain(matches: list) -> list:
    """The longest chain of matches that ascends in the document and in the item, of equal ones that with fewest changes of offset."""
    d, i = (np.array([m[name] for m in matches], np.int64) for name in ("d_at", "i_at"))
    score, before = np.ones(len(d)), np.full(len(d), -1)
    change = 1 / (len(d) + 1)
    for at in range(1, len(d)):
        ahead = np.flatnonzero((d[:at] < d[at]) & (i[:at] < i[at]))
        if len(ahead):
            gain = score[ahead] + 1 - change * (d[ahead] - i[ahead] != d[at] - i[at])
            best = int(gain.argmax())
            score[at], before[at] = gain[best], ahead[best]
    chain, at = [], int(score.argmax())
    while at >= 0:
        chain.append(matches[at])
        at = int(before[at])
    return chain[::-1]


def _occurrences(cover: float):
    def judge(matches: list, total: int) -> tuple[int, int, int, int] | None:
        """Distinct item windows, consistent slots, first and last word of the best occurrence.

        An occurrence lies within `slack` of some offset. Its matches are those on that offset or, where words were
        inserted or left out or a window recurs, the best chain of all within the band.
        """
        best, slack = None, max(2, total // 5)
        by_offset = defaultdict(list)
        # Of the forms in which two windows match, that with fewer slots.
        matches = list({(m["d_at"], m["i_at"]): m for m in sorted(matches, key=lambda m: -len(m["i_slots"]))}.values())
        for m in sorted(matches, key=lambda m: (m["d_at"], m["i_at"])):
            by_offset[m["d_at"] - m["i_at"]].append(m)
        offsets = sorted(by_offset)
        most = len({m["mark"] for m in matches})
        tried = None

        def take(chain: list) -> None:
            nonlocal best
            found = len({m["mark"] for m in chain})
            if found >= cover * total and (best is None or (-found, chain[0]["d_at"]) < (-best[0], best[2])):
                slots = _consistent(chain)
                if slots is not None:
                    best = found, slots, chain[0]["d_at"], chain[-1]["d_at"]

        for offset in offsets:
            take(by_offset[offset])
        for offset in offsets:
            if best is not None and best[0] == most:
                break
            band = offsets[bisect_left(offsets, offset - slack) : bisect_right(offsets, offset + slack)]
            # A band's distinct windows bound what its chains cover.
            marks = {m["mark"] for o in band for m in by_offset[o]}
            if band != tried and len(band) > 1 and len(marks) >= cover * total and (best is None or len(marks) > best[0]):
                take(_chain(sorted((m for o in band for m in by_offset[o]), key=lambda m: (m["d_at"], m["i_at"]))))
            tried = band
        return best

    def occurrences(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            best = [judge(m, t) for m, t in zip(batch["matches"], batch["windows"])]
            keep = [b is not None for b in best]
            out = batch.loc[keep, ["doc", "row", "i_row", "item", "windows"]].copy()
            for i, name in enumerate(("matched", "slots", "first_word", "last_word")):
                out[name] = [b[i] for b in best if b is not None]
            yield out

    return occurrences


def contaminated(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", cover: float = COVER
) -> DataFrame:
    """doc_id, row (a hash of id and text), item_id, windows, matched, coverage, slots, first_word, last_word per find."""
    shipped(docs.sparkSession)
    own = items.select(F.col(item_id).cast("string").alias("item"), F.xxhash64(item_id, item_text).alias("i_row"), F.col(item_text).alias("text"))
    schema = "item string, i_row long, route int, width int, i_at long, hash long, mark long, i_slots array<string>"
    windows = written(own.mapInPandas(_item_windows, schema).distinct(), "items")
    bit = F.col("hash").bitwiseAND(TABLE_BITS - 1)
    marks = windows.select(F.shiftright(bit, 3).cast("int").alias("at"), F.expr(f"shiftleft(1, CAST(hash & {TABLE_BITS - 1} & 7 AS INT))").alias("bits"))
    table = np.zeros(TABLE_BITS // 8, np.uint8)
    for row in marks.groupBy("at").agg(F.bit_or("bits").alias("bits")).toLocalIterator():
        table[row["at"]] = row["bits"]

    widths = {(row["route"], row["width"]) for row in windows.where(f"route <> {TEMPLATE}").select("route", "width").distinct().collect()}
    literal, whole_items = (sorted(w for r, w in widths if r == route) for route in (LITERALLY, AS_WHOLE))
    rows = docs.select(F.col(doc_id).cast("string").alias("doc"), F.xxhash64(doc_id, text).alias("row"), F.col(text).alias("text"))
    hits = rows.mapInPandas(tidy(_hits(table, literal, whole_items)), "doc string, row long, d_at long, hash long, d_slots array<string>")
    totals = windows.groupBy("i_row", "route").agg(F.countDistinct("mark").alias("windows"), F.max("item").alias("item"))
    whole = written(windows.join(totals.withColumnRenamed("item", "its_item"), ["i_row", "route"]).drop("item").withColumnRenamed("its_item", "item"), "items")
    # Bands of offsets overlap by half, so every occurrence lies within one; only bands that hold enough of the item are collected.
    reach = 2 * F.greatest(F.lit(2), F.floor(F.col("windows") / 5)) + 1
    band = F.floor((F.col("d_at") - F.col("i_at")) / reach)
    matches = written(written(hits, "hits").join(whole, "hash").withColumn("band", F.explode(F.array(band - 1, band))), "matches")
    group = ["row", "i_row", "route", "band"]
    enough = matches.groupBy(*group, "windows").agg(F.countDistinct("mark").alias("found")).where(F.col("found") >= cover * F.col("windows"))
    pairs = (
        matches.join(enough.select(*group), group, "left_semi")
        .groupBy("doc", *group, "item", "windows")
        .agg(F.collect_set(F.struct("d_at", "i_at", "mark", "d_slots", "i_slots")).alias("matches"))
    )
    judged = pairs.select("doc", "row", "i_row", "item", "windows", "matches").mapInPandas(
        _occurrences(cover), "doc string, row long, i_row long, item string, windows long, matched long, slots long, first_word long, last_word long"
    )
    # An item that is found in several bands or by both routes is one find.
    found = judged.groupBy("doc", "row", "i_row").agg(
        F.max_by(F.struct("item", "windows", "matched", "slots", "first_word", "last_word"), F.struct("matched", -F.col("first_word"))).alias("best")
    ).select("doc", "row", "best.*")
    return found.select(
        F.col("doc").cast(docs.schema[doc_id].dataType).alias("doc_id"),
        "row",
        F.col("item").cast(items.schema[item_id].dataType).alias("item_id"),
        "windows",
        "matched",
        (F.col("matched") / F.col("windows")).alias("coverage"),
        "slots",
        "first_word",
        "last_word",
    )
