"""Near-duplicate documents: fast similarity sketches, banding, links confirmed on full shingle sets, components.

Sketch. Each text's set of five-word shingles fills SIZE coordinates. In round i every element draws a coordinate and a
value, and a coordinate keeps the least (round, value) it sees; from round SIZE on, round i aims at coordinate
i - SIZE, so all are filled after 2 * SIZE rounds at the latest, and large sets need one or two. Coordinates of two
sets agree with probability equal to their Jaccard similarity, concentrated as for independent hash functions.

Candidates. BANDS bands of ROWS coordinates give one key each. Sets with similarity 0.85 share 14 of 32 keys on average and
fewer than 3 with probability 2.4e-6; sets with similarity 0.8 share 10 and none with probability 3.0e-6. `least_shared` is the largest
number of keys, 3 at most, that links at the bound fall short of with a probability below MOST_MISSED; pairs with fewer are no
candidates. Texts with equal sets are one node.
First, the members of a key are compared with one of them only: the node whose keys are the most common, which in a
group of copies is the text they were made from. The links found are joined into components. While the keys whose members are in
different components hold many pairs, every member outside a key's largest component is compared with one drawn member of it and one
drawn member outside, each key and round with others, and the components are joined anew; so members that are linked with some
share of a large group, as filled-in forms are, join it after a few rounds of a few pairs each. Rounds end when few pairs are left or
a round connects few. Then every member outside the largest component of its key is compared with the members of other components, unless
they have too many shingles that no other of these texts has to be linked with any, or their parities show that too many shingles differ:
a set's parities tell for each of PARITIES classes of shingles whether it holds an odd number of them, so two sets differ in at least as many
shingles as parities. No link is lost by that; up to some thousand shingles it rules out most pairs that are none, in all rounds.
So every candidate pair is compared on its full sets, already connected, or shown to be no link by its counts, and a
group of thousands whose members are linked is not paired with itself. What stays quadratic is a group whose members share keys and
are no links: those that no smaller set of comparisons can tell apart.

Links need 100 * |intersection| >= percent * |union| on the full sets (shingles as 40-bit numbers; two unequal ones
of a pair of 1,000-word texts meet with probability 1e-6). A text's set is made again for the nodes that share a key; a bit table of their
hashes, of bounded size, keeps the other texts out of that shuffle.

Defined results: a null or empty text, or one without words, has an empty set and is linked with nothing. Null doc_ids
are nodes like others and never the smallest id; a component of null ids only has a null id, and its rows are kept.
Rows with equal ids and texts are one node. `chosen` is true for one row hash of every component, that of the least (doc_id, row) with nulls
last, and for every row without shingles. An empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelens.llm.columns import perhaps_among, written
from lakelens.llm.components import components
from lakelens.llm.shared import shipped, tidy
from lakelens.llm.shingles import FACTORS, mixed, shingle_sets, steps

BANDS, ROWS = 32, 5
SIZE = BANDS * ROWS
MOST_SHARED, MOST_MISSED = 3, 5e-6
#: Another round of drawn pairs is made while keys of more members than this hold more pairs than all keys have members, and
#: the last round has left no more than this share of those outside.
LARGE_KEY, LEAST_GAIN = 64, 0.7
#: Classes of shingles, by their hash, whose parities bound how much two sets differ.
PARITIES = 1024
FULL = np.uint64(2**64 - 1)


def missed(percent: int, keys: int) -> float:
    """The probability that two sets of this similarity share fewer than so many keys."""
    p = (percent / 100) ** ROWS
    return sum(math.comb(BANDS, k) * p**k * (1 - p) ** (BANDS - k) for k in range(keys))


def least_shared(percent: int) -> int:
    return max([1, *(k for k in range(1, MOST_SHARED + 1) if missed(percent, k) < MOST_MISSED)])


def sketches(sets: list[np.ndarray], size: int = SIZE) -> np.ndarray:
    """A row of `size` coordinates per set that is not empty."""
    counts = np.array([len(s) for s in sets], np.int64)
    cells = np.full(len(sets) * size, FULL, np.uint64)
    items = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), counts)
    for turn in range(2 * size):
        drawn = mixed(items ^ mixed(np.array([turn + 1], np.uint64) * FACTORS[0]))
        value = (np.uint64(turn) << np.uint64(32)) | (drawn & np.uint64(0xFFFFFFFF))
        place = ((drawn >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64) if turn < size else turn - size
        np.minimum.at(cells, owner * size + place, value)
        open_rows = (cells.reshape(-1, size) == FULL).any(axis=1)
        going = open_rows[owner]
        if not going.any():
            break
        if not going.all():
            items, owner = items[going], owner[going]
    return cells.reshape(-1, size)


def band_keys(rows: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, which also tells the band."""
    parts = rows.reshape(len(rows), BANDS, ROWS)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)[None, :] * FACTORS[ROWS]
    for i in range(ROWS):
        keys = mixed(keys ^ parts[:, :, i]) * FACTORS[i]
    return mixed(keys).astype(np.int64)


def _sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = batch["text"].tolist()
        for a, b in steps(texts):
            sets = shingle_sets([text or "" for text in texts[a:b]])
            filled = [s for s in sets if len(s)]
            keys = iter(band_keys(sketches(filled)))
            part = batch.iloc[a:b][["doc_id", "row"]].copy()
            part["n"] = [len(s) for s in sets]
            part["node"] = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            part["keys"] = [next(keys) if len(s) else None for s in sets]
            yield part


def _short(numbers: np.ndarray) -> bytes:
    """The upper 40 bits of each, ascending, without repeats."""
    upper = np.unique(numbers >> np.uint64(24))
    return upper.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _long(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 5, 8), np.uint8)
    wide[:, :5] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    return wide.view("<u8").ravel()


def parities(elements: bytes) -> np.ndarray:
    """A bit per class, in 64-bit words: whether the set holds an odd number of its shingles."""
    odd = np.bincount((_long(elements) % np.uint64(PARITIES)).astype(np.int64), minlength=PARITIES) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = batch["text"].tolist()
        for a, b in steps(texts):
            sets = [_short(s) for s in shingle_sets(texts[a:b])]
            yield pd.DataFrame({"node": batch["node"].iloc[a:b].to_numpy(), "elements": sets, "size": [len(s) // 5 for s in sets], "parities": [parities(s) for s in sets]})


def _compare(percent: int):
    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            linked, cached, known = [], None, None
            for a, left, right in zip(batch["a"], batch["left"], batch["right"]):
                if cached != a:
                    cached, known = a, _long(left)
                other = _long(right)
                both = len(np.intersect1d(known, other, assume_unique=True))
                linked.append(100 * both >= percent * (len(known) + len(other) - both))
            yield batch.loc[linked, ["a", "b"]]

    return compare


def _differing(one: str, other: str) -> Column:
    """In how many parities two sets differ."""
    return reduce(add, (F.bit_count(F.col(one)[i].bitwiseXOR(F.col(other)[i])) for i in range(PARITIES // 64)))


def _can_link(percent: int) -> Column:
    """Whether size and parities of one set and another (o_size, o_parities) allow a link."""
    both = F.col("size") + F.col("o_size")
    return (both - _differing("parities", "o_parities")) * (100 + percent) >= 2 * percent * both


def links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are similar on their full sets."""
    small = sets.select(F.col("node").alias("a"), "size", "parities")
    other = small.withColumnsRenamed({"a": "b", "size": "o_size", "parities": "o_parities"})
    near = written(pairs.join(other, "b").join(small, "a").where(_can_link(percent)).select("a", "b"), "near")
    ends = near.select(F.explode(F.array("a", "b")).alias("end")).select(F.xxhash64("end"))
    wanted = perhaps_among(sets.select("node", "elements"), F.xxhash64("node"), ends).where("perhaps")
    right = near.join(wanted.select(F.col("node").alias("b"), F.col("elements").alias("right")), "b")
    both = right.join(wanted.select(F.col("node").alias("a"), F.col("elements").alias("left")), "a")
    return both.select("a", "b", "left", "right").mapInPandas(tidy(_compare(percent)), "a binary, b binary")


def _able(sets: DataFrame, percent: int) -> DataFrame:
    """(node, common): shingles that some other node has as well, of the nodes that have enough of them for any link."""
    one, two = F.xxhash64("node"), F.xxhash64(F.lit(1), "node")
    elements = F.expr("explode(transform(sequence(0, length(elements) div 5 - 1), i -> substring(elements, 5 * i + 1, 5)))")
    own = (
        sets.select(one.alias("x"), two.alias("y"), elements.alias("element"))
        .groupBy("element")
        .agg(F.min("x").alias("x"), F.max("x").alias("x2"), F.min("y").alias("y"), F.max("y").alias("y2"))
        .where("x = x2 AND y = y2")
        .groupBy("x", "y")
        .agg(F.count("*").alias("alone"))
    )
    counted = sets.select("node", "n", one.alias("x"), two.alias("y")).join(own, ["x", "y"], "left")
    common = F.col("n") - F.coalesce("alone", F.lit(0))
    return counted.where(common * 100 >= F.col("n") * percent).select("node", common.alias("common"))


def _close(percent: int):
    """Whether two set sizes allow a link."""
    return lambda n, m: F.least(n, m) * 100 >= F.greatest(n, m) * percent


def _several(members: DataFrame, roots: DataFrame) -> DataFrame:
    """(key, node, n, part, main) of the keys whose members are in different components; main is the largest of these."""
    placed = members.join(roots.withColumnRenamed("root", "part"), members["node"] == roots["node"], "left").select(
        members["key"], members["node"], "n", F.coalesce("part", members["node"]).alias("part")
    )
    parts = placed.groupBy("key", "part").agg(F.count("*").alias("c"))
    split = parts.groupBy("key").agg(F.count("*").alias("parts"), F.max_by("part", F.struct("c", "part")).alias("main")).where("parts > 1").drop("parts")
    return written(placed.join(split, "key"), "several")


def _drawn(several: DataFrame, percent: int, seed: int) -> DataFrame:
    """Pairs (a, b): every member outside its key's main part with a drawn member of that part and a drawn one outside."""
    draw = F.struct(F.xxhash64(F.lit(seed), "key", "node"), "node", "n", "part")
    outside = F.col("part") != F.col("main")
    drawn = several.groupBy("key").agg(F.max(F.when(~outside, draw)).alias("of_main"), F.max(F.when(outside, draw)).alias("of_others"))
    both = several.where(outside).join(drawn, "key").select("node", "n", "part", F.explode(F.array("of_main", "of_others")).alias("one"))
    able = both.where((F.col("part") != F.col("one.part")) & _close(percent)(F.col("n"), F.col("one.n")))
    return able.select(F.greatest("one.node", "node").alias("a"), F.least("one.node", "node").alias("b")).distinct()


def _grown(roots: DataFrame, links: DataFrame) -> DataFrame:
    """The components (node, root) with these links (a, b) besides."""
    return roots if links.isEmpty() else components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(links))


def near_duplicates(docs: DataFrame, percent: int = 85, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, row (a hash of id and text), n_shingles, component_id, kept, chosen."""
    shipped(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(doc_id, text).alias("row"), F.col(text).alias("text"))
    sketched = rows.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(
        tidy(_sketch), "doc_id string, row long, n long, node binary, keys array<long>"
    )
    sketched = written(sketched.withColumn("doc_id", F.col("doc_id").cast("long")), "sketches")
    nodes = written(
        sketched.where("node IS NOT NULL")
        .groupBy("node")
        .agg(F.min(F.struct("doc_id", "row")).alias("at"), F.min("doc_id").alias("least"), F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "row")).alias("one"), F.first("n").alias("n"), F.first("keys").alias("keys")),
        "nodes",
    )
    keyed = nodes.select("node", "n", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    members = written(keyed.join(shared, "key"), "members")

    common = members.groupBy("node").agg(F.sum("members").alias("common"))
    ranked = members.join(common, "node").groupBy("key").agg(F.max(F.struct("common", "node", "n")).alias("best"))
    close = _close(percent)
    first = written(
        members.join(ranked, "key")
        .where((F.col("node") != F.col("best.node")) & close(F.col("n"), F.col("best.n")))
        .select(F.greatest("best.node", "node").alias("a"), F.least("best.node", "node").alias("b"))
        .distinct(),
        "pairs",
    )
    wanted = members.select("node").distinct().join(nodes.select("node", "at"), "node")
    perhaps = perhaps_among(rows, F.col("row"), wanted.select("at.row")).where("perhaps")
    found = perhaps.join(wanted, (F.col("row") == F.col("at.row")) & F.col("doc_id").eqNullSafe(F.col("at.doc_id")))
    sets = written(found.select("node", "text").mapInPandas(tidy(_sets), "node binary, elements binary, size long, parities array<long>").dropDuplicates(["node"]), "sets")
    one = written(links(first, sets, percent), "links")

    roots, before, room, able = components(one), None, members.count(), None
    while True:
        several = _several(members, roots)
        if able is None:
            able = written(_able(several.select("node", "n").distinct().join(sets, "node"), percent), "able")
        apart = written(several.join(able, "node"), "apart")
        held = apart.groupBy("key").agg(F.count("*").alias("c"), F.count_if(F.col("part") != F.col("main")).alias("out"))
        pairs, out = held.where(F.col("c") > LARGE_KEY).agg(F.sum(F.col("c") * F.col("out")), F.sum("out")).first()
        if not out or pairs <= room or (before is not None and out > LEAST_GAIN * before):
            break
        if before is not None:
            # Much fewer are left, and so what they have in common with others.
            able = None
        tried = written(_drawn(apart, percent, 0 if before is None else out).join(first, ["a", "b"], "left_anti"), "pairs")
        first = first.unionByName(tried)
        more, before = written(links(tried, sets, percent), "links"), out
        if more.isEmpty() and able is not None:
            # Nothing has changed, so these are the keys that the next round would hold.
            break
        roots = _grown(roots, more)
    apart = apart.join(nodes.select("node", "keys"), "node").join(sets.select("node", "size", "parities"), "node")
    columns = ("node", "n", "part", "keys", "common", "parities", "size")
    outside = apart.where("part <> main").select("key", *[F.col(c).alias(f"o_{c}") for c in columns])
    joint = F.array_intersect("keys", "o_keys")
    second = written(
        apart.join(outside, "key")
        .where(
            (F.col("part") != F.col("o_part"))
            & ((F.col("part") == F.col("main")) | (F.col("node") < F.col("o_node")))
            & close(F.col("n"), F.col("o_n"))
            & (F.least("common", "o_common") * (100 + percent) >= (F.col("n") + F.col("o_n")) * percent)
            & _can_link(percent)
            & (F.size(joint) >= least_shared(percent))
            & (F.col("key") == F.array_min(joint))
        )
        .select(F.greatest("o_node", "node").alias("a"), F.least("o_node", "node").alias("b"))
        .join(first, ["a", "b"], "left_anti"),
        "pairs",
    )
    two = written(links(second, sets, percent), "links")
    final = _grown(roots, two)
    whole = (
        nodes.join(final.withColumnRenamed("node", "member"), F.col("node") == F.col("member"), "left")
        .select("node", F.coalesce("root", "node").alias("root"), "least", "one")
    )
    least = whole.groupBy("root").agg(F.min("least").alias("component_id"), F.min("one").alias("first"))
    named = written(whole.join(least, "root").select("node", "component_id", F.col("first.row").alias("chosen_row")), "classes")
    joined = sketched.join(named.withColumnRenamed("node", "its_node"), F.col("node") == F.col("its_node"), "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select(
        "doc_id",
        "row",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
        (F.col("node").isNull() | (F.col("row") == F.col("chosen_row"))).alias("chosen"),
    )
