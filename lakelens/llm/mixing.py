"""Mixing sources to target weights by min-cost flow over membership patterns.

A document belongs to one or more sources and has a size. Documents are summed by membership pattern (the sorted set
of their sources); only these sums reach the driver, where token capacity is routed from patterns to source quotas.
Taking a pattern's words for the r-th time costs more than for the (r-1)-th, so the cost of repetition is convex
and first uses are spent before any repeat. With costs that depend on the round alone, the cheapest flow is found
by running a maximum flow round by round, each round opening one more copy of every pattern.

The flow into a pattern says how many full copies each of its documents gets and how many words of one more copy are
wanted. Those go to the documents that come first in a seeded hash order: hash bins are summed, then finer bins inside
the bin where the wanted amount ends, and only the few rows of that finer bin are ordered. One more document, the one
whose size is nearest to what is still missing, closes the gap where that brings the sum nearer. No step holds the
rows of a pattern together, however many there are.

Defined results: a null source is a source of its own, last in the order; documents without any source are in no mix and are
taken 0 times; a null text has size 0. Documents of size 0 are taken 0 words. Repeated rows are separate documents
with the same hash; which of them is taken is not told apart. An empty table gives an empty result. Only the named
columns are read.
"""

from __future__ import annotations

from collections import defaultdict, deque
from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelens.llm.columns import word_count, written

#: Hash bins per level; two levels split a pattern into a million bins.
BINS = 1024
#: Patterns the driver plans for; one row per pattern is also the size bound of the tables broadcast here. Beyond it
#: the plan is refused, never cut short.
MOST_PATTERNS = 50_000
SEED = 17

Source = str | None
Pattern = tuple[Source, ...]


def row_hash(doc_id: Column, text: Column, seed: int = SEED) -> Column:
    return F.xxhash64(F.lit(seed), doc_id, text)


def by_code_point(sources: Sequence[Source]) -> list[Source]:
    return sorted(sources, key=lambda s: (s is None, s or ""))


def source_targets(
    sizes: dict[Source, int], weights: Sequence[int] = (3, 1, 2), share: Fraction = Fraction(3, 2), limit: int = 2
) -> dict[Source, Fraction]:
    """Shares of `share` times all sizes by weight (repeating in source order), none above `limit` times its source.

    What a capped source cannot take is shared among the others by weight, until none is above its limit.
    """
    order = by_code_point(list(sizes))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, free, targets = share * sum(sizes.values()), list(order), {}
    while free:
        each = Fraction(left) / sum(weight[s] for s in free)
        full = [s for s in free if each * weight[s] > limit * sizes[s]]
        if not full:
            return targets | {s: each * weight[s] for s in free}
        for s in full:
            targets[s] = Fraction(limit * sizes[s])
            left -= targets[s]
        free = [s for s in free if s not in targets]
    return targets


def route(capacity: dict[Pattern, int], quotas: dict[Source, int], rounds: int = 2) -> dict[tuple[Pattern, Source], int]:
    """Words each source takes from each pattern: quotas are filled as far as possible at the least repetition cost."""
    room: dict[object, dict[object, int]] = defaultdict(dict)

    def edge(a, b, amount):
        room[a][b] = room[a].get(b, 0) + amount
        room[b].setdefault(a, 0)

    endless = rounds * sum(capacity.values()) + 1
    for pattern in capacity:
        edge("start", ("pattern", pattern), 0)
        for source in pattern:
            edge(("pattern", pattern), ("source", source), endless)
    for source, quota in quotas.items():
        edge(("source", source), "end", quota)
    for _ in range(rounds):
        for pattern, amount in capacity.items():
            room["start"][("pattern", pattern)] += amount
        _fill(room)
    return {
        (pattern, source): room[("source", source)][("pattern", pattern)]
        for pattern in capacity
        for source in pattern
        if room[("source", source)][("pattern", pattern)]
    }


def _fill(room: dict) -> None:
    """Augments along shortest paths, level by level, until nothing more flows from start to end."""
    while True:
        level, waiting = {"start": 0}, deque(["start"])
        while waiting:
            a = waiting.popleft()
            for b, amount in room[a].items():
                if amount and b not in level:
                    level[b] = level[a] + 1
                    waiting.append(b)
        if "end" not in level:
            return
        after, at, path = {a: list(room[a]) for a in level}, dict.fromkeys(level, 0), ["start"]
        while path:
            a = path[-1]
            if a == "end":
                steps = list(zip(path, path[1:]))
                amount = min(room[x][y] for x, y in steps)
                for x, y in steps:
                    room[x][y] -= amount
                    room[y][x] += amount
                del path[next(i for i, (x, y) in enumerate(steps) if not room[x][y]) + 1 :]
                continue
            while at[a] < len(after[a]) and not (room[a][after[a][at[a]]] and level.get(after[a][at[a]]) == level[a] + 1):
                at[a] += 1
            if at[a] < len(after[a]):
                path.append(after[a][at[a]])
            else:
                path.pop()
                if path:
                    at[path[-1]] += 1


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str | Column = "source",
    weights: Sequence[int] = (3, 1, 2),
    share: Fraction = Fraction(3, 2),
    rounds: int = 2,
    seed: int = SEED,
) -> DataFrame:
    """One row per row of `docs`: doc_id, row, sources, size, source_size, target, copies, taken.

    `source` is a column with one source, or an array of sources for documents that are in several. source_size and
    target are sums over the document's sources. `copies` is how often the mix holds the document, `taken` the words,
    `row` the seeded hash of id and text that orders documents (see `row_hash`).
    """
    spark = docs.sparkSession
    member = F.col(source) if isinstance(source, str) else source
    if isinstance(source, str) and docs.schema[source].dataType.typeName() != "array":
        member = F.array(member)
    narrow = written(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.coalesce(F.array_sort(F.array_distinct(member)), F.array()).alias("sources"),
            word_count(F.col(text)).alias("size"),
            row_hash(F.col(doc_id), F.col(text), seed).alias("hash"),
        ),
        "mix-sizes",
    )
    sums = narrow.groupBy("sources").agg(F.sum("size").alias("size")).limit(MOST_PATTERNS + 1).collect()
    if len(sums) > MOST_PATTERNS:
        raise ValueError(f"More than {MOST_PATTERNS} membership patterns; merge sources first.")
    capacity: dict[Pattern, int] = {tuple(row["sources"]): row["size"] for row in sums}
    sizes: dict[Source, int] = defaultdict(int)
    for pattern, amount in capacity.items():
        for s in pattern:
            sizes[s] += amount
    targets = source_targets(sizes, weights, share, rounds)
    flows = route(capacity, {s: round(t) for s, t in targets.items()}, rounds)
    planned: dict[Pattern, int] = defaultdict(int)
    for (pattern, _), amount in flows.items():
        planned[pattern] += amount

    plan = spark.createDataFrame(
        [
            (
                list(pattern),
                sum(sizes[s] for s in pattern),
                float(sum(targets[s] for s in pattern)),
                planned[pattern] // amount if amount else 0,
                planned[pattern] % amount if amount else 0,
            )
            for pattern, amount in capacity.items()
        ],
        "sources array<string>, source_size long, target double, full long, want long",
    )
    rows = (
        narrow.join(F.broadcast(plan), "sources", "left")
        .withColumn("bin", F.pmod(F.col("hash"), F.lit(BINS)))
        .withColumn("fine", F.pmod(F.shiftright("hash", 10), F.lit(BINS)))
    )
    wanting = rows.where("want > 0 AND size > 0").drop("source_size", "target", "full")
    edge1 = written(_edge(wanting, "bin", "want").toDF("sources", "bin1", "before1"), "mix-bins")
    inside = wanting.join(F.broadcast(edge1), "sources").where("bin = bin1").withColumn("left1", F.col("want") - F.col("before1"))
    edge2 = written(_edge(inside, "fine", "left1").toDF("sources", "fine2", "before2"), "mix-bins")
    last = inside.join(F.broadcast(edge2), "sources").where("fine = fine2").withColumn("left2", F.col("left1") - F.col("before2"))
    taken = F.expr(
        "aggregate(few, named_struct('n', 0, 'sum', 0L, 'on', true), (s, x) -> if(s.on AND s.sum + x.total <= left2, "
        "named_struct('n', s.n + 1, 'sum', s.sum + x.total, 'on', true), named_struct('n', s.n, 'sum', s.sum, 'on', false)))"
    )
    upto = (
        last.groupBy("sources", "left2", "bin1", "fine2", "hash", "doc_id", "size")
        .agg(F.sum("size").alias("total"))
        .groupBy("sources", "left2", "bin1", "fine2")
        .agg(F.array_sort(F.collect_list(F.struct("hash", "doc_id", "size", "total"))).alias("few"))
        .withColumn("state", taken)
        .withColumn("end", F.when(F.col("state.n") > 0, F.element_at("few", F.greatest("state.n", F.lit(1)))))
        .withColumn("end", F.when(F.col("end").isNotNull(), F.struct("end.hash", "end.doc_id", "end.size")))
        .select("sources", "bin1", "fine2", "end", (F.col("left2") - F.col("state.sum")).alias("gap"))
    )
    upto = written(upto, "mix-ends")
    one = F.struct("hash", "doc_id", "size")
    upto_end = F.struct("bin", "fine") < F.struct(F.col("bin1").alias("bin"), F.col("fine2").alias("fine"))
    upto_end |= (F.col("bin") == F.col("bin1")) & (F.col("fine") == F.col("fine2")) & F.coalesce(one <= F.col("end"), F.lit(False))
    placed = rows.join(F.broadcast(upto), "sources", "left").withColumn(
        "chosen", F.coalesce((F.col("want") > 0) & (F.col("size") > 0) & upto_end, F.lit(False))
    )
    off = F.abs(F.col("total") - F.col("gap"))
    closing = (
        placed.where("NOT chosen AND size > 0 AND size < 2 * gap")
        .groupBy("sources", "gap", "hash", "doc_id", "size")
        .agg(F.sum("size").alias("total"))
        .where(off < F.col("gap"))
        .groupBy("sources")
        .agg(F.min(F.struct(off.alias("off"), F.col("hash"), F.col("doc_id"), F.col("size"))).alias("nearest"))
        .select("sources", F.struct("nearest.hash", "nearest.doc_id", "nearest.size").alias("nearest"))
    )
    extra = F.col("chosen") | (F.col("nearest").isNotNull() & one.eqNullSafe(F.col("nearest")))
    return (
        placed.join(F.broadcast(written(closing, "mix-gaps")), "sources", "left")
        .withColumn("copies", F.when(F.col("size") > 0, F.coalesce("full", F.lit(0)) + F.when(extra, 1).otherwise(0)).otherwise(0))
        .select(
            "doc_id",
            F.col("hash").alias("row"),
            "sources",
            "size",
            "source_size",
            "target",
            F.col("copies").cast("long").alias("copies"),
            (F.col("copies") * F.col("size")).cast("long").alias("taken"),
        )
    )


def _edge(rows: DataFrame, by: str, want: str) -> DataFrame:
    """Per pattern the bin in which the running sum of sizes reaches `want`, and the sum before that bin."""
    sums = rows.groupBy("sources", want, by).agg(F.sum("size").alias("size"))
    listed = sums.groupBy("sources", want).agg(F.array_sort(F.collect_list(F.struct(F.col(by).alias("bin"), "size"))).alias("bins"))
    state = F.expr(
        "aggregate(bins, named_struct('at', CAST(NULL AS BIGINT), 'before', 0L), (s, x) -> "
        f"if(s.at IS NULL, if(s.before + x.size > {want}, named_struct('at', CAST(x.bin AS BIGINT), 'before', s.before), "
        "named_struct('at', s.at, 'before', s.before + x.size)), s))"
    )
    return listed.select("sources", state.alias("state")).select("sources", "state.at", "state.before")
