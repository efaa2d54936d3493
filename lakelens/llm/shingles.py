"""Word shingles of whole texts as 64-bit numbers, computed for many texts at once inside a task.

Words are runs of characters other than ASCII white space, A-Z lower-cased. A text's set holds its distinct five-word
shingles; a text of one to four words has its whole sequence as the only element; one without words has none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

WIDTH = 5
STEP_CHARS = 1 << 20
#: Odd 64-bit multipliers, one per place in a shingle, from a fixed generator.
FACTORS = np.random.Generator(np.random.PCG64(5)).integers(1, 1 << 63, 2 * WIDTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (xor-shift and multiply)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit number per word, and the bounds of each text's words."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(texts, pa.large_string())))
    flat, offsets = split.flatten(), split.offsets.to_numpy()
    coded = flat.dictionary_encode()
    names = coded.dictionary.to_pylist()
    numbers = np.fromiter((xxhash.xxh3_64_intdigest(name) for name in names), np.uint64, len(names))
    there = np.array([name != "" for name in names], bool)
    at = coded.indices.to_numpy()
    keep = there[at] if len(at) else np.zeros(0, bool)
    before = np.concatenate([[0], np.cumsum(keep)])
    return (numbers[at[keep]] if len(at) else np.zeros(0, np.uint64)), before[offsets - offsets[0]]


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """Per text its distinct shingles, ascending."""
    words, bounds = words_of(texts)
    runs = np.zeros(max(0, len(words) - WIDTH + 1), np.uint64)
    for place in range(WIDTH):
        runs += words[place : len(words) - WIDTH + 1 + place] * FACTORS[place]
    runs = mixed(runs)
    sets = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= WIDTH:
            sets.append(np.unique(runs[a : b - WIDTH + 1]))
        elif b > a:
            short = (words[a:b] * FACTORS[WIDTH : WIDTH + b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            sets.append(mixed(np.array([short], np.uint64)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def steps(texts: list[str | None], chars: int = STEP_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold about so many characters."""
    start = held = 0
    for i, text in enumerate(texts):
        held += len(text or "")
        if held >= chars:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
