"""License scans: passages of documents compared to licence templates by Dice coefficient over word bigrams.

Texts and templates are normalised alike: lower case, everything but letters and digits is a gap, `licence` becomes
`license`. A passage of x distinct bigrams that reaches Dice t with a template of n shares at least t / (2 - t) * n of them and has
x <= (2 - t) / t * n. Words outside the templates are told apart by the document's own dictionary, so a repeated bigram counts once whatever
it is made of. A window of at most that many distinct bigrams, however long, slides over the document, and only where it holds enough of the
template's bigrams is the template compared, exactly, over sets. So every passage that reaches t leads to a find. A passage begins and ends with a bigram of the
template; its ends are moved in turn while its coefficient grows, and what is then left before it is searched again. Overlapping passages of several templates go to the one
with the highest coefficient, then the longer one, then the smaller name.

Templates are a parameter, a table of (license, text) with several texts per licence at will. They go to every task, so
their number of words is bounded by MOST_WORDS; more are refused.

Defined results: null and empty texts, and texts of one word, have no passage. Templates without a bigram match
nothing; null templates are left out. Repeated rows each have their results. Empty tables give no rows. Only the named
columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakelens.llm.shared import shipped
from lakelens.llm.shingles import steps

LEAST_DICE = 0.8
MOST_WORDS = 200_000

# Short notices and texts of common licences, as their authors publish them.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice "
        "and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
        "law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
]


def normal(column: pa.Array) -> pa.Array:
    plain = pc.replace_substring_regex(pc.utf8_lower(column), r"[^\p{L}\p{N}]+", " ")
    return pc.replace_substring_regex(plain, r"\blicence", "license")


def words_of(texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words, every word's index among them, and the bounds of each text's words."""
    split = pc.ascii_split_whitespace(normal(pc.fill_null(pa.array(texts, pa.large_string()), "")))
    coded, offsets = split.flatten().dictionary_encode(), split.offsets.to_numpy()
    names, at = coded.dictionary.to_pylist(), coded.indices.to_numpy()
    keep = np.array([name != "" for name in names], bool)[at] if len(at) else np.zeros(0, bool)
    before = np.concatenate([[0], np.cumsum(keep)])
    return names, at[keep], before[offsets - offsets[0]]


@dataclass(frozen=True)
class Template:
    name: str
    words: int
    bigrams: np.ndarray


class Scanner:
    def __init__(self, templates: list[tuple[str, str]], least: float = LEAST_DICE):
        self.least = least
        names, at, bounds = words_of([text for _, text in templates])
        self.place = {name: i + 1 for i, name in enumerate(names) if name}
        self.base = len(names) + 1
        numbers = np.array([self.place.get(name, 0) for name in names], np.int64)[at] if len(at) else np.zeros(0, np.int64)
        self.templates = []
        for (name, _), a, b in zip(templates, bounds[:-1].tolist(), bounds[1:].tolist()):
            if b - a >= 2:
                own = numbers[a:b]
                self.templates.append(Template(name, b - a, np.unique(own[:-1] * self.base + own[1:])))
        self.any = np.unique(np.concatenate([t.bigrams for t in self.templates])) if self.templates else np.zeros(0, np.int64)

    def least_shared(self, bigrams: int) -> int:
        return max(1, int(np.ceil(self.least / (2 - self.least) * bigrams - 1e-9)))

    def scan(self, texts: list[str | None]) -> list[list[tuple[str, float, int, int]]]:
        """Per text its passages: licence, Dice, first word, end word."""
        names, at, bounds = words_of(texts)
        place = np.array([self.place.get(name, 0) for name in names], np.int64)
        # Unknown words have numbers of their own, and their bigrams are negative.
        other = np.where(place > 0, place, self.base + np.arange(len(names)))
        found: list[list] = [[] for _ in texts]
        if not len(at) or not self.templates:
            return found
        numbers, every = place[at], other[at]
        wide = self.base + len(names)
        pairs = numbers[:-1] * self.base + numbers[1:]
        codes = np.where((numbers[:-1] > 0) & (numbers[1:] > 0), pairs, -(every[:-1] * wide + every[1:]))
        pairs[(numbers[:-1] == 0) | (numbers[1:] == 0)] = 0
        ends = bounds[1:-1] - 1
        pairs[ends[(ends >= 0) & (ends < len(pairs))]] = 0
        where = np.flatnonzero(pairs)
        if not len(where):
            return found
        near = np.searchsorted(self.any, pairs[where])
        known = self.any[np.minimum(near, len(self.any) - 1)] == pairs[where]
        where = where[known]
        kinds = pairs[where]
        owner = np.searchsorted(bounds, where, side="right") - 1
        per_text = np.bincount(owner, minlength=len(texts))
        smallest = min(self.least_shared(len(t.bigrams)) for t in self.templates)
        for text in np.flatnonzero(per_text >= smallest).tolist():
            mine = slice(*np.searchsorted(owner, [text, text + 1]))
            found[text] = self._passages(where[mine] - bounds[text], kinds[mine], codes[bounds[text] : bounds[text + 1] - 1].tolist())
        return found

    def _passages(self, places: np.ndarray, kinds: np.ndarray, codes: list[int]) -> list[tuple[str, float, int, int]]:
        candidates = []
        for template in self.templates:
            need = self.least_shared(len(template.bigrams))
            hits = places[np.isin(kinds, template.bigrams)]
            if len(hits) >= need:
                found = self._of_template(template, need, hits, codes)
                candidates += [(-dice, -template.words, template.name, a, b) for dice, a, b in found]
        taken: list[tuple[str, float, int, int]] = []
        for dice, _, name, a, b in sorted(candidates):
            if all(b <= x or a >= y for _, _, x, y in taken):
                taken.append((name, -dice, a, b))
        return sorted(taken, key=lambda p: p[2:])

    def _of_template(self, template: Template, need: int, hits: np.ndarray, codes: list[int]) -> list[tuple[float, int, int]]:
        """Passages that do not overlap: Dice, first word, end word."""
        inside, places, found = frozenset(template.bigrams.tolist()), set(hits.tolist()), []
        ends = reaches(codes, hits, int(self.longest(template)))
        parts = [(0, len(hits), len(codes))]
        while parts:
            low, high, end = parts.pop()
            own, last = hits[low:high], -1
            upto = np.searchsorted(own, ends[low:high])
            for i in np.flatnonzero(upto - np.arange(len(own)) >= need).tolist():
                if own[i] < last:
                    continue
                floor = max(last, 0)
                best = self._best(template, inside, places, codes, int(own[i]), min(int(own[upto[i] - 1]), end - 1))
                forwards = False
                while best is not None:
                    # From the best end back to the best start, and on while that gains.
                    if forwards:
                        better = self._best(template, inside, places, codes, best[1], min(int(own[-1]), end - 1))
                    else:
                        better = self._best(template, inside, places, codes, best[2] - 2, max(floor, int(own[0])))
                    if better is None or better[0] <= best[0]:
                        break
                    best, forwards = better, not forwards
                if best is None:
                    continue
                found.append(best)
                if best[1] - own[i] > need:
                    parts.append((low + i, low + int(np.searchsorted(own, best[1])), best[1] - 1))
                last = best[2]
        return found

    def longest(self, template: Template) -> float:
        """The most distinct bigrams of a passage that reaches the least coefficient."""
        return (2 - self.least) / self.least * len(template.bigrams)

    def _best(self, template: Template, inside: frozenset, places: set[int], codes: list[int], start: int, stop: int) -> tuple[float, int, int] | None:
        """The best passage from the hit at `start` on, towards `stop`: ends at a hit, with no more distinct bigrams than the size bound allows."""
        n, best = len(template.bigrams), None
        longest = self.longest(template)
        seen, shared, turn = set(), 0, 1 if stop >= start else -1
        for at in range(start, stop + turn, turn):
            pair = codes[at]
            if pair not in seen:
                seen.add(pair)
                shared += pair in inside
                if len(seen) > longest:
                    break
            if at in places:
                dice = 2 * shared / (len(seen) + n)
                if dice >= self.least and (best is None or dice > best[0]):
                    best = dice, min(start, at), max(start, at) + 2
        return best


def reaches(codes: list[int], starts: np.ndarray, most: int) -> np.ndarray:
    """For ascending starts, where the longest run of codes from there with at most so many distinct ones ends."""
    counts: dict[int, int] = {}
    out, a, b = np.empty(len(starts), np.int64), 0, 0
    for i, start in enumerate(starts.tolist()):
        if start >= b:
            counts, a, b = {}, start, start
        while a < start:
            left = counts[codes[a]] - 1
            if left:
                counts[codes[a]] = left
            else:
                del counts[codes[a]]
            a += 1
        while b < len(codes) and (codes[b] in counts or len(counts) < most):
            counts[codes[b]] = counts.get(codes[b], 0) + 1
            b += 1
        out[i] = b
    return out


def scan_licences(
    docs: DataFrame, templates: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = LEAST_DICE
) -> DataFrame:
    """doc_id, license, dice, first_word, end_word, one row per passage that matches a template."""
    shipped(docs.sparkSession)
    known = templates.where("license IS NOT NULL AND text IS NOT NULL").select("license", "text").distinct()
    size = known.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    if size > MOST_WORDS:
        raise ValueError(f"The templates hold {size} words; at most {MOST_WORDS} go to every task.")
    scanner = Scanner(sorted((row["license"], row["text"]) for row in known.toLocalIterator()), least)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, ids = batch["text"].tolist(), batch["doc_id"].tolist()
            for a, b in steps(texts):
                rows = [(ids[a + i], *passage) for i, own in enumerate(scanner.scan(texts[a:b])) for passage in own]
                yield pd.DataFrame(rows, columns=["doc_id", "license", "dice", "first_word", "end_word"])

    kind = docs.schema[doc_id].dataType
    rows = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text"))
    result = rows.mapInPandas(scan, "doc_id string, license string, dice double, first_word long, end_word long")
    return result.withColumn("doc_id", F.col("doc_id").cast(kind))
