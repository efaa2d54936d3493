"""License scans, decontamination, toxicity and secrets."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lakelens.llm import secret_spans, toxicity
from lakelens.llm.decontamination import Canonical, contaminated
from lakelens.llm.licence_scan import TEMPLATES, Scanner, scan_licences

DOCS = "doc_id long, text string, spans string, item_id string"


def frame(spark, rows):
    return spark.createDataFrame([(*row, "x", "y") for row in rows], DOCS)


def bigrams(text):
    words = re.sub(r"\blicence", "license", " ".join(re.findall(r"[^\W_]+", text.lower()))).split()
    return words, set(zip(words, words[1:]))


def test_licences(spark):
    rng = random.Random(1)
    prose = [rng.choice("the of to in software without a copy house river seven".split()) for _ in range(4000)]
    mit = TEMPLATES[3][1]
    rows = [
        (1, " ".join(prose[:300]) + "\nReleased under the MIT License.\n" + " ".join(prose[300:600])),
        (2, "/* " + mit.replace(" ", "\n * ") + " */ " + " ".join(prose)),
        (3, " ".join(prose)),
        (4, "Licensed under the Apache Licence, version 2.0"),
        (5, "This work is licensed under the GNU General Public License, version 3. Licensed under CC BY-NC 4.0."),
        (6, mit.replace("free of charge", "at no cost").replace("Software", "Program", 2)),
        (7, None),
        (8, ""),
        (9, "License"),
        (None, "Licensed under CC BY-SA 4.0."),
        (4, "Licensed under the Apache Licence, version 2.0"),
    ]
    templates = spark.createDataFrame([*TEMPLATES, (None, "x y"), ("none", None), ("one", "word")], "license string, text string")
    found = scan_licences(frame(spark, rows), templates).collect()
    assert sorted(((r["doc_id"] or 0, r["license"]) for r in found)) == [
        (0, "CC-BY-SA-4.0"), (1, "MIT"), (2, "MIT"), (4, "Apache-2.0"), (4, "Apache-2.0"), (5, "CC-BY-NC-4.0"), (5, "GPL-3.0"), (6, "MIT"),
    ]
    texts = {row[0]: row[1] for row in rows}
    for r in found:
        words, _ = bigrams(texts[r["doc_id"]])
        own = set(zip(words[r["first_word"] : r["end_word"]], words[r["first_word"] + 1 : r["end_word"]]))
        dice = [2 * len(own & bigrams(t)[1]) / (len(own) + len(bigrams(t)[1])) for name, t in TEMPLATES if name == r["license"]]
        assert r["dice"] == pytest.approx(max(dice)) and r["dice"] >= 0.8


def test_licences_with_insertions():
    """Templates with something inserted against all passages of the text."""
    rng = random.Random(3)
    word = iter(f"w{i}x" for i in range(100_000))
    found, every = 0, 0
    for words in (85, 120):
        template = [next(word) for _ in range(words)]
        scanner = Scanner([("L", " ".join(template))])
        own = set(zip(template, template[1:]))
        for share in (0.2, 0.35, 0.4, 0.45, 0.49, 0.55, 0.7):
            at, more = rng.randint(words // 3, 2 * words // 3), [next(word) for _ in range(round(share * words))]
            text = [*(next(word) for _ in range(20)), *template[:2], *(next(word) for _ in range(9)), *template[:at], *more, *template[at:], "end"]
            best = 0
            for a in range(len(text)):
                seen = set()
                for pair in zip(text[a:], text[a + 1 :]):
                    seen.add(pair)
                    best = max(best, 2 * len(seen & own) / (len(seen) + len(own))) if pair in own else best
            passages = scanner.scan([" ".join(text)])[0]
            assert [p[1] for p in passages] == ([pytest.approx(best)] if best >= 0.8 else [])
            every += best >= 0.8
            found += len(passages)
    assert found == every >= 8
    first = [next(word) for _ in range(40)]
    second = [*first[:30], *(next(word) for _ in range(6)), *first[30:]]
    passages = Scanner([("L", " ".join(first))]).scan([" ".join([*second, *first])])[0]
    assert len(passages) == 2 and all(dice >= 0.8 for _, dice, *_ in passages)


def test_contaminated(spark):
    rng = random.Random(2)
    vocabulary = [f"word{i}" for i in range(300)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(8, 40)))) for i in range(20)]
    items += [
        (100, "Yesterday Tom had 12 apples and Mary sold Tom 5 km of red rope for 12 dollars in the garden"),
        (101, None), (102, ""), (103, "two words"), (None, "an item without any id but with enough words"), (104, "1 2 3 4 5 6 7 8"),
    ]
    clean = [(i, " ".join(rng.choice(vocabulary) for _ in range(300))) for i in range(1000, 1060)]
    planted = []
    for i, (item, text) in enumerate(items[:20]):
        words = clean[i][1].split()
        at = rng.randrange(len(words))
        planted.append((2000 + item, " ".join(words[:at] + [text] + words[at:])))
    special = [
        (3001, "Well. Yesterday Bob had 99 apples and Jane sold Bob 7 miles of red rope for 99 euros in the garden. Good."),
        (3002, "Well. Yesterday Bob had 99 apples and Jane sold Rob 7 miles of red rope for 98 euros in the garden. Good."),
        (3003, "Two words!"), (3004, "only two words"), (3005, None), (3006, ""), (3007, "9 8 7 6 5 4 3 2"),
        (None, "so an item without any id but with enough words, yes"), (2000, planted[0][1]),
    ]
    found = contaminated(frame(spark, clean + planted + special), spark.createDataFrame(items, "item_id long, text string")).collect()
    expected = {(2000 + i, i) for i in range(20)} | {(3001, 100), (3003, 103), (None, None)}
    assert {(r["doc_id"], r["item_id"]) for r in found} == expected and len(found) == len(expected)
    assert all(0.8 <= r["coverage"] <= 1 for r in found)


def test_contaminated_with_repeats(spark):
    """Copies of items that hold a window twice, far apart or within the slack."""
    rng = random.Random(4)
    word = iter(f"w{i}" for i in range(10_000))
    items = []
    for i, (windows, first, second) in enumerate([(40, 12, 30), (54, 15, 35), (60, 20, 27), (60, 20, 25), (30, 3, 21)]):
        words = [next(word) for _ in range(windows + 4)]
        words[second : second + 5] = words[first : first + 5]
        items.append((i, " ".join(words)))
    people = "Then Tom has 3 red apples and Anna has 5 red apples while nobody else in the whole town ever had any fruit of that kind at all again"
    items.append((10, people))
    noise = lambda n: " ".join(next(word) for _ in range(n))
    rows = [(100 + i, f"{noise(50)}. {text} {noise(50)}") for i, text in items]
    rows += [(200 + i, f"{noise(9)} {' '.join(text.split()[:38])} {noise(3)} {' '.join(text.split()[38:])}") for i, text in items[1:4]]
    rows += [(300, people.replace("Tom", "Bob").replace("Anna", "Eve").replace("3", "8")), (301, people.replace("3", "5"))]
    rows += [(302, " ".join([items[0][1].split()[0], *items[0][1].split()[12:17]] * 60)), (303, f"{rows[0][1]} {noise(rng.randint(5, 9))} {rows[0][1]}")]
    found = contaminated(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    expected = {(100 + i, i) for i, _ in items} | {(201, 1), (202, 2), (203, 3), (300, 10), (303, 0)}
    assert {(r["doc_id"], r["item_id"]) for r in found} == expected and len(found) == len(expected)
    assert all(r["coverage"] == 1 and r["first_word"] == 50 for r in found if r["doc_id"] < 200)


def test_contaminated_by_bands(spark):
    """A frequent window neither collects its repeats nor hides an occurrence."""
    words = [f"n{i}" for i in range(50)]
    common = words[5:10]
    words[30:35] = words[40:45] = common
    rows = [(1, " ".join(common * 4000)), (2, " ".join([*(common * 4000), *words, *(common * 4000)]))]
    items = spark.createDataFrame([(7, " ".join(words))], "item_id long, text string")
    found = contaminated(frame(spark, rows), items).collect()
    assert [(r["doc_id"], r["coverage"], r["first_word"]) for r in found] == [(2, 1.0, 20_000)]


def test_contaminated_literally(spark):
    """Items of numbers, names or few words are found as they stand, and not by a common run of five words."""
    names = "Alice Bob Carol Dave Erin Frank Grace Heidi Ivan Judy Mallory Niaj Olivia Peggy"
    items = [
        (1, "1 2 3 4 5 6 7 8"), (2, f"the following people were there: {names}"), (3, "seven green bottles"), (4, "forty two"),
        (5, "at the end of the day"), (6, "1 2 3"), (7, "he paid 4 dollars for it"),
    ]
    rows = [
        (10, "So we count: 1 2 3 4 5 6 7 8 and stop"), (11, "So we count 1 2 3 5 4 6 8 7 and stop"),
        (20, f"Well, the following people were there: {names} and left."), (21, "Well, the following people were there: Zoe Yan Xena Walt Vic Una Tom Sam Rob Pam Oz Ned Max Liz."),
        (30, "We saw Seven green bottles, on the wall"), (31, "seven bottles of green glass"), (40, "What is it? Forty two! Yes."), (41, "he was forty two then"),
        (50, "but at the end of the day it rained"), (51, "but at the start of the day it rained"), (70, "and he paid 4 dollars for it all"), (71, "and he paid 5 dollars for it all"),
    ]
    found = contaminated(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    expected = [(10, 1), (10, 6), (11, 6), (20, 2), (30, 3), (40, 4), (50, 5), (70, 7)]
    assert sorted((r["doc_id"], r["item_id"]) for r in found) == expected


def bad_words(n):
    rng = random.Random(9)
    vocabulary = ["".join(rng.choice("aeiournst") for _ in range(rng.randint(2, 9))) for _ in range(1500)]
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(20, 120))]
        toxic = i % 5 == 0
        for _ in range(rng.randint(2, 4) if toxic else 0):
            words[rng.randrange(len(words))] = rng.choice(["glumpf", "zorgling", "blibberhead", "grotfang"]) + rng.choice(["", "s", "ish"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_toxicity(spark):
    rows, labels = bad_words(900)
    docs = frame(spark, [*rows, (5000, None), (5001, ""), (None, "glumpf zorgling " * 50)])
    marks = spark.createDataFrame([*labels, (5002, 1), (3, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, marks)
    scored = {r["doc_id"]: r for r in docs.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("h"), toxicity.score(model, F.col("text")).alias("s")).collect()}
    truth = dict(labels)
    unseen = [i for i in truth if scored[i]["h"]]
    assert 100 < len(unseen) < 260
    right = sum((scored[i]["s"] >= 0.5) == bool(truth[i]) for i in unseen)
    assert right >= 0.97 * len(unseen)
    assert all(0 <= r["s"] <= 1 for r in scored.values()) and scored[5000]["s"] == scored[5001]["s"] < 0.5 < scored[None]["s"]


def test_toxicity_without_examples(spark):
    rows, labels = bad_words(30)
    docs = frame(spark, rows)
    for marks, share in (([], 0.0), ([(i, 0) for i, _ in labels], 0.0), ([(i, 1) for i, _ in labels], 1.0)):
        model = toxicity.train(docs, spark.createDataFrame(marks, "doc_id long, toxic int"))
        assert {r[0] for r in docs.select(toxicity.score(model, F.col("text"))).collect()} == {share}


def test_toxicity_share(spark, monkeypatch):
    """Scores follow the share of toxic labels, also where only some of the labelled documents are read."""
    rng = random.Random(6)
    rows, _ = bad_words(1200)
    rows = [(i, re.sub("glumpf|zorgling|blibberhead|grotfang", "aeio", text) + (" zorgling" if i % 4 == 0 else "")) for i, text in rows]
    # Of the documents with the word, a third are toxic: 8 % of all.
    labels = [(i, int(i % 4 == 0 and rng.random() < 1 / 3)) for i, _ in rows]
    docs, marks = frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")

    def mean_score():
        model = toxicity.train(docs, marks)
        return docs.agg(F.avg(toxicity.score(model, F.col("text")))).first()[0], model.share

    whole, share = mean_score()
    monkeypatch.setattr(toxicity, "MOST_TOXIC", 60)
    monkeypatch.setattr(toxicity, "MOST_ORDINARY", 120)
    some, same = mean_score()
    true = sum(t for _, t in labels) / len(labels)
    assert all(abs(found - true) < 0.04 for found in (whole, share, some, same))


def base(text):
    kinds = ["assign", "access", "hex"]
    spans = [
        (m.start(), 0, m.end())
        for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A)
        if len(m[2]) >= 6
    ]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if m.end() - m.start() >= 24]
    return [(a, kinds[k], b) for a, k, b in sorted(spans)]


def test_secrets(spark):
    rng = random.Random(8)
    pieces = ["password", "PassWd=", "token : ", "api_key", "apikey='", "secret", "=", ":", " ", "\"", "abc", "deadbeef" * 3, "AKIA", "ABCD1234" * 2, "é中", "hunter22", "ſecret=abcdefgh", "\n"]
    rows = [(i, "".join(rng.choice(pieces) for _ in range(rng.randint(0, 12)))) for i in range(400)]
    words = " ".join("".join(rng.choice("aeiournst") for _ in range(rng.randint(3, 22))) for _ in range(30))
    rows += [(500 + i, f"{words} key {'%040x' % rng.getrandbits(160)} end") for i in range(60)]
    syllables = ["".join(rng.choice("aeiournst") for _ in range(rng.randint(8, 22))) for _ in range(5000)]
    rows += [(600 + i, " ".join(rng.sample(syllables, 100)) + " my_variable_name_2 version-2024-10") for i in range(100)]
    key = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(39)) + "7"
    rows += [(900, None), (901, ""), (902, f"{words} {key} {words}"), (None, "token=abcdef"), (903, "x " * 100_000 + "token=abcdef")]
    docs = frame(spark, rows)
    found = secret_spans.find_secrets(docs, secret_spans.train(docs)).collect()
    got = {r["doc_id"]: [(s["start"], s["kind"], s["end"]) for s in r["spans"]] for r in found}
    assert len(found) == len(rows)
    for doc_id, text in rows:
        assert [s for s in got[doc_id] if s[1] != "random"] == base(text or ""), text
    assert [(len(words) + 1, "random", len(words) + 41)] == got[902]
    assert not [s for i in range(500, 560) for s in got[i] if s[1] == "random"]
    assert not [s for i in range(600, 700) for s in got[i]]
    assert secret_spans.digest([]) == hashlib.sha256(b"").hexdigest()


def test_secrets_ordinary_runs_of_all_documents():
    """Runs beside a base span train the ordinary model; those that touch one do not."""
    def ordinary(text):
        counts = pd.concat(secret_spans._counted(iter([pd.DataFrame({"text": [text]})])))
        return int(counts[counts["label"] == 0]["n"].sum())

    name = "my_variable_name"
    assert ordinary(f"{name} = 1") == ordinary(f"{name} = 1\ntoken=abcdef12") == len(name) - 1
    assert ordinary(f"x token=abcdef12 {name} password: hunter22 {name}") == 2 * (len(name) - 1)


def test_licences_with_repeats():
    """Repeated words outside the templates and within them, any length, against all passages."""
    rng = random.Random(5)
    template = [f"t{i}" for i in range(40)]
    for more in (["foo"] * 25, ["xx", "yy"] * 30, ["xx"] * 400):
        text = template[:20] + more + template[20:]
        assert [p[1] for p in Scanner([("L", " ".join(template))]).scan([" ".join(text)])[0]] == [pytest.approx(_best_passage(template, text))]
    found = 0
    for _ in range(300):
        words = [f"v{i}" for i in range(rng.choice([3, 6, 20]))]
        templates = [[rng.choice(words + [f"u{i}" for i in range(30)]) for _ in range(rng.randint(4, 30))] for _ in range(2)]
        text = []
        while len(text) < rng.randint(5, 90):
            kind, template = rng.random(), rng.choice(templates)
            at = rng.randrange(len(template))
            text += template[at : at + rng.randint(1, 20)] if kind < 0.5 else [rng.choice(["zz", "yy", "foo"])] * rng.randint(1, 8) if kind < 0.8 else [rng.choice(words)]
        for name, template in zip("AB", templates):
            passages = Scanner([(name, " ".join(template))]).scan([" ".join(text)])[0]
            best = _best_passage(template, text)
            assert (max((p[1] for p in passages), default=0) >= 0.8) == (best >= 0.8 - 1e-12)
            found += len(passages)
        both = Scanner([(n, " ".join(t)) for n, t in zip("AB", templates)]).scan([" ".join(text)])[0]
        assert all(a[3] <= b[2] for a, b in zip(both, both[1:]))
    assert found > 100


def _best_passage(template, text):
    own, best = set(zip(template, template[1:])), 0.0
    for a in range(len(text)):
        seen = set()
        for pair in zip(text[a:], text[a + 1 :]):
            seen.add(pair)
            best = max(best, 2 * len(seen & own) / (len(seen) + len(own))) if pair in own else best
    return best


SHORT_ITEMS = [
    ("What is 12 times 7?", "What is 13 times 8?"),
    ("Tom has 3 red apples", "Bob has 5 red apples"),
    ("Solve 4 plus 9 now", "Solve 5 plus 2 now"),
    ("Anna buys 12 pens for 3 dollars each", "Bob buys 7 pens for 9 dollars each"),
    ("Maria sold 14 cups of tea on Monday", "Peter sold 20 cups of tea on Friday"),
]


def test_short_items_with_other_numbers(spark):
    docs = []
    for i, (item, other) in enumerate(SHORT_ITEMS):
        docs += [(10 * i, f"Some words before it. {other.rstrip('?')}. And after that more."), (10 * i + 1, other), (10 * i + 2, f"aa bb {item} cc dd")]
    docs += [(900, "He has 3 red cars and 5 apples. What is this? Solve it now. On Monday we sold 3 cups."), (901, "Bob has red apples"), (902, "Bob has 5 green pears.")]
    items = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(SHORT_ITEMS)], "item_id long, text string")
    found = contaminated(frame(spark, docs), items).collect()
    assert sorted((r["item_id"], r["doc_id"]) for r in found) == [(i, 10 * i + j) for i in range(5) for j in range(3)]


def test_words_of_a_column_as_one_by_one():
    """Numbers, units, names and sentence ends; the same words in any company."""
    text = "Anna paid 3 dollars (about 2.50€) to Bob Smith. Then 5km away, ÉMILE met Él and A. 'Quoted.' end"
    form = Canonical([text, "", "Anna"])
    kinds = "".join("w#un"[k] for k in form.kind.tolist())
    assert [form.cores[i] for i in form.word.tolist()][:6] == ["anna", "paid", "3", "dollars", "about", "2.50€"]
    assert kinds[:9] == "ww#uwwwnn" and form.maybe.tolist()[0] and form.bounds.tolist()[-2:] == [len(kinds) - 1, len(kinds)]
    assert kinds[9:11] == "w#" and not form.maybe.tolist()[11]


def test_one_label_on_many_rows(spark):
    """A labelled id on many rows gives one text to learn from."""
    rows = [(1, f"text number {i} of one id") for i in range(3000)] + [(i, f"other text {i}") for i in range(2, 60)]
    labels = spark.createDataFrame([(i, int(i % 3 == 1)) for i in range(1, 60)], "doc_id long, toxic int")
    sample, labelled = toxicity._sample(frame(spark, rows), labels, "doc_id", "text", "toxic")
    assert sample.count() == sum(labelled.values()) == sum(1 for i in range(1, 60) if zlib.crc32(str(i).encode()) % 5)
