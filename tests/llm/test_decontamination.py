"""Benchmark decontamination against every window of every text, and its defined cases."""

import random
import re

import numpy as np
import pytest

from tests.llm.test_corpus_operators import frame, prose
from tidemark.llm import decontamination
from tidemark.llm.decontamination import SPAN


def terms(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def by_hand(text, items):
    words, hit, found = terms(text), set(), set()
    for item_id, item in items:
        w = terms(item)
        n = min(len(w), SPAN)
        windows = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
        for i in range(len(words) - n + 1):
            if n and tuple(words[i : i + n]) in windows:
                hit |= set(range(i, i + n))
                found.add(item_id)
    return len(words), len(hit), sorted(str(x) for x in found if x is not None)


def benchmark(spark, items):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in items], "item_id long, text string, doc_id string, need string")


ITEMS = [
    (1, "one two three four five six seven eight nine ten eleven twelve"),
    (2, "Ñandú, ça va? l'été 2024 où naïve"),
    (3, "solo"),
    (3, "alpha beta gamma delta epsilon zeta eta theta iota kappa"),
    (4, None),
    (5, " . "),
    (None, "red red red red red red red red red red red"),
    (6, "one two three four five six seven eight nine ten eleven twelve"),
    (6, "one two three four five six seven eight nine ten eleven twelve"),
    (10, "a b a b a b a b a b a b a b a b a b a b a b a"),
]


def documents():
    rng = random.Random(11)
    rows = [
        (1, "ONE; two-three four\nfive six seven eight nine ten!"),  # exactly one window
        (2, "one two three four five six seven eight nine"),  # a word short of one
        (3, "x one two three four five six seven eight nine ten eleven twelve y one two three four five six seven eight nine ten"),
        (4, "Solo, SOLO and ñandú ça VA l été 2024 où naïve ñandú ça va"),
        (5, "red " * 40),
        (6, None),
        (7, ""),
        (8, "\t..\n"),
        (None, "two three four five six seven eight nine ten eleven"),
        (9, "a b " * 30),
        (9, "a b " * 30),
        (9, "solo"),
        (10, prose(rng, 30000) + " alpha beta gamma delta epsilon zeta eta theta iota kappa"),
        (11, "x" * 100000 + " solo " + "y" * 5000),
    ]
    pool = "one two three four five six seven eight nine ten eleven twelve".split()
    for i in range(60):  # pieces of the items at every shift
        a = rng.randrange(12)
        rows.append((100 + i, " ".join(rng.choice(pool) for _ in range(4)) + " " + " ".join(pool[a : a + rng.randrange(13)]) + " " + prose(rng, 5)))
    return rows


def test_equals_every_window(spark):
    rows = documents()
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in decontamination.contamination(frame(spark, rows), benchmark(spark, ITEMS)).collect()), key=str)
    want = sorted(((i, *by_hand(t, ITEMS)) for i, t in rows), key=str)
    assert got == want


def test_spans_are_the_hit_words(spark):
    rows = documents()
    for r in decontamination.contamination(frame(spark, rows[:5]), benchmark(spark, ITEMS)).collect():
        places = {p for s in r.spans for p in range(s.start, s.stop)}
        assert len(places) == r.n_hit and r.spans == sorted(r.spans)


def test_random_texts_of_few_words(spark):
    rng = random.Random(7)
    items = [(i, prose(rng, rng.choice([3, 9, 10, 11, 25]), ["p", "q", "r"])) for i in range(12)]
    rows = [(i, prose(rng, rng.randrange(0, 400), ["p", "q", "r"])) for i in range(40)]
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in decontamination.contamination(frame(spark, rows), benchmark(spark, items)).collect()}
    assert got == {i: by_hand(t, items) for i, t in rows}


def test_a_full_bitmap_changes_no_result(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "LEAST_BITS", 64)
    monkeypatch.setattr(decontamination, "MOST_BITS", 64)
    test_equals_every_window(spark)


def test_winnowing_selects_in_every_window():
    rng = np.random.default_rng(1)
    for words in (40, 3):
        grams = rng.integers(0, words, 500).astype(np.uint64)
        ends = np.repeat([100, 104, 113, 480, 504], [100, 4, 9, 367, 24])[:500]
        chosen = set(decontamination.winnowed(grams, ends).tolist())
        width = decontamination.SPAN - decontamination.GRAM + 1
        allowed = set()
        for i in range(500):
            if i + decontamination.SPAN <= ends[i]:
                window = grams[i : i + width]
                last = i + max(j for j in range(len(window)) if window[j] == window.min())
                allowed.add(last)
        assert chosen == allowed


def test_only_grams_in_the_bitmap_are_written(spark):
    rows = [(i, prose(random.Random(i), 200, [f"w{j}" for j in range(500)])) for i in range(30)]
    index = decontamination.item_prints(benchmark(spark, ITEMS[:1]))
    found = decontamination.document_prints(frame(spark, rows), index)
    assert found.filter("print IS NOT NULL").count() <= 2 and found.filter("n_words IS NOT NULL").count() == 30


def test_contaminated_documents_leave(spark):
    rows = documents()[:9] + [(20, "clean text")]
    docs = frame(spark, rows)
    out = decontamination.without_contaminated(docs, benchmark(spark, ITEMS))
    assert out.columns == docs.columns
    assert sorted(out.collect(), key=str) == sorted((r for r in docs.collect() if not by_hand(r.text, ITEMS)[1]), key=str)


@pytest.mark.parametrize("items, rows", [([], [(1, "one two")]), (ITEMS, []), ([], [])])
def test_empty_tables(spark, items, rows):
    got = decontamination.contamination(frame(spark, rows), benchmark(spark, items))
    assert [(r.doc_id, r.n_words, r.n_hit, r.spans, r["items"]) for r in got.collect()] == [(i, 2, 0, [], []) for i, _ in rows]
