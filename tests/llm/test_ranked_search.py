"""Ranked lexical search against every document scored, and its defined cases."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from tests.llm.test_corpus_operators import frame, prose
from tests.llm.test_decontamination import benchmark, terms
from tidemark.llm import ranked_search
from tidemark.llm.ranked_search import Block, pair_lists, paired, starts


def by_hand(rows, items, k=10):
    docs = [(i, Counter(terms(t))) for i, t in rows]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    n_docs, n_terms = len(docs), sum(n for _, _, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item_id, text in set(items):
        scored = []
        for i, c, n in docs:
            m = 100 - 90 + (90 * n * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if c[t])
            if score > 0:
                scored.append((-score, i is None, i))
        out += [(item_id, at, i, -score) for at, (score, _, i) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return Counter(out)


def corpus(n=400):
    rng = random.Random(5)
    words = [f"w{int(rng.paretovariate(0.6))}" for _ in range(4000)]
    rows = [(i * 3 % n, prose(rng, rng.randrange(1, 80), words)) for i in range(n)]
    rows += [(9000 + i, rows[7][1]) for i in range(30)]  # copies: ties
    rows += [(1, rows[3][1]), (1, rows[3][1]), (None, rows[3][1]), (2, None), (3, ""), (4, " . "), (5, prose(rng, 20000, words)), (6, "W1, w2; Ñandú")]
    items = [(i, prose(rng, rng.randrange(1, 15), words)) for i in range(25)] + [(3, "w1 w2 w3"), (4, rows[7][1]), (4, rows[7][1]), (50, None), (51, ""), (52, "nowhere"), (53, "ñandú NOWHERE w1"), (None, "w2 w9")]
    return rows, items


def found(spark, rows, items, k=10):
    return Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in ranked_search.ranked(frame(spark, rows), benchmark(spark, items), k).collect())


def test_equals_every_document_scored(spark):
    rows, items = corpus()
    assert found(spark, rows, items) == by_hand(rows, items)


def test_small_blocks_and_batches_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "BLOCK", 16)
    monkeypatch.setattr(ranked_search, "SEED_STEP", 3)
    monkeypatch.setattr(ranked_search, "BATCH_TERMS", 60)
    monkeypatch.setattr("tidemark.llm.tokens.CHUNK_BYTES", 2000)
    rows, items = corpus(200)
    rows = rows[:200] + rows[-8:]
    assert found(spark, rows, items, 3) == by_hand(rows, items, 3)


def block_of(rng, n_docs, n_terms):
    lists, gains = [], []
    for t in range(n_terms):
        docs = np.sort(rng.choice(n_docs, rng.integers(1, n_docs // 2 + 1), replace=False))
        lists.append(docs)
        gains.append(rng.integers(1, 100 * (n_terms - t), len(docs)))
    size = np.array([len(x) for x in lists])
    return np.arange(n_terms), size, np.concatenate(lists), np.concatenate(gains).astype(np.int64)


@pytest.mark.parametrize("seed", range(8))
def test_a_block_keeps_its_best_under_any_floor(seed):
    rng = np.random.default_rng(seed)
    term, size, doc, gain = block_of(rng, 300, 9)
    pairs = np.unique(paired(np.arange(9), size), axis=0)
    lists = list(pair_lists(term, starts(size), doc, gain, pairs, 300))
    block = Block(np.arange(300), term, size, doc, gain, np.array([x[0] for x in lists]), np.array([len(x[1]) for x in lists]), np.concatenate([x[1] for x in lists]), np.concatenate([x[2] for x in lists]))
    whole = np.zeros(300, np.int64)
    np.add.at(whole, doc, gain)
    a, b = ranked_search.places(pairs[:, 0], term), ranked_search.places(pairs[:, 1], term)
    at = ranked_search.places(np.arange(len(pairs)), block.pair)
    best = np.lexsort((np.arange(300), -whole))[:5]
    for floor in (0, int(whole[best[4]]), int(whole[best[4]]) - 1, int(whole[best[0]]), int(whole[best[0]]) + 1):
        for joint in (True, False):
            docs, score = block.search(a, b, at, floor, 5, joint)
            want = [d for d in best if whole[d] >= max(floor, 1)]
            assert docs.tolist()[: len(want)] == want and score.tolist()[: len(want)] == whole[want].tolist()


def test_pair_lists_hold_both_terms_and_their_sum():
    rng = np.random.default_rng(0)
    term, size, doc, gain = block_of(rng, 50, 6)
    at = starts(size)
    held = [dict(zip(doc[at[t] : at[t + 1]].tolist(), gain[at[t] : at[t + 1]].tolist())) for t in range(6)]
    pairs = np.array([[0, 1], [0, 5], [2, 3], [4, 9]])
    got = {p: dict(zip(d.tolist(), g.tolist())) for p, d, g in pair_lists(term, at, doc, gain, pairs, 50)}
    assert got == {p: {d: held[a][d] + held[b][d] for d in held[a] if d in held[b]} for p, (a, b) in enumerate(pairs[:3].tolist())}


def test_joint_maxima_read_fewer_postings_than_single_ones():
    """Two frequent terms whose large contributions never meet: only the joint bound leaves their lists unread."""
    n = 1000
    low, high = np.full(n, 1), np.full(n, 1)
    low[:100], high[500:600] = 50, 50
    rare, size = np.array([3, 700]), np.array([n, n, 2])
    doc, gain = np.concatenate([np.arange(n), np.arange(n), rare]), np.concatenate([low, high, [60, 70]]).astype(np.int64)
    pairs = np.array([[0, 1], [2, -1]])
    lists = list(pair_lists(np.arange(3), starts(size), doc, gain, pairs, n))
    assert lists[0][2].max() == 51
    read = {}
    for joint in (True, False):
        block = Block(np.arange(n), np.arange(3), size, doc, gain, np.array([0]), np.array([n]), lists[0][1], lists[0][2])
        docs, score = block.search(np.array([0, 2]), np.array([1, -1]), np.array([0, -1]), 72, 2, joint)
        assert docs.tolist() == [3, 700] and score.tolist() == [111, 72]
        read[joint] = block.read
    assert read[True] <= 4 < 2 * n <= read[False]


@pytest.mark.parametrize("items, rows", [([], [(1, "one two")]), ([(1, "one"), (2, None)], []), ([(1, None)], [(1, None)]), ([(1, "two")], [(1, "one")])])
def test_nothing_to_find(spark, items, rows):
    out = ranked_search.ranked(frame(spark, rows), benchmark(spark, items))
    assert out.columns == ["item_id", "rank", "doc_id", "score"] and out.collect() == []
