"""The ten operators on small fixtures: brute force, round trips and the defined cases."""

import hashlib
import math
import random
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from tidemark.llm import byte_bpe, chat, exact_topk, line_dedup, mixing, ngram_join, quality_classifier, quality_rules, sharding, suffix_tree
from tidemark.llm.common import shared_dir
from tidemark.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, score string, n_lines string, n_removed string, shard string, n_tokens string, target string"
EXTRA = ("a", "b", "c", "d", "e", "f", "g")


def frame(spark, rows):
    """Documents of (doc_id, text[, source]) with further columns whose names the operators use too."""
    return spark.createDataFrame([(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), *EXTRA) for r in rows], SCHEMA)


def prose(rng, n, words="alpha beta gamma delta epsilon zeta eta theta iota kappa la mu nu xi pi rho sigma tau".split()):
    return " ".join(rng.choice(words) for _ in range(n))


def near_copies():
    rng = random.Random(3)
    rows, base = [], [f"w{i} {prose(rng, 60)}" for i in range(6)]
    for i, text in enumerate(base):
        words = text.split()
        for j in range(8):
            copy = list(words)
            for _ in range(j % 3):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(9)}"
            rows.append((len(rows), " ".join(copy)))
        rows.append((len(rows), " ".join(words[:20] + [f"q{i}{k}" for k in range(40)])))
    rows += [(100, None), (101, ""), (102, " \n "), (103, "one two"), (104, "One  TWO"), (105, "one two three"), (106, "solo"), (106, "solo"), (None, "one two"), (107, "y " * 3000)]
    return rows


def words_of(text):
    return bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()).split()


def shingles(text, k=5):
    w = words_of(text)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def linked(rows):
    """Smallest id of each row's component, by all pairs."""
    sets, label = [shingles(t) for _, t in rows], list(range(len(rows)))
    find = lambda i: i if label[i] == i else find(label[i])
    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 75 * len(sets[i] | sets[j]):
                label[find(i)] = find(j)
    out = {}
    for i, (doc_id, _) in enumerate(rows):
        out.setdefault(find(i), []).append(doc_id)
    return [min((x for x in out[find(i)] if x is not None), default=None) for i in range(len(rows))]


@pytest.mark.parametrize("options", [{}, {"frequent": 1000, "cell": 3}, {"frequent": 0}])
def test_ngram_join_equals_all_pairs(spark, options):
    rows = near_copies()
    got = ngram_join.jaccard_components(frame(spark, rows).repartition(3), **options).collect()
    want = Counter((r[0], len(shingles(r[1])), c) for r, c in zip(rows, linked(rows)))
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want


def test_ngram_join_tells_sets_of_one_id_apart(spark, monkeypatch):
    whole = ngram_join.set_id
    monkeypatch.setattr(ngram_join, "set_id", lambda s: whole(s) % 11)
    rows = near_copies()
    got = ngram_join.link_classes(frame(spark, rows))[0]
    assert got.filter("n > 0").select("sid").distinct().count() == len({frozenset(shingles(t)) for _, t in rows} - {frozenset()})


def test_ngram_join_of_graded_copies_equals_all_pairs(spark):
    """Sets of many sizes around one another, so that lists hold several size ranges and lists of two."""
    rng, rows = random.Random(8), []
    for base in range(4):
        words = [f"b{base}w{i}" for i in range(90)]
        for i in range(40):
            a, n = rng.randrange(0, 25), rng.randrange(45, 90)
            rows.append((len(rows), " ".join(words[a : a + n] + [f"own{len(rows)}x{j}" for j in range(rng.randrange(0, 14))])))
    got = {r.doc_id: r.component_id for r in ngram_join.jaccard_components(frame(spark, rows)).collect()}
    assert got == {r[0]: c for r, c in zip(rows, linked(rows))}


def test_ngram_join_leaves_no_table_of_a_turn(spark):
    folder = Path(shared_dir(spark).removeprefix("file://")) / "tidemark"
    names = lambda: Counter(p.name.rsplit("-", 1)[0] for p in folder.iterdir())
    folder.mkdir(exist_ok=True)
    before = names()
    ngram_join.jaccard_components(frame(spark, near_copies())).count()
    assert set(names() - before) == {"set-facts", "classes", "class-components"}


def test_shared_folder_is_needed_on_a_cluster():
    class Session:
        conf = {"spark.master": "yarn"}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_ngram_join_keeps_one_of_each(spark):
    rows = near_copies()
    kept = ngram_join.one_of_each(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for c in linked(rows) if c is not None})


def test_components_of_a_long_chain(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}


def test_sharding_moves_rows_only_into_the_new_shard(spark):
    rows = [(i, "x" * (i % 9)) for i in range(4000)] + [(None, None), (5, "xxxxx")]
    topology = sharding.regular_topology(40)
    got = sharding.shard_documents(frame(spark, rows), topology, sharding.with_new_region(topology)).collect()
    assert len(got) == len(rows)
    moved = [r for r in got if r.shard != r.grown_shard]
    assert {r.grown_shard for r in moved} == {40} and 0.4 < len(moved) / len(rows) * 41 < 1.8
    for shard in range(40):
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots))) and 40 < len(slots) < 180
    assert all(r.size == len(("x" * (r.doc_id % 9)).encode()) + 16 and r.text_crc32 == zlib.crc32(b"x" * (r.doc_id % 9)) for r in got if r.doc_id is not None)
    assert [(r.size, r.text_crc32) for r in got if r.doc_id is None] == [(16, 0)]


def test_sharding_equals_the_draws_by_hand(spark):
    topology = [sharding.Shard(0, "a", "a0", 1.0), sharding.Shard(1, "a", "a0", 3.0), sharding.Shard(2, "a", "a1", 0.5), sharding.Shard(3, "b", "b0", 2.0), sharding.Shard(4, "b", "b0", 0.0), sharding.Shard(5, "b", "b1", 1.5)]
    rows = [(i, prose(random.Random(i), i % 7)) for i in range(300)] + [(None, None), (None, "x"), (7, "twice"), (7, "twice"), (-3, "\u00e4")]

    def place(doc_id, shards):
        live = [s for s in shards if s.weight > 0]
        for level, name in (("region", lambda s: f"region {s.region}"), ("rack", lambda s: f"rack {s.rack}"), ("shard", lambda s: f"shard {s.shard}")):
            weight = Counter()
            for s in live:
                weight[name(s)] += s.weight
            u = {n: (int(hashlib.md5(f"{n}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52 for n in weight}
            best = max(weight, key=lambda n: (math.log(u[n]) / weight[n], n))
            live = [s for s in live if name(s) == best]
        return live[0].shard

    grown = sharding.with_new_region(topology)
    got = sharding.shard_documents(frame(spark, rows), topology, grown).collect()
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()), place(i, topology), place(i, grown)) for i, t in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32, r.shard, r.grown_shard) for r in got) == want
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(of) == list(range(len(of))) for of in slots.values())


def test_sharding_of_many_rows_of_one_id(spark):
    topology = sharding.regular_topology(8)
    got = sharding.shard_documents(frame(spark, [(None, "same")] * 500 + [(1, "one")] * 300), topology, topology).collect()
    assert len({r.shard for r in got if r.doc_id is None}) == 1 and len({r.shard for r in got if r.doc_id == 1}) == 1
    assert len({(r.shard, r.slot) for r in got}) == 800


def test_sharding_confines_movement_to_the_changed_subtree(spark):
    docs = frame(spark, [(i, "") for i in range(3000)])
    before = sharding.regular_topology(16)
    after = [s._replace(weight=3.0) if s.shard == 5 else s for s in before]
    got = sharding.place(sharding.place(docs.select("doc_id"), before, out="old"), after, out="new").collect()
    region = lambda shard: shard // 8
    assert all(region(r.old) == region(r.new) or region(r.new) == 0 for r in got)
    rack = lambda shard: shard // 4
    assert all(rack(r.old) == rack(r.new) or rack(r.new) == 1 for r in got if region(r.old) == region(r.new))
    assert all(r.old == r.new or r.new == 5 for r in got if rack(r.old) == rack(r.new))


def test_chat_keeps_maximal_conversations(spark):
    rows = []
    log = lambda conv, *turns: rows.extend((conv, i, "user" if i % 2 == 0 else "assistant", t, "z") for i, t in enumerate(turns))
    log(1, "hi")
    log(2, "hi", "hello")
    log(3, "hi", "hello", "bye")
    log(4, "hi", "hello", "bye")
    log(5, "hi", "other")
    log(6, None, "x")
    log(None, "lone")
    rows += [(7, None, None, None, "z"), (7, None, None, None, "z")]
    got = {r.conv_id: r for r in chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, h1 string")).collect()}
    assert {k: (v.n_turns, v.n_equal, v.n_prefixes) for k, v in got.items()} == {3: (3, 2, 2), 5: (2, 1, 1), 6: (2, 1, 0), None: (1, 1, 0), 7: (2, 1, 0)}
    assert got[5].chat == "<|user|>\nhi\n<|assistant|>\nother\n<|end|>"
    assert got[7].chat == "<||>\n\n" * 2 + "<|end|>"
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_conversations(empty).collect() == []


def clean_lines(rows, min_lines=3, min_words=50):
    """What may go: for every document the lines that an equal line precedes somewhere in the corpus."""
    seen, out = set(), {}
    for doc_id, text in sorted((r for r in rows if r[1] is not None), key=lambda r: r[0]):
        out[doc_id] = set()
        for i, line in enumerate(text.split("\n")):
            if line.strip() in seen:
                out[doc_id].add(i)
            if line.strip():
                seen.add(line.strip())
    return out


@pytest.mark.parametrize("rule", [line_dedup.repeated_lines, line_dedup.winnowed_repeats])
def test_line_dedup_deletes_later_runs_and_nothing_else(spark, rule):
    rng = random.Random(5)
    line = lambda: prose(rng, 8) + f" {rng.random()}"
    run, passage = [line() for _ in range(5)], "p " + prose(rng, 55)
    rows = [
        (1, "\n".join([line(), *run, line(), "menu"])),
        (2, "\n".join([line(), line(), "", *run[:2], " ", *run[2:], line()])),
        (3, "\n".join([line(), passage, line()])),
        (4, "\n".join([passage, line(), "menu"])),
        (5, "\n".join(run)),
        (6, "\n".join([line(), *run[:2], line()])),
        (7, None),
        (8, ""),
        (9, " \n\n"),
        (10, "x y z\n" * 200 + line()),
    ]
    docs = frame(spark, rows)
    out = line_dedup.dedup_lines(docs, rule=rule)
    assert set(out.columns) == set(docs.columns)
    got = {r.doc_id: r for r in out.collect()}
    removed = {k: r.n_removed for k, r in got.items()}
    assert removed == {1: 0, 2: 5, 3: 0, 4: 1, 5: 5, 6: 0, 7: 0, 8: 0, 9: 0, 10: 199}
    assert got[5].text == "" and got[7].text is None and passage not in got[4].text and "menu" in got[4].text
    assert sorted(r.doc_id for r in line_dedup.without_repeats(docs, rule=rule).collect()) == [1, 2, 3, 4, 6, 7, 8, 9, 10]
    may_go = clean_lines(rows)
    for doc_id, text in rows:
        if text is not None:
            kept = got[doc_id].text.split("\n") if got[doc_id].text else []
            lines = text.split("\n")
            must_stay = [x for i, x in enumerate(lines) if x.strip() and i not in may_go[doc_id]]
            assert [x for x in kept if x.strip() and x in must_stay] == must_stay
    survivors = {x.strip() for r in got.values() for x in (r.text or "").split("\n")}
    assert {x.strip() for _, t in rows for x in (t or "").split("\n")} <= survivors | {""}


@pytest.mark.parametrize("rule", [line_dedup.repeated_lines, line_dedup.winnowed_repeats])
def test_line_dedup_finds_every_run_of_the_least_size(spark, rule):
    rng = random.Random(9)
    line = lambda n: prose(rng, n) + f" {rng.random()}"
    shapes = [(5, 5, 5), (29, 29), (10, 48), (48, 10), (60,), (60, 5), (5, 60), (5, 60, 5), (24, 24), (5, 5)]
    rows, want = [], {}
    for i in range(20 * len(shapes)):
        shape = shapes[i % len(shapes)]
        run = [line(n) for n in shape]
        words, longest = sum(len(x.split()) for x in run), max(run, key=lambda x: len(x.split()))
        # a long line comes alone before, so that the first place of its gram isn't that of the run
        alone = len(longest.split()) >= 50
        rows += [(10 * i, "\n".join([line(6), longest, line(6)] if alone else [line(6)]))]
        rows += [(10 * i + k, "\n".join([line(6), line(6), *run, line(6), line(6)])) for k in (1, 2)]
        want |= {10 * i: 0, 10 * i + 1: int(alone), 10 * i + 2: len(run) if len(run) > 2 or words >= 50 else 0}
    assert {r.doc_id: r.n_removed for r in line_dedup.dedup_lines(frame(spark, rows), rule=rule).collect()} == want


@pytest.mark.parametrize("min_lines", [2, 3, 4])
def test_winnowing_deletes_what_all_grams_delete(spark, min_lines):
    rng = random.Random(17 + min_lines)
    # few lines, so that runs repeat, overlap and lie within one another; some hold 12 words or more alone or in twos
    pool = [f"l{i} " + prose(rng, rng.choice([1, 4, 7, 11, 14])) for i in range(12)]
    rows = [(i, "\n".join(rng.choice([*pool, f"own {i} {k}", ""]) for k in range(rng.randrange(14)))) for i in range(150)]
    got, want = ({(r.doc_id, r.text, r.n_removed) for r in line_dedup.dedup_lines(frame(spark, rows), rule=rule, min_lines=min_lines, min_words=12).collect()} for rule in (line_dedup.winnowed_repeats, line_dedup.repeated_lines))
    assert got == want and sum(r[2] for r in got) > 100


def test_winnowing_is_linear_in_a_text_of_one_line(spark):
    docs = frame(spark, [(1, "x y z\n" * 20_000 + "end"), (2, "a\nb\nc"), (3, "a\nb\nc")])
    prints = line_dedup.fingerprints(line_dedup.line_rows(docs))
    assert prints.count() <= 20_000 + 10
    # the first line stays: it is in the first place of the run only
    assert {r.doc_id: r.n_removed for r in line_dedup.dedup_lines(docs, rule=line_dedup.winnowed_repeats).collect()} == {1: 19_999, 2: 0, 3: 3}


@pytest.mark.parametrize("rule", [line_dedup.repeated_lines, line_dedup.winnowed_repeats])
def test_line_dedup_repeated_rows_get_one_result(spark, rule):
    text = "\n".join(f"line {i} of it" for i in range(4))
    got = line_dedup.dedup_lines(frame(spark, [(1, text), (2, text), (2, text), (None, text)]), rule=rule).collect()
    assert Counter((r.doc_id, r.n_removed) for r in got) == {(1, 0): 1, (2, 4): 2, (None, 4): 1}


def test_quality_classifier_learns_and_scores_all(spark):
    rng = random.Random(1)
    good = lambda: prose(rng, rng.randrange(5, 400)).capitalize() + "."
    bad = lambda: " ".join(w.upper() + "!!" for w in prose(rng, 90).split()) if rng.random() < 0.5 else " | ".join(prose(rng, 80).split())
    rows = [(i, good() if i % 4 else bad()) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(400)] + [(None, 1), (3, None)], "doc_id long, quality int")
    docs = frame(spark, rows + [(900, None), (901, ""), (None, "a b"), (902, "word " * 20000), (903, "!")])
    got = quality_classifier.score_documents(docs, labels).collect()
    assert len(got) == 405 and all(0 <= r.score <= 1 and not math.isnan(r.score) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    tested = [r.predicted == int(r.doc_id % 4 != 0) for r in got if r.held_out and r.doc_id is not None and r.doc_id < 400]
    assert len(tested) > 40 and sum(tested) / len(tested) > 0.95
    kept = quality_classifier.accepted(docs, labels)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in got if r.predicted)


def test_quality_classifier_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(4)
    p = {"W": rng.normal(size=(6, 4)), "b": rng.normal(size=4), "V": rng.normal(size=(4, 3)), "U": rng.normal(size=(4, 3)), "w": rng.normal(size=3), "c": rng.normal(size=4), "d": rng.normal(size=1)}
    inputs, first, y = rng.normal(size=(9, 6)), np.array([0, 1, 5, 9]), np.array([1.0, 0.0, 1.0])

    def loss():
        total = 0.0
        for a, b, label in zip(first[:-1], first[1:], y):
            # the forward pass of one bag, passage by passage
            h = [np.tanh(x @ p["W"] + p["b"]) for x in inputs[a:b]]
            raw = [float(p["w"] @ (np.tanh(v @ p["V"]) / (1 + np.exp(-(v @ p["U"]))))) for v in h]
            share = [math.exp(r) / sum(map(math.exp, raw)) for r in raw]
            z = sum(s * v for s, v in zip(share, h))
            score = 1 / (1 + math.exp(-float(z @ p["c"] + p["d"][0])))
            total -= math.log(score if label else 1 - score)
        return total / len(y)

    got = quality_classifier.gradients(p, inputs, first, y)
    assert set(got) == set(p)
    for name, weights in p.items():
        for at in np.ndindex(weights.shape):
            kept, step = weights[at], 1e-6
            weights[at] = kept + step
            above = loss()
            weights[at] = kept - step
            below = loss()
            weights[at] = kept
            assert got[name][at] == pytest.approx((above - below) / (2 * step), abs=1e-7), (name, at)


def test_quality_classifier_one_long_text_does_not_end_the_sample(spark):
    rng = random.Random(6)
    docs = frame(spark, [(i, prose(rng, 30) if i % 2 else "## " * 30) for i in range(60)] + [(i, prose(rng, 64 * 40)) for i in range(60, 80)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, quality int")
    model = quality_classifier.learn(docs, labels, fit_passages=60, text_passages=10)
    assert isinstance(model, dict)
    alone = quality_classifier.learn(docs.filter("doc_id < 60"), labels.filter("doc_id < 60"), fit_passages=60, text_passages=10)
    assert all(np.array_equal(model[k], alone[k]) for k in alone)


def test_quality_classifier_without_both_classes(spark):
    docs = frame(spark, [(1, "a"), (2, None)])
    for rows, want in ([(1, 0), (2, 0)], 0.0), ([], 1.0):
        got = quality_classifier.score_documents(docs, spark.createDataFrame(rows, "doc_id long, quality int")).collect()
        assert {r.score for r in got} == {want}


def test_quality_rules_counts_and_verdict(spark):
    rng = random.Random(2)
    rows = [(i, prose(rng, 80) if i % 3 else " ".join(w + "$$$" for w in prose(rng, 80).split())) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "a b c " * 40), (103, "é ñ#\né ñ#\n \n" + prose(rng, 60)), (104, "short"), (None, prose(rng, 70))]
    trusted = spark.createDataFrame([(i,) for i in range(60) if i % 3] + [(1,), (None,)], "doc_id long")
    got = quality_rules.score_documents(frame(spark, rows), trusted).collect()
    assert len(got) == len(rows)
    for r, (doc_id, text) in zip(sorted(got, key=lambda r: r.doc_id if r.doc_id is not None else -1), sorted(rows, key=lambda r: r[0] if r[0] is not None else -1)):
        w = (text or "").encode().split()
        windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        often = Counter(windows)
        covered = {i + k for i, g in enumerate(windows) if often[g] > 1 for k in range(3)}
        lines = [x for x in (text or "").split("\n") if x.strip()]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(len(x.decode()) for x in w), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w))
        if doc_id is not None and doc_id < 60:
            assert r.kept == (doc_id % 3 != 0)
        assert not (r.base_failed and r.kept)


def test_quality_rules_score_is_the_mean_log_ratio(spark):
    rows = [(1, "a b a b c"), (2, "x y")]
    got = {r.doc_id: r.llr for r in quality_rules.score_documents(frame(spark, rows), spark.createDataFrame([(2,)], "doc_id long")).collect()}
    grams = lambda t: t.split() + list(zip(t.split(), t.split()[1:]))
    raw, target = Counter(grams("a b a b c") + grams("x y")), Counter(grams("x y"))
    share = lambda c, g: (c[g] + 1) / (sum(c.values()) + quality_rules.BUCKETS)
    for doc_id, text in rows:
        want = [math.log(share(target, g) / share(raw, g)) for g in grams(text)]
        assert got[doc_id] == pytest.approx(sum(want) / len(want))
    none = quality_rules.score_documents(frame(spark, rows), spark.createDataFrame([], "doc_id long")).collect()
    assert all(r.llr is None for r in none)


def test_suffix_tree_base_and_gain(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(prose(rng, 3) + " red fox jumps high" for _ in range(rng.randrange(1, 12)))) for i in range(300)]
    rows += [(1000, None), (1001, ""), (1002, "never seen words Here"), (None, "alpha"), (3, rows[3][1])]
    got = suffix_tree.score_documents(frame(spark, rows).repartition(3)).collect()
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    tokens = lambda t: [*words_of(t), None]
    c = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    want = Counter((i, held(i), len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n, round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(t)), 6)) for i, t in rows)
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    tested = [r for r in got if r.held_out and r.n_tokens > 5]
    assert sum(r.score - r.base_score for r in tested) / sum(r.n_tokens for r in tested) > 0.2


def test_suffix_tree_states_sum_to_one(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(["a b c", "a b d", "b c", "e"]) for _ in range(30))) for i in range(50)]
    docs = frame(spark, rows).select("text")
    counts = suffix_tree.word_counts(docs)
    c = {np.uint64(r.word % 2**64): r.c for r in counts.collect()}
    total, types = sum(c.values()), len(c)
    tree = suffix_tree.grow(docs, counts, total, types)
    assert len(tree) == 2 and len(tree[0].names) and len(tree[1].names)
    words = np.array(list(c), np.uint64)
    root = (np.array(list(c.values())) + 0.1) / (total + 0.1 * (types + 1))
    unseen = 1 - root.sum()
    for name, left in zip(tree[0].names, tree[0].left):
        gain = tree[0].gains(np.full(len(words), name), words, np.zeros(len(words)))
        assert (root * 10**gain).sum() + unseen * 10**left == pytest.approx(1)


def test_suffix_tree_bitmaps_and_prints_lose_nothing(spark):
    """Bitmaps hold all names and few others; the prints hold every pair that comes twice, in one task or in two."""
    rng = np.random.default_rng(5)
    names = rng.integers(-(2**63), 2**63 - 1, 5000, dtype=np.int64)
    bitmap = suffix_tree.Bitmap(spark.createDataFrame([(int(x),) for x in names], "name long"), "name")
    assert bitmap.has(names.view(np.uint64)).all()
    assert bitmap.has(rng.integers(0, 2**63, 100_000, dtype=np.int64).view(np.uint64)).mean() < 0.05
    assert not suffix_tree.Bitmap(spark.createDataFrame([], "name long"), "name").has(names.view(np.uint64)).any()
    rows = [(0, "a b c"), (1, "a b d e d e"), (2, None), (3, ""), (4, "f g")]
    docs = frame(spark, rows).select("text").repartition(3)
    words = suffix_tree.Bitmap(suffix_tree.word_counts(docs), "word")
    prints, buckets = suffix_tree.repeated_prints(docs, words, 20)
    name = lambda pair: suffix_tree.token_stream(np.frombuffer(pair.encode(), np.uint8).copy(), np.array([0, len(pair)]))[0][:2]
    want = {int(suffix_tree.named_print(*suffix_tree.printed(suffix_tree.after(t[:1], t[1:]), buckets)).view(np.int64)[0]) for t in map(name, ["a b", "d e"])}
    assert {r.name for r in prints.collect()} == want


def test_suffix_tree_equals_the_rule_by_hand(spark, monkeypatch):
    rng = random.Random(8)
    filler = [f"w{i}" for i in range(9000)]
    rows = [(i, " ".join([*rng.choices(filler, k=500), rng.choice(["to be or not", "let be or else"]), *["rare pair"] * (i < 16)])) for i in range(400)]
    held = lambda i: zlib.crc32(str(i).encode()) % 10 == 0
    tokens = {i: [*words_of(t), None] for i, t in rows}
    c = Counter(w for i in tokens if not held(i) for w in tokens[i])
    total, types = sum(c.values()), len(c)
    root = lambda w: (c[w] + 0.1) / (total + 0.1 * (types + 1))
    states = {}

    def gain(context, word):
        """log10 of a word's share over that in the root, in the longest kept suffix of context."""
        if not context:
            return 0.0
        if context not in states:
            return gain(context[1:], word)
        own, left = states[context]
        return own[word] if word in own else gain(context[1:], word) + left

    for depth in range(1, suffix_tree.DEPTH + 1):
        follow = {}
        for i, ts in tokens.items():
            for k in range(depth, len(ts)) if not held(i) else ():
                follow.setdefault(tuple(ts[k - depth : k]), Counter())[ts[k]] += 1
        for context, after in follow.items():
            of, own = after.total(), {w: n for w, n in after.items() if n >= 2}
            if of >= 10 and own:
                parent = {w: root(w) * 10 ** gain(context[1:], w) for w in own}
                share = {w: (n + 5 * parent[w]) / (of + 5) for w, n in own.items()}
                if max(abs(math.log(share[w] / parent[w])) for w in own) >= math.log(1.5):
                    left = math.log10(max(1 - sum(share.values()), 1e-9) / max(1 - sum(parent.values()), 1e-9))
                    states[context] = ({w: math.log10(share[w] / root(w)) for w in own}, left)
    assert total * 1e-4 > c[words_of("rare")[0]] >= 10  # by a share of all tokens this context would be none
    assert tuple(words_of("rare")) in states and any(len(s) > 2 for s in states)
    want = {i: sum(math.log10(root(w)) + gain(tuple(ts[max(0, k - suffix_tree.DEPTH) : k]), w) for k, w in enumerate(ts)) for i, ts in tokens.items()}
    for head in (suffix_tree.HEAD, 50):
        monkeypatch.setattr(suffix_tree, "HEAD", head)
        monkeypatch.setattr(suffix_tree, "EFFECTS", head)
        got = {r.doc_id: r.score for r in suffix_tree.score_documents(frame(spark, rows).repartition(3)).collect()}
        assert got == {i: pytest.approx(x, abs=1e-6) for i, x in want.items()}


def test_suffix_tree_dealt_words_and_small_windows(spark, monkeypatch):
    """Words whose places are dealt to several buckets, and counts that not every task knows, change no score."""
    rng = random.Random(12)
    words = [f"w{int(40 * rng.paretovariate(0.7))}" for _ in range(3000)]
    phrases = [" ".join(rng.choices(words, k=7)) for _ in range(60)]
    rows = [(i, " ".join([rng.choice(phrases), "the", *rng.choices(words, k=20), "the of the", rng.choice(phrases)])) for i in range(700)]
    rows += [(1000, None), (1001, ""), (1002, "y " * 600), (1003, "y " * 300 + "the"), (None, phrases[0]), (3, rows[3][1])]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    docs = frame(spark, [r for r in rows if not held(r[0])]).select("text")
    counts = suffix_tree.word_counts(docs)
    c = {r.word % 2**64: r.c for r in counts.collect()}
    total, types = sum(c.values()), len(c)
    tree = suffix_tree.grow(docs, counts, total, types, suffix_tree.DEPTH)
    assert len(tree) == suffix_tree.DEPTH and all(len(t.names) for t in tree)
    want = []
    for i, text in rows:
        data = np.frombuffer((text or "").encode(), np.uint8)
        tokens, _, place = suffix_tree.token_stream(data.copy(), np.array([0, len(data)]))
        gain = np.zeros(len(tokens))
        for states, (deep, context, _) in zip(tree, suffix_tree.contexts_of(tokens, place, suffix_tree.DEPTH)):
            gain[deep] = states.gains(context[deep], tokens[deep], gain[deep])
        want.append((i or -1, len(tokens), sum(math.log10((c.get(int(w), 0) + 0.1) / (total + 0.1 * (types + 1))) for w in tokens) + gain.sum()))
    for split, head, effects in ((1 << 19, 1 << 18, 1 << 20), (50, 1 << 18, 1 << 20), (50, 40, 3), (1 << 19, 0, 0)):
        for name, value in (("SPLIT", split), ("HEAD", head), ("EFFECTS", effects), ("ASK_WINDOW", 2000), ("OFTEN", 30)):
            monkeypatch.setattr(suffix_tree, name, value)
        got = [(r.doc_id or -1, r.n_tokens, r.score) for r in suffix_tree.score_documents(frame(spark, rows).repartition(3)).collect()]
        assert [x[:2] for x in sorted(got)] == [x[:2] for x in sorted(want)]
        assert [x[2] for x in sorted(got)] == pytest.approx([x[2] for x in sorted(want)], abs=1e-6)


def test_suffix_tree_sends_equal_places_of_a_text_once():
    """A text of one word a thousand times is a few places, whose times add up; rare pairs stay as they are."""
    texts = ["y " * 1000, "y " * 1000 + "z", "a b a b"]
    data, ends = np.frombuffer("".join(texts).encode(), np.uint8).copy(), np.cumsum([0, *map(len, texts)])
    tokens, doc, place = suffix_tree.token_stream(data, ends)
    words, c = np.unique(tokens, return_counts=True)
    known = suffix_tree.Vocabulary(words, np.maximum(c, 10), None, None)
    known.candidates = known.repeated = type("None_", (), {"has": lambda self, names: np.zeros(len(names), bool)})()
    places = suffix_tree.Places(tokens, place, known, 5)
    once, times = places.distinct(doc[places.at], 100)
    assert times.sum() == len(places.at) == 2005 and len(once) < 20
    full = Counter(zip(doc[places.at].tolist(), *[x.tolist() for x in (*places.history, places.token)]))
    merged = Counter()
    for i, n in zip(once, times):
        merged[int(doc[places.at[i]]), *[int(x[i]) for x in (*places.history, places.token)]] += int(n)
    assert merged == full
    assert len(places.distinct(doc[places.at], 5000)[0]) == 2005


def test_suffix_tree_shuffles_a_token_once(spark, monkeypatch):
    """Passages that come often have states and next tokens of all lengths; none of them is asked for by itself."""
    rng = random.Random(13)
    words = [f"w{i}" for i in range(3000)]
    phrases = [" ".join(rng.choices(words, k=12)) for _ in range(500)]
    rows = [(i, " ".join(rng.choices(phrases, k=20))) for i in range(1000)]
    monkeypatch.setattr(suffix_tree, "EFFECTS", 50)
    store = spark.sparkContext._jsc.sc().statusStore()

    def written():
        stages = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
        return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))

    before = written()
    assert len(suffix_tree.score_documents(frame(spark, rows)).collect()) == len(rows)
    assert written() - before < 25 * sum(len(t.split()) + 1 for _, t in rows)


def test_mixing_targets_and_copies(spark):
    rows = [(i, "w " * (i % 7), f"s{i % 3}") for i in range(900)] + [(1000 + i, "w w", "s9") for i in range(4)] + [(5000, None, "s0"), (5001, " ", None), (None, "a b c", None), (7, "w " * 4, "s1")]
    docs = frame(spark, rows)
    mixed = mixing.mix(docs)
    assert set(mixed.columns) == set(docs.columns) | {"source_size", "rate", "n_copies"}
    got = mixed.collect()
    sizes = Counter()
    for i, t, s in rows:
        sizes[s] += len((t or "").split())
    names = sorted((s for s in sizes if s is not None)) + [None]
    weight, targets, free = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}, {}, set(names)
    left = 1.5 * sum(sizes.values())
    while True:  # the rounds as told
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 2 * sizes[s]}
        if not over:
            break
        for s in over:
            targets[s] = 2.0 * sizes[s]
            left -= targets[s]
        free -= over
    targets |= {s: level * weight[s] for s in free}
    for r in got:
        assert (r.source_size, r.target) == (sizes[r.source], pytest.approx(targets[r.source]))
        rate = targets[r.source] / sizes[r.source]
        assert r.n_copies in (math.floor(rate + 1e-9), math.floor(rate + 1e-9) + 1) and r.n_copies <= 2
    for s in ("s0", "s1", "s2"):
        assert sum(r.size * r.n_copies for r in got if r.source == s) == pytest.approx(targets[s], rel=0.1)
    out = mixing.emit(docs)
    assert out.columns == docs.columns
    assert out.count() == sum(r.n_copies for r in got)
    assert mixing.emit(docs.limit(0)).collect() == []


def test_topk_equals_brute_force(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.normal(0, 0.3, 12)], 0, "x") for i in range(400)]
    rows += [(400, rows[0][1], 0, "x"), (401, rows[0][1], 0, "x"), (420, None, 0, "x"), (440, [1.0, None], 0, "x"), (460, [float("nan")] * 12, 0, "x"), (480, [float("inf")] * 12, 0, "x"), (500, [2.0] * 3, 0, "x"), (520, [], 0, "x"), (None, [1.0] * 12, 0, "x")]
    frame_ = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, score string")
    whole = {i: [math.floor(64 * float(np.float32(x))) for x in v] for i, v, *_ in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    want = {}
    for q, a in whole.items():
        if q % 20 == 0:
            scores = sorted(((-sum(x * y for x, y in zip(a, b)), i) for i, b in whole.items() if i != q))[:20]
            want[q] = [(i, -s) for s, i in scores]
    got = {}
    for r in exact_topk.top_k(frame_).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert {q: [(i, s) for _, i, s in sorted(v)] for q, v in got.items()} == want
    assert exact_topk.top_k(frame_.limit(0)).collect() == []


def test_topk_asks_equal_rows_once_and_vectors_of_one_id_each(spark):
    rng = np.random.default_rng(4)
    v = {i: rng.normal(size=6).tolist() for i in range(40)}
    other = rng.normal(size=6).tolist()
    rows = [(i, x) for i, x in v.items()] + [(20, v[20]), (0, other)]
    got = exact_topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=5).collect()
    ints = lambda x: [math.floor(64 * c) for c in x]

    def best(query, x):
        scores = sorted((-sum(a * b for a, b in zip(ints(x), ints(y))), i) for i, y in rows if i != query)[:5]
        return [(query, n + 1, i, -s) for n, (s, i) in enumerate(scores)]

    assert Counter(tuple(r) for r in got) == Counter(best(20, v[20]) + best(0, v[0]) + best(0, other))


def test_topk_stops_only_on_proof():
    rng = np.random.default_rng(9)
    v = rng.integers(-60, 60, (3000, 16))
    v[:50] *= 20
    q = rng.integers(-60, 60, (40, 16))
    found = list(exact_topk.best_of_block(np.arange(3000), v, exact_topk.segments(v), np.arange(10_000, 10_040), q, 20))
    for (_, ids, scores), query in zip(found, q):
        exact = v @ query
        order = np.lexsort((np.arange(3000), -exact))[:20]
        assert ids.tolist() == order.tolist() and scores.tolist() == exact[order].tolist()


def test_byte_bpe_equals_the_library_and_round_trips(spark):
    import tiktoken

    lines, pattern = byte_bpe.public_vocabulary()
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=byte_bpe.read_ranks(lines), special_tokens={})
    rng = random.Random(10)
    texts = ["", None, " ", "Hello,  world!\n\n\t it's <|endoftext|> 12345 naïve Straße 日本語 🙂🙂", "a" * 5000, "ab" * 130 + "ß" * 200, "x" + "qz" * 1400, prose(rng, 40).replace(" ", "") * 30, " " * 3000, "\x00\x07", prose(rng, 3000)]
    texts += ["".join(rng.choice("abcdeé ñ.!\n1") for _ in range(rng.randrange(1, 80))) for _ in range(200)]
    docs = frame(spark, [(i, t) for i, t in enumerate(texts)] + [(None, "x y"), (4, "again")])
    out = byte_bpe.encode(docs, lines, pattern)
    assert "lang" in out.columns and "text" not in out.columns
    got = out.collect()
    assert len(got) == len(texts) + 2
    for r in got:
        if r.doc_id is not None and not (r.doc_id == 4 and r.n_tokens < 10):
            text = texts[r.doc_id] or ""
            ids = library.encode_ordinary(text)
            assert r.ids == ids and r.n_tokens == len(ids) and bytes(r.decoded) == text.encode()
            assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest() and r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("operator", ["ngram", "shard", "lines", "classifier", "rules", "tree", "mix", "bpe"])
def test_empty_table(spark, operator):
    docs = frame(spark, [(1, "x")]).limit(0)
    labels = spark.createDataFrame([], "doc_id long, quality int")
    topology = sharding.regular_topology(4)
    run = {
        "ngram": lambda: ngram_join.jaccard_components(docs),
        "shard": lambda: sharding.shard_documents(docs, topology, topology),
        "lines": lambda: line_dedup.dedup_lines(docs),
        "classifier": lambda: quality_classifier.score_documents(docs, labels),
        "rules": lambda: quality_rules.score_documents(docs, labels.select("doc_id")),
        "tree": lambda: suffix_tree.score_documents(docs),
        "mix": lambda: mixing.mix(docs),
        "bpe": lambda: byte_bpe.encode(docs, *byte_bpe.public_vocabulary()),
    }
    assert run[operator]().collect() == []


def test_suffix_tree_scores_a_bucket_in_groups_of_words(spark, monkeypatch):
    last = np.array([3, 1, 3, 2, 1, 3, 5])
    groups = [g.tolist() for g in suffix_tree.word_groups(last, 6, 2)]
    assert sorted(sum(groups, [])) == list(range(7)) and all(g == sorted(g) for g in groups)
    assert len(groups) > 1 and all(len({i for i, g in enumerate(groups) if set(g) & set(np.flatnonzero(last == w).tolist())}) == 1 for w in set(last.tolist()))
    rng = random.Random(3)
    rows = frame(spark, [(i, " ".join(rng.choices([f"w{k}" for k in range(30)], k=40))) for i in range(300)])
    whole = {r.doc_id: r.score for r in suffix_tree.score_documents(rows).collect()}
    monkeypatch.setattr(suffix_tree, "SCORE_PLACES", 5)
    assert {r.doc_id: r.score for r in suffix_tree.score_documents(rows).collect()} == whole
