"""Search by the posting index against search by a scan, and what the index reads."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import postings, search

WORDS = "rate rates inflation bank Bánk of the a growth first-quarter result".split()


def corpus(spark, n=300):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(WORDS) for _ in range(rng.randrange(1, 40)))) for i in range(n)] + [(1000, None), (1001, ""), (1002, "...")]
    return spark.createDataFrame(rows, "id long, text string")


def indexed(docs, path):
    for i in range(3):
        postings.append(docs.filter(F.col("id") % 3 == i), ["id"], F.col("text"), path, f"day{i}")


def scores(df):
    return {r.id: round(r.score, 9) for r in df.collect()}


def scan_metric(df, name, column="token#"):
    """A metric of the scan with a column, of a plan that is run."""
    df.collect()
    plan, found = df._jdf.queryExecution().executedPlan(), []
    stack = [plan]
    while stack:
        node = stack.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            stack.append(node.executedPlan())
            continue
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            stack.append(node.plan())
            continue
        if node.nodeName().startswith("Scan") and column in node.output().toString():
            found.append(node.metrics().get(name).get().value())
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
    return sum(found)


@pytest.mark.parametrize("query", ["bank", "the of", "inflation rates growth", "first-quarter", "first-quarter result the", "nowhere", "bank nowhere", "a-a"])
def test_scores_equal_the_scan(spark, tmp_path, monkeypatch, query):
    monkeypatch.setattr(postings, "BLOCK", 20)
    docs, path = corpus(spark), str(tmp_path / "index")
    indexed(docs, path)
    want = scores(search.bm25(docs, ["id"], F.col("text"), query))
    assert scores(postings.search(spark, path, ["id"], query)) == want
    best = sorted(want.items(), key=lambda x: (-x[1], x[0]))[:7]
    assert sorted(scores(postings.search(spark, path, ["id"], query, limit=7)).items(), key=lambda x: (-x[1], x[0])) == best
    eligible = docs.filter("id % 2 = 0").select("id")
    best = sorted(((i, s) for i, s in want.items() if i % 2 == 0), key=lambda x: (-x[1], x[0]))[:4]
    assert sorted(scores(postings.search(spark, path, ["id"], query, limit=4, eligible=eligible)).items(), key=lambda x: (-x[1], x[0])) == best


def test_null_texts_are_no_documents(spark, tmp_path):
    docs = spark.createDataFrame([(1, "alpha beta"), (2, None), (3, "alpha")], "id long, text string")
    path = str(tmp_path / "index")
    postings.append(docs, ["id"], F.col("text"), path, "one")
    only = scores(search.bm25(docs.dropna(), ["id"], F.col("text"), "alpha"))
    assert scores(search.bm25(docs, ["id"], F.col("text"), "alpha")) == only == scores(postings.search(spark, path, ["id"], "alpha"))
    totals = postings.batches(spark, path).first()
    assert (totals.documents, totals.tokens) == (2, 3)


def test_a_query_reads_its_buckets_only(spark, tmp_path):
    docs, path = corpus(spark), str(tmp_path / "index")
    indexed(docs, path)
    whole = spark.read.parquet(f"{path}/postings")
    files = len(whole.inputFiles())
    own = whole.filter(F.col("bucket") == postings.bucket_of(F.lit("inflation"))).select(F.input_file_name()).distinct().count()
    assert scan_metric(postings.postings(spark, path, ["inflation"]).select("token", "n"), "numFiles") == own < files


def test_blocks_below_the_bound_are_left_out(spark, tmp_path, monkeypatch):
    """Long texts with the word once can't reach the scores of short ones with it often."""
    monkeypatch.setattr(postings, "BLOCK", 8)
    docs = spark.createDataFrame([(i, "word " * (9 if i < 6 else 1) + "filler " * (i < 6 or 300)) for i in range(200)], "id long, text string")
    path = str(tmp_path / "index")
    postings.append(docs.filter("id >= 6"), ["id"], F.col("text"), path, "long")
    postings.append(docs.filter("id < 6"), ["id"], F.col("text"), path, "short")
    rows = postings.postings(spark, path, ["word"])
    totals = postings.batches(spark, path).agg(F.sum("documents"), F.sum("tokens")).first()
    bounds = [r.bound for r in postings.block_bounds(rows, [["word"]], [postings.weight(totals[0], 200)], totals[1] / totals[0]).collect()]
    best = postings.search(spark, path, ["id"], "word", limit=5).collect()
    assert [r.id for r in best] == [0, 1, 2, 3, 4]
    assert sum(b >= best[-1].score for b in bounds) <= 2 < len(bounds)


def test_a_batch_again_replaces_itself_and_an_interrupted_one_is_not_there(spark, tmp_path):
    docs, path = corpus(spark, 60), str(tmp_path / "index")
    indexed(docs, path)
    want = scores(postings.search(spark, path, ["id"], "bank"))
    postings.append(docs.filter("id % 3 = 1"), ["id"], F.col("text"), path, "day1")
    assert scores(postings.search(spark, path, ["id"], "bank")) == want
    late = docs.select((F.col("id") + 5000).alias("id"), "text")
    postings.postings_of(late, ["id"], F.col("text"), 1).write.partitionBy("bucket").parquet(f"{path}/postings/batch=day9")  # and no row of the batch
    assert scores(postings.search(spark, path, ["id"], "bank")) == want
    postings.append(late, ["id"], F.col("text"), path, "day9")
    assert len(scores(postings.search(spark, path, ["id"], "bank"))) == 2 * len(want)


def test_a_text_is_tokenised_once_and_rows_of_a_key_are_one_document(spark, tmp_path):
    docs = spark.createDataFrame([(1, "b a b"), (1, "a c a a a"), (None, "a"), (2, ""), (3, None)], "id long, text string")
    found = postings.postings_of(docs, ["id"], F.col("text"), 1)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and plan.count("split(") == 1
    got = {r.token: (r.n, r.most, r.shortest, r.times, sorted(((p.id or 0, p.frequency, p.length, p.positions) for p in r.postings))) for r in found.collect()}
    assert got == {"a": (2, 5, 1, 6, [(0, 1, 1, [0]), (1, 5, 5, [0, 1, 2, 3, 4])]), "b": (1, 2, 5, 2, [(1, 2, 5, [0, 2])]), "c": (1, 1, 5, 1, [(1, 1, 5, [1])])}
    path = str(tmp_path / "index")
    postings.append(docs, ["id"], F.col("text"), path, "one")
    postings.append(docs.filter("id = 2"), ["id"], F.col("text"), path, "blank")
    assert sorted((r.batch, r.documents, r.tokens) for r in postings.batches(spark, path).collect()) == [("blank", 1, 0), ("one", 4, 9)]
