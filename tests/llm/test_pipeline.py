"""The corpus pipeline: each stage on what its predecessor kept, done by SQL, by all pairs and by the public library."""

import hashlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_corpus_operators import linked, prose, words_of
from tidemark.llm import byte_bpe, line_dedup, mixing, quality_classifier
from tidemark.llm.common import materialise, table


def digest(text):
    return None if text is None else hashlib.md5(text.encode()).hexdigest()


def in_duck(docs):
    con = duckdb.connect()
    con.register("docs_rows", pa.table({"doc_id": pa.array([r.doc_id for r in docs], pa.int64()), "text": pa.array([r.text for r in docs], pa.string()), "source": pa.array([r.source for r in docs], pa.string())}))
    con.execute("CREATE TABLE docs AS SELECT * FROM docs_rows")
    return con


def after_stage(name, spark, before, sf_dir, docs):
    """(doc_id, digest of the text), with repeats, that a stage must leave of the rows before."""
    if name == "quality classifier":
        scored = quality_classifier.score_documents(docs, table(spark, sf_dir, "labels").select("doc_id", "quality")).filter("predicted = 1").select("doc_id").collect()
        good = {r.doc_id for r in scored}
        return Counter((r.doc_id, digest(r.text)) for r in before if r.doc_id in good)
    if name == "line dedup":
        rows = in_duck(before).execute("WITH " + line_dedup.ALL_RUNS_SQL.format(docs="docs") + " SELECT doc_id, text, n_removed FROM cleaned").fetchall()
        return Counter((i, digest(t)) for i, t, removed in rows if not removed or words_of(t))
    if name == "n-gram Jaccard join":
        keep = linked([(r.doc_id, r.text) for r in before])
        return Counter(set((r.doc_id, digest(r.text)) for r, first in zip(before, keep) if r.doc_id == first))
    rows = in_duck(before).execute("WITH " + mixing.MIX_SQL.format(docs="docs") + " SELECT doc_id, text, n_copies FROM mixed").fetchall()
    return Counter({(i, digest(t)): n for i, t, n in rows if n})


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables of a few documents: copies, repeated lines, nulls, empty texts, and columns of clashing names."""
    import random

    rng = random.Random(12)
    shared = "\n".join(prose(rng, 12) for _ in range(4))
    texts = [prose(rng, 80) + "\n" + prose(rng, 40) for _ in range(50)]
    rows = [(i, t if i % 4 else t + "\n" + shared + "\n" + prose(rng, 9), "ab"[i % 2]) for i, t in enumerate(texts)]
    rows += [(100 + i, texts[i], "c") for i in range(10)] + [(200 + i, texts[i] + " tail", None) for i in range(6)]
    rows += [(300, None, "a"), (301, "", "b"), (302, " \n ", None), (303, "x " * 3000, "a"), (304, "!!! $$$ %%%\n" * 5, "b")]
    path = str(tmp_path_factory.mktemp("tables"))
    docs = spark.createDataFrame([(i, t, "en", s, len(t or ""), f"r{i}", i) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long, _rate string, row long")
    docs.write.parquet(f"{path}/documents.parquet")
    labels = [(i, int(i < 300), 0) for i, _, _ in rows if i % 3 or i >= 300]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


@pytest.mark.parametrize("tables", ["tiny", "folder"])
def test_every_stage_equals_its_rule(spark, request, tables):
    sf_dir = request.getfixturevalue(tables)
    docs = table(spark, sf_dir, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.collect()
        want = after_stage(name, spark, before, sf_dir, docs)
        docs = materialise(stage(spark, docs, sf_dir), "test-stage")
        after = docs.collect()
        assert docs.columns == columns and Counter((r.doc_id, digest(r.text)) for r in after) == want, name
        if "_rate" in columns:
            assert all(r["_rate"] == f"r{r.doc_id}" and r["row"] == r.doc_id for r in after)
        if name == "line dedup":
            assert all(r.n_chars == len(r.text) for r in after if r.text is not None)
    lines, pattern = byte_bpe.public_vocabulary()
    import tiktoken

    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=byte_bpe.read_ranks(lines), special_tokens={})
    sha = lambda ids: hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    want = Counter((r.doc_id, sha(library.encode_ordinary(r.text or "")), hashlib.sha256((r.text or "").encode()).hexdigest()) for r in docs.collect())
    got = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert Counter((r.doc_id, r.ids_sha256, r.decoded_sha256) for r in got) == want
    whole = corpus_pipeline.run(spark, sf_dir).collect()
    assert Counter((r.doc_id, r.ids_sha256) for r in whole) == Counter((i, d) for i, d, n in want.elements())


def test_no_documents_and_no_labels(spark, folder, tmp_path):
    docs = table(spark, folder, "documents")
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    table(spark, folder, "labels").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
    path = str(tmp_path / "unlabelled")
    docs.filter(F.col("doc_id") < 5).write.parquet(f"{path}/documents.parquet")
    table(spark, folder, "labels").limit(0).write.parquet(f"{path}/labels.parquet")
    ids = {r.doc_id for r in corpus_pipeline.run(spark, path).collect()}
    assert ids <= set(range(5))
