"""Queries by a posting index (H1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import ledger as L
from tidemark.operators import postings as P
from tidemark.plans import bindings as B
from tidemark.plans.ledgers import NEWS_SPEC
from tidemark.plans.registry import ORACLE_SQL, query
from tidemark.plans.services import _FOLD, _bm25_sql
from tidemark.sources.scratch import shared_path


def _document_index(spark, sf_dir) -> str:
    """All documents as an index that batches made, one for each source."""
    path = shared_path(spark, "document-index")
    docs = B.read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    for i in range(3):
        P.append(docs.filter(F.pmod(F.xxhash64("source"), F.lit(3)) == i), ["doc_id"], F.col("text"), path, f"b{i}")
    return path


def _news_index(spark, sf_dir) -> str:
    path = shared_path(spark, "news-index")
    P.append(B.news(spark, sf_dir).select("item", "version", "body"), ["item", "version"], F.col("body"), path, "all")
    return path


@query("H1_posting_search", ORACLE_SQL["H1_news_search_bm25"])
def posting_search(spark, sf_dir):
    """Every document with both terms, by the index."""
    return P.search(spark, _document_index(spark, sf_dir), ["doc_id"], "The of").select("doc_id", F.round("score", 6).alias("score"))


@query("H1_posting_search_top", f"WITH {B.NEWS}, v AS (SELECT item * 1000 + version AS id, body AS text FROM news), last AS (SELECT item * 1000 + version AS id FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY version DESC) AS rn FROM news) t WHERE rn = 1 AND state = 'active'), found AS (WITH " + _bm25_sql(["the", "and"], "v", "id", " AND id IN (SELECT id FROM last)") + ") SELECT CAST(id // 1000 AS BIGINT) AS item, CAST(id % 1000 AS BIGINT) AS version, score FROM found ORDER BY score DESC, id LIMIT 25")
def posting_search_top(spark, sf_dir):
    """The 25 best of the latest active versions; frequencies are of all versions."""
    last = L.ledger_select(B.news(spark, sf_dir), NEWS_SPEC).select("item", "version")
    out = P.search(spark, _news_index(spark, sf_dir), ["item", "version"], "the and", limit=25, eligible=last)
    return out.select("item", "version", F.round("score", 6).alias("score"))


@query("H1_posting_terms", f"WITH tok AS (SELECT doc_id, list_filter(regexp_split_to_array({_FOLD}, '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '') AS t FROM documents WHERE text IS NOT NULL), x AS (SELECT doc_id, len(t) AS n, unnest(t) AS token FROM tok), c AS (SELECT token, doc_id, count(*) AS f, max(n) AS n FROM x GROUP BY 1, 2) SELECT token, count(*) AS documents, CAST(sum(f) AS BIGINT) AS occurrences, CAST(max(f) AS INTEGER) AS most, CAST(min(n) AS INTEGER) AS shortest FROM c GROUP BY 1")
def posting_terms(spark, sf_dir):
    """What the index says of every token, without its postings."""
    rows = spark.read.parquet(f"{_document_index(spark, sf_dir)}/postings")
    return rows.groupBy("token").agg(F.sum("n").alias("documents"), F.sum("times").alias("occurrences"), F.max("most").alias("most"), F.min("shortest").alias("shortest"))
