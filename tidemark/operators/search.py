"""Ranked text search: BM25 over all versions, of which only the eligible are returned."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import safe_terms

K1, B = 1.2, 0.75
ACCENTS = ("áàâäãåçéèêëíìîïñóòôöõúùûüýÿ", "aaaaaaceeeeiiiinooooouuuuyy")


def folded(text: Column) -> Column:
    return F.translate(F.lower(text), *ACCENTS)


def tokens(text: Column) -> Column:
    """Lower-cased words without accents."""
    return F.filter(F.split(folded(text), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def bm25(docs: DataFrame, key: Sequence[str], text: Column, query: str) -> DataFrame:
    """Documents that hold every term, with their score; rows without text are no documents.

    Only the query's terms are exploded; document frequencies and the mean
    length are taken over all documents. A hyphenated term is a phrase.
    """
    terms = [folded_text(t) for t in safe_terms(query)]
    phrases = [t.split("-") for t in terms]
    words = docs.filter(text.isNotNull()).select(*key, tokens(text).alias("_tokens")).withColumn("_length", F.size("_tokens"))
    count = lambda p: F.size(F.filter(F.col("_tokens"), lambda t: t == p[0])) if len(p) == 1 else F.size(F.filter(F.sequence(F.lit(0), F.greatest(F.col("_length") - 1, F.lit(0))), lambda i: F.slice("_tokens", i + 1, len(p)) == F.array(*[F.lit(w) for w in p])))
    hits = words.select(*key, "_length", *[count(p).alias(f"_tf{i}") for i, p in enumerate(phrases)])
    stats = hits.agg(F.count(F.lit(1)).alias("_docs"), F.avg("_length").alias("_mean"), *[F.count_if(F.col(f"_tf{i}") > 0).alias(f"_df{i}") for i in range(len(terms))])
    every = hits.filter(" AND ".join(f"_tf{i} > 0" for i in range(len(terms)))).crossJoin(F.broadcast(stats))
    idf = lambda i: F.ln((F.col("_docs") - F.col(f"_df{i}") + 0.5) / (F.col(f"_df{i}") + 0.5) + 1)
    part = lambda i: idf(i) * F.col(f"_tf{i}") * (K1 + 1) / (F.col(f"_tf{i}") + K1 * (1 - B + B * F.col("_length") / F.col("_mean")))
    return every.select(*key, sum((part(i) for i in range(len(terms))), F.lit(0.0)).alias("score"))


def folded_text(term: str) -> str:
    return term.lower().translate(str.maketrans(*ACCENTS))
