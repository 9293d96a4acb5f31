"""A posting index of texts as Parquet tables, to which batches append, and ranked search by it.

``postings/batch=…/bucket=…`` holds a row for each token and block of documents:
how many documents of the block hold the token, its largest frequency there, the
shortest of their texts, how often it occurs, and the postings themselves (document, frequency,
length, positions). ``batches/batch=…`` holds a batch's number of documents and
of tokens; it is written last, so a batch that was interrupted is not there for
readers, and writing it again replaces what it left.

A search reads the buckets of its own tokens. The numbers in front of the
postings tell which blocks hold all terms, and bound what a document there may
score; with a limit, the blocks of the highest bounds are read first and the
others only where their bound reaches the k-th score found.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import safe_terms
from tidemark.operators.search import B, K1, folded_text, tokens
from tidemark.sources.scratch import delete

#: Token buckets of a batch, and documents of a block (on average).
BUCKETS, BLOCK = 64, 4096
#: Blocks that a limited search reads first.
FIRST_BLOCKS = 4
#: Tokens of a block that a task hands on together.
ROWS = 4096


def bucket_of(token: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(buckets)).cast("int")


def postings_of(docs: DataFrame, key: Sequence[str], text: Column, n_blocks: int) -> DataFrame:
    """A row for each token and block with its postings. One shuffle, of the texts by block; a block's tokens are sorted together."""
    block = F.pmod(F.xxhash64(*key), F.lit(n_blocks)).cast("int")
    placed = docs.filter(text.isNotNull()).select(*key, text.alias("_text"), block.alias("_block")).repartition("_block").sortWithinPartitions("_block")
    words = placed.select("_block", *key, tokens(F.col("_text")).alias("_tokens"))
    entry = T.StructType([docs.select(k).schema[0] for k in key] + [T.StructField("frequency", T.IntegerType()), T.StructField("length", T.IntegerType()), T.StructField("positions", T.ArrayType(T.IntegerType()))])
    numbers = [T.StructField(n, T.LongType() if n in ("n", "times") else T.IntegerType()) for n in ("n", "most", "shortest", "times")]
    schema = T.StructType([T.StructField("block", T.IntegerType()), T.StructField("token", T.StringType()), *numbers, T.StructField("postings", T.ArrayType(entry))])
    found = words.groupBy("_block").applyInArrow(lambda group: block_postings(group, list(key)), schema)
    return found.withColumn("bucket", bucket_of(F.col("token")))


def block_postings(group: pa.Table, key: list[str]) -> pa.Table:
    """The postings of one block's documents; rows of one key are one document."""
    lists = group.column("_tokens").combine_chunks()
    size = pc.list_value_length(lists).to_numpy()
    coded = lists.flatten().dictionary_encode()
    row = np.zeros(len(size), np.int64)
    for k in key:
        own = group.column(k).combine_chunks().dictionary_encode(null_encoding="encode")
        _, row = np.unique(row * len(own.dictionary) + own.indices.to_numpy(), return_inverse=True)
    _, first, row = np.unique(row, return_index=True, return_inverse=True)
    n = max(len(first), 1)
    length = np.zeros(n, np.int32)
    np.maximum.at(length, row, size)
    at = coded.indices.to_numpy().astype(np.int64) * n + np.repeat(row, size)
    position = (np.arange(len(at)) - np.repeat(np.cumsum(size) - size, size)).astype(np.int32)
    order = np.argsort(at, kind="stable") if len(first) == len(size) else np.lexsort((position, at))
    at, position = at[order], position[order]
    start = np.flatnonzero(np.diff(at, prepend=-1))
    frequency = np.diff(np.append(start, len(at))).astype(np.int32)
    token, doc = at[start] // n, at[start] % n
    head = np.flatnonzero(np.diff(token, prepend=-1))
    lists_of = lambda starts, end, values: pa.ListArray.from_arrays(pa.array(np.append(starts, end), pa.int32()), values)
    keys = [group.column(k).combine_chunks().take(pa.array(first[doc])) for k in key]
    entries = pa.StructArray.from_arrays([*keys, pa.array(frequency), pa.array(length[doc]), lists_of(start, len(at), pa.array(position))], names=[*key, "frequency", "length", "positions"])
    over = lambda ufunc, values: pa.array(ufunc.reduceat(values, head) if len(head) else values[:0])
    columns = {
        "block": pa.array(np.full(len(head), group.column("_block")[0].as_py(), np.int32)),
        "token": coded.dictionary.take(pa.array(token[head])),
        "n": pa.array(np.diff(np.append(head, len(token)))),
        "most": over(np.maximum, frequency),
        "shortest": over(np.minimum, length[doc]),
        "times": over(np.add, frequency.astype(np.int64)),
        "postings": lists_of(head, len(token), entries),
    }
    out = pa.table(columns)
    return pa.Table.from_batches(out.to_batches(max_chunksize=ROWS), out.schema)


def append(docs: DataFrame, key: Sequence[str], text: Column, path: str, batch: str) -> None:
    """Add documents as one batch; rows without text are none. The same batch again replaces itself."""
    spark, at = docs.sparkSession, f"{path}/postings/batch={batch}"
    n_documents = docs.filter(text.isNotNull()).count()
    found = postings_of(docs, key, text, max(1, -(-n_documents // BLOCK)))
    delete(spark, f"{path}/batches/batch={batch}")
    found.sortWithinPartitions("bucket", "token").write.mode("overwrite").partitionBy("bucket").parquet(at)
    # the tokens are summed up from the numbers in front of the postings, so that no text is read for it again
    sizes = spark.read.schema(found.schema).parquet(at).agg(F.lit(n_documents).cast("long").alias("documents"), F.coalesce(F.sum("times"), F.lit(0)).alias("tokens"))
    sizes.write.mode("overwrite").parquet(f"{path}/batches/batch={batch}")


def batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/batches").withColumn("batch", F.col("batch").cast("string"))


def postings(spark: SparkSession, path: str, wanted: Sequence[str]) -> DataFrame:
    """The rows of the tokens, of committed batches; only their buckets are read."""
    rows = spark.read.parquet(f"{path}/postings").withColumn("batch", F.col("batch").cast("string"))
    own = [r.b for r in spark.createDataFrame([(w,) for w in wanted], "w string").select(bucket_of(F.col("w")).alias("b")).distinct().collect()]
    return rows.filter(F.col("bucket").isin(own) & F.col("token").isin(list(wanted))).join(batches(spark, path).select("batch"), "batch", "left_semi")


def phrase_count(positions: Sequence[Column]) -> Column:
    """How often words follow one another, by their sorted positions."""
    back = lambda p, i: F.transform(p, lambda x: x - i)
    return F.size(reduce(F.array_intersect, [back(p, i) for i, p in enumerate(positions)]))


def matches(rows: DataFrame, key: Sequence[str], phrases: Sequence[Sequence[str]]) -> DataFrame:
    """Documents with all phrases: key, length and tf0, tf1, ...; a join of the tokens' postings by document."""
    words = sorted({w for p in phrases for w in p})
    entries = rows.select("batch", "token", F.explode("postings").alias("p")).select("batch", "token", "p.*")
    wide = entries.groupBy("batch", *key).agg(F.max("length").alias("length"), F.count_distinct("token").alias("held"), *[F.max(F.when(F.col("token") == w, F.col("positions"))).alias(f"_at{i}") for i, w in enumerate(words)])
    at = {w: F.col(f"_at{i}") for i, w in enumerate(words)}
    counts = [F.size(at[p[0]]) if len(p) == 1 else phrase_count([at[w] for w in p]) for p in phrases]
    out = wide.filter(F.col("held") == len(words)).select(*key, "length", *[c.alias(f"tf{i}") for i, c in enumerate(counts)])
    return out.filter(" AND ".join(f"tf{i} > 0" for i in range(len(phrases))))


def weight(documents: int, df: int) -> float:
    return math.log((documents - df + 0.5) / (df + 0.5) + 1)


def part(idf: float, tf: Column, length: Column, mean: float) -> Column:
    return F.lit(idf) * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / F.lit(mean)))


def search(spark: SparkSession, path: str, key: Sequence[str], query: str, limit: int | None = None, eligible: DataFrame | None = None) -> DataFrame:
    """key and score of the documents that hold every term, all or the best few (ties by key).

    Frequencies and lengths are of all documents, hits only eligible ones. A
    hyphenated term is a phrase, whose frequency is counted from its matches.
    """
    phrases = [folded_text(t).split("-") for t in safe_terms(query)]
    words = sorted({w for p in phrases for w in p})
    rows = postings(spark, path, words)
    totals = batches(spark, path).agg(F.sum("documents").alias("n"), F.sum("tokens").alias("t")).first()
    n, mean = totals.n or 0, (totals.t or 0) / max(totals.n or 0, 1) or 1.0
    df = {r.token: r.n for r in rows.groupBy("token").agg(F.sum("n").alias("n")).collect()}  # the query's words
    idf = []
    for p in phrases:
        held = df.get(p[0], 0) if len(p) == 1 else matches(rows.filter(F.col("token").isin(p)), key, [p]).count()
        idf.append(weight(n, held))
    score = lambda hits: sum((part(w, F.col(f"tf{i}"), F.col("length"), mean) for i, w in enumerate(idf)), F.lit(0.0))

    def hits(of: DataFrame) -> DataFrame:
        found = matches(of, key, phrases)
        if eligible is not None:
            found = found.join(eligible.select(*key).distinct(), list(key), "left_semi")
        return found.select(*key, score(found).alias("score"))

    if limit is None:
        return hits(rows)
    bounds = block_bounds(rows, phrases, idf, mean)
    first = bounds.orderBy(F.col("bound").desc(), "batch", "block").limit(FIRST_BLOCKS)
    order = [F.col("score").desc(), *key]
    best = hits(rows.join(first, ["batch", "block"], "left_semi")).orderBy(*order).limit(limit).collect()  # limit rows
    floor = best[-1].score if len(best) == limit else 0.0
    return hits(rows.join(bounds.filter(F.col("bound") * (1 + 1e-9) >= floor), ["batch", "block"], "left_semi")).orderBy(*order).limit(limit)


def block_bounds(rows: DataFrame, phrases: Sequence[Sequence[str]], idf: Sequence[float], mean: float) -> DataFrame:
    """batch, block and bound of the blocks that hold all words: no document there scores more. The postings aren't read."""
    words = sorted({w for p in phrases for w in p})
    numbers = rows.groupBy("batch", "block").agg(F.count_distinct("token").alias("held"), F.max("shortest").alias("shortest"), *[F.max(F.when(F.col("token") == w, F.col("most"))).alias(f"_most{i}") for i, w in enumerate(words)])
    most = {w: F.col(f"_most{i}") for i, w in enumerate(words)}
    # a document with all words is no shorter than the shortest of each word, and a phrase no more frequent than its rarest word
    bound = sum((part(w, F.least(*[most[x] for x in p]) if len(set(p)) > 1 else most[p[0]], F.col("shortest"), mean) for w, p in zip(idf, phrases)), F.lit(0.0))
    return numbers.filter(F.col("held") == len(words)).select("batch", "block", bound.alias("bound"))
