"""Exact top-k inner products by an impact-ordered, score-at-a-time index.

Components are quantised by their number of bits: a component's impact class is
the bit length of its absolute value. A block of vectors keeps, for each class,
the postings of that class as one segment (a sheet over rows and dimensions,
since every vector has every dimension), and the length of what each vector has
below the class. For a block of queries the segments are added in descending
impact. After each, a vector's score so far plus or minus |query| times the
length of its rest bounds its score; a query stops only when that proves which
vectors can be among its k best, and those are scored exactly in integers.

Scale: vectors and queries are dealt by hash into blocks of fixed size, and a
task holds one block of each; the queries are a stated set, so every pair of
blocks is the work asked for. A task hands on k rows for each of its queries,
and a window over them gives the k best of all blocks.

Defined cases: rows without id, with a null vector, or with a null or
non-finite component take no part; rows with the query's own id are its own;
equal rows are one query, and different vectors of one id a query each;
vectors of unequal length are compared as if filled with zeros; other ties go
to the smaller vec_id, then to any of equal rows; fewer candidates than k are
all returned; an empty table gives no rows; other columns are not used.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialise, table

SCALE = 64
K = 20
QUERY_STEP = 20
#: Vectors and queries in a block, on average, and queries handled together.
VECTOR_BLOCK, QUERY_BLOCK, QUERY_BATCH = 4096, 1024, 128
#: Stop adding segments when at most this many members are possible for a query, on average.
ENOUGH = 256


def scaled(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and v, the integer components of every row that takes part."""
    x = F.col("embedding")
    good = F.col("vec_id").isNotNull() & x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) != float("inf")))
    return vectors.filter(F.coalesce(good, F.lit(False))).select("vec_id", F.transform(x, lambda c: F.floor(c.cast("double") * scale)).alias("v"))


def segments(v: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(sheet of the postings of one impact class, length of each vector's rest below it), by descending impact."""
    size = np.abs(v)
    bits = np.frexp(size.astype(np.float64))[1]
    out = []
    for c in sorted(set(np.unique(bits).tolist()) - {0}, reverse=True):
        rest = np.where(bits < c, v, 0).astype(np.float64)
        out.append((np.where(bits == c, v, 0).astype(np.float64), np.sqrt((rest * rest).sum(1))))
    return out


def best_of_block(ids: np.ndarray, v: np.ndarray, index, query_ids: np.ndarray, q: np.ndarray, k: int):
    """Rows (query_id, vec_id, score) with each query's k best in one block."""
    whole = q.astype(np.float64)
    length = np.sqrt((whole * whole).sum(1))
    slack = 1e-9 * (1 + length[:, None] * np.sqrt((v.astype(np.float64) ** 2).sum(1)).max(initial=0))
    own = query_ids[:, None] == ids[None, :]
    sums = np.zeros((len(q), len(v)))
    may = ~own
    for n, (sheet, rest) in enumerate(index):
        sums += whole @ sheet.T
        reach = length[:, None] * rest[None, :] + slack
        low = np.where(own, -np.inf, sums - reach)
        if len(v) > k:
            kth = np.partition(low, len(v) - k, axis=1)[:, len(v) - k]
            may = ~own & (sums + reach >= kth[:, None])
        if may.sum() <= ENOUGH * len(q) or n + 1 == len(index):
            break
    for i, query in enumerate(query_ids):
        members = np.flatnonzero(may[i])
        score = v[members] @ q[i]
        order = np.lexsort((ids[members], -score))[:k]
        yield np.full(len(order), query), ids[members][order], score[order]


def top_k(vectors: DataFrame, k: int = K, query_step: int = QUERY_STEP) -> DataFrame:
    """query_id, rank, vec_id and score of the k best candidates of every row whose id is divisible by query_step."""
    whole = materialise(scaled(vectors), "vectors")
    queries = whole.filter(F.pmod("vec_id", F.lit(query_step)) == 0).distinct().withColumn("query_key", F.xxhash64("v"))
    n, n_queries = whole.count(), queries.count()
    blocks, query_blocks = max(1, -(-n // VECTOR_BLOCK)), max(1, -(-n_queries // QUERY_BLOCK))
    all_of = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    cells = whole.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")).withColumn("query_block", all_of(query_blocks))
    asked = queries.withColumn("query_block", F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).cast("int")).withColumn("block", all_of(blocks))

    def best(vector_rows: pa.Table, query_rows: pa.Table) -> pa.Table:
        schema = pa.schema([("query_key", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
        if not vector_rows.num_rows or not query_rows.num_rows:
            return schema.empty_table()
        width = max(len_ for t in (vector_rows, query_rows) for len_ in np.diff(t["v"].combine_chunks().offsets.to_numpy()).tolist())
        v, q = (filled(t["v"].combine_chunks(), width) for t in (vector_rows, query_rows))
        ids, query_ids = (t["vec_id"].to_numpy().astype(np.int64) for t in (vector_rows, query_rows))
        keys, index, found = query_rows["query_key"].to_numpy(), segments(v), []
        for a in range(0, len(q), QUERY_BATCH):
            best_here = best_of_block(ids, v, index, query_ids[a : a + QUERY_BATCH], q[a : a + QUERY_BATCH], k)
            found += [(np.full(len(query), key), query, *rest) for key, (query, *rest) in zip(keys[a : a + QUERY_BATCH], best_here)]
        return pa.table([np.concatenate(x) for x in zip(*found)], schema=schema)

    local = cells.groupBy("block", "query_block").cogroup(asked.groupBy("block", "query_block")).applyInArrow(best, "query_key long, query_id long, vec_id long, score long")
    ordered = Window.partitionBy("query_id", "query_key").orderBy(F.col("score").desc(), "vec_id")
    return local.withColumn("rank", F.row_number().over(ordered)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def filled(lists: pa.ListArray, width: int) -> np.ndarray:
    """Rows of equal width, filled with zeros."""
    at, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.diff(at)
    out = np.zeros((len(sizes), width), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(row)) - np.repeat(at[:-1] - at[0], sizes)] = flat[at[0] : at[-1]]
    return out


def op9_exact_topk(spark, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


#: A vector's floors and the products, for DuckDB.
OP9_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(CAST(c AS DOUBLE) * 64) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
q AS (SELECT *, row_number() OVER () AS asked FROM (SELECT DISTINCT vec_id, v FROM v WHERE vec_id % 20 = 0) d),
s AS (SELECT asked, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score FROM q JOIN v c ON c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY asked ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20"""
