"""Ranked lexical search by MaxScore with pair bounds.

Documents are indexed in blocks: lists of (document, contribution) for each term
of the queries, and for each pair of terms that some query pairs up the list of
the documents that hold both, with what both contribute there. A list has its
maximum; a pair's is the joint maximum, which is less than the sum of two
maxima unless one document has both.

A query's terms are paired by document frequency, the most frequent with each
other. A pair bounds what its two terms may add to a document: the joint
maximum where both occur, else the larger single one. In a block, pairs of small
bound, whose sum stays below the k-th best score known, can't lift a document by
themselves: only the lists of the other pairs are read for candidates. Candidates
then look the rest up by descending bound, first in the intersection (a document
outside it has one term at most), and are dropped as soon as their bound fails.
A block whose bounds all together fail is not read at all.

Scale: documents are read once and never shuffled; a block is a row of arrays of
some thousand documents, cut inside the task that read them. A sixteenth of the
blocks is searched first; the k-th best scores there are where the others start,
and a task carries its own k-th best from block to block, so nothing depends on
how blocks are dealt out. A task hands on k rows for each query. Weights need
the frequencies of the queries' terms only. Queries are taken in batches of a
bounded number of terms, which the tasks hold.

Terms are named by 64 bits of a hash of their bytes.

Defined cases: a null text, or one without terms, is no document of the counts
and is never found; rows that repeat doc_id, or all of a row, are found each for
themselves; a row without id ranks after equal scores and has a null id; equal
items are one query, different texts of one item a query each; an item without
terms, or whose terms no document holds, finds nothing; ties go to the smaller
doc_id, then to any of equal rows; empty tables give no rows; other columns are
not used.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import MAX_LONG, materialise, release, table
from tidemark.llm.tokens import IN_TERM, LOWER, Words, chunks

K = 10
#: Documents of a block, about; a block is also cut at so many postings.
BLOCK, BLOCK_POSTINGS = 4096, 2_000_000
#: One of so many blocks is searched first.
SEED_STEP = 16
#: Terms, with repeats, of the queries that are handled together.
BATCH_TERMS = 1 << 19

#: The arrays of a block, packed as little-endian numbers; documents are places in doc_ids.
BLOCK_ARRAYS = {"doc_ids": "<i8", "n": "<i8", "term": "<i4", "size": "<i4", "doc": "<i4", "tf": "<i4"}
INDEX_ARRAYS = {"doc_ids": "<i8", "term": "<i4", "size": "<i4", "doc": "<i4", "gain": "<i8", "pair": "<i4", "pair_size": "<i4", "pair_doc": "<i4", "pair_gain": "<i8"}


def query_terms(items: DataFrame) -> DataFrame:
    """query, item_id and term of the distinct terms of each distinct item, as a table."""

    def found(batches):
        for batch in batches:
            for at, to, data, offsets in chunks(batch.column("text")):
                words, head = Words(data, offsets, IN_TERM), batch.slice(at, to - at).select(["query", "item_id"])
                lowered = LOWER[data]
                terms = [lowered[s : s + n].tobytes().decode("utf-8", "replace") for s, n in zip(words.starts.tolist(), words.lengths.tolist())]
                rows = head.take(pa.array(words.doc))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(terms, pa.string())], names=["query", "item_id", "term"])

    numbered = items.select("item_id", "text").distinct().select(F.monotonically_increasing_id().alias("query"), "item_id", "text")
    numbered = materialise(numbered, "queries")  # numbers stay when a task is run again
    schema = numbered.select("query", "item_id", F.lit("").alias("term")).schema
    return materialise(numbered.mapInArrow(found, schema).distinct(), "query-terms")


def fields(arrays: dict[str, str]) -> str:
    return ", ".join(f"{name} binary" for name in arrays)


def packed(arrays: dict[str, str], values, **more: pa.Array) -> pa.RecordBatch:
    """A batch of one row of packed arrays, and more columns."""
    columns = [pa.array([np.asarray(x).astype(kind).tobytes()], pa.binary()) for kind, x in zip(arrays.values(), values)]
    return pa.RecordBatch.from_arrays([*more.values(), *columns], names=[*more, *arrays])


def unpacked(arrays: dict[str, str], batch: pa.RecordBatch, row: int) -> list[np.ndarray]:
    return [np.frombuffer(batch.column(name)[row].as_buffer(), kind) for name, kind in arrays.items()]


def by_row(stored: DataFrame) -> DataFrame:
    """A stored table whose rows go to Python one at a time, as each is some megabytes; in a session of its own, for these settings."""
    own = stored.sparkSession.newSession()
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    own.conf.set("spark.sql.parquet.columnarReaderBatchSize", "1")
    return own.read.schema(stored.schema).parquet(stored.stored_at)


def reread(stored: DataFrame, spark) -> DataFrame:
    """A stored table in another session."""
    return spark.read.schema(stored.schema).parquet(stored.stored_at)


def term_hashes(terms: list[str]) -> np.ndarray:
    """The hashes that ``Words`` gives to the terms."""
    raw = [t.encode() for t in terms]
    offsets = np.zeros(len(raw) + 1, np.int64)
    np.cumsum([len(r) for r in raw], out=offsets[1:])
    return Words(np.frombuffer(b"".join(raw), np.uint8), offsets, IN_TERM).hashes(lower=True)


def blocks(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """Blocks as rows of BLOCK_ARRAYS, n_docs, n_terms, terms and df, as a table.

    A block has documents by id, with the number of their terms of any kind, and
    for each term of the vocabulary (sorted hashes) its number of postings and
    the postings. terms and df say the numbers once more to Spark.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def row(ids: list, counts: list, postings: list) -> pa.RecordBatch:
        ids, n = np.concatenate(ids), np.concatenate(counts)
        doc, term, tf = (np.concatenate(x) for x in zip(*postings))
        order = np.argsort(ids, kind="stable")
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        doc = place[doc]
        by_term = np.lexsort((doc, term))
        terms, sizes = np.unique(term, return_counts=True)
        lists = {name: pa.array([x.astype(np.int32)], pa.list_(pa.int32())) for name, x in (("terms", terms), ("df", sizes))}
        totals = {name: pa.array([int(x)], pa.int64()) for name, x in (("n_docs", (n > 0).sum()), ("n_terms", n.sum()), ("first", ids.min()))}
        return packed(BLOCK_ARRAYS, (ids[order], n[order], terms, sizes, doc[by_term], tf[by_term]), **totals, **lists)

    def cut(batches):
        known = shared.value
        ids, counts, postings, n_docs, n_postings = [], [], [], 0, 0
        for batch in batches:
            for at, to, data, offsets in chunks(batch.column("text")):
                words = Words(data, offsets, IN_TERM)
                hashes = words.hashes(lower=True)
                slot = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                there = known[slot] == hashes
                pair, tf = np.unique(words.doc[there] * len(known) + slot[there], return_counts=True)
                ids.append(batch.column("doc_id").slice(at, to - at).fill_null(MAX_LONG).to_numpy())
                counts.append(words.counts)
                postings.append((n_docs + pair // len(known), pair % len(known), tf))
                n_docs, n_postings = n_docs + to - at, n_postings + len(pair)
                if n_docs >= BLOCK or n_postings >= BLOCK_POSTINGS:
                    yield row(ids, counts, postings)
                    ids, counts, postings, n_docs, n_postings = [], [], [], 0, 0
        if n_docs:
            yield row(ids, counts, postings)

    return materialise(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, "n_docs long, n_terms long, first long, terms array<int>, df array<int>, " + fields(BLOCK_ARRAYS)), "search-blocks")


def paired(terms: np.ndarray, df: np.ndarray) -> np.ndarray:
    """Pairs of a query's terms, the most frequent first; the last may have -1 for its second."""
    order = terms[np.lexsort((terms, -df[terms]))]
    if len(order) % 2:
        order = np.append(order, -1)
    pairs = order.reshape(-1, 2)
    return np.where((pairs[:, :1] < pairs[:, 1:]) | (pairs[:, 1:] < 0), pairs, pairs[:, ::-1])


def starts(sizes: np.ndarray) -> np.ndarray:
    out = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=out[1:])
    return out


def places(wanted: np.ndarray, there: np.ndarray) -> np.ndarray:
    """Place of each in a sorted array, -1 where it lacks."""
    if not len(there):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(there, wanted), len(there) - 1)
    return np.where(there[at] == wanted, at, -1)


def gains(tf: np.ndarray, n: np.ndarray, weight: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What a posting adds to a score: weight * ((10^9 tf) div (1000 tf + 8 m)), m = 10 + (90 n N) div L."""
    m = 100 - 90 + (90 * n * n_docs) // max(n_terms, 1)
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


def pair_lists(term: np.ndarray, at: np.ndarray, doc: np.ndarray, gain: np.ndarray, pairs: np.ndarray, n_docs: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of the pair, documents with both terms, what both add) of the pairs that meet in the block."""
    a, b = places(pairs[:, 0], term), places(pairs[:, 1], term)
    where, last = np.full(n_docs, -1, np.int64), -1
    for p in np.flatnonzero((a >= 0) & (b >= 0)).tolist():  # pairs are sorted, so a term's list is laid out once
        if a[p] != last:
            if last >= 0:
                where[doc[at[last] : at[last + 1]]] = -1
            last = a[p]
            where[doc[at[last] : at[last + 1]]] = np.arange(at[last], at[last + 1])
        s = slice(at[b[p]], at[b[p] + 1])
        first = where[doc[s]]
        both = first >= 0
        if both.any():
            yield p, doc[s][both], gain[first[both]] + gain[s][both]


def build(stored: DataFrame, pairs: np.ndarray, weight: np.ndarray, n_docs: int, n_terms: int) -> DataFrame:
    """The index: rows of INDEX_ARRAYS, term lists with what each posting adds, and pair lists, as a table."""
    shared = stored.sparkSession.sparkContext.broadcast((pairs, weight))
    draw = F.xxhash64("first", "n_docs", "n_terms")
    least = stored.select(F.min(draw)).first()[0]
    marked = by_row(stored).select(((F.pmod(draw, F.lit(SEED_STEP)) == 0) | (draw == F.lit(least).cast("long"))).alias("seed"), *BLOCK_ARRAYS)

    def lists(batches):
        pairs, weight = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                ids, n, term, size, doc, tf = unpacked(BLOCK_ARRAYS, batch, i)
                at = starts(size)
                gain = gains(tf.astype(np.int64), n[doc], np.repeat(weight[term], size), n_docs, n_terms)
                found, none = list(pair_lists(term, at, doc, gain, pairs, len(ids))), [np.zeros(0, np.int64)]
                of_pairs = [f[0] for f in found], [len(f[1]) for f in found], np.concatenate([f[1] for f in found] or none), np.concatenate([f[2] for f in found] or none)
                yield packed(INDEX_ARRAYS, (ids, term, size, doc, gain, *of_pairs), seed=batch.column("seed").slice(i, 1))

    return materialise(marked.mapInArrow(lists, "seed boolean, " + fields(INDEX_ARRAYS)), "search-index")


class Block:
    """One block's lists. Places: of terms and pairs in it, -1 for none. ``read`` counts the postings read."""

    def __init__(self, doc_ids, term, size, doc, gain, pair, pair_size, pair_doc, pair_gain):
        self.doc_ids, self.term, self.doc, self.gain, self.pair, self.pair_doc, self.pair_gain = doc_ids, term, doc, gain, pair, pair_doc, pair_gain
        self.at, self.pair_at = starts(size), starts(pair_size)
        top = lambda values, at: np.append(np.maximum.reduceat(values, at[:-1]) if len(at) > 1 else values[:0], 0)
        self.most, self.pair_most = top(gain, self.at), top(pair_gain, self.pair_at)  # the last, 0, is what place -1 reads
        self.read = 0

    def single(self, place: int) -> slice:
        return slice(self.at[place], self.at[place + 1])

    def added(self, place: int, docs: np.ndarray) -> np.ndarray:
        """What a term adds to each of docs."""
        s = self.single(place)
        found = places(docs, self.doc[s])
        self.read += len(docs)
        return np.where(found >= 0, self.gain[s][found], 0)

    def search(self, a: np.ndarray, b: np.ndarray, pair: np.ndarray, floor: int, k: int, joint: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) that hold the block's k best of at least floor.

        a, b, pair: the places of a query's pairs. Without joint, pairs are bounded by the sums of their terms' maxima.
        """
        bound = np.maximum(np.maximum(self.most[a], self.most[b]), self.pair_most[pair]) if joint else self.most[a] + self.most[b]
        order = np.argsort(bound, kind="stable")
        below = np.cumsum(bound[order])
        none = np.zeros(0, np.int64)
        if not len(order) or below[-1] < max(floor, 1):
            return none, none
        n_rest = int(np.searchsorted(below, floor, "left"))
        score = np.zeros(len(self.doc_ids), np.int64)
        for u in order[n_rest:].tolist():
            for place in (a[u], b[u]):
                if place >= 0:
                    s = self.single(place)
                    score[self.doc[s]] += self.gain[s]
                    self.read += s.stop - s.start
        rest = int(below[n_rest - 1]) if n_rest else 0
        docs = np.flatnonzero(score)
        floor = max(floor, kth_best(score[docs], k))
        docs = docs[score[docs] + rest >= floor]
        for u in order[:n_rest][::-1].tolist():
            if not len(docs):
                break
            rest -= int(bound[u])
            one, other = a[u], b[u]
            if one >= 0 and other >= 0:
                s = slice(self.pair_at[pair[u]], self.pair_at[pair[u] + 1]) if pair[u] >= 0 else slice(0, 0)
                found = places(docs, self.pair_doc[s])
                self.read += len(docs)
                in_both = found >= 0
                score[docs[in_both]] += self.pair_gain[s][found[in_both]]
                # the others hold one of the terms at most
                alone = docs[~in_both & (score[docs] + max(self.most[one], self.most[other]) + rest >= floor)]
                first = self.added(one, alone)
                score[alone] += first
                left = alone[first == 0]
                score[left] += self.added(other, left)
                docs = np.concatenate([docs[in_both], alone])
            elif one >= 0 or other >= 0:
                score[docs] += self.added(max(one, other), docs)
            floor = max(floor, kth_best(score[docs], k))
            docs = docs[score[docs] + rest >= floor]
        docs = docs[score[docs] >= max(floor, 1)]
        best = docs[np.lexsort((docs, -score[docs]))[:k]]
        return best, score[best]


def kth_best(scores: np.ndarray, k: int) -> int:
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0


def searched(index: DataFrame, queries: list[np.ndarray], pairs: np.ndarray, floors: np.ndarray, k: int) -> DataFrame:
    """query (its place among queries), doc_id and score: the k best, at least, of what each task read; as a table."""
    shared = index.sparkSession.sparkContext.broadcast((np.concatenate(queries), starts([len(q) for q in queries]), pairs, floors))

    def best(batches):
        numbers, cuts, pairs, floors = shared.value
        floors, found = floors.copy(), [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in range(len(cuts) - 1)]
        for batch in batches:
            for i in range(batch.num_rows):
                block = Block(*unpacked(INDEX_ARRAYS, batch, i))
                a, b = places(pairs[:, 0], block.term)[numbers], places(pairs[:, 1], block.term)[numbers]
                both = places(numbers, block.pair)
                for q, (lo, hi) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
                    docs, score = block.search(a[lo:hi], b[lo:hi], both[lo:hi], int(floors[q]), k)
                    if len(docs):
                        ids, scores = np.concatenate([found[q][0], block.doc_ids[docs]]), np.concatenate([found[q][1], score])
                        order = np.lexsort((ids, -scores))[:k]
                        found[q] = ids[order], scores[order]
                        if len(order) == k:
                            floors[q] = max(floors[q], scores[order[-1]])
        query = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
        if len(query):
            yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(np.concatenate([f[0] for f in found])), pa.array(np.concatenate([f[1] for f in found]))], names=["query", "doc_id", "score"])

    return materialise(index.drop("seed").mapInArrow(best, "query long, doc_id long, score long"), "search-best")


def batch_search(docs: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """query, doc_id, score of the k best documents, at least, of the queries in asked (query, term)."""
    spark = docs.sparkSession
    rows = asked.toArrow()  # BATCH_TERMS rows, but for a longer single item
    numbers, query = np.unique(rows["query"].to_numpy(), return_inverse=True)
    hashes = term_hashes(rows["term"].to_pylist())
    vocabulary, term = np.unique(hashes, return_inverse=True)
    found = blocks(docs, vocabulary)
    n_docs, n_terms = found.select(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    df = np.zeros(len(vocabulary), np.int64)
    counted = found.select(F.explode(F.arrays_zip("terms", "df")).alias("x")).groupBy("x.terms").agg(F.sum("x.df").alias("df")).toArrow()
    df[counted["terms"].to_numpy()] = counted["df"].to_numpy()
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) if x else 0 for x in df.tolist()], np.int64)
    units = [paired(t, df) for t in np.split(term[np.argsort(query, kind="stable")], np.cumsum(np.bincount(query))[:-1])]
    pairs, number = np.unique(np.concatenate(units), axis=0, return_inverse=True)
    queries = np.split(number.reshape(-1), np.cumsum([len(u) for u in units])[:-1])
    index = build(found, pairs, weight, n_docs, n_terms)
    release(found)
    rows = by_row(index)
    first = reread(searched(rows.filter("seed"), queries, pairs, np.zeros(len(queries), np.int64), k), spark)
    floors = np.zeros(len(queries), np.int64)
    kth = first.withColumn("at", F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc()))).filter(F.col("at") == k).toArrow()  # a row for each query
    floors[kth["query"].to_numpy()] = kth["score"].to_numpy()
    out = first.unionByName(reread(searched(rows.filter("NOT seed"), queries, pairs, floors, k), spark))
    release(index)
    names = spark.createDataFrame(pa.table({"query": np.arange(len(numbers)), "number": numbers}))
    return out.join(names, "query").select(F.col("number").alias("query"), "doc_id", "score")


def ranked(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """item_id, rank, doc_id and score of each item's k best documents."""
    asked = query_terms(items)
    n = max(1, -(-asked.count() // BATCH_TERMS))
    out = None
    for i in range(n):
        part = asked.filter(F.pmod(F.xxhash64("query"), F.lit(n)) == i).select("query", "term")
        if not part.isEmpty():
            best = batch_search(docs, part, k)
            out = best if out is None else out.unionByName(best)
    item = asked.select("query", "item_id").distinct()
    if out is None:
        out = item.select("query", F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).limit(0)
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "doc_id")
    top = out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return top.join(item, "query").select("item_id", "rank", F.when(F.col("doc_id") < MAX_LONG, F.col("doc_id")).alias("doc_id"), "score")


def op12_ranked_search(spark, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text"))


_TERMS_SQL = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: Every document of every item scored.
OP12_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS_SQL} AS terms FROM documents),
q AS (SELECT row_number() OVER () AS query, item_id, {_TERMS_SQL} AS terms FROM (SELECT DISTINCT item_id, text FROM benchmark)),
asked AS (SELECT DISTINCT query, item_id, unnest(terms) AS term FROM q),
totals AS (SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM d WHERE len(terms) > 0),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d) WHERE term IN (SELECT term FROM asked) GROUP BY r, term),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), totals),
m AS (SELECT r, doc_id, 100 - 90 + (90 * len(terms) * n_docs) // n_terms AS m FROM d, totals WHERE len(terms) > 0),
scored AS (SELECT a.query, a.item_id, m.doc_id, m.r, CAST(sum(w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * m.m))) AS BIGINT) AS score
  FROM asked a JOIN tf USING (term) JOIN w USING (term) JOIN m USING (r) GROUP BY a.query, a.item_id, m.doc_id, m.r),
placed AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM placed WHERE rank <= {K}"""
