"""Quality rules: base counts and a hashed n-gram log-likelihood ratio.

Words and pairs of words are hashed into ``BUCKETS`` buckets. The trusted
target is the documents that ``labels`` marks with quality 1; the raw corpus is
all documents. A document's score is the mean, over its n-grams, of the
logarithm of the target's smoothed probability over the corpus's. It is kept if
it passes the base rules and the score is at least ``THRESHOLD``.

Scale: two passes over the texts in Arrow batches. The first sums a fixed
number of buckets for each task, so what is shuffled and collected is bounded
by ``BUCKETS`` rows; the trusted ids are broadcast if they are at most
``BROADCAST_IDS``, else joined by shuffle. The second scores every whole text.

Defined cases: a null or blank text has no words, fails the base rules and has
a null score; a document in ``labels`` more than once is trusted if any row
says so; a null doc_id is never trusted; without trusted documents there is no
verdict and the base rules decide; repeated rows give equal results; an empty
table gives no rows; other columns are not used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import table
from tidemark.llm.tokens import IN_WORD, Words, chain, chunks

BUCKETS = 1 << 16
PRIOR = 1.0
THRESHOLD = -0.1
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
BROADCAST_IDS = 1_000_000
SYMBOLS = b"#*$%&|<>"

_IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
_IS_CHAR = (np.arange(256) & 0xC0) != 0x80


def per_document(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags are set between offsets."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def ngram_buckets(words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and document of every word and every pair of words inside a document."""
    pairs = chain(hashes, 2)
    inside = words.doc[1:] == words.doc[:-1]
    shift = np.uint64(64 - BUCKETS.bit_length() + 1)
    return np.concatenate([hashes >> shift, pairs[inside] >> shift]).astype(np.int64), np.concatenate([words.doc, words.doc[1:][inside]])


def repeated_words(hashes: np.ndarray) -> int:
    """Words of one document in windows of three that occur twice or more in it."""
    if len(hashes) < 4:
        return 0
    windows = chain(hashes, 3)
    order = np.argsort(windows)
    equal = windows[order][1:] == windows[order][:-1]
    if not equal.any():
        return 0
    again = np.zeros(len(windows), bool)
    again[order[1:][equal]] = again[order[:-1][equal]] = True
    covered = np.zeros(len(hashes), bool)
    for k in range(3):
        covered[k : k + len(windows)] |= again
    return int(covered.sum())


def repeated_line_count(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def base_counts(column: pa.Array) -> Iterator[tuple[Words, np.ndarray, dict[str, np.ndarray]]]:
    """For each piece of a column its words, their hashes and the base counts of its documents."""
    for _, _, data, offsets in chunks(column):
        words = Words(data, offsets)
        hashes = words.hashes(lower=False)
        first, at = words.first.tolist(), offsets.tolist()
        yield words, hashes, {
            "n_words": words.counts,
            "word_chars": per_document(IN_WORD[data] & _IS_CHAR[data], offsets),
            "n_symbols": per_document(_IS_SYMBOL[data], offsets),
            "n_dup_lines": np.array([repeated_line_count(data[a:b].tobytes()) for a, b in zip(at, at[1:])], np.int64),
            "n_repeat_words": np.array([repeated_words(hashes[a:b]) for a, b in zip(first, first[1:])], np.int64),
        }


def bucket_counts(docs: DataFrame, trusted: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """n-gram counts by bucket of the trusted target and of the raw corpus."""
    ids = trusted.select(F.col("doc_id").alias("_trusted")).distinct()
    if trusted.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    marked = docs.select("doc_id", "text").join(ids, F.col("doc_id") == F.col("_trusted"), "left").select("text", F.col("_trusted").isNotNull().alias("is_target"))

    def counted(batches):
        target, raw = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            is_target = batch.column("is_target").to_numpy(zero_copy_only=False)
            for at, to, data, offsets in chunks(batch.column("text")):
                words = Words(data, offsets)
                bucket, doc = ngram_buckets(words, words.hashes(lower=False))
                raw += np.bincount(bucket, minlength=BUCKETS)
                target += np.bincount(bucket[is_target[at:to][doc]], minlength=BUCKETS)
        there = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (there, target[there], raw[there])], names=["bucket", "target", "raw"])

    sums = marked.mapInArrow(counted, "bucket long, target long, raw long").groupBy("bucket").agg(F.sum("target").alias("target"), F.sum("raw").alias("raw")).toArrow()
    target, raw = np.zeros(BUCKETS), np.zeros(BUCKETS)
    target[sums["bucket"].to_numpy()], raw[sums["bucket"].to_numpy()] = sums["target"].to_numpy(), sums["raw"].to_numpy()
    return target, raw


def log_ratios(target: np.ndarray, raw: np.ndarray) -> np.ndarray | None:
    """log of target over corpus probability by bucket; None without a target."""
    if not target.sum():
        return None
    smooth = lambda c: (c + PRIOR) / (c.sum() + PRIOR * BUCKETS)
    return np.log(smooth(target)) - np.log(smooth(raw))


def score_documents(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, the base counts, base_failed, llr (mean log ratio) and kept for every document."""
    shared = docs.sparkSession.sparkContext.broadcast(log_ratios(*bucket_counts(docs, trusted)))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def scored(batches):
        ratios = shared.value
        for batch in batches:
            found, llr = [], []
            for words, hashes, counts in base_counts(batch.column("text")):
                found.append(counts)
                bucket, doc = ngram_buckets(words, hashes)
                n = np.bincount(doc, minlength=len(words.counts))
                total = np.bincount(doc, weights=ratios[bucket] if ratios is not None else None, minlength=len(words.counts))
                llr.append(np.where((n > 0) & (ratios is not None), total / np.maximum(n, 1), np.nan))
            if found:
                score = np.concatenate(llr)
                columns = [np.concatenate([f[x] for f in found]) for x in names]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c) for c in columns], pa.array(score, mask=np.isnan(score))], names=["doc_id", *names, "llr"])

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scored, "doc_id long, " + ", ".join(f"{n} long" for n in names) + ", llr double")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("llr") >= threshold, F.lit(True)))


def op6_quality_rules(spark, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    return score_documents(table(spark, sf_dir, "documents"), trusted)
