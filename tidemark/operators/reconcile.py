"""Reconciliation of two stored relations by digests of buckets: what is equal is never read.

A relation is stored in hash buckets of its key, a folder for each, with two
levels of digests beside it: of each bucket and of its parts. Two relations are
compared by the buckets' digests first, then by those of the parts of unequal
buckets; only the rows of unequal parts are read and joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.ledger import LedgerSpec, top_version
from tidemark.operators.quality import row_hash

BUCKETS, PARTS = 64, 64


def _placed(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    spread = F.pmod(F.xxhash64(*key), F.lit(BUCKETS * PARTS)).cast("int")
    return rows.withColumn("_spread", spread).withColumns({"bucket": (F.col("_spread") / PARTS).cast("int"), "part": F.pmod("_spread", F.lit(PARTS))}).drop("_spread")


def _digest(columns: Sequence[Column]) -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), F.sum(row_hash(columns)).alias("digest")]


def store(rows: DataFrame, key: Sequence[str], values: Sequence[str], path: str) -> None:
    """Write key and values in buckets, and the digests of buckets and parts."""
    kept = _placed(rows.select(*key, *values), key)
    kept.repartition("bucket", "part").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/rows")
    stored = rows.sparkSession.read.parquet(f"{path}/rows")
    # the digest of a bucket is the sum of its parts'
    stored.groupBy("bucket", "part").agg(*_digest([F.col(c) for c in (*key, *values)])).coalesce(1).write.mode("overwrite").parquet(f"{path}/parts")
    rows.sparkSession.read.parquet(f"{path}/parts").groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("digest").alias("digest")).coalesce(1).write.mode("overwrite").parquet(f"{path}/buckets")


def _unequal(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    left, right = a.select(*on, F.struct("n", "digest").alias("_a")), b.select(*on, F.struct("n", "digest").alias("_b"))
    return left.join(right, list(on), "full_outer").filter(~F.col("_a").eqNullSafe(F.col("_b"))).select(*on)


def unequal_parts(spark: SparkSession, a: str, b: str) -> list[tuple[int, int]]:
    """The (bucket, part) whose digests differ: at most BUCKETS * PARTS pairs."""
    read = lambda path, what: spark.read.parquet(f"{path}/{what}")
    buckets = [r.bucket for r in _unequal(read(a, "buckets"), read(b, "buckets"), ["bucket"]).collect()]
    if not buckets:
        return []
    inside = lambda path: read(path, "parts").filter(F.col("bucket").isin(buckets))
    return sorted((r.bucket, r.part) for r in _unequal(inside(a), inside(b), ["bucket", "part"]).collect())


def rows_in(spark: SparkSession, path: str, parts: Sequence[tuple[int, int]]) -> DataFrame:
    """The rows of some parts; no folder of another bucket is read."""
    spread = [bucket * PARTS + part for bucket, part in parts]
    rows = spark.read.parquet(f"{path}/rows")
    return rows.filter(F.col("bucket").isin([bucket for bucket, _ in parts]) & (F.col("bucket") * PARTS + F.col("part")).isin(spread)).drop("bucket", "part")


def reconcile(spark: SparkSession, expected: str, observed: str, key: Sequence[str], values: Sequence[str]) -> DataFrame:
    """key and status (missing, extra, duplicate or changed) of what differs between two stored relations."""
    parts = unequal_parts(spark, expected, observed)
    group = lambda path, name: rows_in(spark, path, parts).groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(*values))).alias(name))
    both = group(expected, "_a").join(group(observed, "_b"), list(key), "full_outer")
    status = F.when(F.col("_b").isNull(), "missing").when(F.col("_a").isNull(), "extra").when(F.size("_b") > F.size("_a"), "duplicate").when(F.col("_a") != F.col("_b"), "changed")
    return both.withColumn("status", status).filter("status IS NOT NULL").select(*key, "status")


def pointer_faults(spark: SparkSession, ledger: DataFrame, current: DataFrame, spec: LedgerSpec, values: Sequence[str], scratch: str) -> DataFrame:
    """Where the current rows aren't the newest version of their key: key and status."""
    store(top_version(ledger.select(*spec.key, *dict.fromkeys([*spec.rank, *values])), spec), spec.key, values, f"{scratch}/newest")
    store(current, spec.key, values, f"{scratch}/current")
    return reconcile(spark, f"{scratch}/newest", f"{scratch}/current", spec.key, values)
