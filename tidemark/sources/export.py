"""Writing ledgers, and snapshot exports in ordered chunks with manifests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.scratch import shared_path

CHUNK_ROWS = 250
CHUNK_BYTES = 262_144


def append_ledger(versions: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Append immutable versions; Spark's commit makes a batch visible as a whole."""
    versions.write.mode("append").partitionBy(*partition_by).parquet(path)


def numbered(rows: DataFrame, order: Sequence[str], partitions: int | None = None) -> DataFrame:
    """rows with position (from 0) in a total order.

    Rows are dealt out by ranges of the order, sorted in their range and written
    so, with their place in it; the ranges' sizes, a row each, give the offsets.
    No task has more than a range, whatever the order's columns hold.
    """
    path = shared_path(rows.sparkSession, "ordered")
    dealt = rows.repartitionByRange(*([partitions] if partitions else []), *order).sortWithinPartitions(*order)
    dealt.withColumn("_id", F.monotonically_increasing_id()).write.parquet(path)
    stored = rows.sparkSession.read.parquet(path).withColumns({"_range": F.shiftright("_id", 33), "_place": F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))})
    sizes = stored.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))  # over the ranges, not the rows
    offsets = sizes.select("_range", F.coalesce(before, F.lit(0)).alias("_offset"))
    return stored.join(offsets, "_range").withColumn("position", F.col("_offset") + F.col("_place")).drop("_id", "_range", "_place", "_offset")


def chunk_manifest(rows: DataFrame, order: Sequence[str], line: Column, size: int = CHUNK_ROWS) -> DataFrame:
    """A row for each chunk: rows, bytes, sha256 of its lines, first and last key, and whether it is over the byte bound."""
    placed = numbered(rows, order).withColumn("_line", line)
    key = F.concat_ws("|", *order)
    return placed.groupBy(F.floor(F.col("position") / size).alias("chunk_id")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("_line") + 1).alias("bytes"),
        F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "_line"))), lambda x: x["_line"]), "\n"), 256).alias("sha256"),
        F.min_by(key, "position").alias("first_key"), F.max_by(key, "position").alias("last_key"),
    ).withColumn("over_bytes", F.col("bytes") > CHUNK_BYTES)


#: A digest tree's node has so many children, and its root is so many levels above the leaves.
FAN_OUT, LEVELS = 1000, 3


def digest_tree(leaves: DataFrame, at: str, digest: str) -> DataFrame:
    """One row, digest: the root of a tree of sha256 over leaves numbered from 0; a node is the digest of its children's in order."""
    nodes = leaves.select(F.col(at).alias("_at"), F.col(digest).alias("digest"))
    for _ in range(LEVELS):
        children = F.array_sort(F.collect_list(F.struct("_at", "digest")))
        nodes = nodes.groupBy(F.floor(F.col("_at") / FAN_OUT).alias("_node")).agg(F.sha2(F.array_join(F.transform(children, lambda c: c["digest"]), ","), 256).alias("digest")).withColumnRenamed("_node", "_at")
    return nodes.select("digest")


def export_manifest(chunks: DataFrame) -> DataFrame:
    """The dataset's totals, key range and revision, the root of the tree of its chunks' digests."""
    totals = chunks.agg(F.count(F.lit(1)).alias("chunks"), F.sum("rows").alias("rows"), F.min_by("first_key", "chunk_id").alias("first_key"), F.max_by("last_key", "chunk_id").alias("last_key"))
    return totals.crossJoin(digest_tree(chunks, "chunk_id", "sha256").select(F.col("digest").alias("revision")))  # one row each
