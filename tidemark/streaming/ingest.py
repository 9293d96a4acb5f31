"""Streaming twins of the ingest path."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.ledger import LedgerSpec, append_changes, changes_against, number_versions, top_version
from tidemark.sources.scratch import delete, exists

#: Hash buckets of the state of a ledger's keys.
BUCKETS = 64


def replay_dedupe(stream: DataFrame, identity: Sequence[str], at: str, delay: str = "7 days") -> DataFrame:
    """Each identity once, as long as its replays come within the watermark."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark(list(identity))


def bucket_of(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def state_of(spark: SparkSession, path: str, before: int | None = None) -> dict[int, int]:
    """For each bucket of keys the batch (below before) that wrote its state last."""
    if not exists(spark, f"{path}/_commits"):
        return {}
    commits = spark.read.schema("bucket int, batch long").parquet(f"{path}/_commits")
    if before is not None:
        commits = commits.filter(F.col("batch") < before)
    return {r.bucket: r.batch for r in commits.groupBy("bucket").agg(F.max("batch").alias("batch")).collect()}  # a row for each bucket


def read_state(spark: SparkSession, path: str, latest: dict[int, int], schema) -> DataFrame:
    """The last version of every key of the buckets in latest; no other bucket's files are read."""
    folders = [f"{path}/_state/batch={batch}/bucket={bucket}" for bucket, batch in sorted(latest.items())]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def ledger_appender(spec: LedgerSpec, path: str, order: Sequence[str], buckets: int = BUCKETS):
    """A function for foreachBatch: appends what a micro-batch changes to the ledger at path.

    The last version of every key is kept beside the ledger, in hash buckets of
    keys (``_state``); a batch reads and rewrites the buckets of its own keys
    only, whatever the length of the ledger. It writes its versions and the
    buckets under its own number, and then the list of the buckets
    (``_commits``); so its replay after a failure starts from the same state and
    replaces what it wrote before. The states that a batch's predecessor has
    replaced are deleted.

    Within a batch all changes of a key count; the first is compared with the
    key's last version. Versions that come late are appended, and don't become
    current, since that is a matter of rank.
    """

    def append(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        folder, top = f"{path}/batch={number}", LedgerSpec(key=spec.key, rank=("sequence",))
        own = [r.b for r in batch.select(bucket_of(spec.key, buckets).alias("b")).distinct().collect()]  # a row for each bucket
        latest = state_of(spark, path, number)
        changed = append_changes(batch, spec, order).drop("supersedes").withColumn("sequence", F.lit(0).cast("long"))
        state = read_state(spark, path, {b: latest[b] for b in own if b in latest}, changed.schema)
        first = top_version(changed, spec, first=True)
        repeated = first.join(changes_against(state, first.drop("sequence"), spec).select(*spec.key, *order), [*spec.key, *order], "left_anti")
        new = changed.drop("sequence").join(repeated.select(*spec.key, *order), [*spec.key, *order], "left_anti")
        numbered = number_versions(new, spec.key, order).join(state.select(*spec.key, F.col("sequence").alias("_top")), list(spec.key), "left")
        sequence = F.col("sequence").cast("long") + F.coalesce("_top", F.lit(0))
        out = numbered.withColumn("sequence", sequence).withColumn("supersedes", F.when(F.col("sequence") > 1, F.col("sequence") - 1)).drop("_top")
        out.write.mode("overwrite").parquet(folder)
        appended = spark.read.schema(out.schema).parquet(folder).select(*changed.columns)
        kept = top_version(state.select(*changed.columns).unionByName(appended), top)
        delete(spark, f"{path}/_commits/batch={number}")
        kept.withColumn("bucket", bucket_of(spec.key, buckets)).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/_state/batch={number}")
        spark.createDataFrame([(b,) for b in own], "bucket int").coalesce(1).write.mode("overwrite").parquet(f"{path}/_commits/batch={number}")
        before = state_of(spark, path, number - 1)
        for bucket, batch_number in before.items():
            if latest.get(bucket, batch_number) != batch_number:
                delete(spark, f"{path}/_state/batch={batch_number}/bucket={bucket}")

    return append


def current_versions(spark: SparkSession, path: str, spec: LedgerSpec, schema, pointer: Sequence[str] | None = None) -> DataFrame:
    """The current version of every key from the state alone: the last by rank of the versions of a pointer's keys.

    pointer is the part of the key that has one current version (such as the key without its vintage).
    """
    rows = read_state(spark, path, state_of(spark, path), schema)
    return top_version(rows, LedgerSpec(key=tuple(pointer or spec.key), rank=(*spec.rank, "sequence")))


def run_ledger_stream(stream: DataFrame, spec: LedgerSpec, path: str, order: Sequence[str], checkpoint: str) -> StreamingQuery:
    """Start appending a stream to the ledger at path, everything available now."""
    return stream.writeStream.foreachBatch(ledger_appender(spec, path, order)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
