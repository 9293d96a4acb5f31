"""Mixing sources to target weights, with DataFrame functions only.

Tokens are summed per source, targets follow from the weights (capped at
``max_repeat`` passes over a source, the excess reshared among the others by
weight), and every document is then taken floor(rate) times plus once more if
a hash of its id, used as a uniform draw, falls below the rate's fraction.

Scale: one partial aggregation to a row per source; the plan of rates is a
window over that small table, which is written to the shared folder, counted,
and broadcast only if it has at most ``BROADCAST_SOURCES`` rows; then the
documents themselves are never shuffled.

Defined cases: a null text has no words and so adds nothing; a null source is
a source of its own and comes last; repeated rows are repeated draws of the
same outcome (the draw depends on doc_id alone), a null doc_id draws like any
other value; a source without words has target 0 and rate 0; an empty table
gives an empty mix. Extra columns pass through ``mix`` unless they bear one of
its result names, which it then replaces.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import as_struct, hash52, materialise, table, word_count

WEIGHTS = (5, 2, 1)
SHARE_PERCENT = 150
MAX_REPEAT = 2
SEED = "mix"
#: A plan of more sources than this is joined by shuffle instead of broadcast.
BROADCAST_SOURCES = 50_000


def source_plan(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share_percent: int = SHARE_PERCENT, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """One row per source with source_size, target and rate; sizes has source and size.

    The capped sources are those whose cap per weight lies below the level that
    the rest would get; sorted by cap per weight, that is one running sum
    instead of repeated rounds of resharing.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = per_source.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int")))
    everything = Window.partitionBy()
    lighter = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    levelled = (
        weighed.withColumn("cap", F.col("source_size") * max_repeat)
        .withColumn("wanted", F.sum("source_size").over(everything) * share_percent / F.lit(100.0))
        .withColumn("level", (F.col("wanted") - F.coalesce(F.sum("cap").over(lighter), F.lit(0))) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(lighter), F.lit(0))))
        .withColumn("is_capped", F.col("cap") / F.col("weight") < F.col("level"))
    )
    final_level = F.max(F.when(~F.col("is_capped"), F.col("level"))).over(everything)
    target = F.when(F.col("is_capped"), F.col("cap").cast("double")).otherwise(final_level * F.col("weight"))
    return (
        levelled.withColumn("target", F.least(target, F.col("cap").cast("double")))
        .withColumn("rate", F.coalesce(F.try_divide(F.col("target"), F.col("source_size").cast("double")), F.lit(0.0)))
        .select("source", "source_size", "target", "rate", "weight", "n_docs")
    )


def copies(doc_id: Column, rate: Column, seed: str = SEED) -> Column:
    """floor(rate) plus one Bernoulli copy drawn from a hash of the id."""
    whole = F.floor(rate)
    return (whole + (hash52(seed, doc_id) < (rate - whole) * F.lit(float(2**52))).cast("int")).cast("long")


def rated(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share_percent: int = SHARE_PERCENT, max_repeat: int = MAX_REPEAT, seed: str = SEED) -> DataFrame:
    """row (docs' columns, whatever their names, as one struct), size, source_size, target, rate and n_copies."""
    sized = docs.select(as_struct(docs)).withColumn("size", word_count(F.col("row.text")))
    plan = source_plan(sized.select("row.source", "size"), weights, share_percent, max_repeat)
    plan = materialise(plan.select("source", "source_size", "target", "rate"), "source-plan")
    if plan.count() <= BROADCAST_SOURCES:
        plan = F.broadcast(plan)
    return sized.join(plan, F.col("row.source").eqNullSafe(F.col("source")), "left").drop("source").withColumn("n_copies", copies(F.col("row.doc_id"), F.col("rate"), seed))


def mix(docs: DataFrame, **options) -> DataFrame:
    """docs with size, source_size, target, rate and n_copies; a row with n_copies 0 is left out of the mix."""
    new = ["size", "source_size", "target", "rate", "n_copies"]
    return rated(docs.drop(*new), **options).select("row.*", *new)


def emit(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: each row of docs as often as the mix takes it, with its own columns only."""
    mixed = rated(docs, **options).filter("n_copies > 0")
    return mixed.select("row", F.explode(F.sequence(F.lit(1), F.col("n_copies").cast("int")))).select("row.*")


def op8_mixing(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("n_copies")).alias("taken"), F.col("n_copies").alias("n_copies"))


#: DuckDB's words of a text: runs between ASCII gaps.
SQL_WORDS = r"len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> ''))"

MIX_SQL = f"""
sized AS (SELECT *, CAST({SQL_WORDS} AS BIGINT) AS size FROM {{docs}}),
per_source AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, CAST([5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS BIGINT) AS weight, source_size * 2 AS cap FROM per_source),
levelled AS (SELECT *, (CAST(sum(source_size) OVER () * 150 AS DOUBLE) / 100.0 - coalesce(sum(cap) OVER lighter, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER lighter, 0)) AS level
  FROM weighed WINDOW lighter AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
plan AS (SELECT source, source_size, least(CASE WHEN cap / weight < level THEN CAST(cap AS DOUBLE) ELSE max(CASE WHEN NOT cap / weight < level THEN level END) OVER () * weight END, CAST(cap AS DOUBLE)) AS target FROM levelled),
rated AS (SELECT *, CASE WHEN source_size = 0 THEN 0.0 ELSE target / CAST(source_size AS DOUBLE) END AS rate FROM plan),
mixed AS (SELECT s.*, r.source_size, r.target, CAST(floor(r.rate) AS BIGINT)
    + CASE WHEN CAST('0x' || substr(md5('mix:' || coalesce(CAST(s.doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) < (r.rate - floor(r.rate)) * 4503599627370496.0 THEN 1 ELSE 0 END AS n_copies
  FROM sized s JOIN rated r ON s.source IS NOT DISTINCT FROM r.source)"""
OP8_SQL = "WITH " + MIX_SQL.format(docs="documents") + " SELECT doc_id, size, source_size, target, size * n_copies AS taken, n_copies FROM mixed"
