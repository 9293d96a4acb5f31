"""The corpus pipeline: five of the corpus operators in a row, over all documents.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
its result as Parquet in the shared folder and reads it again as the next one's
docs, so a lost executor never costs more than one stage. All but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import byte_bpe, line_dedup, mixing, ngram_join, quality_classifier
from tidemark.llm.common import materialise, table


def _with_length(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones, accepts."""
    return quality_classifier.accepted(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines go, and documents of which nothing is left."""
    return _with_length(line_dedup.without_repeats(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return ngram_join.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's rate takes it."""
    return mixing.emit(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of the ids and of the decoded bytes."""
    return byte_bpe.encode(docs, *byte_bpe.public_vocabulary(), keep=("ids",))


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources", mix_sources),
    ("byte-level BPE", tokenize),
]

#: The classifier's learned scores can't be written as SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the table of documents to token ids."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
