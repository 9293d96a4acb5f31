"""Columns of documents with the names that operators might use inside pass through unchanged."""

import pytest
from pyspark.sql import functions as F

from tidemark.llm import line_dedup, mixing, ngram_join
from tidemark.llm.common import as_struct

NAMES = "_rate _target _source _source_size _size _copies _copy _lines _ord _text_id _n_lines _n_removed _gone _first _doc _key row gone lines rate n_copies raw line col src pos".split()
ROWS = [(i, f"one two three\nfour five six\nseven eight {i}\nnine ten" if i % 3 else None, "ab"[i % 2]) for i in range(12)] + [(3, "a b c", None), (3, "a b c", None), (None, "x y z", "a")]


def documents(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, source string")
    return df.withColumns({n: F.lit(f"own {n}") for n in NAMES}).withColumn("with.dot", F.lit(5))


def own(df, *without):
    return [c for c in df.columns if c not in without]


@pytest.mark.parametrize(
    "operator",
    [
        mixing.emit,
        line_dedup.without_repeats,
        ngram_join.one_of_each,
        lambda d: line_dedup.dedup_lines(d, rule=line_dedup.winnowed_repeats).drop("n_lines", "n_removed"),
        lambda d: mixing.mix(d).drop("size", "source_size", "target"),
    ],
)
def test_own_columns_pass_unchanged(spark, operator):
    docs = documents(spark)
    out = operator(docs)
    assert set(out.columns) == set(docs.columns)
    rows = out.collect()
    kept = [n for n in NAMES if not (n in ("rate", "n_copies") and "rate" in out.columns and rows[0]["rate"] != "own rate")]
    assert len(kept) >= len(NAMES) - 2 and rows
    assert all(r[n] == f"own {n}" for r in rows for n in kept) and all(r["with.dot"] == 5 for r in rows)


def test_a_struct_gives_its_columns_back(spark):
    docs = documents(spark)
    assert sorted(docs.select(as_struct(docs)).select("row.*").collect(), key=str) == sorted(docs.collect(), key=str)
