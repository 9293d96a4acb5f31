"""Reconciliation by digests and correlations of all pairs, against plain joins."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.test_postings import scan_metric
from tidemark.operators import allpairs, ledger, reconcile, series

VALUES = ["v", "w"]


def relation(spark, rows):
    return spark.createDataFrame(rows, "k string, d int, v double, w string")


def test_differences_of_every_kind(spark, tmp_path):
    rows = [(f"k{i}", i % 7, float(i), None if i % 5 == 0 else "x") for i in range(2000)]
    other = [r for r in rows if r[0] not in ("k3", "k4")] + [("new", 1, 1.0, "x"), rows[10]]
    other = [(k, d, 99.0 if k == "k20" else v, None if k == "k21" else w) for k, d, v, w in other] + [(None, 1, None, None)]
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    reconcile.store(relation(spark, rows), ["k", "d"], VALUES, a)
    reconcile.store(relation(spark, other), ["k", "d"], VALUES, b)
    got = {(r.k, r.status) for r in reconcile.reconcile(spark, a, b, ["k", "d"], VALUES).collect()}
    assert got == {("k3", "missing"), ("k4", "missing"), ("new", "extra"), ("k10", "duplicate"), ("k20", "changed"), ("k21", "changed"), (None, "extra")}
    assert reconcile.reconcile(spark, a, a, ["k", "d"], VALUES).collect() == []


def test_equal_buckets_are_not_read(spark, tmp_path):
    rows = [(f"k{i}", 0, float(i), "x") for i in range(5000)]
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    reconcile.store(relation(spark, rows), ["k"], ["v"], a)
    reconcile.store(relation(spark, [(k, d, v + (k == "k77"), w) for k, d, v, w in rows]), ["k"], ["v"], b)
    parts = reconcile.unequal_parts(spark, a, b)
    assert len(parts) == 1
    read = reconcile.rows_in(spark, a, parts)
    few = read.count()
    assert "k77" in {r.k for r in read.collect()} and few < 20
    folders = {f.split("/bucket=")[1].split("/")[0] for f in read.select(F.input_file_name().alias("f")).distinct().toPandas()["f"]}
    assert folders == {str(parts[0][0])}
    assert scan_metric(reconcile.rows_in(spark, a, parts).select("k"), "numFiles", "k#") < len(spark.read.parquet(f"{a}/rows").inputFiles()) / 8


def test_pointers_at_older_versions_are_told(spark, tmp_path):
    spec = ledger.LedgerSpec(key=("k",), rank=("seq",))
    versions = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.0), ("b", 1, 5.0), ("c", 1, 7.0), ("c", 2, 7.0)], "k string, seq int, v double")
    current = spark.createDataFrame([("a", 1, 1.0), ("b", 1, 5.0), ("d", 1, 0.0)], "k string, seq int, v double")
    got = {(r.k, r.status) for r in reconcile.pointer_faults(spark, versions, current, spec, ["seq", "v"], str(tmp_path)).collect()}
    assert got == {("a", "changed"), ("c", "missing"), ("d", "extra")}


@pytest.mark.parametrize("blocks", [(1, 1), (3, 5)])
def test_all_pairs_equal_the_join(spark, blocks):
    rng = random.Random(8)
    rows = []
    for s in range(11):
        for p in range(60):
            if rng.random() < 0.8:
                value = None if rng.random() < 0.1 else 1e9 + (3.0 if s == 4 else rng.random() * 10 + p * (s % 3))
                rows.append((f"s{s}", p, value))
    rows += [("lonely", 999, 1.0), ("short", 1, 1.0), ("short", 2, 2.0)]
    df = spark.createDataFrame(rows, "series_id string, period_start int, value double")
    got = {(r.a, r.b): r for r in allpairs.all_correlations(df, series_blocks=blocks[0], period_blocks=blocks[1]).collect()}
    a, b = df.select("period_start", F.col("series_id").alias("a"), F.col("value").alias("x")), df.select("period_start", F.col("series_id").alias("b"), F.col("value").alias("y"))
    want = {(r.a, r.b): r for r in series.correlation(a.join(b, "period_start").filter("a < b"), ["a", "b"]).collect()}
    assert set(got) == set(want)
    for k, w in want.items():
        g = got[k]
        assert (g.pairs, g.excluded) == (w.pairs, w.excluded)
        if "s4" in k or g.correlation is None:
            assert g.correlation is None
        else:
            assert abs(g.correlation - w.correlation) < 1e-6, (k, g, w)
    assert np.isfinite([g.correlation for g in got.values() if g.correlation is not None]).all()


def test_empty(spark):
    assert allpairs.all_correlations(spark.createDataFrame([], "series_id string, period_start int, value double")).collect() == []
