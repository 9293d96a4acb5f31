"""Rolling regressions and recursive indicators against each window and each step by hand."""

import datetime
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import rolling, scans


@pytest.mark.parametrize("intercept", [True, False])
def test_windows_of_several_regressors_equal_a_solve_of_each(spark, intercept):
    rng = np.random.default_rng(3)
    rows = []
    for g in (9007199254740993, None):
        x = rng.normal(size=(60, 3)) * [1, 1000, 1e-3] + [5, 0, 1]
        x[20:32, 1] = 2 * x[20:32, 0]  # dependent within a window
        y = x @ [1.0, -2.0, 300.0] + rng.normal(size=60) + 4
        y[40:52] = 7.0 if g is None else y[40:52]
        for i in range(60):
            rows.append((g, i, None if i in (3, 4, 45) else float(y[i]), *[None if (i, j) == (10, 1) else float(x[i, j]) for j in range(3)]))
    df = spark.createDataFrame(rows, "g long, t int, y double, a double, b double, c double")
    got = {(r.g, r.t): r for r in rolling.rolling_ols(df, 9, ["g"], ["t"], "y", ["a", "b", "c"], intercept).collect()}
    assert len(got) == 2 * 52
    seen = set()
    for g in (9007199254740993, None):
        mine = [r for r in rows if r[0] == g]
        for i in range(8, 60):
            window = np.array([r[2:] for r in mine[i - 8 : i + 1] if None not in r[2:]], float)
            r = got[(g, i)]
            design = np.column_stack([np.ones(len(window)), window[:, 1:]]) if intercept else window[:, 1:]
            assert (r.sample_size, r.excluded) == (len(window), 9 - len(window))
            if len(window) <= 3 + intercept:
                want = "insufficient_degrees_of_freedom"
            else:
                want = "singular_design" if np.linalg.matrix_rank(design / np.abs(design).max(0)) < design.shape[1] else "established"
            assert r.status == want
            seen.add(want)
            if want == "established":
                beta, *_ = np.linalg.lstsq(design, window[:, 0], rcond=None)
                assert np.allclose(r.coefficients, beta, rtol=1e-5, atol=1e-6)
                assert (r.warning == "constant_target") == (np.ptp(window[:, 0]) == 0) == (r.r_squared is None)
    assert seen >= {"established", "singular_design"}


def test_rolling_correlation_of_complete_pairs(spark):
    rng = random.Random(1)
    rows = [("k", i, None if i % 7 == 0 else rng.random(), 1.0 if 20 <= i < 30 else rng.random()) for i in range(40)]
    got = {r.t: r for r in rolling.rolling_correlation(spark.createDataFrame(rows, "k string, t int, x double, y double"), 5, ["k"], ["t"]).collect()}
    assert sorted(got) == list(range(4, 40))
    for i, r in got.items():
        window = [w[2:] for w in rows[i - 4 : i + 1] if w[2] is not None]
        x, y = np.array(window).T
        if np.ptp(y) == 0:
            assert r.status == "not_established"
        else:
            assert r.pairs == len(window) and abs(r.correlation - np.corrcoef(x, y)[0, 1]) < 1e-9


def by_steps(closes, n=14, fast=12, slow=26, signal=9):
    out, f, s, line, up, down, before = [], None, None, 0.0, None, None, None
    for c in closes:
        f = c if f is None else f + (c - f) * 2 / (fast + 1)
        s = c if s is None else s + (c - s) * 2 / (slow + 1)
        line += (f - s - line) * 2 / (signal + 1)
        if before is not None:
            g, d = max(c - before, 0), max(before - c, 0)
            up, down = (g, d) if up is None else (up + (g - up) / n, down + (d - down) / n)
        out.append((f, s, f - s, line, f - s - line, None if up is None or up + down == 0 else 100 * up / (up + down)))
        before = c
    return out


@pytest.mark.parametrize("chunk_days", [1, 7, 64, 100000])
def test_every_bar_of_every_chunk(spark, chunk_days):
    rng = random.Random(6)
    start, rows = datetime.date(2023, 12, 1), []
    for symbol, size in (("long", 400), ("short", 3), ("one", 1), ("flat", 50), (None, 30)):
        day, price = start, 100.0
        for _ in range(size):
            day += datetime.timedelta(rng.choice([1, 1, 1, 3, 40]))
            price = price if symbol == "flat" else max(1.0, price + rng.gauss(0, 3))
            rows.append((symbol, day, price))
    shuffled = rows[:]
    rng.shuffle(shuffled)
    out = scans.recursive_indicators(spark.createDataFrame(shuffled, "symbol string, trade_date date, close double"), chunk_days=chunk_days).collect()
    assert len(out) == len(rows)
    for symbol in {r[0] for r in rows}:
        got = [r[2:] for r in sorted((r for r in out if r.symbol == symbol), key=lambda r: r.trade_date)]
        want = by_steps([r[2] for r in rows if r[0] == symbol])
        assert all(all((a is None) == (b is None) and (a is None or abs(a - b) < 1e-9 * max(1, abs(b))) for a, b in zip(x, y)) for x, y in zip(got, want)), symbol


def test_no_task_sees_all_bars_of_a_symbol(spark):
    """A symbol's chunks lie in many partitions before they are unfolded."""
    bars = spark.range(3000).select(F.lit("hot").alias("symbol"), F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int")).alias("trade_date"), (F.col("id") % 17).cast("double").alias("close"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = scans.recursive_indicators(bars, chunk_days=16)
        sizes = [r["count"] for r in out.withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 3000 and len(sizes) >= 3 and max(sizes) < 1500


def test_empty_table(spark):
    assert scans.recursive_indicators(spark.createDataFrame([], "symbol string, trade_date date, close double")).collect() == []
