"""Queries of rolling regressions and correlations (W3, D10), recursive indicators at every bar (D16), all pairs (X1) and reconciliation (J3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import reconcile as Q
from tidemark.operators import rolling as R
from tidemark.operators import scans
from tidemark.operators.allpairs import all_correlations
from tidemark.plans import bindings as B
from tidemark.plans.analytics import _PAIRS, WIDE, pairs, rounded, wide
from tidemark.plans.ledgers import SPEC
from tidemark.plans.registry import ORACLE_SQL, query
from tidemark.sources.scratch import shared_path

_N = 9
_MASKED = f"WITH {WIDE}, v AS (SELECT period_start, click IS NOT NULL AND error IS NOT NULL AND view IS NOT NULL AS whole, click, error, view FROM wide), m AS (SELECT period_start, CASE WHEN whole THEN click END AS y, CASE WHEN whole THEN error END AS a, CASE WHEN whole THEN view END AS b FROM v), "
_FRAME = f"WINDOW w AS (ORDER BY period_start ROWS BETWEEN {_N - 1} PRECEDING AND CURRENT ROW)"


def _two(least: int, intercept: bool) -> str:
    """The normal equations of two regressors by Cramer's rule."""
    if intercept:
        sums = "covar_pop(y, a) OVER w AS ya, covar_pop(y, b) OVER w AS yb, covar_pop(a, b) OVER w AS ab, var_pop(a) OVER w AS aa, var_pop(b) OVER w AS bb, avg(y) OVER w AS my, avg(a) OVER w AS ma, avg(b) OVER w AS mb"
    else:
        sums = "avg(y * a) OVER w AS ya, avg(y * b) OVER w AS yb, avg(a * b) OVER w AS ab, avg(a * a) OVER w AS aa, avg(b * b) OVER w AS bb, 0 AS my, 0 AS ma, 0 AS mb"
    first = "round(c.my - s1 * c.ma - s2 * c.mb, 2) AS intercept, " if intercept else ""
    return (
        _MASKED + f"s AS (SELECT period_start, count(*) OVER w AS n, count(y) OVER w AS k, {sums} FROM m {_FRAME}), c AS (SELECT *, (ya * bb - yb * ab) / (aa * bb - ab * ab) AS s1, (yb * aa - ya * ab) / (aa * bb - ab * ab) AS s2 FROM s WHERE n = {_N} AND k > {least}) "
        f"SELECT s.period_start, s.k AS sample_size, {_N} - s.k AS excluded, CASE WHEN s.k > {least} THEN 'established' ELSE 'insufficient_degrees_of_freedom' END AS status, {first}round(s1, 4) AS error, round(s2, 4) AS \"view\" FROM s LEFT JOIN c USING (period_start) WHERE s.n = {_N}"
    )


def _rolling(spark, sf_dir, intercept: bool):
    rows = wide(spark, sf_dir).withColumn("all", F.lit(1))
    return R.rolling_ols(rows, _N, ["all"], ["period_start"], "click", ["error", "view"], intercept)


@query("W3_rolling_regression_two", _two(3, True))
def rolling_two(spark, sf_dir):
    """Clicks on errors and views over nine days."""
    at = lambda i: F.get("coefficients", F.lit(i))
    return _rolling(spark, sf_dir, True).select("period_start", "sample_size", "excluded", "status", F.round(at(0), 2).alias("intercept"), F.round(at(1), 4).alias("error"), F.round(at(2), 4).alias("view"))


@query("W3_rolling_regression_through_origin", _two(2, False))
def rolling_origin(spark, sf_dir):
    at = lambda i: F.get("coefficients", F.lit(i))
    return _rolling(spark, sf_dir, False).select("period_start", "sample_size", "excluded", "status", F.round(at(0), 4).alias("error"), F.round(at(1), 4).alias("view"))


@query(
    "D10_correlation_rolling",
    f"WITH {_PAIRS}, m AS (SELECT a, b, period_start, CASE WHEN y IS NOT NULL THEN x END AS x, CASE WHEN x IS NOT NULL THEN y END AS y FROM pairs), s AS (SELECT a, b, period_start, count(*) OVER w AS n, count(x) OVER w AS pairs, covar_pop(x, y) OVER w AS c, stddev_pop(x) OVER w AS sx, stddev_pop(y) OVER w AS sy FROM m WINDOW w AS (PARTITION BY a, b ORDER BY period_start ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)) "
    "SELECT a, b, period_start, pairs, CASE WHEN pairs >= 2 AND sx > 0 AND sy > 0 THEN round(c / (sx * sy), 6) END AS correlation, CASE WHEN pairs >= 2 AND sx > 0 AND sy > 0 THEN 'established' ELSE 'not_established' END AS status FROM s WHERE n = 7",
)
def rolling_correlation(spark, sf_dir):
    """Correlation over seven days of each pair of series."""
    return rounded(R.rolling_correlation(pairs(spark, sf_dir), 7, ["a", "b"], ["period_start"]), "correlation")


@query(
    "D16_indicators_every_bar",
    f"WITH RECURSIVE {B.BARS}, n AS (SELECT symbol, trade_date, CAST(close AS DOUBLE) AS close, row_number() OVER (PARTITION BY symbol ORDER BY trade_date) AS i FROM bars), "
    "e AS (SELECT symbol, trade_date, i, close, close AS f, close AS s, CAST(0 AS DOUBLE) AS line, CAST(NULL AS DOUBLE) AS up, CAST(NULL AS DOUBLE) AS down FROM n WHERE i = 1 UNION ALL SELECT n.symbol, n.trade_date, n.i, n.close, e.f + (n.close - e.f) * (2.0::DOUBLE / 13), e.s + (n.close - e.s) * (2.0::DOUBLE / 27), "
    "e.line + (e.f + (n.close - e.f) * (2.0::DOUBLE / 13) - e.s - (n.close - e.s) * (2.0::DOUBLE / 27) - e.line) * 0.2::DOUBLE, CASE WHEN e.up IS NULL THEN greatest(n.close - e.close, 0) ELSE e.up + (greatest(n.close - e.close, 0) - e.up) / 14 END, "
    "CASE WHEN e.down IS NULL THEN greatest(e.close - n.close, 0) ELSE e.down + (greatest(e.close - n.close, 0) - e.down) / 14 END FROM e JOIN n ON n.symbol = e.symbol AND n.i = e.i + 1) "
    "SELECT symbol, trade_date, round(f, 5) AS ema_fast, round(s, 5) AS ema_slow, round(f - s, 5) AS macd, round(line, 5) AS signal, round(f - s - line, 5) AS histogram, round(100 * up / nullif(up + down, 0), 5) AS rsi FROM e",
)
def indicators_every_bar(spark, sf_dir):
    """Averages, MACD with its signal, and relative strength at every bar."""
    out = scans.recursive_indicators(B.bars(spark, sf_dir), chunk_days=8)
    return rounded(out, "ema_fast", "ema_slow", "macd", "signal", "histogram", "rsi", places=5)


@query("X1_correlation_all_pairs", ORACLE_SQL["X1_correlation"])
def correlation_all_pairs(spark, sf_dir):
    """Every two series, by a blocked product."""
    return rounded(all_correlations(B.event_series(spark, sf_dir)), "correlation")


_CHANGED = "changed AS (SELECT symbol, trade_date, volume, CASE WHEN volume % 5 = 0 THEN close + 1 ELSE close END AS close FROM bars WHERE volume % 7 <> 0 UNION ALL SELECT symbol, trade_date + 1000, volume, close FROM bars WHERE volume % 11 = 0 UNION ALL SELECT symbol, trade_date, volume, close FROM bars WHERE volume % 13 = 0 AND volume % 7 <> 0)"


@query(
    "J3_digest_reconcile",
    f"WITH {B.BARS}, {_CHANGED}, a AS (SELECT symbol, trade_date, list_sort(list((volume, close))) AS x FROM bars GROUP BY 1, 2), b AS (SELECT symbol, trade_date, list_sort(list((volume, close))) AS y FROM changed GROUP BY 1, 2) "
    "SELECT symbol, trade_date, CASE WHEN y IS NULL THEN 'missing' WHEN x IS NULL THEN 'extra' WHEN len(y) > len(x) THEN 'duplicate' ELSE 'changed' END AS status FROM a FULL OUTER JOIN b USING (symbol, trade_date) WHERE x IS DISTINCT FROM y",
)
def digest_reconcile(spark, sf_dir):
    """Bars against a copy with changes, losses, additions and repeats; only unequal buckets are read."""
    bars = B.bars(spark, sf_dir).select("symbol", "trade_date", "volume", "close")
    changed = bars.filter("volume % 7 <> 0").withColumn("close", F.when(F.col("volume") % 5 == 0, F.col("close") + 1).otherwise(F.col("close")))
    changed = changed.unionByName(bars.filter("volume % 11 = 0").withColumn("trade_date", F.date_add("trade_date", 1000))).unionByName(bars.filter("volume % 13 = 0 AND volume % 7 <> 0"))
    path = shared_path(spark, "reconciled")
    Q.store(bars, ["symbol", "trade_date"], ["volume", "close"], f"{path}/expected")
    Q.store(changed, ["symbol", "trade_date"], ["volume", "close"], f"{path}/observed")
    return Q.reconcile(spark, f"{path}/expected", f"{path}/observed", ["symbol", "trade_date"], ["volume", "close"])


@query(
    "J3_newest_version",
    f"WITH {B.OBS}, newest AS (SELECT key, max(seq) AS seq FROM obs GROUP BY 1), pointed AS (SELECT key, max(seq) AS seq FROM obs WHERE NOT (partkey % 9 = 0 AND seq > 1) GROUP BY 1) SELECT key, CASE WHEN p.key IS NULL THEN 'missing' ELSE 'changed' END AS status FROM newest n LEFT JOIN pointed p USING (key) WHERE n.seq IS DISTINCT FROM p.seq",
)
def newest_version(spark, sf_dir):
    """Pointers, some of which missed a late version, against the newest versions."""
    versions = B.obs_ledger(spark, sf_dir)
    pointed = versions.filter("NOT (partkey % 9 = 0 AND seq > 1)").groupBy("key").agg(F.max("seq").alias("seq"))
    return Q.pointer_faults(spark, versions, pointed, SPEC, ["seq"], shared_path(spark, "pointers"))
