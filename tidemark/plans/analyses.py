"""Queries of the analyses that build on series, ledgers and surfaces (D)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions import scalars
from tidemark.operators import declared as D
from tidemark.operators import ledger as L
from tidemark.operators import quality as Q
from tidemark.operators import series as S
from tidemark.plans import bindings as B
from tidemark.plans.analytics import _PAIRS, pairs, rounded
from tidemark.plans.ledgers import DAY, SPEC, seen_sql
from tidemark.plans.registry import query
from tidemark.plans.services import _RECESSIONS, _recessions

_EVENTS = "released AS (SELECT event_id, user_id, ts, value AS actual, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS consensus FROM events), s AS (SELECT *, actual - consensus AS surprise FROM released), z AS (SELECT *, stddev_samp(surprise) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS sd FROM s)"


def _released(spark, sf_dir):
    """Users' events: each has the value before it as its consensus."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    events = B.read(spark, sf_dir, "events").select("event_id", "user_id", "ts", F.col("value").alias("actual"), F.lag("value").over(w).alias("consensus"))
    return D.surprises(events, ["user_id"], ["ts", "event_id"])


@query("D1_release_surprises", f"WITH {_EVENTS} SELECT event_id, round(surprise, 6) AS surprise FROM s")
def surprises(spark, sf_dir):
    return _released(spark, sf_dir).select("event_id", F.round("surprise", 6).alias("surprise"))


@query("D2_standardize_surprises", f"WITH {_EVENTS} SELECT event_id, round(surprise / nullif(sd, 0), 5) AS standardized FROM z")
def standardized(spark, sf_dir):
    return _released(spark, sf_dir).select("event_id", F.round("standardized", 5).alias("standardized"))


@query("D3_revision_analysis", f"WITH {B.OBS}, t AS (SELECT key, arg_min(value, seq) FILTER (WHERE is_first) AS f, arg_max(value, seq) AS l FROM obs GROUP BY key), d AS (SELECT key % 100 AS family, l - f AS d, f, l FROM t) SELECT family, count(d) AS n, round(avg(d), 4) AS bias, round(avg(abs(d)), 4) AS mae, round(sqrt(avg(d * d)), 4) AS rmse, count(*) FILTER (WHERE d > 0) AS up, count(*) FILTER (WHERE d < 0) AS down, count(*) FILTER (WHERE d = 0) AS unchanged, count(*) FILTER (WHERE sign(l) <> sign(f)) AS sign_changes FROM d GROUP BY 1")
def revisions(spark, sf_dir):
    trail = L.vintage_trail(B.obs_ledger(spark, sf_dir), SPEC, "value", "is_first", DAY).withColumn("family", F.col("key") % 100)
    return rounded(D.revisions(trail, ["family"]), "bias", "mae", "rmse", places=4)


@query("D4_align_to_recessions", f"WITH {_RECESSIONS} SELECT o_orderkey, EXISTS (SELECT 1 FROM recessions WHERE date_trunc('month', o_orderdate) BETWEEN peak AND trough) AS in_recession FROM orders")
def recessions(spark, sf_dir):
    orders = B.read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    return D.in_intervals(orders, _recessions(spark, sf_dir), F.col("day"), "peak", "trough", "in_recession").select("o_orderkey", "in_recession")


@query("D5_series_search", "SELECT p_type AS series, p_brand AS family, count(*) AS observations, min(p_retailprice) AS low, max(p_retailprice) AS high FROM part WHERE contains(lower(p_type || ' ' || p_brand), 'promo brand#1') GROUP BY 1, 2")
def series_search(spark, sf_dir):
    found = B.read(spark, sf_dir, "part").filter(scalars.contains_literal("promo brand#1", F.col("p_type"), F.col("p_brand")))
    return found.groupBy(F.col("p_type").alias("series"), F.col("p_brand").alias("family")).agg(F.count(F.lit(1)).alias("observations"), F.min("p_retailprice").alias("low"), F.max("p_retailprice").alias("high"))


@query("D5_series_describe", f"WITH {B.OBS} SELECT suppkey AS series, count(*) AS vintages, count(DISTINCT available_date) AS periods, min(available_date) AS first, max(available_date) AS last, count(*) FILTER (WHERE state = 'tombstone') AS tombstones FROM obs GROUP BY 1")
def series_describe(spark, sf_dir):
    return B.obs_ledger(spark, sf_dir).groupBy(F.col("suppkey").alias("series")).agg(F.count(F.lit(1)).alias("vintages"), F.count_distinct("available_date").alias("periods"), F.min("available_date").alias("first"), F.max("available_date").alias("last"), F.count_if(F.col("state") == "tombstone").alias("tombstones"))


_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("D6_liquidity_snapshot", f"WITH {B.OBS}, last AS (SELECT suppkey, line, arg_max(value, (available_at, key, seq)) AS v, arg_max(state, (available_at, key, seq)) AS state FROM obs WHERE {seen_sql(DAY)} GROUP BY 1, 2) SELECT suppkey, " + ", ".join(f"max(v) FILTER (WHERE line = {k}) AS l{k}" for k in range(1, 8)) + " FROM last GROUP BY 1")
def liquidity(spark, sf_dir):
    """Components known at the cutoff, a column each."""
    spec = L.LedgerSpec(key=("suppkey", "line"), rank=("available_at", "key", "seq"))
    known = L.ledger_select(B.obs_ledger(spark, sf_dir), spec, DAY)
    return known.groupBy("suppkey").agg(*[F.max(F.when(F.col("line") == k, F.col("value"))).alias(f"l{k}") for k in range(1, 8)])


@query("D6_liquidity_impulse", f"WITH {B.ORDER_SERIES} SELECT a.series_id, a.period_start, a.value, round(a.value - b.value, 2) AS change FROM orders_daily a LEFT JOIN orders_daily b ON b.series_id = a.series_id AND b.period_start + 7 = a.period_start")
def impulse(spark, sf_dir):
    return rounded(D.exact_change(B.order_series(spark, sf_dir), ["series_id"], "period_start", "value", 7), "change", places=2)


@query("D7_curve_analytics", "WITH p AS (SELECT o_orderpriority AS tenor, CAST(o_orderdate AS DATE) AS curve_date, max(o_totalprice) AS r FROM orders GROUP BY 1, 2), w AS (SELECT curve_date, max(r) FILTER (WHERE tenor = '1-URGENT') AS m3, max(r) FILTER (WHERE tenor = '2-HIGH') AS y2, max(r) FILTER (WHERE tenor = '3-MEDIUM') AS y5, max(r) FILTER (WHERE tenor = '4-NOT SPECIFIED') AS y10, max(r) FILTER (WHERE tenor = '5-LOW') AS y30 FROM p GROUP BY 1) SELECT curve_date, round(y10 - y2, 4) AS slope_10y_2y, round(y10 - m3, 4) AS slope_10y_3m, round(y30 - y5, 4) AS slope_30y_5y, round(2 * y5 - y2 - y10, 4) AS butterfly_2s5s10s, round(2 * y10 - y2 - y30, 4) AS curvature_2s10s30s FROM w")
def curve(spark, sf_dir):
    points = B.read(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("tenor"), F.col("o_orderdate").cast("date").alias("curve_date")).agg(F.max("o_totalprice").alias("rate"))
    out = D.curve_spreads(points, ["curve_date"], ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"])
    return rounded(out, "slope_10y_2y", "slope_10y_3m", "slope_30y_5y", "butterfly_2s5s10s", "curvature_2s10s30s", places=4)


@query("D8_transform_suite", f"WITH {B.SERIES}, t AS (SELECT *, lag(value) OVER w AS back, first_value(value IGNORE NULLS) OVER g AS f, max(value) OVER g AS top, avg(value) OVER r AS ra, stddev_samp(value) OVER r AS rs, count(value) OVER r AS rn, avg(value) OVER g AS ga, stddev_samp(value) OVER g AS gs FROM series WINDOW w AS (PARTITION BY series_id ORDER BY period_start), r AS (PARTITION BY series_id ORDER BY period_start ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), g AS (PARTITION BY series_id ORDER BY period_start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) SELECT series_id, period_start, round(value - back, 4) AS difference, round(value / back - 1, 4) AS percent_change, round(ln(value / back), 4) AS log_change, round(100 * value / f, 4) AS index_100, round(value / top - 1, 4) AS drawdown, CASE WHEN rn = 5 THEN round(ra, 4) END AS rolling_mean, CASE WHEN rn = 5 THEN round(rs, 4) END AS rolling_std, CASE WHEN rn = 5 THEN round((value - ra) / nullif(rs, 0), 4) END AS rolling_z, round((value - ga) / nullif(gs, 0), 4) AS expanding_z FROM t")
def transforms(spark, sf_dir):
    out = D.transforms(B.event_series(spark, sf_dir))
    return rounded(out, *out.columns[2:], places=4)


for _months, _annual, _name in ((12, False, "yoy"), (3, True, "qoq_saar")):
    _value = "power(a.value / b.value, 4) - 1" if _annual else "a.value / b.value - 1"

    @query(f"D8_calendar_{_name}", f"WITH {B.ORDER_SERIES}, m AS (SELECT series_id, CAST(date_trunc('month', period_start) AS DATE) AS period_start, sum(value) AS value FROM orders_daily GROUP BY 1, 2) SELECT a.series_id, a.period_start, round(100 * ({_value}), 4) AS change FROM m a LEFT JOIN m b ON b.series_id = a.series_id AND b.period_start + INTERVAL {_months} MONTH = a.period_start")
    def _calendar(spark, sf_dir, months=_months, annual=_annual):
        monthly = D.resample_any(B.order_series(spark, sf_dir), "month", "sum")
        return rounded(D.calendar_change(monthly, months, annual), "change", places=4)


@query("D9_describe_extended", f"WITH {B.SERIES}, l AS (SELECT *, lag(value) OVER (PARTITION BY series_id ORDER BY period_start) AS lagged FROM series), q AS (SELECT series_id, stddev_samp(value) AS std, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3, corr(value, lagged) AS ac FROM l GROUP BY 1), d AS (SELECT s.series_id, abs(value - median) AS d FROM series s JOIN q USING (series_id)), m AS (SELECT series_id, quantile_cont(d, 0.5) AS mad FROM d GROUP BY 1), o AS (SELECT d.series_id, max(mad) AS mad, count(*) FILTER (WHERE d > 3.5 * 1.4826 * mad) AS outliers FROM d JOIN m USING (series_id) GROUP BY 1) SELECT series_id, round(std, 4) AS std, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3, round(ac, 6) AS autocorrelation, round(mad, 4) AS mad, outliers FROM q JOIN o USING (series_id)")
def extended(spark, sf_dir):
    out = rounded(D.describe_extended(B.event_series(spark, sf_dir)), "std", "q1", "median", "q3", "mad", places=4)
    return rounded(out, "autocorrelation")


@query("D10_correlation_lead_lag", f"WITH {B.SERIES}, n AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY period_start) AS i FROM series), p AS (SELECT k AS lag, x.value AS x, y.value AS y FROM n x, (SELECT unnest([-2, -1, 0, 1, 2]) AS k), n y WHERE x.series_id = 'click' AND y.series_id = 'view' AND y.i = x.i + k) SELECT lag, count(*) FILTER (WHERE x IS NOT NULL AND y IS NOT NULL) AS pairs, round(corr(x, y), 6) AS correlation FROM p GROUP BY 1")
def lead_lag(spark, sf_dir):
    found = D.lead_lag_pairs(B.event_series(spark, sf_dir), "click", "view", [-2, -1, 0, 1, 2])
    return rounded(S.correlation(found, ["lag"]), "correlation").select("lag", "pairs", "correlation")


@query("D10_correlation_spearman", f"WITH {_PAIRS}, f AS (SELECT * FROM pairs WHERE x IS NOT NULL AND y IS NOT NULL), r AS (SELECT a, b, rank() OVER (PARTITION BY a, b ORDER BY x) AS rx, rank() OVER (PARTITION BY a, b ORDER BY y) AS ry FROM f) SELECT a, b, count(*) AS pairs, round(corr(rx, ry), 6) AS correlation FROM r GROUP BY 1, 2")
def spearman(spark, sf_dir):
    return rounded(S.correlation(D.ranked(pairs(spark, sf_dir), ["a", "b"]), ["a", "b"]), "correlation").select("a", "b", "pairs", "correlation")


@query("D11_align_resampled", f"WITH {B.SERIES}, f AS (SELECT series_id, period_start, last_value(value IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY period_start ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS value FROM series) SELECT series_id, CAST(date_trunc('week', period_start) AS DATE) AS period_start, round(avg(value), 4) AS value FROM f GROUP BY 1, 2")
def resampled(spark, sf_dir):
    """Weekly means after gaps of at most two days were filled forward."""
    return rounded(D.resample_any(D.filled_forward(B.event_series(spark, sf_dir), 2), "week", "mean"), "value", places=4)


_RETURNS = f"{B.SERIES}, r AS (SELECT series_id, period_start, value / lag(value) OVER (PARTITION BY series_id ORDER BY period_start) - 1 AS ret FROM series)"


@query("D13_cross_sectional_performance", f"WITH {_RETURNS}, o AS (SELECT r.series_id, r.period_start, r.ret, b.ret AS base FROM r JOIN r b ON b.period_start = r.period_start AND b.series_id = 'view' WHERE r.series_id <> 'view' AND r.ret IS NOT NULL) SELECT series_id, period_start, rank() OVER (PARTITION BY period_start ORDER BY ret DESC) AS rank, round(ret - base, 6) AS relative, round(avg(CASE WHEN ret > 0 THEN 1.0 ELSE 0.0 END) OVER (PARTITION BY period_start), 6) AS breadth, round(stddev_samp(ret) OVER (PARTITION BY period_start), 6) AS dispersion FROM o")
def cross_section(spark, sf_dir):
    return rounded(D.cross_section(S.returns(B.event_series(spark, sf_dir), 1), "view"), "relative", "breadth", "dispersion")


for _forward in (False, True):
    _step = "lead" if _forward else "lag"
    _ret = "other / close - 1" if _forward else "close / other - 1"

    @query(f"D14_{'forward' if _forward else 'market'}_returns", f"WITH {B.BARS}, o AS (SELECT symbol, trade_date, close, {_step}(close, 5) OVER (PARTITION BY symbol ORDER BY trade_date) AS other FROM bars) SELECT symbol, trade_date, CASE WHEN {'close' if _forward else 'other'} <> 0 THEN round({_ret}, 6) END AS \"return\" FROM o")
    def _market(spark, sf_dir, forward=_forward):
        bars = B.bars(spark, sf_dir).select("symbol", F.col("trade_date").alias("period_start"), F.col("trade_date").alias("period_end"), F.col("close").alias("value"))
        return rounded(S.returns(bars, 5, forward=forward, key=("symbol",)), "return").select("symbol", F.col("period_start").alias("trade_date"), "return")


@query("D15_indicators_windowed", f"WITH {B.BARS}, t AS (SELECT *, count(close) OVER r AS n, avg(close) OVER r AS sma, (close * 5 + lag(close, 1) OVER w * 4 + lag(close, 2) OVER w * 3 + lag(close, 3) OVER w * 2 + lag(close, 4) OVER w) / 15 AS wma, sum((high + low + close) / 3 * volume) OVER r / sum(volume) OVER r AS vwap, max(close) OVER v AS top FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY trade_date), r AS (PARTITION BY symbol ORDER BY trade_date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), v AS (PARTITION BY symbol ORDER BY trade_date ROWS BETWEEN 21 PRECEDING AND CURRENT ROW)) SELECT symbol, trade_date, CASE WHEN n = 5 THEN round(sma, 9) END AS sma, CASE WHEN n = 5 THEN round(wma, 9) END AS wma, CASE WHEN n = 5 THEN round(vwap, 9) END AS vwap, round(100 * (top - low) / nullif(top, 0), 9) AS vix_fix FROM t")
def windowed(spark, sf_dir):
    return rounded(D.windowed_indicators(B.bars(spark, sf_dir)), "sma", "wma", "vwap", "vix_fix", places=9)


@query("D16_indicators_recursive", f"WITH RECURSIVE {B.BARS}, n AS (SELECT symbol, CAST(close AS DOUBLE) AS close, row_number() OVER (PARTITION BY symbol ORDER BY trade_date) AS i FROM bars), e AS (SELECT symbol, i, close, close AS f, close AS s, CAST(NULL AS DOUBLE) AS up, CAST(NULL AS DOUBLE) AS down FROM n WHERE i = 1 UNION ALL SELECT n.symbol, n.i, n.close, e.f + (n.close - e.f) * (2.0::DOUBLE / 13), e.s + (n.close - e.s) * (2.0::DOUBLE / 27), CASE WHEN e.up IS NULL THEN greatest(n.close - e.close, 0) ELSE e.up + (greatest(n.close - e.close, 0) - e.up) / 14 END, CASE WHEN e.down IS NULL THEN greatest(e.close - n.close, 0) ELSE e.down + (greatest(e.close - n.close, 0) - e.down) / 14 END FROM e JOIN n ON n.symbol = e.symbol AND n.i = e.i + 1) SELECT symbol, CAST(max(i) AS INTEGER) AS bars, round(arg_max(f, i), 5) AS ema_fast, round(arg_max(s, i), 5) AS ema_slow, round(arg_max(f - s, i), 5) AS macd, round(arg_max(100 * up / nullif(up + down, 0), i), 5) AS rsi FROM e GROUP BY 1 HAVING max(i) >= 2")
def recursive(spark, sf_dir):
    return rounded(D.recursive_indicators(B.bars(spark, sf_dir)), "ema_fast", "ema_slow", "macd", "rsi", places=5)


for _name, _key in (("retail_sales", "suppkey"), ("weekly_fundamentals", "partkey")):

    @query(f"D17_{_name}", f"WITH {B.OBS} SELECT {_key} AS series_id, CAST(date_trunc('{'month' if _key == 'suppkey' else 'week'}', available_date) AS DATE) AS period, arg_max(value, (available_at, key, seq)) AS value FROM obs WHERE {seen_sql(DAY)} GROUP BY 1, 2")
    def _values(spark, sf_dir, key=_key):
        rows = B.obs_ledger(spark, sf_dir).withColumns({"series_id": F.col(key), "period": F.trunc("available_date", "month" if key == "suppkey" else "week")})
        return L.ledger_select(rows, L.LedgerSpec(key=("series_id", "period"), rank=("available_at", "key", "seq")), DAY).select("series_id", "period", "value")


@query("D18_share_count_history", f"WITH {B.OBS} SELECT key, seq, value, round(value - lag(value) OVER (PARTITION BY key ORDER BY seq), 2) AS change FROM obs")
def share_counts(spark, sf_dir):
    return rounded(D.version_changes(B.obs_ledger(spark, sf_dir), ["key"], ["seq"], "value"), "change", places=2).select("key", "seq", "value", "change")


@query("D18_estimate_revisions", f"WITH {B.OBS}, c AS (SELECT partkey AS metric, available_at, key, seq, round(value - lag(value) OVER (PARTITION BY partkey ORDER BY available_at, key, seq), 2) AS change FROM obs) SELECT metric, count(*) FILTER (WHERE change > 0) AS up, count(*) FILTER (WHERE change < 0) AS down, count(*) AS versions FROM c GROUP BY 1")
def estimate_revisions(spark, sf_dir):
    changed = rounded(D.version_changes(B.obs_ledger(spark, sf_dir), ["partkey"], ["available_at", "key", "seq"], "value"), "change", places=2)
    return changed.groupBy(F.col("partkey").alias("metric")).agg(F.count_if(F.col("change") > 0).alias("up"), F.count_if(F.col("change") < 0).alias("down"), F.count(F.lit(1)).alias("versions"))


@query("D19_earnings_setup", f"WITH {B.OBS}, k AS (SELECT * FROM obs WHERE {seen_sql(DAY)}), e AS (SELECT suppkey, max(available_date) AS last_event FROM k WHERE line = 1 GROUP BY 1), c AS (SELECT suppkey, arg_max(value, (available_at, key, seq)) AS consensus FROM k WHERE line = 2 GROUP BY 1), g AS (SELECT suppkey, arg_max(value, (available_at, key, seq)) AS guidance FROM k WHERE line = 3 GROUP BY 1) SELECT suppkey AS issuer, last_event, consensus, guidance FROM e LEFT JOIN c USING (suppkey) LEFT JOIN g USING (suppkey)")
def setup(spark, sf_dir):
    """Event, consensus and guidance of every issuer at one cutoff, in one pass over the ledger."""
    rank = F.struct("available_at", "key", "seq")
    known = L.visible(B.obs_ledger(spark, sf_dir), SPEC, DAY)
    of = lambda k: F.max_by(F.when(F.col("line") == k, F.col("value")), F.when(F.col("line") == k, rank))
    out = known.groupBy(F.col("suppkey").alias("issuer")).agg(F.max(F.when(F.col("line") == 1, F.col("available_date"))).alias("last_event"), of(2).alias("consensus"), of(3).alias("guidance"))
    return out.filter("last_event IS NOT NULL")


@query("D20_contract_screen", "SELECT p_partkey AS contract, unnest(list_filter([CASE WHEN p_size < 10 THEN 'size' END, CASE WHEN p_retailprice > 1500 THEN 'strike' END, CASE WHEN p_type = 'PROMO' THEN 'kind' END], lambda r: r IS NOT NULL)) AS rule FROM part")
def screen(spark, sf_dir):
    rules = {"size": F.col("p_size") >= 10, "strike": F.col("p_retailprice") <= 1500, "kind": F.col("p_type") != "PROMO"}
    return Q.rejects(Q.check_rows(B.read(spark, sf_dir, "part").withColumnRenamed("p_partkey", "contract"), rules), ["contract"])


@query("D21_surface_diagnostics", "SELECT l_orderkey AS capture, count(*) FILTER (WHERE l_returnflag = 'A') AS present, count(*) FILTER (WHERE l_returnflag <> 'A') AS other, count(*) FILTER (WHERE l_discount > l_tax) AS crossed, min(l_tax) AS iv_low, max(l_tax) AS iv_high FROM lineitem GROUP BY 1")
def diagnostics(spark, sf_dir):
    return B.read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("capture")).agg(F.count_if(F.col("l_returnflag") == "A").alias("present"), F.count_if(F.col("l_returnflag") != "A").alias("other"), F.count_if(F.col("l_discount") > F.col("l_tax")).alias("crossed"), F.min("l_tax").alias("iv_low"), F.max("l_tax").alias("iv_high"))


@query("D22_strategy_payoff", "WITH legs AS (SELECT l_orderkey AS strategy, p_retailprice AS strike, CASE WHEN l_linenumber % 2 = 0 THEN 'call' ELSE 'put' END AS kind, l_quantity AS q, l_tax * 100 AS premium FROM lineitem JOIN part ON p_partkey = l_partkey), g AS (SELECT unnest([800.0, 1000.0, 1200.0, 1600.0]::DOUBLE[]) AS spot) SELECT strategy, spot, round(sum(q * (CASE WHEN kind = 'call' THEN greatest(spot - strike, 0) ELSE greatest(strike - spot, 0) END - premium)), 4) AS payoff FROM legs, g GROUP BY 1, 2")
def payoff(spark, sf_dir):
    strikes = B.read(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_retailprice").alias("strike"))
    legs = B.read(spark, sf_dir, "lineitem").join(strikes, "l_partkey").select(F.col("l_orderkey").alias("strategy"), "strike", F.when(F.col("l_linenumber") % 2 == 0, "call").otherwise("put").alias("option_type"), F.col("l_quantity").alias("quantity"), (F.col("l_tax") * 100).alias("premium"))
    return rounded(D.payoffs(legs, ["strategy"], [800, 1000, 1200, 1600]), "payoff", places=4)


@query("D23_signal_ic", f"WITH {B.BARS}, f AS (SELECT symbol, trade_date, close AS signal, lead(close) OVER (PARTITION BY symbol ORDER BY trade_date) - close AS outcome FROM bars), m AS (SELECT *, rank() OVER (PARTITION BY trade_date ORDER BY signal) AS s, rank() OVER (PARTITION BY trade_date ORDER BY outcome) AS o, ntile(5) OVER (PARTITION BY trade_date ORDER BY signal, symbol) AS b FROM f WHERE signal IS NOT NULL AND outcome IS NOT NULL) SELECT trade_date, count(*) AS n, round(corr(s, o), 6) AS ic, round(avg(outcome) FILTER (WHERE b = 5) - avg(outcome) FILTER (WHERE b = 1), 6) AS spread FROM m GROUP BY 1")
def signal_ic(spark, sf_dir):
    w = Window.partitionBy("symbol").orderBy("trade_date")
    rows = B.bars(spark, sf_dir).select("symbol", "trade_date", F.col("close").alias("signal"), (F.lead("close").over(w) - F.col("close")).alias("outcome"))
    return rounded(D.signal_ic(rows, "trade_date", "signal", "outcome", 5), "ic", "spread")


@query("D24_walk_forward_folds", f"WITH {B.SERIES}, n AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY period_start) AS i FROM series), f AS (SELECT n.*, k AS fold, CASE WHEN i > k * 6 AND i <= k * 6 + 6 THEN 'test' WHEN i <= k * 6 - 2 THEN 'train' END AS part FROM n, (SELECT unnest([1, 2, 3, 4]) AS k)), m AS (SELECT series_id, fold, avg(value) FILTER (WHERE part = 'train') AS p FROM f GROUP BY 1, 2) SELECT f.series_id, f.fold, count(value) AS pairs, round(avg(p - value), 5) AS me, round(avg(abs(p - value)), 5) AS mae, round(sqrt(avg((p - value) * (p - value))), 5) AS rmse FROM f JOIN m USING (series_id, fold) WHERE part = 'test' GROUP BY 1, 2")
def folds(spark, sf_dir):
    """The training part's mean as forecast of the test part, by fold."""
    numbered = B.event_series(spark, sf_dir).withColumn("i", F.row_number().over(S.by_period()))
    parts = D.walk_forward(numbered, "i", 4, 6, 2)
    mean = parts.filter("part = 'train'").groupBy("series_id", "fold").agg(F.avg("value").alias("prediction"))
    rows = parts.filter("part = 'test'").join(mean, ["series_id", "fold"]).select("series_id", "fold", F.col("value").alias("actual"), "prediction")
    return rounded(S.forecast_errors(rows, ["series_id", "fold"]), "me", "mae", "rmse", places=5).drop("status")


@query("D25_block_bootstrap", f"WITH {B.SERIES}, n AS (SELECT series_id, value, row_number() OVER (PARTITION BY series_id ORDER BY period_start) - 1 AS i, count(*) OVER (PARTITION BY series_id) AS n FROM series WHERE value IS NOT NULL), z AS (SELECT DISTINCT series_id, n FROM n), r AS (SELECT series_id, n, unnest(range(1, 21)) AS replicate FROM z), b AS (SELECT *, unnest(range(0, CAST(floor((n - 1) / 4) AS BIGINT) + 1)) AS b FROM r), p AS (SELECT *, CAST('0x' || substr(md5('boot:' || series_id || ':' || replicate || ':' || b), 1, 8) AS BIGINT) % n AS start, unnest(range(0, 4)) AS k FROM b) SELECT p.series_id, CAST(p.replicate AS INTEGER) AS replicate, round(avg(n.value), 5) AS mean FROM p JOIN n ON n.series_id = p.series_id AND n.i = (p.start + p.k) % p.n WHERE p.b * 4 + p.k < p.n GROUP BY 1, 2")
def bootstrap(spark, sf_dir):
    return rounded(D.block_bootstrap(B.event_series(spark, sf_dir), 20, 4, "boot"), "mean", places=5)


@query("D26_ols_hac", f"WITH {_PAIRS}, c AS (SELECT * FROM pairs WHERE x IS NOT NULL AND y IS NOT NULL), f AS (SELECT a, b, count(*) AS n, avg(x) AS mx, avg(y) AS my, regr_slope(y, x) AS slope, var_pop(x) AS v FROM c GROUP BY 1, 2), g AS (SELECT c.a, c.b, period_start, (x - mx) * (y - my - slope * (x - mx)) AS g FROM c JOIN f USING (a, b)), l AS (SELECT *, lag(g, 1) OVER w AS g1, lag(g, 2) OVER w AS g2 FROM g WINDOW w AS (PARTITION BY a, b ORDER BY period_start)), s AS (SELECT a, b, sum(g * g) + 2 * (2.0 / 3) * sum(g * g1) + 2 * (1.0 / 3) * sum(g * g2) AS s FROM l GROUP BY 1, 2) SELECT a, b, n, round(slope, 6) AS slope, round(sqrt(greatest(s, 0)) / (n * v), 6) AS standard_error FROM f JOIN s USING (a, b)")
def hac(spark, sf_dir):
    return rounded(D.slope_hac(pairs(spark, sf_dir), ["a", "b"], ["period_start"], 2), "slope", "standard_error")
