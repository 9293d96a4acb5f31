"""Queries of joins, aggregations, windows and statistics (C, G, W, X)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import joins as J
from tidemark.operators import ledger as L
from tidemark.operators import series as S
from tidemark.plans import bindings as B
from tidemark.plans.ledgers import DAY, SPEC, seen_sql
from tidemark.plans.registry import ORACLE_SQL, query

TYPES = ["click", "error", "purchase", "signup", "view"]
WIDE = B.SERIES + ", wide AS (SELECT period_start, " + ", ".join(f"max(value) FILTER (WHERE series_id = '{t}') AS {t}" for t in TYPES) + " FROM series GROUP BY 1)"
FREE = "period_start AS period_end"


def wide(spark, sf_dir):
    return J.align(B.event_series(spark, sf_dir), TYPES)


def rounded(df, *columns, places=6):
    return df.withColumns({c: F.round(F.col(c), places) for c in columns})


def _with_part(spark, sf_dir, lines):
    part = B.read(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type")
    return J.join_dimension(lines.select("l_orderkey", "l_linenumber", "l_partkey"), part, ["l_partkey"])


@query("C1_join_dimension_inner", "SELECT l_orderkey, l_linenumber, l_partkey, p_brand, p_type FROM lineitem JOIN part ON p_partkey = l_partkey")
def dimension(spark, sf_dir):
    return _with_part(spark, sf_dir, B.read(spark, sf_dir, "lineitem"))


@query("C1_join_dimension_inner_all", ORACLE_SQL["C1_join_dimension_inner"])
def dimension_all(spark, sf_dir):
    return _with_part(spark, sf_dir, B.read(spark, sf_dir, "lineitem"))


@query("C2_identifier_resolve", f"WITH {B.INTERVALS}, i2 AS (SELECT * FROM intervals UNION ALL SELECT symbol, target + 1, priority, valid_from, valid_through FROM intervals WHERE symbol % 7 = 0), probes AS (SELECT o_orderkey AS probe, o_custkey AS symbol, CAST(o_orderdate AS DATE) - 40 AS d FROM orders), m AS (SELECT probe, count(i.symbol) AS n, min(target) AS target FROM probes p LEFT JOIN i2 i ON i.symbol = p.symbol AND i.valid_from <= d AND (i.valid_through IS NULL OR i.valid_through >= d) GROUP BY 1) SELECT probe, CASE n WHEN 0 THEN 'unknown' WHEN 1 THEN 'resolved' ELSE 'ambiguous' END AS status, CASE WHEN n = 1 THEN target END AS target FROM m")
def resolve(spark, sf_dir):
    held = B.intervals(spark, sf_dir)
    held = held.unionByName(held.filter("symbol % 7 = 0").withColumn("target", F.col("target") + 1))
    probes = B.read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("probe"), F.col("o_custkey").alias("symbol"), F.date_sub(F.col("o_orderdate").cast("date"), 40).alias("d"))
    return J.resolve(probes, held, "symbol", "d", ["probe"], "target")


@query("C3_filing_issuer_bridge", "SELECT DISTINCT o_orderkey AS accession, l_suppkey AS issuer FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F'")
def bridge(spark, sf_dir):
    filings = B.read(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("accession"))
    members = B.read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("accession"), F.col("l_suppkey").alias("issuer"))
    return J.bridge(filings, members, ["accession"])


@query("C4_covering_interval_join", f"WITH {B.INTERVALS}, probes AS (SELECT o_orderkey AS probe, o_custkey AS symbol, CAST(o_orderdate AS DATE) AS a, CAST(o_orderdate AS DATE) + 100 AS b FROM orders) SELECT probe, count(i.symbol) AS covering FROM probes p LEFT JOIN intervals i ON i.symbol = p.symbol AND i.valid_from <= p.a AND coalesce(i.valid_through, DATE '9999-12-31') >= p.b GROUP BY 1")
def covering(spark, sf_dir):
    day = F.col("o_orderdate").cast("date")
    inner = B.read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("probe"), F.col("o_custkey").alias("symbol"), day.alias("valid_from"), F.date_add(day, 100).alias("valid_through"))
    return J.covering(inner, B.intervals(spark, sf_dir), "symbol", ["probe"])


@query("C5_align_inner", f"WITH {WIDE} SELECT {FREE}, * FROM wide")
def align_inner(spark, sf_dir):
    return wide(spark, sf_dir)


@query("C6_align_outer", f"WITH {B.ORDER_SERIES}, k AS (SELECT period_start, period_end, " + ", ".join(f"max(value) FILTER (WHERE series_id = '{s}') AS \"{s}\", CASE WHEN count(*) FILTER (WHERE series_id = '{s}') = 0 THEN 'absent_from_series' END AS \"{s}_missing\"" for s in ("1-URGENT", "2-HIGH", "5-LOW")) + " FROM orders_daily WHERE series_id IN ('1-URGENT', '2-HIGH', '5-LOW') GROUP BY 1, 2) SELECT * FROM k")
def align_outer(spark, sf_dir):
    return J.align(B.order_series(spark, sf_dir), ["1-URGENT", "2-HIGH", "5-LOW"], "outer")


@query("C7_compose_full_outer", "WITH u AS (SELECT c_nationkey AS k, 'customers' AS d FROM customer WHERE c_nationkey < 20 UNION ALL SELECT s_nationkey, 'suppliers' FROM supplier WHERE s_nationkey > 5 UNION ALL SELECT n_nationkey, 'nations' FROM nation), n AS (SELECT k, d, count(*) AS n FROM u GROUP BY 1, 2) SELECT k AS nation, list_sort(list(d)) AS datasets, list_sort(list_filter(['customers', 'nations', 'suppliers'], lambda x: NOT list_contains(list(d), x))) AS missing_datasets, max(n) > 1 AS conflict FROM n GROUP BY 1")
def compose(spark, sf_dir):
    parts = {
        "customers": B.read(spark, sf_dir, "customer").filter("c_nationkey < 20").select(F.col("c_nationkey").alias("nation")),
        "suppliers": B.read(spark, sf_dir, "supplier").filter("s_nationkey > 5").select(F.col("s_nationkey").alias("nation")),
        "nations": B.read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nation")),
    }
    return J.compose(parts, ["nation"])


@query("C9_left_anti_references", "SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_mktsegment <> 'BUILDING')")
def anti(spark, sf_dir):
    known = B.read(spark, sf_dir, "customer").filter("c_mktsegment <> 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return B.read(spark, sf_dir, "orders").join(known, "o_custkey", "left_anti").select("o_orderkey", "o_custkey")


@query("C10_left_join_evidence_chain", "SELECT r_name, n_name, count(DISTINCT c_custkey) AS issuers, count(DISTINCT o_orderkey) AS filings FROM region LEFT JOIN nation ON n_regionkey = r_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'P' GROUP BY 1, 2")
def chain(spark, sf_dir):
    """Regions, nations, customers and orders as a chain of left joins; counts are taken below each fan-out."""
    filings = B.read(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    issuers = B.read(spark, sf_dir, "customer").join(filings, F.col("c_custkey") == F.col("o_custkey"), "left").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("i"), F.sum("n").alias("f"))
    region, nation = B.read(spark, sf_dir, "region"), B.read(spark, sf_dir, "nation")
    joined = region.join(nation, F.col("n_regionkey") == F.col("r_regionkey"), "left").join(issuers, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return joined.groupBy("r_name", "n_name").agg(F.coalesce(F.sum("i"), F.lit(0)).alias("issuers"), F.coalesce(F.sum("f"), F.lit(0)).alias("filings"))


@query("C11_snapshot_run_join", f"SELECT o_orderkey AS snapshot, c_name AS run FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus = 'O' AND c_mktsegment = 'BUILDING' AND o_orderdate <= DATE '{DAY}'")
def snapshot_run(spark, sf_dir):
    runs = B.read(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'").select("c_custkey", F.col("c_name").alias("run"))
    snapshots = B.read(spark, sf_dir, "orders").filter((F.col("o_orderstatus") == "O") & (F.col("o_orderdate") <= F.lit(DAY).cast("date")))
    return snapshots.join(runs, F.col("c_custkey") == F.col("o_custkey")).select(F.col("o_orderkey").alias("snapshot"), "run")


_DESCRIBE = "SELECT series_id, count(*) AS n, count(value) AS nonmissing, count(*) - count(value) AS missing, min(value) AS min, max(value) AS max, round(avg(value), 6) AS mean, round(var_samp(value), 4) AS variance"


@query("G1_describe_series", f"WITH {B.SERIES} {_DESCRIBE}, CASE WHEN count(value) = 0 THEN 'all_missing' WHEN count(value) < 2 THEN 'insufficient_observations' END AS warning FROM series GROUP BY 1")
def describe(spark, sf_dir):
    return rounded(rounded(S.describe(B.event_series(spark, sf_dir)), "mean"), "variance", places=4).drop("first_period", "last_period")


@query("G2_describe_legacy", f"WITH {B.ORDER_SERIES} SELECT series_id, count(*) AS n, count(value) AS nonmissing, min(value) AS min, max(value) AS max, round(avg(value), 4) AS mean, min(period_start) AS first_period, max(period_end) AS last_period FROM orders_daily GROUP BY 1")
def describe_legacy(spark, sf_dir):
    return rounded(S.describe(B.order_series(spark, sf_dir)), "mean", places=4).select("series_id", "n", "nonmissing", "min", "max", "mean", "first_period", "last_period")


for _how, _value in (("mean", "round(avg(value), 4)"), ("sum", "round(sum(value), 2)"), ("last", "round(arg_max(value, period_start), 2)")):
    for _target, _unit, _months in (("monthly", "month", 1), ("quarterly", "quarter", 3)):

        @query(f"G3_resample_{_target}_{_how}", f"WITH {B.ORDER_SERIES}, b AS (SELECT series_id, CAST(date_trunc('{_unit}', period_start) AS DATE) AS s, CAST(date_trunc('{_unit}', period_start) + INTERVAL {_months} MONTH - INTERVAL 1 DAY AS DATE) AS e, * EXCLUDE (series_id) FROM orders_daily), g AS (SELECT series_id, s, e, {_value} AS v, bool_and(value IS NOT NULL) AND count(*) = e - s + 1 AND count(DISTINCT period_start) = e - s + 1 AS proven FROM b GROUP BY series_id, s, e) SELECT series_id, s AS period_start, e AS period_end, CASE WHEN proven THEN v END AS value, CASE WHEN NOT proven THEN 'resample_incomplete_bucket' END AS missing_reason FROM g")
        def _resample(spark, sf_dir, how=_how, target=_target):
            return rounded(S.resample(B.order_series(spark, sf_dir), "daily", target, how), "value", places=4 if how == "mean" else 2)


@query("G4_quality_audit", f"WITH {B.SERIES} SELECT count(DISTINCT series_id) AS series_count, count(*) FILTER (WHERE value IS NULL) AS missing_count FROM series")
def audit(spark, sf_dir):
    return B.event_series(spark, sf_dir).agg(F.count_distinct("series_id").alias("series_count"), F.count_if(F.col("value").isNull()).alias("missing_count"))


@query("G8_high_water_state", "SELECT o_orderstatus AS state, count(*) AS row_count, max(CAST(o_orderdate AS DATE)) AS captured_at, max(o_orderkey) AS snapshot_id FROM orders GROUP BY 1")
def high_water(spark, sf_dir):
    return B.read(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("state")).agg(F.count(F.lit(1)).alias("row_count"), F.max(F.col("o_orderdate").cast("date")).alias("captured_at"), F.max("o_orderkey").alias("snapshot_id"))


_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@query("G9_revision_counts_by_relation", " UNION ALL ".join(f"SELECT '{t}' AS relation, count(*) AS n FROM {t}" for t in _TABLES))
def relation_counts(spark, sf_dir):
    out = None
    for t in _TABLES:
        one = B.read(spark, sf_dir, t).agg(F.lit(t).alias("relation"), F.count(F.lit(1)).alias("n")).select("relation", "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("G10_warning_union", "SELECT o_custkey AS issuer, list_sort(list(DISTINCT o_orderstatus || ':' || o_orderpriority)) AS warnings FROM orders GROUP BY 1")
def warning_union(spark, sf_dir):
    return B.read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("issuer")).agg(F.array_sort(F.collect_set(F.concat_ws(":", "o_orderstatus", "o_orderpriority"))).alias("warnings"))


for _log in (False, True):
    for _forward in (False, True):
        _step = "lead" if _forward else "lag"
        _base, _later = ("value", "other") if _forward else ("other", "value")
        _expr = f"ln({_later} / {_base})" if _log else f"{_later} / {_base} - 1"
        _name = f"W{2 if _forward else 1}_return_{'forward' if _forward else 'trailing'}{'_log' if _log else ''}"
        _none = "insufficient_forward_horizon" if _forward else "insufficient_history"

        @query(_name, f"WITH {B.SERIES}, o AS (SELECT *, {_step}(value, 2) OVER w AS other, {_step}(1, 2) OVER w AS there FROM series WINDOW w AS (PARTITION BY series_id ORDER BY period_start)) SELECT series_id, period_start, period_end, CASE WHEN there IS NOT NULL AND {_base} <> 0 THEN round({_expr}, 6) END AS \"return\", CASE WHEN there IS NULL THEN '{_none}' WHEN value IS NULL OR other IS NULL THEN 'return_input_missing' WHEN {_base} = 0 THEN 'zero_return_base' END AS missing_reason FROM o")
        def _returns(spark, sf_dir, log=_log, forward=_forward):
            return rounded(S.returns(B.event_series(spark, sf_dir), 2, log, forward), "return")


@query("W4_first_difference_stats", f"WITH {B.SERIES}, full_series AS (SELECT series_id, period_start, raw AS value FROM summed UNION ALL SELECT series_id || '*', period_start, value FROM series), d AS (SELECT *, value - lag(value) OVER (PARTITION BY series_id ORDER BY period_start) AS d FROM full_series) SELECT series_id, count(*) AS n, CASE WHEN count(value) < count(*) THEN 'missing_values' ELSE 'established' END AS status, CASE WHEN count(value) = count(*) THEN round(avg(d), 6) END AS difference_mean, CASE WHEN count(value) = count(*) THEN round(var_samp(d), 3) END AS difference_variance FROM d GROUP BY 1")
def differences(spark, sf_dir):
    gaps = B.event_series(spark, sf_dir).withColumn("series_id", F.concat("series_id", F.lit("*")))
    daily = B.read(spark, sf_dir, "events").groupBy(F.col("event_type").alias("series_id"), F.col("ts").cast("date").alias("period_start")).agg(F.sum(B.money("value")).cast("double").alias("value"))
    out = S.first_differences(daily.select("series_id", "period_start", F.col("period_start").alias("period_end"), "value").unionByName(gaps))
    return rounded(rounded(out, "difference_mean"), "difference_variance", places=3)


@query("W5_event_study", f"WITH {B.SERIES}, r AS (SELECT *, value / lag(value) OVER w - 1 AS ret, row_number() OVER w AS i FROM series WINDOW w AS (PARTITION BY series_id ORDER BY period_start)), e AS (SELECT series_id, period_start, i AS pos FROM r WHERE day(period_start) % 5 = 0), a AS (SELECT e.series_id, e.period_start, e.pos, count(r.ret) AS n, min(r.ret) AS least, sum(CASE WHEN r.ret > -1 THEN ln(1 + r.ret) END) AS s FROM e LEFT JOIN r ON r.series_id = e.series_id AND r.i BETWEEN e.pos - 2 AND e.pos + 3 GROUP BY 1, 2, 3) SELECT series_id, period_start, CASE WHEN pos >= 3 AND pos <= 27 AND n = 6 AND least > -1 THEN round(exp(s) - 1, 6) END AS cumulative_return, CASE WHEN pos < 3 OR pos > 27 THEN 'event_window_out_of_sample' WHEN n < 6 THEN 'event_return_missing' WHEN least <= -1 THEN 'event_return_total_loss' END AS missing_reason FROM a")
def event_study(spark, sf_dir):
    rets = S.returns(B.event_series(spark, sf_dir), 1)
    events = rets.filter("day(period_start) % 5 = 0").select("series_id", "period_start")
    return rounded(S.event_study(rets, events, 2, 3), "cumulative_return")


@query("W6_supersession_chain", f"WITH {B.OBS}, v AS (SELECT key, seq + CASE WHEN key % 50 = 0 AND seq > 2 THEN 1 ELSE 0 END AS seq, CASE WHEN seq > 1 AND key % 20 <> 0 THEN seq - 1 END AS supersedes, seq AS version FROM obs), c AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY seq) AS n, lag(version) OVER (PARTITION BY key ORDER BY seq) AS before FROM v) SELECT key, seq, CASE WHEN seq <> n THEN 'sequence_gap' ELSE 'wrong_supersedes' END AS rule FROM c WHERE seq <> n OR supersedes IS DISTINCT FROM before")
def supersession(spark, sf_dir):
    rows = B.obs_ledger(spark, sf_dir)
    gap = F.when((F.col("key") % 50 == 0) & (F.col("seq") > 2), 1).otherwise(0)
    versions = rows.select("key", (F.col("seq") + gap).alias("seq"), F.when((F.col("seq") > 1) & (F.col("key") % 20 != 0), F.col("seq") - 1).alias("supersedes"), F.col("seq").alias("version"))
    return L.supersession_faults(versions, ["key"], "seq", "version", "supersedes").select("key", "seq", "rule")


@query("W7_interval_overlap", f"WITH {B.INTERVALS}, l AS (SELECT symbol, target, valid_from, CASE WHEN target % 3 = 0 THEN valid_through + 5 ELSE valid_through END AS valid_through FROM intervals), r AS (SELECT *, max(coalesce(valid_through, DATE '9999-12-31')) OVER (PARTITION BY symbol ORDER BY valid_from, valid_through NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM l) SELECT symbol, target, valid_from FROM r WHERE reach >= valid_from")
def overlap(spark, sf_dir):
    longer = B.intervals(spark, sf_dir).withColumn("valid_through", F.when(F.col("target") % 3 == 0, F.date_add("valid_through", 5)).otherwise(F.col("valid_through")))
    return J.overlaps(longer, ["symbol"]).select("symbol", "target", "valid_from")


@query("W8_strict_order_check", "WITH a AS (SELECT o_custkey AS series_id, o_orderkey AS arrival, CAST(o_orderdate AS DATE) AS d, lag(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS before FROM orders) SELECT series_id, arrival FROM a WHERE before >= d")
def strict_order(spark, sf_dir):
    day = F.col("o_orderdate").cast("date")
    rows = B.read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("series_id"), F.col("o_orderkey").alias("arrival"), day.alias("period_start"), day.alias("period_end"))
    return S.order_faults(rows).select("series_id", "arrival")


_PAIRS = B.SERIES + ", pairs AS (SELECT a.series_id AS a, b.series_id AS b, a.period_start, a.value AS x, b.value AS y FROM series a JOIN series b ON a.period_start = b.period_start AND a.series_id < b.series_id)"


def pairs(spark, sf_dir):
    s = B.event_series(spark, sf_dir)
    a, b = s.select("period_start", F.col("series_id").alias("a"), F.col("value").alias("x")), s.select("period_start", F.col("series_id").alias("b"), F.col("value").alias("y"))
    return a.join(b, "period_start").filter("a < b")


@query("W3_rolling_regression", f"WITH {_PAIRS}, p AS (SELECT *, row_number() OVER (PARTITION BY a, b ORDER BY period_start) AS i FROM pairs), w AS (SELECT l.a, l.b, l.period_start, regr_count(r.y, r.x) AS sample_size, regr_sxx(r.y, r.x) AS sxx, regr_slope(r.y, r.x) AS s, regr_intercept(r.y, r.x) AS c FROM p l JOIN p r ON r.a = l.a AND r.b = l.b AND r.i BETWEEN l.i - 3 AND l.i GROUP BY l.a, l.b, l.period_start, l.i HAVING count(*) = 4) SELECT a, b, period_start, CAST(sample_size AS BIGINT) AS sample_size, CASE WHEN sample_size <= 2 THEN 'insufficient_degrees_of_freedom' WHEN sxx = 0 THEN 'singular_design' ELSE 'established' END AS status, CASE WHEN sample_size > 2 AND sxx > 0 THEN round(s, 4) END AS slope, CASE WHEN sample_size > 2 AND sxx > 0 THEN round(c, 2) END AS intercept FROM w")
def rolling(spark, sf_dir):
    """Windows of four days for each pair of series; days without a value leave some windows with too few."""
    out = S.rolling_regression(pairs(spark, sf_dir), 4, ["a", "b"], ["period_start"])
    return rounded(rounded(out, "slope", places=4), "intercept", places=2)


_CORR = f"WITH {_PAIRS} SELECT a, b, count(*) FILTER (WHERE x IS NOT NULL AND y IS NOT NULL) AS pairs, count(*) FILTER (WHERE x IS NULL OR y IS NULL) AS excluded, round(corr(x, y), 6) AS correlation, CASE WHEN corr(x, y) IS NULL THEN 'not_established' ELSE 'established' END AS status FROM pairs GROUP BY 1, 2"


@query("X1_correlation", _CORR)
def correlation(spark, sf_dir):
    return rounded(S.correlation(pairs(spark, sf_dir), ["a", "b"]), "correlation")


@query("X5_signal_diagnostics", _CORR)
def signal(spark, sf_dir):
    """Several series: their correlations."""
    return correlation(spark, sf_dir)


@query("X6_robustness_suite", f"WITH {B.SERIES} {_DESCRIBE} FROM series GROUP BY 1")
def robustness(spark, sf_dir):
    return describe(spark, sf_dir).drop("warning")


@query("X2_ols_regression", f"WITH {_PAIRS} SELECT a, b, regr_count(y, x) AS n, 'established' AS status, round(regr_intercept(y, x), 4) AS intercept, round(regr_slope(y, x), 6) AS slope, round(regr_syy(y, x) - regr_sxy(y, x) * regr_sxy(y, x) / regr_sxx(y, x), 2) AS rss, round(regr_r2(y, x), 6) AS r_squared FROM pairs GROUP BY 1, 2")
def ols(spark, sf_dir):
    out = S.ols(pairs(spark, sf_dir), ["a", "b"], "y", ["x"])
    return out.select("a", "b", "n", "status", F.round(F.get("coefficients", F.lit(0)), 4).alias("intercept"), F.round(F.get("coefficients", F.lit(1)), 6).alias("slope"), F.round("rss", 2).alias("rss"), F.round("r_squared", 6).alias("r_squared"))


@query("X2_ols_without_intercept", f"WITH {_PAIRS}, g AS (SELECT a, b, count(*) AS n, sum(x * y) AS sxy, sum(x * x) AS sxx, sum(y * y) AS syy, var_pop(y) * count(*) AS tss FROM pairs WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY 1, 2) SELECT a, b, n, 'established' AS status, round(sxy / sxx, 6) AS slope, round(1 - (syy - sxy * sxy / sxx) / tss, 5) AS r_squared FROM g")
def ols_without_intercept(spark, sf_dir):
    out = S.ols(pairs(spark, sf_dir), ["a", "b"], "y", ["x"], intercept=False)
    return out.select("a", "b", "n", "status", F.round(F.get("coefficients", F.lit(0)), 6).alias("slope"), F.round("r_squared", 5).alias("r_squared"))


@query("X3_forecast_evaluate", f"WITH {B.SERIES}, f AS (SELECT series_id, value AS actual, lag(value) OVER (PARTITION BY series_id ORDER BY period_start) AS p FROM series) SELECT series_id, count(p - actual) AS pairs, round(avg(p - actual), 6) AS me, round(avg(abs(p - actual)), 6) AS mae, round(sqrt(avg((p - actual) * (p - actual))), 6) AS rmse, 'established' AS status FROM f GROUP BY 1")
def forecast(spark, sf_dir):
    rows = B.event_series(spark, sf_dir).select("series_id", F.col("value").alias("actual"), F.lag("value").over(S.by_period()).alias("prediction"))
    return rounded(S.forecast_errors(rows, ["series_id"]), "me", "mae", "rmse")


_TESTS = "tests AS (SELECT p_brand AS family, p_partkey AS test, CASE WHEN p_partkey % 11 <> 0 THEN (p_partkey * 7919 % 1000) / 1000.0 END AS p FROM part)"


def tests_of_parts(spark, sf_dir):
    p = F.when(F.col("p_partkey") % 11 != 0, (F.col("p_partkey") * 7919 % 1000) / F.lit(1000.0))
    return B.read(spark, sf_dir, "part").select(F.col("p_brand").alias("family"), F.col("p_partkey").alias("test"), p.alias("p"))


_RANKED = f"WITH {_TESTS}, r AS (SELECT *, row_number() OVER (PARTITION BY family ORDER BY p, test) AS position, count(*) OVER (PARTITION BY family) AS n FROM tests WHERE p IS NOT NULL)"
_BH = _RANKED + " SELECT family, test, p, position, round(least(1.0, min(p * n {c} / position) OVER (PARTITION BY family ORDER BY position DESC ROWS UNBOUNDED PRECEDING)), 6) AS adjusted FROM r"


@query("X4_multiple_testing_bh", _BH.format(c=""))
def bh(spark, sf_dir):
    return rounded(S.adjusted_p(tests_of_parts(spark, sf_dir), ["family"], tie=["test"]), "adjusted")


@query("D12_multiple_testing_by", _BH.format(c="* list_sum(list_transform(range(1, n + 1), lambda i: 1.0 / i))"))
def by(spark, sf_dir):
    return rounded(S.adjusted_p(tests_of_parts(spark, sf_dir), ["family"], tie=["test"], method="by"), "adjusted")


@query("D12_multiple_testing_holm", _RANKED + " SELECT family, test, p, position, round(least(1.0, max(p * (n - position + 1)) OVER (PARTITION BY family ORDER BY position ROWS UNBOUNDED PRECEDING)), 6) AS adjusted FROM r")
def holm(spark, sf_dir):
    return rounded(S.adjusted_p(tests_of_parts(spark, sf_dir), ["family"], tie=["test"], method="holm"), "adjusted")


@query("D12_multiple_testing_bonferroni", _RANKED + " SELECT family, test, p, position, round(least(1.0, p * n), 6) AS adjusted FROM r")
def bonferroni(spark, sf_dir):
    return rounded(S.adjusted_p(tests_of_parts(spark, sf_dir), ["family"], tie=["test"], method="bonferroni"), "adjusted")


@query("X7_point_in_time_panel", f"WITH {B.OBS}, c AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY seq DESC) AS rn FROM obs WHERE {seen_sql(DAY)}), p AS (SELECT available_date AS period_start, line, round(sum(value), 2) AS v FROM c WHERE rn = 1 GROUP BY 1, 2) SELECT period_start, period_start AS period_end, max(v) FILTER (WHERE line = 1) AS l1, max(v) FILTER (WHERE line = 2) AS l2 FROM p WHERE line IN (1, 2) GROUP BY 1 HAVING count(DISTINCT line) = 2")
def panel(spark, sf_dir):
    """Series as known at a cutoff, then aligned."""
    known = L.ledger_select(B.obs_ledger(spark, sf_dir), SPEC, DAY, active=False)
    rows = known.groupBy(F.concat(F.lit("l"), "line").alias("series_id"), F.col("available_date").alias("period_start")).agg(F.round(F.sum("value"), 2).alias("value")).withColumn("period_end", F.col("period_start"))
    return J.align(rows, ["l1", "l2"])


@query("X8_derived_availability", f"WITH {B.OBS} SELECT partkey, CASE WHEN bool_and(available_precision = 'datetime') THEN 'datetime' ELSE 'date' END AS available_precision, max(available_date) AS available_date, CASE WHEN bool_and(available_precision = 'datetime') THEN max(available_at) END AS available_at FROM obs GROUP BY 1")
def availability(spark, sf_dir):
    return S.derived_availability(B.obs_ledger(spark, sf_dir), ["partkey"]).withColumn("available_at", F.col("available_at").cast("timestamp_ntz"))


@query("X9_lineage_carry", f"WITH {B.OBS} SELECT suppkey, available_date, list_sort(list(DISTINCT key || '/' || seq)) AS lineage FROM obs GROUP BY 1, 2")
def lineage(spark, sf_dir):
    return S.lineage(B.obs_ledger(spark, sf_dir), ["suppkey", "available_date"], [F.col("key"), F.col("seq")])
