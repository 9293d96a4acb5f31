"""Queries of company reads (A7, A14, L11, L12), audits (J4, S2, S9), lineage (X9) and further measures (D8, D15, D21-D23)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import company as K
from tidemark.operators import declared as D
from tidemark.operators import ledger as L
from tidemark.operators import quality as Q
from tidemark.operators import series as S
from tidemark.plans import bindings as B
from tidemark.plans.analytics import rounded
from tidemark.plans.ledgers import DAY, MOMENT, seen_sql
from tidemark.plans.options import _sql as options_sql
from tidemark.plans.options import _table as options_table
from tidemark.plans.registry import query



@query(
    "A7_issuer_with_links",
    f"WITH {B.OBS}, issuers AS (SELECT suppkey AS issuer, value, state, row_number() OVER (PARTITION BY suppkey ORDER BY available_date DESC, key DESC, seq DESC) AS rn FROM obs WHERE {seen_sql(MOMENT)}), "
    f"links AS (SELECT suppkey AS issuer, partkey, available_date AS valid_from, available_date + CAST(quantity AS INT) * 20 AS valid_through, state, row_number() OVER (PARTITION BY suppkey, partkey ORDER BY available_date DESC, key DESC, seq DESC) AS rn FROM obs WHERE {seen_sql(MOMENT)}), "
    f"held AS (SELECT issuer, count(*) AS n, string_agg(CAST(partkey AS VARCHAR), ',' ORDER BY partkey) AS parts FROM links WHERE rn = 1 AND state = 'active' AND valid_from <= DATE '{DAY}' AND valid_through >= DATE '{DAY}' GROUP BY 1) "
    "SELECT i.issuer, round(i.value, 2) AS value, CAST(coalesce(h.n, 0) AS INTEGER) AS links, coalesce(h.parts, '') AS parts FROM issuers i LEFT JOIN held h USING (issuer) WHERE rn = 1 AND state = 'active'",
)
def issuer_with_links(spark, sf_dir):
    """Issuers' versions at a moment, with the links known then that hold on its day."""
    obs = B.obs_ledger(spark, sf_dir).withColumnRenamed("suppkey", "issuer")
    rank = ("available_date", "key", "seq")
    links = obs.withColumns({"valid_from": F.col("available_date"), "valid_through": F.date_add("available_date", F.col("quantity").cast("int") * 20)})
    out = K.issuers_as_of(obs, L.LedgerSpec(key=("issuer",), rank=rank, state="state"), links, L.LedgerSpec(key=("issuer", "partkey"), rank=rank, state="state"), DAY, MOMENT, ["partkey"])
    return out.select("issuer", F.round("value", 2).alias("value"), F.size("links").alias("links"), F.array_join(F.transform("links", lambda x: x["partkey"].cast("string")), ",").alias("parts"))


@query("A14_filings_of_members", f"SELECT DISTINCT o_orderkey AS accession, l_suppkey AS issuer, CAST(o_orderdate AS DATE) AS filing_date FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderdate AS DATE) < DATE '{DAY}' ELSE CAST(o_orderdate AS TIMESTAMP) + CAST(o_custkey % 24 AS INTEGER) * INTERVAL 1 HOUR <= TIMESTAMP '1998-06-15 10:00:00' END")
def filings_of_members(spark, sf_dir):
    """Filings known at a moment, by acceptance date or instant, with each issuer that they belong to."""
    day = F.col("o_orderdate").cast("date")
    accepted = F.col("o_orderdate").cast("timestamp") + F.make_interval(hours=(F.col("o_custkey") % 24).cast("int"))
    filings = B.read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("accession"), day.alias("filing_date"), F.when(F.col("o_orderkey") % 2 == 0, "date").otherwise("datetime").alias("available_precision"), day.alias("available_date"), accepted.alias("available_at"))
    members = B.read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("accession"), F.col("l_suppkey").alias("issuer"))
    return K.filings_as_of(filings, members, MOMENT).select("accession", "issuer", "filing_date")


_FACTS = f"{B.OBS}, facts AS (SELECT suppkey AS issuer, p_type AS concept, p_size % 3 AS unit, CAST(date_trunc('quarter', available_date) AS DATE) AS period, available_date, key, seq, CAST(quantity AS INT) AS value FROM obs JOIN part ON p_partkey = partkey), mapping AS (SELECT DISTINCT p_type AS concept, p_size % 3 AS unit, lower(p_type) || '_' || (p_size % 3) AS metric FROM part WHERE p_type <> 'PROMO' AND p_size % 3 < 2)"


def _derived(spark, sf_dir):
    part = B.read(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("concept"), (F.col("p_size") % 3).alias("unit"))
    mapping = part.select("concept", "unit", F.concat_ws("_", F.lower("concept"), "unit").alias("metric"), ((F.col("concept") != "PROMO") & (F.col("unit") < 2)).alias("active"))
    obs = B.obs_ledger(spark, sf_dir)
    facts = obs.join(part, F.col("partkey") == F.col("p_partkey")).select(F.col("suppkey").alias("issuer"), "concept", "unit", F.trunc("available_date", "quarter").alias("period"), "available_date", "key", "seq", F.col("quantity").cast("int").alias("value"))
    return K.derive_metrics(facts, mapping, ["concept", "unit"], "metric", ["issuer", "period"], ["available_date", "key", "seq"], "value")


@query("L11_fundamental_versions", f"WITH {_FACTS}, m AS (SELECT f.*, g.metric FROM facts f JOIN mapping g ON f.concept = g.concept AND f.unit = g.unit), c AS (SELECT *, lag(value) OVER w IS NOT DISTINCT FROM value AND lag(seq) OVER w IS NOT NULL AS same FROM m WINDOW w AS (PARTITION BY issuer, period, metric ORDER BY available_date, key, seq)) SELECT issuer, period, metric, value, CAST(row_number() OVER (PARTITION BY issuer, period, metric ORDER BY available_date, key, seq) AS INTEGER) AS sequence FROM c WHERE NOT same")
def fundamental_versions(spark, sf_dir):
    """Versions of metrics behind the mapping."""
    return _derived(spark, sf_dir)[0].select("issuer", "period", "metric", "value", "sequence")


@query("L11_unmapped_facts", f"WITH {_FACTS} SELECT f.key, f.seq, f.concept, f.unit FROM facts f WHERE NOT EXISTS (SELECT 1 FROM mapping g WHERE f.concept = g.concept AND f.unit = g.unit)")
def unmapped(spark, sf_dir):
    return _derived(spark, sf_dir)[1].select("key", "seq", "concept", "unit")


_ASSERTED = f"WITH {B.INTERVALS}, i2 AS (SELECT * FROM intervals UNION ALL SELECT symbol, target + 1, priority, valid_from, valid_through FROM intervals WHERE symbol % 7 = 0), asserted AS (SELECT o_orderkey AS assertion, o_custkey AS symbol, CAST(o_orderdate AS DATE) - 30 AS d FROM orders), c AS (SELECT a.assertion, a.symbol, a.d, count(i.symbol) AS n, min(i.target) AS target FROM asserted a LEFT JOIN i2 i ON i.symbol = a.symbol AND i.valid_from <= a.d AND (i.valid_through IS NULL OR i.valid_through >= a.d) GROUP BY 1, 2, 3)"


def _assertions(spark, sf_dir):
    held = B.intervals(spark, sf_dir)
    held = held.unionByName(held.filter("symbol % 7 = 0").withColumn("target", F.col("target") + 1))
    asserted = B.read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("assertion"), F.col("o_custkey").alias("symbol"), F.date_sub(F.col("o_orderdate").cast("date"), 30).alias("d"))
    return K.assert_links(asserted, held, "symbol", "d", ["assertion"], "target", ["symbol"], ["d", "assertion"])


@query("L12_link_assertion_versions", f"{_ASSERTED}, g AS (SELECT *, lag(target) OVER w IS NOT DISTINCT FROM target AND lag(assertion) OVER w IS NOT NULL AS same FROM c WHERE n = 1 WINDOW w AS (PARTITION BY symbol ORDER BY d, assertion)) SELECT symbol, assertion, target, CAST(row_number() OVER (PARTITION BY symbol ORDER BY d, assertion) AS INTEGER) AS sequence FROM g WHERE NOT same")
def assertion_versions(spark, sf_dir):
    """Versions of what a symbol stands for, from assertions that one security covers."""
    return _assertions(spark, sf_dir)[0].select("symbol", "assertion", "target", "sequence")


@query("L12_refused_assertions", f"{_ASSERTED} SELECT assertion, CASE n WHEN 0 THEN 'unknown' ELSE 'ambiguous' END AS status FROM c WHERE n <> 1")
def refused_assertions(spark, sf_dir):
    return _assertions(spark, sf_dir)[1]


_AUDITED = f"{B.OBS}, v AS (SELECT key, seq AS sequence, seq AS version, CASE WHEN seq > 1 AND suppkey % 40 <> 0 THEN CASE WHEN suppkey % 41 = 0 THEN 99 ELSE seq - 1 END END AS supersedes, CASE WHEN partkey % 13 <> 0 THEN quantity END AS value, CASE WHEN partkey % 17 = 0 THEN 'r' END AS reason, state, CASE WHEN suppkey % 2 = 0 THEN 'omitted' END AS state_reason, line AS scope FROM obs)"


@query(
    "J4_ledger_rules",
    f"WITH {_AUDITED}, s AS (SELECT *, count(*) FILTER (WHERE supersedes IS NULL) OVER (PARTITION BY key) AS starts FROM v) SELECT key, sequence, 'value_xor_reason' AS rule FROM s WHERE state <> 'tombstone' AND (value IS NULL) <> (reason IS NOT NULL) UNION ALL SELECT key, sequence, 'tombstone_has_reason' FROM s WHERE state = 'tombstone' AND state_reason IS NULL "
    "UNION ALL SELECT key, sequence, 'tombstone_of_complete_scope' FROM s WHERE state = 'tombstone' AND scope % 2 <> 0 UNION ALL SELECT key, sequence, 'one_start' FROM s WHERE starts <> 1 AND supersedes IS NULL UNION ALL SELECT key, sequence, 'supersedes_other_key' FROM s WHERE supersedes = 99 UNION ALL SELECT key, sequence, 'changed_or_deleted' FROM v WHERE key % 100 = 1",
)
def ledger_rules(spark, sf_dir):
    """All rules of an append-only ledger; some rows of the copy of before had another value."""
    obs = B.obs_ledger(spark, sf_dir)
    other = F.when(F.col("suppkey") % 41 == 0, F.lit(99)).otherwise(F.col("seq") - 1)
    v = obs.select("key", F.col("seq").alias("sequence"), F.col("seq").alias("version"), F.when((F.col("seq") > 1) & (F.col("suppkey") % 40 != 0), other).alias("supersedes"), F.when(F.col("partkey") % 13 != 0, F.col("quantity")).alias("value"), F.when(F.col("partkey") % 17 == 0, "r").alias("reason"), "state", F.when(F.col("suppkey") % 2 == 0, "omitted").alias("state_reason"), F.col("line").alias("scope"))
    scopes = v.select("scope").distinct().withColumn("complete", F.col("scope") % 2 == 0)
    before = v.withColumn("state_reason", F.when(F.col("key") % 100 == 1, "another").otherwise(F.col("state_reason")))
    return Q.ledger_audit(v, ["key"], scopes, "scope", before, ["version", "value", "state", "state_reason"])


_SCOPED = f"WITH {B.BARS}, files AS (SELECT symbol, trade_date FROM bars WHERE NOT (symbol % 6 = 0 AND volume % 3 = 0) UNION ALL SELECT symbol, trade_date FROM bars WHERE symbol % 5 = 0 AND volume % 4 = 0 AND symbol % 6 <> 0 UNION ALL SELECT symbol, trade_date + 900 FROM bars WHERE symbol % 9 = 0), scope AS (SELECT symbol, min(trade_date) AS a, max(trade_date) AS b, list(DISTINCT trade_date) AS days, count(*) AS n FROM bars WHERE symbol % 11 <> 0 GROUP BY 1), found AS (SELECT symbol, count(*) AS n, min(trade_date) AS lo, max(trade_date) AS hi, list(DISTINCT trade_date) AS days, count(*) > count(DISTINCT trade_date) AS twice FROM files GROUP BY 1), m AS (SELECT coalesce(s.symbol, f.symbol) AS symbol, s.n AS asked, f.n AS n, a, b, lo, hi, twice, s.days AS expected, f.days AS there FROM scope s FULL OUTER JOIN found f ON s.symbol = f.symbol)"


@query(
    "S2_price_file_scope",
    f"{_SCOPED} SELECT symbol, 'no_scope' AS rule FROM m WHERE asked IS NULL UNION ALL SELECT symbol, 'out_of_scope' FROM m WHERE asked IS NOT NULL AND (lo < a OR hi > b) UNION ALL SELECT symbol, 'duplicate_key' FROM m WHERE twice UNION ALL SELECT symbol, 'missing_day' FROM m WHERE asked IS NOT NULL AND len(list_filter(expected, lambda d: NOT list_contains(coalesce(there, []), d))) > 0 "
    "UNION ALL SELECT symbol, 'unexpected_day' FROM m WHERE asked IS NOT NULL AND there IS NOT NULL AND len(list_filter(there, lambda d: NOT list_contains(expected, d))) > 0 UNION ALL SELECT symbol, 'row_count' FROM m WHERE asked IS NOT NULL AND coalesce(n, 0) <> asked",
)
def price_scope(spark, sf_dir):
    """Files of bars against what was asked for: days, keys and number of rows."""
    bars = B.bars(spark, sf_dir).select("symbol", "trade_date", "volume")
    files = bars.filter("NOT (symbol % 6 = 0 AND volume % 3 = 0)").unionByName(bars.filter("symbol % 5 = 0 AND volume % 4 = 0 AND symbol % 6 <> 0")).unionByName(bars.filter("symbol % 9 = 0").withColumn("trade_date", F.date_add("trade_date", 900)))
    scope = bars.filter("symbol % 11 <> 0").groupBy("symbol").agg(F.min("trade_date").alias("first_day"), F.max("trade_date").alias("last_day"), F.collect_set("trade_date").alias("days"), F.count(F.lit(1)).alias("expected_rows"))
    return Q.scope_faults(files, scope, ["symbol"], ["trade_date"], "trade_date")


@query("X9_lineage_flags", f"WITH {B.OBS}, f AS (SELECT suppkey, available_date, key, seq, [CASE WHEN quantity > 25 THEN 'large' ELSE 'small' END, CASE WHEN state = 'tombstone' THEN 'omitted' ELSE 'there' END] AS flags FROM obs) SELECT suppkey, available_date, list_sort(list(DISTINCT key || '/' || seq)) AS lineage, list_sort(list_distinct(flatten(list(flags)))) AS quality_flags, ['resample:sum', 'return:trailing'] AS transformations FROM f GROUP BY 1, 2")
def lineage_flags(spark, sf_dir):
    flags = F.array(F.when(F.col("quantity") > 25, "large").otherwise("small"), F.when(F.col("state") == "tombstone", "omitted").otherwise("there"))
    return S.lineage_with_flags(B.obs_ledger(spark, sf_dir).withColumn("flags", flags), ["suppkey", "available_date"], [F.col("key"), F.col("seq")], "flags", ["resample:sum", "return:trailing"])


@query("D8_quarter_on_quarter", f"WITH {B.ORDER_SERIES}, q AS (SELECT series_id, CAST(date_trunc('quarter', period_start) AS DATE) AS period_start, sum(value) AS value FROM orders_daily GROUP BY 1, 2) SELECT a.series_id, a.period_start, round(100 * (a.value / b.value - 1), 4) AS change FROM q a LEFT JOIN q b ON b.series_id = a.series_id AND b.period_start = CAST(a.period_start - INTERVAL 3 MONTH AS DATE)")
def quarter_on_quarter(spark, sf_dir):
    quarters = B.order_series(spark, sf_dir).groupBy("series_id", F.trunc("period_start", "quarter").alias("period_start")).agg(F.sum("value").alias("value"))
    return rounded(D.calendar_change(quarters, 3), "change", places=4)


@query("D15_vix_fix_bands", f"WITH {B.BARS}, t AS (SELECT *, row_number() OVER w AS i, max(close) OVER v AS top FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY trade_date), v AS (PARTITION BY symbol ORDER BY trade_date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)), f AS (SELECT symbol, trade_date, i, CASE WHEN i >= 5 THEN 100 * (top - low) / nullif(top, 0) END AS fix FROM t) SELECT symbol, trade_date, round(fix, 6) AS vix_fix, CASE WHEN i >= 8 THEN round(avg(fix) OVER b - 2.0 * stddev_pop(fix) OVER b, 6) END AS lower_band, CASE WHEN i >= 8 THEN round(avg(fix) OVER b + 2.0 * stddev_pop(fix) OVER b, 6) END AS upper_band, CASE WHEN i >= 10 THEN round(max(fix) OVER r * 0.85, 6) END AS range_high, CASE WHEN i >= 10 THEN round(min(fix) OVER r * 1.01, 6) END AS range_low FROM f WINDOW b AS (PARTITION BY symbol ORDER BY trade_date ROWS BETWEEN 3 PRECEDING AND CURRENT ROW), r AS (PARTITION BY symbol ORDER BY trade_date ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)")
def vix_bands(spark, sf_dir):
    """With windows of 5, 4 and 6 bars, as the bars are few; the defaults are 22, 20 and 50."""
    return rounded(D.vix_fix(B.bars(spark, sf_dir), 5, 4, 2.0, 6), "vix_fix", "lower_band", "upper_band", "range_high", "range_low")


@query("D21_surface_by_expiry", f"{options_sql('contracts', 'surface')}, c AS (SELECT DISTINCT capture, contract, expiration FROM contracts) SELECT capture, expiration, count(*) FILTER (WHERE surface_state = 'present') AS present, min(implied_volatility) FILTER (WHERE surface_state = 'present') AS iv_low, max(implied_volatility) FILTER (WHERE surface_state = 'present') AS iv_high, round(avg(implied_volatility) FILTER (WHERE surface_state = 'present'), 6) AS iv_mean FROM surface JOIN c USING (capture, contract) GROUP BY 1, 2")
def surface_by_expiry(spark, sf_dir):
    return rounded(D.surface_by_expiry(options_table(spark, sf_dir, "surface"), options_table(spark, sf_dir, "contracts")), "iv_mean")


@query("D22_strategy_greeks", f"{options_sql('surface')} SELECT capture AS strategy, count(*) AS legs, round(sum(line * 100 * delta), 6) AS delta, round(sum(line * 100 * gamma), 6) AS gamma, CASE WHEN count(*) FILTER (WHERE surface_state = 'missing') = 0 THEN round(sum(line * 100 * theta), 6) END AS theta, round(sum(line * 100 * vega), 6) AS vega, round(sum(line * 100 * rho), 6) AS rho FROM surface GROUP BY 1")
def strategy_greeks(spark, sf_dir):
    """A capture's rows as the legs of a strategy; where a leg lacks a theta, the strategy has none."""
    legs = options_table(spark, sf_dir, "surface").withColumns({"strategy": F.col("capture"), "quantity": F.col("line"), "multiplier": F.lit(100), "theta": F.when(F.col("surface_state") != "missing", F.col("theta"))})
    return rounded(D.aggregate_greeks(legs, ["strategy"]), *D.GREEKS)


_SIGNAL = f"WITH {B.BARS}, f AS (SELECT symbol, trade_date, close AS signal, lead(close) OVER (PARTITION BY symbol ORDER BY trade_date) - close AS outcome FROM bars), m AS (SELECT *, ntile(5) OVER (PARTITION BY trade_date ORDER BY signal, symbol) AS bucket FROM f WHERE signal IS NOT NULL AND outcome IS NOT NULL)"


def _signal(spark, sf_dir):
    w = Window.partitionBy("symbol").orderBy("trade_date")
    return B.bars(spark, sf_dir).select("symbol", "trade_date", F.col("close").alias("signal"), (F.lead("close").over(w) - F.col("close")).alias("outcome"))


@query("D23_signal_quantiles", f"{_SIGNAL} SELECT trade_date, CAST(bucket AS INTEGER) AS bucket, count(*) AS n, round(avg(outcome), 6) AS mean_outcome FROM m GROUP BY 1, 2")
def signal_quantiles(spark, sf_dir):
    return rounded(D.signal_quantiles(_signal(spark, sf_dir), "trade_date", "signal", "outcome", 5), "mean_outcome")


@query("D23_signal_turnover", f"{_SIGNAL}, d AS (SELECT trade_date, lag(trade_date) OVER (ORDER BY trade_date) AS before FROM (SELECT DISTINCT trade_date FROM m)) SELECT m.trade_date, CAST(m.bucket AS INTEGER) AS bucket, CASE WHEN max(d.before) IS NOT NULL THEN round(1 - count(o.symbol) / count(*), 6) END AS turnover FROM m JOIN d USING (trade_date) LEFT JOIN m o ON o.trade_date = d.before AND o.symbol = m.symbol AND o.bucket = m.bucket GROUP BY 1, 2")
def signal_turnover(spark, sf_dir):
    return rounded(D.signal_turnover(_signal(spark, sf_dir), "trade_date", "signal", "outcome", 5), "turnover")


_SETUP = {"event": "line = 1", "consensus": "line = 2", "guidance": "line = 3", "fundamental": "line >= 4"}


@query(
    "D19_setup_by_period",
    f"WITH {B.OBS}, o AS (SELECT *, suppkey AS issuer, CAST(date_trunc('quarter', available_date) AS DATE) AS period FROM obs), "
    + ", ".join(f"{n} AS (SELECT issuer, period, arg_max(value, (available_at, key, seq)) AS v FROM (SELECT *, row_number() OVER (PARTITION BY issuer, period, line ORDER BY available_at DESC, key DESC, seq DESC) AS rn FROM o WHERE {w} AND {seen_sql(MOMENT)}) t WHERE rn = 1 AND state = 'active' GROUP BY 1, 2)" for n, w in _SETUP.items())
    + ", k AS ("
    + " UNION ".join(f"SELECT issuer, period FROM {n}" for n in _SETUP)
    + ") SELECT k.issuer, k.period, "
    + ", ".join(f"{n}.v AS {n}" for n in _SETUP)
    + " FROM k "
    + " ".join(f"LEFT JOIN {n} ON {n}.issuer = k.issuer AND {n}.period = k.period" for n in _SETUP),
)
def setup_by_period(spark, sf_dir):
    """Event, consensus, guidance and fundamentals of every issuer and quarter, all as known at one moment."""
    obs = B.obs_ledger(spark, sf_dir).withColumns({"issuer": F.col("suppkey"), "period": F.trunc("available_date", "quarter")})
    spec = L.LedgerSpec(key=("issuer", "period", "line"), rank=("available_at", "key", "seq"), state="state")
    return K.setup_at({name: (obs.filter(where), spec, "value") for name, where in _SETUP.items()}, ["issuer", "period"], MOMENT)
