"""Queries of version selection and ledger building (P, A, L, F)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions import scalars
from tidemark.functions.temporal import CALENDAR_DATE_INCLUSIVE, COMPLETED_DATE, Temporal, bucket_end, bucket_start, cutoff, effective_on, month_bounds, parse_temporal, pit_visible, pit_warning
from tidemark.operators import ledger as L
from tidemark.plans import bindings as B
from tidemark.plans.registry import ORACLE_SQL, query

DAY, MOMENT = "1998-06-15", "1998-06-15T10:00:00Z"
SPEC = L.LedgerSpec(key=("key",), rank=("seq",), payload=("value",), state="state")


def available() -> Temporal:
    return SPEC.availability()


def seen_sql(at: str, policy: str = COMPLETED_DATE) -> str:
    """The visibility rule as SQL over the ledger's columns."""
    if "T" not in at:
        return f"available_date <= DATE '{at}'"
    day, op = at[:10], "<=" if policy == CALENDAR_DATE_INCLUSIVE else "<"
    return f"CASE WHEN available_precision = 'date' THEN available_date {op} DATE '{day}' ELSE available_at <= TIMESTAMP '{at[:19].replace('T', ' ')}' END"


def top_sql(columns: str, where: str = "TRUE", order: str = "seq DESC", after: str = "state = 'active'", source: str = B.OBS, table: str = "obs", key: str = "key") -> str:
    return f"WITH {source} SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn FROM {table} WHERE {where}) t WHERE rn = 1 AND {after}"


for _at, _name in ((DAY, "date"), (MOMENT, "datetime")):
    for _policy in (COMPLETED_DATE, CALENDAR_DATE_INCLUSIVE):
        _warn = "CASE WHEN available_precision = 'date' AND available_date = DATE '1998-06-15' THEN 1 ELSE 0 END" if _name == "datetime" and _policy == CALENDAR_DATE_INCLUSIVE else "0"

        @query(f"P1_pit_visible_{_name}_{_policy}", f"WITH {B.OBS} SELECT available_precision, count(*) AS n, CAST(sum({_warn}) AS BIGINT) AS warned FROM obs WHERE {seen_sql(_at, _policy)} GROUP BY 1")
        def _visible(spark, sf_dir, at=_at, policy=_policy):
            rows = B.obs_ledger(spark, sf_dir).filter(pit_visible(available(), cutoff(at), policy))
            return rows.groupBy("available_precision").agg(F.count(F.lit(1)).alias("n"), F.count(pit_warning(available(), cutoff(at), policy)).alias("warned"))


@query("P2_temporal_parse", "SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'date' WHEN o_orderkey % 3 = 1 THEN 'datetime' END AS precision, count(*) AS n, min(CASE WHEN o_orderkey % 3 < 2 THEN CAST(o_orderdate AS DATE) END) AS first_date, max(CASE WHEN o_orderkey % 3 = 1 THEN CAST(o_orderdate AS TIMESTAMP) + INTERVAL 13 HOUR END) AS last_instant FROM orders GROUP BY 1")
def temporal_parse(spark, sf_dir):
    """Orders' dates written as a date, as a datetime with offset, and as a naive datetime, which is refused."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    raw = F.when(F.col("o_orderkey") % 3 == 0, day).when(F.col("o_orderkey") % 3 == 1, F.concat(day, F.lit("T09:00:00-04:00"))).otherwise(F.concat(day, F.lit("T09:00:00")))
    parsed = parse_temporal(raw)
    rows = B.read(spark, sf_dir, "orders").select(parsed.precision.alias("precision"), parsed.written_date.alias("d"), parsed.instant.alias("t"))
    return rows.groupBy("precision").agg(F.count(F.lit(1)).alias("n"), F.min("d").alias("first_date"), F.max(F.col("t").cast("timestamp_ntz")).alias("last_instant"))


@query("P3_precision_consistent", "SELECT o_orderpriority AS priority, count(*) FILTER (WHERE o_orderkey % 5 = 0) AS wrong FROM orders GROUP BY 1")
def precision_consistent(spark, sf_dir):
    """Where the stored precision isn't the one that the text has."""
    raw = F.date_format("o_orderdate", "yyyy-MM-dd")
    stored = F.when(F.col("o_orderkey") % 5 == 0, "datetime").otherwise("date")
    return B.read(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("priority")).agg(F.count_if(~parse_temporal(raw).precision.eqNullSafe(stored)).alias("wrong"))


@query("P4_period_range", f"WITH {B.ORDER_SERIES} SELECT series_id, period_start, value FROM orders_daily WHERE period_start BETWEEN DATE '1997-01-01' AND DATE '1997-03-31'")
def period_range(spark, sf_dir):
    return B.order_series(spark, sf_dir).filter(F.col("period_start").between("1997-01-01", "1997-03-31")).select("series_id", "period_start", "value")


@query("P5_effective_on", f"WITH {B.INTERVALS} SELECT symbol, target, valid_from, valid_through FROM intervals WHERE valid_from <= DATE '1998-01-01' AND (valid_through IS NULL OR valid_through >= DATE '1998-01-01')")
def effective(spark, sf_dir):
    return B.intervals(spark, sf_dir).filter(effective_on(F.col("valid_from"), F.col("valid_through"), F.lit("1998-01-01").cast("date"))).select("symbol", "target", "valid_from", "valid_through")


@query("P6_active_only", top_sql("key, seq, value", seen_sql(DAY)))
def active_only(spark, sf_dir):
    chosen = L.top_version(L.visible(B.obs_ledger(spark, sf_dir), SPEC, DAY), SPEC)
    return L.active_only(chosen, SPEC).select("key", "seq", "value")


@query("P7_like_search", "SELECT p_partkey, p_name, p_brand FROM part WHERE contains(lower(p_name || ' ' || p_brand), 'red widget brand#1')")
def like_search(spark, sf_dir):
    return B.read(spark, sf_dir, "part").filter(scalars.contains_literal("Red Widget brand#1", F.col("p_name"), F.col("p_brand"))).select("p_partkey", "p_name", "p_brand")


@query("P8_fixed_projection", "SELECT c_custkey AS issuer, c_name AS legal_name, c_mktsegment AS entity_type, n_name AS country FROM customer JOIN nation ON c_nationkey = n_nationkey")
def fixed_projection(spark, sf_dir):
    nation = B.read(spark, sf_dir, "nation")
    return B.read(spark, sf_dir, "customer").join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("issuer"), F.col("c_name").alias("legal_name"), F.col("c_mktsegment").alias("entity_type"), F.col("n_name").alias("country"))


@query("P9_scalar_projection", "SELECT o_orderkey AS accession, o_custkey AS issuer, CAST(o_orderdate AS DATE) AS filing_date, o_orderstatus AS form FROM orders")
def scalar_projection(spark, sf_dir):
    return B.read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("accession"), F.col("o_custkey").alias("issuer"), F.col("o_orderdate").cast("date").alias("filing_date"), F.col("o_orderstatus").alias("form"))


@query("P10_json_type_check", "SELECT event_id, 'k_is_integer' AS rule FROM events WHERE TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) IS NULL OR event_id % 7 = 0")
def json_type_check(spark, sf_dir):
    """Events whose property k isn't an integer; every seventh is made a text."""
    raw = F.when(F.col("event_id") % 7 == 0, F.lit("x")).otherwise(F.get_json_object("props", "$.k"))
    return B.read(spark, sf_dir, "events").filter(raw.try_cast("int").isNull()).select("event_id", F.lit("k_is_integer").alias("rule"))


@query("A1_macro_latest", top_sql("key, seq, value", after="TRUE"))
def macro_latest(spark, sf_dir):
    return L.ledger_select(B.obs_ledger(spark, sf_dir), SPEC, active=False).select("key", "seq", "value")


@query("A2_price_latest", top_sql("symbol, trade_date, line, close", source=f"{B.OBS}, quotes AS (SELECT partkey % 200 AS symbol, available_date AS trade_date, line, value AS close, seq, key, state FROM obs)", table="quotes", key="symbol, trade_date", order="line DESC, key DESC, seq DESC"))
def price_latest(spark, sf_dir):
    spec = L.LedgerSpec(key=("symbol", "trade_date"), rank=("line", "key", "seq"), state="state")
    quotes = B.obs_ledger(spark, sf_dir).select((F.col("partkey") % 200).alias("symbol"), F.col("available_date").alias("trade_date"), "line", F.col("value").alias("close"), "seq", "key", "state", "available_precision", "available_date", "available_at")
    return L.ledger_select(quotes, spec).select("symbol", "trade_date", "line", "close")


@query("A3_price_as_of", top_sql("key, seq, value, state", seen_sql(MOMENT), after="TRUE"))
def price_as_of(spark, sf_dir):
    return L.ledger_select(B.obs_ledger(spark, sf_dir), SPEC, MOMENT, active=False).select("key", "seq", "value", "state")


@query("A4_macro_as_of", top_sql("key, seq, value", seen_sql(MOMENT, CALENDAR_DATE_INCLUSIVE), after="TRUE"))
def macro_as_of(spark, sf_dir):
    return L.ledger_select(B.obs_ledger(spark, sf_dir), SPEC, MOMENT, CALENDAR_DATE_INCLUSIVE, active=False).select("key", "seq", "value")


@query("A5_macro_first_release", top_sql("key, seq, value", "is_first", "seq", "TRUE"))
def macro_first_release(spark, sf_dir):
    return L.first_release(B.obs_ledger(spark, sf_dir), SPEC, "is_first").select("key", "seq", "value")


@query("A6_ledger_as_of", top_sql("key, seq, value, available_date", seen_sql(DAY)))
def ledger_as_of(spark, sf_dir):
    return L.ledger_select(B.obs_ledger(spark, sf_dir), SPEC, DAY).select("key", "seq", "value", "available_date")


_WRITTEN = "CAST(available_at + CASE partkey % 3 WHEN 0 THEN INTERVAL 14 HOUR WHEN 1 THEN -INTERVAL 12 HOUR ELSE INTERVAL 0 HOUR END AS DATE)"


@query(
    "A6_ledger_as_of_offsets",
    f"WITH {B.OBS}, w AS (SELECT * REPLACE (CASE WHEN available_precision = 'date' THEN available_date ELSE {_WRITTEN} END AS available_date) FROM obs) SELECT key, seq, value, available_date FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY seq DESC) AS rn FROM w WHERE CASE WHEN available_precision = 'date' THEN available_date < DATE '1998-06-15' ELSE available_at <= TIMESTAMP '1998-06-16 11:00:00' END) t WHERE rn = 1 AND state = 'active'",
)
def ledger_as_of_offsets(spark, sf_dir):
    """Instants written with offsets of +14, -12 and 0 hours, at a cutoff of -12: dates as written differ by two days."""
    hours = F.when(F.col("partkey") % 3 == 0, 14).when(F.col("partkey") % 3 == 1, -12).otherwise(0)
    written = (F.col("available_at") + F.make_interval(hours=hours)).cast("date")
    rows = B.obs_ledger(spark, sf_dir).withColumn("available_date", F.when(F.col("available_precision") == "date", F.col("available_date")).otherwise(written))
    return L.ledger_select(rows, SPEC, "1998-06-15T23:00:00-12:00").select("key", "seq", "value", "available_date")


@query("A7_issuer_as_of", "SELECT c_custkey AS issuer, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS entity_state, count(*) AS versions, c_name AS legal_name FROM customer JOIN orders ON o_custkey = c_custkey WHERE o_orderdate <= DATE '1998-06-15' GROUP BY 1, 4")
def issuer_as_of(spark, sf_dir):
    """Issuers with the state of their last version at the cutoff."""
    versions = B.read(spark, sf_dir, "orders").filter(F.col("o_orderdate") <= F.lit(DAY).cast("date"))
    last = versions.groupBy("o_custkey").agg(F.max_by("o_orderstatus", F.struct("o_orderdate", "o_orderkey")).alias("entity_state"), F.count(F.lit(1)).alias("versions"))
    return B.read(spark, sf_dir, "customer").join(last, F.col("c_custkey") == F.col("o_custkey")).select(F.col("c_custkey").alias("issuer"), "entity_state", "versions", F.col("c_name").alias("legal_name"))


@query("A8_issuer_links_as_of", f"WITH {B.OBS} SELECT suppkey, partkey, seq, state FROM (SELECT *, row_number() OVER (PARTITION BY suppkey, partkey ORDER BY available_date DESC, key DESC, seq DESC) AS rn FROM obs WHERE {seen_sql(DAY)}) t WHERE rn = 1 AND state = 'active'")
def issuer_links(spark, sf_dir):
    spec = L.LedgerSpec(key=("suppkey", "partkey"), rank=("available_date", "key", "seq"), state="state")
    return L.ledger_select(B.obs_ledger(spark, sf_dir), spec, DAY).select("suppkey", "partkey", "seq", "state")


@query("A9_fundamentals_as_of", f"WITH {B.OBS}, facts AS (SELECT suppkey AS issuer, partkey % 50 AS metric, CAST(date_trunc('quarter', available_date) AS DATE) AS period, * FROM obs), chosen AS (SELECT *, row_number() OVER (PARTITION BY issuer, metric, period ORDER BY available_at DESC, key DESC, seq DESC) AS rn FROM facts WHERE {seen_sql(DAY)}) SELECT issuer, period, metric, value FROM chosen WHERE rn = 1 AND metric < 10")
def fundamentals_as_of(spark, sf_dir):
    """One value of each metric and quarter, for a list of metrics."""
    facts = B.obs_ledger(spark, sf_dir).withColumns({"issuer": F.col("suppkey"), "metric": F.col("partkey") % 50, "period": F.trunc("available_date", "quarter")}).filter("metric < 10")
    spec = L.LedgerSpec(key=("issuer", "metric", "period"), rank=("available_at", "key", "seq"))
    return L.ledger_select(facts, spec, DAY).select("issuer", "period", "metric", "value")


@query("A10_corporate_actions_as_of", f"WITH {B.OBS}, chosen AS (SELECT *, row_number() OVER (PARTITION BY key, line ORDER BY seq DESC) AS rn FROM obs WHERE {seen_sql(DAY)}) SELECT key AS event_id, line AS provider, available_date AS event_date, value AS cash_amount FROM chosen WHERE rn = 1 AND state = 'active'")
def corporate_actions(spark, sf_dir):
    spec = L.LedgerSpec(key=("key", "line"), rank=("seq",), state="state")
    return L.ledger_select(B.obs_ledger(spark, sf_dir), spec, DAY).select(F.col("key").alias("event_id"), F.col("line").alias("provider"), F.col("available_date").alias("event_date"), F.col("value").alias("cash_amount"))


def _family(name, key_sql, key, columns):
    sql = f"WITH {B.OBS}, f AS (SELECT *, {key_sql} FROM obs) SELECT {', '.join(columns)} FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(key)} ORDER BY available_at DESC, key DESC, seq DESC) AS rn FROM f WHERE {seen_sql(MOMENT)}) t WHERE rn = 1"

    @query(name, sql)
    def run(spark, sf_dir):
        made = {"metric": F.col("partkey") % 20, "period": F.trunc("available_date", "quarter"), "event": F.col("key") % 500, "target": F.trunc("available_date", "year")}
        rows = B.obs_ledger(spark, sf_dir).withColumns({k: v for k, v in made.items() if k in key})
        return L.ledger_select(rows, L.LedgerSpec(key=key, rank=("available_at", "key", "seq")), MOMENT).select(*columns)

    return run


_family("A11_consensus_as_of", "partkey % 20 AS metric, CAST(date_trunc('quarter', available_date) AS DATE) AS period", ("suppkey", "metric", "period"), ["suppkey", "metric", "period", "value"])
_family("A12_earnings_events_as_of", "key % 500 AS event", ("event",), ["event", "available_date", "line", "value"])
_family("A13_guidance_as_of", "partkey % 20 AS metric, CAST(date_trunc('year', available_date) AS DATE) AS target", ("metric", "target"), ["metric", "target", "value", "quantity"])


@query("A14_filings_as_of", "SELECT c_mktsegment AS kind, o_orderkey AS accession, CAST(o_orderdate AS DATE) AS filing_date FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderdate <= DATE '1998-06-15'")
def filings_as_of(spark, sf_dir):
    filings = B.read(spark, sf_dir, "orders").filter(F.col("o_orderdate") <= F.lit(DAY).cast("date"))
    return filings.join(B.read(spark, sf_dir, "customer"), F.col("c_custkey") == F.col("o_custkey")).select(F.col("c_mktsegment").alias("kind"), F.col("o_orderkey").alias("accession"), F.col("o_orderdate").cast("date").alias("filing_date"))


NEWS_SPEC = L.LedgerSpec(key=("item",), rank=("version",), state="state")


@query("A15_news_as_of", f"WITH {B.NEWS} SELECT item, version, lane FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY version DESC) AS rn FROM news WHERE available_at <= TIMESTAMP '2024-01-04 00:00:00') t WHERE rn = 1 AND state = 'active'")
def news_as_of(spark, sf_dir):
    return L.ledger_select(B.news(spark, sf_dir), NEWS_SPEC, "2024-01-04T00:00:00Z").select("item", "version", "lane")


@query("A16_classification_as_of", f"WITH {B.INTERVALS}, every AS (SELECT * FROM intervals UNION ALL SELECT symbol, target + 1, 'X', valid_from - 30, valid_through FROM intervals WHERE symbol % 5 = 0), e AS (SELECT * FROM every WHERE valid_from <= DATE '1998-01-01' AND (valid_through IS NULL OR valid_through >= DATE '1998-01-01')), c AS (SELECT *, row_number() OVER (PARTITION BY symbol, valid_from ORDER BY target DESC) AS rn FROM e) SELECT symbol, count(*) AS intervals, CASE WHEN count(*) > 1 THEN 'conflict' ELSE 'resolved' END AS status, CASE WHEN count(*) = 1 THEN max(priority) END AS priority FROM c WHERE rn = 1 GROUP BY symbol")
def classification_as_of(spark, sf_dir):
    rows = B.intervals(spark, sf_dir)
    more = rows.filter("symbol % 5 = 0").select("symbol", (F.col("target") + 1).alias("target"), F.lit("X").alias("priority"), F.date_sub("valid_from", 30).alias("valid_from"), "valid_through")
    known = rows.unionByName(more).withColumns({"available_precision": F.lit("date"), "available_date": F.lit("1990-01-01").cast("date"), "available_at": F.lit(None).cast("timestamp")})
    return L.effective_value(known, L.LedgerSpec(key=("symbol", "valid_from"), rank=("target",)), ["symbol"], "1998-01-01", DAY, ["priority"])


@query("A17_universe_members_as_of", f"WITH {B.MEMBERS}, v AS (SELECT universe, member, snapshot, CASE WHEN member % 4 = 0 AND snapshot >= DATE '1997-01-01' THEN 'tombstone' ELSE 'active' END AS state FROM members) SELECT universe, member, snapshot FROM (SELECT *, row_number() OVER (PARTITION BY universe, member ORDER BY snapshot DESC) AS rn FROM v WHERE snapshot <= DATE '1998-01-01') t WHERE rn = 1 AND state = 'active'")
def universe_members(spark, sf_dir):
    state = F.when((F.col("member") % 4 == 0) & (F.col("snapshot") >= F.lit("1997-01-01").cast("date")), "tombstone").otherwise("active")
    rows = B.members(spark, sf_dir).withColumns({"state": state, "valid_from": F.col("snapshot"), "valid_through": F.lit(None).cast("date"), "available_precision": F.lit("date"), "available_date": F.col("snapshot"), "available_at": F.lit(None).cast("timestamp")})
    return L.effective_members(rows, L.LedgerSpec(key=("universe", "member"), rank=("snapshot",), state="state"), "1998-01-01", DAY).select("universe", "member", "snapshot")


@query("A18_option_capture_as_of", "SELECT o_custkey AS underlying, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS capture FROM orders WHERE o_orderdate <= DATE '1998-06-15' GROUP BY 1")
def option_capture(spark, sf_dir):
    captures = B.read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("underlying"), F.col("o_orderkey").alias("capture"), F.lit("date").alias("available_precision"), F.col("o_orderdate").cast("date").alias("available_date"), F.lit(None).cast("timestamp").alias("available_at"))
    return L.ledger_select(captures, L.LedgerSpec(key=("underlying",), rank=("available_date", "capture")), DAY).select("underlying", "capture")


for _name, _key, _source in (("market", "partkey", "obs"), ("company", "suppkey", "obs"), ("gdp", "line", "obs")):

    @query(f"A19_snapshot_projection_{_name}", f"WITH {B.OBS} SELECT {_key} AS subject, available_date, key, seq, value FROM (SELECT *, row_number() OVER (PARTITION BY {_key}, available_date ORDER BY key DESC, seq DESC) AS rn FROM obs WHERE {seen_sql(MOMENT)}) t WHERE rn = 1")
    def _projection(spark, sf_dir, key=_key):
        spec = L.LedgerSpec(key=(key, "available_date"), rank=("key", "seq"))
        return L.ledger_select(B.obs_ledger(spark, sf_dir), spec, MOMENT).select(F.col(key).alias("subject"), "available_date", "key", "seq", "value")


@query("A19_snapshot_projection_news", f"WITH {B.NEWS} SELECT item, version, state, md5(body) AS digest FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY version DESC) AS rn FROM news) t WHERE rn = 1")
def projection_news(spark, sf_dir):
    return L.ledger_select(B.news(spark, sf_dir), NEWS_SPEC, active=False).select("item", "version", "state", F.md5(F.col("body").cast("binary")).alias("digest"))


@query("A20_vintage_comparison_trail", f"WITH {B.OBS} SELECT key, arg_min(value, seq) FILTER (WHERE is_first) AS first_value, arg_max(value, seq) FILTER (WHERE {seen_sql(DAY)}) AS as_of_value, arg_max(value, seq) AS latest_value FROM obs GROUP BY key")
def vintage_trail(spark, sf_dir):
    return L.vintage_trail(B.obs_ledger(spark, sf_dir), SPEC, "value", "is_first", DAY)


@query("A21_latest_via_max_seq_join", "SELECT o_orderkey AS item, n.seq, n.value FROM orders LEFT JOIN (SELECT * FROM (WITH " + B.OBS + " SELECT *, row_number() OVER (PARTITION BY key ORDER BY seq DESC) AS rn FROM obs) t WHERE rn = 1) n ON n.key = o_orderkey")
def latest_left(spark, sf_dir):
    last = L.ledger_select(B.obs_ledger(spark, sf_dir), SPEC, active=False).select("key", "seq", "value")
    return B.read(spark, sf_dir, "orders").join(last, F.col("o_orderkey") == F.col("key"), "left").select(F.col("o_orderkey").alias("item"), "seq", "value")


# Ledger building. Observations are the lines of a part in time; their payload is the order's quantity band and flag.

OBSERVED = B.OBS + ", observed AS (SELECT suppkey AS subject, partkey % 10 AS metric, available_date AS known_on, key, seq, CAST(quantity / 25 AS INTEGER) AS band, state FROM obs)"
OBSERVED_SPEC = L.LedgerSpec(key=("subject", "metric"), rank=("known_on", "key", "seq"), payload=("band",))


def observed(spark, sf_dir):
    return B.obs_ledger(spark, sf_dir).select(F.col("suppkey").alias("subject"), (F.col("partkey") % 10).alias("metric"), F.col("available_date").alias("known_on"), "key", "seq", F.round(F.col("quantity") / 25).cast("int").alias("band"), "state")


def _append(name, key, payload, payload_sql=None):
    same = " AND ".join(f"lag({p}) OVER w IS NOT DISTINCT FROM {p}" for p in payload)
    keys, values = ", ".join(key), ", ".join(payload)
    sql = f"WITH {OBSERVED}, marked AS (SELECT *, {same} AND lag(seq) OVER w IS NOT NULL AS same FROM observed WINDOW w AS (PARTITION BY {keys} ORDER BY known_on, key, seq)), kept AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY known_on, key, seq) AS sequence FROM marked WHERE NOT same) SELECT {keys}, known_on, {values}, sequence, CASE WHEN sequence > 1 THEN sequence - 1 END AS supersedes FROM kept"

    @query(name, sql)
    def run(spark, sf_dir):
        spec = L.LedgerSpec(key=key, rank=("known_on", "key", "seq"), payload=payload)
        return L.append_changes(observed(spark, sf_dir), spec, spec.rank).select(*key, "known_on", *payload, "sequence", "supersedes")

    return run


_append("L2_ledger_append_changes", ("subject", "metric"), ("band",))
_append("L6_classification_append", ("subject",), ("state",))
_append("L10_sec_fact_append", ("subject", "metric", "state"), ("band",))
_append("L17_issuer_version_append", ("subject",), ("band", "state"))

ORDER = ("available_date", "key", "seq")


def _own_append(name, append, key, payload, columns, instant=None):
    """A family's append; columns has its input columns as SQL and as Spark expressions over the ledger of lines."""
    made = ", ".join(f"{sql} AS {c}" for c, (sql, _) in columns.items())
    same = " AND ".join(f"lag({p}) OVER w IS NOT DISTINCT FROM {p}" for p in payload)
    known = f", CAST({instant} AS DATE) AS available_date, {instant} AS available_at" if instant else ""
    sql = f"WITH {B.OBS}, f AS (SELECT {made}, available_date AS known_on, key, seq FROM obs), marked AS (SELECT *, {same} AND lag(seq) OVER w IS NOT NULL AS same FROM f WINDOW w AS (PARTITION BY {', '.join(key)} ORDER BY known_on, key, seq)), kept AS (SELECT *, row_number() OVER (PARTITION BY {', '.join(key)} ORDER BY known_on, key, seq) AS sequence FROM marked WHERE NOT same) SELECT {', '.join([*key, *payload])}, sequence, CASE WHEN sequence > 1 THEN sequence - 1 END AS supersedes{known} FROM kept"

    @query(name, sql)
    def run(spark, sf_dir):
        rows = B.obs_ledger(spark, sf_dir).select(*[F.expr(spark_sql).alias(c) for c, (_, spark_sql) in columns.items()], F.col("available_date").alias("known_on"), "key", "seq")
        out = append(rows, ("known_on", "key", "seq")).select(*key, *payload, "sequence", "supersedes", *["available_date", "available_at"][: 2 * bool(instant)])
        return out.withColumn("available_at", F.col("available_at").cast("timestamp_ntz")) if instant else out

    return run


def _both(sql):
    return sql, sql


_own_append(
    "L7_treasury_curve_append", L.append_curve, ("provider", "curve_date", "variant", "tenor"), ("value", "reason", "state"),
    {
        "provider": _both("suppkey % 2"), "curve_date": ("CAST(date_trunc('week', available_date) AS DATE)", "CAST(date_trunc('week', available_date) AS DATE)"), "variant": _both("line % 2"), "tenor": _both("partkey % 10"),
        "value": _both("CASE WHEN quantity >= 5 THEN CAST(quantity AS INT) % 4 END"), "reason": _both("CASE WHEN quantity < 5 THEN 'not_quoted' END"), "state": _both("state"), "captured_at": _both("available_at"),
    },
    "captured_at",
)
_own_append(
    "L8_calendar_event_append", L.append_calendar, ("event",), ("actual", "consensus", "previous", "unit"),
    {
        "event": _both("partkey"), "actual": _both("CASE WHEN state = 'active' THEN CAST(quantity AS INT) % 5 END"), "consensus": _both("line % 3"), "previous": _both("suppkey % 2"),
        "unit": _both("CASE WHEN line > 3 THEN 'percent' ELSE 'index' END"), "event_at": _both("available_at"),
    },
    "event_at",
)
_own_append(
    "L13_action_append", L.append_actions, ("event", "provider"), ("kind", "cash_amount", "currency", "split_from", "split_to", "state"),
    {
        "event": _both("partkey"), "provider": _both("line % 2"), "kind": _both("CASE WHEN partkey % 3 = 0 THEN 'split' ELSE 'dividend' END"), "state": _both("state"),
        "cash_amount": ("CASE WHEN partkey % 3 <> 0 THEN suppkey % 4 END", "suppkey % 4"), "currency": ("CASE WHEN partkey % 3 <> 0 THEN 'USD' END", "'USD'"),
        "split_from": ("CASE WHEN partkey % 3 = 0 THEN 1 END", "1"), "split_to": ("CASE WHEN partkey % 3 = 0 THEN suppkey % 3 + 2 END", "suppkey % 3 + 2"),
    },
)
_own_append(
    "L14_consensus_append", lambda rows, order: L.append_expectations(rows, "consensus", order), ("issuer", "metric", "period"), ("value", "analysts", "unit", "state"),
    {"issuer": _both("suppkey"), "metric": _both("partkey % 10"), "period": _both("year(available_date)"), "value": _both("CAST(quantity AS INT) % 3"), "analysts": _both("line % 2"), "unit": _both("'USD'"), "state": _both("state")},
)
_own_append(
    "L14_earnings_event_append", lambda rows, order: L.append_expectations(rows, "earnings_event", order), ("issuer", "event"), ("event_date", "session", "status", "state"),
    {"issuer": _both("suppkey"), "event": _both("partkey % 20"), "event_date": _both("CAST(date_trunc('year', available_date) AS DATE)"), "session": _both("CASE WHEN line % 2 = 0 THEN 'open' ELSE 'close' END"), "status": _both("CASE WHEN quantity > 40 THEN 'confirmed' ELSE 'expected' END"), "state": _both("state")},
)
_own_append(
    "L14_guidance_append", lambda rows, order: L.append_expectations(rows, "guidance", order), ("issuer", "metric", "target"), ("low", "high", "unit", "state"),
    {"issuer": _both("suppkey"), "metric": _both("partkey % 5"), "target": _both("year(available_date)"), "low": _both("CAST(quantity AS INT) % 2"), "high": _both("CAST(quantity AS INT) % 2 + line % 3"), "unit": _both("'USD'"), "state": _both("state")},
)


@query("L1_replay_gate", "SELECT o_custkey AS dataset, o_orderstatus AS identity, count(*) AS batches FROM orders o WHERE NOT EXISTS (SELECT 1 FROM orders l WHERE l.o_orderdate < DATE '1997-01-01' AND l.o_custkey = o.o_custkey AND l.o_orderstatus = o.o_orderstatus) GROUP BY 1, 2 HAVING count(*) > 0")
def replay_gate(spark, sf_dir):
    """Batches that aren't in the log of those before 1997, with how many replays of each there are."""
    orders = B.read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("dataset"), F.col("o_orderstatus").alias("identity"), "o_orderdate")
    new = L.replay_gate(orders, orders.filter(F.col("o_orderdate") < F.lit("1997-01-01").cast("date")), ["dataset", "identity"]).select("dataset", "identity")
    return orders.join(new, ["dataset", "identity"]).groupBy("dataset", "identity").agg(F.count(F.lit(1)).alias("batches"))


@query("L3_current_pointer_forward_only", f"WITH {B.OBS} SELECT partkey AS subject, arg_max(value, (available_date, key, seq)) AS current_value FROM obs GROUP BY 1")
def pointer(spark, sf_dir):
    """The current version in release order, whatever the order of arrival."""
    spec = L.LedgerSpec(key=("partkey",), rank=("available_date", "key", "seq"))
    return L.ledger_select(B.obs_ledger(spark, sf_dir).orderBy(F.xxhash64("key", "seq")), spec).select(F.col("partkey").alias("subject"), F.col("value").alias("current_value"))


def _members(spark, sf_dir, before):
    """Members of the snapshots before a month, as active versions, and those of the month."""
    rows, day = B.members(spark, sf_dir), F.lit(before).cast("date")
    current = rows.filter(F.col("snapshot") < day).groupBy("universe", "member").agg(F.count(F.lit(1)).alias("sequence"), F.min("snapshot").alias("valid_from")).withColumn("state", F.when(F.col("member") % 3 == 0, "tombstone").otherwise("active"))
    return current, rows.filter(F.col("snapshot") == day)


_MEMBERS_SQL = B.MEMBERS + ", cur AS (SELECT universe, member, count(*) AS sequence, min(snapshot) AS valid_from, CASE WHEN member % 3 = 0 THEN 'tombstone' ELSE 'active' END AS state FROM members WHERE snapshot < DATE '1998-03-01' GROUP BY 1, 2), snap AS (SELECT * FROM members WHERE snapshot = DATE '1998-03-01')"


@query("L4_tombstone_omissions", f"WITH {_MEMBERS_SQL} SELECT universe, member, 'tombstone' AS state, '{L.OMITTED}' AS state_reason, sequence + 1 AS sequence, sequence AS supersedes FROM cur c WHERE state = 'active' AND universe IN (SELECT universe FROM snap) AND NOT EXISTS (SELECT 1 FROM snap s WHERE s.universe = c.universe AND s.member = c.member)")
def tombstones(spark, sf_dir):
    current, snapshot = _members(spark, sf_dir, "1998-03-01")
    return L.tombstone_omissions(current, snapshot, ["universe", "member"], snapshot.withColumn("whole", F.lit(True)), ["universe"], "whole")


@query("L4_tombstones_of_partial", f"WITH {_MEMBERS_SQL} SELECT c.universe, count(*) FILTER (WHERE c.universe NOT IN ('1-URGENT', '5-LOW')) AS tombstones FROM cur c WHERE state = 'active' AND universe IN (SELECT universe FROM snap) AND NOT EXISTS (SELECT 1 FROM snap s WHERE s.universe = c.universe AND s.member = c.member) GROUP BY 1")
def partial_tombstones(spark, sf_dir):
    """Snapshots of five universes, of which two are partial: those tombstone nothing."""
    current, snapshot = _members(spark, sf_dir, "1998-03-01")
    scope = snapshot.withColumn("whole", ~F.col("universe").isin("1-URGENT", "5-LOW"))
    gone = L.tombstone_omissions(current, snapshot, ["universe", "member"], scope, ["universe"], "whole").groupBy("universe").agg(F.count(F.lit(1)).alias("n"))
    every = L.tombstone_omissions(current, snapshot, ["universe", "member"], scope.withColumn("whole", F.lit(True)), ["universe"], "whole").select("universe").distinct()
    return every.join(gone, "universe", "left").select("universe", F.coalesce("n", F.lit(0)).alias("tombstones"))


@query("L5_universe_apply_snapshot", f"WITH {_MEMBERS_SQL}, n AS (SELECT universe, member, CASE WHEN member % 2 = 0 THEN DATE '1998-03-01' ELSE (SELECT c.valid_from FROM cur c WHERE c.universe = s.universe AND c.member = s.member) END AS valid_from FROM snap s) SELECT coalesce(c.universe, n.universe) AS universe, coalesce(c.member, n.member) AS member, CASE WHEN n.member IS NULL AND c.state = 'active' THEN 'tombstone' WHEN n.member IS NULL THEN 'unchanged' WHEN c.state IS NULL THEN 'active' WHEN c.state = 'tombstone' THEN 'restored' WHEN n.valid_from IS NOT DISTINCT FROM c.valid_from THEN 'membership' ELSE 'conflict' END AS action, CASE WHEN n.member IS NULL THEN c.valid_from ELSE n.valid_from END AS valid_from, CAST(NULL AS DATE) AS valid_through FROM cur c FULL OUTER JOIN n ON c.universe = n.universe AND c.member = n.member")
def universe_apply(spark, sf_dir):
    current, snapshot = _members(spark, sf_dir, "1998-03-01")
    old = current.select("universe", "member", F.col("valid_from").alias("_from"))
    snapshot = snapshot.join(old, ["universe", "member"], "left").withColumn("valid_from", F.when(F.col("member") % 2 == 0, F.lit("1998-03-01").cast("date")).otherwise(F.col("_from")))
    none = F.lit(None).cast("date")
    return L.apply_universe(current.withColumn("valid_through", none), snapshot.withColumn("valid_through", none), complete=True)


def _weekly_versions(observations):
    """A version is unchanged if its digest or its value equals the one before."""
    rows = observations.select(F.col("metric").alias("series_id"), F.trunc("known_on", "week").alias("period"), "band", "state", "known_on", "key", "seq")
    order = Window.partitionBy("series_id", "period").orderBy("known_on", "key", "seq")
    same = (F.lag("band").over(order).eqNullSafe(F.col("band")) | F.lag("state").over(order).eqNullSafe(F.col("state"))) & F.lag("seq").over(order).isNotNull()
    return rows.withColumn("_same", same).filter("NOT _same").groupBy("series_id", "period").agg(F.count(F.lit(1)).alias("versions"))


@query("L9_weekly_fundamental_append", f"WITH {OBSERVED}, w AS (SELECT metric AS series_id, date_trunc('week', known_on) AS period, band, state, known_on, key, seq FROM observed), m AS (SELECT *, lag(band) OVER o IS NOT DISTINCT FROM band OR lag(state) OVER o IS NOT DISTINCT FROM state AS same, lag(seq) OVER o AS before FROM w WINDOW o AS (PARTITION BY series_id, period ORDER BY known_on, key, seq)) SELECT series_id, CAST(period AS DATE) AS period, count(*) AS versions FROM m WHERE NOT (same AND before IS NOT NULL) GROUP BY 1, 2")
def weekly_append(spark, sf_dir):
    return _weekly_versions(observed(spark, sf_dir))


@query("L9_weekly_fundamental_append_all", ORACLE_SQL["L9_weekly_fundamental_append"])
def weekly_append_all(spark, sf_dir):
    return _weekly_versions(observed(spark, sf_dir))


@query(
    "L9_weekly_fundamental_corrections",
    f"WITH RECURSIVE {B.OBS}, w AS (SELECT partkey AS series_id, CAST(date_trunc('month', available_date) AS DATE) AS period, CAST(quantity AS INT) % 3 AS value, md5(state || '|' || suppkey % 2) AS content, row_number() OVER (PARTITION BY partkey, date_trunc('month', available_date) ORDER BY available_date, key, seq) AS i FROM obs), f AS (SELECT *, TRUE AS kept FROM w WHERE i = 1 UNION ALL SELECT w.series_id, w.period, CASE WHEN w.value = f.value OR w.content = f.content THEN f.value ELSE w.value END, CASE WHEN w.value = f.value OR w.content = f.content THEN f.content ELSE w.content END, w.i, NOT (w.value = f.value OR w.content = f.content) FROM f JOIN w ON w.series_id = f.series_id AND w.period = f.period AND w.i = f.i + 1) SELECT series_id, period, value, content, row_number() OVER (PARTITION BY series_id, period ORDER BY i) AS sequence FROM f WHERE kept",
)
def weekly_corrections(spark, sf_dir):
    """A correction differs from the current version in its content and in its value."""
    rows = B.obs_ledger(spark, sf_dir).select(F.col("partkey").alias("series_id"), F.trunc("available_date", "month").alias("period"), F.expr("CAST(quantity AS INT) % 3").alias("value"), F.md5(F.concat_ws("|", "state", F.col("suppkey") % 2).cast("binary")).alias("content"), *ORDER)
    return L.append_corrections(rows, ["series_id", "period"], ORDER, ["value", "content"]).select("series_id", "period", "value", "content", "sequence")


@query("L11_fundamental_derive", f"WITH {B.OBS}, facts AS (SELECT suppkey AS issuer, p_type AS concept, p_size % 3 AS unit, CAST(date_trunc('quarter', available_date) AS DATE) AS period, available_date, key, seq, value FROM obs JOIN part ON p_partkey = partkey), mapping AS (SELECT DISTINCT p_type AS concept, p_size % 3 AS unit, lower(p_type) || '_' || (p_size % 3) AS metric FROM part WHERE p_type <> 'PROMO' AND p_size % 3 < 2), m AS (SELECT f.*, g.metric FROM facts f JOIN mapping g ON f.concept = g.concept AND f.unit = g.unit) SELECT issuer, metric, period, count(*) AS versions, arg_max(value, (available_date, key, seq)) AS value FROM m GROUP BY 1, 2, 3")
def fundamental_derive(spark, sf_dir):
    """Raw facts to canonical metrics by the mapping; the last version of each metric and period."""
    part = B.read(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("concept"), (F.col("p_size") % 3).alias("unit"))
    mapping = part.filter("concept <> 'PROMO' AND unit < 2").select("concept", "unit", F.concat_ws("_", F.lower("concept"), "unit").alias("metric")).distinct()
    facts = B.obs_ledger(spark, sf_dir).join(part, F.col("partkey") == F.col("p_partkey")).withColumn("period", F.trunc("available_date", "quarter"))
    mapped = facts.join(mapping, ["concept", "unit"])
    return mapped.groupBy(F.col("suppkey").alias("issuer"), "metric", "period").agg(F.count(F.lit(1)).alias("versions"), F.max_by("value", F.struct("available_date", "key", "seq")).alias("value"))


@query("L12_link_assertion_append", f"WITH {B.INTERVALS}, asserted AS (SELECT o_orderkey AS assertion, o_custkey AS symbol, CAST(o_orderdate AS DATE) AS d FROM orders), c AS (SELECT a.assertion, count(i.symbol) AS covering, min(i.target) AS target FROM asserted a LEFT JOIN intervals i ON i.symbol = a.symbol AND i.valid_from <= a.d AND (i.valid_through IS NULL OR i.valid_through >= a.d) GROUP BY 1) SELECT assertion, target FROM c WHERE covering = 1")
def link_assertion(spark, sf_dir):
    """Assertions that exactly one interval of their symbol covers."""
    asserted = B.read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("assertion"), F.col("o_custkey").alias("symbol"), F.col("o_orderdate").cast("date").alias("d"))
    covering = asserted.join(B.intervals(spark, sf_dir), "symbol").filter(effective_on(F.col("valid_from"), F.col("valid_through"), F.col("d")))
    return covering.groupBy("assertion").agg(F.count(F.lit(1)).alias("n"), F.min("target").alias("target")).filter("n = 1").select("assertion", "target")


@query("L15_news_append", f"WITH {B.NEWS} SELECT item, version, state, CASE WHEN before IS NULL AND state = 'retracted' THEN 'starts_retracted' WHEN before = 'retracted' AND state = 'retracted' THEN 'retracted_twice' END AS fault, row_number() OVER (PARTITION BY item ORDER BY version) AS sequence FROM (SELECT *, lag(state) OVER (PARTITION BY item ORDER BY version) AS before FROM news) t")
def news_append(spark, sf_dir):
    """Every capture is a new version; illegal changes of state are told."""
    order = Window.partitionBy("item").orderBy("version")
    before = F.lag("state").over(order)
    fault = F.when(before.isNull() & (F.col("state") == "retracted"), "starts_retracted").when((before == "retracted") & (F.col("state") == "retracted"), "retracted_twice")
    return B.news(spark, sf_dir).select("item", "version", "state", fault.alias("fault"), F.row_number().over(order).alias("sequence"))


@query("L16_option_bar_append", "SELECT user_id AS contract, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS bar_start, event_id, row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY ts, event_id) AS sequence FROM events")
def bar_append(spark, sf_dir):
    start = F.date_trunc("hour", "ts")
    rows = B.read(spark, sf_dir, "events").select(F.col("user_id").alias("contract"), start.cast("timestamp_ntz").alias("bar_start"), "event_id", "ts")
    return rows.withColumn("sequence", F.row_number().over(Window.partitionBy("contract", "bar_start").orderBy("ts", "event_id"))).drop("ts")


@query("L18_first_seen_dimension", "SELECT o.o_custkey AS k, CASE WHEN c.c_custkey IS NULL THEN 'new' WHEN c.c_nationkey = o.o_custkey % 25 THEN 'known' ELSE 'conflict' END AS status FROM (SELECT DISTINCT o_custkey FROM orders) o LEFT JOIN customer c ON c.c_custkey = o.o_custkey AND c.c_custkey % 2 = 0")
def first_seen(spark, sf_dir):
    known = B.read(spark, sf_dir, "customer").filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("k"), F.col("c_nationkey").cast("long").alias("nation"))
    rows = B.read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), (F.col("o_custkey") % 25).alias("nation"))
    return L.first_seen(known, rows, ["k"], ["nation"]).select("k", "status")


@query("L19_option_cohort_write", "SELECT o_orderkey AS capture, count(l_orderkey) AS contracts, count(DISTINCT l_partkey) AS instruments, max(l_shipdate) >= max(o_orderdate) AS complete FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1")
def cohort(spark, sf_dir):
    lines = B.read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_shipdate")
    return B.read(spark, sf_dir, "orders").join(lines, F.col("l_orderkey") == F.col("o_orderkey"), "left").groupBy(F.col("o_orderkey").alias("capture")).agg(F.count("l_orderkey").alias("contracts"), F.count_distinct("l_partkey").alias("instruments"), (F.max("l_shipdate") >= F.max("o_orderdate")).alias("complete"))


# Scalar functions.


@query("F1_stable_id", "SELECT c_custkey, 'iss_' || substr(sha256(c_name || chr(0) || c_mktsegment), 1, 32) AS id FROM customer")
def stable(spark, sf_dir):
    return B.read(spark, sf_dir, "customer").select("c_custkey", scalars.stable_id("iss", F.col("c_name"), F.col("c_mktsegment")).alias("id"))


@query("F2_decimal_canonical", r"SELECT s_suppkey, regexp_replace(regexp_replace(CAST(CAST(s_acctbal AS DECIMAL(28,10)) AS VARCHAR), '(\.\d*?)0+$', '\1'), '\.$', '') AS text FROM supplier")
def decimal_text(spark, sf_dir):
    return B.read(spark, sf_dir, "supplier").select("s_suppkey", scalars.decimal_canonical(F.col("s_acctbal")).alias("text"))


@query("F3_json_canonical", """SELECT n_nationkey, '{"key":' || n_nationkey || ',"name":"' || n_name || '","region":' || n_regionkey || '}' AS doc FROM nation""")
def json_text(spark, sf_dir):
    return B.read(spark, sf_dir, "nation").select("n_nationkey", scalars.json_canonical({"region": F.col("n_regionkey"), "name": F.col("n_name"), "key": F.col("n_nationkey")}).alias("doc"))


@query("F4_bucket_bounds", "SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS m, CAST(last_day(o_orderdate) AS DATE) AS me, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS q, CAST(date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS qe, CAST(date_trunc('year', o_orderdate) AS DATE) AS y, CAST(date_trunc('year', o_orderdate) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE) AS ye FROM orders")
def buckets(spark, sf_dir):
    d = F.col("o_orderdate").cast("date")
    names = {"m": "monthly", "q": "quarterly", "y": "annual"}
    return B.read(spark, sf_dir, "orders").select("o_orderkey", *[x for n, f in names.items() for x in (bucket_start(d, f).alias(n), bucket_end(d, f).alias(n + "e"))])


@query("F5_month_bounds", "SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS month, CAST(date_trunc('month', o_orderdate) AS DATE) AS first, CAST(last_day(o_orderdate) AS DATE) AS last FROM orders")
def months(spark, sf_dir):
    first, last = month_bounds(F.col("month"))
    return B.read(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("month")).distinct().select("month", first.alias("first"), last.alias("last"))


@query("F6_ratios", "SELECT s_suppkey, round(s_acctbal / nullif(s_nationkey, 0) - 1, 6) AS simple, CASE WHEN s_acctbal > 0 AND s_nationkey > 0 THEN round(ln(s_acctbal / s_nationkey), 6) END AS log FROM supplier")
def ratios(spark, sf_dir):
    a, b = F.col("s_acctbal"), F.col("s_nationkey")
    return B.read(spark, sf_dir, "supplier").select("s_suppkey", F.round(scalars.simple_ratio(a, b), 6).alias("simple"), F.round(scalars.log_ratio(a, b), 6).alias("log"))


@query("F8_accession_format", "SELECT count(*) AS n, count(*) FILTER (WHERE o_orderkey % 2 = 0) AS valid FROM orders")
def accessions(spark, sf_dir):
    # the last six digits are the number, those before it the year, so that every even order's has its places
    number, year = F.pmod("o_orderkey", F.lit(1000000)), F.expr("pmod(o_orderkey div 1000000, 100)")
    text = F.when(F.col("o_orderkey") % 2 == 0, F.format_string("%010d-%02d-%06d", "o_custkey", year, number)).otherwise(F.format_string("%010d-%d", "o_custkey", "o_orderkey"))
    return B.read(spark, sf_dir, "orders").agg(F.count(F.lit(1)).alias("n"), F.count_if(scalars.is_accession(text)).alias("valid"))


@query("F9_security_shaped_scan", "SELECT count(*) FILTER (WHERE c_custkey % 10 = 0) AS found FROM customer")
def security_shaped(spark, sf_dir):
    text = F.when(F.col("c_custkey") % 10 == 0, F.format_string("AB%07d", F.col("c_custkey") % 1000)).otherwise(F.col("c_name"))
    return B.read(spark, sf_dir, "customer").agg(F.count_if(scalars.is_security_shaped(text)).alias("found"))


@query("F10_ohlc_consistent", f"WITH {B.BARS} SELECT count(*) AS bars, count(*) FILTER (WHERE low <= least(open, close) AND high >= greatest(open, close)) AS consistent FROM bars")
def ohlc(spark, sf_dir):
    return B.bars(spark, sf_dir).agg(F.count(F.lit(1)).alias("bars"), F.count_if(scalars.ohlc_consistent(*map(F.col, ("open", "high", "low", "close")))).alias("consistent"))


@query("F11_dimensions_digest", """SELECT p_partkey, sha256('{"brand":"' || p_brand || '","type":"' || p_type || '"}') AS digest FROM part""")
def digests(spark, sf_dir):
    return B.read(spark, sf_dir, "part").select("p_partkey", scalars.dimensions_digest(F.create_map(F.lit("type"), "p_type", F.lit("brand"), "p_brand")).alias("digest"))


@query("F12_family_from_prefix", "SELECT CASE WHEN p_type LIKE 'S%' THEN 's' WHEN p_type LIKE 'P%' THEN 'p' END AS family, count(*) AS n FROM part GROUP BY 1")
def families(spark, sf_dir):
    return B.read(spark, sf_dir, "part").groupBy(scalars.family_from_prefix(F.col("p_type"), [("S", "s"), ("P", "p")]).alias("family")).agg(F.count(F.lit(1)).alias("n"))
