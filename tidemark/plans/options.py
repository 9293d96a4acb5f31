"""Queries of option captures (J8-J10, L19, N1, N2) and of cutoffs for each row (A6).

Captures are orders, their lines the surface, parts the contracts. The columns
are written once, as expressions that Spark and DuckDB read alike.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.temporal import CALENDAR_DATE_INCLUSIVE, COMPLETED_DATE
from tidemark.operators import asof
from tidemark.operators import cohort as C
from tidemark.operators import ledger as L
from tidemark.operators.nested import nest
from tidemark.plans import bindings as B
from tidemark.plans.ledgers import DAY, SPEC
from tidemark.plans.registry import query
from tidemark.sources import cohorts
from tidemark.sources.scratch import shared_path

CAPTURE = {
    "capture": "o_orderkey", "underlying": "o_custkey", "feed": "CASE WHEN o_custkey % 2 = 0 THEN 'sip' ELSE 'indicative' END", "environment": "CASE WHEN o_orderstatus = 'P' THEN 'paper' ELSE 'live' END",
    "policy": "CASE WHEN o_orderpriority < '3' THEN 'standard_only' ELSE 'all' END", "available_precision": "CASE WHEN o_orderkey % 2 = 0 THEN 'date' ELSE 'datetime' END",
    "available_date": "CAST(o_orderdate AS DATE) + 45", "available_at": "CAST(CAST(o_orderdate AS DATE) + 45 AS TIMESTAMP) + CAST(o_custkey % 24 AS INT) * INTERVAL 1 HOUR",
}
_SEEN = {"available_precision": "CASE WHEN l_linenumber % 2 = 0 THEN 'date' ELSE 'datetime' END", "available_date": "CAST(l_shipdate AS DATE)", "available_at": "CAST(l_shipdate AS TIMESTAMP) + CAST(l_partkey % 24 AS INT) * INTERVAL 1 HOUR"}
_EXPIRATION = "CAST('2000-01-01' AS DATE) + CAST(l_partkey % 4 AS INT) * 30"
CONTRACT = {
    "capture": "l_orderkey", "contract": "l_partkey", "expiration": _EXPIRATION, "strike": "p_retailprice", "kind": "CASE WHEN p_size % 2 = 0 THEN 'call' ELSE 'put' END",
    "deliverable": "CASE WHEN p_size % 10 = 0 THEN 'nonstandard' ELSE 'standard' END", "multiplier": "100", "status": "CASE WHEN p_size > 45 THEN 'inactive' ELSE 'active' END",
}
SURFACE = {
    "capture": "l_orderkey", "contract": "l_partkey", "line": "l_linenumber", "surface_state": "CASE l_returnflag WHEN 'A' THEN 'present' WHEN 'N' THEN 'missing' ELSE 'excluded' END",
    "missing_reason": "CASE WHEN l_returnflag = 'N' AND l_suppkey % 5 <> 0 THEN 'not_quoted' WHEN l_returnflag = 'A' AND l_suppkey % 23 = 0 THEN 'stale' END",
    "exclusion_reason": "CASE WHEN l_returnflag = 'R' AND l_suppkey % 7 <> 0 THEN 'nonstandard_deliverable' END",
    "bid_price": "CASE WHEN l_returnflag = 'A' AND l_suppkey % 3 = 0 THEN l_extendedprice END", "ask_price": "CASE WHEN l_returnflag = 'A' AND l_suppkey % 3 = 0 THEN l_extendedprice + 1 END",
    "last_price": "CASE WHEN (l_returnflag = 'A' AND l_suppkey % 3 = 1) OR l_suppkey % 29 = 0 THEN l_extendedprice END", "quote_date": "CASE WHEN l_returnflag = 'A' OR l_suppkey % 29 = 0 THEN CAST(l_shipdate AS DATE) END",
    "implied_volatility": "l_discount", "delta": "l_tax", "gamma": "l_discount * l_tax", "theta": "-l_tax", "vega": "l_discount + l_tax", "rho": "l_discount - l_tax",
    "oi_state": "CASE WHEN l_returnflag = 'A' OR l_suppkey % 31 = 0 THEN 'present' ELSE 'missing' END", "close_state": "CASE WHEN l_returnflag = 'A' OR l_suppkey % 37 = 0 THEN 'present' ELSE 'missing' END",
    "bars": "CASE WHEN l_returnflag = 'A' THEN CAST(l_linenumber AS INT) ELSE 0 END", "feed": "CASE WHEN l_suppkey % 17 = 0 THEN 'other' WHEN o_custkey % 2 = 0 THEN 'sip' ELSE 'indicative' END",
    "environment": "CASE WHEN l_suppkey % 19 = 0 THEN 'paper' ELSE 'live' END", **_SEEN,
}
EXPIRY = {
    "capture": "l_orderkey", "expiration": _EXPIRATION, "line": "l_linenumber", "state": "CASE WHEN l_returnflag <> 'N' OR l_suppkey % 2 = 0 THEN 'present' ELSE 'missing' END", "missing_reason": "CASE WHEN l_returnflag = 'N' THEN 'no_inputs' END",
    "spot_price": "CASE WHEN l_returnflag <> 'N' THEN CASE WHEN l_suppkey % 4 <> 0 THEN o_totalprice ELSE o_totalprice + 1 END END", "risk_free_rate": "CASE WHEN l_returnflag <> 'N' THEN l_discount END",
    "dividend_yield": "CASE WHEN l_returnflag <> 'N' THEN l_tax END", "forward_price": "CASE WHEN l_returnflag <> 'N' AND l_suppkey % 11 <> 0 THEN l_extendedprice END", **_SEEN,
}
POINT = {"capture": "l_orderkey", "tenor_days": "CAST(l_linenumber * 30 AS INT)", "point_state": "CASE WHEN l_suppkey % 6 = 0 THEN 'missing' ELSE 'present' END", "zero_rate": "l_tax", **_SEEN}
DIVIDEND = {"capture": "l_orderkey", "ex_date": "CAST(l_shipdate AS DATE)", "line": "l_linenumber", "cash_amount": "l_discount", **_SEEN}
INPUTS = {
    "capture": "o_orderkey", "dependencies_present": "o_orderstatus <> 'O'", "last_price": "CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END", "trade_price": "o_totalprice",
    "available_precision": "CASE WHEN o_orderkey % 5 = 0 THEN 'datetime' ELSE 'date' END", "available_date": "CAST(o_orderdate AS DATE) + CAST(o_orderkey % 60 AS INT)", "available_at": "CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 60 AS INT) AS TIMESTAMP)",
}

#: Columns, and the lines that a table has; captures and inputs are of orders.
TABLES = {
    "captures": (CAPTURE, None), "inputs": (INPUTS, None), "contracts": (CONTRACT, "l_linenumber <= 5"), "surface": (SURFACE, "l_linenumber <> 4"),
    "expiry": (EXPIRY, "l_linenumber <= 5 AND l_linenumber <> 2"), "points": (POINT, "l_linenumber <= 3"), "dividends": (DIVIDEND, "l_returnflag = 'R'"),
}


def _sql(*names: str) -> str:
    """The tables as common table expressions."""
    out = []
    for name in names:
        columns, where = TABLES[name]
        source = "orders" if where is None else f"lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey WHERE {where}"
        out.append(f"{name} AS (SELECT {'DISTINCT ' if name == 'contracts' else ''}{', '.join(f'{e} AS {c}' for c, e in columns.items())} FROM {source})")
    return "WITH " + ", ".join(out)


def _table(spark, sf_dir: str, name: str):
    columns, where = TABLES[name]
    orders = B.read(spark, sf_dir, "orders")
    if where is None:
        rows = orders
    else:
        lines = B.read(spark, sf_dir, "lineitem").filter(where)
        rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(B.read(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    out = rows.select(*[F.expr(e).alias(c) for c, e in columns.items()])
    return out.distinct() if name == "contracts" else out


def _visible(a: str, c: str, policy: str) -> str:
    """The visibility rule as SQL: rows of a at the cutoffs of c."""
    op = "<=" if policy == CALENDAR_DATE_INCLUSIVE else "<"
    return f"CASE WHEN {c}_precision = 'date' THEN {a}_date <= {c}_date WHEN {a}_precision = 'date' THEN {a}_date {op} {c}_date ELSE {a}_at <= {c}_at END"


def _rules(rules: dict[str, str], columns: str, source: str) -> str:
    return " UNION ALL ".join(f"SELECT {columns}, '{name}' AS rule FROM {source} WHERE {wrong}" for name, wrong in rules.items())


@query(
    "J10_capture_context",
    f"{_sql('captures', 'surface')}, met AS (SELECT s.*, c.feed AS own_feed, c.environment AS own_environment, c.available_precision AS c_precision, c.available_date AS c_date, c.available_at AS c_at FROM surface s JOIN captures c USING (capture)) "
    + _rules({"feed": "feed <> own_feed", "environment": "environment <> own_environment", "availability": f"NOT ({_visible('available', 'c', CALENDAR_DATE_INCLUSIVE)})"}, "capture, line, contract", "met"),
)
def capture_context(spark, sf_dir):
    """Surface rows that don't fit their capture."""
    return C.context_faults(_table(spark, sf_dir, "surface"), _table(spark, sf_dir, "captures"), ["line", "contract"])


_EMPTY = "bid_price IS NULL AND ask_price IS NULL AND last_price IS NULL AND quote_date IS NULL"
_MUST = "(policy = 'standard_only' AND coalesce(deliverable, '') = 'nonstandard')"
_SURFACE_RULES = {
    "present_with_reason": "surface_state = 'present' AND (missing_reason IS NOT NULL OR exclusion_reason IS NOT NULL)",
    "present_without_quote": "surface_state = 'present' AND (quote_date IS NULL OR (bid_price IS NULL AND ask_price IS NULL AND last_price IS NULL))",
    "missing_not_explicit": f"surface_state = 'missing' AND NOT (missing_reason IS NOT NULL AND exclusion_reason IS NULL AND {_EMPTY})",
    "excluded_not_explicit": f"surface_state = 'excluded' AND NOT (exclusion_reason IS NOT NULL AND missing_reason IS NULL AND {_EMPTY})",
    "nonstandard_not_excluded": f"{_MUST} AND NOT (surface_state = 'excluded' AND coalesce(exclusion_reason, '') = 'nonstandard_deliverable')",
    "excluded_without_need": f"surface_state = 'excluded' AND NOT {_MUST}",
    "observed_though_not_present": "surface_state <> 'present' AND (oi_state <> 'missing' OR close_state <> 'missing' OR bars > 0)",
}


@query("J8_surface_rules", f"{_sql('captures', 'contracts', 'surface')}, met AS (SELECT s.*, c.deliverable, k.policy FROM surface s LEFT JOIN contracts c USING (capture, contract) JOIN captures k USING (capture)) " + _rules(_SURFACE_RULES, "capture, line, contract", "met"))
def surface_rules(spark, sf_dir):
    """Surface rows whose state doesn't fit their fields or the policy."""
    return C.surface_faults(_table(spark, sf_dir, "surface"), _table(spark, sf_dir, "contracts"), _table(spark, sf_dir, "captures"), ["line", "contract"])


@query(
    "J8_surface_rows_of_contracts",
    f"{_sql('contracts', 'surface')}, s AS (SELECT capture, contract, count(*) AS n FROM surface GROUP BY 1, 2), d AS (SELECT DISTINCT capture, contract, TRUE AS declared FROM contracts), met AS (SELECT * FROM s FULL OUTER JOIN d USING (capture, contract)) "
    + _rules({"missing_row": "n IS NULL", "undeclared": "declared IS NULL", "duplicate": "n > 1"}, "capture, contract", "met"),
)
def surface_rows(spark, sf_dir):
    """Each declared contract has exactly one surface row and each surface row a declared contract."""
    return C.coverage_faults(_table(spark, sf_dir, "contracts"), _table(spark, sf_dir, "surface"))


_WHOLE = "(state = 'present' AND missing_reason IS NULL AND spot_price IS NOT NULL AND risk_free_rate IS NOT NULL AND dividend_yield IS NOT NULL AND forward_price IS NOT NULL)"


@query(
    "J9_expiry_input_rules",
    f"{_sql('contracts', 'expiry', 'points', 'inputs')}, x AS (SELECT capture, expiration, count(*) AS n FROM expiry GROUP BY 1, 2), d AS (SELECT DISTINCT capture, expiration, TRUE AS declared FROM contracts), met AS (SELECT * FROM x FULL OUTER JOIN d USING (capture, expiration)), "
    "rows AS (SELECT e.*, i.dependencies_present, i.last_price, i.trade_price, EXISTS (SELECT 1 FROM points p WHERE p.capture = e.capture AND p.point_state = 'present' AND p.zero_rate = e.risk_free_rate) AS on_curve FROM expiry e JOIN inputs i USING (capture)) "
    + _rules({"input_missing": "n IS NULL", "not_expected": "declared IS NULL", "input_twice": "n > 1"}, "capture, expiration", "met")
    + " UNION ALL "
    + _rules(
        {
            "not_synchronized": f"dependencies_present AND NOT {_WHOLE}",
            "spot_not_of_capture": f"dependencies_present AND {_WHOLE} AND spot_price <> coalesce(last_price, trade_price)",
            "rate_not_on_curve": f"dependencies_present AND {_WHOLE} AND NOT on_curve",
            "incoherent_not_missing": "NOT dependencies_present AND NOT (state = 'missing' AND missing_reason IS NOT NULL AND spot_price IS NULL AND risk_free_rate IS NULL AND dividend_yield IS NULL AND forward_price IS NULL)",
        },
        "capture, expiration",
        "rows",
    ),
)
def expiry_rules(spark, sf_dir):
    """Inputs of expirations that aren't in step with their capture."""
    return C.expiry_faults(*[_table(spark, sf_dir, t) for t in ("contracts", "expiry", "inputs", "points")])


_CONTRACT_FIELDS = ["expiration", "strike", "kind", "deliverable", "multiplier", "status"]
_QUOTE_FIELDS = ["surface_state", "missing_reason", "exclusion_reason", "bid_price", "ask_price", "last_price", "implied_volatility", "delta", "gamma", "theta", "vega", "rho"]


@query(
    "N1_surface_snapshot_rows",
    f"{_sql('captures', 'contracts', 'surface')}, ranked AS (SELECT *, row_number() OVER (PARTITION BY underlying ORDER BY available_date DESC, available_at DESC, capture DESC) AS rn FROM captures WHERE available_date <= DATE '{DAY}'), "
    f"chosen AS (SELECT * FROM ranked WHERE rn = 1) SELECT k.capture, k.underlying, k.feed, k.environment, k.policy, k.available_precision AS capture_available_precision, k.available_date AS capture_available_date, k.available_at AS capture_available_at, s.contract, {', '.join('c.' + f for f in _CONTRACT_FIELDS)}, "
    "CASE WHEN s.contract IS NULL THEN 'not_available' ELSE s.surface_state END AS surface_state, CASE WHEN s.contract IS NULL THEN 'no_selected_surface_rows' ELSE s.missing_reason END AS missing_reason, "
    f"{', '.join('s.' + f for f in _QUOTE_FIELDS if f not in ('surface_state', 'missing_reason'))}, {', '.join(f'CASE WHEN s.contract IS NULL THEN k.{a} ELSE s.{a} END AS {a}' for a in C.AVAILABLE)} FROM chosen k LEFT JOIN surface s ON s.capture = k.capture LEFT JOIN contracts c ON c.capture = s.capture AND c.contract = s.contract",
)
def surface_snapshot_rows(spark, sf_dir):
    """The last capture of each underlying on a day: a row for each surface row, with the capture's, contract's and quote's columns."""
    captures = _table(spark, sf_dir, "captures")
    chosen = L.ledger_select(captures, C.CAPTURE_SPEC, DAY).drop("pit_warning")
    return C.flat_surface(chosen, _table(spark, sf_dir, "contracts"), _table(spark, sf_dir, "surface"), _CONTRACT_FIELDS, _QUOTE_FIELDS)


#: A cutoff of its own for each customer.
PROBE = {
    "probe": "c_custkey", "underlying": "c_custkey", "cutoff_precision": "CASE WHEN c_custkey % 3 = 0 THEN 'datetime' ELSE 'date' END", "cutoff_date": "CAST('1996-01-01' AS DATE) + CAST(c_custkey % 900 AS INT)",
    "cutoff_at": "CAST(CAST('1996-01-01' AS DATE) + CAST(c_custkey % 900 AS INT) AS TIMESTAMP) + CAST(c_custkey % 24 AS INT) * INTERVAL 1 HOUR",
}
_CUTOFF = ("cutoff_precision", "cutoff_date", "cutoff_at")
_PARTS = {"curve": ("points", ["tenor_days", "point_state", "zero_rate"]), "dividends": ("dividends", ["ex_date", "line", "cash_amount"]), "expiry_inputs": ("expiry", ["expiration", "line", "state", "spot_price"]), "surface": ("surface", ["contract", "line", "surface_state", "last_price"]), "quote": ("inputs", ["last_price", "trade_price"])}


@query(
    "N2_capture_nested_at_own_cutoffs",
    f"{_sql('captures', 'points', 'dividends', 'expiry', 'surface', 'inputs')}, probes AS (SELECT {', '.join(f'{e} AS {c}' for c, e in PROBE.items())} FROM customer), "
    f"met AS (SELECT p.probe, k.capture, row_number() OVER (PARTITION BY p.probe ORDER BY k.available_date DESC, k.available_at DESC, k.capture DESC) AS rn FROM probes p JOIN captures k USING (underlying) WHERE {_visible('available', 'cutoff', COMPLETED_DATE)}), "
    "chosen AS (SELECT p.*, m.capture FROM probes p LEFT JOIN (SELECT * FROM met WHERE rn = 1) m USING (probe)), "
    + ", ".join(
        f"n_{name} AS (SELECT c.probe, count(*) AS n, string_agg({' || chr(58) || '.join(f'coalesce(CAST({f} AS VARCHAR), chr(45))' for f in fields[:3])}, ',' ORDER BY {', '.join(f'{f} NULLS FIRST' for f in fields)}) AS t FROM chosen c JOIN {table} x USING (capture) WHERE {_visible('available', 'cutoff', COMPLETED_DATE)} GROUP BY 1)"
        for name, (table, fields) in ((n, (t, f if n != "curve" and n != "dividends" else f[:2] + f[2:])) for n, (t, f) in _PARTS.items())
    )
    + " SELECT c.probe, c.capture, "
    + ", ".join(f"CAST(coalesce(n_{name}.n, 0) AS INTEGER) AS n_{name}" for name in _PARTS)
    + ", n_expiry_inputs.t AS expiry_inputs, n_surface.t AS surface FROM chosen c "
    + " ".join(f"LEFT JOIN n_{name} ON n_{name}.probe = c.probe" for name in _PARTS),
)
def nested_at_own_cutoffs(spark, sf_dir):
    """Of each underlying the capture, and the parts of it, that were known at a cutoff of its own."""
    probes = B.read(spark, sf_dir, "customer").select(*[F.expr(e).alias(c) for c, e in PROBE.items()])
    parts = {name: (_table(spark, sf_dir, table), fields) for name, (table, fields) in _PARTS.items()}
    out = C.nested_at(probes, _table(spark, sf_dir, "captures"), parts, ["probe"], _CUTOFF)

    def text(name, fields):
        entry = lambda x: F.concat_ws(":", *[F.coalesce(x[f].cast("string"), F.lit("-")) for f in fields])
        return F.when(F.size(name) > 0, F.array_join(F.transform(name, entry), ",")).alias(name)

    return out.select("probe", "capture", *[F.size(n).alias(f"n_{n}") for n in _PARTS], text("expiry_inputs", ["expiration", "line", "state"]), text("surface", ["contract", "line", "surface_state"]))


for _policy in (COMPLETED_DATE, CALENDAR_DATE_INCLUSIVE):

    @query(
        f"A6_ledger_as_of_each_{_policy}",
        f"WITH {B.OBS}, probes AS (SELECT {', '.join(f'{e} AS {c}' for c, e in PROBE.items())}, c_custkey % 50 + 1 AS suppkey FROM customer), met AS (SELECT p.probe, o.key, o.seq, o.state, row_number() OVER (PARTITION BY p.probe ORDER BY o.available_date DESC, o.key DESC, o.seq DESC) AS rn FROM probes p JOIN obs o USING (suppkey) WHERE {_visible('available', 'cutoff', _policy)}) "
        "SELECT p.probe, m.key, m.seq FROM probes p LEFT JOIN (SELECT * FROM met WHERE rn = 1 AND state = 'active') m USING (probe)",
    )
    def _as_of_each(spark, sf_dir, policy=_policy):
        """Observations of a supplier as they were known at each customer's cutoff."""
        probes = B.read(spark, sf_dir, "customer").select(*[F.expr(e).alias(c) for c, e in PROBE.items()], (F.col("c_custkey") % 50 + 1).alias("suppkey"))
        spec = L.LedgerSpec(key=("suppkey",), rank=("available_date", "key", "seq"), state=SPEC.state)
        ledger = B.obs_ledger(spark, sf_dir).select("suppkey", "key", "seq", "state", *C.AVAILABLE)
        return asof.as_of_each(probes, ledger, spec, ["probe"], _CUTOFF, policy).select("probe", "version.key", "version.seq")


# A cohort's tables, written together and read back.

_BAR = "SELECT capture, contract, line, unnest(range(1, bars + 1)) AS bar, last_price AS price FROM surface"
_COHORT_SQL = {
    "captures": f"{_sql('captures')} SELECT * FROM captures",
    "contracts": f"{_sql('contracts')} SELECT * FROM contracts",
    "quotes": f"{_sql('inputs')} SELECT capture, last_price, trade_price FROM inputs WHERE dependencies_present",
    "surface": f"{_sql('surface')} SELECT capture, contract, line, {', '.join(_QUOTE_FIELDS)}, quote_date FROM surface",
    "open_interest": f"{_sql('surface')} SELECT capture, contract, line, quote_date AS as_of_date, CAST(vega * 100 AS DOUBLE) AS value FROM surface WHERE oi_state = 'present'",
    "close_prices": f"{_sql('surface')} SELECT capture, contract, line, quote_date AS trade_date, last_price AS value FROM surface WHERE close_state = 'present'",
    "bars": f"{_sql('surface')} SELECT capture, contract, line, CAST(bar AS INTEGER) AS bar, price FROM ({_BAR})",
    "curve": f"{_sql('points')} SELECT capture, tenor_days, point_state, zero_rate FROM points",
    "dividends": f"{_sql('dividends')} SELECT capture, ex_date, line, cash_amount FROM dividends",
    "expiry_inputs": f"{_sql('expiry')} SELECT capture, expiration, line, state, missing_reason, spot_price, risk_free_rate, dividend_yield, forward_price FROM expiry",
}
#: Where a session has written the cohorts of a folder.
_written: dict[tuple[str, str], str] = {}


def documents(spark, sf_dir):
    """The captures as nested documents."""
    surface = _table(spark, sf_dir, "surface")
    bars = F.when(F.col("bars") > 0, F.transform(F.sequence(F.lit(1), F.greatest(F.col("bars"), F.lit(1))), lambda i: F.struct(F.col("line"), i.alias("bar"), F.col("last_price").alias("price")))).otherwise(F.array().cast("array<struct<line:int,bar:int,price:double>>"))
    interest = F.when(F.col("oi_state") == "present", F.struct(F.col("line"), F.col("quote_date").alias("as_of_date"), (F.col("vega") * 100).alias("value")))
    close = F.when(F.col("close_state") == "present", F.struct(F.col("line"), F.col("quote_date").alias("trade_date"), F.col("last_price").alias("value")))
    surface = surface.withColumns({"bars": bars, "open_interest": interest, "close_price": close})
    inputs = _table(spark, sf_dir, "inputs").select("capture", F.when(F.col("dependencies_present"), F.struct("last_price", "trade_price")).alias("quote"))
    rest = {"contracts": (_table(spark, sf_dir, "contracts"), [c for c in CONTRACT if c != "capture"]), "surface": (surface, ["contract", "line", *_QUOTE_FIELDS, "quote_date", "open_interest", "close_price", "bars"]), "curve": (_table(spark, sf_dir, "points"), _PARTS["curve"][1])}
    rest |= {"dividends": (_table(spark, sf_dir, "dividends"), _PARTS["dividends"][1]), "expiry_inputs": (_table(spark, sf_dir, "expiry"), ["expiration", "line", "state", "missing_reason", *C.EXPIRY_INPUTS])}
    return nest(_table(spark, sf_dir, "captures").join(inputs, "capture"), ["capture"], rest)


for _name, _text in _COHORT_SQL.items():

    @query(f"L19_cohort_{_name}", _text)
    def _cohort_table(spark, sf_dir, name=_name):
        """A table of the cohorts, one for each feed, that were committed as a whole."""
        known = (spark.sparkContext.applicationId, sf_dir)
        if known not in _written:
            path = shared_path(spark, "cohorts")
            made = shared_path(spark, "cohort-documents")
            documents(spark, sf_dir).write.parquet(made)  # once, not for each table of each feed
            whole = spark.read.parquet(made)
            for feed in ("sip", "indicative"):
                cohorts.commit(C.tables_of(whole.filter(F.col("feed") == feed)), path, feed)
            _written[known] = path
        return cohorts.read_table(spark, _written[known], name).drop("cohort")
