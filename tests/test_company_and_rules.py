"""Company reads, audits and measures on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions.temporal import parse_temporal
from tidemark.operators import company, declared, quality, series
from tidemark.operators.ledger import LedgerSpec

DAY = dt.date


def stamped(df):
    t = parse_temporal(F.col("raw"))
    return df.withColumns({"available_precision": t.precision, "available_date": t.written_date, "available_at": t.instant}).drop("raw")


def test_issuers_have_the_links_that_were_known_and_hold(spark):
    issuers = stamped(spark.createDataFrame([("a", 1, "Old", "active", "2024-01-01"), ("a", 2, "New", "active", "2024-03-01"), ("b", 1, "Gone", "tombstone", "2024-01-01")], "issuer string, seq int, name string, state string, raw string"))
    links = [("a", "X", 1, "active", DAY(2024, 1, 1), None, "2024-01-01"), ("a", "X", 2, "active", DAY(2024, 1, 1), DAY(2024, 1, 31), "2024-02-20"), ("a", "Y", 1, "active", DAY(2024, 1, 1), None, "2024-01-05"), ("a", "Z", 1, "active", DAY(2024, 1, 1), None, "2024-05-01"), ("a", "W", 1, "tombstone", DAY(2024, 1, 1), None, "2024-01-01")]
    held = stamped(spark.createDataFrame(links, "issuer string, symbol string, seq int, state string, valid_from date, valid_through date, raw string"))
    spec, link_spec = LedgerSpec(("issuer",), ("seq",), state="state"), LedgerSpec(("issuer", "symbol"), ("seq",), state="state")
    read = lambda at: {r.issuer: (r.name, [x.symbol for x in r.links]) for r in company.issuers_as_of(issuers, spec, held, link_spec, "2024-02-15", at, ["symbol"]).collect()}
    assert read("2024-02-15") == {"a": ("Old", ["X", "Y"])} and read("2024-03-15") == {"a": ("New", ["Y"])}


def test_filings_come_once_for_each_member(spark):
    filings = stamped(spark.createDataFrame([("f1", "2024-01-01"), ("f2", "2024-02-01T10:00:00Z"), ("f3", "soon")], "accession string, raw string"))
    members = spark.createDataFrame([("f1", "a"), ("f1", "b"), ("f1", "a"), ("f2", "a"), ("f3", "a")], "accession string, issuer string")
    got = company.filings_as_of(filings, members, "2024-02-01T09:00:00Z").select("accession", "issuer").collect()
    assert sorted(map(tuple, got)) == [("f1", "a"), ("f1", "b")]


def test_metrics_are_versioned_and_unmapped_facts_told(spark):
    facts = spark.createDataFrame([("a", "Rev", 1, 5), ("a", "Rev", 2, 5), ("a", "Rev", 3, 6), ("a", "Odd", 1, 1), ("b", "Rev", 1, 7)], "issuer string, concept string, t int, value int")
    mapping = spark.createDataFrame([("Rev", "revenue", True), ("Rev", "sales", True), ("Odd", "odd", False)], "concept string, metric string, active boolean")
    versions, rest = company.derive_metrics(facts, mapping, ["concept"], "metric", ["issuer"], ["t"], "value")
    assert sorted((r.issuer, r.metric, r.t, r.sequence) for r in versions.collect()) == sorted((i, m, t, s) for m in ("revenue", "sales") for i, t, s in (("a", 1, 1), ("a", 3, 2), ("b", 1, 1)))
    assert [(r.concept, r.t) for r in rest.collect()] == [("Odd", 1)]


def test_assertions_need_one_security(spark):
    held = spark.createDataFrame([("S", "one", DAY(2024, 1, 1), DAY(2024, 1, 31)), ("S", "two", DAY(2024, 2, 1), None), ("D", "x", DAY(2024, 1, 1), None), ("D", "y", DAY(2024, 1, 1), None)], "symbol string, target string, valid_from date, valid_through date")
    asked = spark.createDataFrame([(1, "S", DAY(2024, 1, 2)), (2, "S", DAY(2024, 1, 9)), (3, "S", DAY(2024, 3, 1)), (4, "D", DAY(2024, 1, 2)), (5, "N", DAY(2024, 1, 2))], "assertion int, symbol string, d date")
    versions, refused = company.assert_links(asked, held, "symbol", "d", ["assertion"], "target", ["symbol"], ["d", "assertion"])
    assert sorted((r.assertion, r.target, r.sequence) for r in versions.collect()) == [(1, "one", 1), (3, "two", 2)]
    assert sorted(map(tuple, refused.collect())) == [(4, "ambiguous"), (5, "unknown")]


LEDGER = "k string, sequence int, version string, supersedes string, value double, reason string, state string, state_reason string, scope string"


def test_audit_of_an_append_only_ledger(spark):
    good = [("a", 1, "v1", None, 1.0, None, "active", None, "s"), ("a", 2, "v2", "v1", None, "suppressed", "active", None, "s"), ("a", 3, "v3", "v2", None, None, "tombstone", "omitted", "s"), (None, 1, "w1", None, 1.0, None, "active", None, "s")]
    bad = [("b", 1, "x1", None, None, None, "active", None, "s"), ("b", 2, "x2", None, 1.0, "why", "tombstone", None, "p"), ("b", 3, "x3", "v1", 1.0, None, "active", None, "s")]
    scopes = spark.createDataFrame([("s", True), ("p", False)], "scope string, complete boolean")
    ledger = spark.createDataFrame(good + bad, LEDGER)
    earlier = spark.createDataFrame([*good[:1], (None, 1, "w1", None, 2.0, None, "active", None, "s"), ("z", 1, "z1", None, 1.0, None, "active", None, "s")], LEDGER)
    got = {tuple(r) for r in quality.ledger_audit(ledger, ["k"], scopes, "scope", earlier, ["version", "value", "state"]).collect()}
    assert got == {("b", 1, "value_xor_reason"), ("b", 2, "tombstone_has_reason"), ("b", 2, "tombstone_of_complete_scope"), ("b", 1, "one_start"), ("b", 2, "one_start"), ("b", 3, "supersedes_other_key"), (None, 1, "changed_or_deleted"), ("z", 1, "changed_or_deleted")}


def test_files_are_what_was_asked_for(spark):
    rows = [("ok", DAY(2024, 1, 2)), ("ok", DAY(2024, 1, 3)), ("twice", DAY(2024, 1, 2)), ("twice", DAY(2024, 1, 2)), ("late", DAY(2024, 1, 9)), ("stray", DAY(2024, 1, 2))]
    days = [DAY(2024, 1, 2), DAY(2024, 1, 3)]
    scope = [(s, days[0], days[1], days, 2) for s in ("ok", "twice", "late", "none")]
    got = quality.scope_faults(spark.createDataFrame(rows, "symbol string, d date"), spark.createDataFrame(scope, "symbol string, first_day date, last_day date, days array<date>, expected_rows long"), ["symbol"], ["d"], "d").collect()
    want = {("twice", "duplicate_key"), ("twice", "missing_day"), ("late", "out_of_scope"), ("late", "missing_day"), ("late", "unexpected_day"), ("late", "row_count"), ("stray", "no_scope"), ("none", "missing_day"), ("none", "row_count")}
    assert {tuple(r) for r in got} == want


def test_no_finer_frequency_is_made_up(spark):
    rows = spark.createDataFrame([("s", DAY(2024, 1, 1), DAY(2024, 3, 31), 5.0), ("s", DAY(2024, 4, 1), DAY(2024, 6, 30), None)], "series_id string, period_start date, period_end date, value double")
    with pytest.raises(ValueError, match="finer"):
        series.resample(rows, "quarterly", "monthly", "sum")
    assert [(r.value, r.missing_reason) for r in series.resample(rows, "quarterly", "quarterly", "sum").orderBy("period_start").collect()] == [(5.0, None), (None, "missing")]


def test_vix_fix_bands_by_hand(spark):
    closes = [10.0, 11.0, 9.0, 8.0, 12.0, 7.0]
    bars = spark.createDataFrame([("s", DAY(2024, 1, 1 + i), c - 1, c) for i, c in enumerate(closes)], "symbol string, trade_date date, low double, close double")
    got = declared.vix_fix(bars, 2, 3, 2.0, 4).orderBy("trade_date").collect()
    fix = [None] + [100 * (max(closes[i - 1 : i + 1]) - (closes[i] - 1)) / max(closes[i - 1 : i + 1]) for i in range(1, 6)]
    assert [r.vix_fix is None for r in got] == [True] + [False] * 5 and all(abs(r.vix_fix - f) < 1e-9 for r, f in zip(got[1:], fix[1:]))
    assert [r.upper_band is None for r in got] == [True] * 3 + [False] * 3 and [r.range_high is None for r in got] == [True] * 4 + [False] * 2
    last = fix[3:6]
    mean = sum(last) / 3
    spread = 2 * (sum((x - mean) ** 2 for x in last) / 3) ** 0.5
    assert abs(got[5].upper_band - mean - spread) < 1e-9 and abs(got[5].range_low - 1.01 * min(fix[2:6])) < 1e-9


def test_greeks_need_every_leg(spark):
    legs = spark.createDataFrame([("s", 2, 100, 0.5, 0.1), ("s", -1, 100, 0.3, None)], "strategy string, quantity int, multiplier int, delta double, gamma double").withColumns({g: F.lit(1.0) for g in ("theta", "vega", "rho")})
    r = declared.aggregate_greeks(legs, ["strategy"]).first()
    assert (round(r.delta, 9), r.gamma, r.theta, r.legs) == (70.0, None, 100.0, 2)
