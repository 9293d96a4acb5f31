"""Captures of option surfaces on hand-made rows: rules, tables that commit together, reads at cutoffs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions.temporal import parse_temporal
from tidemark.operators import cohort
from tidemark.sources import cohorts


def stamped(df, raw="raw", prefix="available"):
    t = parse_temporal(F.col(raw))
    return df.withColumns({f"{prefix}_precision": t.precision, f"{prefix}_date": t.written_date, f"{prefix}_at": t.instant}).drop(raw)


def captures(spark):
    return stamped(spark.createDataFrame([(1, "u", "sip", "live", "standard_only", "2024-03-05T15:00:00Z"), (2, "u", "sip", "live", "all", "2024-03-07"), (3, "v", "sip", "live", "all", "2024-03-06")], "capture int, underlying string, feed string, environment string, policy string, raw string"))


def test_rows_fit_the_context_of_their_capture(spark):
    rows = [(1, "a", "sip", "live", "2024-03-05T15:00:00Z"), (1, "b", "sip", "live", "2024-03-05"), (1, "c", "sip", "live", "2024-03-05T15:00:01Z"), (1, "d", "other", "paper", "2024-03-06"), (1, "e", None, "live", "2024-03-01"), (2, "f", "sip", "live", "2024-03-07T23:00:00Z"), (2, "g", "sip", "live", "later"), (9, "h", "sip", "live", "2024-03-01")]
    df = stamped(spark.createDataFrame(rows, "capture int, contract string, feed string, environment string, raw string"))
    got = {(r.contract, r.rule) for r in cohort.context_faults(df, captures(spark), ["contract"]).collect()}
    assert got == {("c", "availability"), ("d", "feed"), ("d", "environment"), ("d", "availability"), ("e", "feed"), ("g", "availability"), ("h", "unknown_capture")}


SURFACE = "capture int, contract string, surface_state string, missing_reason string, exclusion_reason string, quote_date date, bid_price double, ask_price double, last_price double, oi_state string, close_state string, bars int"


@pytest.mark.parametrize(
    ("row", "rules"),
    [
        ((1, "s", "present", None, None, dt.date(2024, 3, 5), None, 2.0, None, "present", "missing", 3), set()),
        ((1, "s", "present", "x", None, None, 1.0, None, None, "present", "missing", 3), {"present_with_reason", "present_without_quote"}),
        ((1, "s", "missing", "not_quoted", None, None, None, None, None, "missing", "missing", 0), set()),
        ((1, "s", "missing", None, None, None, None, None, 1.0, "missing", "present", 0), {"missing_not_explicit", "observed_though_not_present"}),
        ((1, "n", "excluded", None, "nonstandard_deliverable", None, None, None, None, "missing", "missing", 0), set()),
        ((1, "n", "excluded", None, "other", None, None, None, None, "missing", "missing", 0), {"nonstandard_not_excluded"}),
        ((2, "n", "excluded", None, "nonstandard_deliverable", None, None, None, None, "missing", "missing", 1), {"excluded_without_need", "observed_though_not_present"}),
        ((1, "n", None, None, None, None, None, None, None, None, None, None), {"unknown_state", "nonstandard_not_excluded"}),
    ],
)
def test_states_fit_their_fields(spark, row, rules):
    contracts = spark.createDataFrame([(c, n, d) for c in (1, 2) for n, d in (("s", "standard"), ("n", "nonstandard"))], "capture int, contract string, deliverable string")
    assert {r.rule for r in cohort.surface_faults(spark.createDataFrame([row], SURFACE), contracts, captures(spark)).collect()} == rules


def test_expiry_inputs_are_in_step(spark):
    day = dt.date(2024, 6, 1)
    contracts = spark.createDataFrame([(c, day) for c in range(1, 8)], "capture int, expiration date")
    full = (100.0, 0.05, 0.01, 101.0)
    rows = [(1, day, "present", None, *full), (2, day, "present", None, 99.0, *full[1:]), (3, day, "present", None, 100.0, 0.06, 0.01, 101.0), (4, day, "missing", "none", None, None, None, None), (5, day, "missing", "none", None, None, None, None), (6, day, "present", None, *full), (6, day, "present", None, *full), (8, day, "present", None, *full)]
    expiry = spark.createDataFrame(rows, "capture int, expiration date, state string, missing_reason string, spot_price double, risk_free_rate double, dividend_yield double, forward_price double")
    inputs = spark.createDataFrame([(c, c != 5, None if c == 1 else 100.0, 100.0) for c in (1, 2, 3, 4, 5, 6, 8)], "capture int, dependencies_present boolean, last_price double, trade_price double")
    points = spark.createDataFrame([(c, s, r) for c in range(1, 9) for s, r in (("present", 0.05), ("missing", 0.06), ("present", None))], "capture int, point_state string, zero_rate double")
    got = sorted((r.capture, r.rule) for r in cohort.expiry_faults(contracts, expiry, inputs, points).collect())
    assert got == [(2, "spot_not_of_capture"), (3, "rate_not_on_curve"), (4, "not_synchronized"), (6, "input_twice"), (7, "input_missing"), (8, "not_expected")]


def test_a_cohort_that_stops_between_two_tables_is_not_there(spark, tmp_path):
    path = str(tmp_path / "cohorts")
    one = {"contracts": spark.createDataFrame([(1,), (2,)], "c int"), "surface": spark.createDataFrame([(1, "p")], "c int, s string")}
    assert cohorts.commit(one, path, "first") and not cohorts.commit(one, path, "first")
    two = {"contracts": spark.createDataFrame([(7,)], "c int"), "surface": spark.createDataFrame([(7, "q")], "c int, s string").withColumn("s", F.raise_error(F.lit("lost")))}
    with pytest.raises(Exception, match="lost"):
        cohorts.commit(two, path, "second")
    seen = lambda t: sorted(r.c for r in cohorts.read_table(spark, path, t).collect())
    assert seen("contracts") == [1, 2] and seen("surface") == [1]
    two["surface"] = spark.createDataFrame([(7, "q"), (8, "r")], "c int, s string")
    assert cohorts.commit(two, path, "second")
    assert seen("contracts") == [1, 2, 7] and seen("surface") == [1, 7, 8]
    assert {r.cohort: r.rows for r in cohorts.manifests(spark, path).collect()} == {"first": {"contracts": 2, "surface": 1}, "second": {"contracts": 1, "surface": 2}}


def test_every_part_at_its_own_cutoff(spark):
    probes = stamped(spark.createDataFrame([(1, "u", "2024-03-05T15:00:00Z"), (2, "u", "2024-03-08"), (3, "u", "2024-03-01"), (4, "v", "2024-03-06")], "probe int, underlying string, cutoff string"), "cutoff", "cutoff")
    points = stamped(spark.createDataFrame([(1, 90, 0.2, "2024-03-04"), (1, 30, 0.1, "2024-03-05T14:00:00Z"), (1, 60, 0.3, "2024-03-06"), (2, 30, 0.4, "2024-03-07")], "capture int, tenor int, rate double, raw string"))
    out = cohort.nested_at(probes, captures(spark), {"curve": (points, ["tenor", "rate"])}, ["probe"], ("cutoff_precision", "cutoff_date", "cutoff_at"))
    got = {r.probe: (r.capture, [tuple(c) for c in r.curve]) for r in out.collect()}
    assert got == {1: (1, [(30, 0.1), (90, 0.2)]), 2: (2, [(30, 0.4)]), 3: (None, []), 4: (3, [])}


def test_a_capture_without_surface_has_one_row(spark):
    surface = stamped(spark.createDataFrame([(1, "s", "present", None, 2.0, "2024-03-05")], "capture int, contract string, surface_state string, missing_reason string, last_price double, raw string"))
    contracts = spark.createDataFrame([(1, "s", 10.0)], "capture int, contract string, strike double")
    rows = {r.capture: r for r in cohort.flat_surface(captures(spark), contracts, surface, ["strike"], ["surface_state", "missing_reason", "last_price"]).collect()}
    assert (rows[1].surface_state, rows[1].strike, rows[1].available_date, rows[1].capture_available_date) == ("present", 10.0, dt.date(2024, 3, 5), dt.date(2024, 3, 5))
    assert (rows[2].surface_state, rows[2].missing_reason, rows[2].contract, rows[2].available_date) == ("not_available", "no_selected_surface_rows", None, dt.date(2024, 3, 7))


def test_cohort_tables_are_written_from_documents_made_once(spark, tiny, monkeypatch):
    from tidemark.plans import catalogue, options
    from tidemark.sources import cohorts

    read, commit = [], cohorts.commit

    def watched(tables, path, cohort):
        read.extend(f for t in tables.values() for f in t.inputFiles())
        return commit(tables, path, cohort)

    monkeypatch.setattr(cohorts, "commit", watched)
    monkeypatch.setattr(options, "_written", {})
    assert catalogue.QUERIES["L19_cohort_captures"](spark, tiny).count() == spark.read.parquet(f"{tiny}/orders.parquet").count()
    assert read and all("cohort-documents" in f for f in read)
