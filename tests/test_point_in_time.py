"""Visibility, selection, building and streams of ledgers on hand-made rows."""

import datetime
import hashlib

import pytest
from pyspark.sql import functions as F

from tidemark.functions import scalars
from tidemark.functions.temporal import CALENDAR_DATE_INCLUSIVE, COMPLETED_DATE, SAME_DAY_WARNING, cutoff, parse_temporal, pit_visible, pit_warning
from tidemark.operators import declared, joins, ledger, quality, search, series
from tidemark.sources import export, readers
from tidemark.streaming import ingest

SPEC = ledger.LedgerSpec(key=("k",), rank=("seq",), payload=("value",), state="state")
ROWS = "k string, seq int, value double, state string, available string"


def versions(spark, rows):
    df = spark.createDataFrame(rows, ROWS)
    t = parse_temporal(F.col("available"))
    return df.withColumns({"available_precision": t.precision, "available_date": t.written_date, "available_at": t.instant})


@pytest.mark.parametrize(
    ("stored", "at", "policy", "included", "warning"),
    [
        ("2024-03-05", "2024-03-05", COMPLETED_DATE, True, None),
        ("2024-03-06", "2024-03-05", COMPLETED_DATE, False, None),
        ("2024-03-05", "2024-03-05T23:59:00Z", COMPLETED_DATE, False, None),
        ("2024-03-04", "2024-03-05T00:00:00Z", COMPLETED_DATE, True, None),
        ("2024-03-05", "2024-03-05T00:00:00Z", CALENDAR_DATE_INCLUSIVE, True, SAME_DAY_WARNING),
        ("2024-03-04", "2024-03-05T00:00:00Z", CALENDAR_DATE_INCLUSIVE, True, None),
        ("2024-03-05T23:30:00-05:00", "2024-03-05", COMPLETED_DATE, True, None),  # the next day in UTC
        ("2024-03-06T00:30:00+05:00", "2024-03-05", COMPLETED_DATE, False, None),  # the same day in UTC
        ("2024-03-05T09:00:00-04:00", "2024-03-05T13:00:00Z", COMPLETED_DATE, True, None),
        ("2024-03-05T09:00:01-04:00", "2024-03-05T13:00:00Z", CALENDAR_DATE_INCLUSIVE, False, None),
        ("2024-03-05T09:00:00", "2024-03-06", COMPLETED_DATE, False, None),  # no offset: unknown
        ("soon", "2024-03-06", COMPLETED_DATE, False, None),
    ],
)
def test_visibility(spark, stored, at, policy, included, warning):
    t = parse_temporal(F.lit(stored))
    row = spark.range(1).select(pit_visible(t, cutoff(at), policy).alias("v"), pit_warning(t, cutoff(at), policy).alias("w")).first()
    assert (row.v, row.w if row.v else None) == (included, warning)


def test_visible_rows_are_those_the_rule_lets_through(spark):
    """The bound for the scan hides nothing that is visible, whatever the offset."""
    offsets = [f"{h:+03d}:00" for h in range(-12, 15)]
    times = ["2024-03-06T01:00:00+14:00", "2024-03-05T11:00:00-12:00", "2024-03-07T00:30:00+14:00", "2024-03-04", "2024-03-05", "2024-03-06", "2024-03-07", "x"]
    times += [f"2024-03-0{d}T{t}{o}" for d in range(4, 8) for t in ("00:30:00", "23:30:00") for o in offsets]
    rows = versions(spark, [(str(i), 1, 1.0, "active", t) for i, t in enumerate(times)]).cache()
    for at in ("2024-03-05T12:00:00Z", "2024-03-05", *[f"2024-03-05T23:00:00{o}" for o in offsets[::2]], "2024-03-06T00:10:00+14:00"):
        for policy in (COMPLETED_DATE, CALENDAR_DATE_INCLUSIVE):
            want = {r.k for r in rows.filter(pit_visible(SPEC.availability(), cutoff(at), policy)).collect()}
            assert {r.k for r in ledger.visible(rows, SPEC, at, policy).collect()} == want


def test_later_rows_never_change_an_earlier_view(spark):
    early = [("a", 1, 1.0, "active", "2024-01-01"), ("a", 2, 2.0, "active", "2024-02-01"), ("b", 1, 5.0, "active", "2024-01-15")]
    late = [("a", 3, 9.0, "active", "2024-03-01"), ("b", 2, None, "tombstone", "2024-03-01"), ("c", 1, 1.0, "active", "2024-03-02T00:00:00Z")]
    at = lambda rows, when: sorted((r.k, r.value) for r in ledger.ledger_select(versions(spark, rows), SPEC, when).collect())
    assert at(early, "2024-02-15") == at(early + late, "2024-02-15") == [("a", 2.0), ("b", 5.0)]
    assert at(early + late, None) == at(early + late, "9999-01-01") == [("a", 9.0), ("c", 1.0)]


def test_a_tombstone_hides_its_key_and_older_versions_stay_hidden(spark):
    rows = versions(spark, [("a", 1, 1.0, "active", "2024-01-01"), ("a", 2, None, "tombstone", "2024-02-01")])
    assert ledger.ledger_select(rows, SPEC).collect() == []
    assert [r.seq for r in ledger.ledger_select(rows, SPEC, active=False).collect()] == [2]


def test_append_changes_is_a_no_op_on_replay(spark):
    spec = ledger.LedgerSpec(key=("k",), rank=("t",), payload=("value",))
    seen = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 1.0), ("a", 3, None), ("a", 4, None), ("a", 5, 1.0)], "k string, t int, value double")
    built = ledger.append_changes(seen, spec, ["t"])
    assert [(r.t, r.sequence, r.supersedes) for r in built.orderBy("t").collect()] == [(1, 1, None), (3, 2, 1), (5, 3, 2)]
    current = ledger.top_version(built, ledger.LedgerSpec(key=("k",), rank=("sequence",)))
    assert ledger.changes_against(current, seen.filter("t = 5"), spec).collect() == []
    assert ledger.replay_gate(seen.select("k"), seen.select("k"), ["k"]).collect() == []


def test_resolve_tells_unknown_resolved_and_ambiguous(spark):
    day = datetime.date
    held = spark.createDataFrame([("A", "x", day(2024, 1, 1), day(2024, 1, 31)), ("A", "y", day(2024, 2, 1), None), ("B", "z", day(2024, 1, 1), None), ("B", "w", day(2024, 1, 5), None)], "symbol string, target string, valid_from date, valid_through date")
    probes = spark.createDataFrame([(1, "A", day(2024, 1, 31)), (2, "A", day(2024, 2, 1)), (3, "A", day(2023, 1, 1)), (4, "B", day(2024, 1, 5)), (5, "C", day(2024, 1, 1))], "id int, symbol string, d date")
    got = {r.id: (r.status, r.target) for r in joins.resolve(probes, held, "symbol", "d", ["id"], "target").collect()}
    assert got == {1: ("resolved", "x"), 2: ("resolved", "y"), 3: ("unknown", None), 4: ("ambiguous", None), 5: ("unknown", None)}
    assert sorted(r.target for r in joins.overlaps(held, ["symbol"]).collect()) == ["w"]


def test_resample_needs_proof_of_coverage(spark):
    day = datetime.date
    daily = [("s", day(2024, 2, d), day(2024, 2, d), float(d)) for d in range(1, 30)] + [("s", day(2024, 3, d), day(2024, 3, d), 1.0) for d in range(1, 31)]
    got = {r.period_start.month: (r.value, r.missing_reason) for r in series.resample(spark.createDataFrame(daily, "series_id string, period_start date, period_end date, value double"), "daily", "monthly", "sum").collect()}
    assert got == {2: (435.0, None), 3: (None, "resample_incomplete_bucket")}
    weekly = [("s", day(2024, 1, d), min(day(2024, 1, d) + datetime.timedelta(6), day(2024, 1, 31)), 2.0) for d in (1, 8, 15, 22, 29)] + [("p", day(2024, 1, d), day(2024, 1, d), 2.0) for d in (1, 8, 15, 22, 29)]
    got = {r.series_id: r.value for r in series.resample(spark.createDataFrame(weekly, "series_id string, period_start date, period_end date, value double"), "weekly", "monthly", "mean").collect()}
    assert got == {"s": 2.0, "p": None}
    monthly = [("s", day(2024, m, 1), (day(2024, m + 1, 1) - datetime.timedelta(1)), float(m)) for m in range(1, 7)]
    got = {r.period_start: r.value for r in series.resample(spark.createDataFrame(monthly, "series_id string, period_start date, period_end date, value double"), "monthly", "quarterly", "last").collect()}
    assert got == {day(2024, 1, 1): 3.0, day(2024, 4, 1): 6.0}


def test_return_reasons(spark):
    day = datetime.date
    rows = [("s", day(2024, 1, i + 1), day(2024, 1, i + 1), v) for i, v in enumerate([1.0, 2.0, None, 0.0, 4.0, -1.0])]
    df = spark.createDataFrame(rows, "series_id string, period_start date, period_end date, value double")
    reasons = [r.missing_reason for r in series.returns(df, 1).orderBy("period_start").collect()]
    assert reasons == ["insufficient_history", None, "return_input_missing", "return_input_missing", "zero_return_base", None]
    logs = [r.missing_reason for r in series.returns(df, 1, log=True).orderBy("period_start").collect()]
    assert logs[-1] == "nonpositive_log_return_input"
    assert series.returns(df, 1, forward=True).orderBy("period_start").collect()[-1].missing_reason == "insufficient_forward_horizon"


def test_ols_statuses(spark):
    rows = [("exact", float(i), 2.0 * i, 3 + i - 4.0 * i) for i in range(6)] + [("two", float(i), float(i * i), 1 + i + 2.0 * i * i) for i in range(6)] + [("few", 1.0, 2.0, 3.0)] + [("flat", float(i), float(i * i), 5.0) for i in range(6)]
    got = {r.g: r for r in series.ols(spark.createDataFrame(rows, "g string, a double, b double, y double"), ["g"], "y", ["a", "b"]).collect()}
    assert got["exact"].status == "singular_design" and got["few"].status == "insufficient_degrees_of_freedom"
    assert got["two"].coefficients == pytest.approx([1, 1, 2]) and got["two"].r_squared == pytest.approx(1)
    assert (got["flat"].status, got["flat"].warning, got["flat"].r_squared) == ("established", "constant_target", None)
    assert got["flat"].coefficients == pytest.approx([5, 0, 0])
    line = spark.createDataFrame([("g", float(i), 3.0 * i) for i in range(1, 4)] + [("h", 1.0, 1.0)], "g string, a double, y double")
    through = {r.g: r for r in series.ols(line, ["g"], "y", ["a"], intercept=False).collect()}
    assert through["g"].coefficients == pytest.approx([3.0]) and through["g"].r_squared == pytest.approx(1)
    assert through["h"].status == "insufficient_degrees_of_freedom"


def test_rolling_windows_are_of_raw_rows(spark):
    rows = [("s", 1, 1.0, 1.0), ("s", 2, 2.0, None), ("s", 3, 3.0, 3.0), ("s", 4, 3.0, 5.0), ("s", 5, 3.0, 9.0), ("s", 6, 4.0, 2.0)]
    df = spark.createDataFrame(rows, "k string, t int, x double, y double")
    got = [(r.t, r.sample_size, r.status) for r in series.rolling_regression(df, 3, ["k"], ["t"]).orderBy("t").collect()]
    assert got == [(3, 2, "insufficient_degrees_of_freedom"), (4, 2, "insufficient_degrees_of_freedom"), (5, 3, "singular_design"), (6, 3, "established")]


def test_digests_of_different_rows_differ(spark):
    df = spark.createDataFrame([(1, "a", None, "b"), (2, "a", "b", None), (3, "a|b", "", ""), (4, "a", "b|", "")], "k int, x string, y string, z string")
    parts = [F.col(c) for c in "xyz"]
    assert quality.semantic_identity(df, ["k"], parts).select("identity").distinct().count() == 4
    assert quality.table_digest(df, parts, ["k"]).select("digest").distinct().count() == 4
    ids = {r.k: r.i for r in df.select("k", scalars.stable_id("p", *parts).alias("i")).collect()}
    assert ids[1] is None and ids[3] != ids[4]
    maps = spark.range(1).select(scalars.dimensions_digest(F.expr("map('a', '1;b=2')")).alias("m"), scalars.dimensions_digest(F.expr("map('a', '1', 'b', '2')")).alias("n"), scalars.dimensions_digest(F.expr("map('a', '1', 'b', null)")).alias("o"), scalars.dimensions_digest(F.expr("map('a', '1')")).alias("p"), scalars.dimensions_digest(F.expr("map('b', '2', 'a', '1')")).alias("q")).first()
    assert len({*maps}) == 4 and maps.n == maps.q
    assert spark.range(1).select(scalars.json_canonical({"b": F.lit(None).cast("int"), "a": F.lit(1)}).alias("j")).first().j == '{"a":1,"b":null}'


def test_families_compare_their_own_fields(spark):
    at = datetime.datetime(2024, 1, 5, 9)
    curve = spark.createDataFrame([("p", "d", "v", 1, 1.0, None, "active", at, 1), ("p", "d", "v", 1, 1.0, None, "active", at, 2), ("p", "d", "v", 1, None, "holiday", "active", at, 3)], "provider string, curve_date string, variant string, tenor int, value double, reason string, state string, captured_at timestamp, t int")
    assert [(r.t, r.available_precision, r.available_at) for r in ledger.append_curve(curve, ["t"]).orderBy("t").collect()] == [(1, "datetime", at), (3, "datetime", at)]
    actions = spark.createDataFrame([("e", "p", "dividend", 1.0, "USD", 1, 2, "active", 1), ("e", "p", "dividend", 1.0, "USD", 1, 3, "active", 2), ("e", "p", "dividend", 2.0, "USD", 1, 3, "active", 3)], "event string, provider string, kind string, cash_amount double, currency string, split_from int, split_to int, state string, t int")
    assert [(r.t, r.split_to) for r in ledger.append_actions(actions, ["t"]).orderBy("t").collect()] == [(1, None), (3, None)]
    seen = spark.createDataFrame([("s", 1, "x", 1), ("s", 1, "y", 2), ("s", 2, "y", 3), ("s", 2, "x", 4), ("s", 3, "z", 5)], "k string, value int, content string, t int")
    kept = ledger.append_corrections(seen, ["k"], ["t"], ["value", "content"]).orderBy("t").collect()
    assert [(r.t, r.sequence, r.supersedes) for r in kept] == [(1, 1, None), (3, 2, 1), (5, 3, 2)]


def test_partial_snapshots_omit_nothing(spark):
    current = spark.createDataFrame([("u", "a", "active", 1), ("u", "b", "active", 1), ("v", "a", "active", 1)], "universe string, member string, state string, sequence int")
    snapshot = spark.createDataFrame([("u", "a", True), ("v", "z", False)], "universe string, member string, whole boolean")
    gone = ledger.tombstone_omissions(current, snapshot, ["universe", "member"], snapshot, ["universe"], "whole").collect()
    assert [(r.universe, r.member, r.sequence) for r in gone] == [("u", "b", 2)]


def test_datetimes_have_a_t_and_an_offset_with_colon(spark):
    for text in ("2024-03-05 10:00:00+01:00", "2024-03-05T10:00:00+0100", "2024-03-05T10:00:00"):
        assert spark.range(1).select(parse_temporal(F.lit(text)).precision.alias("p")).first().p is None


def test_one_row_of_an_identity_is_the_same_in_every_order(spark):
    rows = [("i", 3), ("i", 1), ("i", 2)]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "id string, v int")
        assert [tuple(r) for r in ledger.replay_gate(df, df.limit(0), ["id"]).collect()] == [("i", 1)]


def test_correlation_without_variance_is_not_established(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0), ("a", 1.0, 2.0), ("b", 1.0, 2.0), ("c", 1.0, 2.0), ("c", 2.0, 4.0)], "g string, x double, y double")
    assert {r.g: r.correlation for r in series.correlation(df, ["g"]).collect()} == {"a": None, "b": None, "c": pytest.approx(1)}


def test_benjamini_hochberg_by_hand(spark):
    df = spark.createDataFrame([("f", p) for p in (0.01, 0.03, 0.04, 0.5, None)], "family string, p double")
    got = [round(r.adjusted, 4) for r in series.adjusted_p(df, ["family"]).orderBy("position").collect()]
    assert got == [0.04, 0.0533, 0.0533, 0.5]


def test_bm25_terms_phrases_and_accents(spark):
    docs = spark.createDataFrame([(1, "Ré-entry of the big red fox"), (2, "red fox red fox"), (3, "fox red"), (4, None)], "id int, t string")
    of = lambda q: {r.id: r.score for r in search.bm25(docs, ["id"], F.col("t"), q).collect()}
    assert set(of("red fox")) == {1, 2, 3} and set(of("red-fox")) == {1, 2} and set(of("re")) == {1}
    assert of("red")[2] > of("red")[1]
    with pytest.raises(ValueError):
        search.bm25(docs, ["id"], F.col("t"), "a;b")


def test_canonical_texts(spark):
    row = spark.range(1).select(*[scalars.decimal_canonical(F.lit(v)).alias(f"c{i}") for i, v in enumerate(["10.500", "-0", "100", "0.00001"])]).first()
    assert list(row) == ["10.5", "0", "100", "0.00001"]


def test_chunks_cover_every_row_once(spark):
    rows = spark.range(1000).select("id", F.concat(F.lit("r"), "id").alias("line"))
    chunks = export.chunk_manifest(rows, ["id"], F.col("line"), 250).orderBy("chunk_id").collect()
    assert [(c.rows, c.first_key, c.last_key) for c in chunks] == [(250, "0", "249"), (250, "250", "499"), (250, "500", "749"), (250, "750", "999")]


def test_positions_are_of_the_whole_order(spark):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"), F.lit("one prefix").alias("p"))
    placed = export.numbered(rows, ["p", "k"], 6)
    assert placed.filter("position <> k").isEmpty() and placed.count() == 5000 and placed.columns == ["k", "p", "position"]
    assert export.numbered(rows.limit(0), ["p", "k"]).collect() == []


def test_a_digest_tree_tells_order_and_content(spark, monkeypatch):
    monkeypatch.setattr(export, "FAN_OUT", 4)
    leaves = lambda xs: spark.createDataFrame(list(enumerate(xs)), "i long, d string")
    root = lambda xs: export.digest_tree(leaves(xs), "i", "d").first().digest
    xs = [f"h{i}" for i in range(40)]
    sha = lambda parts: hashlib.sha256(",".join(parts).encode()).hexdigest()
    level = xs
    for _ in range(3):
        level = [sha(level[i : i + 4]) for i in range(0, len(level), 4)]
    assert [root(xs)] == level and root(xs[::-1]) != level[0] and root(xs[:-1]) != level[0]


def test_csv_rules_reject_and_keep(spark, tmp_path):
    head = "provider,provider_symbol,asset_type,trade_date,open,high,low,close,volume,currency,price_variant,available_at,available_precision\n"
    (tmp_path / "a.csv").write_text(head + "p,X,etf,2024-01-02,1,3,1,2,10,USD,raw,2024-01-02,date\n" + "p,Y,etf,2024-01-02,1,0.5,1,2,-1,USD,raw,2024-01-02T00:00:00Z,date\n" + "p,Z,etf,not-a-date,1,3,1,2,10,USD,raw,2024-01-02,date\n")
    checked = readers.read_prices(spark, str(tmp_path))
    assert [r.provider_symbol for r in quality.accepted(checked).collect()] == ["X"]
    got = {r.provider_symbol: set(r.rejected) for r in checked.collect()}
    assert got["Y"] == {"ohlc_consistent", "volume", "precision"} and "parses" in got["Z"]


def test_json_document_of_observations(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"family": "gdp", "provider": "p", "captured_at": "2024-01-01T00:00:00Z", "payload": {\n "series": [{"series_id": "s", "unit": "usd"}], "releases": [{"source_vintage_identity": "v2", "source_release_order": 2}],\n "observations": [{"series_id": "s", "release_identity": "v2", "period_start": "2023-10-01", "period_end": "2023-12-31", "value": "1.5"}]}}')
    (row,) = readers.macro_observations(readers.read_document(spark, str(tmp_path), readers.MACRO)).collect()
    assert (row.series_id, row.unit, row.release_order, row.value, row.missing_reason) == ("s", "usd", 2, "1.5", None)


def test_stream_of_batches_equals_one_batch(spark, tmp_path):
    spec = ledger.LedgerSpec(key=("k",), rank=("t",), payload=("value",))
    rows = [("a", 1, 1.0), ("a", 2, 1.0), ("a", 3, 2.0), ("b", 3, 7.0), ("a", 4, 2.0), ("a", 5, 3.0), ("b", 6, 7.0)]
    df = spark.createDataFrame(rows, "k string, t int, value double")
    append = ingest.ledger_appender(spec, str(tmp_path / "ledger"), ["t"])
    for number, (a, b) in enumerate([(0, 2), (2, 3), (3, 9)]):
        append(df.filter((F.col("t") > a) & (F.col("t") <= b)), number)
    append(df.filter("t > 3"), 2)  # the same batch once more
    got = sorted((r.k, r.t, r.sequence, r.supersedes) for r in spark.read.parquet(str(tmp_path / "ledger")).collect())
    want = sorted((r.k, r.t, r.sequence, r.supersedes) for r in ledger.append_changes(df, spec, ["t"]).collect())
    assert got == want


def test_corrections_keep_null_keys_and_long_values(spark):
    rows = [(None, 1, 9007199254740993, "a"), (None, 2, 9007199254740993, "a"), (None, 3, 9007199254740993, "a"), ("k", 1, None, "a"), ("k", 2, 9007199254740993, "b"), ("k", 3, 9007199254740995, "b"), ("k", 4, 9007199254740995, "c"), ("k", 5, 1, "d")]
    df = spark.createDataFrame(rows, "k string, t int, value long, content string")
    got = ledger.append_corrections(df, ["k"], ["t"], ["value", "content"]).collect()
    assert sorted(((r.k, r.t, r.value, r.sequence) for r in got), key=str) == sorted([(None, 1, 9007199254740993, 1), ("k", 1, None, 1), ("k", 2, 9007199254740993, 2), ("k", 4, 9007199254740995, 3), ("k", 5, 1, 4)], key=str)


def test_ols_passes_its_keys_untouched(spark):
    rows = [(g, float(x), 2.0 * x + 1) for g in (None, 9007199254740993, 5) for x in range(4)]
    out = series.ols(spark.createDataFrame(rows, "g long, x double, y double"), ["g"], "y", ["x"]).collect()
    assert {r.g for r in out} == {None, 9007199254740993, 5} and all(abs(r.coefficients[1] - 2) < 1e-9 for r in out)
    empty = series.ols(spark.createDataFrame([], "g long, x double, y double"), ["g"], "y", ["x"])
    assert empty.collect() == []


def test_curve_of_five_tenors(spark):
    points = spark.createDataFrame([("d", t, r) for t, r in zip(declared.CURVE_TENORS, [5.0, 4.0, 3.5, 4.2, 4.6])] + [("e", "2y", 4.0), ("e", "10y", 4.5)], "day string, tenor string, rate double")
    out = {r.day: r for r in declared.curve_spreads(points, ["day"]).collect()}
    measures = lambda r: tuple(None if x is None else round(x, 9) for x in (r.slope_10y_2y, r.slope_10y_3m, r.slope_30y_5y, r.butterfly_2s5s10s, r.curvature_2s10s30s))
    assert measures(out["d"]) == (0.2, -0.8, 1.1, -1.2, -0.2) and measures(out["e"]) == (0.5, None, None, None, None)


def test_a_micro_batch_reads_and_rewrites_the_buckets_of_its_keys(spark, tmp_path):
    spec, path = ledger.LedgerSpec(key=("k",), rank=("t",), payload=("value",)), str(tmp_path / "ledger")
    append = ingest.ledger_appender(spec, path, ["t"], buckets=16)
    append(spark.createDataFrame([(f"k{i}", 1, 1.0) for i in range(100)], "k string, t int, value double"), 0)
    before = ingest.state_of(spark, path)
    assert len(before) == 16
    one = spark.createDataFrame([("k7", 2, 5.0), ("k7", 3, 5.0)], "k string, t int, value double")
    for _ in range(2):  # and its replay
        append(one, 1)
        after = ingest.state_of(spark, path)
        moved = [b for b in after if after[b] != before[b]]
        assert len(moved) == 1 and len(list((tmp_path / "ledger" / "_state" / "batch=1").glob("bucket=*"))) == 1
        schema = "k string, t int, value double, sequence long"
        read = ingest.read_state(spark, path, {b: after[b] for b in moved}, schema)
        assert len(read.inputFiles()) == 1 and {(r.k, r.sequence) for r in read.filter("k = 'k7'").collect()} == {("k7", 2)}
        assert spark.read.parquet(path).count() == 101
    append(one.withColumn("t", F.col("t") + 5).withColumn("value", F.lit(9.0)), 2)
    assert not list((tmp_path / "ledger" / "_state" / "batch=0").glob(f"bucket={moved[0]}")), "the state that batch 1 replaced"
    assert {r.sequence for r in spark.read.parquet(path).filter("k = 'k7'").collect()} == {1, 2, 3}


def test_late_vintages_append_without_becoming_current(spark, tmp_path):
    spec, path = ledger.LedgerSpec(key=("series", "vintage"), rank=("release",), payload=("value",)), str(tmp_path / "ledger")
    append, schema = ingest.ledger_appender(spec, path, ["release"]), "series string, vintage string, release int, value double"
    append(spark.createDataFrame([("gdp", "second", 2, 1.5)], schema), 0)
    append(spark.createDataFrame([("gdp", "advance", 1, 1.0), ("cpi", "advance", 1, 3.0)], schema), 1)
    now = ingest.current_versions(spark, path, spec, schema + ", sequence long", ["series"]).collect()
    assert {(r.series, r.vintage, r.value) for r in now} == {("gdp", "second", 1.5), ("cpi", "advance", 3.0)}
    assert spark.read.parquet(path).count() == 3


def test_an_empty_first_batch_and_empty_batches(spark, tmp_path):
    spec, path = ledger.LedgerSpec(key=("k",), rank=("t",), payload=("value",)), str(tmp_path / "ledger")
    append, schema = ingest.ledger_appender(spec, path, ["t"]), "k string, t int, value double"
    for number, rows in enumerate([[], [("a", 1, 1.0)], [], [("a", 2, 1.0), ("a", 3, 2.0), (None, 1, None), (None, 2, None)]]):
        append(spark.createDataFrame(rows, schema), number)
    assert sorted(((r.k, r.t, r.sequence) for r in spark.read.parquet(path).collect()), key=str) == sorted([("a", 1, 1), ("a", 3, 2), (None, 1, 1)], key=str)


def test_harmonic_factor_of_by_is_summed_once_for_a_family(spark):
    rows = [("f", i, (i + 1) / 8) for i in range(4)] + [("g", 0, 0.5), ("g", 1, None)]
    out = series.adjusted_p(spark.createDataFrame(rows, "family string, test int, p double"), ["family"], tie=["test"], method="by")
    assert "_harmonic" not in out.columns and "sequence(" not in out._jdf.queryExecution().optimizedPlan().toString()
    harmonic = 1 + 1 / 2 + 1 / 3 + 1 / 4
    assert sorted((r.family, r.test, round(r.adjusted, 9)) for r in out.collect()) == [*[("f", i, round(min(1.0, 0.5 * harmonic), 9)) for i in range(4)], ("g", 0, 0.5)]
