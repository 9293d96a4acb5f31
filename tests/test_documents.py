"""Nested documents to typed rows and rejects."""

import datetime
import json
from decimal import Decimal

import pytest

from tidemark.sources import documents as D
from tidemark.sources.documents import Family, Field


def items(spark, docs, families, context=None):
    texts = [(f"d{i}", t if t is None or isinstance(t, str) else json.dumps(t)) for i, t in enumerate(docs)]
    return D.split(spark.createDataFrame(texts, "file string, text string"), families, context=context)


ONE = Family("rows", "$.payload.rows", (Field("name"), Field("day", "date"), Field("at", "temporal", nullable=True, precision="how"), Field("how", nullable=True), Field("price", "decimal", minimum=0), Field("n", "integer", nullable=True, minimum=1), Field("ok", "boolean"), Field("kind", among=("a", "b"))), exact=True)
GOOD = {"name": "x", "day": "2024-02-29", "at": "2024-01-01T00:00:00Z", "how": "datetime", "price": "12.50", "n": 3, "ok": True, "kind": "a"}


@pytest.mark.parametrize(
    ("change", "rules"),
    [
        ({}, set()),
        ({"at": None, "n": None}, set()),
        ({"name": " "}, {"name:blank"}),
        ({"name": 5}, {"name:type"}),
        ({"name": None}, {"name:null"}),
        ({"day": "2023-02-29"}, {"day:format"}),
        ({"day": "2024-01-01T00:00:00Z"}, {"day:format"}),
        ({"at": "2024-01-01T00:00:00"}, {"at:format"}),
        ({"at": "2024-01-01"}, {"at:precision"}),
        ({"price": 12.5}, {"price:type"}),
        ({"price": "1e3"}, {"price:format"}),
        ({"price": "-0.01"}, {"price:minimum"}),
        ({"n": True}, {"n:type"}),
        ({"n": "3"}, {"n:type"}),
        ({"n": 2.5}, {"n:type"}),
        ({"n": 0}, {"n:minimum"}),
        ({"ok": "true"}, {"ok:type"}),
        ({"kind": "c"}, {"kind:enum"}),
        ({"more": 1, "extra": 2}, {"extra,more:unknown"}),
        ({"name": 5, "kind": None}, {"name:type", "kind:null"}),
    ],
)
def test_rules_of_paths(spark, change, rules):
    row = D.typed(items(spark, [{"payload": {"rows": [GOOD | change]}}], [ONE]), ONE).collect()[0]
    assert set(row.rejected) == rules
    if not change:
        assert (row.file, row.name, row.day, row.price, row.n, row.ok) == ("d0", "x", datetime.date(2024, 2, 29), Decimal("12.50"), 3, True)


def test_absent_fields_and_documents_that_are_none(spark):
    short = {k: v for k, v in GOOD.items() if k not in ("name", "ok")}
    found = items(spark, [{"payload": {"rows": [short, GOOD]}}, "{", None, {"payload": {}}, {"payload": {"rows": {}}}, "[]"], [ONE])
    got = sorted((r.file, r.family, r.place, r.rule) for r in D.rejects_of(found, [ONE], ["file"]).collect())
    assert got == [("d0", "rows", [0], "name:absent"), ("d0", "rows", [0], "ok:absent"), ("d1", D.NO_DOCUMENT, [0], "document:json"), ("d2", D.NO_DOCUMENT, [0], "document:json")]
    assert [r.name for r in D.rows_of(found, ONE).collect()] == ["x"]


def test_inner_families_carry_their_outer_item_and_context(spark):
    available = {"available_at": "2024-01-01", "available_precision": "date"}
    links = [{"link_kind": "ticker", "provider": "p", "provider_identifier": s, "valid_from": "2024-01-01", "valid_through": None, "confidence": "high", **available} for s in ("A", "B")]
    doc = {"source": "s", "issuers": [{"issuer_key": "one", "cik": "1", "legal_name": "One", "entity_type": "x", "state": "active", **available, "links": links}, {"issuer_key": "two", "links": []}, {"issuer_key": "three"}, {"issuer_key": None, "links": links[:1]}]}
    found = items(spark, [doc], D.COMPANY, {"source": "$.source"})
    got = D.typed(found, D.family(D.COMPANY, "issuer_links")).collect()
    assert [(r.issuer_key, r.place, r.provider_identifier, r.carried["source"], r.rejected) for r in got] == [("one", [0, 0], "A", "s", []), ("one", [0, 1], "B", "s", []), (None, [3, 0], "A", "s", [])]
    assert len(D.rows_of(found, D.family(D.COMPANY, "issuers")).collect()) == 1


def test_items_can_be_written_a_folder_for_each_family(spark, tmp_path):
    doc = {"universe": {"universe_key": "u", "display_name": "U", "completeness": "complete", "available_at": "2024-01-01", "available_precision": "date", "members": [{"instrument_key": "i", "effective_from": "2024-01-01", "effective_through": None}]}}
    items(spark, [doc], D.CATALOG).write.partitionBy("family").parquet(str(tmp_path / "items"))
    back = spark.read.parquet(str(tmp_path / "items"))
    member = D.rows_of(back, D.family(D.CATALOG, "members")).collect()[0]
    assert (member.instrument_key, member.effective_from, member.effective_through) == ("i", datetime.date(2024, 1, 1), None)
    assert D.rows_of(back, D.family(D.CATALOG, "universe")).first().completeness == "complete"
    assert D.rejects_of(back, D.CATALOG, ["file"]).count() == 0


def test_arrays_of_bars_are_of_one_symbol_and_the_days_asked(spark):
    bar = lambda day, **more: {"symbol": "S", "date": day, "open": 2, "high": 3.5, "low": 1, "close": 2.25, "volume": 10, "change": 0, "changePercent": -0.5, "vwap": 2} | more
    days = ["2024-01-02", "2024-01-03"]
    docs = {
        "good": [bar(d) for d in days],
        "shape": [bar(days[0]), bar(days[1], extra=1)],
        "quoted": [bar(days[0], open="2"), bar(days[1])],
        "prices": [bar(days[0], high=1.5), bar(days[1])],
        "other": [bar(days[0], symbol="T"), bar(days[1])],
        "twice": [bar(days[0]), bar(days[0])],
        "late": [bar(days[0]), bar("2024-02-01")],
        "broken": "[",
    }
    texts = spark.createDataFrame([(k, t if isinstance(t, str) else json.dumps(t)) for k, t in docs.items()], "file string, text string")
    wanted = [datetime.date.fromisoformat(d) for d in days]
    scope = spark.createDataFrame([(k, "S", wanted[0], wanted[1], wanted, 2) for k in docs], "file string, symbol string, first_day date, last_day date, days array<date>, expected_rows long")
    got = {}
    for r in D.bar_array_faults(texts, scope, ["file"]).collect():
        got.setdefault(r.file, set()).add(r.rule)
    assert got == {
        "shape": {"extra:unknown", "missing_day", "row_count"},
        "quoted": {"open:type", "missing_day", "row_count"},
        "prices": {"prices"},
        "other": {"other_symbol"},
        "twice": {"duplicate_key", "missing_day"},
        "late": {"out_of_scope", "missing_day", "unexpected_day"},
        "broken": {"document:json", "missing_day", "row_count"},
    }


def test_documents_read_a_source_once_for_all_its_families(spark, tiny):
    from tidemark.plans import documents as P

    whole = P.documents(spark, tiny, D.OPTIONS, P.OPTIONS)
    plan = whole._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [l_orderkey") == 1
    one = json.loads(whole.filter("doc = 1").first().text)
    lines = [r.l_linenumber for r in spark.read.parquet(f"{tiny}/lineitem.parquet").filter("l_orderkey = 1").collect()]
    assert {len(a) for a in (one["contracts"], one["surface"], one["inputs"]["expiry_inputs"], one["inputs"]["rate_curve"]["points"])} == {len(lines)}
    assert sorted(s["quote"]["volume"] for s in one["surface"]) == sorted(lines) and one["capture"]["underlying_key"] is not None


def test_rejects_of_documents_are_those_of_their_items(spark):
    docs = ["{", None, json.dumps({"payload": {"rows": [GOOD, GOOD | {"name": 5, "kind": None}, GOOD | {"more": 1}, {}]}})]
    texts = spark.createDataFrame([(f"d{i}", t) for i, t in enumerate(docs)], "file string, text string")
    key = lambda r: (r.file, r.family, tuple(r.place), r.rule)
    got = sorted(map(key, D.document_rejects(texts, [ONE], ["file"]).collect()))
    assert got == sorted(map(key, D.rejects_of(D.split(texts, [ONE]), [ONE], ["file"]).collect())) and len(got) > 5


def test_a_source_makes_each_text_once_for_all_fields(spark, tiny):
    from tidemark.plans import documents as P

    whole = P.documents(spark, tiny, D.OPTIONS, P.OPTIONS)
    plan = whole._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("cast(cast(l_extendedprice") == 1
    one, line = json.loads(whole.filter("doc = 1").first().text), spark.read.parquet(f"{tiny}/lineitem.parquet").filter("l_orderkey = 1").orderBy("l_linenumber").first()
    found = next(c for c in one["surface"] if c["provider_contract_id"] == f"1-{line.l_linenumber}")
    assert {found["bars"][0][n] for n in ("open", "high", "low", "close")} == {found["quote"]["last_price"]} == {f"{line.l_extendedprice:.2f}"}


def test_a_filter_of_rejected_rows_reads_each_path_once(spark):
    found = D.rows_of(items(spark, [{"payload": {"rows": [GOOD]}}], [ONE]), ONE)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("$.price") == 1 and plan.count("schema_of_variant") <= len(ONE.fields) and "Generate explode(array(struct" in plan.replace("named_struct", "struct")


def test_items_whose_text_is_right_are_not_read_field_by_field(spark, tiny):
    from tidemark.plans import documents as P

    certain = {f.name: D._certain(f, [g for g in D.OPTIONS if g.inner and g.path == f.path]) for f in D.OPTIONS if not f.inner}
    assert all(certain.values())
    texts = P.documents(spark, tiny, D.OPTIONS, P.OPTIONS)
    plan = D.document_rejects(texts, D.OPTIONS, ["doc"])._jdf.queryExecution().optimizedPlan().toString()
    assert all(c.replace("\\", "") in plan.replace("\\", "") for c in certain.values())
    item = json.dumps(json.loads(texts.filter("doc = 1").first().text)["contracts"][0], separators=(",", ":"))
    found = spark.createDataFrame([(item,), (item.replace('"p"', '" "'),), (item.replace('"p"', "5"),), (item.replace('"p"', '"Infinity"'),)], "t string")
    assert [r.y for r in found.selectExpr("t").withColumn("y", found.t.rlike(f"^{certain['contracts']}$")).collect()] == [True, False, False, False]


LIST = (
    Family("rows", "$.a.rows", (Field("x"), Field("d", "date", nullable=True), Field("t", "temporal", precision="w"), Field("w", among=("date", "datetime")), Field("q", "decimal", path="$.in.q"), Field("m", "decimal", minimum=0, nullable=True, path="$.in.m"), Field("n", "integer", minimum=19), Field("s", "text"), Field("any", "any"))),
    Family("one", "$.a.rows", (Field("x"), Field("v", "integer", minimum=0)), inner="$.one", single=True),
    Family("many", "$.a.rows", (Field("y", "datetime"), Field("c", among=("u", "v"), nullable=True)), inner="$.many.of", outer=("x",)),
    Family("whole", "$.s", (Field("x"), Field("d", "date")), single=True),
)
RIGHT = {"x": "k", "d": "2024-03-31", "t": "2024-01-01", "w": "date", "in": {"q": "-1.5", "m": "0"}, "n": 19, "s": "", "any": "t", "one": {"x": "k", "v": 0}, "many": {"of": [{"y": "2024-01-01T00:00:00+01:30", "c": None}]}}


def test_rejects_by_patterns_are_those_of_the_items_read_field_by_field(spark):
    values = [None, " ", " k", "Infinity", 5, 2.0, 18, 20, 1900, 19.0, -1, "2024-02-29", "2024-02-30", "2024-04-31", "2024-01-01T00:00:00Z", "2024-01-01T24:00:00Z", "datetime", "-0", "1e5", "1.12345678901", "{}", [], {}, {"x": "k", "v": 2.0}, {"of": [None, 3]}, 10**18, 10**19]
    docs = [{"a": {"rows": [RIGHT, RIGHT | {k: v}, {n: x for n, x in RIGHT.items() if n != k}]}, "s": v} for k in RIGHT for v in values]
    docs += [{"a": v, "s": {"x": "k", "d": "2024-01-01"}} for v in ([], {"rows": {}}, {"rows": "r"}, {"rows": [RIGHT, 5, None, "t"]}, {"rows": [RIGHT | {"more": 1}, dict(sorted(RIGHT.items()))]})]
    compact = [json.dumps(d, separators=(",", ":")) for d in docs]
    right = json.dumps(RIGHT, separators=(",", ":"))
    odd = [json.dumps({"a": {"rows": [right]}}), f'{{"a":{{"rows":[{right}]}},"a":1}}', f'[{{"a":{{"rows":[{right}]}}}}]', f'{{"a":{{"rows":[{right}]', f' {{"a":{{"rows":[{right}]}}}} x', f'{{"a":{{"rows":[{right}]}}}}'.replace("19", "1.9e1")]
    odd += [f'{{"a":{{"rows":[{right.replace(a, b)}]}}}}' for a, b in (('"x":"k"', '"x":1E400'), ('"s":""', '"s":-1e999'), ('"n":19', '"n":19,"n":19'), ('"n":19', '"n":1900000000000000000000'))]
    texts = spark.createDataFrame(list(enumerate(compact + odd)), "file int, text string").repartition(4)
    key = lambda r: (r.file, r.family, tuple(r.place), r.rule)
    assert D._parts_type(LIST) and D._certain(LIST[0], LIST[1:3]) and D._certain(LIST[3], [])
    for families in (LIST, LIST[2:0:-1] + LIST[:1], (Family("rows", "$.a.rows", LIST[0].fields, exact=True), *LIST[1:])):
        got = sorted(map(key, D.document_rejects(texts, families, ["file"]).collect()))
        assert got == sorted(map(key, D.rejects_of(D.split(texts, families), families, ["file"]).collect())) and len(got) > 500


def test_rejects_of_inner_single_and_odd_paths_are_those_of_their_items(spark):
    families = [
        ONE,
        Family("ins", "$.payload.rows", (Field("x", "any"), Field("deep", "number", nullable=True, path="$.a.b[0].c"), Field("d"), Field("upper", nullable=True, path="$.D")), inner="$.more.ins", exact=True, outer=("name",)),
        Family("one", "$.payload.rows", (Field("x", "datetime"), Field("y", "text", path="$.x.y")), inner="$.more", single=True),
        Family("top", "$.payload", (Field("z", "integer", minimum=2), Field("q", "any", path="$['a b']"), Field("rows", "any")), single=True),
    ]
    inner = [{"x": 1, "d": "k", "D": 5, "a": {"b": [{"c": "2"}]}}, None, 3, {"x": {"y": "v"}, "e": 0}]
    rows = [GOOD, None, 7, GOOD | {"more": {"ins": inner}}, {"more": {"x": "2024-01-01T00:00:00Z", "ins": {}}}, {"more": {"x": {"y": "t"}}}, {"more": 4}]
    docs = [{"payload": {"rows": rows, "z": 2.0, "a b": []}}, {"payload": {"z": 3, "rows": {}}}, {"payload": 4}, [{"payload": {"rows": rows}}], {}]
    texts = spark.createDataFrame([(f"d{i}", json.dumps(d)) for i, d in enumerate(docs)] + [("twice", '{"payload": {"z": 1, "z": 2}}')], "file string, text string")
    key = lambda r: (r.file, r.family, tuple(r.place), r.rule)
    got = sorted(map(key, D.document_rejects(texts, families, ["file"]).collect()))
    assert got == sorted(map(key, D.rejects_of(D.split(texts, families), families, ["file"]).collect()))
    assert {("d0", "ins", (3, 0), "deep:type"), ("d0", "top", (0,), "z:type"), ("d2", "top", (0,), "z:absent"), ("twice", D.NO_DOCUMENT, (0,), "document:json")} <= set(got)
