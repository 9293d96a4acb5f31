"""Readers of nested documents."""

import json

from tidemark.sources import readers as R


def test_option_quotes_meet_their_documents_first_contract(spark, tmp_path):
    """An entry takes its own document's contract; entries twice, without an id or without a contract stay; no entry carries all contracts."""
    contract = lambda i, strike: {"provider_contract_id": i, "strike_price": strike, "option_type": "call"}
    entry = lambda i, state, bars=0: {"provider_contract_id": i, "surface_state": state, "quote": {"bid_price": 1.0, "ask_price": 2.0}, "bars": [{"bar_start": "d", "close": 1.0}] * bars}
    docs = [
        {"capture": {"capture_id": "k"}, "contracts": [contract("a", 5.0), contract("a", 4.0), contract(None, 9.0), contract("b", None)], "surface": [entry("a", "present", 2), entry("a", "missing"), entry(None, "x"), entry(None, "y"), entry("b", "z"), entry("c", "none")]},
        {"capture": {"capture_id": "k"}, "contracts": [contract("a", 7.0)], "surface": [entry("a", "other")]},
        {"capture": {"capture_id": "n"}, "surface": [entry("a", "alone")]},
        {"capture": {"capture_id": "e"}, "contracts": [contract("a", 1.0)]},
    ]
    (tmp_path / "docs.json").write_text("\n".join(json.dumps(d) for d in docs))
    out = R.option_quotes(R.read_document(spark, str(tmp_path / "docs.json"), R.OPTIONS, lines=True))
    assert out.columns == ["capture_id", "provider_contract_id", "surface_state", "bid_price", "ask_price", "strike_price", "bars"]
    got = sorted((r.capture_id, r.surface_state, r.strike_price, r.bars) for r in out.collect())
    assert got == [("k", "missing", 5.0, 0), ("k", "none", None, 0), ("k", "other", 7.0, 0), ("k", "present", 5.0, 2), ("k", "x", None, 0), ("k", "y", None, 0), ("k", "z", None, 0), ("n", "alone", None, 0)]
    assert "filter(contracts" not in out._jdf.queryExecution().optimizedPlan().toString()
