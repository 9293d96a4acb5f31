"""Captures of option surfaces: their rules, the tables of a nested document, and nested and flat reads.

All tables name their capture in ``capture``; availability is in
available_precision, available_date and available_at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.temporal import CALENDAR_DATE_INCLUSIVE, COMPLETED_DATE, Temporal, pit_visible
from tidemark.operators.asof import as_of_each
from tidemark.operators.ledger import LedgerSpec
from tidemark.operators.nested import nest

CAPTURE_SPEC = LedgerSpec(key=("underlying",), rank=("available_date", "available_at", "capture"))
AVAILABLE = ("available_precision", "available_date", "available_at")


def broken(rows: DataFrame, key: Sequence[str], rules: dict[str, Column]) -> DataFrame:
    """key and rule of every rule that a row breaks; a rule tells when it is broken, null is not."""
    found = F.array_compact(F.array(*[F.when(F.coalesce(wrong, F.lit(False)), F.lit(name)) for name, wrong in rules.items()]))
    return rows.select(*key, F.explode(found).alias("rule"))


def context_faults(rows: DataFrame, captures: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of another feed or environment than their capture's, that became available after it, or whose capture lacks.

    A row known by the date of its capture's instant counts as in time.
    """
    own = captures.select("capture", F.struct("feed", "environment", *AVAILABLE).alias("_capture"))
    met = rows.join(own, "capture", "left")
    c = F.col("_capture")
    in_time = pit_visible(Temporal(*[F.col(a) for a in AVAILABLE]), Temporal(*[c[a] for a in AVAILABLE]), CALENDAR_DATE_INCLUSIVE)
    there = c.isNotNull()
    return broken(met, ["capture", *key], {"unknown_capture": ~there, "feed": there & ~F.col("feed").eqNullSafe(c["feed"]), "environment": there & ~F.col("environment").eqNullSafe(c["environment"]), "availability": there & ~in_time})


def coverage_faults(contracts: DataFrame, surface: DataFrame) -> DataFrame:
    """Declared contracts (capture, contract) without a surface row, rows of undeclared ones, and second rows."""
    rows = surface.groupBy("capture", "contract").agg(F.count(F.lit(1)).alias("_n"))
    both = contracts.select("capture", "contract", F.lit(True).alias("_declared")).distinct().join(rows, ["capture", "contract"], "full_outer")
    return broken(both, ["capture", "contract"], {"missing_row": F.col("_n").isNull(), "undeclared": F.col("_declared").isNull(), "duplicate": F.col("_n") > 1})


QUOTE_PRICES = ("bid_price", "ask_price", "last_price")


def surface_faults(surface: DataFrame, contracts: DataFrame, captures: DataFrame, key: Sequence[str] = ("contract",)) -> DataFrame:
    """Rows whose state doesn't fit what they hold, or their contract's deliverable under the capture's policy.

    surface has surface_state, missing_reason, exclusion_reason, quote_date, the
    quote's prices, oi_state, close_state and bars (their number).
    """
    deliverable = contracts.groupBy("capture", "contract").agg(F.max("deliverable").alias("_deliverable"))
    rows = surface.join(deliverable, ["capture", "contract"], "left").join(captures.select("capture", F.col("policy").alias("_policy")), "capture", "left")
    state, missing, excluded = F.col("surface_state"), F.col("missing_reason"), F.col("exclusion_reason")
    present, empty = state == "present", F.coalesce(*[F.col(p) for p in QUOTE_PRICES], F.lit(None)).isNull() & F.col("quote_date").isNull()
    priced = F.col("quote_date").isNotNull() & F.coalesce(*[F.col(p) for p in QUOTE_PRICES]).isNotNull()
    must = (F.col("_policy") == "standard_only") & (F.col("_deliverable") == "nonstandard")
    return broken(
        rows,
        ["capture", *key],
        {
            "unknown_state": ~F.coalesce(state.isin("present", "missing", "excluded"), F.lit(False)),
            "present_with_reason": present & (missing.isNotNull() | excluded.isNotNull()),
            "present_without_quote": present & ~priced,
            "missing_not_explicit": (state == "missing") & (missing.isNull() | excluded.isNotNull() | ~empty),
            "excluded_not_explicit": (state == "excluded") & (excluded.isNull() | missing.isNotNull() | ~empty),
            "nonstandard_not_excluded": must & ~F.coalesce((state == "excluded") & (excluded == "nonstandard_deliverable"), F.lit(False)),
            "excluded_without_need": (state == "excluded") & ~F.coalesce(must, F.lit(False)),
            "observed_though_not_present": (state != "present") & ((F.col("oi_state") != "missing") | (F.col("close_state") != "missing") | (F.col("bars") > 0)),
        },
    )


EXPIRY_INPUTS = ("spot_price", "risk_free_rate", "dividend_yield", "forward_price")


def expiry_faults(contracts: DataFrame, expiry: DataFrame, inputs: DataFrame, points: DataFrame) -> DataFrame:
    """capture, expiration and rule of inputs that aren't in step with their capture.

    Every expiration of a declared contract has one input, and no other has any.
    If all dependencies of the capture are present (inputs: dependencies_present,
    last_price, trade_price), an input is present with all its numbers, its spot
    is the last, else the trade price, and its rate is a present point of the
    same capture's curve; otherwise it is an explicit missing one without numbers.
    """
    expected = contracts.select("capture", "expiration").distinct().withColumn("_expected", F.lit(True))
    numbered = expiry.groupBy("capture", "expiration").agg(F.count(F.lit(1)).alias("_n"))
    covered = broken(expected.join(numbered, ["capture", "expiration"], "full_outer"), ["capture", "expiration"], {"input_missing": F.col("_n").isNull(), "not_expected": F.col("_expected").isNull(), "input_twice": F.col("_n") > 1})
    rates = points.filter("point_state = 'present' AND zero_rate IS NOT NULL").select("capture", F.col("zero_rate").alias("risk_free_rate")).distinct().withColumn("_on_curve", F.lit(True))
    rows = expiry.join(inputs.select("capture", "dependencies_present", "last_price", "trade_price"), "capture", "left").join(rates, ["capture", "risk_free_rate"], "left")
    ready = F.coalesce("dependencies_present", F.lit(False))
    numbers = [F.col(c) for c in EXPIRY_INPUTS]
    some, none = sum((n.isNull().cast("int") for n in numbers), F.lit(0)) > 0, F.coalesce(*numbers).isNull()
    state, reason = F.col("state"), F.col("missing_reason")
    spot = F.coalesce("last_price", "trade_price")
    whole = (state == "present") & reason.isNull() & ~some
    in_step = broken(
        rows,
        ["capture", "expiration"],
        {
            "not_synchronized": ready & ~F.coalesce(whole, F.lit(False)),
            "spot_not_of_capture": ready & F.coalesce(whole, F.lit(False)) & ~F.coalesce(F.col("spot_price") == spot, F.lit(False)),
            "rate_not_on_curve": ready & F.coalesce(whole, F.lit(False)) & F.col("_on_curve").isNull(),
            "incoherent_not_missing": ~ready & ~F.coalesce((state == "missing") & reason.isNotNull() & none, F.lit(False)),
        },
    )
    return covered.unionByName(in_step)


def tables_of(documents: DataFrame) -> dict[str, DataFrame]:
    """The tables of capture documents: one row of a document gives rows of each.

    documents has the capture's columns, and arrays of structs: contracts,
    surface (each with open_interest, close_price and bars), curve, dividends and
    expiry_inputs; quote is a struct. Ids are the capture with the natural key.
    """
    head = [c for c in documents.columns if c not in ("contracts", "surface", "curve", "dividends", "expiry_inputs", "quote")]
    part = lambda name: documents.select("capture", F.explode(name).alias("x"))
    whole = lambda name: part(name).select("capture", "x.*")
    surface = whole("surface")
    observed = ("open_interest", "close_price", "bars")
    of_contract = lambda name: surface.filter(F.col(name).isNotNull()).select("capture", "contract", f"{name}.*")
    return {
        "captures": documents.select(*head),
        "contracts": whole("contracts"),
        "quotes": documents.filter("quote IS NOT NULL").select("capture", "quote.*"),
        "surface": surface.drop(*observed),
        "open_interest": of_contract("open_interest"),
        "close_prices": of_contract("close_price"),
        "bars": surface.select("capture", "contract", F.explode("bars").alias("b")).select("capture", "contract", "b.*"),
        "curve": whole("curve"),
        "dividends": whole("dividends"),
        "expiry_inputs": whole("expiry_inputs"),
    }


def nested_at(probes: DataFrame, captures: DataFrame, parts: dict[str, tuple[DataFrame, Sequence[str]]], probe_key: Sequence[str], at: tuple[str, str, str], policy: str = COMPLETED_DATE) -> DataFrame:
    """For each probe (underlying and a cutoff of its own) the last capture known then, and of it what was known of each part.

    parts: name to (rows with capture and availability, the fields of an entry).
    Adds capture (null where none was known) and a sorted array for each part.
    """
    chosen = as_of_each(probes, captures.select("underlying", "capture", *AVAILABLE), CAPTURE_SPEC, probe_key, at, policy, active=False).withColumn("capture", F.col("version.capture")).drop("version")
    cut = Temporal(*[F.col(c) for c in at])
    known = {}
    for name, (rows, fields) in parts.items():
        met = chosen.select(*probe_key, "capture", *at).join(rows.select("capture", *AVAILABLE, F.struct(*fields).alias("_entry")), "capture")
        known[name] = (met.filter(pit_visible(Temporal(*[F.col(a) for a in AVAILABLE]), cut, policy)).select(*probe_key, "_entry.*"), fields)
    return nest(chosen, probe_key, known)


def flat_surface(captures: DataFrame, contracts: DataFrame, surface: DataFrame, contract_fields: Sequence[str], surface_fields: Sequence[str]) -> DataFrame:
    """A row for each surface row with its capture's and its contract's columns; one not_available row for a capture without any."""
    held = surface.select("capture", "contract", *surface_fields, *[F.col(a).alias(f"_{a}") for a in AVAILABLE])
    met = captures.join(held, "capture", "left").join(contracts.select("capture", "contract", *contract_fields), ["capture", "contract"], "left")
    none = F.col("contract").isNull() & F.col("surface_state").isNull()
    own = {"surface_state": F.when(none, "not_available").otherwise(F.col("surface_state")), "missing_reason": F.when(none, "no_selected_surface_rows").otherwise(F.col("missing_reason"))}
    heads = {f"capture_{a}": F.col(a) for a in AVAILABLE} | {a: F.when(none, F.col(a)).otherwise(F.col(f"_{a}")) for a in AVAILABLE}
    return met.withColumns(own | heads).drop(*[f"_{a}" for a in AVAILABLE])
