"""Version ledgers: selection of versions, and building ledgers from snapshots.

A ledger is append-only; every row is one version of a natural key. A later
version supersedes the one before it, and a tombstone hides its key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import fields_text
from tidemark.functions.temporal import COMPLETED_DATE, Temporal, cutoff, effective_on, latest_written_date, pit_visible, pit_warning

OMITTED = "source_omitted_from_complete_authoritative_snapshot"


@dataclass(frozen=True)
class LedgerSpec:
    """Which columns of a ledger name a key, rank its versions, are compared, and tell its state."""

    key: tuple[str, ...]
    rank: tuple[str, ...]
    payload: tuple[str, ...] = ()
    state: str | None = None
    available: tuple[str, str, str] = ("available_precision", "available_date", "available_at")

    def availability(self) -> Temporal:
        return Temporal(*[F.col(c) for c in self.available])


def visible(ledger: DataFrame, spec: LedgerSpec, at: str | None, policy: str = COMPLETED_DATE) -> DataFrame:
    """The versions that are available at the cutoff (all without one), with pit_warning.

    The bound on the written date repeats what visibility implies for dates, in
    a form that reaches the Parquet scan.
    """
    if at is None:
        return ledger.withColumn("pit_warning", F.lit(None).cast("string"))
    moment = cutoff(at)
    near = F.col(spec.available[1]) <= F.lit(latest_written_date(at)).cast("date")
    return ledger.filter(near & pit_visible(spec.availability(), moment, policy)).withColumn("pit_warning", pit_warning(spec.availability(), moment, policy))


def top_version(rows: DataFrame, spec: LedgerSpec, first: bool = False) -> DataFrame:
    """One row for each key: its last (or first) version. One shuffle on the key, after a partial aggregation."""
    others = [c for c in rows.columns if c not in spec.key]
    pick = F.min_by if first else F.max_by
    best = rows.groupBy(*spec.key).agg(pick(F.struct(*others), F.struct(*spec.rank)).alias("_best"))
    return best.select(*spec.key, "_best.*").select(*rows.columns)


def active_only(rows: DataFrame, spec: LedgerSpec) -> DataFrame:
    """Applied after the selection, so that a visible tombstone hides its key."""
    return rows.filter(F.col(spec.state) == "active") if spec.state else rows


def ledger_select(ledger: DataFrame, spec: LedgerSpec, at: str | None = None, policy: str = COMPLETED_DATE, active: bool = True) -> DataFrame:
    """Latest (no cutoff) or as-of version of every key."""
    chosen = top_version(visible(ledger, spec, at, policy), spec)
    return active_only(chosen, spec) if active else chosen


def first_release(ledger: DataFrame, spec: LedgerSpec, flag: str, at: str | None = None) -> DataFrame:
    """The first version of every key that carries the flag; later corrections don't redefine it."""
    return top_version(visible(ledger, spec, at).filter(F.col(flag)), spec, first=True)


def vintage_trail(ledger: DataFrame, spec: LedgerSpec, value: str, flag: str, at: str) -> DataFrame:
    """First release, as-of and latest value of every key side by side, in one pass over the ledger."""
    seen = F.coalesce(pit_visible(spec.availability(), cutoff(at)), F.lit(False))
    rank = F.struct(*spec.rank)
    return ledger.groupBy(*spec.key).agg(
        F.min_by(F.when(F.col(flag), F.col(value)), F.when(F.col(flag), rank)).alias("first_value"),
        F.max_by(F.when(seen, F.col(value)), F.when(seen, rank)).alias("as_of_value"),
        F.max_by(value, rank).alias("latest_value"),
    )


def replay_gate(batches: DataFrame, log: DataFrame, identity: Sequence[str]) -> DataFrame:
    """The batches whose identity hasn't succeeded before, each once: the least of its rows, so that reruns agree."""
    return least_of_each(batches, identity).join(log.select(*identity).distinct(), list(identity), "left_anti")


def least_of_each(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row for each key, the least in the order of the other columns."""
    others = [c for c in rows.columns if c not in key]
    if not others:
        return rows.distinct()
    return rows.groupBy(*key).agg(F.min(F.struct(*others)).alias("_least")).select(*key, "_least.*").select(*rows.columns)


def available_from(rows: DataFrame, instant: str) -> DataFrame:
    """rows that are available from an instant of their own, whatever availability they had: a curve from its capture, a calendar event from its time."""
    at = F.col(instant)
    return rows.withColumns({"available_precision": F.when(at.isNotNull(), "datetime").otherwise("unknown"), "available_date": at.cast("date"), "available_at": at})


def append_curve(observed: DataFrame, order: Sequence[str]) -> DataFrame:
    """Versions of curve points, for each provider, date, variant and tenor: value, reason and state are compared, and a point is available from its capture."""
    spec = LedgerSpec(key=("provider", "curve_date", "variant", "tenor"), rank=tuple(order), payload=("value", "reason", "state"))
    return available_from(append_changes(observed, spec, order), "captured_at")


def append_calendar(observed: DataFrame, order: Sequence[str]) -> DataFrame:
    """Versions of calendar events: actual, consensus, previous and unit are compared, and a version is available from the event's time."""
    spec = LedgerSpec(key=("event",), rank=tuple(order), payload=("actual", "consensus", "previous", "unit"))
    return available_from(append_changes(observed, spec, order), "event_at")


def append_actions(observed: DataFrame, order: Sequence[str]) -> DataFrame:
    """Versions of corporate actions, for each event and provider.

    A dividend's payload is its cash amount and currency, a split's the two
    numbers of its ratio; the fields of the other kind are null and not compared.
    """
    dividend = F.col("kind") == "dividend"
    own = {c: F.when(dividend, F.col(c)) for c in ("cash_amount", "currency")} | {c: F.when(~dividend, F.col(c)) for c in ("split_from", "split_to")}
    spec = LedgerSpec(key=("event", "provider"), rank=tuple(order), payload=("kind", *own, "state"))
    return append_changes(observed.withColumns(own), spec, order)


def append_expectations(observed: DataFrame, family: str, order: Sequence[str]) -> DataFrame:
    """Versions of what is expected of issuers: consensus of a metric and period, an earnings event, or guidance for a period."""
    key, payload = {
        "consensus": (("issuer", "metric", "period"), ("value", "analysts", "unit", "state")),
        "earnings_event": (("issuer", "event"), ("event_date", "session", "status", "state")),
        "guidance": (("issuer", "metric", "target"), ("low", "high", "unit", "state")),
    }[family]
    return append_changes(observed, LedgerSpec(key=key, rank=tuple(order), payload=payload), order)


def append_corrections(observed: DataFrame, key: Sequence[str], order: Sequence[str], alike: Sequence[str]) -> DataFrame:
    """The observations that differ from the current version in every column of alike; equality in one of them is no change.

    Since such a likeness isn't transitive, each is compared with the version
    that is current then, not with the observation before it. A partition's
    keys are read as a sorted stream of texts of keys and compared columns (nulls
    are alike, and a key of their own); only the current version is held, and
    the observation's own columns pass as they are.
    """

    def kept(batches):
        current = None
        for part in batches:
            flags = []
            for k, *v in zip(*[part.column(n).to_pylist() for n in compared]):
                same = current is not None and current[0] == k and any(a == b for a, b in zip(current[1], v))
                flags.append(not same)
                if not same:
                    current = (k, v)
            yield part.filter(pa.array(flags, pa.bool_())).select(observed_columns)

    likes = {f"_like_{i}": fields_text(F.col(c)) for i, c in enumerate(alike)}
    observed_columns, compared = observed.columns, ["_key", *likes]
    rows = observed.withColumns({"_key": fields_text(*[F.col(k) for k in key]), **likes}).repartition("_key").sortWithinPartitions("_key", *order)
    return number_versions(rows.mapInArrow(kept, observed.schema), key, order)


def append_changes(observed: DataFrame, spec: LedgerSpec, order: Sequence[str]) -> DataFrame:
    """The versions that a sequence of observations gives: rows whose payload differs from the one before.

    Adds sequence (from 1) and supersedes, the sequence before it or null.
    """
    by_order = Window.partitionBy(*spec.key).orderBy(*order)
    payload = F.struct(*spec.payload)
    changed = observed.withColumn("_same", F.lag(payload).over(by_order).eqNullSafe(payload) & (F.row_number().over(by_order) > 1)).filter(~F.col("_same")).drop("_same")
    return number_versions(changed, spec.key, order)


def number_versions(versions: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """versions with sequence and supersedes."""
    sequence = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return versions.withColumn("sequence", sequence).withColumn("supersedes", F.when(F.col("sequence") > 1, F.col("sequence") - 1))


def changes_against(current: DataFrame, observed: DataFrame, spec: LedgerSpec) -> DataFrame:
    """Of one batch, the rows that are new or differ from the current version, with the next sequence."""
    kept = current.select(*spec.key, F.struct(*spec.payload).alias("_was"), F.col("sequence").alias("supersedes"))
    joined = observed.join(kept, list(spec.key), "left")
    return joined.filter(F.col("supersedes").isNull() | ~F.col("_was").eqNullSafe(F.struct(*spec.payload))).drop("_was").withColumn("sequence", F.coalesce("supersedes", F.lit(0)) + 1)


def tombstone_omissions(current: DataFrame, snapshot: DataFrame, key: Sequence[str], scope: DataFrame, scope_key: Sequence[str], complete: str) -> DataFrame:
    """A tombstone for each active key that a complete snapshot omits; complete names the column of scope that tells which snapshots are, others omit nothing."""
    whole = scope.groupBy(*scope_key).agg(F.bool_and(F.coalesce(complete, F.lit(False))).alias("_whole")).filter("_whole")
    active = current.filter("state = 'active'").join(whole, list(scope_key), "left_semi")
    gone = active.join(snapshot.select(*key).distinct(), list(key), "left_anti")
    return gone.select(*key, F.lit("tombstone").alias("state"), F.lit(OMITTED).alias("state_reason"), (F.col("sequence") + 1).alias("sequence"), F.col("sequence").alias("supersedes"))


def apply_universe(current: DataFrame, snapshot: DataFrame, complete: bool) -> DataFrame:
    """What a snapshot of a universe's members does to each (universe, member).

    Both have universe, member, valid_from, valid_through; current has state too.
    """
    now = current.select("universe", "member", F.col("state").alias("_state"), F.col("valid_from").alias("_from"), F.col("valid_through").alias("_through"))
    new = snapshot.select("universe", "member", "valid_from", "valid_through", F.lit(True).alias("_seen"))
    same = F.col("valid_from").eqNullSafe(F.col("_from")) & F.col("valid_through").eqNullSafe(F.col("_through"))
    action = (
        F.when(F.col("_seen").isNull() & (F.col("_state") == "active"), F.lit("tombstone" if complete else "unchanged"))
        .when(F.col("_seen").isNull(), F.lit("unchanged"))
        .when(F.col("_state").isNull(), F.lit("active"))
        .when(F.col("_state") == "tombstone", F.lit("restored"))
        .when(same, F.lit("membership"))
        .otherwise(F.lit("conflict"))
    )
    keep_bounds = F.col("_seen").isNull()
    bounds = [F.when(keep_bounds, F.col(f"_{x}")).otherwise(F.col(f"valid_{x}")).alias(f"valid_{x}") for x in ("from", "through")]
    return now.join(new, ["universe", "member"], "full_outer").select("universe", "member", action.alias("action"), *bounds)


def first_seen(dimension: DataFrame, rows: DataFrame, key: Sequence[str], immutable: Sequence[str]) -> DataFrame:
    """For each key of rows: 'new', 'known' or 'conflict', the last if an immutable column differs from the dimension's."""
    own = least_of_each(rows, [*key, *immutable])
    known = dimension.select(*key, F.struct(*immutable).alias("_known"))
    status = F.when(F.col("_known").isNull(), "new").when(F.col("_known").eqNullSafe(F.struct(*immutable)), "known").otherwise("conflict")
    return own.join(known, list(key), "left").withColumn("status", status).drop("_known")


def supersession_faults(ledger: DataFrame, key: Sequence[str], sequence: str, version: str, supersedes: str) -> DataFrame:
    """Versions whose sequence isn't contiguous from 1, or that don't supersede the version before them."""
    chain = Window.partitionBy(*key).orderBy(sequence)
    return (
        ledger.withColumns({"_n": F.row_number().over(chain), "_before": F.lag(version).over(chain)})
        .withColumn("rule", F.when(F.col(sequence) != F.col("_n"), "sequence_gap").when(~F.col(supersedes).eqNullSafe(F.col("_before")), "wrong_supersedes"))
        .filter("rule IS NOT NULL")
        .drop("_n", "_before")
    )


def effective_members(memberships: DataFrame, spec: LedgerSpec, day: str, at: str) -> DataFrame:
    """Members effective on a day and visible at a cutoff; a visible tombstone hides its member."""
    on = memberships.filter(effective_on(F.col("valid_from"), F.col("valid_through"), F.lit(day).cast("date")))
    return ledger_select(on, spec, at)


def effective_value(intervals: DataFrame, spec: LedgerSpec, subject: Sequence[str], day: str, at: str, values: Sequence[str]) -> DataFrame:
    """The value that holds for each subject on a day: the highest correction of its one interval, or a conflict of several."""
    on = intervals.filter(effective_on(F.col("valid_from"), F.col("valid_through"), F.lit(day).cast("date")))
    chosen = top_version(visible(on, spec, at), spec)
    one = chosen.groupBy(*subject).agg(F.count(F.lit(1)).alias("intervals"), *[F.max(v).alias(v) for v in values])
    return one.select(*subject, "intervals", F.when(F.col("intervals") > 1, "conflict").otherwise("resolved").alias("status"), *[F.when(F.col("intervals") == 1, F.col(v)).alias(v) for v in values])
