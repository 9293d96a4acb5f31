"""Issuers with their links, filings with their members, facts to metrics, link assertions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.temporal import COMPLETED_DATE, effective_on
from tidemark.operators.joins import resolve
from tidemark.operators.ledger import LedgerSpec, append_changes, ledger_select, visible
from tidemark.operators.nested import nest


def issuers_as_of(issuers: DataFrame, spec: LedgerSpec, links: DataFrame, link_spec: LedgerSpec, day: str, at: str | None, fields: Sequence[str], policy: str = COMPLETED_DATE) -> DataFrame:
    """The version of every issuer at a cutoff, with its links then that hold on a day, as a sorted array.

    A link's version is selected before its interval is asked, so a correction of the interval counts.
    """
    chosen = ledger_select(issuers, spec, at, policy).drop("pit_warning")
    held = ledger_select(links, link_spec, at, policy).filter(effective_on(F.col("valid_from"), F.col("valid_through"), F.lit(day).cast("date")))
    return nest(chosen, spec.key, {"links": (held.select(*spec.key, *fields), fields)})


def filings_as_of(filings: DataFrame, members: DataFrame, at: str, accession: str = "accession", issuer: str = "issuer", policy: str = COMPLETED_DATE) -> DataFrame:
    """A row for each filing that is visible at the cutoff and each issuer that it belongs to, once."""
    seen = visible(filings, LedgerSpec(key=(accession,), rank=(accession,)), at, policy).drop("pit_warning")
    return seen.join(members.select(accession, issuer).distinct(), accession)


def derive_metrics(facts: DataFrame, mapping: DataFrame, on: Sequence[str], metric: str, key: Sequence[str], order: Sequence[str], value: str) -> tuple[DataFrame, DataFrame]:
    """Versions of metrics from raw facts by the active mapping, and the facts that no mapping names (with on).

    A metric's key is key and metric; a version is a fact whose value differs
    from the one before it in order. A mapping that names several metrics for
    the same on gives each its versions.
    """
    active = mapping.filter("active").select(*on, metric).distinct()
    mapped = facts.join(active, list(on))
    versions = append_changes(mapped, LedgerSpec(key=(*key, metric), rank=tuple(order), payload=(value,)), order)
    return versions, facts.join(active, list(on), "left_anti")


def assert_links(assertions: DataFrame, securities: DataFrame, symbol: str, day: str, key: Sequence[str], target: str, subject: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Versions of dated assertions that exactly one security's interval covers, and the others with their status.

    key tells assertions apart; subject is what an assertion is about, whose
    versions are those that name another target than the one before.
    """
    found = resolve(assertions, securities, symbol, day, key, target)
    marked = assertions.join(found, list(key))
    good = marked.filter("status = 'resolved'").drop("status")
    return append_changes(good, LedgerSpec(key=tuple(subject), rank=tuple(order), payload=(target,)), order), marked.filter("status <> 'resolved'").select(*key, "status")


def setup_at(parts: dict[str, tuple[DataFrame, LedgerSpec, str]], key: Sequence[str], at: str, policy: str = COMPLETED_DATE) -> DataFrame:
    """For each key (such as issuer and period) the value of every part that was known at one cutoff; null where none was.

    parts: name to (ledger, its spec, value column); a spec's key may go beyond
    key, then the last by rank of the keys' current versions counts. A visible
    tombstone leaves nothing. One union and one aggregation join the parts.
    """
    tagged = None
    for name, (ledger, spec, value) in parts.items():
        chosen = ledger_select(ledger, spec, at, policy)
        one = chosen.groupBy(*key).agg(F.max_by(F.col(value).cast("double"), F.struct(*spec.rank)).alias("_value")).select(*key, F.lit(name).alias("_part"), "_value")
        tagged = one if tagged is None else tagged.unionByName(one)
    return tagged.groupBy(*key).agg(*[F.max(F.when(F.col("_part") == name, F.col("_value"))).alias(name) for name in parts])
