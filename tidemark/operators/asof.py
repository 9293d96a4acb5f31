"""As-of reads with a cutoff for each row: what was known of a key at many moments at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.temporal import CALENDAR_DATE_INCLUSIVE, COMPLETED_DATE, Temporal, pit_warning
from tidemark.operators.ledger import LedgerSpec

#: Length of a slice of time, in days; a key's versions and cutoffs of one slice are one group.
SLICE_DAYS = 31
_DAY = 86_400_000_000

# Times of different precision are compared in different ways, so there are three lanes, each with one order:
# all versions against cutoffs that are dates, by written date; versions known by date against instants, by
# written date; versions known by instant against instants.
_TO_DATES, _DATES_TO_INSTANTS, _INSTANTS = range(3)


def _lanes(pairs: Sequence[tuple[int, Column, Column]]) -> Column:
    """Rows of (lane, at) for the lanes whose condition holds."""
    rows = [F.when(F.coalesce(ok, F.lit(False)) & at.isNotNull(), F.struct(F.lit(lane).alias("lane"), at.alias("at"))) for lane, ok, at in pairs]
    return F.explode(F.array_compact(F.array(*rows)))


def _day(c: Column) -> Column:
    return F.unix_date(c).cast("long") * _DAY


def as_of_each(probes: DataFrame, ledger: DataFrame, spec: LedgerSpec, probe_key: Sequence[str], at: tuple[str, str, str], policy: str = COMPLETED_DATE, active: bool = True, slice_days: int = SLICE_DAYS) -> DataFrame:
    """For each probe the version of its key that is the last by rank of those visible at its own cutoff.

    probes has the ledger's key columns, probe_key (which tells its rows apart)
    and at, the precision, written date and instant of its cutoff. Adds version,
    a struct of the ledger's other columns, or null, and pit_warning. With
    active a version whose state is another hides its key.

    Versions and cutoffs of a key are one sorted stream along which the last
    version so far is carried; so neither is compared with all of the other. A
    key's stream is cut into slices of time, each of which starts with the best
    version of the slices before it (a running maximum over one row a slice), so
    that a hot key is many groups.
    """
    avail, cut = spec.availability(), Temporal(*[F.col(c) for c in at])
    others = [c for c in ledger.columns if c not in spec.key]
    entry = F.struct(F.struct(*[F.col(r) for r in spec.rank]).alias("rank"), F.struct(*others).alias("row"))
    by_date, by_instant = avail.precision == "date", avail.precision == "datetime"
    versions = ledger.select(
        *spec.key, _lanes([(_TO_DATES, by_date | by_instant, _day(avail.written_date)), (_DATES_TO_INSTANTS, by_date, _day(avail.written_date)), (_INSTANTS, by_instant, F.unix_micros(avail.instant))]).alias("place"), entry.alias("entry")
    )
    # a date is over when the next begins: then it comes before cutoffs of later days only
    strict = F.lit(0 if policy == CALENDAR_DATE_INCLUSIVE else 1)
    asked = probes.select(
        *spec.key,
        F.struct(*probe_key).alias("probe"),
        _lanes([(_TO_DATES, cut.precision == "date", _day(cut.written_date)), (_DATES_TO_INSTANTS, cut.precision == "datetime", _day(cut.written_date) - strict), (_INSTANTS, cut.precision == "datetime", F.unix_micros(cut.instant))]).alias("place"),
    )
    key, width = [*spec.key, "lane"], slice_days * _DAY
    placed = lambda df: df.select("*", "place.lane", "place.at", F.floor(F.col("place.at") / width).cast("long").alias("slice")).drop("place")
    versions, asked = placed(versions), placed(asked)
    none = F.lit(None).cast(versions.schema["entry"].dataType)
    best = versions.groupBy(*key, "slice").agg(F.max_by("entry", "entry.rank").alias("entry")).unionByName(asked.select(*key, "slice").distinct().withColumn("entry", none))
    one = best.groupBy(*key, "slice").agg(F.max_by("entry", "entry.rank").alias("entry"))
    before = Window.partitionBy(*key).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = one.select(*key, "slice", F.max_by("entry", "entry.rank").over(before).alias("entry")).filter("entry IS NOT NULL")
    no_probe = F.lit(None).cast(asked.schema["probe"].dataType).alias("probe")
    stream = (
        versions.select(*key, "slice", "at", F.lit(0).alias("kind"), "entry", no_probe)
        .unionByName(carried.select(*key, "slice", F.lit(None).cast("long").alias("at"), F.lit(0).alias("kind"), "entry", no_probe))
        .unionByName(asked.select(*key, "slice", "at", F.lit(1).alias("kind"), none.alias("entry"), "probe"))
    )
    so_far = Window.partitionBy(*key, "slice").orderBy(F.col("at").asc_nulls_first(), "kind").rowsBetween(Window.unboundedPreceding, 0)
    known = stream.withColumn("known", F.max_by("entry", "entry.rank").over(so_far)).filter("probe IS NOT NULL AND known IS NOT NULL")
    found = known.groupBy("probe").agg(F.max_by("known", "known.rank").alias("known")).select("probe.*", F.col("known.row").alias("version"))
    if active and spec.state:
        found = found.filter(F.col("version")[spec.state] == "active")
    out = probes.join(found, list(probe_key), "left")
    theirs = Temporal(*[F.col("version")[c] for c in spec.available])
    return out.withColumn("pit_warning", F.when(F.col("version").isNotNull(), pit_warning(theirs, cut, policy)))
