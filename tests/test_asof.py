"""As-of reads with a cutoff for each row against the visibility rule, pair by pair."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions.temporal import CALENDAR_DATE_INCLUSIVE, COMPLETED_DATE, Temporal, parse_temporal, pit_visible
from tidemark.operators import asof, ledger

SPEC = ledger.LedgerSpec(key=("k",), rank=("seq",), state="state")


def stamped(df, raw, prefix):
    t = parse_temporal(F.col(raw))
    return df.withColumns({f"{prefix}_precision": t.precision, f"{prefix}_date": t.written_date, f"{prefix}_at": t.instant})


def moment(rng):
    day = f"2024-0{rng.randrange(1, 5)}-{rng.randrange(1, 29):02d}"
    zone = rng.choice(["Z", "+05:00", "-11:00", "+14:00"])
    return rng.choice([day, f"{day}T{rng.randrange(24):02d}:00:00{zone}", f"{day}T00:00:00{zone}"])


def rows(spark, n_versions, n_probes, keys):
    rng = random.Random(n_versions)
    versions = [(rng.choice(keys), i, rng.choice(["active"] * 4 + ["tombstone"]), rng.choice([moment(rng)] * 9 + ["soon"])) for i in range(n_versions)]
    probes = [(i, rng.choice([*keys, "absent"]), rng.choice([moment(rng)] * 9 + ["never", None])) for i in range(n_probes)]
    a = stamped(spark.createDataFrame(versions, "k string, seq int, state string, raw string"), "raw", "available")
    b = stamped(spark.createDataFrame(probes, "probe int, k string, cutoff string"), "cutoff", "cutoff")
    return a, b


def by_pairs(a, b, policy, active):
    at = Temporal(F.col("cutoff_precision"), F.col("cutoff_date"), F.col("cutoff_at"))
    met = b.join(a.withColumnRenamed("k", "k2"), F.col("k") == F.col("k2")).filter(pit_visible(SPEC.availability(), at, policy))
    best = met.groupBy("probe").agg(F.max(F.struct("seq", "state")).alias("v")).collect()
    return {r.probe: r.v.seq for r in best if not active or r.v.state == "active"}


@pytest.mark.parametrize("policy", [COMPLETED_DATE, CALENDAR_DATE_INCLUSIVE])
@pytest.mark.parametrize(("slice_days", "active"), [(1, True), (31, False), (4000, True)])
def test_equals_the_rule_pair_by_pair(spark, policy, slice_days, active):
    a, b = rows(spark, 160, 200, ["x", "y", "z"])
    got = asof.as_of_each(b, a, SPEC, ["probe"], ("cutoff_precision", "cutoff_date", "cutoff_at"), policy, active, slice_days).collect()
    assert len(got) == 200 and {r.probe: r.version.seq for r in got if r.version is not None} == by_pairs(a, b, policy, active)


def test_one_cutoff_for_all_is_the_ledger_select(spark):
    a, _ = rows(spark, 120, 1, ["x", "y", "z", "w"])
    at = "2024-03-05T13:00:00Z"
    probes = stamped(a.select("k").distinct().withColumn("cutoff", F.lit(at)), "cutoff", "cutoff")
    got = {r.k: r.version.seq for r in asof.as_of_each(probes, a, SPEC, ["k"], ("cutoff_precision", "cutoff_date", "cutoff_at")).collect() if r.version}
    assert got == {r.k: r.seq for r in ledger.ledger_select(a, SPEC, at).collect()}


def test_a_hot_key_is_many_groups(spark):
    """No group of the stream holds more than a slice of a key's versions and cutoffs."""
    n = 4000
    a = spark.range(n).select(F.lit("hot").alias("k"), F.col("id").alias("seq"), F.lit("active").alias("state"), F.date_format(F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("raw"))
    b = spark.range(n).select(F.col("id").alias("probe"), F.lit("hot").alias("k"), F.date_format(F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("cutoff"))
    out = asof.as_of_each(stamped(b, "cutoff", "cutoff"), stamped(a, "raw", "available"), SPEC, ["probe"], ("cutoff_precision", "cutoff_date", "cutoff_at"))
    assert out.filter("version.seq = probe").count() == n
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "slice" in plan and "CartesianProduct" not in plan


def test_empty_tables(spark):
    a, b = rows(spark, 10, 10, ["x"])
    at = ("cutoff_precision", "cutoff_date", "cutoff_at")
    assert [r.version for r in asof.as_of_each(b, a.limit(0), SPEC, ["probe"], at).collect()] == [None] * 10
    assert asof.as_of_each(b.limit(0), a, SPEC, ["probe"], at).collect() == []
