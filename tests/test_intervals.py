"""Dated lookups by bins of days against every pair."""

import datetime
import random
import time

import pytest
from pyspark.sql import functions as F

from tidemark.operators import joins

DAY = datetime.date


def intervals(spark, rows):
    return spark.createDataFrame(rows, "symbol string, target string, valid_from date, valid_through date")


def some(n, rng, span=900):
    start = DAY(2019, 12, 20)
    out = []
    for i in range(n):
        a = start + datetime.timedelta(rng.randrange(span))
        out.append((rng.choice("ABC"), f"t{i}", a, rng.choice([None, a, a + datetime.timedelta(rng.randrange(span)), a - datetime.timedelta(3)])))
    return out


@pytest.mark.parametrize(("n", "hot"), [(3, 0), (60, 0), (60, 18), (60, 256)])
def test_resolve_and_covering_equal_every_pair(spark, n, hot):
    rng = random.Random(n)
    held = some(n, rng) + [("A", "old", DAY(1, 1, 1), DAY(2020, 1, 1)), ("B", "far", DAY(2020, 5, 1), DAY(9999, 12, 31))]
    probes = [(i, rng.choice("ABCD"), DAY(2019, 12, 1) + datetime.timedelta(rng.randrange(1000))) for i in range(150)]
    inside = lambda h, d: h[2] <= d and (h[3] is None or h[3] >= d)
    want = {}
    for i, s, d in probes:
        met = [h[1] for h in held if h[0] == s and inside(h, d)]
        want[i] = ("unknown" if not met else "resolved" if len(met) == 1 else "ambiguous", met[0] if len(met) == 1 else None)
    got = joins.resolve(spark.createDataFrame(probes, "id int, symbol string, d date"), intervals(spark, held), "symbol", "d", ["id"], "target", hot).collect()
    assert {r.id: (r.status, r.target) for r in got} == want
    inner = [(i, s, d, rng.choice([None, d, d + datetime.timedelta(rng.randrange(300))])) for i, s, d in probes]
    whole = lambda h, a, b: inside(h, a) and (h[3] or DAY(9999, 12, 31)) >= (b or DAY(9999, 12, 31))
    got = joins.covering(spark.createDataFrame(inner, "id int, symbol string, valid_from date, valid_through date"), intervals(spark, held), "symbol", ["id"], hot).collect()
    assert {r.id: r.covering for r in got} == {i: sum(h[0] == s and whole(h, a, b) for h in held) for i, s, a, b in inner}


def test_bins_make_up_an_interval(spark):
    rng = random.Random(1)
    rows = [(i, DAY(2020, 1, 1) + datetime.timedelta(rng.randrange(4000)), rng.randrange(3000)) for i in range(80)]
    df = spark.createDataFrame([(i, a, a + datetime.timedelta(n)) for i, a, n in rows], "i int, a date, b date")
    for r in df.select("*", joins.bins_of_interval(F.col("a"), F.col("b")).alias("bins"), joins.day_number(F.col("a")).alias("lo"), joins.day_number(F.col("b")).alias("hi")).collect():
        days = [d for b in r.bins for d in range(b.bin * 8**b.level, (b.bin + 1) * 8**b.level)]
        assert sorted(days) == list(range(r.lo, r.hi + 1)) and len(r.bins) <= 14 * joins.LEVELS


def test_one_symbol_with_many_intervals_and_probes_is_no_product(spark):
    """100,000 overlapping intervals and probes of one symbol: some 10^10 pairs, each counted, none made."""
    n = 100_000
    day = F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") % 5000).cast("int"))
    held = spark.range(n).select(F.lit("hot").alias("symbol"), F.col("id").alias("target"), day.alias("valid_from"), F.date_add(day, 2000).alias("valid_through"))
    probes = spark.range(n).select("id", F.lit("hot").alias("symbol"), day.alias("d"))
    began = time.time()
    got = joins.resolve(probes, held, "symbol", "d", ["id"], "target").groupBy("status").count().collect()
    assert {r.status: r["count"] for r in got} == {"ambiguous": n}
    inner = probes.select("id", "symbol", F.col("d").alias("valid_from"), F.date_add("d", 1000).alias("valid_through"))
    out = joins.covering(inner, held, "symbol", ["id"])
    total = out.agg(F.sum("covering")).first()[0]
    # an interval that starts s days before a day covers it and the 1000 after it if 0 <= s <= 1000
    assert total == sum(20 * 20 * (min(d, 1000) + 1) for d in range(5000))
    assert time.time() - began < 120
