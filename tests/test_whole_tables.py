"""Queries that read all rows of their tables."""

from pyspark.sql import functions as F

from tidemark.plans import bindings as B
from tidemark.plans import catalogue, ledgers


def test_dimension_joins_every_line(spark, tiny):
    lines, part = B.read(spark, tiny, "lineitem"), B.read(spark, tiny, "part")
    want = lines.join(part, lines.l_partkey == part.p_partkey, "left_semi")
    for name in ("C1_join_dimension_inner", "C1_join_dimension_inner_all"):
        assert catalogue.QUERIES[name](spark, tiny).count() == want.count() > 0


def test_weekly_append_has_every_series_and_week(spark, tiny):
    got = {(r.series_id, r.period): r.versions for r in catalogue.QUERIES["L9_weekly_fundamental_append"](spark, tiny).collect()}
    by_hand, last = {}, {}
    for r in ledgers.observed(spark, tiny).withColumn("week", F.trunc("known_on", "week")).orderBy("known_on", "key", "seq").collect():
        key = (r.metric, r.week)
        before = last.get(key)
        if before is None or (r.band != before[0] and r.state != before[1]):
            by_hand[key] = by_hand.get(key, 0) + 1
        last[key] = (r.band, r.state)
    assert got == by_hand


def test_accessions_of_seven_digit_orders(spark, tmp_path):
    spark.createDataFrame([(2, 1), (3, 1), (1000002, 1), (1000003, 2), (250000000, 3)], "o_orderkey long, o_custkey long").write.parquet(str(tmp_path / "orders.parquet"))
    row = catalogue.QUERIES["F8_accession_format"](spark, str(tmp_path)).first()
    assert (row.n, row.valid) == (5, 3)


def test_bars_of_events_without_value_keep_the_price_rules(spark, tmp_path):
    rows = [(1, 7, "2024-01-01 00:00:00", 0.0), (2, 7, "2024-01-02 00:00:00", 3.5), *[(3 + i, 8, "2024-01-02 00:00:00", 0.0) for i in range(6)]]
    events = spark.createDataFrame(rows, "event_id long, user_id long, ts string, value double").withColumn("ts", F.col("ts").cast("timestamp"))
    events.write.parquet(str(tmp_path / "events.parquet"))
    got = {tuple(r) for r in catalogue.QUERIES["S9_bar_array_faults"](spark, str(tmp_path)).collect()}
    assert got == {(8, "prices")}  # the bar of six events has a high below its low
