"""Canonical inputs made from the driver's tables, as DataFrames and as SQL of the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(column: str):
    return F.col(column).cast("decimal(18,2)")


#: One version for each line of an order, in a total order; even lines are known by date, odd ones by instant.
OBS = """obs AS (SELECT l_orderkey AS key, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) AS seq,
  CAST(l_extendedprice AS DOUBLE) AS value, l_partkey AS partkey, l_suppkey AS suppkey, l_linenumber AS line, l_quantity AS quantity,
  CASE WHEN l_linenumber % 2 = 0 THEN 'date' ELSE 'datetime' END AS available_precision, CAST(l_shipdate AS DATE) AS available_date,
  CAST(l_shipdate AS TIMESTAMP) + CAST(l_partkey % 24 AS INTEGER) * INTERVAL 1 HOUR AS available_at, CASE WHEN l_returnflag = 'R' THEN 'tombstone' ELSE 'active' END AS state, l_linenumber <= 3 AS is_first FROM lineitem)"""


def obs_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions of orders: key, seq, value, availability, state."""
    order = Window.partitionBy("l_orderkey").orderBy("l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")
    return read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("key"),
        F.row_number().over(order).alias("seq"),
        F.col("l_extendedprice").alias("value"),
        F.col("l_partkey").alias("partkey"),
        F.col("l_suppkey").alias("suppkey"),
        F.col("l_linenumber").alias("line"),
        F.col("l_quantity").alias("quantity"),
        F.when(F.col("l_linenumber") % 2 == 0, "date").otherwise("datetime").alias("available_precision"),
        F.col("l_shipdate").cast("date").alias("available_date"),
        (F.col("l_shipdate").cast("timestamp") + F.make_interval(hours=(F.col("l_partkey") % 24).cast("int"))).alias("available_at"),
        F.when(F.col("l_returnflag") == "R", "tombstone").otherwise("active").alias("state"),
        (F.col("l_linenumber") <= 3).alias("is_first"),
    )


#: Daily sums of event values by type; some are missing.
SERIES = """summed AS (SELECT event_type AS series_id, CAST(ts AS DATE) AS period_start, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS raw FROM events GROUP BY 1, 2),
series AS (SELECT series_id, period_start, period_start AS period_end, CASE WHEN day(period_start) % 10 = length(series_id) THEN NULL ELSE raw END AS value FROM summed)"""


def event_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five series of thirty days: series_id, period_start, period_end, value."""
    daily = read(spark, sf_dir, "events").groupBy(F.col("event_type").alias("series_id"), F.col("ts").cast("date").alias("period_start")).agg(F.sum(money("value")).cast("double").alias("raw"))
    value = F.when(F.dayofmonth("period_start") % 10 != F.length("series_id"), F.col("raw"))
    return daily.select("series_id", "period_start", F.col("period_start").alias("period_end"), value.alias("value"))


#: Daily order totals as one series, and one for each priority.
ORDER_SERIES = """orders_daily AS (SELECT series_id, CAST(o_orderdate AS DATE) AS period_start, CAST(o_orderdate AS DATE) AS period_end, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value
  FROM (SELECT 'ALL' AS series_id, o_orderdate, o_totalprice FROM orders UNION ALL SELECT o_orderpriority, o_orderdate, o_totalprice FROM orders) u GROUP BY 1, 2, 3)"""


def order_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order totals by day: the series ALL and one for each priority."""
    orders = read(spark, sf_dir, "orders")
    each = orders.select(F.explode(F.array(F.lit("ALL"), "o_orderpriority")).alias("series_id"), F.col("o_orderdate").cast("date").alias("period_start"), "o_totalprice")
    return each.groupBy("series_id", "period_start").agg(F.sum(money("o_totalprice")).cast("double").alias("value")).select("series_id", "period_start", F.col("period_start").alias("period_end"), "value")


#: Dated intervals of customers' priorities: each holds from an order to the day before the next.
INTERVALS = """marked AS (SELECT o_custkey AS symbol, CAST(o_orderdate AS DATE) AS valid_from, min(o_orderkey) AS target, min(o_orderpriority) AS priority FROM orders GROUP BY 1, 2),
intervals AS (SELECT symbol, target, priority, valid_from, CAST(lead(valid_from) OVER (PARTITION BY symbol ORDER BY valid_from) - INTERVAL 1 DAY AS DATE) AS valid_through FROM marked)"""


def intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """symbol, target, priority, valid_from, valid_through (null: open)."""
    marked = read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("symbol"), F.col("o_orderdate").cast("date").alias("valid_from")).agg(F.min("o_orderkey").alias("target"), F.min("o_orderpriority").alias("priority"))
    return marked.withColumn("valid_through", F.date_sub(F.lead("valid_from").over(Window.partitionBy("symbol").orderBy("valid_from")), 1))


#: Bars of users' event values by day.
BARS = """bars AS (SELECT user_id AS symbol, CAST(ts AS DATE) AS trade_date, arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low, arg_max(value, (ts, event_id)) AS close, count(*) AS volume FROM events GROUP BY 1, 2)"""


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """symbol, trade_date, open, high, low, close, volume."""
    at = F.struct("ts", "event_id")
    return read(spark, sf_dir, "events").groupBy(F.col("user_id").alias("symbol"), F.col("ts").cast("date").alias("trade_date")).agg(
        F.min_by("value", at).alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", at).alias("close"), F.count(F.lit(1)).alias("volume")
    )


#: Members of universes: customers by order priority, a snapshot for each month.
MEMBERS = """members AS (SELECT DISTINCT o_orderpriority AS universe, CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot, o_custkey AS member FROM orders)"""


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """universe, snapshot (month), member."""
    return read(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("universe"), F.trunc(F.col("o_orderdate").cast("date"), "month").alias("snapshot"), F.col("o_custkey").alias("member")).distinct()


#: News: a conversation is an item, a turn a version; the last version retracts if the assistant has it.
NEWS = """news AS (SELECT c.conv_id AS item, c.turn AS version, c.role AS lane, c.text AS body, CASE WHEN c.role = 'assistant' AND c.turn = m.last AND c.conv_id % 3 = 0 THEN 'retracted' ELSE 'active' END AS state, 'datetime' AS available_precision,
  CAST(TIMESTAMP '2024-01-01' + CAST(c.turn AS INTEGER) * INTERVAL 1 DAY AS DATE) AS available_date, TIMESTAMP '2024-01-01' + CAST(c.turn AS INTEGER) * INTERVAL 1 DAY AS available_at
  FROM conversations c JOIN (SELECT conv_id, max(turn) AS last FROM conversations GROUP BY 1) m USING (conv_id))"""


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """item, version, lane, body, state and availability."""
    turns = read(spark, sf_dir, "conversations").withColumn("last", F.max("turn").over(Window.partitionBy("conv_id")))
    at = F.lit("2024-01-01").cast("timestamp") + F.make_interval(days=F.col("turn").cast("int"))
    retracted = (F.col("role") == "assistant") & (F.col("turn") == F.col("last")) & (F.col("conv_id") % 3 == 0)
    return turns.select(F.col("conv_id").alias("item"), F.col("turn").alias("version"), F.col("role").alias("lane"), F.col("text").alias("body"), F.when(retracted, "retracted").otherwise("active").alias("state"), F.lit("datetime").alias("available_precision"), at.cast("date").alias("available_date"), at.alias("available_at"))
