"""Joins: dated identifiers, covering intervals, alignment of series, composition of components."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.temporal import effective_on

#: A dimension is broadcast only if it was counted and has at most so many rows.
BROADCAST_ROWS = 100_000


def join_dimension(rows: DataFrame, dimension: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """An equi-join whose dimension side is broadcast only after a count."""
    small = dimension.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return rows.join(F.broadcast(dimension) if small else dimension, list(on), how)


#: Dates are cut into bins of 1, 8, 64, … days from the year 1 on.
RADIX, LEVELS = 8, 8
_FIRST_DAY, _DAYS = 719_162, RADIX**LEVELS
#: A symbol with more intervals than this is looked up by bins; of others each interval is compared.
HOT = 256
#: Length of the slices, in days, in which the ends of a bin's intervals are counted.
SLICE_DAYS = 366


def day_number(day: Column) -> Column:
    return (F.unix_date(day) + _FIRST_DAY).cast("long")


def bins_of_interval(first: Column, last: Column) -> Column:
    """Rows of (level, bin): the fewest bins that make up the days from first to last (null: open)."""
    a, b = day_number(first), F.coalesce(day_number(last), F.lit(_DAYS - 1)) + 1

    def at_level(k: int) -> Column:
        width = RADIX**k
        lo, hi = F.floor((a + width - 1) / width), F.floor(b / width)
        # bins that a larger one doesn't take in
        left = F.least(F.floor((lo + RADIX - 1) / RADIX) * RADIX, hi)
        right = F.greatest(F.floor(hi / RADIX) * RADIX, left)
        run = lambda x, y: F.when(x < y, F.sequence(x, F.greatest(y - 1, x))).otherwise(F.array().cast("array<bigint>"))
        return F.when(lo < hi, F.transform(F.concat(run(lo, left), run(right, hi)), lambda n: F.struct(F.lit(k).alias("level"), n.cast("long").alias("bin")))).otherwise(F.array().cast("array<struct<level:int,bin:bigint>>"))

    return F.flatten(F.array(*[at_level(k) for k in range(LEVELS)]))


def bins_of_day(day: Column) -> Column:
    """Rows of (level, bin): the one bin of each level that holds a day."""
    return F.array(*[F.struct(F.lit(k).alias("level"), F.floor(day_number(day) / RADIX**k).cast("long").alias("bin")) for k in range(LEVELS)])


def placed(rows: DataFrame, bins: Column, *columns: str) -> DataFrame:
    return rows.select(*columns, F.explode(bins).alias("_b")).select(*columns, "_b.level", "_b.bin")


def by_heat(left: DataFrame, right: DataFrame, symbol: str, hot: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """left and right of symbols that right has at most hot rows of, and of the others."""
    many = right.groupBy(F.col(symbol).alias("_many")).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot).select("_many")
    part = lambda df, how: df.join(many, df[symbol] == many["_many"], how)
    return part(left, "left_anti"), part(right, "left_anti"), part(left, "left_semi"), part(right, "left_semi")


def resolve(probes: DataFrame, intervals: DataFrame, symbol: str, day: str, probe_key: Sequence[str], target: str, hot: int = HOT) -> DataFrame:
    """Each probe with the one target whose interval holds its symbol on its day.

    status is resolved, ambiguous (several; the target is null) or unknown. A
    symbol's few intervals are compared with its probes. Of a hot symbol they are
    spread to a few bins of days each, which are summed up (how many, and
    which), and a probe looks up one bin of each level: an equi-join with one row
    on a side, so that many intervals and probes are neither a product nor one
    hot key.
    """
    proper = intervals.filter(F.col("valid_through").isNull() | (F.col("valid_from") <= F.col("valid_through")))
    few_probes, few, probes_, held = by_heat(probes, proper, symbol, hot)
    few = few.select(F.col(symbol).alias("_symbol"), "valid_from", "valid_through", F.col(target).alias("_target"))
    compared = few_probes.join(few, (few_probes[symbol] == few["_symbol"]) & effective_on(few["valid_from"], few["valid_through"], few_probes[day]), "left").select(*probe_key, F.col("_target").isNotNull().cast("long").alias("_n"), "_target")
    nodes = placed(held, bins_of_interval(F.col("valid_from"), F.col("valid_through")), symbol, target).groupBy(F.col(symbol).alias("_symbol"), "level", "bin").agg(F.count(target).alias("_n"), F.min(target).alias("_target"))
    asked = placed(probes_, bins_of_day(F.col(day)), *dict.fromkeys([*probe_key, symbol]))
    looked = asked.join(nodes, (asked[symbol] == nodes["_symbol"]) & (asked["level"] == nodes["level"]) & (asked["bin"] == nodes["bin"]), "left").select(*probe_key, F.coalesce("_n", F.lit(0)).alias("_n"), "_target")
    found = compared.unionByName(looked).groupBy(*probe_key).agg(F.sum("_n").alias("n"), F.min("_target").alias("_target"))
    status = F.when(F.col("n") == 0, "unknown").when(F.col("n") == 1, "resolved").otherwise("ambiguous")
    return found.select(*probe_key, status.alias("status"), F.when(F.col("n") == 1, F.col("_target")).alias(target))


def covering(inner: DataFrame, outer: DataFrame, symbol: str, inner_key: Sequence[str], hot: int = HOT) -> DataFrame:
    """For each inner interval (valid_from, valid_through) how many outer intervals of its symbol contain it whole.

    A symbol's few intervals are compared. Of a hot symbol, the outer intervals that hold the inner one's first day are in its bins; of
    a bin's, those that end no earlier are a running count along the ends. The
    ends are cut into slices that start with the count of those after them, so
    no symbol, and no bin, is one group.
    """
    ends = lambda c: F.coalesce(day_number(F.col(c)), day_number(F.lit("9999-12-31").cast("date")))
    proper = outer.filter(F.col("valid_through").isNull() | (F.col("valid_from") <= F.col("valid_through"))).select(symbol, "valid_from", "valid_through")
    few_inner, few, inner_, hot_outer = by_heat(inner, proper, symbol, hot)
    few = few.select(F.col(symbol).alias("_symbol"), F.col("valid_from").alias("_from"), ends("valid_through").alias("_last"))
    whole = (few_inner[symbol] == few["_symbol"]) & (few["_from"] <= few_inner["valid_from"]) & (few["_last"] >= ends("valid_through"))
    compared = few_inner.join(few, whole, "left").select(*inner_key, F.col("_symbol").isNotNull().cast("long").alias("_n"))
    held = hot_outer.select(F.col(symbol).alias("_symbol"), "valid_from", "valid_through", ends("valid_through").alias("_end"))
    outs = placed(held, bins_of_interval(F.col("valid_from"), F.col("valid_through")), "_symbol", "_end")
    rows = inner_.select(*inner_key, F.col(symbol).alias("_symbol"), "valid_from", ends("valid_through").alias("_end"))
    ins = placed(rows, bins_of_day(F.col("valid_from")), *inner_key, "_symbol", "_end")
    node, piece = ["_symbol", "level", "bin"], F.floor(F.col("_end") / SLICE_DAYS).cast("long").alias("_slice")
    outs, ins = outs.select("*", piece), ins.select("*", piece)
    counts = outs.groupBy(*node, "_slice").agg(F.count(F.lit(1)).alias("_n")).unionByName(ins.select(*node, "_slice").distinct().withColumn("_n", F.lit(0).cast("long"))).groupBy(*node, "_slice").agg(F.sum("_n").alias("_n"))
    later = Window.partitionBy(*node).orderBy(F.col("_slice").desc()).rowsBetween(Window.unboundedPreceding, -1)
    carried = counts.select(*node, "_slice", F.sum("_n").over(later).alias("_weight")).filter("_weight > 0")
    key = F.struct(*inner_key)
    none = F.lit(None).cast(ins.select(key.alias("k")).schema["k"].dataType).alias("_key")
    stream = (
        outs.select(*node, "_slice", "_end", F.lit(1).cast("long").alias("_weight"), none)
        .unionByName(carried.select(*node, "_slice", F.lit(None).cast("long").alias("_end"), "_weight", none))
        .unionByName(ins.select(*node, "_slice", "_end", F.lit(0).cast("long").alias("_weight"), key.alias("_key")))
    )
    down = Window.partitionBy(*node, "_slice").orderBy(F.col("_end").desc_nulls_first(), F.col("_weight").desc()).rowsBetween(Window.unboundedPreceding, 0)
    found = stream.withColumn("_n", F.sum("_weight").over(down)).filter("_key IS NOT NULL").select("_key.*", F.coalesce("_n", F.lit(0)).alias("_n"))
    return compared.unionByName(found).groupBy(*inner_key).agg(F.sum("_n").alias("covering"))


def overlaps(intervals: DataFrame, key: Sequence[str]) -> DataFrame:
    """Intervals that begin before an earlier one of their key has ended; sorted once, not compared in pairs."""
    earlier = Window.partitionBy(*key).orderBy("valid_from", "valid_through").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.max(F.coalesce("valid_through", F.lit("9999-12-31").cast("date"))).over(earlier)
    return intervals.withColumn("_reach", reach).filter(F.col("_reach") >= F.col("valid_from")).drop("_reach")


def align(series: DataFrame, ids: Sequence[str], how: str = "inner", value: str = "value", period: Sequence[str] = ("period_start", "period_end")) -> DataFrame:
    """A row for each period with a column for each series; one aggregation however many series there are.

    inner keeps the periods that all have a row in; outer keeps all, and adds
    for each series a <id>_missing reason: absent_from_series where it has no row.
    """
    present = [F.max(F.when(F.col("series_id") == i, F.lit(1))).alias(f"_has_{i}") for i in ids]
    values = [F.max(F.when(F.col("series_id") == i, F.col(value))).alias(i) for i in ids]
    wide = series.filter(F.col("series_id").isin(*ids)).groupBy(*period).agg(*values, *present)
    if how == "inner":
        every = sum((F.coalesce(F.col(f"`_has_{i}`"), F.lit(0)) for i in ids), F.lit(0))
        return wide.filter(every == len(ids)).select(*period, *[F.col(f"`{i}`") for i in ids])
    reasons = [F.when(F.col(f"`_has_{i}`").isNull(), F.lit("absent_from_series")).when(F.col(f"`{i}`").isNull(), F.lit("missing")).alias(f"{i}_missing") for i in ids]
    return wide.select(*period, *[F.col(f"`{i}`") for i in ids], *reasons)


def compose(components: dict[str, DataFrame], identity: Sequence[str]) -> DataFrame:
    """Components joined on a stable identity: one row each, what it has of which component, and which are missing.

    A component with several rows of one identity is a conflict there. One
    aggregation over the tagged union stands for all the outer joins.
    """
    tagged = None
    for name, rows in components.items():
        one = rows.select(*identity, F.lit(name).alias("_name"))
        tagged = one if tagged is None else tagged.unionByName(one)
    names = F.array(*[F.lit(n) for n in sorted(components)])
    per = tagged.groupBy(*identity, "_name").agg(F.count(F.lit(1)).alias("_n"))
    return per.groupBy(*identity).agg(
        F.array_sort(F.collect_set("_name")).alias("datasets"),
        F.array_sort(F.array_except(names, F.collect_set("_name"))).alias("missing_datasets"),
        (F.max("_n") > 1).alias("conflict"),
    )


def bridge(filings: DataFrame, members: DataFrame, on: Sequence[str]) -> DataFrame:
    """Filings with every issuer that they belong to, once each."""
    return filings.join(members, list(on)).distinct()
