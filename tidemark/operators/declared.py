"""Analyses over series, prices, ledgers and option contracts, each a plan over whole tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.series import by_period


def surprises(events: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """actual - consensus, and that over the deviation of the key's strictly earlier surprises."""
    prior = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = events.withColumn("surprise", F.col("actual") - F.col("consensus"))
    return out.withColumn("standardized", F.try_divide(F.col("surprise"), F.nullif(F.stddev_samp("surprise").over(prior), F.lit(0.0))))


def revisions(trail: DataFrame, key: Sequence[str]) -> DataFrame:
    """Latest against first release: bias, mean absolute and root mean square revision, directions and changes of sign."""
    d = F.col("latest_value") - F.col("first_value")
    return trail.groupBy(*key).agg(
        F.count(d).alias("n"), F.avg(d).alias("bias"), F.avg(F.abs(d)).alias("mae"), F.sqrt(F.avg(d * d)).alias("rmse"),
        F.count_if(d > 0).alias("up"), F.count_if(d < 0).alias("down"), F.count_if(d == 0).alias("unchanged"),
        F.count_if(F.signum("latest_value") != F.signum("first_value")).alias("sign_changes"),
    )


def in_intervals(rows: DataFrame, intervals: DataFrame, day: Column, start: str, end: str, flag: str) -> DataFrame:
    """rows with a flag whether the day's month lies in an interval of months; intervals are spread to months, so it is an equi-join."""
    months = intervals.select(F.explode(F.sequence(F.col(start), F.col(end), F.expr("INTERVAL 1 MONTH"))).alias("_month")).distinct().withColumn("_in", F.lit(True))
    return rows.withColumn("_month", F.trunc(day, "month")).join(months, "_month", "left").withColumn(flag, F.coalesce("_in", F.lit(False))).drop("_month", "_in")


def exact_change(rows: DataFrame, key: Sequence[str], day: str, value: str, days: int) -> DataFrame:
    """Change of a value against exactly so many days before; nothing is filled."""
    before = rows.select(*key, F.date_add(day, days).alias(day), F.col(value).alias("_before"))
    return rows.join(before, [*key, day], "left").select(*key, day, value, (F.col(value) - F.col("_before")).alias("change"))


#: Tenors of the measures of a curve.
CURVE_TENORS = ("3m", "2y", "5y", "10y", "30y")


def curve_spreads(points: DataFrame, key: Sequence[str], tenors: Sequence[str] = CURVE_TENORS) -> DataFrame:
    """10y-2y, 10y-3m, 30y-5y, the 2s5s10s butterfly and the 2s10s30s curvature; tenors are the names of 3m, 2y, 5y, 10y and 30y.

    A missing point leaves its measures null; nothing is interpolated.
    """
    wide = points.groupBy(*key).agg(*[F.max(F.when(F.col("tenor") == t, F.col("rate"))).alias(f"_{i}") for i, t in enumerate(tenors)])
    m3, y2, y5, y10, y30 = (F.col(f"_{i}") for i in range(5))
    return wide.select(
        *key, (y10 - y2).alias("slope_10y_2y"), (y10 - m3).alias("slope_10y_3m"), (y30 - y5).alias("slope_30y_5y"), (2 * y5 - y2 - y10).alias("butterfly_2s5s10s"), (2 * y10 - y2 - y30).alias("curvature_2s10s30s")
    )


def transforms(series: DataFrame, window: int = 5) -> DataFrame:
    """Differences, changes, index, drawdown, rolling and expanding statistics of every series."""
    w = by_period()
    v = F.col("value")
    back = F.lag("value").over(w)
    roll = w.rowsBetween(-(window - 1), 0)
    grow = w.rowsBetween(Window.unboundedPreceding, 0)
    full = F.count("value").over(roll) == window
    first = F.first("value", ignorenulls=True).over(grow)
    return series.select(
        "series_id", "period_start",
        (v - back).alias("difference"), (F.try_divide(v, back) - 1).alias("percent_change"), F.when((v > 0) & (back > 0), F.ln(F.try_divide(v, back))).alias("log_change"),
        (100 * F.try_divide(v, first)).alias("index_100"), (F.try_divide(v, F.max("value").over(grow)) - 1).alias("drawdown"),
        F.when(full, F.avg("value").over(roll)).alias("rolling_mean"), F.when(full, F.stddev_samp("value").over(roll)).alias("rolling_std"),
        F.when(full, F.try_divide(v - F.avg("value").over(roll), F.nullif(F.stddev_samp("value").over(roll), F.lit(0.0)))).alias("rolling_z"),
        F.try_divide(v - F.avg("value").over(grow), F.nullif(F.stddev_samp("value").over(grow), F.lit(0.0))).alias("expanding_z"),
    )


def calendar_change(series: DataFrame, months: int, annualize: bool = False) -> DataFrame:
    """Change against the period that starts exactly so many months before, if it is there."""
    before = series.select("series_id", F.add_months("period_start", months).alias("period_start"), F.col("value").alias("_before"))
    ratio = F.try_divide(F.col("value"), F.col("_before"))
    change = 100 * ((F.pow(ratio, 12 / months) if annualize else ratio) - 1)
    return series.join(before, ["series_id", "period_start"], "left").select("series_id", "period_start", change.alias("change"))


def describe_extended(series: DataFrame) -> DataFrame:
    """Deviation, quartiles, lag-1 autocorrelation and the count of outliers by median absolute deviation."""
    lagged = series.withColumn("_lag", F.lag("value").over(by_period()))
    both = F.col("value").isNotNull() & F.col("_lag").isNotNull()
    a, b = F.when(both, F.col("value")), F.when(both, F.col("_lag"))
    stats = lagged.groupBy("series_id").agg(
        F.stddev_samp("value").alias("std"), F.percentile("value", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("_q"),
        F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b)).alias("autocorrelation"),
    )
    centred = series.join(stats.select("series_id", F.col("_q")[1].alias("_median")), "series_id").withColumn("_d", F.abs(F.col("value") - F.col("_median")))
    mad = centred.groupBy("series_id").agg(F.percentile("_d", F.lit(0.5)).alias("mad"))
    outliers = centred.join(mad, "series_id").groupBy("series_id").agg(F.max("mad").alias("mad"), F.count_if(F.col("_d") > 3.5 * 1.4826 * F.col("mad")).alias("outliers"))
    return stats.join(outliers, "series_id").select("series_id", "std", F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"), F.col("_q")[2].alias("q3"), "autocorrelation", "mad", "outliers")


def lead_lag_pairs(series: DataFrame, a: str, b: str, lags: Sequence[int]) -> DataFrame:
    """x of series a at each observation with y of series b so many observations later, for all lags."""
    numbered = series.withColumn("_i", F.row_number().over(by_period()))
    x = numbered.filter(F.col("series_id") == a).select("_i", F.col("value").alias("x"), F.explode(F.array(*[F.lit(k) for k in lags])).alias("lag"))
    y = numbered.filter(F.col("series_id") == b).select(F.col("_i").alias("_j"), F.col("value").alias("y"))
    return x.join(y, F.col("_i") + F.col("lag") == F.col("_j")).select("lag", "x", "y")


def ranked(pairs: DataFrame, key: Sequence[str]) -> DataFrame:
    """Complete pairs with x and y as average ranks."""
    full = pairs.dropna(subset=["x", "y"])
    rank = lambda c: F.rank().over(Window.partitionBy(*key).orderBy(c)) + (F.count(F.lit(1)).over(Window.partitionBy(*key, c)) - 1) / 2
    return full.withColumns({"_x": rank("x"), "_y": rank("y")}).select(*key, F.col("_x").alias("x"), F.col("_y").alias("y"))


def resample_any(series: DataFrame, unit: str, how: str) -> DataFrame:
    """Aggregates by calendar unit, without a proof of coverage."""
    fn = {"first": F.min_by("value", "period_start"), "last": F.max_by("value", "period_start"), "mean": F.avg("value"), "sum": F.sum("value"), "min": F.min("value"), "max": F.max("value")}[how]
    return series.groupBy("series_id", F.trunc("period_start", unit).alias("period_start")).agg(fn.alias("value"))


def filled_forward(series: DataFrame, most: int) -> DataFrame:
    """Missing values take the last one of at most so many observations before."""
    return series.withColumn("value", F.last("value", ignorenulls=True).over(by_period().rowsBetween(-most, 0)))


def cross_section(returns: DataFrame, benchmark: str) -> DataFrame:
    """By date: each series' rank and return relative to the benchmark's, breadth and dispersion; dates of the benchmark only."""
    base = returns.filter(F.col("series_id") == benchmark).select("period_start", F.col("return").alias("_base"))
    others = returns.filter(F.col("series_id") != benchmark).join(base, "period_start")
    day = Window.partitionBy("period_start")
    return others.filter(F.col("return").isNotNull()).select(
        "series_id", "period_start", F.rank().over(day.orderBy(F.col("return").desc())).alias("rank"), (F.col("return") - F.col("_base")).alias("relative"),
        F.avg((F.col("return") > 0).cast("double")).over(day).alias("breadth"), F.stddev_samp("return").over(day).alias("dispersion"),
    )


def windowed_indicators(bars: DataFrame, n: int = 5) -> DataFrame:
    """Simple and weighted moving average and volume-weighted price of n bars, and the fix of volatility by the highest close."""
    w = Window.partitionBy("symbol").orderBy("trade_date")
    roll = w.rowsBetween(-(n - 1), 0)
    full = F.count("close").over(roll) == n
    typical = (F.col("high") + F.col("low") + F.col("close")) / 3
    weighted = sum((F.lag("close", k).over(w) * (n - k) for k in range(1, n)), F.col("close") * n) / (n * (n + 1) / 2)
    top = F.max("close").over(w.rowsBetween(-21, 0))
    return bars.select(
        "symbol", "trade_date", F.when(full, F.avg("close").over(roll)).alias("sma"), F.when(full, weighted).alias("wma"),
        F.when(full, F.try_divide(F.sum(typical * F.col("volume")).over(roll), F.sum("volume").over(roll).cast("double"))).alias("vwap"),
        (100 * F.try_divide(top - F.col("low"), top)).alias("vix_fix"),
    )


def recursive_indicators(bars: DataFrame, n: int = 14, fast: int = 12, slow: int = 26) -> DataFrame:
    """Last exponential averages, MACD and relative strength of every symbol, by folds over its bars in order."""
    rows = bars.groupBy("symbol").agg(F.array_sort(F.collect_list(F.struct("trade_date", F.col("close").cast("double").alias("close")))).alias("_bars"))
    closes = F.transform("_bars", lambda b: b["close"])
    ema = lambda k: F.aggregate(closes, F.lit(None).cast("double"), lambda acc, v: F.when(acc.isNull(), v).otherwise(acc + (v - acc) * (2.0 / (k + 1))))
    moves = F.transform(F.sequence(F.lit(2), F.size("_bars")), lambda i: F.element_at(closes, i) - F.element_at(closes, i - 1))
    smooth = lambda part: F.aggregate(moves, F.lit(None).cast("double"), lambda acc, v: F.when(acc.isNull(), part(v)).otherwise(acc + (part(v) - acc) / n))
    up, down = smooth(lambda v: F.greatest(v, F.lit(0.0))), smooth(lambda v: F.greatest(-v, F.lit(0.0)))
    out = rows.filter(F.size("_bars") >= 2).select("symbol", F.size("_bars").alias("bars"), ema(fast).alias("ema_fast"), ema(slow).alias("ema_slow"), up.alias("_up"), down.alias("_down"))
    return out.select("symbol", "bars", "ema_fast", "ema_slow", (F.col("ema_fast") - F.col("ema_slow")).alias("macd"), (100 * F.try_divide(F.col("_up"), F.col("_up") + F.col("_down"))).alias("rsi"))


def version_changes(ledger: DataFrame, key: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """Every version with its change from the one before."""
    return ledger.withColumn("change", F.col(value) - F.lag(value).over(Window.partitionBy(*key).orderBy(*order)))


def payoffs(legs: DataFrame, key: Sequence[str], grid: Sequence[float]) -> DataFrame:
    """Payoff at expiry of the legs of each strategy on a grid of spot prices: the legs times a fixed grid, summed."""
    spots = legs.withColumn("spot", F.explode(F.array(*[F.lit(float(g)) for g in grid])))
    call, put = F.greatest(F.col("spot") - F.col("strike"), F.lit(0.0)), F.greatest(F.col("strike") - F.col("spot"), F.lit(0.0))
    return spots.groupBy(*key, "spot").agg(F.sum(F.col("quantity") * (F.when(F.col("option_type") == "call", call).otherwise(put) - F.col("premium"))).alias("payoff"))


def signal_ic(rows: DataFrame, day: str, signal: str, outcome: str, buckets: int) -> DataFrame:
    """By date: rank correlation of signal and outcome, and the outcome's spread of the top over the bottom bucket."""
    full = rows.dropna(subset=[signal, outcome])
    w = Window.partitionBy(day)
    marked = full.withColumns({"_s": F.rank().over(w.orderBy(signal)), "_o": F.rank().over(w.orderBy(outcome)), "_b": F.ntile(buckets).over(w.orderBy(signal, "symbol"))})
    out = marked.groupBy(day).agg(F.count(F.lit(1)).alias("n"), F.covar_pop("_s", "_o").alias("_c"), F.stddev_pop("_s").alias("_x"), F.stddev_pop("_o").alias("_y"), F.avg(F.when(F.col("_b") == buckets, F.col(outcome))).alias("_top"), F.avg(F.when(F.col("_b") == 1, F.col(outcome))).alias("_bottom"))
    return out.select(day, "n", F.try_divide(F.col("_c"), F.col("_x") * F.col("_y")).alias("ic"), (F.col("_top") - F.col("_bottom")).alias("spread"))


def walk_forward(rows: DataFrame, position: str, folds: int, size: int, purge: int) -> DataFrame:
    """rows of each chronological fold's training and test part: test rows of the fold, training rows before them less the purge."""
    fold = F.explode(F.sequence(F.lit(1), F.lit(folds)))
    spread = rows.withColumn("fold", fold)
    start = F.col("fold") * size
    part = F.when((F.col(position) > start) & (F.col(position) <= start + size), "test").when(F.col(position) <= start - purge, "train")
    return spread.withColumn("part", part).filter("part IS NOT NULL")


def block_bootstrap(series: DataFrame, replicates: int, block: int, seed: str) -> DataFrame:
    """Means of circular-block resamples of every series, drawn by hash and so the same on every run."""
    numbered = series.filter("value IS NOT NULL").withColumn("_i", F.row_number().over(by_period()) - 1).withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("series_id")))
    sizes = numbered.groupBy("series_id").agg(F.max("_n").alias("_n"))
    blocks = sizes.withColumn("replicate", F.explode(F.sequence(F.lit(1), F.lit(replicates)))).withColumn("_b", F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / block).cast("int"))))
    draw = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), "series_id", "replicate", "_b").cast("binary")), 1, 8), 16, 10).cast("long")
    picks = blocks.withColumn("_start", F.pmod(draw, F.col("_n"))).withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(block - 1)))).filter(F.col("_b") * block + F.col("_k") < F.col("_n"))
    chosen = picks.withColumn("_i", F.pmod(F.col("_start") + F.col("_k"), F.col("_n"))).select("series_id", "replicate", "_i")
    return chosen.join(numbered.select("series_id", "_i", "value"), ["series_id", "_i"]).groupBy("series_id", "replicate").agg(F.avg("value").alias("mean"))


def slope_hac(pairs: DataFrame, key: Sequence[str], order: Sequence[str], lags: int) -> DataFrame:
    """Slope of y on x with its Newey-West standard error (Bartlett weights), one aggregation for the fit and one for the products."""
    full = pairs.dropna(subset=["x", "y"])
    fit = full.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("_mx"), F.avg("y").alias("_my"), F.covar_pop("x", "y").alias("_c"), F.var_pop("x").alias("_v"))
    fit = fit.filter("_v > 0").withColumn("slope", F.col("_c") / F.col("_v"))
    g = full.join(fit, list(key)).withColumn("_g", (F.col("x") - F.col("_mx")) * (F.col("y") - F.col("_my") - F.col("slope") * (F.col("x") - F.col("_mx"))))
    w = Window.partitionBy(*key).orderBy(*order)
    lagged = g.withColumns({f"_g{k}": F.lag("_g", k).over(w) for k in range(1, lags + 1)})
    total = sum((2 * (1 - k / (lags + 1)) * F.coalesce(F.sum(F.col("_g") * F.col(f"_g{k}")), F.lit(0.0)) for k in range(1, lags + 1)), F.sum(F.col("_g") * F.col("_g")))
    out = lagged.groupBy(*key).agg(F.max("n").alias("n"), F.max("slope").alias("slope"), total.alias("_s"), F.max("_v").alias("_v"))
    return out.select(*key, "n", "slope", (F.sqrt(F.greatest(F.col("_s"), F.lit(0.0))) / (F.col("n") * F.col("_v"))).alias("standard_error"))


def vix_fix(bars: DataFrame, n: int = 22, band: int = 20, deviations: float = 2.0, look_back: int = 50, high: float = 0.85, low: float = 1.01) -> DataFrame:
    """The fix of volatility by the highest close, its bands and the limits of its range; null until their windows are full."""
    w = Window.partitionBy("symbol").orderBy("trade_date")
    over = lambda k: w.rowsBetween(-(k - 1), 0)
    rows = F.row_number().over(w)
    top = F.max("close").over(over(n))
    fix = bars.select("symbol", "trade_date", rows.alias("_i"), F.when(rows >= n, 100 * F.try_divide(top - F.col("low"), top)).alias("vix_fix"))
    full = lambda k, c: F.when(F.col("_i") >= n + k - 1, c)
    mid, spread = F.avg("vix_fix").over(over(band)), deviations * F.stddev_pop("vix_fix").over(over(band))
    return fix.select(
        "symbol", "trade_date", "vix_fix", full(band, mid - spread).alias("lower_band"), full(band, mid + spread).alias("upper_band"),
        full(look_back, F.max("vix_fix").over(over(look_back)) * high).alias("range_high"), full(look_back, F.min("vix_fix").over(over(look_back)) * low).alias("range_low"),
    )


def _bucketed(rows: DataFrame, day: str, signal: str, outcome: str, buckets: int, symbol: str) -> DataFrame:
    full = rows.dropna(subset=[signal, outcome])
    return full.withColumn("bucket", F.ntile(buckets).over(Window.partitionBy(day).orderBy(signal, symbol)))


def signal_quantiles(rows: DataFrame, day: str, signal: str, outcome: str, buckets: int, symbol: str = "symbol") -> DataFrame:
    """By date and bucket of the signal, from low to high: how many, and their mean outcome."""
    return _bucketed(rows, day, signal, outcome, buckets, symbol).groupBy(day, "bucket").agg(F.count(F.lit(1)).alias("n"), F.avg(outcome).alias("mean_outcome"))


def signal_turnover(rows: DataFrame, day: str, signal: str, outcome: str, buckets: int, symbol: str = "symbol") -> DataFrame:
    """By date and bucket: the share of its members that weren't in it on the date before; null on the first date."""
    marked = _bucketed(rows, day, signal, outcome, buckets, symbol).select(day, symbol, "bucket")
    days = marked.select(day).distinct()
    after = days.withColumn("_before", F.lag(day).over(Window.orderBy(day)))  # over dates, a row each
    was = marked.select(F.col(day).alias("_before"), symbol, "bucket", F.lit(1).alias("_stayed"))
    met = marked.join(after, day).join(was, ["_before", symbol, "bucket"], "left")
    return met.groupBy(day, "bucket").agg(F.when(F.max("_before").isNotNull(), 1 - F.count("_stayed") / F.count(F.lit(1))).alias("turnover"))


def surface_by_expiry(surface: DataFrame, contracts: DataFrame) -> DataFrame:
    """Of every capture and expiration: present rows, and the range and mean of their implied volatility."""
    rows = surface.join(contracts.select("capture", "contract", "expiration").distinct(), ["capture", "contract"])
    here = F.col("surface_state") == "present"
    iv = F.when(here, F.col("implied_volatility"))
    return rows.groupBy("capture", "expiration").agg(F.count_if(here).alias("present"), F.min(iv).alias("iv_low"), F.max(iv).alias("iv_high"), F.avg(iv).alias("iv_mean"))


GREEKS = ("delta", "gamma", "theta", "vega", "rho")


def aggregate_greeks(legs: DataFrame, key: Sequence[str]) -> DataFrame:
    """The greeks of each strategy: its legs' times quantity and multiplier, null where a leg lacks one."""
    whole = lambda g: F.when(F.count(g) == F.count(F.lit(1)), F.sum(F.col("quantity") * F.col("multiplier") * F.col(g)))
    return legs.groupBy(*key).agg(F.count(F.lit(1)).alias("legs"), *[whole(g).alias(g) for g in GREEKS])
