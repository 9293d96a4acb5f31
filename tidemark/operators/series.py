"""Series: description, resampling, returns, regressions, events; a long table of many series at once."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.scalars import log_ratio, simple_ratio
from tidemark.functions.temporal import bucket_end, bucket_start

PERIOD = ("period_start", "period_end")


def by_period(*key: str):
    return Window.partitionBy(*(key or ("series_id",))).orderBy(*PERIOD)


def describe(series: DataFrame, key: Sequence[str] = ("series_id",)) -> DataFrame:
    """Counts, range, mean and sample variance of each series, with a status."""
    out = series.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n"), F.count("value").alias("nonmissing"), F.count_if(F.col("value").isNull()).alias("missing"),
        F.min("value").alias("min"), F.max("value").alias("max"), F.avg("value").alias("mean"), F.var_samp("value").alias("variance"),
        F.min("period_start").alias("first_period"), F.max("period_end").alias("last_period"),
    )
    return out.withColumn("warning", F.when(F.col("nonmissing") == 0, "all_missing").when(F.col("nonmissing") < 2, "insufficient_observations"))


#: From fine to coarse.
FREQUENCIES = ("daily", "weekly", "monthly", "quarterly", "annual")


def resample(series: DataFrame, source: str, target: str, how: str) -> DataFrame:
    """Daily, weekly, monthly or quarterly values as monthly, quarterly or annual ones.

    A finer target is refused; the same frequency gives the series as it is.
    A bucket has a value only if its observations are proven to cover it and
    none is missing; the proof is an aggregate (valid rows, their number, their
    distinct starts), so no bucket's rows are collected.
    """
    if FREQUENCIES.index(target) < FREQUENCIES.index(source):
        raise ValueError(f"{source} values can't be made {target}: no value is known at the finer frequency")
    if target == source:
        return series.select("series_id", *PERIOD, "value", F.when(F.col("value").isNull(), "missing").alias("missing_reason"))
    start, end = bucket_start(F.col("period_start"), target), bucket_end(F.col("period_start"), target)
    placed = series.withColumns({"_start": start, "_end": end})
    days = F.datediff("_end", "_start") + 1
    if source == "daily":
        valid, expected = F.col("period_start") == F.col("period_end"), days
    elif source == "weekly":
        valid = (F.pmod(F.datediff("period_start", "_start"), F.lit(7)) == 0) & (F.col("period_end") == F.least(F.date_add("period_start", 6), "_end"))
        expected = F.ceil(days / 7)
    else:
        whole = {"monthly": 1, "quarterly": 3}[source]
        valid = (F.col("period_start") == bucket_start(F.col("period_start"), source)) & (F.col("period_end") == bucket_end(F.col("period_start"), source)) & (F.col("period_end") <= F.col("_end"))
        expected = F.round(F.months_between(F.date_add("_end", 1), "_start") / whole)
    value = {"mean": F.avg("value"), "sum": F.sum("value"), "last": F.max_by("value", F.struct(*PERIOD))}[how]
    agg = placed.groupBy("series_id", F.col("_start").alias("period_start"), F.col("_end").alias("period_end")).agg(
        value.alias("_value"), F.bool_and(valid & F.col("value").isNotNull()).alias("_valid"), F.count(F.lit(1)).alias("_n"), F.count_distinct("period_start").alias("_distinct"), F.max(expected).cast("long").alias("_expected")
    )
    proven = F.col("_valid") & (F.col("_n") == F.col("_expected")) & (F.col("_distinct") == F.col("_expected"))
    return agg.select("series_id", *PERIOD, F.when(proven, F.col("_value")).alias("value"), F.when(~proven, "resample_incomplete_bucket").alias("missing_reason"))


def returns(series: DataFrame, horizon: int, log: bool = False, forward: bool = False, key: Sequence[str] = ("series_id",)) -> DataFrame:
    """Return over a number of observations back (or ahead), with the reason where there is none."""
    w = by_period(*key)
    step = F.lead if forward else F.lag
    other, there = step("value", horizon).over(w), step(F.lit(1), horizon).over(w)
    base, later = (F.col("value"), other) if forward else (other, F.col("value"))
    reason = (
        F.when(there.isNull(), "insufficient_forward_horizon" if forward else "insufficient_history")
        .when(F.col("value").isNull() | other.isNull(), "return_input_missing")
        .when(base == 0, "zero_return_base")
    )
    if log:
        reason = reason.when((base < 0) | (later <= 0), "nonpositive_log_return_input")
    return series.select(*key, *PERIOD, F.when(reason.isNull(), log_ratio(later, base) if log else simple_ratio(later, base)).alias("return"), reason.alias("missing_reason"))


def rolling_regression(pairs: DataFrame, n: int, key: Sequence[str], order: Sequence[str], y: str = "y", x: str = "x") -> DataFrame:
    """Least squares of y on x over each window of n rows, N - n + 1 estimates for N rows.

    A window is of rows as they come; those that lack a value are left out
    inside it, so that an estimate may rest on fewer, or have none: status tells.
    """
    w = Window.partitionBy(*key).orderBy(*order).rowsBetween(-(n - 1), 0)
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    out = pairs.withColumns({"_x": F.when(both, F.col(x)), "_y": F.when(both, F.col(y))})
    out = out.withColumns({"_rows": F.count(F.lit(1)).over(w), "sample_size": F.count("_x").over(w), "_cov": F.covar_pop("_y", "_x").over(w), "_var": F.var_pop("_x").over(w), "_my": F.avg("_y").over(w), "_mx": F.avg("_x").over(w)})
    status = F.when(F.col("sample_size") <= 2, "insufficient_degrees_of_freedom").when(F.col("_var") == 0, "singular_design").otherwise("established")
    slope = F.when(status == "established", F.try_divide("_cov", "_var"))
    out = out.filter(F.col("_rows") == n).withColumns({"status": status, "slope": slope})
    return out.select(*key, *order, "sample_size", "status", "slope", (F.col("_my") - F.col("slope") * F.col("_mx")).alias("intercept"))


def first_differences(series: DataFrame) -> DataFrame:
    """Mean and sample variance of first differences; not established where a value is missing or fewer than three are there."""
    d = series.withColumn("_d", F.col("value") - F.lag("value").over(by_period()))
    out = d.groupBy("series_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("value").isNull()).alias("_missing"), F.avg("_d").alias("_mean"), F.var_samp("_d").alias("_var"))
    status = F.when(F.col("_missing") > 0, "missing_values").when(F.col("n") < 3, "insufficient_observations").otherwise("established")
    ok = status == "established"
    return out.select("series_id", "n", status.alias("status"), F.when(ok, F.col("_mean")).alias("difference_mean"), F.when(ok, F.col("_var")).alias("difference_variance"))


def event_study(returns_: DataFrame, events: DataFrame, before: int, after: int) -> DataFrame:
    """Cumulative return from before to after each event's observation, in numbered observations."""
    numbered = returns_.withColumn("_i", F.row_number().over(by_period())).withColumn("_last", F.count(F.lit(1)).over(Window.partitionBy("series_id")))
    marked = events.join(numbered.select("series_id", "period_start", F.col("_i").alias("_at"), "_last"), ["series_id", "period_start"])
    around = marked.withColumn("_i", F.explode(F.sequence(F.col("_at") - before, F.col("_at") + after)))
    joined = around.join(numbered.select("series_id", "_i", "return"), ["series_id", "_i"], "left")
    out = joined.groupBy("series_id", "period_start", "_at", "_last").agg(F.sum(F.when(F.col("return") > -1, F.log1p("return"))).alias("_log"), F.count("return").alias("_n"), F.min("return").alias("_min"))
    reason = F.when((F.col("_at") - before < 1) | (F.col("_at") + after > F.col("_last")), "event_window_out_of_sample").when(F.col("_n") < before + after + 1, "event_return_missing").when(F.col("_min") <= -1, "event_return_total_loss")
    return out.select("series_id", "period_start", F.when(reason.isNull(), F.expm1("_log")).alias("cumulative_return"), reason.alias("missing_reason"))


def order_faults(series: DataFrame) -> DataFrame:
    """Rows whose period isn't after the one before it in order of arrival."""
    w = Window.partitionBy("series_id").orderBy("arrival")
    return series.filter("TRUE").withColumn("_before", F.lag(F.struct(*PERIOD)).over(w)).filter(F.col("_before") >= F.struct(*PERIOD)).drop("_before")


def correlation(pairs: DataFrame, key: Sequence[str], x: str = "x", y: str = "y") -> DataFrame:
    """Pearson's correlation over complete pairs; not established below two pairs or without variance."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    cx, cy = F.when(both, F.col(x)), F.when(both, F.col(y))
    out = pairs.groupBy(*key).agg(F.count_if(both).alias("pairs"), F.count_if(~both).alias("excluded"), F.covar_pop(cx, cy).alias("_c"), F.stddev_pop(cx).alias("_x"), F.stddev_pop(cy).alias("_y"))
    value = F.when(F.col("pairs") >= 2, F.try_divide(F.col("_c"), F.col("_x") * F.col("_y")))
    return out.select(*key, "pairs", "excluded", value.alias("correlation"), F.when(value.isNull(), "not_established").otherwise("established").alias("status"))


def ols(rows: DataFrame, key: Sequence[str], y: str, xs: Sequence[str], intercept: bool = True) -> DataFrame:
    """Least squares for each group, over complete rows; coefficients begin with the intercept, if there is one.

    One aggregation gives each group's means and centred products; only those
    few numbers of each group go to a solve of the normal equations. R squared
    is over the centred target, with or without intercept; a constant target
    has none, and a warning.
    """
    complete = rows.dropna(subset=[y, *xs])
    names = [y, *xs]
    products = [F.covar_pop(a, b).alias(f"c_{i}_{j}") for i, a in enumerate(names) for j, b in enumerate(names) if j >= i]
    sums = complete.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), *[F.avg(a).alias(f"m_{i}") for i, a in enumerate(names)], *products)
    p = len(xs)

    def solve(batches):
        for part in batches:
            out = []
            for r in part.drop_columns(list(key)).to_pylist():
                c = np.array([[r[f"c_{min(i, j)}_{max(i, j)}"] for j in range(p + 1)] for i in range(p + 1)], float)
                m = np.array([r[f"m_{i}"] for i in range(p + 1)], float)
                gram = c if intercept else c + np.outer(m, m)
                status, warning, beta, rss, r2 = "established", None, None, None, None
                if r["n"] <= p + int(intercept):
                    status = "insufficient_degrees_of_freedom"
                elif np.linalg.cond(gram[1:, 1:]) > 1e12:
                    status = "singular_design"
                else:
                    beta = np.linalg.solve(gram[1:, 1:], gram[1:, 0])
                    rss = max(0.0, float(r["n"] * (gram[0, 0] - beta @ gram[1:, 0])))
                    tss = r["n"] * c[0, 0]
                    warning, r2 = ("constant_target", None) if tss == 0 else (None, 1 - rss / tss)
                    beta = [m[0] - float(beta @ m[1:])] * int(intercept) + beta.tolist()
                out.append({"n": r["n"], "status": status, "warning": warning, "coefficients": beta, "rss": rss, "r_squared": r2})
            solved = pa.Table.from_pylist(out, pa.schema([("n", pa.int64()), ("status", pa.string()), ("warning", pa.string()), ("coefficients", pa.list_(pa.float64())), ("rss", pa.float64()), ("r_squared", pa.float64())])).to_batches()
            if solved:  # key columns go through untouched
                yield pa.RecordBatch.from_arrays([*[part.column(k) for k in key], *solved[0].columns], names=[*key, *solved[0].schema.names])

    schema = StructType([*sums.select(*key).schema.fields, *StructType.fromDDL("n long, status string, warning string, coefficients array<double>, rss double, r_squared double").fields])
    return sums.mapInArrow(solve, schema)


def forecast_errors(rows: DataFrame, key: Sequence[str], actual: str = "actual", prediction: str = "prediction") -> DataFrame:
    """Mean error, mean absolute error and root mean square error over complete pairs; not established below two."""
    e = F.col(prediction) - F.col(actual)
    out = rows.groupBy(*key).agg(F.count(e).alias("pairs"), F.avg(e).alias("_me"), F.avg(F.abs(e)).alias("_mae"), F.sqrt(F.avg(e * e)).alias("_rmse"))
    ok = F.col("pairs") >= 2
    return out.select(*key, "pairs", *[F.when(ok, F.col(f"_{m}")).alias(m) for m in ("me", "mae", "rmse")], F.when(ok, "established").otherwise("not_established").alias("status"))


def adjusted_p(tests: DataFrame, family: Sequence[str], p: str = "p", tie: Sequence[str] = (), method: str = "bh") -> DataFrame:
    """Adjusted p-values in each family by bh, by, holm or bonferroni; nulls are left out, ties have positions of their own."""
    known = tests.filter(F.col(p).isNotNull())
    up = Window.partitionBy(*family).orderBy(p, *tie)
    known = known.withColumns({"position": F.row_number().over(up), "_n": F.count(F.lit(1)).over(Window.partitionBy(*family))})
    if method == "bonferroni":
        return known.withColumn("adjusted", F.least(F.lit(1.0), F.col(p) * F.col("_n"))).drop("_n")
    if method == "holm":
        step = F.max(F.col(p) * (F.col("_n") - F.col("position") + 1)).over(up.rowsBetween(Window.unboundedPreceding, 0))
        return known.withColumn("adjusted", F.least(F.lit(1.0), step)).drop("_n")
    harmonic = F.lit(1.0)
    if method == "by":  # the positions are 1 to _n
        known, harmonic = known.withColumn("_harmonic", F.sum(F.lit(1.0) / F.col("position")).over(Window.partitionBy(*family))), F.col("_harmonic")
    down = Window.partitionBy(*family).orderBy(F.col("position").desc()).rowsBetween(Window.unboundedPreceding, 0)
    return known.withColumn("adjusted", F.least(F.lit(1.0), F.min(F.col(p) * F.col("_n") * harmonic / F.col("position")).over(down))).drop("_n", "_harmonic")


def derived_availability(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """When a derived point is available: the latest of its contributors.

    All dates give a date, all instants an instant, a mixture the latest date,
    and any unknown contributor an unknown.
    """
    kinds = F.collect_set("available_precision")
    out = rows.groupBy(*key).agg(kinds.alias("_k"), F.max("available_date").alias("_d"), F.max("available_at").alias("_t"))
    known = ~F.exists("_k", lambda k: ~k.isin("date", "datetime"))
    precision = F.when(~known, "unknown").when(F.array_contains("_k", "date"), "date").otherwise("datetime")
    return out.select(*key, precision.alias("available_precision"), F.when(known, F.col("_d")).alias("available_date"), F.when(precision == "datetime", F.col("_t")).alias("available_at"))


def lineage_with_flags(rows: DataFrame, key: Sequence[str], parts: Sequence[Column], flags: str, markers: Sequence[str]) -> DataFrame:
    """lineage, with the union of the contributors' quality flags (arrays) and the markers of what was done to them."""
    out = rows.groupBy(*key).agg(F.array_sort(F.collect_set(F.concat_ws("/", *parts))).alias("lineage"), F.array_sort(F.array_distinct(F.flatten(F.collect_set(flags)))).alias("quality_flags"))
    return out.withColumn("transformations", F.array(*[F.lit(m) for m in markers]).cast("array<string>"))


def lineage(rows: DataFrame, key: Sequence[str], parts: Sequence[Column]) -> DataFrame:
    """The distinct contributors of each derived point, sorted."""
    return rows.groupBy(*key).agg(F.array_sort(F.collect_set(F.concat_ws("/", *parts))).alias("lineage"))
