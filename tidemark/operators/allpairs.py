"""Correlations of all pairs of series as a blocked product of matrices.

Cells are dealt to blocks of series and of periods; a task has two blocks of
series over one block of periods, and gives the sums of all their pairs from
products of its two matrices. A cell goes to as many tasks as there are blocks
of series, whatever the number of periods or series; no join makes a row for
each pair and period.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Blocks of series and of periods.
SERIES_BLOCKS, PERIOD_BLOCKS = 4, 8
_SUMS = ("present", "n", "sx", "sy", "sxx", "syy", "sxy")


def all_correlations(series: DataFrame, period: str = "period_start", value: str = "value", series_blocks: int = SERIES_BLOCKS, period_blocks: int = PERIOD_BLOCKS) -> DataFrame:
    """a, b, pairs, excluded, correlation and status of every two series (a < b) with a common period.

    series has series_id (a string), a period and a value; one row of each. pairs
    counts the periods where both have a value, excluded those where both have a
    row but not both a value. Values are taken from their series' mean, so that
    sums of products don't lose their digits.
    """
    means = series.groupBy("series_id").agg(F.avg(value).alias("_mean"))
    cells = series.join(means, "series_id").select(
        "series_id", F.col(period).cast("string").alias("period"), (F.col(value) - F.col("_mean")).cast("double").alias("v"),
        F.pmod(F.xxhash64("series_id"), F.lit(series_blocks)).cast("int").alias("own"), F.pmod(F.xxhash64(period), F.lit(period_blocks)).cast("int").alias("p"),
    )
    other = F.explode(F.array(*[F.lit(i) for i in range(series_blocks)])).alias("other")
    dealt = cells.select("*", other).withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})
    schema = pa.schema([("a", pa.string()), ("b", pa.string()), *[(s, pa.float64()) for s in _SUMS]])

    def products(group: pa.Table) -> pa.Table:
        ids, at = np.unique(group["series_id"].to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
        periods, when = np.unique(group["period"].to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
        own = np.zeros(len(ids), int)
        own[at] = group["own"].to_numpy()
        v = group["v"].to_numpy(zero_copy_only=False).astype(float)
        there, known, x = (np.zeros((len(periods), len(ids))) for _ in range(3))
        there[when, at] = 1
        known[when, at] = ~np.isnan(v)
        x[when, at] = np.nan_to_num(v)
        i, j = group["i"][0].as_py(), group["j"][0].as_py()
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        t = lambda m, n: m[:, left].T @ n[:, right]
        sums = [t(there, there), t(known, known), t(x, known), t(known, x), t(x * x, known), t(known, x * x), t(x, x)]
        a, b = np.meshgrid(ids[left], ids[right], indexing="ij")
        wanted = (sums[0] > 0) & ((a < b) if i == j else np.ones(a.shape, bool))
        swap = a[wanted] > b[wanted]
        columns = [s[wanted] for s in sums]
        for p, q in ((2, 3), (4, 5)):
            columns[p], columns[q] = np.where(swap, columns[q], columns[p]), np.where(swap, columns[p], columns[q])
        first, second = np.where(swap, b[wanted], a[wanted]), np.where(swap, a[wanted], b[wanted])
        return pa.table([pa.array(first.tolist(), pa.string()), pa.array(second.tolist(), pa.string()), *[pa.array(c) for c in columns]], schema=schema)

    parts = dealt.groupBy("i", "j", "p").applyInArrow(products, "a string, b string, " + ", ".join(f"{s} double" for s in _SUMS))
    total = parts.groupBy("a", "b").agg(*[F.sum(s).alias(s) for s in _SUMS])
    n = F.col("n")
    spread = lambda s, ss: F.col(ss) - F.col(s) * F.col(s) / n
    # what rounding leaves of a constant series is no variance
    flat = lambda s, ss: spread(s, ss) <= F.lit(1e-12) * F.col(ss)
    value_ = F.when((n >= 2) & ~flat("sx", "sxx") & ~flat("sy", "syy"), (F.col("sxy") - F.col("sx") * F.col("sy") / n) / F.sqrt(spread("sx", "sxx") * spread("sy", "syy")))
    return total.select("a", "b", n.cast("long").alias("pairs"), (F.col("present") - n).cast("long").alias("excluded"), value_.alias("correlation"), F.when(value_.isNull(), "not_established").otherwise("established").alias("status"))
