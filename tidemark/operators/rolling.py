"""Rolling statistics of several columns: sums of windows in the JVM, small solves in Arrow batches."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: A design whose centred products have a greater condition number is singular.
SINGULAR = 1e12


def solve_windows(n: np.ndarray, means: np.ndarray, products: np.ndarray, intercept: bool) -> dict[str, list]:
    """Least squares of the first column on the others, for many windows at once.

    n, means and products are each window's count, means and centred products (divided by n).
    """
    p = means.shape[1] - 1
    gram = products if intercept else products + means[:, :, None] * means[:, None, :]
    enough = n > p + int(intercept)
    # columns of very different size are no near-dependence: the products are scaled before they are judged
    size = np.sqrt(np.einsum("ijj->ij", gram[:, 1:, 1:]))
    usable = enough & (size > 0).all(1)
    unit = np.where(usable[:, None, None], gram[:, 1:, 1:] / np.where(size > 0, size, 1)[:, :, None] / np.where(size > 0, size, 1)[:, None, :], np.eye(p))
    regular = usable & (np.linalg.cond(unit) <= SINGULAR)
    safe = np.where(regular[:, None, None], unit, np.eye(p))
    beta = np.linalg.solve(safe, (gram[:, 1:, 0] / np.where(size > 0, size, 1))[:, :, None])[:, :, 0] / np.where(size > 0, size, 1)
    rss = np.maximum(0.0, n * (gram[:, 0, 0] - (beta * gram[:, 1:, 0]).sum(1)))
    tss = n * products[:, 0, 0]
    whole = np.concatenate([(means[:, 0] - (beta * means[:, 1:]).sum(1))[:, None], beta], axis=1) if intercept else beta
    status = np.where(~enough, "insufficient_degrees_of_freedom", np.where(regular, "established", "singular_design"))
    constant = regular & (tss == 0)
    return {
        "status": status.tolist(),
        "warning": ["constant_target" if c else None for c in constant],
        "coefficients": [b if ok else None for b, ok in zip(whole.tolist(), regular)],
        "rss": [r if ok else None for r, ok in zip(rss.tolist(), regular)],
        "r_squared": [1 - r / t if ok and t > 0 else None for r, t, ok in zip(rss.tolist(), tss.tolist(), regular)],
    }


def rolling_ols(rows: DataFrame, n: int, key: Sequence[str], order: Sequence[str], y: str, xs: Sequence[str], intercept: bool = True) -> DataFrame:
    """Least squares of y on the xs over each window of n rows, N - n + 1 estimates for N rows.

    A window is of rows as they come; rows that lack a value are left out inside
    it (excluded). Each window has a status of its own; coefficients begin with
    the intercept, if there is one.
    """
    w = Window.partitionBy(*key).orderBy(*order).rowsBetween(-(n - 1), 0)
    names = [y, *xs]
    complete = F.lit(True)
    for c in names:
        complete = complete & F.col(c).isNotNull()
    masked = rows.withColumns({f"_v{i}": F.when(complete, F.col(c).cast("double")) for i, c in enumerate(names)})
    cells = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    sums = {"_rows": F.count(F.lit(1)).over(w), "_n": F.count("_v0").over(w)} | {f"_m{i}": F.avg(f"_v{i}").over(w) for i in range(len(names))} | {f"_c{i}_{j}": F.covar_pop(f"_v{i}", f"_v{j}").over(w) for i, j in cells}
    carried = list(dict.fromkeys([*key, *order]))
    windows = masked.withColumns(sums).filter(F.col("_rows") == n).select(*carried, *[c for c in sums if c != "_rows"])
    p = len(names)

    def solve(batches):
        for part in batches:
            if not part.num_rows:
                continue
            value = lambda c: np.nan_to_num(part.column(c).fill_null(0).to_numpy(zero_copy_only=False).astype(float))
            count = part.column("_n").to_numpy().astype(float)
            products = np.zeros((part.num_rows, p, p))
            for i, j in cells:
                products[:, i, j] = products[:, j, i] = value(f"_c{i}_{j}")
            out = solve_windows(count, np.stack([value(f"_m{i}") for i in range(p)], axis=1), products, intercept)
            types = (pa.string(), pa.string(), pa.list_(pa.float64()), pa.float64(), pa.float64())
            size = pa.array(count.astype(np.int64))
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in carried], size, pa.array(n - count.astype(np.int64)), *[pa.array(v, t) for v, t in zip(out.values(), types)]], names=[*carried, "sample_size", "excluded", *out])

    schema = StructType([*windows.select(*carried).schema.fields, *StructType.fromDDL("sample_size long, excluded long, status string, warning string, coefficients array<double>, rss double, r_squared double").fields])
    return windows.mapInArrow(solve, schema)


def rolling_correlation(pairs: DataFrame, n: int, key: Sequence[str], order: Sequence[str], x: str = "x", y: str = "y") -> DataFrame:
    """Pearson's correlation over each window of n rows, from the complete pairs in it; not established below two or without variance."""
    w = Window.partitionBy(*key).orderBy(*order).rowsBetween(-(n - 1), 0)
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    masked = pairs.withColumns({"_x": F.when(both, F.col(x)), "_y": F.when(both, F.col(y))})
    sums = {"_rows": F.count(F.lit(1)).over(w), "pairs": F.count("_x").over(w), "_c": F.covar_pop("_x", "_y").over(w), "_sx": F.stddev_pop("_x").over(w), "_sy": F.stddev_pop("_y").over(w)}
    out = masked.withColumns(sums).filter(F.col("_rows") == n)
    value = F.when((F.col("pairs") >= 2) & (F.col("_sx") > 0) & (F.col("_sy") > 0), F.try_divide(F.col("_c"), F.col("_sx") * F.col("_sy")))
    return out.select(*dict.fromkeys([*key, *order]), "pairs", value.alias("correlation"), F.when(value.isNull(), "not_established").otherwise("established").alias("status"))
