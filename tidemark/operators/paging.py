"""Total orders, limits, pages and small samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def limited(rows: DataFrame, order: Sequence, n: int) -> tuple[DataFrame, bool]:
    """The first n rows of a total order, and whether there are more; the one row beyond is all that is asked for it."""
    return rows.orderBy(*order).limit(n), rows.limit(n + 1).count() > n


def page(rows: DataFrame, sort: str, whitelist: Sequence[str], tie: Sequence[str], size: int, number: int, descending: bool = False) -> DataFrame:
    """One page (from 1) in a whitelisted order with a tie-breaker."""
    if sort not in whitelist:
        raise ValueError(f"can't sort by {sort}")
    by = F.col(sort).desc_nulls_last() if descending else F.col(sort).asc_nulls_last()
    return rows.orderBy(by, *tie).offset(size * (number - 1)).limit(size)


def pages_of(rows: DataFrame, size: int, number: int) -> DataFrame:
    """How many rows and pages there are, and whether a page's number lies beyond."""
    total = rows.agg(F.count(F.lit(1)).alias("total_rows"))
    return total.withColumn("page_count", F.ceil(F.col("total_rows") / size).cast("long")).withColumn("out_of_range", F.col("page_count") < number)


def order_ties(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Values of an order that several rows share, so that it isn't total."""
    return rows.groupBy(*order).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def first_middle_last(rows: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Of each key's rows the first, the middle and the last one."""
    w = Window.partitionBy(*key)
    numbered = rows.withColumns({"_i": F.row_number().over(w.orderBy(*order)), "_n": F.count(F.lit(1)).over(w)})
    return numbered.filter((F.col("_i") == 1) | (F.col("_i") == F.floor(F.col("_n") / 2) + 1) | (F.col("_i") == F.col("_n"))).drop("_i", "_n")
