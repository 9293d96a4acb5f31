"""Nested results: option surfaces and labelled news."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def collected(rows: DataFrame, key: Sequence[str], fields: Sequence[str], name: str) -> DataFrame:
    """The rows of each key as a sorted array of structs."""
    return rows.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias(name))


def nest(parents: DataFrame, key: Sequence[str], children: dict[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """parents with an array for each family of children, empty where there are none; a join for each family, not for each row."""
    out = parents
    for name, (rows, fields) in children.items():
        out = out.join(collected(rows, key, fields, name), list(key), "left").withColumn(name, F.coalesce(name, F.array().cast(rows.select(F.array(F.struct(*fields)).alias("x")).schema["x"].dataType)))
    return out


def surface(contracts: DataFrame, quotes: DataFrame, interest: DataFrame, closes: DataFrame, bars: DataFrame, key: Sequence[str], bar_fields: Sequence[str]) -> DataFrame:
    """One row for each contract with a quote: quote, open interest and close where there are any, and its bars."""
    joined = contracts.join(quotes, list(key)).join(interest, list(key), "left").join(closes, list(key), "left")
    return nest(joined, key, {"bars": (bars, bar_fields)})
