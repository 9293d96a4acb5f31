"""Scalar column expressions: ids, canonical texts, guarded arithmetic, format tests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_id(prefix: str, *parts: Column) -> Column:
    """prefix_ and the first 32 hex digits of sha256 over the parts, joined by NUL; null if a part is null or holds a NUL."""
    plain = [F.when(~p.cast("string").contains("\0"), p.cast("string")) for p in parts]
    joined = F.concat(*[x for p in plain for x in (F.lit("\0"), p)][1:])
    return F.concat(F.lit(prefix + "_"), F.substring(F.sha2(joined, 256), 1, 32))


def fields_text(*columns: Column) -> Column:
    """One text for a row of fields, different for different rows: each field after its length, N for a null."""
    return F.concat(*[F.coalesce(F.concat(F.length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("N")) for c in columns])


def decimal_canonical(value: Column) -> Column:
    """A decimal without trailing zeros or exponent; minus zero is zero."""
    text = value.cast("decimal(28,10)").cast("string")
    plain = F.regexp_replace(F.regexp_replace(text, r"(\.\d*?)0+$", "$1"), r"\.$", "")
    return F.when(plain == "-0", "0").otherwise(plain)


def json_canonical(fields: dict[str, Column]) -> Column:
    """A JSON object with sorted keys; null fields are null in it."""
    return F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]), {"ignoreNullFields": "false"})


def dimensions_digest(dimensions: Column) -> Column:
    """sha256 of a map as a JSON object in key order, null values included: the key to join and group maps by."""
    return F.sha2(F.to_json(F.map_from_entries(F.array_sort(F.map_entries(dimensions))), {"ignoreNullFields": "false"}), 256)


def simple_ratio(later: Column, base: Column) -> Column:
    return F.try_divide(later, base) - 1


def log_ratio(later: Column, base: Column) -> Column:
    return F.when((later > 0) & (base > 0), F.ln(F.try_divide(later, base)))


def contains_literal(needle: str, *columns: Column) -> Column:
    """Case-insensitive search for a literal in the columns, joined by spaces; wildcards have no meaning."""
    if len(needle) > 128 or any(ord(c) < 32 for c in needle):
        raise ValueError("a search text has at most 128 characters and no control characters")
    return F.lower(F.concat_ws(" ", *columns)).contains(needle.lower())


def safe_terms(query: str) -> list[str]:
    """The terms of a search: at most 8, of at most 64 letters, digits and inner hyphens."""
    import re

    terms = query.split()
    if not 1 <= len(terms) <= 8 or any(len(t) > 64 or not re.fullmatch(r"\w+(-\w+)*", t) for t in terms):
        raise ValueError("not a plain search text")
    return terms


def is_accession(value: Column) -> Column:
    """An accession number: 10, 2 and 6 digits."""
    return value.rlike(r"^\d{10}-\d{2}-\d{6}$")


def is_security_shaped(value: Column) -> Column:
    """A text in the shape of a security identifier of nine or twelve places."""
    return value.rlike(r"^[0-9A-Z]{8}[0-9]$") | value.rlike(r"^[A-Z]{2}[0-9A-Z]{9}[0-9]$")


def ohlc_consistent(open_: Column, high: Column, low: Column, close: Column) -> Column:
    return (low <= F.least(open_, close)) & (high >= F.greatest(open_, close)) & (low <= high)


def family_from_prefix(series_id: Column, families: Sequence[tuple[str, str]]) -> Column:
    """The family of the first prefix that fits."""
    out = F.lit(None).cast("string")
    for prefix, family in reversed(families):
        out = F.when(series_id.startswith(prefix), F.lit(family)).otherwise(out)
    return out
