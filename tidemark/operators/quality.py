"""Data quality: row rules with reject tables, coverage, audits and digests of relations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import fields_text


def check_rows(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """rows with rejected, the names of the rules that each row breaks (a rule that gives null is broken)."""
    broken = F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()])
    return rows.withColumn("rejected", F.filter(broken, lambda r: r.isNotNull()))


def accepted(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("rejected") == 0).drop("rejected")


def rejects(checked: DataFrame, key: Sequence[str]) -> DataFrame:
    """A row for each broken rule."""
    return checked.filter(F.size("rejected") > 0).select(*key, F.explode("rejected").alias("rule"))


def duplicates(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Natural keys that a batch has more than once."""
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def coverage(expected: DataFrame, observed: DataFrame, key: Sequence[str]) -> DataFrame:
    """Expected keys that are missing, observed ones that are extra, and duplicates."""
    seen = observed.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    both = expected.select(*key, F.lit(True).alias("_expected")).join(seen, list(key), "full_outer")
    status = F.when(F.col("n").isNull(), "missing").when(F.col("_expected").isNull(), "extra").when(F.col("n") > 1, "duplicate")
    return both.withColumn("status", status).filter("status IS NOT NULL").select(*key, "status")


def dangling(rows: DataFrame, key: Sequence[str], parent: DataFrame, on: dict[str, str], rule: str) -> DataFrame:
    """Rows whose reference isn't in the parent."""
    return rows.join(parent.select(*[F.col(p).alias(c) for c, p in on.items()]).distinct(), list(on), "left_anti").select(*key, F.lit(rule).alias("rule"))


def result_rows(violations: DataFrame, total: DataFrame, rules: Sequence[str], severity: str = "error") -> DataFrame:
    """A row for each rule: outcome, how many subjects break it, and of how many."""
    names = violations.sparkSession.createDataFrame([(r,) for r in rules], "rule string")
    found = violations.groupBy("rule").agg(F.count(F.lit(1)).alias("_n"))
    return names.join(found, "rule", "left").crossJoin(total.agg(F.count(F.lit(1)).alias("subjects"))).select(
        F.col("rule").alias("rule_id"), F.lit(severity).alias("severity"), F.when(F.col("_n").isNull(), "pass").otherwise("fail").alias("outcome"), F.coalesce("_n", F.lit(0)).alias("observed"), "subjects"
    )


def row_hash(columns: Sequence[Column]) -> Column:
    """60 bits of md5 over the columns' texts; nulls differ from empty texts."""
    return F.conv(F.substring(F.md5(fields_text(*columns).cast("binary")), 1, 15), 16, 10).cast("decimal(38,0)")


def table_digest(rows: DataFrame, columns: Sequence[Column], key: Sequence[str] = ()) -> DataFrame:
    """Content of a relation that doesn't depend on row order: count and sum of row hashes; nothing is sorted."""
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.sum(row_hash(columns)).cast("string").alias("digest"))


def semantic_identity(rows: DataFrame, batch: Sequence[str], columns: Sequence[Column]) -> DataFrame:
    """sha256 of a batch's rows in canonical order, volatile columns left out; for batches of a task's size."""
    return rows.groupBy(*batch).agg(F.sha2(F.array_join(F.array_sort(F.collect_list(fields_text(*columns))), "\n"), 256).alias("identity"))


def page_faults(pages: DataFrame, batch: Sequence[str]) -> DataFrame:
    """Batches whose pages aren't contiguous from 1 and unique, with the rows that they hold."""
    out = pages.groupBy(*batch).agg(F.min("page").alias("lo"), F.max("page").alias("hi"), F.count(F.lit(1)).alias("n"), F.count_distinct("page").alias("distinct"), F.sum("row_count").alias("rows"))
    return out.select(*batch, "rows", ((F.col("lo") == 1) & (F.col("hi") == F.col("n")) & (F.col("n") == F.col("distinct"))).alias("complete"))


def capture_diff(left: DataFrame, right: DataFrame, key: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Keys whose values differ between two captures, or that one of them lacks."""
    a, b = left.select(*key, F.struct(*values).alias("_a")), right.select(*key, F.struct(*values).alias("_b"))
    return a.join(b, list(key), "full_outer").filter(~F.col("_a").eqNullSafe(F.col("_b"))).select(*key, F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").otherwise("changed").alias("change"))


def ledger_audit(ledger: DataFrame, key: Sequence[str], scopes: DataFrame, scope: str, earlier: DataFrame | None = None, columns: Sequence[str] = ()) -> DataFrame:
    """key, sequence and rule of what breaks an append-only ledger's rules.

    The ledger has sequence, supersedes, version, value, reason, state,
    state_reason and the scope that each row came with; scopes tells which are
    complete. earlier is a copy of before: its rows, by columns, must all be there.
    """
    rows = ledger.join(scopes.groupBy(scope).agg(F.bool_and("complete").alias("_complete")), scope, "left")
    tombstone = F.col("state") == "tombstone"
    chain = Window.partitionBy(*key).orderBy("sequence", "version")
    rows = rows.withColumns({"_starts": F.count(F.when(F.col("supersedes").isNull(), 1)).over(Window.partitionBy(*key)), "_before": F.lag("version").over(chain)})
    own = rows.select(*key, F.col("version").alias("_theirs")).distinct()
    named = rows.select(*key, "sequence", "version", "supersedes").filter("supersedes IS NOT NULL")
    strange = named.join(own, [*[named[k].eqNullSafe(own[k]) for k in key], named["supersedes"] == own["_theirs"]], "left_anti").select(*key, "sequence", F.lit("supersedes_other_key").alias("rule"))
    checked = check_rows(
        rows,
        {
            "value_xor_reason": (F.col("value").isNull() == F.col("reason").isNotNull()) | tombstone,
            "tombstone_has_reason": ~tombstone | F.col("state_reason").isNotNull(),
            "tombstone_of_complete_scope": ~tombstone | F.coalesce("_complete", F.lit(False)),
            "one_start": (F.col("_starts") == 1) | F.col("supersedes").isNotNull(),
        },
    )
    out = rejects(checked, [*key, "sequence"]).unionByName(strange)
    if earlier is not None:
        text = lambda df: df.select(*key, "sequence", fields_text(*[F.col(c) for c in columns]).alias("_text"))
        now = text(ledger).select(*[F.col(k).alias(f"_k_{k}") for k in key], F.col("sequence").alias("_s"), F.col("_text").alias("_t"))
        before = text(earlier)
        gone = before.join(now, [*[before[k].eqNullSafe(now[f"_k_{k}"]) for k in key], before["sequence"] == now["_s"], before["_text"] == now["_t"]], "left_anti")
        out = out.unionByName(gone.select(*key, "sequence", F.lit("changed_or_deleted").alias("rule")))
    return out


def scope_faults(rows: DataFrame, scope: DataFrame, on: Sequence[str], key: Sequence[str], day: str) -> DataFrame:
    """on and rule of files that aren't what was asked for.

    scope has on, first_day, last_day, days (the expected ones, or null) and
    expected_rows (or null). Rules: a file without scope, days out of scope,
    keys twice, missing and unexpected days, another number of rows.
    """
    found = rows.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"), F.min(day).alias("_lo"), F.max(day).alias("_hi"), F.array_sort(F.collect_set(day)).alias("_days"))
    twice = duplicates(rows, [*on, *key]).select(*on).distinct().withColumn("_twice", F.lit(True))
    both = scope.withColumn("_asked", F.lit(True)).join(found, list(on), "full_outer").join(twice, list(on), "left")
    asked = F.col("_asked").isNotNull()
    wrong = {
        "no_scope": ~asked,
        "out_of_scope": asked & ((F.col("_lo") < F.col("first_day")) | (F.col("_hi") > F.col("last_day"))),
        "duplicate_key": F.col("_twice").isNotNull(),
        "missing_day": F.size(F.array_except("days", F.coalesce("_days", F.array().cast("array<date>")))) > 0,
        "unexpected_day": F.size(F.array_except("_days", "days")) > 0,
        "row_count": asked & (F.coalesce("_n", F.lit(0)) != F.col("expected_rows")),
    }
    names = F.array_compact(F.array(*[F.when(F.coalesce(w, F.lit(False)), F.lit(n)) for n, w in wrong.items()]))
    return both.select(*on, F.explode(names).alias("rule"))
