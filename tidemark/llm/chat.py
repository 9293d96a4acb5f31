"""Chat formatting by collapsing cumulative snapshots.

A conversation that is logged again after each turn leaves logs that are
prefixes of one another. Each turn gets a 128-bit hash of its place, role and
text, as four sums of 32 bits, and the running sums over a conversation's turns
are the hashes of its prefixes. A log whose whole hash is the hash of a proper
prefix of another goes (an anti-join on number of turns and hash); of logs that
are equal the one of smallest conv_id stays. What stays is rendered.

Scale: sums over a window for each conversation, one partial aggregation of
prefixes to distinct hashes, then equi-joins on hashes; a first turn that a
third of all conversations share is one row of the aggregate. One conversation
is one output row, so its own turns do meet in one task.

Defined cases: turns are ordered by turn (nulls first), role and text, and
repeated rows count as turns of their own; a null role or text is hashed as a
value of its own and rendered as the empty string; rows with a null conv_id
are one conversation; an empty table gives no rows; other columns are not used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialise, table

TURN_FORMAT = "<|%s|>\n%s\n"
END = "<|end|>"
HASH = ["h1", "h2", "h3", "h4"]


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """turns with pos (from 1), n_turns and the hash of the prefix that ends with each."""
    ordered = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    running = ordered.rowsBetween(Window.unboundedPreceding, 0)
    numbered = turns.select("conv_id", "turn", "role", "text").withColumn("pos", F.row_number().over(ordered))
    body = F.concat(F.col("pos").cast("string"), F.lit(":"), F.coalesce(F.concat(F.lit("r"), F.col("role")), F.lit("-")), F.lit(":"), F.coalesce(F.concat(F.lit("t"), F.col("text")), F.lit("-")))
    part = lambda k: F.conv(F.substring("_md5", 8 * k + 1, 8), 16, 10).cast("long")
    by_pos = Window.partitionBy("conv_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    hashed = numbered.withColumn("_md5", F.md5(body.cast("binary")))
    return hashed.withColumns({h: F.sum(part(k)).over(by_pos) for k, h in enumerate(HASH)} | {"n_turns": F.count(F.lit(1)).over(Window.partitionBy("conv_id"))}).drop("_md5")


def collapse(turns: DataFrame) -> DataFrame:
    """A row for each maximal conversation: conv_id, n_turns, n_equal (logs of the same turns), n_prefixes (logs that are proper prefixes of it)."""
    hashed = materialise(prefix_hashes(turns).select("conv_id", "pos", "n_turns", *HASH), "prefixes")
    logs = hashed.filter("pos = n_turns").groupBy("n_turns", *HASH).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_equal"))
    proper = hashed.filter("pos < n_turns").select(F.col("pos").alias("n_turns"), *HASH).distinct()
    kept = logs.join(proper, ["n_turns", *HASH], "left_anti").select("conv_id", "n_turns", "n_equal")
    shorter = logs.select(F.col("n_turns").alias("pos"), *HASH, F.col("n_equal").alias("_n"))
    absorbed = hashed.filter("pos < n_turns").join(shorter, ["pos", *HASH]).groupBy(F.col("conv_id").alias("_conv_id")).agg(F.sum("_n").alias("n_prefixes"))
    return kept.join(absorbed, F.col("conv_id").eqNullSafe(F.col("_conv_id")), "left").select("conv_id", "n_turns", "n_equal", F.coalesce("n_prefixes", F.lit(0)).alias("n_prefixes"))


def format_conversations(turns: DataFrame) -> DataFrame:
    """The maximal conversations with their rendered chat."""
    kept = collapse(turns)
    one = F.format_string(TURN_FORMAT, F.coalesce("role", F.lit("")), F.coalesce("text", F.lit("")))
    of = turns.select(F.col("conv_id").alias("_conv_id"), "turn", "role", "text", one.alias("_one"))
    joined = kept.join(of, F.col("conv_id").eqNullSafe(F.col("_conv_id")))
    rendered = joined.groupBy("conv_id", "n_turns", "n_equal", "n_prefixes").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text", "_one"))).alias("_turns"))
    return rendered.select("conv_id", "n_turns", "n_equal", "n_prefixes", F.concat(F.array_join(F.col("_turns._one"), ""), F.lit(END)).alias("chat"))


def op3_chat(spark, sf_dir: str) -> DataFrame:
    return format_conversations(table(spark, sf_dir, "conversations"))


OP3_SQL = """
WITH numbered AS (SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS pos FROM conversations),
counted AS (SELECT *, count(*) OVER (PARTITION BY conv_id) AS n_turns,
  string_agg(md5(coalesce('r' || role, '-') || ':' || coalesce('t' || text, '-')), '') OVER (PARTITION BY conv_id ORDER BY pos) AS prefix FROM numbered),
logs AS (SELECT n_turns, prefix, min(conv_id) AS conv_id, count(*) AS n_equal FROM counted WHERE pos = n_turns GROUP BY ALL),
proper AS (SELECT DISTINCT pos AS n_turns, prefix FROM counted WHERE pos < n_turns),
kept AS (SELECT * FROM logs l WHERE NOT EXISTS (SELECT 1 FROM proper p WHERE p.n_turns = l.n_turns AND p.prefix = l.prefix)),
absorbed AS (SELECT c.conv_id, CAST(sum(l.n_equal) AS BIGINT) AS n_prefixes FROM counted c JOIN logs l ON l.n_turns = c.pos AND l.prefix = c.prefix WHERE c.pos < c.n_turns GROUP BY c.conv_id)
SELECT k.conv_id, k.n_turns, k.n_equal, coalesce(a.n_prefixes, 0) AS n_prefixes,
  (SELECT string_agg('<|' || coalesce(n.role, '') || '|>' || chr(10) || coalesce(n.text, '') || chr(10), '' ORDER BY n.pos) FROM numbered n WHERE n.conv_id IS NOT DISTINCT FROM k.conv_id) || '<|end|>' AS chat
FROM kept k LEFT JOIN absorbed a ON a.conv_id IS NOT DISTINCT FROM k.conv_id"""
