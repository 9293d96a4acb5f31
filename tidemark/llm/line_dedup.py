"""Line deduplication over hashes of line runs, with DataFrame functions only.

The lines of a text that hold a word, trimmed, are its positions. A run of them
counts if it has ``min_lines`` lines or ``min_words`` words, and is deleted
wherever it equals a run at an earlier place, in the order of doc_id (nulls
last), text hash and line. It is enough to look at the grams: the runs that
count but would not without their last line, or not without their first. Any
run that counts is covered by the grams in it, and each gram of a later run is
also in the earlier one. So every gram but its first occurrence in the corpus
is deleted, no gram is left out, and a deleted line's words stay at an earlier
place.

``winnowed_repeats`` finds the same lines by winnowing. The lines' hashes are put
together to grams, one line shorter than ``min_lines``; of each window of two
consecutive grams the smaller hash is a fingerprint (of equals the right one),
and so is each gram, or run of fewer lines, that has ``min_words`` words. So any
run that counts holds a fingerprint, which its content alone decides: equal
runs hold the same at the same line. Fingerprints are joined with those that
two places or more share; all others go. From these the text is compared both
ways: a fingerprint is extended by the line before or after it where its window
reaches, and of the places of an extended run that has ``min_lines`` lines all
but the first are deleted, as are those of a fingerprint that counts itself.
Longer runs are deleted as the runs of ``min_lines`` lines of which they consist.
``repeated_lines`` looks at all grams instead.

Scale: everything is keyed by hashes of lines; a run is matched with its first
place only, so a group of n copies gives n - 1 matches and never n squared, and
a long text of equal lines as many as it has lines. First places come from a
partial aggregation, and the equi-joins on them are ones whose large partitions
adaptive execution splits. The text is shuffled once, to rebuild the changed
documents.

Defined cases: a null or blank text has no lines and stays as it is; rows that
repeat doc_id and text are one document and get one result each; blank lines
are kept; a long line is one position, whatever its length; an empty table
gives no rows; further columns, whatever their names, pass through
``dedup_lines`` unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import MAX_LONG, WORD_GAP, as_struct, materialise, release, table, word_count

MIN_LINES = 3
MIN_WORDS = 50

KEY = ["_ord", "_text_id"]


def hash60(value: Column) -> Column:
    return F.conv(F.substring(F.md5(value.cast("binary")), 1, 15), 16, 10).cast("long")


def with_key(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with the pair that names and orders a document."""
    return docs.withColumns({"_ord": F.coalesce(F.col(doc_id).cast("long"), F.lit(MAX_LONG)), "_text_id": hash60(F.coalesce(F.col(text), F.lit("")))})


def line_rows(docs: DataFrame) -> DataFrame:
    """A row for each line with a word: key, pos (among such lines), raw (among all), line hash and words."""
    trim = rf"^{WORD_GAP}|{WORD_GAP}$"
    lines = with_key(docs.select("doc_id", "text")).select(*KEY, F.posexplode(F.split("text", "\n")).alias("raw", "line"))
    worded = lines.withColumn("line", F.regexp_replace("line", trim, "")).filter("line <> ''")
    worded = worded.select(*KEY, "raw", hash60(F.col("line")).alias("line_hash"), word_count(F.col("line")).alias("words")).dropDuplicates([*KEY, "raw"])
    return worded.withColumn("pos", F.row_number().over(Window.partitionBy(*KEY).orderBy("raw")) - 1)


def joined_hash(hashes: list[Column]) -> Column:
    """The hash of a run of lines."""
    return hash60(F.concat_ws(",", *[h.cast("string") for h in hashes]))


def fingerprints(lines: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """Key and gram of every fingerprint, raws (the raw numbers of the line before, its own, and the line after), size (its lines), counts (whether it is to be deleted by itself), before and after: the hash of the run with the line before or after, where a window reaches it."""
    if min_lines < 2:
        raise ValueError("min_lines must be 2 or more")
    doc = Window.partitionBy(*KEY).orderBy("raw")
    length = min_lines - 1
    near = {f"_{name}{i}": (F.lead(name, i) if i >= 0 else F.lag(name, -i)).over(doc) for i in range(-1, min_lines) for name in ("words", "line_hash", "raw")}
    take = lambda name, a, b: [F.col(f"_{name}{i}") for i in range(a, b)]
    total = lambda a, b: sum(take("words", a, b), F.lit(0))
    # a run is looked at unless it counts without its last line and also without its first
    least = lambda a, b: (total(a, b - 1) < min_words) | (total(a + 1, b) < min_words)
    there = F.col(f"_raw{length - 1}").isNotNull()
    named = lines.withColumns(near).withColumn("_gram", F.when(there, joined_hash(take("line_hash", 0, length))))
    named = named.withColumns({"_left": F.lag("_gram").over(doc), "_right": F.lead("_gram").over(doc)})
    before = F.when((F.col("_gram") <= F.col("_left")) & least(-1, length), joined_hash(take("line_hash", -1, length)))
    after = F.when((F.col("_gram") < F.col("_right")) & least(0, min_lines), joined_hash(take("line_hash", 0, min_lines)))
    nothing, found = F.lit(None).cast("long"), []
    for size in range(1, length + 1):
        counts = F.coalesce((total(0, size) >= min_words) & least(0, size), F.lit(False))
        whole = size == length
        content = F.col("_gram") if whole else joined_hash(take("line_hash", 0, size))
        print_ = F.struct(content.alias("gram"), F.lit(size).cast("byte").alias("size"), counts.alias("counts"), (F.col("_before") if whole else nothing).alias("before"), (F.col("_after") if whole else nothing).alias("after"))
        found.append(F.when(counts | (F.col("_before").isNotNull() | F.col("_after").isNotNull() if whole else F.lit(False)), print_))
    named = named.withColumns({"_before": before, "_after": after})
    return named.select(*KEY, F.array(*take("raw", -1, min_lines)).alias("raws"), F.explode(F.array_compact(F.array(*found))).alias("_print")).select(*KEY, "raws", "_print.*")


def winnowed_repeats(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """Key and raw line number of every line to delete, by fingerprints and their extension."""
    prints = materialise(fingerprints(line_rows(docs), min_lines, min_words), "fingerprints")
    shared = prints.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram")
    run = lambda start, size, name: F.struct(F.slice("raws", start, size).alias("raws"), F.col(name).alias("gram"))
    extended = F.array(
        F.when(F.col("counts"), run(2, F.col("size"), "gram")),
        F.when(F.col("before").isNotNull(), run(1, min_lines, "before")),
        F.when(F.col("after").isNotNull(), run(2, min_lines, "after")),
    )
    runs = prints.join(shared, "gram").select(*KEY, F.explode(F.array_compact(extended)).alias("_run"))
    runs = materialise(runs.select(*KEY, F.get("_run.raws", F.lit(0)).alias("raw"), "_run.*"), "runs")
    release(prints)
    return later_places(runs)


def grams(lines: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """Key, first raw line number, raw line numbers and hash of every gram."""
    doc = Window.partitionBy(*KEY).orderBy("raw")
    ahead = {f"_{name}{i}": F.lead(name, i).over(doc) for i in range(min_lines) for name in ("words", "line_hash", "raw")}
    found, total = [], F.lit(0)
    for i in range(min_lines):
        shorter, total = total, total + F.col(f"_words{i}")
        counts = F.col(f"_words{i}").isNotNull() if i + 1 == min_lines else total >= min_words
        least = (shorter < min_words) | (total - F.col("_words0") < min_words)
        run = F.struct(F.array(*[F.col(f"_raw{j}") for j in range(i + 1)]).alias("raws"), hash60(F.concat_ws(",", *[F.col(f"_line_hash{j}").cast("string") for j in range(i + 1)])).alias("gram"))
        found.append(F.when(counts & least, run))
    return lines.withColumns(ahead).select(*KEY, "raw", F.explode(F.array_compact(F.array(*found))).alias("_run")).select(*KEY, "raw", "_run.raws", "_run.gram")


def later_places(runs: DataFrame) -> DataFrame:
    """Key and raw line number of every line of a run (raws, first of them raw, and gram, its name) but at its first place."""
    first = runs.groupBy("gram").agg(F.min(F.struct(*KEY, "raw")).alias("src"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram", "src")
    later = runs.join(first, "gram").filter(F.struct(*KEY, "raw") > F.col("src"))
    return later.select(*KEY, F.explode("raws").alias("raw")).distinct()


def repeated_lines(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """Key and raw line number of every line to delete, by all grams."""
    return later_places(materialise(grams(line_rows(docs), min_lines, min_words), "grams"))


def rebuilt(docs: DataFrame, rule=repeated_lines, **options) -> DataFrame:
    """row (docs' columns, whatever their names, as one struct, with the lines that the rule finds out of text), n_lines and n_removed."""
    gone = rule(docs, **options).groupBy(*KEY).agg(F.collect_list("raw").alias("gone"))
    out = with_key(docs.select(as_struct(docs)), "row.doc_id", "row.text").join(gone, KEY, "left")
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
    text = F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n"))
    return out.withColumn("lines", F.split(F.coalesce("row.text", F.lit("")), "\n")).select(F.col("row").withField("text", text).alias("row"), F.size("lines").cast("long").alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"))


def dedup_lines(docs: DataFrame, **options) -> DataFrame:
    """docs with the repeated lines out of text, and n_lines, n_removed: lines before, lines deleted.

    A document whose lines all go keeps its row with an empty text. Columns of
    those two names in docs are replaced.
    """
    return rebuilt(docs.drop("n_lines", "n_removed"), **options).select("row.*", "n_lines", "n_removed")


def without_repeats(docs: DataFrame, **options) -> DataFrame:
    """docs with the repeated lines out of text, without the documents of which nothing but blanks is left; columns as in docs."""
    return rebuilt(docs, **options).filter((F.col("n_removed") == 0) | (word_count(F.col("row.text")) > 0)).select("row.*")


def deduplicated(spark, sf_dir: str, rule) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs, rule=rule).select("doc_id", "n_lines", "n_removed", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("text_md5"))


def op4_line_dedup(spark, sf_dir: str) -> DataFrame:
    return deduplicated(spark, sf_dir, winnowed_repeats)


def op4_line_dedup_all_runs(spark, sf_dir: str) -> DataFrame:
    return deduplicated(spark, sf_dir, repeated_lines)


_GAP = r"[\x20\x09-\x0D]+"
#: Every run of up to three lines that counts, no gram or fingerprint.
ALL_RUNS_SQL = rf"""
keyed AS (SELECT doc_id, text, coalesce(CAST(doc_id AS BIGINT), 9223372036854775807) AS ord, CAST('0x' || substr(md5(coalesce(text, '')), 1, 15) AS BIGINT) AS text_id FROM {{docs}}),
raw_lines AS (SELECT ord, text_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS raw FROM (SELECT DISTINCT ord, text_id, text FROM keyed)),
worded AS (SELECT ord, text_id, raw, regexp_replace(line, '^{_GAP}|{_GAP}$', '', 'g') AS line FROM raw_lines),
lines AS (SELECT ord, text_id, raw, CAST('0x' || substr(md5(line), 1, 15) AS BIGINT) AS line_hash, len(regexp_split_to_array(line, '{_GAP}')) AS words, row_number() OVER (PARTITION BY ord, text_id ORDER BY raw) - 1 AS pos FROM worded WHERE line <> ''),
looked AS (SELECT *, lead(words, 1) OVER d AS w1, lead(words, 2) OVER d AS w2, lead(line_hash, 1) OVER d AS h1, lead(line_hash, 2) OVER d AS h2 FROM lines WINDOW d AS (PARTITION BY ord, text_id ORDER BY raw)),
stretches AS (SELECT ord, text_id, pos, 1 AS size, [line_hash] AS content FROM looked WHERE words >= 50 UNION ALL SELECT ord, text_id, pos, 2, [line_hash, h1] FROM looked WHERE words + w1 >= 50 UNION ALL SELECT ord, text_id, pos, 3, [line_hash, h1, h2] FROM looked WHERE w2 IS NOT NULL),
firsts AS (SELECT content, min((ord, text_id, pos)) AS src FROM stretches GROUP BY content HAVING count(*) > 1),
later AS (SELECT r.ord, r.text_id, r.pos, r.size FROM stretches r JOIN firsts f USING (content) WHERE (r.ord, r.text_id, r.pos) > f.src),
gone AS (SELECT l.ord, l.text_id, list(DISTINCT l.raw) AS raws FROM later x JOIN lines l ON l.ord = x.ord AND l.text_id = x.text_id AND l.pos >= x.pos AND l.pos < x.pos + x.size GROUP BY l.ord, l.text_id),
cleaned AS (SELECT k.doc_id, len(string_split(coalesce(k.text, ''), chr(10))) AS n_lines, coalesce(len(g.raws), 0) AS n_removed,
  CASE WHEN g.raws IS NULL THEN k.text ELSE array_to_string(list_filter(string_split(k.text, chr(10)), lambda x, i: NOT list_contains(g.raws, i - 1)), chr(10)) END AS text FROM keyed k LEFT JOIN gone g ON k.ord = g.ord AND k.text_id = g.text_id)"""
OP4_SQL = "WITH " + ALL_RUNS_SQL.format(docs="documents") + " SELECT doc_id, CAST(n_lines AS BIGINT) AS n_lines, CAST(n_removed AS BIGINT) AS n_removed, md5(coalesce(text, '')) AS text_md5 FROM cleaned"
