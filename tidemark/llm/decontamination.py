"""Benchmark decontamination by winnowing.

A word is a run of ASCII letters and digits and of other characters beyond
ASCII, with A-Z lower-cased. Of the grams of ``GRAM`` words of a text the one
with the smallest hash in each window of ``SPAN`` words is a fingerprint (the
last of equals). A span of ``SPAN`` words that a document shares with an item
is such a window on both sides, so both select the same gram of it: every
shared span meets in a fingerprint. Fingerprints are joined, gram and words,
and each meeting is extended both ways word by word, as far as a window that
holds the gram may reach; what reaches ``SPAN`` words is hit. An item of fewer
words is its own fingerprint, and is looked up at every place.

Scale: documents are read once. A bitmap of the benchmark's fingerprints, of
bounded size, goes with the scan, and only the grams that are in it are written,
with the words around them; the join, its extension and the grouping by document
are on those rows alone. A fuller bitmap lets more rows pass at the same
results. The benchmark's side is a table, broadcast only where Spark finds it
small; adaptive execution splits a hot fingerprint. Documents without any row
are not shuffled.

Defined cases: a null or blank text has no words and is not contaminated; rows
that repeat doc_id, or all of a row, get one result each; items without words
take no part; rows of one item_id are one item with the windows of each; an
item without id hits words and isn't counted; a text that repeats a window is
hit at each place; an empty benchmark hits nothing; an empty table gives no
rows; other columns are not used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.llm.common import materialise, table
from tidemark.llm.tokens import IN_TERM, LOWER, Words, chain, chunks, signed

#: Words of a window, and of a gram.
SPAN, GRAM = 10, 5
#: The bitmap has BITS_EACH bits a fingerprint, as a power of two between these.
BITS_EACH, LEAST_BITS, MOST_BITS = 256, 1 << 22, 1 << 27
#: Rows of fingerprints in a batch.
BATCH = 4096

PRINT_FIELDS = "pos int, print long, need int, gram string, left array<string>, right array<string>"
_PRINT_ARROW = [("pos", pa.int32()), ("print", pa.int64()), ("need", pa.int32()), ("gram", pa.string()), ("left", pa.list_(pa.string())), ("right", pa.list_(pa.string()))]


def winnowed(grams: np.ndarray, ends: np.ndarray, span: int = SPAN, gram: int = GRAM) -> np.ndarray:
    """Places of the selected grams; ends[i] is the end of the text that word i is in."""
    width = span - gram + 1
    n = len(grams) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    least, at = grams[:n].copy(), np.zeros(n, np.int64)
    for j in range(1, width):
        other = grams[j : j + n]
        lower = other <= least
        least[lower] = other[lower]
        at[lower] = j
    begins = np.arange(n)
    inside = begins + span <= ends[:n]
    chosen = np.zeros(len(grams), bool)
    chosen[(begins + at)[inside]] = True
    return np.flatnonzero(chosen)


class Terms:
    """Terms of a piece of text, with the end of the text of each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.words = Words(data, offsets, IN_TERM)
        self.hashes = self.words.hashes(lower=True)
        self.ends = self.words.first[1:][self.words.doc]

    def prints(self, need: int) -> tuple[np.ndarray, np.ndarray]:
        """Place and hash of the fingerprints for windows of SPAN words, or of every run of fewer."""
        grams = chain(self.hashes, min(need, GRAM) if need == SPAN else need)
        if need == SPAN:
            at = winnowed(grams, self.ends)
        else:
            at = np.flatnonzero(np.arange(len(grams)) + need <= self.ends[: len(grams)])
        return at, grams[at]

    def rows(self, at: np.ndarray, prints: np.ndarray, need: int) -> Iterator[list]:
        """Columns of PRINT_FIELDS, in batches."""
        size, reach = (GRAM, SPAN - GRAM) if need == SPAN else (need, 0)
        first, lowered = self.words.first, LOWER[self.words.data]
        for a in range(0, len(at), BATCH):
            here = at[a : a + BATCH]
            begin, end = first[self.words.doc[here]], self.ends[here]
            low, high = np.maximum(begin, here - reach), np.minimum(end, here + size + reach)
            text = {}
            for lo, hi in zip(low.tolist(), high.tolist()):
                for i in range(lo, hi):
                    if i not in text:
                        s = self.words.starts[i]
                        text[i] = lowered[s : s + self.words.lengths[i]].tobytes().decode("utf-8", "replace")
            spans = list(zip(low.tolist(), here.tolist(), high.tolist()))
            yield [
                here,
                pa.array((here - begin).astype(np.int32)),
                pa.array(signed(prints[a : a + BATCH])),
                pa.array(np.full(len(here), need, np.int32)),
                pa.array([" ".join(text[i] for i in range(p, p + size)) for _, p, _ in spans], pa.string()),
                pa.array([[text[i] for i in range(p - 1, lo - 1, -1)] for lo, p, _ in spans], pa.list_(pa.string())),
                pa.array([[text[i] for i in range(p + size, hi)] for _, p, hi in spans], pa.list_(pa.string())),
            ]


def item_prints(benchmark: DataFrame) -> DataFrame:
    """item_id (as a string) and the fingerprints of every item, as a table."""

    def found(batches):
        for batch in batches:
            for at, to, data, offsets in chunks(batch.column("text")):
                ids, terms = batch.column("item_id").slice(at, to - at), Terms(data, offsets)
                counts = terms.words.counts
                for need in np.unique(np.minimum(counts[counts > 0], SPAN)).tolist():
                    places, prints = terms.prints(need)
                    own = np.minimum(counts[terms.words.doc[places]], SPAN) == need
                    for here, *columns in terms.rows(places[own], prints[own], need):
                        yield pa.RecordBatch.from_arrays([ids.take(pa.array(terms.words.doc[here])), *columns], names=["item_id", *[n for n, _ in _PRINT_ARROW]])

    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").mapInArrow(found, "item_id string, " + PRINT_FIELDS)
    return materialise(rows.drop("pos").distinct(), "benchmark-prints")


def bitmap(index: DataFrame) -> np.ndarray:
    """Bits of the fingerprints' leading bits, as 64-bit words: MOST_BITS / 8 bytes at most."""
    bits = LEAST_BITS
    while bits < min(MOST_BITS, BITS_EACH * index.count()):
        bits *= 2
    slot = F.expr(f"shiftrightunsigned(print, {64 - bits.bit_length() + 1})")
    words = index.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(slot & 63 AS int)))").alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return out


def may_be_in(bits: np.ndarray, prints: np.ndarray) -> np.ndarray:
    slot = prints >> np.uint64(64 - (len(bits) * 64).bit_length() + 1)
    return (bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) != 0


def document_prints(docs: DataFrame, index: DataFrame) -> DataFrame:
    """A row (row, doc_id, n_words, n_found) for each document, and one for each fingerprint that the bitmap has, as a table."""
    needs = sorted(r.need for r in index.select("need").distinct().collect())  # at most SPAN
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(index))
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    schema = StructType([*numbered.select("row", "doc_id").schema.fields, *StructType.fromDDL("n_words long, n_found long, " + PRINT_FIELDS).fields])

    def found(batches):
        bits = shared.value
        for batch in batches:
            names = ["row", "doc_id", "n_words", "n_found", *[n for n, _ in _PRINT_ARROW]]
            id_type = batch.column("doc_id").type
            for at, to, data, offsets in chunks(batch.column("text")):
                row, terms = batch.column("row").slice(at, to - at), Terms(data, offsets)
                n_found = np.zeros(to - at, np.int64)
                for need in needs:
                    places, prints = terms.prints(need)
                    there = may_be_in(bits, prints)
                    places, prints = places[there], prints[there]
                    n_found += np.bincount(terms.words.doc[places], minlength=to - at)
                    for here, *columns in terms.rows(places, prints, need):
                        none = [pa.nulls(len(here), t) for t in (id_type, pa.int64(), pa.int64())]
                        yield pa.RecordBatch.from_arrays([row.take(pa.array(terms.words.doc[here])), *none, *columns], names=names)
                rest = [pa.nulls(to - at, t) for _, t in _PRINT_ARROW]
                yield pa.RecordBatch.from_arrays([row, batch.column("doc_id").slice(at, to - at), pa.array(terms.words.counts.astype(np.int64)), pa.array(n_found), *rest], names=names)

    return materialise(numbered.mapInArrow(found, schema), "document-prints")


def in_common(a: Column, b: Column, most: int) -> Column:
    """How many leading elements two arrays share, of the first most."""
    alike = [(F.size(a) >= t) & (F.size(b) >= t) & (F.slice(a, 1, t) == F.slice(b, 1, t)) for t in range(1, most + 1)]
    return sum((x.cast("int") for x in alike[1:]), alike[0].cast("int"))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, spans and items of every document.

    spans holds (start, stop) word places that equal a span of an item, sorted;
    they may overlap. items are the ids of the items, as sorted strings.
    """
    index = item_prints(benchmark)
    found = document_prints(docs, index)
    theirs = index.select("item_id", "print", "need", "gram", F.col("left").alias("item_left"), F.col("right").alias("item_right"))
    size, reach = F.when(F.col("need") == SPAN, GRAM).otherwise(F.col("need")), SPAN - GRAM
    met = (
        found.filter("print IS NOT NULL")
        .join(theirs, ["print", "need", "gram"])
        .withColumns({"before": in_common(F.col("left"), F.col("item_left"), reach), "after": in_common(F.col("right"), F.col("item_right"), reach)})
        .filter(F.col("before") + size + F.col("after") >= F.col("need"))
        .select("row", "item_id", F.struct((F.col("pos") - F.col("before")).alias("start"), (F.col("pos") + size + F.col("after")).alias("stop")).alias("span"))
    )
    hits = met.groupBy("row").agg(F.array_sort(F.collect_set("span")).alias("spans"), F.array_sort(F.collect_set("item_id")).alias("items"))
    every = found.filter("n_found IS NOT NULL")
    none = every.filter("n_found = 0").select("doc_id", "n_words", F.lit(None).cast(hits.schema["spans"].dataType).alias("spans"), F.lit(None).cast("array<string>").alias("items"))
    some = every.filter("n_found > 0").join(hits, "row", "left").select("doc_id", "n_words", "spans", "items")
    spans, items = F.coalesce("spans", F.expr("cast(array() AS array<struct<start:int,stop:int>>)")), F.coalesce("items", F.expr("cast(array() AS array<string>)"))
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("to")),
        lambda a, s: F.struct((a["n"] + F.greatest(F.lit(0), s["stop"] - F.greatest(a["to"], s["start"]))).alias("n"), F.greatest(a["to"], s["stop"]).alias("to")),
        lambda a: a["n"],
    )
    return none.unionByName(some).withColumns({"spans": spans, "items": items}).select("doc_id", "n_words", covered.alias("n_hit"), "spans", "items")


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the documents of which a word is hit, by doc_id (rows without id: by their text); columns as in docs."""
    name = F.to_json(F.struct("doc_id", F.when(F.col("doc_id").isNull(), F.xxhash64("text")).alias("text")))
    hit = contamination(docs.select(name.alias("doc_id"), "text"), benchmark).filter("n_hit > 0").select(F.col("doc_id").alias("hit")).distinct()
    whole = docs.select(F.struct(*docs.columns).alias("doc"), name.alias("name"))
    return whole.join(hit, F.col("name") == F.col("hit"), "left_anti").select("doc.*")


def op11_decontamination(spark, sf_dir: str) -> DataFrame:
    out = contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text"))
    listed = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), listed.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _runs(rows: str) -> str:
    """Every run of 1 to 10 words of the rows (r, p, word) whose length some item has."""
    joined = lambda n: " || ' ' || ".join(["word", *[f"lead(word, {i}) OVER d" for i in range(1, n)]])
    return " UNION ALL ".join(f"SELECT r, p, {n} AS n, {joined(n)} AS win FROM {rows} WHERE {n} IN (SELECT n FROM lengths) WINDOW d AS (PARTITION BY r ORDER BY p)" for n in range(1, SPAN + 1))


#: Every window of every text, joined.
OP11_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS words FROM documents),
i AS (SELECT row_number() OVER () AS r, item_id, {_TERMS} AS words FROM benchmark),
lengths AS (SELECT DISTINCT least(len(words), {SPAN}) AS n FROM i WHERE len(words) > 0),
doc_words AS (SELECT r, unnest(words) AS word, unnest(range(len(words))) AS p FROM d),
item_words AS (SELECT r, unnest(words) AS word, unnest(range(len(words))) AS p FROM i),
doc_runs AS ({_runs("doc_words")}),
item_runs AS ({_runs("item_words")}),
windows AS (SELECT DISTINCT i.item_id, w.n, w.win FROM item_runs w JOIN i USING (r) WHERE w.win IS NOT NULL AND w.n = least(len(i.words), {SPAN})),
hits AS (SELECT x.r, x.p, x.n, w.item_id FROM doc_runs x JOIN windows w ON x.n = w.n AND x.win = w.win),
hit_words AS (SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest(range(p, p + n)) AS q FROM (SELECT DISTINCT r, p, n FROM hits)) GROUP BY r),
items AS (SELECT r, count(DISTINCT item_id) AS n, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM hits GROUP BY r)
SELECT doc_id, len(words) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(s.n, 0) AS n_items, sha256(coalesce(s.ids, '')) AS items_sha256, h.n IS NOT NULL AS contaminated
FROM d LEFT JOIN hit_words h ON d.r = h.r LEFT JOIN items s ON d.r = s.r"""
