"""Jaccard join of word n-gram sets with skipping by set relations.

A document's set is its distinct shingles of five words, lower-cased A-Z, each
as a 64-bit hash. Two documents link when 100 * |A and B| >= 75 * |A or B|.
Equal sets are one class and enter once. The steps:

1. A pass over all texts gives each document's set size and set id, and
   counts shingles inside windows of a task's documents; the shingles with the
   largest summed counts (at most ``frequent``, found by a threshold on the
   counts' histogram) go to the end of the global order. The order decides the
   cost only: any order gives the same links.
2. A second pass emits each distinct set's prefix: the first
   n - ceil(0.75 n) + 1 shingles in that order, with position and size. Two
   sets that link share one at which the positional bound holds.
3. The index lists, sorted by size and set id, are read as a stream. The first
   set of each size range of a list is its pivot; the other sets are candidates
   of the pivot only, and those at positions that the bound excludes are
   skipped. Very frequent shingles have their list split over several cells,
   whose pivots meet in turn.
4. Candidate pairs are verified with whole sets. A set that links with its
   pivot is highly similar to it and takes over its answers: it belongs to the
   pivot's component, and a list that lies in one component is finished.
5. The lists that hold several components still are tried with one more pivot,
   the set most like the others; then the pairs of their sets in different
   components that pass the size and position bounds in some list, and share
   enough prefix shingles, are verified, so no link that could join two
   components is lost.
6. Components of the links are spread to classes and to documents.

Scale: texts are read three times and tokenised in Arrow batches; only prefix
entries (about a quarter of the shingles) are shuffled. A set's text is fetched
again only for candidates. What is broadcast is bounded: ``frequent`` hashes
and a filter of ``FILTER_BITS`` bits. All state is in the shared folder.

Defined cases: a null, empty or blank text has an empty set and links with
nothing; fewer than five words are one shingle; repeated rows are equal sets;
rows with a null doc_id count as id 2^63 - 1, and their component_id is null
if no other id is in it; an empty table gives no rows; other columns are
not used. Very long texts are whole sets like any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import MAX_LONG, materialise, most_frequent, release, table
from tidemark.llm.components import components
from tidemark.llm.tokens import Words, chunks, mix, shingle_sets, signed

WORDS_PER_SHINGLE = 5
PERCENT = 75
#: Upper bound on the shingles that the order puts last, and so on that broadcast.
FREQUENT = 1 << 20
#: Shingles counted together before their counts are handed on.
COUNT_WINDOW = 4_000_000
#: A list expected to be longer is split over cells of about this many sets.
CELL = 20_000
FILTER_BITS = 1 << 23


def set_id(s: np.ndarray) -> int:
    """63 bits that name a set of shingles."""
    folded = int(np.bitwise_xor.reduce(mix(s))) + int(s.sum(dtype=np.uint64)) + len(s) * 0x9E3779B97F4A7C15
    return int(mix(np.array([folded % 2**64], np.uint64))[0]) >> 1


def check_id(s: np.ndarray) -> int:
    """64 other bits of a set of shingles."""
    return int(signed(mix(s + np.uint64(0xD1B54A32D192ED03)).sum(dtype=np.uint64, keepdims=True))[0])


def name_of(s: np.ndarray, clashes: dict[int, dict[int, int]]) -> int:
    """The set's id; of sets with equal ids all but one have another."""
    sid = set_id(s)
    return clashes[sid].get(check_id(s), sid) if sid in clashes else sid


def batch_sets(batch: pa.RecordBatch, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, set) for each row of a batch with a text column."""
    for at, _, data, offsets in chunks(batch.column("text")):
        words = Words(data, offsets)
        for i, s in enumerate(shingle_sets(words, words.hashes(lower=True), k)):
            yield at + i, s


def set_facts(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, n, sid and a check of each document, and in rows without n a shingle with its count among a window of distinct sets."""

    def facts(batches):
        pool, pooled, seen = [], 0, set()

        def counted():
            every, n = np.unique(np.concatenate(pool), return_counts=True)
            often = n > 1
            return pa.RecordBatch.from_arrays([pa.nulls(often.sum(), pa.int64()), pa.nulls(often.sum(), pa.int32()), pa.array(signed(every[often])), pa.nulls(often.sum(), pa.int64()), pa.array(n[often].astype(np.int32))], names=["doc_id", "n", "sid", "check", "times"])

        for batch in batches:
            sizes, ids, checks = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for row, s in batch_sets(batch, k):
                sizes[row], ids[row], checks[row] = len(s), (sid := set_id(s)), check_id(s)
                if sid not in seen:
                    seen.add(sid)
                    pool.append(s)
                    pooled += len(s)
                    if pooled >= COUNT_WINDOW:
                        yield counted()
                        pool, pooled, seen = [], 0, set()
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes), pa.array(ids), pa.array(checks), pa.nulls(batch.num_rows, pa.int32())], names=["doc_id", "n", "sid", "check", "times"])
        if pool:
            yield counted()

    return docs.mapInArrow(facts, "doc_id long, n int, sid long, check long, times int")


def clashing(sized: DataFrame) -> dict[int, dict[int, int]]:
    """Of different sets with one id, the further ones' new ids by id and check.

    Of N sets some N * N / 2^64 pairs clash: none at 10^9, five at 10^10.
    """
    several = sized.groupBy("sid").agg(F.min("check").alias("_first"), F.max("check").alias("_last")).filter("_first <> _last")
    further = sized.join(several, "sid").filter("check <> _first").select("sid", "check").distinct()
    out: dict[int, dict[int, int]] = {}
    for sid, check in further.collect():
        out.setdefault(sid, {})[check] = int(mix(np.array([check], np.int64).view(np.uint64))[0]) >> 1
    return out


def frequent_shingles(facts: DataFrame, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (sorted, unsigned) and counts of the most frequent shingles, at most bound of them."""
    counts = materialise(facts.filter("n IS NULL").groupBy(F.col("sid").alias("h")).agg(F.sum("times").alias("times")), "shingle-counts")
    found = most_frequent(counts, "h", "times", bound)
    release(counts)
    hashes, times = found["h"].to_numpy().view(np.uint64), found["times"].to_numpy()
    order = np.argsort(hashes)
    return hashes[order], times[order]


def prefix_entries(docs: DataFrame, k: int, percent: int, frequent: tuple[np.ndarray, np.ndarray], clashes: dict, cell: int = CELL) -> DataFrame:
    """h, salt, sid and place (size << 32 | position) of every prefix shingle of every distinct set.

    salt is the cell of a list that is split, -1 where it isn't.
    """
    shared = docs.sparkSession.sparkContext.broadcast((*frequent, clashes))

    def entries(batches):
        last, times, clashes = shared.value
        rank = np.empty(len(last), np.int64)
        rank[np.lexsort((last, times))] = np.arange(len(last))
        seen: set[int] = set()
        names = ["h", "salt", "sid", "place"]

        def handed_on(*columns):
            h, salt, ids, places = (np.concatenate(c) for c in columns)
            return pa.RecordBatch.from_arrays([pa.array(signed(h)), pa.array(salt), pa.array(ids), pa.array(places)], names=names)

        for batch in batches:
            hashes, salts, ids, places, held = [], [], [], [], 0
            for _, s in batch_sets(batch, k):
                sid, n = name_of(s, clashes), len(s)
                if not n or sid in seen:
                    continue
                if len(seen) > 500_000:
                    seen.clear()
                seen.add(sid)
                at = np.searchsorted(last, s)
                is_last = last[np.minimum(at, len(last) - 1)] == s if len(last) else np.zeros(n, bool)
                length = n - (percent * n + 99) // 100 + 1
                rare, common = s[~is_last], at[is_last]
                common = common[np.argsort(rank[common])][: max(0, length - len(rare))]
                h = np.concatenate([rare[:length], last[common]])
                salt = np.full(len(h), -1, np.int32)
                if len(common):
                    cells = times[common] // cell + 1
                    salt[len(h) - len(common) :] = np.where(cells > 1, sid % cells, -1)
                hashes.append(h)
                salts.append(salt)
                ids.append(np.full(len(h), sid, np.int64))
                places.append((n << 32) + np.arange(len(h), dtype=np.int64))
                held += len(h)
                if held > 500_000:
                    yield handed_on(hashes, salts, ids, places)
                    hashes, salts, ids, places, held = [], [], [], [], 0
            if held:
                yield handed_on(hashes, salts, ids, places)

    return docs.select("text").mapInArrow(entries, "h long, salt int, sid long, place long")


def shared_lists(entries: DataFrame, percent: int) -> DataFrame:
    """The entries of lists with two sets or more, each with its pivot's sid and place; split tells that the list has several cells, leads that the set is the first of a whole list and so its size range the first, two that the list has no third set."""

    def with_pivots(batches):
        held = None  # the first entry of a list of which no second has come
        list_id = sid = pivot = pivot_place = None  # of the entry before
        for batch in batches:
            c, z, s, p = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("h", "salt", "sid", "place"))
            if held is not None:
                c, z, s, p = (np.concatenate([np.array([h], x.dtype), x]) for h, x in zip(held, (c, z, s, p)))
            if not len(c):
                continue
            goes_on = held is None and list_id is not None
            new = np.ones(len(c), bool)
            new[1:] = (c[1:] != c[:-1]) | (z[1:] != z[:-1])
            again = np.zeros(len(c), bool)
            again[1:] = ~new[1:] & (s[1:] == s[:-1])
            if goes_on and (c[0], z[0]) == list_id:
                new[0], again[0] = False, s[0] == sid
            c, z, s, p, new = c[~again], z[~again], s[~again], p[~again], new[~again]
            held = None
            if not len(c):
                continue
            size, first = p >> 32, new.copy()
            while True:  # the first of each list, and the first that is too large for the pivot before it
                at = np.maximum.accumulate(np.where(first, np.arange(len(c)), -1))
                of_size = np.where(at >= 0, size[at], pivot_place >> 32 if pivot_place is not None else 0)
                over = np.flatnonzero(percent * size > 100 * of_size)
                over = over[~first[over]]
                if not len(over):
                    break
                _, leading = np.unique(at[over], return_index=True)
                first[over[leading]] = True
            piv, piv_place = np.where(at >= 0, s[at], pivot if pivot is not None else 0), np.where(at >= 0, p[at], pivot_place if pivot_place is not None else 0)
            starts = np.flatnonzero(new)
            length = np.append(starts[1:], len(c)) - starts
            lone, two = np.zeros(len(c), bool), np.zeros(len(c), bool)
            lone[starts] = length == 1
            whole = starts[:-1][length[:-1] == 2]  # the last list may go on
            two[whole] = two[whole + 1] = True
            is_split = z >= 0
            if lone[-1] and not is_split[-1]:
                held = (c[-1], z[-1], s[-1], p[-1])
            out = ~lone | is_split
            list_id, sid, pivot, pivot_place = (c[-1], z[-1]), s[-1], piv[-1], piv_place[-1]
            yield pa.RecordBatch.from_arrays([pa.array(x[out]) for x in (c, s, p, piv, piv_place, is_split, new & ~is_split, two & ~is_split)], names=["h", "sid", "place", "pivot", "pivot_place", "split", "leads", "two"])

    return entries.repartition("h", "salt").sortWithinPartitions("h", "salt", F.shiftright("place", 32), "sid").mapInArrow(with_pivots, "h long, sid long, place long, pivot long, pivot_place long, split boolean, leads boolean, two boolean")


def bounds(a: str, b: str, percent: int) -> Column:
    """Whether two sets that share the shingles at places a and b may link, by their sizes and what follows there."""
    n, m = F.shiftright(a, 32), F.shiftright(b, 32)
    rest = F.least(n - F.col(a).bitwiseAND(F.lit(0xFFFFFFFF)), m - F.col(b).bitwiseAND(F.lit(0xFFFFFFFF)))
    return (percent * n <= 100 * m) & (percent * m <= 100 * n) & ((100 + percent) * rest >= percent * (n + m))


def whole_sets(docs: DataFrame, chosen: DataFrame, k: int, clashes: dict) -> DataFrame:
    """sid and shingles of the chosen sids, from the text of each class's smallest doc_id, rep."""
    words = chosen.groupBy((F.pmod("rep", F.lit(FILTER_BITS)) / 64).cast("int").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(pmod(rep, 64) AS INT))")).alias("bits")).toArrow()
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    bits[words["w"].to_numpy()] = words["bits"].to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast((bits, clashes))

    def sets(batches):
        bits, clashes = shared.value
        for batch in batches:
            ids = batch.column("doc_id").fill_null(MAX_LONG).to_numpy()
            slot = (ids % FILTER_BITS).astype(np.int64)
            batch = batch.filter(pa.array((bits[slot >> 6] >> (slot & 63) & 1).astype(bool)))
            ids = batch.column("doc_id").fill_null(MAX_LONG)
            found = [(name_of(s, clashes), s) for _, s in batch_sets(batch, k)]
            lengths = np.concatenate([[0], np.cumsum([len(s) for _, s in found])]).astype(np.int32)
            values = signed(np.concatenate([s for _, s in found])) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([ids, pa.array([x for x, _ in found], pa.int64()), pa.ListArray.from_arrays(pa.array(lengths), pa.array(values))], names=["rep", "sid", "shingles"])

    return docs.select("doc_id", "text").mapInArrow(sets, "rep long, sid long, shingles array<long>").dropDuplicates(["sid"]).select("sid", "shingles")


def verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame, k: int, percent: int, clashes: dict) -> DataFrame:
    """a, b and whether they link, for each candidate pair(a, b)."""
    chosen = materialise(pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct().join(classes, "sid").select("sid", "rep"), "wanted-sets")
    sets = whole_sets(docs, chosen, k, clashes)
    left, right = sets.select(F.col("sid").alias("a"), F.col("shingles").alias("_a")), sets.select(F.col("sid").alias("b"), F.col("shingles").alias("_b"))
    both = pairs.join(right, "b").join(left, "a")
    common = F.size(F.array_intersect("_a", "_b"))
    out = materialise(both.select("a", "b", (100 * common >= percent * (F.size("_a") + F.size("_b") - common)).alias("links")), "verified")
    release(chosen, pairs)
    return out


def open_lists(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """h, sid, place and label of the lists that hold sets of several components, and more than the two that were compared already."""
    placed = lists.select("h", "sid", "place").join(labels.withColumnRenamed("node", "sid"), "sid", "left").withColumn("label", F.coalesce("label", "sid")).repartition("h")
    several = placed.groupBy("h").agg(F.min("label").alias("_lo"), F.max("label").alias("_hi"), F.count(F.lit(1)).alias("_n")).filter("_lo <> _hi AND _n > 2").select("h")
    return materialise(placed.join(several, "h"), "open-lists")


def ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def met_pairs(met: DataFrame, percent: int) -> DataFrame:
    """The pairs a, b of met(a, a_place, b, b_place), a row for each list in which the two met: in how many (common), their sizes, and whether the bounds hold in one of them (near)."""
    size = lambda place: F.max(F.shiftright(place, 32))
    return met.groupBy("a", "b").agg(F.count(F.lit(1)).alias("common"), F.max(bounds("a_place", "b_place", percent)).alias("near"), size("a_place").alias("n"), size("b_place").alias("m"))


def enough(common: Column, percent: int) -> Column:
    """Whether sets of n and m shingles, of which so many at most are in both prefixes, may link; other common shingles lie behind the prefix of one of the two."""
    behind = F.ceil(F.lit(percent) * F.greatest("n", "m") / F.lit(100)) - 1
    return (100 + percent) * (common + behind) >= percent * (F.col("n") + F.col("m"))


def first_stars(lists: DataFrame, percent: int) -> DataFrame:
    """Pairs a, b of a pivot and a set of its lists that may link, by the common prefix shingles of those lists and all lists in which a leads nobody.

    A pair that isn't near may have its first common shingle in a list in which
    the two did not meet. It is doubtful: not compared now but kept, as later
    steps don't see the lists of two sets, which count into its common.
    """
    unmet = lists.filter("NOT leads").groupBy(F.col("sid").alias("a")).agg(F.count(F.lit(1)).alias("_unmet"))
    met = lists.filter(F.col("sid") != F.col("pivot")).select(F.col("pivot").alias("a"), F.col("pivot_place").alias("a_place"), F.col("sid").alias("b"), F.col("place").alias("b_place"))
    more = F.coalesce("_unmet", F.lit(0))
    return met_pairs(met, percent).join(unmet, "a", "left").filter(enough(F.col("common") + more, percent) & (F.col("near") | (more > 0))).select("a", "b", "common", (~F.col("near")).alias("doubtful"))


def later_stars(lists: DataFrame, percent: int) -> DataFrame:
    """Pairs of each open list's pivot with the list's sets in other components.

    The pivot is the set with the largest share of its size in open lists, the
    one most like the others, in one order for all lists: so the lists of one
    group have mostly the same pivot.
    """
    common = lists.groupBy("sid").agg(F.count(F.lit(1)).alias("_lists"))
    ranked = lists.join(common, "sid").withColumn("_order", -F.col("_lists") / F.shiftright("place", 32))
    pivots = ranked.groupBy("h").agg(F.min(F.struct("_order", "sid", "place", "label")).alias("p")).select("h", F.col("p.sid").alias("a"), F.col("p.place").alias("a_place"), F.col("p.label").alias("a_label"))
    led = pivots.groupBy("a").agg(F.count(F.lit(1)).alias("_led"))
    unmet = common.withColumnRenamed("sid", "a").join(led, "a").select("a", (F.col("_lists") - F.col("_led")).alias("_unmet"))
    met = lists.select("h", F.col("sid").alias("b"), F.col("place").alias("b_place"), "label").join(pivots, "h").filter(F.col("a_label") != F.col("label")).select("a", "a_place", "b", "b_place")
    return met_pairs(met, percent).join(unmet, "a").filter(F.col("near") & enough(F.col("common") + F.col("_unmet"), percent)).select("a", "b")


def all_across(lists: DataFrame, percent: int) -> DataFrame:
    """Pairs of sets of one list that are in different components still and pass the bounds there.

    The join's condition has the bounds, so pairs that only share a passage are
    never made: where it is frequent it stands late in their order.
    """
    side = lambda x: lists.select("h", F.col("sid").alias(x), F.col("place").alias(f"{x}_place"), F.col("label").alias(f"{x}_label"))
    return side("a").join(side("b"), "h").filter((F.col("a") < F.col("b")) & (F.col("a_label") != F.col("b_label")) & bounds("a_place", "b_place", percent)).select("a", "b")


def sharing_enough(pairs: DataFrame, lists: DataFrame, doubtful: DataFrame, percent: int) -> DataFrame:
    """Of the pairs a, b those that may link by how many open lists they share; doubtful(a, b, common) has what to add for lists of two.

    A set's open lists are at most its prefix, so each pair meets in one row.
    """
    held = lists.groupBy("sid").agg(F.collect_list("h").alias("_lists"), F.max(F.shiftright("place", 32)).alias("_size"))
    side = lambda x, n: held.select(F.col("sid").alias(x), F.col("_lists").alias(f"_{x}"), F.col("_size").alias(n))
    both = pairs.join(side("b", "m"), "b").join(side("a", "n"), "a").withColumn("common", F.size(F.array_intersect("_a", "_b"))).select("a", "b", "n", "m", "common")
    return both.join(doubtful.withColumnRenamed("common", "_more"), ["a", "b"], "left").filter(enough(F.col("common") + F.coalesce("_more", F.lit(0)), percent)).select("a", "b")


def link_classes(docs: DataFrame, k: int = WORDS_PER_SHINGLE, percent: int = PERCENT, frequent: int = FREQUENT, cell: int = CELL) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents with n and sid; classes with sid and rep; node and label of each sid that links)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    facts = materialise(set_facts(docs, k), "set-facts")
    sized = facts.filter("n IS NOT NULL").select("doc_id", "n", "sid", "check")
    clashes = clashing(sized)
    if clashes:
        renamed = docs.sparkSession.createDataFrame([(sid, check, new) for sid, of in clashes.items() for check, new in of.items()], "sid long, check long, _new long")
        sized = sized.join(renamed, ["sid", "check"], "left").withColumn("sid", F.coalesce("_new", "sid"))
    classes = materialise(sized.filter("n > 0").groupBy("sid").agg(F.min(F.coalesce("doc_id", F.lit(MAX_LONG))).alias("rep")), "classes")
    often = frequent_shingles(facts, frequent)
    lists = materialise(shared_lists(prefix_entries(docs, k, percent, often, clashes, cell), percent), "lists")

    pivots = lists.filter("split").select("h", F.col("pivot").alias("sid"), F.col("pivot_place").alias("place")).distinct()
    top = pivots.groupBy("h").agg(F.min(F.struct("place", "sid")).alias("top"))
    over_cells = pivots.join(top, "h").filter("sid <> top.sid").select("h", "sid", "place", F.col("top.sid").alias("pivot"), F.col("top.place").alias("pivot_place")).filter(bounds("place", "pivot_place", percent)).select(F.col("pivot").alias("a"), F.col("sid").alias("b"))
    stars = materialise(first_stars(lists, percent), "stars")
    doubtful = stars.filter("doubtful").groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("common").alias("common"))
    known = verified(docs, classes, materialise(ordered(stars.filter("NOT doubtful").select("a", "b").union(over_cells)), "candidates"), k, percent, clashes)
    labels = components(known.filter("links"))
    rest = open_lists(lists.filter("NOT two"), labels)
    done = [stars, lists, known]
    for last in (False, True):
        pairs = all_across(rest, percent) if last else later_stars(rest, percent)
        pairs = ordered(pairs).join(known, ["a", "b"], "left_anti")
        pairs = materialise(sharing_enough(pairs, rest, doubtful, percent) if last else pairs, "candidates")
        more = verified(docs, classes, pairs, k, percent, clashes)
        known = known.union(more)
        done += [more, rest]
        if not more.filter("links").isEmpty():
            labels = components(known.filter("links"))
            rest = rest if last else open_lists(rest, labels)
    release(*done)
    return sized, classes, labels


def jaccard_components(docs: DataFrame, **options) -> DataFrame:
    """A row per document: doc_id, n_shingles, set_id and component_id."""
    sized, classes, labels = link_classes(docs, **options)
    named = classes.join(labels.withColumnRenamed("node", "sid"), "sid", "left").select("sid", "rep", F.coalesce("label", "sid").alias("label"))
    smallest = named.groupBy("label").agg(F.min("rep").alias("component_id"))
    of_class = materialise(named.join(smallest, "label").select(F.col("sid").alias("_sid"), F.nullif("component_id", F.lit(MAX_LONG)).alias("component_id")), "class-components")
    return sized.join(of_class, (F.col("sid") == F.col("_sid")) & (F.col("n") > 0), "left").select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.col("sid").alias("set_id"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """docs with the document of smallest doc_id of each component only; repeated rows once; columns as in docs."""
    first = jaccard_components(docs, **options).filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_first")).distinct()
    return docs.join(first, docs["doc_id"].cast("long").eqNullSafe(first["_first"]), "left_semi").dropDuplicates(["doc_id", "text"])


def op1_ngram_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))
