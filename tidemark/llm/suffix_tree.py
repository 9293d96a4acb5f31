"""Language-model scoring with a probabilistic suffix tree over words.

Tokens are lower-cased words and one end for each text. The root is the
add-0.1 unigram distribution. Contexts of one to ``DEPTH`` words are candidates
if they occur ``MIN_COUNT`` times or more, whatever the number of tokens, and
are kept as states if some next token passes the divergence test: it follows
``MIN_FOLLOW`` times or more and its smoothed share differs from that after the
shorter context by a factor of ``RATIO`` or more. A state gives each such next
token a share smoothed towards the shorter context's, and leaves the rest of
its mass to that context's distribution, so that every state sums to one. A
token is scored in the state of the longest suffix of its history that was kept.

A score is a sum of effects: each state on the way to the longest multiplies
the share of the token by what it leaves to the shorter context, or, if the
token is one of its own, by the ratio of the two shares.

Scale: words are counted for each task and summed by one shuffle. Then each
place that follows a candidate word goes, with up to ``DEPTH`` words before it,
once to the bucket of the word just before it: all contexts that end in that
word, and their next tokens, are counted, tested and scored there, the shorter
first, so neither contexts nor effects are written anywhere, and what is
shuffled follows the number of tokens. A bucket answers with a sum for each
text of a window, and a grouping by window adds these to what the texts know.
Places go packed by window and bucket, a word as its number among the bucket's
words, and these as ranks among the ``HEAD`` most frequent words, which are
broadcast, or as hashes; equal places of a text with a frequent pair of words go as one.
The places after a word that occurs over ``SPLIT`` times in training are dealt to
several buckets by the word before it, so that longer contexts stay whole. The
next tokens of that word alone are counted by bucket of the next token, in a pass
over the texts before, which asks for the counts of words that aren't broadcast, too.
Bitmaps of at most ``BITS`` bits, broadcast, spare the shuffle rare words;
what they let through by chance is counted exactly. Neither vocabulary nor
states nor scores pass through the driver, only sums for each such frequent word.

``grow`` makes the same states as tables, a pass and some joins for each length.

Defined cases: a null text is empty and has its end as only token; a null
doc_id counts as an empty text in the fold and is so held out; repeated rows
are counted each and scored each; with no training text every count is 0 and
N = V = 0; an empty table gives no rows; other columns are not used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import dropping_shuffles, materialise, most_frequent, release, table
from tidemark.llm.tokens import Words, chunks, mix, signed

ADD = 0.1
MIN_COUNT = 10
MIN_FOLLOW = 2
RATIO = 1.5
SMOOTH = 5.0
#: The longest contexts; each further length costs a column of the places.
DEPTH = 4
#: Upper bound on the words whose counts are broadcast.
HEAD = 1 << 18
#: Training occurrences of a word beyond which the places after it are dealt to several buckets.
SPLIT = 1 << 19
#: Upper bound on such words, whose effects are broadcast.
EFFECTS = 1 << 20
#: Upper bound on the bits of a broadcast bitmap of names, 16 for each name up to there; a power of two.
BITS = 1 << 28
#: Tokens for each bucket of the prints of pairs.
BUCKET_TOKENS = 1 << 20
FOLDS = 10
#: Tokens counted together before their counts are handed on.
COUNT_WINDOW = 2_000_000
#: Tokens whose places are sent together.
ASK_WINDOW = 1_000_000
#: Places of a bucket that are scored together.
SCORE_PLACES = 1 << 17
#: Places of a window with one pair of words beyond which equal ones of a text are sent as one.
OFTEN = 2000
END = np.uint64(0x454E44)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def held_out():
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def token_stream(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all tokens of a piece (an end after each document), the document of each, and its place in it."""
    words = Words(data, offsets)
    n = len(words.counts)
    out = np.empty(len(words.starts) + n, np.uint64)
    doc = np.repeat(np.arange(n), words.counts + 1)
    ends = np.cumsum(words.counts + 1) - 1
    is_word = np.ones(len(out), bool)
    is_word[ends] = False
    out[is_word] = words.hashes(lower=True)
    out[ends] = END
    return out, doc, np.arange(len(out)) - np.repeat(ends - words.counts, words.counts + 1)


def after(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The name of a context with one word more at its end."""
    return mix(context * np.uint64(3) + _STEP ^ word)


class Pool:
    """Counts of rows whose first column names them, handed on when enough have come together."""

    def __init__(self, *names: str):
        self.names, self.parts, self.size = names, [], 0

    def add(self, *columns: np.ndarray) -> bool:
        self.parts.append(columns)
        self.size += len(columns[0])
        return self.size >= COUNT_WINDOW

    def flush(self) -> pa.RecordBatch:
        columns = [np.concatenate(c) for c in zip(*self.parts)]
        _, at, n = np.unique(columns[0], return_index=True, return_counts=True)
        self.parts, self.size = [], 0
        return pa.RecordBatch.from_arrays([*[pa.array(signed(c[at])) for c in columns], pa.array(n)], names=[*self.names, "n"])


def word_counts(training: DataFrame) -> DataFrame:
    """word (hash) and c over all training texts."""

    def counted(batches):
        pool = Pool("word")
        for batch in batches:
            for _, _, data, offsets in chunks(batch.column("text")):
                if pool.add(token_stream(data, offsets)[0]):
                    yield pool.flush()
        if pool.size:
            yield pool.flush()

    return training.mapInArrow(counted, "word long, n long").groupBy("word").agg(F.sum("n").alias("c"))


class Bitmap:
    """Names that may be in a column: all that are, and a few others by chance, by two bits for each name."""

    def __init__(self, names: DataFrame, column: str):
        size = min(max(16 * names.count(), 1 << 16), BITS)
        self.mask = np.uint64((1 << (size - 1).bit_length()) - 1)
        slots = F.array(F.col(column), F.shiftrightunsigned(column, 32)).alias("slots")
        slot = names.select(F.explode(slots).alias("slot")).select(F.col("slot").bitwiseAND(F.lit(int(self.mask))).alias("slot"))
        with dropping_shuffles(names.sparkSession):
            found = slot.groupBy(F.shiftright("slot", 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(slot & 63L AS INT))")).alias("bits")).toArrow()
        self.bits = np.zeros((int(self.mask) >> 6) + 1, np.uint64)
        self.bits[found["at"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)

    def has(self, names: np.ndarray) -> np.ndarray:
        out = self._bit(names & self.mask)
        at = np.flatnonzero(out)
        out[at] = self._bit(names[at] >> np.uint64(32) & self.mask)
        return out

    def _bit(self, slot: np.ndarray) -> np.ndarray:
        return (self.bits[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


def contexts_of(tokens: np.ndarray, place: np.ndarray, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length up to depth: which tokens have so many words before them, and at every place the context's name and that of the context without its first word (undefined where there are fewer words)."""
    name, rest = tokens[:0], np.zeros(len(tokens), np.uint64)
    for d in range(1, depth + 1):
        longer = np.zeros(len(tokens), np.uint64)
        longer[1:] = after(name[:-1], tokens[:-1]) if d > 1 else tokens[:-1]
        rest, name = name if d > 1 else rest, longer
        yield place >= d, name, rest


def printed(pair: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """A pair's bucket, and the 32 bits that stand for it there."""
    return (pair >> np.uint64(32)) % np.uint64(buckets), pair.astype(np.uint32)


def named_print(bucket: np.ndarray, bits: np.ndarray) -> np.ndarray:
    return mix(bucket.astype(np.uint64) << np.uint64(32) | bits.astype(np.uint64))


def _slices(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The bytes of the values between each two ends."""
    binary = pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer((ends * values.itemsize).astype(np.int64)), pa.py_buffer(values.tobytes())])
    return binary.cast(pa.binary())


def repeated_prints(training: DataFrame, candidates: Bitmap, total: int) -> tuple[DataFrame, int]:
    """name: the prints of all pairs of a candidate word and its next token that come twice or more, and of others by chance; and the number of buckets.

    Most pairs of a corpus come once. Four bytes of each, packed by bucket, tell
    which may come again, so that only these are shuffled with their names. A
    window sends a print at most twice, so no bucket has a hot member.
    """
    buckets = max(32, total // BUCKET_TOKENS)
    shared = training.sparkSession.sparkContext.broadcast(candidates)

    def packed(parts):
        pair, n = np.unique(np.concatenate(parts), return_counts=True)
        bucket, bits = printed(np.repeat(pair, np.minimum(n, 2)), buckets)
        order = np.argsort(bucket, kind="stable")
        bucket, bits = bucket[order], bits[order]
        found, first = np.unique(bucket, return_index=True)
        return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), _slices(bits, np.append(first, len(bits)))], names=["bucket", "prints"])

    def sent(batches):
        parts, size = [], 0
        for batch in batches:
            for _, _, data, offsets in chunks(batch.column("text")):
                tokens, _, place = token_stream(data, offsets)
                at = np.flatnonzero(place >= 1)
                may = at[shared.value.has(tokens[at - 1])]
                parts.append(after(tokens[may - 1], tokens[may]))
                size += len(parts[-1])
                if size >= COUNT_WINDOW:
                    yield packed(parts)
                    parts, size = [], 0
        if size:
            yield packed(parts)

    def again(group: pa.Table) -> pa.Table:
        bits = np.sort(np.frombuffer(b"".join(group.column("prints").to_pylist()), np.uint32))
        twice = np.unique(bits[1:][bits[1:] == bits[:-1]])
        bucket = np.full(len(twice), group.column("bucket")[0].as_py(), np.uint64)
        return pa.table({"name": signed(named_print(bucket, twice))})

    rows = training.mapInArrow(sent, "bucket long, prints binary").groupBy("bucket").applyInArrow(again, "name long")
    return materialise(rows, "repeated-prints"), buckets


def next_counts(training: DataFrame, depth: int, candidates: Bitmap, shorter: Bitmap, buckets: int) -> DataFrame:
    """pair, context, short and n: how often (MIN_FOLLOW or more) a token follows a context; pair and short name both together, short without the context's first word.

    shorter holds what may come MIN_FOLLOW times: the shorts of the length before, for single words the prints of pairs.
    A window's counts go packed, by bucket of the pair and sorted by context, so that runs of one context take little room.
    """
    shared = training.sparkSession.sparkContext.broadcast((candidates, shorter))

    def packed(parts):
        context, token, rest = (np.concatenate(c) for c in zip(*parts))
        pair, at, n = np.unique(after(context, token), return_index=True, return_counts=True)
        bucket = (pair >> np.uint64(32)) % np.uint64(buckets)
        order = np.lexsort((context[at], bucket))
        bucket, at, n = bucket[order], at[order], n[order]
        found, first = np.unique(bucket, return_index=True)
        ends = np.append(first, len(bucket))
        columns = [_slices(x, ends) for x in (context[at], token[at], rest[at], n.astype(np.uint32))]
        return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), *columns], names=["bucket", "contexts", "tokens", "rests", "times"])

    def counted(batches):
        contexts, repeated = shared.value
        parts, size = [], 0
        for batch in batches:
            for _, _, data, offsets in chunks(batch.column("text")):
                tokens, _, place = token_stream(data, offsets)
                *_, (deep, name, rest) = contexts_of(tokens, place, depth)
                may = np.flatnonzero(deep)
                may = may[contexts.has(name[may])]
                if depth == 1:
                    again = repeated.has(named_print(*printed(after(name[may], tokens[may]), buckets)))
                else:
                    again = repeated.has(after(rest[may], tokens[may]))
                may = may[again]
                parts.append((name[may], tokens[may], rest[may]))
                size += len(may)
                if size >= COUNT_WINDOW:
                    yield packed(parts)
                    parts, size = [], 0
        if size:
            yield packed(parts)

    def summed(group: pa.Table) -> pa.Table:
        context, token, rest, times = (np.frombuffer(b"".join(group.column(x).to_pylist()), t) for x, t in (("contexts", "u8"), ("tokens", "u8"), ("rests", "u8"), ("times", "u4")))
        pair = after(context, token)
        order = np.argsort(pair, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], np.diff(pair[order]) != 0]))
        n = np.add.reduceat(times[order].astype(np.int64), first)
        at, n = order[first[n >= MIN_FOLLOW]], n[n >= MIN_FOLLOW]
        short = after(rest[at], token[at]) if depth > 1 else token[at]
        return pa.table({"pair": signed(pair[at]), "context": signed(context[at]), "short": signed(short), "n": n})

    rows = training.mapInArrow(counted, "bucket long, contexts binary, tokens binary, rests binary, times binary")
    return rows.groupBy("bucket").applyInArrow(summed, "pair long, context long, short long, n long")


def lengths(training: DataFrame, counts: DataFrame, total: int, types: int, depth: int, with_root: bool = False) -> list[DataFrame]:
    """A table for each length: the next tokens of its candidates (pair, context, n), their share, that in the shorter context (and in the root), whether the context is kept, and log10 of what it leaves of the other tokens' shares."""
    root = (F.col("c") + ADD) / (total + ADD * (types + 1))
    end = int(signed(np.array([END]))[0])
    candidates = counts.filter((F.col("c") >= MIN_COUNT) & (F.col("word") != end)).select(F.col("word").alias("name"), F.col("c").alias("of"))
    shorter = counts.select(F.col("word").alias("short"), root.alias("parent"), *[root.alias("root")][: int(with_root)])
    out, buckets = [], 1
    for d in range(1, depth + 1):
        if candidates.isEmpty():
            break
        contexts = Bitmap(candidates, "name")
        if d == 1:
            prints, buckets = repeated_prints(training, contexts, total)
            repeated = Bitmap(prints, "name")
            release(prints)
        else:
            repeated = Bitmap(out[-1], "pair")
        # contexts last: their join and the sums over each share one shuffle
        rows = next_counts(training, d, contexts, repeated, buckets).join(shorter, "short").drop("short").join(candidates.withColumnRenamed("name", "context"), "context")
        rows = rows.withColumn("share", (F.col("n") + SMOOTH * F.col("parent")) / (F.col("of") + SMOOTH)).drop("of")
        whole = Window.partitionBy("context")
        left = F.log10(F.greatest(1 - F.sum("share").over(whole), F.lit(1e-9)) / F.greatest(1 - F.sum("parent").over(whole), F.lit(1e-9)))
        kept = F.max(F.abs(F.ln(F.col("share") / F.col("parent")))).over(whole) >= float(np.log(RATIO))
        out.append(materialise(rows.withColumns({"left": left, "kept": kept}), f"length-{d}"))
        candidates = out[-1].filter(F.col("n") >= MIN_COUNT).select(F.col("pair").alias("name"), F.col("n").alias("of"))
        shorter = out[-1].select(F.col("pair").alias("short"), F.when(F.col("kept"), F.col("share")).otherwise(F.col("parent")).alias("parent"), *["root"][: int(with_root)])
    return out


class States:
    """The kept contexts of one length, and what they change."""

    def __init__(self, names: np.ndarray, left: np.ndarray, keys: np.ndarray, gain: np.ndarray):
        self.names, self.left = names, left  # sorted; log10 of what a state's other tokens keep of their share in the shorter context
        self.keys, self.gain = keys, gain  # of state and explicit next token, sorted; log10 of its share over that in the root

    def gains(self, context: np.ndarray, word: np.ndarray, shorter: np.ndarray) -> np.ndarray:
        """log10 of the share of each word after its context over that in the root; shorter is the same for the shorter context."""
        if not len(self.names):
            return shorter
        at = np.minimum(np.searchsorted(self.names, context), len(self.names) - 1)
        out = np.where(self.names[at] == context, shorter + self.left[at], shorter)
        key = after(context, word)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.gain[at], out)


def grow(training: DataFrame, counts: DataFrame, total: int, types: int, depth: int = 2) -> list[States]:
    """The kept states of the first lengths, collected: to look into the model of a small corpus; scoring doesn't use it."""
    out = []
    for rows in lengths(training, counts, total, types, depth, with_root=True):
        found = rows.filter("kept").select("context", "left", "pair", F.log10(F.col("share") / F.col("root")).alias("gain")).toArrow()
        context, key = (found[x].to_numpy().view(np.uint64) for x in ("context", "pair"))
        names, at = np.unique(context, return_index=True)
        order = np.argsort(key)
        out.append(States(names, found["left"].to_numpy()[at], key[order], found["gain"].to_numpy()[order]))
    return out


def looked_up(keys: np.ndarray, sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each key stands in sorted_keys, and whether it does."""
    if not len(sorted_keys):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return at, sorted_keys[at] == keys


def coded(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number from 0 for each value, the same for equal ones, and the distinct values."""
    found = pa.array(values).dictionary_encode()
    return found.indices.to_numpy(), found.dictionary.to_numpy()


def pressed(*columns: np.ndarray) -> bytes:
    """Columns of whole numbers, none below zero, of one length: each by as many planes of bytes as it needs, compressed."""
    n, widths, planes = len(columns[0]), [], []
    for x in columns:
        widths.append(max(1, (int(x.max(initial=0)).bit_length() + 7) // 8))
        wide = np.ascontiguousarray(x.astype("<u4" if widths[-1] <= 4 else "<u8"))
        planes.append(np.ascontiguousarray(wide.view(np.uint8).reshape(n, wide.itemsize)[:, : widths[-1]].T).tobytes())
    return np.array([n, *widths], "<u4").tobytes() + pa.Codec("zstd", compression_level=1).compress(b"".join(planes), asbytes=True)


def unpressed(data: bytes, columns: int) -> list[np.ndarray]:
    n, *widths = np.frombuffer(data[: 4 * (columns + 1)], "<u4").tolist()
    planes = np.frombuffer(pa.decompress(data[4 * (columns + 1) :], n * sum(widths), "zstd"), np.uint8).reshape(sum(widths), n)
    out, at = [], 0
    for width in widths:
        wide = np.zeros((n, 4 if width <= 4 else 8), np.uint8)
        wide[:, :width] = planes[at : at + width].T
        out.append(wide.reshape(-1).view("<u4" if width <= 4 else "<u8"))
        at += width
    return out


class Vocabulary:
    """What each task knows of the words: the counts of the most frequent ones, in how many parts the places after a very frequent one are dealt, and bitmaps of the others."""

    def __init__(self, words: np.ndarray, c: np.ndarray, candidates: Bitmap, repeated: Bitmap):
        self.words, self.c, self.candidates, self.repeated = words, c, candidates, repeated  # words sorted
        order = np.argsort(-c, kind="stable")
        self.ranked = words[order]  # the most frequent first
        self.rank = np.empty(len(words), np.int64)
        self.rank[order] = np.arange(len(words))
        often = np.flatnonzero(c > SPLIT)
        often = often[np.argsort(-c[often], kind="stable")[:EFFECTS]]
        self.split = np.zeros(len(words) + 1, np.int64)  # a number from 1 for each such word, 0 for the others and at the end
        self.split[often] = np.arange(1, len(often) + 1)
        self.of = np.concatenate([[0], c[often]])
        self.parts = np.maximum(1, -(-self.of // SPLIT))

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The rank of each word (-1: not known by its count), the count (else 0), and its number if its places are dealt in parts."""
        at, known = looked_up(words, self.words)
        if not len(self.words):
            return np.full(len(words), -1), np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        return np.where(known, self.rank[at], -1), np.where(known, self.c[at], 0), np.where(known, self.split[at], 0)

    def listed(self, ranks: np.ndarray, others: np.ndarray) -> bytes:
        """Words as bytes: known ones by their sorted ranks, then others."""
        steps = pressed(np.diff(ranks, prepend=0))
        return np.array([len(steps)], "<u4").tobytes() + steps + others.tobytes()

    def unlisted(self, data: bytes) -> np.ndarray:
        end = 4 + int(np.frombuffer(data[:4], "<u4")[0])
        return np.concatenate([self.ranked[np.cumsum(unpressed(data[4:end], 1)[0], dtype=np.int64)], np.frombuffer(data[end:], np.uint64)])


class Places:
    """The places of a window of texts that follow a candidate word: their bucket, the words before them from the nearest on (-1: none, or no candidate), their own word (-1: comes once in training), all as numbers of the window's distinct words."""

    def __init__(self, tokens: np.ndarray, place: np.ndarray, known: Vocabulary, bits: int):
        self.codes, self.words = coded(tokens)
        self.rank, self.c, self.split = known.find(self.words)
        self.known, self.is_known = known, self.rank >= 0
        candidate = np.where(self.is_known, self.c >= MIN_COUNT, known.candidates.has(self.words))
        repeated = np.where(self.is_known, self.c >= MIN_FOLLOW, known.repeated.has(self.words))
        at = np.flatnonzero(place >= 1)
        at = at[candidate[self.codes[at - 1]]]
        self.at, self.history, deep = at, [self.codes[at - 1]], np.ones(len(at), bool)
        for d in range(2, DEPTH + 1):
            before = self.codes[np.maximum(at - d, 0)]
            deep = deep & (place[at] >= d) & candidate[before]
            self.history.append(np.where(deep, before, -1))
        own = self.codes[at]
        self.token = np.where(repeated[own], own, -1)
        last = self.history[0]
        home = self.words[last]
        # longer contexts of a dealt word stay together; where there is none, any part will do
        dealt = np.flatnonzero(self.split[last])
        by = np.where(self.history[1][dealt] >= 0, self.history[1][dealt], own[dealt])
        part = mix(self.words[by] ^ _STEP) % known.parts[self.split[last[dealt]]].astype(np.uint64)
        home[dealt] = mix(home[dealt] + (part + np.uint64(1)) * _STEP)
        self.bucket = (home >> np.uint64(64 - bits)).view(np.int64)

    def distinct(self, owner: np.ndarray, often: int) -> tuple[np.ndarray, np.ndarray]:
        """Which places stand for all equal ones of a text, and how often each occurs; of pairs of words that come often times or less, each stands for itself."""
        many = len(self.words) + 1
        slot = (self.history[0] * np.int32(40503) + self.token).astype(np.uint16)  # rarer pairs may share a slot with others, which costs time only
        some = np.flatnonzero((np.bincount(slot) > often)[slot])
        code, keep, times = owner[some], np.ones(len(slot), bool), np.ones(len(slot), np.int64)
        for x in (*self.history, self.token):
            code, _ = coded(code.astype(np.int64) * many + x[some] + 1)
        _, first, n = np.unique(code, return_index=True, return_counts=True)
        keep[some] = False
        keep[some[first]] = True
        times[some[first]] = n
        return np.flatnonzero(keep), times[keep]

    def packed(self, bucket: np.ndarray, named: list[np.ndarray], *columns: np.ndarray) -> Iterator[tuple[int, bytes, bytes]]:
        """For each bucket its words and its rows: the named columns as numbers of these words from 1 on, 0 for -1, and the other columns."""
        order = np.argsort(bucket.astype(np.int32), kind="stable")
        named, columns = [x[order] + 1 for x in named], [x[order] for x in columns]
        found, first = np.unique(bucket[order], return_index=True)
        seen = np.zeros(len(self.words) + 1, np.int64)
        place_of = np.where(self.is_known, self.rank, len(self.known.words))
        for b, start, end in zip(found.tolist(), first.tolist(), [*first[1:].tolist(), len(order)]):
            ids = np.concatenate([x[start:end] for x in named])
            place = np.arange(len(ids))
            seen[ids] = place
            distinct = ids[(seen[ids] == place) & (ids > 0)]
            distinct = distinct[np.argsort(place_of[distinct - 1], kind="stable")]
            seen[distinct] = np.arange(1, len(distinct) + 1)
            seen[0] = 0
            known = int(self.is_known[distinct - 1].sum())
            yield b, self.known.listed(self.rank[distinct[:known] - 1], self.words[distinct[known:] - 1]), pressed(*seen[ids].reshape(len(named), -1), *[x[start:end] for x in columns])


def gathered(known: Vocabulary, rows: list[tuple[bytes, bytes]], named: int, columns: int) -> tuple[np.ndarray, list[np.ndarray], list[int]]:
    """The distinct words of packed rows, their columns one after another (named ones as numbers of these words from 1 on, 0: none), and each row's size."""
    lists = [known.unlisted(x) for x, _ in rows]
    codes, words = coded(np.concatenate(lists))
    parts, at = [], 0
    for own, (_, data) in zip(lists, rows):
        to = at + len(own)
        number = np.concatenate([[0], codes[at:to] + 1]).astype(np.int32)
        got = unpressed(data, columns)
        parts.append([*[number[x] for x in got[:named]], *got[named:]])
        at = to
    sizes, whole = [len(x[0]) for x in parts], []
    for k in range(columns):
        whole.append(np.concatenate([x[k] for x in parts]))
        for x in parts:
            x[k] = None  # no two copies of all columns at a time
    return words, whole, sizes


def word_groups(last: np.ndarray, words: int, most: int) -> Iterator[np.ndarray]:
    """The places of a bucket in groups of some most places, in their order there; all places after one word are in one group."""
    n = np.bincount(last, minlength=words)
    group = ((np.cumsum(n) - n) // most).astype(np.int16)[last]
    order = np.argsort(group, kind="stable")
    ends = np.cumsum(np.bincount(group))
    yield from (x for x in np.split(order, ends[:-1]) if len(x))


class Scores:
    """What contexts add to the root's log10 share at each place of a group that holds all places of its contexts; trained: how often a place counts."""

    def __init__(self, token: np.ndarray, trained: np.ndarray, root: np.ndarray):
        self.token, self.trained, self.words = token, trained, len(root)
        self.parent = root[token]  # the share after the context before, where the token is one of its own
        self.gain = np.zeros(len(token))

    def apply(self, at: np.ndarray, left: np.ndarray, kept: np.ndarray, follows: np.ndarray, share: np.ndarray) -> None:
        """left, kept, follows and share for each place: of its context, whether the token is one of its own, and its share there."""
        other, own = kept & ~follows, kept & follows
        self.gain[at[other]] += left[other]
        to = at[own]
        self.gain[to] += np.log10(share[own] / self.parent[to])
        self.parent[to] = share[own]

    def step(self, at: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Takes the contexts of one length, numbered from 0, in; gives back the places of candidates, and their contexts."""
        of = np.bincount(context, weights=self.trained[at])
        candidate = of[context] >= MIN_COUNT
        at, context = at[candidate], context[candidate]
        if not len(at):
            return at, context
        may = np.flatnonzero(self.token[at])
        pair, key = coded(context[may].astype(np.int64) * self.words + self.token[at[may]])
        n = np.bincount(pair, weights=self.trained[at[may]], minlength=len(key))
        parent = np.zeros(len(key))
        parent[pair] = self.parent[at[may]]  # the same at each place of a pair that comes MIN_FOLLOW times
        own = n >= MIN_FOLLOW
        holder = key // self.words
        share = (n + SMOOTH * parent) / (of[holder] + SMOOTH)
        holder = holder[own]
        left = left_of(*[np.bincount(holder, weights=x[own], minlength=len(of)) for x in (share, parent)])
        ratio = np.zeros(len(of))
        np.maximum.at(ratio, holder, np.abs(np.log(share[own] / parent[own])))
        follows, shares = np.zeros(len(at), bool), np.zeros(len(at))
        follows[may], shares[may] = own[pair], share[pair]
        self.apply(at, left[context], ratio[context] >= np.log(RATIO), follows, shares)
        return at, context


def left_of(share: np.ndarray, parent: np.ndarray) -> np.ndarray:
    """log10 of what contexts leave of the other tokens' shares, by the sums over their own."""
    return np.log10(np.maximum(1 - share, 1e-9) / np.maximum(1 - parent, 1e-9))


def packed_counts(counts: DataFrame, bits: int) -> DataFrame:
    """The words and their counts, packed by bucket of the word."""

    def run(batches):
        parts, size = [], 0

        def window():
            word, c = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(word)
            bucket, columns = _by_bucket(word[order], bits, word[order], c[order])
            return pa.RecordBatch.from_arrays([pa.array(bucket), *columns], names=["bucket", "names", "worth"])

        for batch in batches:
            parts.append((batch.column("word").to_numpy().view(np.uint64), batch.column("c").to_numpy()))
            size += len(batch)
            if size >= COUNT_WINDOW:
                yield window()
                parts, size = [], 0
        if size:
            yield window()

    return counts.select("word", "c").mapInArrow(run, "bucket long, names binary, worth binary")


def sorted_counts(known: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    parts = [[b"" if x is None else x for x in known.column(c).to_pylist()] for c in ("names", "worth")]
    word, c = np.frombuffer(b"".join(parts[0]), np.uint64), np.frombuffer(b"".join(parts[1]), np.int64)
    order = np.argsort(word)
    return word[order], c[order]


def windows(batches, most: int, *more: str) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list[pa.RecordBatch]]]:
    """Tokens, their document, their place in it, and further columns of the documents, of texts until they have most tokens or more."""
    parts, columns, size, row = [], [], 0, 0
    for batch in batches:
        for at, to, data, offsets in chunks(batch.column("text")):
            tokens, doc, place = token_stream(data, offsets)
            parts.append((tokens, row + doc, place))
            columns.append(batch.select(more).slice(at, to - at))
            row += to - at
            size += len(tokens)
            if size >= most:
                whole, of, parts, columns, size, row = [np.concatenate(x) for x in zip(*parts)], columns, [], [], 0, 0
                yield *whole, of
                del whole, of
    if parts:
        yield *[np.concatenate(x) for x in zip(*parts)], columns


def column(parts: list[pa.RecordBatch], name: str) -> pa.Array:
    return pa.concat_arrays([x.column(name) for x in parts])


def answers(docs: DataFrame, counts: DataFrame, shared, bits: int, norm: float) -> DataFrame:
    """What buckets of places need to know of words whose count not every task knows, and of the next tokens of words whose places are dealt to several buckets.

    A window asks once for each bucket and word; the counts of a dealt word's next tokens, and their shares, are summed
    where the next token's bucket is, so that of such a word only sums of each bucket remain (number, share, parent, ratio).
    """

    def window(tokens, doc, place, parts):
        known = shared.value
        many = len(known.of)
        trained = ~column(parts, "held_out").to_numpy(zero_copy_only=False)
        places = Places(tokens, place, known, bits)
        number = places.split[places.history[0]]
        ask = np.flatnonzero((places.token >= 0) & ((number > 0) | ~places.is_known[places.token]))
        code, key = coded((places.bucket[ask] * many + number[ask]) * len(places.words) + places.token[ask])
        n = np.bincount(code, weights=trained[doc[places.at[ask]]], minlength=len(key)).astype(np.int64)
        to, token = np.divmod(key, len(places.words))
        to, number = np.divmod(to, many)
        rows = list(places.packed((places.words[token] >> np.uint64(64 - bits)).view(np.int64), [token], to, number, n))
        if rows:
            return pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], names=["bucket", "words", "rows"])
        return None

    def asked(batches):
        for whole in windows(batches, ASK_WINDOW, "held_out"):
            out = window(*whole)
            del whole  # not kept while the next window is read
            if out is not None:
                yield out
            del out

    def answered(asked: pa.Table, counted: pa.Table) -> pa.Table:
        known, out = shared.value, []
        rows = sorted(zip(asked.column("words").to_pylist(), asked.column("rows").to_pylist()))
        if rows:
            words, (token, to, number, n), _ = gathered(known, rows, 1, 4)
            word, count = sorted_counts(counted)
            at, hit = looked_up(words, word)
            c = np.zeros(len(words) + 1, np.int64)
            c[1:][hit] = count[at[hit]]
            code, key = coded(number.astype(np.int64) * len(c) + token)
            times = np.bincount(code, weights=n, minlength=len(key)).astype(np.int64)
            follows = (c[key % len(c)] >= MIN_FOLLOW) & ((key < len(c)) | (times >= MIN_FOLLOW))
            for x in np.unique(key[follows] // len(c)):
                if x:
                    own = follows & (key // len(c) == x)
                    parent = (c[key[own] % len(c)] + ADD) / norm
                    share = (times[own] + SMOOTH * parent) / (known.of[x] + SMOOTH)
                    out.append((-1, None, int(x), share.sum(), parent.sum(), np.abs(np.log(share / parent)).max()))
            take = np.flatnonzero(follows[code])
            once = np.unique(to[take].astype(np.int64) * len(key) + code[take])
            to, code = np.divmod(once, len(key))
            number, token = np.divmod(key[code], len(c))
            found, first = np.unique(to, return_index=True)
            for b, start, end in zip(found.tolist(), first.tolist(), [*first[1:].tolist(), len(to)]):
                own = slice(start, end)
                out.append((b, pressed(words[token[own] - 1], number[own], c[token[own]], times[code[own]]), None, None, None, None))
        columns = zip(*out) if out else [()] * 6
        types = (pa.int64(), pa.binary(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
        return pa.table([pa.array(x, t) for x, t in zip(columns, types)], names=["bucket", "words", "number", "share", "parent", "ratio"])

    rows = docs.mapInArrow(asked, "bucket long, words binary, rows binary").groupBy("bucket")
    known = packed_counts(counts.filter(F.col("c") >= MIN_FOLLOW), bits).groupBy("bucket")
    return materialise(rows.cogroup(known).applyInArrow(answered, "bucket long, words binary, number long, share double, parent double, ratio double"), "answers")


def score_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score for every document."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out().alias("held_out"))
    counts = materialise(word_counts(docs.filter("NOT held_out").select("text")), "word-counts")
    total, types = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    found = most_frequent(counts, "word", "c", HEAD)
    words, c = found["word"].to_numpy().view(np.uint64), found["c"].to_numpy()
    order = np.argsort(words)
    others = counts.filter(F.col("c") < int(c.min(initial=total + 1)))
    bitmaps = [Bitmap(others.filter(F.col("c") >= least), "word") for least in (MIN_COUNT, MIN_FOLLOW)]
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(Vocabulary(words[order], c[order], *bitmaps))
    norm = total + ADD * (types + 1)
    bits = (max(32, total // (2 * BUCKET_TOKENS)) - 1).bit_length()
    known = answers(docs, counts, shared, bits, norm)
    dealt = known.filter("number IS NOT NULL").groupBy("number").agg(F.sum("share").alias("share"), F.sum("parent").alias("parent"), F.max("ratio").alias("ratio")).toArrow()
    of_dealt = np.zeros((2, len(shared.value.of)))  # what they leave, and whether they are kept
    number, share, parent, ratio = (dealt[x].to_numpy() for x in ("number", "share", "parent", "ratio"))
    of_dealt[0, number], of_dealt[1, number] = left_of(share, parent), ratio >= np.log(RATIO)

    def window(first, tokens, doc, place, parts):
        known = shared.value
        log_share = lambda c: np.log10((c + ADD) / norm)
        held, n = column(parts, "held_out"), sum(len(x) for x in parts)
        places = Places(tokens, place, known, bits)
        is_known = places.is_known[places.codes]
        base = np.bincount(doc[is_known], weights=log_share(places.c)[places.codes[is_known]], minlength=n).astype(float)  # whole numbers where none is known
        facts = [column(parts, "doc_id"), held, pa.array(np.bincount(doc, minlength=n)), pa.array(np.bincount(doc[is_known], minlength=n)), pa.array(base)]
        rows = [(-1 - (first >> 40), first, _sent(pa.RecordBatch.from_arrays(facts, names=FACTS)), None, None)]
        # other words: for their counts, once for each text
        order = np.argsort(places.words)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        key, times = np.unique(rank[places.codes[~is_known]] * n + doc[~is_known], return_counts=True)
        word, owner = places.words[order[key // n]], key % n
        bucket = (word >> np.uint64(64 - bits)).view(np.int64)
        found, start = np.unique(bucket, return_index=True)
        for b, at, to in zip(found.tolist(), start.tolist(), [*start[1:].tolist(), len(word)]):
            rows.append((2 * b, first, None, None, pressed(word[at:to], owner[at:to], times[at:to])))
        once, times = places.distinct(doc[places.at], OFTEN)
        owner = doc[places.at[once]]
        trained = ~held.to_numpy(zero_copy_only=False)
        named = [x[once] for x in (*places.history, places.token)]
        rows += [(2 * b + 1, first, None, *x) for b, *x in places.packed(places.bucket[once], named, owner, trained[owner], times)]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()))], names=ASKED)

    def asked(batches):
        first = TaskContext.get().partitionId() << 40
        for whole in windows(batches, ASK_WINDOW, "doc_id", "held_out"):
            n, out = sum(len(x) for x in whole[-1]), window(first, *whole)
            del whole  # not kept while the next window is read
            yield out
            del out
            first += n

    def by_words(rows, counted):
        """The base's sums of each window's texts, for words whose count not every task knows."""
        word, c = sorted_counts(counted)
        for first, _, _, data in rows:
            key, owner, times = unpressed(data, 3)
            at, hit = looked_up(key.astype(np.uint64), word)
            value = np.full(len(key), np.log10(ADD / norm))
            value[hit] = np.log10((c[at[hit]] + ADD) / norm)
            docs, of = np.unique(owner, return_inverse=True)
            yield first, 0, docs, np.bincount(of, weights=times * value), np.bincount(of, weights=times * hit).astype(np.int64)

    def by_contexts(rows, replies):
        """The sums of what contexts add, for each window's texts."""
        known = shared.value
        words, columns, sizes = gathered(known, [x[2:] for x in rows], DEPTH + 1, DEPTH + 4)
        *history, token, owner, trained, often = columns
        firsts = [x[0] for x in rows]
        del columns
        rows.clear()  # the packed bytes, which the caller's list would keep
        c, split = np.zeros(len(words) + 1, np.int64), np.zeros(len(words) + 1, np.int64)
        _, c[1:], split[1:] = known.find(words)
        replies = [unpressed(x, 4) for x in replies if x is not None]
        pairs, times = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if replies:
            word, number, count, times = (np.concatenate([x.astype(t) for x in y]) for y, t in zip(zip(*replies), ("u8", "i8", "i8", "i8")))
            order = np.argsort(words)
            at, hit = looked_up(word, words[order])
            at, number, count, times = order[at[hit]] + 1, number[hit], count[hit], times[hit]
            c[at] = count
            order = np.argsort(number * len(c) + at)
            pairs, times = (number * len(c) + at)[order], times[order]
        token, root, gain = np.where(c[token] >= MIN_FOLLOW, token, 0), (c + ADD) / norm, np.zeros(len(token))

        def gained(places):
            token_of, (last, *before) = token[places], (x[places] for x in history)
            scores = Scores(token_of, np.multiply(trained[places], often[places], dtype=float), root)
            of = split[last]
            at = np.flatnonzero(of)
            if len(at):
                number = of[at]
                place, follows = looked_up(number * len(c) + token_of[at], pairs)
                follows &= token_of[at] > 0
                share = np.zeros(len(at))
                share[follows] = (times[place[follows]] + SMOOTH * scores.parent[at[follows]]) / (known.of[number[follows]] + SMOOTH)
                scores.apply(at, of_dealt[0][number], of_dealt[1][number] > 0, follows, share)
            alone, context = scores.step(*(lambda x: (x, last[x]))(np.flatnonzero(of == 0)))
            at, context = np.concatenate([at, alone]), np.concatenate([last[at], context])
            for word in before:
                deep = word[at] > 0
                at = at[deep]
                context, _ = coded(context[deep].astype(np.int64) * len(c) + word[at])
                at, context = scores.step(at, context)
            return scores.gain

        for places in word_groups(history[0], len(c), SCORE_PLACES):  # contexts end in the last word, so a group holds theirs whole
            gain[places] = gained(places)
        start = 0
        for first, size in zip(firsts, sizes):
            sums = np.bincount(owner[start : start + size], weights=gain[start : start + size] * often[start : start + size])
            docs = np.flatnonzero(sums)
            yield first, 1, docs, sums[docs], np.zeros(0, np.int64)
            start += size

    def answered(asked: pa.Table, known: pa.Table) -> pa.Table:
        out, kinds = [], ([], [])
        for bucket, first, facts, *row in zip(*[asked.column(x).to_pylist() for x in ASKED]):
            if facts is not None:
                out.append((first, facts, None, None, None, None))
            else:
                kinds[bucket & 1].append((first, bucket, *row))
        facts = row = None
        for found, answer in zip(kinds, (lambda rows: by_words(rows, known), lambda rows: by_contexts(rows, sorted(known.column("names").to_pylist())))):
            rows = sorted(found)
            found.clear()
            if rows:
                for first, kind, docs, sums, seen in answer(rows):
                    out.append((first, None, kind, pressed(docs), sums.tobytes(), pressed(seen)))
        columns = zip(*out) if out else [()] * 6
        return pa.table([pa.array(x, t) for x, t in zip(columns, (pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.binary(), pa.binary()))], names=["first", "facts", "kind", "docs", "sums", "seen"])

    def summed(group: pa.Table) -> pa.Table:
        rows = list(zip(*[group.column(x).to_pylist() for x in ("facts", "kind", "docs", "sums", "seen")]))
        facts = pa.ipc.open_stream(next(r[0] for r in rows if r[0] is not None)).read_all()
        n_known, base = (facts.column(x).to_numpy().copy() for x in ("n_head", "base"))
        gain = np.zeros(len(base))
        # in one order on every run, whatever the order of arrival
        for _, kind, docs, sums, seen in sorted((r for r in rows if r[0] is None), key=lambda r: r[1:]):
            (docs,), (seen,) = unpressed(docs, 1), unpressed(seen, 1)
            (gain if kind else base)[docs] += np.frombuffer(sums, "f8")
            if not kind:
                n_known[docs] += seen
        columns = [*facts.select(["doc_id", "held_out", "n_tokens"]).columns, pa.array(n_known), pa.array(np.full(len(n_known), total)), pa.array(base), pa.array(base + gain)]
        return pa.table(columns, names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    rows = docs.mapInArrow(asked, "bucket long, first long, facts binary, words binary, places binary")
    counted = packed_counts(counts, bits).withColumn("bucket", 2 * F.col("bucket"))
    replies = known.filter("words IS NOT NULL").select((2 * F.col("bucket") + 1).alias("bucket"), F.col("words").alias("names"), F.lit(None).cast("binary").alias("worth"))
    sums = rows.groupBy("bucket").cogroup(counted.unionAll(replies).groupBy("bucket")).applyInArrow(answered, "first long, facts binary, kind long, docs binary, sums binary, seen binary")
    return sums.groupBy("first").applyInArrow(summed, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _sent(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _by_bucket(key: np.ndarray, bits: int, *columns: np.ndarray) -> tuple[np.ndarray, list[pa.Array]]:
    """The buckets (first bits) of sorted keys, and the bytes of each column in each of them."""
    bucket = (key >> np.uint64(64 - bits)).view(np.int64)
    found, first = np.unique(bucket, return_index=True)
    ends = np.append(first, len(bucket))
    return found, [_slices(x, ends) for x in columns]


ASKED = ["bucket", "first", "facts", "words", "places"]
FACTS = ["doc_id", "held_out", "n_tokens", "n_head", "base"]


def op7_suffix_tree(spark, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))
