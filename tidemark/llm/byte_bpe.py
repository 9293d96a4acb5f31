"""Byte-level BPE encoding and decoding by recursive DuckDB queries inside tasks.

Texts are cut into words by the tokenizer's pattern; the words that are new to
the task go to a DuckDB query as rows of word, position and byte token. Each
turn of its recursion joins neighbours with the merge table, takes every word's
leftmost pair of the least rank and contracts it, until no word has a pair
left. An ordered aggregation over the token positions joins the tokens' bytes
back and so decodes each word; a text's ids and bytes are those of its words in
order.

Scale: one narrow pass over the texts; nothing is shuffled. The merge table
(about twice the vocabulary) is built by each task from the rank file, whose
bytes are broadcast, and goes with the task. Texts wait, at most ``HELD_BYTES`` of them,
until ``QUERY_WORDS`` new words have come together; a word is kept with its ids
and merged once, until the kept words take more than ``CACHE_BYTES``.

Defined cases: a null text is empty and has no ids; any characters, special
tokens' names included, are ordinary text; a word that is itself in the
vocabulary is that token; words of more than ``LONG_WORD`` bytes, for which a
turn per merge would cost the square of their length, are merged in the same
order from a heap; repeated rows are encoded each; an empty table gives no
rows; other columns are not used, but ``encode`` keeps them in front of its own.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections import deque
from collections.abc import Iterable, Iterator, Sequence
from contextlib import closing
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import table
from tidemark.llm.tokens import chunks

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: About so many bytes of memory for the words that a worker knows.
CACHE_BYTES = 64 << 20
#: Bytes of text that wait for new words to come together.
HELD_BYTES = 4 << 20
#: Words in one recursive query.
QUERY_WORDS = 30_000
LONG_WORD = 2000
#: A recursive query keeps the rows of all its turns, about half the sum of its words' squared lengths.
QUERY_SQUARES = 8_000_000

MERGE_SQL = """
WITH RECURSIVE state(word, pos, next_pos, token, next_token, turn) AS (
  SELECT word, pos, lead(pos) OVER w, token, lead(token) OVER w, 0 FROM start_tokens WINDOW w AS (PARTITION BY word ORDER BY pos)
  UNION ALL
  (WITH least AS (
     SELECT s.word, min((m.merged::BIGINT << 32) | s.pos) AS pair, arg_min(s.next_pos, (m.merged::BIGINT << 32) | s.pos) AS gone_pos
     FROM state s JOIN merges m ON m.left_token = s.token AND m.right_token = s.next_token GROUP BY s.word),
   pair AS (
     SELECT l.word, (l.pair & 4294967295)::INT AS at, (l.pair >> 32)::INT AS merged, l.gone_pos, s.next_pos, s.next_token
     FROM least l JOIN state s ON s.word = l.word AND s.pos = l.gone_pos)
   SELECT s.word, s.pos,
     CASE WHEN s.pos = p.at THEN p.next_pos ELSE s.next_pos END,
     CASE WHEN s.pos = p.at THEN p.merged ELSE s.token END,
     CASE WHEN s.pos = p.at THEN p.next_token WHEN s.next_pos = p.at THEN p.merged ELSE s.next_token END,
     s.turn + 1
   FROM state s JOIN pair p ON s.word = p.word WHERE s.pos <> p.gone_pos)
), last_turn AS (SELECT word, max(turn) AS turn FROM state GROUP BY word)
SELECT s.word, list(s.token ORDER BY s.pos) AS ids, string_agg(v.hex, '' ORDER BY s.pos) AS decoded
FROM state s JOIN last_turn USING (word, turn) JOIN vocabulary v ON v.token = s.token GROUP BY s.word ORDER BY s.word
"""


def read_ranks(lines: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines.splitlines()) if token}


class Numbers(dict):
    """Words by number; a new word gets the next one."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


class Encoder:
    """Words to ids and back, in one task."""

    def __init__(self, lines: bytes, pattern: str):
        import duckdb
        import regex

        self.ranks = read_ranks(lines)
        self.tokens = {i: t for t, i in self.ranks.items()}
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.words = regex.compile(pattern).findall
        self.forget()
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "150MB", "temp_directory": ""})
        merges = [(self.ranks[t[:i]], self.ranks[t[i:]], rank) for t, rank in self.ranks.items() for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks]
        left, right, merged = (pa.array(x, pa.int32()) for x in zip(*merges))
        self.db.register("_merges", pa.table({"left_token": left, "right_token": right, "merged": merged}))
        self.db.register("_vocabulary", pa.table({"token": pa.array(self.tokens, pa.int32()), "hex": [t.hex() for t in self.tokens.values()]}))
        self.db.execute("CREATE TABLE merges AS FROM _merges")
        self.db.execute("CREATE TABLE vocabulary AS FROM _vocabulary")

    def close(self) -> None:
        self.forget()
        self.db.close()

    def forget(self) -> None:
        self.numbers = Numbers()
        self.ids: list[bytes] = []  # of each word by number, as little-endian 32 bits
        self.decoded: list[bytes] = []
        self.kept_bytes = 0

    def contract(self, words: list[bytes]) -> tuple[list[bytes], list[bytes]]:
        """ids (as their bytes) and decoded bytes of each of the words, none of them empty."""
        whole = np.array([self.ranks.get(w, -1) for w in words], np.int32)
        data = [b"\0" if r >= 0 else w for w, r in zip(words, whole.tolist())]
        lengths = np.array([len(d) for d in data])
        first = np.cumsum(lengths) - lengths
        word = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
        pos = (np.arange(lengths.sum()) - np.repeat(first, lengths)).astype(np.int32)
        token = self.byte_ids[np.frombuffer(b"".join(data), np.uint8)]
        token[first[whole >= 0]] = whole[whole >= 0]
        self.db.register("start_tokens", pa.table({"word": word, "pos": pos, "token": token}))
        found = self.db.sql(MERGE_SQL).to_arrow_table().combine_chunks()
        ids = found["ids"].chunk(0) if isinstance(found["ids"], pa.ChunkedArray) else found["ids"]
        at, flat = (4 * ids.offsets.to_numpy().astype(np.int64)).tolist(), ids.values.to_numpy().astype("<u4").tobytes()
        decoded = found["decoded"].to_pylist()
        ends = np.cumsum([len(d) // 2 for d in decoded]).tolist()
        raw = bytes.fromhex("".join(decoded))
        return [flat[a:b] for a, b in zip(at, at[1:])], [raw[a:b] for a, b in zip([0, *ends], ends)]

    def contract_long(self, word: bytes) -> np.ndarray:
        """The same contraction for one very long word: the leftmost pair of the least rank, from a heap."""
        token = self.byte_ids[np.frombuffer(word, np.uint8)].tolist()
        end = list(range(1, len(word) + 1))  # of the token that starts at a place; the next token starts there
        before, alive = list(range(-1, len(word) - 1)), [True] * len(word)
        rank_of = lambda i: self.ranks.get(word[i : end[end[i]]] if end[i] < len(word) else b"")  # noqa: E731  is the pair's bytes' rank
        heap = [(r, i, end[end[i]]) for i in range(len(word) - 1) if (r := self.ranks.get(word[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, to = heapq.heappop(heap)
            if not alive[i] or end[i] >= len(word) or end[end[i]] != to:
                continue
            alive[end[i]], end[i], token[i] = False, to, rank
            if to < len(word):
                before[to] = i
                if (r := rank_of(i)) is not None:
                    heapq.heappush(heap, (r, i, end[to]))
            if (j := before[i]) >= 0 and (r := rank_of(j)) is not None:
                heapq.heappush(heap, (r, j, to))
        return np.array([t for t, a in zip(token, alive) if a], np.uint32)

    def contract_mixed(self, words: list[bytes]) -> tuple[list[bytes], list[bytes]]:
        """As contract, for words of which some are very long."""
        short = [w for w in words if len(w) <= LONG_WORD]
        found = zip(*self.contract(short)) if short else iter(())
        out = []
        for w in words:
            if len(w) <= LONG_WORD:
                out.append(next(found))
            else:
                merged = self.contract_long(w)
                out.append((merged.astype("<u4").tobytes(), b"".join([self.tokens[i] for i in merged.tolist()])))
        return [i for i, _ in out], [d for _, d in out]

    def learn(self, words: list[str]) -> None:
        """ids and decoded bytes of the words with the next numbers."""
        raw = [w.encode() for w in words]
        squares = np.cumsum([min(len(w), LONG_WORD) ** 2 for w in raw])
        start = 0
        while start < len(raw):
            before = squares[start - 1] if start else 0
            end = min(start + QUERY_WORDS, max(start + 1, int(np.searchsorted(squares, before + QUERY_SQUARES, "right"))))
            part, start = raw[start:end], end
            ids, decoded = self.contract(part) if max(map(len, part)) <= LONG_WORD else self.contract_mixed(part)
            self.ids += ids
            self.decoded += decoded
            self.kept_bytes += sum(map(len, ids)) + 2 * sum(map(len, part)) + 250 * len(part)

    def encode(self, pieces: Iterable[list[str]]) -> Iterator[list[tuple[bytes, bytes]]]:
        """For each piece, a list of texts, the ids (as their bytes) and decoded bytes of each text; pieces wait until enough new words have come together."""
        held: list[list[list[int]]] = []
        waiting = 0

        def handed_on():
            self.learn(list(islice(self.numbers, len(self.ids), None)))
            for piece in held:
                yield [(b"".join(map(self.ids.__getitem__, numbers)), b"".join(map(self.decoded.__getitem__, numbers))) for numbers in piece]
            if self.kept_bytes > CACHE_BYTES:
                self.forget()

        for texts in pieces:
            held.append([list(map(self.numbers.__getitem__, self.words(t))) for t in texts])
            waiting += sum(map(len, texts))
            if len(self.numbers) - len(self.ids) >= QUERY_WORDS or waiting >= HELD_BYTES:
                yield from handed_on()
                held, waiting = [], 0
        yield from handed_on()


def encode(docs: DataFrame, ranks: bytes, pattern: str, keep: Sequence[str] = ("ids", "decoded")) -> DataFrame:
    """docs without its text but with n_tokens, ids_sha256, decoded_sha256 and, as kept, the ids and the decoded bytes."""
    shared = docs.sparkSession.sparkContext.broadcast((ranks, pattern))
    kinds = {"n_tokens": T.LongType(), "ids_sha256": T.StringType(), "decoded_sha256": T.StringType()} | {k: {"ids": T.ArrayType(T.IntegerType()), "decoded": T.BinaryType()}[k] for k in keep}
    own = [c for c in docs.columns if c != "text" and c not in kinds]

    def encoded(batches):
        waiting: deque[pa.RecordBatch] = deque()

        def pieces():
            for batch in batches:
                for at, to, _, _ in chunks(batch.column("text")):
                    waiting.append(batch.slice(at, to - at).select(own))
                    yield [t or "" for t in batch.column("text")[at:to].to_pylist()]

        # a worker outlives its task: the encoder, with its tables and words, doesn't
        with closing(Encoder(*shared.value)) as bpe:
            yield from columns_of(bpe.encode(pieces()), waiting)

    def columns_of(results, waiting):
        for found in results:
            columns = {
                "n_tokens": pa.array([len(i) // 4 for i, _ in found], pa.int64()),
                "ids_sha256": pa.array([hashlib.sha256(i).hexdigest() for i, _ in found], pa.string()),
                "decoded_sha256": pa.array([hashlib.sha256(d).hexdigest() for _, d in found], pa.string()),
            }
            if "ids" in keep:
                columns["ids"] = pa.array([np.frombuffer(i, "<i4") for i, _ in found], pa.list_(pa.int32()))
            if "decoded" in keep:
                columns["decoded"] = pa.array([d for _, d in found], pa.binary())
            yield pa.RecordBatch.from_arrays([*waiting.popleft().columns, *[columns[c] for c in kinds]], names=[*own, *kinds])

    schema = T.StructType([*docs.select(*own).schema.fields, *[T.StructField(c, kind) for c, kind in kinds.items()]])
    return docs.select(*own, "text").mapInArrow(encoded, schema)


def public_vocabulary(name: str = VOCABULARY) -> tuple[bytes, str]:
    """The rank file's bytes and the pattern of the public tokenizers' folder."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as f:
        return f.read(), public_tokenizers.PATTERN


def op10_byte_bpe(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id"), "text")
    return encode(docs, *public_vocabulary(), keep=())
