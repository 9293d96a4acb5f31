"""Words of texts as numpy arrays: spans, hashes and windows over a whole Arrow batch at once."""

from __future__ import annotations

from collections.abc import Iterator

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BYTES = np.arange(256)
IN_WORD = ~((_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D)))
#: Bytes of terms: ASCII letters and digits, and all of any other character.
IN_TERM = (_BYTES >= 0x80) | ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES | 0x20 >= 0x61) & (_BYTES | 0x20 <= 0x7A) & (_BYTES >= 0x41))
LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)
#: Text is handled in pieces of about so many bytes, cut between documents.
CHUNK_BYTES = 1 << 20
#: Words beyond this many bytes are hashed one by one.
LONG_WORD = 1024

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every input bit."""
    x = x ^ (x >> _U(30))
    x *= _M1
    x ^= x >> _U(27)
    x *= _M2
    x ^= x >> _U(31)
    return x


def chunks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets from 0) of pieces of a string column; nulls are empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, "right")) - 1)
        to = min(to, len(column))
        yield at, to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


class Words:
    """Word spans of a piece of text: starts, lengths, and the document of each; first[d] is a document's first word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, in_word: np.ndarray = IN_WORD):
        self.data, self.offsets, n = data, offsets, len(offsets) - 1
        inside = in_word[data]
        before = np.zeros(len(data), bool)
        before[1:] = inside[:-1]
        after = np.zeros(len(data), bool)
        after[:-1] = inside[1:]
        begins, ends = offsets[:-1][np.diff(offsets) > 0], offsets[1:][np.diff(offsets) > 0]
        before[begins] = False
        after[ends - 1] = False
        self.starts = np.flatnonzero(inside & ~before)
        self.lengths = np.flatnonzero(inside & ~after) + 1 - self.starts
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(n), self.counts)

    def hashes(self, lower: bool) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        data = np.zeros(len(self.data) + 8, np.uint8)
        data[:-8] = LOWER[self.data] if lower else self.data
        lanes = np.ndarray((len(self.data) + 1,), "<u8", data, 0, (1,))
        out = mix(self.lengths.astype(np.uint64) + _U(0x9E3779B97F4A7C15))
        active, k = np.flatnonzero(self.lengths <= LONG_WORD), 0
        while len(active):
            left = self.lengths[active] - 8 * k
            lane = lanes[self.starts[active] + 8 * k]
            short = left < 8
            lane[short] &= (_U(1) << (left[short].astype(np.uint64) * _U(8))) - _U(1)
            out[active] = mix(out[active] ^ lane)
            active, k = active[left > 8], k + 1
        for i in np.flatnonzero(self.lengths > LONG_WORD):
            word = data[self.starts[i] : self.starts[i] + self.lengths[i]].tobytes()
            out[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return out


def chain(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the windows of k words that start at each place (one array over all documents; the last k - 1 places lack)."""
    n = max(0, len(hashes) - k + 1)
    out = mix(hashes[:n] + _U(k))
    for j in range(1, k):
        out = mix((out * _U(3)) ^ hashes[j : j + n])
    return out


def shingle_sets(words: Words, hashes: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """For each document its distinct k-word shingles, sorted; the whole sequence as one where there are fewer words."""
    whole = chain(hashes, k)
    shorter = {j: chain(hashes, j) for j in range(1, k)}
    for first, n in zip(words.first[:-1].tolist(), words.counts.tolist()):
        if n >= k:
            yield np.unique(whole[first : first + n - k + 1])
        elif n:
            yield shorter[n][first : first + 1].copy()
        else:
            yield hashes[:0]


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
