"""Recursive indicators as scans: a bar's step is an affine map of the state, so chunks of bars are composed.

The averages of a symbol (fast, slow, the signal of their difference, and the
smoothed gains and losses) are a linear recurrence. A chunk of bars, a slice of
time, is summed up by where it takes a state of zero; the states that chunks
start with follow from these few numbers of each chunk, and then every chunk
gives its bars' values by itself. No symbol's bars meet in one place.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.scalars import fields_text

#: Days of a chunk of bars.
CHUNK_DAYS = 64


def groups(batches: Iterator[pa.RecordBatch], key: Sequence[str]) -> Iterator[pa.Table]:
    """The runs of rows with equal keys (not null) of a sorted stream, each whole; one is held at a time."""
    left = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if left is None else pa.concat_tables([left, rows]).combine_chunks()
        if not rows.num_rows:
            continue
        cut = np.zeros(rows.num_rows - 1, bool)
        for k in key:
            column = rows[k].combine_chunks()
            cut |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
        at = [0, *(np.flatnonzero(cut) + 1).tolist()]
        for a, b in zip(at, at[1:]):
            yield rows.slice(a, b - a)
        left = rows.slice(at[-1])
    if left is not None and left.num_rows:
        yield left


def smoothed(values: np.ndarray, share: float, start: float) -> np.ndarray:
    """s = s + share (v - s) along values, in blocks of powers of the decay."""
    out, decay, block = np.empty(len(values)), 1 - share, 64
    powers = decay ** np.arange(block + 1)
    lower = np.tril(share * decay ** np.maximum(np.subtract.outer(np.arange(block), np.arange(block)), 0))
    for a in range(0, len(values), block):
        part = values[a : a + block]
        out[a : a + block] = lower[: len(part), : len(part)] @ part + powers[1 : len(part) + 1] * start
        start = out[min(a + block, len(values)) - 1]
    return out


#: The numbers of a chunk: where it takes averages of zero, and moves of none.
SUMMARY = ("fast", "slow", "signal", "gain", "loss")


class Averages:
    """The recurrence of fast, slow and signal averages of closes, and of gain and loss of moves."""

    def __init__(self, n: int, fast: int, slow: int, signal: int):
        self.fast, self.slow, self.signal, self.move = 2 / (fast + 1), 2 / (slow + 1), 2 / (signal + 1), 1 / n

    def of_closes(self, closes: np.ndarray, start: Sequence[float]) -> list[np.ndarray]:
        fast, slow = smoothed(closes, self.fast, start[0]), smoothed(closes, self.slow, start[1])
        return [fast, slow, smoothed(fast - slow, self.signal, start[2])]

    def of_moves(self, moves: np.ndarray, start: Sequence[float]) -> list[np.ndarray]:
        return [smoothed(np.maximum(moves, 0), self.move, start[0]), smoothed(np.maximum(-moves, 0), self.move, start[1])]

    def summary(self, closes: np.ndarray) -> list[float]:
        inner = self.of_moves(np.diff(closes), (0, 0)) if len(closes) > 1 else [np.zeros(1)] * 2
        return [float(x[-1]) for x in [*self.of_closes(closes, (0, 0, 0)), *inner]]

    def begin(self, state, first: float, second: float | None):
        """Averages before a chunk's first close, and gain and loss after its first move (the second close is asked for a symbol's first chunk only)."""
        if state is None:  # averages start at the first close, gain and loss at the first move
            return (first, first, 0.0), None if second is None else (max(second - first, 0.0), max(first - second, 0.0))
        averages, last, moves = state
        move = first - last
        if moves is None:
            return averages, (max(move, 0.0), max(-move, 0.0))
        return averages, tuple(float(x[-1]) for x in self.of_moves(np.array([move]), moves))

    def onward(self, state, m: int, first: float, second: float | None, last: float, summary: Sequence[float]):
        """The state after a chunk of m closes."""
        averages, moves = self.begin(state, first, second)
        decayed = self.of_closes(np.zeros(m), averages)
        after = tuple(float(d[-1]) + s for d, s in zip(decayed, summary[:3]))
        return after, last, None if moves is None else tuple(x * (1 - self.move) ** (m - 1) + s for x, s in zip(moves, summary[3:]))


def recursive_indicators(bars: DataFrame, key: Sequence[str] = ("symbol",), day: str = "trade_date", close: str = "close", n: int = 14, fast: int = 12, slow: int = 26, signal: int = 9, chunk_days: int = CHUNK_DAYS) -> DataFrame:
    """key, day, ema_fast, ema_slow, macd, signal, histogram and rsi (null for a symbol's first bar) of every bar.

    Averages start at the first close, gain and loss at the first move; rsi is
    null where nothing has moved. One bar a day, no nulls.
    """
    rule = Averages(n, fast, slow, signal)
    placed = bars.select(*key, day, F.col(close).cast("double").alias("_close"), fields_text(*[F.col(k) for k in key]).alias("_key"), F.floor(F.unix_date(F.col(day)) / chunk_days).cast("long").alias("_chunk"))
    dealt = placed.repartition("_key", "_chunk").sortWithinPartitions("_key", "_chunk", day)

    def summed(batches):
        for rows in groups(batches, ("_key", "_chunk")):
            closes = rows["_close"].to_numpy()
            numbers = [float(closes[0]), float(closes[1]) if len(closes) > 1 else None, float(closes[-1]), *rule.summary(closes)]
            yield pa.RecordBatch.from_pydict({"_key": rows["_key"][:1].to_pylist(), "_chunk": rows["_chunk"][:1].to_pylist(), "m": [len(closes)], **{c: [x] for c, x in zip(("first", "second", "last", *SUMMARY), numbers)}}, pa.schema([("_key", pa.string()), ("_chunk", pa.int64()), ("m", pa.int64()), *[(c, pa.float64()) for c in ("first", "second", "last", *SUMMARY)]]))

    chunks = dealt.mapInArrow(summed, "_key string, _chunk long, m long, first double, second double, last double, " + ", ".join(f"{c} double" for c in SUMMARY))

    def started(batches):
        """The state before each chunk; of a symbol one row a chunk is read."""
        for rows in groups(batches, ("_key",)):
            state, out = None, []
            for r in rows.to_pylist():
                averages, last, moves = state or ((None,) * 3, None, None)
                out.append({"_key": r["_key"], "_chunk": r["_chunk"], "started": state is not None, "averages": list(averages), "before": last, "moves": None if moves is None else list(moves)})
                state = rule.onward(state, r["m"], r["first"], r["second"], r["last"], [r[c] for c in SUMMARY])
            yield pa.RecordBatch.from_pylist(out, pa.schema([("_key", pa.string()), ("_chunk", pa.int64()), ("started", pa.bool_()), ("averages", pa.list_(pa.float64())), ("before", pa.float64()), ("moves", pa.list_(pa.float64()))]))

    states = chunks.repartition("_key").sortWithinPartitions("_key", "_chunk").mapInArrow(started, "_key string, _chunk long, started boolean, averages array<double>, before double, moves array<double>")
    joined = placed.join(states, ["_key", "_chunk"]).repartition("_key", "_chunk").sortWithinPartitions("_key", "_chunk", day)
    names = ("ema_fast", "ema_slow", "macd", "signal", "histogram", "rsi")

    def unfolded(batches):
        for rows in groups(batches, ("_key", "_chunk")):
            closes, head = rows["_close"].to_numpy(), rows.slice(0, 1).to_pylist()[0]
            state = (tuple(head["averages"]), head["before"], None if head["moves"] is None else tuple(head["moves"])) if head["started"] else None
            averages, moves = rule.begin(state, float(closes[0]), float(closes[1]) if len(closes) > 1 else None)
            quick, long, line = rule.of_closes(closes, averages)
            if moves is None:
                gain, loss = np.full((2, 1), np.nan)
            elif len(closes) == 1:
                gain, loss = (np.array([x]) for x in moves)
            else:
                gain, loss = (np.concatenate([[x], y]) for x, y in zip(moves, rule.of_moves(np.diff(closes), moves)))
            if state is None:
                gain[0] = np.nan
            total = gain + loss
            with np.errstate(divide="ignore", invalid="ignore"):
                rsi = np.where(total > 0, 100 * gain / total, np.nan)
            macd = quick - long
            columns = [*[rows[c].combine_chunks() for c in (*key, day)], *[pa.array(x) for x in (quick, long, macd, line, macd - line)], pa.array(rsi, mask=np.isnan(rsi))]
            yield pa.RecordBatch.from_arrays(columns, names=[*key, day, *names])

    schema = StructType([*bars.select(*key, day).schema.fields, *StructType.fromDDL(", ".join(f"{c} double" for c in names)).fields])
    return joined.mapInArrow(unfolded, schema)
