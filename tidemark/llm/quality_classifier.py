"""Document quality by attention-based multiple-instance learning.

A text is a bag of passages of ``PASSAGE_WORDS`` words. Each passage has a
vector of surface features (byte classes, shapes of words, repetition), which a
learned layer encodes; gated attention, tanh(Vh) times sigmoid(Uh), weighs the
passages of a document, and the weighted mean of the encodings gives the score
by logistic regression. All weights are learned together from document labels
by Adam on the log loss.

The fit uses a bounded sample: the ``FIT_ROWS`` labelled rows with the smallest
hash of their id among those outside the held-out fold, without texts of more
than ``FIT_TEXT_PASSAGES`` passages, and of these as many as have
``FIT_PASSAGES`` passages in all. Scoring covers every passage of every
document in one pass in Arrow batches; only the weights, some thousand numbers,
are broadcast, and nothing is shuffled.

Labels, language, source and id are never features. Defined cases: a null,
empty or blank text is a bag of one empty passage; labels without quality or
id do not count, and of several for one id the smallest holds; without labels
of both classes the score is the share of label 1 in the sample (1 without any
labels); repeated rows get equal scores; an empty table gives no rows; other
columns are not used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialise, table
from tidemark.llm.tokens import Words, chain, chunks

PASSAGE_WORDS = 64
FIT_ROWS = 6000
FIT_PASSAGES = 150_000
#: The longest texts to learn from, so that no single one uses the sample up; longer ones are scored like all.
FIT_TEXT_PASSAGES = 5000
FOLDS = 5
THRESHOLD = 0.3
ENCODING, ATTENTION = 16, 8
EPOCHS, RATE, DECAY, SEED = 400, 0.02, 1e-4, 7

_B = np.arange(256)
_UPPER, _LOWER, _DIGIT = (_B >= 65) & (_B <= 90), (_B >= 97) & (_B <= 122), (_B >= 48) & (_B <= 57)
_PUNCT = ((_B >= 33) & (_B <= 126)) & ~(_UPPER | _LOWER | _DIGIT)
#: Byte classes: each ASCII punctuation mark by itself, then upper, lower, digit, beyond ASCII, gap.
_CLASS = np.full(256, _PUNCT.sum() + 4)
_CLASS[_PUNCT] = np.arange(_PUNCT.sum())
_CLASS[_UPPER], _CLASS[_LOWER], _CLASS[_DIGIT], _CLASS[_B >= 128] = (_PUNCT.sum() + i for i in range(4))
CLASSES = int(_PUNCT.sum()) + 5
FEATURES = CLASSES + 8


def passage_features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """A row of features for each passage, and the first passage of each document (with the total at the end)."""
    n_docs, n_words = len(words.counts), len(words.starts)
    per_doc = np.maximum(1, -(-words.counts // PASSAGE_WORDS))
    first = np.concatenate([[0], np.cumsum(per_doc)])
    n = int(first[-1])
    x = np.zeros((n, FEATURES), np.float32)
    if n_words:
        of_word = first[words.doc] + (np.arange(n_words) - words.first[words.doc]) // PASSAGE_WORDS
        ends = words.starts + words.lengths
        # bytes belong to the passage of the word that they are in or follow
        spans = np.diff(np.concatenate([words.starts, [len(words.data)]]))
        of_byte = np.repeat(of_word, spans)
        kinds = _CLASS[words.data[words.starts[0] :]]
        byte_counts = np.bincount(of_byte * CLASSES + kinds, minlength=n * CLASSES).reshape(n, CLASSES)
        x[:, :CLASSES] = np.sqrt(byte_counts / np.maximum(1, byte_counts.sum(1, keepdims=True)))
        size = np.bincount(of_word, minlength=n)
        of = lambda flags: np.bincount(of_word, weights=flags, minlength=n) / np.maximum(1, size)
        cumulative = lambda flags: np.concatenate([[0], np.cumsum(flags)])
        inside = lambda table: (lambda c: c[ends] - c[words.starts])(cumulative(table[words.data]))
        upper, lower, punct = inside(_UPPER), inside(_LOWER), inside(_PUNCT)
        hashes = words.hashes(lower=True)
        again = np.zeros(n_words, bool)
        again[1:] = (hashes[1:] == hashes[:-1]) & (of_word[1:] == of_word[:-1])
        order = np.lexsort((hashes, of_word))
        seen = np.zeros(n_words, bool)
        seen[order[1:]] = (hashes[order][1:] == hashes[order][:-1]) & (of_word[order][1:] == of_word[order][:-1])
        pair = np.zeros(n_words, bool)
        if n_words > 1:
            pairs, at = chain(hashes, 2), of_word[:-1]
            order = np.lexsort((pairs, at))
            pair[order[1:]] = (pairs[order][1:] == pairs[order][:-1]) & (at[order][1:] == at[order][:-1])
        rest = [of((upper > 1) & (lower == 0)), of(punct > 1), of(punct == words.lengths), of(again), of(seen), of(pair), np.minimum(2.0, of(words.lengths) / 10), np.log1p(size) / 5]
        x[:, CLASSES:] = np.stack(rest, 1)
    assert len(first) == n_docs + 1
    return x, first


def batch_features(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for at, to, data, offsets in chunks(texts):
        yield at, to, *passage_features(Words(data, offsets))


def forward(p: dict[str, np.ndarray], x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
    """Encodings, attention and scores of documents whose passages are the rows of x."""
    return attend(p, (x - p["mean"]) / p["scale"], first)


def attend(p: dict[str, np.ndarray], inputs: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
    """As forward, with standardised features."""
    start, per_doc = first[:-1], np.diff(first)
    h = np.tanh(inputs @ p["W"] + p["b"])
    gate_t, gate_s = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
    raw = (gate_t * gate_s) @ p["w"]
    e = np.exp(raw - np.repeat(np.maximum.reduceat(raw, start), per_doc))
    a = e / np.repeat(np.add.reduceat(e, start), per_doc)
    z = np.add.reduceat(h * a[:, None], start)
    return {"h": h, "t": gate_t, "s": gate_s, "a": a, "z": z, "score": 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"], -30, 30)))}


def gradients(p: dict[str, np.ndarray], inputs: np.ndarray, first: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """The derivative of the mean log loss by each weight."""
    start, per_doc = first[:-1], np.diff(first)
    f = attend(p, inputs, first)
    dlogit = (f["score"] - y) / len(y)
    g = {"c": f["z"].T @ dlogit, "d": np.array([dlogit.sum()])}
    dz = np.repeat(dlogit[:, None] * p["c"], per_doc, axis=0)
    da = (dz * f["h"]).sum(1)
    draw_ = f["a"] * (da - np.repeat(np.add.reduceat(f["a"] * da, start), per_doc))
    g["w"] = (f["t"] * f["s"]).T @ draw_
    dgate = draw_[:, None] * p["w"]
    dt, ds = dgate * f["s"] * (1 - f["t"] ** 2), dgate * f["t"] * f["s"] * (1 - f["s"])
    g["V"], g["U"] = f["h"].T @ dt, f["h"].T @ ds
    dh = (dz * f["a"][:, None] + dt @ p["V"].T + ds @ p["U"].T) * (1 - f["h"] ** 2)
    g["W"], g["b"] = inputs.T @ dh, dh.sum(0)
    return g


def fit(x: np.ndarray, first: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray] | float:
    """Weights learned from bags of passages and document labels; a constant where there is one class only."""
    if not len(y) or y.min() == y.max():
        return float(y.mean()) if len(y) else 1.0
    rng = np.random.default_rng(SEED)
    draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
    inputs = x.astype(np.float64)
    fixed = {"mean": inputs.mean(0), "scale": inputs.std(0) + 0.02}
    inputs -= fixed["mean"]
    inputs /= fixed["scale"]
    p = {"W": draw(FEATURES, ENCODING), "b": np.zeros(ENCODING), "V": draw(ENCODING, ATTENTION), "U": draw(ENCODING, ATTENTION), "w": draw(ATTENTION), "c": draw(ENCODING), "d": np.zeros(1)}
    m, v = ({k: np.zeros_like(a) for k, a in p.items()} for _ in range(2))
    for step in range(1, EPOCHS + 1):
        g = gradients(p, inputs, first, y)
        for k in p:
            grad = g[k] + DECAY * p[k]
            m[k], v[k] = 0.9 * m[k] + 0.1 * grad, 0.999 * v[k] + 0.001 * grad**2
            p[k] = p[k] - RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return p | fixed


def held_out(doc_id=None, folds: int = FOLDS):
    """Whether a row is outside the fit: crc32 of the id as text modulo folds is 0 (a null id counts as an empty text)."""
    return F.crc32(F.coalesce(F.col(doc_id or "doc_id").cast("string"), F.lit("")).cast("binary")) % folds == 0


def learn(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, fit_passages: int = FIT_PASSAGES, text_passages: int = FIT_TEXT_PASSAGES) -> dict[str, np.ndarray] | float:
    """Fit on the bounded sample; labels has doc_id and quality."""
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").filter(~held_out()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows).select(F.col("doc_id").alias("_id"), F.col("quality").cast("double").alias("y"))
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("_id")).groupBy("doc_id").agg(F.min("text").alias("text"), F.min("y").alias("y"))

    def features(batches):
        for batch in batches:
            y = batch.column("y").to_numpy(zero_copy_only=False)
            for at, to, x, first in batch_features(batch.column("text")):
                rows = [x[a:b].astype(np.float32).tobytes() for a, b in zip(first[:-1], first[1:])]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")[at:to], pa.array(y[at:to]), pa.array(rows, pa.binary()), pa.array(np.diff(first))], names=["doc_id", "y", "x", "n"])

    bags = materialise(chosen.mapInArrow(features, "doc_id long, y double, x binary, n long"), "bags")
    within = bags.select("doc_id", "n").filter(F.col("n") <= text_passages).withColumn("_sum", F.sum("n").over(Window.orderBy(F.xxhash64("doc_id"), "doc_id"))).filter(F.col("_sum") <= fit_passages).select("doc_id")
    bags = bags.join(F.broadcast(within), "doc_id", "left_semi").orderBy("doc_id").toArrow()
    if not bags.num_rows:
        return 1.0
    x = np.frombuffer(b"".join(bags["x"].to_pylist()), np.float32).reshape(-1, FEATURES)
    first, y = np.concatenate([[0], np.cumsum(bags["n"].to_numpy())]), bags["y"].to_numpy()
    del bags
    return fit(x, first, y)


def batch_scores(texts: pa.Array, model: dict[str, np.ndarray] | float) -> tuple[np.ndarray, np.ndarray]:
    """Score and number of passages of each row."""
    score, passages = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
    for at, to, x, first in batch_features(texts):
        score[at:to] = model if isinstance(model, float) else forward(model, x, first)["score"]
        passages[at:to] = np.diff(first)
    return score, passages


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted and n_passages for every document."""
    shared = docs.sparkSession.sparkContext.broadcast(learn(docs, labels))

    def scored(batches):
        for batch in batches:
            score, passages = batch_scores(batch.column("text"), shared.value)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score), pa.array(passages)], names=["doc_id", "score", "n_passages"])

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scored, "doc_id long, score double, n_passages long")
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "n_passages")


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that the classifier accepts, unchanged; only texts go to Python and only scores come back."""
    shared = docs.sparkSession.sparkContext.broadcast(learn(docs, labels))

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(batch_scores(texts, shared.value)[0])

    return docs.filter(score("text") >= threshold)


def op5_quality_classifier(spark, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").select("doc_id", "quality"))
