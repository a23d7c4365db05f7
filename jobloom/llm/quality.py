"""Quality scores from random-indexing word vectors and a small network.

1. Word vectors. Words (runs of letters in lower case) and marks (runs of other characters) are
   hashed into a vocabulary of fixed size; each entry has a fixed sparse random index vector. A word's
   vector is the sum of the index vectors of its neighbours within `SPAN`, over all documents, at
   length 1. The same pass counts the documents that hold the word.
2. A document's features are pooled from the vectors of its words in order: their mean, weighted by
   the words' rarity, their deviation from it, and the mean product of neighbours, by dimension. The
   last says how well words fit those beside them. Nothing else is known of a document.
3. A two-layer network in numpy is fitted on a bounded sample of labelled rows (`SAMPLE`, those whose
   ids hash lowest) and its logits are divided by a temperature fitted on a fifth of the rows, which
   it was not trained on.

Word vectors and scores cover all documents and whole texts. Only tables of fixed size are broadcast.

Defined cases: null and empty texts get the score of a document without words; labels that are null
or belong to no document aren't used; of several labels of a document the least counts, of several
texts with one id that of the least hash; with no usable label, or one class only, every score is the
share of label 1 (0.5 without labels); with fewer than five labels none is set aside and the
temperature is 1; repeated rows get a score each; an empty table gives an empty result. Other columns
are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from jobloom.llm.batches import LOWER, Texts, Words, map_texts, mix, texts_of, word_hashes
from jobloom.llm.langid import in_fold

BITS = 15
VOCABULARY = 1 << BITS
DIMS = 64
NONZERO = 4
SPAN = 2
# Tables of sums are added in groups of a few dozen, this many groups at a time.
GROUPS = (1024, 32, 1)
# Words whose vectors are in memory at once.
PIECE = 1 << 13
SAMPLE = 20_000
HIDDEN = 32
STEPS = 600
SEED = 7

# Words are runs of letters (ASCII, or any byte of a longer character), marks what is between.
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 9, 10, 11, 12, 13]] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


def _index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zero entries of each index vector."""
    ids = np.arange(VOCABULARY * NONZERO, dtype=np.uint64).reshape(VOCABULARY, NONZERO)
    h = mix(ids + np.uint64(0x9E3779B97F4A7C15))
    return (h % np.uint64(DIMS)).astype(np.int64), np.where(h >> np.uint64(63), 1, -1)


class Tokens:
    """Vocabulary entries of the words and marks of a slice, in order, and their rows."""

    def __init__(self, t: Texts):
        letters = Texts(t.batch, t.column, LOWER[t.data], t.offsets)
        words, marks = Words(letters, ~_LETTER), Words(letters, _LETTER | _BLANK)
        order = np.argsort(np.concatenate([words.starts, marks.starts]), kind="stable")
        hashes = np.concatenate([word_hashes(letters.data, words), word_hashes(letters.data, marks)])
        self.ids = (hashes[order] >> np.uint64(64 - BITS)).astype(np.int64)
        self.rows = np.concatenate([words.rows, marks.rows])[order]


class WordVectors:
    """A unit vector and a weight for each entry of the vocabulary."""

    def __init__(self, sums: np.ndarray, holders: np.ndarray, documents: int):
        length = np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
        self.vectors = (sums / length).astype(np.float32)
        self.weights = (np.log((1 + documents) / (1 + holders)) + 1).astype(np.float32)


# Sums of vectors, then the documents that hold each entry, then all documents.
TOTALS = VOCABULARY * DIMS + VOCABULARY + 1


def add_counts(total: np.ndarray, t: Texts) -> None:
    """Add the neighbours and documents of a slice."""
    place, sign = _index_vectors()
    tokens = Tokens(t)
    for step in range(1, SPAN + 1):
        near = np.flatnonzero(tokens.rows[step:] == tokens.rows[:-step])
        a, b = tokens.ids[near], tokens.ids[near + step]
        for own, other in ((a, b), (b, a)):
            for j in range(NONZERO):
                np.add.at(total, own * DIMS + place[other, j], sign[other, j])
    held = np.unique(tokens.rows << BITS | tokens.ids) & (VOCABULARY - 1)
    total[VOCABULARY * DIMS:-1] += np.bincount(held, minlength=VOCABULARY)
    total[-1] += len(t)


def _sum_packed(table: pa.Table) -> pa.Table:
    total = np.zeros(TOTALS, np.int64)
    for packed in table.column("sums").to_pylist():
        total += np.frombuffer(zlib.decompress(packed), np.int64)
    return pa.table({"salt": pa.array([table.column("salt")[0].as_py()], pa.int32()),
                     "sums": [zlib.compress(total.tobytes(), 1)]})


def word_vectors(docs: DataFrame, text: str = "text") -> WordVectors:
    """The vectors of the vocabulary, from all documents."""
    def work(batches):
        total = np.zeros(TOTALS, np.int64)
        for batch in batches:
            for t in texts_of(batch, "_text"):
                add_counts(total, t)
        salt = TaskContext.get().partitionId() % GROUPS[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array([salt], pa.int32()), pa.array([zlib.compress(total.tobytes(), 1)])],
            ["salt", "sums"])

    kind = "salt int, sums binary"
    sums = docs.select(F.col(text).alias("_text")).mapInArrow(work, kind)
    for n in GROUPS:
        sums = sums.withColumn("salt", F.col("salt") % n).groupBy("salt").applyInArrow(_sum_packed, kind)
    total = np.zeros(TOTALS, np.int64)
    for row in sums.collect():
        total += np.frombuffer(zlib.decompress(row.sums), np.int64)
    size = VOCABULARY * DIMS
    return WordVectors(total[:size].reshape(VOCABULARY, DIMS), total[size:-1], int(total[-1]))


def features(t: Texts, known: WordVectors) -> np.ndarray:
    """The pooled vectors of each row: mean, deviation and mean product of neighbours."""
    tokens, n = Tokens(t), len(t)
    out = np.zeros((n, 3 * DIMS), np.float32)
    bounds = np.searchsorted(tokens.rows, np.arange(n + 1)).tolist()
    for row, (start, end) in enumerate(zip(bounds, bounds[1:])):
        sums, squares, products = np.zeros((3, DIMS))
        weight = 0.0
        for low in range(start, end, PIECE):
            high = min(low + PIECE, end)
            # One more word, for the last one's neighbour.
            ids = tokens.ids[low:min(high + 1, end)]
            vectors, own = known.vectors[ids], known.weights[ids[:high - low]]
            products += np.einsum("ij,ij->j", vectors[1:], vectors[:-1])
            vectors = vectors[:high - low]
            sums += own @ vectors
            squares += own @ (vectors * vectors)
            weight += own.sum(dtype=float)
        if end > start:
            mean = sums / weight
            out[row] = np.concatenate([mean, np.sqrt(np.maximum(squares / weight - mean * mean, 0)),
                                       products / (end - start)])
    return out


def _logits(x, weights):
    w1, b1, w2, b2 = weights
    hidden = np.maximum(x @ w1 + b1, 0)
    return hidden, hidden @ w2 + b2


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def gradients(x: np.ndarray, y: np.ndarray, weights: list, decay: float) -> list:
    """Of the mean log loss and half the decay times the squares of the layers' weights."""
    hidden, z = _logits(x, weights)
    error = (_sigmoid(z) - y) / len(y)
    back = np.outer(error, weights[2]) * (hidden > 0)
    return [x.T @ back + decay * weights[0], back.sum(axis=0),
            hidden.T @ error + decay * weights[2], np.array([error.sum()])]


def log_loss(z: np.ndarray, y: np.ndarray) -> float:
    p = _sigmoid(z)
    return float(-np.mean(y * np.log(p + 1e-12) + (1 - y) * np.log(1 - p + 1e-12)))


class Network:
    """Two layers with standardised inputs and a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, epochs: int = 60, rate: float = 3e-3,
                 decay: float = 1e-4):
        self.constant = None
        if not len(y) or y.min() == y.max():
            self.constant = float(y.mean()) if len(y) else 0.5
            return
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        x = (x - self.mean) / self.scale
        rng = np.random.default_rng(SEED)
        order = rng.permutation(len(y))
        held, own = order[:len(y) // 5], order[len(y) // 5:]
        d = x.shape[1]
        weights = [rng.normal(0, (2 / d) ** 0.5, (d, HIDDEN)), np.zeros(HIDDEN),
                   rng.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(1)]
        first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
        step, batches = 0, max(1, len(own) // 128)
        for _ in range(max(epochs, -(-STEPS // batches))):
            for batch in np.array_split(rng.permutation(own), batches):
                step += 1
                for i, g in enumerate(gradients(x[batch], y[batch], weights, decay)):
                    first[i] = 0.9 * first[i] + 0.1 * g
                    second[i] = 0.999 * second[i] + 0.001 * g * g
                    weights[i] = weights[i] - rate * (first[i] / (1 - 0.9**step)) / (
                        np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
        self.weights, self.temperature = weights, 1.0
        if len(held):
            z = _logits(x[held], weights)[1]
            grid = np.exp(np.linspace(np.log(0.25), np.log(8), 61))
            self.temperature = float(grid[int(np.argmin([log_loss(z / t, y[held]) for t in grid]))])

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return _sigmoid(_logits((x - self.mean) / self.scale, self.weights)[1] / self.temperature)


def fit(docs: DataFrame, labelled: DataFrame, vectors, sample: int = SAMPLE) -> Network:
    """labelled: (key, label) with one row per key; docs: (key, text)."""
    chosen = labelled.orderBy(F.xxhash64("key"), "key").limit(sample)
    rows = docs.join(F.broadcast(chosen), "key")

    def work(slices):
        for t in slices:
            x = features(t, vectors.value)
            yield pa.RecordBatch.from_arrays(
                [t.values("key"), t.values("h"), t.values("label"),
                 pa.array(list(x), pa.list_(pa.float32()))], ["key", "h", "label", "x"])

    kind = docs.schema["key"].dataType.simpleString()
    rows = rows.withColumn("h", F.xxhash64("text"))
    found = map_texts(rows, "text", f"key {kind}, h bigint, label double, x array<float>", work)
    # Rows that repeat a key count once; the order makes the fit the same on each run.
    found = found.groupBy("key").agg(F.min(F.struct("h", "label", "x")).alias("row"))
    found = found.select("key", "row.label", "row.x").toPandas().sort_values("key")
    x = np.stack(found["x"].tolist()).astype(float) if len(found) else np.empty((0, 3 * DIMS))
    return Network(x, found["label"].to_numpy(float))


def score_quality(docs: DataFrame, labels: DataFrame, parts: int = 5, held_out: int = 0,
                  threshold: float = 0.3, sample: int = SAMPLE, *, key: str = "doc_id",
                  text: str = "text", label: str = "quality") -> DataFrame:
    """key, held_out, score and predicted of each document; labels of the held-out fold and of
    rows without key are not used."""
    context = docs.sparkSession.sparkContext
    vectors = context.broadcast(word_vectors(docs, text))
    out: Column = in_fold(F.col(key), parts, held_out)
    known = (labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull() & ~out)
             .groupBy(F.col(key).alias("key")).agg(F.min(label).cast("double").alias("label")))
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    known = known.join(rows.select("key").distinct(), "key", "left_semi")
    network = context.broadcast(fit(rows, known, vectors, sample))
    kind = docs.schema[key].dataType.simpleString()

    def work(slices):
        for t in slices:
            scores = network.value.score(features(t, vectors.value).astype(np.float64))
            yield pa.RecordBatch.from_arrays(
                [t.values("key"), t.values("held_out"), pa.array(scores, pa.float64())],
                ["key", "held_out", "score"])

    marked = docs.select(F.col(key).alias("key"), out.alias("held_out"), F.col(text).alias("text"))
    found = map_texts(marked, "text", f"key {kind}, held_out boolean, score double", work)
    return found.select(F.col("key").alias(key), "held_out", "score",
                        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))
