"""Language identification as inference of a multilingual mixture.

Training counts character trigrams around each letter, hashed into a table of fixed size per
language, over all training documents. A document is then a mixture: each trigram was written in
one of its languages. Expectation-maximisation gives the shares of all languages; the languages in
order of share are nested candidate sets, whose likelihoods (shares estimated anew for each set)
less a penalty for each further language choose the set. The answer is the largest share in it;
the score is that language's share among all, with one trigram of prior weight per language.

The broadcast model is languages times `BUCKETS` floats; more than `MOST_LANGUAGES` raise an error.

Defined cases: null texts and texts without a letter are `und` with score 0, also everything if
nothing could be learned; null languages and rows without id aren't learned from; ties go to the
language first in order; repeated rows count as often as they stand; an empty table gives an empty
result. A prediction reads the text alone; other columns are not read.
"""

from __future__ import annotations

import functools
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from jobloom.llm.batches import Texts, map_texts, texts_of

BITS = 16
BUCKETS = 1 << BITS
SALTS = 1024
MOST_LANGUAGES = 512
ROUNDS = 12
SMOOTHING = 0.5
# Log-likelihood that a further language must gain per doubling of the text.
PENALTY = 2.0
UNKNOWN = "und"
# Bytes of text inferred at once.
SLICE = 1 << 19


@functools.cache
def _letters() -> np.ndarray:
    """Lower case of each letter, 0 for other characters."""
    chars = map(chr, range(0x110000))
    return np.fromiter((ord(c.lower()[0]) if c.isalpha() else 0 for c in chars), np.uint32, 0x110000)


def trigrams(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Row and hashed trigram of each letter with its two neighbours."""
    heads = np.flatnonzero((t.data & 0xC0) != 0x80)
    code = np.frombuffer(t.data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    own = _letters()[code]
    bounds = np.searchsorted(heads, t.offsets)
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    filled = bounds[1:] > bounds[:-1]
    before[bounds[:-1][filled]] = 0
    after[bounds[1:][filled] - 1] = 0
    at = np.flatnonzero(own)
    h = (before[at] * np.uint32(0x9E3779B1) ^ own[at] * np.uint32(0x85EBCA77)) * np.uint32(
        0xC2B2AE3D) + after[at] * np.uint32(0x27D4EB2F)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    rows = np.repeat(np.arange(len(t)), np.diff(bounds))[at]
    return rows, (h >> np.uint32(32 - BITS)).astype(np.int64)


def _sum_packed(table: pa.Table) -> pa.Table:
    total = np.zeros(BUCKETS, np.uint64)
    for packed in table.column("counts").to_pylist():
        total += np.frombuffer(zlib.decompress(packed), np.uint64)
    return pa.table({"lang": [table.column("lang")[0].as_py()],
                     "salt": pa.array([table.column("salt")[0].as_py()], pa.int32()),
                     "counts": [zlib.compress(total.tobytes(), 1)]})


class Model:
    """Trigram probabilities by language, and the inference."""

    def __init__(self, counts: dict[str, np.ndarray]):
        self.languages = sorted(counts)
        rows = [(counts[x] + SMOOTHING) / (counts[x].sum() + SMOOTHING * BUCKETS)
                for x in self.languages]
        self.probability = np.array(rows, np.float32).reshape(len(rows), BUCKETS).T.copy()

    def shares(self, p: np.ndarray, n: np.ndarray, starts: np.ndarray, prior: float,
               allowed: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Shares of languages per row and the log-likelihood; p has a line per distinct trigram
        of a row, n its counts, `starts` where rows begin."""
        rows = len(starts)
        sizes = np.diff(np.append(starts, len(n)))
        of = np.repeat(np.arange(rows), sizes)
        total = np.add.reduceat(n, starts)[:, None]
        allowed = np.ones((rows, p.shape[1]), bool) if allowed is None else allowed
        width = allowed.sum(axis=1, keepdims=True)
        pi = (allowed / width).astype(np.float32)
        for _ in range(ROUNDS):
            joint = p * pi[of]
            joint *= (n / joint.sum(axis=1))[:, None]
            pi = (np.add.reduceat(joint, starts, axis=0) + prior * allowed) / (total + prior * width)
            pi = pi.astype(np.float32)
        likelihood = np.add.reduceat(n * np.log((p * pi[of]).sum(axis=1, dtype=np.float64)), starts)
        return pi, likelihood

    def predict(self, t: Texts) -> tuple[list[str], np.ndarray]:
        names, scores = [UNKNOWN] * len(t), np.zeros(len(t))
        rows, grams = trigrams(t)
        if not len(rows) or not self.languages:
            return names, scores
        keys, n = np.unique(rows << BITS | grams, return_counts=True)
        of, p = keys >> BITS, self.probability[keys & (BUCKETS - 1)]
        starts = np.flatnonzero(np.concatenate([[True], np.diff(of) != 0]))
        found, n = of[starts], n.astype(np.float32)
        p = p / p.max(axis=1, keepdims=True)
        every, _ = self.shares(p, n, starts, 1.0)
        best = self._select(p, n, starts, every)
        for row, language, share in zip(found.tolist(), best.tolist(), every[np.arange(len(best)), best]):
            names[row], scores[row] = self.languages[language], min(1.0, float(share))
        return names, scores

    def _select(self, p, n, starts, every) -> np.ndarray:
        """The largest share in the set of languages with the best penalised likelihood."""
        order = np.argsort(-every, axis=1, kind="stable")
        total = np.add.reduceat(n, starts)
        sizes = np.diff(np.append(starts, len(n)))
        best = order[:, 0].copy()
        log_p = np.log(p, dtype=np.float64)
        single = np.add.reduceat(n[:, None] * log_p, starts, axis=0)
        one = single.argmax(axis=1)
        reached, best = single.max(axis=1), one
        # Rows where one language leaves nothing to gain need no larger sets.
        going = np.arange(len(starts))
        for k in range(2, p.shape[1] + 1):
            share = np.take_along_axis(every, order[:, k - 1:k], axis=1)[:, 0]
            going = going[share[going] * total[going] > 1]
            if not len(going):
                break
            lines = np.concatenate([np.arange(starts[g], starts[g] + sizes[g]) for g in going])
            begins = np.concatenate([[0], np.cumsum(sizes[going])[:-1]])
            allowed = np.zeros((len(going), p.shape[1]), bool)
            np.put_along_axis(allowed, order[going, :k], True, axis=1)
            pi, likelihood = self.shares(p[lines], n[lines], begins, 0.0, allowed)
            gain = likelihood - PENALTY * (k - 1) * np.log2(total[going] + 1)
            better = gain > reached[going]
            reached[going[better]] = gain[better]
            best[going[better]] = pi[better].argmax(axis=1)
        return best


def train(docs: DataFrame, *, text: str = "text", lang: str = "lang") -> Model:
    """Count the trigrams of all rows with a language. The sums are of fixed size."""
    rows = docs.filter(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))

    def work(batches):
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for t in texts_of(batch, "text"):
                names, of = np.unique(np.array(t.values("lang").to_pylist(), object).astype(str),
                                      return_inverse=True)
                row, grams = trigrams(t)
                sums = np.bincount(of[row] << BITS | grams, minlength=len(names) << BITS)
                for name, own in zip(names.tolist(), sums.reshape(len(names), BUCKETS)):
                    totals[name] = totals.get(name, 0) + own.astype(np.uint64)
        salt = TaskContext.get().partitionId() % SALTS
        for name, own in totals.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([salt], pa.int32()),
                 pa.array([zlib.compress(own.tobytes(), 1)])], ["lang", "salt", "counts"])

    kind = "lang string, salt int, counts binary"
    sums = rows.mapInArrow(work, kind)
    for by in (["lang", "salt"], ["lang"]):
        sums = sums.groupBy(*by).applyInArrow(_sum_packed, kind)
    found = sums.limit(MOST_LANGUAGES + 1).collect()
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    return Model({r.lang: np.frombuffer(zlib.decompress(r.counts), np.uint64).astype(float)
                  for r in found})


def in_fold(key: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the key as text leaves this remainder; false for a null key."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % parts == part, F.lit(False))


def predict(docs: DataFrame, model: Model, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, lang_pred and score of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[key].dataType.simpleString()

    def work(slices):
        for t in slices:
            names, scores = shared.value.predict(t)
            yield pa.RecordBatch.from_arrays(
                [t.values("_key"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=["_key", "lang_pred", "score"])

    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    found = map_texts(rows, "_text", f"_key {kind}, lang_pred string, score double", work, SLICE)
    return found.withColumnRenamed("_key", key)


def identify(docs: DataFrame, parts: int = 3, held_out: int = 1, *, key: str = "doc_id",
             text: str = "text", lang: str = "lang") -> DataFrame:
    """key, held_out, lang_pred and score; learns from documents outside the held-out fold."""
    out = in_fold(F.col(key), parts, held_out)
    learn = docs.filter(F.col(key).isNotNull() & ~out)
    model = train(learn, text=text, lang=lang)
    found = predict(docs, model, key=key, text=text)
    return found.select(key, in_fold(F.col(key), parts, held_out).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, least: float = 0.0, parts: int = 3, held_out: int = 1, *,
                    key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The documents in a known language with a score of at least `least`, with all columns.

    Those without a letter go. With `least` 0 no other document does: every text with a letter is
    given some language, and the inferred mixture takes no part in the decision. If no language
    could be learned nothing is known of any text, and all with a letter stay.
    """
    out = in_fold(F.col(key), parts, held_out)
    model = train(docs.filter(F.col(key).isNotNull() & ~out), text=text, lang=lang)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(slices):
        for t in slices:
            if shared.value.languages:
                names, scores = shared.value.predict(t)
                keep = (np.array(names) != UNKNOWN) & (scores >= least)
            else:
                keep = np.bincount(trigrams(t)[0], minlength=len(t)) > 0
            yield t.batch.filter(pa.array(keep))

    return map_texts(docs, text, docs.schema, work, SLICE)
