from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from jobloom.llm import quality
from jobloom.llm.batches import texts_of
from jobloom.llm.langid import in_fold

SF_DIR = "/root/testdata/sf0.01"
DOCS = "doc_id bigint, text string, score string"


def tables(spark):
    draw = np.random.default_rng(2)
    vocabulary = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)]
    rows, labels = [], []
    for i in range(400):
        words = draw.choice(vocabulary, 40).tolist()
        good = i % 4 != 0
        rows.append((i, " ".join(words) if good else " ".join(w + "***" for w in words), "x"))
        labels.append((i, int(good), 0))
    rows += [(1000, None, "x"), (1001, "", "x"), (None, "no id", "x"), (1002, "long " * 50_000, "x"),
             (5, rows[5][1], "x"), (1003, " \t ", "x")]
    labels += [(1000, None, 0), (5, 1, 0), (5, None, 0), (9999, 0, 0), (None, 1, 0)]
    return (spark.createDataFrame(rows, DOCS),
            spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))


def test_cases(spark):
    docs, labels = tables(spark)
    found = quality.score_quality(docs, labels).collect()
    assert len(found) == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)
    held = [r for r in found if r.held_out and r.doc_id < 400]
    assert len(held) > 50
    assert all(r.predicted == int(r.doc_id % 4 != 0) for r in held)
    again = quality.score_quality(docs, labels).collect()
    assert sorted((str(r.doc_id), round(r.score, 6)) for r in found) == sorted(
        (str(r.doc_id), round(r.score, 6)) for r in again)


def ids_of(word):
    batch = pa.RecordBatch.from_arrays([pa.array([word])], ["text"])
    return [i for t in texts_of(batch, "text") for i in quality.Tokens(t).ids.tolist()]


TEXTS = ["the cat, The DOG and the cat", "", None, "*** cat\ndog ***", "one", "so so so so so"]
TOKENS = [["the", "cat", ",", "the", "dog", "and", "the", "cat"], [], [], ["***", "cat", "dog", "***"],
          ["one"], ["so"] * 5]


def plain_vectors():
    place, sign = quality._index_vectors()
    sums, holders = np.zeros((quality.VOCABULARY, quality.DIMS)), np.zeros(quality.VOCABULARY)
    number = {w: ids_of(w)[0] for words in TOKENS for w in words}
    for words in TOKENS:
        for i, w in enumerate(words):
            for k in range(max(0, i - quality.SPAN), min(len(words), i + quality.SPAN + 1)):
                if k != i:
                    for j in range(quality.NONZERO):
                        sums[number[w], place[number[words[k]], j]] += sign[number[words[k]], j]
        for w in set(words):
            holders[number[w]] += 1
    return number, sums, holders


def test_word_vectors_against_a_plain_loop(spark):
    docs = spark.createDataFrame([(t,) for t in TEXTS], "text string").repartition(3)
    found = quality.word_vectors(docs)
    number, sums, holders = plain_vectors()
    assert len(set(number.values())) == len(number)
    for i in range(quality.VOCABULARY):
        assert np.allclose(found.vectors[i], sums[i] / max(np.linalg.norm(sums[i]), 1e-9))
    assert np.allclose(found.weights, np.log((1 + len(TEXTS)) / (1 + holders)) + 1)


@pytest.mark.parametrize("piece", [1, 3, 1 << 16])
def test_pooling_against_a_plain_loop(monkeypatch, piece):
    monkeypatch.setattr(quality, "PIECE", piece)
    number, sums, holders = plain_vectors()
    known = quality.WordVectors(sums, holders, len(TEXTS))
    batch = pa.RecordBatch.from_arrays([pa.array(TEXTS)], ["text"])
    got = np.concatenate([quality.features(t, known) for t in texts_of(batch, "text")])
    for row, words in zip(got, TOKENS):
        v = [known.vectors[number[w]].astype(float) for w in words]
        weight = [float(known.weights[number[w]]) for w in words]
        mean = sum((w * x for w, x in zip(weight, v)), np.zeros(quality.DIMS)) / max(sum(weight), 1e-9)
        square = sum((w * x * x for w, x in zip(weight, v)), np.zeros(quality.DIMS)) / max(sum(weight), 1e-9)
        beside = sum((a * b for a, b in zip(v, v[1:])), np.zeros(quality.DIMS)) / max(len(v), 1)
        deviation = np.sqrt(np.maximum(square - mean * mean, 0))
        # A difference of nearly equal squares is exact to about the root of a double's last place.
        assert np.allclose(row, np.concatenate([mean, deviation, beside]), atol=1e-3)


def test_gradients_against_differences():
    draw = np.random.default_rng(5)
    x, y = draw.normal(size=(30, 6)), (draw.random(30) < 0.4).astype(float)
    weights = [draw.normal(size=(6, 4)), draw.normal(size=4), draw.normal(size=4), draw.normal(size=1)]

    def loss():
        z = quality._logits(x, weights)[1]
        return quality.log_loss(z, y) + 0.05 * ((weights[0] ** 2).sum() + (weights[2] ** 2).sum())

    for w, g in zip(weights, quality.gradients(x, y, weights, 0.1)):
        for at in np.ndindex(w.shape):
            kept, step = w[at], 1e-6
            w[at] = kept + step
            more = loss()
            w[at] = kept - step
            less = loss()
            w[at] = kept
            assert abs((more - less) / (2 * step) - g[at]) < 1e-5


def test_probabilities_are_calibrated():
    draw = np.random.default_rng(6)
    x = draw.normal(size=(12_000, 10))
    y = (draw.random(len(x)) < 1 / (1 + np.exp(-2 * x[:, 0] + x[:, 1]))).astype(float)
    network = quality.Network(x[:6000], y[:6000])
    score, truth = network.score(x[6000:]), y[6000:]
    bins = np.minimum((score * 10).astype(int), 9)
    error = sum(abs(score[bins == b].mean() - truth[bins == b].mean()) * (bins == b).mean()
                for b in range(10) if (bins == b).any())
    assert error < 0.04


def test_temperature_tames_an_overfitted_network():
    draw = np.random.default_rng(8)
    x = draw.normal(size=(5000, 40))
    y = (draw.random(len(x)) < 1 / (1 + np.exp(-x[:, 0]))).astype(float)
    network = quality.Network(x[:600], y[:600], epochs=200)
    z = quality._logits((x[600:] - network.mean) / network.scale, network.weights)[1]
    assert network.temperature > 1.5
    assert quality.log_loss(z / network.temperature, y[600:]) < 0.8 * quality.log_loss(z, y[600:])


@pytest.mark.parametrize("n", [2, 3, 4, 5, 12, 19])
def test_few_labels_are_learned_from(n):
    y = np.arange(n) % 2.0
    x = np.stack([y * 2 - 1, np.zeros(n)], axis=1)
    network = quality.Network(x, y)
    assert network.constant is None
    assert np.all((network.score(x) > 0.5) == (y > 0.5)) or n < 5


def test_rows_that_share_an_id(spark):
    docs, labels = tables(spark)
    more = docs.filter("doc_id < 60").withColumn("text", F.concat("text", F.lit(" more words")))
    scores = [sorted((str(r.doc_id), round(r.score, 5)) for r in quality.score_quality(d, labels).collect())
              for d in (docs.union(more), more.union(docs).repartition(5))]
    assert [k for k, _ in scores[0]] == [k for k, _ in scores[1]]
    assert np.allclose([s for _, s in scores[0]], [s for _, s in scores[1]], atol=0.01)


def test_labels_of_the_fold_are_not_used(spark):
    docs, labels = tables(spark)
    changed = labels.withColumn("quality", F.when(
        in_fold(F.col("doc_id"), 5, 0), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (sorted((str(r.doc_id), round(r.score, 6)) for r in quality.score_quality(docs, x).collect())
                for x in (labels, changed))
    assert one == two


def test_without_labels_and_rows(spark):
    docs, labels = tables(spark)
    assert quality.score_quality(docs.limit(0), labels).count() == 0
    assert {r.score for r in quality.score_quality(docs.limit(30), labels.limit(0)).collect()} == {0.5}
    same = labels.filter("quality = 1")
    assert {r.score for r in quality.score_quality(docs, same).collect()} == {1.0}


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")
def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    found = quality.score_quality(docs, labels).filter("held_out").join(labels, "doc_id")
    assert found.filter("predicted = quality").count() >= 0.95 * found.count()
