from pathlib import Path

import numpy as np
import pytest

from jobloom.llm import langid

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "doc_id bigint, text string, lang string, lang_pred string"
EN = "the quick brown fox jumps over the lazy dog and then they were there with the other thing "
DE = "der schnelle braune fuchs springt über den faulen hund und dann waren sie da mit dem ding "
FR = "le rapide renard brun saute par-dessus le chien paresseux et puis ils étaient là avec eux "


def docs(spark):
    rows = [(i, [EN, DE, FR][i % 3] * (1 + i % 4), ["en", "de", "fr"][i % 3], "x") for i in range(60)]
    rows += [(100, None, "en", "x"), (101, "", "de", "x"), (102, "123 !!", "de", "x"), (None, EN, "zz", "x"),
             (103, EN, None, "x"), (104, DE * 3 + EN, "de", "x"), (105, EN * 3000, "en", "x"),
             (106, "A", "en", "x"), (1, EN, "de", "x"), (107, "漢字", "en", "x")]
    return spark.createDataFrame(rows, SCHEMA)


def test_cases(spark):
    table = docs(spark)
    found = langid.identify(table).collect()
    assert len(found) == table.count()
    by_id = {r.doc_id: r for r in found}
    for i in range(2, 60):
        assert by_id[i].lang_pred == ["en", "de", "fr"][i % 3]
    for i in (100, 101, 102):
        assert (by_id[i].lang_pred, by_id[i].score) == ("und", 0.0)
    assert by_id[None].lang_pred == "en" and not by_id[None].held_out
    assert by_id[103].lang_pred == "en" and by_id[104].lang_pred == "de" and by_id[105].lang_pred == "en"
    assert all(0 <= r.score <= 1 for r in found)
    assert by_id[104].score < by_id[2].score
    import zlib
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found if r.doc_id is not None)


def test_nothing_learned(spark):
    table = docs(spark)
    assert langid.identify(table.limit(0)).count() == 0
    none = table.filter("lang is null")
    assert {r.lang_pred for r in langid.identify(none).collect()} == {"und"}


def test_labels_of_the_fold_are_not_used(spark):
    from pyspark.sql import functions as F

    table = docs(spark)
    changed = table.withColumn("lang", F.when(
        langid.in_fold(F.col("doc_id"), 3, 1), F.lit("xx")).otherwise(F.col("lang")))
    assert sorted(map(str, langid.identify(table).collect())) == sorted(
        map(str, langid.identify(changed).collect()))


def test_kept_documents(spark):
    kept = langid.keep_identified(docs(spark))
    assert kept.columns == ["doc_id", "text", "lang", "lang_pred"]
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == 67 and not {100, 101, 102} & set(ids)


def test_mixture_against_a_plain_loop():
    rng = np.random.default_rng(0)
    p = rng.random((9, 3)).astype(np.float32)
    n = rng.integers(1, 5, 9).astype(np.float32)
    starts = np.array([0, 4])
    model = langid.Model({"a": np.zeros(langid.BUCKETS)})
    pi, likelihood = model.shares(p, n, starts, 1.0)
    for r, (a, b) in enumerate(((0, 4), (4, 9))):
        own = np.full(3, 1 / 3)
        for _ in range(langid.ROUNDS):
            joint = p[a:b] * own
            joint = joint / joint.sum(axis=1, keepdims=True) * n[a:b, None]
            own = (joint.sum(axis=0) + 1) / (n[a:b].sum() + 3)
        assert np.allclose(pi[r], own, atol=1e-4)
        assert likelihood[r] == pytest.approx((n[a:b] * np.log((p[a:b] * own).sum(axis=1))).sum(), rel=1e-4)


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")
def test_held_out_accuracy(spark):
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = langid.identify(table).filter("held_out").join(table, "doc_id")
    assert found.filter("lang_pred = lang").count() > 0.98 * found.count()


def test_documents_stay_if_nothing_is_learned(spark):
    table = docs(spark)
    none = table.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang", "lang_pred")
    assert langid.keep_identified(none).count() == langid.keep_identified(table).count() == 67
    assert langid.keep_identified(table.filter(langid.in_fold(table["doc_id"], 3, 1))).count() > 10
