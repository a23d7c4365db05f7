"""The pipeline against a plain version on small documents with planted cases."""

import random
import re
import zlib
from collections import Counter

import pytest

import corpus_pipeline
from jobloom.llm import langid

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
VOCABULARY = {"en": [f"{a}{b}th" for a in "abcdefgh" for b in "aeiou"],
              "de": [f"{a}{b}sch" for a in "klmnprst" for b in "aeiou"]}


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    draw = random.Random(11)
    some = lambda n, lang: [draw.choice(VOCABULARY[lang]) for _ in range(n)]
    item, passage = some(14, "en"), some(60, "en")
    rows = []
    for i in range(120):
        lang = "de" if i % 3 == 0 else "en"
        words = some(draw.randrange(60, 160), lang)
        if i in (10, 20):
            words[5:5] = item
        if i in (31, 41, 52):
            words[9:9] = passage
        rows.append((i, " ".join(words), lang, f"s{i % 4}", 0))
    rows += [(200, rows[1][1], "en", "s1", 0), (201, rows[2][1].replace(" ", "  ", 5), "en", "s1", 0),
             (202, rows[4][1] + " more", "en", "s2", 0), (203, "12 34 !!", "en", "s1", 0),
             (204, None, None, None, None), (205, "", "en", "s0", 0)]
    rows = [(a, t, b, c, None if t is None else len(t)) for a, t, b, c, _ in rows]
    path = tmp_path_factory.mktemp("pipeline")
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, " ".join(item))], "item_id bigint, text string").write.parquet(
        f"{path}/benchmark.parquet")
    return str(path), rows, passage


def test_each_stage_and_the_whole(spark, folder):
    path, rows, passage = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, path)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        docs = spark.createDataFrame(docs.collect(), SCHEMA)
        seen.append({r.doc_id: r for r in docs.collect()})
    every = {r[0] for r in rows}
    assert set(seen[0]) == every - {203, 204, 205}
    assert set(seen[1]) == set(seen[0]) - {200, 201, 202}
    assert set(seen[2]) == set(seen[1])
    words = {i: split(r.text) for i, r in seen[1].items()}
    windows = Counter(tuple(w[k:k + 35]) for w in words.values() for k in range(len(w) - 34))
    for i, r in seen[2].items():
        gone = {p for k in range(len(words[i]) - 34) if windows[tuple(words[i][k:k + 35])] > 1
                for p in range(k, k + 35)}
        assert (len(gone) >= len(passage)) == (i in (31, 41, 52))
        assert split(r.text) == [w for p, w in enumerate(words[i]) if p not in gone]
        assert r.n_chars == len(r.text)
    assert set(seen[3]) == set(seen[2]) - {10, 20}
    final = corpus_pipeline.run(spark, path).collect()
    assert {r.doc_id for r in final} <= set(seen[3])
    sizes = {r.doc_id: len(split(r.text)) for r in seen[3].values()}
    assert all(r["size"] == sizes[r.doc_id] and 0 < r.taken <= 3 * r["size"] for r in final)
    total = sum(sizes.values())
    assert abs(sum(r.taken for r in final) - total) < 200


def test_fold_of_language_training(spark, folder):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{folder[0]}/documents.parquet")
    for r in docs.select("doc_id", langid.in_fold(F.col("doc_id"), 3, 1).alias("out")).collect():
        assert r.out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)


def test_empty_documents(spark, tmp_path, folder):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_one_row_of_each_group_goes_through_two_stages(spark):
    draw = random.Random(12)
    texts = [" ".join(draw.choice("abcdefghij") + str(draw.randrange(1000)) for _ in range(60)) for _ in range(7)]
    near = texts[3] + " more"
    rows = [(1, texts[0]), (1, texts[0]),                       # a repeated row
            (None, texts[1]), (2, texts[1]), (None, texts[1]),  # copies without id
            (None, texts[2]), (None, texts[2]),                 # only copies without id
            (3, texts[3]), (4, near), (4, texts[4]),            # an id shared with a near copy
            (5, texts[5]), (5, texts[6]),                       # an id of two texts
            (6, ""), (6, ""), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA).repartition(3)
    expected = [(1, texts[0]), (2, texts[1]), (None, texts[2]), (3, texts[3]), (4, texts[4]), (5, texts[5]),
                (5, texts[6]), (6, ""), (6, ""), (None, None)]
    for stage in (corpus_pipeline.drop_near_copies, corpus_pipeline.cut_repeats):
        docs = stage(spark, docs, "")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        found = Counter((r.doc_id, r.text or None) for r in docs.collect())
        assert found == Counter((i, t or None) for i, t in expected), stage


def test_stages_remove_what_earlier_ones_wrote(spark, tmp_path, folder):
    path = folder[0]
    docs, held = spark.read.parquet(f"{path}/documents.parquet"), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:3]):
        stage(spark, docs, path).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        held += [f for f in corpus_pipeline._held if f not in held]
        assert corpus_pipeline._held == held[-1:]
    # Documents that still read from a folder keep it.
    lazy = corpus_pipeline.drop_near_copies(spark, docs, path)
    corpus_pipeline.cut_repeats(spark, lazy, path)
    assert len(corpus_pipeline._held) == 2
