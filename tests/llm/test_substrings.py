import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from jobloom.llm import substrings as s
from jobloom.llm.batches import SPACE, Words, long_run_hashes, run_hashes, texts_of, word_hashes

SCHEMA = "doc_id bigint, text string, spans string"


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain(rows, window):
    words = [split(t) for _, t in rows]
    seen = Counter(tuple(w[k:k + window]) for w in words for k in range(len(w) - window + 1))
    out = []
    for (key, _), w in zip(rows, words):
        gone = set()
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k:k + window])] > 1:
                gone |= set(range(k, k + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((key, len(w), len(gone), kept, hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def corpus():
    draw = random.Random(8)
    vocabulary = [f"w{i}" for i in range(50)] + ["é", "漢"]
    some = lambda n: [draw.choice(vocabulary) for _ in range(n)]
    passage, line = some(25), some(9)
    rows = []
    for i in range(150):
        w = some(draw.randrange(0, 80))
        if i % 3 == 0:
            w[3:3] = line
        if i % 7 == 0:
            a = draw.randrange(0, 12)
            w += passage[a:]
        if i % 11 == 0:
            w += passage + some(4)
        rows.append((i, draw.choice([" ", "\n", "\t "]).join(w)))
    rows += [(500, rows[4][1]), (501, rows[4][1] + " more"), (502, None), (503, ""), (504, "ha " * 40),
             (505, "ha ha"), (None, rows[7][1]), (506, "one two three four " * 9), (507, rows[8][1]),
             (507, rows[8][1]), (508, " ".join(f"x{i}" for i in range(30_000)))]
    return rows


@pytest.mark.parametrize("window, gram, options", [
    (12, 4, {}), (12, 4, {"shard_words": 60}), (12, 4, {"shard_runs": 3}),
    (12, 4, {"shard_runs": 0}), (13, 4, {"shard_runs": 1}), (35, 8, {})])
def test_against_plain(spark, window, gram, options):
    rows = corpus()
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA)
    found = s.kept_words(df, window, gram, **options).collect()
    assert sorted(map(tuple, found), key=str) == plain(rows, window)


def test_joined_instead_of_broadcast(spark):
    rows = corpus()
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(map(tuple, s.kept_words(df, 12, 4).collect()), key=str) == plain(rows, 12)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_cut_texts(spark):
    rows = corpus()
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, _spans string")
    cut = s.remove_repeats(df, 12, 4)
    assert cut.columns == df.columns
    found = sorted(((r.doc_id, " ".join(split(r.text))) for r in cut.collect()), key=str)
    assert found == sorted(((r[0], r[3]) for r in plain(rows, 12)), key=str)
    texts = {i: t for i, t in rows}
    whole = {r[0] for r in plain(rows, 12) if not r[2]}
    for r in cut.collect():
        if r.doc_id in whole:
            assert r.text == texts[r.doc_id]
    assert cut.filter("doc_id = 502 and text is null").count() == 1


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert s.kept_words(df).count() == 0 and s.remove_repeats(df).count() == 0


def test_automaton_counts_substrings():
    draw = random.Random(1)
    texts = [[draw.randrange(3) for _ in range(draw.randrange(1, 30))] for _ in range(12)]
    automaton = s.SuffixAutomaton()
    weights = [draw.choice([1, 1, 2]) for _ in texts]
    for t, w in zip(texts, weights):
        automaton.add(t, w)
    automaton.finish()
    for n in (1, 3, 6):
        seen = Counter()
        for t, w in zip(texts, weights):
            for k in range(len(t) - n + 1):
                seen[tuple(t[k:k + n])] += w
        for t in texts:
            expected = [k for k in range(len(t) - n + 1) if seen[tuple(t[k:k + n])] > 1]
            assert automaton.repeated(t, n) == expected


def test_hashes_do_not_depend_on_place():
    texts = ["a bb a ccc bb", None, "ccc a bb", "", "ab b"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    t = next(texts_of(batch, "text"))
    words = Words(t, SPACE)
    assert words.counts.tolist() == [5, 0, 3, 0, 2]
    h = word_hashes(t.data, words)
    assert h[0] == h[2] == h[6] and h[1] == h[4] == h[7] and h[3] == h[5]
    assert len(np.unique(h)) == 5
    assert run_hashes(h, 2)[0] == run_hashes(h, 2)[6]
    assert long_run_hashes(h, 2)[0] == long_run_hashes(h, 2)[6] != long_run_hashes(h, 2)[1]
