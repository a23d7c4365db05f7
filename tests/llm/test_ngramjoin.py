import random
import re

import numpy as np
import pytest

from jobloom.llm import ngramjoin
from jobloom.llm.components import components

SCHEMA = "doc_id bigint, text string, component_id string"


def sets(text, n):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if len(w) < n:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}


def plain(rows, n, percent):
    made = [(i, sets(t, n)) for i, t in rows]
    group = list(range(len(made)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in range(len(made)):
        for b in range(a):
            x, y = made[a][1], made[b][1]
            common = len(x & y)
            if x and y and None not in (made[a][0], made[b][0]) and (
                    100 * common >= percent * (len(x) + len(y) - common)):
                group[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(made):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return sorted(((i, len(s), None if i is None and s else
                    i if not s else least[root(k)]) for k, (i, s) in enumerate(made)), key=str)


def corpus():
    draw = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = []
    base = [[draw.choice(vocabulary) for _ in range(80)] for _ in range(12)]
    common = [draw.choice(vocabulary) for _ in range(12)]
    for i in range(260):
        words = list(base[0] if i % 3 == 0 else base[i % 12])
        for _ in range(draw.choice([0, 1, 1, 2, 3, 5])):
            words[draw.randrange(len(words))] = draw.choice(vocabulary)
        if i % 4 == 0:
            words = words[: draw.randrange(60, 81)]
        rows.append((i, " ".join(words)))
    for i in range(40):
        rows.append((300 + i, " ".join(common + [draw.choice(vocabulary) for _ in range(25)])))
    # A chain: each links only with its neighbours.
    chain = [f"c{i}" for i in range(200)]
    rows += [(400 + i, " ".join(chain[i * 5:i * 5 + 100])) for i in range(20)]
    rows += [(500, None), (501, ""), (502, "two words"), (503, "TWO words"), (504, "\x0b \t"), (505, "two"),
             (None, rows[0][1]), (506, rows[5][1]), (506, rows[5][1]), (507, "long " * 30_000), (508, "a b c d"),
             (509, "A B C D"), (510, "é ß ü ö"), (511, "É ß ü ö")]
    return rows


@pytest.mark.parametrize("n, percent", [(4, 85), (5, 80), (1, 60)])
def test_against_all_pairs(spark, n, percent):
    rows = corpus()
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA)
    got = ngramjoin.similar_components(df, n, percent)
    found = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=str)
    assert found == plain(rows, n, percent)


def test_without_broadcast_and_with_outlines_for_all(spark, monkeypatch):
    monkeypatch.setattr(ngramjoin, "BROADCAST_IDS", 0)
    monkeypatch.setattr(ngramjoin, "LARGE_BUCKET", 1)
    rows = corpus()
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA)
    got = ngramjoin.similar_components(df, 4, 85)
    found = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=str)
    assert found == plain(rows, 4, 85)


def test_keep_one(spark):
    rows = corpus()
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA)
    kept = ngramjoin.keep_one(df, 4, 85)
    assert kept.columns == df.columns
    expected = {c for _, _, c in plain(rows, 4, 85) if c is not None}
    assert {r.doc_id for r in kept.collect()} == expected | {None}


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert ngramjoin.similar_components(df).count() == 0
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x")], SCHEMA)
    assert sorted(map(tuple, ngramjoin.similar_components(df).select(
        "doc_id", "n_shingles", "component_id").collect())) == [(1, 0, 1), (2, 0, 2)]


def test_fragments_follow_the_order():
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 1000, 1 << ngramjoin.LEAST_BITS).astype(np.uint32)
    order = ngramjoin.GlobalOrder(counts, 4)
    grams = np.sort(rng.integers(0, 2**64, 5000, dtype=np.uint64))
    by_key = np.argsort(order.keys(grams))
    assert (np.diff(order.fragment(grams)[by_key]) >= 0).all()
    assert len(np.unique(order.fragment(grams))) == 4


def test_components(spark):
    draw = random.Random(4)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(150)]
    edges += [(i, i + 1) for i in range(1000, 1100)] + [(2000, i) for i in range(2001, 2100)] + [(7, 7)]
    label = {}

    def root(x):
        while label.setdefault(x, x) != x:
            x = label[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        label[y] = x
    found = components(spark.createDataFrame(edges, "u bigint, v bigint"))
    assert {r.node: r.label for r in found.collect()} == {x: root(x) for x in label if root(x) != x}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def near_misses(n, edits, seed=9, words=120):
    """Texts around one base with some words changed, so that many pairs just miss the similarity."""
    draw = random.Random(seed)
    base = [f"b{i}" for i in range(words)]
    rows = []
    for i in range(n):
        text = list(base)
        for p in draw.sample(range(words), draw.choice(edits)):
            text[p] = f"x{draw.randrange(10_000)}" if draw.random() < 0.7 else f"y{p}"
        rows.append((i, " ".join(text)))
    return rows


@pytest.mark.parametrize("edits", [[2], [3], [2, 3, 4, 5, 9], [1, 2, 4, 6, 30, 60]])
def test_near_misses_around_one_text(spark, monkeypatch, edits):
    monkeypatch.setattr(ngramjoin, "LARGE_BUCKET", 8)
    rows = near_misses(150, edits) + [(1000 + i, t.replace("b", "c")) for i, t in near_misses(60, edits, 4)]
    rows += [(2000 + i, t.replace("b1", "d1")) for i, t in near_misses(60, edits, 5)]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA)
    got = ngramjoin.similar_components(df, 4, 85)
    found = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=str)
    assert found == plain(rows, 4, 85)


def test_few_pairs_of_a_large_group_are_compared(spark, monkeypatch):
    """Of the quarter of a million pairs of near misses about as many as there are texts are compared."""
    monkeypatch.setattr(ngramjoin, "PIVOTS", 1)
    compared = []
    inner = ngramjoin.similar

    def counted(pairs, cut, percent):
        compared.append(pairs.count())
        return inner(pairs, cut, percent)

    monkeypatch.setattr(ngramjoin, "similar", counted)
    rows = near_misses(700, [3, 4, 5, 6], words=200)
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA)
    got = ngramjoin.similar_components(df, 4, 85)
    found = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=str)
    assert found == plain(rows, 4, 85)
    assert sum(compared[2:]) < 7000, compared


def test_rows_of_files_are_not_written_again(spark, tmp_path):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(1, base, "a"), (1, base, "a"), (None, base + " more", "b"), (3, "other words " * 9, "c"),
            (4, None, None), (5, "", "e"), (None, "x y", "f")]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, _row string")
    expected = sorted(map(str, [rows[0], *rows[3:]]))
    table.repartition(3).write.parquet(f"{tmp_path}/rows")
    for docs in (table, spark.read.parquet(f"{tmp_path}/rows")):
        kept = ngramjoin.keep_one_row(docs, n=5, percent=80)
        assert kept.columns == docs.columns
        assert sorted(str(tuple(r)) for r in kept.collect()) == expected
    assert all(str(tmp_path) in f or "gone" in f for f in kept.inputFiles())


def test_settings_of_the_session_stay(spark, tmp_path):
    from jobloom.llm.written import RELEASE, written

    before = spark.conf.get(RELEASE, None)
    assert written(spark.range(5).repartition(2), f"{tmp_path}/t").count() == 5
    assert spark.conf.get(RELEASE, None) == before
