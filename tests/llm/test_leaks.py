import re

import pytest

from jobloom.llm import leaks

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(low)


def plain(docs, items, window):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k:k + n]), set()).add(item)
    out = []
    for key, text in docs:
        w, hit, ids = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if found := windows.get(tuple(w[k:k + n])):
                    hit |= set(range(k, k + n))
                    ids |= {str(i) for i in found if i is not None}
        out.append((key, len(w), len(hit), sorted(ids)))
    return sorted(out, key=str)


ITEMS = [(1, "one two three four five six"), (2, "Three FOUR, five—six"), (3, "short"), (4, None),
         (5, " .,; "), (None, "nameless item text here"), (1, "one two three four five six"),
         (10, "über straße naïve café"), (11, "a a a a a a a")]
DOCS = [(1, "zero ONE two-three four five six seven"), (2, "nothing"), (3, None), (4, ""),
        (5, "short short nameless item text here"), (5, "short short nameless item text here"),
        (None, "x three four five—six"), (7, "ÜBER straße über straße naïve café!"),
        (8, "a " * 50), (9, "filler words " * 20_000 + "one two three four")]


@pytest.mark.parametrize("shard_bytes", [1 << 20, 60])
def test_against_plain(spark, shard_bytes):
    docs = spark.createDataFrame([(k, t, "extra") for k, t in DOCS], "doc_id bigint, text string, n_hit string")
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    found = leaks.find_leaks(docs, items, 4, shard_bytes=shard_bytes).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in found), key=str)
    assert got == plain(DOCS, ITEMS, 4)
    texts = dict(DOCS)
    for r in found:
        assert sum(h.last - h.first + 1 for h in r.hits) == r.n_hit
        for h in r.hits:
            span = texts[r.doc_id][h.start:h.end]
            assert words(span) == words(texts[r.doc_id])[h.first:h.last + 1]


def test_empty_tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_id bigint, text string")
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert leaks.find_leaks(docs.limit(0), items).count() == 0
    assert {r.n_hit for r in leaks.find_leaks(docs, items.limit(0)).collect()} == {0}


@pytest.mark.parametrize("shard_bytes", [1 << 20, 30])
def test_clean_documents_stay(spark, shard_bytes):
    docs = spark.createDataFrame([(k, t, 1) for k, t in DOCS], "doc_id bigint, text string, _leaked int")
    items = spark.createDataFrame(ITEMS[:2], "item_id bigint, text string")
    kept = leaks.decontaminate(docs, items, 4, shard_bytes=shard_bytes)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 5, 5, 7, 8]


def test_a_window_that_many_items_share(spark):
    items = [(i, "one two three four") for i in range(500)]
    docs = spark.createDataFrame(DOCS, "doc_id bigint, text string")
    found = leaks.find_leaks(docs, spark.createDataFrame(items, "item_id bigint, text string"), 4,
                             shard_bytes=3000).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in found), key=str)
    assert got == plain(DOCS, items, 4)
