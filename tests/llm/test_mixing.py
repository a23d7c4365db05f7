import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from jobloom.llm import mixing

DOCS = "doc_id bigint, text string, source string, taken string"


def plain_targets(sizes):
    """Shares by weight, the excess over three times the size shared out again until none is."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, open_, left = dict.fromkeys(names, 0.0), set(names), float(sum(sizes.values()))
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        for s in list(open_):
            target[s] += left * weight[s] / total
        left = 0.0
        for s in list(open_):
            if target[s] > 3 * sizes[s]:
                left += target[s] - 3 * sizes[s]
                target[s] = 3.0 * sizes[s]
                open_.discard(s)
    return target


def docs(spark):
    rows = []
    for i in range(400):
        source = "hot" if i % 3 == 0 else ["a", "b", "é", "z", None][i % 5]
        rows.append((i, " ".join(f"w{j}" for j in range(i % 97)), source, "x"))
    rows += [(1000, "one word\u000b two\tthree", "tiny", "x"), (1001, None, "empty", "x"),
             (None, "no id here", "a", "x"), (1500, "again " * 50, "b", "x"), (1500, "again " * 50, "b", "x"),
             (2000, "long " * 40_000, "z", "x")]
    return spark.createDataFrame(rows, DOCS)


def test_targets_sizes_and_takes(spark):
    table = docs(spark)
    found = mixing.mix(table).collect()
    assert len(found) == table.count()
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    words = {}
    by_id = {r.doc_id: r for r in table.collect()}
    for r in found:
        source = by_id[r.doc_id].source
        n = len(re.findall(r"[^\x20\x09-\x0D]+", by_id[r.doc_id].text or ""))
        assert r["size"] == n and 0 <= r.taken <= 3 * n
        sizes[source] += n
        taken[source] += r.taken
        target[source] = r.target
        words[source] = r.source_size
    assert words == dict(sizes)
    expected = plain_targets(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(expected[s])
        assert abs(taken[s] - target[s]) <= 2 * mixing.BLOCK_WORDS
    again = mixing.mix(table).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_empty(spark):
    assert mixing.mix(docs(spark).limit(0)).count() == 0
    assert mixing.mix(docs(spark).filter("text is null")).collect()[0].taken == 0


@pytest.mark.parametrize("n", [1, 2, 3, 5, 10, 97, 1000])
def test_permutation(spark, n):
    rows = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("bigint"), F.lit(1)).alias("p"))
    assert sorted(r.p for r in rows.collect()) == list(range(n))


def test_slots_fill_all_shards_once(spark):
    sized = docs(spark).select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    targets = mixing.source_targets(sized)
    plan = mixing.slot_plan(targets, shard_slots=256).collect()
    places = sorted(r.shard * 256 + r.slot for r in plan)
    assert places == list(range(len(plan)))
    # Every shard draws from the large sources, at about their share.
    hot = max(targets.collect(), key=lambda r: r.slots)
    shards = max(r.shard for r in plan)
    for shard in range(shards):
        n = sum(r.number == hot.number for r in plan if r.shard == shard)
        assert abs(n / 256 - hot.slots / len(plan)) < 0.2


def test_blocks_hold_the_words_that_documents_give(spark):
    table = docs(spark)
    pieces = mixing.mixed_blocks(table, shard_slots=256).collect()
    held, shards, filled = defaultdict(int), defaultdict(set), defaultdict(list)
    sizes = {r.doc_id: len(re.findall(mixing.WORD, r.text or "")) for r in table.collect()}
    for r in pieces:
        assert 0 <= r.first_word and r.words > 0 and r.first_word + r.words <= sizes[r.doc_id]
        held[r.doc_id] += r.words
        shards[r.doc_id].add(r.shard)
        filled[r.shard, r.slot].append((r["at"], r.words))
    # Slots are filled from their start without gaps, and shards but the last have all their slots.
    for parts in filled.values():
        parts.sort()
        assert [a for a, _ in parts] == [sum(w for _, w in parts[:i]) for i in range(len(parts))]
        assert sum(w for _, w in parts) <= mixing.BLOCK_WORDS
    assert sorted(s * 256 + i for s, i in filled) == list(range(len(filled)))
    found = [r for r in mixing.mix(table, shard_slots=256).collect() if r.doc_id != 1500]
    assert {r.doc_id: r.taken for r in found if r.taken} == {k: n for k, n in held.items() if k != 1500}
    assert all(r.shards == len(shards[r.doc_id]) for r in found)


def test_repeated_rows_share_what_is_taken(spark):
    rows = [(1, "again and again " * 30, "a", "x")] * 40 + [(2, "once only here", "b", "x")]
    table = spark.createDataFrame(rows, DOCS)
    in_all = sum(r.taken for r in mixing.mix(table).collect() if r.doc_id == 1)
    mixed = [r.taken for r in mixing.mix_documents(table).collect() if r.doc_id == 1]
    assert len(mixed) == 40 and 0 <= sum(mixed) - in_all < 40


def test_mixed_documents(spark):
    mixed = mixing.mix_documents(docs(spark))
    assert mixed.columns == ["doc_id", "text", "source", "size", "source_size", "target", "taken"]
    assert mixed.filter("taken <= 0").count() == 0


def test_no_python_on_the_executors(spark):
    plan = mixing.mix(docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
