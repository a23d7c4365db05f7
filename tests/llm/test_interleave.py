import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from jobloom.llm import interleave

DOCS = "doc_id bigint, text string, source string, shard string, slot string, size string"


def number(digits, *parts):
    text = "|".join("-" if p is None else f"={p}" for p in parts)
    return int(hashlib.md5(text.encode()).hexdigest()[:digits], 16)


def plain(rows, n_shards, seed=0):
    """(doc_id, source, size, checksum, shard, slot) by ranking and sorting in memory."""
    by_source, seen = defaultdict(list), Counter()
    for i, text, source in rows:
        data = (text or "").encode()
        row = (i, source, len(data) + 16, zlib.crc32(data))
        copy = seen[row]
        seen[row] += 1
        by_source[source].append((number(15, seed, i, row[2], row[3], copy), copy, row))
    placed = []
    for source, of_source in by_source.items():
        name = "-" if source is None else "=" + source
        offset = number(12, seed, name) / 16.0 ** 12
        for rank, (_, _, row) in enumerate(sorted(of_source, key=lambda x: x[:2])):
            placed.append(((rank + offset) / len(of_source), name, row))
    placed.sort(key=lambda x: (x[0], x[1].encode()))
    n, out, slots = len(placed), [], Counter()
    for at, (_, _, row) in enumerate(placed):
        shard = at * n_shards // n
        out.append((*row, shard, slots[shard]))
        slots[shard] += 1
    return Counter(out)


def table(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c") for r in rows], DOCS).repartition(5)


def sample():
    rows = [(i, f"text {i} " + "é" * (i % 50), "hot" if i % 3 == 0 else f"s{i % 11}") for i in range(900)]
    rows += [(7000, "the same row", "hot")] * 400 + [(None, None, None)] * 90
    rows += [(8000 + i, "a copy", None) for i in range(60)] + [(9000, "", "s1"), (9001, None, "s1")]
    return rows + [(9100 + i, "x" * 200_000, f"one{i}") for i in range(3)]


def found(spark, rows, **options):
    got = interleave.interleave(table(spark, rows), **options)
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    return got.collect()


@pytest.mark.parametrize("options", [{}, {"n_shards": 7, "seed": 5}])
def test_against_plain(spark, options):
    rows = sample()
    got = found(spark, rows, **options)
    expected = plain(rows, options.get("n_shards", 40), options.get("seed", 0))
    assert Counter((r.doc_id, r["size"], r.text_crc32, r.shard, r.slot) for r in got) == Counter(
        {(i, size, crc, shard, slot): n for (i, _, size, crc, shard, slot), n in expected.items()})
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}


def test_shards_match_the_mixture(spark):
    rows = sample()
    kept = interleave.shard_documents(table(spark, rows), 10).select("source", "shard", "slot").collect()
    shards = Counter(r.shard for r in kept)
    assert max(shards.values()) - min(shards.values()) <= 1
    for shard, n in shards.items():
        assert sorted(r.slot for r in kept if r.shard == shard) == list(range(n))
    sources = Counter(r.source for r in kept)
    for source, n in sources.items():
        for shard in shards:
            share = sum(r.source == source and r.shard == shard for r in kept)
            assert abs(share - n / 10) <= 3


def test_fewer_rows_than_shards_and_none(spark):
    got = found(spark, [(i, "x", "s") for i in range(5)])
    assert sorted((r.shard, r.slot) for r in got) == [(0, 0), (8, 0), (16, 0), (24, 0), (32, 0)]
    assert found(spark, []) == []


def test_documents_and_files(spark, tmp_path):
    rows = sample()
    docs = table(spark, rows)
    kept = interleave.shard_documents(docs, 4)
    assert sorted(kept.columns) == sorted(["doc_id", "text", "source", "size", "shard", "slot"])
    assert Counter((r.doc_id, r.text, r.source) for r in kept.collect()) == Counter(rows)
    interleave.write_shards(docs, str(tmp_path / "out"), files=9, n_shards=4)
    read = spark.read.parquet(str(tmp_path / "out"))
    assert read.count() == len(rows)
    for shard in range(4):
        files = sorted((tmp_path / "out" / f"shard={shard}").glob("*.parquet"))
        slots = [r.slot for f in files for r in spark.read.parquet(str(f)).select("slot").collect()]
        assert slots == list(range(len(slots)))


def test_no_python_on_the_executors(spark):
    plan = interleave.interleave(table(spark, sample()))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_digest_tells_null_from_text(spark):
    row = spark.createDataFrame([(None, "-")], "a string, b string").select(
        interleave.digest(12, F.col("a")).alias("a"), interleave.digest(12, F.col("b")).alias("b")).first()
    assert row.a == number(12, None) and row.b == number(12, "-") and row.a != row.b
