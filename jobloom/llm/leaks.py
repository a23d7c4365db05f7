"""Benchmark decontamination with one Aho-Corasick automaton over normalised items.

Items and documents are normalised alike: A-Z in lower case, and words are runs of digits, letters
a-z and characters from U+0080 on, with one space between them. The automaton holds each window of
`window` consecutive item words; an item with fewer words, but not none, is one window. A document
is scanned once; each match is mapped back to words and to character offsets of the original text.

The automaton is broadcast only up to `shard_bytes` of windows and the ids of their items. A larger
benchmark is dealt into shards by the hash of window and id, so that a window that many items share
spreads as well; every shard then scans all documents, and what the shards find of a document is put
together.

Defined cases: a null or empty text has no words, in documents and items; an item without id marks
words but isn't counted or named; a repeated item counts once; a repeated document keeps a row
for each of its rows; with no items nothing is hit; input columns other than id and text aren't
read by `find_leaks` and pass through `decontaminate` unchanged, whatever their names.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from jobloom.llm.batches import LOWER, Texts, Words, map_texts, texts_of
from jobloom.session import shared_dir

WINDOW = 10
SHARD_BYTES = 4 << 20

NOT_WORD = np.zeros(256, bool)
NOT_WORD[:0x80] = [not (chr(b).isascii() and chr(b).isalnum()) for b in range(0x80)]
NORMAL = np.where(NOT_WORD, 0x20, LOWER).astype(np.uint8)
FOUND = "n_words bigint, n_hit bigint, hits array<struct<first:bigint,last:bigint,start:bigint,end:bigint>>, item_ids array<string>"


def normalised(texts: Texts) -> list[str]:
    """Each row's words with a space before, between and after them; a character per byte."""
    flat = NORMAL[texts.data].tobytes()
    ends = texts.offsets.tolist()
    return [(b" " + b" ".join(flat[a:b].split()) + b" ").decode("latin-1")
            for a, b in zip(ends, ends[1:])]


def item_windows(items: DataFrame, window: int, item: str, text: str) -> DataFrame:
    """Distinct (item_id, window, words) of all items."""
    def work(batches):
        for batch in batches:
            for t in texts_of(batch, "_text"):
                ids, out = t.values("_item").to_pylist(), {}
                for i, line in zip(ids, normalised(t)):
                    words = line.split()
                    n = min(window, len(words))
                    for k in range(len(words) - n + 1 if n else 0):
                        out[i, f" {' '.join(words[k:k + n])} "] = n
                yield pa.RecordBatch.from_pydict({
                    "item_id": pa.array([k[0] for k in out], pa.string()),
                    "window": pa.array([k[1] for k in out], pa.string()),
                    "words": pa.array(list(out.values()), pa.int32())})

    source = items.select(F.col(item).cast("string").alias("_item"), F.col(text).alias("_text"))
    return source.mapInArrow(work, "item_id string, window string, words int").distinct()


_automata: dict[str, ahocorasick.Automaton] = {}


def _automaton(key: str, windows: list[tuple[str, int, list[str]]]) -> ahocorasick.Automaton:
    """The automaton of a broadcast, built once per process; the last one stays."""
    if key not in _automata:
        _automata.clear()
        made = ahocorasick.Automaton()
        for line, words, ids in windows:
            made.add_word(line, (words, ids))
        made.make_automaton()
        _automata[key] = made
    return _automata[key]


def _merged(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of runs of words [first, last]; runs that touch become one."""
    order = np.argsort(first, kind="stable")
    first, reach = first[order], np.maximum.accumulate(last[order])
    new = np.concatenate([[True], first[1:] > reach[:-1] + 1])
    return first[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(first) - 1)]


def _scan(t: Texts, automaton: ahocorasick.Automaton | None):
    """Per row: words, hit words, runs with their character offsets, items."""
    words = Words(t, NOT_WORD)
    heads = None
    for row, (line, n) in enumerate(zip(normalised(t), words.counts.tolist())):
        found = list(automaton.iter(line)) if automaton is not None and n else []
        if not found:
            yield n, 0, [], []
            continue
        blanks = np.cumsum(np.frombuffer(line.encode("latin-1"), np.uint8) == 0x20)
        last = blanks[[end for end, _ in found]] - 2
        first = last - np.array([w for _, (w, _) in found]) + 1
        first, last = _merged(first, last)
        if heads is None:
            heads = np.concatenate([[0], np.cumsum((t.data & 0xC0) != 0x80)])
        base, at = words.bounds[row], heads[t.offsets[row]]
        hits = [dict(first=int(a), last=int(b), start=int(heads[words.starts[base + a]] - at),
                     end=int(heads[words.ends[base + b]] - at)) for a, b in zip(first, last)]
        ids = sorted({i for _, (_, own) in found for i in own})
        yield n, int((last - first + 1).sum()), hits, ids


def _find(docs: DataFrame, windows: list, name: str, key: str, text: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(windows)
    kind = docs.schema[key].dataType.simpleString()
    column_types = (pa.int64(), pa.int64(),
                    pa.list_(pa.struct([(n, pa.int64()) for n in ("first", "last", "start", "end")])),
                    pa.list_(pa.string()))

    def work(slices):
        automaton = _automaton(name, shared.value) if shared.value else None
        for t in slices:
            columns = zip(*_scan(t, automaton))
            yield pa.RecordBatch.from_arrays(
                [t.values("_key")] + [pa.array(c, k) for c, k in zip(columns, column_types)],
                ["_key", "n_words", "n_hit", "hits", "item_ids"])

    source = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    return map_texts(source, "_text", f"_key {kind}, {FOUND}", work).withColumnRenamed("_key", key)


def _joined_hits(hits: Column) -> Column:
    """Union of runs of words that several shards found, by their first word."""
    def add(done, run):
        top = F.element_at(done, -1)
        joins = (F.size(done) > 0) & (F.coalesce(top["last"], F.lit(-2)) + 1 >= run["first"])
        wider = F.struct(top["first"].alias("first"), F.greatest(top["last"], run["last"]).alias("last"),
                         top["start"].alias("start"), F.greatest(top["end"], run["end"]).alias("end"))
        return F.when(joins, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(wider))).otherwise(
            F.concat(done, F.array(run)))

    empty = F.slice(hits, 1, 0)
    return F.aggregate(F.array_sort(hits), empty, add)


def _written_windows(items: DataFrame, window: int, item: str, text: str) -> tuple[str, DataFrame]:
    """The distinct (item_id, window, words) of all items and where they are written."""
    path = shared_dir(items.sparkSession, "leak-windows")
    found = item_windows(items, window, item, text)
    found.write.parquet(path)
    return path, items.sparkSession.read.schema(found.schema).parquet(path)


def _shards(windows: DataFrame, shard_bytes: int, *columns: str) -> int:
    """How many shards hold these columns in `shard_bytes` each."""
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in columns), F.lit(0).cast("bigint"))
    return -(-(windows.agg(F.sum(size)).head()[0] or 0) // shard_bytes)


def _with_items(windows: DataFrame) -> list[tuple[str, int, list[str]]]:
    """One shard on the driver: its windows, each with those of its items that lie in the shard."""
    return [tuple(r) for r in windows.groupBy("window", "words")
            .agg(F.sort_array(F.collect_set("item_id"))).collect()]


def find_leaks(docs: DataFrame, items: DataFrame, window: int = WINDOW, *, key: str = "doc_id",
               text: str = "text", item: str = "item_id", item_text: str = "text",
               shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Per document: key, n_words, n_hit, hits (runs of hit words with character offsets of the
    original text) and item_ids (items with a window in it, sorted)."""
    spark = docs.sparkSession
    path, windows = _written_windows(items, window, item, item_text)
    shards = _shards(windows, shard_bytes, "window", "item_id")
    if shards <= 1:
        return _find(docs, _with_items(windows), path, key, text)
    keyed = shared_dir(spark, "leak-documents")
    (docs.select(F.struct(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"))
                 .alias("_row"), F.col(text).alias("_text")).write.parquet(keyed))
    parts = []
    for shard in range(shards):
        own = windows.filter(F.pmod(F.xxhash64("window", "item_id"), F.lit(shards)) == shard)
        parts.append(_find(spark.read.parquet(keyed), _with_items(own), f"{path}/{shard}", "_row",
                           "_text"))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    merged = found.groupBy("_row").agg(
        F.max("n_words").alias("n_words"),
        _joined_hits(F.flatten(F.collect_list("hits"))).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"))
    n_hit = F.aggregate("hits", F.lit(0).cast("bigint"),
                        lambda n, h: n + h["last"] - h["first"] + 1)
    return merged.select(F.col("_row.key").alias(key), "n_words", n_hit.alias("n_hit"), "hits",
                         "item_ids")


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, *, key: str = "doc_id",
                  text: str = "text", item: str = "item_id", item_text: str = "text",
                  shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The documents without a hit word, with all their columns.

    One pass without a join where the windows fit one automaton. Otherwise a row goes if its
    key and text have a hit, so rows that repeat both go together.
    """
    path, windows = _written_windows(items, window, item, item_text)
    distinct = windows.select("window", "words").distinct()
    if _shards(distinct, shard_bytes, "window") > 1:
        row = F.xxhash64(F.col(key), F.col(text))
        keyed = docs.select(row.alias("row"), F.col(text).alias("text"))
        dirty = find_leaks(keyed, items, window, key="row", item=item, item_text=item_text,
                           shard_bytes=shard_bytes).filter("n_hit > 0").select("row").distinct()
        return docs.join(dirty, F.xxhash64(docs[key], docs[text]) == dirty["row"], "left_anti")
    found = [(r.window, r.words, []) for r in distinct.collect()]
    shared = docs.sparkSession.sparkContext.broadcast(found)

    def work(slices):
        automaton = _automaton(path, shared.value) if shared.value else None
        for t in slices:
            clean = [not (n and automaton and next(automaton.iter(line), None))
                     for line, n in zip(normalised(t), np.diff(t.offsets).tolist())]
            yield t.batch.filter(pa.array(clean, pa.bool_()))

    return map_texts(docs, text, docs.schema, work)
