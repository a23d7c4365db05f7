"""Substring dedup: words covered by a window of `window` words that also starts elsewhere.

Suffix automata of reference shards find the repeated windows, each shard broadcast only to the
texts that can match it. That is decided by anchors: the anchor of a window is its least hashed
word k-gram (the first of equals), so equal windows have equal anchors at equal places. Consecutive
windows with one anchor form a run; each window belongs to one run, and the words of a run hold no
other windows.

1. Runs are listed by their anchor, with a hash of all their words. An anchor with one run is done,
   and so is one whose runs all have the same words: none or all of their windows are repeated.
2. Of the other anchors, equal runs count as one with a weight. The distinct runs are the reference.
   It is dealt to tasks by anchor and cut into shards of `shard_words`. A shard's suffix automaton
   counts how often each of its substrings occurs; streaming the runs through it gives their
   matching statistics, that is, the windows that occur at least twice.
3. An anchor with more than `shard_runs` distinct runs (a line that many texts share) would not fit
   a shard. Its runs are halved: windows that reach further to the left of the anchor, and to the
   right. The words that all windows of a half hold make a longer anchor; most are rare and done.
   What is still frequent is halved again, at last down to single windows, which are counted.
4. Repeated windows become spans of words, per document.

A broadcast of every shard to every document would take documents times shards; see the README.
Windows compare by 64-bit hashes of words, in the automaton word by word.

Defined cases: a null text has no words; texts shorter than a window keep everything; a window that
occurs twice in one text, overlapping itself or not, is repeated; repeated rows repeat each other
entirely; null ids are ordinary; an empty table gives an empty result. Columns other than id and
text aren't read by `repeated_spans` and pass through `remove_repeats`.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from jobloom.llm.batches import (
    Texts, Words, _powers_to, free_name, map_texts, mix, run_hashes, word_hashes,
)
from jobloom.session import shared_dir

WINDOW = 35
GRAM = 8
SHARD_WORDS = 50_000
SHARD_RUNS = 500
_PLACE = np.uint64((1 << 28) - 1)

RUN = "doc bigint, anchor bigint, run bigint, first int, last int, place int"
PIECE = "anchor bigint, run bigint, shift int, weight bigint, place int, part bigint, same bigint, words binary"


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` consecutive values."""
    done = 1
    while done * 2 <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    return np.minimum(values[:len(values) - (width - done)], values[width - done:])


def runs_of(t: Texts, window: int, gram: int):
    """Words, and of each run: row, anchor, hash, first and last window (by their first word in
    the slice), and the anchor's first word."""
    words = Words(t)
    hashes = word_hashes(t.data, words)
    n = len(hashes)
    none = np.empty(0, np.int64)
    if n < window:
        return words, none, none.view(np.uint64), none.view(np.uint64), none, none, none
    grams = run_hashes(hashes, gram)
    marked = grams & ~_PLACE | np.arange(len(grams), dtype=np.uint64)
    place = (_least(marked, window - gram + 1) & _PLACE).astype(np.int64)
    rows = words.rows
    inside = np.flatnonzero(rows[:n - window + 1] == rows[window - 1:])
    if not len(inside):
        return words, none, none.view(np.uint64), none.view(np.uint64), none, none, none
    place = place[inside]
    new = np.concatenate([[True], (np.diff(place) != 0) | (np.diff(inside) != 1)])
    begins = np.flatnonzero(new)
    ends = np.append(begins[1:], len(inside)) - 1
    first, last, place = inside[begins], inside[ends], place[begins]
    power, inverse = _powers_to(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * power[:n], out=sums[1:])
    content = (sums[last + window] - sums[first]) * inverse[first]
    shape = ((place - first) << 32 | (last - first)).astype(np.uint64)
    return words, rows[first], grams[place], mix(content + mix(shape)), first, last, place


def list_runs(docs: DataFrame, window: int, gram: int) -> DataFrame:
    def work(slices):
        for t in slices:
            words, row, anchor, run, first, last, place = runs_of(t, window, gram)
            base = words.bounds[row]
            yield pa.RecordBatch.from_arrays(
                [t.values("doc").take(pa.array(row)), pa.array(anchor.view(np.int64)),
                 pa.array(run.view(np.int64)), pa.array((first - base).astype(np.int32)),
                 pa.array((last - base).astype(np.int32)), pa.array((place - first).astype(np.int32))],
                ["doc", "anchor", "run", "first", "last", "place"])

    return map_texts(docs, "text", RUN, work)


class SuffixAutomaton:
    """All substrings of several sequences, with the weighted number of their occurrences."""

    def __init__(self):
        self.to: list[dict[int, int]] = [{}]
        self.link, self.length, self.weight = [-1], [0], [0]

    def _state(self, length: int, to: dict, link: int) -> int:
        self.to.append(to)
        self.link.append(link)
        self.length.append(length)
        self.weight.append(0)
        return len(self.to) - 1

    def _split(self, p: int, word: int, q: int) -> int:
        """Give the shorter strings of q a state of their own."""
        clone = self._state(self.length[p] + 1, dict(self.to[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.to[p].get(word) == q:
            self.to[p][word] = clone
            p = self.link[p]
        return clone

    def add(self, sequence: list[int], weight: int) -> None:
        last = 0
        for word in sequence:
            q = self.to[last].get(word)
            if q is not None:
                last = q if self.length[q] == self.length[last] + 1 else self._split(last, word, q)
            else:
                new, p = self._state(self.length[last] + 1, {}, 0), last
                while p >= 0 and word not in self.to[p]:
                    self.to[p][word] = new
                    p = self.link[p]
                if p >= 0:
                    q = self.to[p][word]
                    self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(
                        p, word, q)
                last = new
            self.weight[last] += weight

    def finish(self) -> None:
        """Add the occurrences of each string to those of its suffixes."""
        for state in sorted(range(1, len(self.to)), key=self.length.__getitem__, reverse=True):
            if self.link[state] > 0:
                self.weight[self.link[state]] += self.weight[state]

    def repeated(self, sequence: list[int], window: int) -> list[int]:
        """First words of the windows of a sequence that occur more than once."""
        found, state, length = [], 0, 0
        for i, word in enumerate(sequence):
            while state and word not in self.to[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.to[state]:
                state, length = self.to[state][word], length + 1
            while state and self.length[self.link[state]] >= window:
                state = self.link[state]
                length = self.length[state]
            if length >= window and self.weight[state] > 1:
                found.append(i - window + 1)
        return found


def _spans(starts: list[int]) -> list[tuple[int, int]]:
    """Runs of consecutive numbers."""
    out: list[tuple[int, int]] = []
    for s in starts:
        if out and out[-1][1] == s - 1:
            out[-1] = (out[-1][0], s)
        else:
            out.append((s, s))
    return out


def _shard_spans(window: int, shard_words: int):
    """Repeated windows of the distinct runs of a partition, shard by shard of whole anchors."""
    def flush(shard):
        automaton = SuffixAutomaton()
        for _, _, words, weight in shard:
            automaton.add(words, weight)
        automaton.finish()
        out = [(a, r, x, y) for a, r, words, _ in shard
               for x, y in _spans(automaton.repeated(words, window))]
        return pa.RecordBatch.from_arrays(
            [pa.array([o[i] for o in out], k) for i, k in enumerate(
                (pa.int64(), pa.int64(), pa.int32(), pa.int32()))], ["anchor", "run", "low", "high"])

    def work(batches):
        shard, size, anchor, known = [], 0, None, set()
        for batch in batches:
            for row in batch.to_pylist():
                if row["anchor"] != anchor:
                    if size >= shard_words:
                        yield flush(shard)
                        shard, size = [], 0
                    anchor, known = row["anchor"], set()
                if row["run"] in known:
                    continue
                known.add(row["run"])
                words = np.frombuffer(row["words"], np.int64).tolist()
                shard.append((anchor, row["run"], words, row["weight"]))
                size += len(words)
        if shard:
            yield flush(shard)

    return work


def next_gram(window: int, gram: int) -> int:
    """Words that all windows of a half hold."""
    return gram + (window - gram + 1) // 2


def _halves(window: int, gram: int):
    """Cut runs by whether their windows reach further left of the anchor or right of it.

    Of the window - gram words around the anchor at least half lie on one side, so all windows
    of a half hold that many words there: their anchor. `part` is the hash of its words and side,
    `same` of all words of the piece.
    """
    longer = next_gram(window, gram)
    reach = longer - gram

    def work(batches):
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                words, place = np.frombuffer(r["words"], np.uint64), r["place"]
                last = len(words) - window
                left = min(last, place - reach)
                for side, low, high, at in ((0, 0, left, place - reach),
                                            (1, max(0, left + 1), last, place)):
                    if low > high:
                        continue
                    part = run_hashes(words[at:at + longer], longer) + np.uint64(side)
                    own = words[low:high + window]
                    shape = np.array([(at - low) << 32 | len(own)], np.uint64)
                    same = mix(run_hashes(own, len(own)) + mix(shape))
                    rows.append((r["anchor"], r["run"], r["shift"] + low, r["weight"], at - low,
                                 int(mix(part).view(np.int64)[0]), int(same.view(np.int64)[0]),
                                 own.tobytes()))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(),
                     pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                [x.split(" ")[0] for x in PIECE.split(", ")])

    return work


class Repeats:
    """The repeated windows of all documents, step by step, in the shared folder."""

    def __init__(self, docs: DataFrame, window: int = WINDOW, gram: int = GRAM,
                 shard_words: int = SHARD_WORDS, shard_runs: int = SHARD_RUNS):
        """docs: (doc, text); rows with the same doc have the same text."""
        self.spark, self.docs, self.window, self.gram = docs.sparkSession, docs, window, gram
        self.shard_words, self.shard_runs = shard_words, shard_runs
        self.folder = shared_dir(self.spark, "substrings")

    def written(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    def _reference(self, kinds: DataFrame) -> DataFrame:
        """The words of the distinct runs. Rows that repeat a document repeat its runs."""
        window = self.window
        asked = F.collect_list(F.struct(
            "anchor", "run", "first", "last", "place", "weight")).alias("asked")
        wanted = self.written(kinds.groupBy("doc").agg(asked), "asked")
        # Spark broadcasts what is wanted where its size is known to be small.
        docs = self.docs.join(wanted, "doc").select("doc", "text", "asked")

        def work(slices):
            for t in slices:
                words = Words(t)
                hashes = word_hashes(t.data, words).view(np.int64)
                rows = [(a["anchor"], a["run"], a["weight"], a["place"],
                         hashes[b + a["first"]:b + a["last"] + window].tobytes())
                        for b, asked in zip(words.bounds.tolist(), t.values("asked").to_pylist())
                        for a in asked]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], k) for i, k in enumerate(
                        (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()))],
                    ["anchor", "run", "weight", "place", "words"])

        return map_texts(
            docs, "text", "anchor bigint, run bigint, weight bigint, place int, words binary", work)

    def _automata(self, pieces: DataFrame) -> DataFrame:
        """Repeated windows of (anchor, run, weight, words), by automata over whole anchors."""
        dealt = pieces.repartition("anchor").sortWithinPartitions("anchor")
        return dealt.mapInArrow(_shard_spans(self.window, self.shard_words),
                                "anchor bigint, run bigint, low int, high int")

    def _halved(self, hot: DataFrame) -> DataFrame:
        """Repeated windows of runs whose anchor is too frequent for a shard."""
        window, gram, level, out = self.window, self.gram, 0, []
        pieces = hot.dropDuplicates(["anchor", "run"]).select(
            "anchor", "run", F.lit(0).alias("shift"), "weight", "place",
            F.lit(0).cast("bigint").alias("part"), F.lit(0).cast("bigint").alias("same"), "words")
        keys = ["anchor", "run", "shift"]
        while True:
            level += 1
            halves = self.written(pieces.mapInArrow(_halves(window, gram), PIECE), f"halves-{level}")
            gram = next_gram(window, gram)
            counts = halves.groupBy("part").agg(
                F.sum("weight").alias("n"), F.count("*").alias("rows"),
                F.min("same").alias("x"), F.max("same").alias("y")).filter("n > 1")
            counts = self.written(counts.select(
                "part", "rows", (F.col("x") == F.col("y")).alias("all")), f"counts-{level}")
            met = self.written(halves.join(counts, "part"), f"met-{level}")
            n_windows = (F.octet_length("words") / 8 - window).cast("int")
            out.append(met.filter("all").select(
                "anchor", "run", F.col("shift").alias("low"), (F.col("shift") + n_windows).alias("high")))
            mixed = met.filter("not all")
            small = mixed.filter(F.col("rows") <= self.shard_runs)
            # A piece of its own for the automata: named by its words' place in the run.
            named = small.select(F.col("part").alias("anchor"), F.xxhash64(*keys).alias("run"),
                                 "weight", "words")
            found = self._automata(named).withColumnRenamed("anchor", "part").withColumnRenamed(
                "run", "_name")
            back = small.select("part", *keys, F.xxhash64(*keys).alias("_name"))
            out.append(back.join(found, ["part", "_name"]).select(
                "anchor", "run", (F.col("shift") + F.col("low")).alias("low"),
                (F.col("shift") + F.col("high")).alias("high")))
            pieces = mixed.filter(F.col("rows") > self.shard_runs).drop("rows", "all").select(
                *[x.split(" ")[0] for x in PIECE.split(", ")])
            if gram == window or pieces.isEmpty():
                break
        found = out[0]
        for more in out[1:]:
            found = found.union(more)
        return found

    def spans(self) -> DataFrame:
        """(doc, spans): runs of windows, by their first words, that are repeated."""
        runs = list_runs(self.docs, self.window, self.gram)
        met = (runs.groupBy("anchor").agg(F.count("*").alias("n"), F.min("run").alias("x"),
                                          F.max("run").alias("y"))
               .filter("n > 1").select("anchor", (F.col("x") == F.col("y")).alias("same")))
        # Written first, so that Spark can split a frequent anchor in the join.
        runs = self.written(runs.join(self.written(met, "met"), "anchor"), "runs")
        whole = runs.filter("same").select("doc", "first", "last")
        mixed = runs.filter("not same").drop("same")
        sample = F.min(F.struct("doc", "first", "last", "place")).alias("sample")
        kinds = self.written(
            mixed.groupBy("anchor", "run").agg(F.count("*").alias("weight"), sample)
            .select("anchor", "run", "weight", "sample.*"), "kinds")
        reference = self._reference(kinds)
        sizes = self.written(kinds.groupBy("anchor").agg(F.count("*").alias("n"))
                             .filter(F.col("n") > self.shard_runs).select("anchor"), "hot")
        reference = self.written(reference, "reference")
        cool = reference.join(sizes, "anchor", "left_anti").drop("place")
        found = self._automata(cool)
        hot = reference.join(sizes, "anchor", "left_semi")
        if not sizes.isEmpty():
            found = found.union(self._halved(hot))
        found = self.written(found, "found")
        low, high = F.col("first") + F.col("low"), F.col("first") + F.col("high")
        parts = mixed.join(found, ["anchor", "run"]).select(
            "doc", low.alias("first"), high.alias("last"))
        spans = F.collect_list(F.struct("first", "last")).alias("spans")
        return self.written(whole.union(parts).groupBy("doc").agg(spans), "spans")


def _covered(words: Words, row: int, spans: list[dict], window: int) -> np.ndarray:
    """Of the words of a row, which a repeated window covers."""
    n = int(words.bounds[row + 1] - words.bounds[row])
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, [s["first"] for s in spans], 1)
    np.add.at(steps, [s["last"] + window for s in spans], -1)
    return np.cumsum(steps[:n]) > 0


def _row_key(docs: DataFrame, key: str, text: str):
    return F.xxhash64(F.col(key), F.col(text))


def kept_words(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, *, key: str = "doc_id",
               text: str = "text", **options) -> DataFrame:
    """key, n_words, n_removed, kept (words joined by a blank) and kept_sha256 of each row."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"),
                       _row_key(docs, key, text).alias("doc"))
    repeats = Repeats(rows.select("doc", "text"), window, gram, **options)
    found = repeats.spans()
    joined = rows.join(found, "doc", "left")
    kind = docs.schema[key].dataType.simpleString()

    def work(slices):
        for t in slices:
            words, raw = Words(t), t.data.tobytes()
            removed, kept = [], []
            for row, spans in enumerate(t.values("spans").to_pylist()):
                a, b = words.bounds[row], words.bounds[row + 1]
                gone = _covered(words, row, spans, window) if spans else np.zeros(b - a, bool)
                left = np.flatnonzero(~gone) + a
                removed.append(int(gone.sum()))
                kept.append(b" ".join([raw[x:y] for x, y in zip(
                    words.starts[left].tolist(), words.ends[left].tolist())]))
            yield pa.RecordBatch.from_arrays(
                [t.values("key"), pa.array(words.counts.astype(np.int64)),
                 pa.array(removed, pa.int64()), pa.array(kept).cast(pa.string()),
                 pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())],
                ["key", "n_words", "n_removed", "kept", "kept_sha256"])

    out = map_texts(joined.select("key", "text", "spans"), "text",
                    f"key {kind}, n_words bigint, n_removed bigint, kept string, kept_sha256 string",
                    work)
    return out.withColumnRenamed("key", key)


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, *, key: str = "doc_id",
                   text: str = "text", **options) -> DataFrame:
    """The rows with the repeated words cut out of their text; the white space before a word goes
    with it. A row that loses nothing keeps its text to the letter."""
    doc, own = free_name(docs, "_doc"), free_name(docs, "_spans")
    held = docs.withColumn(doc, _row_key(docs, key, text))
    repeats = Repeats(held.select(F.col(doc).alias("doc"), F.col(text).alias("text")), window,
                      gram, **options)
    found = repeats.spans().select(F.col("doc").alias("_found"), F.col("spans").alias(own))
    joined = held.join(found, held[doc] == found["_found"], "left").select(*docs.columns, own)

    def work(slices):
        for t in slices:
            words, raw = Words(t), t.data.tobytes()
            texts = []
            for row, spans in enumerate(t.values(own).to_pylist()):
                low, high = int(t.offsets[row]), int(t.offsets[row + 1])
                if not spans:
                    texts.append(raw[low:high])
                    continue
                a, b = int(words.bounds[row]), int(words.bounds[row + 1])
                gone = _covered(words, row, spans, window)
                cuts = [low, *words.ends[a:b].tolist()]
                pieces = [raw[x:y] for x, y, g in zip(cuts, cuts[1:], gone) if not g]
                texts.append(b"".join([*pieces, raw[cuts[-1]:high]]).lstrip())
            cut = pa.array(texts, pa.binary()).cast(pa.string())
            valid = t.values(text).is_valid()
            at = t.batch.schema.get_field_index(text)
            columns = list(t.batch.columns)
            columns[at] = pc.if_else(valid, cut, pa.scalar(None, pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=t.batch.schema.names)

    return map_texts(joined, text, joined.schema, work).drop(own)
