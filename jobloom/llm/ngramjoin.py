"""N-gram Jaccard join by vertical partitioning, and the components of its links.

A document's set are its distinct word n-grams, as 64-bit hashes. Documents with equal sets form a
class; the join works on classes. N-grams have one global order, rare ones first: by a frequency
class from a table of bounded size (document counts of hashed n-grams), then by hash. The order is
cut into fragments of about equal mass, so each set is cut vertically into segments.

Candidates: two sets as similar as asked for share an n-gram among the first few of each (prefix),
at places that leave room for the rest (positions), and have similar sizes. Classes that share a
prefix n-gram form a bucket. For each candidate pair the overlaps of its segments are counted
fragment by fragment and summed, which gives the exact overlap.

Components need not see all pairs of a bucket. First each class is compared with its buckets' first
class. Classes that are still in other components than some of their bucket are compared with a few
more of it. Last, all pairs of a bucket whose classes still are in different components are
decided, so that no link between components can be missed: in small buckets by comparing them, in
large ones by their differences to a pivot. A group of copies, however large, costs a few comparisons
for each of its texts.

Differences to a pivot: classes that share large buckets form a cluster, whose pivot P holds the n-grams
that most classes of its largest bucket hold. What a class x has but P has not, or P has but x has
not, is dx, found fragment by fragment. As x and y differ by what dx and dy do not share, x and y are
linked iff F(x) + F(y) <= 2 (100 + p) |dx & dy| with F(x) = (100 + p) |dx| - (100 - p) |x|, for p percent.

- Where F(x) + F(y) <= 0 nothing needs to be shared: then both are linked with the class of least F, so
  one star around it links all of them.
- Else some n-grams of dx must be in dy. Those that one class alone holds are left out; of the others,
  rare ones first, only so many first ones are joined as the least sum of F allows.
- A class of which P holds little cannot be linked with one that P holds mostly. The latter are done; the
  others get a pivot of their own, a few times, and then are compared.

Only tables of bounded size are broadcast (frequency classes, 1 to 16 MB by the size of the input;
fragment cuts), and the ids of candidate classes up to `BROADCAST_IDS`; beyond that they are joined.

Defined cases: without text or words a set is empty, and linked with nothing; fewer than n words
are one n-gram; rows without id get no component and link nothing; rows that share an id are each
taken by their own text; repeated rows and ties are equal sets, linked if not empty; an empty table
gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import zlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F

from jobloom.llm.batches import (
    LOWER, Texts, Words, map_texts, mix, run_hashes, texts_of, word_hashes,
)
from jobloom.llm.components import components
from jobloom.llm.written import written
from jobloom.session import shared_dir

WORDS = 4
PERCENT = 85
FRAGMENTS = 4
# The table of document counts has 2**20 entries for small inputs and 2**24 at most. Its size only
# decides how well the order tells rare n-grams from frequent ones.
LEAST_BITS, MOST_BITS = 20, 24
BYTES_PER_COUNTER = 64
SLICES = 64
SALTS = 1024
BROADCAST_IDS = 500_000
PIVOTS = 3
# Clusters get a new pivot so many times; longer lists of shared differences are not compared in the join.
PIVOT_ROUNDS, LONGEST_LIST = 3, 256
# Bits of a set's outline, and classes from which on a bucket is compared by outlines first.
OUTLINE_BITS = 1024
LARGE_BUCKET = 64


def ngram_sets(t: Texts, n: int):
    """The sorted distinct n-gram hashes of each row."""
    lowered = Texts(t.batch, t.column, LOWER[t.data], t.offsets)
    words = Words(lowered)
    hashes = word_hashes(lowered.data, words)
    grams = run_hashes(hashes, n)
    for a, b in zip(words.bounds.tolist(), words.bounds[1:].tolist()):
        if b - a >= n:
            yield np.unique(grams[a:b - n + 1])
        elif b > a:
            yield mix(run_hashes(hashes[a:b], b - a) + np.uint64(b - a))
        else:
            yield np.empty(0, np.uint64)


def _counter(grams: np.ndarray, bits: int) -> np.ndarray:
    return (grams >> np.uint64(64 - bits)).astype(np.int64)


def counter_bits(df: DataFrame) -> int:
    """Size of the table of counts, by Spark's estimate of the input's size."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(LEAST_BITS, min(MOST_BITS, (size // BYTES_PER_COUNTER).bit_length()))


def _summed(rows: DataFrame, *by: str) -> DataFrame:
    """Sum packed counter slices per group of bounded size."""
    def add(table: pa.Table) -> pa.Table:
        total: np.ndarray | int = 0
        for packed in table.column("counts").to_pylist():
            total = total + np.frombuffer(zlib.decompress(packed), np.uint64)
        return pa.table({
            "part": pa.array([table.column("part")[0].as_py()], pa.int32()),
            "salt": pa.array([table.column("salt")[0].as_py()], pa.int32()),
            "counts": [zlib.compress(total.tobytes(), 1)]})

    return rows.groupBy(*by).applyInArrow(add, "part int, salt int, counts binary")


def frequency_table(docs: DataFrame, n: int, bits: int) -> np.ndarray:
    """Documents per hashed n-gram, over all documents, in 2**bits counters."""
    def work(batches):
        total = np.zeros(1 << bits, np.uint32)
        held, size = [], 0

        def count():
            if held:
                np.add(total, np.bincount(_counter(np.concatenate(held), bits), minlength=1 << bits),
                       out=total, casting="unsafe")
                held.clear()

        for batch in batches:
            for t in texts_of(batch, "_text"):
                for grams in ngram_sets(t, n):
                    held.append(grams)
                    size += len(grams)
                if size >= 1 << 21:
                    count()
                    size = 0
        count()
        salt = TaskContext.get().partitionId() % SALTS
        parts = [zlib.compress(p.astype(np.uint64).tobytes(), 1) for p in np.split(total, SLICES)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(SLICES), pa.int32()), pa.array([salt] * SLICES, pa.int32()),
             pa.array(parts)], ["part", "salt", "counts"])

    counted = docs.mapInArrow(work, "part int, salt int, counts binary")
    out = np.zeros((SLICES, (1 << bits) // SLICES), np.uint32)
    for row in _summed(_summed(counted, "part", "salt"), "part").toLocalIterator():
        out[row.part] = np.frombuffer(zlib.decompress(row.counts), np.uint64)
    return out.ravel()


class GlobalOrder:
    """Rank of each n-gram, rare ones first, and the cuts into fragments."""

    def __init__(self, counts: np.ndarray, fragments: int):
        self.bits = len(counts).bit_length() - 1
        self.ranks = np.minimum(8 * np.log2(counts.astype(np.float32) + 1), 255).astype(np.uint8)
        mass = np.bincount(self.ranks, weights=counts, minlength=256)
        ends = np.concatenate([[0.0], np.cumsum(mass)])
        goals = ends[-1] * np.arange(1, fragments) / fragments
        rank = np.clip(np.searchsorted(ends, goals, side="right") - 1, 0, 255)
        within = (goals - ends[rank]) / np.maximum(mass[rank], 1)
        self.cuts = (rank.astype(np.uint64) << np.uint64(56)) + (
            np.clip(within, 0, 0.999) * 2.0**56).astype(np.uint64)

    def keys(self, grams: np.ndarray) -> np.ndarray:
        rank = self.ranks[_counter(grams, self.bits)].astype(np.uint64)
        return rank << np.uint64(56) | grams & np.uint64((1 << 56) - 1)

    def fragment(self, grams: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.cuts, self.keys(grams), side="right")


def prefix_length(size: int, percent: int) -> int:
    """How many first n-grams must meet those of a set that is similar enough."""
    return size - -(-percent * size // 100) + 1 if size else 0


def class_hash(grams: np.ndarray) -> int:
    """Names a set by its size and two sums over it."""
    n = np.array([len(grams)], np.uint64)
    if not len(grams):
        return 0
    sums = np.array([grams.sum(dtype=np.uint64)]) + np.array(
        [np.bitwise_xor.reduce(mix(grams))]) * np.uint64(31)
    return int(mix(n * np.uint64(0x9E3779B97F4A7C15) + mix(n + sums)).view(np.int64)[0])


def outline(grams: np.ndarray) -> np.ndarray:
    """A bitmap with a bit set for each n-gram, by its hash."""
    marked = np.zeros(OUTLINE_BITS, np.uint8)
    marked[(grams % np.uint64(OUTLINE_BITS)).astype(np.int64)] = 1
    return np.packbits(marked, bitorder="little").view("<i8")


def signatures(docs: DataFrame, shared, n: int, percent: int) -> DataFrame:
    """(doc_id, class, size, prefix, outline) of all documents."""
    def work(slices):
        order = shared.value
        for t in slices:
            classes, sizes, prefixes, outlines = [], [], [], []
            for grams in ngram_sets(t, n):
                classes.append(class_hash(grams))
                sizes.append(len(grams))
                first = grams[np.argsort(order.keys(grams))[:prefix_length(len(grams), percent)]]
                prefixes.append(first.view(np.int64))
                outlines.append(outline(grams))
            ends = np.concatenate([[0], np.cumsum([len(p) for p in prefixes])])
            flat = np.concatenate(prefixes) if prefixes else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [t.values("_id"), pa.array(classes, pa.int64()), pa.array(sizes, pa.int32()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)),
                 pa.array(outlines, pa.list_(pa.int64()))],
                ["doc_id", "class", "size", "prefix", "outline"])

    return map_texts(docs, "_text", "doc_id bigint, class bigint, size int, prefix array<bigint>, "
                     "outline array<bigint>", work)


def segments(docs: DataFrame, shared, n: int) -> DataFrame:
    """(class, fragment, size, grams): the sets cut at the order's cuts, sorted by hash. Texts of
    other classes than the row says are left out."""
    def work(slices):
        order = shared.value
        for t in slices:
            out = [[], [], [], []]
            for grams, wanted in zip(ngram_sets(t, n), t.values("class").to_pylist()):
                name, part = class_hash(grams), order.fragment(grams)
                for f in np.unique(part).tolist() if name == wanted else ():
                    for column, value in zip(out, (name, f, len(grams), grams[part == f].tobytes())):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()),
                 pa.array(out[2], pa.int32()), pa.array(out[3], pa.binary())],
                ["class", "fragment", "size", "grams"])

    return map_texts(docs, "_text", "class bigint, fragment int, size int, grams binary", work)


def _overlaps(batches):
    """Common n-grams of two segments of one fragment."""
    for batch in batches:
        left, right = batch.column(5).to_pylist(), batch.column(6).to_pylist()
        known: dict[bytes, np.ndarray] = {}
        common = []
        for x, y in zip(left, right):
            if y not in known:
                known = {y: np.frombuffer(y, np.uint64)}
            common.append(len(np.intersect1d(np.frombuffer(x, np.uint64), known[y],
                                             assume_unique=True)))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:5], pa.array(common, pa.int64())],
            ["a", "b", "size_a", "size_b", "fragment", "common"])


def similar(pairs: DataFrame, cut: DataFrame, percent: int) -> DataFrame:
    """The (u, v) of (a, b) pairs of classes that are similar enough, compared fragment by fragment."""
    left = cut.select(F.col("class").alias("a"), "fragment", F.col("size").alias("size_a"),
                      F.col("grams").alias("grams_a"))
    right = cut.select(F.col("class").alias("b"), "fragment", F.col("size").alias("size_b"),
                       F.col("grams").alias("grams_b"))
    met = pairs.join(left, "a").join(right, ["b", "fragment"]).select(
        "a", "b", "size_a", "size_b", "fragment", "grams_a", "grams_b")
    parts = met.mapInArrow(
        _overlaps, "a bigint, b bigint, size_a int, size_b int, fragment int, common bigint")
    # Repeated rows of a class repeat a fragment.
    parts = parts.groupBy("a", "b", "size_a", "size_b", "fragment").agg(F.max("common").alias("common"))
    common = F.sum("common")
    return (parts.groupBy("a", "b", "size_a", "size_b").agg(common.alias("common"))
            .filter(F.col("common") * 100 >= F.lit(percent) * (
                F.col("size_a") + F.col("size_b") - F.col("common")))
            .select(F.col("a").alias("u"), F.col("b").alias("v")))


def _exploded(batches):
    """The n-grams of segments, one a row."""
    for batch in batches:
        grams = [np.frombuffer(g, np.int64) for g in batch.column(2).to_pylist()]
        lengths = [len(g) for g in grams]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(batch.column(0).to_numpy(), lengths)),
             pa.array(np.repeat(batch.column(1).to_numpy(), lengths)),
             pa.array(np.concatenate(grams) if grams else np.empty(0, np.int64))],
            ["cluster", "fragment", "gram"])


def _differences(batches):
    """What a segment and its part of the pivot do not share, and how many they do."""
    for batch in batches:
        out, inside = [], []
        for grams, pivot in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist()):
            x = np.frombuffer(grams or b"", np.int64)
            p = np.array(pivot or [], np.int64)
            out.append(np.setxor1d(x, p, assume_unique=True))
            inside.append((len(x) + len(p) - len(out[-1])) // 2)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(out, pa.list_(pa.int64())), pa.array(inside, pa.int64())],
            ["cluster", "class", "fragment", "differ", "inside"])


def _can_meet(x: str, y: str, percent: int) -> Column:
    """Sizes and places of a shared prefix n-gram leave room for enough overlap.

    If it is the first n-gram that two sets share, what they share stands from there on in both.
    So a pair that is similar enough passes at its first shared n-gram; at others it need not.
    """
    size_x, size_y = F.col(f"{x}.size"), F.col(f"{y}.size")
    rest = F.least(size_x - F.col(f"{x}.place"), size_y - F.col(f"{y}.place"))
    sizes = F.least(size_x, size_y) * 100 >= F.greatest(size_x, size_y) * percent
    return sizes & (rest * (100 + percent) >= (size_x + size_y) * percent)


def _outlines_meet(x: str, y: str, percent: int) -> Column:
    """Outlines leave room for enough overlap: a bit that only one has is an n-gram of its own."""
    def own(a: str, b: str) -> Column:
        bits = [F.bit_count(F.col(f"{a}.outline")[k].bitwiseAND(F.bitwise_not(F.col(f"{b}.outline")[k])))
                for k in range(OUTLINE_BITS // 64)]
        return F.col(f"{a}.size") - reduce(Column.__add__, bits)

    room = F.least(own(x, y), own(y, x))
    return room * (100 + percent) >= (F.col(f"{x}.size") + F.col(f"{y}.size")) * percent


class Join:
    """Classes, buckets and links of one join; every table is written to the shared folder."""

    def __init__(self, docs: DataFrame, n: int = WORDS, percent: int = PERCENT,
                 fragments: int = FRAGMENTS, *, key: str = "doc_id", text: str = "text"):
        self.spark, self.percent = docs.sparkSession, percent
        self.folder = shared_dir(self.spark, "ngram-join")
        source = docs.select(F.col(key).cast("bigint").alias("_id"), F.col(text).alias("_text"))
        texts = source.select("_text")
        order = GlobalOrder(frequency_table(texts, n, counter_bits(texts)), fragments)
        self.shared = self.spark.sparkContext.broadcast(order)
        self.source, self.n, self.fragments, self.cuts = source, n, fragments, []
        self.docs = self.written(signatures(source, self.shared, n, percent), "signatures")
        sets = self.docs.filter("size > 0 and doc_id is not null")
        self.classes = self.written(
            sets.groupBy("class").agg(F.min("doc_id").alias("first")), "classes")
        own = sets.join(self.classes, (sets["class"] == self.classes["class"])
                        & (sets["doc_id"] == self.classes["first"]), "left_semi")
        self.members = self.written(self._buckets(own), "buckets")
        held = self.members.select("class").distinct()
        # Rows that repeat a class repeat its outline, which changes nothing.
        self.outlines = self.written(
            own.select("class", "size", "outline").join(held, "class", "left_semi"), "outlines")

    def written(self, df: DataFrame, name: str) -> DataFrame:
        return written(df, f"{self.folder}/{name}")

    def _buckets(self, own: DataFrame) -> DataFrame:
        """(gram, class, size, place, first) of prefix n-grams that several classes hold."""
        rows = own.select("class", "size", F.posexplode("prefix").alias("place", "gram"))
        shared = (rows.groupBy("gram").agg(F.min("class").alias("first"), F.max("class").alias("last"))
                  .filter("first <> last").select("gram", "first"))
        # Written first, so that Spark can split a frequent n-gram in the join.
        return rows.join(self.written(shared, "shared"), "gram")

    def _cut(self, pairs: DataFrame, step: int | str) -> DataFrame:
        """The segments of the classes of these pairs; those of earlier steps are kept."""
        ids = pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct()
        for earlier in self.cuts:
            ids = ids.join(earlier.select("class").distinct(), "class", "left_anti")
        ids = ids.join(self.classes, "class").select("class", F.col("first").alias("_id"))
        ids = self.written(ids, f"candidates-{step}")
        wanted = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
        cut = segments(self.source.join(wanted, "_id"), self.shared, self.n)
        self.cuts.append(self.written(cut, f"segments-{step}"))
        out = self.cuts[0]
        for more in self.cuts[1:]:
            out = out.union(more)
        return out

    def _similar(self, pairs: DataFrame, step: int | str) -> DataFrame:
        """The links among these pairs. Outlines spare most of those that are none."""
        x = self.outlines.withColumnRenamed("class", "a").alias("x")
        y = self.outlines.withColumnRenamed("class", "b").alias("y")
        near = pairs.join(x, "a").join(y, "b").filter(_outlines_meet("x", "y", self.percent))
        near = self.written(near.select("a", "b").distinct(), f"near-{step}")
        if near.isEmpty():
            return near.select(F.col("a").alias("u"), F.col("b").alias("v"))
        return self.written(similar(near, self._cut(near, step), self.percent), f"links-{step}")

    def _labelled(self, labels: DataFrame) -> DataFrame:
        """Buckets whose classes are in several components, with the components."""
        rows = self.members.join(labels.withColumnRenamed("node", "class"), "class", "left")
        rows = rows.withColumn("label", F.coalesce("label", "class"))
        mixed = (rows.groupBy("gram").agg(F.min("label").alias("x"), F.max("label").alias("y"))
                 .filter("x <> y").select("gram"))
        return rows.join(mixed, "gram", "left_semi")

    @staticmethod
    def _with_earlier(rows: DataFrame) -> DataFrame:
        """Add the n-grams of the class in these rows that stand before, at most a prefix."""
        own = F.sort_array(F.collect_list(F.struct("place", "gram"))).alias("own")
        lists = rows.groupBy("class", "size", "label").agg(own)
        each = lists.select("class", "size", "label", "own", F.posexplode("own").alias("i", "at"))
        earlier = F.transform(F.slice("own", F.lit(1), F.col("i")), lambda x: x["gram"])
        return each.select("class", "size", "label", "at.place", "at.gram", earlier.alias("earlier"))

    def _paired(self, left: DataFrame, right: DataFrame, apart: Column) -> DataFrame:
        pairs = left.alias("x").join(right.alias("y"), "gram").filter(
            _can_meet("x", "y", self.percent) & apart)
        return pairs.select(F.greatest("x.class", "y.class").alias("a"),
                            F.least("x.class", "y.class").alias("b")).distinct()

    def links(self) -> DataFrame:
        """(u, v) links between classes with the components of all links."""
        differ = F.col("x.class") != F.col("y.class")
        first = self.members.filter(F.col("class") == F.col("first"))
        pairs = self.written(self._paired(self.members, first, differ), "pairs-1")
        found = self._similar(pairs, 1)
        tried, links = pairs, found

        other = F.col("x.label") != F.col("y.label")
        rows = self.written(self._labelled(components(links)), "labelled-2")
        places = [F.min(F.xxhash64("class", F.lit(i))).alias(f"p{i}") for i in range(PIVOTS)]
        chosen = rows.groupBy("gram").agg(*places)
        is_chosen = F.lit(False)
        for i in range(PIVOTS):
            is_chosen |= F.xxhash64("class", F.lit(i)) == F.col(f"p{i}")
        some = rows.join(chosen, "gram").filter(is_chosen).select(*rows.columns)
        pairs = self._paired(rows, some, other).join(tried, ["a", "b"], "left_anti")
        pairs = self.written(pairs, "pairs-2")
        found = self._similar(pairs, 2)
        tried, links = tried.union(pairs), links.union(found)

        links, done = self._by_differences(links)
        rows = self.written(self._labelled(components(links)), "labelled-3")
        # Each pair once, at the first n-gram that its classes share.
        rows = self.written(self._with_earlier(rows), "earlier-3")
        large = self.written(self._large(self.members), "large-3")
        apart = other & (F.col("x.class") > F.col("y.class"))
        once = ~F.arrays_overlap("x.earlier", "y.earlier")
        few = rows.join(large, "gram", "left_anti")
        pairs = self._paired(few, few, apart & once)
        rest = rows.join(large, "gram", "left_semi").join(done, "class", "left_anti")
        if not rest.isEmpty():
            outlines = self.outlines.select("class", "outline").dropDuplicates(["class"])
            many = self.written(rest.join(outlines, "class"), "many-3")
            pairs = pairs.union(self._paired(
                many, many, apart & _outlines_meet("x", "y", self.percent) & once)).distinct()
        pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = self.written(pairs, "pairs-3")
        found = self._similar(pairs, 3)
        return links.union(found)

    @staticmethod
    def _large(rows: DataFrame) -> DataFrame:
        return rows.groupBy("gram").agg(F.count("*").alias("n")).filter(
            F.col("n") > LARGE_BUCKET).select("gram")

    def _by_differences(self, links: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The links with those that large buckets add, and the classes of which none is missed there."""
        done = self.classes.select("class").filter(F.lit(False))
        large = self.written(self._large(self.members), "large-0")
        for i in range(PIVOT_ROUNDS):
            rows = self._labelled(components(links)).join(large, "gram", "left_semi")
            rows = self.written(rows.join(done, "class", "left_anti"), f"hard-{i}")
            if rows.isEmpty():
                break
            more, near = self._one_pivot_each(rows, links, i)
            links, done = links.union(more), done.union(near)
            if near.isEmpty():
                break
        return links, self.written(done, "done")

    def _one_pivot_each(self, rows: DataFrame, links: DataFrame, i: int) -> tuple[DataFrame, DataFrame]:
        """Links between classes of these large buckets by differences to one pivot for each cluster, and
        the classes that the pivots mostly hold: no link of theirs is missed."""
        up, down = 100 + self.percent, 100 - self.percent
        hubs = rows.groupBy("gram").agg(F.min("class").alias("v"))
        tied = rows.join(hubs, "gram").select(F.col("class").alias("u"), "v")
        clusters = components(tied).select(F.col("node").alias("class"), F.col("label").alias("cluster"))
        every = rows.select("class", "size").distinct().join(clusters, "class", "left")
        every = self.written(every.withColumn("cluster", F.coalesce("cluster", "class")), f"clusters-{i}")

        placed = rows.select("gram", "class").join(every.select("class", "cluster"), "class")
        buckets = placed.groupBy("cluster", "gram").agg(F.count("*").alias("n"))
        largest = buckets.groupBy("cluster").agg(F.max(F.struct("n", "gram")).alias("b")).select(
            "cluster", "b.n", "b.gram")
        heart = placed.join(largest, ["cluster", "gram"]).select("cluster", "class", "n")
        both = every.select(F.col("class").alias("a"), F.col("class").alias("b"))
        cut = self._cut(both, f"every-{i}").dropDuplicates(["class", "fragment"]).select(
            "class", "fragment", "grams")
        held = heart.join(cut, "class").select("cluster", "fragment", "grams").mapInArrow(
            _exploded, "cluster bigint, fragment int, gram bigint")
        held = held.groupBy("cluster", "fragment", "gram").agg(F.count("*").alias("held"))
        pivots = held.join(largest.select("cluster", "n"), "cluster").filter(F.col("held") * 2 > F.col("n"))
        pivots = self.written(pivots.groupBy("cluster", "fragment").agg(
            F.collect_list("gram").alias("pivot")), f"pivots-{i}")

        # The pivot may have n-grams in a fragment where a class has none.
        parts = every.select("class", "cluster", F.explode(F.sequence(F.lit(0), F.lit(self.fragments - 1)))
                             .alias("fragment"))
        parts = parts.join(cut, ["class", "fragment"], "left").join(pivots, ["cluster", "fragment"], "left")
        differ = self.written(parts.select("cluster", "class", "fragment", "grams", "pivot").mapInArrow(
            _differences, "cluster bigint, class bigint, fragment int, differ array<bigint>, "
            "inside bigint"), f"differ-{i}")
        told = differ.groupBy("class").agg(F.sum(F.size("differ")).alias("d"), F.sum("inside").alias("inside"))
        told = every.join(told, "class").withColumn("f", F.col("d") * up - F.col("size") * down)
        told = self.written(told, f"told-{i}")
        near = self.written(told.filter(
            (F.col("size") - F.col("inside")) * up <= F.col("size") * self.percent).select("class"), f"mostly-{i}")
        kept = told.filter(F.col("inside") * up >= F.col("size") * self.percent)

        hub = self.written(kept.groupBy("cluster").agg(F.min(F.struct("f", "class")).alias("m")).select(
            "cluster", F.col("m.f").alias("hub_f"), F.col("m.class").alias("hub")), f"hubs-{i}")
        kept = self.written(kept.join(hub, "cluster"), f"kept-{i}")
        star = self.written(kept.filter((F.col("f") + F.col("hub_f") <= 0) & (F.col("class") != F.col("hub")))
                            .select(F.col("class").alias("u"), F.col("hub").alias("v")), f"star-{i}")

        one = differ.select("cluster", "class", F.explode("differ").alias("gram")).join(
            kept.select("class"), "class", "left_semi")
        one = self.written(one, f"one-{i}")
        common = self.written(one.groupBy("cluster", "gram").agg(F.count("*").alias("n")).filter("n > 1"),
                              f"common-{i}")
        lists = one.join(common, ["cluster", "gram"]).groupBy("class").agg(
            F.sort_array(F.collect_list(F.struct("n", "gram"))).alias("list"))
        need = F.greatest(F.ceil((F.col("f") + F.col("hub_f")) / (2 * up)), F.lit(1)).cast("int")
        labels = components(links.union(star)).withColumnRenamed("node", "class")
        lists = (lists.join(kept.select("class", "cluster", "f", "hub_f"), "class")
                 .join(labels, "class", "left").withColumn("label", F.coalesce("label", "class"))
                 .withColumn("n", F.size("list")).withColumn("first", F.col("n") - need + 1).filter("first > 0"))
        grams = F.transform("list", lambda x: x["gram"])
        asked = lists.select("class", "cluster", "label", "f", "n",
                             F.when(F.col("n") <= LONGEST_LIST, grams).alias("whole"),
                             F.posexplode(F.slice(grams, F.lit(1), F.col("first"))).alias("place", "gram"))
        asked = self.written(asked, f"asked-{i}")
        total = F.col("x.f") + F.col("y.f")
        left = F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place"))
        shared = F.coalesce(F.size(F.array_intersect("x.whole", "y.whole")), left)
        met = asked.alias("x").join(asked.alias("y"), ["cluster", "gram"]).filter(
            (F.col("x.class") > F.col("y.class")) & (F.col("x.label") != F.col("y.label"))
            & (total <= left * (2 * up)) & (total <= shared * (2 * up)))
        pairs = met.select(F.col("x.class").alias("a"), F.col("y.class").alias("b")).distinct()
        pairs = self.written(pairs, f"pairs-pivot-{i}")
        return star.union(self._similar(pairs, f"pivot-{i}")), near

    def result(self) -> DataFrame:
        """(doc_id, n_shingles, class, component_id) of all documents."""
        labels = components(self.links()).withColumnRenamed("node", "class")
        named = self.classes.join(labels, "class", "left").withColumn(
            "label", F.coalesce("label", "class"))
        least = named.groupBy("label").agg(F.min("first").alias("component_id"))
        named = self.written(named.join(least, "label").select("class", "component_id"), "components")
        rows = self.docs.select("doc_id", "class", F.col("size").cast("bigint").alias("n_shingles"))
        linked = rows.filter("n_shingles > 0 and doc_id is not null").join(named, "class")
        rest = rows.filter("n_shingles = 0 or doc_id is null").withColumn(
            "component_id", F.when(F.col("n_shingles") == 0, F.col("doc_id")))
        return linked.select("doc_id", "n_shingles", "class", "component_id").unionByName(
            rest.select("doc_id", "n_shingles", "class", "component_id"))


def similar_components(docs: DataFrame, n: int = WORDS, percent: int = PERCENT,
                       **options) -> DataFrame:
    """doc_id, n_shingles, class (equal for equal sets) and component_id of each document."""
    return Join(docs, n, percent, **options).result()


def keep_one(docs: DataFrame, n: int = WORDS, percent: int = PERCENT, *, key: str = "doc_id",
             text: str = "text") -> DataFrame:
    """One document of each component, that with the smallest id, with all columns. Rows without
    id and empty ones stay; rows that share an id stay or go together."""
    found = similar_components(docs, n, percent, key=key, text=text)
    gone = found.filter("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs[key] == gone["_gone"], "left_anti")


def _with_row_id(docs: DataFrame, name: str, folder: str) -> DataFrame:
    """docs with an id of each row: what its file and place hash to, if docs are the rows of Parquet files,
    else a number that is written down with the rows."""
    relation = docs._jdf.queryExecution().analyzed().nodeName() == "LogicalRelation"
    if relation and docs.inputFiles():
        try:
            return docs.withColumn(name, F.xxhash64("_metadata.file_path", "_metadata.row_index"))
        except AnalysisException:  # files of another format
            pass
    return written(docs.withColumn(name, F.monotonically_increasing_id()), f"{folder}/rows")


def keep_one_row(docs: DataFrame, n: int = WORDS, percent: int = PERCENT, *, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """One row of each component, with all columns; each row is taken by its own text, also those
    that repeat a row, share an id or have none. The smallest id stays (none counts as the largest),
    then the smallest hash of the text. Empty texts are linked with nothing and stay.

    The rows of Parquet files are read again where they are needed, others are written down first."""
    folder = shared_dir(docs.sparkSession, "keep-one-row")
    row = "_row"
    while row in docs.columns:
        row += "_"
    rows = _with_row_id(docs, row, folder)
    found = similar_components(rows, n, percent, key=row, text=text).filter("n_shingles > 0")
    found = found.select(F.col("doc_id").alias("row"), "component_id")
    names = rows.select(F.col(row).alias("row"), F.struct(
        F.col(key).isNull().alias("none"), F.col(key).alias("id"), F.xxhash64(text).alias("hash"),
        F.col(row).alias("row")).alias("name"))
    found = written(found.join(names, "row"), f"{folder}/found")
    stay = found.groupBy("component_id").agg(F.min("name").alias("name"))
    gone = found.select("row").join(stay.select(F.col("name.row").alias("row")), "row", "left_anti")
    gone = written(gone.withColumnRenamed("row", "_gone"), f"{folder}/gone")
    return rows.join(gone, rows[row] == gone["_gone"], "left_anti").select(*docs.columns)
