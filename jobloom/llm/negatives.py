"""Hard negatives by a vertical scan of dimension columns that narrows a bitmap of candidates.

Rows are dealt into blocks; a block holds one column of whole numbers per dimension, with the column's
least and largest value. Each anchor reads the columns in descending magnitude of its own components.
What the unread columns can still add to a score lies between the sums of their least and largest
contributions, so after every few columns the candidates' bitmap loses the rows that can no longer

- be among the best k of the anchor's label (the k-th best surely reached score is the bar), or
- lie in any of the score windows that the anchor's positives open, or be among a window's best k (its
  bar is the k-th best score among rows that surely lie in it).

Scores of the rows that remain when all columns are read are exact, and the windows are resolved on them.

Two scans: the first finds each anchor's positives, which are merged over blocks and written down; the
second, sent with the windows, finds the negatives, which are merged over blocks again. Anchors travel
in chunks of bounded size; a cell of a grid of blocks and groups of chunks is one unit of work, dealt
over a stated number of tasks. No task holds more than a block and a chunk, and every anchor sees every
row. Written tables keep rows and blocks, so a lost executor costs its tasks alone.

Defined cases: rows with a null label, a null vector or a null, NaN or infinite component take no part;
a null id is no anchor but a candidate, last among ties; rows that share an id are rows of their own, as
anchors and as candidates, and a row is never its own candidate. Missing components of shorter vectors
count as 0, so that an empty vector scores 0. Where scores would leave 64 bits, components count as the
largest that keeps them in. Fewer than k rows: all are returned; an anchor without positives or a positive
without negatives gives no row. Empty tables give an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from jobloom.llm.vectors import bound, exact_floats, sound, whole
from jobloom.session import shared_dir

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
# A negative's score lies between these hundredths of its positive's, both included.
LEAST, MOST = 30, 90
BLOCK_CELLS = 1 << 18
CHUNK_ANCHORS = 64
# Chunks of anchors that meet a block in one cell of the grid.
CELL_CHUNKS = 8
# Columns read between two looks at the bitmap.
STEP = 8

BLOCK = "block int, rows array<bigint>, ids array<bigint>, labels array<bigint>, columns binary, dims int"
CHUNK = ("chunk int, anchors array<bigint>, anchor_labels array<bigint>, vectors binary, "
         "windows array<array<bigint>>")


class Block:
    """Dimension columns of some rows in memory, in the order of their ids (nulls last)."""

    def __init__(self, rows: np.ndarray, ids: pa.Array, labels: np.ndarray, columns: np.ndarray):
        self.rows, self.ids, self.labels = rows, ids, labels
        dims, n = columns.shape
        self.low = columns.min(axis=1) if n else np.zeros(dims, np.int64)
        self.high = columns.max(axis=1) if n else np.zeros(dims, np.int64)
        self.largest = int(np.abs(columns).max(initial=0))
        self.columns, self.dims = columns, dims
        self._floats: np.ndarray | None = None

    def scan(self, anchor: np.ndarray, alive: np.ndarray,
             needed: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Positions and exact scores of the rows of the bitmap `alive` that stay needed.

        `needed` says so of rows by the least and the largest score that they can still reach.
        """
        columns = self.columns
        if exact_floats(self.largest, np.abs(anchor).max(initial=0), dims=self.dims):
            if self._floats is None:
                self._floats = columns.astype(np.float64)
            columns, anchor = self._floats, anchor.astype(np.float64)
        order = np.argsort(-np.abs(anchor), kind="stable")
        ends = np.stack([anchor * self.low, anchor * self.high])[:, order]
        # What is left to add from the k-th column of the order on.
        left = np.zeros((2, self.dims + 1), anchor.dtype)
        left[0, :-1] = ends.min(axis=0)[::-1].cumsum()[::-1]
        left[1, :-1] = ends.max(axis=0)[::-1].cumsum()[::-1]
        at = np.flatnonzero(alive)
        part = np.zeros(len(at), anchor.dtype)
        for first in range(0, self.dims, STEP):
            if not len(at):
                break
            read = order[first:first + STEP]
            part += anchor[read] @ columns[np.ix_(read, at)]
            done = min(first + STEP, self.dims)
            keep = needed(part + left[0, done], part + left[1, done])
            at, part = at[keep], part[keep]
        return at, part.astype(np.int64)

    def best(self, at: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
        """Which of the rows are the best k: higher scores first, then the order of ids."""
        return np.lexsort((at, -scores))[:k]

    def positives(self, row: int, label: int, anchor: np.ndarray, k: int):
        alive = (self.labels == label) & (self.rows != row)

        def needed(low, high):
            if len(low) <= k:
                return np.ones(len(low), bool)
            return high >= np.partition(low, len(low) - k)[len(low) - k]

        at, scores = self.scan(anchor, alive, needed)
        chosen = self.best(at, scores, k)
        return at[chosen], scores[chosen]

    def negatives(self, label: int, anchor: np.ndarray, windows: list[tuple[int, int]], k: int):
        """(window's number, positions, scores) of the best k rows in each window."""
        def needed(low, high):
            keep = np.zeros(len(low), bool)
            for least, most in windows:
                within = low[(low >= least) & (high <= most)]
                bar = least
                if len(within) >= k:
                    bar = max(bar, np.partition(within, len(within) - k)[len(within) - k])
                keep |= (high >= bar) & (low <= most)
            return keep

        at, scores = self.scan(anchor, self.labels != label, needed)
        for w, (least, most) in enumerate(windows):
            inside = np.flatnonzero((scores >= least) & (scores <= most))
            chosen = inside[self.best(at[inside], scores[inside], k)]
            yield w, at[chosen], scores[chosen]


def _longs(values) -> np.ndarray:
    return np.array(values, np.int64)


def _matrix(table: pa.Table, scale: int, dims: int) -> np.ndarray:
    return whole(table.column("v"), scale, dims, bound(dims))


def _build(scale: int, dims: int):
    def work(table: pa.Table) -> pa.Table:
        table = table.sort_by([("id", "ascending"), ("row", "ascending")])
        columns = np.ascontiguousarray(_matrix(table, scale, dims).T)
        return pa.table({
            "block": pa.array([table.column("part")[0].as_py()], pa.int32()),
            "rows": pa.array([table.column("row").to_pylist()], pa.list_(pa.int64())),
            "ids": pa.array([table.column("id").to_pylist()], pa.list_(pa.int64())),
            "labels": pa.array([table.column("label").to_pylist()], pa.list_(pa.int64())),
            "columns": pa.array([columns.astype("<i8").tobytes()], pa.binary()),
            "dims": pa.array([dims], pa.int32())})
    return work


def _pack(scale: int, dims: int):
    def work(table: pa.Table) -> pa.Table:
        values = _matrix(table, scale, dims)
        windows = (table.column("windows").to_pylist() if "windows" in table.column_names
                   else [[]] * len(table))
        return pa.table({
            "chunk": pa.array([table.column("part")[0].as_py()], pa.int32()),
            "anchors": pa.array([table.column("row").to_pylist()], pa.list_(pa.int64())),
            "anchor_labels": pa.array([table.column("label").to_pylist()], pa.list_(pa.int64())),
            "vectors": pa.array([values.astype("<i8").tobytes()], pa.binary()),
            "windows": pa.array([windows], pa.list_(pa.list_(pa.int64())))})
    return work


def _met(batches: Iterator[pa.RecordBatch]):
    """(block, anchor's row, label, vector, windows) of all pairs of a block and an anchor."""
    current, block = None, None
    for batch in batches:
        for row in range(len(batch)):
            one = {c: batch.column(batch.schema.get_field_index(c))[row] for c in batch.schema.names}
            if one["block"].as_py() != current:
                current, dims = one["block"].as_py(), one["dims"].as_py()
                rows = _longs(one["rows"].as_py())
                columns = np.frombuffer(one["columns"].as_py(), "<i8").reshape(dims, len(rows))
                block = Block(rows, pa.array(one["ids"].as_py(), pa.int64()),
                              _longs(one["labels"].as_py()), columns)
            anchors, labels = one["anchors"].as_py(), one["anchor_labels"].as_py()
            vectors = np.frombuffer(one["vectors"].as_py(), "<i8").reshape(len(anchors), block.dims)
            windows = one["windows"].as_py()
            yield block, list(zip(anchors, labels, vectors, windows))


def _found(pieces: list[tuple], names: list[str], block: Block) -> pa.RecordBatch:
    """A batch of found rows: pieces of (constants..., positions, scores)."""
    lengths = [len(p[-1]) for p in pieces]
    constants = [pa.array(np.repeat(_longs([p[c] for p in pieces]), lengths))
                 for c in range(len(names) - 2)]
    at = np.concatenate([p[-2] for p in pieces]) if pieces else np.empty(0, np.int64)
    scores = np.concatenate([p[-1] for p in pieces]) if pieces else np.empty(0, np.int64)
    return pa.RecordBatch.from_arrays(
        [*constants, block.ids.take(pa.array(at)), pa.array(scores)], names)


def _scan_positives(k: int):
    def work(batches):
        for block, anchors in _met(batches):
            pieces = [(row, *block.positives(row, label, v, k)) for row, label, v, _ in anchors]
            yield _found(pieces, ["anchor", "id", "score"], block)
    return work


def _scan_negatives(k: int, least: int, most: int):
    def work(batches):
        for block, anchors in _met(batches):
            pieces = []
            for row, label, v, scores in anchors:
                # Least and largest whole scores s with least * p <= 100 * s <= most * p.
                windows = [(-(-least * p // 100), most * p // 100) for p in scores]
                pieces += [(row, w + 1, at, s)
                           for w, at, s in block.negatives(label, v, windows, k)]
            yield _found(pieces, ["anchor", "positive", "id", "score"], block)
    return work


class _Scan:
    """Blocks of all rows, and chunks of anchors sent to them."""

    def __init__(self, rows: DataFrame, scale: int, block_cells: int, chunk_anchors: int):
        self.spark, self.scale, self.chunk_anchors = rows.sparkSession, scale, chunk_anchors
        self.folder = shared_dir(self.spark, "hard-negatives")
        self.rows = self._written(rows, "rows")
        n, dims = self.rows.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
        self.dims = max(dims, 1)
        self.blocks = max(1, -(-n // max(block_cells // self.dims, 1)))
        self.index = self._written(
            self._dealt(self.rows, self.blocks).applyInArrow(_build(scale, self.dims), BLOCK), "blocks")

    def _written(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    @staticmethod
    def _dealt(rows: DataFrame, parts: int):
        part = F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int")
        return rows.withColumn("part", part).repartition(min(parts, 4096), "part").groupBy("part")

    def pairs(self, anchors: DataFrame) -> DataFrame:
        """Each chunk of anchors beside each block."""
        chunks = max(1, -(-anchors.count() // self.chunk_anchors))
        groups = -(-chunks // CELL_CHUNKS)
        packed = self._dealt(anchors, chunks).applyInArrow(_pack(self.scale, self.dims), CHUNK)
        sent = packed.withColumn("group", F.pmod("chunk", F.lit(groups))).withColumn(
            "block", F.explode(F.sequence(F.lit(0), F.lit(self.blocks - 1))))
        blocks = self.index.withColumn(
            "group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
        # A stated count, since these few rows are much work; hashes of few cells need some room.
        tasks = min(4 * self.blocks * groups, 20_000)
        return (blocks.repartition(tasks, "block", "group").hint("merge")
                .join(sent.repartition(tasks, "block", "group"), ["block", "group"]).drop("group"))

    def positives(self, anchors: DataFrame, k: int) -> DataFrame:
        """anchor, positive (1 to k), positive_id, positive_score."""
        found = self.pairs(anchors).mapInArrow(
            _scan_positives(k), "anchor bigint, id bigint, score bigint")
        order = Window.partitionBy("anchor").orderBy(F.desc("score"), F.asc_nulls_last("id"))
        found = (found.withColumn("positive", F.row_number().over(order).cast("bigint"))
                 .filter(F.col("positive") <= k)
                 .select("anchor", "positive", F.col("id").alias("positive_id"),
                         F.col("score").alias("positive_score")))
        return self._written(found, "positives")

    def negatives(self, anchors: DataFrame, positives: DataFrame, k: int, least: int,
                  most: int) -> DataFrame:
        """anchor, positive, rank, negative_id, negative_score."""
        windows = positives.groupBy("anchor").agg(F.transform(
            F.sort_array(F.collect_list(F.struct("positive", "positive_score"))),
            lambda x: x["positive_score"]).alias("windows"))
        asked = anchors.join(windows.withColumnRenamed("anchor", "row"), "row")
        found = self.pairs(asked).mapInArrow(
            _scan_negatives(k, least, most), "anchor bigint, positive bigint, id bigint, score bigint")
        order = Window.partitionBy("anchor", "positive").orderBy(
            F.desc("score"), F.asc_nulls_last("id"))
        return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
                .select("anchor", "positive", "rank", F.col("id").alias("negative_id"),
                        F.col("score").alias("negative_score")))


def hard_negatives(rows: DataFrame, is_anchor: Column, label: Column, n_positives: int = POSITIVES,
                   n_negatives: int = NEGATIVES, *, least: int = LEAST, most: int = MOST,
                   scale: int = SCALE, key: str = "vec_id", vector: str = "embedding",
                   block_cells: int = BLOCK_CELLS, chunk_anchors: int = CHUNK_ANCHORS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    For each row with `is_anchor` and each of its best `n_positives` other rows of the same label: the
    best `n_negatives` rows of other labels whose score lies between `least` and `most` hundredths of
    the positive's.
    """
    taking_part = rows.filter(label.isNotNull() & sound(F.col(vector))).select(
        F.monotonically_increasing_id().alias("row"), F.col(key).cast("bigint").alias("id"),
        label.cast("bigint").alias("label"), F.col(vector).alias("v"),
        F.coalesce(is_anchor & F.col(key).isNotNull(), F.lit(False)).alias("asks"))
    scan = _Scan(taking_part, scale, block_cells, chunk_anchors)
    anchors = scan.rows.filter("asks")
    positives = scan.positives(anchors, n_positives)
    negatives = scan.negatives(anchors, positives, n_negatives, least, most)
    named = positives.join(anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")),
                           "anchor")
    return negatives.join(named, ["anchor", "positive"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
