"""Exact top-k search by inner product on a bit-sliced index.

A component x is quantised to floor(scale * x). The index is dealt into blocks of rows by a hash
of the id. A block keeps, for each dimension, one bitmap per bit of the (offset) value. A query's
scores in a block are a bit-sliced sum: for each non-zero signed digit of a query component the
value's bitmaps, complemented if the digit is negative, are added at the digit's place with carry-save
adders on whole bitmaps. The top rows are then selected from the most significant slice downward;
rows that tie at the boundary are resolved exactly, by their scores' last bit and then the id.
The blocks' best rows are merged per query.

Queries are packed into chunks of bounded size and sent to every block, since each query must see
each row; neither side is ever whole in one place.

Defined cases: vectors that are null or hold a null, NaN or infinite component, and rows without
id, take no part. Of rows with the same id one counts, that with the smallest vector. Missing
components of shorter vectors count as 0, so an empty vector scores 0. Components beyond 2**62
after scaling count as 2**62, scores beyond 2**63 - 1 are given as that number (either way with
their sign) and tie by id across blocks. Fewer than k other rows:
all are returned. Empty tables give an empty result. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from jobloom.session import shared_dir

SCALE = 1024
BLOCK_ROWS = 4096
CHUNK_QUERIES = 64
# Values beyond count as this one, so that a block's bitmaps are 64 per dimension at most.
LARGEST = 1 << 62
MOST_SCORE = (1 << 63) - 1

INDEX = "block int, ids binary, slices binary, bits int, dims int"
CHUNK = "chunk int, ids binary, vectors binary, dims int"


def quantised(df: DataFrame, scale: int = SCALE, *, key: str = "vec_id",
              vector: str = "embedding") -> DataFrame:
    """(id, v) of the rows that take part, one row per id."""
    v = F.col(vector)
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("bigint"))
    return (df.filter(F.col(key).isNotNull() & v.isNotNull() & sound)
            .select(F.col(key).cast("bigint").alias("id"), whole.alias("v"))
            .groupBy("id").agg(F.min("v").alias("v")))


def _matrix(vectors: pa.ChunkedArray) -> np.ndarray:
    """Rows of a list column, shorter ones filled with 0."""
    flat = vectors.combine_chunks()
    lengths = np.diff(flat.offsets.to_numpy())
    out = np.zeros((len(flat), int(lengths.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = np.clip(
        flat.flatten().to_numpy(), -LARGEST, LARGEST)
    return out


def _build(table: pa.Table) -> pa.Table:
    """The index row of one block."""
    table = table.sort_by("id")
    values = _matrix(table.column("v"))
    bits = int(np.abs(values).max(initial=0)).bit_length() + 1
    rows, dims = values.shape
    offset = values.astype(np.uint64) + np.uint64(1 << (bits - 1))
    words = -(-rows // 64)
    planes = np.zeros((dims, bits, words * 64), np.uint8)
    for b in range(bits):
        planes[:, b, :rows] = ((offset >> np.uint64(b)) & np.uint64(1)).T
    slices = np.packbits(planes, axis=-1, bitorder="little")
    return pa.table({
        "block": pa.array([table.column("block")[0].as_py()], pa.int32()),
        "ids": [table.column("id").to_numpy().astype("<i8").tobytes()],
        "slices": [slices.tobytes()], "bits": pa.array([bits], pa.int32()),
        "dims": pa.array([dims], pa.int32())})


def build_index(rows: DataFrame, n_blocks: int) -> DataFrame:
    """One row per block of (id, v) rows."""
    block = F.pmod(F.xxhash64("id"), F.lit(n_blocks)).cast("int")
    return rows.withColumn("block", block).groupBy("block").applyInArrow(_build, INDEX)


def _pack(table: pa.Table) -> pa.Table:
    values = _matrix(table.column("v"))
    return pa.table({
        "chunk": pa.array([table.column("chunk")[0].as_py()], pa.int32()),
        "ids": [table.column("id").to_numpy().astype("<i8").tobytes()],
        "vectors": [values.astype("<i8").tobytes()], "dims": pa.array([values.shape[1]], pa.int32())})


def signed_digits(value: int) -> list[tuple[int, int]]:
    """(place, 1 or -1) of a number's non-adjacent form."""
    out, place = [], 0
    while value:
        if value & 1:
            digit = 2 - (value & 3)
            out.append((place, digit))
            value -= digit
        value >>= 1
        place += 1
    return out


class Block:
    """One block of the index in memory."""

    def __init__(self, ids: bytes, slices: bytes, bits: int, dims: int):
        self.ids = np.frombuffer(ids, "<i8")
        self.bits, self.dims, self.rows = bits, dims, len(self.ids)
        self.words = -(-self.rows // 64)
        flat = np.frombuffer(slices, "<u8").reshape(dims * bits, self.words)
        # Bitmaps of all values, then their complements.
        self.maps = np.concatenate([flat, ~flat])
        everyone = np.zeros(self.words * 64, np.uint8)
        everyone[:self.rows] = 1
        self.all = np.packbits(everyone, bitorder="little").view("<u8")

    def sums(self, query: np.ndarray) -> tuple[np.ndarray, int]:
        """Slices of each row's score plus a constant, from the lowest; the constant."""
        columns: list[list[int]] = []
        shift = 0
        for d, q in enumerate(query[:self.dims].tolist()):
            shift += q << (self.bits - 1)
            for place, digit in signed_digits(q):
                base = d * self.bits
                if digit < 0:
                    base += self.dims * self.bits
                    shift += ((1 << self.bits) - 1) << place
                while len(columns) < place + self.bits:
                    columns.append([])
                for b in range(self.bits):
                    columns[place + b].append(base + b)
        slices, carries, c = [], [], 0
        while c < len(columns) or carries:
            rows = self.maps[columns[c]] if c < len(columns) and columns[c] else np.empty(
                (0, self.words), np.uint64)
            rows = np.concatenate([rows, *carries])
            carries = []
            while len(rows) > 2:
                n = len(rows) // 3
                x, y, z = rows[:n], rows[n:2 * n], rows[2 * n:3 * n]
                half = x ^ y
                carries.append((x & y) | (half & z))
                rows = np.concatenate([half ^ z, rows[3 * n:]])
            if len(rows) == 2:
                carries.append(rows[:1] & rows[1:])
                rows = rows[:1] ^ rows[1:]
            slices.append(rows[0] if len(rows) else np.zeros(self.words, np.uint64))
            c += 1
        return np.array(slices).reshape(len(slices), self.words), shift

    def top(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows other than the query's own."""
        slices, shift = self.sums(query)
        open_, sure = self.all.copy(), np.zeros(self.words, np.uint64)
        at = int(np.searchsorted(self.ids, own))
        if at < self.rows and self.ids[at] == own:
            open_[at >> 6] &= ~(np.uint64(1) << np.uint64(at & 63))
        for s in slices[::-1]:
            reached = sure | (open_ & s)
            n = int(np.bitwise_count(reached).sum())
            if n > k:
                open_ &= s
            else:
                sure = reached
                open_ &= ~s
                if n == k:
                    open_[:] = 0
                    break
        sure, tied = self._positions(sure), self._positions(open_)
        # Rows stand in the order of their ids, so the first of the tied have the smallest.
        chosen = np.concatenate([sure, tied[:k - len(sure)]])
        # Numbers of any size where 64 bits might not hold them.
        kind = np.int64 if len(slices) < 62 and abs(shift) < 1 << 62 else object
        scores = np.zeros(len(chosen), kind)
        for place, s in enumerate(slices):
            bit = (s[chosen >> 6] >> (chosen & 63).astype(np.uint64)) & np.uint64(1)
            scores += bit.astype(np.int64).astype(kind) << place
        scores -= shift
        if kind is object:
            scores = np.array([max(-MOST_SCORE, min(MOST_SCORE, x)) for x in scores], np.int64)
        return self.ids[chosen], scores

    @staticmethod
    def _positions(bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def _search(k: int):
    def work(batches):
        block, current = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["block"] != current:
                    block = Block(row["ids"], row["slices"], row["bits"], row["dims"])
                    current = row["block"]
                ids = np.frombuffer(row["query_ids"], "<i8")
                vectors = np.frombuffer(row["vectors"], "<i8").reshape(len(ids), row["query_dims"])
                found = [block.top(int(i), v, k) for i, v in zip(ids, vectors)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(ids, [len(f[0]) for f in found])),
                     pa.array(np.concatenate([f[0] for f in found])),
                     pa.array(np.concatenate([f[1] for f in found]))],
                    ["query_id", "vec_id", "score"])
    return work


def top_k(rows: DataFrame, is_query: Column, k: int = 10, *, scale: int = SCALE,
          key: str = "vec_id", vector: str = "embedding", block_rows: int = BLOCK_ROWS,
          chunk_queries: int = CHUNK_QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score of the k best rows for each row of `rows` with `is_query`."""
    spark = rows.sparkSession
    sound = quantised(rows, scale, key=key, vector=vector)
    index = shared_dir(spark, "bit-slices")
    n_blocks = max(1, -(-rows.count() // block_rows))
    build_index(sound, n_blocks).write.parquet(index)
    asked = quantised(rows.filter(is_query), scale, key=key, vector=vector)
    n_chunks = max(1, -(-rows.filter(is_query).count() // chunk_queries))
    chunk = F.pmod(F.xxhash64("id", F.lit("chunk")), F.lit(n_chunks)).cast("int")
    chunks = asked.withColumn("chunk", chunk).groupBy("chunk").applyInArrow(_pack, CHUNK)
    blocks = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block")
    sent = chunks.select(blocks, F.col("ids").alias("query_ids"), "vectors",
                         F.col("dims").alias("query_dims"))
    # Spark does not see that explode makes many rows of few, and must not broadcast them.
    met = spark.read.schema(INDEX).parquet(index).join(sent.hint("merge"), "block")
    best = met.mapInArrow(_search(k), "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
