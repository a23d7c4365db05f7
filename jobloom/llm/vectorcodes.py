"""Vector codes: each part of a vector becomes the number of the nearest entry of a codebook, which is
fitted on all rows with adaptive distance bounds.

A part keeps, from round to round, its entry, its b next closest entries with lower bounds of their
distances in ascending order, and one outer bound below the distances of all others. When the entries
have moved, the own distance is computed anew, each lower bound falls by its entry's move and the outer
bound by the largest move. Then

- an own distance below all bounds leaves the entry as it is;
- else, if it is below the outer bound, only the kept entries whose bounds it reaches can be nearer:
  their distances are computed exactly, in whole numbers, ties to the lower index;
- else all entries are compared, and the part gets a new list.

Bounds are rounded so that they never claim too much, and an equal distance counts as unsure. b follows
the data: it doubles if more than an eighth of the parts were compared with all entries, and halves if
the later half of the lists was hardly reached.

State lies in the shared folder, one row per Arrow batch of vectors, written anew by each round; rows
are never shuffled. A round's sums (per part and entry, added up in tasks first) and the codebooks are
the only things that pass the driver: `entries` times the dimensions, whatever the number of rows.

Defined cases: vectors that are null or hold a null, NaN or infinite component are dropped; a null id is
kept, the last to found an entry; rows that share an id are rows of their own, in the order of their
vectors; fewer rows than entries give fewer entries; entries that no part uses stay. Shorter vectors and
lengths that the number of parts does not divide are filled with 0. Components beyond the largest that
keeps squared distances within 64 bits count as that; sums of errors end at the largest long. An empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from jobloom.llm.vectors import bound, exact_floats, sound, whole
from jobloom.session import shared_dir

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
# The list of closest entries that a part starts with, and its limits.
KEPT, LEAST_KEPT = 16, 4
LARGEST_LONG = (1 << 63) - 1
# Fills a list that holds fewer entries; its bound is the outer one.
NONE = -1

STATE = ("ids array<bigint>, labels array<bigint>, vectors binary, own binary, near binary, "
         "bounds binary, outer binary, kept int, compared bigint, deep bigint, parts bigint")


class Codebooks:
    """Entries of all parts: whole numbers, parts x entries x width."""

    def __init__(self, entries: np.ndarray, before: "Codebooks | None" = None):
        self.entries = entries
        if before is not None:
            moved = np.sqrt(((entries - before.entries).astype(np.float64) ** 2).sum(axis=2))
            self.moves = moved * (1 + 1e-9)

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of x to all of y."""
    largest = max(int(np.abs(x).max(initial=0)), int(np.abs(y).max(initial=0)))
    # |x|^2 - 2xy + |y|^2 has terms four times a square.
    if exact_floats(2 * largest, 2 * largest, dims=x.shape[1]):
        x, y = x.astype(np.float64), y.astype(np.float64)
        return ((x * x).sum(axis=1)[:, None] - 2 * (x @ y.T) + (y * y).sum(axis=1)).astype(np.int64)
    return np.stack([((x - e) ** 2).sum(axis=1) for e in y], axis=1)


def _below(distances: np.ndarray) -> np.ndarray:
    """Lower bounds as stored: single precision, rounded down."""
    return np.maximum(np.nextafter((distances * (1 - 1e-9)).astype(np.float32), np.float32(-np.inf)), 0)


class Part:
    """The parts of a block at one position, with their bounds.

    own (n), near (n x b) and bounds (n x b, ascending), outer (n).
    """

    def __init__(self, x, own, near, bounds, outer):
        self.x, self.own, self.near, self.bounds, self.outer = x, own, near, bounds, outer
        self.compared = self.deep = 0

    @classmethod
    def fresh(cls, x: np.ndarray, entries: np.ndarray, b: int) -> "Part":
        n = len(x)
        part = cls(x, np.zeros(n, np.int16), np.zeros((n, b), np.int16), np.zeros((n, b), np.float32),
                   np.zeros(n, np.float32))
        part._compare_all(np.arange(n), entries)
        return part

    def _compare_all(self, rows: np.ndarray, entries: np.ndarray) -> None:
        """Nearest entry and a new list for some rows."""
        b = self.near.shape[1]
        self.compared += len(rows)
        for low in range(0, len(rows), 1024):
            some = rows[low:low + 1024]
            square = squares(self.x[some], entries)
            own = square.argmin(axis=1)
            self.own[some] = own
            away = np.sqrt(square.astype(np.float64))
            away[np.arange(len(some)), own] = np.inf
            kept = min(b, len(entries) - 1)
            if kept < len(entries) - 1:
                order = np.argpartition(away, kept, axis=1)[:, :kept + 1]
            else:
                order = np.argsort(away, axis=1)
            far = np.take_along_axis(away, order, axis=1)
            inner = np.argsort(far, axis=1, kind="stable")
            order, far = np.take_along_axis(order, inner, axis=1), np.take_along_axis(far, inner, axis=1)
            # The next one after the list bounds all others; without any other there is no bound.
            outer = _below(far[:, kept]) if far.shape[1] > kept else np.full(len(some), np.inf, np.float32)
            self.outer[some] = outer
            self.near[some] = NONE
            self.bounds[some] = outer[:, None]
            self.near[some[:, None], np.arange(kept)] = order[:, :kept]
            self.bounds[some[:, None], np.arange(kept)] = _below(far[:, :kept])

    def resize(self, b: int) -> None:
        n, old = self.near.shape
        if b < old:
            self.outer = np.minimum(self.outer, self.bounds[:, b])
            self.near, self.bounds = self.near[:, :b].copy(), self.bounds[:, :b].copy()
        elif b > old:
            self.near = np.hstack([self.near, np.full((n, b - old), NONE, np.int16)])
            self.bounds = np.hstack([self.bounds, np.repeat(self.outer[:, None], b - old, axis=1)])

    def follow(self, entries: np.ndarray, moves: np.ndarray) -> None:
        """Assign anew after the entries have moved."""
        b = self.near.shape[1]
        own = self.own.astype(np.int64)
        square = ((self.x - entries[own]) ** 2).sum(axis=1)
        upper = np.sqrt(square.astype(np.float64)) * (1 + 1e-9)
        self.outer = _below(self.outer - moves.max(initial=0))
        bounds = np.minimum(_below(self.bounds - moves[self.near]), self.outer[:, None])
        # A bound holds for its own entry; a smaller one behind it keeps the order ascending.
        self.bounds = np.minimum.accumulate(bounds[:, ::-1], axis=1)[:, ::-1]
        reached = (self.bounds <= upper[:, None]).sum(axis=1)
        everything = np.flatnonzero(self.outer <= upper)
        some = np.flatnonzero((reached > 0) & (self.outer > upper))
        self.deep += int((reached[some] > b // 2).sum())
        for deepest in range(1, b + 1):
            rows = some[reached[some] == deepest]
            if len(rows):
                self._verify(rows, deepest, square[rows], entries)
        self._compare_all(everything, entries)

    def _verify(self, rows: np.ndarray, deepest: int, square: np.ndarray, entries: np.ndarray) -> None:
        """Compare with the first `deepest` kept entries in whole numbers."""
        near = self.near[rows, :deepest].astype(np.int64)
        exact = ((self.x[rows][:, None] - entries[near]) ** 2).sum(axis=2)
        names = np.hstack([self.own[rows, None].astype(np.int64), near])
        exact = np.hstack([square[:, None], exact])
        order = np.lexsort((names, exact), axis=1)
        names, exact = (np.take_along_axis(a, order, axis=1) for a in (names, exact))
        self.own[rows] = names[:, 0]
        self.near[rows, :deepest] = names[:, 1:]
        rest = self.bounds[rows, deepest] if deepest < self.bounds.shape[1] else self.outer[rows]
        self.bounds[rows, :deepest] = np.minimum(_below(np.sqrt(exact[:, 1:].astype(np.float64))),
                                                 rest[:, None])


class Block:
    """The vectors of one batch with the state of their parts."""

    def __init__(self, ids: list, labels: list, parts: list[Part]):
        self.ids, self.labels, self.parts = ids, labels, parts

    @classmethod
    def fresh(cls, batch: pa.RecordBatch, books: Codebooks, scale: int, b: int) -> "Block":
        n_parts, _, width = books.entries.shape
        dims = n_parts * width
        x = whole(pa.chunked_array([batch.column(2)]), scale, dims, bound(dims, True))
        parts = [Part.fresh(x[:, p * width:(p + 1) * width], books.entries[p], b) for p in range(n_parts)]
        return cls(batch.column(0).to_pylist(), batch.column(1).to_pylist(), parts)

    @classmethod
    def read(cls, row: dict, books: Codebooks) -> "Block":
        n_parts, _, width = books.entries.shape
        n, b = len(row["ids"]), row["kept"]
        x = np.frombuffer(row["vectors"], "<i4").reshape(n_parts, n, width).astype(np.int64)
        own = np.frombuffer(row["own"], "<i2").reshape(n_parts, n)
        near = np.frombuffer(row["near"], "<i2").reshape(n_parts, n, b)
        bounds = np.frombuffer(row["bounds"], "<f4").reshape(n_parts, n, b)
        outer = np.frombuffer(row["outer"], "<f4").reshape(n_parts, n)
        return cls(row["ids"], row["labels"],
                   [Part(x[p], own[p].copy(), near[p].copy(), bounds[p].copy(), outer[p].copy())
                    for p in range(n_parts)])

    def follow(self, books: Codebooks, b: int) -> None:
        for p, part in enumerate(self.parts):
            part.resize(b)
            part.follow(books.entries[p], books.moves[p])

    def state(self) -> pa.RecordBatch:
        def packed(name: str, kind: str) -> pa.Array:
            return pa.array([np.stack([getattr(p, name) for p in self.parts]).astype(kind).tobytes()],
                            pa.binary())

        return pa.RecordBatch.from_arrays([
            pa.array([self.ids], pa.list_(pa.int64())), pa.array([self.labels], pa.list_(pa.int64())),
            packed("x", "<i4"), packed("own", "<i2"), packed("near", "<i2"), packed("bounds", "<f4"),
            packed("outer", "<f4"), pa.array([self.parts[0].near.shape[1]], pa.int32()),
            pa.array([sum(p.compared for p in self.parts)], pa.int64()),
            pa.array([sum(p.deep for p in self.parts)], pa.int64()),
            pa.array([sum(len(p.x) for p in self.parts)], pa.int64())],
            [f.split()[0] for f in STATE.split(", ")])


def _begin(books: Codebooks, scale: int, b: int):
    def work(batches):
        for batch in batches:
            if len(batch):
                yield Block.fresh(batch, books, scale, b).state()
    return work


def _blocks(batches: Iterator[pa.RecordBatch], books: Codebooks) -> Iterator[Block]:
    for batch in batches:
        for row in range(len(batch)):
            yield Block.read(batch.slice(row, 1).to_pylist()[0], books)


def _continue(books: Codebooks, b: int):
    def work(batches):
        for block in _blocks(batches, books):
            block.follow(books, b)
            yield block.state()
    return work


def _add_up(books: Codebooks):
    """A task's sums: (part, entry, count, sums of the components)."""
    shape = books.entries.shape

    def work(batches):
        sums, counts = np.zeros(shape, np.int64), np.zeros(shape[:2], np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                n = len(row["own"]) // 2 // shape[0]
                x = np.frombuffer(row["vectors"], "<i4").reshape(shape[0], n, shape[2])
                own = np.frombuffer(row["own"], "<i2").reshape(shape[0], n)
                for p in range(shape[0]):
                    np.add.at(sums[p], own[p], x[p])
                    counts[p] += np.bincount(own[p], minlength=shape[1])
        part, entry = np.nonzero(counts)
        if len(part):
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), pa.array(entry), pa.array(counts[part, entry]),
                 pa.array(list(sums[part, entry]), pa.list_(pa.int64()))],
                ["part", "entry", "n", "sums"])
    return work


def _finish(books: Codebooks, b: int):
    def work(batches):
        for block in _blocks(batches, books):
            block.follow(books, b)
            own = np.stack([p.own for p in block.parts]).astype(np.int64)
            error = sum(((p.x - books.entries[i, p.own]) ** 2).sum(axis=1)
                        for i, p in enumerate(block.parts))
            codes = ["".join(f"{e:02x}" for e in row) for row in own.T.tolist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(block.ids, pa.int64()), pa.array(block.labels, pa.int64()),
                 pa.array(codes, pa.string()), pa.array(error, pa.int64())],
                ["id", "label", "code", "error"])
    return work


def _updated(state: DataFrame, books: Codebooks) -> Codebooks:
    """Each entry replaced by the rounded-down mean of its parts; unused ones stay."""
    width = books.entries.shape[2]
    added = state.select("own", "vectors").mapInArrow(
        _add_up(books), "part bigint, entry bigint, n bigint, sums array<bigint>")
    # Sums of many rows may pass 64 bits before they are divided.
    sums = F.array(*(F.sum(F.col("sums")[i].cast("decimal(38,0)")) for i in range(width)))
    rows = added.groupBy("part", "entry").agg(F.sum("n").alias("n"), sums.alias("sums")).collect()
    entries = books.entries.copy()
    for r in rows:
        entries[r.part, r.entry] = [int(s) // r.n for s in r.sums]
    return Codebooks(entries, books)


def _founders(kept: DataFrame, parts: int, entries: int, scale: int) -> Codebooks:
    """Codebooks of the vectors with the smallest ids: a bounded number of rows."""
    width = max(1, -(-(kept.agg(F.max(F.size("v"))).first()[0] or 0) // parts))
    rows = kept.orderBy(F.asc_nulls_last("id"), "v").limit(entries).select("v").collect()
    dims = parts * width
    x = whole(pa.array([r.v for r in rows], pa.list_(pa.float64())), scale, dims, bound(dims, True))
    return Codebooks(np.ascontiguousarray(x.reshape(len(rows), parts, width).transpose(1, 0, 2)))


def _next_kept(state: DataFrame, b: int, entries: int) -> int:
    compared, deep, parts = state.agg(*(F.sum(c) for c in ("compared", "deep", "parts"))).first()
    if compared * 8 > parts:
        return max(min(2 * b, entries - 1), 1)
    if (compared + deep) * 64 < parts:
        return max(b // 2, min(LEAST_KEPT, b))
    return b


def compress(rows: DataFrame, *, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
             scale: int = SCALE, key: str = "vec_id", vector: str = "embedding", label: str = "label",
             kept: int = KEPT) -> tuple[DataFrame, Codebooks | None]:
    """(id, label, code, error) rows and the fitted codebooks (None for an empty table).

    At most 256 entries, so that an index has two hexadecimal digits.
    """
    if not 1 <= entries <= 256:
        raise ValueError("entries must be 1 to 256")
    spark = rows.sparkSession
    taken = rows.filter(sound(F.col(vector))).select(
        F.col(key).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"),
        F.col(vector).cast("array<double>").alias("v"))
    result = "id bigint, label bigint, code string, error bigint"
    books = _founders(taken, parts, entries, scale)
    if not books.entries.shape[1]:
        return spark.createDataFrame([], result), None
    folder = shared_dir(spark, "vector-codes")
    b = max(1, min(kept, books.entries.shape[1] - 1))
    for i in range(rounds):
        state = (taken.mapInArrow(_begin(books, scale, b), STATE) if i == 0
                 else state.mapInArrow(_continue(books, b), STATE))
        state.write.parquet(f"{folder}/{i}")
        state = spark.read.schema(STATE).parquet(f"{folder}/{i}")
        b = _next_kept(state, b, books.entries.shape[1]) if i else b
        books = _updated(state, books)
    if not rounds:
        raise ValueError("at least one round")
    return state.mapInArrow(_finish(books, b), result), books


def coded(rows: DataFrame, **options) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of each kept row."""
    spark = rows.sparkSession
    found, books = compress(rows, **options)
    path = f"{shared_dir(spark, 'vector-codes')}/coded"
    found.write.parquet(path)
    found = spark.read.schema(found.schema).parquet(path)
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LARGEST_LONG)).cast("bigint")
    by_label = found.groupBy(F.col("label").alias("_label")).agg(total.alias("label_error"))
    return found.join(by_label, found["label"].eqNullSafe(by_label["_label"])).select(
        F.col("id").alias("vec_id"), "code", "error", "label_error",
        F.lit(books.digest() if books else None).cast("string").alias("codebooks_sha256"))
