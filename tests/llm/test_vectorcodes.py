import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from jobloom.llm import vectorcodes
from jobloom.llm.vectors import bound

SCHEMA = "vec_id bigint, embedding array<float>, label int, code string, error string"


def plain(rows, entries=256, rounds=4, parts=4, scale=1024):
    """Codes by comparing all parts with all entries in whole numbers."""
    kept = [(i, v, label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, [np.float32(x) for x in r[1]]))
    width = max(1, -(-max((len(v) for _, v, _ in kept), default=0) // parts))
    most = bound(width * parts, True)
    whole = [[max(-most, min(most, math.floor(scale * float(np.float32(x))))) for x in v]
             + [0] * (width * parts - len(v)) for _, v, _ in kept]
    pieces = [[v[p * width:(p + 1) * width] for v in whole] for p in range(parts)]
    books = [piece[:entries] for piece in pieces]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), n) for n, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            users = defaultdict(list)
            for x in pieces[p]:
                users[nearest(x, books[p])[1]].append(x)
            books[p] = [[sum(c) // len(users[n]) for c in zip(*users[n])] if n in users else e
                        for n, e in enumerate(books[p])]
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    out, by_label = [], defaultdict(int)
    for k, (i, _, label) in enumerate(kept):
        found = [nearest(pieces[p][k], books[p]) for p in range(parts)]
        error = sum(d for d, _ in found)
        by_label[label] += error
        out.append((i, label, "".join(f"{n:02x}" for _, n in found), error))
    return Counter((i, code, error, min(by_label[label], (1 << 63) - 1), digest)
                   for i, label, code, error in out)


def found(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(3)
    return Counter((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256)
                   for r in vectorcodes.coded(df, **options).collect())


def sample(n=150, dims=8):
    draw = random.Random(6)
    rows = [(i, [draw.gauss(i % 5, 0.3) for _ in range(dims)], draw.choice([0, 1, None])) for i in range(n)]
    rows += [(500 + i, rows[3][1], 1) for i in range(40)]
    rows += [(7, rows[9][1], 2), (7, rows[9][1], 2), (None, rows[8][1], 0), (600, [], 1), (601, [0.25] * 3, 1)]
    return rows + [(700, None, 1), (701, [None] * dims, 1), (702, [math.nan] * dims, 1), (703, [math.inf], 2)]


@pytest.mark.parametrize("options", [{"entries": 20, "kept": 3}, {"entries": 16, "kept": 15}, {"entries": 1},
                                     {"entries": 2, "rounds": 1}, {}])
def test_against_plain(spark, options):
    rows = sample()
    expected = plain(rows, **{k: v for k, v in options.items() if k != "kept"})
    assert found(spark, rows, **options) == expected


def test_few_rows_and_none(spark):
    rows = [(3, [0.1, 0.2, 0.3, 0.4], None), (1, [1.0, -1.0, 0.0, 5.0], None)]
    got = found(spark, rows)
    assert got == plain(rows) and {(r[1], r[2]) for r in got} == {("00" * 4, 0), ("01" * 4, 0)}
    assert not found(spark, [])


def test_large_components(spark):
    draw = random.Random(2)
    rows = [(i, [draw.choice([1e30, -1e30, 5e4, 0.01]) for _ in range(5)], i % 2) for i in range(30)]
    assert found(spark, rows, entries=4) == plain(rows, entries=4)


@pytest.mark.parametrize("kept", [1, 4, 9, 15])
def test_bounds_never_claim_too_much(kept):
    """After any moves each bound is below the true distance, lists ascend, and entries are right."""
    draw = np.random.default_rng(kept)
    x = draw.integers(-30, 30, (400, 3))
    books = vectorcodes.Codebooks(draw.integers(-30, 30, (1, 16, 3)))
    part = vectorcodes.Part.fresh(x, books.entries[0], kept)
    for step in range(12):
        if step:
            moved = books.entries + draw.integers(-3, 4, books.entries.shape) * (step % 4)
            books = vectorcodes.Codebooks(moved, books)
            kept = max(1, min(15, kept + (step % 3 - 1) * 2))
            part.resize(kept)
            part.follow(books.entries[0], books.moves[0])
        exact = ((x[:, None] - books.entries[0]) ** 2).sum(axis=2)
        assert (part.own == exact.argmin(axis=1)).all()
        away = np.sqrt(exact)
        assert part.near.shape == part.bounds.shape == (400, kept)
        assert (np.diff(part.bounds, axis=1) >= 0).all()
        for r in range(400):
            listed = [(n, b) for n, b in zip(part.near[r], part.bounds[r]) if n >= 0]
            assert part.own[r] not in [n for n, _ in listed]
            assert all(b <= away[r, n] for n, b in listed)
            others = set(range(16)) - {n for n, _ in listed} - {int(part.own[r])}
            assert all(part.outer[r] <= away[r, n] for n in others)


def test_bounds_spare_comparisons():
    draw = np.random.default_rng(5)
    x = draw.integers(-1000, 1000, (2000, 4))
    books = vectorcodes.Codebooks(draw.integers(-1000, 1000, (1, 64, 4)))
    part = vectorcodes.Part.fresh(x, books.entries[0], 8)
    assert part.compared == 2000
    part.compared = 0
    books = vectorcodes.Codebooks(books.entries + 5, books)
    part.follow(books.entries[0], books.moves[0])
    assert part.compared < 100


def test_kept_follows_the_data(spark):
    state = spark.createDataFrame([(50, 0, 100), (0, 0, 100)], "compared bigint, deep bigint, parts bigint")
    assert vectorcodes._next_kept(state, 16, 256) == 32 and vectorcodes._next_kept(state, 16, 20) == 19
    state = spark.createDataFrame([(0, 0, 100)], "compared bigint, deep bigint, parts bigint")
    assert vectorcodes._next_kept(state, 16, 256) == 8 and vectorcodes._next_kept(state, 3, 256) == 3
