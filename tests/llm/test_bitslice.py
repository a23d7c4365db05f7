import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobloom.llm import bitslice

SCHEMA = "vec_id bigint, embedding array<float>, score string"


def plain(rows, k, every):
    sound = {}
    for i, v, *_ in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole = [math.floor(1024 * float(np.float32(x))) for x in v]
        sound[i] = min(sound.get(i, whole), whole)
    out = []
    for q in sorted(i for i in sound if i % every == 0):
        scores = sorted((-sum(a * b for a, b in zip(sound[q], v)), i) for i, v in sound.items() if i != q)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return out


def found(spark, rows, k=4, every=5, **options):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA)
    got = bitslice.top_k(df, F.col("vec_id") % every == 0, k, **options)
    return sorted(map(tuple, got.select("query_id", "rank", "vec_id", "score").collect()))


@pytest.mark.parametrize("options", [{}, {"block_rows": 7, "chunk_queries": 3}])
def test_against_plain(spark, options):
    draw = random.Random(3)
    rows = [(i, [draw.gauss(0, 0.4) for _ in range(8)]) for i in range(60)]
    rows += [(100 + i, rows[3][1]) for i in range(20)]
    rows += [(200, None), (205, [None] * 8), (210, [float("nan")] + [0.0] * 7), (215, [float("inf")] * 8),
             (None, [0.1] * 8), (220, []), (225, [0.5, 0.5]), (3, rows[3][1]), (4, [0.0] * 8),
             (230, [-0.0] * 8), (235, [31.5, -1000.25] + [0.001] * 6)]
    assert found(spark, rows, **options) == plain(rows, 4, 5)


def test_few_rows_and_none(spark):
    assert found(spark, [(0, [1.0]), (1, [2.0])]) == [(0, 1, 1, 2 * 1024 * 1024)]
    assert found(spark, [(0, [1.0])]) == []
    df = spark.createDataFrame([], SCHEMA)
    assert bitslice.top_k(df, F.col("vec_id") % 5 == 0).count() == 0


def test_signed_digits():
    for n in range(-300, 300):
        digits = bitslice.signed_digits(n)
        assert sum(d << p for p, d in digits) == n
        assert all(b[0] - a[0] > 1 for a, b in zip(digits, digits[1:]))


def large(x):
    return max(-(1 << 62), min(1 << 62, math.floor(1024 * float(np.float32(x)))))


def test_large_components(spark):
    rows = [(0, [1e30, 1.0]), (1, [1.0, 2.0]), (2, [-1e30, 0.5]), (3, [3e12, -1.0]), (4, [-2.0, 1e9]),
            (5, [0.25, -3e9]), (10, [1e-3, 7.0])]
    most, out = (1 << 63) - 1, []
    for q, v in rows:
        if q % 5 == 0:
            exact = [(sum(large(a) * large(b) for a, b in zip(v, w)), i) for i, w in rows if i != q]
            best = sorted((-max(-most, min(most, x)), i) for x, i in exact)[:4]
            out += [(q, r + 1, i, -x) for r, (x, i) in enumerate(best)]
    assert found(spark, rows) == sorted(out)
    assert found(spark, rows, block_rows=2, chunk_queries=1) == sorted(out)
