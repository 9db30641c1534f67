import math
import random

import numpy as np
from pyspark.sql import functions as F

from deskmatch.llm import topk


def brute(rows, k, scale):
    ready = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
             if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for i, v in ready:
        if i % 5 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in ready if j != i)
            out |= {(i, rank + 1, j, -s) for rank, (s, j) in enumerate(scores[:k])}
    return out


def test_top_rows_equal_brute_force(spark):
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-1, 1) if i % 3 else rng.choice([-0.5, 0.25]) for _ in range(7)]) for i in range(130)]
    rows += [(200, None), (205, [float("nan")] * 7), (210, [1.0, None, 1.0, 0.0, 0.0, 0.0, 0.0]), (None, [1.0] * 7), (215, [math.inf] * 7),
             (220, []), (221, [1.0, 2.0])]
    table = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, rank string, block int")
    for block in (40, 1000):
        found = topk.top_k(table, F.col("vec_id") % 5 == 0, k=4, scale=16, block_rows=block, query_rows=8).collect()
        assert {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found} == brute(rows, 4, 16)


def test_few_and_no_rows(spark):
    kind = "vec_id long, embedding array<float>"
    two = spark.createDataFrame([(0, [1.0]), (1, [2.0])], kind)
    assert [tuple(r) for r in topk.top_k(two, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 256 * 512)]
    assert topk.top_k(spark.createDataFrame([], kind), F.col("vec_id") == 0).count() == 0


def test_slices_hold_every_value():
    values = np.array([[-(1 << 62), 5], [1 << 62, 5], [3, -9]], "i8")
    lows, places, maps = topk.sliced(values)
    for query in ([3, -7], [0, 1], [-1, 0]):
        levels, constant = topk.score_maps(query, lows, places, maps, ~maps)
        for row in range(3):
            bits = sum(((int(m[0]) >> row) & 1) << i for i, m in enumerate(levels) if m is not None)
            assert bits + constant == sum(q * int(v) for q, v in zip(query, values[row]))


def test_signed_digits():
    for n in range(300):
        assert sum(d << p for p, d in topk.digits(n)) == n
    assert sum(d << p for p, d in topk.digits(-37)) == -37
