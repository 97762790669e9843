import math
import random

import numpy as np
import pytest

from skytally.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, score double, v string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 0.5, "x") for i, v in rows], SCHEMA)


def brute(rows, k=10):
    fine = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in fine:
        if q % 100 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in fine if i != q and len(a) == len(b))[:k]
            out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize(("block", "queries"), [(8192, 256), (64, 2)])
def test_equals_brute_force(spark, monkeypatch, block, queries):
    monkeypatch.setattr(topk, "BLOCK_ROWS", block)
    monkeypatch.setattr(topk, "QUERY_ROWS", queries)
    pick = random.Random(4)
    rows = [(i, [pick.gauss(0, 0.2) for _ in range(16)]) for i in range(900)]
    rows += [(1000 + i, [0.5] * 16) for i in range(150)]  # many ties
    rows += [(2000, [0.0] * 16), (2100, [-1.0] * 16), (2200, [3.0, *[0.0] * 15])]
    got = sorted(tuple(r) for r in topk.op8(vectors(spark, rows)).collect())
    assert got == brute(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (100, None), (200, []), (300, [1.0, None]), (400, [nan, 1.0]), (500, [inf, 1.0]), (1, [0.5, -0.5]), (2, [0.5, -0.5]), (None, [1.0, 1.0]),
            (600, [-0.0001, 0.0]), (700, [1.0, 2.0, 3.0])]
    got = sorted(tuple(r) for r in topk.op8(vectors(spark, rows)).collect())
    assert got == brute(rows) and {r[0] for r in got} == {0, 600}
    assert topk.op8(vectors(spark, rows).limit(0)).count() == 0
    assert topk.op8(vectors(spark, [(100, [1.0])])).count() == 0


def test_repeated_ids(spark):
    rows = [(100, [1.0, 0.0]), (100, [1.0, 0.0]), (1, [0.5, 0.0]), (1, [0.5, 0.0])]
    got = sorted((r.query_id, r.vec_id) for r in topk.op8(vectors(spark, rows)).collect())
    assert got == [(100, 1)] * 4
    # equal and different vectors of one id, each a query with ten ranks of its own
    rows = [(i, [i / 10, (20 - i) / 10]) for i in range(1, 21)] + [(100, [1.0, 0.0])] * 2 + [(100, [0.0, 1.0]), (100, [0.5, 0.5])]
    got = sorted(tuple(r) for r in topk.op8(vectors(spark, rows)).collect())
    assert got == brute(rows) and len(got) == 40
