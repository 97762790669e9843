import hashlib
import math

import numpy as np
import pytest

from skytally.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, label int, cluster int, id string, v string, p double"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "x", "y", 0.5) for i, v in rows], SCHEMA)


def brute(rows, k=16, rounds=3):
    """Every distance of every round, in whole numbers of any size."""
    kept = []
    for i, v in rows:
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [max(-(1 << 27), min(1 << 27, math.floor(64 * float(np.float32(x))))) for x in v]))
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centres = [v for _, v in order[:k]]
    for step in range(rounds + 1):
        near = []
        for _, v in kept:
            near.append(min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres)))
        if step < rounds:
            for n in range(len(centres)):
                own = [v for (_, v), (_, c) in zip(kept, near) if c == n]
                if own:
                    centres[n] = [sum(x) // len(own) for x in zip(*own)]
    total = sum(d for d, _ in near)
    of = {n: sum(d for d, c in near if c == n) for n in range(len(centres))}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, n, d, of[n], total, digest[n]) for (i, _), (d, n) in zip(kept, near)), key=repr)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_equals_brute_force(spark):
    pick = np.random.default_rng(8)
    middles = pick.normal(0, 0.3, (9, 64))
    rows = [(i, (middles[i % 9] + pick.normal(0, 0.05, 64)).tolist()) for i in range(300)]
    rows += [(1000 + i, [0.25] * 64) for i in range(40)]  # copies: ties
    rows += [(7, rows[0][1]), (7, rows[0][1]), (7, rows[1][1]), (None, rows[2][1])]
    rows += [(2000, [1e30] * 64), (2001, [-1e30] * 64), (2002, [-0.001] * 64)]
    assert result(centroids.op11(vectors(spark, rows))) == brute(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    fine = [0.5, -0.5] * 32
    rows = [(1, None), (2, []), (3, fine[:63]), (4, fine + [1.0]), (5, [nan] + fine[1:]), (6, [inf] + fine[1:]), (7, [None] + fine[1:]), (8, fine), (9, fine)]
    got = result(centroids.op11(vectors(spark, rows)))
    assert got == brute(rows) and [r[0] for r in got] == [8, 9] and all(r[1:3] == (0, 0) for r in got)
    empty = centroids.op11(vectors(spark, rows[:7]))
    assert empty.count() == 0 and empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert centroids.op11(vectors(spark, rows).limit(0)).count() == 0


def test_bounds_hold_and_prune():
    pick = np.random.default_rng(2)
    for spread in (1, 40, 1 << 26):
        middles = pick.integers(-spread, spread + 1, (16, 64))
        rows = middles[pick.integers(0, 16, 2000)] + pick.integers(-(spread // 8) - 1, spread // 8 + 2, (2000, 64))
        pivots = centroids.Pivots(rows[: 2 * centroids.PAIRS])
        of_rows = pivots.distances(rows)
        exact = np.stack([centroids.squared(rows, c) for c in middles], 1)
        assert (pivots.bounds(of_rows, pivots.distances(middles)) <= exact).all()
        nearest, best, computed = centroids.assigned(rows, of_rows, middles, pivots)
        assert (nearest == exact.argmin(1)).all() and (best == exact.min(1)).all()
        assert computed <= exact.size
    # well apart, most distances are never computed
    middles = pick.integers(-4000, 4000, (16, 64))
    rows = middles[pick.integers(0, 16, 2000)] + pick.integers(-3, 4, (2000, 64))
    pivots = centroids.Pivots(rows[: 2 * centroids.PAIRS])
    nearest, best, computed = centroids.assigned(rows, pivots.distances(rows), middles, pivots)
    exact = np.stack([centroids.squared(rows, c) for c in middles], 1)
    assert (nearest == exact.argmin(1)).all() and (best == exact.min(1)).all() and computed < 0.5 * exact.size


@pytest.mark.parametrize("n", [1, 2, 5])
def test_equal_pivots(n):
    rows = np.ones((n, 64), np.int64)
    nearest, best, _ = centroids.assigned(rows, centroids.Pivots(rows).distances(rows), rows, centroids.Pivots(rows))
    assert not nearest.any() and not best.any()
