import random

import pytest

from skytally.llm import mixing
from tests.llm.helpers import documents, words


def expected_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    want, got, capped = share * sum(sizes.values()), {}, set()
    while True:
        free = [s for s in names if s not in capped]
        rest = want - sum(cap * sizes[s] for s in capped)
        got = {s: cap * sizes[s] if s in capped else rest * weight[s] / sum(weight[x] for x in free) for s in names}
        over = {s for s in free if got[s] > cap * sizes[s] + 1e-9}
        if not over:
            return got
        capped |= over


def test_targets_and_balance(spark):
    pick = random.Random(3)
    rows = [(i, "w " * pick.choice([0, 1, 5, 30, 200]), "en", pick.choice(["a", "b", "é", "", None, *["hot"] * 6]), 1) for i in range(3000)]
    docs = documents(spark, rows)
    got = mixing.op1(docs).collect()
    assert sorted(r.doc_id for r in got) == list(range(3000))
    by = {}
    for r in got:
        assert r["size"] == len(words(rows[r.doc_id][1])) and r.source == rows[r.doc_id][3]
        assert r.taken in (0, r["size"], 2 * r["size"])
        by.setdefault(r.source, []).append(r)
    sizes = {s: sum(r["size"] for r in rs) for s, rs in by.items()}
    goal = expected_targets(sizes)
    for s, rs in by.items():
        assert {r.source_size for r in rs} == {sizes[s]} and {round(r.target, 6) for r in rs} == {round(goal[s], 6)}
        assert abs(sum(r.taken for r in rs) - goal[s]) <= 5 + 0.001 * goal[s]
        # as many rows as their share of the words, about
        times = sum(1 for r in rs if r["size"] and r.taken) + sum(1 for r in rs if r["size"] and r.taken > r["size"])
        assert abs(times - goal[s] / sizes[s] * sum(1 for r in rs if r["size"])) <= 0.1 * len(rs) + 5
    again = mixing.op1(docs.repartition(13)).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in got)


def test_flight_keeps_totals():
    pick = random.Random(1)
    size = [pick.choice([1, 2, 2, 50, 1000]) for _ in range(400)]
    n = [pick.choice([1, 1, 1, 3]) for _ in size]
    rows = sorted(range(400), key=lambda k: -size[k])
    pi = [0.3] * 400
    assert len(mixing.flight(pi, n, size, rows, random.Random(2))) <= 2
    for weight in (n, [a * b for a, b in zip(n, size)]):
        assert sum(w * p for w, p in zip(weight, pi)) == pytest.approx(sum(w * 0.3 for w in weight))
    for seed in range(20):
        landed = [0.3] * 400
        mixing.land(landed, n, size, rows, random.Random(seed))
        assert set(landed) == {0.0, 1.0}
        assert abs(sum(a * b * p for a, b, p in zip(n, size, landed)) - 0.3 * sum(a * b for a, b in zip(n, size))) < 12


def test_inclusion_is_even():
    counts = [0] * 60
    for seed in range(400):
        pi = [0.25] * 60
        mixing.land(pi, [1] * 60, [1 + i % 7 for i in range(60)], sorted(range(60), key=lambda i: -(i % 7)), random.Random(seed))
        counts = [c + p for c, p in zip(counts, pi)]
    assert 0.25 * 400 * 0.6 < min(counts) and max(counts) < 0.25 * 400 * 1.5


def test_odd_rows_and_empty_table(spark):
    docs = documents(spark)
    got = mixing.op1(docs).collect()
    assert len(got) == docs.count()
    taken = [r.taken for r in got if r.doc_id == 6]
    assert len(taken) == 2 and taken[0] == taken[1]
    assert all(0 <= r.taken <= 2 * r["size"] for r in got)
    kept = mixing.resampled(docs)
    assert kept.columns == docs.columns
    assert kept.count() >= sum(r.taken // max(1, r["size"]) for r in got)
    assert mixing.op1(docs.limit(0)).count() == 0 and mixing.resampled(docs.limit(0)).count() == 0
