import hashlib
import random
import time
import zlib

import numpy as np
import pytest

from skytally.llm import runs
from skytally.llm.store import table
from tests.llm.helpers import ODD, documents


def brute(w):
    """Runs by comparing every word with the one q further on, for every q."""
    numbers = {x: i for i, x in enumerate(w)}
    w, out = np.array([numbers[x] for x in w], int), []
    for q in range(1, len(w) // 4 + 1):
        edges = np.flatnonzero(np.diff(w[q:] == w[:-q], prepend=False, append=False))
        for i, j in edges.reshape(-1, 2).tolist():
            length = j - i + q
            if length >= max(6, 4 * q):
                part = w[i : i + length]
                if not any((part[p:] == part[:-p]).all() for p in range(1, q)):
                    out.append((i, length, q))
    return sorted(out)


def expected(doc_id, text):
    """The query's row, by loops."""
    w = (text or "").encode().split()
    n, h = len(w), zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute(w)
    kept = [x for i, x in enumerate(w) if not any(s + q <= i < s + length for s, length, q in found)]
    best = min(((-length, s, q) for s, length, q in found), default=None)
    digest = hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in found).encode()).hexdigest()
    one = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *one, digest, hashlib.sha256(b" ".join(kept)).hexdigest())


def test_random_words_equal_brute_force():
    pick, total = random.Random(5), 0
    for _ in range(800):
        texts = []
        for _ in range(pick.randint(1, 4)):
            n, letters = pick.choice([0, 1, 5, 6, 7, 12, 40, 90]), "abcd"[: pick.randint(1, 4)]
            w = [pick.choice(letters) for _ in range(n)]
            if pick.random() < 0.6 and n > 8:
                a = pick.randrange(n)
                p = 1 + (n - a) // pick.randint(3, 10)
                w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            texts.append(w)
        found, _ = runs._batch([" ".join(w).encode() for w in texts])
        assert found == [brute(w) for w in texts]
        total += sum(map(len, found))
    assert total > 500


def test_range_successors():
    pick = np.random.default_rng(3)
    for n in (1, 2, 63, 64, 65, 300):
        values = pick.permutation(n)
        tree = runs.Successors(values)
        low = pick.integers(0, n, 50)
        high = low + 1 + pick.integers(0, n, 50) % (n - low)
        x = pick.integers(0, n, 50)
        assert tree.smaller(low, high, x).tolist() == [int((values[a:b] < y).sum()) for a, b, y in zip(low, high, x)]
        nth = pick.integers(0, n, 50) % (high - low)
        assert tree.smallest(low, high, nth).tolist() == [int(sorted(values[a:b])[c]) for a, b, c in zip(low, high, nth)]


def test_query_equals_brute_force(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    got = sorted(tuple(r) for r in runs.op13(docs).collect())
    assert got == sorted(expected(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    assert sum(r[1] > 0 for r in got) >= 10


def test_odd_rows(spark):
    # ids whose remainder is 0 have their words repeated
    some = [i for i in range(10000) if zlib.crc32(str(i).encode()) % 10 == 0]
    extra = [(i, t, "en", "a", 0) for i, t in zip(some, ["", None, "one", "a b", "a b c d e f g h i j k l", "x " * 50, "ü 😀 \x0b z z " * 30])]
    rows = [*ODD, *extra, *[(i, " ".join(f"w{j}" for j in range(60)), "en", "a", 0) for i in some[20:60]]]
    got = sorted((tuple(r) for r in runs.op13(documents(spark, rows)).collect()), key=repr)
    assert got == sorted((expected(r[0], r[1]) for r in rows), key=repr)
    assert runs.op13(documents(spark, rows).limit(0)).count() == 0


def test_columns_stay(spark):
    docs = documents(spark)
    out = runs.with_runs(docs, runs="found", collapsed="short")
    assert out.columns == [*docs.columns, "found", "short"]
    row = out.filter("doc_id = 9").first()
    assert [tuple(r) for r in row.found] == [(0, 3000, 1)] and row.short == "long end" and row.text.endswith("long end")
    assert out.filter("text IS NULL").first().short == "" and out.count() == docs.count()
    with pytest.raises(ValueError):
        runs.with_runs(docs, runs="Size")


def test_long_texts_take_time_in_proportion():
    took = []
    for n in (100_000, 400_000):
        text = b"a b c a b d " * (n // 12) + b" ".join(b"%d" % i for i in range(n // 2)) + b" x" * (n // 2)
        start = time.process_time()
        found, _ = runs._batch([text])
        took.append(time.process_time() - start)
        assert found[0][0] == (0, n // 12 * 6, 6) and len(found[0]) == 2
    assert took[1] < 10 * took[0]
