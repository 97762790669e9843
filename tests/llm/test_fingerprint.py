import hashlib
import random

import numpy as np
import pytest
import xxhash

from skytally.llm import fingerprint
from tests.llm.helpers import ODD, documents


def hashed(lane, text):
    seed = xxhash.xxh64_intdigest(int(lane).to_bytes(4, "little"), seed=42)
    return xxhash.xxh64_intdigest(text.encode(), seed=seed)


def vector(text):
    lines = [p for p in (text or "").split("\n") if p]
    wide = [sum(hashed(i, p) & fingerprint._MODULUS for p in lines) & fingerprint._MODULUS for i in range(fingerprint.WIDE)]
    signs = []
    for j in range(fingerprint.SIGNS):
        h = [hashed(fingerprint.WIDE + j // 32, p) for p in lines]
        signs.append(sum((x >> (j % 32)) & fingerprint._HALVES for x in h))
    return [*wide, *signs, len(lines)]


def alike(a, b):
    if a == b:
        return 1.0
    s = []
    for v in (a, b):
        x = [c for p in v[fingerprint.WIDE : -1] for c in (p >> 32, p & fingerprint._LOW)]
        s.append(np.array([2 * c - v[-1] for c in x], float))
    norm = np.sqrt((s[0] @ s[0]) * (s[1] @ s[1]))
    return float(np.clip(s[0] @ s[1] / norm, 0, 1)) if norm else 0.0


def printed(v):
    return ".".join(f"{x:x}" for x in v)


@pytest.mark.parametrize("parts", [1, 7])
def test_equals_brute_force(spark, parts):
    pick = random.Random(2)
    line = lambda: "".join(pick.choices("abc é😀", k=pick.randrange(12)))
    rows = [(i * 3, "\n".join(line() for _ in range(pick.randrange(8))), "en", "a", 1) for i in range(120)] + [(r[0] if r[0] is None else r[0] + 1000, *r[1:]) for r in ODD if r[0] != 9]
    docs = documents(spark, rows)
    got = fingerprint.op10(docs.repartition(parts)).collect()
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    texts = [r[1] or "" for r in order]
    expected = {}
    for i, r in enumerate(order):
        own, following = texts[i], texts[(i + 1) % len(order)]
        half = len(own) // 2
        edited = own[: len(own) - half] + following[:half]
        a, b, c = vector(own), vector(edited), vector(following)
        expected.setdefault(r[0], []).append((len(own), hashlib.sha256(edited.encode()).hexdigest(), printed(a), printed(b), alike(a, b), alike(a, c)))
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id != 1006:  # two equal rows with one key
            (e,) = expected[r.doc_id]
            assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == e[:4]
            assert r.near_edited == pytest.approx(e[4]) and r.near_next == pytest.approx(e[5])


def test_order_does_not_matter_and_paragraphs_come_and_go(spark):
    rows = [(1, "a\nb\nc"), (2, "c\n\nb\na"), (3, "a\nb"), (4, "c"), (5, "a\nb\nc\nc")]
    df = fingerprint.with_vector(spark.createDataFrame(rows, "doc_id long, text string"), "text", "f")
    f = {r.doc_id: r.f for r in df.collect()}
    assert f[1] == f[2]
    assert [(x + y) & fingerprint._MODULUS for x, y in zip(f[3], f[4])] == f[1]
    assert f[5] != f[1] and [(x - y) & fingerprint._MODULUS for x, y in zip(f[5], f[4])] == f[1]


def test_likeness_follows_shared_paragraphs(spark):
    lines = [f"paragraph number {i}" for i in range(400)]
    rows = [(i, "\n".join(lines[i : i + 40])) for i in (0, 10, 30, 300)]
    df = fingerprint.with_vector(spark.createDataFrame(rows, "doc_id long, text string"), "text", "f")
    f = {r.doc_id: r.f for r in df.collect()}
    assert 0.55 < alike(f[0], f[10]) < 0.95 and alike(f[0], f[30]) < 0.55 and alike(f[0], f[300]) < 0.3


def test_single_document_and_empty_table(spark):
    one = documents(spark, [(1, "ab\ncd", "en", "a", 5)])
    r = fingerprint.op10(one).first()
    assert r.edited_sha256 == hashlib.sha256(b"ab\nab").hexdigest() and r.near_next == 1.0
    assert fingerprint.op10(one.limit(0)).count() == 0
