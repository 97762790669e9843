import math
import zlib
from collections import Counter

import pytest

from skytally.llm import lm
from skytally.llm.store import table
from tests.llm.helpers import documents, words

END = object()


def held(doc_id):
    return zlib.crc32(str(doc_id).encode() if doc_id is not None else b"") % 10


def brute(rows, weights_of):
    tokens = [(k, [*words(t), END]) for k, t in rows]
    train = [ws for k, ws in tokens if held(k) != 0]
    c = Counter(w for ws in train for w in ws)
    n, v = sum(c.values()), len(c)
    out = {}
    for k, ws in tokens:
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        out[k] = (held(k) == 0, len(ws), sum(c[w] > 0 for w in ws), n, base)
    return out


def test_counts_and_base_scores(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    expected = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], None)
    got = lm.op3(docs).collect()
    assert len(got) == len(expected)
    for r in got:
        held_out, n_tokens, n_known, n, base = expected[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held_out, n_tokens, n_known, n)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score < 0
    unseen = [r for r in got if r.held_out]
    # the mixture foretells unseen texts better than word counts do
    assert sum(r.score for r in unseen) > 0.9 * sum(r.base_score for r in unseen)


def test_probabilities_add_up(spark):
    """A text of one word scores P(word) * P(end | word); over all words that is at most the mass of one step."""
    train = [(i, "a b a b c", "en", "s", 1) for i in range(100, 140)]
    probes = [(k, w, "en", "s", 1) for k, w in zip((x for x in range(10000) if held(x) == 0), ["a", "b", "c", "unknown"])]
    got = {r.doc_id: r for r in lm.op3(documents(spark, train + probes)).collect()}
    scores = {w: 10 ** got[k].score for k, w, *_ in probes}
    assert scores["c"] > scores["b"] > 0  # every training text starts with a and ends with c
    assert sum(scores.values()) < 1
    assert got[probes[3][0]].n_known == 1 and got[probes[0][0]].n_known == 2


def test_odd_rows_and_empty_tables(spark):
    docs = documents(spark)
    got = lm.op3(docs).collect()
    expected = brute([(r.doc_id, r.text) for r in docs.collect()], None)
    assert len(got) == docs.count()
    for r in got:
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == expected[r.doc_id][:4]
        assert math.isfinite(r.score) and r.base_score == pytest.approx(expected[r.doc_id][4])
    assert lm.op3(docs.limit(0)).count() == 0
    only = [(x, "nothing to learn from", "en", "a", 1) for x in range(3000) if held(x) == 0][:3]
    assert all(math.isfinite(r.score) and r.train_tokens == 0 for r in lm.op3(documents(spark, only)).collect())
