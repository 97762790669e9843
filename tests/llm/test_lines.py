import random
import re
from collections import Counter

import pytest

from skytally.llm import lines
from tests.llm.helpers import ODD, documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    """The query's rows by loops; ``rows`` are (doc_id, text, host)."""
    texts = [(i, t or "", s) for i, t, s in rows]
    norm = lambda x: " ".join(WORD.findall(x)).lower()
    docs = {(s, t) for _, t, s in texts}
    of = Counter(s for s, _ in docs)
    held = Counter((s, x) for s, t in docs for x in {norm(x) for x in t.split("\n")} if x)
    bad = {k for k, n in held.items() if n > lines.LINE_DOCS and n > lines.LINE_SHARE * of[k[0]]}
    out = []
    for i, t, s in texts:
        w = WORD.findall(t)
        windows = [tuple(w[j : j + 8]) for j in range(len(w) - 7)]
        often = Counter(windows)
        repeated = len({j + d for j, x in enumerate(windows) if often[x] > 1 for d in range(8)})
        filled = [x for x in t.split("\n") if WORD.search(x)]
        removed = sum(len(WORD.findall(x)) for x in filled if (s, norm(x)) in bad)
        base = len(w) < 20 or 100 * repeated > 30 * len(w)
        left = len(w) - removed
        poor = removed > 0 and (left < 20 or left < 0.5 * len(w))
        out.append((i, len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(filled) - len(set(filled)), repeated, base, not base and not poor, removed))
    return sorted(out, key=repr)


def corpus():
    pick = random.Random(1)
    text = lambda n: "\n".join(" ".join(pick.choice("abcdefghij") + str(pick.randrange(99)) for _ in range(12)) for _ in range(n))
    rows = []
    for i in range(60):
        host = ["h", "h", None, "", "g"][i % 5]
        menu = "Home | About us |  Contact\tand more of it, to be read by no one at all\n" if i % 4 else ""
        rows.append((i, menu + text(pick.choice([1, 2, 3, 9])) + "\nall RIGHTS reserved\n" + ("<x> * " if i % 7 == 0 else ""), host))
    rows += [(100 + i, "one text that is stored very often, twenty words and more in a single line for all of its copies to hold here", "h") for i in range(50)]
    rows += [(200, text(2) + "\n" + "a b c d e f g h " * 9, "g"), (201, "x y " * 40, "g"), (202, "\n".join(["same line of words"] * 9), "g"), (202, "", None)]
    return rows


def test_equals_brute_force(spark):
    rows = corpus() + [(r[0], r[1], r[3]) for r in ODD]
    docs = spark.createDataFrame([(i, t, "en", s, 1, 2, "n") for i, t, s in rows], "doc_id long, text string, lang string, source string, lines int, words int, host string")
    got = sorted((tuple(r) for r in lines.op12(docs).collect()), key=repr)
    assert got == brute(rows)
    assert any(r[8] and not r[7] and not r[6] for r in got) and any(r[8] and r[7] for r in got)
    assert all(r[7] for r in got if r[0] is not None and 100 <= r[0] < 150)  # copies are one document


def test_boilerplate_goes(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, s, "z") for i, t, s in rows], "doc_id long, text string, source string, removed string")
    out = {r.doc_id: r for r in lines.without_boilerplate(docs).collect()}
    verdict = {r[0]: r for r in brute(rows)}
    assert set(out) == {i for i, r in verdict.items() if r[7]} and lines.without_boilerplate(docs).columns == docs.columns
    texts = {i: t for i, t, _ in rows}
    for i, r in out.items():
        assert len(WORD.findall(r.text)) == verdict[i][1] - verdict[i][8]
        if not verdict[i][8]:
            assert r.text == texts[i]


@pytest.mark.parametrize("n", [0, 1])
def test_few_rows(spark, n):
    docs = documents(spark, ODD[:1]).limit(n)
    assert [tuple(r) for r in lines.op12(docs).collect()] == [(1, 0, 0, 0, 0, 0, True, False, 0)][:n]
    assert lines.without_boilerplate(docs).count() == 0
