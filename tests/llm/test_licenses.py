import math
from collections import Counter

import pytest

from skytally.llm import licenses
from skytally.llm.store import table

MIT, APACHE = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."


def files(spark, rows):
    return spark.createDataFrame([(i, p, t, "x", 1.0) for i, (p, t) in enumerate(rows)], "id long, path string, text string, license_text string, dot double")


def test_inheritance(spark):
    filler = "\n".join(f"line {i} of ordinary words" for i in range(30))
    tree = [
        ("a/LICENSE", MIT), ("a/x.py", filler), ("a/b/c/deep.py", filler), ("a/b/LICENSE.txt", APACHE), ("a/own.py", f"# {APACHE}\n{filler}"),
        ("d/x.py", filler), ("e/", MIT), ("e/f/page", filler), (None, filler), ("top.py", None), ("a/LICENSEE.py", filler), ("a/LICENSE", MIT),
    ]
    got = {r.id: (r.license, r.origin, r.license_from) for r in licenses.scanned(files(spark, tree)).collect()}
    assert len(got) == len(tree)
    assert got[0][:2] == ("MIT", "own") and got[11] == got[0]
    assert got[1] == ("MIT", "inherited", "a/") and got[10] == ("MIT", "inherited", "a/")
    assert got[2] == ("Apache-2.0", "inherited", "a/b/")
    assert got[4][:2] == ("Apache-2.0", "own")
    assert got[7] == ("MIT", "inherited", "e/")
    assert got[5] == got[8] == got[9] == (None, None, None)


def test_empty_table(spark):
    assert licenses.scanned(files(spark, [("a", "b")]).limit(0)).count() == 0


def test_pages(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    got = licenses.op5(pages).collect()
    assert len(got) == pages.count()
    marked = pages.filter("html RLIKE 'under the MIT License[.]</'").select("page_id").collect()
    found = {r.page_id for r in got if r.license == "MIT"}
    assert {r.page_id for r in marked} <= found


def brute_by_true_frequencies(texts):
    """As above, with the number of lines that have it as the frequency of every term."""
    lines = [line.strip(" ") for t in texts if t for line in t.split("\n") if line.strip(" ")]
    n, df = len(lines), Counter(t for line in lines for t in set(licenses._terms(line)))

    def unit(text):
        w = {t: (1 + math.log(c)) * math.log(1 + n / max(1, df[t])) for t, c in Counter(licenses._terms(text)).items()}
        norm = math.sqrt(sum(x * x for x in w.values())) or 1.0
        return {t: x / norm for t, x in w.items()}

    templates = [(name, unit(x)) for name, ts in licenses.TEMPLATES.items() for x in ts]
    out = {}
    for line in set(lines):
        v = unit(line)
        score, name = min((-sum(v.get(k, 0) * w for k, w in t.items()), name) for name, t in templates)
        if -score >= licenses.COSINE:
            out[line] = (name, -score)
    return out


@pytest.mark.parametrize("hot", [1 << 16, 40])
def test_lines_equal_brute_force_of_true_frequencies(spark, sf_dir, monkeypatch, hot):
    """Frequent words beside a notice take little from its score, rare ones more; some frequencies by a shuffle too."""
    monkeypatch.setattr(licenses, "HOT_TERMS", hot)
    pages = table(spark, sf_dir, "pages").select(licenses.page_text("html").alias("text")).collect()
    filler = "\n".join(f"copyright by and w{i} x{i}" for i in range(3000))
    beside = f"copyright by and {APACHE}"
    texts = [r.text for r in pages] + [filler, MIT, beside, f"wholly unheardof utterly {APACHE}", "version 2.0", None, "", "---"]
    got = {r.line: (r.license, r.score) for r in licenses.matched(files(spark, [("p", t) for t in texts]), "text").collect()}
    expected = brute_by_true_frequencies(texts)
    assert set(got) == set(expected)
    assert got[beside][1] > 0.9 > got[f"wholly unheardof utterly {APACHE}"][1]
    for line, (name, score) in expected.items():
        assert got[line][0] == name and got[line][1] == pytest.approx(score)
