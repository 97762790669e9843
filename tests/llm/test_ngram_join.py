import random

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from skytally.llm import ngram_join
from skytally.llm.components import components
from skytally.llm.store import table
from tests.llm.helpers import documents, shingles


def brute(rows, percent=85):
    """Least key reachable by links, by row; rows without words alone."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        known = [x for x in (least.get(find(i)), k) if x is not None]
        least[find(i)] = min(known, default=None)
    return [(k, len(sets[i]), least[find(i)] if sets[i] else k) for i, (k, _) in enumerate(rows)]


def check(spark, rows):
    docs = documents(spark, [(k, t, "en", "a", 1) for k, t in rows])
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.op6(docs).collect()), key=repr)
    assert got == sorted(brute(rows), key=repr)
    return docs


def test_odd_rows(spark):
    docs = check(spark, [(r.doc_id, r.text) for r in documents(spark).collect()])
    assert ngram_join.op6(docs.limit(0)).count() == 0


def near_copies(seed, n, length, edits):
    pick = random.Random(seed)
    base = [f"w{pick.randrange(5000)}" for _ in range(length)]
    out = []
    for _ in range(n):
        text = list(base)
        for _ in range(pick.randrange(edits + 1)):
            text[pick.randrange(length)] = f"e{pick.randrange(10**6)}"
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize("group, widespread", [(8, 1 << 16), (2048, 1 << 16), (2048, 5)])
def test_equals_brute_force(spark, monkeypatch, group, widespread):
    """Near copies around the threshold, chains of them, a passage that many share, short texts; split groups too."""
    monkeypatch.setattr(ngram_join, "GROUP", group)
    monkeypatch.setattr(ngram_join, "WIDESPREAD", widespread)
    pick = random.Random(5)
    texts = near_copies(1, 40, 100, 4) + near_copies(2, 25, 300, 12) + near_copies(3, 10, 30, 1)
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [passage + " " + " ".join(f"w{pick.randrange(10**6)}" for _ in range(pick.randrange(5, 80))) for _ in range(60)]
    texts += [" ".join(f"c{j}" for j in range(i, i + 60)) for i in range(0, 40, 2)]  # each like the next, the ends unlike
    texts += ["a b c", "a b c", "A b c", "a b", "b a", "a b c d"]
    rows = [(i, t) for i, t in enumerate(texts)]
    pick.shuffle(rows)
    expected = brute(rows)
    assert len({c for _, _, c in expected}) < len(rows)
    check(spark, rows)


def test_whole_table(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").collect()]
    check(spark, rows)


def test_deduplicated_keeps_one_of_each(spark):
    docs = documents(spark)
    kept = ngram_join.deduplicated(docs)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    ids = [k for k, _ in got]
    assert ids.count(4) == 1 and 5 not in ids and 6 not in ids and ids.count(7) == 1 and 8 not in ids
    assert {1, 2, 3, 9, 10, 11, -5, None} <= set(ids)
    two = documents(spark, [(1, "a b c d e", "en", "a", 1), (1, "quite another text", "en", "a", 1), (1, "a b c d e", "en", "a", 1)])
    assert sorted(r.text for r in ngram_join.deduplicated(two).collect()) == ["a b c d e", "quite another text"]
    assert ngram_join.deduplicated(docs.limit(0)).count() == 0


@pytest.mark.parametrize("least", [64, 1 << 11])
def test_trees_find_every_pair_that_may_be_similar(monkeypatch, least):
    """With narrow bitmaps, sets of several widths."""
    monkeypatch.setattr(ngram_join, "LEAST_BITS", least)
    pick = np.random.default_rng(1)
    size = np.sort(pick.integers(5, 60, 300))
    sets = [np.unique(pick.integers(0, 80, n).astype(np.uint64)) for n in size]
    size = np.array([len(s) for s in sets])
    order = np.argsort(size, kind="stable")
    sets, size = [sets[i] for i in order], size[order]
    starts = np.concatenate([[0], np.cumsum(size)])
    spread = [s * np.uint64(0x9E3779B97F4A7C15) for s in sets]
    maps = pa.array(ngram_join.bitmaps(np.concatenate(spread), starts), pa.binary())
    side = ngram_join.Side(np.arange(len(sets)), size.astype(np.int64), np.arange(1, len(sets) + 1), maps)
    found = {(min(x, y), max(x, y)) for a, b, _ in side.pairs(side) for x, y in zip(a.tolist(), b.tolist())}
    for i in range(len(sets)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 85 * (size[i] + size[j] - both):
                assert (j, i) in found


def test_components(spark):
    path = [(i, i + 1) for i in range(50)] + [(100, 200), (200, 150), (300, 300)]
    got = dict(components(spark.createDataFrame(path, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(51)}, 100: 100, 150: 100, 200: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def five_word_least(rows):
    """Least key of each row's component by five words and 0.8, rows without words left out."""
    sets = {k: shingles(t, 5) for k, t in rows}
    least = {k: k for k, s in sets.items() if s}
    links = [(a, b) for a in least for b in least if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    while any(least[a] != least[b] for a, b in links):
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    return least, links


@pytest.mark.parametrize("group", [8, 2048])
def test_pipeline_stage_equals_brute_force_of_five_words(spark, monkeypatch, group):
    """Also pairs that are similar by five words from 0.8, not by four from 0.85."""
    monkeypatch.setattr(ngram_join, "GROUP", group)
    pick = random.Random(8)
    texts = near_copies(4, 30, 100, 5) + near_copies(5, 30, 300, 14) + near_copies(6, 30, 40, 3) + ["a b c d", "A b c d", "a b c", "", "a b c d e"]
    # one sentence more: 44 of 52 shingles of four words are common, 43 of 51 of five
    texts += [" ".join(f"{x}{i}" for i in range(n)) for x in "qrs" for n in (47, 55)]
    rows = list(enumerate(texts))
    pick.shuffle(rows)
    least, links = five_word_least(rows)
    four = {k: shingles(t) for k, t in rows}
    apart = [(a, b) for a, b in links if 100 * len(four[a] & four[b]) < 85 * len(four[a] | four[b])]
    assert apart
    docs = documents(spark, [(k, t, "en", "a", 1) for k, t in rows])
    got = {r.doc_id for r in corpus_pipeline.without_copies(spark, docs, "").collect()}
    assert got == {k for k, c in least.items() if k == c} | {k for k, t in rows if not t}


def most_python_operators(plan):
    """Of one task: on a way through the plan, between exchanges."""
    way, most = [(-1, 0)], 0
    for line in plan.splitlines():
        name = line.lstrip(" :+-*")
        at = len(line) - len(name)
        if name.startswith(("==", "AdaptiveSparkPlan")) or not name:
            continue
        while way[-1][0] >= at:
            way.pop()
        python = any(x in name.split("[")[0].split("(")[0] for x in ("Python", "Arrow", "Pandas"))
        way.append((at, 0 if "Exchange" in name.split(" ")[0] else way[-1][1] + python))
        most = max(most, way[-1][1])
    return most


def test_no_task_holds_two_python_workers(spark, monkeypatch, capsys):
    """Each Python operator of a task holds a worker of its own, and workers stay: an executor's memory goes with them."""
    plans = []

    def noted(df):
        capsys.readouterr()
        df.explain()
        plans.append(capsys.readouterr().out)
        return df

    def noting(df, label, *more, save=ngram_join.saved):
        return save(noted(df), label, *more)

    monkeypatch.setattr(ngram_join, "saved", noting)
    rows = [(i, t, "en", "a", 1) for i, t in enumerate(near_copies(7, 30, 60, 2) + ["", "a b"])]
    kept = noted(ngram_join.deduplicated(documents(spark, rows)))
    assert 3 <= kept.count() < 32
    assert [most_python_operators(p) for p in plans].count(1) >= 5
    assert max(most_python_operators(p) for p in plans) == 1


def test_repeated_and_missing_keys(spark):
    """Sets are found by key: of several texts of one key, or of none, each keeps its links."""
    texts = near_copies(9, 12, 80, 2) + near_copies(10, 12, 50, 1) + ["", "a b c", "a b c"]
    check(spark, [((None, 3, i)[i % 3], t) for i, t in enumerate(texts)])


def test_nodes_in_slices(spark, monkeypatch):
    texts = [*near_copies(11, 40, 30, 5), None, "", "a b", "x" * 500]
    expected = ngram_join.nodes_of(*ngram_join.sets(pa.array(texts))).tolist()
    monkeypatch.setattr(ngram_join, "SLICE", 300)
    rows = spark.createDataFrame(list(enumerate(texts)), "k long, t string").coalesce(1)
    got = dict(rows.select("k", ngram_join._node(ngram_join.SHINGLE)("t")).collect())
    assert [got[i] for i in range(len(texts))] == expected


def test_rules_out_of_range(spark):
    for rule in ({"shingle": 0}, {"percent": 49}, {"percent": 101}):
        with pytest.raises(ValueError):
            ngram_join.classes(documents(spark), **rule)
