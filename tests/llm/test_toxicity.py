import random

from skytally.llm import toxicity
from tests.llm.helpers import documents

BAD = ["vile", "wretched", "odious"]


def corpus(n=1500):
    pick = random.Random(8)
    words = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(n):
        toxic = int(pick.random() < 0.15)
        text = pick.choices(words, k=pick.randrange(5, 60)) + (pick.choices(BAD, k=3) if toxic else [])
        pick.shuffle(text)
        rows.append((i, " ".join(text), "en", "a", 1))
        labels.append((i, 1, toxic))
    return rows, labels


def test_held_out_texts_are_told_apart(spark):
    rows, labels = corpus()
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.op9(documents(spark, rows), known).collect()}
    assert len(got) == len(rows)
    unseen = [(got[i], t) for i, _, t in labels if got[i].held_out]
    assert 150 < len(unseen) < 450
    assert sum(r.predicted == t for r, t in unseen) >= 0.98 * len(unseen)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())


def test_labels_of_the_held_out_part_do_not_count(spark):
    rows, labels = corpus(400)
    docs = documents(spark, rows)
    schema = "doc_id long, quality int, toxic int"
    first = {r.doc_id: r for r in toxicity.op9(docs, spark.createDataFrame(labels, schema)).collect()}
    turned = [(i, q, 1 - t if first[i].held_out else t) for i, q, t in labels]
    second = {r.doc_id: r.score for r in toxicity.op9(docs, spark.createDataFrame(turned, schema)).collect()}
    assert second == {i: r.score for i, r in first.items()}


def test_weights_are_few(spark):
    rows, labels = corpus()
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    places, weights = toxicity.train(documents(spark, rows), known, toxicity.checksum("doc_id") >= 0)
    assert places[0] == toxicity.BIAS and 3 < len(places) < 600 and (weights[1:] != 0).all()


def test_odd_rows_and_empty_tables(spark):
    rows, labels = corpus(300)
    odd = [(r.doc_id + 10000 if r.doc_id is not None else None, r.text, "en", "a", 1) for r in documents(spark).collect()]
    docs = documents(spark, rows + odd)
    known = spark.createDataFrame([*labels, (None, 1, 1), (5, 1, None), (7, 1, 9), (8, 1, 1), (8, 1, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.op9(docs, known).collect()
    assert len(got) == docs.count() and all(r.score is not None for r in got)
    kept = toxicity.clean(docs, known)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()
    none = known.limit(0)
    assert {(r.score, r.predicted) for r in toxicity.op9(docs, none).collect()} == {(0.0, 0)}
    assert toxicity.clean(docs, none).count() == docs.count()
    assert toxicity.op9(docs.limit(0), known).count() == 0
