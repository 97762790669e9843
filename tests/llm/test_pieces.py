import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from skytally.llm import pieces
from tests.llm.helpers import ODD, documents

TEXTS = [r[1] for r in ODD] + ["  a  b\n\tc ", "ﬁ①É", " ", "日本語 😀\n\n x", "a▁b ▁", "\r\n\x00 á", "the " * 50]


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.6, 1.0])
def test_round_trip(dropout):
    p = pieces.Pieces(pieces.vocabulary(), dropout)
    ids = p.encode(TEXTS, np.arange(len(TEXTS)).astype(np.uint64))
    assert [p.decode(i) for i in ids] == TEXTS


def test_without_dropout_as_the_library():
    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    p = pieces.Pieces(pieces.vocabulary())
    texts = [t for t in TEXTS if t and "▁" not in t]
    assert [i.tolist() for i in p.encode(texts, np.zeros(len(texts), np.uint64))] == sp.encode(texts)


def test_many_parts_together_as_one_by_one():
    p = pieces.Pieces(pieces.vocabulary(), 0.3)
    parts = sorted({w for t in TEXTS if t for w in pieces._PARTS.findall(" " + t) if len(w) < 40})
    for variant in range(3):
        keys = p.keys(parts, [variant] * len(parts))
        for part, ids, key in zip(parts, p.encode_parts(parts, [variant] * len(parts)), keys.tolist()):
            assert np.frombuffer(ids, np.int32).tolist() == p.agenda(part, key)


def test_segmentations_vary_and_reruns_agree(spark):
    docs = documents(spark, [(i, "international organization of standards " * 3, "en", "a", 1) for i in range(40)])
    runs = [sorted((r.doc_id, tuple(r.ids)) for r in pieces.encoded(d).collect()) for d in (docs, docs.repartition(7))]
    assert runs[0] == runs[1] and len({ids for _, ids in runs[0]}) > 10
    other = pieces.encoded(docs, seed=2).collect()
    assert sorted((r.doc_id, tuple(r.ids)) for r in other) != runs[0]


def test_odd_rows_and_empty_table(spark):
    docs = documents(spark)
    got = pieces.op2(docs)
    assert got.filter("NOT lossless").count() == 0 and got.count() == docs.count()
    whole = pieces.decoded(pieces.encoded(docs))
    assert whole.filter("text IS NULL AND ids IS NULL AND decoded IS NULL").count() == 1
    assert whole.filter("text = '' AND size(ids) = 0 AND decoded = ''").count() == 1
    assert pieces.op2(docs.limit(0)).count() == 0


def test_each_occurrence_of_a_word_is_split_at_the_rate(spark):
    """A word of one merge, in 200 documents of 50: split in a tenth of all, as many ways apart as draws of their own give."""
    docs = documents(spark, [(i, "a " * 49 + "a", "en", "a", 1) for i in range(200)])
    ids = [r.ids for r in pieces.encoded(docs).collect()]
    split = np.array([len(x) - 50 for x in ids])
    assert abs(split.sum() / 10_000 - 0.1) < 0.015
    assert 2 < split.var() < 8  # binomial: 4.5


@pytest.mark.parametrize("rate, cache, often", [(0.1, 1 << 18, 8), (0.4, 1 << 18, 1), (0.1, 20, 1), (0.0, 20, 1)])
def test_table_gives_what_each_occurrence_draws(monkeypatch, rate, cache, often):
    monkeypatch.setattr(pieces, "CACHE", cache)
    monkeypatch.setattr(pieces, "LOOK_UP", 64)
    monkeypatch.setattr(pieces, "OFTEN", often)
    texts = ["the international organization of standards and ﬁ " + "=" * 60] * 120
    names = pieces.mix(np.arange(len(texts)).astype(np.uint64))
    held, alone = pieces.Pieces(pieces.vocabulary(), rate), pieces.Pieces(pieces.vocabulary(), rate)
    got = held.encode(texts, names)
    for text, name, ids in zip(texts, names, got):
        parts = pieces._PARTS.findall(" " + text)
        keys = alone.keys(parts, pieces.mix(name + np.arange(len(parts)).astype(np.uint64)))
        assert ids.tolist() == [x for p, k in zip(parts, keys.tolist()) for x in alone.agenda(p, k)]


def test_taken_names_raise(spark):
    docs = documents(spark)
    with pytest.raises(ValueError):
        pieces.encoded(docs.withColumn("IDS", F.lit(1)))
    with pytest.raises(ValueError):
        pieces.encoded(docs, lossless="ids")
    with pytest.raises(ValueError):
        pieces.decoded(pieces.encoded(docs).withColumn("decoded", F.lit(1)))


def test_check_in_the_encoding_pass_is_that_of_decoding(spark):
    docs = documents(spark)
    rows = pieces.decoded(pieces.encoded(docs, lossless="same")).collect()
    assert all(r.same and r.decoded == r.text for r in rows) and len(rows) == docs.count()
