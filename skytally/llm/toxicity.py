"""Toxicity scores by FTRL-proximal logistic regression over hashed n-grams and skip-grams.

Features of a text: its lower-cased words (runs of letters and digits), pairs of neighbours, and pairs
with one word between, each hashed to ``2 ** BITS`` places; a feature is present or not. The learner
has a learning rate per coordinate and an L1 penalty that keeps most weights at zero, so the model is
a short list of (place, weight), never longer than ``2 ** BITS``, and goes to every task whole.

Learning sees a bounded sample of labelled rows, ``TRAIN_ROWS`` of them in the order of a hash of
their key, streamed ``EPOCHS`` times through one task that holds one batch of texts at a time.
Scoring covers every row, without a shuffle.

Nulls and ties: a null text is empty and scores the bias; null labels teach nothing; a null key is
scored and teaches nothing; repeated rows get equal scores; a text labelled twice is learned from
twice. A very long text is worked on by itself, in memory of some hundred bytes a word; an empty table gives no rows,
and columns other than the key and the text stay or are not read. Without labels of both kinds there is nothing to tell apart and every score is 0.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.llm.store import checksum, saved
from skytally.llm.tokens import NOT_ALPHANUMERIC, as_bytes, combine, hashed_words, parts_of, pieces_of, rows_of

BITS = 22
TRAIN_ROWS = 20_000
EPOCHS = 2
ALPHA, BETA, L1, L2 = 0.5, 1.0, 7.0, 0.0
#: How much more a toxic text teaches than another: they are few.
TOXIC_WEIGHT = 3.0
BIAS = -1
#: Places, or bytes of text, worked on at a time.
SLICE = 1 << 19


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and place of every feature occurrence."""
    words, offsets = hashed_words(texts, NOT_ALPHANUMERIC)
    row = rows_of(offsets)
    found, rows = [words], [row]
    for gap in (1, 2):
        near = row[gap:] == row[:-gap]
        found.append(combine(words[:-gap] + np.uint64(gap), words[gap:])[near])
        rows.append(row[gap:][near])
    return np.concatenate(rows), (np.concatenate(found) >> np.uint64(64 - BITS)).astype(np.int64)


class Ftrl:
    """The online learner. ``z`` and ``n`` are its sums per coordinate; the last place is the bias."""

    def __init__(self) -> None:
        self.z = np.zeros((1 << BITS) + 1)
        self.n = np.zeros((1 << BITS) + 1)
        self.seen = [0, 0]

    def weights(self, at: np.ndarray) -> np.ndarray:
        z = self.z[at]
        l1 = np.where(at == 1 << BITS, 0.0, L1)
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(self.n[at])) / ALPHA + L2))

    def learn(self, places: np.ndarray, label: int) -> None:
        at = np.append(np.unique(places), 1 << BITS)
        w = self.weights(at)
        g = (1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label) * (TOXIC_WEIGHT if label else 1.0)
        grown = self.n[at] + g * g
        self.z[at] += g - (np.sqrt(grown) - np.sqrt(self.n[at])) / ALPHA * w
        self.n[at] = grown
        self.seen[label] += 1

    def model(self) -> tuple[np.ndarray, np.ndarray]:
        found = []
        for at in range(0, 1 << BITS, SLICE):
            places = np.arange(at, min(at + SLICE, 1 << BITS))
            w = self.weights(places)
            found.append((places[w != 0], w[w != 0]))
        found.append((np.array([BIAS]), self.weights(np.array([1 << BITS]))))
        return tuple(np.concatenate(x) for x in zip(*found))


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    learner = Ftrl()
    for part in parts_of(batches, "text", SLICE):
        row, place = features(part.column("text"))
        order = np.argsort(row, kind="stable")
        row, place = row[order], place[order]
        edges = np.searchsorted(row, np.arange(part.num_rows + 1))
        for i, label in enumerate(part.column("label").to_pylist()):
            learner.learn(place[edges[i] : edges[i + 1]], label)
    if min(learner.seen):
        places, weights = learner.model()
        yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(weights)], ["place", "weight"])


def train(docs: DataFrame, labels: DataFrame, learn: Column, key: str = "doc_id", text: str = "text",
          label: str = "toxic", rows: int = TRAIN_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """The model: places in order and their weights, the bias first. ``learn`` says of a key whether it may teach."""
    known = (
        labels.select(F.col(key).alias("__key"), F.col(label).cast("int").alias("label"))
        .filter(F.col("label").isin(0, 1) & F.col("__key").isNotNull())
        .withColumn("__order", F.xxhash64("__key"))
    )
    taught = known.withColumnRenamed("__key", key).filter(learn).withColumnRenamed(key, "__key")
    # at most `rows` keys of a few bytes each
    taught = saved(taught.orderBy("__order", "__key", "label").limit(rows), "toxic-keys")
    texts = docs.select(F.col(key).alias("__key"), F.col(text).alias("text"))
    sample = texts.join(F.broadcast(taught), "__key").withColumn(
        "__epoch", F.explode(F.array(*[F.lit(i) for i in range(EPOCHS)]))
    )
    stream = sample.repartition(1).sortWithinPartitions("__epoch", "__order", "__key", "label", F.xxhash64("text"))
    model = stream.select("text", "label").mapInArrow(_learn, "place long, weight double")
    found = saved(model, "toxic-model").orderBy("place").toArrow()  # at most 2 ** BITS + 1 rows
    return found.column("place").to_numpy(), found.column("weight").to_numpy()


def scorer(spark: SparkSession, model: tuple[np.ndarray, np.ndarray]) -> Callable[[Column], Column]:
    """The score of a text column, between 0 and 1. The model is broadcast: at most 2 ** BITS + 1 weights."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scores(texts: pa.Array) -> pa.Array:
        places, weights = shared.value
        sums = np.zeros(len(texts))
        for a, b in pieces_of(as_bytes(texts)[1], SLICE) if len(places) else []:
            row, place = features(texts.slice(a, b - a))
            at = np.minimum(np.searchsorted(places, place), len(places) - 1)
            hit = np.flatnonzero(places[at] == place)
            row, at = np.divmod(np.unique(row[hit] * len(places) + at[hit]), len(places))
            sums[a:b] = weights[0] + np.bincount(row, weights[at], b - a)
        if len(places):
            sums = 1 / (1 + np.exp(-np.clip(sums, -700, 700)))
        return pa.array(sums, pa.float64())

    return scores


def op9(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all documents by a model that never sees a label of the held-out fifth."""
    held_out = checksum("doc_id") % 5 == 0
    scores = scorer(docs.sparkSession, train(docs, labels, ~held_out))
    return docs.select("doc_id", held_out.alias("held_out"), scores(F.col("text")).alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows whose text does not look toxic, with all their columns."""
    scores = scorer(docs.sparkSession, train(docs, labels, checksum("doc_id") % 5 != 0))
    return docs.withColumn("__toxic", scores(F.col("text"))).filter("__toxic < 0.5").drop("__toxic")
