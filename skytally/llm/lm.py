"""Language-model scores by deleted interpolation of word bigrams.

The probability of a word after another mixes three estimates: the pair's maximum-likelihood one, the
word's, and a uniform one over the vocabulary and one unknown word. The mixture weights depend on how often
the context was seen, in buckets of powers of two. They are learned by expectation-maximisation on a
deleted part of the training texts, with counts from the rest; the final estimates use all of the
training texts.

Every count is of all training texts. Texts are tokenised once into batches; each batch asks for the
totals of its distinct words and pairs (see :mod:`skytally.llm.batches`), so work and traffic follow
the corpus, and nothing but the mixture weights, three numbers a bucket, passes through the driver.

Words are runs of anything but ASCII white space, A-Z as a-z; a text is its words and one end. A null text
is empty and has the end alone; a null key counts as empty text where keys are hashed; repeated rows
are texts of their own. Without training texts all counts are 0 and every score is that of the uniform
estimate. Words are told apart by 64-bit hashes. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytally.llm.batches import Batch, answered, distinct_keys, tokenised, totals
from skytally.llm.store import checksum, saved
from skytally.llm.tokens import combine, mix

REST, DELETED, UNSEEN = 0, 1, 2
#: Buckets of the context count: none, then one for each power of two.
BUCKETS = 64
ROUNDS = 12
SMOOTHING = 0.1

_WORD, _END, _START = (mix(np.array([i], np.uint64)) for i in (101, 102, 103))


def bucket(count: np.ndarray) -> np.ndarray:
    return np.where(count > 0, np.floor(np.log2(np.maximum(count, 1))) + 1, 0).astype(np.int64)


def _pairs(b: Batch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of contexts and words over all texts, each with its end, and where texts begin."""
    end, start = len(b.vocabulary), len(b.vocabulary) + 1
    first = np.concatenate([[0], np.cumsum(b.lengths + 1)])
    word = np.full(first[-1], end)
    inner = np.ones(first[-1], bool)
    inner[first[1:] - 1] = False
    word[inner] = b.numbers
    context = np.empty_like(word)
    context[1:] = word[:-1]
    context[first[:-1]] = start
    return context, word, first


def _asked(b: Batch) -> tuple[list, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys and counts of words and pairs; for each the order its keys have; each token's pair; its word."""
    context, word, first = _pairs(b)
    hashes = np.concatenate([b.vocabulary, _END, _START])
    size = len(hashes)
    codes, pair, counts = np.unique(context * size + word, return_inverse=True, return_counts=True)
    pair_keys = combine(hashes[codes // size], hashes[codes % size])
    word_keys = combine(np.broadcast_to(_WORD, size - 1), hashes[:-1])
    by_word, by_pair = np.argsort(word_keys), np.argsort(pair_keys)
    word_counts = np.bincount(word, minlength=size - 1)
    keys = [(word_keys[by_word], word_counts[by_word]), (pair_keys[by_pair], counts[by_pair])]
    return keys, (by_word, by_pair), codes, pair.ravel(), (word, first)


def _ask(b: Batch) -> list:
    return _asked(b)[0]


def _known(b: Batch, part: int | None, starts: tuple[int, int]) -> tuple:
    """Counts per distinct pair: of the pair, its context, its word. ``part`` None: of both parts."""
    _, (by_word, by_pair), codes, pair, (word, first) = _asked(b)
    words, pairs = b.answer([0, 1])
    pick = (lambda x: x.sum(0)) if part is None else (lambda x: x[part])
    word_count, pair_count = np.empty(len(by_word), np.int64), np.empty(len(by_pair), np.int64)
    word_count[by_word], pair_count[by_pair] = pick(words), pick(pairs)
    size = len(by_word) + 1
    context_count = np.append(word_count, sum(starts) if part is None else starts[part])
    context_count[size - 2] = 0  # an end is no context
    return pair_count, context_count[codes // size], word_count[codes % size], pair, word_count[word], first


def learned(events: DataFrame, n: int, v: int) -> np.ndarray:
    """Mixture weights by context bucket: pair, word, uniform."""
    weights = np.tile([0.4, 0.5, 0.1], (BUCKETS, 1))
    weights[0] = [0.0, 0.9, 0.1]
    for _ in range(ROUNDS):
        of = [F.element_at(F.array(*[F.lit(float(x)) for x in weights[:, i]]), F.col("bucket") + 1) for i in range(3)]
        share = [of[0] * F.col("f2"), of[1] * F.col("f1"), of[2] * F.lit(1 / (v + 1))]
        whole = share[0] + share[1] + share[2]
        found = (
            events.select("bucket", "n", *[(s / whole).alias(f"s{i}") for i, s in enumerate(share)])
            .groupBy("bucket").agg(*[F.sum(F.col("n") * F.col(f"s{i}")).alias(f"s{i}") for i in range(3)])
            .collect()
        )
        sums = np.zeros((BUCKETS, 3))
        for row in found:  # a row a bucket
            sums[row["bucket"]] = [row["s0"], row["s1"], row["s2"]]
        weights = sums + 10 * weights  # a bucket with little evidence stays near where it was
        weights /= weights.sum(1, keepdims=True)
    return weights


def scored(docs: DataFrame, held_out: Column, deleted: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, counts of tokens, and log10 probabilities by the model and by smoothed word counts alone."""
    kind = docs.schema[key].dataType.simpleString()
    part = F.when(held_out, UNSEEN).when(deleted, DELETED).otherwise(REST)
    batches = tokenised(docs, key, text, part)
    sizes = {r["part"]: r for r in batches.groupBy("part").agg(F.sum("n_words").alias("words"), F.sum("n_docs").alias("docs")).collect()}
    starts = tuple(int(sizes[p]["docs"]) if p in sizes else 0 for p in (REST, DELETED))
    tokens = tuple(int(sizes[p]["words"] + sizes[p]["docs"]) if p in sizes else 0 for p in (REST, DELETED))
    everything = sum(int(r["words"] + r["docs"]) for r in sizes.values())
    answers = totals(batches, _ask, everything)
    v_rest, v = distinct_keys(answers, 0)
    n_rest, n = tokens[0], sum(tokens)

    def deleted_events(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for row in frame.to_pylist():
                pair_count, context_count, word_count, pair, _, _ = _known(Batch(row), REST, starts)
                times = np.bincount(pair, minlength=len(pair_count))
                triples = np.stack([pair_count, context_count, word_count, times])
                same = combine(combine(*triples[:2].astype(np.uint64)), triples[2].astype(np.uint64))
                _, at, of = np.unique(same, return_index=True, return_inverse=True)
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, triples[:3, at]), pa.array(np.bincount(of.ravel(), times).astype(np.int64))], ["c2", "c", "c1", "n"]
                )

    events = answered(batches.filter(f"part = {DELETED}"), answers).mapInArrow(deleted_events, "c2 long, c long, c1 long, n long")
    grouped = events.groupBy("c2", "c", "c1").agg(F.sum("n").alias("n"))
    context_bucket = F.when(F.col("c") > 0, F.floor(F.log2(F.col("c").cast("double"))) + 1).otherwise(0).cast("int")
    events = saved(
        grouped.select(
            context_bucket.alias("bucket"), "n", F.when(F.col("c") > 0, F.col("c2") / F.col("c")).otherwise(0.0).alias("f2"),
            (F.col("c1") / F.lit(max(n_rest, 1))).alias("f1"),
        ).groupBy("bucket", "f2", "f1").agg(F.sum("n").alias("n")),
        "deleted",
    )
    weights = learned(events, n_rest, v_rest)

    def scores(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for row in range(frame.num_rows):
                b = Batch(frame.slice(row, 1).to_pylist()[0])
                pair_count, context_count, word_count, pair, token_count, first = _known(b, None, starts)
                w = weights[bucket(context_count)].T
                f2 = np.where(context_count > 0, pair_count / np.maximum(context_count, 1), 0)
                with np.errstate(divide="ignore"):
                    model = np.log10(w[0] * f2 + w[1] * word_count / max(n, 1) + w[2] / (v + 1))
                    base = np.log10((token_count + SMOOTHING) / (n + SMOOTHING * (v + 1)))
                add = lambda x: np.add.reduceat(x, first[:-1])
                yield pa.RecordBatch.from_arrays(
                    [frame.column("keys").slice(row, 1).flatten(), pa.array(np.diff(first)), pa.array(add((token_count > 0).astype(np.int64))),
                     pa.array(add(base)), pa.array(add(model[pair]))],
                    [key, "n_tokens", "n_known", "base_score", "score"],
                )

    schema = f"`{key}` {kind}, n_tokens long, n_known long, base_score double, score double"
    return answered(batches, answers).mapInArrow(scores, schema).withColumn("train_tokens", F.lit(n).cast("long"))


def op3(docs: DataFrame) -> DataFrame:
    """All documents, scored by a model that has not seen the tenth of them with checksum 0."""
    fold = checksum("doc_id") % 10
    found = scored(docs.select("doc_id", "text"), fold == 0, fold == 1)
    return found.select("doc_id", (fold == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
