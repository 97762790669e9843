"""Tokenised texts in batches, and counts of keys over all batches.

A batch is some ``BATCH_WORDS`` words of whole texts as a list of distinct word hashes and a number
per word. Passes that need corpus counts ask for them once per batch and distinct key: the keys of a
batch go to buckets by hash, a bucket adds up its keys, and each batch gets back a total per key, in the
order of the keys. A key in every text crosses the network once per batch, so a frequent one is no
hot group.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytally.llm.store import saved
from skytally.llm.tokens import WHITE_SPACE, hashed_words

BATCH_WORDS = 1 << 19
#: Keys that meet in one bucket, about.
BUCKET_KEYS = 1 << 19


def pack(values: np.ndarray) -> bytes:
    """An array's bytes, by significance, compressed: small numbers take little."""
    return zlib.compress(np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T.tobytes(), 1)


def unpack(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(data), np.uint8).reshape(size, -1).T).view(kind).ravel()


def tokenised(docs: DataFrame, key: str, text: str, part: Column, words: int = BATCH_WORDS) -> DataFrame:
    """All texts as batches of one ``part`` each: keys, words per text, the distinct hashes, numbers of them."""
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), part.cast("int").alias("part"), F.spark_partition_id().alias("task"))

    def split(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list] = {}
        made = 0

        def batch(part: int, task: int) -> pa.RecordBatch:
            nonlocal made
            parts = waiting.pop(part)
            lengths = np.concatenate([p[1] for p in parts])
            distinct, numbers, counts = np.unique(np.concatenate([p[2] for p in parts]), return_inverse=True, return_counts=True)
            order = np.argsort(-counts, kind="stable")  # small numbers for frequent words
            place = np.empty_like(order)
            place[order] = np.arange(len(order))
            made += 1
            return pa.RecordBatch.from_pydict({
                "batch": [(task << 32) + made], "part": pa.array([part], pa.int32()),
                "keys": pa.ListArray.from_arrays(pa.array([0, len(lengths)], pa.int32()), pa.concat_arrays([p[0] for p in parts])),
                "lengths": [pack(lengths)], "vocabulary": [distinct[order].tobytes()],
                "numbers": [pack(place[numbers.ravel()].astype(np.uint32))],
                "n_words": [len(numbers.ravel())], "n_docs": [len(lengths)],
            })

        task = 0
        for frame in frames:
            hashes, offsets = hashed_words(frame.column("text"))
            lengths, of = np.diff(offsets), np.repeat(np.asarray(frame.column("part")), np.diff(offsets))
            task = frame.column("task")[0].as_py() if frame.num_rows else task
            parts = np.asarray(frame.column("part"))
            for p in np.unique(parts).tolist():
                own = np.flatnonzero(parts == p)
                waiting.setdefault(p, []).append((frame.column("key").take(pa.array(own)), lengths[own], hashes[of == p]))
                if sum(len(x[2]) for x in waiting[p]) >= words:
                    yield batch(p, task)
        for p in list(waiting):
            yield batch(p, task)

    schema = f"batch long, part int, keys array<{kind}>, lengths binary, vocabulary binary, numbers binary, n_words long, n_docs long"
    return saved(rows.mapInArrow(split, schema), "batches")


class Batch:
    """A row of :func:`tokenised`."""

    def __init__(self, row: dict) -> None:
        self.batch, self.part, self.keys = row["batch"], row["part"], row["keys"]
        self.lengths = unpack(row["lengths"], np.int64)
        self.vocabulary = np.frombuffer(row["vocabulary"], np.uint64)
        self.numbers = unpack(row["numbers"], np.uint32).astype(np.int64)
        self.answers = row.get("answers")

    def answer(self, kinds: list[int]) -> list[np.ndarray]:
        """Totals for the keys asked for, a pair of rows for each kind, in the order of its keys."""
        out: list[list] = [[] for _ in kinds]
        for a in self.answers:
            out[a["kind"]].append(unpack(a["totals"], np.int64).reshape(2, -1))
        return [np.concatenate(x, 1) if x else np.zeros((2, 0), np.int64) for x in out]


Ask = Callable[[Batch], list[tuple[np.ndarray, np.ndarray]]]


def totals(batches: DataFrame, ask: Ask, n_keys: int) -> DataFrame:
    """Corpus totals for each batch. ``ask`` gives, for each kind of key, sorted keys and their counts in the batch.

    Part 0 and part 1 are added up apart; batches of other parts only ask. Rows: ``batch``, ``answers``,
    and with a null batch, per kind, how many keys have a count in part 0, and in either part.
    """
    buckets = -(-n_keys // BUCKET_KEYS) or 1

    def asked(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for row in frame.to_pylist():
                b = Batch(row)
                for kind, (keys, counts) in enumerate(ask(b)):
                    bucket = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
                    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(keys) else np.zeros(0, int)
                    slices = list(zip(first, [*first[1:], len(keys)]))
                    full = bucket[first].astype(np.int32)
                    yield pa.RecordBatch.from_pydict({
                        "kind": pa.array([kind] * len(full), pa.int32()), "bucket": pa.array(full, pa.int32()),
                        "batch": pa.array([b.batch] * len(full), pa.int64()), "part": pa.array([b.part] * len(full), pa.int32()),
                        "keys": pa.array([keys[i:j].tobytes() for i, j in slices], pa.binary()),
                        "counts": pa.array([pack(counts[i:j]) for i, j in slices], pa.binary()),
                    })

    def added(name: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        keys = [np.frombuffer(k, np.uint64) for k in rows["keys"]]
        distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
        at = at.ravel()
        ends = np.cumsum([len(k) for k in keys])
        counts = np.concatenate([unpack(c, np.int64) for c in rows["counts"]]).astype(float)
        part = np.repeat(rows["part"].to_numpy(), [len(k) for k in keys])
        sums = np.stack([np.bincount(at, np.where(part == p, counts, 0), len(distinct)) for p in (0, 1)]).astype(np.int64)
        back = np.split(sums[:, at], ends[:-1], axis=1)
        seen = [np.count_nonzero(sums[0]), np.count_nonzero(sums.sum(0))]
        none = [None] * len(back)
        return pd.DataFrame({
            "batch": [*rows["batch"], None], "kind": name[0], "bucket": name[1], "totals": [*[pack(x.ravel()) for x in back], None],
            "seen_0": [*none, seen[0]], "seen": [*none, seen[1]],
        }).astype({"batch": "Int64", "seen_0": "Int64", "seen": "Int64"})

    sent = batches.mapInArrow(asked, "kind int, bucket int, batch long, part int, keys binary, counts binary")
    answers = sent.groupBy("kind", "bucket").applyInPandas(added, "batch long, kind int, bucket int, totals binary, seen_0 long, seen long")
    return saved(answers, "totals")


def answered(batches: DataFrame, answers: DataFrame) -> DataFrame:
    """Batches with their answers, by bucket."""
    per_batch = answers.filter("batch IS NOT NULL").groupBy(F.col("batch").alias("__batch")).agg(
        F.array_sort(F.collect_list(F.struct("kind", "bucket", "totals"))).alias("answers")
    )
    return batches.join(per_batch, F.col("batch") == F.col("__batch")).drop("__batch")


def distinct_keys(answers: DataFrame, kind: int) -> tuple[int, int]:
    """Keys with a count in part 0, and in part 0 or 1."""
    found = answers.filter(f"batch IS NULL AND kind = {kind}").agg(F.sum("seen_0"), F.sum("seen")).first()
    return int(found[0] or 0), int(found[1] or 0)
