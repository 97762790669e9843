"""Runs of periodically repeated words, and texts with each run collapsed to its first period.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) that is
at least ``EXPONENT`` periods and ``LEAST`` words long and that no neighbouring word extends. All runs
are found, by internal pattern matching:

* A suffix array over the words of a batch of texts is made by prefix doubling. Words of different
  texts never match and each text ends in a word of its own, so no match leaves its text. On the way
  every dyadic block (length m = 2, 4, 8, ..., starting at a multiple of m) whose words occur again
  gets its interval of the suffix array.
* A wavelet matrix over the suffix array answers range successors: the occurrence of a block next after
  it and next before it. Blocks that occur once are not asked for.
* An occurrence at a distance d with m / 2 <= d < m overlaps its block, so that both lie in a stretch
  with period d. Such occurrences of one distance that touch form a progression, and each progression
  is one candidate: a period and a stretch, extended word by word until it ends.

No run is missed. A run with period q and at least 4 q words holds, for the m with q < m <= 2 q, a
whole block of length m (2 m - 1 words hold one) and beside it at least 2 q more words, hence q on one side.
There the block occurs at distance q, and at no smaller one, or the run had a smaller period. For the
same reason a candidate's distance is the smallest period of any stretch long enough to be a run.

A text's words are any bytes but spaces and the control characters 9 to 13, compared exactly. Each row
is on its own: nothing is shuffled, and a task needs some hundred bytes for each word of a batch (4 MB of
text, or one longer text). A null text and one without words have no runs and collapse to the empty
text; ties do not arise, repeated rows get the same result each, an empty table gives none. All other
columns stay; a name that is taken raises ValueError.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytally.llm.store import checksum, free

EXPONENT, LEAST = 4, 6
RUN = "struct<start:bigint,length:bigint,period:bigint>"


class Blocks:
    """The suffix array of ``symbols`` and the intervals in it of all dyadic blocks that occur twice.

    Every symbol string that repeats must end before the array does: the last symbol is unique.
    """

    def __init__(self, symbols: np.ndarray) -> None:
        n = len(symbols)
        order = np.argsort(symbols, kind="stable")
        sizes = np.empty(n, np.int64)  # by first place of a class
        rank = np.empty(n, np.int64)  # first place of the class of what starts at a position
        first = self._firsts(symbols[order])
        rank[order] = first
        self._count(sizes, first, np.arange(n))
        self.symbols, self.intervals, m = rank.copy(), [], 1
        active = order[sizes[first] > 1]
        while len(active):
            # what starts at an active position has m symbols that occur elsewhere: m further on is inside
            key = rank[active] * n + rank[active + m]
            by = np.argsort(key, kind="stable")
            active, key = active[by], key[by]
            old = rank[active]
            places = old + np.arange(len(old)) - self._firsts(old)
            first = places[self._firsts(key)]
            rank[active] = first
            self._count(sizes, first, places)
            m *= 2
            active = active[sizes[first] > 1]
            starts = np.sort(active[active % m == 0])
            self.intervals.append((m, starts, rank[starts], rank[starts] + sizes[rank[starts]]))
        self.suffixes = np.empty(n, np.int64)
        self.suffixes[rank] = np.arange(n)

    @staticmethod
    def _firsts(ordered: np.ndarray) -> np.ndarray:
        """For each place of an ordered array the first place of equal values."""
        new = np.ones(len(ordered), bool)
        new[1:] = ordered[1:] != ordered[:-1]
        return np.maximum.accumulate(np.where(new, np.arange(len(ordered)), 0))

    @staticmethod
    def _count(sizes: np.ndarray, first: np.ndarray, places: np.ndarray) -> None:
        """Sizes of classes, of which ``first`` names the first place for each of ``places``."""
        ends = np.flatnonzero(np.append(first[1:] != first[:-1], True))
        sizes[first[ends]] = places[ends] - first[ends] + 1


class Successors:
    """A wavelet matrix: per bit, from the highest, which values have it, each level ordered by the bits above."""

    def __init__(self, values: np.ndarray) -> None:
        self.levels = []
        for shift in reversed(range(int(len(values)).bit_length())):
            ones = (values >> shift) & 1 == 1
            packed = np.packbits(~ones, bitorder="little")
            words = np.zeros(len(ones) // 64 + 1, "<u8")
            words.view(np.uint8)[: len(packed)] = packed
            before = np.zeros(len(words), np.int64)
            np.cumsum(np.bitwise_count(words[:-1]), out=before[1:], dtype=np.int64)
            self.levels.append((shift, words, before, int(len(ones) - ones.sum())))
            values = np.concatenate([values[~ones], values[ones]])

    @staticmethod
    def _zeros(words: np.ndarray, before: np.ndarray, to: np.ndarray) -> np.ndarray:
        at = to >> 6
        below = (np.uint64(1) << (to & 63).astype(np.uint64)) - np.uint64(1)
        return before[at] + np.bitwise_count(words[at] & below).astype(np.int64)

    def smaller(self, low: np.ndarray, high: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many values in places ``low`` to ``high`` are under ``x``."""
        count = np.zeros(len(low), np.int64)
        for shift, words, before, zeros in self.levels:
            a, b = self._zeros(words, before, low), self._zeros(words, before, high)
            one = (x >> shift) & 1 == 1
            count += np.where(one, b - a, 0)
            low, high = np.where(one, low - a + zeros, a), np.where(one, high - b + zeros, b)
        return count

    def smallest(self, low: np.ndarray, high: np.ndarray, nth: np.ndarray) -> np.ndarray:
        """The ``nth`` smallest value (from 0) in places ``low`` to ``high``."""
        value = np.zeros(len(low), np.int64)
        for shift, words, before, zeros in self.levels:
            a, b = self._zeros(words, before, low), self._zeros(words, before, high)
            one = nth >= b - a
            nth = np.where(one, nth - (b - a), nth)
            value += one.astype(np.int64) << shift
            low, high = np.where(one, low - a + zeros, a), np.where(one, high - b + zeros, b)
        return value


def progressions(blocks: Blocks) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Candidates: a period, and first and end of a stretch whose symbols equal those a period further on."""
    asked = [x for x in blocks.intervals if len(x[1])]
    if not asked:
        return (np.zeros(0, np.int64),) * 3
    m, block, low, high = (np.concatenate(x) for x in zip(*((np.full(len(s), m), s, a, b) for m, s, a, b in asked)))
    order = Successors(blocks.suffixes)
    own = order.smaller(low, high, block)
    found = []
    for step, has in ((1, own + 1 < high - low), (-1, own > 0)):
        b = block[has]
        other = order.smallest(low[has], high[has], own[has] + step)
        found.append((np.abs(other - b), np.minimum(other, b), m[has]))
    d, start, m = (np.concatenate(x) for x in zip(*found))
    near = (2 * d >= m) & (d < m)
    d, start, m = d[near], start[near], m[near]
    by = np.lexsort((start, d))
    d, start, end = d[by], start[by], (start + m)[by]
    # stretches of one period that touch are one
    span = 2 * len(blocks.symbols)
    reach = np.maximum.accumulate(d * span + end)
    new = np.ones(len(d), bool)
    new[1:] = (d * span + start)[1:] > reach[:-1]
    firsts = np.flatnonzero(new)
    lasts = np.append(firsts[1:], len(d)) - 1 if len(d) else firsts
    return d[firsts], start[firsts], reach[lasts] - d[firsts] * span


def _equal(a: np.ndarray, b: np.ndarray) -> int:
    """How many symbols from the start of two arrays are the same."""
    at, step, n = 0, 32, min(len(a), len(b))
    while at < n:
        differ = a[at : min(at + step, n)] != b[at : min(at + step, n)]
        if differ.any():
            return at + int(differ.argmax())
        at, step = at + step, step * 4
    return n


def runs_of(symbols: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs (start, length, period), by start and period. The last symbol is unique."""
    blocks = Blocks(symbols)
    s = blocks.symbols
    out = set()
    for d, start, end in zip(*(x.tolist() for x in progressions(blocks))):
        start -= _equal(s[:start][::-1], s[: start + d][::-1])
        end += _equal(s[end:], s[end + d :])
        if end - start + d >= max(LEAST, EXPONENT * d):
            out.add((start, end - start + d, d))
    return sorted(out)


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    if runs:
        depth = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            depth[start + period] += 1
            depth[start + length] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0)]
    return b" ".join(words)


def _batch(texts: list[bytes | None]) -> tuple[list[list[tuple[int, int, int]]], list[bytes]]:
    words = [(t or b"").split() for t in texts]
    numbers: defaultdict = defaultdict()
    numbers.default_factory = numbers.__len__
    ends = np.cumsum([len(w) + 1 for w in words])
    symbols = np.empty(int(ends[-1]), np.int64)
    for w, end in zip(words, ends):
        symbols[end - len(w) - 1 : end - 1] = np.fromiter(map(numbers.__getitem__, w), np.int64, len(w))
    symbols += np.repeat(np.arange(len(words)), np.diff(ends, prepend=0)) * (len(numbers) + 1)
    symbols[ends - 1] = np.arange(1, len(words) + 1) * (len(numbers) + 1) - 1
    runs: list[list[tuple[int, int, int]]] = [[] for _ in words]
    for start, length, period in runs_of(symbols):
        text = int(np.searchsorted(ends, start, "right"))
        runs[text].append((start - int(ends[text]) + len(words[text]) + 1, length, period))
    return runs, [_collapsed(w, r) for w, r in zip(words, runs)]


def with_runs(df: DataFrame, text: str = "text", runs: str = "runs", collapsed: str = "collapsed") -> DataFrame:
    """``df`` with all runs of ``text``, by start and period, and the text without what a run repeats.

    A word is dropped if a run holds it after its first period; the others are joined by one space.
    """
    free(df, runs, collapsed)
    schema = f"{df.schema.toDDL()}, `{runs}` array<{RUN}>, `{collapsed}` string"

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        for batch in batches:
            if not batch.num_rows:
                continue
            found, short = _batch(batch.column(text).cast(pa.large_binary()).to_pylist())
            flat = np.array([r for rows in found for r in rows], np.int64).reshape(-1, 3)
            offsets = np.concatenate([[0], np.cumsum([len(rows) for rows in found])]).astype(np.int32)
            struct = pa.StructArray.from_arrays([pa.array(flat[:, i].copy()) for i in range(3)], fields=list(kind))
            lists = pa.ListArray.from_arrays(pa.array(offsets), struct)
            column = pa.array(short, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, lists, column], names=[*batch.schema.names, runs, collapsed])

    return df.mapInArrow(find, schema)


def repeated(text: str, key: str) -> Column:
    """``text``, but for one key in ten periodic from some word on: what the query's rows are searched in."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    h = checksum(key)
    g = F.floor(h / 10)

    def periodic(w: Column) -> Column:
        n = F.size(w)
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
        place = lambda i: F.when(i < a, i).otherwise(a + F.pmod(i - a, p))
        return F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(w, place(i).cast("int"))), " ")

    # transform over one element names the words, which are split once
    edited = F.get(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, periodic(w)).otherwise("")), 0)
    return F.when(F.pmod(h, F.lit(10)) == 0, edited).otherwise(F.col(text))


def op13(docs: DataFrame) -> DataFrame:
    """Runs and collapsed texts of all documents, as the longest run and digests; a null id counts as empty text."""
    texts = docs.select("doc_id", repeated("text", "doc_id").alias("text"))
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("length"), r["start"].alias("start"), r["period"].alias("period"))))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return (
        with_runs(texts).withColumn("best", best)
        .select(
            "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), (-F.col("best.length")).alias("length"),
            F.col("best.period").alias("period"), F.expr("(-1000 * best.length) div best.period").alias("exponent_milli"),
            F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"),
            F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
        )
    )
