"""Mixing sources to target weights by the cube method of balanced sampling.

Every source gets a target in words: its weight's part of a share of all words, at most ``CAP`` times
its own size, the excess going to the others by weight. A source that needs ``m`` times its words
takes every row ``floor(m)`` times; the rest is an inclusion probability, the same for all its rows,
and the cube method turns those into a sample that keeps both the words and the rows of the source.

Flight: three undecided rows always admit a step that keeps both totals, namely along the null space
of the two constraints, until one row reaches 0 or 1. Rows are dealt to blocks of a source by a hash
of their key, some ``BLOCK`` rows each, so that a large source is many tasks; a block leaves two rows
undecided at most. Those meet in blocks of the next level, and so on, until one block per source is
left. Landing: the last two rows of a source are settled by draws, and a few exchanges among the rows of
its last block make up for the words these add or take.

Draws are keyed by source, level and block, so reruns agree whatever the partitioning.

Rows equal in key, source and size are one unit and share a decision. A null or empty text has size
0, is balanced as a row and adds no words; null keys and a null source are values like others; an
empty table gives none. Other columns are not read.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytally.llm.store import saved

WEIGHTS = (3, 1, 2)
SHARE, CAP = 1.5, 2.0
BLOCK = 512
#: Exchanges that may follow the last draws of a source.
EXCHANGES = 4
_NEAR = 1e-9


def words(text: str) -> Column:
    """Number of words: runs of anything but ASCII white space."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def ranked(df: DataFrame, order: Column, out: str) -> DataFrame:
    """``df`` with the place of each row in a total order, from 0: sorted by range, counted per range."""
    parts = saved(
        df.repartitionByRange(order).sortWithinPartitions(order)
        .withColumn("__part", F.spark_partition_id())
        .withColumn("__at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))),
        "ranked",
    )
    counts = sorted(parts.groupBy("__part").count().collect())  # a row for each partition
    firsts, total = {}, 0
    for part, count in counts:
        firsts[part], total = total, total + count
    first = F.lit(0).cast("long")
    if firsts:
        pairs = F.map_from_arrays(*[F.array(*[F.lit(v) for v in x]) for x in (firsts.keys(), firsts.values())])
        first = F.element_at(pairs, F.col("__part")).cast("long")
    return parts.withColumn(out, first + F.col("__at")).drop("__part", "__at")


def targets(sources: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """``source``, ``source_size``, ``rows`` with ``rank`` and ``target``. Adds up sources in Spark, a row a round."""
    named = ranked(sources, F.col("source").asc_nulls_last(), "rank").withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    )
    limit = cap * F.col("source_size")
    total, all_weights = named.agg(F.sum("source_size"), F.sum("weight")).first()
    want, level, capped = share * (total or 0), 0.0, -1
    if all_weights:
        level = want / all_weights
    while all_weights:
        over = F.col("weight") * level > limit
        now, fixed, free = named.agg(
            F.count_if(over), F.sum(F.when(over, limit)), F.sum(F.when(~over, F.col("weight")))
        ).first()
        if now == capped or not free:
            break
        capped, level = now, (want - (fixed or 0.0)) / free
    return named.withColumn("target", F.least(F.col("weight") * level, limit)).drop("weight")


def flight(pi: list[float], n: list[int], size: list[int], rows: list[int], draw: random.Random) -> list[int]:
    """Moves ``pi`` of ``rows`` until two of them are undecided at most; keeps the sums of n * pi and n * size * pi."""
    active: list[int] = []

    def step(u: list[float]) -> None:
        up = min((1 - pi[k]) / x if x > 0 else pi[k] / -x for k, x in zip(active, u) if x)
        down = min(pi[k] / x if x > 0 else (1 - pi[k]) / -x for k, x in zip(active, u) if x)
        by = up if draw.random() * (up + down) < down else -down
        for k, x in zip(active, u):
            moved = pi[k] + by * x
            pi[k] = 0.0 if moved < _NEAR else 1.0 if moved > 1 - _NEAR else moved
        active[:] = [k for k in active if 0 < pi[k] < 1]

    for k in rows:
        if not 0 < pi[k] < 1:
            continue
        active.append(k)
        if len(active) == 3:
            a, b, c = (size[k] for k in active)
            d = (b - c, c - a, a - b) if a != b or b != c else (1, -1, 0)
            step([x / n[k] for x, k in zip(d, active)])
        if len(active) == 2 and size[active[0]] == size[active[1]]:
            step([1 / n[active[0]], -1 / n[active[1]]])
    return active


def land(pi: list[float], n: list[int], size: list[int], rows: list[int], draw: random.Random) -> None:
    """Decides all ``rows``: a flight, draws for the two it leaves, and exchanges that make up for the draws.

    An exchange turns two rows round, or one. Of all in the block the one that leaves the least error in
    words, then in rows, is made, while it helps and ``EXCHANGES`` times at most.
    """
    words, rows_of = np.array([n[k] * size[k] for k in rows], float), np.array([n[k] for k in rows], float)
    want = np.array([pi[k] for k in rows])
    for k in flight(pi, n, size, rows, draw):
        pi[k] = float(draw.random() < pi[k])
    got = np.array([pi[k] for k in rows])
    for _ in range(EXCHANGES if rows else 0):
        turn = 1 - 2 * got
        off, off_rows = (got - want) @ words, (got - want) @ rows_of
        # the diagonal turns one row round
        both = lambda x: np.add.outer(x, x) - np.diag(x)
        cost = np.abs(off + both(turn * words)) + 1e-3 * np.abs(off_rows + both(turn * rows_of))
        i, j = divmod(int(cost.argmin()), len(rows))
        if cost[i, j] >= abs(off) + 1e-3 * abs(off_rows) - _NEAR:
            break
        got[i], got[j] = (1 - got[i], 1 - got[j]) if i != j else (1 - got[i],) * 2
    for k, x in zip(rows, got):
        pi[k] = float(x)


def _settler(seed: int, level: int, last: bool) -> Callable[[tuple, pd.DataFrame], pd.DataFrame]:
    def settle(name: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "doc_id", "n"], na_position="last", ignore_index=True)
        undecided = np.flatnonzero((rows["pi"] > 0) & (rows["pi"] < 1))
        draw = random.Random(f"{seed} {level} {name[0]} {name[1]}")
        pi, n, size = (rows[c][undecided].tolist() for c in ("pi", "n", "size"))
        (land if last else flight)(pi, n, size, sorted(range(len(pi)), key=lambda k: -size[k]), draw)
        rows.loc[undecided, "pi"] = pi
        return rows

    return settle


def mixed(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
          weights: tuple = WEIGHTS, share: float = SHARE, cap: float = CAP, seed: int = 1) -> DataFrame:
    """A row for each unit (``doc_id, source, size``): how many rows it stands for and ``copies`` of each to take."""
    units = saved(
        docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), words(text).alias("size"))
        .groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("n")),
        "sizes",
    )
    sizes = units.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"), F.count(F.lit(1)).alias("units")
    )
    goal = saved(targets(sizes, weights, share, cap), "targets")
    of = goal.withColumnRenamed("source", "__source")
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    planned = (
        units.join(of, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
        .withColumn("__times", times + _NEAR)
        .withColumn("whole", F.floor("__times"))
        .withColumn("pi", F.col("__times") - F.col("whole"))
        .withColumn("pi", F.when(F.col("pi") < 2 * _NEAR, 0.0).otherwise(F.col("pi") - _NEAR))
        .withColumn("block", F.pmod(F.xxhash64("doc_id", "size"), F.ceil(F.col("units") / BLOCK)))
        .drop("__times", "units")
    )
    most = goal.agg(F.max("units")).first()[0] or 0
    blocks, level, left, parts = math.ceil(most / BLOCK), 0, planned, []
    while True:
        last = blocks <= 1

        left = saved(left.groupBy("rank", "block").applyInPandas(_settler(seed, level, last), left.schema), "flight")
        undecided = (F.col("pi") > 0) & (F.col("pi") < 1)
        parts.append(left.filter(~undecided))
        if last:
            break
        left = left.filter(undecided).withColumn("block", F.floor(F.col("block") / (BLOCK // 2)))
        blocks, level = math.ceil(blocks / (BLOCK // 2)), level + 1
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out.select(
        "doc_id", "source", "size", "n", "source_size", "target", (F.col("whole") + F.col("pi")).cast("int").alias("copies")
    )


def op1(docs: DataFrame) -> DataFrame:
    """A row for each document, with the words the mix takes of it."""
    each = mixed(docs).withColumn("__row", F.explode(F.sequence(F.lit(1), F.col("n"))))
    return each.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source")


def resampled(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """``docs`` with every row as often as the mix takes it, all columns kept."""
    plan = mixed(docs, key, text, source, **options).filter("copies > 0").select(
        F.col("doc_id").alias("__key"), F.col("source").alias("__source"), F.col("size").alias("__size"), "copies"
    ).withColumnRenamed("copies", "__copies")
    same = (
        F.col(key).eqNullSafe(F.col("__key")) & F.col(source).eqNullSafe(F.col("__source")) & (words(text) == F.col("__size"))
    )
    return docs.join(plan, same).withColumn("__row", F.explode(F.sequence(F.lit(1), "__copies"))).select(docs.columns)
