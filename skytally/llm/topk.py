"""Exact top-k search by an impact-ordered index, a score at a time.

A vector's component is an integer. Per dimension the index lists rows by how far their component lies
above the dimension's least value (for queries that are positive there) or below its greatest (for
negative ones), so all contributions are products of non-negative numbers and a query's score is a
constant plus their sum. The distances, the impacts, are quantised to ``LEVELS`` levels; rows of one
dimension, direction and level are a posting segment.

A query processes segments by descending product of its own component and the segment's impact, adding
the product to its rows' accumulators: lower bounds of their scores. An upper bound adds what
quantising hid and, for dimensions still to come, the largest impact not yet processed. It stops only
when the bounds prove that no other row can reach the k-th best; every row whose upper bound does
reach it is then scored exactly, in 64-bit integers.

Rows are dealt to blocks of ``BLOCK_ROWS`` by a hash of their id, each block an index of its own, and
queries to blocks of ``QUERY_ROWS``; each pair of blocks is a task's unit of work, never a pair of
rows. The k best of each block meet per query; that needs k rows from each block, cut again on the way.

Vectors that are null, empty, or hold null or non-finite components take no part, nor do vectors of a
length other than the queries'. Equal scores go to the smaller id. Equal ids are rows of their own, as
candidates and as queries, each with ``k`` ranks; a query's own row is every row of its id. A null id takes no part. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skytally.llm.store import saved

BLOCK_ROWS = 8192
QUERY_ROWS = 512
LEVELS = 8
#: Segments between two looks at the bounds.
LOOK = 128


class Index:
    """Posting segments of one block of rows, for each dimension and direction."""

    def __init__(self, rows: np.ndarray) -> None:
        self.rows = rows
        # products of whole numbers in doubles are exact, and fast, while no sum reaches 2 ** 53
        self.doubles = rows.astype(float) if rows.size and np.abs(rows).max() * rows.shape[1] < 1 << 26 else None
        self.low, self.high = rows.min(0), rows.max(0)
        self.quantum = np.maximum((self.high - self.low) // LEVELS + 1, 1)
        self.segments = [[], []]
        for up, impacts in ((0, rows - self.low), (1, self.high - rows)):
            level = impacts // self.quantum
            order = np.argsort(-level, 0, kind="stable")
            for d in range(rows.shape[1]):
                ordered = level[order[:, d], d]
                edges = np.flatnonzero(np.diff(ordered)) + 1
                at = np.concatenate([[0], edges])
                self.segments[up].append((ordered[at], np.split(order[:, d], edges)))

    def best(self, query: np.ndarray, own: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Exact scores of the k best rows but ``own``, and the rows."""
        weight = np.abs(query)
        plan = []
        for d in np.flatnonzero(weight):
            levels, members = self.segments[int(query[d] < 0)][d]
            # a segment of impact 0 adds nothing
            plan += [(int(weight[d]) * int(level) * int(self.quantum[d]), int(d), i) for i, level in enumerate(levels) if level]
        plan.sort(key=lambda x: -x[0])
        # what each dimension can still add to a row it has not reached, and what quantising hides at most
        hidden = weight * (self.quantum - 1)
        rest = np.zeros_like(weight)
        for d in np.flatnonzero(weight):
            levels, _ = self.segments[int(query[d] < 0)][d]
            rest[d] = weight[d] * levels[0] * self.quantum[d]
        sums = np.zeros(len(self.rows), np.int64)
        reach = rest.copy()
        allowed = ~own
        wanted = min(k, int(allowed.sum()))
        if not wanted:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        open_rows = np.full(rest.shape, len(self.rows))
        alive = allowed
        for at in range(0, len(plan), LOOK):
            for product, d, i in plan[at : at + LOOK]:
                levels, members = self.segments[int(query[d] < 0)][d]
                sums[members[i]] += product
                open_rows[d] -= len(members[i])
                following = int(levels[i + 1]) if i + 1 < len(levels) else 0
                reach[d] = weight[d] * following * self.quantum[d]
            # an upper bound for every row: every dimension not finished may still add its next level
            upper = int(reach[open_rows > 0].sum() + hidden.sum())
            bound = np.partition(sums[allowed], len(sums[allowed]) - wanted)[len(sums[allowed]) - wanted]
            alive = allowed & (sums + upper >= bound)
            if alive.sum() <= max(4 * k, 64):
                break
        found = np.flatnonzero(alive)
        if self.doubles is not None and weight.max() < 1 << 26:
            scores = (self.doubles[found] @ query.astype(float)).astype(np.int64)
        else:
            scores = self.rows[found] @ query
        order = np.lexsort((ids[found], -scores))[:wanted]
        return scores[order], found[order]


def integers(vector: str) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * 1024).cast("long"))


def usable(vector: str) -> Column:
    fine = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & fine


def nearest(rows: DataFrame, is_query: Column, k: int, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the k largest inner products of each row that ``is_query`` with all others."""
    whole = rows.filter(usable(vector) & F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("vec_id"), integers(vector).alias("v"), is_query.alias("is_query")
    )
    # queries of one id are told apart by a number
    copy = F.row_number().over(Window.partitionBy("vec_id").orderBy("v"))
    asked, others = whole.filter("is_query").withColumn("copy", copy), whole.filter("NOT is_query").withColumn("copy", F.lit(0))
    whole = saved(others.union(asked).withColumn("length", F.size("v")), "vectors")
    counts = whole.agg(F.count(F.lit(1)), F.count_if("is_query")).first()
    blocks, query_blocks = (-(-n // size) or 1 for n, size in zip(counts, (BLOCK_ROWS, QUERY_ROWS)))
    hashed = F.xxhash64("vec_id")
    asked = whole.filter("is_query").withColumn("q", F.pmod(hashed, F.lit(query_blocks)).cast("int"))
    packed = [F.collect_list(F.struct("vec_id", "copy", "v")).alias("members")]
    asked = asked.groupBy("length", "q").agg(*packed).withColumnRenamed("members", "queries")
    held = whole.withColumn("b", F.pmod(hashed, F.lit(blocks)).cast("int")).groupBy("length", "b").agg(*packed)
    # each block of rows meets each block of queries, a key for each pair: no block gathers all its partners
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    met = held.withColumn("q", every(query_blocks)).join(asked.withColumn("b", every(blocks)), ["length", "b", "q"])

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for members, queries in zip(frame["members"], frame["queries"]):
                ids, matrix = unpacked(members)
                order = np.argsort(ids, kind="stable")
                ids, index = ids[order], Index(matrix[order])
                parts = []
                for query_id, query, asked in zip(*unpacked(queries), queries):
                    scores, found = index.best(query, ids == query_id, ids, k)
                    parts.append(pd.DataFrame({"query_id": query_id, "copy": asked["copy"], "vec_id": ids[found], "score": scores}))
                yield pd.concat(parts)

    found = met.select("members", "queries").mapInPandas(search, "query_id long, copy int, vec_id long, score long")
    best_first = Window.partitionBy("query_id", "copy").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def unpacked(members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.array([m["vec_id"] for m in members], np.int64), np.stack([np.asarray(m["v"], np.int64) for m in members])


SQL = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS double)) AS bigint)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.r, q.vec_id AS query_id, r.vec_id,
    CAST(list_sum(list_transform(list_zip(q.v, r.v), lambda p: p[1] * p[2])) AS bigint) AS score
  FROM v q JOIN v r ON q.vec_id <> r.vec_id WHERE q.vec_id % 100 = 0),
best AS (SELECT *, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS int) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM best WHERE rank <= 10
"""


def op8(rows: DataFrame) -> DataFrame:
    return nearest(rows, F.col("vec_id") % 100 == 0, 10)
