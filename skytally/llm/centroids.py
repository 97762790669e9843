"""Centroid clustering with exact assignments, pruned by Ptolemy's inequality over pivot pairs.

Vectors and centroids are whole numbers. Each round assigns every vector to its nearest centroid and
replaces every centroid that has vectors by the floor of their mean, component by component; ties go
to the centroid of the smaller number, and a centroid without vectors stays.

For points x, c and a pair of pivots p, q Ptolemy's inequality bounds a distance from below:

    d(x, c) d(p, q) >= | d(x, p) d(c, q) - d(x, q) d(c, p) |

Pivots are fixed over all rounds, so a vector's distances to them are computed once and kept beside it
as whole numbers (squared). A round bounds the distances of a vector to all centroids, computes the
one of the least bound exactly, and then, centroid by centroid, those the bound does not rule out.
Roots and products are rounded, so a bound is made smaller by ``SLACK`` of its larger term and again
as a whole before it may rule anything out; it must then be above the best distance, never equal to it.
Results are therefore those of comparing everything, whatever the pivots.

A task reduces its rows to one row a centroid (a count and sums), which are added up by Spark; only
``k`` centroids and ``2 * PAIRS`` pivots reach the driver. Vectors are written once, to the shared
folder, with their pivot distances; each round reads that table.

A vector takes part if it has exactly ``size`` components, none null or non-finite. Components are
whole numbers of at most 27 bits: larger ones count as 2**27 (smaller than -2**27 likewise), so that
squared distances are 64-bit numbers. Equal ids are rows of their own, assigned each; among the first
centroids ties of the hash go to the smaller vector. A null id is a row like others, ordered last among
the first centroids. With fewer rows than ``k`` there are fewer centroids; an empty table gives no rows.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytally.llm.store import saved

PAIRS = 6
SLACK = 1e-9
_LARGEST = 1 << 27


def integers(vector: str, scale: int) -> Column:
    """Components times ``scale``, rounded down."""
    bound = F.lit(float(_LARGEST))
    return F.transform(vector, lambda x: F.greatest(-bound, F.least(bound, F.floor(x.cast("double") * scale).cast("double"))).cast("int"))


def usable(vector: str, size: int) -> Column:
    fine = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    return F.coalesce((F.size(vector) == size) & fine, F.lit(False))


def squared(rows: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Squared distances of rows to a point, exact."""
    difference = rows - point
    return np.einsum("ij,ij->i", difference, difference)


class Pivots:
    """Pairs of pivots, and the bounds they give."""

    def __init__(self, points: np.ndarray) -> None:
        self.points = points
        pairs = [(i, i + 1) for i in range(0, len(points) - 1, 2)]
        apart = [float(np.sqrt(float(squared(points[i : i + 1], points[j])[0]))) for i, j in pairs]
        self.pairs = [(i, j, a) for (i, j), a in zip(pairs, apart) if a > 0]

    def distances(self, rows: np.ndarray) -> np.ndarray:
        """Squared distances to all pivots, a column each."""
        return np.stack([squared(rows, p) for p in self.points], 1) if len(self.points) else np.zeros((len(rows), 0), np.int64)

    def bounds(self, of_rows: np.ndarray, of_centroids: np.ndarray) -> np.ndarray:
        """Numbers that no squared distance of row to centroid is below."""
        x, c = np.sqrt(of_rows.astype(float)), np.sqrt(of_centroids.astype(float))
        out = np.zeros((len(x), len(c)))
        for i, j, apart in self.pairs:
            left, right = np.outer(x[:, i], c[:, j]), np.outer(x[:, j], c[:, i])
            np.maximum(out, (np.abs(left - right) - SLACK * np.maximum(left, right)) / apart, out=out)
        return out * out * (1 - SLACK)


def assigned(rows: np.ndarray, of_rows: np.ndarray, centroids: np.ndarray, pivots: Pivots) -> tuple[np.ndarray, np.ndarray, int]:
    """The nearest centroid of each row, the squared distance, and how many distances were computed."""
    bounds = pivots.bounds(of_rows, pivots.distances(centroids))
    nearest = bounds.argmin(1)
    difference = rows - centroids[nearest]
    best = np.einsum("ij,ij->i", difference, difference)
    computed, start = len(rows), nearest.copy()
    for c, centroid in enumerate(centroids):
        left = np.flatnonzero((bounds[:, c] <= best) & (start != c))
        distance = squared(rows[left], centroid)
        computed += len(left)
        closer = (distance < best[left]) | ((distance == best[left]) & (c < nearest[left]))
        best[left[closer]], nearest[left[closer]] = distance[closer], c
    return nearest, best, computed


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def _measured(vectors: DataFrame, pivots: Pivots, size: int) -> DataFrame:
    """``vectors`` with squared distances to the pivots."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = pivots.distances(_matrix(batch.column("v"), size))
                offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * found.shape[1])
                lists = pa.ListArray.from_arrays(offsets, pa.array(found.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "p"])

    return vectors.mapInArrow(measure, "id long, v array<int>, p array<bigint>")


def _sums(vectors: DataFrame, centroids: np.ndarray, pivots: Pivots, size: int) -> dict[int, tuple[int, list[int]]]:
    """For each centroid that has vectors their number and the sums of their components."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
        for batch in batches:
            if batch.num_rows:
                rows = _matrix(batch.column("v"), size)
                nearest, _, _ = assigned(rows, _matrix(batch.column("p"), len(pivots.points)), centroids, pivots)
                counts += np.bincount(nearest, minlength=len(centroids))
                np.add.at(sums, nearest, rows)
        have = np.flatnonzero(counts)
        offsets = pa.array(np.arange(len(have) + 1, dtype=np.int32) * size)
        lists = pa.ListArray.from_arrays(offsets, pa.array(sums[have].ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(have), pa.array(counts[have]), lists], names=["c", "n", "s"])

    parts = vectors.mapInArrow(add, "c long, n long, s array<bigint>")
    total = parts.groupBy("c").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("s")[i]) for i in range(size)]).alias("s"))
    return {r.c: (r.n, r.s) for r in total.collect()}  # k rows


def _placed(vectors: DataFrame, centroids: np.ndarray, pivots: Pivots, size: int) -> DataFrame:
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows, of_rows = _matrix(batch.column("v"), size), _matrix(batch.column("p"), len(pivots.points))
                nearest, best, _ = assigned(rows, of_rows, centroids, pivots)
                columns = [batch.column("id"), pa.array(nearest.astype(np.int32)), pa.array(best)]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "cluster", "distance"])

    return vectors.mapInArrow(place, "id long, cluster int, distance long")


def _first(vectors: DataFrame, seed: int, n: int) -> np.ndarray:
    """The ``n`` rows of smallest hash of seed and id, in that order."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256)
    return np.array([r.v for r in vectors.orderBy(F.asc_nulls_last(hashed), "v").limit(n).select("v").collect()], np.int64)


def clustered(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 16, rounds: int = 3, size: int = 64, scale: int = 64, seed: int = 1
) -> tuple[DataFrame, np.ndarray]:
    """``id, cluster, distance`` (squared) of every usable vector after ``rounds`` rounds, and the final centroids.

    Pivots are the rows that follow the first centroids in the order of their hashes.
    """
    kept = df.filter(usable(vector, size)).select(F.col(key).cast("long").alias("id"), integers(vector, scale).alias("v"))
    first = _first(kept, seed, k + 2 * PAIRS)
    if not len(first):
        return kept.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), np.zeros((0, size), np.int64)
    # with few rows centroids serve as pivots as well
    centroids, pivots = first[:k], Pivots(first[-2 * PAIRS :])
    vectors = saved(_measured(kept, pivots, size), "centroids")
    for _ in range(rounds):
        centroids = centroids.copy()
        for c, (n, sums) in _sums(vectors, centroids, pivots, size).items():
            centroids[c] = [s // n for s in sums]
    return _placed(vectors, centroids, pivots, size), centroids


def op11(rows: DataFrame) -> DataFrame:
    spark = rows.sparkSession
    placed, centroids = clustered(rows)
    placed = saved(placed, "clusters")
    digests = [(c, hashlib.sha256(",".join(map(str, row)).encode()).hexdigest()) for c, row in enumerate(centroids.tolist())]
    of_cluster = placed.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()  # k rows
    inertia = {r.cluster: r.cluster_inertia for r in of_cluster}
    total = sum(inertia.values())
    table = spark.createDataFrame(
        [(c, inertia.get(c, 0), total, digest) for c, digest in digests], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    return placed.join(F.broadcast(table), "cluster").select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql(k: int = 16, rounds: int = 3) -> str:
    number = "greatest(-134217728, least(134217728, floor(64 * CAST(x AS double))))"
    parts = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST({number} AS bigint)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""c0 AS MATERIALIZED (
  SELECT c, v FROM (SELECT v, row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, v) - 1 AS c FROM kept) WHERE c < {k})""",
    ]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
  SELECT r, vec_id, v, nearest.d AS distance, nearest.c AS cluster FROM (
    SELECT r, any_value(vec_id) AS vec_id, any_value(v) AS v, min({{'d': d, 'c': c}}) AS nearest FROM (
      SELECT r, vec_id, kept.v, c, list_sum(list_transform(list_zip(kept.v, c{i}.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d FROM kept, c{i})
    GROUP BY r))""")
        if i < rounds:
            parts.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT c{i}.c, coalesce(m.v, c{i}.v) AS v FROM c{i} LEFT JOIN (
    SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY d) AS v FROM (
      SELECT cluster, d, CAST(sum(x) AS bigint) AS s, count(*) AS n
      FROM (SELECT cluster, unnest(v) AS x, unnest(range(64)) AS d FROM a{i}) GROUP BY ALL)
    GROUP BY cluster) m ON m.cluster = c{i}.c)""")
    return f"""
WITH {", ".join(parts)}
SELECT vec_id, CAST(cluster AS int) AS cluster, CAST(distance AS bigint) AS distance,
  CAST(sum(distance) OVER (PARTITION BY cluster) AS bigint) AS cluster_inertia, CAST(sum(distance) OVER () AS bigint) AS inertia,
  sha256(array_to_string(c{rounds}.v, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON c{rounds}.c = cluster"""


SQL = _sql()
