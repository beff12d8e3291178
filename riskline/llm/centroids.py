"""Exact centroid clustering of integer vectors, with centroids filtered by n-simplex projection.

The starting centroids serve as pivots.  The distances of a vector to the pivots are taken once and fix a point over
the simplex that the pivots span: its place in their hull and its height above it (the apex).  Vectors are staged with
their apexes.  For two vectors with apexes (x, a) and (y, b) the squared distance lies between |x - y|^2 + (a - b)^2
and |x - y|^2 + (a + b)^2, so a round projects its centroids in the same way and keeps, for every vector, those whose
lower bound doesn't pass the smallest upper bound.  Only they are compared exactly, in integers.

A round is one pass over the staged vectors.  Tasks hand back sums and counts of every cluster, so that what is shuffled and
what reaches the driver is (centroids x components) numbers whatever the input; a cluster that holds a third of all
rows is no larger than the others there.

Defined results: vectors that are null, of another length, or hold null or non-finite components take no part; rows
repeated under one id are vectors of their own; rows without an id take part but start no cluster as long as there are
enough others; ties between starting vectors of one id go to the smaller vector; ties between centroids to the smaller
number; with fewer vectors than centroids there are as many centroids as vectors; a cluster that stays empty keeps its
centroid; an empty table gives no rows; other columns are not read.  Results are exact while sums of squared distances
stay below 2**63.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskline.llm.common import Scratch, tidy
from riskline.llm.topk import integers

#: Vectors that a task compares at once.
ROWS = 4096
#: A pivot counts if its squared height over those before it is at least this share of its squared distance.
FLAT = 1e-6
#: Relative slack of bounds computed in floating point.
SLACK = 1e-8


class Simplex:
    """The simplex of some pivots (rows of integers); pivots that lie in the hull of the earlier ones are left out."""

    def __init__(self, pivots: np.ndarray):
        self.pivots = pivots[:1]
        self.base = np.zeros((0, 0))  # row i: coordinates of pivot i + 1, the first pivot is the origin
        for p in pivots[1:]:
            place, height = self.apex(squared(p[None], self.pivots))
            away = float(((p - pivots[0]).astype(float) ** 2).sum())
            if height[0] ** 2 <= FLAT * away:
                continue
            n = len(self.base)
            grown = np.zeros((n + 1, n + 1))
            grown[:n, :n] = self.base
            grown[n, :n], grown[n, n] = place[0], height[0]
            self.base, self.pivots = grown, np.concatenate([self.pivots, p[None]])

    def apex(self, distances: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places in the hull, heights) of vectors, by their squared distances to the pivots."""
        d = distances.astype(float)
        # |v|^2 - |v - p|^2 + |p|^2 = 2 v.p for every pivot p, seen from the first one
        right = (d[:, :1] - d[:, 1:] + (self.base**2).sum(axis=1)[None]) / 2
        place = np.linalg.solve(self.base, right.T).T if len(self.base) else right
        return place, np.sqrt(np.maximum(d[:, 0] - (place**2).sum(axis=1), 0))


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of every row of a to every row of b, exact."""
    return np.stack([((a - x) ** 2).sum(axis=1) for x in b], axis=1) if len(b) else np.zeros((len(a), 0), np.int64)


def bounds(place: np.ndarray, height: np.ndarray, to_place: np.ndarray, to_height: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the squared distances between vectors and centroids, by their apexes."""
    inside = (place**2).sum(axis=1)[:, None] + (to_place**2).sum(axis=1)[None] - 2 * place @ to_place.T
    size = inside + height[:, None] ** 2 + to_height[None] ** 2
    slack = SLACK * ((place**2).sum(axis=1)[:, None] + (to_place**2).sum(axis=1)[None] + height[:, None] ** 2 + to_height[None] ** 2 + 1)
    twice = 2 * height[:, None] * to_height[None]
    return size - twice - slack, size + twice + slack


def nearest(x: np.ndarray, place: np.ndarray, height: np.ndarray, centroids: np.ndarray, simplex: Simplex) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(nearest centroid, squared distance, centroids compared exactly) of every vector; ties to the smaller number."""
    low, high = bounds(place, height, *simplex.apex(squared(centroids, simplex.pivots)))
    near = low <= high.min(axis=1)[:, None]
    row, number = np.nonzero(near)
    exact = np.full(near.shape, np.iinfo(np.int64).max)
    for at in range(0, len(row), ROWS):
        r, c = row[at : at + ROWS], number[at : at + ROWS]
        exact[r, c] = ((x[r] - centroids[c]) ** 2).sum(axis=1)
    best = exact.argmin(axis=1)
    return best, exact[np.arange(len(x)), best], near.sum(axis=1)


def matrix(column: pa.Array, width: int | None = None) -> np.ndarray:
    """List column as rows of a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), width if width is not None else -1)


def start_key(vec_id: Column) -> Column:
    """Order of the vectors among which the first ones are the starting centroids."""
    return F.sha2(F.concat(F.lit("1:"), vec_id.cast("string")), 256)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


class Clustering:
    """Staged vectors with their apexes, and passes over them."""

    def __init__(self, vectors: DataFrame, k: int, dims: int, scale: int):
        spark = vectors.sparkSession
        self.scratch, self.dims = Scratch(spark, "centroids"), dims
        whole = (F.size("embedding") == dims) & F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
        rows = vectors.where(whole).select("vec_id", integers(F.col("embedding"), scale).alias("v"))
        first = rows.orderBy(start_key(F.col("vec_id")).asc_nulls_last(), "v").limit(k).collect()
        self.centroids = np.array([r["v"] for r in first], np.int64).reshape(-1, dims)
        if not len(first):
            return
        self.simplex = simplex = Simplex(self.centroids)

        def project(batches):
            for part in _parts(batches):
                place, height = simplex.apex(squared(matrix(part.column("v"), dims), simplex.pivots))
                flat = pa.array(np.concatenate([place, height[:, None]], axis=1).reshape(-1))
                ends = pa.array(np.arange(part.num_rows + 1, dtype=np.int32) * (place.shape[1] + 1))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.ListArray.from_arrays(ends, flat)], ["vec_id", "v", "apex"])

        self.rows = self.scratch.write(rows.mapInArrow(tidy(project), "vec_id long, v array<bigint>, apex array<double>"), "vectors")

    def assign(self) -> DataFrame:
        """(vec_id, cluster, distance, compared) of every vector, by the present centroids."""
        centroids, find = self.centroids, _Finder(self.dims, self.simplex)

        def run(batches):
            for part in _parts(batches):
                _, best, distance, compared = find(part, centroids)
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), pa.array(best.astype(np.int32)), pa.array(distance), pa.array(compared.astype(np.int32))],
                    ["vec_id", "cluster", "distance", "compared"],
                )

        return self.rows.mapInArrow(tidy(run), "vec_id long, cluster int, distance long, compared int")

    def move(self) -> None:
        """One round: every centroid that has vectors becomes the floor of their mean."""
        centroids, find, dims = self.centroids, _Finder(self.dims, self.simplex), self.dims

        def run(batches):
            total, count = np.zeros(centroids.shape, np.int64), np.zeros(len(centroids), np.int64)
            for part in _parts(batches):
                x, best, _, _ = find(part, centroids)
                np.add.at(total, best, x)
                count += np.bincount(best, minlength=len(centroids))
            used = np.flatnonzero(count)
            ends = pa.array(np.arange(len(used) + 1, dtype=np.int32) * dims)
            sums = pa.ListArray.from_arrays(ends, pa.array(total[used].reshape(-1)))
            yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(count[used]), sums], ["cluster", "n", "sums"])

        made = self.rows.mapInArrow(tidy(run), "cluster int, n long, sums array<bigint>")
        added = made.select("cluster", "n", F.posexplode("sums").alias("at", "x")).groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
        moved = centroids.copy()
        for r in added.collect():  # centroids x components numbers
            moved[r["cluster"], r["at"]] = r["x"] // r["n"]
        self.centroids = moved


class _Finder:
    """Nearest centroids of a batch; what a task needs of a Clustering."""

    def __init__(self, dims: int, simplex: Simplex):
        self.dims, self.simplex = dims, simplex

    def __call__(self, part: pa.RecordBatch, centroids: np.ndarray) -> tuple[np.ndarray, ...]:
        x, apex = matrix(part.column("v"), self.dims), matrix(part.column("apex"), len(self.simplex.pivots))
        return (x, *nearest(x, apex[:, :-1], apex[:, -1], centroids, self.simplex))


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64) -> DataFrame:
    """vec_id, cluster, distance, compared, cluster_inertia, inertia and centroid_sha256 of every vector that takes part."""
    spark: SparkSession = vectors.sparkSession
    job = Clustering(vectors, k, dims, scale)
    if not len(job.centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, compared int, cluster_inertia long, inertia long, centroid_sha256 string")
    for _ in range(rounds):
        job.move()
    found = job.scratch.write(job.assign(), "assigned")
    inertia = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # a row per centroid
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in job.centroids.tolist()]

    def of_cluster(values: list, kind: str) -> Column:
        return F.element_at(F.array(*[F.lit(x).cast(kind) for x in values]), F.col("cluster") + 1)

    return found.select(
        "vec_id", "cluster", "distance", "compared",
        of_cluster([inertia.get(c, 0) for c in range(len(digest))], "long").alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"),
        of_cluster(digest, "string").alias("centroid_sha256"),
    )
