"""Exact top-k search by inner product: a Voronoi join over pivots.

Components are scaled to integers.  A bounded sample gives the pivots; every vector belongs to the cell of its
nearest pivot.  A summary per cell (size, radius, distances of the members nearest to the pivot) is all that reaches
the driver.  From the summaries each query gets a lower bound of its k-th best score (a member x of cell G scores at
least q.p - |q| d(x, p)) and the cells that can beat it (at most q.p + |q| radius); only those cells' blocks are
paired with its query group.  Queries go in groups and cells in blocks of bounded size, so a cell or a query group
that holds a third of all rows is spread over many tasks; each (group, block) pair is solved locally by one exact
matrix product and the winners are merged per query.

Defined results: vectors that are null, or hold null or non-finite components, and rows without an id take no part;
rows repeated under one id count once (the smallest vector); vectors of different length are compared as if padded
with zeros; ties go to the smaller id; with fewer than k candidates all are returned; an empty table gives no rows.
Scores are exact while the sums of products stay below 2**63.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskline.llm.common import Scratch

#: Pivots, rows they are chosen from, vectors of a block, queries of a group.
PIVOTS, PIVOT_SAMPLE, BLOCK, GROUP = 32, 1024, 4096, 1024
#: Relative slack of bounds computed in floating point.
SLACK = 1e-9


def integers(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component, x as double."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def usable(vector: Column) -> Column:
    """Not null, and every component is a finite number."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(finite, F.lit(False))


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first traversal; fewer if the sample has fewer distinct vectors."""
    points = sample.astype(float)
    chosen = [0]
    distance = ((points - points[0]) ** 2).sum(axis=1)
    while len(chosen) < n and distance.max() > 0:
        chosen.append(int(distance.argmax()))
        distance = np.minimum(distance, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    return points[chosen]


def scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Integer inner products: through doubles where every partial sum is exact there."""
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * max(queries.shape[1], 1)
    if most < 2**53:
        return (queries.astype(float) @ vectors.T.astype(float)).astype(np.int64)
    return queries @ vectors.T


def local_top(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(query, vector, score) of the k best of a block for every query, its own id left out, ties to the smaller id."""
    s = scores(queries, vectors)
    own = ids[None, :] == query_ids[:, None]
    s[own] = np.iinfo(np.int64).min
    keep = min(k, len(ids))
    least = np.partition(s, len(ids) - keep, axis=1)[:, len(ids) - keep]
    rows = []
    for i, q in enumerate(query_ids.tolist()):
        at = np.flatnonzero((s[i] >= least[i]) & ~own[i])
        at = at[np.lexsort((ids[at], -s[i, at]))][:keep]
        rows += [(q, int(ids[j]), int(s[i, j])) for j in at]
    return rows


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, pivots: int = PIVOTS, block: int = BLOCK, group: int = GROUP) -> DataFrame:
    """k best candidates by inner product for the rows of ``vectors`` (vec_id, embedding) that ``is_query`` marks."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "topk")
    made = vectors.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select("vec_id", integers(F.col("embedding")).alias("v"))
    rows = scratch.write(made.groupBy("vec_id").agg(F.min("v").alias("v")), "vectors")
    out = "query_id long, rank int, vec_id long, score long"
    dims = rows.agg(F.max(F.size("v"))).first()[0]
    if dims is None:
        return spark.createDataFrame([], out)
    rows = rows.select("vec_id", F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size("v"))).alias("v"))

    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOT_SAMPLE).collect()
    centre = spark.sparkContext.broadcast(choose_pivots(np.array([r["v"] for r in sample], np.int64).reshape(len(sample), -1), pivots))

    def place(batches):
        for part in batches:
            p = centre.value
            x = _matrix(part.column("v")).astype(float)
            d = np.maximum((x**2).sum(1)[:, None] - 2 * x @ p.T + (p**2).sum(1)[None], 0) if x.size else np.zeros((part.num_rows, len(p)))
            cell = d.argmin(axis=1)
            away = np.sqrt(((x - p[cell]) ** 2).sum(1)) if x.size else np.zeros(part.num_rows)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cell.astype(np.int32)), pa.array(away)], ["vec_id", "v", "cell", "away"])

    placed = scratch.write(rows.mapInArrow(place, "vec_id long, v array<bigint>, cell int, away double"), "placed")

    # summaries: one row per cell with its size, radius, queries, and the k + 1 members nearest to the pivot
    nearest = Window.partitionBy("cell", F.pmod(F.xxhash64("vec_id"), F.lit(64))).orderBy("away")
    near = placed.select("cell", "away", F.row_number().over(nearest).alias("n")).where(F.col("n") <= k + 1)
    near = near.groupBy("cell").agg(F.slice(F.sort_array(F.collect_list("away")), 1, k + 1).alias("near"))  # 64 (k + 1) at most
    totals = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("radius"), F.count(F.when(is_query, 1)).alias("queries"))
    summary = {r["cell"]: r for r in totals.join(near, "cell").collect()}  # as many rows as pivots

    cells = sorted(summary)
    blocks = {c: -(-summary[c]["n"] // block) for c in cells}
    # query groups: cells in the order of their pivots' first coordinate, filled up; a large cell takes several
    group_of, n_groups, filled = {}, 0, group
    for c in sorted(cells, key=lambda c: (tuple(centre.value[c][:1]), c)):
        parts = max(1, -(-summary[c]["queries"] // group))
        if parts > 1 or filled + summary[c]["queries"] > group:
            group_of[c] = (n_groups, parts)
            n_groups += parts
            filled = summary[c]["queries"] if parts == 1 else group
        else:
            group_of[c] = (n_groups - 1, 1)
            filled += summary[c]["queries"]
    bound = spark.sparkContext.broadcast(
        (cells, np.array([summary[c]["radius"] for c in cells]), [np.array(summary[c]["near"]) for c in cells])
    )

    def needed(batches):
        """Adds the cells that may hold one of a query's k best."""
        names, radius, near = bound.value
        p = centre.value[names]
        for part in batches:
            q = _matrix(part.column("v")).astype(float)
            dot = q @ p.T if q.size else np.zeros((part.num_rows, len(p)))
            norm = np.sqrt((q**2).sum(axis=1)) if q.size else np.zeros(part.num_rows)
            low = np.concatenate([dot[:, [g]] - norm[:, None] * d[None] for g, d in enumerate(near)], axis=1)
            # one of the k + 1 best may be the query itself
            kth = -np.partition(-low, k, axis=1)[:, k] if low.shape[1] > k else np.full(part.num_rows, -np.inf)
            high = dot + norm[:, None] * radius[None]
            keep = high >= (kth - SLACK * (np.abs(kth) + np.abs(high).max(axis=1) + 1))[:, None]
            lists = [np.array(names, np.int32)[row] for row in keep]
            ends = np.cumsum([0, *map(len, lists)]).astype(np.int32)
            flat = np.concatenate(lists) if lists else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.ListArray.from_arrays(ends, flat)], [*part.schema.names, "cells"])

    def by_cell(values: dict[int, int]) -> Column:
        return F.element_at(F.create_map(*[F.lit(x) for c in cells for x in (c, values[c])]), F.col("cell"))

    queries = placed.where(is_query).select(
        F.col("vec_id").alias("query_id"), "v",
        (by_cell({c: g for c, (g, _) in group_of.items()}) + F.pmod(F.xxhash64("vec_id"), by_cell({c: n for c, (_, n) in group_of.items()}))).cast("int").alias("g"),
    )
    asked = scratch.write(queries.mapInArrow(needed, "query_id long, v array<bigint>, g int, cells array<int>").select("query_id", "v", "g", F.explode("cells").alias("cell")), "asked")
    block_of = F.pmod(F.xxhash64("vec_id"), by_cell(blocks)).cast("int")
    wanted = asked.select(F.col("g").alias("to_g"), F.col("cell").alias("to_cell")).distinct()
    data = placed.select("vec_id", "v", F.col("cell").alias("to_cell"), block_of.alias("to_b")).join(wanted, "to_cell")
    asking = asked.withColumn("b", F.explode(F.sequence(F.lit(0), (by_cell(blocks) - 1).cast("int"))))

    def solve(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            found = local_top(_matrix(left.column("v")), left.column("query_id").to_numpy(), _matrix(right.column("v")), right.column("vec_id").to_numpy(), k)
        a = np.array(found, np.int64).reshape(-1, 3)
        return pa.table({"query_id": a[:, 0], "vec_id": a[:, 1], "score": a[:, 2]})

    local = asking.groupBy("g", "cell", "b").cogroup(data.groupBy("to_g", "to_cell", "to_b")).applyInArrow(solve, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return local.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
