"""Exact k nearest neighbours of every row of a table among the others (metric space, integer vectors).

1. Equal vectors are one entry with their k + 1 smallest ids, so many copies of one vector are one row.
2. Pivots are drawn from the entries by hash, in number as the entries / ``PER_CELL`` (up to ``MOST_PIVOTS``, which
   bounds what is sent to every task): where rows are dense, pivots are too.  An entry belongs to the cell of its
   nearest pivot; a cell's summary is its size and radius.
3. Each entry asks its own cell first; its (k + 1)-th distance there bounds the search.
4. It then asks another cell only if the triangle inequality (distance to the pivot less the radius) or the plane
   between the two pivots leaves room for a closer row.  Cells are solved in blocks, queries in chunks of bounded
   size, each pair by exact integer distances.

Distances are squared Euclidean, exact while they stay below 2**63; ties go to the smaller id.  A row's neighbours are
as many as there are other rows, up to k.  Vectors have equal lengths and no nulls; ids are unique.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskline.session import materialize

#: Entries that a cell should hold, most pivots, entries of a block, queries of a chunk, numbers of a distance table.
PER_CELL, MOST_PIVOTS, BLOCK, CHUNK, TABLE = 256, 4096, 1024, 1024, 1 << 20
#: Relative slack of bounds computed in floating point.
SLACK = 1e-9
FOUND = "array<struct<distance: bigint, id: string>>"


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(flat) else np.zeros((len(column), 0), np.int64)


def _to_pivots(v: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of every vector to every pivot."""
    x, p = v.astype(float), pivots.astype(float)
    return np.sqrt(np.maximum((x**2).sum(1)[:, None] - 2 * x @ p.T + (p**2).sum(1)[None], 0))


def _slices(batches, width: int):
    rows = max(1, TABLE // max(width, 1))
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _assigner(pivots: np.ndarray):
    def place(batches):
        for part in _slices(batches, len(pivots)):
            v = _matrix(part.column("v"))
            cell = _to_pivots(v, pivots).argmin(axis=1)
            away = np.sqrt(((v - pivots[cell]) ** 2).sum(axis=1).astype(float))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cell.astype(np.int32)), pa.array(away)], [*part.schema.names, "cell", "away"])

    return place


def _asker(pivots: np.ndarray, cells: np.ndarray, radius: np.ndarray):
    """Adds the other cells in which a row as near as ``bound`` may lie (all of them where there is no bound yet)."""
    between = _to_pivots(pivots, pivots)

    def ask(batches):
        for part in _slices(batches, len(pivots)):
            own = part.column("cell").to_numpy()
            bound = part.column("bound").to_numpy(zero_copy_only=False).astype(float)
            reach = np.where(np.isnan(bound), np.inf, np.sqrt(bound))
            d = _to_pivots(_matrix(part.column("v")), pivots)
            at_own = d[np.arange(len(own)), own]
            apart = between[own][:, cells]
            plane = (d[:, cells] ** 2 - at_own[:, None] ** 2) / np.maximum(2 * apart, 1e-300)
            least = np.maximum(d[:, cells] - radius[None], plane)
            room = (least <= (reach + SLACK * (1 + d.max(axis=1)))[:, None]) & (cells[None] != own[:, None])
            row, to = np.nonzero(room)
            ends = np.searchsorted(row, np.arange(len(own) + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(cells[to].astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*part.columns, lists], [*part.schema.names, "cells"])

    return ask


def _solver(k: int):
    """Local answers: the k + 1 nearest ids that a block holds for every query of a chunk."""

    def solve(left: pa.Table, right: pa.Table) -> pa.Table:
        keys, found = [], []
        if left.num_rows and right.num_rows:
            order = pc.sort_indices(right, sort_keys=[("key", "ascending")])
            right = right.take(order)  # equal distances come in the order of the smallest id
            x, ids = _matrix(right.column("v")), right.column("ids").to_pylist()
            q, names = _matrix(left.column("v")), left.column("key").to_pylist()
            step = max(1, TABLE // max(len(x) * max(x.shape[1], 1), 1))
            for at in range(0, len(q), step):
                d = ((q[at : at + step, None, :] - x[None]) ** 2).sum(axis=2)
                near = np.argsort(d, axis=1, kind="stable")[:, : k + 1]
                for i, row in enumerate(near):
                    best = sorted((int(d[i, j]), name) for j in row for name in ids[j])[: k + 1]
                    keys.append(names[at + i])
                    found.append([{"distance": a, "id": b} for a, b in best])
        kind = pa.list_(pa.struct([("distance", pa.int64()), ("id", pa.string())]))
        return pa.table({"key": pa.array(keys, pa.string()), "found": pa.array(found, kind)})

    return solve


@dataclass
class NeighbourSearch:
    """Entries placed in cells; ``neighbours`` answers for all rows, ``asked`` counts the (entry, cell) pairs compared."""

    points: DataFrame
    k: int
    per_cell: int = PER_CELL
    block: int = BLOCK
    chunk: int = CHUNK

    def __post_init__(self):
        k = self.k
        by_id = Window.partitionBy("v").orderBy("id")
        few = self.points.select("id", "v").withColumn("n", F.row_number().over(by_id)).where(F.col("n") <= k + 1)
        entries = few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumn("key", F.col("ids")[0])
        entries = materialize(entries.select("key", "v", "ids"))
        self.entries = entries.count()
        wanted = max(1, min(MOST_PIVOTS, -(-self.entries // self.per_cell)))
        drawn = entries.select("key", "v").orderBy(F.xxhash64("key"), "key").limit(wanted).collect()
        self.pivots = np.array([r["v"] for r in drawn], np.int64)
        if not drawn:
            return
        self.placed = materialize(entries.mapInArrow(
            _assigner(self.pivots), "key string, v array<bigint>, ids array<string>, cell int, away double"))
        sizes = self.placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("radius"))
        self.summary = sorted(sizes.collect())  # a row per pivot at most

    def _numbers(self, counts: dict[int, int], per: int, name: str) -> DataFrame:
        """(to_cell, name): how many groups of ``per`` rows a cell needs; a row per pivot at most."""
        rows = [(int(c), max(1, -(-n // per))) for c, n in counts.items()]
        return F.broadcast(self.points.sparkSession.createDataFrame(rows, f"to_cell int, {name} int"))

    def _answers(self, asks: DataFrame) -> DataFrame:
        """(key, found) of rows (key, v, to_cell), one for every block of the cells asked."""
        asked = {r["to_cell"]: r["n"] for r in asks.groupBy("to_cell").agg(F.count(F.lit(1)).alias("n")).collect()}
        parts = self._numbers({r["cell"]: r["n"] for r in self.summary}, self.block, "parts")
        chunks = self._numbers(asked, self.chunk, "chunks")

        def dealt(n: str):
            return F.pmod(F.xxhash64("key"), F.col(n)).cast("int")

        def each(n: str):
            return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

        queries = asks.join(parts, "to_cell").join(chunks, "to_cell").select("key", "v", "to_cell", dealt("chunks").alias("q"), each("parts").alias("b"))
        queries = queries.toDF("key", "v", "to_cell", "q", "b")  # columns of their own, as both sides come from one table
        data = self.placed.withColumnRenamed("cell", "to_cell").join(parts, "to_cell").join(chunks, "to_cell")
        data = data.select("key", "v", "ids", "to_cell", dealt("parts").alias("b"), each("chunks").alias("q")).toDF("key", "v", "ids", "to_cell", "b", "q")
        groups = [x.groupBy("to_cell", "b", "q") for x in (queries, data)]
        return groups[0].cogroup(groups[1]).applyInArrow(_solver(self.k), f"key string, found {FOUND}")

    def _best(self, answers: DataFrame) -> DataFrame:
        every = F.array_sort(F.flatten(F.collect_list("found")))
        return answers.groupBy("key").agg(F.slice(every, 1, self.k + 1).alias("found"))

    def _search(self) -> tuple[DataFrame, DataFrame]:
        at_home = materialize(self._best(self._answers(self.placed.select("key", "v", F.col("cell").alias("to_cell")))))
        bounded = self.placed.select("key", "v", "cell").join(
            at_home.select("key", F.try_element_at("found", F.lit(self.k + 1))["distance"].alias("bound")), "key")
        cells = np.array([r["cell"] for r in self.summary])
        radius = np.array([r["radius"] for r in self.summary])
        asks = bounded.mapInArrow(_asker(self.pivots, cells, radius), "key string, v array<bigint>, cell int, bound bigint, cells array<int>")
        return at_home, materialize(asks.select("key", "v", F.explode("cells").alias("to_cell")))

    def asked(self) -> tuple[int, int]:
        """((entry, cell) pairs compared, pairs there are)."""
        return self.entries + self._search()[1].count(), self.entries * len(self.summary)

    def neighbours(self) -> DataFrame:
        """(id, neighbours) of every row: the other rows by distance, then id."""
        if not len(self.pivots):
            return self.points.select("id", F.lit(None).cast(FOUND).alias("neighbours"))
        at_home, asks = self._search()
        best = self._best(at_home.unionByName(self._answers(asks))) if not asks.isEmpty() else at_home
        of_entry = self.placed.select("key", "v").join(best, "key").select("v", "found")
        others = F.filter("found", lambda x: x["id"] != F.col("id"))
        return self.points.select("id", "v").join(of_entry, "v").select("id", F.slice(others, 1, self.k).alias("neighbours"))


def nearest_neighbours(points: DataFrame, k: int) -> DataFrame:
    """(id, neighbours) for a table of (id string, v array<bigint>)."""
    return NeighbourSearch(points, k).neighbours()
