"""Connected components of a link table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskline.llm.common import Scratch


class UnionFind:
    """Disjoint sets with path halving; the root of a set is its smallest member."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        p = self.parent
        while (up := p.setdefault(x, x)) != x:
            p[x] = x = p.setdefault(up, up)
        return x

    def union(self, a: int, b: int) -> bool:
        """Whether the two were apart."""
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
        return a != b


def forest(links: DataFrame) -> DataFrame:
    """Union-find inside each partition: one link (a, b) with a > b per member, b the root of its partition's tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = UnionFind()
        for part in batches:
            for a, b in zip(part.column("a").to_pylist(), part.column("b").to_pylist(), strict=True):
                sets.union(a, b)
        rows = np.array([(x, sets.find(x)) for x in list(sets.parent)], np.int64).reshape(-1, 2)
        rows = rows[rows[:, 0] != rows[:, 1]]
        yield pa.RecordBatch.from_arrays([pa.array(rows[:, 0]), pa.array(rows[:, 1])], ["a", "b"])

    return links.select("a", "b").mapInArrow(run, "a long, b long")


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root): root is the smallest node reachable; nodes without a link are absent.

    Partitions first reduce their links to trees; then every node takes the smallest label among its neighbours and
    follows that label's own label, until nothing changes.  All of it are joins and minima over the link table, each
    round is written to the shared folder, and nothing is collected but the number of changes.
    """
    trees = scratch.write(forest(links), "trees")
    both = trees.select("a", "b").union(trees.select("b", "a"))
    labels = scratch.write(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("root")), "labels")
    while True:
        lower = both.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        moved = labels.join(lower, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        jump = labels.select(F.col("node").alias("root"), F.col("root").alias("next"))
        moved = scratch.write(moved.join(jump, "root", "left").select("node", "old", F.coalesce(F.least("root", "next"), "root").alias("root")), "labels")
        if moved.where("old <> root").isEmpty():
            return moved.select("node", "root")
        labels = moved.select("node", "root")
