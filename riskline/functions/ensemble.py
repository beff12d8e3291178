"""D08 and E02 without a model object: fitted models as node tables and the columns made from them.

A node table holds all trees of an ensemble in one list: feature (-1 for a leaf), threshold (values up to it go left),
children and value.  Scoring walks it with array functions; no ML transformer takes part, so the plan
is a projection like any other.  A linear model is a weight per feature.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column
from pyspark.sql import functions as F

LEAF = -1
_NODE = "array<struct<feature: int, threshold: double, left: int, right: int, value: double>>"


@dataclass
class NodeTable:
    """``kind``: 'mean' of the trees' values, 'logistic' of twice their sum, or 'linear' (logistic of weights and intercept)."""

    features: list[str]
    kind: str
    roots: list[int]
    nodes: list[list]  # feature, threshold, left, right, value
    depth: int = 0
    weights: list[float] | None = None
    intercept: float = 0.0

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> NodeTable:
        return NodeTable(**json.loads(text))


def _walk(node, nodes: list[list], value, depth: int = 0) -> tuple[int, int]:
    """Appends a JVM tree node and what is below it; (its number, depth of what is below)."""
    number = len(nodes)
    if node.getClass().getSimpleName() == "LeafNode":
        nodes.append([LEAF, 0.0, LEAF, LEAF, value(node)])
        return number, depth
    split = node.split()
    row = [split.featureIndex(), float(split.threshold()), LEAF, LEAF, 0.0]
    nodes.append(row)
    row[2], left = _walk(node.leftChild(), nodes, value, depth + 1)
    row[3], right = _walk(node.rightChild(), nodes, value, depth + 1)
    return number, max(left, right)


def node_table(pipeline: PipelineModel, features: list[str]) -> NodeTable:
    """The node table (or weights) of a fitted pipeline of this library; features are numeric, splits are thresholds."""
    model = pipeline.stages[-1]
    kind = type(model).__name__
    if kind == "LogisticRegressionModel":
        scale, shift = [1.0] * len(features), [0.0] * len(features)
        for stage in pipeline.stages:
            if type(stage).__name__ == "StandardScalerModel":
                scale, shift = [float(x) or 1.0 for x in stage.std], [float(x) for x in stage.mean]
        weights = [float(w) / s for w, s in zip(model.coefficients, scale, strict=True)]
        return NodeTable(features, "linear", [], [], weights=weights,
                         intercept=float(model.intercept) - sum(w * m for w, m in zip(weights, shift, strict=True)))
    roots, nodes, depth = [], [], 0
    forest = kind == "RandomForestClassificationModel"
    for tree, weight in zip(model.trees, model.treeWeights, strict=True):
        if forest:  # share of the positive class in the leaf
            def value(leaf):
                stats = list(leaf.impurityStats().stats())
                return float(stats[1]) / (sum(stats) or 1.0)
        else:
            def value(leaf, weight=weight):
                return float(leaf.prediction()) * weight
        root, below = _walk(tree._java_obj.rootNode(), nodes, value)
        roots.append(root)
        depth = max(depth, below)
    return NodeTable(features, "mean" if forest else "logistic", roots, nodes, depth)


def _inputs(table: NodeTable) -> list[Column]:
    return [F.coalesce(F.nanvl(F.col(f).cast("double"), F.lit(0.0)), F.lit(0.0)) for f in table.features]


def _literal(rows: list, kind: str) -> Column:
    """A list as one literal: the optimiser folds the parse."""
    return F.from_json(F.lit(json.dumps(rows)), kind)


def raw_probability(table: NodeTable) -> Column:
    """The model's probability of fraud from the feature columns; missing features count as 0."""
    if table.kind == "linear":
        terms = [F.lit(w) * x for w, x in zip(table.weights, _inputs(table), strict=True)]
        return 1 / (1 + F.exp(-(sum(terms[1:], terms[0]) + F.lit(table.intercept))))
    names = ("feature", "threshold", "left", "right", "value")
    nodes = _literal([dict(zip(names, n, strict=True)) for n in table.nodes], _NODE)
    x = F.array(*_inputs(table))

    def step(node: Column, _: Column) -> Column:
        at = nodes[node]
        return F.when(at["feature"] == LEAF, node).when(x[at["feature"]] <= at["threshold"], at["left"]).otherwise(at["right"])

    def leaf(root: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.lit(max(table.depth, 1))), root, step) if table.depth else root

    total = F.aggregate(_literal(table.roots, "array<int>"), F.lit(0.0), lambda s, root: s + nodes[leaf(root)]["value"])
    return total / len(table.roots) if table.kind == "mean" else 1 / (1 + F.exp(-2 * total))


@dataclass
class Box:
    """A leaf: its value and, per feature on its path, the interval (low, high] that leads there."""

    value: float
    bounds: list[tuple[str, float, float]]


def boxes(table: NodeTable) -> list[Box]:
    """The leaves of a tree ensemble; a row's (unsquashed) score is the sum of the values of the boxes that it lies in."""
    share = 1.0 / len(table.roots) if table.kind == "mean" else 1.0
    out: list[Box] = []

    def down(number: int, bounds: dict[str, tuple[float, float]]) -> None:
        feature, threshold, left, right, value = table.nodes[number]
        if feature == LEAF:
            out.append(Box(value * share, [(f, *bounds[f]) for f in sorted(bounds)]))
            return
        name = table.features[feature]
        low, high = bounds.get(name, (float("-inf"), float("inf")))
        down(left, bounds | {name: (low, min(high, threshold))})
        down(right, bounds | {name: (max(low, threshold), high)})

    for root in table.roots:
        down(root, {})
    return out
