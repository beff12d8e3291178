"""Platt scaling by Newton steps on sufficient statistics.

p = 1 / (1 + exp(a f + b)) against targets (n1 + 1) / (n1 + 2) and 1 / (n0 + 2).  The rows are summed up once per
(score, label); every step is one aggregate over that table: objective, gradient and second derivatives at the point it
tries.  Terms are added as decimals, so the sums do not depend on the order of tasks.  A step that does not lower the
objective enough is halved.  The objective is convex, and its minimum finite, as no target is 0 or 1.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskline.session import materialize

#: Most evaluations, gradient per row at which the search ends, least step.
EVALUATIONS, FLAT, LEAST_STEP = 100, 1e-11, 1e-10
_SUM = "decimal(38,16)"


@dataclass(frozen=True)
class Platt:
    """Parameters, the classes' sizes, the objective reached and the evaluations it took."""

    a: float
    b: float
    positives: int
    negatives: int
    objective: float
    evaluations: int


def start(positives: int, negatives: int) -> tuple[float, float]:
    return 0.0, math.log((negatives + 1.0) / (positives + 1.0))


def targets(positives: int, negatives: int) -> tuple[float, float]:
    """Targets of the positive and of the negative class."""
    return (positives + 1.0) / (positives + 2.0), 1.0 / (negatives + 2.0)


def _terms(f: Column, t: Column, a: float, b: float) -> dict[str, Column]:
    """Objective, gradient and second derivatives of one row at (a, b); exponents are never positive."""
    z = F.lit(a) * f + F.lit(b)
    small = F.exp(-F.abs(z))
    p = F.when(z >= 0, small / (1 + small)).otherwise(1 / (1 + small))
    slope, bend = t - p, p * (1 - p)
    loss = F.when(z >= 0, t * z).otherwise((t - 1) * z) + F.log1p(small)
    return {"loss": loss, "ga": f * slope, "gb": slope, "haa": f * f * bend, "hab": f * bend, "hbb": bend}


def fit(scored: DataFrame, raw: str = "raw_probability") -> Platt:
    """Parameters for rows with a score and a ``label``; rows without a score or label take no part."""
    counted = scored.where(F.col(raw).isNotNull() & F.col("label").isin(0, 1)).groupBy(F.col(raw).alias("f"), "label").agg(F.count(F.lit(1)).alias("n"))
    counted = materialize(counted)
    sizes = counted.agg(F.sum(F.when(F.col("label") == 1, F.col("n"))).alias("p"), F.sum(F.when(F.col("label") == 0, F.col("n"))).alias("n")).first()
    positives, negatives = int(sizes["p"] or 0), int(sizes["n"] or 0)
    high, low = targets(positives, negatives)
    target = F.when(F.col("label") == 1, F.lit(high)).otherwise(F.lit(low))

    def at(a: float, b: float) -> dict[str, float]:
        terms = _terms(F.col("f"), target, a, b)
        sums = counted.agg(*[F.sum((c * F.col("n")).cast(_SUM)).alias(k) for k, c in terms.items()]).first()
        return {k: float(sums[k]) for k in terms}

    a, b = start(positives, negatives)
    if not positives + negatives:
        return Platt(a, b, 0, 0, 0.0, 0)
    here, used, step = at(a, b), 1, 1.0
    while used < EVALUATIONS and max(abs(here["ga"]), abs(here["gb"])) > FLAT * (positives + negatives) and step >= LEAST_STEP:
        haa, hbb = here["haa"] + 1e-12, here["hbb"] + 1e-12
        det = haa * hbb - here["hab"] ** 2
        da = -(hbb * here["ga"] - here["hab"] * here["gb"]) / det
        db = -(haa * here["gb"] - here["hab"] * here["ga"]) / det
        tried = at(a + step * da, b + step * db)
        used += 1
        if tried["loss"] <= here["loss"] + 1e-4 * step * (here["ga"] * da + here["gb"] * db) + 1e-15 * abs(here["loss"]):
            a, b, here, step = a + step * da, b + step * db, tried, 1.0
        else:
            step /= 2
    return Platt(a, b, positives, negatives, here["loss"], used)
