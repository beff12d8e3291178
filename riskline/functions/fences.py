"""Plan-shape helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fence(df: DataFrame) -> DataFrame:
    """Identity pass through a generator: predicates on the result are not pushed below it.

    Used after expensive, multiply-referenced projections (JSON parsing): without
    it Catalyst substitutes the projection into a later filter and re-evaluates
    the whole parse inside the predicate and again above it.
    """
    return df.select(F.inline(F.array(F.struct(*[F.col(c) for c in df.columns]))))
