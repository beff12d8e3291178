"""E01 reason codes as array expressions (no UDF).

Six weighted contributions in fixed list order; stable sort by |impact| desc;
take ``limit``; then drop zeros; round to 4 places (half-even).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskline import constants as C


def _impact(name: str, weight: float, cap: float | None, value: Column) -> Column:
    default = 1.0 if name == "amount_vs_user_average" else 0.0
    v = F.coalesce(value, F.lit(default))
    if cap is not None:
        v = F.least(v, F.lit(cap))
    return v * weight


def reason_factors(features: dict[str, Column], limit: int = C.REASON_LIMIT, friendly: bool = True) -> Column:
    """array<struct<feature, impact, direction>>, ordered by importance."""
    entries = [
        F.struct(
            F.abs(_impact(name, w, cap, features[name])).alias("mag"),
            F.lit(pos).alias("pos"),
            F.lit(C.FACTOR_LABELS[name] if friendly else name).alias("feature"),
            _impact(name, w, cap, features[name]).alias("impact"),
        )
        for pos, (name, w, cap) in enumerate(C.REASON_WEIGHTS)
    ]
    ordered = F.array_sort(
        F.array(*entries),
        lambda a, b: F.when(a["mag"] > b["mag"], -1).when(a["mag"] < b["mag"], 1)
        .when(a["pos"] < b["pos"], -1).when(a["pos"] > b["pos"], 1).otherwise(0),
    )
    kept = F.filter(F.slice(ordered, 1, limit), lambda e: e["impact"] != 0)
    return F.transform(
        kept,
        lambda e: F.struct(
            e["feature"].alias("feature"),
            F.bround(e["impact"], 4).alias("impact"),
            F.lit("increases_risk").alias("direction"),
        ),
    )
