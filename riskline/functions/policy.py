"""Probability model and decision policy as column expressions.

Every function takes and returns ``Column`` so batch and streaming plans share
one definition and stay inside whole-stage codegen.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskline import constants as C


@dataclass(frozen=True)
class Policy:
    """Thresholds and rule settings; review < block is enforced."""

    review_threshold: float = C.REVIEW_THRESHOLD
    block_threshold: float = C.BLOCK_THRESHOLD
    velocity_review_count: int = C.VELOCITY_REVIEW_COUNT
    amount_ratio_review: float = C.AMOUNT_RATIO_REVIEW

    def __post_init__(self) -> None:
        if not 0 <= self.review_threshold < self.block_threshold <= 1:
            raise ValueError("thresholds must satisfy 0 <= review < block <= 1")

    @classmethod
    def resolve(cls, model_review: float | None = None, model_block: float | None = None,
                override_review: float | None = None, override_block: float | None = None) -> "Policy":
        """Model thresholds unless configuration overrides them."""
        review = override_review if override_review is not None else model_review
        block = override_block if override_block is not None else model_block
        return cls(review if review is not None else C.REVIEW_THRESHOLD,
                   block if block is not None else C.BLOCK_THRESHOLD)


def heuristic_probability(ratio: Column, n5m: Column, new_device: Column, new_country: Column,
                          impossible: Column) -> Column:
    """D03 bootstrap model: fixed logit, sigmoid.  Missing features count as their defaults."""
    logit = (
        F.lit(C.HEURISTIC_INTERCEPT)
        + F.least(F.coalesce(ratio, F.lit(1.0)), F.lit(15.0)) * 0.12
        + F.least(F.coalesce(n5m, F.lit(0.0)), F.lit(10.0)) * 0.22
        + F.coalesce(new_device, F.lit(0.0)) * 0.8
        + F.coalesce(new_country, F.lit(0.0)) * 0.7
        + F.coalesce(impossible, F.lit(0.0)) * 2.0
    )
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))


def checked_probability(p: Column) -> Column:
    """D01 guard: a probability outside [0, 1] (or NaN) fails the task."""
    return F.when((p >= 0) & (p <= 1), p).otherwise(
        F.raise_error(F.concat(F.lit("not a probability in [0, 1]: "), p.cast("string")))
    ).cast("double")


def risk_score(p: Column) -> Column:
    """Round-half-even of 100 p (``rint``), as int."""
    return F.rint(p * 100).cast("int")


def rule_reasons(features: dict[str, Column], policy: Policy = Policy()) -> Column:
    """D04 + D05 reasons, fixed order; fourth reason when impossible travel meets a new device."""
    impossible = F.coalesce(features["impossible_travel"], F.lit(0.0)) == 1
    base = F.array_compact(F.array(
        F.when(impossible, F.lit(C.RULE_IMPOSSIBLE_TRAVEL)),
        F.when(F.coalesce(features["transactions_last_5m"], F.lit(0.0)) >= policy.velocity_review_count,
               F.lit(C.RULE_BURST)),
        F.when(F.coalesce(features["amount_vs_user_average"], F.lit(0.0)) >= policy.amount_ratio_review,
               F.lit(C.RULE_LARGE_AMOUNT)),
    ))
    escalate = impossible & (F.coalesce(features["new_device"], F.lit(0.0)) == 1)
    return F.when(escalate, F.array_append(base, F.lit(C.RULE_TRAVEL_NEW_DEVICE))).otherwise(base)


def decision(p: Column, reasons: Column, policy: Policy = Policy()) -> Column:
    """D02 threshold decision with D05 escalation (never a downgrade)."""
    base = (F.when(p >= policy.block_threshold, F.lit("BLOCK"))
            .when(p >= policy.review_threshold, F.lit("MANUAL_REVIEW"))
            .otherwise(F.lit("APPROVE")))
    return (F.when(F.array_contains(reasons, C.RULE_TRAVEL_NEW_DEVICE), F.lit("BLOCK"))
            .when((F.size(reasons) > 0) & (base == "APPROVE"), F.lit("MANUAL_REVIEW"))
            .otherwise(base))


def alert_severity(decision_col: Column) -> Column:
    """HIGH for BLOCK, MEDIUM for MANUAL_REVIEW (alerts exist for non-APPROVE only)."""
    return F.when(decision_col == "BLOCK", F.lit("HIGH")).otherwise(F.lit("MEDIUM"))
