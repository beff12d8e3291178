"""riskline: payment-risk analytics expressed as Spark DataFrame plans.

Sub-packages
------------
sources    table readers, the events/orders -> transactions adapter, sinks
functions  column expressions (policy, reason codes, geo, contract rules)
operators  DataFrame -> DataFrame building blocks (features, drift, cases, ...)
plans      composed jobs (scoring, training, query registry with SQL twins)
streaming  Structured Streaming pipeline (validate, dedup, state, score, sink)
"""

__all__ = ["session"]
