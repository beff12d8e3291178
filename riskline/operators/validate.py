"""Validation, cleaning and enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskline import constants as C
from riskline.functions.contract import contract_rules, parse_fields
from riskline.functions.fences import fence

RAW_REQUIRED = ["TRANSACTION_ID", "TX_DATETIME", "CUSTOMER_ID", "TERMINAL_ID", "TX_AMOUNT", "TX_FRAUD"]


def validate_payloads(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """V01 + V02: parse and check every payload; normalised fields plus ``errors`` / ``valid``."""
    parsed = parse_fields(raw, payload)
    errors, fields = contract_rules()
    out = parsed.select(*raw.columns, errors.alias("errors"), *[c.alias(n) for n, c in fields.items()])
    return fence(out.withColumn("valid", F.size("errors") == 0))


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid transactions in the contract schema + us, dead letters with original payload and error)."""
    good = checked.where(F.col("valid")).select(
        *C.TRANSACTION_KEYS, F.unix_micros("timestamp").alias("us"),
        *[c for c in ("source_seq",) if c in checked.columns])
    bad = checked.where(~F.col("valid")).select(
        *[c for c in ("source_seq",) if c in checked.columns],
        F.col("payload").alias("original_payload"), F.array_join("errors", "|").alias("error"), "errors")
    return good, bad


def raw_source_from_events(events: DataFrame) -> DataFrame:
    """Raw training-source schema (TRANSACTION_ID, TX_DATETIME, CUSTOMER_ID, TERMINAL_ID, TX_AMOUNT, TX_FRAUD)."""
    k, u = F.col("event_id"), F.col("user_id")
    takeover = F.pmod(k, F.lit(97)) == 0
    return events.select(
        k.alias("TRANSACTION_ID"),
        F.col("ts").cast("timestamp").alias("TX_DATETIME"),
        u.alias("CUSTOMER_ID"),
        F.pmod(k * 7919 + u * 31, F.lit(500)).alias("TERMINAL_ID"),
        F.col("value").alias("TX_AMOUNT"),
        (takeover | (F.pmod(k, F.lit(37)) == 0)).cast("int").alias("TX_FRAUD"),
    )


def check_source(raw: DataFrame) -> DataFrame:
    """One row per check (check, failures); the caller raises when any failure > 0.

    Missing columns are reported without touching the data; the other checks
    are one aggregate pass plus one grouped count for duplicate ids.
    """
    spark = raw.sparkSession
    missing = sorted(set(RAW_REQUIRED) - set(raw.columns))
    if missing:
        return spark.createDataFrame([("missing_columns:" + ",".join(missing), len(missing))],
                                     "check string, failures long")
    dup = raw.groupBy("TRANSACTION_ID").count().where(F.col("count") > 1).agg(
        F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("long").alias("v"))
    agg = raw.agg(
        F.count(F.when(F.col("TX_AMOUNT") < 0, 1)).alias("negative_amount"),
        F.count(F.when(~F.coalesce(F.col("TX_FRAUD").isin(0, 1), F.lit(False)), 1)).alias("non_binary_target"),
    )
    long = agg.select(F.explode(F.array(
        F.struct(F.lit("negative_amount").alias("check"), F.col("negative_amount").cast("long").alias("failures")),
        F.struct(F.lit("non_binary_target").alias("check"), F.col("non_binary_target").cast("long").alias("failures")),
    )).alias("x")).select("x.*")
    return long.unionByName(dup.select(F.lit("duplicate_id").alias("check"), F.col("v").alias("failures")))


def clean_source(raw: DataFrame) -> DataFrame:
    """Drop zero-amount rows."""
    return raw.where(F.col("TX_AMOUNT") > 0)


def enrich(raw: DataFrame) -> DataFrame:
    """Raw source -> transaction columns (names, categories, geography by modulo rules).

    Fraud rows get another country ((u + 2) mod 5) and a one-off device
    (takeover-<id>).  These label-conditioned columns are never model inputs.
    """
    u, m = F.col("CUSTOMER_ID").cast("long"), F.col("TERMINAL_ID").cast("long")
    fraud = F.col("TX_FRAUD") == 1

    def pick(values, idx):
        return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))

    return raw.select(
        F.col("TRANSACTION_ID").cast("string").alias("transaction_id"),
        F.col("TX_DATETIME").alias("timestamp"),
        F.unix_micros("TX_DATETIME").alias("us"),
        F.format_string("user-%05d", u).alias("user_id"),
        F.format_string("merchant-%05d", m).alias("merchant_id"),
        F.col("TX_AMOUNT").cast("double").alias("amount"),
        F.col("TX_FRAUD").alias("is_fraud"),
        pick(C.CATEGORIES, F.pmod(m, F.lit(len(C.CATEGORIES)))).alias("merchant_category"),
        pick(C.COUNTRIES, F.when(fraud, F.pmod(u + 2, F.lit(5))).otherwise(F.pmod(u, F.lit(5)))).alias("country"),
        F.when(fraud, F.concat(F.lit("takeover-"), F.col("TRANSACTION_ID").cast("string")))
        .otherwise(F.format_string("device-%05d", u)).alias("device_id"),
        F.concat(F.lit("192.0.2."), (F.pmod(u, F.lit(253)) + 1).cast("string")).alias("ip_address"),
        pick(C.CHANNELS, F.pmod(m, F.lit(3))).alias("channel"),
    )


def check_training_frame(df: DataFrame, features: list[str] = C.MODEL_FEATURES) -> DataFrame:
    """Missing columns and null / NaN counts per model feature (check, failures)."""
    spark = df.sparkSession
    need = features + ["is_fraud", "amount"]
    missing = sorted(set(need) - set(df.columns))
    if missing:
        return spark.createDataFrame([("missing_columns:" + ",".join(missing), len(missing))],
                                     "check string, failures long")
    agg = df.agg(*[F.count(F.when(F.col(f).isNull() | F.isnan(F.col(f)), 1)).alias(f) for f in features])
    return agg.select(F.explode(F.array(*[
        F.struct(F.lit(f"nan_{f}").alias("check"), F.col(f).cast("long").alias("failures")) for f in features
    ])).alias("x")).select("x.*")
