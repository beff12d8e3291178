"""Derive payment transactions from the driver tables.

No payment table is supplied, so ``events`` (and ``orders``, which carries
repeated customer/date pairs) are mapped onto the transaction contract with
integer arithmetic only.  The same rules are written in SQL in
``riskline.plans.sql_twins`` so DuckDB reproduces every value.

Rules (m = merchant number, u = user number, k = source id):
  m = (k * 7919 + u * 31) mod 500
  merchant_category = CATEGORIES[m mod 6], channel = CHANNELS[m mod 3]
  country = COUNTRIES[u mod 5], device = device-%05d(u), ip = 192.0.2.(u mod 253 + 1)
  account takeover when k mod 97 = 0: country = COUNTRIES[(u + 2) mod 5], device = takeover-<k>
  coordinates = centre of the country, missing when k mod 11 = 0
  is_fraud = takeover or k mod 37 = 0       (ground truth, never a model input)
Time can be compressed: us = origin + (us - origin) div time_scale, which packs
30 days into 90 minutes at time_scale 480 so that minute windows carry data.
Source rows are dealt out in tasks of bounded rows (``in_bounded_tasks``) before they are widened.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskline import constants as C
from riskline.operators.cases import NOTE_LIMIT

ORIGIN_US = 1_704_067_200_000_000  # 2024-01-01T00:00:00Z
COMPRESSED_SCALE = 480
LABEL_DELAY_DAYS = 14
#: Source rows of a task.
SOURCE_ROWS = 1 << 18


def event_micros(ts: Column) -> Column:
    """Epoch microseconds of a timestamp / timestamp_ntz column (session zone UTC)."""
    return F.unix_micros(ts.cast("timestamp"))


def _pick(values: list, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def in_bounded_tasks(rows: DataFrame) -> DataFrame:
    """``rows`` in tasks of about ``SOURCE_ROWS`` rows, whatever the splits and row groups of their files.

    A split holds as many rows as its bytes come to, and a task that shuffles them into many partitions holds them all.
    The hash of all columns deals them out evenly, null or repeated keys too, and alike when a task is run again.
    """
    tasks = -(-rows.count() // SOURCE_ROWS)
    return rows.repartition(tasks, *rows.columns) if tasks > 1 else rows


def _adapt(df: DataFrame, key: Column, user: Column, amount: Column, ts: Column, prefix: str,
           time_scale: int) -> DataFrame:
    k = key.cast("long")
    u = user.cast("long")
    raw_us = event_micros(ts)
    m = F.pmod(F.col("k") * 7919 + F.col("u") * 31, F.lit(500))
    takeover = F.pmod(F.col("k"), F.lit(97)) == 0
    home = F.pmod(F.col("u"), F.lit(5))
    away = F.pmod(F.col("u") + 2, F.lit(5))
    country_idx = F.when(takeover, away).otherwise(home)
    lats = [C.COUNTRY_COORDINATES[c][0] for c in C.COUNTRIES]
    lons = [C.COUNTRY_COORDINATES[c][1] for c in C.COUNTRIES]
    no_geo = F.pmod(F.col("k"), F.lit(11)) == 0
    base = df.select(k.alias("k"), u.alias("u"), amount.cast("double").alias("amount"), raw_us.alias("raw_us"))
    base = in_bounded_tasks(base)
    if time_scale == 1:
        base = base.withColumn("us", F.col("raw_us"))
    else:  # integer compression towards the origin (same arithmetic in the SQL twin)
        base = base.withColumn("us", F.lit(ORIGIN_US) + F.expr(f"(raw_us - {ORIGIN_US}) div {int(time_scale)}"))
    return base.select(
        F.lit("1.0").alias("schema_version"),
        F.concat(F.lit(prefix), F.col("k").cast("string")).alias("transaction_id"),
        F.format_string("user-%05d", F.col("u")).alias("user_id"),
        F.format_string("merchant-%05d", m).alias("merchant_id"),
        F.timestamp_micros(F.col("us")).alias("timestamp"),
        F.col("us"),
        F.col("amount"),
        F.lit("USD").alias("currency"),
        _pick(C.CATEGORIES, F.pmod(m, F.lit(len(C.CATEGORIES)))).alias("merchant_category"),
        _pick(C.COUNTRIES, country_idx).alias("country"),
        F.when(takeover, F.concat(F.lit("takeover-"), F.col("k").cast("string")))
        .otherwise(F.format_string("device-%05d", F.col("u"))).alias("device_id"),
        F.concat(F.lit("192.0.2."), (F.pmod(F.col("u"), F.lit(253)) + 1).cast("string")).alias("ip_address"),
        _pick(C.CHANNELS, F.pmod(m, F.lit(len(C.CHANNELS)))).alias("channel"),
        F.when(~no_geo, _pick(lats, country_idx)).alias("latitude"),
        F.when(~no_geo, _pick(lons, country_idx)).alias("longitude"),
        F.lit(None).cast("string").alias("request_id"),
        F.col("k").alias("source_seq"),
        (takeover | (F.pmod(F.col("k"), F.lit(37)) == 0)).alias("is_fraud"),
    )


def transactions_from_events(events: DataFrame, time_scale: int = 1) -> DataFrame:
    """events(event_id, ts, user_id, value) -> transaction contract + us, source_seq, is_fraud."""
    return _adapt(events, F.col("event_id"), F.col("user_id"), F.col("value"), F.col("ts"), "txn-", time_scale)


def transactions_from_orders(orders: DataFrame, time_scale: int = 1) -> DataFrame:
    """orders(o_orderkey, o_custkey, o_totalprice, o_orderdate): many equal timestamps per user."""
    return _adapt(orders, F.col("o_orderkey"), F.col("o_custkey"), F.col("o_totalprice"),
                  F.col("o_orderdate"), "ord-", time_scale)


def label_log(transactions: DataFrame, delay_unit_us: int = C.DAY_US) -> DataFrame:
    """Delayed confirmed-label log derived from the ground truth.

    Every transaction gets a chargeback-style label (k mod 14 + 1) days after the
    event; k mod 10 = 0 gets a later analyst correction (flipped when k mod 20 = 0);
    k mod 250 = 0 also produces a label for an id that does not exist (rejected by S08).
    ``delay_unit_us`` is one "day" of delay; compressed time passes DAY / time_scale.
    """
    k = F.col("source_seq")
    first = transactions.select(
        F.col("transaction_id"),
        F.col("is_fraud"),
        F.lit("chargeback").alias("source"),
        (F.col("us") + (F.pmod(k, F.lit(LABEL_DELAY_DAYS)) + 1) * F.lit(delay_unit_us)).alias("confirmed_us"),
        (k * 4).alias("label_seq"),
    )
    correction = transactions.where(F.pmod(k, F.lit(10)) == 0).select(
        F.col("transaction_id"),
        F.when(F.pmod(k, F.lit(20)) == 0, ~F.col("is_fraud")).otherwise(F.col("is_fraud")).alias("is_fraud"),
        F.lit("analyst").alias("source"),
        (F.col("us") + (F.pmod(k, F.lit(LABEL_DELAY_DAYS)) + 2) * F.lit(delay_unit_us)).alias("confirmed_us"),
        (k * 4 + 1).alias("label_seq"),
    )
    unknown = transactions.where(F.pmod(k, F.lit(250)) == 0).select(
        F.concat(F.col("transaction_id"), F.lit("-unknown")).alias("transaction_id"),
        F.col("is_fraud"),
        F.lit("chargeback").alias("source"),
        (F.col("us") + F.lit(delay_unit_us)).alias("confirmed_us"),
        (k * 4 + 2).alias("label_seq"),
    )
    return first.unionByName(correction).unionByName(unknown)


# Mutations applied to the JSON feed, by source id mod 50 (0 and others: unchanged).
PAYLOAD_CASES = {
    1: "naive timestamp", 2: "unknown key", 3: "amount 0", 4: "currency of 2 letters", 5: "lower-case country",
    6: "channel WEB", 7: "ip with leading zero", 8: "latitude 91", 9: "not JSON", 10: "amount as text",
    11: "amount over the limit", 12: "id of 65 characters", 13: "merchant missing", 14: "offset +02:00",
    15: "epoch seconds", 16: "user id as number", 17: "currency and channel omitted", 18: "latitude null",
    19: "valid request id", 20: "invalid request id",
}


def payloads_from_transactions(tx: DataFrame) -> DataFrame:
    """Raw JSON feed (source_seq, payload) with deterministic contract violations (see PAYLOAD_CASES)."""
    r = F.pmod(F.col("source_seq"), F.lit(50))
    k = F.col("source_seq").cast("string")

    def q(s):
        return F.concat(F.lit('"'), s, F.lit('"'))

    def field(name, value):
        return F.concat(F.lit(f',"{name}":'), value)

    iso = F.date_format(F.col("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    ts_val = (F.when(r == 1, q(iso))
              .when(r == 14, q(F.concat(F.date_format(F.timestamp_micros(F.col("us") + C.HOUR_US * 2),
                                                       "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+02:00"))))
              .when(r == 15, F.expr("CAST(us div 1000000 AS STRING)"))
              .otherwise(q(F.concat(iso, F.lit("Z")))))
    amount = (F.when(r == 3, F.lit("0")).when(r == 10, q(F.col("amount").cast("string")))
              .when(r == 11, F.lit("10000000.01")).otherwise(F.col("amount").cast("string")))
    lat = (F.when(r == 8, F.lit(',"latitude":91.0'))
           .when(r == 18, F.lit(',"latitude":null'))
           .when(F.col("latitude").isNotNull(), field("latitude", F.col("latitude").cast("string")))
           .otherwise(F.lit("")))
    lon = F.when((r != 18) & F.col("longitude").isNotNull(),
                 field("longitude", F.col("longitude").cast("string"))).otherwise(F.lit(""))
    body = F.concat(
        F.lit('{"schema_version":"1.0"'),
        field("transaction_id", q(F.when(r == 12, F.repeat(F.lit("x"), 65)).otherwise(F.col("transaction_id")))),
        field("user_id", F.when(r == 16, F.regexp_extract("user_id", "([0-9]+)$", 1).cast("long").cast("string"))
              .otherwise(q(F.col("user_id")))),
        F.when(r == 13, F.lit("")).otherwise(field("merchant_id", q(F.col("merchant_id")))),
        field("timestamp", ts_val),
        field("amount", amount),
        F.when(r == 17, F.lit("")).otherwise(field("currency", q(F.when(r == 4, F.lit("US")).otherwise(F.lit("USD"))))),
        field("merchant_category", q(F.col("merchant_category"))),
        field("country", q(F.when(r == 5, F.lower("country")).otherwise(F.col("country")))),
        field("device_id", q(F.col("device_id"))),
        field("ip_address", q(F.when(r == 7, F.lit("192.0.2.010")).otherwise(F.col("ip_address")))),
        F.when(r == 17, F.lit("")).otherwise(field("channel", q(F.when(r == 6, F.lit("WEB")).otherwise(F.col("channel"))))),
        lat, lon,
        F.when(r == 19, field("request_id", q(F.concat(F.lit("00000000-0000-4000-8000-"), F.lpad(k, 12, "0")))))
        .when(r == 20, field("request_id", q(F.concat(F.lit("req-"), k)))).otherwise(F.lit("")),
        F.when(r == 2, F.lit(',"extra":1')).otherwise(F.lit("")),
        F.lit("}"),
    )
    return tx.select("source_seq", F.when(r == 9, F.concat(F.lit("not-json-"), k)).otherwise(body).alias("payload"))


# Update scripts used to derive an update log from the alerts (variant = alert_id mod 6).
# (variant, seq, status, resolution, note)  -- "LONG" stands for a note over the limit.
UPDATE_SCRIPTS = [
    (0, 1, "IN_REVIEW", None, "checking"), (0, 2, "RESOLVED", "FRAUD", "confirmed"), (0, 3, "RESOLVED", "FRAUD", None),
    (1, 1, "IN_REVIEW", None, None), (1, 2, "OPEN", None, "reopen"), (1, 3, "RESOLVED", "LEGITIMATE", "customer ok"),
    (2, 1, "RESOLVED", None, None), (2, 2, "OPEN", None, "still open"), (2, 3, "RESOLVED", "FRAUD", None),
    (3, 1, "RESOLVED", "LEGITIMATE", None), (3, 2, "RESOLVED", "FRAUD", None), (3, 3, "IN_REVIEW", None, "late"),
    (4, 1, "OPEN", "FRAUD", None), (4, 2, "IN_REVIEW", None, "first note"), (4, 3, "IN_REVIEW", None, None),
    (5, 1, "IN_REVIEW", None, "LONG"), (5, 2, "IN_REVIEW", None, None), (5, 3, "RESOLVED", "LEGITIMATE", "same"),
]
UPDATE_GAP_US = C.MINUTE_US


def update_log(spark: SparkSession, alerts: DataFrame) -> DataFrame:
    """Derive an analyst update log from the alerts (3 updates each, plus 404 probes)."""
    scripts = spark.createDataFrame(
        UPDATE_SCRIPTS, "variant int, seq int, status string, resolution string, note string"
    )
    # Fixed 18-row script table: broadcast is size-bounded by construction.
    log = alerts.select("alert_id", "created_us").join(
        F.broadcast(scripts), F.pmod(F.col("alert_id"), F.lit(6)) == F.col("variant")
    )
    log = log.select(
        "alert_id",
        F.col("seq").cast("long").alias("seq"),
        (F.col("created_us") + F.col("seq") * F.lit(UPDATE_GAP_US)).alias("at_us"),
        "status",
        "resolution",
        F.when(F.col("note") == "LONG", F.repeat(F.lit("n"), NOTE_LIMIT + 1)).otherwise(F.col("note"))
        .alias("analyst_note"),
    )
    unknown = alerts.where(F.pmod(F.col("alert_id"), F.lit(6)) == 0).select(
        (-F.col("alert_id") - 1).alias("alert_id"),
        F.lit(1).cast("long").alias("seq"),
        (F.col("created_us") + F.lit(UPDATE_GAP_US)).alias("at_us"),
        F.lit("IN_REVIEW").alias("status"),
        F.lit(None).cast("string").alias("resolution"),
        F.lit(None).cast("string").alias("analyst_note"),
    )
    return log.unionByName(unknown)
