"""Small fixtures built in tests (never registered as queries)."""

from __future__ import annotations

import math
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from riskline import constants as C

T0 = datetime(2026, 1, 5, 12, 0, 0, tzinfo=timezone.utc)
COLS = ["transaction_id", "user_id", "merchant_id", "timestamp", "amount", "country", "device_id", "ip_address",
        "latitude", "longitude"]


def tx(tid, when, amount=100.0, user="u1", merchant="m1", country="US", device="d1", ip="192.0.2.1",
       lat=40.7128, lon=-74.0060):
    return (tid, user, merchant, when, float(amount), country, device, ip, lat, lon)


def frame(spark, rows):
    schema = ("transaction_id string, user_id string, merchant_id string, timestamp timestamp, amount double, "
              "country string, device_id string, ip_address string, latitude double, longitude double")
    df = spark.createDataFrame(rows, schema)
    return df.withColumn("us", F.unix_micros("timestamp")).withColumn("currency", F.lit("USD")).withColumn(
        "merchant_category", F.lit("grocery")).withColumn("channel", F.lit("web")).withColumn(
        "source_seq", F.monotonically_increasing_id())


def micros(dt: datetime) -> int:
    return int(dt.timestamp()) * 1_000_000 + dt.microsecond


def brute_features(rows, horizon_days=C.HISTORY_DAYS):
    """Plain-Python definition of the online features (independent of the Spark plan)."""
    H = horizon_days * C.DAY_US
    out = {}
    for r in rows:
        tid, user, merchant, when, amount, country, device, ip, lat, lon = r
        t = micros(when)
        prior = [h for h in rows if h[1] == user and h[0] != tid and t - H <= micros(h[3]) < t]
        prior.sort(key=lambda h: (micros(h[3]), h[0]))
        amounts = [h[4] for h in prior]
        avg = sum(amounts) / len(amounts) if amounts else amount
        s = sorted(amounts)
        med = (s[len(s) // 2] if len(s) % 2 else (s[len(s) // 2 - 1] + s[len(s) // 2]) / 2) if s else amount

        def recent(w):
            return [h for h in prior if micros(h[3]) >= t - w]
        speed = 0.0
        if prior and lat is not None and lon is not None and prior[-1][8] is not None and prior[-1][9] is not None:
            p = prior[-1]
            hours = (t - micros(p[3])) / 3_600_000_000
            if hours > 0:
                p1, p2 = math.radians(p[8]), math.radians(lat)
                a = math.sin(math.radians(lat - p[8]) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(
                    math.radians(lon - p[9]) / 2) ** 2
                speed = 2 * 6371.0 * math.asin(min(math.sqrt(a), 1.0)) / hours
        out[tid] = {
            "user_average_amount": avg, "user_median_amount": med,
            "amount_vs_user_average": amount / max(avg, 0.01),
            "transactions_last_1m": float(len(recent(C.MINUTE_US))),
            "transactions_last_5m": float(len(recent(5 * C.MINUTE_US))),
            "transactions_last_1h": float(len(recent(C.HOUR_US))),
            "transactions_last_24h": float(len(recent(C.DAY_US))),
            "amount_last_1h": sum(h[4] for h in recent(C.HOUR_US)),
            "unique_merchants_last_24h": float(len({h[2] for h in recent(C.DAY_US)})),
            "unique_countries_last_24h": float(len({h[5] for h in recent(C.DAY_US)})),
            "new_merchant": float(bool(prior) and merchant not in {h[2] for h in prior}),
            "new_country": float(bool(prior) and country not in {h[5] for h in prior}),
            "new_device": float(bool(prior) and device not in {h[6] for h in prior}),
            "ip_changed": float(bool(prior) and ip != prior[-1][7]),
            "travel_speed_kmh": speed,
            "impossible_travel": float(speed > 900.0),
        }
    return out


def at(minutes=0, seconds=0, days=0, micro=0):
    return T0 + timedelta(days=days, minutes=minutes, seconds=seconds, microseconds=micro)
