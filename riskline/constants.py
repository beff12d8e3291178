"""Fixed values and schemas.

Values in the FIXED VALUES block must equal the behaviour being reproduced
(category lists, policy thresholds, model weights, cost settings).  Everything
else in the package is derived from them.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES (must stay equal to the reproduced behaviour)
# ---------------------------------------------------------------------------
COUNTRIES = ["US", "GB", "TR", "DE", "FR"]
CATEGORIES = ["grocery", "travel", "electronics", "fuel", "restaurant", "entertainment"]
CHANNELS = ["web", "mobile", "pos"]
# Country centres: US, GB, TR as in the simulator; DE, FR are our own choice.
COUNTRY_COORDINATES = {
    "US": (40.7128, -74.0060),
    "GB": (51.5072, -0.1276),
    "TR": (41.0082, 28.9784),
    "DE": (52.52, 13.405),
    "FR": (48.8566, 2.3522),
}
EARTH_RADIUS_KM = 6371.0
IMPOSSIBLE_TRAVEL_KMH = 900.0
HISTORY_DAYS = 30

REVIEW_THRESHOLD = 0.40
BLOCK_THRESHOLD = 0.70
VELOCITY_REVIEW_COUNT = 8
AMOUNT_RATIO_REVIEW = 8.0

BOOTSTRAP_VERSION = "bootstrap-heuristic"
# logit = -4 + 0.12*min(ratio, 15) + 0.22*min(n5m, 10) + 0.8*new_device + 0.7*new_country + 2*impossible
HEURISTIC_INTERCEPT = -4.0

# Reason-code weights, in list order (the order also breaks ties).
REASON_WEIGHTS = [
    ("impossible_travel", 2.0, None),
    ("new_device", 0.8, None),
    ("new_country", 0.7, None),
    ("transactions_last_5m", 0.22, 10.0),
    ("amount_vs_user_average", 0.12, 15.0),
    ("ip_changed", 0.3, None),
]
REASON_LIMIT = 5

RULE_IMPOSSIBLE_TRAVEL = "impossible_travel"
RULE_BURST = "rapid_transaction_burst"
RULE_LARGE_AMOUNT = "unusually_large_amount"
RULE_TRAVEL_NEW_DEVICE = "impossible_travel_with_new_device"

FALSE_POSITIVE_COST = 25.0
REVIEW_COST = 5.0
REVIEW_CATCH_RATE = 0.80
MAX_REVIEW_RATE = 0.05

PSI_BINS = 10
PSI_FLOOR = 1e-6
PSI_ALERT = 0.20
JS_ALERT = 0.10
DRIFT_MIN_ROWS = 100

GATE_PR_AUC_TOLERANCE = 0.01
GATE_RECALL_TOLERANCE = 0.02

SPLIT_FRACTIONS = [("train", 0.50), ("selection", 0.65), ("calibration", 0.75), ("threshold", 0.85), ("test", 1.0)]
# ---------------------------------------------------------------------------

# Display names for reason codes (our own wording).
FACTOR_LABELS = {
    "impossible_travel": "Travel speed between payments is not physically possible",
    "new_device": "Device not seen for this user before",
    "new_country": "Country not seen for this user before",
    "transactions_last_5m": "Payments in the previous five minutes",
    "amount_vs_user_average": "Amount against the user's usual spend",
    "ip_changed": "IP address differs from the previous payment",
}

DECISIONS = ["APPROVE", "MANUAL_REVIEW", "BLOCK"]
ALERT_STATUSES = ["OPEN", "IN_REVIEW", "RESOLVED"]
RESOLUTIONS = ["FRAUD", "LEGITIMATE"]

ONLINE_FEATURES = [
    "amount",
    "hour",
    "weekday",
    "user_average_amount",
    "user_median_amount",
    "amount_vs_user_average",
    "transactions_last_1m",
    "transactions_last_5m",
    "transactions_last_1h",
    "transactions_last_24h",
    "amount_last_1h",
    "unique_merchants_last_24h",
    "unique_countries_last_24h",
    "new_merchant",
    "new_country",
    "new_device",
    "ip_changed",
    "travel_speed_kmh",
    "impossible_travel",
]

MODEL_FEATURES = [
    "amount",
    "hour",
    "weekday",
    "user_average_amount",
    "user_median_amount",
    "amount_vs_user_average",
    "transactions_last_5m",
    "transactions_last_1h",
    "transactions_last_24h",
    "new_merchant",
]

MINUTE_US = 60 * 1_000_000
HOUR_US = 60 * MINUTE_US
DAY_US = 24 * HOUR_US

TRANSACTION_FIELDS = [
    ("schema_version", T.StringType()),
    ("transaction_id", T.StringType()),
    ("user_id", T.StringType()),
    ("merchant_id", T.StringType()),
    ("timestamp", T.TimestampType()),
    ("amount", T.DoubleType()),
    ("currency", T.StringType()),
    ("merchant_category", T.StringType()),
    ("country", T.StringType()),
    ("device_id", T.StringType()),
    ("ip_address", T.StringType()),
    ("channel", T.StringType()),
    ("latitude", T.DoubleType()),
    ("longitude", T.DoubleType()),
    ("request_id", T.StringType()),
]
TRANSACTION = T.StructType([T.StructField(n, t, True) for n, t in TRANSACTION_FIELDS])
TRANSACTION_KEYS = [n for n, _ in TRANSACTION_FIELDS]

SNAPSHOT = T.StructType([T.StructField(n, T.DoubleType(), True) for n in ONLINE_FEATURES])
RISK_FACTOR = T.StructType(
    [
        T.StructField("feature", T.StringType()),
        T.StructField("impact", T.DoubleType()),
        T.StructField("direction", T.StringType()),
    ]
)
