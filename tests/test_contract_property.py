"""Property test: Spark contract validation == a plain-Python statement of the rules."""

import json
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from riskline import constants as C
from riskline.functions import contract as K
from riskline.operators.validate import validate_payloads

IDS = K.ID_FIELDS


def expected_errors(obj) -> list[str]:
    if not isinstance(obj, dict):
        return ["malformed_json"]
    errs = []
    if set(obj) - set(C.TRANSACTION_KEYS):
        errs.append("unknown_field")
    for f in IDS:
        v = obj.get(f)
        if not (isinstance(v, str) and 1 <= len(v) <= 64):
            errs.append(f"invalid_{f}")
    a = obj.get("amount")
    amount = None
    if isinstance(a, (int, float)) and not isinstance(a, bool):
        amount = float(a)
    elif isinstance(a, str):
        try:
            amount = float(a)
        except ValueError:
            amount = None
    if not (amount is not None and 0 < amount <= K.MAX_AMOUNT):
        errs.append("invalid_amount")
    if "currency" in obj and not (isinstance(obj["currency"], str) and len(obj["currency"]) == 3):
        errs.append("invalid_currency")
    if not (isinstance(obj.get("country"), str) and len(obj["country"]) == 2):
        errs.append("invalid_country")
    ip = obj.get("ip_address")
    if not (isinstance(ip, str) and re.fullmatch(K.IPV4[1:-1], ip)):
        errs.append("invalid_ip_address")
    if "channel" in obj and obj["channel"] not in C.CHANNELS:
        errs.append("invalid_channel")
    for f, bound in (("latitude", 90), ("longitude", 180)):
        v = obj.get(f)
        if f in obj and v is not None and not (isinstance(v, (int, float)) and not isinstance(v, bool)
                                               and -bound <= v <= bound):
            errs.append(f"invalid_{f}")
    r = obj.get("request_id")
    if r is not None and not (isinstance(r, str) and re.fullmatch(K.UUID[1:-1], r)):
        errs.append("invalid_request_id")
    if "schema_version" in obj and not isinstance(obj["schema_version"], str):
        errs.append("invalid_schema_version")
    ts = obj.get("timestamp")
    ok_ts = (isinstance(ts, int) and not isinstance(ts, bool)) or (
        isinstance(ts, str) and (re.fullmatch(r"[0-9]+", ts) is not None or ts in VALID_ZONED))
    if not ok_ts:
        errs.append("invalid_timestamp")
    return errs


VALID_ZONED = {"2026-01-05T12:00:00Z", "2026-01-05T12:00:00.123456Z", "2026-01-05T14:00:00+02:00",
               "2026-01-05 12:00:00Z"}
TIMESTAMPS = st.sampled_from(sorted(VALID_ZONED) + ["2026-01-05T12:00:00", "2026-01-05", "soon", "1700000000",
                                                    "", "2026-13-45T99:00:00Z"]) | st.integers(0, 2_000_000_000) \
    | st.floats(0, 2e9, allow_nan=False) | st.none() | st.booleans()
TEXT = st.text(alphabet="abcXYZ-_0189", min_size=0, max_size=70)
ANY_SCALAR = st.none() | st.booleans() | st.integers(-5, 10**8) | st.floats(allow_nan=False, allow_infinity=False,
                                                                              min_value=-1e9, max_value=1e9) | TEXT
FIELD_VALUES = {
    "transaction_id": TEXT | ANY_SCALAR, "user_id": TEXT | st.integers(0, 99), "merchant_id": TEXT,
    "merchant_category": TEXT, "device_id": TEXT | st.none(),
    "amount": st.floats(-10, 2e7, allow_nan=False) | st.integers(-5, 2 * 10**7) | st.booleans()
    | st.sampled_from(["12.5", "0", "abc", "1e3", "-3"]),
    "currency": st.sampled_from(["USD", "EUR", "US", "usd", "DOLLAR"]) | st.integers(0, 5),
    "country": st.sampled_from(["US", "us", "USA", "G", ""]) | st.none(),
    "ip_address": st.sampled_from(["192.0.2.1", "192.0.2.010", "256.1.1.1", "10.0.0.255", "1.2.3"])
    | st.integers(0, 10**9),
    "channel": st.sampled_from(["web", "mobile", "pos", "WEB", "atm"]) | st.none(),
    "latitude": st.floats(-100, 100, allow_nan=False) | st.none() | st.booleans() | st.just("40.1"),
    "longitude": st.floats(-200, 200, allow_nan=False) | st.none(),
    "request_id": st.sampled_from(["00000000-0000-4000-8000-000000000001", "req-1", ""]) | st.none(),
    "schema_version": st.sampled_from(["1.0", "2"]) | st.integers(1, 2),
    "timestamp": TIMESTAMPS,
}
PAYLOAD = st.fixed_dictionaries({}, optional={**FIELD_VALUES, "extra": st.integers(0, 1)})
RAW = st.one_of(PAYLOAD.map(json.dumps), st.sampled_from(["not json", "[1, 2]", "42", "{\"a\": "]))


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(RAW, min_size=50, max_size=120))
def test_contract_matches_python_rules(spark, payloads):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(payloads)], "source_seq long, payload string")
    got = {r["source_seq"]: r["errors"] for r in validate_payloads(df).select("source_seq", "errors").collect()}
    for i, p in enumerate(payloads):
        try:
            obj = json.loads(p)
        except json.JSONDecodeError:
            obj = None
        assert got[i] == expected_errors(obj), (p, got[i])
