"""Transaction contract rules (V01) and normalisation (V02) on raw JSON text.

The payload is parsed once (``from_json`` into VARIANT fields) so that the JSON
type of every field is known (a number where a string is required is an error,
a numeric string for ``amount`` is accepted).  Each rule yields an error code or
null; ``errors`` is the compacted array in fixed rule order.

Decisions where the source's lax parser and Spark differ (documented choices):
boolean ``amount`` and integer ``ip_address`` are rejected; a duplicate key keeps
its last value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskline import constants as C

# FIXED VALUES: field limits of the contract
ID_FIELDS = ["transaction_id", "user_id", "merchant_id", "merchant_category", "device_id"]
MAX_AMOUNT = 10_000_000.0
IPV4 = r"^((25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\.){3}(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])$"
UUID = r"^[0-9a-fA-F]{8}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{12}$"
ZONE = r"(Z|z|[+-][0-9]{2}:?[0-9]{2})$"
EPOCH = r"^[0-9]+$"
NUMERIC_TYPES = ("BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT")


def _is_numeric(t: Column) -> Column:
    return t.isin(*NUMERIC_TYPES) | t.startswith("DECIMAL")


def parse_fields(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Stage 1+2: one ``from_json`` parse into a struct of VARIANT fields, then (type, text) per key.

    Each field arrives as its own small variant, so its JSON type
    (``schema_of_variant``) and text need no path lookup in a large document.
    ``json_object_keys`` is null unless the payload is a JSON object.  A
    duplicate key keeps its last value.  Staged projections keep Catalyst from
    inlining the parse into every rule.
    """
    fields = T.StructType([T.StructField(k, T.VariantType(), True) for k in C.TRANSACTION_KEYS])
    staged = df.select("*", F.json_object_keys(F.col(payload)).alias("_keys"),
                       F.from_json(F.col(payload), fields).alias("_j"))
    cols = [F.when(F.col("_keys").isNotNull(), F.lit("OBJECT")).alias("_t_root")]
    for k in C.TRANSACTION_KEYS:
        cols.append(F.schema_of_variant(F.col(f"_j.{k}")).alias(f"_t_{k}"))
        cols.append(F.try_variant_get(F.col(f"_j.{k}"), "$", "string").alias(f"_s_{k}"))
    out = staged.select("*", *cols).drop("_j")
    extra = [F.col(f"_s_{k}").try_cast("double").alias(f"_d_{k}") for k in ("amount", "latitude", "longitude")]
    extra.append(F.col("_s_timestamp").try_cast("long").alias("_l_timestamp"))
    return out.select("*", *extra)


def contract_rules() -> tuple[Column, dict[str, Column]]:
    """Stage 3: (errors array, normalised fields) over the columns of ``parse_fields``."""
    def t(k):
        return F.col(f"_t_{k}")

    def s(k):
        return F.col(f"_s_{k}")

    is_object = F.coalesce(F.col("_t_root").startswith("OBJECT"), F.lit(False))
    unknown = F.size(F.array_except(F.col("_keys"), F.array(*[F.lit(k) for k in C.TRANSACTION_KEYS]))) > 0

    checks: list[tuple[str, Column]] = [("unknown_field", unknown)]
    for f in ID_FIELDS:
        bad = ~F.coalesce((t(f) == "STRING") & (F.length(s(f)) >= 1) & (F.length(s(f)) <= 64), F.lit(False))
        checks.append((f"invalid_{f}", bad))

    amount = F.when(_is_numeric(t("amount")), F.col("_d_amount")).when(
        t("amount") == "STRING", s("amount").try_cast("double"))
    checks.append(("invalid_amount", ~F.coalesce((amount > 0) & (amount <= MAX_AMOUNT), F.lit(False))))

    cur_ok = t("currency").isNull() | ((t("currency") == "STRING") & (F.length(s("currency")) == 3))
    checks.append(("invalid_currency", ~F.coalesce(cur_ok, F.lit(False))))
    checks.append(("invalid_country",
                   ~F.coalesce((t("country") == "STRING") & (F.length(s("country")) == 2), F.lit(False))))
    checks.append(("invalid_ip_address",
                   ~F.coalesce((t("ip_address") == "STRING") & s("ip_address").rlike(IPV4), F.lit(False))))
    ch_ok = t("channel").isNull() | ((t("channel") == "STRING") & s("channel").isin(*C.CHANNELS))
    checks.append(("invalid_channel", ~F.coalesce(ch_ok, F.lit(False))))

    def coord(field: str, bound: float) -> tuple[Column, Column]:
        val = F.when(_is_numeric(t(field)), F.col(f"_d_{field}"))
        ok = (t(field).isNull() | (t(field) == "VOID")
              | F.coalesce(_is_numeric(t(field)) & (val >= -bound) & (val <= bound), F.lit(False)))
        return val, ok

    lat, lat_ok = coord("latitude", 90.0)
    lon, lon_ok = coord("longitude", 180.0)
    checks.append(("invalid_latitude", ~lat_ok))
    checks.append(("invalid_longitude", ~lon_ok))

    req_ok = (t("request_id").isNull() | (t("request_id") == "VOID")
              | F.coalesce((t("request_id") == "STRING") & s("request_id").rlike(UUID), F.lit(False)))
    checks.append(("invalid_request_id", ~req_ok))
    checks.append(("invalid_schema_version",
                   ~(t("schema_version").isNull() | F.coalesce(t("schema_version") == "STRING", F.lit(False)))))

    tt, ts_s = t("timestamp"), s("timestamp")
    ts_epoch = F.when(tt.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), F.col("_l_timestamp")).when(
        (tt == "STRING") & ts_s.rlike(EPOCH), ts_s.try_cast("long"))
    ts_zoned = F.when((tt == "STRING") & ts_s.rlike(ZONE), F.try_to_timestamp(ts_s))
    ts = F.coalesce(F.when(ts_epoch.isNotNull(), F.timestamp_seconds(ts_epoch)), ts_zoned)
    checks.append(("invalid_timestamp", ts.isNull()))

    errors = F.when(~is_object, F.array(F.lit("malformed_json"))).otherwise(
        F.array_compact(F.array(*[F.when(cond, F.lit(code)) for code, cond in checks]))
    )
    fields = {
        "schema_version": F.coalesce(s("schema_version"), F.lit("1.0")),
        **{f: s(f) for f in ID_FIELDS},
        "timestamp": ts,
        "amount": amount,
        "currency": F.upper(F.coalesce(s("currency"), F.lit("USD"))),
        "country": F.upper(s("country")),
        "ip_address": s("ip_address"),
        "channel": F.coalesce(s("channel"), F.lit("web")),
        "latitude": lat,
        "longitude": lon,
        "request_id": F.coalesce(s("request_id"), F.expr("uuid()")),
    }
    return errors, fields
