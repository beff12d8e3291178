"""SQL twins (DuckDB dialect) of the registered Spark queries.

The twins are deliberately written the plain way -- history as a self-join
with FILTER aggregates, global orders as unpartitioned windows -- so they check
the Spark plans by a different route.  Only the adapter rules and the fixed
values are shared.
"""

from __future__ import annotations

from riskline import constants as C
from riskline.sources.adapter import COMPRESSED_SCALE, LABEL_DELAY_DAYS, ORIGIN_US

DAY = C.DAY_US
HOUR = C.HOUR_US
MINUTE = C.MINUTE_US


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" if isinstance(v, str) else repr(float(v)) for v in values) + "]"


def tx_cte(source: str = "events", scale: int = 1) -> str:
    """CTE ``tx``: transactions derived from events / orders (same rules as the adapter)."""
    if source == "events":
        cols, prefix = "event_id AS k, user_id AS u, value AS amount, epoch_us(ts) AS raw_us FROM events", "txn-"
    else:
        cols = ("o_orderkey AS k, o_custkey AS u, o_totalprice AS amount, epoch_us(o_orderdate) AS raw_us "
                "FROM orders")
        prefix = "ord-"
    us = "raw_us" if scale == 1 else f"({ORIGIN_US} + (raw_us - {ORIGIN_US}) // {int(scale)})"
    lats = [C.COUNTRY_COORDINATES[c][0] for c in C.COUNTRIES]
    lons = [C.COUNTRY_COORDINATES[c][1] for c in C.COUNTRIES]
    return f"""
src AS (SELECT {cols}),
src2 AS (
  SELECT k, u, CAST(amount AS DOUBLE) AS amount, {us} AS us,
         (k * 7919 + u * 31) % 500 AS m,
         (k % 97 = 0) AS takeover
  FROM src),
tx AS (
  SELECT '{prefix}' || CAST(k AS VARCHAR) AS transaction_id,
         printf('user-%05d', u) AS user_id,
         printf('merchant-%05d', m) AS merchant_id,
         us,
         make_timestamp(us) AS ts,
         amount,
         'USD' AS currency,
         {_list(C.CATEGORIES)}[m % {len(C.CATEGORIES)} + 1] AS merchant_category,
         {_list(C.COUNTRIES)}[CASE WHEN takeover THEN (u + 2) % 5 ELSE u % 5 END + 1] AS country,
         CASE WHEN takeover THEN 'takeover-' || CAST(k AS VARCHAR) ELSE printf('device-%05d', u) END AS device_id,
         '192.0.2.' || CAST(u % 253 + 1 AS VARCHAR) AS ip_address,
         {_list(C.CHANNELS)}[m % 3 + 1] AS channel,
         CASE WHEN k % 11 = 0 THEN NULL
              ELSE {_list(lats)}[CASE WHEN takeover THEN (u + 2) % 5 ELSE u % 5 END + 1] END AS latitude,
         CASE WHEN k % 11 = 0 THEN NULL
              ELSE {_list(lons)}[CASE WHEN takeover THEN (u + 2) % 5 ELSE u % 5 END + 1] END AS longitude,
         k AS source_seq,
         (takeover OR k % 37 = 0) AS is_fraud
  FROM src2)"""


def features_cte(horizon_days: int = C.HISTORY_DAYS, history: str = "true") -> str:
    """CTE ``feat``: the 19 online features by brute-force self-join over ``tx`` (h must also meet ``history``)."""
    H = horizon_days * DAY
    return f"""
hist AS (
  SELECT t.transaction_id,
         count(h.transaction_id) AS n_h,
         avg(h.amount) AS avg_h,
         median(h.amount) AS med_h,
         count(h.transaction_id) FILTER (WHERE h.us >= t.us - {MINUTE}) AS n1m,
         count(h.transaction_id) FILTER (WHERE h.us >= t.us - {5 * MINUTE}) AS n5m,
         count(h.transaction_id) FILTER (WHERE h.us >= t.us - {HOUR}) AS n1h,
         count(h.transaction_id) FILTER (WHERE h.us >= t.us - {DAY}) AS n24h,
         sum(h.amount) FILTER (WHERE h.us >= t.us - {HOUR}) AS s1h,
         count(DISTINCT h.merchant_id) FILTER (WHERE h.us >= t.us - {DAY}) AS um24,
         count(DISTINCT h.country) FILTER (WHERE h.us >= t.us - {DAY}) AS uc24,
         coalesce(bool_or(h.merchant_id = t.merchant_id), false) AS seen_m,
         coalesce(bool_or(h.country = t.country), false) AS seen_c,
         coalesce(bool_or(h.device_id = t.device_id), false) AS seen_d,
         max({{'us': h.us, 'id': h.transaction_id, 'ip': h.ip_address,
               'lat': h.latitude, 'lon': h.longitude}}) AS prev
  FROM tx t LEFT JOIN tx h
    ON h.user_id = t.user_id AND h.us >= t.us - {H} AND h.us < t.us
   AND h.transaction_id <> t.transaction_id AND {history}
  GROUP BY t.transaction_id),
geo AS (
  SELECT t.*, hist.*,
         (t.us - (hist.prev).us) / {float(HOUR)} AS hours,
         radians((hist.prev).lat) AS phi1, radians(t.latitude) AS phi2,
         radians(t.latitude - (hist.prev).lat) AS dphi,
         radians(t.longitude - (hist.prev).lon) AS dlam
  FROM tx t JOIN hist USING (transaction_id)),
geo2 AS (
  SELECT *,
         CASE WHEN n_h > 0 AND latitude IS NOT NULL AND longitude IS NOT NULL
                   AND (prev).lat IS NOT NULL AND (prev).lon IS NOT NULL AND hours > 0
              THEN 2 * {C.EARTH_RADIUS_KM} * asin(least(sqrt(pow(sin(dphi / 2), 2)
                   + cos(phi1) * cos(phi2) * pow(sin(dlam / 2), 2)), 1.0)) / hours
              ELSE 0.0 END AS speed
  FROM geo),
feat AS (
  SELECT transaction_id, user_id, merchant_id, us, ts, amount, country, device_id, ip_address,
         latitude, longitude, source_seq, is_fraud, merchant_category,
         CAST(hour(ts) AS DOUBLE) AS hour,
         CAST(isodow(ts) - 1 AS DOUBLE) AS weekday,
         CASE WHEN n_h > 0 THEN avg_h ELSE amount END AS user_average_amount,
         CASE WHEN n_h > 0 THEN med_h ELSE amount END AS user_median_amount,
         amount / greatest(CASE WHEN n_h > 0 THEN avg_h ELSE amount END, 0.01) AS amount_vs_user_average,
         CAST(n1m AS DOUBLE) AS transactions_last_1m,
         CAST(n5m AS DOUBLE) AS transactions_last_5m,
         CAST(n1h AS DOUBLE) AS transactions_last_1h,
         CAST(n24h AS DOUBLE) AS transactions_last_24h,
         coalesce(s1h, 0.0) AS amount_last_1h,
         CAST(um24 AS DOUBLE) AS unique_merchants_last_24h,
         CAST(uc24 AS DOUBLE) AS unique_countries_last_24h,
         CASE WHEN n_h > 0 AND NOT seen_m THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS new_merchant,
         CASE WHEN n_h > 0 AND NOT seen_c THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS new_country,
         CASE WHEN n_h > 0 AND NOT seen_d THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS new_device,
         CASE WHEN n_h > 0 AND ip_address <> (prev).ip THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS ip_changed,
         speed AS travel_speed_kmh,
         CASE WHEN speed > {C.IMPOSSIBLE_TRAVEL_KMH} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS impossible_travel
  FROM geo2)"""


HEURISTIC_PROB = f"""
prob AS (
  SELECT *, 1.0 / (1.0 + exp(-({C.HEURISTIC_INTERCEPT}
          + least(amount_vs_user_average, 15.0) * 0.12
          + least(transactions_last_5m, 10.0) * 0.22
          + new_device * 0.8 + new_country * 0.7 + impossible_travel * 2.0))) AS fraud_probability
  FROM feat),"""


def scored_cte(review: float = C.REVIEW_THRESHOLD, block: float = C.BLOCK_THRESHOLD, prob: str = HEURISTIC_PROB,
               version: str = C.BOOTSTRAP_VERSION) -> str:
    """CTE ``scored``: probability (CTE ``prob``), score, reasons, decision over ``feat``."""
    return f"""{prob}
rsn AS (
  SELECT *,
    list_filter([CASE WHEN impossible_travel = 1 THEN '{C.RULE_IMPOSSIBLE_TRAVEL}' END,
                 CASE WHEN transactions_last_5m >= {C.VELOCITY_REVIEW_COUNT} THEN '{C.RULE_BURST}' END,
                 CASE WHEN amount_vs_user_average >= {C.AMOUNT_RATIO_REVIEW} THEN '{C.RULE_LARGE_AMOUNT}' END,
                 CASE WHEN impossible_travel = 1 AND new_device = 1 THEN '{C.RULE_TRAVEL_NEW_DEVICE}' END],
                lambda x: x IS NOT NULL) AS reasons,
    CASE WHEN fraud_probability >= {block} THEN 'BLOCK'
         WHEN fraud_probability >= {review} THEN 'MANUAL_REVIEW' ELSE 'APPROVE' END AS base_decision
  FROM prob),
scored AS (
  SELECT *,
    CAST(round_even(fraud_probability * 100, 0) AS INTEGER) AS risk_score,
    CASE WHEN impossible_travel = 1 AND new_device = 1 THEN 'BLOCK'
         WHEN len(reasons) > 0 AND base_decision = 'APPROVE' THEN 'MANUAL_REVIEW'
         ELSE base_decision END AS decision,
    '{version}' AS model_version
  FROM rsn)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


def _scripts_values() -> str:
    from riskline.sources.adapter import UPDATE_SCRIPTS

    def lit(v):
        return "NULL" if v is None else (f"'{v}'" if isinstance(v, str) else str(v))
    return ", ".join("(" + ", ".join(lit(x) for x in row) + ")" for row in UPDATE_SCRIPTS)


def store_ctes(scale: int = COMPRESSED_SCALE) -> str:
    """tx, feat, scored, alerts, updates, folded, state, label_log, as_of."""
    from riskline.operators.cases import NOTE_LIMIT
    from riskline.sources.adapter import UPDATE_GAP_US

    unit = DAY // scale
    return with_ctes(tx_cte("events", scale), features_cte(), scored_cte()) + f""",
as_of AS (SELECT max(us) AS as_of_us FROM tx),
alerts AS (
  SELECT CAST('0x' || substr(md5(transaction_id), 1, 15) AS BIGINT) AS alert_id, transaction_id,
         CASE WHEN decision = 'BLOCK' THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
         'OPEN' AS status, us AS created_us
  FROM scored WHERE decision <> 'APPROVE'),
scripts(variant, seq, status, resolution, note) AS (VALUES {_scripts_values()}),
updates AS (
  SELECT a.alert_id, CAST(s.seq AS BIGINT) AS seq, a.created_us + s.seq * {UPDATE_GAP_US} AS at_us,
         s.status, s.resolution,
         CASE WHEN s.note = 'LONG' THEN repeat('n', {NOTE_LIMIT + 1}) ELSE s.note END AS analyst_note
  FROM alerts a JOIN scripts s ON a.alert_id % 6 = s.variant
  UNION ALL
  SELECT -alert_id - 1, 1, created_us + {UPDATE_GAP_US}, 'IN_REVIEW', NULL, NULL
  FROM alerts WHERE alert_id % 6 = 0),
u1 AS (
  SELECT u.*, (a.alert_id IS NOT NULL) AS known,
         coalesce(u.status IN ('OPEN', 'IN_REVIEW', 'RESOLVED')
           AND (u.resolution IS NULL OR u.resolution IN ('FRAUD', 'LEGITIMATE'))
           AND ((u.status = 'RESOLVED') = (u.resolution IS NOT NULL))
           AND (u.analyst_note IS NULL OR length(u.analyst_note) <= {NOTE_LIMIT}), false) AS shape
  FROM updates u LEFT JOIN alerts a USING (alert_id)),
firstres AS (
  SELECT alert_id, arg_min(seq, seq) AS fr_seq, arg_min(resolution, seq) AS fr_resolution,
         arg_min(at_us, seq) AS fr_at
  FROM u1 WHERE shape AND status = 'RESOLVED' GROUP BY alert_id),
u2 AS (
  SELECT u1.*, f.fr_seq, f.fr_resolution, f.fr_at,
         EXISTS (SELECT 1 FROM u1 p WHERE p.alert_id = u1.alert_id AND p.seq < u1.seq
                 AND p.shape AND p.status = 'IN_REVIEW') AS review_before
  FROM u1 LEFT JOIN firstres f USING (alert_id)),
folded AS (
  SELECT alert_id, seq, at_us, status, resolution, analyst_note,
         CASE WHEN NOT known THEN '404' WHEN NOT shape THEN '422'
              WHEN (fr_seq IS NULL OR seq < fr_seq) AND (status <> 'OPEN' OR NOT review_before) THEN 'ok'
              WHEN seq = fr_seq THEN 'ok'
              WHEN seq > fr_seq AND status = 'RESOLVED' AND resolution = fr_resolution THEN 'ok'
              ELSE '409' END AS code,
         fr_resolution AS final_resolution, fr_at AS resolved_us
  FROM u2),
state AS (
  SELECT a.alert_id, a.transaction_id, a.severity,
         coalesce((SELECT arg_max(f.status, f.seq) FROM folded f WHERE f.alert_id = a.alert_id AND f.code = 'ok'),
                  a.status) AS status,
         (SELECT arg_max(f.analyst_note, f.seq) FROM folded f
           WHERE f.alert_id = a.alert_id AND f.code = 'ok' AND f.analyst_note IS NOT NULL) AS analyst_note,
         (SELECT max(f.final_resolution) FROM folded f WHERE f.alert_id = a.alert_id AND f.code = 'ok') AS resolution,
         (SELECT max(f.resolved_us) FROM folded f WHERE f.alert_id = a.alert_id AND f.code = 'ok') AS resolved_us,
         a.created_us
  FROM alerts a),
label_log AS (
  SELECT transaction_id, is_fraud, 'chargeback' AS source,
         us + (source_seq % {LABEL_DELAY_DAYS} + 1) * {unit} AS confirmed_us, source_seq * 4 AS label_seq
  FROM tx
  UNION ALL
  SELECT transaction_id, CASE WHEN source_seq % 20 = 0 THEN NOT is_fraud ELSE is_fraud END, 'analyst',
         us + (source_seq % {LABEL_DELAY_DAYS} + 2) * {unit}, source_seq * 4 + 1
  FROM tx WHERE source_seq % 10 = 0
  UNION ALL
  SELECT transaction_id || '-unknown', is_fraud, 'chargeback', us + {unit}, source_seq * 4 + 2
  FROM tx WHERE source_seq % 250 = 0
  UNION ALL
  SELECT transaction_id, resolution = 'FRAUD', 'analyst', resolved_us, alert_id * 4 + 3
  FROM state WHERE resolution IS NOT NULL),
labels_all AS (
  SELECT l.transaction_id,
         arg_max(l.is_fraud, (l.confirmed_us, l.label_seq)) AS is_fraud,
         arg_max(l.source, (l.confirmed_us, l.label_seq)) AS source,
         max(l.confirmed_us) AS confirmed_us, count(*) AS versions
  FROM label_log l SEMI JOIN tx USING (transaction_id)
  GROUP BY l.transaction_id),
labels AS (
  SELECT l.transaction_id,
         arg_max(l.is_fraud, (l.confirmed_us, l.label_seq)) AS is_fraud,
         arg_max(l.source, (l.confirmed_us, l.label_seq)) AS source,
         max(l.confirmed_us) AS confirmed_us, count(*) AS versions
  FROM label_log l SEMI JOIN tx USING (transaction_id)
  WHERE l.confirmed_us <= (SELECT as_of_us FROM as_of)
  GROUP BY l.transaction_id)"""
