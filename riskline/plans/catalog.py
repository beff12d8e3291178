"""Registered queries: name -> (spark builder, DuckDB twin).

Each builder takes (spark, sf_dir) and returns a DataFrame whose columns are
flat (strings, longs, ints, doubles rounded to 6 places) so the twin compares
value for value.  Time-relative queries use ``as_of`` = latest event time in
the data, never the wall clock.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskline import constants as C
from riskline.plans import sql_twins as S
from riskline.plans.scoring import score_batch
from riskline.operators import window_metrics as WM
from riskline.operators.features import arrival_features, online_features
from riskline.session import materialize, prepare
from riskline.sources.adapter import COMPRESSED_SCALE, transactions_from_events, transactions_from_orders
from riskline.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TWINS: dict[str, str] = {}


def register(name: str, twin: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if twin is not None:
            TWINS[name] = twin
        return fn
    return deco


def r6(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def transactions(spark: SparkSession, sf_dir: str, source: str = "events", scale: int = 1) -> DataFrame:
    prepare(spark)
    if source == "events":
        return transactions_from_events(read_table(spark, sf_dir, "events"), scale)
    return transactions_from_orders(read_table(spark, sf_dir, "orders"), scale)


FEATURE_SQL = ", ".join(f"round({n}, 6) AS {n}" for n in C.ONLINE_FEATURES)


def _feature_query(source: str, scale: int):
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        feats = online_features(transactions(spark, sf_dir, source, scale))
        return feats.select("transaction_id", *[r6(n).alias(n) for n in C.ONLINE_FEATURES])
    twin = S.with_ctes(S.tx_cte(source, scale), S.features_cte()) + f" SELECT transaction_id, {FEATURE_SQL} FROM feat"
    return build, twin


for _name, _src, _scale in [
    ("features_events_raw", "events", 1),
    ("features_events_compressed", "events", COMPRESSED_SCALE),
    ("features_orders", "orders", 1),
]:
    _b, _t = _feature_query(_src, _scale)
    register(_name, _t)(_b)


#: Arrival slices of the stream-order query: shuffled against event time.
ARRIVALS = 4


@register("features_by_arrival", S.with_ctes(
    S.tx_cte("events", COMPRESSED_SCALE),
    S.features_cte(history=f"(h.source_seq * 7919) % {ARRIVALS} <= (t.source_seq * 7919) % {ARRIVALS}"))
    + f" SELECT transaction_id, {FEATURE_SQL} FROM feat")
def q_features_by_arrival(spark, sf_dir):
    """Four micro-batches in shuffled order, each scored against what had arrived."""
    tx = transactions(spark, sf_dir, "events", COMPRESSED_SCALE)
    arrival = F.pmod(F.col("source_seq") * 7919, F.lit(ARRIVALS))
    out = None
    for k in range(ARRIVALS):
        feats = arrival_features(tx.where(arrival == k), tx.where(arrival < k))
        out = feats if out is None else out.unionByName(feats)
    return out.select("transaction_id", *[r6(n).alias(n) for n in C.ONLINE_FEATURES])


def _score_query(source: str, scale: int):
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        scored = score_batch(transactions(spark, sf_dir, source, scale), with_snapshot=False)
        return scored.select(
            "transaction_id", r6("fraud_probability").alias("fraud_probability"), "risk_score", "decision",
            F.array_join("rule_reasons", "|").alias("rule_reasons"), "model_version",
        )
    twin = S.with_ctes(S.tx_cte(source, scale), S.features_cte(), S.scored_cte()) + """
 SELECT transaction_id, round(fraud_probability, 6) AS fraud_probability, risk_score, decision,
        array_to_string(reasons, '|') AS rule_reasons, model_version FROM scored"""
    return build, twin


for _name, _src, _scale in [
    ("score_events_compressed", "events", COMPRESSED_SCALE),
    ("score_events_raw", "events", 1),
    ("score_orders", "orders", 1),
]:
    _b, _t = _score_query(_src, _scale)
    register(_name, _t)(_b)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["score_events_compressed"](spark, sf_dir)


# ---------------------------------------------------------------------------
# Store-based queries: alerts, workflow fold, labels, read models
# ---------------------------------------------------------------------------
from riskline.operators import readmodels as RM  # noqa: E402
from riskline.operators.features import offline_features, skew_report  # noqa: E402
from riskline.plans.scoring import alerts_from, explanations_for, first_write_wins  # noqa: E402
from riskline.plans.scoring import merchant_dimension, user_dimension  # noqa: E402
from riskline.plans.store import CaseFrames, build_store  # noqa: E402

ST = S.store_ctes()

FEED = RM.FeedFilter(hours=1, limit=100, offset=20, min_risk=5, max_risk=100, country="us", min_amount=5.0)


def _impact_sql() -> str:
    parts = []
    for pos, (name, w, cap) in enumerate(C.REASON_WEIGHTS):
        v = name if cap is None else f"least({name}, {cap})"
        label = C.FACTOR_LABELS[name].replace("'", "''")
        parts.append(f"{{'pos': {pos}, 'feature': '{label}', 'impact': {v} * {w}}}")
    return "[" + ", ".join(parts) + "]"


@register("explain_reason_codes", ST + f""",
fac AS (SELECT s.transaction_id, unnest({_impact_sql()}) AS f
        FROM scored s SEMI JOIN alerts a USING (transaction_id)),
rk AS (SELECT transaction_id, (f).pos AS pos, (f).feature AS feature, (f).impact AS impact,
              row_number() OVER (PARTITION BY transaction_id ORDER BY abs((f).impact) DESC, (f).pos) AS position
       FROM fac)
SELECT transaction_id, position, feature, round(round_even(impact, 4), 6) AS impact, 'increases_risk' AS direction
FROM rk WHERE position <= {C.REASON_LIMIT} AND impact <> 0""")
def q_explain(spark, sf_dir):
    return explanations_for(build_store(spark, sf_dir).flagged).withColumn("impact", r6("impact"))


@register("alerts", ST + " SELECT alert_id, transaction_id, severity, status, created_us FROM alerts")
def q_alerts(spark, sf_dir):
    return alerts_from(build_store(spark, sf_dir).decided).select("alert_id", "transaction_id", "severity", "status", "created_us")


@register("alert_update_fold", ST + " SELECT alert_id, seq, status, code FROM folded")
def q_fold(spark, sf_dir):
    return build_store(spark, sf_dir).cases.folded.select("alert_id", "seq", "status", "code")


@register("alert_state", ST + """ SELECT alert_id, transaction_id, severity, status, analyst_note, resolution,
 resolved_us, created_us FROM state""")
def q_state(spark, sf_dir):
    return build_store(spark, sf_dir).cases.state


@register("analyst_labels", ST + """ SELECT transaction_id, resolution = 'FRAUD' AS is_fraud, 'analyst' AS source,
 resolved_us AS confirmed_us FROM state WHERE resolution IS NOT NULL""")
def q_analyst_labels(spark, sf_dir):
    from riskline.operators.cases import analyst_labels
    return analyst_labels(build_store(spark, sf_dir).cases.state).drop("label_seq")


@register("labels_latest", ST + " SELECT transaction_id, is_fraud, source, confirmed_us, versions FROM labels_all")
def q_labels_latest(spark, sf_dir):
    return build_store(spark, sf_dir).labels(as_of=False)


@register("labels_rejected", ST + """ SELECT transaction_id, label_seq FROM label_log l
 ANTI JOIN tx USING (transaction_id)""")
def q_labels_rejected(spark, sf_dir):
    return build_store(spark, sf_dir).rejected_labels().select("transaction_id", "label_seq")


@register("dim_users", S.with_ctes(S.tx_cte("events", 1)) + " SELECT user_id, min(us) AS created_us FROM tx GROUP BY 1")
def q_dim_users(spark, sf_dir):
    return user_dimension(transactions(spark, sf_dir))


@register("dim_merchants", S.with_ctes(S.tx_cte("events", 1)) + """
 SELECT merchant_id, arg_max(merchant_category, (us, transaction_id)) AS category,
        arg_max(country, (us, transaction_id)) AS country, min(us) AS created_us FROM tx GROUP BY 1""")
def q_dim_merchants(spark, sf_dir):
    return merchant_dimension(transactions(spark, sf_dir))


_FEED_WHERE = f"""t.us >= (SELECT as_of_us FROM as_of) - {FEED.hours * C.HOUR_US}
   AND s.risk_score >= {FEED.min_risk} AND s.risk_score <= {FEED.max_risk}
   AND t.country = '{FEED.country.upper()}' AND t.amount >= {FEED.min_amount}"""


@register("feed_page", ST + f"""
 SELECT t.transaction_id, t.us AS timestamp_us, t.user_id, t.merchant_id, t.merchant_category, t.amount,
        'USD' AS currency, t.country, s.risk_score, round(s.fraud_probability, 6) AS fraud_probability, s.decision,
        s.model_version, st.status AS case_status, st.resolution,
        CASE WHEN l.is_fraud THEN 'FRAUD' WHEN l.is_fraud IS NOT NULL THEN 'LEGITIMATE' END AS confirmed_label
 FROM tx t JOIN scored s USING (transaction_id)
 LEFT JOIN state st ON st.transaction_id = t.transaction_id
 LEFT JOIN labels l ON l.transaction_id = t.transaction_id
 WHERE {_FEED_WHERE}
 ORDER BY t.us DESC, t.transaction_id LIMIT {FEED.limit} OFFSET {FEED.offset}""")
def q_feed_page(spark, sf_dir):
    st = build_store(spark, sf_dir)
    page = materialize(RM.feed_rows(st.decided, FEED, st.as_of_us))  # at most FEED.limit rows
    state = CaseFrames(spark, alerts_from(page)).state
    return RM.feed_page(page, state, st.labels_of(page, state)).withColumn("fraud_probability", r6("fraud_probability"))


@register("feed_total", ST + f"""
 SELECT count(*) AS total FROM tx t JOIN scored s USING (transaction_id) WHERE {_FEED_WHERE}""")
def q_feed_total(spark, sf_dir):
    st = build_store(spark, sf_dir)
    return RM.feed_total(st.decided, FEED, st.as_of_us)


@register("overview_kpis", S.store_ctes(1) + f"""
 SELECT count(*) AS transactions_24h,
        count(*) FILTER (WHERE s.decision = 'APPROVE') AS approved,
        count(*) FILTER (WHERE s.decision = 'MANUAL_REVIEW') AS manual_review,
        count(*) FILTER (WHERE s.decision = 'BLOCK') AS blocked
 FROM tx t LEFT JOIN scored s USING (transaction_id)
 WHERE t.us >= (SELECT as_of_us FROM as_of) - {24 * C.HOUR_US}""")
def q_overview(spark, sf_dir):
    st = build_store(spark, sf_dir, 1)
    return RM.overview(st.txns, st.predictions, st.as_of_us, 24)


@register("decisions_last_hour", ST + f"""
 SELECT s.decision, count(*) AS transactions FROM tx t JOIN scored s USING (transaction_id)
 WHERE t.us >= (SELECT as_of_us FROM as_of) - {C.HOUR_US} GROUP BY 1""")
def q_decisions_hour(spark, sf_dir):
    st = build_store(spark, sf_dir)
    return RM.decisions_since(st.txns, st.predictions, st.as_of_us, 1)


@register("risk_distribution", ST + " SELECT risk_score, count(*) AS count FROM scored GROUP BY 1")
def q_risk_distribution(spark, sf_dir):
    return RM.risk_distribution(build_store(spark, sf_dir).predictions)


@register("model_performance", ST + """,
j AS (SELECT l.is_fraud, s.decision = 'BLOCK' AS pos FROM labels l JOIN scored s USING (transaction_id)),
c AS (SELECT count(*) AS n, count(*) FILTER (WHERE is_fraud AND pos) AS tp,
             count(*) FILTER (WHERE NOT is_fraud AND pos) AS fp, count(*) FILTER (WHERE is_fraud AND NOT pos) AS fn
      FROM j),
pr AS (SELECT n, tp / greatest(tp + fp, 1) AS p, tp / greatest(tp + fn, 1) AS r FROM c)
SELECT CASE WHEN n > 0 THEN 'available' ELSE 'awaiting_labels' END AS status, n AS labeled_transactions,
       round(p, 6) AS precision, round(r, 6) AS recall, round(2 * p * r / greatest(p + r, 1e-12), 6) AS f1 FROM pr""")
def q_model_performance(spark, sf_dir):
    st = build_store(spark, sf_dir)
    return RM.model_performance(st.labels(), st.predictions)


@register("investigation_recent", ST + f""",
c AS (SELECT a.transaction_id, h.transaction_id AS recent_transaction_id, h.us AS recent_us, h.amount, h.country,
             h.merchant_id, h.risk_score, h.decision,
             row_number() OVER (PARTITION BY a.transaction_id ORDER BY h.us DESC, h.transaction_id DESC) AS recent_rank
      FROM alerts a JOIN scored t USING (transaction_id)
      JOIN scored h ON h.user_id = t.user_id AND h.us <= t.us AND h.transaction_id <> t.transaction_id)
SELECT transaction_id, recent_rank, recent_transaction_id, recent_us, amount, country, merchant_id, risk_score, decision
FROM c WHERE recent_rank <= {RM.RECENT_ROWS}""")
def q_investigation_recent(spark, sf_dir):
    columns = ["transaction_id", "user_id", "us", "amount", "currency", "country", "merchant_id", "risk_score", "decision"]
    rows = materialize(build_store(spark, sf_dir).decided.select(*columns))  # scored once, read several times
    return RM.recent_user_rows(rows, rows.where(F.col("decision") != "APPROVE"))


#: Some stored predictions have lost their snapshot, some alerts are not explained yet.
LOST_SNAPSHOT, PENDING = 7, 3


def _stored_snapshots(st) -> DataFrame:
    lost = F.pmod(F.col("source_seq"), F.lit(LOST_SNAPSHOT)) == 0
    return st.scored.select("transaction_id", "risk_score", "decision",
                            F.when(~lost, F.col("feature_snapshot")).alias("feature_snapshot"))


def _explained(st) -> DataFrame:
    done = st.alerts.where(F.pmod("alert_id", F.lit(PENDING)) != 0).select("transaction_id")
    return explanations_for(st.flagged.join(done, "transaction_id", "left_semi"))


@register("investigation_header", ST + f"""
 SELECT st.transaction_id, st.alert_id, st.status, st.resolution, s.risk_score, s.decision,
        CASE WHEN s.source_seq % {LOST_SNAPSHOT} = 0 THEN 'unavailable' ELSE 'available' END AS feature_snapshot_status,
        CASE WHEN st.alert_id % {PENDING} <> 0 THEN 'complete' WHEN s.source_seq % {LOST_SNAPSHOT} <> 0 THEN 'fallback'
             ELSE 'unavailable' END AS explanation_status,
        CASE WHEN l.is_fraud THEN 'FRAUD' WHEN l.is_fraud IS NOT NULL THEN 'LEGITIMATE' END AS confirmed_label
 FROM state st JOIN scored s USING (transaction_id) LEFT JOIN labels l USING (transaction_id)""")
def q_investigation_header(spark, sf_dir):
    st = build_store(spark, sf_dir)
    return RM.investigation(_stored_snapshots(st), st.cases.state, _explained(st), st.labels())


@register("alerts_newest", ST + f"""
 SELECT alert_id, transaction_id, severity, status, created_us,
        CASE WHEN alert_id % {PENDING} <> 0 THEN 'complete' ELSE 'pending' END AS explanation_status
 FROM state ORDER BY created_us DESC, alert_id DESC LIMIT 100""")
def q_alerts_newest(spark, sf_dir):
    st = build_store(spark, sf_dir)
    return RM.alerts_list(st.cases.state, _explained(st), 100)


@register("latency_p95", S.with_ctes(S.tx_cte("events", 1)) + """
 SELECT epoch_us(time_bucket(INTERVAL 5 MINUTE, ts)) AS window_us, count(*) AS predictions,
        round(quantile_cont(source_seq % 83 + 1, 0.95), 6) AS p95_ms
 FROM tx WHERE source_seq % 17 <> 0 GROUP BY 1""")
def q_latency(spark, sf_dir):
    seq = F.col("source_seq")
    timed = transactions(spark, sf_dir).select(
        F.col("timestamp").alias("created_at"),
        F.when(F.pmod(seq, F.lit(17)) != 0, (F.pmod(seq, F.lit(83)) + 1).cast("double")).alias("processing_time_ms"))
    return RM.latency_p95(timed).withColumn("p95_ms", r6("p95_ms"))


METRIC_QUANTILES = {"p50": 0.5, "p95": 0.95}


@register("daily_window_metrics", S.with_ctes(S.tx_cte("events", 1)) + f"""
 SELECT us - us % {C.DAY_US} AS window_us, count(*) AS n, count(DISTINCT user_id) AS exact_ids,
        true AS ids_ok, true AS p50_ok, true AS p95_ok
 FROM tx GROUP BY 1""")
def q_daily_window_metrics(spark, sf_dir):
    rows = transactions(spark, sf_dir).select("timestamp", "user_id", F.round(F.col("amount") * 100).cast("long").alias("cents"))
    days = WM.merge_windows(WM.window_sketches(rows, "cents", "user_id"), 1440)
    return WM.within_bounds(WM.read_windows(days, METRIC_QUANTILES), rows, "cents", "user_id", 1440, METRIC_QUANTILES)


@register("decisions_per_minute", ST + """
 SELECT epoch_us(time_bucket(INTERVAL 1 MINUTE, t.ts)) AS minute_us, s.decision, count(*) AS n
 FROM tx t JOIN scored s USING (transaction_id) GROUP BY ALL""")
def q_decisions_per_minute(spark, sf_dir):
    st = build_store(spark, sf_dir)
    return RM.decisions_per_minute(st.txns, st.predictions)


_SIGNAL_SQL = " UNION ALL ".join(
    f"SELECT transaction_id, '{s}' AS signal, round({s}, {1 if s == 'travel_speed_kmh' else 6}) AS value "
    f"FROM scored SEMI JOIN alerts USING (transaction_id)"
    for s in RM.BEHAVIOUR_SIGNALS
)


@register("behaviour_signals", ST + " " + _SIGNAL_SQL)
def q_behaviour(spark, sf_dir):
    st = build_store(spark, sf_dir)
    return RM.behaviour_signals(st.scored, st.flagged)


@register("first_write_wins", S.with_ctes(S.tx_cte("events", 1)) + """,
incoming AS (
  SELECT transaction_id, amount, source_seq FROM tx
  UNION ALL SELECT transaction_id, amount * 2, source_seq + 1000000000000 FROM tx WHERE source_seq % 13 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY source_seq) AS rn,
             count(*) OVER (PARTITION BY transaction_id) AS arrivals FROM incoming)
SELECT transaction_id, amount, arrivals FROM r WHERE rn = 1""")
def q_first_write_wins(spark, sf_dir):
    tx = transactions(spark, sf_dir)
    replay = tx.where(F.pmod("source_seq", F.lit(13)) == 0).select(
        "transaction_id", (F.col("amount") * 2).alias("amount"), (F.col("source_seq") + 10**12).alias("source_seq"))
    incoming = tx.select("transaction_id", "amount", "source_seq").unionByName(replay)
    arrivals = incoming.groupBy("transaction_id").agg(F.count(F.lit(1)).alias("arrivals"))
    return first_write_wins(incoming, None).join(arrivals, "transaction_id").select(
        "transaction_id", "amount", "arrivals")


OFFLINE_COLS = ["user_average_amount", "user_median_amount", "amount_vs_user_average", "hour", "weekday",
                "new_merchant", "new_country", "new_device", "transactions_last_5m", "transactions_last_1h",
                "transactions_last_24h"]


def offline_cte(source: str = "orders") -> str:
    return S.with_ctes(S.tx_cte(source, 1)) + f""",
o1 AS (
  SELECT *,
    coalesce(avg(amount) OVER (PARTITION BY user_id ORDER BY us, transaction_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), amount) AS user_average_amount,
    coalesce(median(amount) OVER (PARTITION BY user_id ORDER BY us, transaction_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), amount) AS user_median_amount,
    CAST(hour(ts) AS DOUBLE) AS hour, CAST(isodow(ts) - 1 AS DOUBLE) AS weekday,
    row_number() OVER (PARTITION BY user_id ORDER BY us, transaction_id) AS urn,
    row_number() OVER (PARTITION BY user_id, merchant_id ORDER BY us, transaction_id) AS mrn,
    row_number() OVER (PARTITION BY user_id, country ORDER BY us, transaction_id) AS crn,
    row_number() OVER (PARTITION BY user_id, device_id ORDER BY us, transaction_id) AS drn,
    CAST(count(*) OVER (PARTITION BY user_id ORDER BY us RANGE BETWEEN {5 * C.MINUTE_US} PRECEDING AND 1 PRECEDING)
         AS DOUBLE) AS transactions_last_5m,
    CAST(count(*) OVER (PARTITION BY user_id ORDER BY us RANGE BETWEEN {C.HOUR_US} PRECEDING AND 1 PRECEDING)
         AS DOUBLE) AS transactions_last_1h,
    CAST(count(*) OVER (PARTITION BY user_id ORDER BY us RANGE BETWEEN {C.DAY_US} PRECEDING AND 1 PRECEDING)
         AS DOUBLE) AS transactions_last_24h
  FROM tx),
offline AS (
  SELECT *, amount / greatest(user_average_amount, 0.01) AS amount_vs_user_average,
    CASE WHEN urn > 1 AND mrn = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS new_merchant,
    CASE WHEN urn > 1 AND crn = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS new_country,
    CASE WHEN urn > 1 AND drn = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS new_device
  FROM o1)"""


@register("features_offline", offline_cte() + " SELECT transaction_id, "
          + ", ".join(f"round({c}, 6) AS {c}" for c in OFFLINE_COLS) + " FROM offline")
def q_features_offline(spark, sf_dir):
    off = offline_features(transactions(spark, sf_dir, "orders"))
    return off.select("transaction_id", *[r6(c).alias(c) for c in OFFLINE_COLS])


_SKEW = ["amount", "hour", "weekday", "user_average_amount", "user_median_amount", "amount_vs_user_average",
         "transactions_last_5m", "transactions_last_1h", "transactions_last_24h", "new_merchant", "new_country",
         "new_device"]


@register("feature_skew", offline_cte() + ", " + S.features_cte()[1:] + ",\n"
          + "sk AS (SELECT count(*) AS rows, "
          + ", ".join(f"count(*) FILTER (WHERE abs(f.{c} - o.{c}) > 1e-9) AS {c}" for c in _SKEW)
          + " FROM feat f JOIN offline o USING (transaction_id))\n"
          + " UNION ALL ".join(f"SELECT '{c}' AS feature, rows, {c} AS differing, "
                               f"round({c} / greatest(rows, 1), 6) AS share FROM sk" for c in _SKEW))
def q_feature_skew(spark, sf_dir):
    tx = transactions(spark, sf_dir, "orders")
    return skew_report(online_features(tx), offline_features(tx), names=_SKEW)


# ---------------------------------------------------------------------------
# Ordering (H1), evaluation (M01, M06-M09, M13), drift (R01-R04), S02
# ---------------------------------------------------------------------------
from riskline.operators import drift as D  # noqa: E402
from riskline.operators import evaluate as EV  # noqa: E402
from riskline.operators.ordering import chronological_split, evenly_spaced  # noqa: E402

DOWNSAMPLE_ROWS = 2500


def scored_events(spark, sf_dir, scale=COMPRESSED_SCALE) -> DataFrame:
    return score_batch(transactions(spark, sf_dir, "events", scale), with_snapshot=False)


def eval_frame(scored: DataFrame) -> DataFrame:
    return materialize(scored.select("transaction_id", "us", F.col("is_fraud").cast("int").alias("label"), "amount",
                         F.col("fraud_probability").alias("probability")))


SCORED_C = S.with_ctes(S.tx_cte("events", COMPRESSED_SCALE), S.features_cte(), S.scored_cte())
SCORED_R = S.with_ctes(S.tx_cte("events", 1), S.features_cte(), S.scored_cte())
EV_SQL = """,
ev AS (SELECT transaction_id, us, CAST(is_fraud AS INTEGER) AS label, amount, fraud_probability AS probability
       FROM scored),
split AS (SELECT *, row_number() OVER (ORDER BY us, transaction_id) - 1 AS row_index, count(*) OVER () AS n FROM ev),
sliced AS (SELECT *, CASE WHEN row_index < CAST(floor(n * 0.5) AS BIGINT) THEN 'train'
                          WHEN row_index < CAST(floor(n * 0.65) AS BIGINT) THEN 'selection'
                          WHEN row_index < CAST(floor(n * 0.75) AS BIGINT) THEN 'calibration'
                          WHEN row_index < CAST(floor(n * 0.85) AS BIGINT) THEN 'threshold'
                          ELSE 'test' END AS split FROM split)"""


def threshold_sql(src: str, tag: str, cfg: EV.CostConfig = EV.CostConfig()) -> str:
    pairs = EV.threshold_grid()
    ths = sorted({r for _, r, _ in pairs} | {b for _, _, b in pairs})
    idx = {t: i + 1 for i, t in enumerate(ths)}
    th_list = "[" + ", ".join(f"CAST('{t!r}' AS DOUBLE)" for t in ths) + "]"
    grid = ", ".join(f"({o}, CAST('{r!r}' AS DOUBLE), CAST('{b!r}' AS DOUBLE), {idx[r]}, {idx[b]})"
                     for o, r, b in pairs)
    keep = repr(1 - cfg.review_catch_rate)
    return f""",
{tag}_b AS (SELECT len(list_filter({th_list}, lambda t: t <= probability)) AS j, label, amount FROM {src}),
{tag}_per AS (SELECT j, count(*) AS n, sum(CASE WHEN label = 1 THEN amount ELSE 0.0 END) AS fa,
                     count(*) FILTER (WHERE label = 0) AS legit FROM {tag}_b GROUP BY j),
{tag}_all AS (SELECT a.range AS j, coalesce(p.n, 0) AS n, coalesce(p.fa, 0.0) AS fa, coalesce(p.legit, 0) AS legit
              FROM range(0, {len(ths) + 1}) a LEFT JOIN {tag}_per p ON p.j = a.range),
{tag}_below AS (SELECT j,
      coalesce(sum(n) OVER (ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS n_below,
      coalesce(sum(fa) OVER (ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS fa_below,
      coalesce(sum(legit) OVER (ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS legit_below,
      sum(n) OVER () AS n_total, sum(legit) OVER () AS legit_total FROM {tag}_all),
{tag}_grid(ord, review, block, jr, jb) AS (VALUES {grid}),
{tag}_priced AS (
  SELECT g.ord, g.review, g.block,
         r.fa_below + (b.fa_below - r.fa_below) * {keep} + (b.legit_total - b.legit_below) * {cfg.false_positive_cost}
           + (b.n_below - r.n_below) * {cfg.review_cost} AS cost,
         (b.n_below - r.n_below) / greatest(b.n_total, 1) AS rate
  FROM {tag}_grid g JOIN {tag}_below r ON r.j = g.jr JOIN {tag}_below b ON b.j = g.jb),
{tag}_top AS (SELECT * FROM {tag}_priced WHERE rate <= {cfg.max_review_rate} ORDER BY cost, ord LIMIT 1),
{tag} AS (SELECT coalesce(round(t.review, 2), {C.REVIEW_THRESHOLD}) AS review_threshold,
                 coalesce(round(t.block, 2), {C.BLOCK_THRESHOLD}) AS block_threshold,
                 coalesce(t.cost, CAST('inf' AS DOUBLE)) AS expected_cost
          FROM (SELECT 1 AS one) d LEFT JOIN {tag}_top t ON true)"""


def cost_sql(src: str, review: str, block: str, cfg: EV.CostConfig = EV.CostConfig()) -> str:
    keep = repr(1 - cfg.review_catch_rate)
    return f"""coalesce(sum(
      CASE WHEN probability < {review} AND label = 1 THEN amount ELSE 0.0 END
    + CASE WHEN probability >= {review} AND probability < {block} AND label = 1 THEN amount * {keep} ELSE 0.0 END
    + CASE WHEN probability >= {block} AND label = 0 THEN {cfg.false_positive_cost} ELSE 0.0 END
    + CASE WHEN probability >= {review} AND probability < {block} THEN {cfg.review_cost} ELSE 0.0 END), 0.0)"""


@register("chronological_split", SCORED_C + EV_SQL + " SELECT transaction_id, row_index, split FROM sliced")
def q_split(spark, sf_dir):
    ev = eval_frame(scored_events(spark, sf_dir))
    return chronological_split(ev).select("transaction_id", "row_index", "split")


@register("even_downsample", S.with_ctes(S.tx_cte("events", 1)) + f""",
o AS (SELECT transaction_id, row_number() OVER (ORDER BY us, transaction_id) - 1 AS idx, count(*) OVER () AS n
      FROM tx)
SELECT transaction_id FROM o
WHERE n <= {DOWNSAMPLE_ROWS}
   OR ((((idx * {DOWNSAMPLE_ROWS - 1}) + (n - 2)) // (n - 1)) * (n - 1)) // {DOWNSAMPLE_ROWS - 1} = idx""")
def q_downsample(spark, sf_dir):
    tx = transactions(spark, sf_dir)
    return evenly_spaced(tx, "us", ["transaction_id"], DOWNSAMPLE_ROWS).select("transaction_id")


@register("expected_cost_default", SCORED_C + EV_SQL
          + f" SELECT round({cost_sql('ev', C.REVIEW_THRESHOLD, C.BLOCK_THRESHOLD)}, 6) AS expected_cost FROM ev")
def q_cost_default(spark, sf_dir):
    ev = eval_frame(scored_events(spark, sf_dir))
    return EV.expected_cost(ev, C.REVIEW_THRESHOLD, C.BLOCK_THRESHOLD).select(r6("expected_cost").alias("expected_cost"))


@register("threshold_search", SCORED_C + EV_SQL + threshold_sql("ev", "best")
          + " SELECT review_threshold, block_threshold, round(expected_cost, 6) AS expected_cost FROM best")
def q_threshold_search(spark, sf_dir):
    ev = eval_frame(scored_events(spark, sf_dir))
    return EV.optimize_thresholds(ev).withColumn("expected_cost", r6("expected_cost"))


def _metrics_sql(src: str, thr) -> str:
    return f"""
 SELECT round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END, 6) AS precision,
        round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END, 6) AS recall,
        round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END, 6) AS f1,
        round(fp / greatest(fp + tn, 1), 6) AS false_positive_rate,
        round(fn / greatest(fn + tp, 1), 6) AS false_negative_rate
 FROM (SELECT count(*) FILTER (WHERE probability >= {thr} AND label = 1) AS tp,
              count(*) FILTER (WHERE probability >= {thr} AND label = 0) AS fp,
              count(*) FILTER (WHERE probability < {thr} AND label = 1) AS fn,
              count(*) FILTER (WHERE probability < {thr} AND label = 0) AS tn FROM {src})"""


_M8 = ["precision", "recall", "f1", "false_positive_rate", "false_negative_rate"]


@register("threshold_metrics", SCORED_C + EV_SQL + _metrics_sql("ev", C.BLOCK_THRESHOLD))
def q_threshold_metrics(spark, sf_dir):
    ev = eval_frame(scored_events(spark, sf_dir))
    return EV.threshold_metrics(ev, C.BLOCK_THRESHOLD).select(*[r6(c).alias(c) for c in _M8])


def _ranking_sql(src: str, tag: str = "rank_metrics") -> str:
    return f""",
{tag}_g AS (SELECT probability AS s, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg
       FROM {src} GROUP BY 1),
{tag}_c AS (SELECT *, sum(pos) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS cum_pos,
              sum(neg) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS cum_neg,
              sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM {tag}_g),
{tag} AS (SELECT sum(pos / P * (cum_pos / (cum_pos + cum_neg))) AS pr_auc,
                        sum(pos * ((N - cum_neg) + neg / 2.0)) / (max(P) * max(N)) AS roc_auc FROM {tag}_c)"""


@register("ranking_metrics", SCORED_C + EV_SQL + _ranking_sql("ev")
          + " SELECT round(pr_auc, 6) AS pr_auc, round(roc_auc, 6) AS roc_auc FROM rank_metrics")
def q_ranking(spark, sf_dir):
    ev = eval_frame(scored_events(spark, sf_dir))
    return EV.ranking_metrics(ev).select(r6("pr_auc").alias("pr_auc"), r6("roc_auc").alias("roc_auc"))


def _report_frame(ev_test: DataFrame, version: str, review, block) -> DataFrame:
    cost = EV.expected_cost(ev_test, review, block)
    rec = EV.threshold_metrics(ev_test, block).select("recall")
    rank = EV.ranking_metrics(ev_test).select(F.col("pr_auc"))
    parts = [cost.select(F.lit("test_expected_cost").alias("k"), F.col("expected_cost").alias("v")),
             rec.select(F.lit("test_recall").alias("k"), F.col("recall").alias("v")),
             rank.select(F.lit("test_pr_auc").alias("k"), F.col("pr_auc").alias("v"))]
    long = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return long.agg(*[F.max(F.when(F.col("k") == k, F.col("v"))).alias(k)
                      for k in ("test_expected_cost", "test_recall", "test_pr_auc")]
                    ).withColumn("model_version", F.lit(version))


@register("promotion_gates", SCORED_C + EV_SQL + """,
other AS (SELECT label, amount, split, (probability + least(amount / 400.0, 1.0)) / 2 AS probability FROM sliced),
thr_src AS (SELECT * FROM other WHERE split = 'threshold'),
test AS (SELECT * FROM sliced WHERE split = 'test'),
test2 AS (SELECT * FROM other WHERE split = 'test')""" + threshold_sql("thr_src", "tuned")
          + _ranking_sql("test", "rm1") + _ranking_sql("test2", "rm2") + f""",
champ AS (SELECT {cost_sql('test', C.REVIEW_THRESHOLD, C.BLOCK_THRESHOLD)} AS cost,
                 count(*) FILTER (WHERE probability >= {C.BLOCK_THRESHOLD} AND label = 1)
                   / greatest(count(*) FILTER (WHERE label = 1), 1) AS recall FROM test),
chall AS (SELECT {cost_sql('test2', '(SELECT review_threshold FROM tuned)', '(SELECT block_threshold FROM tuned)')} AS cost,
                 count(*) FILTER (WHERE probability >= (SELECT block_threshold FROM tuned) AND label = 1)
                   / greatest(count(*) FILTER (WHERE label = 1), 1) AS recall FROM test2),
gates AS (SELECT (SELECT pr_auc FROM rm2) >= (SELECT pr_auc FROM rm1) - {C.GATE_PR_AUC_TOLERANCE} AS g1,
                 chall.recall >= champ.recall - {C.GATE_RECALL_TOLERANCE} AS g2, chall.cost <= champ.cost AS g3
          FROM champ, chall)
SELECT 'bootstrap-default' AS champion_version, 'amount-blend' AS challenger_version, g1 AS gate_pr_auc,
       g2 AS gate_recall, g3 AS gate_business_cost, g1 AND g2 AND g3 AS promotion_recommended,
       false AS automatic_promotion
FROM gates""")
def q_promotion(spark, sf_dir):
    """The bootstrap score against a score that also looks at the amount."""
    ev = materialize(chronological_split(eval_frame(scored_events(spark, sf_dir))))
    blend = (F.col("probability") + F.least(F.col("amount") / 400.0, F.lit(1.0))) / 2
    other = ev.withColumn("probability", blend)
    tuned = EV.optimize_thresholds(other.where(F.col("split") == "threshold")).first()
    champion = _report_frame(ev.where(F.col("split") == "test"), "bootstrap-default", C.REVIEW_THRESHOLD,
                             C.BLOCK_THRESHOLD)
    challenger = _report_frame(other.where(F.col("split") == "test"), "amount-blend", tuned["review_threshold"],
                               tuned["block_threshold"])
    return EV.compare_reports(champion, challenger)


DRIFT_COLS = ["amount_psi", "amount_ks", "amount_ks_p_value", "probability_psi", "probability_ks",
              "probability_ks_p_value", "country_js"]


def _drift_inputs(spark, sf_dir):
    scored = scored_events(spark, sf_dir, 1).select(
        "transaction_id", "us", "amount", "country", "fraud_probability")
    split = materialize(chronological_split(materialize(scored)))
    reference = split.where(F.col("split") == "calibration")
    as_of = split.agg(F.max("us")).first()[0]
    current = split.where(F.col("us") >= F.lit(as_of - C.DAY_US))
    return reference, current, as_of


def _psi_sql(col: str, tag: str) -> str:
    qs = ", ".join(repr(i / C.PSI_BINS) for i in range(C.PSI_BINS + 1))
    return f""",
{tag}_e AS (SELECT list_sort(list_distinct(quantile_cont({col}, [{qs}]))) AS e FROM ref),
{tag}_rb AS (SELECT CASE WHEN r.{col} = e[len(e)] THEN len(e) - 2
                         ELSE len(list_filter(e, lambda x: x <= r.{col})) - 1 END AS bin
             FROM ref r, {tag}_e WHERE r.{col} >= e[1] AND r.{col} <= e[len(e)]),
{tag}_cb AS (SELECT CASE WHEN c.{col} = e[len(e)] THEN len(e) - 2
                         ELSE len(list_filter(e, lambda x: x <= c.{col})) - 1 END AS bin
             FROM cur c, {tag}_e WHERE c.{col} >= e[1] AND c.{col} <= e[len(e)]),
{tag}_bins AS (SELECT range AS bin FROM range(0, (SELECT len(e) - 1 FROM {tag}_e))),
{tag}_t AS (SELECT b.bin,
               (SELECT count(*) FROM {tag}_rb x WHERE x.bin = b.bin) AS rc,
               (SELECT count(*) FROM {tag}_cb x WHERE x.bin = b.bin) AS cc FROM {tag}_bins b),
{tag}_r AS (SELECT greatest(rc / greatest(sum(rc) OVER (), 1), {C.PSI_FLOOR}) AS rr,
                   greatest(cc / greatest(sum(cc) OVER (), 1), {C.PSI_FLOOR}) AS cr FROM {tag}_t),
{tag} AS (SELECT CASE WHEN (SELECT len(e) FROM {tag}_e) < 3 THEN 0.0
                      ELSE coalesce((SELECT sum((cr - rr) * ln(cr / rr)) FROM {tag}_r), 0.0) END AS v)"""


def _ks_sql(col: str, tag: str) -> str:
    """CTEs: the distance, and its p-value by lattice paths (share of paths by diagonals) or, for large slices, the series."""
    series = " + ".join(f"power(-1, {k - 1}) * exp(-2.0 * {k * k} * lam * lam)" for k in range(1, 101))
    return f""",
{tag}_u AS (SELECT {col} AS v, 1 AS a, 0 AS b FROM ref UNION ALL SELECT {col}, 0, 1 FROM cur),
{tag}_g AS (SELECT v, sum(a) AS a, sum(b) AS b FROM {tag}_u GROUP BY v),
{tag}_c AS (SELECT *, sum(a) OVER (ORDER BY v ROWS UNBOUNDED PRECEDING) AS ca,
                   sum(b) OVER (ORDER BY v ROWS UNBOUNDED PRECEDING) AS cb,
                   sum(a) OVER () AS n, sum(b) OVER () AS m FROM {tag}_g),
{tag}_h AS (SELECT CAST(max(abs(ca * m - cb * n)) AS BIGINT) AS h, CAST(max(n) AS BIGINT) AS n, CAST(max(m) AS BIGINT) AS m FROM {tag}_c),
{tag} AS (SELECT h / (n * m) AS d, n, m, h FROM {tag}_h),
{tag}_l AS (SELECT d, (sqrt(n * m / (n + m)) + 0.12 + 0.11 / sqrt(n * m / (n + m))) * d AS lam FROM {tag}),
{tag}_x AS (WITH RECURSIVE r AS (
    SELECT 0::BIGINT AS s, n, m, h, list_transform(range(0, n + 1), lambda i: 0.0::DOUBLE) AS u
    FROM {tag} WHERE greatest(n, m) <= {D.EXACT_ROWS}
    UNION ALL SELECT s + 1, n, m, h, list_transform(range(0, n + 1), lambda i:
      CASE WHEN i > s + 1 OR s + 1 - i > m THEN 0.0 WHEN abs(i * (n + m) - (s + 1) * n) >= h THEN 1.0
           ELSE (i * (CASE WHEN i > 0 THEN u[i] ELSE 0.0 END) + (s + 1 - i) * u[i + 1]) / (s + 1) END)
    FROM r WHERE s < n + m)
  SELECT CASE WHEN h <= 0 THEN 1.0 ELSE u[n + 1] END AS p FROM r WHERE s = n + m),
{tag}_p AS (SELECT coalesce((SELECT p FROM {tag}_x),
                            CASE WHEN d <= 0 THEN 1.0 ELSE least(greatest(2 * ({series}), 0.0), 1.0) END) AS p FROM {tag}_l)"""


_DRIFT_SLICES = f""",
tx_c AS (SELECT transaction_id, country FROM tx),
base AS (SELECT s.transaction_id, s.us, s.amount, s.probability AS fraud_probability, t.country, s.split
         FROM sliced s JOIN tx_c t USING (transaction_id)),
ref AS (SELECT * FROM base WHERE split = 'calibration'),
cur AS (SELECT * FROM base WHERE us >= (SELECT max(us) FROM base) - {C.DAY_US})"""


@register("ks_tests", SCORED_R + EV_SQL + _DRIFT_SLICES + _ks_sql("amount", "aks") + _ks_sql("fraud_probability", "pks")
          + "\n" + " UNION ALL ".join(
    f"SELECT '{col}' AS metric, n, m, round(d, 6) AS ks, round((SELECT p FROM {tag}_p), 6) AS p_value, "
    f"CASE WHEN greatest(n, m) <= {D.EXACT_ROWS} THEN 'exact' ELSE 'asymptotic' END AS method FROM {tag}"
    for col, tag in (("amount", "aks"), ("fraud_probability", "pks"))))
def q_ks_tests(spark, sf_dir):
    reference, current, _ = _drift_inputs(spark, sf_dir)
    return D.ks_tests(reference, current, ["amount", "fraud_probability"]).withColumns({c: r6(c) for c in ("ks", "p_value")})


@register("drift_report", SCORED_R + EV_SQL + _DRIFT_SLICES
          + _psi_sql("amount", "apsi") + _psi_sql("fraud_probability", "ppsi")
          + _ks_sql("amount", "aks") + _ks_sql("fraud_probability", "pks") + f""",
jr AS (SELECT country, count(*) AS r FROM ref GROUP BY 1),
jq AS (SELECT country, count(*) AS q FROM cur GROUP BY 1),
jj AS (SELECT coalesce(r, 0) / (SELECT count(*) FROM ref) AS p, coalesce(q, 0) / (SELECT count(*) FROM cur) AS q
       FROM jr FULL OUTER JOIN jq USING (country)),
js AS (SELECT coalesce(sum((CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0.0 END
                          + CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0.0 END) / 2), 0.0) AS v FROM jj),
rep AS (SELECT (SELECT v FROM apsi) AS amount_psi, (SELECT d FROM aks) AS amount_ks,
               (SELECT p FROM aks_p) AS amount_ks_p_value, (SELECT v FROM ppsi) AS probability_psi,
               (SELECT d FROM pks) AS probability_ks, (SELECT p FROM pks_p) AS probability_ks_p_value,
               (SELECT v FROM js) AS country_js, (SELECT count(*) FROM cur) AS rows,
               (SELECT max(us) FROM base) AS as_of)
SELECT '{C.BOOTSTRAP_VERSION}' AS model_version, as_of - {C.DAY_US} AS window_start_us, as_of AS window_end_us,
       rows, """ + ", ".join(f"round({c}, 6) AS {c}" for c in DRIFT_COLS) + f""",
       amount_psi >= {C.PSI_ALERT} OR probability_psi >= {C.PSI_ALERT} OR country_js >= {C.JS_ALERT} AS drift_detected
FROM rep WHERE rows >= {C.DRIFT_MIN_ROWS}""")
def q_drift(spark, sf_dir):
    reference, current, as_of = _drift_inputs(spark, sf_dir)
    rep = D.drift_report(reference, current, C.BOOTSTRAP_VERSION, as_of - C.DAY_US, as_of)
    return rep.select("model_version", "window_start_us", "window_end_us", "rows",
                      *[r6(c).alias(c) for c in DRIFT_COLS], "drift_detected")


# ---------------------------------------------------------------------------
# Validation
# ---------------------------------------------------------------------------
from riskline.functions import contract as K  # noqa: E402
from riskline.operators import validate as V  # noqa: E402
from riskline.sources.adapter import payloads_from_transactions  # noqa: E402

_ALLOWED = "[" + ", ".join(f"'{k}'" for k in C.TRANSACTION_KEYS) + "]"
_NUM = "('BIGINT', 'UBIGINT', 'DOUBLE', 'INTEGER', 'HUGEINT')"


def _dealt_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions over all cores: JSON validation is CPU-bound and the table has one row group."""
    return transactions(spark, sf_dir).repartition(spark.sparkContext.defaultParallelism)


def _payload_sql() -> str:
    iso = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')"
    return S.with_ctes(S.tx_cte("events", 1)) + f""",
pl AS (
  SELECT source_seq, source_seq % 50 AS r, * EXCLUDE (source_seq) FROM tx),
payloads AS (
  SELECT source_seq, CASE WHEN r = 9 THEN 'not-json-' || CAST(source_seq AS VARCHAR) ELSE
    '{{"schema_version":"1.0"'
    || ',"transaction_id":"' || CASE WHEN r = 12 THEN repeat('x', 65) ELSE transaction_id END || '"'
    || ',"user_id":' || CASE WHEN r = 16 THEN CAST(CAST(regexp_extract(user_id, '([0-9]+)$', 1) AS BIGINT) AS VARCHAR)
                             ELSE '"' || user_id || '"' END
    || CASE WHEN r = 13 THEN '' ELSE ',"merchant_id":"' || merchant_id || '"' END
    || ',"timestamp":' || CASE WHEN r = 1 THEN '"' || {iso} || '"'
                               WHEN r = 14 THEN '"' || strftime(make_timestamp(us + {2 * C.HOUR_US}),
                                                               '%Y-%m-%dT%H:%M:%S.%f') || '+02:00"'
                               WHEN r = 15 THEN CAST(us // 1000000 AS VARCHAR)
                               ELSE '"' || {iso} || 'Z"' END
    || ',"amount":' || CASE WHEN r = 3 THEN '0' WHEN r = 10 THEN '"' || CAST(amount AS VARCHAR) || '"'
                            WHEN r = 11 THEN '10000000.01' ELSE CAST(amount AS VARCHAR) END
    || CASE WHEN r = 17 THEN '' ELSE ',"currency":"' || CASE WHEN r = 4 THEN 'US' ELSE 'USD' END || '"' END
    || ',"merchant_category":"' || merchant_category || '"'
    || ',"country":"' || CASE WHEN r = 5 THEN lower(country) ELSE country END || '"'
    || ',"device_id":"' || device_id || '"'
    || ',"ip_address":"' || CASE WHEN r = 7 THEN '192.0.2.010' ELSE ip_address END || '"'
    || CASE WHEN r = 17 THEN '' ELSE ',"channel":"' || CASE WHEN r = 6 THEN 'WEB' ELSE channel END || '"' END
    || CASE WHEN r = 8 THEN ',"latitude":91.0' WHEN r = 18 THEN ',"latitude":null'
            WHEN latitude IS NOT NULL THEN ',"latitude":' || CAST(latitude AS VARCHAR) ELSE '' END
    || CASE WHEN r <> 18 AND longitude IS NOT NULL THEN ',"longitude":' || CAST(longitude AS VARCHAR) ELSE '' END
    || CASE WHEN r = 19 THEN ',"request_id":"00000000-0000-4000-8000-' || lpad(CAST(source_seq AS VARCHAR), 12, '0') || '"'
            WHEN r = 20 THEN ',"request_id":"req-' || CAST(source_seq AS VARCHAR) || '"' ELSE '' END
    || CASE WHEN r = 2 THEN ',"extra":1' ELSE '' END
    || '}}' END AS payload
  FROM pl),
pt AS (
  SELECT source_seq, payload,
         CASE WHEN json_valid(payload) THEN json_type(payload) = 'OBJECT' ELSE false END AS is_obj
  FROM payloads),
pv AS (
  SELECT source_seq, is_obj,
    CASE WHEN is_obj THEN json_keys(payload) END AS keys,
    """ + ",\n    ".join(
        f"CASE WHEN is_obj THEN json_type(payload, '$.{f}') END AS t_{f}, "
        f"CASE WHEN is_obj THEN json_extract_string(payload, '$.{f}') END AS s_{f}"
        for f in C.TRANSACTION_KEYS) + f"""
  FROM pt),
pc AS (
  SELECT *,
    CASE WHEN t_amount IN {_NUM} THEN CAST(s_amount AS DOUBLE)
         WHEN t_amount = 'VARCHAR' THEN TRY_CAST(s_amount AS DOUBLE) END AS amount,
    CASE WHEN t_latitude IN {_NUM} THEN CAST(s_latitude AS DOUBLE) END AS latitude,
    CASE WHEN t_longitude IN {_NUM} THEN CAST(s_longitude AS DOUBLE) END AS longitude,
    coalesce(
      CASE WHEN t_timestamp IN ('BIGINT', 'UBIGINT') THEN CAST(s_timestamp AS BIGINT) * 1000000
           WHEN t_timestamp = 'VARCHAR' AND regexp_full_match(s_timestamp, '{K.EPOCH[1:-1]}')
             THEN TRY_CAST(s_timestamp AS BIGINT) * 1000000 END,
      CASE WHEN t_timestamp = 'VARCHAR' AND regexp_matches(s_timestamp, '{K.ZONE}')
           THEN epoch_us(TRY_CAST(s_timestamp AS TIMESTAMPTZ)) END) AS us
  FROM pv),
checked AS (
  SELECT *, CASE WHEN NOT is_obj THEN ['malformed_json'] ELSE list_filter([
    CASE WHEN len(list_filter(keys, lambda k: NOT list_contains({_ALLOWED}, k))) > 0 THEN 'unknown_field' END,
    """ + ",\n    ".join(
        f"CASE WHEN NOT coalesce(t_{f} = 'VARCHAR' AND length(s_{f}) BETWEEN 1 AND 64, false) "
        f"THEN 'invalid_{f}' END" for f in K.ID_FIELDS) + f""",
    CASE WHEN NOT coalesce(amount > 0 AND amount <= {K.MAX_AMOUNT}, false) THEN 'invalid_amount' END,
    CASE WHEN NOT coalesce(t_currency IS NULL OR (t_currency = 'VARCHAR' AND length(s_currency) = 3), false)
         THEN 'invalid_currency' END,
    CASE WHEN NOT coalesce(t_country = 'VARCHAR' AND length(s_country) = 2, false) THEN 'invalid_country' END,
    CASE WHEN NOT coalesce(t_ip_address = 'VARCHAR' AND regexp_full_match(s_ip_address, '{K.IPV4[1:-1]}'), false)
         THEN 'invalid_ip_address' END,
    CASE WHEN NOT coalesce(t_channel IS NULL OR (t_channel = 'VARCHAR' AND s_channel IN ('web', 'mobile', 'pos')), false)
         THEN 'invalid_channel' END,
    CASE WHEN NOT (t_latitude IS NULL OR t_latitude = 'NULL'
                   OR coalesce(t_latitude IN {_NUM} AND latitude BETWEEN -90 AND 90, false)) THEN 'invalid_latitude' END,
    CASE WHEN NOT (t_longitude IS NULL OR t_longitude = 'NULL'
                   OR coalesce(t_longitude IN {_NUM} AND longitude BETWEEN -180 AND 180, false))
         THEN 'invalid_longitude' END,
    CASE WHEN NOT (t_request_id IS NULL OR t_request_id = 'NULL'
                   OR coalesce(t_request_id = 'VARCHAR' AND regexp_full_match(s_request_id, '{K.UUID[1:-1]}'), false))
         THEN 'invalid_request_id' END,
    CASE WHEN NOT (t_schema_version IS NULL OR coalesce(t_schema_version = 'VARCHAR', false))
         THEN 'invalid_schema_version' END,
    CASE WHEN us IS NULL THEN 'invalid_timestamp' END], lambda x: x IS NOT NULL) END AS errors
  FROM pc)"""


@register("contract_validation", _payload_sql() + """
 SELECT source_seq, len(errors) = 0 AS valid, array_to_string(errors, '|') AS errors,
        CASE WHEN len(errors) = 0 THEN s_transaction_id END AS transaction_id,
        CASE WHEN len(errors) = 0 THEN us END AS us,
        CASE WHEN len(errors) = 0 THEN round(amount, 6) END AS amount,
        CASE WHEN len(errors) = 0 THEN upper(coalesce(s_currency, 'USD')) END AS currency,
        CASE WHEN len(errors) = 0 THEN upper(s_country) END AS country,
        CASE WHEN len(errors) = 0 THEN coalesce(s_channel, 'web') END AS channel
 FROM checked""")
def q_contract(spark, sf_dir):
    checked = V.validate_payloads(payloads_from_transactions(_dealt_out(spark, sf_dir)))
    ok = F.col("valid")
    return checked.select(
        "source_seq", "valid", F.array_join("errors", "|").alias("errors"),
        F.when(ok, F.col("transaction_id")).alias("transaction_id"),
        F.when(ok, F.unix_micros("timestamp")).alias("us"),
        F.when(ok, r6("amount")).alias("amount"),
        F.when(ok, F.col("currency")).alias("currency"),
        F.when(ok, F.col("country")).alias("country"),
        F.when(ok, F.col("channel")).alias("channel"),
    )


@register("dead_letter_errors", _payload_sql() + """
 SELECT 'validator' AS component, e AS error_type, count(*) AS errors
 FROM checked, unnest(errors) AS u(e) GROUP BY ALL""")
def q_dlq_errors(spark, sf_dir):
    from riskline.operators.readmodels import errors_by_type
    checked = V.validate_payloads(payloads_from_transactions(_dealt_out(spark, sf_dir)))
    _, bad = V.split_valid(checked)
    return errors_by_type(bad)


_RAW_SQL = """
raw AS (SELECT event_id AS TRANSACTION_ID, ts AS TX_DATETIME, user_id AS CUSTOMER_ID,
               (event_id * 7919 + user_id * 31) % 500 AS TERMINAL_ID, value AS TX_AMOUNT,
               CAST((event_id % 97 = 0) OR (event_id % 37 = 0) AS INTEGER) AS TX_FRAUD FROM events)"""


@register("source_checks", "WITH" + _RAW_SQL + """
 SELECT 'negative_amount' AS "check", count(*) FILTER (WHERE TX_AMOUNT < 0) AS failures FROM raw
 UNION ALL SELECT 'non_binary_target', count(*) FILTER (WHERE TX_FRAUD NOT IN (0, 1)) FROM raw
 UNION ALL SELECT 'duplicate_id', CAST(coalesce(sum(c - 1), 0) AS BIGINT) FROM
   (SELECT TRANSACTION_ID, count(*) AS c FROM raw GROUP BY 1 HAVING count(*) > 1)""")
def q_source_checks(spark, sf_dir):
    return V.check_source(V.raw_source_from_events(read_table(prepare(spark), sf_dir, "events")))


@register("enriched_source", "WITH" + _RAW_SQL + f"""
 SELECT CAST(TRANSACTION_ID AS VARCHAR) AS transaction_id, epoch_us(TX_DATETIME) AS us,
        printf('user-%05d', CUSTOMER_ID) AS user_id, printf('merchant-%05d', TERMINAL_ID) AS merchant_id,
        TX_AMOUNT AS amount, TX_FRAUD AS is_fraud,
        {S._list(C.CATEGORIES)}[TERMINAL_ID % 6 + 1] AS merchant_category,
        {S._list(C.COUNTRIES)}[CASE WHEN TX_FRAUD = 1 THEN (CUSTOMER_ID + 2) % 5 ELSE CUSTOMER_ID % 5 END + 1] AS country,
        CASE WHEN TX_FRAUD = 1 THEN 'takeover-' || CAST(TRANSACTION_ID AS VARCHAR)
             ELSE printf('device-%05d', CUSTOMER_ID) END AS device_id,
        '192.0.2.' || CAST(CUSTOMER_ID % 253 + 1 AS VARCHAR) AS ip_address,
        {S._list(C.CHANNELS)}[TERMINAL_ID % 3 + 1] AS channel
 FROM raw WHERE TX_AMOUNT > 0""")
def q_enriched(spark, sf_dir):
    raw = V.raw_source_from_events(read_table(prepare(spark), sf_dir, "events"))
    return V.enrich(V.clean_source(raw)).drop("timestamp")


@register("training_frame_checks", offline_cte("events") + " SELECT " + " UNION ALL SELECT ".join(
    f"'nan_{f}' AS \"check\", count(*) FILTER (WHERE {f} IS NULL OR isnan({f})) AS failures FROM offline"
    for f in C.MODEL_FEATURES))
def q_training_checks(spark, sf_dir):
    return V.check_training_frame(offline_features(transactions(spark, sf_dir, "events")).withColumn(
        "is_fraud", F.col("is_fraud").cast("int")))


# ---------------------------------------------------------------------------
# Attribution (E02, E03), training pieces (M02, M04, R05), event projection (S05), F01
# ---------------------------------------------------------------------------
from riskline.operators import attribution as AT  # noqa: E402
from riskline.operators.ordering import exact_sample_by_rank  # noqa: E402
from riskline.operators.features import history_for  # noqa: E402

def _background(scored: DataFrame, features: list[str]) -> DataFrame:
    calib = chronological_split(scored.select("transaction_id", "us", *features)).where(
        F.col("split") == "calibration")
    return exact_sample_by_rank(calib, AT.BACKGROUND_ROWS, 42).select(*features)


def _rank_sql(column: str = "transaction_id", seed: int = 42) -> str:
    return f"CAST('0x' || substr(md5({column} || ':{seed}'), 1, 15) AS BIGINT)"


def _shapley_sql() -> str:
    """phi per alert and feature over all coalitions, plainly: coalition x background x alert."""
    f = AT.HEURISTIC_INPUTS
    mix = {n: f"CASE WHEN (c.k >> {j}) & 1 = 1 THEN x.{n} ELSE b.{n} END" for j, n in enumerate(f)}
    logit = (f"{C.HEURISTIC_INTERCEPT} + least({mix[f[0]]}, 15.0) * 0.12 + least({mix[f[1]]}, 10.0) * 0.22"
             f" + ({mix[f[2]]}) * 0.8 + ({mix[f[3]]}) * 0.7 + ({mix[f[4]]}) * 2.0")
    weights = AT.coalition_weights(len(f))
    phi = " UNION ALL ".join(
        f"SELECT transaction_id, '{n}' AS feature, sum(v * [{', '.join(repr(w) for w in weights[j])}][k + 1]) AS phi"
        f" FROM val GROUP BY transaction_id" for j, n in enumerate(f))
    return f""",
bgr AS (SELECT s.* FROM scored s JOIN sliced l USING (transaction_id) WHERE l.split = 'calibration'
        ORDER BY {_rank_sql("s.transaction_id")}, s.transaction_id LIMIT {AT.BACKGROUND_ROWS}),
val AS (SELECT x.transaction_id, c.k, avg(1.0 / (1.0 + exp(-({logit})))) AS v
        FROM scored x SEMI JOIN alerts USING (transaction_id) CROSS JOIN range(0, {1 << len(f)}) c(k) CROSS JOIN bgr b
        GROUP BY ALL),
phi AS ({phi}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY round(abs(phi), 9) DESC, feature) AS position
           FROM phi)
SELECT transaction_id, CAST(position AS INTEGER) AS position, feature, round(phi, 6) AS impact,
       CASE WHEN round(phi, 9) >= 0 THEN 'increases_risk' ELSE 'decreases_risk' END AS direction
FROM ranked WHERE position <= {C.REASON_LIMIT}"""


@register("alert_attributions", ST + EV_SQL + _shapley_sql())
def q_attributions(spark, sf_dir):
    scored = scored_events(spark, sf_dir)
    alerted = scored.where(F.col("decision") != "APPROVE")
    bg = _background(scored, AT.HEURISTIC_INPUTS)
    return AT.exact_attribution(alerted, bg, AT.HEURISTIC_INPUTS).drop("raw_phi")


@register("explain_pending_alerts", ST + f""",
fac AS (SELECT s.transaction_id, s.source_seq, unnest({_impact_sql()}) AS f
        FROM scored s JOIN alerts a USING (transaction_id) WHERE a.alert_id % {PENDING} = 0),
rk AS (SELECT transaction_id, source_seq, (f).pos AS pos, (f).feature AS feature, (f).impact AS impact,
              row_number() OVER (PARTITION BY transaction_id ORDER BY abs((f).impact) DESC, (f).pos) AS position
       FROM fac)
SELECT transaction_id, CASE WHEN source_seq % {LOST_SNAPSHOT} = 0 THEN 'reason_codes:recomputed'
                            ELSE 'reason_codes:snapshot' END AS method, position, feature,
       round(round_even(impact, 4), 6) AS impact, 'increases_risk' AS direction
FROM rk WHERE position <= {C.REASON_LIMIT} AND impact <> 0""")
def q_explain_pending(spark, sf_dir):
    """E03 as a stage: alerts without an explanation; lost snapshots are computed again from the transactions."""
    st = build_store(spark, sf_dir)
    pending = st.alerts.where(F.pmod("alert_id", F.lit(PENDING)) == 0)
    recomputed = online_features(st.txns).join(pending.select("transaction_id"), "transaction_id", "left_semi")
    return AT.explain_pending(pending, _stored_snapshots(st), recomputed).withColumn("impact", r6("impact"))


@register("class_balance", SCORED_R + EV_SQL + """
 SELECT count(*) FILTER (WHERE label = 0) AS negatives, count(*) FILTER (WHERE label = 1) AS positives,
        round(greatest(count(*) FILTER (WHERE label = 0) / greatest(count(*) FILTER (WHERE label = 1), 1), 1.0), 6)
          AS imbalance
 FROM sliced WHERE split = 'train'""")
def q_class_balance(spark, sf_dir):
    ev = chronological_split(eval_frame(scored_events(spark, sf_dir, 1)))
    train = ev.where(F.col("split") == "train")
    return train.agg(F.count(F.when(F.col("label") == 0, 1)).alias("negatives"),
                     F.count(F.when(F.col("label") == 1, 1)).alias("positives")).select(
        "negatives", "positives",
        F.round(F.greatest(F.col("negatives") / F.greatest(F.col("positives"), F.lit(1)), F.lit(1.0)), 6)
        .alias("imbalance"))


@register("undersample_counts", SCORED_R + EV_SQL + """
 SELECT label, CASE WHEN label = 1 THEN count(*) ELSE (SELECT count(*) FROM sliced WHERE split = 'train' AND label = 1)
        END AS rows
 FROM sliced WHERE split = 'train' GROUP BY label""")
def q_undersample(spark, sf_dir):
    from riskline.plans.training import class_balance, undersample
    ev = chronological_split(eval_frame(scored_events(spark, sf_dir, 1)))
    train = materialize(ev.where(F.col("split") == "train"))
    _, pos, _ = class_balance(train)
    return undersample(train, pos).groupBy("label").agg(F.count(F.lit(1)).alias("rows"))


@register("reference_sample", SCORED_R + EV_SQL + f"""
 SELECT s.transaction_id, s.amount, t.country, round(s.probability, 6) AS fraud_probability
 FROM sliced s JOIN tx t USING (transaction_id) WHERE s.split = 'calibration'
 ORDER BY {_rank_sql("s.transaction_id")}, s.transaction_id LIMIT 2000""")
def q_reference_sample(spark, sf_dir):
    reference, _, _ = _drift_inputs(spark, sf_dir)
    return D.reference_sample(reference).withColumn("fraud_probability", r6("fraud_probability"))


@register("event_projection", ST + """
 SELECT 'transactions.v1' AS topic, transaction_id AS event_key, transaction_id AS payload_id, merchant_id,
        NULL::INTEGER AS risk_score, NULL::VARCHAR AS decision, NULL::VARCHAR AS label_source FROM scored
 UNION ALL SELECT 'fraud_predictions.v1', transaction_id, transaction_id, NULL, risk_score, decision, NULL FROM scored
 UNION ALL SELECT 'fraud_alerts.v1', transaction_id, transaction_id, NULL, risk_score, decision, NULL FROM scored
  WHERE decision <> 'APPROVE'
 UNION ALL SELECT 'confirmed_labels.v1', transaction_id, transaction_id, NULL, NULL, NULL, source
  FROM label_log SEMI JOIN tx USING (transaction_id)""")
def q_event_projection(spark, sf_dir):
    from riskline.streaming.pipeline import event_projection
    st = build_store(spark, sf_dir)
    accepted = st.label_log.join(st.txns.select("transaction_id"), "transaction_id", "left_semi")
    field = lambda name: F.get_json_object("payload", f"$.{name}")
    return event_projection(st.decided, accepted).select(
        "topic", "event_key", field("transaction_id").alias("payload_id"), field("merchant_id").alias("merchant_id"),
        field("risk_score").cast("int").alias("risk_score"), field("decision").alias("decision"),
        field("source").alias("label_source"))


@register("history_pairs_alerts", S.with_ctes(S.tx_cte("events", COMPRESSED_SCALE), S.features_cte(),
                                              S.scored_cte()) + f"""
 SELECT t.transaction_id AS target_id, h.transaction_id, h.us
 FROM scored t JOIN tx h ON h.user_id = t.user_id AND h.us >= t.us - {C.HISTORY_DAYS * C.DAY_US} AND h.us < t.us
  AND h.transaction_id <> t.transaction_id
 WHERE t.decision <> 'APPROVE'""")
def q_history_pairs(spark, sf_dir):
    scored = scored_events(spark, sf_dir)
    targets = scored.where(F.col("decision") != "APPROVE").select("transaction_id", "user_id", "us")
    hist = transactions(spark, sf_dir, "events", COMPRESSED_SCALE).select("transaction_id", "user_id", "us")
    return history_for(targets, hist).select("target_id", "transaction_id", "us")


@register("model_info", f"""
 SELECT '{C.BOOTSTRAP_VERSION}' AS model_version, {C.REVIEW_THRESHOLD}::DOUBLE AS review_threshold,
        {C.BLOCK_THRESHOLD}::DOUBLE AS block_threshold, count(*) AS scored_rows, min(us) AS first_us, max(us) AS last_us
 FROM ({S.with_ctes(S.tx_cte("events", 1))} SELECT us FROM tx)""")
def q_model_info(spark, sf_dir):
    """Q07: the model in use and what it has scored."""
    from riskline.plans.training import model_info
    info = model_info(spark, None).first()  # one row
    seen = transactions(spark, sf_dir).agg(F.count(F.lit(1)).alias("scored_rows"), F.min("us").alias("first_us"),
                                           F.max("us").alias("last_us"))
    return seen.select(*[F.lit(info[c]).alias(c) for c in ("model_version", "review_threshold", "block_threshold")],
                       "scored_rows", "first_us", "last_us")


@register("stored_replies", S.with_ctes(S.tx_cte("events", 1)) + """
 SELECT transaction_id, CASE WHEN source_seq % 5 = 0 THEN 'stored' ELSE 'new' END AS reply,
        CASE WHEN source_seq % 5 = 0 THEN amount + 1 ELSE amount END AS amount FROM tx""")
def q_stored_replies(spark, sf_dir):
    """A known id is answered with its stored row, a new one is kept; the replay carries other amounts."""
    from riskline.plans.scoring import replies
    tx = transactions(spark, sf_dir).select("transaction_id", "amount", "source_seq")
    stored = tx.where(F.pmod("source_seq", F.lit(5)) == 0).withColumn("amount", F.col("amount") + 1)
    return replies(tx, stored).select("transaction_id", "reply", "amount")


# ---------------------------------------------------------------------------
# Synthetic minority rows
# ---------------------------------------------------------------------------
from riskline.operators import smote as SM  # noqa: E402


def _hash_sql(value: str, seed: int) -> str:
    return f"CAST('0x' || substr(md5(CAST({value} AS VARCHAR) || ':{seed}'), 1, 15) AS BIGINT)"


def training_cte() -> str:
    """CTE ``tr``: the training slice with its features and ``label``, and ``ft``: all slices."""
    names = ", ".join(C.MODEL_FEATURES)
    bounds = "".join(f"WHEN row_index < CAST(floor(n * {hi}) AS BIGINT) THEN '{name}' " for name, hi in C.SPLIT_FRACTIONS[:-1])
    return offline_cte("events") + f""",
fr AS (SELECT transaction_id, us, CAST(is_fraud AS INTEGER) AS label, {names},
              row_number() OVER (ORDER BY us, transaction_id) - 1 AS row_index, count(*) OVER () AS n FROM offline),
ft AS (SELECT * EXCLUDE (n), CASE {bounds}ELSE '{C.SPLIT_FRACTIONS[-1][0]}' END AS split FROM fr),
tr AS (SELECT * FROM ft WHERE split = 'train')"""


def _smote_sql() -> str:
    f = C.MODEL_FEATURES
    steps = ", ".join(f"CAST(floor({x} * {SM.STEPS} + 0.5) AS BIGINT) AS q{i}" for i, x in enumerate(f))
    mean = ", ".join(f"CAST(sum(q{i}) AS DOUBLE) / count(*) AS m{i}, CAST(sum(CAST(q{i} AS HUGEINT) * q{i}) AS DOUBLE) / count(*) AS p{i}" for i in range(len(f)))
    spread = ", ".join(f"m{i}, sqrt(greatest(p{i} - m{i} * m{i}, 0.0)) AS s{i}" for i in range(len(f)))
    v = ", ".join(f"CASE WHEN s{i} = 0 THEN 0 ELSE CAST(floor((q{i} - m{i}) / s{i} * {SM.UNITS} + 0.5) AS BIGINT) END" for i in range(len(f)))
    mixed = ", ".join(f"round(b.{x} + w * (o.{x} - b.{x}), 6) AS {x}" for x in f)
    return f""",
sq AS (SELECT transaction_id, us, label, {steps} FROM tr),
sm AS (SELECT {mean} FROM sq),
ss AS (SELECT {spread} FROM sm),
sv AS (SELECT transaction_id, row_number() OVER (ORDER BY us, transaction_id) - 1 AS rank, [{v}] AS v FROM sq, ss WHERE label = 1),
sd AS (SELECT a.transaction_id AS base_id, a.rank, b.transaction_id AS neighbour_id,
              list_sum(list_transform(list_zip(a.v, b.v), lambda x: (x[1] - x[2]) * (x[1] - x[2]))) AS d
       FROM sv a JOIN sv b ON a.transaction_id <> b.transaction_id),
sk AS (SELECT *, row_number() OVER (PARTITION BY base_id ORDER BY d, neighbour_id) - 1 AS place FROM sd),
sc AS (SELECT count(*) FILTER (WHERE label = 1) AS few, count(*) FILTER (WHERE label = 0) AS many FROM tr),
sr AS (SELECT r.range AS i, {_hash_sql("r.range", 42)} % (few * least({SM.NEIGHBOURS}, few - 1)) AS u,
              ({_hash_sql("r.range", 43)} % {SM.PLACES}) / {SM.PLACES} AS w, least({SM.NEIGHBOURS}, few - 1) AS k
       FROM sc, range((SELECT CASE WHEN few > 1 THEN greatest(many - few, 0) ELSE 0 END FROM sc)) r)
SELECT i AS row, base_id, neighbour_id, {mixed}
FROM sr JOIN sk ON sk.rank = u // k AND sk.place = u % k
JOIN tr b ON b.transaction_id = base_id JOIN tr o ON o.transaction_id = neighbour_id"""


def training_slices(spark, sf_dir) -> DataFrame:
    from riskline.plans.training import training_frame
    return chronological_split(materialize(training_frame(transactions(spark, sf_dir))))


@register("smote_rows", training_cte() + _smote_sql())
def q_smote(spark, sf_dir):
    train = materialize(training_slices(spark, sf_dir).where(F.col("split") == "train"))
    return SM.smote_rows(train).select("row", "base_id", "neighbour_id", *[r6(f).alias(f) for f in C.MODEL_FEATURES])


# ---------------------------------------------------------------------------
# A trained model as columns (D08), its attributions (E02), calibration
# ---------------------------------------------------------------------------
from riskline.operators import calibrate as CA  # noqa: E402
from riskline.operators.tree_shap import tree_shap  # noqa: E402
from riskline.functions.ensemble import boxes  # noqa: E402
from riskline.plans.bundles import small_forest  # noqa: E402

#: Steps of the twin, each limited to a change of 1 in the exponent of any row.
_NEWTON_STEPS = 60


@register("platt_parameters", SCORED_R + EV_SQL + f""",
cal AS (SELECT probability AS f, label FROM sliced WHERE split = 'calibration'),
ct AS (SELECT count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label = 0) AS n FROM cal),
tg AS (SELECT f, CASE WHEN label = 1 THEN (p + 1.0) / (p + 2.0) ELSE 1.0 / (n + 2.0) END AS t FROM cal, ct),
fr AS (SELECT min(f) AS f0, max(f) AS f1 FROM cal),
nw AS (WITH RECURSIVE r AS (
    SELECT 0 AS i, 0.0::DOUBLE AS a, ln((n + 1.0) / (p + 1.0)) AS b FROM ct
    UNION ALL SELECT i + 1, a + da / greatest(1, abs(da * f0 + db), abs(da * f1 + db)), b + db / greatest(1, abs(da * f0 + db), abs(da * f1 + db))
    FROM (SELECT i, a, b, (hab * gb - hbb * ga) / (haa * hbb - hab * hab) AS da, (hab * ga - haa * gb) / (haa * hbb - hab * hab) AS db
          FROM (SELECT i, a, b, sum(f * (t - q)) AS ga, sum(t - q) AS gb, sum(f * f * q * (1 - q)) AS haa, sum(f * q * (1 - q)) AS hab,
                       sum(q * (1 - q)) AS hbb
                FROM (SELECT i, a, b, f, t, 1 / (1 + exp(a * f + b)) AS q FROM r, tg WHERE i < {_NEWTON_STEPS}) GROUP BY i, a, b)), fr)
  SELECT a, b FROM r WHERE i = {_NEWTON_STEPS})
SELECT p AS positives, n AS negatives, round(a, 6) AS a, round(b, 6) AS b FROM ct, nw""")
def q_platt(spark, sf_dir):
    ev = chronological_split(eval_frame(scored_events(spark, sf_dir, 1))).where(F.col("split") == "calibration")
    found = CA.fit(ev, "probability")
    row = spark.createDataFrame([(found.positives, found.negatives, found.a, found.b)], "positives long, negatives long, a double, b double")
    return row.withColumns({c: r6(c) for c in ("a", "b")})


def _forest_sql(forest) -> tuple[str, str]:
    """CTEs that walk the node table over ``feat`` (``wx``: inputs, ``nd``: nodes), and ``prob`` from them."""
    nodes = ", ".join(f"({i}, {f}, CAST('{t!r}' AS DOUBLE), {left}, {right}, CAST('{v!r}' AS DOUBLE))"
                      for i, (f, t, left, right, v) in enumerate(forest.table.nodes))
    walk = f""",
nd(node, feature, threshold, l, r, value) AS (VALUES {nodes}),
wx AS (SELECT transaction_id, [{', '.join(forest.features)}] AS v FROM feat),
wk AS (WITH RECURSIVE w AS (
    SELECT transaction_id, v, unnest({forest.table.roots}) AS node FROM wx
    UNION ALL SELECT transaction_id, v, CASE WHEN v[feature + 1] <= threshold THEN l ELSE r END FROM w JOIN nd USING (node) WHERE feature >= 0)
  SELECT transaction_id, sum(value) / {len(forest.table.roots)} AS raw FROM w JOIN nd USING (node) WHERE feature < 0 GROUP BY 1)"""
    prob = f"""
prob AS (SELECT feat.*, 1 / (1 + exp(CAST('{forest.calibrator.a!r}' AS DOUBLE) * raw + CAST('{forest.calibrator.b!r}' AS DOUBLE))) AS fraud_probability
         FROM feat JOIN wk USING (transaction_id)),"""
    return walk, prob


def _forest_scored(forest) -> str:
    walk, prob = _forest_sql(forest)
    return (S.with_ctes(S.tx_cte("events", 1), S.features_cte()) + walk + ","
            + S.scored_cte(forest.review_threshold, forest.block_threshold, prob, forest.version))


FOREST = small_forest()


@register("score_with_model", _forest_scored(FOREST)
          + " SELECT transaction_id, round(fraud_probability, 6) AS fraud_probability, risk_score, decision, model_version FROM scored")
def q_score_with_model(spark, sf_dir):
    scored = score_batch(transactions(spark, sf_dir), model=FOREST, with_snapshot=False)
    return scored.select("transaction_id", r6("fraud_probability").alias("fraud_probability"), "risk_score", "decision", "model_version")


def _tree_shap_sql(forest) -> str:
    at = {f: i + 1 for i, f in enumerate(forest.features)}
    number = lambda x: f"CAST('{x!r}' AS DOUBLE)"
    found = boxes(forest.table)
    bounds = ", ".join(f"({i}, {at[f]}, {number(lo)}, {number(hi)})" for i, b in enumerate(found) for f, lo, hi in b.bounds)
    values = ", ".join(f"({i}, {number(b.value)})" for i, b in enumerate(found))
    names = ", ".join(f"'{f}'" for f in forest.features)
    return f""",
ix AS (SELECT transaction_id, row_number() OVER (ORDER BY us, transaction_id) - 1 AS row_index, count(*) OVER () AS n FROM feat),
bg AS (SELECT transaction_id FROM ix WHERE row_index >= CAST(floor(n * 0.65) AS BIGINT) AND row_index < CAST(floor(n * 0.75) AS BIGINT)
       ORDER BY {_rank_sql()}, transaction_id LIMIT {AT.BACKGROUND_ROWS}),
lb(leaf, f, lo, hi) AS (VALUES {bounds}),
lv(leaf, value) AS (VALUES {values}),
sa AS (SELECT transaction_id, leaf, f, v[f] > lo AND v[f] <= hi AS ok FROM wx, lb WHERE transaction_id IN (SELECT transaction_id FROM scored WHERE decision <> 'APPROVE')),
sb AS (SELECT transaction_id AS bg, leaf, f, v[f] > lo AND v[f] <= hi AS ok FROM wx JOIN bg USING (transaction_id), lb),
pr AS (SELECT transaction_id, bg, leaf, count(*) FILTER (WHERE sa.ok AND NOT sb.ok) AS a, count(*) FILTER (WHERE sb.ok AND NOT sa.ok) AS c
       FROM sa JOIN sb USING (leaf, f) GROUP BY ALL HAVING bool_and(sa.ok OR sb.ok)),
ph AS (SELECT transaction_id, f, CASE WHEN sa.ok THEN factorial(CAST(a - 1 AS INTEGER)) * factorial(CAST(c AS INTEGER))
                                      ELSE -factorial(CAST(a AS INTEGER)) * factorial(CAST(c - 1 AS INTEGER)) END
              / factorial(CAST(a + c AS INTEGER)) * value AS part
       FROM pr JOIN sa USING (transaction_id, leaf) JOIN sb USING (bg, leaf, f) JOIN lv USING (leaf) WHERE sa.ok <> sb.ok)
SELECT transaction_id, [{names}][f] AS feature, round(sum(part) / (SELECT count(*) FROM bg), 6) AS impact FROM ph GROUP BY ALL"""


@register("model_attributions", _forest_scored(FOREST) + _tree_shap_sql(FOREST))
def q_model_attributions(spark, sf_dir):
    """Exact attributions of the trained forest for every alert it raises."""
    scored = materialize(score_batch(transactions(spark, sf_dir), model=FOREST, with_snapshot=False).select(
        "transaction_id", "us", "decision", *FOREST.features))
    alerted = scored.where(F.col("decision") != "APPROVE")
    found = tree_shap(alerted, materialize(_background(scored, FOREST.features)), FOREST.table)
    return found.select("transaction_id", "feature", r6("phi").alias("impact"))
