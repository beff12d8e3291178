"""Point-in-time behaviour features (F01-F12 online, B01-B05 offline).

Online definition (per transaction at event time t, same user):
  H(t) = rows with time in [t - 30 d, t); equal timestamps are not history.
  Sub-windows are [t - w, t).  Novelty / ip change need a non-empty H.

Plan shape
----------
* One shuffle.  Rows are hash-partitioned on (user_id, time bucket) where a bucket
  spans ``bucket_days`` (default 2 x horizon).  Each row whose time lies within
  the horizon of the next bucket is copied into that bucket as history only
  (a "halo"), so every target row sees its whole horizon inside its partition.
* Every other window (novelty per (user, value, bucket)) is clustered on a
  superset of (user_id, bucket) and reuses that partitioning: sorts only.
* Counts are differences of two incremental prefix counts (linear, exact).
* Sums are differences of prefix sums in DECIMAL(38,10) (exact, linear).
* 24 h distinct counts are exact prefix counts over close times (linear-log), without a row of their own.
* Medians come from ``operators.selection`` (linear-log) in the same partitions.
* The number of partitions follows the number of rows, so that a task's rows do not grow with the table.
* Users with more rows than ``hot_rows`` would be one task; they are scanned in
  chunks of bounded size instead (``operators.segments``), with the same answers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskline import constants as C
from riskline.functions.geo import haversine_km
from riskline.operators.segments import CHUNK_BITS, HOT_ROWS, offline_scan, online_scan, user_rows, window_tasks
from riskline.operators.selection import grouped_medians

UNB = Window.unboundedPreceding
_EXACT = "decimal(38,10)"


def _hour_weekday(ts: Column) -> tuple[Column, Column]:
    # weekday(): Monday = 0, as Python's datetime.weekday().
    return F.hour(ts).cast("double"), F.weekday(ts).cast("double")


def halo_partition(df: DataFrame, horizon_us: int, bucket_us: int, key: str = "user_id", tasks: int | None = None) -> DataFrame:
    """Split (key, time) into buckets, copying each bucket's last ``horizon_us`` into the next.

    Adds ``_pb`` (partition bucket) and ``_target`` (row belongs to this bucket).  ``tasks`` fixes the number of partitions.
    """
    if bucket_us < horizon_us:
        raise ValueError("bucket must be at least as wide as the horizon")
    b = F.floor(F.col("us") / F.lit(bucket_us)).cast("long")
    out = df.withColumn("_b", b)
    spill = F.col("us") >= (F.col("_b") + 1) * F.lit(bucket_us) - F.lit(horizon_us)
    out = out.withColumn(
        "_pb", F.explode(F.when(spill, F.array(F.col("_b"), F.col("_b") + 1)).otherwise(F.array(F.col("_b"))))
    )
    out = out.withColumn("_target", F.col("_pb") == F.col("_b")).drop("_b")
    # Single exchange; every later window clusters on a superset of these keys.
    return out.repartition(tasks, key, "_pb") if tasks else out.repartition(key, "_pb")


def online_features(
    txns: DataFrame,
    horizon_days: int = C.HISTORY_DAYS,
    bucket_days: int | None = None,
    impossible_travel_kmh: float = C.IMPOSSIBLE_TRAVEL_KMH,
    distinct_counts: bool = True,
    medians: bool = True,
    hot_rows: int = HOT_ROWS,
    chunk_bits: int = CHUNK_BITS,
) -> DataFrame:
    """The 19 online features for every row of ``txns``.

    ``distinct_counts=False`` leaves the two 24 h distinct counts null and skips
    the close times they need; ``medians=False`` likewise leaves the median
    null (decision-only plans read neither).  Users with more than ``hot_rows``
    rows are scanned in chunks of ``2 ** chunk_bits`` rows.

    ``txns`` needs transaction_id, user_id, us, timestamp, amount, merchant_id,
    country, device_id, ip_address, latitude, longitude.  Output keeps the input
    columns and adds the feature columns (all double).
    """
    horizon = horizon_days * C.DAY_US
    bucket = (bucket_days or 2 * horizon_days) * C.DAY_US
    n_rows, hot = user_rows(txns, hot_rows)
    tasks = window_tasks(txns.sparkSession, n_rows)
    usual = txns if hot is None else txns.join(hot, "user_id", "left_anti")
    out = _derived(_window_scan(usual, horizon, bucket, distinct_counts, medians, tasks), txns.columns, horizon, impossible_travel_kmh)
    if hot is None:
        return out
    many = online_scan(txns.join(hot, "user_id", "left_semi").select(*txns.columns), horizon, distinct_counts, medians, chunk_bits)
    return out.unionByName(_derived(many, txns.columns, horizon, impossible_travel_kmh))


def _window_scan(txns: DataFrame, horizon: int, bucket: int, distinct_counts: bool, medians: bool, tasks: int) -> DataFrame:
    """Counts, sums and latest rows by windows over (user, time bucket)."""
    df = halo_partition(txns.where("us is not null"), horizon, bucket, tasks=tasks)

    # Exact linear 24 h distinct counts: row j is the latest occurrence of its value for
    # query times t in (s_j, b_j], b_j = min(next occurrence, s_j + 24 h).  Hence
    # distinct(t) = #{s_j < t} - #{b_j < t}; the second term is a prefix count over
    # the close times, taken where the medians are.
    def close_at(value: str) -> Column:
        wv = Window.partitionBy("user_id", "_pb", value).orderBy("us")
        end = F.col("us") + F.lit(C.DAY_US)
        return F.least(F.coalesce(F.lead("us").over(wv), end), end)

    w = Window.partitionBy("user_id", "_pb").orderBy("us")

    def frame(lo, hi):
        return w.rangeBetween(lo, hi)

    prior_n = F.count(F.lit(1)).over(frame(UNB, -1))

    def count_last(width_us: int) -> Column:
        return prior_n - F.count(F.lit(1)).over(frame(UNB, -width_us - 1))

    exact = F.col("amount").cast(_EXACT)
    prior_sum = F.sum(exact).over(frame(UNB, -1))

    def sum_last(width_us: int) -> Column:
        return F.coalesce(prior_sum - F.sum(exact).over(frame(UNB, -width_us - 1)), prior_sum)

    latest = F.max(
        F.struct(
            F.col("us").alias("us"),
            F.col("transaction_id").alias("id"),
            F.col("ip_address").alias("ip"),
            F.col("latitude").alias("lat"),
            F.col("longitude").alias("lon"),
        )
    ).over(frame(UNB, -1))

    def last_seen(value: str) -> Column:
        wv = Window.partitionBy("user_id", "_pb", value).orderBy("us").rangeBetween(UNB, -1)
        return F.max("us").over(wv)

    closes = {"_close_m": "merchant_id", "_close_c": "country"} if distinct_counts else {}
    df = df.select(
        "*",
        *[close_at(value).alias(name) for name, value in closes.items()],
        count_last(horizon).alias("_n_h"),
        sum_last(horizon).alias("_s_h"),
        count_last(C.MINUTE_US).alias("_n1m"),
        count_last(5 * C.MINUTE_US).alias("_n5m"),
        count_last(C.HOUR_US).alias("_n1h"),
        count_last(C.DAY_US).alias("_n24h"),
        sum_last(C.HOUR_US).alias("_s1h"),
        last_seen("merchant_id").alias("_seen_m"),
        last_seen("country").alias("_seen_c"),
        last_seen("device_id").alias("_seen_d"),
        latest.alias("_prev"),
    )
    if not medians:
        df = df.withColumn("_med", F.lit(None).cast("double"))
    if not distinct_counts:
        df = df.withColumns({c: F.lit(None).cast("long") for c in ("_um24", "_uc24")})
    if medians or distinct_counts:
        df = df.sortWithinPartitions("user_id", "_pb", "us")
        df = grouped_medians(df, ["user_id", "_pb"], "_med" if medians else None, horizon,
                             open_until={"_um24": "_close_m", "_uc24": "_close_c"} if distinct_counts else None)
    return df.where("_target")


def _derived(df: DataFrame, columns: list[str], horizon: int, impossible_travel_kmh: float) -> DataFrame:
    """The 19 features from what a scan has found."""
    has_history = F.col("_n_h") > 0
    avg_amount = F.when(has_history, F.col("_s_h").cast("double") / F.col("_n_h")).otherwise(F.col("amount"))
    lower = F.col("us") - F.lit(horizon)

    def novel(seen: str) -> Column:
        return (has_history & (F.col(seen).isNull() | (F.col(seen) < lower))).cast("double")

    prev = F.col("_prev")
    hours = (F.col("us") - prev["us"]) / F.lit(float(C.HOUR_US))
    coords = (F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
              & prev["lat"].isNotNull() & prev["lon"].isNotNull())
    speed = F.when(
        has_history & coords & (hours > 0),
        haversine_km(prev["lat"], prev["lon"], F.col("latitude"), F.col("longitude")) / hours,
    ).otherwise(F.lit(0.0))
    hour, weekday = _hour_weekday(F.col("timestamp"))

    return df.select(
        *columns,
        hour.alias("hour"),
        weekday.alias("weekday"),
        avg_amount.alias("user_average_amount"),
        F.coalesce(F.col("_med"), F.col("amount")).alias("user_median_amount"),
        (F.col("amount") / F.greatest(avg_amount, F.lit(0.01))).alias("amount_vs_user_average"),
        F.col("_n1m").cast("double").alias("transactions_last_1m"),
        F.col("_n5m").cast("double").alias("transactions_last_5m"),
        F.col("_n1h").cast("double").alias("transactions_last_1h"),
        F.col("_n24h").cast("double").alias("transactions_last_24h"),
        F.coalesce(F.col("_s1h").cast("double"), F.lit(0.0)).alias("amount_last_1h"),
        F.col("_um24").cast("double").alias("unique_merchants_last_24h"),
        F.col("_uc24").cast("double").alias("unique_countries_last_24h"),
        novel("_seen_m").alias("new_merchant"),
        novel("_seen_c").alias("new_country"),
        novel("_seen_d").alias("new_device"),
        (has_history & (F.col("ip_address") != prev["ip"])).cast("double").alias("ip_changed"),
        speed.alias("travel_speed_kmh"),
        (speed > impossible_travel_kmh).cast("double").alias("impossible_travel"),
    )


def arrival_features(arrived: DataFrame, stored: DataFrame | None = None, **options) -> DataFrame:
    """Features of the rows that arrived, against each other and the ``stored`` rows that arrived before.

    Late rows see what has arrived by then; stored rows are history only and are never scored again.
    """
    rows = arrived.withColumn("_arrived", F.lit(True))
    if stored is not None:
        rows = rows.unionByName(stored.select(*arrived.columns).withColumn("_arrived", F.lit(False)))
    return online_features(rows, **options).where("_arrived").drop("_arrived")


def snapshot(names: list[str] = C.ONLINE_FEATURES) -> Column:
    """Packed feature snapshot stored with the prediction."""
    return F.struct(*[F.col(n).cast("double").alias(n) for n in names])


def history_for(targets: DataFrame, history: DataFrame, horizon_days: int = C.HISTORY_DAYS) -> DataFrame:
    """F01 when targets and history are different tables: equi-join on user plus range predicate.

    Range join by (user, day bucket): each history row is replicated into the
    buckets whose targets it may serve, so the join is an equi-join on
    (user_id, bucket) with a residual time predicate -- no per-user cartesian.
    """
    horizon = horizon_days * C.DAY_US
    t = targets.select(
        F.col("transaction_id").alias("target_id"), F.col("user_id"), F.col("us").alias("t_us"),
        F.floor(F.col("us") / F.lit(horizon)).cast("long").alias("_bk"),
    )
    h = history.withColumn("_b0", F.floor(F.col("us") / F.lit(horizon)).cast("long")).withColumn(
        "_bk", F.explode(F.array(F.col("_b0"), F.col("_b0") + 1))
    ).drop("_b0")
    joined = t.join(h, ["user_id", "_bk"], "inner").where(
        (F.col("us") >= F.col("t_us") - F.lit(horizon)) & (F.col("us") < F.col("t_us"))
        & (F.col("transaction_id") != F.col("target_id"))
    )
    return joined.drop("_bk", "t_us")


#: Columns whose first occurrence counts as new, and widths of the counts, of the offline features.
_OFFLINE_VALUES = {"merchant_id": "new_merchant", "country": "new_country", "device_id": "new_device"}
_OFFLINE_WIDTHS = {"5m": 5 * C.MINUTE_US, "1h": C.HOUR_US, "24h": C.DAY_US}


def offline_features(txns: DataFrame, hot_rows: int = HOT_ROWS, chunk_bits: int = CHUNK_BITS) -> DataFrame:
    """Training-time features (unlimited horizon for mean / median / novelty).

    Row order per user is (us, transaction_id); earlier rows with the same
    timestamp count for mean / median / novelty (row order), never for counts.
    Users with more than ``hot_rows`` rows are scanned in chunks of ``2 ** chunk_bits`` rows.
    """
    n_rows, hot = user_rows(txns, hot_rows)
    usual = txns if hot is None else txns.join(hot, "user_id", "left_anti")
    scanned = _offline_windows(usual, window_tasks(txns.sparkSession, n_rows))
    if hot is not None:
        many = offline_scan(txns.join(hot, "user_id", "left_semi").select(*txns.columns), list(_OFFLINE_VALUES), _OFFLINE_WIDTHS, chunk_bits)
        scanned = scanned.unionByName(many)
    hour, weekday = _hour_weekday(F.col("timestamp"))
    mean = F.when(F.col("_pos") > 0, F.col("_sum").cast("double") / F.col("_pos")).otherwise(F.col("amount"))
    out = scanned.select(
        *txns.columns,
        mean.alias("user_average_amount"),
        F.coalesce(F.col("_med"), F.col("amount")).alias("user_median_amount"),
        hour.alias("hour"),
        weekday.alias("weekday"),
        *[(F.col(f"_new_{v}") & (F.col("_pos") > 0)).cast("double").alias(name) for v, name in _OFFLINE_VALUES.items()],
        *[F.col(f"_n_{w}").cast("double").alias(f"transactions_last_{w}") for w in _OFFLINE_WIDTHS],
    )
    return out.withColumn(
        "amount_vs_user_average", F.col("amount") / F.greatest(F.col("user_average_amount"), F.lit(0.01))
    )


def _offline_windows(txns: DataFrame, tasks: int) -> DataFrame:
    """Earlier rows, sums, medians, first occurrences and counts by windows over the user."""
    w_rows = Window.partitionBy("user_id").orderBy("us", "transaction_id")
    prior = w_rows.rowsBetween(UNB, -1)
    w_range = Window.partitionBy("user_id").orderBy("us")
    prior_n = F.count(F.lit(1)).over(w_range.rangeBetween(UNB, -1))

    def count_last(width_us: int) -> Column:
        return prior_n - F.count(F.lit(1)).over(w_range.rangeBetween(UNB, -width_us - 1))

    def first_seen(value: str) -> Column:
        return F.row_number().over(Window.partitionBy("user_id", value).orderBy("us", "transaction_id")) == 1

    df = txns.repartition(tasks, "user_id").select(
        "*",
        (F.row_number().over(w_rows) - 1).cast("long").alias("_pos"),
        F.coalesce(F.sum(F.col("amount").cast(_EXACT)).over(prior), F.lit(0)).cast(_EXACT).alias("_sum"),
        *[first_seen(v).alias(f"_new_{v}") for v in _OFFLINE_VALUES],
        *[count_last(width).alias(f"_n_{w}") for w, width in _OFFLINE_WIDTHS.items()],
    )
    return grouped_medians(df.sortWithinPartitions("user_id", "us", "transaction_id"), ["user_id"], "_med", None)


def skew_report(online: DataFrame, offline: DataFrame, eps: float = 1e-9,
                names: list[str] | None = None) -> DataFrame:
    """Per shared feature, share of rows where online and offline values differ."""
    shared = names or [n for n in C.MODEL_FEATURES + ["new_country", "new_device"]
                       if n in online.columns and n in offline.columns]
    a = online.select("transaction_id", *[F.col(n).alias(f"on_{n}") for n in shared])
    b = offline.select("transaction_id", *[F.col(n).alias(f"off_{n}") for n in shared])
    j = a.join(b, "transaction_id")
    aggs = []
    for n in shared:
        aggs.append(F.sum((F.abs(F.col(f"on_{n}") - F.col(f"off_{n}")) > eps).cast("long")).alias(n))
    wide = j.agg(F.count(F.lit(1)).alias("rows"), *aggs)
    long = wide.select(
        "rows", F.explode(F.array(*[F.struct(F.lit(n).alias("feature"), F.col(n).alias("differing"))
                                    for n in shared])).alias("x")
    )
    return long.select(
        F.col("x.feature").alias("feature"),
        F.col("rows"),
        F.col("x.differing").alias("differing"),
        F.round(F.col("x.differing") / F.greatest(F.col("rows"), F.lit(1)), 6).alias("share"),
    )
