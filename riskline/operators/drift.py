"""Distribution drift (R01-R05) from one table of value counts.

``value_table`` groups both slices once into (metric, value, reference count,
current count) with running counts in value order (H1's buckets).  Quantile edges,
PSI bins and the KS statistic are all read from it: an order statistic is the row
whose running count passes its position, a bin is a sum of counts, KS a maximum.
Only order statistics (<= 22 a metric) and bin counts leave the executors.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskline import constants as C
from riskline.operators.lattice import EXACT_ROWS, exact_p_value
from riskline.operators.ordering import bucketed
from riskline.session import materialize


def value_table(reference: DataFrame, current: DataFrame, cols: list[str], n_buckets: int | None = None
                ) -> tuple[DataFrame, dict[str, tuple[int, int]]]:
    """(metric, v, a, b, cum_a, cum_b) and per metric the row counts of the slices; null values are left out."""
    def long(df: DataFrame, in_reference: int) -> DataFrame:
        pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("v"))
                                    for c in cols]))
        return df.select(pairs.alias("p")).select("p.metric", "p.v", F.lit(in_reference).alias("a"),
                                                  F.lit(1 - in_reference).alias("b"))

    counts = long(reference, 1).unionByName(long(current, 0)).where("v is not null").groupBy("metric", "v").agg(
        F.sum("a").cast("long").alias("a"), F.sum("b").cast("long").alias("b"))
    n = n_buckets or max(1, int(reference.sparkSession.conf.get("spark.sql.shuffle.partitions", "8")))
    table = materialize(bucketed(materialize(counts), ["metric", "v"], n))
    sums = sorted(table.groupBy("_bkt", "metric").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).collect(),
                  key=lambda r: r["_bkt"])  # at most buckets + metrics rows
    totals, offsets = {c: (0, 0) for c in cols}, []
    for r in sums:
        before = totals[r["metric"]]
        offsets.append((r["_bkt"], r["metric"], *before))
        totals[r["metric"]] = (before[0] + r["a"], before[1] + r["b"])
    if not offsets:
        return table.withColumn("cum_a", F.col("a")).withColumn("cum_b", F.col("b")).drop("_bkt"), totals
    at = F.create_map(*[x for k, m, u, v in offsets for x in (F.lit(f"{k}:{m}"), F.array(F.lit(u), F.lit(v)))])
    start = F.element_at(at, F.concat_ws(":", "_bkt", "metric"))
    w = Window.partitionBy("_bkt", "metric").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    return table.select("metric", "v", "a", "b", (start[0] + F.sum("a").over(w)).alias("cum_a"),
                        (start[1] + F.sum("b").over(w)).alias("cum_b")), totals


def edges_of(table: DataFrame, totals: dict[str, tuple[int, int]], bins: int = C.PSI_BINS) -> dict[str, list[float]]:
    """Per metric the unique linear quantiles of the reference at 0, 1/bins, ..., 1, from order statistics."""
    wanted = {m: [i * (n - 1) / bins for i in range(bins + 1)] for m, (n, _) in totals.items() if n}
    places = {m: sorted({f(p) for p in ps for f in (math.floor, math.ceil)}) for m, ps in wanted.items()}
    hit = F.lit(False)
    for m, at in places.items():
        holds = F.exists(F.array(*[F.lit(k) for k in at]), lambda k: (k < F.col("cum_a")) & (k >= F.col("cum_a") - F.col("a")))
        hit = hit | ((F.col("metric") == m) & holds)
    rows = table.where(hit).select("metric", "v", "a", "cum_a").collect()  # at most 2 (bins + 1) a metric
    out = {m: [] for m in totals}
    for m, ps in wanted.items():
        own = [r for r in rows if r["metric"] == m]

        def order_statistic(k: int, own=own) -> float:
            return next(r["v"] for r in own if r["cum_a"] - r["a"] <= k < r["cum_a"])

        quantiles = []
        for p in ps:
            lo, hi = math.floor(p), math.ceil(p)
            x, y = order_statistic(lo), order_statistic(hi)
            quantiles.append(x if lo == hi or x == y else (hi - p) * x + (p - lo) * y)
        out[m] = sorted(set(quantiles))
    return out


def _bin_index(v: Column, edges: list[float]) -> Column:
    """Histogram bin of v over ``edges``: half-open bins, last closed, null outside the range."""
    arr = F.array(*[F.lit(e) for e in edges])
    k = len(edges) - 1
    idx = F.size(F.filter(arr, lambda e: e <= v)) - 1
    return (F.when((v < edges[0]) | (v > edges[-1]) | v.isNull() | F.isnan(v), F.lit(None))
            .when(v == edges[-1], F.lit(k - 1)).otherwise(idx))


def bin_counts(table: DataFrame, edges: dict[str, list[float]]) -> DataFrame:
    """(metric, bin, reference_count, current_count) of the bins that hold a value."""
    index = F.lit(None).cast("int")
    for m, e in edges.items():
        if len(e) >= 3:
            index = F.when(F.col("metric") == m, _bin_index(F.col("v"), e)).otherwise(index)
    return table.withColumn("bin", index).where("bin is not null").groupBy("metric", "bin").agg(
        F.sum("a").alias("reference_count"), F.sum("b").alias("current_count"))


def psi_terms(bins: int, counted: dict[int, tuple[int, int]]) -> list[tuple[int, int, int, float]]:
    """(bin, reference count, current count, PSI term) for every bin; ratios have a floor."""
    rows = [(k, *counted.get(k, (0, 0))) for k in range(bins)]
    r_all, c_all = max(sum(r for _, r, _ in rows), 1), max(sum(c for _, _, c in rows), 1)
    ratios = [(max(r / r_all, C.PSI_FLOOR), max(c / c_all, C.PSI_FLOOR)) for _, r, c in rows]
    return [(k, r, c, (q - p) * math.log(q / p)) for (k, r, c), (p, q) in zip(rows, ratios)]


def psi_table(reference: DataFrame, current: DataFrame, col: str, bins: int = C.PSI_BINS) -> DataFrame:
    """R01 per-bin table: bin, reference_count, current_count and the PSI term."""
    table, totals = value_table(reference, current, [col])
    edges = edges_of(table, totals, bins)
    counted = {r["bin"]: (r["reference_count"], r["current_count"]) for r in bin_counts(table, edges).collect()}
    rows = psi_terms(len(edges[col]) - 1, counted) if len(edges[col]) >= 3 else []
    return reference.sparkSession.createDataFrame(rows, "bin int, reference_count long, current_count long, term double")


def psi(reference: DataFrame, current: DataFrame, col: str, bins: int = C.PSI_BINS) -> DataFrame:
    """One row, column ``psi`` (0 when fewer than 3 unique edges)."""
    t = psi_table(reference, current, col, bins)
    return t.agg(F.coalesce(F.sum("term"), F.lit(0.0)).alias("psi"))


def ks_distance(totals: dict[str, tuple[int, int]]) -> Column:
    """R02 as a column over ``value_table``: distance of the two distribution functions at a value."""
    out = F.lit(0.0)
    for m, (n, k) in totals.items():
        if n and k:
            gap = F.abs(F.col("cum_a") / F.lit(float(n)) - F.col("cum_b") / F.lit(float(k)))
            out = F.when(F.col("metric") == m, gap).otherwise(out)
    return out


def ks_statistic(reference: DataFrame, current: DataFrame, col: str, n_buckets: int | None = None) -> DataFrame:
    """Two-sample KS statistic D plus sizes (n, m)."""
    table, totals = value_table(reference, current, [col], n_buckets)
    n, m = totals[col]
    return table.agg(F.coalesce(F.max(ks_distance(totals)), F.lit(0.0)).alias("ks")).select(
        "ks", F.lit(n).cast("long").alias("n"), F.lit(m).cast("long").alias("m"))


def ks_p_value(d: Column, n: Column, m: Column, terms: int = 100) -> Column:
    """Asymptotic Kolmogorov p-value for D with effective size nm/(n+m) (series, as a column)."""
    en = F.sqrt(n * m / (n + m))
    lam = (en + 0.12 + 0.11 / en) * d
    s = None
    for k in range(1, terms + 1):
        term = (-1) ** (k - 1) * F.exp(-2.0 * k * k * lam * lam)
        s = term if s is None else s + term
    return F.when(d <= 0, F.lit(1.0)).otherwise(F.least(F.greatest(2 * s, F.lit(0.0)), F.lit(1.0)))


def ks_tests(reference: DataFrame, current: DataFrame, cols: list[str]) -> DataFrame:
    """R02 with its p-value: one row per column (metric, n, m, ks, p_value, method).

    Lattice paths are counted where neither slice has more than ``EXACT_ROWS`` rows (method 'exact'); else the series is
    used ('asymptotic').  An empty slice has distance 0 and p-value 1.
    """
    table, totals = value_table(reference, current, cols)
    return ks_rows(table, totals)


def ks_rows(table: DataFrame, totals: dict[str, tuple[int, int]]) -> DataFrame:
    """``ks_tests`` from a value table; the distance is an integer over n m, so it is exact."""
    rows = None
    for metric, (n, m) in totals.items():
        h = F.coalesce(F.max(F.abs(F.col("cum_a").cast("decimal(38,0)") * F.lit(m) - F.col("cum_b").cast("decimal(38,0)") * F.lit(n))), F.lit(0))
        d = (F.col("h").cast("double") / F.lit(float(max(n * m, 1)))).alias("ks")
        exact = max(n, m) <= EXACT_ROWS
        sizes = [F.lit(n).cast("long").alias("n"), F.lit(m).cast("long").alias("m")]
        one = table.where(F.col("metric") == metric).agg(h.alias("h")).select(F.lit(metric).alias("metric"), *sizes, d, "h")
        if not n or not m:
            p = F.lit(1.0)
        elif exact:
            p = exact_p_value(F.col("n"), F.col("m"), F.col("h").cast("long"))
        else:
            p = ks_p_value(F.col("ks"), F.lit(float(n)), F.lit(float(m)))
        one = one.select("metric", "n", "m", "ks", p.alias("p_value"), F.lit("exact" if exact else "asymptotic").alias("method"))
        rows = one if rows is None else rows.unionByName(one)
    return rows


def js_divergence(reference: DataFrame, current: DataFrame, col: str, reference_rows: int | None = None,
                  current_rows: int | None = None) -> DataFrame:
    """Jensen-Shannon divergence (natural log; the squared JS distance), one row ``js``."""
    rc = reference.groupBy(F.col(col).alias("c")).agg(F.count(F.lit(1)).alias("r"))
    cc = current.groupBy(F.col(col).alias("c")).agg(F.count(F.lit(1)).alias("q"))
    r_tot = reference.count() if reference_rows is None else reference_rows
    q_tot = current.count() if current_rows is None else current_rows
    j = rc.join(cc, "c", "full_outer").fillna(0, ["r", "q"])
    p = F.col("r") / F.lit(float(max(r_tot, 1)))
    q = F.col("q") / F.lit(float(max(q_tot, 1)))
    t = j.select(p.alias("p"), q.alias("q"))
    m = (F.col("p") + F.col("q")) / 2
    term = (F.when(F.col("p") > 0, F.col("p") * F.log(F.col("p") / m)).otherwise(0.0)
            + F.when(F.col("q") > 0, F.col("q") * F.log(F.col("q") / m)).otherwise(0.0)) / 2
    return t.agg(F.coalesce(F.sum(term), F.lit(0.0)).alias("js"))


def drift_report(reference: DataFrame, current: DataFrame, model_version: str, window_start_us: int,
                 window_end_us: int, min_rows: int = C.DRIFT_MIN_ROWS) -> DataFrame:
    """One-row report (or no row when the window holds fewer than ``min_rows``).

    ``reference`` / ``current`` carry amount, country, fraud_probability.
    Detection: PSI >= 0.20 on amount or probability, or JS >= 0.10 on country.
    KS is reported, not used for detection.
    """
    spark = current.sparkSession
    n_cur = current.count()
    if n_cur < min_rows:
        return spark.createDataFrame([], REPORT_SCHEMA)
    metrics = {"amount": "amount", "fraud_probability": "probability"}
    table, totals = value_table(reference, current, list(metrics))
    table = materialize(table)
    edges = edges_of(table, totals)
    counted: dict[str, dict[int, tuple[int, int]]] = {m: {} for m in metrics}
    for r in bin_counts(table, edges).collect():  # at most bins a metric
        counted[r["metric"]][r["bin"]] = (r["reference_count"], r["current_count"])
    found = {}
    for m, name in metrics.items():
        terms = psi_terms(len(edges[m]) - 1, counted[m]) if len(edges[m]) >= 3 else []
        found[f"{name}_psi"] = F.lit(math.fsum(t[3] for t in terms))
    tests = {r["metric"]: r for r in ks_rows(table, totals).collect()}  # a row a metric
    row = js_divergence(reference, current, "country", current_rows=n_cur).withColumnRenamed("js", "country_js")
    for m, name in metrics.items():
        found[f"{name}_ks"], found[f"{name}_ks_p_value"] = F.lit(tests[m]["ks"]), F.lit(tests[m]["p_value"])
    found["country_js"] = F.col("country_js")
    names = ["amount_psi", "amount_ks", "amount_ks_p_value", "probability_psi", "probability_ks",
             "probability_ks_p_value", "country_js"]
    return row.select(*[found[k].alias(k) for k in names]).select(
        F.lit(model_version).alias("model_version"),
        F.lit(window_start_us).alias("window_start_us"),
        F.lit(window_end_us).alias("window_end_us"),
        F.lit(n_cur).cast("long").alias("rows"),
        *names,
        ((F.col("amount_psi") >= C.PSI_ALERT) | (F.col("probability_psi") >= C.PSI_ALERT)
         | (F.col("country_js") >= C.JS_ALERT)).alias("drift_detected"),
    )


REPORT_SCHEMA = ("model_version string, window_start_us long, window_end_us long, rows long, amount_psi double, "
                 "amount_ks double, amount_ks_p_value double, probability_psi double, probability_ks double, "
                 "probability_ks_p_value double, country_js double, drift_detected boolean")


def reference_sample(df: DataFrame, size: int = 2000, seed: int = 42) -> DataFrame:
    """Reproducible sample of at most ``size`` rows (seeded hash rank, exact count)."""
    from riskline.operators.ordering import exact_sample_by_rank

    return exact_sample_by_rank(df.select("transaction_id", "amount", "country", "fraud_probability"), size, seed)
