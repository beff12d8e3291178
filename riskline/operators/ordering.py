"""H1: global ordered index and prefix sums without a single-partition window.

A window without ``partitionBy`` pulls every row into one task.  Instead, for an index:

1. the rows are range-partitioned by (key, tiebreak), sorted, numbered within their partition and staged, so that the
   numbers are fixed (the boundaries of a range partitioning come from a sample and may differ on recompute),
2. one count a partition is collected,
3. a row's index is its number and the counts of the partitions before its own.

Prefix sums over small tables (value counts) use explicit boundaries of buckets in the plan and a window inside each.

Users: S02 (even downsample), M01 (chronological split), M04 (exact-count
undersample), M05 (ranks of base rows), M09 (AP / ROC AUC), R02 (KS statistic).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskline.session import materialize

#: Bits of a row number that count within its partition (those of ``monotonically_increasing_id``).
PART_BITS = 33
#: Rows per bucket of the sample that places the boundaries.
SAMPLE_PER_BUCKET = 32


def _default_buckets(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8")))


def range_bounds(df: DataFrame, key: str, n_buckets: int, accuracy: int = 10_000) -> list:
    if n_buckets <= 1:
        return []
    qs = [i / n_buckets for i in range(1, n_buckets)]
    row = df.agg(F.percentile_approx(F.col(key), qs, accuracy).alias("b")).first()
    values = row["b"] if row is not None and row["b"] is not None else []
    return sorted(set(v for v in values if v is not None))


def bucket_of(key: Column, bounds: list) -> Column:
    """Number of boundaries strictly below the key (monotone in the key), by halving: a search tree of comparisons."""

    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        bound = bounds[mid] if isinstance(bounds[mid], Column) else F.lit(bounds[mid])
        return F.when(bound < key, search(mid + 1, hi)).otherwise(search(lo, mid))

    return search(0, len(bounds)) if bounds else F.lit(0)


def order_bounds(df: DataFrame, cols: list[str], n_buckets: int) -> list[tuple]:
    """At most ``n_buckets - 1`` boundaries of the order by ``cols``, from the rows with the smallest hash.

    The sample has ``SAMPLE_PER_BUCKET`` rows per bucket and is the same on every run; it only decides how evenly the
    buckets fill.
    """
    if n_buckets <= 1:
        return []
    rows = df.select(*cols).orderBy(F.xxhash64(*cols), *cols).limit(SAMPLE_PER_BUCKET * n_buckets).collect()
    ranked = sorted({tuple(r) for r in rows}, key=lambda r: [(v is not None, v) for v in r])
    return [ranked[i * len(ranked) // n_buckets] for i in range(1, n_buckets)] if len(ranked) >= n_buckets else ranked[1:]


def bucketed(df: DataFrame, cols: list[str], n_buckets: int) -> DataFrame:
    """Adds ``_bkt``, monotone in the order by all of ``cols``: equal first keys do not share a bucket by force."""
    types = {f.name: f.dataType for f in df.schema.fields}
    whole = F.struct(*[F.col(c) for c in cols])
    bounds = [F.struct(*[F.lit(v).cast(types[c]).alias(c) for c, v in zip(cols, b)])
              for b in order_bounds(df, cols, n_buckets)]
    return df.withColumn("_bkt", bucket_of(whole, bounds))


def numbered(df: DataFrame, order: list[str], parts: int | None = None, name: str = "_row") -> DataFrame:
    """``df`` staged in the order of ``order``; ``name`` grows with it and tells the partition and the place there."""
    placed = df.repartitionByRange(parts or _default_buckets(df), *order).sortWithinPartitions(*order)
    return materialize(placed.withColumn(name, F.monotonically_increasing_id()))


def _offsets(totals: dict[int, tuple], n: int, width: int) -> list[list]:
    rows = [totals.get(i, (0,) * width) for i in range(n)]
    out = []
    running = [0] * width
    for r in rows:
        out.append(list(running))
        running = [a + (b or 0) for a, b in zip(running, r)]
    return out


def global_index(df: DataFrame, key: str, tiebreak: list[str] | None = None, n_buckets: int | None = None,
                 name: str = "_idx") -> DataFrame:
    """0-based position of each row in the global order (key, *tiebreak)."""
    return global_index_with_count(df, key, tiebreak, n_buckets, name)[0]


def global_index_with_count(df: DataFrame, key: str, tiebreak: list[str] | None = None,
                            n_buckets: int | None = None, name: str = "_idx") -> tuple[DataFrame, int]:
    """``global_index`` plus the row count (the sum of the collected bucket counts: no extra job)."""
    d = numbered(df, [key, *(tiebreak or [])], n_buckets)
    part = F.shiftright("_row", PART_BITS)
    counts = {r["p"]: r["c"] for r in d.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("c")).collect()}  # a row a partition
    before, offsets = 0, []
    for p in range(max(counts, default=0) + 1):
        offsets.append(before)
        before += counts.get(p, 0)
    offset = F.array(*[F.lit(o).cast("long") for o in offsets])[part.cast("int")]
    return d.withColumn(name, offset + F.col("_row").bitwiseAND(F.lit((1 << PART_BITS) - 1))).drop("_row"), before


def prefix_sums(df: DataFrame, key: str, cols: list[str], n_buckets: int | None = None,
                prefix: str = "cum_") -> DataFrame:
    """Inclusive running sums of ``cols`` in ``key`` order; ``key`` must be unique in ``df``."""
    return prefix_sums_with_totals(df, key, cols, n_buckets, prefix)[0]


def prefix_sums_with_totals(df: DataFrame, key: str, cols: list[str], n_buckets: int | None = None,
                            prefix: str = "cum_") -> tuple[DataFrame, list]:
    """``prefix_sums`` plus the grand totals of ``cols`` (from the collected bucket totals)."""
    n = n_buckets or _default_buckets(df)
    bounds = range_bounds(df, key, n)
    d = df.withColumn("_bkt", bucket_of(F.col(key), bounds))
    tot_rows = d.groupBy("_bkt").agg(*[F.sum(c).alias(c) for c in cols]).collect()
    totals = {r["_bkt"]: tuple(r[c] for c in cols) for r in tot_rows}
    nb = len(bounds) + 1
    offs = _offsets(totals, nb, len(cols))
    w = Window.partitionBy("_bkt").orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    out = d
    for i, c in enumerate(cols):
        arr = F.array(*[F.lit(o[i]) for o in offs])
        out = out.withColumn(prefix + c, F.element_at(arr, F.col("_bkt") + 1) + F.sum(c).over(w))
    totals_all = [sum((t[i] or 0) for t in totals.values()) for i in range(len(cols))]
    return out.drop("_bkt"), totals_all


def evenly_spaced(df: DataFrame, key: str, tiebreak: list[str], k: int, n_buckets: int | None = None) -> DataFrame:
    """Keep positions floor(i (n - 1) / (k - 1)), i = 0..k-1, of the ordered rows.

    A row filter on the global index: position p is kept iff
    p == floor(ceil(p (k - 1) / (n - 1)) (n - 1) / (k - 1)).  No join, no driver loop.
    Returns all rows when n <= k.
    """
    idx, n = global_index_with_count(df, key, tiebreak, n_buckets)
    if n <= k:
        return df
    if k <= 1:
        return idx.where(F.col("_idx") == 0).drop("_idx")
    # exact integer arithmetic (valid while n * k < 9.2e18)
    keep = F.expr(f"((((_idx * {k - 1}) + {n - 2}) div {n - 1}) * {n - 1}) div {k - 1} = _idx")
    return idx.where(keep).drop("_idx")


def chronological_split(df: DataFrame, key: str = "us", tiebreak: list[str] | None = None,
                        fractions: list[tuple[str, float]] | None = None, n_buckets: int | None = None
                        ) -> DataFrame:
    """Slice boundaries at int(n * fraction) on the global (time, id) order."""
    from riskline.constants import SPLIT_FRACTIONS

    fr = fractions or SPLIT_FRACTIONS
    idx, n = global_index_with_count(df, key, tiebreak or ["transaction_id"], n_buckets)
    bounds = [int(n * f) for _, f in fr]
    expr = None
    for (name, _), hi in zip(fr, bounds):
        cond = F.col("_idx") < hi
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return idx.withColumn("split", expr).withColumnRenamed("_idx", "row_index")


def hash_rank(id_col: Column, seed: int) -> Column:
    """60 bits of the MD5 of ``id:seed``: a fixed pseudo-random rank that any SQL engine can compute."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", id_col, F.lit(str(seed)))), 1, 15), 16, 10).cast("long")


def exact_sample_by_rank(df: DataFrame, count: int, seed: int = 42, id_col: str = "transaction_id",
                         n_buckets: int | None = None) -> DataFrame:
    """Keep exactly ``count`` rows chosen by a seeded hash rank (reproducible, unlike ``sample``)."""
    ranked = df.withColumn("_h", hash_rank(F.col(id_col), seed))
    idx = global_index(ranked, "_h", [id_col], n_buckets)
    return idx.where(F.col("_idx") < count).drop("_idx", "_h")
