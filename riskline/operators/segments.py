"""Scans over the ordered rows of a user in chunks of bounded size.

A window partitioned by user is one task per user.  Here the rows are range-partitioned in the order that the scan
needs, staged, and numbered; ``CHUNK_BITS`` of the number make a chunk, so a chunk has a bounded number of rows whoever
they belong to.  A scan is a window inside the (user, chunk) pieces plus what the earlier pieces of the user carry over:
one summary row a piece, combined by a window over the summaries.  Staging fixes the numbers; a task that is lost is
computed again from the staged rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskline import constants as C
from riskline.operators.ordering import numbered
from riskline.operators.selection import range_medians
from riskline.session import materialize

#: Rows of a chunk, as a power of two.
CHUNK_BITS = 15
#: Users with more rows than this are scanned in chunks, the others by windows over the user.
HOT_ROWS = 1 << 18
#: Rows of a task of windows over users (their history copies come on top), and rows that are worth a task.
TASK_ROWS, FEW_ROWS = 1 << 15, 1 << 12
UNB = Window.unboundedPreceding
EXACT = "decimal(38,10)"


def ordered_chunks(df: DataFrame, order: list[str], bits: int = CHUNK_BITS) -> DataFrame:
    """``df`` staged in the order of ``order``, with the row number ``_row`` (growing, with gaps) and its ``_chunk``."""
    return numbered(df, order).withColumn("_chunk", F.shiftright("_row", bits))


def carried(chunks: DataFrame, by: list[str], totals: dict[str, Column], later: bool = False) -> DataFrame:
    """Adds to every row what the earlier (``later``: the later) chunks of its ``by`` come to; null where there is none.

    ``totals`` maps a new column to an aggregate; one named ``sum_...`` is added up, ``max_...`` and ``min_...`` are
    combined likewise.
    """
    over = Window.partitionBy(*by).orderBy(F.desc("_chunk") if later else F.col("_chunk")).rowsBetween(UNB, -1)
    summary = chunks.groupBy(*by, "_chunk").agg(*[c.alias(n) for n, c in totals.items()])
    combine = {"sum": F.sum, "max": F.max, "min": F.min}
    return chunks.join(summary.select(*by, "_chunk", *[combine[n.split("_")[0]](n).over(over).alias(n) for n in totals]), [*by, "_chunk"])


def user_rows(rows: DataFrame, more_than: int) -> tuple[int, DataFrame | None]:
    """Number of rows, and the users with more rows than a task should hold (None if there is none)."""
    counts = rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    found = counts.agg(F.sum("n").alias("rows"), F.max("n").alias("most")).first()
    if (found["most"] or 0) <= more_than:
        return found["rows"] or 0, None
    return found["rows"], materialize(counts.where(F.col("n") > more_than).select("user_id"))


def window_tasks(spark: SparkSession, rows: int) -> int:
    """Tasks for ``rows`` rows in windows, so that a task's rows do not grow with the table.

    Given to ``repartition`` as a number, which adaptive execution keeps: it joins partitions by their shuffled bytes,
    and rows that compress well would meet in a few tasks, each with several sorts of what they come to unpacked.
    """
    spread = int(spark.conf.get("spark.sql.shuffle.partitions", "8"))
    return max(2, -(-rows // TASK_ROWS), min(spread, -(-rows // FEW_ROWS)))


def time_line(rows: DataFrame, widths: dict[str, int], ends: dict[str, Column], asking: list[str], seen: list[str], both: list[str], bits: int) -> DataFrame:
    """Rows and what becomes of them later, in one order per user: what a row sees at its time is a prefix of it.

    A row asks at its time (kind ``row``).  It is seen by rows at any later microsecond (``seen``), leaves the window
    of a width that much later, and ends early where ``ends`` says so; kinds of these two are the names given.  Whatever
    happens at a row's own time or before comes before it in the order, so rows of equal time never see each other.
    Columns travel with the events that need them.
    """
    def event(kind: str, time: Column, asks: bool = False) -> Column:
        return F.struct(F.lit(kind).alias("kind"), time.alias("time"), F.lit(int(asks)).alias("asks"))

    happens = [event("row", F.col("us"), True), event("seen", F.col("us") + 1)]
    happens += [event(n, F.col("us") + w + 1) for n, w in widths.items()]
    happens += [event(n, end + 1) for n, end in ends.items()]
    each = rows.select("user_id", F.col("_row").alias("of_row"), "amount", *asking, *seen, *both, F.explode(F.array(*happens)).alias("e"))
    of = [(asking, ["row"]), (seen, ["seen"]), (both, ["row", "seen"])]
    kept = [F.when(F.col("e.kind").isin(kinds), F.col(c)).alias(c) for columns, kinds in of for c in columns]
    flat = each.select("user_id", "of_row", "e.kind", "e.time", "e.asks", "amount", *kept)
    return ordered_chunks(flat, ["user_id", "time", "asks", "of_row", "kind"], bits)


def _running(line: DataFrame, sums: dict[str, Column], extra: dict[str, Column]) -> DataFrame:
    """Prefix sums and maxima along the user's time line, up to and with every event."""
    totals = {f"sum_{n}": F.sum(c) for n, c in sums.items()} | {f"max_{n}": F.max(c) for n, c in extra.items()}
    inside = Window.partitionBy("user_id", "_chunk").orderBy("_row").rowsBetween(UNB, 0)
    with_carry = carried(line, ["user_id"], totals)
    out = {n: F.sum(c).over(inside) + F.coalesce(F.col(f"sum_{n}"), F.lit(0)) for n, c in sums.items()}
    out |= {n: F.greatest(F.max(c).over(inside), F.col(f"max_{n}")) for n, c in extra.items()}
    return with_carry.select("*", *[c.alias(n) for n, c in out.items()])


def _seen_before(line: DataFrame, value: str, name: str) -> DataFrame:
    """The latest time at which the row's own ``value`` was seen before."""
    seen = F.when(F.col("kind") == "seen", F.col("time") - 1)
    inside = Window.partitionBy("user_id", value, "_chunk").orderBy("_row").rowsBetween(UNB, 0)
    found = carried(line, ["user_id", value], {"max_seen": F.max(seen)})
    return found.withColumn(name, F.greatest(F.max(seen).over(inside), F.col("max_seen"))).drop("max_seen")


def online_scan(rows: DataFrame, horizon: int, distinct_counts: bool, medians: bool, bits: int = CHUNK_BITS) -> DataFrame:
    """What ``features.online_features`` derives its columns from, for users of any size: counts, sums, latest rows.

    Returns the rows' columns with ``_n_h _s_h _med _n1m _n5m _n1h _n24h _s1h _um24 _uc24 _seen_m _seen_c _seen_d _prev``.
    """
    values = {"m": "merchant_id", "c": "country", "d": "device_id"}
    named = rows.select("*", *[F.coalesce(F.col(c), F.lit("")).alias(f"_v{k}") for k, c in values.items()])
    order = ordered_chunks(named, ["user_id", "us", "transaction_id"], bits)
    ends: dict[str, Column] = {}
    if distinct_counts:  # a value's 24 hours end early where it occurs again
        for k in ("m", "c"):
            again = Window.partitionBy("user_id", f"_v{k}", "_chunk").orderBy("_row")
            order = carried(order, ["user_id", f"_v{k}"], {"min_next": F.min("us")}, later=True)
            order = order.withColumn(f"_end{k}", F.least(F.coalesce(F.lead("us").over(again), F.col("min_next")), F.col("us") + C.DAY_US)).drop("min_next")
            ends[f"end_{k}"] = F.col(f"_end{k}")
    widths = {"1m": C.MINUTE_US, "5m": 5 * C.MINUTE_US, "1h": C.HOUR_US, "24h": C.DAY_US, "h": horizon}
    row = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    latest = F.struct("us", F.col("transaction_id").alias("id"), F.col("ip_address").alias("ip"), F.col("latitude").alias("lat"), F.col("longitude").alias("lon"))
    order = order.withColumn("_content", row).withColumn("_latest", latest)
    line = time_line(order, widths, ends, ["_content"], ["_latest"], [f"_v{k}" for k in values], bits)
    kind, amount = F.col("kind"), F.col("amount").cast(EXACT)

    def count(name: str) -> Column:
        return F.when(kind == "seen", 1).when(kind == name, -1).otherwise(0).cast("long")

    sums = {f"_n{w}" if w != "h" else "_n_h": count(w) for w in widths} | {"_seen": F.when(kind == "seen", 1).otherwise(0).cast("long")}
    sums |= {n: F.when(kind == "seen", amount).when(kind == w, -amount).otherwise(F.lit(0).cast(EXACT)) for n, w in (("_s1h", "1h"), ("_s_h", "h"))}
    if distinct_counts:
        sums |= {"_um24": count("end_m"), "_uc24": count("end_c")}
    line = _running(line, sums, {"_prev": F.when(kind == "seen", F.col("_latest"))})
    for k in values:
        line = _seen_before(line, f"_v{k}", f"_seen_{k}")
    asked = line.where(kind == "row")
    if not distinct_counts:
        asked = asked.withColumn("_um24", F.lit(None).cast("long")).withColumn("_uc24", F.lit(None).cast("long"))
    names = ["_n_h", "_s_h", "_n1m", "_n5m", "_n1h", "_n24h", "_s1h", "_um24", "_uc24", "_seen_m", "_seen_c", "_seen_d", "_prev"]
    if not medians:
        return asked.select("_content.*", *names, F.lit(None).cast("double").alias("_med"))
    asked = materialize(asked.select("user_id", "of_row", "_content", *names, (F.col("_seen") - F.col("_n_h")).alias("lo"), F.col("_seen").alias("hi")))
    place = positions(order)
    found = range_medians(place.select("user_id", "pos", F.col("amount").alias("value")), asked.where("hi > lo").select("user_id", "lo", "hi").distinct(), bits)
    return asked.join(found, ["user_id", "lo", "hi"], "left").select("_content.*", *names, F.col("median").alias("_med"))


def positions(order: DataFrame) -> DataFrame:
    """Adds ``pos``, the place of a row among its user's rows, from 0."""
    inside = Window.partitionBy("user_id", "_chunk").orderBy("_row")
    found = carried(order, ["user_id"], {"sum_rows": F.count(F.lit(1))})
    return found.withColumn("pos", F.row_number().over(inside) - 1 + F.coalesce(F.col("sum_rows"), F.lit(0))).drop("sum_rows")


def offline_scan(rows: DataFrame, values: list[str], widths: dict[str, int], bits: int = CHUNK_BITS) -> DataFrame:
    """What ``features.offline_features`` derives its columns from, for users of any size.

    Returns the rows' columns with ``_pos`` (earlier rows), ``_sum`` and ``_med`` of their amounts, ``_new_<value>`` and
    ``_n_<width>`` (earlier rows within a width, rows of equal time left out).
    """
    order = positions(ordered_chunks(rows, ["user_id", "us", "transaction_id"], bits))
    inside = Window.partitionBy("user_id", "_chunk").orderBy("_row").rowsBetween(UNB, -1)
    order = carried(order, ["user_id"], {"sum_amount": F.sum(F.col("amount").cast(EXACT))})
    order = order.withColumn("_sum", F.coalesce(F.sum(F.col("amount").cast(EXACT)).over(inside), F.lit(0)) + F.coalesce(F.col("sum_amount"), F.lit(0)))
    for v in values:
        key = f"_v_{v}"
        order = order.withColumn(key, F.coalesce(F.col(v), F.lit("")))
        order = carried(order, ["user_id", key], {"max_row": F.max("_row")})
        first = F.row_number().over(Window.partitionBy("user_id", key, "_chunk").orderBy("_row")) == 1
        order = order.withColumn(f"_new_{v}", first & F.col("max_row").isNull()).drop("max_row", key)
    order = materialize(order)
    found = [F.col(c) for c in ("pos", "_sum", *[f"_new_{v}" for v in values])]
    content = order.withColumn("_content", F.struct(*[F.col(f"`{c}`") for c in rows.columns], *found))
    line = time_line(content, widths, {}, ["_content"], [], [], bits)
    kind = F.col("kind")
    line = _running(line, {f"_n_{w}": F.when(kind == "seen", 1).when(kind == w, -1).otherwise(0).cast("long") for w in widths}, {})
    asked = line.where(kind == "row").select("_content.*", *[f"_n_{w}" for w in widths])
    wanted = order.where("pos > 0").select("user_id", F.lit(0).cast("long").alias("lo"), F.col("pos").alias("hi"))
    medians = range_medians(order.select("user_id", "pos", F.col("amount").alias("value")), wanted, bits)
    medians = medians.select("user_id", F.col("hi").alias("pos"), F.col("median").alias("_med"))
    return asked.join(medians, ["user_id", "pos"], "left").withColumnRenamed("pos", "_pos")
