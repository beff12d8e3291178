"""Order statistics of ranges: the k-th smallest value among positions lo ... hi - 1 of a user's rows.

``kth_smallest`` answers many ranges over one array by a wavelet matrix: a level per bit of the values' ranks, and at each a
count of zeros before every position, so a query costs one step a level whatever its range.  ``grouped_medians``
uses it on whole groups inside a task.

``range_medians`` does the same where a user's rows are more than a task should hold.  Rows are cut twice: by position
into time chunks, by value into buckets, both of bounded size.  Counts of every bucket before every time chunk are a small
table; the counts of a range are those of its whole chunks and the two chunks that it cuts.  Ranges that cut the
same two chunks are solved together: they find the bucket that holds their k-th value and its rank there, and a second
step finds it in the bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskline.session import materialize

#: Rows that a task takes at once at least, and numbers of a table of counts.
ROWS, TABLE = 1 << 14, 1 << 20


def kth_smallest(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
    """values of rank ``k`` (from 0) among ``values[lo:hi]``, for many ranges; every range has more than k entries."""
    known, rank = np.unique(values, return_inverse=True)
    lo, hi, k = lo.copy(), hi.copy(), k.copy()
    found = np.zeros(len(k), np.int64)
    for bit in range(max(len(known) - 1, 0).bit_length() - 1, -1, -1):
        one = (rank >> bit & 1).astype(bool)
        zeros = np.concatenate([[0], np.cumsum(~one)])
        low, high = zeros[lo], zeros[hi]
        up = k >= high - low
        k = np.where(up, k - (high - low), k)
        lo, hi = np.where(up, zeros[-1] + lo - low, low), np.where(up, zeros[-1] + hi - high, high)
        found |= up.astype(np.int64) << bit
        rank = np.concatenate([rank[~one], rank[one]])
    return known[found] if len(known) else np.zeros(0)


def medians(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Median of ``values[lo:hi]`` for many ranges, NaN where a range is empty."""
    out = np.full(len(lo), np.nan)
    some = hi > lo
    lo, hi = lo[some], hi[some]
    low = kth_smallest(values, lo, hi, (hi - lo - 1) // 2)
    high = kth_smallest(values, lo, hi, (hi - lo) // 2)
    out[some] = low * 0.5 + high * 0.5
    return out


def _changes(columns: list[pa.Array], nulls_alike: bool = False) -> np.ndarray:
    """Number of the group of every row, rows being sorted by ``columns``; a null is a group of its own or like other nulls."""
    fresh = np.zeros(len(columns[0]), bool)
    for c in columns:
        if nulls_alike:
            codes = c.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        else:
            codes = c.dictionary_encode().indices.to_numpy(zero_copy_only=False) if pa.types.is_string(c.type) else c.to_numpy(zero_copy_only=False)
        fresh[1:] |= codes[1:] != codes[:-1]
    return np.cumsum(fresh)


def earlier(group: np.ndarray, time: np.ndarray, of_group: np.ndarray, before: np.ndarray) -> np.ndarray:
    """How many of the entries (group, time) come before the group ``of_group``, or are in it with a time below ``before``."""
    entry = np.concatenate([np.zeros(len(before), bool), np.ones(len(time), bool)])
    order = np.lexsort((entry, np.concatenate([before, time]), np.concatenate([of_group, group])))
    count = np.cumsum(entry[order])
    out = np.empty(len(order), np.int64)
    out[order] = count
    return out[: len(before)]


def grouped_medians(df: DataFrame, by: list[str], name: str | None, horizon: int | None, open_until: dict[str, str] | None = None) -> DataFrame:
    """Adds the median amount of the earlier rows of a row's group, as column ``name`` (None: leaves it out).

    ``df`` is partitioned by ``by`` and sorted by it, then by ``us`` and ``transaction_id``.  With a ``horizon``, earlier
    rows are those with a time in [us - horizon, us); without one, those before it in the order.  ``open_until`` maps a
    further column to a time: it counts the earlier rows whose time has not passed before the row's own.  Groups are taken
    whole, several at a time.
    """
    open_until = open_until or {}
    added = [(c, T.LongType()) for c in open_until] + ([(name, T.DoubleType())] if name else [])
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields] + [T.StructField(c, t, True) for c, t in added])

    def solve(part: pa.RecordBatch) -> pa.RecordBatch:
        group = _changes([part.column(c) for c in by])
        time = part.column("us").to_numpy()
        made = []
        if open_until:
            whole = _changes([part.column(c) for c in by], nulls_alike=True)
            began = earlier(whole, time, whole, time)
            made += [pa.array(began - earlier(whole, part.column(c).to_numpy(), whole, time)) for c in open_until.values()]
        if name:
            found = amounts(part, group, time)
            made.append(pa.array(found, mask=np.isnan(found)))
        return pa.RecordBatch.from_arrays([*part.columns, *made], schema.names)

    def amounts(part: pa.RecordBatch, group: np.ndarray, time: np.ndarray) -> np.ndarray:
        amount = part.column("amount").to_numpy(zero_copy_only=False).astype(float)
        member = ~np.isnan(amount)
        if horizon is None:
            hi = np.cumsum(member) - member
            lo = hi[np.searchsorted(group, group)]
        else:
            hi = earlier(group[member], time[member], group, time)
            lo = earlier(group[member], time[member], group, time - horizon)
        return medians(amount[member], lo, hi)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < ROWS:
                continue
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            group = _changes([whole.column(c) for c in by], nulls_alike=True)
            last = int(np.searchsorted(group, group[-1]))  # the last group may go on
            if last:
                yield solve(whole.slice(0, last))
            held = [whole.slice(last)]
        whole = pa.Table.from_batches(held).combine_chunks().to_batches() if held else []
        if whole:
            yield solve(whole[0])

    return df.mapInArrow(run, schema)


def _find_buckets(left: pa.Table, right: pa.Table) -> pa.Table:
    """Ranges that cut the same two time chunks: the bucket of their k-th value and its rank there.

    ``left`` holds the ranges (lo, hi, k) and one row with the counts before the two chunks; ``right`` the chunks' rows.
    """
    names, kinds = ["user_id", "lo", "hi", "k", "bucket", "rest"], [pa.string(), *[pa.int64()] * 5]
    is_counts = left.column("upper").is_valid().to_numpy()
    asked, told = left.filter(pa.array(~is_counts)), left.filter(pa.array(is_counts))
    if not asked.num_rows or not told.num_rows:
        return pa.table({n: pa.array([], t) for n, t in zip(names, kinds, strict=True)})
    lo, hi, k = (asked.column(c).to_numpy() for c in ("lo", "hi", "k"))
    upper, lower = (np.array(told.column(c)[0].as_py(), np.int64) for c in ("upper", "lower"))
    pos, bucket = right.column("pos").to_numpy(), right.column("bucket").to_numpy()
    place = np.unique(pos, return_index=True)[1]  # the chunks are one if the range begins and ends in it
    pos, bucket = pos[place], bucket[place]
    chunk = right.column("chunk_rows")[0].as_py()
    first = int(hi[0]) // chunk * chunk  # first position of the chunk where the ranges end
    begin = int(lo[0]) // chunk * chunk  # of the chunk where they begin
    same = begin == first
    out_bucket, out_rest = np.empty(len(k), np.int64), np.empty(len(k), np.int64)
    step = max(1, TABLE // max(len(upper), 1))

    def before(limit: np.ndarray, least: int, most: int) -> np.ndarray:
        """Counts by bucket of the rows at positions least ... limit - 1 (below ``most``), for every limit, growing."""
        inside = (pos >= least) & (pos < most)
        p, b = pos[inside], bucket[inside]
        ends = np.searchsorted(p, limit)
        table = np.zeros((len(limit), len(upper)), np.int64)
        table[0] = np.bincount(b[: ends[0]], minlength=len(upper))
        row = np.searchsorted(ends, np.arange(ends[0], ends[-1]), side="right")
        np.add.at(table, (row, b[ends[0] : ends[-1]]), 1)
        return np.cumsum(table, axis=0)

    order = np.lexsort((lo, hi))
    for at in range(0, len(k), step):
        some = order[at : at + step]
        counts = before(hi[some], first, first + chunk)
        by_lo = np.argsort(lo[some], kind="stable")
        gone = np.empty_like(counts)
        gone[by_lo] = before(lo[some][by_lo], begin, begin + chunk)
        if same:
            counts = counts - gone
        else:  # the rest of the first chunk, whole chunks, the begin of the last one
            of_first = np.bincount(bucket[(pos >= begin) & (pos < begin + chunk)], minlength=len(upper))
            counts = counts + (upper - lower)[None] + of_first[None] - gone
        total = np.cumsum(counts, axis=1)
        found = (total <= k[some][:, None]).sum(axis=1)
        out_bucket[some] = found
        out_rest[some] = k[some] - (total[np.arange(len(some)), found] - counts[np.arange(len(some)), found])
    users = asked.column("user_id")
    return pa.table({"user_id": users, "lo": lo, "hi": hi, "k": k, "bucket": out_bucket, "rest": out_rest})


def _find_values(left: pa.Table, right: pa.Table) -> pa.Table:
    """The values of ranges (lo, hi, rest) among the rows of one bucket."""
    if not left.num_rows or not right.num_rows:
        return pa.table({"user_id": pa.array([], pa.string()), "lo": pa.array([], pa.int64()), "hi": pa.array([], pa.int64()), "value": pa.array([], pa.float64())})
    pos, value = right.column("pos").to_numpy(), right.column("value").to_numpy()
    order = np.argsort(pos)
    pos, value = pos[order], value[order]
    lo, hi = left.column("lo").to_numpy(), left.column("hi").to_numpy()
    found = kth_smallest(value, np.searchsorted(pos, lo), np.searchsorted(pos, hi), left.column("rest").to_numpy().astype(np.int64))
    return pa.table({"user_id": left.column("user_id"), "lo": lo, "hi": hi, "value": found})


def range_medians(rows: DataFrame, ranges: DataFrame, bits: int) -> DataFrame:
    """(user_id, lo, hi, median) of distinct non-empty ranges (user_id, lo, hi) over rows (user_id, pos, value).

    Positions of a user run from 0 without gaps.  No task holds more than a few chunks of ``2 ** bits`` rows.
    """
    from riskline.operators.segments import ordered_chunks

    size = 1 << bits
    by_value = ordered_chunks(rows.where("value is not null"), ["user_id", "value", "pos"], bits)
    pieces = by_value.select("user_id", F.col("_chunk")).distinct()
    numbered = pieces.withColumn("bucket", F.row_number().over(Window.partitionBy("user_id").orderBy("_chunk")).cast("long") - 1)
    dealt = by_value.join(numbered, ["user_id", "_chunk"]).select("user_id", "pos", "value", "bucket", F.shiftright("pos", bits).alias("chunk"))
    dealt = materialize(dealt)

    # counts of every bucket before every time chunk (chunks x buckets numbers of a user)
    users = dealt.groupBy("user_id").agg(F.max("chunk").alias("chunks"), F.max("bucket").alias("buckets"))
    grid = users.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") + 1)))
    grid = grid.withColumn("bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.col("buckets")))).select("user_id", "chunk", "bucket")
    seen = dealt.groupBy("user_id", "chunk", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("user_id", "bucket").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    table = grid.join(seen, ["user_id", "chunk", "bucket"], "left").withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    table = table.groupBy("user_id", "chunk").agg(F.transform(F.array_sort(F.collect_list(F.struct("bucket", "before"))), lambda x: x["before"]).alias("counts"))
    table = materialize(table)

    n = F.col("hi") - F.col("lo")
    wanted = ranges.withColumn("k", F.explode(F.array_distinct(F.array(F.floor((n - 1) / 2), F.floor(n / 2)))))
    wanted = materialize(wanted.select("user_id", "lo", "hi", "k", F.shiftright("hi", bits).alias("to_chunk"), F.shiftright("lo", bits).alias("from_chunk")))
    cut = wanted.select("user_id", "to_chunk", "from_chunk").distinct()
    upper = table.select("user_id", F.col("chunk").alias("to_chunk"), F.col("counts").alias("upper"))
    lower = table.select("user_id", (F.col("chunk") - 1).alias("from_chunk"), F.col("counts").alias("lower"))
    told = cut.join(upper, ["user_id", "to_chunk"]).join(lower, ["user_id", "from_chunk"])
    nothing = F.lit(None).cast("long")
    left = wanted.select("user_id", "to_chunk", "from_chunk", "lo", "hi", "k", F.lit(None).cast("array<bigint>").alias("upper"), F.lit(None).cast("array<bigint>").alias("lower"))
    left = left.unionByName(told.select("user_id", "to_chunk", "from_chunk", nothing.alias("lo"), nothing.alias("hi"), nothing.alias("k"), "upper", "lower"))
    sides = cut.select("*", F.explode(F.array_distinct(F.array("to_chunk", "from_chunk"))).alias("chunk"))
    right = dealt.select("user_id", "pos", "bucket", "chunk").join(sides, ["user_id", "chunk"]).withColumn("chunk_rows", F.lit(size))
    # a range may end where the last chunk does: then that chunk has no rows, and one row without a place stands for it
    empty = cut.select("user_id", F.lit(-1).cast("long").alias("pos"), F.lit(0).cast("long").alias("bucket"), F.lit(-1).cast("long").alias("chunk"), "to_chunk", "from_chunk", F.lit(size).alias("chunk_rows"))
    right = right.select(empty.columns).unionByName(empty)
    left, right = left.toDF(*left.columns), right.toDF(*right.columns)  # columns of their own: both come from one table
    keys = ["user_id", "to_chunk", "from_chunk"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_find_buckets, "user_id string, lo long, hi long, k long, bucket long, rest long")
    found = materialize(found)

    blocks = found.groupBy("user_id", "bucket").agg(F.ceil(F.count(F.lit(1)) / F.lit(size)).alias("blocks"))
    asked = found.join(blocks, ["user_id", "bucket"]).withColumn("block", F.pmod(F.xxhash64("lo", "hi"), F.col("blocks")))
    held = dealt.select("user_id", "pos", "value", "bucket").join(blocks, ["user_id", "bucket"])
    held = held.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    asked, held = asked.toDF(*asked.columns), held.toDF(*held.columns)
    keys = ["user_id", "bucket", "block"]
    values = asked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(_find_values, "user_id string, lo long, hi long, value double")
    # the two middle values of a range, or one
    return values.groupBy("user_id", "lo", "hi").agg((F.min("value") * 0.5 + F.max("value") * 0.5).alias("median"))
