"""Joins for event streams: windowed aggregate join, interval join, enrichment.

Each works on batch input (for tests and backfills) and on streaming input
(watermarks required where Spark needs them to bound state).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamkit.operators.windows import MICROS, is_ntz, flatten_window, window_groups, with_event_time

# broadcast a dimension only when it has at most this many rows (checked)
DEFAULT_BROADCAST_ROWS = 1_000_000


def join_windowed(left: DataFrame, right: DataFrame, *, left_time: str, right_time: str,
                  size: str, left_aggs: list[Column], right_aggs: list[Column],
                  keys: Iterable[str] = (), how: str = "inner",
                  delay: str | None = None) -> DataFrame:
    """Aggregate both sides per (window, keys) and join the aggregates.

    The join key is the window struct itself plus ``keys`` -- exactly the
    aggregates' grouping keys -- so both sides arrive already hash-partitioned
    for the join and it adds no shuffle of its own.  Streaming: both sides
    carry the watermark ``delay``; append mode emits a joined row once both
    windows are final.
    """
    keys = list(keys)
    la = window_groups(left, left_time, size, left_aggs, keys=keys, delay=delay)
    ra = window_groups(right, right_time, size, right_aggs, keys=keys, delay=delay)
    return flatten_window(la.join(ra, ["_w", *keys], how), is_ntz(left, left_time))


def _floor_div(x: Column, d: int) -> Column:
    """Exact floor(x / d) for BIGINT x (no floating point near bucket edges)."""
    return F.call_function("div", x - F.pmod(x, F.lit(d)), F.lit(d))


def join_interval(left: DataFrame, right: DataFrame, *, keys: list[str], left_time: str,
                  right_time: str, lower_seconds: int, upper_seconds: int,
                  how: str = "inner", delay: str | None = None,
                  bucket_seconds: int | None = None,
                  left_prefix: str = "l_", right_prefix: str = "r_") -> DataFrame:
    """Row-level interval join: ``r.time BETWEEN l.time + lower AND l.time + upper``
    on equal ``keys``; ``how`` is ``inner`` or ``left``.

    The time axis is cut into buckets of ``bucket_seconds`` (default: the
    interval width) and the bucket joins the equi-keys, so a key with many
    rows is split by time and each row meets only candidates from nearby
    buckets (never key-wide pairing).  Each left row sits in the one bucket
    of its own time; each right row is copied to every bucket whose left
    rows it can match -- two for the default width.  Left rows are never
    copied, so a left join emits exactly one NULL row for a left row
    without partners, and no pair repeats.  Streaming input needs ``delay``
    (both watermarks).  Output columns are prefixed; keys appear once.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    width = int(bucket_seconds or max(1, upper_seconds - lower_seconds))
    lo_us, hi_us, w_us = lower_seconds * MICROS, upper_seconds * MICROS, width * MICROS
    ntz_l, ntz_r = is_ntz(left, left_time), is_ntz(right, right_time)
    if left.isStreaming or right.isStreaming:
        left = with_event_time(left, left_time, delay)
        right = with_event_time(right, right_time, delay)
    lname, rname = left_prefix + left_time, right_prefix + right_time
    lt = F.unix_micros(F.col(lname).cast("timestamp"))
    rt = F.unix_micros(F.col(rname).cast("timestamp"))
    lsel = (left.select(*[F.col(f"`{c}`").alias(c if c in keys else left_prefix + c) for c in left.columns])
                .withColumn("_bucket", _floor_div(lt, w_us)))
    # a right row at r matches left rows with time in [r - upper, r - lower]
    rsel = (right.select(*[F.col(f"`{c}`").alias(c if c in keys else right_prefix + c) for c in right.columns])
                 .withColumn("_bucket", F.explode(F.sequence(_floor_div(rt - hi_us, w_us),
                                                             _floor_div(rt - lo_us, w_us)))))
    L, R = lsel.alias("L"), rsel.alias("R")
    cond = F.lit(True)
    for k in keys + ["_bucket"]:
        cond = cond & (F.col(f"L.`{k}`") == F.col(f"R.`{k}`"))
    lts = F.col(f"L.`{lname}`").cast("timestamp")
    rts = F.col(f"R.`{rname}`").cast("timestamp")
    cond = (cond & (rts >= lts + F.expr(f"INTERVAL {int(lower_seconds)} SECONDS"))
                 & (rts <= lts + F.expr(f"INTERVAL {int(upper_seconds)} SECONDS")))
    lcols = [c for c in lsel.columns if c not in keys and c != "_bucket"]
    rcols = [c for c in rsel.columns if c not in keys and c != "_bucket"]
    out = L.join(R, cond, "inner" if how == "inner" else "left_outer").select(
        *[F.col(f"L.`{k}`").alias(k) for k in keys], *[F.col(f"L.`{c}`") for c in lcols],
        *[F.col(f"R.`{c}`") for c in rcols])
    return _restore_ntz(out, lname, rname, ntz_l, ntz_r)


def _restore_ntz(df: DataFrame, lcol: str, rcol: str, ntz_l: bool, ntz_r: bool) -> DataFrame:
    if ntz_l:
        df = df.withColumn(lcol, F.col(lcol).cast("timestamp_ntz"))
    if ntz_r:
        df = df.withColumn(rcol, F.col(rcol).cast("timestamp_ntz"))
    return df


def fits(df: DataFrame, max_rows: int) -> bool:
    """Checked size bound: True when ``df`` has at most ``max_rows`` rows.
    Costs a scan of at most ``max_rows + 1`` rows."""
    return df.limit(max_rows + 1).count() <= max_rows


def plan_bytes(df: DataFrame) -> int:
    """Bytes of the frame as the optimizer has them: the files of its scans, an
    upper bound for filters and aggregates of them.  No job runs."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def bucket_dimension(dim: DataFrame, name: str, keys: list[str], buckets: int) -> DataFrame:
    """Save a large dimension as a catalog table bucketed (and sorted) on the
    join keys and return it.  Joined on those keys, it is read already
    partitioned: only the other side is shuffled, so a stream-static join
    does not re-shuffle the whole dimension in every micro-batch."""
    (dim.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name))
    return dim.sparkSession.table(name)


# broadcast a dimension that is read anew in each micro-batch up to so many bytes of files
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def enrich_bounded(rows: DataFrame, dim: DataFrame, keys: dict[str, str], *, how: str = "left",
                   max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``rows`` with the dimension's columns ({row column: dimension column}).
    The dimension is broadcast if its files have at most ``max_bytes``; past
    that it is joined by shuffle, and as a ``bucket_dimension`` table read in
    its buckets, so that only ``rows`` are shuffled.  NULL keys match nothing."""
    right = F.broadcast(dim) if plan_bytes(dim) <= max_bytes else dim.hint("merge")
    cond = F.lit(True)
    for a, b in keys.items():
        cond = cond & (rows[a] == right[b])
    return rows.join(right, cond, how)


def enrich(stream: DataFrame, dim: DataFrame, keys: list[str] | dict[str, str], *,
           how: str = "left", broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Stream-batch (or batch-batch) enrichment join.

    ``keys`` is a list of shared column names or a {stream_col: dim_col}
    map.  The dimension is broadcast only after ``fits`` proves it has at
    most ``broadcast_rows`` rows; otherwise Spark plans a shuffle join --
    give a large dimension as a ``bucket_dimension`` table so that only the
    stream side is shuffled.
    """
    small = fits(dim, broadcast_rows)
    right = F.broadcast(dim) if small else dim
    if isinstance(keys, dict):
        cond = None
        for s, d in keys.items():
            c = stream[s] == right[d]
            cond = c if cond is None else cond & c
        return stream.join(right, cond, how)
    return stream.join(right, keys, how)
