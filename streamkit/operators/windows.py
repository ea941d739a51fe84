"""Event time: watermarks, tumbling/sliding/session windows, late rows.

Each function takes a batch or a streaming DataFrame.  Streaming input gets
a watermark (Spark requires a ``timestamp`` column for it, so
``timestamp_ntz`` columns are cast on the way in and back on the way out;
the library keeps the session time zone at UTC).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamkit.session import shared_dir

MICROS = 1_000_000


def is_ntz(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, T.TimestampNTZType)


def with_event_time(df: DataFrame, col: str, delay: str | None) -> DataFrame:
    """Cast ``col`` to ``timestamp`` if needed and set the watermark ``delay``."""
    out = df.withColumn(col, F.col(col).cast("timestamp")) if is_ntz(df, col) else df
    return out.withWatermark(col, delay) if delay else out


def _flatten_window(df: DataFrame, wcol: str, ntz: bool) -> DataFrame:
    start, end = F.col(f"{wcol}.start"), F.col(f"{wcol}.end")
    if ntz:
        start, end = start.cast("timestamp_ntz"), end.cast("timestamp_ntz")
    rest = [F.col(f"`{c}`") for c in df.columns if c != wcol]
    return df.select(start.alias("window_start"), end.alias("window_end"), *rest)


def window_agg(df: DataFrame, time_col: str, size: str, aggs: list[Column], *,
               keys: Iterable[str] = (), slide: str | None = None,
               delay: str | None = None) -> DataFrame:
    """Tumbling (or, with ``slide``, sliding) event-time window aggregate.

    Output: ``window_start, window_end, *keys, *aggs``.  Partial aggregation
    runs before the shuffle, so a hot key or window costs one row per task
    on the wire.  Streaming input needs ``delay`` (the watermark); append
    mode then emits a window once the watermark passes its end.
    """
    return _flatten_window(window_groups(df, time_col, size, aggs, keys=keys, slide=slide, delay=delay),
                           "_w", is_ntz(df, time_col))


def window_groups(df: DataFrame, time_col: str, size: str, aggs: list[Column], *,
                  keys: Iterable[str] = (), slide: str | None = None,
                  delay: str | None = None) -> DataFrame:
    """``window_agg`` before flattening: the window stays one struct column
    ``_w`` (the aggregate's partitioning key, reusable by a later join)."""
    src = with_event_time(df, time_col, delay) if (df.isStreaming or delay) else df
    w = F.window(time_col, size, slide) if slide else F.window(time_col, size)
    return src.groupBy(w.alias("_w"), *keys).agg(*aggs)


def flatten_window(df: DataFrame, ntz: bool, wcol: str = "_w") -> DataFrame:
    """``_w`` struct -> ``window_start``, ``window_end`` (as timestamp_ntz when ``ntz``)."""
    return _flatten_window(df, wcol, ntz)


def session_agg(df: DataFrame, time_col: str, gap: str, aggs: list[Column], *,
                keys: Iterable[str] = (), delay: str | None = None) -> DataFrame:
    """Session windows with Spark's ``session_window`` (streaming path)."""
    ntz = is_ntz(df, time_col)
    src = with_event_time(df, time_col, delay) if (df.isStreaming or delay) else df
    out = src.groupBy(F.session_window(time_col, gap).alias("_w"), *keys).agg(*aggs)
    return _flatten_window(out, "_w", ntz)


def _micros(df: DataFrame, col: str) -> Column:
    return F.unix_micros(F.col(col).cast("timestamp"))


def sessions(df: DataFrame, time_col: str, gap_seconds: int, *, keys: list[str],
             aggs: list[Column] | None = None, rows_per_chunk: int = 2_000_000,
             max_hot_keys: int = 200_000) -> DataFrame:
    """Batch session windows that stay parallel when one key holds most rows.

    Keys with at most ``rows_per_chunk`` rows go through Spark's
    ``session_window``: one scan, one shuffle.  A hotter key is cut into time
    chunks that hold about ``rows_per_chunk`` rows on average (never shorter than
    the gap); gaps are found with a window over (key, chunk), and the two facts
    that cross chunk borders -- the last event time and the last session start
    before a chunk -- come from a per-(key, chunk) summary.  One aggregate first
    finds the hot keys, at most rows / rows_per_chunk of them, written as a table
    and broadcast after a size check (``max_hot_keys``; joined by shuffle past it).

    Same result for both: a session ends ``gap`` after its last event, and only an
    event strictly after that end starts a new session (one exactly at the end
    joins it).  Rows without an event time are left out; NULL keys are one key.

    Output: ``*keys, window_start, window_end, *aggs`` (default ``events``).
    """
    from streamkit.operators.joins import fits

    ntz = is_ntz(df, time_col)
    gap_us = int(gap_seconds) * MICROS
    aggs = aggs or [F.count(F.lit(1)).alias("events")]
    x = df.where(F.col(time_col).isNotNull())
    density = x.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min(_micros(df, time_col)).alias("_lo"),
                                   F.max(_micros(df, time_col)).alias("_hi"))
    shared_dir(df.sparkSession)
    hot = (density.where(F.col("_n") > rows_per_chunk)
                  .select(*[F.col(k).alias(f"_hk{i}") for i, k in enumerate(keys)],
                          F.greatest(F.lit(gap_us), F.ceil((F.col("_hi") - F.col("_lo") + 1) * rows_per_chunk / F.col("_n"))).cast("bigint").alias("_span"))
                  .checkpoint(eager=True))
    if hot.isEmpty():
        return _native_sessions(x, time_col, gap_seconds, keys, aggs)
    if not keys:   # all rows are one key: its span is a number, no join
        span = hot.first()["_span"]
        cut = x.withColumn("_t", _micros(df, time_col)).withColumn("_all", F.lit(0)).withColumn("_chunk", F.floor(F.col("_t") / F.lit(span)))
        return _sessions_by_chunk(cut, ["_all"], gap_us, aggs, ntz).drop("_all")
    # every hot key is cut, whatever their number: past the bound Spark plans the join
    hot = F.broadcast(hot) if fits(hot, max_hot_keys) else hot
    same_key = F.lit(True)
    for i, k in enumerate(keys):
        same_key = same_key & F.col(k).eqNullSafe(F.col(f"_hk{i}"))
    cold = _native_sessions(x.join(hot, same_key, "left_anti"), time_col, gap_seconds, keys, aggs)
    cut = (x.withColumn("_t", _micros(df, time_col)).join(hot, same_key)
            .withColumn("_chunk", F.floor(F.col("_t") / F.col("_span")))
            .drop("_span", *[f"_hk{i}" for i in range(len(keys))]))
    return cold.unionByName(_sessions_by_chunk(cut, keys, gap_us, aggs, ntz))


def _native_sessions(x: DataFrame, time_col: str, gap_seconds: int, keys: list[str], aggs: list[Column]) -> DataFrame:
    out = session_agg(x, time_col, f"{int(gap_seconds)} seconds", aggs, keys=keys)
    return out.select(*keys, "window_start", "window_end", *[c for c in out.columns if c not in (*keys, "window_start", "window_end")])


def _join_by(left: DataFrame, right: DataFrame, names: list[str]) -> DataFrame:
    """Inner join on ``names`` in which NULL keys match NULL keys."""
    right = right.select(*[F.col(n).alias(f"_j{i}") for i, n in enumerate(names)], *[c for c in right.columns if c not in names])
    cond = F.lit(True)
    for i, n in enumerate(names):
        cond = cond & F.col(n).eqNullSafe(F.col(f"_j{i}"))
    return left.join(right, cond).drop(*[f"_j{i}" for i in range(len(names))])


def _sessions_by_chunk(x: DataFrame, keys: list[str], gap_us: int, aggs: list[Column] | None,
                       ntz: bool) -> DataFrame:
    """Sessions of rows carrying ``_t`` (micros) and ``_chunk``."""
    by_chunk = Window.partitionBy(*keys, "_chunk").orderBy("_t")
    over_chunks = Window.partitionBy(*keys).orderBy("_chunk")
    before = over_chunks.rowsBetween(Window.unboundedPreceding, -1)

    edges = (x.groupBy(*keys, "_chunk").agg(F.max("_t").alias("_cmax"))
              .withColumn("_carry_prev", F.lag("_cmax").over(over_chunks))
              .drop("_cmax"))
    flagged = (_join_by(x, edges, [*keys, "_chunk"])
                .withColumn("_prev", F.coalesce(F.lag("_t").over(by_chunk), F.col("_carry_prev")))
                .withColumn("_start", F.when(F.col("_prev").isNull() |
                                             (F.col("_t") - F.col("_prev") > gap_us), F.col("_t")))
                .withColumn("_local_start", F.max("_start").over(
                    by_chunk.rowsBetween(Window.unboundedPreceding, 0))))
    starts = (flagged.groupBy(*keys, "_chunk").agg(F.max("_start").alias("_last"))
                     .withColumn("_carry_start", F.max("_last").over(before))
                     .drop("_last"))
    tagged = (_join_by(flagged, starts, [*keys, "_chunk"])
                     .withColumn("_sid", F.coalesce("_local_start", "_carry_start")))
    out = tagged.groupBy(*keys, "_sid").agg(
        F.max("_t").alias("_last_t"), *(aggs or [F.count(F.lit(1)).alias("events")]))
    start = F.timestamp_micros(F.col("_sid"))
    end = F.timestamp_micros(F.col("_last_t") + gap_us)
    if ntz:
        start, end = start.cast("timestamp_ntz"), end.cast("timestamp_ntz")
    agg_names = [c for c in out.columns if c not in (*keys, "_sid", "_last_t")]
    return out.select(*keys, start.alias("window_start"), end.alias("window_end"), *agg_names)


def late_split(batch: DataFrame, time_col: str, delay_seconds: int, watermark_us: int | None) -> DataFrame:
    """Tag rows of one micro-batch as late (``_late``) against a watermark:
    event time older than ``watermark_us`` (the max event time of all
    earlier micro-batches minus the delay)."""
    if watermark_us is None:
        return batch.withColumn("_late", F.lit(False))
    return batch.withColumn("_late", F.coalesce(_micros(batch, time_col) < F.lit(watermark_us), F.lit(False)))


def running_max(df: DataFrame, seq_col: str, value_col: str) -> DataFrame:
    """(seq_col, before): for each number the greatest value of smaller numbers,
    NULL if there is none.  ``df`` has one row per number (long, not NULL).

    Numbers are counted from the smallest; those before n are cut into blocks of
    a power of two by n's bits, and the blocks' maxima are looked up: aggregates
    and a join by block, no window over all numbers."""
    low, high = df.agg(F.min(seq_col), F.max(seq_col)).first()
    if low is None:
        return df.select(seq_col, F.col(value_col).alias("before"))
    bits = max(1, int(high - low).bit_length())
    at = F.col(seq_col) - F.lit(low)
    level = F.sequence(F.lit(0), F.lit(bits - 1))
    odd = lambda j: F.expr("shiftright(_at, j)").bitwiseAND(F.lit(1)) == 1
    rows = df.select(seq_col, value_col, at.alias("_at")).withColumn("j", F.explode(level))
    blocks = rows.where(~odd("j")).groupBy("j", F.expr("shiftright(_at, j)").alias("_block")).agg(F.max(value_col).alias("_top"))
    asked = rows.where(odd("j")).select(seq_col, "j", (F.expr("shiftright(_at, j)") - 1).alias("_block"))
    found = asked.join(blocks, ["j", "_block"]).groupBy(seq_col).agg(F.max("_top").alias("before"))
    return df.select(seq_col).join(found, seq_col, "left")


def late_by_sequence(df: DataFrame, time_col: str, seq_col: str, delay_seconds: int, *,
                     max_batches: int = 1_000_000) -> DataFrame:
    """Batch twin of ``streaming.routes.late_router``: ``seq_col`` numbers the
    micro-batch each row arrived in; a row is late (``_late``) when its event
    time is older than the max event time of all earlier micro-batches minus
    the delay.  The running max is taken over a one-row-per-micro-batch
    summary, then joined back on the micro-batch number.  Rows without a
    micro-batch number are left out.
    """
    from streamkit.operators.joins import fits

    t = _micros(df, time_col)
    per_batch = df.where(F.col(seq_col).isNotNull()).groupBy(F.col(seq_col).cast("bigint").alias(seq_col)).agg(F.max(t).alias("_bmax"))
    shared_dir(df.sparkSession)
    marks = running_max(per_batch.checkpoint(eager=True), seq_col, "_bmax") \
        .select(seq_col, (F.col("before") - delay_seconds * MICROS).alias("_wm"))
    # broadcast (checked): joining by shuffle would put a busy micro-batch in one task
    marks = F.broadcast(marks) if fits(marks, max_batches) else marks
    return (df.join(marks, seq_col)
              .withColumn("_late", F.coalesce(t < F.col("_wm"), F.lit(False)))
              .drop("_wm"))
