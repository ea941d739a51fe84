"""Registered queries: event-time windows (tumbling, sliding, session),
watermarks, late rows, de-duplication, streaming aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from streamkit.operators import tables
from streamkit.operators.dedupe import dedupe
from streamkit.operators.windows import late_by_sequence, session_agg, sessions, window_agg
from streamkit.plans.common import (EVENT_COLS, EVENTS_SQL, TUMBLING_SQL, decoded_events, events_stream,
    run_parquet, state_partitions, STATEFUL_BATCHES)
from streamkit.plans.registry import query
from streamkit.plans.topics import FLUSH_TS, FLUSH_USER, events_messages, flush_messages, table, write_arrivals
from streamkit.session import work_path
from streamkit.sources.topic import ENVELOPE_SCHEMA
from streamkit.streaming.routes import late_router
from streamkit.streaming.run import drain, progress
from streamkit.streaming.sinks import SinkSpec, start


@query("tumbling_15m", TUMBLING_SQL)
def tumbling_15m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Max value and count per 15-minute tumbling window (batch)."""
    ev = table(spark, sf_dir, "events")
    return window_agg(ev, "ts", "15 minutes", [F.max("value").alias("max_value"),
                                               F.count(F.lit(1)).alias("events")])


@query("tumbling_15m_stream", TUMBLING_SQL)
def tumbling_15m_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """15-minute windows, 2-minute watermark, append mode to parquet."""
    st = events_stream(spark, sf_dir, batches=STATEFUL_BATCHES, flush_types=[None])
    agg = window_agg(st, "ts", "15 minutes", [F.max("value").alias("max_value"),
                                              F.count(F.lit(1)).alias("events")], delay="2 minutes")
    out = run_parquet(agg, "tumbling", partitions=state_partitions(spark, sf_dir))
    return out.where(F.col("window_start") < F.to_timestamp_ntz(F.lit(FLUSH_TS)))


SLIDING_SQL = """
SELECT ws AS window_start, ws + INTERVAL 15 MINUTE AS window_end, max(value) AS max_value, count(*) AS events
FROM (SELECT value, unnest(generate_series(time_bucket(INTERVAL 5 MINUTE, ts) - INTERVAL 10 MINUTE,
                                          time_bucket(INTERVAL 5 MINUTE, ts), INTERVAL 5 MINUTE)) AS ws
      FROM events)
GROUP BY 1, 2
"""


@query("sliding_window", SLIDING_SQL)
def sliding_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """15-minute windows sliding every 5 minutes."""
    ev = table(spark, sf_dir, "events")
    return window_agg(ev, "ts", "15 minutes", [F.max("value").alias("max_value"),
                                               F.count(F.lit(1)).alias("events")], slide="5 minutes")


@query("sliding_window_stream", SLIDING_SQL)
def sliding_window_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W5 streaming: 15-minute windows sliding every 5 minutes, 2-minute
    watermark, append mode (an end-of-input marker closes the last windows)."""
    st = events_stream(spark, sf_dir, batches=STATEFUL_BATCHES, flush_types=[None])
    agg = window_agg(st, "ts", "15 minutes", [F.max("value").alias("max_value"),
                                              F.count(F.lit(1)).alias("events")],
                     slide="5 minutes", delay="2 minutes")
    out = run_parquet(agg, "sliding", partitions=state_partitions(spark, sf_dir))
    return out.where(F.col("window_end") <= F.to_timestamp_ntz(F.lit(FLUSH_TS)))


@query("tumbling_by_type", """
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
       time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
       event_type, count(*) AS events, max(value) AS max_value, count(DISTINCT user_id) AS users
FROM events GROUP BY 1, 2, event_type
""")
def tumbling_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5 with a grouping key: hourly windows per event type, with distinct users."""
    ev = table(spark, sf_dir, "events")
    return window_agg(ev, "ts", "1 hour", [F.count(F.lit(1)).alias("events"), F.max("value").alias("max_value"),
                                           F.countDistinct("user_id").alias("users")], keys=["event_type"])


SESSION_SQL = """
WITH g AS (
  SELECT user_id, ts, value,
         CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL
                OR ts > lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 30 MINUTE
              THEN 1 ELSE 0 END AS new_session
  FROM events),
s AS (SELECT *, sum(new_session) OVER (PARTITION BY user_id ORDER BY ts
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM g)
SELECT user_id, min(ts) AS window_start, max(ts) + INTERVAL 30 MINUTE AS window_end,
       count(*) AS events, max(value) AS max_value
FROM s GROUP BY user_id, sid
"""


@query("session_window", SESSION_SQL)
def session_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """30-minute-gap sessions per user, split by time so a busy user stays parallel."""
    ev = table(spark, sf_dir, "events")
    return sessions(ev, "ts", 30 * 60, keys=["user_id"],
                    aggs=[F.count(F.lit(1)).alias("events"), F.max("value").alias("max_value")])


@query("session_window_stream", SESSION_SQL)
def session_window_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W5 streaming: ``session_window`` per user with a 2-minute watermark."""
    st = events_stream(spark, sf_dir, batches=STATEFUL_BATCHES, flush_types=[None])
    agg = session_agg(st, "ts", "30 minutes", [F.count(F.lit(1)).alias("events"),
                                               F.max("value").alias("max_value")],
                      keys=["user_id"], delay="2 minutes")
    out = run_parquet(agg, "sessions", partitions=state_partitions(spark, sf_dir), merge_sessions=True)
    return out.where(F.col("user_id") != FLUSH_USER).select("user_id", "window_start", "window_end",
                                                          "events", "max_value")


@query("dedupe_events", EVENTS_SQL)
def dedupe_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event delivered twice; streaming de-duplication within a 10-minute watermark."""
    st = events_stream(spark, sf_dir, batches=STATEFUL_BATCHES, copies=2)
    return run_parquet(dedupe(st, ["event_id"], time_col="ts", delay="10 minutes"), "dedupe",
                       partitions=state_partitions(spark, sf_dir)) \
        .select(*EVENT_COLS)


@query("dedupe_events_batch", EVENTS_SQL)
def dedupe_events_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W6 batch twin over the doubled table."""
    ev = table(spark, sf_dir, "events")
    return dedupe(ev.unionByName(ev), ["event_id"]).select(*EVENT_COLS)


GROUP_SQL = """
SELECT event_type, count(*) AS events,
       CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS total_value, max(ts) AS last_ts
FROM events GROUP BY event_type
"""


def _group_aggs():
    return [F.count(F.lit(1)).alias("events"),
            F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total_value"),
            F.max("ts").alias("last_ts")]


@query("stream_group_agg", GROUP_SQL)
def stream_group_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: running aggregate per event type in update mode; every micro-batch's
    updated rows are appended as a table batch, the latest per key is the answer."""
    st = events_stream(spark, sf_dir, batches=4)
    agg = st.groupBy("event_type").agg(*_group_aggs())
    path = work_path(spark, "group-agg")
    drain(start(agg, SinkSpec("table_append", path=path, mode="update", state_store="rocksdb", commit_col="committed_at",
                              state_partitions=state_partitions(spark, sf_dir))))
    return tables.latest_by_key(tables.read(spark, path), ["event_type"], ["committed_at", tables.BATCH_COL]) \
        .select("event_type", "events", "total_value", "last_ts")


@query("stream_group_agg_complete", GROUP_SQL)
def stream_group_agg_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4 in complete mode: every micro-batch writes the whole result as a
    table batch; the last batch is the answer."""
    st = events_stream(spark, sf_dir, batches=4)
    agg = st.groupBy("event_type").agg(*_group_aggs())
    path = work_path(spark, "group-agg-complete")
    drain(start(agg, SinkSpec("table_append", path=path, mode="complete", state_store="rocksdb",
                              state_partitions=state_partitions(spark, sf_dir))))
    t = tables.read(spark, path)
    last = t.agg(F.max(tables.BATCH_COL)).first()[0]
    return tables.as_of(spark, path, last).where(F.col(tables.BATCH_COL) == last) \
        .select("event_type", "events", "total_value", "last_ts")


@query("late_rows", """
WITH a AS (
  SELECT event_id, epoch_us(ts) AS t,
         (epoch_us(ts) + CASE WHEN user_id % 4 = 3 THEN 10800000000 ELSE 0 END) // 3600000000 AS micro_batch
  FROM events),
b AS (SELECT micro_batch, max(t) AS bmax FROM a GROUP BY micro_batch),
c AS (SELECT micro_batch, max(bmax) OVER (ORDER BY micro_batch
                                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM b)
SELECT a.event_id, a.micro_batch, coalesce(a.t < c.prev - 120000000, false) AS is_late
FROM a JOIN c ON a.micro_batch = c.micro_batch
""")
def late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partition 3 of the topic arrives 3 hours behind; hourly micro-batches by
    arrival; rows older than the watermark (2 minutes) are routed aside."""
    env = events_messages(spark, sf_dir)
    lag = F.when(F.col("partition") == 3, F.expr("INTERVAL 3 HOURS")).otherwise(F.expr("INTERVAL 0 SECONDS"))
    env = env.withColumn("timestamp", F.col("timestamp") + lag)
    ev = decoded_events(env, keep=("timestamp",)).withColumn(
        "micro_batch", F.expr("unix_micros(timestamp) div 3600000000"))
    tagged = late_by_sequence(ev, "ts", "micro_batch", delay_seconds=120)
    return tagged.select("event_id", "micro_batch", F.col("_late").alias("is_late"))


# Arrival groups of the streamed late-row query.
ARRIVAL_GROUP_US = 3 * 86400 * 1_000_000    # one micro-batch per 3 days of arrival
LAGGING_PARTITION_US = 3 * 86400 * 1_000_000  # topic partition 3 arrives one group late


@query("late_rows_stream", f"""
WITH a AS (
  SELECT event_id, epoch_us(ts) AS t,
         (epoch_us(ts) + CASE WHEN user_id % 4 = 3 THEN {LAGGING_PARTITION_US} ELSE 0 END)
           // {ARRIVAL_GROUP_US} AS arrival_group
  FROM events),
b AS (SELECT arrival_group, max(t) AS bmax FROM a GROUP BY arrival_group),
c AS (SELECT arrival_group, max(bmax) OVER (ORDER BY arrival_group
                                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM b)
SELECT a.event_id, coalesce(a.t < c.prev - 120000000, false) AS is_late
FROM a JOIN c ON a.arrival_group = c.arrival_group
""")
def late_rows_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W4 as a stream: the topic is replayed in arrival order, one micro-batch
    per 3-day arrival group, partition 3 one group behind the others.  The
    late-row router sends rows older than the watermark (2 minutes behind
    the max event time of earlier micro-batches) to a side table."""
    main, late, state = (work_path(spark, n) for n in ("late-main", "late-side", "late-state"))
    drain(start(decoded_events(arrivals_stream(spark, events_messages(spark, sf_dir))),
                SinkSpec("foreach_batch", fn=late_router(main, late, state, time_col="ts", delay_seconds=120))))
    on_time = tables.read(spark, main).select("event_id", F.lit(False).alias("is_late"))
    aside = tables.read(spark, late).select("event_id", F.lit(True).alias("is_late"))
    return on_time.unionByName(aside)


def arrivals_stream(spark: SparkSession, env: DataFrame) -> DataFrame:
    """The topic as a stream in which partition 3 lags: each 3-day arrival group
    is one file, and one micro-batch."""
    lag = F.when(F.col("partition") == 3, F.lit(LAGGING_PARTITION_US)).otherwise(F.lit(0))
    staged = env.withColumn("_lag", lag).withColumn(
        "arrival_group", F.expr(f"(unix_micros(timestamp) + _lag) div {ARRIVAL_GROUP_US}")).drop("_lag")
    path = write_arrivals(spark, staged, "arrivals", "arrival_group")
    schema = T.StructType(ENVELOPE_SCHEMA.fields + [T.StructField("arrival_group", T.LongType())])
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


# A row is dropped if its window had ended at the watermark in force one micro-batch
# before: Spark judges late rows by the watermark that the previous batch evicted by.
DROPS_CTE = f"""
a AS (SELECT event_id, ts, value, epoch_ms(ts) AS t, time_bucket(INTERVAL 15 MINUTE, ts) AS ws,
             (epoch_us(ts) + CASE WHEN user_id % 4 = 3 THEN {LAGGING_PARTITION_US} ELSE 0 END) // {ARRIVAL_GROUP_US} AS g FROM events),
b AS (SELECT g, max(t) AS m FROM a GROUP BY g),
c AS (SELECT g, max(m) OVER (ORDER BY g ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) - 120000 AS wm FROM b),
d AS (SELECT a.*, coalesce(epoch_ms(ws + INTERVAL 15 MINUTE) <= wm, false) AS dropped FROM a JOIN c ON c.g = a.g)
"""


@query("watermark_drops_stream", f"""
WITH {DROPS_CTE}
SELECT ws AS window_start, ws + INTERVAL 15 MINUTE AS window_end, max(value) AS max_value, count(*) AS events
FROM d WHERE NOT dropped GROUP BY ws
""")
def watermark_drops_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """15-minute windows over a topic that arrives out of order; the
    watermark (2 minutes) moves with every micro-batch, and rows of windows that
    it has closed are dropped from the result."""
    return _windows_with_drops(spark, sf_dir, "drops")[0]


@query("watermark_drop_counts", f"""
WITH {DROPS_CTE}
SELECT count(*) AS arrived, count(*) FILTER (WHERE dropped) AS dropped FROM d
""")
def watermark_drop_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows the watermark dropped, from the stream's own result:
    rows that arrived (its progress) less rows in the windows it gave out."""
    windows, seen = _windows_with_drops(spark, sf_dir, "drop-counts")
    arrived = seen.agg(F.sum("input_rows")).first()[0] - 1   # less the end-of-input marker
    return windows.agg((F.lit(arrived) - F.coalesce(F.sum("events"), F.lit(0))).alias("dropped")) \
        .select(F.lit(arrived).cast("bigint").alias("arrived"), F.col("dropped").cast("bigint").alias("dropped"))


def _windows_with_drops(spark: SparkSession, sf_dir: str, name: str) -> tuple[DataFrame, DataFrame]:
    """(windows, progress) of the out-of-order topic."""
    env = events_messages(spark, sf_dir).unionByName(flush_messages(spark))
    agg = window_agg(decoded_events(arrivals_stream(spark, env)), "ts", "15 minutes",
                     [F.max("value").alias("max_value"), F.count(F.lit(1)).alias("events")], delay="2 minutes")
    out = work_path(spark, name)
    q = drain(start(agg, SinkSpec("parquet", path=out, state_store="rocksdb", state_partitions=state_partitions(spark, sf_dir))))
    return spark.read.parquet(out).where(F.col("window_end") <= F.to_timestamp_ntz(F.lit(FLUSH_TS))), progress(spark, q)


@query("decoded_tumbling", TUMBLING_SQL)
def decoded_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ingest chain in one plan: rows -> JSON messages -> decode -> typed
    event time -> 15-minute windows."""
    ev = decoded_events(events_messages(spark, sf_dir))
    return window_agg(ev, "ts", "15 minutes", [F.max("value").alias("max_value"),
                                               F.count(F.lit(1)).alias("events")])
