"""Shared pieces of the registered queries: decoded events, replayed topic
streams, SQL fragments for the generators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from streamkit.functions import decode
from streamkit.operators import tables
from streamkit.plans.topics import (EVENTS_PAYLOAD, EVENTS_TOPIC, STREAM_FILE_BYTES, events_messages, flush_messages,
    input_bytes, replay_layout, table, write_replay)
from streamkit.session import work_path
from streamkit.sources import generators as gen
from streamkit.sources.topic import replay_topic
from streamkit.streaming.run import drain
from streamkit.streaming.sinks import SinkSpec, Trigger, start


EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def decoded_events(env: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Envelope -> typed events (``ts`` back to timestamp_ntz)."""
    return decode.cast_timestamps(decode.json_events(env, EVENTS_PAYLOAD, keep=keep), ["ts"])


EVENTS_SQL = "SELECT event_id, ts, user_id, event_type, value, props FROM events"


def events_stream(spark: SparkSession, sf_dir: str, *, batches: int | None = None, copies: int = 1,
                  flush_types: list[str] | None = None) -> DataFrame:
    """``events`` replayed as a topic folder and read back as a decoded
    stream: one micro-batch, or ``batches`` micro-batches of equal file
    counts, in order of event time.  Files are sized from the table's bytes, not fixed in number."""
    env = events_messages(spark, sf_dir)
    base = env
    for _ in range(copies - 1):
        env = env.unionByName(base)
    if flush_types is not None:
        env = env.unionByName(flush_messages(spark, flush_types))
    files, per_batch = replay_layout(copies * input_bytes(spark, f"{sf_dir.rstrip('/')}/events.parquet"),
                                     batches, STREAM_FILE_BYTES)
    path = write_replay(spark, env, "topic-events", files=files)
    st = replay_topic(spark, path, EVENTS_TOPIC, EVENTS_PAYLOAD, stream=True,
                      max_files_per_trigger=per_batch)
    return decode.cast_timestamps(st, ["ts"])


# input bytes per state partition of a new stateful query: a few hundred thousand events,
# each read and written in the state store by one task
STATE_BYTES = 8 * 1024 * 1024


def state_partitions(spark: SparkSession, sf_dir: str, table_name: str = "events") -> int:
    """State partitions for a new stateful query over ``table_name``: one per
    ``STATE_BYTES`` of input, whatever cores the session has at the moment (the
    count is frozen into the checkpoint at the first start)."""
    size = input_bytes(spark, f"{sf_dir.rstrip('/')}/{table_name}.parquet")
    return max(1, -(-size // STATE_BYTES))


# micro-batches that a stateful query's input is replayed in
STATEFUL_BATCHES = 4


def run_parquet(df: DataFrame, name: str, *, partitions: int | None = None, merge_sessions: bool = False) -> DataFrame:
    """Run a stream to completion into a parquet folder and read it back;
    ``partitions`` sets the state partitions of a stateful query, whose state
    is then kept in RocksDB.  Its rows are not counted: no one reads that figure."""
    spark = df.sparkSession
    out = work_path(spark, name)
    query = drain(start(df, SinkSpec("parquet", path=out, trigger=Trigger.available_now(),
                                     state_partitions=partitions, state_store="rocksdb" if partitions else None,
                                     count_state_rows=False, merge_sessions=merge_sessions)))
    if partitions:
        ran = sum(int(p["numInputRows"]) > 0 for p in query.recentProgress)
        if ran < min(STATEFUL_BATCHES, sum(int(p["numInputRows"]) for p in query.recentProgress)):
            raise RuntimeError(f"{name} ran in {ran} micro-batches of data")
    return spark.read.parquet(out)


CUTOFF = "2024-01-15 00:00:00"


def cutoff() -> F.Column:
    return F.to_timestamp_ntz(F.lit(CUTOFF))


def appended_table(spark: SparkSession, sf_dir: str, name: str, batches: int) -> str:
    """``events`` streamed into a batch-addressable table, one micro-batch per file."""
    path = work_path(spark, name)
    st = events_stream(spark, sf_dir, batches=batches)
    drain(start(st, SinkSpec("table_append", path=path)))
    return path


def hsql(k: int, id_expr: str = "event_id") -> str:
    return gen.hash_sql(id_expr, k)


def sql_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


TS0_SQL = f"TIMESTAMP '{gen.BASE_TIME}'"


CLICK_SQL = f"""
WITH g AS (SELECT event_id, {sql_list(gen.CLICK_EVENT_TYPES)}[{hsql(1)} % 5 + 1] AS event_type FROM events)
SELECT event_id AS id,
       CAST({hsql(0)} % 5 + 1 AS INTEGER) AS user_id,
       strftime({TS0_SQL} + to_seconds((((event_id % {gen.CLICK_PERIOD}) + {gen.CLICK_PERIOD}) % {gen.CLICK_PERIOD}) * {gen.CLICK_STEP_S} + {hsql(7)} % {gen.CLICK_STEP_S}), '%Y-%m-%d %H:%M:%S') AS timestamp,
       event_type,
       CASE WHEN event_type IN ('page_view', 'click') THEN {sql_list(gen.CLICK_PAGES)}[{hsql(2)} % 5 + 1] END AS page,
       CASE WHEN event_type = 'click' THEN 'button' || CAST({hsql(3)} % 50 + 1 AS VARCHAR) END AS element,
       CASE WHEN event_type = 'search' THEN 'example search term' || CAST({hsql(4)} % 10 + 1 AS VARCHAR) END AS query,
       CASE WHEN event_type IN ('add_to_cart', 'purchase')
            THEN {sql_list(gen.CLICK_PRODUCTS)}[{hsql(5)} % 5 + 1] END AS product,
       CASE WHEN event_type IN ('add_to_cart', 'purchase')
            THEN round(10 + ({hsql(6)} % 9001) / 100.0::DOUBLE, 2) END AS price
FROM g
"""


def trip_sql(id_expr: str = "event_id", source: str = "events", overrides: dict | None = None,
              extra: str = "") -> str:
    o = overrides or {}

    def pick(name: str, expr: str) -> str:
        if name not in o:
            return f"{expr} AS {name}"
        v = o[name]
        return f"{v if isinstance(v, int) else repr(v)} AS {name}"
    pickup = f"{TS0_SQL} + to_seconds({hsql(4, id_expr)} % 1801)"
    dropoff = f"{TS0_SQL} + to_seconds({hsql(4, id_expr)} % 1801 + {hsql(5, id_expr)} % 1801)"
    return f"""SELECT {id_expr} AS id, {extra}
       {pick('hvfhs_license_num', f"'HV' || lpad(CAST({hsql(0, id_expr)} % 9 + 1 AS VARCHAR), 5, '0')")},
       {pick('dispatching_base_num', f"{sql_list(gen.TRIP_BASES)}[{hsql(1, id_expr)} % 5 + 1]")},
       {pick('PULocationID', f"CAST({hsql(2, id_expr)} % 265 + 1 AS INTEGER)")},
       {pick('DOLocationID', f"CAST({hsql(3, id_expr)} % 265 + 1 AS INTEGER)")},
       {pick('pickup_datetime', f"strftime({pickup}, '%Y-%m-%d %H:%M:%S')")},
       {pick('dropoff_datetime', f"strftime({dropoff}, '%Y-%m-%d %H:%M:%S')")}
FROM {source}"""


# The two override sets of the trip producer notebook, plus a
# pickup-only override that exposes dropoffs before pickups.
TRIP_OVERRIDES = [
    {"dispatching_base_num": "B03494", "PULocationID": 100, "DOLocationID": 100},
    {"dispatching_base_num": "B03496", "PULocationID": 120, "DOLocationID": 150,
     "pickup_datetime": "2025-01-01 00:15:56", "dropoff_datetime": "2025-01-01 01:00:12"},
]


PICKUP_ONLY = {"pickup_datetime": "2025-01-01 00:20:00"}


def many_sql(sets: list[dict]) -> str:
    return "\nUNION ALL\n".join(trip_sql(overrides=o, extra=f"{v} AS variant,") for v, o in enumerate(sets))


TUMBLING_SQL = """
SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS window_start,
       time_bucket(INTERVAL 15 MINUTE, ts) + INTERVAL 15 MINUTE AS window_end,
       max(value) AS max_value, count(*) AS events
FROM events GROUP BY 1, 2
"""


def typed_batches(spark: SparkSession, sf_dir: str, name: str) -> str:
    """``events`` written as one table batch per event type (types in sorted order)."""
    path = work_path(spark, name)
    ev = table(spark, sf_dir, "events")
    types = [r[0] for r in ev.select("event_type").distinct().collect()]   # a handful of types
    order = F.array(*[F.lit(t) for t in sorted(t for t in types if t is not None)])
    tables.write_batches(ev.withColumn("_batch", F.array_position(order, F.col("event_type")) - 1),
                         path, "loader", "_batch")
    return path
