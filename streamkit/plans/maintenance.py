"""Registered queries: insert-only merge, schema evolution on write, delete,
compaction, expiry, replay and history, and the consumer notebook end to end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from streamkit.functions import decode
from streamkit.functions.encode import messages
from streamkit.operators import tables
from streamkit.operators.files import list_tree
from streamkit.plans.common import (CUTOFF, EVENT_COLS, EVENTS_SQL, TRIP_OVERRIDES, appended_table,
    cutoff, events_stream, many_sql, run_parquet, trip_sql, typed_batches)
from streamkit.plans.registry import query
from streamkit.plans.topics import table, write_replay
from streamkit.session import FS, work_path
from streamkit.sources import generators as gen
from streamkit.sources.topic import replay_topic
from streamkit.streaming.run import drain
from streamkit.streaming.sinks import SinkSpec, start


@query("merge_insert_events", f"""
SELECT event_id, ts, user_id, event_type,
       CASE WHEN ts < TIMESTAMP '{CUTOFF}' THEN -value ELSE value END AS value, props
FROM events
""")
def merge_insert_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table already holds the first half of the month (with a
    marker: negated value); the whole topic is merged in 10 micro-batches on
    ``event_id``.  Matched rows stay untouched, the rest are inserted."""
    path = work_path(spark, "merge-target")
    old = table(spark, sf_dir, "events").where(F.col("ts") < cutoff()).withColumn("value", -F.col("value"))
    tables.bootstrap(spark, path, old, EVENT_COLS)
    st = events_stream(spark, sf_dir, batches=10)
    drain(start(st, SinkSpec("table_merge", path=path, keys=["event_id"])))
    return tables.read(spark, path).select(*EVENT_COLS)


@query("merge_insert_by_day", f"""
SELECT event_id, ts, user_id, event_type,
       CASE WHEN ts < TIMESTAMP '{CUTOFF}' THEN -value ELSE value END AS value, props,
       CAST(ts AS DATE) AS event_date
FROM events
""")
def merge_insert_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 on a target partitioned by event date below each batch: every
    micro-batch reads only the target folders of the days it carries (the
    event date is a function of the event, so a key never changes day)."""
    path = work_path(spark, "merge-by-day")
    ev = table(spark, sf_dir, "events").withColumn("event_date", F.to_date("ts"))
    old = ev.where(F.col("ts") < cutoff()).withColumn("value", -F.col("value"))
    tables.bootstrap(spark, path, old, EVENT_COLS + ["event_date"], partition_by=["event_date"])
    st = events_stream(spark, sf_dir, batches=10).withColumn("event_date", F.to_date("ts"))
    drain(start(st, SinkSpec("table_merge", path=path, keys=["event_id"], partition_follows_key=True)))
    return tables.read(spark, path).select(*EVENT_COLS, "event_date")


@query("merge_key_changes_day", f"""
SELECT event_id, ts, CAST(CASE WHEN ts < TIMESTAMP '{CUTOFF}' THEN ts ELSE ts + INTERVAL 1 DAY END AS DATE) AS event_date
FROM events
""")
def merge_key_changes_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 on a partitioned target whose keys reappear under another day: every
    event comes again a day later, and the keys in the table stay as they are."""
    path = work_path(spark, "merge-days")
    ev = table(spark, sf_dir, "events").select("event_id", "ts")
    old = ev.where(F.col("ts") < cutoff()).withColumn("event_date", F.to_date("ts"))
    tables.bootstrap(spark, path, old, ["event_id", "ts", "event_date"], partition_by=["event_date"])
    tables.merge_insert(ev.withColumn("event_date", F.date_add(F.to_date("ts"), 1)), path, ["event_id"],
                        stream_id="later", batch_id=0)
    return tables.read(spark, path).select("event_id", "ts", "event_date")


@query("merge_dedupe_keys", """
WITH t AS (SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-03 00:00:00'),
s AS (SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY user_id, event_type)
SELECT event_id, ts, user_id, event_type, value, props FROM t
UNION ALL
SELECT e.event_id, e.ts, e.user_id, e.event_type, e.value, e.props
FROM s JOIN events e ON e.event_id = s.event_id
WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.user_id = s.user_id AND t.event_type = s.event_type)
""")
def merge_dedupe_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 + M2 with ``dedupe_source``: composite key (user_id, event_type); the
    source (every event, delivered twice) keeps one row per key -- the one
    with the smallest event id -- and only keys new to the table go in."""
    path = work_path(spark, "merge-dedupe")
    ev = table(spark, sf_dir, "events")
    tables.bootstrap(spark, path, ev.where(F.col("ts") < F.to_timestamp_ntz(F.lit("2024-01-03 00:00:00"))),
                     EVENT_COLS)
    tables.merge_insert(ev.unionByName(ev).select(*EVENT_COLS), path, ["user_id", "event_type"],
                        stream_id="backfill", batch_id=0, dedupe_source=True)
    return tables.read(spark, path).select(*EVENT_COLS)


@query("merge_evolve", f"""
SELECT event_id, ts, user_id, event_type, value,
       CASE WHEN ts < TIMESTAMP '{CUTOFF}' THEN NULL ELSE props END AS props
FROM events
""")
def merge_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table predates the ``props`` field; merging the stream with
    ``evolve`` widens the recorded table schema, and older batches read the
    new column as NULL."""
    path = work_path(spark, "merge-evolve")
    old = table(spark, sf_dir, "events").where(F.col("ts") < cutoff()).drop("props")
    tables.bootstrap(spark, path, old)
    st = events_stream(spark, sf_dir, batches=4)
    drain(start(st, SinkSpec("table_merge", path=path, keys=["event_id"], evolve=True)))
    return tables.read(spark, path).select(*EVENT_COLS)


@query("delete_where", """
SELECT event_id, ts, user_id, event_type, value, props FROM events
WHERE NOT coalesce(event_type IN ('error', 'signup'), false)
""")
def delete_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7: predicate delete that rewrites only the batches holding matches."""
    path = appended_table(spark, sf_dir, "delete", batches=4)
    tables.delete_where(spark, path, "event_type IN ('error', 'signup')")
    return tables.read(spark, path).select(*EVENT_COLS)


@query("compact", f"SELECT *, true AS files_are_small FROM ({EVENTS_SQL})")
def compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M9: files are rewritten to at most 100 rows each (they had all rows of a
    micro-batch); the row set is unchanged."""
    path = appended_table(spark, sf_dir, "compact", batches=8)
    tables.compact(spark, path, rows_per_file=100)
    t = tables.read(spark, path)
    largest = t.groupBy(F.col("_metadata.file_path").alias("f")).count().agg(F.max("count")).first()[0]
    return t.select(*EVENT_COLS, F.lit(largest <= 100).alias("files_are_small"))


@query("fold_batches", """
WITH e AS (SELECT *, datediff('day', TIMESTAMP '2024-01-01', ts) AS day FROM events)
SELECT event_id, ts, user_id, event_type, value, props, CAST(CASE WHEN day <= 19 THEN -20 ELSE day END AS BIGINT) AS batch_id,
       (SELECT count(DISTINCT day) FROM e WHERE day <= 19) AS files_before,
       (SELECT CAST(ceil(count(*) / 200.0) AS BIGINT) FROM e WHERE day <= 19) AS files_after
FROM e
""")
def fold_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M9 across micro-batches: a batch a day, folded through day 19 into files of
    200 rows.  A folded day that comes again, appended and merged, adds nothing;
    the folded files are vacuumed."""
    path = work_path(spark, "fold")
    ev = table(spark, sf_dir, "events").withColumn("day", F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")))
    tables.write_batches(ev.repartition("day"), path, "loader", "day")
    done = tables.fold(spark, path, "loader", upto=19, rows_per_file=200)
    again = ev.where("day = 3").drop("day")
    tables.write_batch(again, path, "loader", 3)
    tables.merge_insert(again.withColumn("event_id", -1 - F.col("event_id")), path, ["event_id"], stream_id="loader", batch_id=3)
    tables.write_batches(ev.where("day = 3"), path, "loader", "day")
    tables.vacuum(spark, path, retention_hours=0)
    return tables.read(spark, path).select(*EVENT_COLS, tables.BATCH_COL, F.lit(done.files_before).cast("bigint").alias("files_before"),
                                           F.lit(done.files_after).cast("bigint").alias("files_after"))


@query("vacuum_folded", """
SELECT count(*) FILTER (WHERE day <= 19) AS folded_rows, count(DISTINCT day) FILTER (WHERE day <= 19) AS removed_folders,
       count(DISTINCT day) FILTER (WHERE day > 19) + 1 AS kept_folders
FROM (SELECT datediff('day', TIMESTAMP '2024-01-01', ts) AS day FROM events)
""")
def vacuum_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6: what a fold left behind is found by listing and anti-join and removed
    in tasks; the batches that count stay."""
    path = work_path(spark, "vacuum")
    ev = table(spark, sf_dir, "events").withColumn("day", F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")))
    tables.write_batches(ev.repartition("day"), path, "loader", "day")
    tables.fold(spark, path, "loader", upto=19, rows_per_file=200)
    removed = tables.vacuum(spark, path, retention_hours=0).where(F.col("path").rlike(r"/batch_id=\d+$")).count()
    left = list_tree(spark, path).where(F.col("is_dir") & F.col("relative").rlike(r"/batch_id=-?\d+$")).count()
    folded = tables.read(spark, path).where(F.col(tables.BATCH_COL) == tables.folded_id(19))
    return folded.agg(F.count(F.lit(1)).alias("folded_rows"), F.lit(removed).cast("bigint").alias("removed_folders"), F.lit(left).cast("bigint").alias("kept_folders"))


@query("expire", f"SELECT *, 2 AS removed FROM ({EVENTS_SQL})")
def expire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6: expiry with zero retention removes what no committed batch references
    (staging left by a failed job, an empty batch folder), and only that."""
    path = appended_table(spark, sf_dir, "expire", batches=4)
    tables.compact(spark, path, rows_per_file=5000)
    fs = FS(spark, path)
    fs.write_text(f"{path}/_temporary/0/part-0.parquet", "left over")
    fs.mkdirs(f"{path}/{tables.STREAM_COL}=gone/{tables.BATCH_COL}=7")
    removed = [r for r in tables.expire(spark, path, retention_hours=0) if not r.endswith(f"{tables.STREAM_COL}=gone")]
    gone = sum(not fs.exists(r) for r in removed)
    return tables.read(spark, path).select(*EVENT_COLS, F.lit(gone).alias("removed"))


# The 11 columns of the trip table at rest, and the payload
# schema of a trip message.
TRIP_TABLE_COLS = ["hvfhs_license_num", "dispatching_base_num", "originating_base_num", "request_datetime",
                   "on_scene_datetime", "pickup_datetime", "dropoff_datetime", "PULocationID", "DOLocationID",
                   "trip_miles", "trip_time"]


TRIP_PAYLOAD = ("hvfhs_license_num STRING, dispatching_base_num STRING, PULocationID INT, DOLocationID INT, "
                "pickup_datetime STRING, dropoff_datetime STRING")


CHECK_BASES = ("B03494", "B03496")
TRIPS_TOPIC = "trips"


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw trip file: one generated trip per ``events`` row plus the five
    columns only the table at rest has."""
    t = decode.cast_timestamps(gen.trips(spark, table(spark, sf_dir, "events"), id_col="event_id"),
                               ["pickup_datetime", "dropoff_datetime"])
    h = gen.field_hash(F.col("id"), 6)
    return t.select(
        "*", F.col("dispatching_base_num").alias("originating_base_num"),
        (F.col("pickup_datetime") - F.expr("INTERVAL 5 MINUTES")).alias("request_datetime"),
        (F.col("pickup_datetime") - F.expr("INTERVAL 2 MINUTES")).alias("on_scene_datetime"),
        F.round((h % 2000) / 100.0, 2).alias("trip_miles"),
        (F.unix_micros(F.col("dropoff_datetime").cast("timestamp"))
         - F.unix_micros(F.col("pickup_datetime").cast("timestamp"))).cast("bigint").__truediv__(1_000_000)
        .cast("bigint").alias("trip_time"))


@query("trip_merge_counts", f"""
WITH raw AS ({trip_sql()}),
s AS ({many_sql(TRIP_OVERRIDES)})
SELECT (SELECT count(*) FROM raw WHERE dispatching_base_num IN {CHECK_BASES}) AS before_cnt,
       (SELECT count(*) FROM raw WHERE dispatching_base_num IN {CHECK_BASES})
       + (SELECT count(*) FROM s WHERE NOT EXISTS (
            SELECT 1 FROM raw r WHERE r.hvfhs_license_num = s.hvfhs_license_num
                                  AND r.pickup_datetime = s.pickup_datetime)) AS after_cnt,
       (SELECT count(*) FROM raw) AS table_rows_before
""")
def trip_merge_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The consumer notebook end to end: bootstrap the trip table from a raw
    file (11 columns) if absent, register a view, count the two bases, stream
    the producer's override sets through the topic, decode, cast timestamps,
    merge insert-only on the configured keys (missing columns NULL-filled),
    count again."""
    raw_path = work_path(spark, "raw-trips")
    raw_trips(spark, sf_dir).write.parquet(raw_path)
    path = work_path(spark, "trip-table")
    raw = spark.read.parquet(raw_path)
    tables.bootstrap(spark, path, raw, TRIP_TABLE_COLS, view="trip_table")
    count_sql = f"SELECT count(*) AS cnt FROM trip_table WHERE dispatching_base_num IN {CHECK_BASES}"
    before = spark.sql(count_sql).first()["cnt"]
    rows_before = spark.sql("SELECT count(*) AS n FROM trip_table").first()["n"]
    produced = gen.trips_many(spark, table(spark, sf_dir, "events"), TRIP_OVERRIDES, id_col="event_id")
    msgs = messages(produced, TRIPS_TOPIC, partition=F.col("variant"),
                    payload_cols=["hvfhs_license_num", "dispatching_base_num", "PULocationID", "DOLocationID",
                                  "pickup_datetime", "dropoff_datetime"])
    topic = write_replay(spark, msgs, "topic-trips")
    st = replay_topic(spark, topic, TRIPS_TOPIC, TRIP_PAYLOAD, stream=True)
    st = decode.cast_timestamps(st, ["pickup_datetime", "dropoff_datetime"])
    keys = tables.keys_from_text("hvfhs_license_num,pickup_datetime")
    drain(start(st, SinkSpec("table_merge", path=path, keys=keys)))
    tables.register(spark, path, "trip_table")
    after = spark.sql(count_sql).first()["cnt"]
    return spark.createDataFrame([(before, after, rows_before)],
                                 "before_cnt bigint, after_cnt bigint, table_rows_before bigint")


@query("replay_from_batch", """
SELECT event_id, ts, user_id, event_type, value, props FROM events
WHERE event_type IN ('purchase', 'signup', 'view')
""")
def replay_from_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table read back as a stream from batch 2 on."""
    path = typed_batches(spark, sf_dir, "replay")
    st = tables.replay(spark, path, from_batch=2, stream=True, max_files_per_trigger=2)
    return run_parquet(st.select(*EVENT_COLS), "replayed")


@query("table_as_of", """
SELECT event_id, ts, user_id, event_type, value, props FROM events
WHERE event_type IN ('click', 'error', 'purchase')
""")
def table_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch-addressable history: the table as it stood after batch 2."""
    path = typed_batches(spark, sf_dir, "as-of")
    return tables.as_of(spark, path, 2, stream_id="loader").select(*EVENT_COLS)


@query("table_history", """
SELECT 'loader' AS stream_id,
       CAST(CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2
                            WHEN 'signup' THEN 3 WHEN 'view' THEN 4 END AS BIGINT) AS batch_id,
       count(*) AS "rows"
FROM events GROUP BY event_type
""")
def table_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch-addressable history: one row per committed batch with its row count."""
    return tables.history(spark, typed_batches(spark, sf_dir, "history"))
