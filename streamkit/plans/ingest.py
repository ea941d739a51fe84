"""Registered queries: decoding, topic offsets, JSON fields, bad messages,
schema alignment and evolution, file streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from streamkit.functions import decode, schema
from streamkit.operators import tables
from streamkit.plans.common import EVENT_COLS, EVENTS_SQL, decoded_events, events_stream, run_parquet
from streamkit.plans.registry import query
from streamkit.plans.topics import (EVENTS_PAYLOAD, EVENTS_TOPIC, events_envelope, events_messages,
    table, write_replay)
from streamkit.session import work_path
from streamkit.sources.files import stream_files
from streamkit.sources.topic import offset_filter, replay_topic
from streamkit.streaming.routes import quarantine_router
from streamkit.streaming.run import drain
from streamkit.streaming.sinks import SinkSpec, start


@query("decode_events", """
SELECT event_id, ts, user_id, event_type, value, props FROM events
""")
def decode_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P12 encode -> P1 bytes to text -> P2 from_json -> P3 flatten -> P5 timestamps."""
    env = events_messages(spark, sf_dir).where(F.col("topic") == EVENTS_TOPIC)
    return decoded_events(env).select(*EVENT_COLS)


@query("count_where_in", """
SELECT count(*) AS cnt FROM events WHERE event_type IN ('click', 'purchase')
""")
def count_where_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filtered COUNT over a registered view, in SQL as the notebook does."""
    table(spark, sf_dir, "events").createOrReplaceTempView("sk_events")
    return spark.sql("SELECT count(*) AS cnt FROM sk_events WHERE event_type IN ('click', 'purchase')")


# Starting positions per partition for the offsets query.
OFFSETS_SPEC = '{"events": {"0": 100, "1": -2, "2": 250, "3": -1}}'


@query("offsets_from", """
WITH env AS (
  SELECT event_id, CAST(user_id % 4 AS INTEGER) AS partition,
         row_number() OVER (PARTITION BY user_id % 4 ORDER BY ts, event_id) - 1 AS "offset"
  FROM events)
SELECT partition, "offset", event_id FROM env
WHERE (partition = 0 AND "offset" >= 100) OR partition = 1 OR (partition = 2 AND "offset" >= 250)
""")
def offsets_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start positions per partition (-2 earliest, -1 latest) on the topic."""
    env = offset_filter(events_envelope(spark, sf_dir), OFFSETS_SPEC, topic=EVENTS_TOPIC)
    return decoded_events(env, keep=("partition", "offset")).select("partition", "offset", "event_id")


@query("json_props", """
SELECT event_id, CAST(props->>'$.k' AS INTEGER) AS k FROM events
""")
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2 on a text column: typed field out of a JSON string."""
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", decode.parse_json("props", "k INT").getField("k").alias("k"))


@query("stream_parquet_copy", EVENTS_SQL)
def stream_parquet_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 (replay) -> decode -> K3 parquet sink, K10 availableNow, K16 checkpoint."""
    return run_parquet(events_stream(spark, sf_dir, batches=4), "copy").select(*EVENT_COLS)


@query("align_columns", """
SELECT event_id, ts, user_id, event_type, value, props,
       CAST(NULL AS VARCHAR) AS region, CAST(NULL AS DOUBLE) AS score, CAST(NULL AS TIMESTAMP) AS seen_at
FROM events
""")
def align_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded messages shaped to a wider table schema; the missing
    columns arrive as NULLs of the table's types (never ``void``)."""
    decoded = decoded_events(events_messages(spark, sf_dir))
    target = T.StructType(decoded.schema.fields + [
        T.StructField("region", T.StringType()), T.StructField("score", T.DoubleType()),
        T.StructField("seen_at", T.TimestampNTZType())])
    return schema.align(decoded, target)


@query("evolve_json", """
SELECT event_id, user_id, event_type, props AS rest_props, value AS rest_value FROM events
""")
def evolve_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads carry fields the reader's schema does not know yet; they
    are kept in a ``map<string,string>`` rest column instead of being lost."""
    env = events_messages(spark, sf_dir).select(F.col("value").cast("string").alias("json"))
    known = "event_id BIGINT, ts STRING, user_id BIGINT, event_type STRING"
    parsed = schema.evolve_json(env, "json", known)
    return parsed.select("event_id", "user_id", "event_type",
                         F.col("_rest")["props"].alias("rest_props"),
                         F.col("_rest")["value"].cast("double").alias("rest_value"))


SPLIT_SQL = """
SELECT CAST(event_id AS VARCHAR) AS key, false AS is_bad, event_id, event_type, CAST(NULL AS VARCHAR) AS payload
FROM events
UNION ALL
SELECT 'doc:' || CAST(doc_id AS VARCHAR), true, CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), text
FROM documents
"""


def mixed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One topic carrying event messages and raw document texts."""
    env = events_messages(spark, sf_dir)
    docs = table(spark, sf_dir, "documents")
    doc_msgs = docs.select(F.concat(F.lit("doc:"), F.col("doc_id").cast("string")).cast("binary").alias("key"),
                           F.col("text").cast("binary").alias("value"), F.lit(EVENTS_TOPIC).alias("topic"),
                           F.lit(0).alias("partition"), F.lit(None).cast("bigint").alias("offset"),
                           F.current_timestamp().alias("timestamp"), F.lit(0).alias("timestampType"))
    return env.unionByName(doc_msgs)


@query("split_bad", SPLIT_SQL)
def split_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that are not JSON objects are set aside with their full payload."""
    tagged = decode.with_corrupt(mixed_messages(spark, sf_dir), EVENTS_PAYLOAD, keep=("key",))
    return tagged.select(F.col("key").cast("string").alias("key"), F.col("_is_bad").alias("is_bad"),
                         "event_id", "event_type", F.col(decode.CORRUPT_COL).alias("payload"))


@query("split_bad_stream", SPLIT_SQL)
def split_bad_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P19 on a stream: each micro-batch is decoded once and routed -- good
    rows to one table, undecodable messages to a quarantine table."""
    topic = write_replay(spark, mixed_messages(spark, sf_dir), "topic-mixed")
    st = replay_topic(spark, topic, EVENTS_TOPIC, stream=True)
    good, bad = work_path(spark, "good"), work_path(spark, "quarantine")
    drain(start(st, SinkSpec("foreach_batch", fn=quarantine_router(good, bad, EVENTS_PAYLOAD, keep=("key",)))))
    ok = tables.read(spark, good).select(F.col("key").cast("string").alias("key"), F.lit(False).alias("is_bad"),
                                         "event_id", "event_type", F.lit(None).cast("string").alias("payload"))
    aside = tables.read(spark, bad).select(F.col("key").cast("string").alias("key"), F.lit(True).alias("is_bad"),
                                           F.lit(None).cast("bigint").alias("event_id"),
                                           F.lit(None).cast("string").alias("event_type"), "payload")
    return ok.unionByName(aside)


@query("null_rows", """
SELECT count(*) AS messages, count(*) FILTER (WHERE doc_id IS NOT NULL) AS null_rows FROM (
  SELECT NULL AS doc_id FROM events UNION ALL SELECT doc_id FROM documents)
""")
def null_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3: after a plain PERMISSIVE decode (no filter), undecodable messages
    become all-NULL rows; count them."""
    from streamkit.operators import quality
    env = events_messages(spark, sf_dir)
    docs = table(spark, sf_dir, "documents").select(F.col("text").cast("binary").alias("value"))
    decoded = decode.json_events(env.select("value").unionByName(docs), EVENTS_PAYLOAD)
    return decoded.agg(F.count(F.lit(1)).alias("messages"),
                       F.count_if(quality.null_rows(decoded)).alias("null_rows"))


@query("json_file_stream", EVENTS_SQL)
def json_file_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON-lines files streamed with the schema inferred at start
    (``spark.sql.streaming.schemaInference``), then typed."""
    folder = work_path(spark, "json-files")
    ev = table(spark, sf_dir, "events")
    ev.select(F.to_json(F.struct(*[F.col(c) for c in EVENT_COLS]),
                        {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}).alias("value")) \
        .write.text(folder)
    st = stream_files(spark, folder, format="json", options={"prefersDecimal": "false"})
    typed = decode.cast_timestamps(st, ["ts"]).select(
        F.col("event_id").cast("bigint").alias("event_id"), "ts", F.col("user_id").cast("bigint").alias("user_id"),
        "event_type", F.col("value").cast("double").alias("value"), "props")
    return run_parquet(typed, "json-stream")
