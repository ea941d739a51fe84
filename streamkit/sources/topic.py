"""Topic sources.

``read_topic`` subscribes to a Kafka topic when the Kafka connector is on
the classpath.  ``replay_topic`` reads the same envelope shape from parquet
files (batch or stream), which is how the library is exercised without a
broker.  Both end in the same decode step.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamkit.functions.decode import json_events

ENVELOPE_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
])

# Kafka's sentinel offsets in a per-partition JSON spec.
EARLIEST = -2
LATEST = -1


def read_topic(spark: SparkSession, topic: str, schema=None, *,
               bootstrap_servers: str, starting_offsets: str = "earliest",
               options: dict | None = None) -> DataFrame:
    """Kafka stream subscribed to one topic, decoded with ``schema`` when given."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap_servers)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets))
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    try:
        raw = reader.load()
    except Exception as e:  # the connector is a separate artifact
        if "kafka" in str(e).lower() and "data source" in str(e).lower():
            raise RuntimeError("the Kafka source needs the spark-sql-kafka-0-10 connector on the "
                               "classpath; replay envelope files with replay_topic instead") from e
        raise
    return json_events(raw, schema) if schema is not None else raw


def write_topic(df: DataFrame, topic: str, *, bootstrap_servers: str,
                checkpoint: str | None = None):
    """Kafka sink for a batch or streaming envelope (``key``, ``value``)."""
    if df.isStreaming:
        from streamkit.session import work_path
        return (df.select("key", "value").writeStream.format("kafka")
                  .option("kafka.bootstrap.servers", bootstrap_servers).option("topic", topic)
                  .option("checkpointLocation", checkpoint or work_path(df.sparkSession, f"checkpoint-kafka-{topic}"))
                  .start())
    (df.select("key", "value").write.format("kafka")
       .option("kafka.bootstrap.servers", bootstrap_servers).option("topic", topic).save())
    return None


def parse_offsets(spec: str, topic: str) -> dict[int, int] | str:
    """``earliest`` / ``latest`` or the JSON form ``{"topic": {"0": 23, "1": -2}}``."""
    s = spec.strip()
    if s in ("earliest", "latest"):
        return s
    per_topic = json.loads(s)
    if topic not in per_topic:
        raise ValueError(f"starting offsets name no partition of topic {topic!r}")
    return {int(p): int(o) for p, o in per_topic[topic].items()}


def offset_filter(envelope: DataFrame, starting_offsets: str = "earliest", *,
                  topic: str | None = None) -> DataFrame:
    """Keep envelope rows at or after the starting position of their partition.

    ``earliest`` keeps all, ``latest`` keeps none of what is already there,
    and the JSON form gives a start per partition (``-2`` earliest, ``-1``
    latest).  Partitions absent from a JSON spec are not read (Kafka would
    reject such a spec).  The per-partition start table has one row per
    named partition and is broadcast.
    """
    df = envelope.where(F.col("topic") == topic) if topic else envelope
    spec = parse_offsets(starting_offsets, topic or "")
    if spec == "earliest":
        return df
    if spec == "latest":
        return df.where(F.lit(False))
    spark = df.sparkSession
    starts = spark.createDataFrame([(p, o) for p, o in spec.items()],
                                   "partition int, _start bigint")
    latest = (df.join(F.broadcast(starts.where(F.col("_start") == LATEST)), "partition", "left_semi")
                .groupBy("partition").agg((F.max("offset") + 1).alias("_end")))
    resolved = (starts.join(latest, "partition", "left")
                      .select("partition",
                              F.when(F.col("_start") == EARLIEST, F.lit(0))
                               .when(F.col("_start") == LATEST, F.coalesce("_end", F.lit(0)))
                               .otherwise(F.col("_start")).alias("_start")))
    return (df.join(F.broadcast(resolved), "partition")
              .where(F.col("offset") >= F.col("_start")).drop("_start"))


def replay_topic(spark: SparkSession, path: str, topic: str, schema=None, *,
                 starting_offsets: str = "earliest", stream: bool = False,
                 max_files_per_trigger: int | None = None,
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """Envelope parquet files at ``path`` read as the topic: batch, or as a
    file stream (one micro-batch per ``max_files_per_trigger`` files)."""
    if stream:
        reader = spark.readStream.schema(ENVELOPE_SCHEMA)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        env = reader.parquet(path).where(F.col("topic") == topic)
        if starting_offsets != "earliest":
            spec = parse_offsets(starting_offsets, topic)
            if spec == "latest" or any(v == LATEST for v in spec.values()):
                raise ValueError("'latest' needs a live topic; a file stream has no end offset")
            cond = F.lit(False)
            for p, o in spec.items():
                cond = cond | ((F.col("partition") == p) & (F.col("offset") >= max(o, 0)))
            env = env.where(cond)
    else:
        env = offset_filter(spark.read.schema(ENVELOPE_SCHEMA).parquet(path),
                            starting_offsets, topic=topic)
    return json_events(env, schema, keep=keep) if schema is not None else env
