"""Message encoding: rows -> JSON payload -> Kafka-shaped envelope.

The envelope schema is Spark's public Kafka source schema
(key, value, topic, partition, offset, timestamp, timestampType).
Offsets are assigned without any single-task step: rows are range
partitioned on (partition, order...), each Spark partition numbers its own
rows, and a prefix sum over the per-(Spark partition, topic partition)
counts -- a table whose size is bounded by the number of range partitions
-- turns local numbers into topic offsets.  Range bounds come from a
sample and need not repeat between two evaluations, so the numbered rows
are checkpointed (reliably, to the shared checkpoint folder) before both
the counts and the final join read them.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamkit.session import shared_dir

# Wire formats that keep microseconds (to_json's default is ms).
TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
JSON_OPTIONS = {"timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSSXXX",
                "timestampNTZFormat": TS_FORMAT}

ENVELOPE_COLUMNS = ["key", "value", "topic", "partition", "offset", "timestamp", "timestampType"]


def json_payload(cols: Iterable[str | Column] | None = None, df: DataFrame | None = None) -> Column:
    """``to_json(struct(cols))`` as UTF-8 bytes with microsecond timestamps."""
    if cols is None:
        if df is None:
            raise ValueError("give cols or df")
        cols = df.columns
    return F.to_json(F.struct(*[F.col(c) if isinstance(c, str) else c for c in cols]),
                     JSON_OPTIONS).cast("binary")


def assign_offsets(df: DataFrame, partition_col: str, order_cols: list[str], *,
                   slices: int | None = None, offset_col: str = "offset") -> DataFrame:
    """0-based position of each row within its ``partition_col`` value,
    ordered by ``order_cols`` (which should make the order total).

    Equivalent to ``row_number() OVER (PARTITION BY p ORDER BY ...) - 1`` but
    spread over ``slices`` range partitions instead of one task per topic
    partition, so a hot partition is split like any other.  Size ``slices``
    to the data (about one per 128 MB); the default is the session's
    shuffle partition count.
    """
    spark = df.sparkSession
    shared_dir(spark)
    n = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [partition_col, *order_cols]
    ranged = (df.repartitionByRange(n, *keys)
                .sortWithinPartitions(*keys)
                .withColumn("_slice", F.spark_partition_id())
                .withColumn("_pos", F.monotonically_increasing_id())
                .checkpoint(eager=True))
    # at most n + (#topic partitions) rows: each slice spans a contiguous key range
    w = (Window.partitionBy(partition_col).orderBy("_slice")
         .rowsBetween(Window.unboundedPreceding, -1))
    starts = (ranged.groupBy("_slice", partition_col)
                    .agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first"))
                    .withColumn("_base", F.coalesce(F.sum("_n").over(w), F.lit(0))))
    return (ranged.join(F.broadcast(starts.select("_slice", partition_col, "_base", "_first")),
                        ["_slice", partition_col])
                  .withColumn(offset_col, F.col("_base") + F.col("_pos") - F.col("_first"))
                  .drop("_slice", "_pos", "_base", "_first"))


def messages(df: DataFrame, topic: str, *, partition: Column, payload_cols: list[str] | None = None,
             key: Column | None = None, timestamp: Column | None = None) -> DataFrame:
    """Rows -> envelope rows without offsets (a single projection)."""
    cols = payload_cols or df.columns
    return df.select(
        (key.cast("binary") if key is not None else F.lit(None).cast("binary")).alias("key"),
        json_payload(cols).alias("value"),
        F.lit(topic).alias("topic"),
        partition.cast("int").alias("partition"),
        F.lit(None).cast("bigint").alias("offset"),
        (timestamp.cast("timestamp") if timestamp is not None else F.current_timestamp()).alias("timestamp"),
        F.lit(0).alias("timestampType"))


def envelope(df: DataFrame, topic: str, *, partition: Column, order_cols: list[str],
             payload_cols: list[str] | None = None, key: Column | None = None,
             timestamp: Column | None = None, slices: int | None = None) -> DataFrame:
    """Rows -> Kafka-shaped envelope with per-partition offsets.

    ``partition`` is the topic partition of each row, ``order_cols`` the
    append order within a partition, ``timestamp`` the broker append time
    (defaults to the first order column).
    """
    cols = payload_cols or df.columns
    staged = df.select(
        (key.cast("binary") if key is not None else F.lit(None).cast("binary")).alias("key"),
        json_payload(cols).alias("value"),
        F.lit(topic).alias("topic"),
        partition.cast("int").alias("partition"),
        (timestamp if timestamp is not None else F.col(order_cols[0])).cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
        *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_cols)])
    order = [f"_o{i}" for i in range(len(order_cols))]
    with_off = assign_offsets(staged, "partition", order, slices=slices)
    return with_off.select(*ENVELOPE_COLUMNS)
