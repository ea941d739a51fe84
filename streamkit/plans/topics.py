"""Driver tables turned into topic envelopes and replay folders.

A replay folder stands in for a Kafka topic: envelope parquet files under
the session's shared folder, read back as a file stream.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from streamkit.functions.encode import envelope, messages
from streamkit.session import FS, use_utc, work_path


# Payload schema of an ``events`` message and its topic layout.
EVENTS_TOPIC = "events"
EVENTS_PAYLOAD = "event_id BIGINT, ts STRING, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
EVENTS_PARTITIONS = 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    use_utc(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_partition() -> F.Column:
    return F.pmod(F.col("user_id"), F.lit(EVENTS_PARTITIONS))


def events_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as envelope rows without offsets (one projection)."""
    ev = table(spark, sf_dir, "events")
    return messages(ev, EVENTS_TOPIC, partition=events_partition(),
                    key=F.col("event_id").cast("string"), timestamp=F.col("ts"))


def events_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a topic: partition = user_id mod 4, offsets by (ts, event_id)."""
    ev = table(spark, sf_dir, "events")
    size = input_bytes(spark, f"{sf_dir.rstrip('/')}/events.parquet")
    return envelope(ev, EVENTS_TOPIC, partition=events_partition(), order_cols=["ts", "event_id"],
                    key=F.col("event_id").cast("string"),
                    slices=max(EVENTS_PARTITIONS, -(-size // TARGET_FILE_BYTES)))


# replay files are sized like Spark's input splits
TARGET_FILE_BYTES = 128 * 1024 * 1024


def input_bytes(spark: SparkSession, path: str) -> int:
    """Bytes under ``path`` (one summary call to the file system)."""
    fs = FS(spark, path)
    return int(fs.fs.getContentSummary(fs.p(path)).getLength())


def write_replay(spark: SparkSession, env: DataFrame, name: str, *, files: int | None = None) -> str:
    """Write envelope rows as a replay folder and return its path.

    With ``files`` the rows are in that many files by event time, and a file
    stream takes them in that order.  Else there is one per input split."""
    path = work_path(spark, name)
    if not files:
        env.write.parquet(path)
        return path
    env.repartitionByRange(files, "timestamp").write.parquet(path)
    in_order(spark, path)
    return path


def write_arrivals(spark: SparkSession, env: DataFrame, name: str, group_col: str) -> str:
    """Write rows as a replay folder of one file per value of ``group_col``; a
    file stream with one file per trigger takes the groups in ascending order."""
    path = work_path(spark, name)
    env.repartition(group_col).write.partitionBy(group_col).parquet(path)
    in_order(spark, path, lambda file: int(file.rsplit(f"{group_col}=", 1)[1].split("/")[0]))
    return path


def in_order(spark: SparkSession, path: str, rank=None) -> None:
    """Set the files' modification times, by which a file stream orders them, a
    second apart in order of ``rank`` (default: the part number); a few files per
    micro-batch, as a topic's producer would have written them over time."""
    fs = FS(spark, path)

    def below(folder: str) -> list[str]:
        out = []
        for name, is_dir, _, _ in fs.list(folder):
            base = name.rsplit("/", 1)[-1]
            if not base.startswith(("_", ".")):
                out += below(name) if is_dir else [name]
        return out

    files = sorted(below(path), key=lambda f: (rank(f) if rank else 0, f.rsplit("/", 1)[-1]))
    now = int(time.time() * 1000)
    for i, f in enumerate(files):
        fs.fs.setTimes(fs.p(f), now - 1000 * (len(files) - i), -1)


# a file of a streamed replay holds the messages of so many bytes of input: as JSON they
# take several times that and are one row group, which one task reads
STREAM_FILE_BYTES = 4 * 1024 * 1024


def replay_layout(size_bytes: int, batches: int | None, file_bytes: int = TARGET_FILE_BYTES) -> tuple[int, int | None]:
    """(files to write, files per micro-batch) so that each file is about
    ``file_bytes`` and a stream with ``maxFilesPerTrigger`` set to the
    second number runs ``batches`` micro-batches (None: one micro-batch)."""
    n = max(1, batches or 1)
    per_batch = max(1, -(-size_bytes // (n * file_bytes)))
    return n * per_batch, (per_batch if batches else None)


# A marker dated far after any real event; fed with the data
# it moves the watermark past every real window (append mode then emits
# them all), and its own window is never emitted.
FLUSH_TS = "2099-01-01 00:00:00"
FLUSH_USER = -1


def flush_messages(spark: SparkSession, event_types: list[str] | None = None) -> DataFrame:
    """Envelope rows carrying only the marker event time (one per event type)."""
    types = event_types or [None]
    rows = spark.createDataFrame([(t,) for t in types], "event_type string")
    # the key is set (to a user no real event has): a join infers NOT NULL on
    # its keys and may filter a NULL-key marker before the watermark sees it
    marker = rows.select(F.lit(None).cast("bigint").alias("event_id"),
                         F.to_timestamp_ntz(F.lit(FLUSH_TS)).alias("ts"),
                         F.lit(FLUSH_USER).cast("bigint").alias("user_id"), "event_type",
                         F.lit(None).cast("double").alias("value"), F.lit(None).cast("string").alias("props"))
    return messages(marker, EVENTS_TOPIC, partition=F.lit(0), timestamp=F.col("ts"))
