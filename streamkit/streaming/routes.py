"""foreachBatch functions that send one micro-batch to two tables.

* ``late_router`` -- rows older than the watermark go to a side table
  instead of being silently dropped.  The watermark is Spark's rule (max
  event time of all earlier micro-batches minus the delay), kept as a
  running max in a small state table; only the last two micro-batches'
  entries are kept, so a replayed micro-batch sees the same watermark it saw
  the first time and the state never grows.
* ``quarantine_router`` -- decoded rows to one table, undecodable messages
  to another.
* ``enrich_router`` -- rows with a dimension's columns, read anew for each
  micro-batch.

The first two persist the micro-batch once and write with ``tables.write_batch``,
so replays replace their own output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamkit.functions.decode import split_tagged, with_corrupt
from streamkit.operators import tables
from streamkit.operators.joins import DEFAULT_BROADCAST_BYTES, enrich_bounded
from streamkit.operators.windows import MICROS, late_split
from streamkit.session import FS
from streamkit.streaming.sinks import stream_id


def _watermark_before(batch: DataFrame, state_path: str, sid: str, epoch: int) -> int | None:
    spark = batch.sparkSession
    if not tables.exists(spark, state_path):
        return None
    row = (tables.read(spark, state_path)
           .where((F.col(tables.STREAM_COL) == sid) & (F.col(tables.BATCH_COL) < epoch))
           .agg(F.max("max_event_us")).first())
    return None if row is None or row[0] is None else int(row[0])


def _forget_before(spark, state_path: str, sid: str, keep_from: int) -> None:
    """Drop state entries older than ``keep_from``: each entry holds the
    running max, and a replay only ever needs the entry before its epoch."""
    fs = FS(spark, state_path)
    for name, is_dir, _, _ in fs.list(f"{state_path}/{tables.STREAM_COL}={sid}"):
        base = name.rsplit("/", 1)[-1]
        if is_dir and base.startswith(f"{tables.BATCH_COL}=") and int(base.split("=", 1)[1]) < keep_from:
            fs.delete(name)


def late_router(main_path: str, late_path: str, state_path: str, *, time_col: str,
                delay_seconds: int) -> Callable[[DataFrame, int], None]:
    qid = stream_id()

    def run(batch: DataFrame, epoch_id: int) -> None:
        sid = qid(batch)
        batch = batch.persist()
        try:
            seen = _watermark_before(batch, state_path, sid, epoch_id)
            wm = None if seen is None else seen - delay_seconds * MICROS
            tagged = late_split(batch, time_col, delay_seconds, wm)
            tables.write_batch(tagged.where(~F.col("_late")).drop("_late"), main_path, sid, epoch_id)
            tables.write_batch(tagged.where(F.col("_late")).drop("_late"), late_path, sid, epoch_id)
            top = batch.agg(F.max(F.unix_micros(F.col(time_col).cast("timestamp")))).first()[0]
            running = max(v for v in (seen, top) if v is not None) if (seen is not None or top is not None) else None
            spark = batch.sparkSession
            state = spark.createDataFrame([(running,)], "max_event_us bigint")
            tables.write_batch(state, state_path, sid, epoch_id)
            _forget_before(spark, state_path, sid, epoch_id - 1)
        finally:
            batch.unpersist()
    return run


def quarantine_router(good_path: str, bad_path: str, schema, *,
                      keep: tuple[str, ...] = ()) -> Callable[[DataFrame, int], None]:
    qid = stream_id()

    def run(batch: DataFrame, epoch_id: int) -> None:
        sid = qid(batch)
        tagged = with_corrupt(batch, schema, keep=keep).persist()   # decoded once for both tables
        try:
            good, bad = split_tagged(tagged, schema, keep=keep)
            tables.write_batch(good, good_path, sid, epoch_id)
            tables.write_batch(bad, bad_path, sid, epoch_id)
        finally:
            tagged.unpersist()
    return run


def enrich_router(dimension: Callable[[], DataFrame], keys: dict[str, str], out_path: str, *, how: str = "left",
                  max_bytes: int = DEFAULT_BROADCAST_BYTES) -> Callable[[DataFrame, int], None]:
    """Each micro-batch joined with the dimension as it is by then, appended to a
    table.  ``dimension`` gives the frame to read, for each micro-batch anew, so
    its files are listed again and its bytes are checked again: it is broadcast
    up to ``max_bytes``, else joined by shuffle (``joins.enrich_bounded``)."""
    qid = stream_id()

    def run(batch: DataFrame, epoch_id: int) -> None:
        rows = enrich_bounded(batch, dimension(), keys, how=how, max_bytes=max_bytes)
        tables.write_batch(rows.drop(*keys.values()), out_path, qid(batch), epoch_id)
    return run
