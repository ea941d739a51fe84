"""De-duplication of replayed events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from streamkit.operators.windows import with_event_time


def dedupe(df: DataFrame, keys: list[str], *, time_col: str | None = None,
           delay: str | None = None) -> DataFrame:
    """Drop repeated events by ``keys``.

    Streaming: ``dropDuplicatesWithinWatermark`` -- state per key lives until
    the watermark passes the first copy's event time plus ``delay``, so
    copies further apart than the delay are not caught (the contract is
    "within the delay").  Batch: ``dropDuplicates``, a hash aggregate with a
    map-side step, so a key with very many copies is reduced in every task
    before the shuffle.
    """
    if df.isStreaming:
        if not (time_col and delay):
            raise ValueError("streaming de-duplication needs time_col and delay")
        ntz = isinstance(df.schema[time_col].dataType, T.TimestampNTZType)
        out = with_event_time(df, time_col, delay).dropDuplicatesWithinWatermark(keys)
        return out.withColumn(time_col, out[time_col].cast("timestamp_ntz")) if ntz else out
    return df.dropDuplicates(keys)
