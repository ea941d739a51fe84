"""Streaming sinks behind one validated specification.

``start(df, SinkSpec(...))`` returns a ``StreamingQuery``.  Kinds:

============== ==============================================================
memory         named in-memory table (tests and notebooks only: rows live on
               the driver)
console        printed micro-batches
parquet        file sink, append only
table_append   replay-safe append into a batch-addressable table (``tables``)
table_merge    insert-only MERGE of every micro-batch into such a table
kafka          Kafka sink (needs the connector on the classpath)
foreach_batch  user function ``fn(batch_df, epoch_id)``
============== ==============================================================

Checkpoints default to a per-query folder below the session's shared
folder, never inside the output table.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from streamkit.operators import tables
from streamkit.session import conf as session_conf, work_path

KINDS = ("memory", "console", "parquet", "table_append", "table_merge", "kafka", "foreach_batch")
MODES = ("append", "update", "complete")
CONTINUOUS_OK = ("memory", "console", "kafka")


@dataclass(frozen=True)
class Trigger:
    kind: str = "available_now"          # once | available_now | processing_time | continuous
    interval: str | None = None

    @staticmethod
    def once() -> "Trigger":
        return Trigger("once")

    @staticmethod
    def available_now() -> "Trigger":
        return Trigger("available_now")

    @staticmethod
    def every(seconds: float) -> "Trigger":
        return Trigger("processing_time", f"{seconds} seconds")

    @staticmethod
    def continuous(interval: str = "1 second") -> "Trigger":
        return Trigger("continuous", interval)

    @staticmethod
    def parse(mode: str, interval_seconds: float = 5) -> "Trigger":
        """Names used by notebooks: once, availableNow, processingTime, continuous."""
        table = {"once": Trigger.once(), "availableNow": Trigger.available_now(),
                 "available_now": Trigger.available_now(),
                 "processingTime": Trigger.every(interval_seconds),
                 "continuous": Trigger.continuous()}
        if mode not in table:
            raise ValueError(f"Invalid trigger mode: {mode!r}")
        return table[mode]

    def kwargs(self) -> dict:
        if self.kind == "once":
            return {"once": True}
        if self.kind == "available_now":
            return {"availableNow": True}
        if self.kind == "processing_time":
            return {"processingTime": self.interval}
        if self.kind == "continuous":
            return {"continuous": self.interval}
        raise ValueError(f"Invalid trigger: {self.kind!r}")


@dataclass
class SinkSpec:
    kind: str
    name: str | None = None
    path: str | None = None
    checkpoint: str | None = None
    mode: str = "append"
    trigger: Trigger = field(default_factory=Trigger.available_now)
    keys: list[str] | None = None
    dedupe_source: bool = False
    null_safe: bool = False
    evolve: bool = False
    fn: Callable[[DataFrame, int], None] | None = None
    options: dict = field(default_factory=dict)
    # stateful queries: "rocksdb" keeps state off the JVM heap (large joins,
    # de-duplication); state_partitions is frozen into the checkpoint at the
    # first start, so size it for the target volume
    state_store: str | None = None
    state_partitions: int | None = None
    # rocksdb: keep the progress rows' count of state rows, which costs a read of
    # the store for every row that is put or removed
    count_state_rows: bool = True
    # table sinks: cap rows per output file (maxRecordsPerFile)
    rows_per_file: int | None = None
    # table_append: a column that stores when the micro-batch was written, which
    # orders versions of a key also across writers (tables.latest_by_key)
    commit_col: str | None = None
    # session windows: rows of a task are merged into sessions before the shuffle
    merge_sessions: bool = False
    partition_follows_key: bool = False     # table_merge: a key's partition values never change

    def validate(self, df: DataFrame) -> None:
        if self.kind not in KINDS:
            raise ValueError(f"unknown sink {self.kind!r}; expected one of {KINDS}")
        if self.mode not in MODES:
            raise ValueError(f"unknown output mode {self.mode!r}")
        if self.trigger.kind == "continuous" and self.kind not in CONTINUOUS_OK:
            raise ValueError(f"continuous trigger supports {CONTINUOUS_OK}, not {self.kind!r}")
        if self.kind in ("parquet", "table_append", "table_merge") and not self.path:
            raise ValueError(f"sink {self.kind!r} needs a path")
        if self.kind == "parquet" and self.mode != "append":
            raise ValueError("the parquet file sink supports append mode only")
        if self.kind == "table_merge":
            if not self.keys:
                raise ValueError("table_merge needs merge keys")
            missing = [k for k in self.keys if k not in df.columns]
            if missing:
                raise ValueError(f"merge keys {missing} not in stream columns {df.columns}")
        if self.state_store not in (None, "rocksdb", "hdfs"):
            raise ValueError(f"unknown state store {self.state_store!r}")
        if self.kind == "kafka":
            missing = [k for k in ("kafka.bootstrap.servers", "topic") if not self.options.get(k)]
            if "topic" in missing and "topic" in df.columns:
                missing.remove("topic")   # each row names its topic
            if missing:
                raise ValueError(f"the kafka sink needs options {missing}")
            if "value" not in df.columns:
                raise ValueError("the kafka sink needs a value column (functions.encode.messages makes it)")
        if self.commit_col and self.kind != "table_append":
            raise ValueError("commit_col is for table_append")
        if self.kind == "foreach_batch" and self.fn is None:
            raise ValueError("foreach_batch needs fn")
        if self.kind == "memory" and not self.name:
            raise ValueError("memory sink needs a name (the table name)")
        if self.checkpoint and self.path and \
                self.checkpoint.rstrip("/").startswith(self.path.rstrip("/") + "/"):
            raise ValueError("checkpoint must not live inside the output path")


def stream_id() -> Callable[[DataFrame], str]:
    """Identity of the running query, read inside ``foreachBatch``."""
    def get(batch: DataFrame) -> str:
        qid = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not qid:
            raise RuntimeError("no streaming query id on this thread")
        return qid
    return get


def _append_fn(spec: SinkSpec) -> Callable[[DataFrame, int], None]:
    qid = stream_id()

    def run(batch: DataFrame, epoch_id: int) -> None:
        if spec.commit_col:
            batch = batch.withColumn(spec.commit_col, F.current_timestamp())
        tables.write_batch(batch, spec.path, qid(batch), epoch_id, evolve=spec.evolve,
                           rows_per_file=spec.rows_per_file)
    return run


def _merge_fn(spec: SinkSpec) -> Callable[[DataFrame, int], None]:
    qid = stream_id()
    index: list[tables.KeyIndex] = []   # key ranges of the table's batches, read at the first epoch

    def run(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        if not index and not spec.null_safe and tables.exists(spark, spec.path):
            index.append(tables.KeyIndex(spark, spec.path, spec.keys))
        # merge_insert persists the micro-batch: stats, keys and write reuse it
        tables.merge_insert(batch, spec.path, spec.keys, stream_id=qid(batch), batch_id=epoch_id,
                            dedupe_source=spec.dedupe_source, null_safe=spec.null_safe,
                            evolve=spec.evolve, rows_per_file=spec.rows_per_file,
                            partition_follows_key=spec.partition_follows_key, index=index[0] if index else None)
    return run


STATE_PROVIDERS = {
    "rocksdb": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "hdfs": "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider",
}


def start(df: DataFrame, spec: SinkSpec) -> StreamingQuery:
    """Validate ``spec`` and start the streaming query."""
    spec.validate(df)
    conf = {}
    if spec.state_store:
        conf["spark.sql.streaming.stateStore.providerClass"] = STATE_PROVIDERS[spec.state_store]
        if spec.state_store == "rocksdb":
            conf["spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"] = "true"
            conf["spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"] = str(spec.count_state_rows).lower()
    if spec.merge_sessions:
        conf["spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"] = "true"
    if spec.state_partitions:
        conf["spark.sql.shuffle.partitions"] = str(spec.state_partitions)
    with session_conf(df.sparkSession, conf):
        return _start(df, spec)


def _start(df: DataFrame, spec: SinkSpec) -> StreamingQuery:
    spark = df.sparkSession
    w = df.writeStream.trigger(**spec.trigger.kwargs())
    if spec.name:
        w = w.queryName(spec.name)
    for k, v in spec.options.items():
        w = w.option(k, v)
    needs_checkpoint = spec.kind not in ("memory", "console")
    checkpoint = spec.checkpoint or (work_path(spark, f"checkpoint-{spec.name or spec.kind}")
                                     if needs_checkpoint else None)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    if spec.kind in ("memory", "console"):
        return w.format(spec.kind).outputMode(spec.mode).start()
    if spec.kind == "parquet":
        return w.format("parquet").outputMode("append").option("path", spec.path).start()
    if spec.kind == "kafka":
        return w.format("kafka").outputMode(spec.mode).start()
    if spec.kind == "table_append":
        return w.outputMode(spec.mode).foreachBatch(_append_fn(spec)).start()
    if spec.kind == "table_merge":
        return w.outputMode(spec.mode).foreachBatch(_merge_fn(spec)).start()
    return w.outputMode(spec.mode).foreachBatch(spec.fn).start()
