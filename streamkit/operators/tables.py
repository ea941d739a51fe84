"""Batch-addressable parquet tables with replay-safe maintenance.

Layout: ``<path>/stream_id=<writer>/batch_id=<n>/[<col>=<v>/]part-*.parquet``
with optional data partition columns (``partition_by``) below each batch,
and ``_schema.json`` recording the row schema.  Every write replaces
exactly the partitions it produces (dynamic partition overwrite, Spark's
own commit protocol), so re-running a micro-batch after a failure rewrites
its own output instead of adding to it.

* ``merge_insert`` -- insert-only MERGE: source rows whose key is not in the
  target are appended (``whenNotMatchedInsertAll``); matched rows are left
  alone.  The target scan is pruned to the batch's key range (and partition
  values), reduced to the batch's keys with a semi-join (broadcast only
  under a checked key count), then anti-joined.
* ``delete_where`` -- rewrites only the batches holding matching rows.
* ``compact`` -- rewrites batches into files of about ``rows_per_file``
  rows, salting each batch by a row hash so a hot batch is spread over many
  tasks.
* ``fold`` -- rewrites a writer's committed batches up to an epoch as one
  batch, committed by one small record; replays of folded epochs insert
  nothing.
* ``vacuum`` -- removes files no visible batch references (staging left
  by failed jobs, folded batches, empty folders) once older than the
  retention; listing and deletion run in tasks (``operators.files``).
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamkit.functions.schema import align, conform, readable_as, widen
from streamkit.operators.files import delete_files, list_tree, writable, write_runs
from streamkit.session import FS, conf, shared_dir, work_path

STREAM_COL = "stream_id"
BATCH_COL = "batch_id"
LAYOUT_COLS = [STREAM_COL, BATCH_COL]
BOOTSTRAP_STREAM = "bootstrap"
# broadcast a batch's key set only below this many distinct keys
DEFAULT_BROADCAST_KEYS = 2_000_000


# ---------------------------------------------------------------- reads

def exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds a created table: the recorded schema, which a
    create writes last, and a batch folder.  A half-written create is no table."""
    fs = FS(spark, path)
    return fs.exists(f"{path.rstrip('/')}/{SCHEMA_FILE}") and any(is_dir and name.rsplit("/", 1)[-1].startswith(f"{STREAM_COL}=")
               for name, is_dir, _, _ in fs.list(path))


SCHEMA_FILE = "_schema.json"   # hidden from Spark's file listing by the leading underscore


def stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The table's current row schema as last written, if recorded."""
    fs = FS(spark, path)
    f = f"{path.rstrip('/')}/{SCHEMA_FILE}"
    if not fs.exists(f):
        return None
    return T.StructType.fromJson(json.loads(fs.read_text(f)))


FOLDS_FILE = "_folds.json"


def folds(spark: SparkSession, path: str) -> dict[str, int]:
    """Writer -> last epoch folded into its one folded batch (one entry per writer)."""
    fs = FS(spark, path)
    f = f"{path.rstrip('/')}/{FOLDS_FILE}"
    return json.loads(fs.read_text(f)) if fs.exists(f) else {}


def folded_id(upto: int) -> int:
    """Batch id of the batch that holds all epochs up to ``upto``."""
    return -(upto + 1)


def _visible(folded: dict[str, int]) -> Column:
    """The batches that count: those after the fold and the folded one.  A
    predicate on partition columns: other folders are not read."""
    cond = F.col(BATCH_COL) >= 0
    for sid, upto in folded.items():
        mine = F.col(STREAM_COL) == sid
        cond = (cond & ~(mine & (F.col(BATCH_COL) <= upto))) | (mine & (F.col(BATCH_COL) == folded_id(upto)))
    return cond


PARTITION_FLAG = "streamkit.partition"


def save_schema(spark: SparkSession, path: str, schema: T.StructType,
                partition_by: Iterable[str] = ()) -> None:
    """Record the row schema; ``partition_by`` columns are flagged in the
    field metadata (they become folders below each batch)."""
    flagged = set(partition_by)
    rows = T.StructType([T.StructField(f.name, f.dataType, True,
                                       {**(f.metadata or {}), **({PARTITION_FLAG: True} if f.name in flagged else {})})
                         for f in schema.fields if f.name not in LAYOUT_COLS])
    FS(spark, path).write_text(f"{path.rstrip('/')}/{SCHEMA_FILE}", rows.json())


def partition_cols(schema: T.StructType | None) -> list[str]:
    """Data columns the table is partitioned by below each batch folder."""
    return [f.name for f in (schema.fields if schema else []) if (f.metadata or {}).get(PARTITION_FLAG)]


def _parts(spark: SparkSession, path: str) -> list[str]:
    return LAYOUT_COLS + partition_cols(stored_schema(spark, path))


def _with_layout(schema: T.StructType) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField(STREAM_COL, T.StringType()),
                                              T.StructField(BATCH_COL, T.LongType())])


def read(spark: SparkSession, path: str, *, merge_schema: bool = False,
         columns: list[str] | None = None) -> DataFrame:
    """The table as a DataFrame; ``batch_id`` is BIGINT, ``stream_id`` STRING.

    With a recorded schema (written on every create and evolution) the files
    are read with it, so batches written before a column was added show it
    as NULL without opening every footer; ``merge_schema`` forces footer
    reconciliation instead.
    """
    stored = None if merge_schema else stored_schema(spark, path)
    reader = spark.read.option("basePath", path)
    if stored is not None:
        reader = reader.schema(_with_layout(stored))
    elif merge_schema:
        reader = reader.option("mergeSchema", "true")
    df = reader.parquet(path)
    df = df.withColumn(STREAM_COL, F.col(STREAM_COL).cast("string")) \
           .withColumn(BATCH_COL, F.col(BATCH_COL).cast("bigint")).where(_visible(folds(spark, path)))
    return df.select(*columns) if columns else df


def data_schema(spark: SparkSession, path: str) -> T.StructType:
    """Schema of the stored rows, without the layout columns."""
    stored = stored_schema(spark, path)
    if stored is not None:
        return stored
    return T.StructType([f for f in read(spark, path).schema.fields if f.name not in LAYOUT_COLS])


def latest_by_key(df: DataFrame, keys: list[str], order_cols: list[str] | None = None) -> DataFrame:
    """Latest version of each key by ``order_cols``.  ``max_by`` is a plain
    aggregate, so versions collapse map-side first.

    The default order is the batch id, which counts within one writer only: a
    stream whose checkpoint was reset starts again at 0 as another writer.  A
    frame that shows rows of several writers is refused; give a column of the
    rows (``SinkSpec.commit_col`` stores one) as the order then."""
    if order_cols is None:
        if STREAM_COL in df.columns and df.select(STREAM_COL).distinct().limit(2).count() > 1:
            raise ValueError("several writers: batch ids do not order their versions; pass order_cols")
        order_cols = [BATCH_COL]
    order = F.struct(*[F.col(c) for c in order_cols])
    rest = [c for c in df.columns if c not in keys and c not in LAYOUT_COLS]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in rest]), order).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.`{c}`").alias(c) for c in rest])


def register(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Temp view over the table (rows only, layout columns dropped)."""
    df = read(spark, path).drop(*LAYOUT_COLS)
    df.createOrReplaceTempView(name)
    return df


def history(spark: SparkSession, path: str) -> DataFrame:
    """One row per committed batch: stream, batch and row count."""
    return (read(spark, path, columns=LAYOUT_COLS)
            .groupBy(*LAYOUT_COLS).agg(F.count(F.lit(1)).alias("rows")))


def keys_from_text(text: str) -> list[str]:
    """Merge keys given as comma-separated text (configuration files, env)."""
    keys = [k.strip() for k in text.split(",") if k.strip()]
    if not keys:
        raise ValueError("no merge keys")
    return keys


# ---------------------------------------------------------------- writes

def _record_schema(spark: SparkSession, path: str, rows: T.StructType, evolve: bool) -> T.StructType:
    """First write records the schema; later writes may only add columns or
    widen types with ``evolve`` (the recorded schema is widened), never
    silently.  Returns the schema in force after the write."""
    stored = stored_schema(spark, path)
    if stored is None:
        save_schema(spark, path, rows)
        return rows
    extra = [f.name for f in rows.fields if f.name not in stored.fieldNames()]
    if extra and not evolve:
        raise ValueError(f"columns {extra} are not in the table; pass evolve=True to add them")
    if evolve:
        return _widened(spark, path, stored, rows)
    return stored


def _widened(spark: SparkSession, path: str, stored: T.StructType, rows: T.StructType) -> T.StructType:
    """The recorded schema widened to hold ``rows``; refused, before anything is
    written, where files at rest could not be read as the wider type."""
    wider = widen(stored, rows)
    bad = [f"{f.name}: {f.dataType.simpleString()} -> {wider[f.name].dataType.simpleString()}"
           for f in stored.fields if not readable_as(f.dataType, wider[f.name].dataType)]
    if bad:
        raise ValueError(f"stored batches cannot be read with the changed types {bad}; rewrite the table first")
    pcols = partition_cols(stored)
    if [(f.name, f.dataType) for f in wider.fields] != [(f.name, f.dataType) for f in stored.fields]:
        save_schema(spark, path, wider, pcols)
        return stored_schema(spark, path)
    return stored


def _check_types(rows: T.StructType, schema: T.StructType) -> None:
    bad = [f"{f.name}: {f.dataType.simpleString()} -> {schema[f.name].dataType.simpleString()}"
           for f in rows.fields
           if not isinstance(f.dataType, T.NullType) and not readable_as(f.dataType, schema[f.name].dataType)]
    if bad:
        raise ValueError(f"columns do not have the table's types: {bad}")


def _typed(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """``rows`` with the types of the recorded schema; a column whose values may
    not fit fails before anything is written."""
    _check_types(rows.schema, schema)
    return rows.select(*[conform(F.col(f"`{f.name}`"), f.dataType, schema[f.name].dataType).alias(f.name)
                         for f in rows.schema.fields])


def _files(fs: FS, folder: str) -> list[str]:
    """Data files below ``folder``."""
    out = []
    for name, is_dir, _, _ in fs.list(folder):
        out += _files(fs, name) if is_dir else [name]
    return out


def write_batch(df: DataFrame, path: str, stream_id: str, batch_id: int, *,
                rows_per_file: int | None = None, evolve: bool = False, options: dict[str, str] | None = None) -> None:
    """Write ``df`` as batch (stream_id, batch_id), replacing that batch if
    present: files of an earlier attempt go, also those in folders that get
    no rows this time.  Rows take the table's recorded types or are refused.
    A replay of a folded epoch writes nothing: its rows are in the folded batch."""
    spark = df.sparkSession
    if 0 <= int(batch_id) <= folds(spark, path).get(str(stream_id), -1):
        return
    rows = df.drop(*[c for c in LAYOUT_COLS if c in df.columns])
    schema = _record_schema(spark, path, rows.schema, evolve)
    out = (_typed(rows, schema).withColumn(STREAM_COL, F.lit(str(stream_id)))
               .withColumn(BATCH_COL, F.lit(int(batch_id)).cast("bigint")))
    fs = FS(spark, path)
    mine = _stream_folders(spark, path).get(str(stream_id))
    earlier = _files(fs, f"{mine}/{BATCH_COL}={int(batch_id)}") if mine else []
    w = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**(options or {}))
    if rows_per_file:
        w = w.option("maxRecordsPerFile", rows_per_file)
    w.partitionBy(*LAYOUT_COLS, *partition_cols(schema)).parquet(path)
    for name in earlier:   # the job removed those in the folders it wrote
        if fs.exists(name):
            fs.delete(name)


def write_batches(df: DataFrame, path: str, stream_id: str, batch_col: str, *,
                  evolve: bool = False) -> None:
    """Write many batches in one job (one scan): ``batch_col`` holds each
    row's batch number; every batch present is replaced."""
    spark = df.sparkSession
    rows = df.drop(*[c for c in LAYOUT_COLS if c in df.columns])
    schema = _record_schema(spark, path, rows.drop(batch_col).schema, evolve)
    number = F.col(f"`{batch_col}`").cast("bigint").alias(BATCH_COL)
    types = T.StructType([*schema.fields, T.StructField(BATCH_COL, T.LongType())])
    folded = folds(spark, path).get(str(stream_id))
    if folded is not None:   # replays of folded epochs write nothing
        rows = rows.where(F.col(f"`{batch_col}`") > folded)
    earlier = None
    if partition_cols(schema) and str(stream_id) in _stream_folders(spark, path):
        # files of the batches that come again: those in folders that get no rows this time go afterwards
        mine = read(spark, path).where(F.col(STREAM_COL) == str(stream_id))
        again = rows.select(number).distinct()
        earlier = _kept(mine.select(BATCH_COL, F.col("_metadata.file_path").alias("path")).distinct().join(again, BATCH_COL, "left_semi").select("path"))
    (_typed(rows.select(*[f"`{c}`" for c in rows.columns if c != batch_col], number), types)
         .withColumn(STREAM_COL, F.lit(str(stream_id)))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*LAYOUT_COLS, *partition_cols(schema)).parquet(path))
    if earlier is not None:
        delete_files(earlier).count()


def _kept(df: DataFrame, partition_by: Iterable[str] = ()) -> DataFrame:
    """``df`` as a table in the shared folder: what comes after reads it, whatever happens to its sources."""
    spark = df.sparkSession
    path = work_path(spark, "kept")
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def overwrite(df: DataFrame, path: str, *, partition_by: Iterable[str] = ()) -> None:
    """Replace the whole table by ``df`` (one bootstrap batch).

    ``partition_by`` names data columns (an event date, say) stored as
    folders below each batch, so a merge or a query that filters on them
    reads only the matching folders (partition pruning).
    """
    partition_by = list(partition_by)
    missing = [c for c in partition_by if c not in df.columns]
    if missing:
        raise ValueError(f"partition columns {missing} not in {df.columns}")
    rows = df.drop(*[c for c in LAYOUT_COLS if c in df.columns])
    (rows.withColumn(STREAM_COL, F.lit(BOOTSTRAP_STREAM))
         .withColumn(BATCH_COL, F.lit(0).cast("bigint"))
         .write.mode("overwrite").option("partitionOverwriteMode", "static")
         .partitionBy(*LAYOUT_COLS, *partition_by).parquet(path))
    save_schema(df.sparkSession, path, rows.schema, partition_by)
    FS(df.sparkSession, path).delete(f"{path.rstrip('/')}/{FOLDS_FILE}")


def bootstrap(spark: SparkSession, path: str, source: DataFrame,
              columns: list[str] | None = None, *, view: str | None = None,
              partition_by: Iterable[str] = ()) -> bool:
    """Create the table from ``source`` (projected to ``columns``) if absent.

    Returns True when it was created.  Missing columns fail before anything
    is written.  ``view`` registers a temp view afterwards.
    """
    created = False
    if not exists(spark, path):
        if columns:
            missing = [c for c in columns if c not in source.columns]
            if missing:
                raise ValueError(f"source lacks columns {missing}")
            source = source.select(*columns)
        overwrite(source, path, partition_by=partition_by)
        created = True
    if view:
        register(spark, path, view)
    return created


def _key_condition(left: str, right: str, keys: list[str], null_safe: bool) -> Column:
    out = None
    for k in keys:
        lc, rc = F.col(f"{left}.`{k}`"), F.col(f"{right}.`{k}`")
        c = lc.eqNullSafe(rc) if null_safe else lc == rc
        out = c if out is None else out & c
    return out


def dedupe_by_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: the smallest row by value.  Deterministic, and a plain
    aggregation (partial aggregation map-side), so a hot key never lands
    whole in one task."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    picked = df.groupBy(*keys).agg(F.min(F.struct(*[F.col(f"`{c}`") for c in rest])).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.`{c}`").alias(c) for c in rest]).select(*df.columns)


def key_stats(batch: DataFrame, keys: list[str]) -> dict:
    """Row count and key ranges of a batch, in one pass."""
    return batch.agg(F.count(F.lit(1)).alias("rows"),
                     *[F.min(k).alias(f"lo{i}") for i, k in enumerate(keys)],
                     *[F.max(k).alias(f"hi{i}") for i, k in enumerate(keys)]).first().asDict()


def new_rows(batch: DataFrame, target: DataFrame | None, keys: list[str], *,
             dedupe_source: bool = False, null_safe: bool = False,
             broadcast_keys: int = DEFAULT_BROADCAST_KEYS, stats: dict | None = None,
             in_list: int = 0) -> DataFrame:
    """Rows of ``batch`` whose key is absent from ``target`` (insert-only MERGE).

    Default semantics follow ``target.k = source.k``: NULL keys never match
    and are always inserted, duplicate batch keys are all inserted.
    ``dedupe_source`` keeps one row per key; ``null_safe`` matches NULLs.
    Rows with a NULL key go past the join (unless ``null_safe``): they never
    meet in one task.  ``in_list``: a batch of at most so many rows and one key
    column names its keys to the target scan, which then skips row groups by
    their bloom filters.
    """
    missing = [k for k in keys if k not in batch.columns]
    if missing:
        raise ValueError(f"merge keys {missing} not in source columns {batch.columns}")
    src = dedupe_by_key(batch, keys) if dedupe_source else batch
    if target is None:
        return src
    tmissing = [k for k in keys if k not in target.columns]
    if tmissing:
        raise ValueError(f"merge keys {tmissing} not in target columns {target.columns}")
    # one pass over the batch: its size bounds the distinct keys, and its key
    # range is pushed to the target scan, where parquet skips row groups
    # whose min/max statistics fall outside it (ids and event times that grow
    # over time make this skip most of the table)
    stats = stats or key_stats(batch, keys)
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(f"`{k}`").isNull()
    keyed = src if null_safe else src.where(~no_key)
    if stats["rows"] <= broadcast_keys:
        # the row count already bounds the key list: broadcast it as is
        # (duplicates do not change a semi-join), no de-duplicating shuffle
        src_keys, small = keyed.select(*keys), True
    else:
        src_keys = keyed.select(*keys).dropDuplicates()
        small = src_keys.limit(broadcast_keys + 1).count() <= broadcast_keys
    tk = target.select(*keys)
    for i, k in enumerate(keys):
        lo, hi = stats[f"lo{i}"], stats[f"hi{i}"]
        dt = src.schema[k].dataType
        if lo is not None and _orderable(dt):
            in_range = F.col(k).between(_typed_lit(lo, dt), _typed_lit(hi, dt))
            tk = tk.where(in_range | F.col(k).isNull() if null_safe else in_range)
    if len(keys) == 1 and stats["rows"] <= in_list and not null_safe and isinstance(src.schema[keys[0]].dataType, (T.IntegralType, T.StringType)):
        named = [r[0] for r in keyed.select(keys[0]).distinct().collect()]   # in_list values at most
        tk = tk.where(F.col(keys[0]).isin(named)) if named else tk.where(F.lit(False))
    if not null_safe:  # NULL never equals anything: such target rows cannot match
        for k in keys:
            tk = tk.where(F.col(k).isNotNull())
    # shrink the target scan to this batch's keys before the anti-join
    reducer = F.broadcast(src_keys) if small else src_keys
    tk = (tk.alias("t").join(reducer.alias("s"), _key_condition("t", "s", keys, null_safe), "left_semi")
            .dropDuplicates())
    # past the bound the found keys are a table: the anti-join is then one of two
    # plain shuffles, in which Spark splits the batch rows of a hot key
    right = F.broadcast(tk) if small else _kept(tk)
    found = keyed.alias("src").join(right.alias("tk"), _key_condition("src", "tk", keys, null_safe), "left_anti")
    return found if null_safe else found.unionByName(src.where(no_key))


# ---------------------------------------------------------------- key ranges

RANGES_DIR = "_ranges"


def _ranged(dt: T.DataType) -> bool:
    return isinstance(dt, (T.IntegralType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType))


def _range_value(col: Column, dt: T.DataType) -> Column:
    """The key as a number or text that orders as it does."""
    if isinstance(dt, T.DateType):
        return F.unix_date(col)
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(col.cast("timestamp"))
    return col.cast("bigint") if isinstance(dt, T.IntegralType) else col


def _either(pick, a, b):
    return b if a is None else a if b is None else pick(a, b)


class KeyIndex:
    """Ranges of the merge keys in each batch of a table: small records beside the
    batches, read once when a writer starts and kept up to date by it.

    A merge opens only batches whose ranges meet the micro-batch's.  Batches
    without a record (written by others) are measured once, in one scan of
    their keys.  A fold of the table is noticed and read anew."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str]):
        self.path, self.keys = path.rstrip("/"), keys
        schema = stored_schema(spark, path)
        self.types = [schema[k].dataType for k in keys]
        self.folded: dict[str, int] | None = None
        self.ranges: dict[tuple[str, int], tuple[list, list]] = {}
        self.refresh(spark)

    def refresh(self, spark: SparkSession) -> None:
        folded = folds(spark, self.path)
        if folded == self.folded:
            return
        self.folded = folded
        fs = FS(spark, self.path)
        found: dict[tuple[str, int], tuple[list, list]] = {}
        if fs.exists(f"{self.path}/{RANGES_DIR}"):
            for r in spark.read.text(f"{self.path}/{RANGES_DIR}").collect():   # a line for each batch
                x = json.loads(r[0])
                if x["keys"] == self.keys:   # of an epoch that ran twice the wider range holds
                    lo, hi = found.get((x["stream"], x["batch"]), (x["lo"], x["hi"]))
                    found[x["stream"], x["batch"]] = [_either(min, a, b) for a, b in zip(lo, x["lo"])], [_either(max, a, b) for a, b in zip(hi, x["hi"])]
        seen = []
        for sid, folder in _stream_folders(spark, self.path).items():
            upto = folded.get(sid)
            for name, is_dir, _, _ in fs.list(folder):
                base = name.rsplit("/", 1)[-1]
                if is_dir and base.startswith(f"{BATCH_COL}="):
                    n = int(base.split("=", 1)[1])
                    if n >= 0 if upto is None else (n > upto or n == folded_id(upto)):
                        seen.append((sid, n))
        self.ranges = {b: found[b] for b in seen if b in found}
        new = [b for b in seen if b not in found]
        if new:
            self._measure(spark, new)

    def _aggs(self) -> list[Column]:
        return [f(_range_value(F.col(f"`{k}`"), t) if _ranged(t) else F.lit(None).cast("bigint")).alias(f"{n}{i}")
                for i, (k, t) in enumerate(zip(self.keys, self.types)) for n, f in (("lo", F.min), ("hi", F.max))]

    def _measure(self, spark: SparkSession, batches: list[tuple[str, int]]) -> None:
        wanted = spark.createDataFrame(batches, f"{STREAM_COL} string, {BATCH_COL} bigint")
        rows = read(spark, self.path).join(wanted, LAYOUT_COLS, "left_semi").groupBy(*LAYOUT_COLS).agg(*self._aggs()).collect()   # a row for each batch
        measured = {(r[STREAM_COL], r[BATCH_COL]): self._of(r) for r in rows}
        self.put(spark, {b: measured.get(b, ([None] * len(self.keys), [None] * len(self.keys))) for b in batches}, f"measured-{uuid.uuid4().hex}")

    def _of(self, row) -> tuple[list, list]:
        n = range(len(self.keys))
        return [row[f"lo{i}"] for i in n], [row[f"hi{i}"] for i in n]

    def put(self, spark: SparkSession, ranges: dict[tuple[str, int], tuple[list, list]], name: str) -> None:
        lines = [json.dumps({"stream": s, "batch": b, "keys": self.keys, "lo": lo, "hi": hi}) for (s, b), (lo, hi) in ranges.items()]
        FS(spark, self.path).write_text(f"{self.path}/{RANGES_DIR}/{name}.json", "\n".join(lines) + "\n")
        self.ranges.update(ranges)

    def candidates(self, lo: list, hi: list) -> list[tuple[str, int]]:
        """Batches that may hold a key between ``lo`` and ``hi``.  A batch without
        keys has none; a key column without a range may hold anything."""
        def meets(a: list, b: list) -> bool:
            for i, t in enumerate(self.types):
                if _ranged(t) and (a[i] is None or lo[i] is None or a[i] > hi[i] or b[i] < lo[i]):
                    return False
            return True
        return [k for k, (a, b) in self.ranges.items() if meets(a, b)]


def _prune_partitions(batch: DataFrame, target: DataFrame, pcols: list[str]) -> DataFrame:
    """Keep only target folders whose partition values lie in the batch's range
    of each partition column (or are NULL, if the batch has NULLs): a literal
    filter of fixed size, whatever the batch, that prunes folders before reading."""
    pcols = [c for c in pcols if _orderable(batch.schema[c].dataType)]
    if not pcols:
        return target
    seen = batch.agg(*[f(c).alias(f"{n}{i}") for i, c in enumerate(pcols) for n, f in (("lo", F.min), ("hi", F.max))],
                     *[F.coalesce(F.bool_or(F.col(c).isNull()), F.lit(False)).alias(f"null{i}") for i, c in enumerate(pcols)]).first()
    for i, c in enumerate(pcols):
        dt, cond = batch.schema[c].dataType, F.lit(False)
        if seen[f"lo{i}"] is not None:
            cond = F.col(c).between(_typed_lit(seen[f"lo{i}"], dt), _typed_lit(seen[f"hi{i}"], dt))
        target = target.where(cond | F.col(c).isNull() if seen[f"null{i}"] else cond)
    return target


def _typed_lit(v, dt: T.DataType) -> Column:
    if isinstance(dt, T.TimestampNTZType):   # wall clock: no time-zone round trip
        return F.lit(v.isoformat(" ")).cast(dt)
    return F.lit(v).cast(dt)


def _orderable(dt: T.DataType) -> bool:
    return isinstance(dt, (T.NumericType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType))


# a batch of at most so many rows names its keys to the target scan
IN_LIST = 1000
# candidate folders are read by path up to so many, else the whole table is listed
MAX_PATHS = 10_000


def merge_insert(batch: DataFrame, path: str, keys: list[str], *, stream_id: str,
                 batch_id: int, dedupe_source: bool = False, null_safe: bool = False,
                 broadcast_keys: int = DEFAULT_BROADCAST_KEYS,
                 evolve: bool = False, rows_per_file: int | None = None,
                 partition_follows_key: bool = False, index: KeyIndex | None = None) -> DataFrame:
    """Insert-only MERGE of one batch, replay-safe.

    A key is looked for in the whole target.  Only with ``partition_follows_key``
    (the caller states that a key's partition values never change) are the
    folders outside the batch's range of partition values left out.

    Reads the target without this writer's batches >= ``batch_id`` (so a
    replayed batch sees what it saw the first time), aligns the batch to the
    target schema (missing columns become typed NULLs; with ``evolve`` new
    batch columns widen the table instead of failing; types that may not fit are
    refused before anything runs), and writes the new rows as batch (stream_id,
    batch_id), with bloom filters on the keys.  Returns the inserted rows' frame
    (none for an epoch that was folded).  The batch is evaluated once (persisted
    here unless the caller did).

    With ``index`` (a ``KeyIndex`` of the table that the caller keeps from batch
    to batch; not for ``null_safe``) only batches whose key ranges meet the
    batch's are listed and opened, and the inserted rows' ranges are recorded.
    """
    spark = batch.sparkSession
    if 0 <= int(batch_id) <= folds(spark, path).get(str(stream_id), -1):
        return batch.limit(0)
    cached_here = not batch.is_cached
    source = batch.persist() if cached_here else batch
    try:
        with conf(spark, {"spark.sql.parquet.pushdown.inFilterThreshold": str(IN_LIST)}):
            return _merge_insert(source, path, keys, stream_id=stream_id, batch_id=batch_id,
                                 dedupe_source=dedupe_source, null_safe=null_safe,
                                 broadcast_keys=broadcast_keys, evolve=evolve, rows_per_file=rows_per_file,
                                 partition_follows_key=partition_follows_key, index=None if null_safe else index)
    finally:
        if cached_here:
            source.unpersist()


def _merge_insert(batch: DataFrame, path: str, keys: list[str], *, stream_id: str, batch_id: int,
                  dedupe_source: bool, null_safe: bool, broadcast_keys: int, evolve: bool,
                  rows_per_file: int | None, partition_follows_key: bool, index: KeyIndex | None) -> DataFrame:
    spark = batch.sparkSession
    target, stats = None, None
    if exists(spark, path):
        tschema = data_schema(spark, path)
        extra = [c for c in batch.columns if c not in tschema.fieldNames()]
        if extra and not evolve:
            raise ValueError(f"batch columns {extra} are not in the table; pass evolve=True to add them")
        if evolve:
            tschema = _widened(spark, path, tschema, batch.drop(*LAYOUT_COLS).schema)
        _check_types(batch.drop(*LAYOUT_COLS).schema, tschema)
        pcols = partition_cols(tschema)
        carried = all(c in batch.columns for c in pcols)   # before NULL-filling
        batch = align(batch, tschema)
        if index is not None:
            index.refresh(spark)
            seen = batch.agg(F.count(F.lit(1)).alias("rows"), *[f(k).alias(f"{n}{i}") for i, k in enumerate(keys) for n, f in (("lo", F.min), ("hi", F.max))],
                             *[c.alias(f"x{j}") for j, c in enumerate(index._aggs())]).first()
            stats = seen.asDict()
            at = [seen[f"x{j}"] for j in range(2 * len(keys))]
            some = [b for b in index.candidates(at[::2], at[1::2]) if not (b[0] == str(stream_id) and b[1] >= int(batch_id))]
            if len(some) <= MAX_PATHS:
                target = read_batches(spark, path, some) if some else None
            else:
                target = read(spark, path)
        else:
            target = read(spark, path)
        if target is not None:
            target = target.where(~((F.col(STREAM_COL) == str(stream_id)) & (F.col(BATCH_COL) >= int(batch_id))))
            if carried and partition_follows_key:
                target = _prune_partitions(batch, target, pcols)
    rows = new_rows(batch, target, keys, dedupe_source=dedupe_source, null_safe=null_safe,
                    broadcast_keys=broadcast_keys, stats=stats, in_list=IN_LIST)
    bloom = {f"parquet.bloom.filter.enabled#{k}": "true" for k in keys}
    if index is None:
        write_batch(rows, path, stream_id, batch_id, rows_per_file=rows_per_file, options=bloom)
        return rows
    measured = Observation()
    write_batch(rows.observe(measured, *index._aggs()), path, stream_id, batch_id, rows_per_file=rows_per_file, options=bloom)
    index.put(spark, {(str(stream_id), int(batch_id)): index._of(measured.get)}, f"{quote(str(stream_id), safe='')}-{int(batch_id)}")
    return rows


# ---------------------------------------------------------------- maintenance

def _predicate(pred: str | Column) -> Column:
    return F.expr(pred) if isinstance(pred, str) else pred


def _stream_folders(spark: SparkSession, path: str) -> dict[str, str]:
    """Writer -> its folder (one entry per writer); Spark escapes names on disk."""
    names = [name.rsplit("/", 1)[-1] for name, is_dir, _, _ in FS(spark, path).list(path) if is_dir]
    return {unquote(n.split("=", 1)[1]): f"{path.rstrip('/')}/{n}" for n in names if n.startswith(f"{STREAM_COL}=")}


def read_batches(spark: SparkSession, path: str, batches: Iterable[tuple[str, int]]) -> DataFrame:
    """Only the named batch folders: pruning by path, no join with a batch list."""
    streams = _stream_folders(spark, path)
    paths = [f"{streams[str(s)]}/{BATCH_COL}={int(b)}" for s, b in batches]
    stored = stored_schema(spark, path)
    reader = spark.read.option("basePath", path)
    if stored is not None:
        reader = reader.schema(_with_layout(stored))
    df = reader.parquet(*paths)
    return df.withColumn(STREAM_COL, F.col(STREAM_COL).cast("string")) \
             .withColumn(BATCH_COL, F.col(BATCH_COL).cast("bigint"))


def _folder(file_path: Column) -> Column:
    return F.regexp_extract(file_path, r"^(.*)/[^/]*$", 1)


def delete_where(spark: SparkSession, path: str, predicate: str | Column) -> int:
    """Delete rows matching ``predicate`` (SQL text or Column).

    Rows where the predicate is NULL are kept.  One pass counts the matches of
    each folder (a written table); only batches that hold one are read again and
    rewritten, found by a join on the partition columns that prunes the other
    folders; folders left empty are removed in tasks.  Re-running after a failure
    finishes the job.  Returns the number of rewritten batches.
    """
    hit = F.coalesce(_predicate(predicate), F.lit(False))
    t = read(spark, path)
    folders = _kept(t.select(*LAYOUT_COLS, _folder(F.col("_metadata.file_path")).alias("path"), hit.alias("_hit"))
                     .groupBy(*LAYOUT_COLS, "path").agg(F.count_if("_hit").alias("hits"), F.count(F.lit(1)).alias("rows")))
    touched = _kept(folders.where("hits > 0").select(*LAYOUT_COLS).distinct())
    n = touched.count()
    if n:
        (t.join(touched, LAYOUT_COLS, "left_semi").where(~hit).select(*t.columns)
          .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
          .partitionBy(*_parts(spark, path)).parquet(path))
        stuck = delete_files(folders.where("hits = rows").select("path")).where("NOT removed").agg(F.min("path")).first()[0]
        if stuck is not None:
            raise OSError(f"folder of deleted rows could not be removed: {stuck}")
    return n


# broadcast per-batch tables (one row per batch) only up to this many batches
MAX_BROADCAST_BATCHES = 1_000_000


# a task of a rewrite takes files of so many rows in all, and no more than so many files
TASK_ROWS, TASK_FILES = 1_000_000, 200

# a fold's files of so few rows are written by tasks themselves: opening a file through
# Hadoop costs more than its rows do
SMALL_FILE_ROWS = 20_000

# a rewrite's tasks move their own files into its staging folder, which becomes
# the batches at the end: the driver does not move them one by one
_REWRITE = {"partitionOverwriteMode": "dynamic", "mapreduce.fileoutputcommitter.algorithm.version": "2"}


def _files_per_task(rows_per_file: int) -> int:
    return max(1, min(TASK_FILES, TASK_ROWS // rows_per_file))


def compact(spark: SparkSession, path: str, *, rows_per_file: int = 1_000_000,
            batches: Iterable[tuple[str, int]] | None = None) -> int:
    """Rewrite batches into files of about ``rows_per_file`` rows.

    Each batch is split into ceil(rows / rows_per_file) salt groups by a hash
    of the whole row, and the data is range-partitioned on (batch, salt), so
    a very large batch is spread over many tasks.  A task takes ``_files_per_task``
    groups and cuts its rows into files of at most ``rows_per_file``: small files
    cost no task each.  The per-batch file counts (one row per partition folder)
    are broadcast when their number is within ``MAX_BROADCAST_BATCHES`` and
    joined by shuffle past it; the files are the same.  Returns the number of salt groups.
    """
    t = read_batches(spark, path, batches) if batches is not None else read(spark, path)
    parts_cols = _parts(spark, path)
    data_cols = [c for c in t.columns if c not in LAYOUT_COLS]
    # one row per partition folder, materialized once (reliable checkpoint)
    # so the totals and the join below do not scan the table again
    shared_dir(spark)
    counts = (t.groupBy(*parts_cols).agg(F.count(F.lit(1)).alias("_rows"))
               .withColumn("_files", F.greatest(F.lit(1), F.ceil(F.col("_rows") / rows_per_file)).cast("bigint"))
               .checkpoint(eager=True))
    totals = counts.agg(F.sum("_files").alias("files"), F.count(F.lit(1)).alias("batches")).first()
    if not totals["files"]:
        return 0
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in data_cols])
    parts = int(totals["files"])
    sizes = counts.select(*parts_cols, "_files")
    sizes = F.broadcast(sizes) if totals["batches"] <= MAX_BROADCAST_BATCHES else sizes
    salted = (t.alias("t").join(sizes.alias("c"), _key_condition("t", "c", parts_cols, True))
               .select("t.*", "c._files")
               .withColumn("_salt", F.pmod(row_hash, F.col("_files"))).drop("_files"))
    out = salted.repartitionByRange(-(-parts // _files_per_task(rows_per_file)), *parts_cols, "_salt").drop("_salt")
    (out.write.mode("overwrite").options(**_REWRITE)
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(*parts_cols).parquet(path))
    return parts


@dataclass(frozen=True)
class Folded:
    """What a fold did: the epoch folded through, and files read and written."""

    upto: int
    files_before: int
    files_after: int


def _file_count(df: DataFrame) -> int:
    """Files of ``df``, hundreds of small ones opened by a task."""
    with conf(df.sparkSession, {"spark.sql.files.openCostInBytes": str(256 * 1024)}):
        return df.select(F.col("_metadata.file_path").alias("f")).agg(F.count_distinct("f")).first()[0]


def _file_rows(df: DataFrame, pcols: list[str]) -> DataFrame:
    """The files of ``df`` with their rows and the rows in files before them, within
    each value of the partition columns: a short row per file, kept as it is read several times."""
    sizes = df.groupBy(*pcols, F.col("_metadata.file_path").alias("_file")).agg(F.count(F.lit(1)).alias("_rows"))
    return _kept(sizes.withColumn("_before", F.sum("_rows").over(Window.partitionBy(*pcols).orderBy("_file")) - F.col("_rows")).drop(*pcols))


def _numbered(df: DataFrame, places: DataFrame, pcols: list[str], cols: list[str], rows_per_file: int) -> DataFrame:
    """``cols`` of ``df``, a scan of whole files, with the number ``_run`` of each row's run of
    ``rows_per_file`` rows, spread over tasks that each get whole runs; only the last run of a partition value is shorter.
    The table of files is broadcast as far as ``MAX_BROADCAST_BATCHES`` of them."""
    seen = places.agg(F.sum("_rows").alias("rows"), F.count(F.lit(1)).alias("files")).first()
    tasks = max(1, -(-(seen["rows"] or 0) // (rows_per_file * _files_per_task(rows_per_file))))
    at = F.broadcast(places) if seen["files"] <= MAX_BROADCAST_BATCHES else places
    named = [f"`{c}`" for c in cols]
    rows = df.select(*named, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_at")) \
        .join(at, "_file").withColumn("_run", F.expr(f"(_before + _at) div {int(rows_per_file)}"))
    return rows.repartitionByRange(tasks, *pcols, "_run").select(*named, "_run")


def fold(spark: SparkSession, path: str, stream_id: str, *, upto: int | None = None, rows_per_file: int = 1_000_000,
         keys: list[str] | None = None, order_cols: list[str] | None = None) -> Folded:
    """Fold a writer's batches up to epoch ``upto`` (default: all it has) into one.

    The rows are numbered across the batches' folders (within each value of the
    table's partition columns) and cut into files of ``rows_per_file``, the last one
    shorter; a task writes ``_files_per_task`` of them.  They are
    written as one batch of a negative id, which no reader sees; files of up to
    ``SMALL_FILE_ROWS`` rows by ``operators.files.write_runs``.  Then
    ``_folds.json`` is replaced, which is the commit: from there on readers see
    the folded batch instead of its parts, and writes of folded epochs (replays)
    insert nothing.  A fold that fails before is written again by the next one.
    The parts stay for readers that run, until ``vacuum``.

    All rows are kept, but no longer know their epoch.  With ``keys`` only the
    latest version of each key is kept, by ``order_cols`` (default: the epoch),
    as update-mode tables need; a fold of such a table without ``keys`` would
    lose the order of versions that is in the batch ids alone.
    """
    sid = str(stream_id)
    folded = folds(spark, path)
    src = read(spark, path).where(F.col(STREAM_COL) == sid)
    last = src.agg(F.max(BATCH_COL)).first()[0]
    done = folded.get(sid, -1)
    upto = max(done, -1 if last is None else last) if upto is None else int(upto)
    if upto <= done:
        return Folded(done, 0, 0)
    if not keys and order_cols:
        raise ValueError("order_cols is for keys")
    src = src.where(F.col(BATCH_COL) <= upto)
    pcols = partition_cols(stored_schema(spark, path))
    places = _file_rows(src, pcols)
    before = places.count()
    cols = [c for c in src.columns if c not in LAYOUT_COLS]
    rows = src
    if keys:
        rows = _kept(latest_by_key(src.drop(STREAM_COL), keys, order_cols or [BATCH_COL]).select(*cols), pcols)
        places = _file_rows(rows, pcols)
    out = _numbered(rows, places, pcols, cols, rows_per_file)
    after = None
    if before and not pcols and rows_per_file <= SMALL_FILE_ROWS and writable(src.select(*[f"`{c}`" for c in cols]).schema):
        folder = f"{_stream_folders(spark, path)[sid]}/{BATCH_COL}={folded_id(upto)}"
        FS(spark, path).delete(folder)   # of a fold that failed: no reader sees it
        wrote = write_runs(out, folder, "_run").agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("files")).first()
        if wrote["rows"] != places.agg(F.sum("_rows")).first()[0]:
            raise OSError(f"{folder} holds {wrote['rows']} rows, which are not all")
        after = wrote["files"]
    else:
        (out.drop("_run").withColumn(STREAM_COL, F.lit(sid)).withColumn(BATCH_COL, F.lit(folded_id(upto)).cast("bigint"))
            .write.mode("overwrite").options(**_REWRITE).option("maxRecordsPerFile", rows_per_file)
            .partitionBy(*LAYOUT_COLS, *pcols).parquet(path))
    _commit(spark, path, FOLDS_FILE, json.dumps({**folded, sid: upto}))
    if after is None:
        after = _file_count(read(spark, path).where((F.col(STREAM_COL) == sid) & (F.col(BATCH_COL) == folded_id(upto))))
    return Folded(upto, before, after)


def _commit(spark: SparkSession, path: str, name: str, text: str) -> None:
    """Replace a small record: written beside it first, then renamed into place."""
    fs = FS(spark, path)
    target = f"{path.rstrip('/')}/{name}"
    fresh = f"{path.rstrip('/')}/_{uuid.uuid4().hex}"
    fs.write_text(fresh, text)
    fs.delete(target)
    if not fs.rename(fresh, target):
        raise OSError(f"{target} could not be written")


RECORDS = ("_SUCCESS", SCHEMA_FILE, FOLDS_FILE)


def vacuum(spark: SparkSession, path: str, *, retention_hours: float = 168.0,
           checkpoints: Iterable[str] = ()) -> DataFrame:
    """Remove what no visible batch references, once older than the retention:
    staging folders of jobs (``_temporary``, ``.spark-staging-*``; a folder goes
    when all in it is old), stray files, folded batches and empty folders.
    Returns what was removed (``path``), as a table in the shared folder.

    The tree is listed by tasks, one batch folder at a time, into a table; files
    without a live batch are an anti-join of it; tasks delete them.  The driver
    lists the writers' folders and no more.

    Refuses to run when a stream checkpoint lies inside the table, since
    such a folder is not table data and must not be cleaned.
    """
    norm = path.rstrip("/")
    for ck in checkpoints:
        if ck.rstrip("/").startswith(norm + "/"):
            raise ValueError(f"checkpoint {ck} lies inside table {path}; move it out first")
    cutoff_ms = int((time.time() - retention_hours * 3600.0) * 1000)
    tree = _kept(list_tree(spark, path).where(~F.col("relative").isin(*RECORDS) & ~F.col("relative").rlike(f"^{RANGES_DIR}(/|$)") & ~F.col("relative").rlike(r"^\.[^/]*\.crc$")))
    # names of the layout: stream, batch, what is below; a data file's checksum goes with it
    layout = r"^stream_id=([^/]*)/batch_id=(-?\d+)(/.*)?$"
    tree = tree.withColumn("batch", F.regexp_extract("relative", r"^(stream_id=[^/]*/batch_id=-?\d+)(/|$)", 1)) \
        .withColumn(STREAM_COL, F.expr("try_url_decode(replace(regexp_extract(relative, '^stream_id=([^/]*)/', 1), '+', '%2B'))")) \
        .withColumn(BATCH_COL, F.regexp_extract("relative", layout, 2).try_cast("bigint")) \
        .withColumn("data", F.col("relative").rlike(r"^stream_id=[^/]*/batch_id=-?\d+/([^/._][^/]*=[^/]*/)*(\.[^/]*\.parquet\.crc|[^/._][^/]*\.parquet)$") & ~F.col("is_dir")) \
        .withColumn("hidden", F.regexp_extract("relative", r"^((?:[^/]*/)*?[._][^/]*)(/|$)", 1))
    live = tree.where("data").where(_visible(folds(spark, path))).select("batch").distinct()
    kept = tree.where("data").join(live, "batch", "left_semi").select("path")
    loose = tree.where("NOT is_dir OR hidden <> ''").join(kept, "path", "left_anti")
    # a hidden tree is one unit, any other file is its own
    unit = F.when((F.col("hidden") != "") & ~F.col("data"), F.concat(F.lit(norm + "/"), "hidden")).otherwise(F.col("path"))
    dead = _kept(loose.withColumn("unit", unit).groupBy("unit").agg(F.max("modified").alias("modified"), F.max("data").alias("data"))
                      .where(F.col("modified") <= cutoff_ms).select(F.col("unit").alias("path"), "data"))
    gone = _kept(delete_files(dead.select("path")))
    # folders in which nothing is left
    stays = tree.withColumn("unit", unit).join(dead.select(F.col("path").alias("unit")), "unit", "left_anti") \
        .where((~F.col("is_dir")) | (F.col("modified") > cutoff_ms)).select("relative")
    above = stays.select(F.explode(F.expr("transform(sequence(1, size(split(relative, '/'))), n -> concat_ws('/', slice(split(relative, '/'), 1, n)))")).alias("relative")).distinct()
    empty = _kept(tree.where("is_dir AND hidden = ''").join(above, "relative", "left_anti").select("path"))
    swept = _kept(delete_files(empty))
    return _kept(gone.where("removed").unionByName(swept.where("removed")).select("path"))


def expire(spark: SparkSession, path: str, *, retention_hours: float = 168.0,
           checkpoints: Iterable[str] = ()) -> list[str]:
    """``vacuum``, with the removed paths as a list (for tables with few of them)."""
    return sorted(r.path for r in vacuum(spark, path, retention_hours=retention_hours, checkpoints=checkpoints).collect())


def as_of(spark: SparkSession, path: str, batch_id: int, *, stream_id: str | None = None) -> DataFrame:
    """The table as it stood after ``batch_id`` of ``stream_id`` (or of every
    writer): later batches are left out by partition pruning.  Exact for
    insert-only tables; after a delete or compaction the rewritten batches
    hold their current rows.  A batch that was folded with later ones can no
    longer be told apart and is refused."""
    late = [s for s, upto in folds(spark, path).items() if int(batch_id) < upto and stream_id in (None, s)]
    if late:
        raise ValueError(f"batches after {batch_id} of {late} are folded with earlier ones")
    t = read(spark, path)
    upto = F.col(BATCH_COL) <= int(batch_id)
    if stream_id is not None:
        upto = (F.col(STREAM_COL) != str(stream_id)) | upto
    return t.where(upto)


def replay(spark: SparkSession, path: str, *, from_batch: int = 0, stream_id: str | None = None,
           stream: bool = False, max_files_per_trigger: int | None = None) -> DataFrame:
    """Read the table back from a batch on, as a batch or a file stream."""
    if stream:
        schema = read(spark, path).schema
        reader = spark.readStream.schema(schema).option("basePath", path)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        df = reader.parquet(path)
    else:
        df = read(spark, path)
    df = df.where(F.col(BATCH_COL) >= from_batch)
    if stream_id is not None:
        df = df.where(F.col(STREAM_COL) == stream_id)
    return df
