"""Listing, writing and deleting files of a folder in Spark tasks.

Tasks open the store through ``pyarrow.fs`` by URI (local, S3, GCS, HDFS), so
the driver neither lists files nor deletes them one by one.  Many small files are
written the same way: Hadoop's local file system starts a process (chmod) for every
file it creates."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from streamkit.session import FS

_FOUND = pa.schema([("path", pa.string()), ("relative", pa.string()), ("is_dir", pa.bool_()), ("modified", pa.int64())])
_SQL = "path string, relative string, is_dir boolean, modified long"


def uri(path: str) -> str:
    """``file:/x`` and plain paths as URIs that pyarrow reads."""
    if "://" in path:
        return path
    return "file://" + (path[len("file:"):] if path.startswith("file:") else path)


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    """The store and the path in it, taken as it stands: folder names hold escapes."""
    scheme, _, rest = uri(path).partition("://")
    authority, _, tail = rest.partition("/")
    system, top = pafs.FileSystem.from_uri(f"{scheme}://{authority}/")
    return system, f"{top.rstrip('/')}/{tail}"


def _entries(root: str, folder: str, recursive: bool) -> list[tuple]:
    """What lies below ``folder``; ``path`` begins with ``root`` as given."""
    _, top = _open(root)
    system, local = _open(folder)
    found = system.get_file_info(pafs.FileSelector(local, recursive=recursive, allow_not_found=True))
    top = top.rstrip("/")
    return [(f"{root.rstrip('/')}/{x.path[len(top) + 1:]}", x.path[len(top) + 1:], x.type == pafs.FileType.Directory, (x.mtime_ns or 0) // 1_000_000) for x in found]


def _list(root: str, recursive: bool, itself: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                rows = [tuple(row[c] for c in _FOUND.names)] if itself else []
                if row["is_dir"]:
                    rows += _entries(root, row["path"], recursive)
                for lo in range(0, len(rows), 10_000):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows[lo:lo + 10_000]), _FOUND)], schema=_FOUND)
    return run


def list_tree(spark: SparkSession, path: str, *, tasks: int | None = None) -> DataFrame:
    """(path, relative, is_dir, modified in ms) of all below ``path``, hidden
    entries too.  The driver lists the first level; tasks list the second, then
    each takes some of its folders with all that is below."""
    top = [(name, name.rsplit("/", 1)[-1], is_dir, modified) for name, is_dir, _, modified in FS(spark, path).list(path)]
    root = path.rstrip("/")
    top = [(f"{root}/{base}", base, is_dir, modified) for _, base, is_dir, modified in top]
    tasks = tasks or spark.sparkContext.defaultParallelism
    first = spark.createDataFrame(top, _SQL)
    if not top:
        return first
    second = first.where("is_dir").repartition(min(len(top), tasks)).mapInArrow(_list(root, False, False), _SQL)
    return first.unionByName(second.repartition(tasks, "path").mapInArrow(_list(root, True, True), _SQL))


def _delete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths = batch.column(0).to_pylist()
        done = []
        for path in paths:
            system, local = _open(path)
            info = system.get_file_info(local)
            if info.type == pafs.FileType.NotFound:  # Spark's file names are escaped
                system, local = _open(unquote(path))
                info = system.get_file_info(local)
            if info.type == pafs.FileType.Directory:
                system.delete_dir(local)
            elif info.type != pafs.FileType.NotFound:
                system.delete_file(local)
            done.append(system.get_file_info(local).type == pafs.FileType.NotFound)
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(done, pa.bool_())], names=["path", "removed"])


def delete_files(paths: DataFrame) -> DataFrame:
    """Deletes the files and folders (with all in them) named in ``path``, in
    tasks, when the result (path, removed) is evaluated.  What is gone already,
    also by an earlier attempt of a task, counts as removed."""
    spread = paths.select("path").distinct().repartition(paths.sparkSession.sparkContext.defaultParallelism, "path")
    return spread.mapInArrow(_delete, "path string, removed boolean")


_CODECS = {"snappy": "snappy", "zstd": "zstd", "gzip": "gzip", "none": "none", "uncompressed": "none"}
_LEAVES = (T.StringType, T.BinaryType, T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
           T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType)


def writable(dtype: T.DataType) -> bool:
    """True for types that pyarrow stores in Parquet as Spark does."""
    if isinstance(dtype, T.StructType):
        return bool(dtype.fields) and len(set(dtype.names)) == len(dtype.fields) and all(writable(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return writable(dtype.elementType)
    if isinstance(dtype, T.MapType):
        return writable(dtype.keyType) and writable(dtype.valueType)
    return isinstance(dtype, _LEAVES)


def _write(folder: str, codec: str, version: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq
        task = TaskContext.get().partitionId()
        system, top = _open(folder)
        system.create_dir(top, recursive=True)

        def store(number: int, parts: list[pa.RecordBatch]) -> tuple[str, int]:
            # readers take dates and times of files that name Spark's version as they stand
            whole = pa.Table.from_batches(parts).drop_columns(parts[0].schema.names[-1])
            whole = whole.replace_schema_metadata({"org.apache.spark.version": version})
            name = f"{top}/part-{task:05d}-{number:09d}.parquet"
            # a hidden name first: another attempt of the task puts the same rows in the same place
            fresh = f"{top}/.{uuid.uuid4().hex}"
            pq.write_table(whole, fresh, filesystem=system, compression=codec, store_schema=False)
            system.move(fresh, name)
            return name, whole.num_rows

        number, parts, done = None, [], []
        for batch in batches:
            runs = batch.column(batch.num_columns - 1).to_numpy()
            cuts = [0, *((runs[1:] != runs[:-1]).nonzero()[0] + 1).tolist(), len(runs)]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if hi == lo:
                    continue
                if parts and number != int(runs[lo]):
                    done.append(store(number, parts))
                    parts = []
                number = int(runs[lo])
                parts.append(batch.slice(lo, hi - lo))
        if parts:
            done.append(store(number, parts))
        yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())], names=["path", "rows"])
    return run


def write_runs(df: DataFrame, folder: str, run_col: str) -> DataFrame:
    """Writes the rows of ``df`` (types as in ``writable``) to Parquet files in
    ``folder``, one per value of its last column ``run_col``, when the result (path,
    rows; a row per file) is evaluated.  The rows of a run are in one partition of
    ``df`` and few enough for a task's memory.  A file is named after its
    task and run and moved into place whole, so a repeated task
    replaces its files; nothing marks the folder as complete."""
    spark = df.sparkSession
    codec = _CODECS.get(spark.conf.get("spark.sql.parquet.compression.codec", "snappy").lower(), "snappy")
    return df.sortWithinPartitions(run_col).mapInArrow(_write(folder, codec, spark.version), "path string, rows long")
