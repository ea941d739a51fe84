"""Session helpers: the shared work folder and Hadoop file-system access.

Every folder the library writes on its own behalf (stream checkpoints,
replayed topics, intermediate tables) lives under the folder the cluster
names in ``spark.checkpoint.dir``, which is shared by all executors.  A
folder of our own is made only when that setting is absent (local runs and
tests).
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Return the session's shared checkpoint folder, setting one if unset."""
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    local = tempfile.mkdtemp(prefix="streamkit-")  # unset: local/test session only
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir().rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared folder."""
    return f"{shared_dir(spark)}/streamkit/{name}-{uuid.uuid4().hex[:12]}"


def use_utc(spark: SparkSession) -> None:
    """Pin the session time zone: stored timestamps are UTC wall clock."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


@contextmanager
def conf(spark: SparkSession, values: dict[str, str]):
    """Session settings within a block."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


class FS:
    """Thin access to the Hadoop FileSystem that owns ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark.sparkContext._jvm
        self._jvm = jvm
        self._path_cls = jvm.org.apache.hadoop.fs.Path
        self.root = self._path_cls(path)
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.root.getFileSystem(conf)

    def p(self, path: str):
        return self._path_cls(path)

    def exists(self, path: str) -> bool:
        return bool(self.fs.exists(self.p(path)))

    def delete(self, path: str, recursive: bool = True) -> bool:
        return bool(self.fs.delete(self.p(path), recursive))

    def mkdirs(self, path: str) -> bool:
        return bool(self.fs.mkdirs(self.p(path)))

    def rename(self, src: str, dst: str) -> bool:
        return bool(self.fs.rename(self.p(src), self.p(dst)))

    def list(self, path: str) -> list[tuple[str, bool, int, int]]:
        """(path, is_dir, length, modification_ms) of the direct children."""
        if not self.exists(path):
            return []
        out = []
        for st in self.fs.listStatus(self.p(path)):
            out.append((st.getPath().toString(), bool(st.isDirectory()),
                        int(st.getLen()), int(st.getModificationTime())))
        return out

    def write_text(self, path: str, text: str) -> None:
        out = self.fs.create(self.p(path), True)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()

    def read_text(self, path: str) -> str:
        stream = self.fs.open(self.p(path))
        try:
            reader = self._jvm.java.io.BufferedReader(
                self._jvm.java.io.InputStreamReader(stream, "UTF-8"))
            lines = []
            line = reader.readLine()
            while line is not None:
                lines.append(line)
                line = reader.readLine()
            return "\n".join(lines)
        finally:
            stream.close()
