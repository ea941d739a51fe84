"""File and table scans, batch and streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from streamkit.functions.schema import resolve_schema


def read_table(spark: SparkSession, path: str, *, format: str = "parquet",
               schema=None, columns: list[str] | None = None,
               options: dict | None = None) -> DataFrame:
    """Batch scan; ``columns`` prunes the scan (see ``ReadSchema`` in the plan)."""
    reader = spark.read.format(format)
    if schema is not None:
        reader = reader.schema(resolve_schema(schema))
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    df = reader.load(path)
    return df.select(*columns) if columns else df


def stream_files(spark: SparkSession, path: str, *, format: str = "json", schema=None,
                 max_files_per_trigger: int | None = None,
                 options: dict | None = None) -> DataFrame:
    """File stream.  Without ``schema`` the files' schema is inferred once at
    start, which Spark allows only with ``spark.sql.streaming.schemaInference``."""
    reader = spark.readStream.format(format)
    if schema is not None:
        reader = reader.schema(resolve_schema(schema))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    if schema is not None:
        return reader.load(path)
    key = "spark.sql.streaming.schemaInference"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")           # read once, when the stream is defined
    try:
        return reader.load(path)
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def stream_file(spark: SparkSession, file_path: str, *, format: str = "parquet", schema=None,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """File stream over one table file (the file source lists folders or
    globs; a glob matching exactly this file is used)."""
    path = file_path.rstrip("/")
    glob = f"{path[:-1]}[{path[-1]}]"
    if schema is None:
        schema = spark.read.format(format).load(path).schema
    return stream_files(spark, glob, format=format, schema=schema,
                        max_files_per_trigger=max_files_per_trigger)
