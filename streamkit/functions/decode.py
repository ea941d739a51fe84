"""Message decoding: envelope bytes -> text -> typed columns.

Everything here is a projection (no shuffle), stays inside whole-stage
codegen and works on batch and streaming DataFrames.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamkit.functions.schema import resolve_schema

CORRUPT_COL = "_corrupt_record"


def payload_text(df: DataFrame, col: str = "value", alias: str = "json_str") -> DataFrame:
    """``CAST(value AS STRING) AS json_str`` (bytes are read as UTF-8)."""
    return df.select(F.col(col).cast("string").alias(alias))


def parse_json(col: str | Column, schema, *, options: dict | None = None) -> Column:
    """``from_json`` in PERMISSIVE mode.

    Malformed text, JSON arrays and JSON ``null`` give a struct of NULLs; SQL
    NULL and the empty string give a NULL struct; unknown fields are dropped;
    a value that does not fit its field's type nulls only that field.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.from_json(c, resolve_schema(schema), options or {})


def json_events(df: DataFrame, schema, *, value_col: str = "value",
                keep: Iterable[str] = ()) -> DataFrame:
    """Decode envelope rows into the payload's typed columns (``data.*``).

    ``keep`` names envelope columns (e.g. ``partition``, ``offset``,
    ``timestamp``) carried next to the payload fields.
    """
    st = resolve_schema(schema)
    kept = [F.col(k) for k in keep]
    return (df.select(*kept, parse_json(F.col(value_col).cast("string"), st).alias("data"))
              .select(*[F.col(k) for k in keep], "data.*"))


def cast_timestamps(df: DataFrame, cols: Iterable[str], *, fmt: str | None = None,
                    ntz: bool = True) -> DataFrame:
    """String -> timestamp for each column; unparsable text becomes NULL
    (``try_to_timestamp``), as Spark 3.x's non-ANSI ``to_timestamp`` did.
    ``ntz`` keeps the wall clock without a time zone (``timestamp_ntz``)."""
    out = df
    for c in cols:
        parsed = F.try_to_timestamp(F.col(c), F.lit(fmt)) if fmt else F.try_to_timestamp(F.col(c))
        out = out.withColumn(c, parsed.cast("timestamp_ntz") if ntz else parsed)
    return out


def with_corrupt(df: DataFrame, schema, *, value_col: str = "value",
                 keep: Iterable[str] = ()) -> DataFrame:
    """Decode like ``json_events`` and add ``_corrupt_record`` (the raw text
    of messages that are not a JSON object of the schema) and ``_is_bad``.
    An object with a field of another type is bad here, field and all, while
    ``json_events`` keeps it with that field NULL."""
    st = resolve_schema(schema)
    with_col = T.StructType(st.fields + [T.StructField(CORRUPT_COL, T.StringType(), True)])
    text = F.col(value_col).cast("string")
    parsed = F.from_json(text, with_col, {"columnNameOfCorruptRecord": CORRUPT_COL})
    kept = [F.col(k) for k in keep]
    out = df.select(*kept, text.alias("_text"), parsed.alias("data"))
    bad = (F.col(f"data.{CORRUPT_COL}").isNotNull() | F.col("data").isNull()
           | (F.length(F.trim(F.col("_text"))) == 0))
    return (out.withColumn("_is_bad", F.coalesce(bad, F.lit(True)))
               .withColumn(CORRUPT_COL, F.when(F.col("_is_bad"), F.col("_text")))
               .select(*[F.col(k) for k in keep],
                       *[F.col(f"data.`{f.name}`").alias(f.name) for f in st.fields],
                       CORRUPT_COL, "_is_bad"))


def split_bad(df: DataFrame, schema, *, value_col: str = "value",
              keep: Iterable[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(good, bad): decoded rows, and undecodable messages set aside.

    Both outputs derive from one tagged frame; inside ``foreachBatch``
    persist ``with_corrupt`` and split that (``split_tagged``), so that each
    message is decoded once.
    """
    return split_tagged(with_corrupt(df, schema, value_col=value_col, keep=keep), schema, keep=keep)


def split_tagged(tagged: DataFrame, schema, *, keep: Iterable[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(good, bad) of a frame made by ``with_corrupt``."""
    st = resolve_schema(schema)
    good = tagged.where(~F.col("_is_bad")).select(*keep, *[f"`{f.name}`" for f in st.fields])
    bad = tagged.where(F.col("_is_bad")).select(*keep, F.col(CORRUPT_COL).alias("payload"))
    return good, bad
