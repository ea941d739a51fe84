"""Schema resolution, comparison, alignment, widening and JSON evolution.

All functions work on batch and streaming DataFrames alike; they only look
at ``df.schema`` on the driver and build column expressions.
"""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def resolve_schema(spec, spark: SparkSession | None = None) -> T.StructType:
    """Accept a StructType, DDL text, JSON schema text, or a path to a JSON schema file."""
    if isinstance(spec, T.StructType):
        return spec
    if not isinstance(spec, str):
        raise TypeError(f"schema must be StructType or str, got {type(spec).__name__}")
    text = spec.strip()
    if text.startswith("{"):
        return T.StructType.fromJson(json.loads(text))
    looks_like_path = ("/" in text or text.endswith(".json")) and " " not in text
    if looks_like_path:
        if os.path.exists(text):
            with open(text, encoding="utf-8") as fh:
                return resolve_schema(fh.read(), spark)
        if spark is not None:
            from streamkit.session import FS
            return resolve_schema(FS(spark, text).read_text(text), spark)
        raise FileNotFoundError(text)
    dt = T.DataType.fromDDL(text)
    if not isinstance(dt, T.StructType):
        raise ValueError(f"not a struct DDL: {text!r}")
    return dt


@dataclass
class SchemaDiff:
    added: list[str] = field(default_factory=list)      # in source, not in target
    missing: list[str] = field(default_factory=list)    # in target, not in source
    retyped: list[tuple[str, str, str]] = field(default_factory=list)  # (name, source, target)

    @property
    def same(self) -> bool:
        return not (self.added or self.missing or self.retyped)


def diff(source: T.StructType | DataFrame, target: T.StructType | DataFrame) -> SchemaDiff:
    """Column-set and type difference between two schemas (names compared case-sensitively)."""
    s = source.schema if isinstance(source, DataFrame) else source
    t = target.schema if isinstance(target, DataFrame) else target
    sf = {f.name: f.dataType for f in s.fields}
    tf = {f.name: f.dataType for f in t.fields}
    out = SchemaDiff()
    out.added = [n for n in sf if n not in tf]
    out.missing = [n for n in tf if n not in sf]
    out.retyped = [(n, sf[n].simpleString(), tf[n].simpleString())
                   for n in sf if n in tf and sf[n] != tf[n]]
    return out


# The numeric widening order used by ``widen``.
_NUMERIC_ORDER = [T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType]


def widen_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type both values fit in; string as the last resort."""
    if a == b:
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(b, T.NullType):
        return a
    ka = next((i for i, k in enumerate(_NUMERIC_ORDER) if isinstance(a, k)), None)
    kb = next((i for i, k in enumerate(_NUMERIC_ORDER) if isinstance(b, k)), None)
    if ka is not None and kb is not None:
        return _NUMERIC_ORDER[max(ka, kb)]()
    if isinstance(a, T.DecimalType) and kb is not None or isinstance(b, T.DecimalType) and ka is not None:
        return T.DoubleType()
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        whole = max(a.precision - a.scale, b.precision - b.scale)
        return T.DecimalType(min(38, whole + scale), scale)
    stamps = (T.TimestampType, T.TimestampNTZType, T.DateType)
    if isinstance(a, stamps) and isinstance(b, stamps):
        if isinstance(a, T.TimestampType) or isinstance(b, T.TimestampType):
            return T.TimestampType()
        return T.TimestampNTZType()
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return widen(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widen_type(a.elementType, b.elementType), True)
    return T.StringType()


def widen(a: T.StructType, b: T.StructType) -> T.StructType:
    """Union of two struct schemas; shared fields take the widened type (a's order first)."""
    bf = {f.name: f for f in b.fields}
    fields = []
    for f in a.fields:
        if f.name in bf:
            fields.append(T.StructField(f.name, widen_type(f.dataType, bf[f.name].dataType), True))
        else:
            fields.append(T.StructField(f.name, f.dataType, True))
    seen = {f.name for f in a.fields}
    fields += [T.StructField(f.name, f.dataType, True) for f in b.fields if f.name not in seen]
    return T.StructType(fields)


def readable_as(old: T.DataType, new: T.DataType) -> bool:
    """True when parquet files written as ``old`` can be read as ``new``
    without losing a value; other changes of type need a rewrite."""
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        names = set(new.fieldNames())
        return all(f.name in names and readable_as(f.dataType, new[f.name].dataType) for f in old.fields)
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return readable_as(old.elementType, new.elementType)
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        return readable_as(old.keyType, new.keyType) and readable_as(old.valueType, new.valueType)
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        return new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale
    if old == new:
        return True
    whole = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
    if type(old) in whole and type(new) in whole:
        return whole.index(type(old)) <= whole.index(type(new))
    if isinstance(new, T.DoubleType):
        return isinstance(old, (T.ByteType, T.ShortType, T.IntegerType, T.FloatType))
    return False


def conform(c: Column, src: T.DataType, dst: T.DataType) -> Column:
    """Column ``c`` of type ``src`` reshaped to ``dst``: structs are rebuilt
    field by field (missing fields NULL, extra ones dropped, a NULL struct
    stays NULL), arrays of structs element by element, anything else cast."""
    if src == dst:
        return c
    if isinstance(src, T.StructType) and isinstance(dst, T.StructType):
        names = set(src.fieldNames())
        rebuilt = F.struct(*[
            (conform(c.getField(f.name), src[f.name].dataType, f.dataType) if f.name in names
             else F.lit(None).cast(f.dataType)).alias(f.name) for f in dst.fields])
        return F.when(c.isNull(), F.lit(None).cast(dst)).otherwise(rebuilt)
    if isinstance(src, T.ArrayType) and isinstance(dst, T.ArrayType) and \
            isinstance(src.elementType, T.StructType) and isinstance(dst.elementType, T.StructType):
        return F.transform(c, lambda e: conform(e, src.elementType, dst.elementType))
    return c.cast(dst)


def align(df: DataFrame, target: T.StructType | DataFrame, *, keep_extra: bool = False) -> DataFrame:
    """Shape ``df`` like ``target``: missing columns become typed NULLs, shared
    columns are cast to the target type, output follows the target's order.

    Unlike ``lit(None)`` alone (a ``void`` column that parquet would silently
    store), every filler carries the target column's type.
    """
    t = target.schema if isinstance(target, DataFrame) else target
    have = set(df.columns)
    cols: list[Column] = []
    for f in t.fields:
        if f.name in have:
            cols.append(conform(F.col(f"`{f.name}`"), df.schema[f.name].dataType, f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    if keep_extra:
        target_names = {f.name for f in t.fields}
        cols += [F.col(f"`{n}`") for n in df.columns if n not in target_names]
    return df.select(*cols)


def evolve_json(df: DataFrame, text_col: str, known: T.StructType | str, *,
                rest_col: str = "_rest") -> DataFrame:
    """Parse JSON text with the known schema and keep every unknown top-level
    field in a ``map<string,string>`` column, so new producer fields survive
    until the schema is widened.  Additive evolution: parse again with
    ``widen(known, new_fields)``.
    """
    schema = resolve_schema(known)
    known_names = F.array(*[F.lit(f.name) for f in schema.fields])
    as_map = F.from_json(F.col(text_col), T.MapType(T.StringType(), T.StringType()))
    parsed = F.from_json(F.col(text_col), schema)
    rest = F.map_filter(as_map, lambda k, v: ~F.array_contains(known_names, k))
    return df.select("*", parsed.alias("_parsed"), rest.alias(rest_col)) \
        .select(*[F.col(f"`{c}`") for c in df.columns], "_parsed.*", rest_col)


def evolve_variant(df: DataFrame, text_col: str, known: T.StructType | str, *,
                   rest_col: str = "_rest") -> DataFrame:
    """Parse JSON text once, to a variant: the known fields come out typed, all
    other top-level fields stay in the variant ``rest_col``, nested ones whole.

    Text that is no JSON object, and NULL, gives NULLs and a NULL rest; a known
    field of another type is NULL; a document of known fields alone has the rest
    ``{}``.  Widen the schema by what ``variant_drift`` shows and read again."""
    schema = resolve_schema(known)
    names = F.array(*[F.lit(f.name) for f in schema.fields])
    parsed = df.select("*", F.try_parse_json(F.col(f"`{text_col}`")).alias("_variant"))
    fields = F.try_variant_get(F.col("_variant"), "$", "map<string, variant>")
    rest = F.to_variant_object(F.map_filter(fields, lambda k, v: ~F.array_contains(names, k)))

    def field(f: T.StructField) -> Column:
        kind = f.dataType.simpleString()
        if "'" in f.name:   # paths have no escapes
            return F.try_variant_get(F.element_at(fields, F.lit(f.name)), "$", kind)
        return F.try_variant_get(F.col("_variant"), f"$['{f.name}']", kind)
    return parsed.select(*[F.col(f"`{c}`") for c in df.columns],
                         *[field(f).alias(f.name) for f in schema.fields],
                         rest.alias(rest_col))


def variant_drift(df: DataFrame, rest_col: str = "_rest") -> str | None:
    """The schema that holds every rest seen, as SQL text (one aggregate with
    map-side steps; the driver gets the text).  None if there is none."""
    return df.agg(F.schema_of_variant_agg(rest_col).alias("s")).first()["s"]


def unknown_fields(df: DataFrame, rest_col: str = "_rest") -> DataFrame:
    """Distinct unknown field names seen in ``rest_col`` with their row counts."""
    return (df.select(F.explode(F.map_keys(rest_col)).alias("field"))
              .groupBy("field").agg(F.count(F.lit(1)).alias("rows")))
