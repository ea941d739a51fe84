import json

from pyspark.sql import types as T

from streamkit.functions import schema as S


def test_resolve_schema_forms(spark, tmp_path):
    st = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    assert S.resolve_schema(st) == st
    assert S.resolve_schema("a INT, b STRING") == st
    assert S.resolve_schema(st.json()) == st
    p = tmp_path / "schema.json"
    p.write_text(json.dumps(st.jsonValue()))
    assert S.resolve_schema(str(p), spark) == st


def test_diff_and_align_typed_nulls(spark):
    src = spark.createDataFrame([(1, "x")], "a int, extra string")
    target = T.StructType([T.StructField("a", T.LongType()), T.StructField("t", T.TimestampType()),
                           T.StructField("s", T.StringType())])
    d = S.diff(src, target)
    assert d.added == ["extra"] and d.missing == ["t", "s"] and d.retyped == [("a", "int", "bigint")]
    out = S.align(src, target)
    assert out.schema == T.StructType([T.StructField(f.name, f.dataType, True) for f in target.fields]) or \
        [f.dataType for f in out.schema.fields] == [T.LongType(), T.TimestampType(), T.StringType()]
    assert "void" not in out.schema.simpleString()


def test_widen():
    a = T.StructType([T.StructField("x", T.IntegerType()), T.StructField("y", T.StringType())])
    b = T.StructType([T.StructField("x", T.LongType()), T.StructField("z", T.DoubleType())])
    w = S.widen(a, b)
    assert [f.name for f in w.fields] == ["x", "y", "z"]
    assert w["x"].dataType == T.LongType()
    assert S.widen_type(T.IntegerType(), T.DoubleType()) == T.DoubleType()
    assert S.widen_type(T.IntegerType(), T.StringType()) == T.StringType()


def test_evolve_json_keeps_unknown_fields(spark):
    df = spark.createDataFrame([('{"a": 1, "b": "x", "new": 5}',), ('{"a": 2}',)], "j string")
    out = S.evolve_json(df, "j", "a INT").orderBy("a").collect()
    assert out[0].a == 1 and out[0]._rest == {"b": "x", "new": "5"}
    assert out[1]._rest == {}
    fields = {r.field: r.rows for r in S.unknown_fields(S.evolve_json(df, "j", "a INT")).collect()}
    assert fields == {"b": 1, "new": 1}


def test_align_rebuilds_nested_structs(spark):
    a = T.StructType.fromDDL("x INT, s STRUCT<a: INT, b: STRING>, l ARRAY<STRUCT<p: INT>>")
    b = T.StructType.fromDDL("x BIGINT, s STRUCT<a: BIGINT, c: DOUBLE>, l ARRAY<STRUCT<p: BIGINT, q: STRING>>")
    w = S.widen(a, b)
    assert w.simpleString() == ("struct<x:bigint,s:struct<a:bigint,b:string,c:double>,"
                                "l:array<struct<p:bigint,q:string>>>")
    df = spark.createDataFrame([(1, (2, "z"), [(3,)]), (2, None, None)], a)
    rows = S.align(df, w).orderBy("x").collect()
    assert rows[0].s.asDict() == {"a": 2, "b": "z", "c": None} and rows[0].l[0].asDict() == {"p": 3, "q": None}
    assert rows[1].s is None and rows[1].l is None            # a NULL struct stays NULL
