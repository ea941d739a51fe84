from pyspark.sql import functions as F

from streamkit.functions import decode, encode

DDL = "license STRING, base STRING, pu INT, pickup STRING"


def _payloads(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "v string").select(F.col("v").cast("binary").alias("value"))


def test_from_json_permissive_cases(spark):
    # fixed payloads and the outcome each must have
    texts = ['{"license":"HV1"}', '{"license":"HV1","extra":9}', "not json", None, "", "null",
             '[{"license":"A"}]', '{"license":"HV1","pu":"abc"}', '{"pu":"7"}', '{"pu":7.9}',
             '{"license":{"a":1}}']
    rows = decode.json_events(_payloads(spark, texts), DDL).collect()
    assert len(rows) == len(texts)                      # nothing is dropped
    got = [tuple(r) for r in rows]
    assert got[0] == ("HV1", None, None, None)
    assert got[1] == ("HV1", None, None, None)          # unknown field ignored
    assert got[2] == (None, None, None, None)           # malformed -> all NULL row
    assert got[3] == (None, None, None, None)           # SQL NULL
    assert got[4] == (None, None, None, None)           # empty string
    assert got[5] == (None, None, None, None)           # JSON null
    assert got[6] == (None, None, None, None)           # array
    assert got[8][2] is None and got[9][2] is None      # wrong number types null the field
    assert got[10][0] == '{"a":1}'                      # object in a string field -> JSON text


def test_split_bad_routes_undecodable(spark):
    texts = ['{"license":"HV1","pu":3}', "garbage", None, '{"pu":"abc"}', "[1,2]"]
    good, bad = decode.split_bad(_payloads(spark, texts), DDL)
    g = good.collect()
    assert [(r.license, r.pu) for r in g] == [("HV1", 3)]
    assert bad.count() == 4


def test_timestamp_round_trip_keeps_microseconds(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    msgs = ev.select(encode.json_payload(ev.columns).alias("value"))
    back = decode.cast_timestamps(decode.json_events(
        msgs, "event_id BIGINT, ts STRING, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"), ["ts"])
    assert back.exceptAll(ev).count() == 0 and ev.exceptAll(back).count() == 0


def test_cast_timestamps_bad_text_is_null(spark):
    df = spark.createDataFrame([("2025-01-01 00:00:01",), ("x",), (None,)], "t string")
    out = decode.cast_timestamps(df, ["t"]).collect()
    assert out[0].t is not None and out[1].t is None and out[2].t is None
