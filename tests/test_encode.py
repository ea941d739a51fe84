from pyspark.sql import functions as F

from streamkit.functions.encode import assign_offsets, envelope
from streamkit.sources.topic import offset_filter


def _brute_offsets(pdf, part, order):
    pdf = pdf.sort_values([part, *order])
    pdf["expect"] = pdf.groupby(part).cumcount()
    return pdf


def test_offsets_equal_row_number(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("p", F.pmod("user_id", F.lit(4)))
    got = assign_offsets(ev, "p", ["ts", "event_id"], slices=5).select("event_id", "offset").toPandas()
    want = _brute_offsets(ev.select("event_id", "p", "ts").toPandas(), "p", ["ts", "event_id"])
    m = got.merge(want, on="event_id")
    assert len(m) == 1000 and (m["offset"] == m["expect"]).all()


def test_offsets_with_one_hot_partition(spark):
    # one topic partition holds most rows: it is split across slices, offsets stay exact
    df = spark.range(3000).select(F.col("id"), F.when(F.col("id") % 10 == 0, 1).otherwise(0).alias("p"))
    got = assign_offsets(df, "p", ["id"], slices=6).toPandas()
    want = _brute_offsets(df.toPandas(), "p", ["id"])
    m = got.merge(want, on=["id", "p"])
    assert (m["offset"] == m["expect"]).all()


def test_offset_filter_spec(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    env = envelope(ev, "t", partition=F.pmod("user_id", F.lit(2)), order_cols=["ts", "event_id"])
    sizes = {r.partition: r["count"] for r in env.groupBy("partition").count().collect()}
    spec = '{"t": {"0": 10, "1": -1}}'
    out = offset_filter(env, spec, topic="t")
    assert out.count() == sizes[0] - 10
    assert offset_filter(env, "earliest", topic="t").count() == 1000
    assert offset_filter(env, "latest", topic="t").count() == 0
    assert offset_filter(env, '{"t": {"1": -2}}', topic="t").count() == sizes[1]


def test_kafka_source_reports_missing_connector(spark):
    from streamkit.sources.topic import read_topic
    try:
        df = read_topic(spark, "t", "a INT", bootstrap_servers="localhost:1")
    except RuntimeError as e:
        assert "connector" in str(e)
    else:   # connector present: the plan is a streaming decode of the topic
        assert df.isStreaming and df.columns == ["a"]


def test_replay_topic_stream_with_start_offsets(spark, tmp_path):
    from streamkit.sources.topic import replay_topic
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    env = envelope(ev, "t", partition=F.pmod("user_id", F.lit(2)), order_cols=["ts", "event_id"])
    env.write.parquet(str(tmp_path / "topic"))
    st = replay_topic(spark, str(tmp_path / "topic"), "t", "event_id BIGINT", stream=True,
                      starting_offsets='{"t": {"0": 5, "1": -2}}')
    q = st.writeStream.format("memory").queryName("replay_off").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.sql("select count(*) c from replay_off").first().c == 1000 - 5


def test_replay_layout_sizes_files_by_bytes():
    from streamkit.plans.topics import TARGET_FILE_BYTES, replay_layout
    assert replay_layout(10, None) == (1, None)
    assert replay_layout(10, 4) == (4, 1)
    files, per_batch = replay_layout(100 * TARGET_FILE_BYTES, 10)     # ~100 splits, 10 micro-batches
    assert (files, per_batch) == (100, 10)
    files, per_batch = replay_layout(10**14, None)                        # 100 TB, one micro-batch
    assert per_batch is None and files == -(-10**14 // TARGET_FILE_BYTES)
