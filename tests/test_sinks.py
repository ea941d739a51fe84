import os

import pytest
from pyspark.sql import functions as F

from streamkit.operators import tables
from streamkit.streaming import run
from streamkit.streaming.sinks import SinkSpec, Trigger, start


def _stream(spark, path):
    return spark.readStream.schema("k bigint, v string").parquet(path)


def test_spec_validation(spark, tmp):
    os.makedirs(f"{tmp}/in")
    df = _stream(spark, f"{tmp}/in")
    bad = [SinkSpec("nowhere"),                                                  # unknown sink
           SinkSpec("parquet"),                                                  # no path
           SinkSpec("parquet", path=f"{tmp}/o", mode="update"),                  # file sink: append only
           SinkSpec("parquet", path=f"{tmp}/o", trigger=Trigger.continuous()),   # continuous: no file sink
           SinkSpec("table_merge", path=f"{tmp}/o"),                             # no keys
           SinkSpec("table_merge", path=f"{tmp}/o", keys=["vendor_id"]),         # unknown key
           SinkSpec("memory"),                                                   # unnamed table
           SinkSpec("parquet", path=f"{tmp}/o", checkpoint=f"{tmp}/o/_ck"),      # checkpoint inside table
           SinkSpec("console", mode="sideways")]
    for spec in bad:
        with pytest.raises(ValueError):
            start(df, spec)
    with pytest.raises(ValueError):
        Trigger.parse("sometimes")
    assert Trigger.parse("processingTime", 5).kwargs() == {"processingTime": "5 seconds"}
    assert Trigger.parse("once").kwargs() == {"once": True}


def _write(spark, path, rows):
    spark.createDataFrame(rows, "k bigint, v string").coalesce(1).write.mode("append").parquet(path)


def test_memory_and_parquet_sinks(spark, tmp):
    _write(spark, f"{tmp}/in", [(1, "a"), (2, "b")])
    q = start(_stream(spark, f"{tmp}/in"), SinkSpec("memory", name="mem_t", trigger=Trigger.once()))
    run.drain(q)
    assert spark.sql("select count(*) c from mem_t").first().c == 2
    q = start(_stream(spark, f"{tmp}/in"), SinkSpec("parquet", path=f"{tmp}/out", checkpoint=f"{tmp}/ck"))
    run.drain(q)
    assert spark.read.parquet(f"{tmp}/out").count() == 2
    p = run.progress(spark, q).collect()
    assert p and p[0].input_rows == 2


def test_merge_sink_restart_and_fresh_checkpoint(spark, tmp):
    src, out = f"{tmp}/in", f"{tmp}/table"
    tables.overwrite(spark.createDataFrame([(1, "old")], "k bigint, v string"), out)
    _write(spark, src, [(1, "new"), (2, "b")])
    spec = SinkSpec("table_merge", path=out, keys=["k"], checkpoint=f"{tmp}/ck1")
    run.drain(start(_stream(spark, src), spec))
    _write(spark, src, [(3, "c"), (2, "again")])
    run.drain(start(_stream(spark, src), spec))              # restart: only the new file
    got = sorted((r.k, r.v) for r in tables.read(spark, out).collect())
    assert got == [(1, "old"), (2, "b"), (3, "c")]
    # a brand-new checkpoint re-reads everything: the merge keeps the table unchanged
    run.drain(start(_stream(spark, src), SinkSpec("table_merge", path=out, keys=["k"], checkpoint=f"{tmp}/ck2")))
    assert sorted((r.k, r.v) for r in tables.read(spark, out).collect()) == got


def test_append_sink_and_foreach_batch(spark, tmp):
    _write(spark, f"{tmp}/in", [(1, "a")])
    _write(spark, f"{tmp}/in", [(2, "b")])
    st = spark.readStream.schema("k bigint, v string").option("maxFilesPerTrigger", 1).parquet(f"{tmp}/in")
    run.drain(start(st, SinkSpec("table_append", path=f"{tmp}/t")))
    assert sorted(r.k for r in tables.read(spark, f"{tmp}/t").collect()) == [1, 2]
    assert tables.history(spark, f"{tmp}/t").count() == 2
    seen = []
    run.drain(start(_stream(spark, f"{tmp}/in"), SinkSpec("foreach_batch", fn=lambda df, e: seen.append(df.count()))))
    assert sum(seen) == 2


def test_replay_table_as_stream(spark, tmp):
    tables.write_batch(spark.createDataFrame([(1, "a")], "k bigint, v string"), f"{tmp}/t", "s", 0)
    tables.write_batch(spark.createDataFrame([(2, "b")], "k bigint, v string"), f"{tmp}/t", "s", 1)
    st = tables.replay(spark, f"{tmp}/t", from_batch=1, stream=True)
    run.drain(start(st, SinkSpec("memory", name="replayed", trigger=Trigger.available_now())))
    assert [r.k for r in spark.sql("select k from replayed").collect()] == [2]
    assert tables.replay(spark, f"{tmp}/t", from_batch=0).count() == 2


def test_rate_source_processing_time_to_memory(spark):
    from streamkit.sources.generators import rate_events
    st = rate_events(spark, "temperatures", 50, num_partitions=2)
    q = start(st, SinkSpec("memory", name="rate_mem", trigger=Trigger.every(0.5)))
    import time
    time.sleep(3)
    run.drain(q)
    rows = spark.sql("select * from rate_mem").collect()
    assert rows and all(1 <= r.locationId <= 265 for r in rows)


def test_failure_in_batch_function_propagates(spark, tmp):
    _write(spark, f"{tmp}/in", [(1, "a")])

    def boom(df, epoch):
        raise RuntimeError("merge failed")
    q = start(_stream(spark, f"{tmp}/in"), SinkSpec("foreach_batch", fn=boom))
    with pytest.raises(Exception):
        run.drain(q)


def test_observed_metrics_reach_progress(spark, tmp):
    from streamkit.operators.audit import batch_metrics
    _write(spark, f"{tmp}/in", [(1, "a"), (2, "b"), (3, "a")])
    st = batch_metrics(_stream(spark, f"{tmp}/in"), "in_rows", a_rows="v = 'a'")
    q = start(st, SinkSpec("parquet", path=f"{tmp}/out"))
    run.drain(q)
    import json
    seen = [json.loads(r.observed) for r in run.progress(spark, q).collect()]
    assert any(m.get("in_rows", {}).get("rows") == 3 and m["in_rows"]["a_rows"] == 2 for m in seen)


def test_console_sink_and_continuous_trigger(spark, tmp):
    _write(spark, f"{tmp}/in", [(1, "a")])
    run.drain(start(_stream(spark, f"{tmp}/in"), SinkSpec("console", trigger=Trigger.once())))
    rate = spark.readStream.format("rate").option("rowsPerSecond", 20).load()
    q = start(rate, SinkSpec("memory", name="cont_mem", trigger=Trigger.continuous("1 second")))
    import time
    time.sleep(4)
    q.stop()
    assert spark.sql("select count(*) c from cont_mem").first().c > 0


def test_quarantine_router_splits_messages(spark, tmp):
    from streamkit.streaming.routes import quarantine_router
    rows = [('{"k": 1, "v": "a"}',), ("oops",), ('{"k": 2}',), ("",)]
    spark.createDataFrame(rows, "t string").select(F.col("t").cast("binary").alias("value")) \
        .write.parquet(f"{tmp}/msgs")
    st = spark.readStream.schema("value binary").parquet(f"{tmp}/msgs")
    run.drain(start(st, SinkSpec("foreach_batch", fn=quarantine_router(f"{tmp}/good", f"{tmp}/bad", "k INT, v STRING"))))
    assert sorted(r.k for r in tables.read(spark, f"{tmp}/good").collect()) == [1, 2]
    assert sorted(r.payload for r in tables.read(spark, f"{tmp}/bad").collect()) == ["", "oops"]


def test_rocksdb_state_store_dedupe(spark, tmp):
    from streamkit.operators.dedupe import dedupe
    rows = [(i % 7, f"2025-01-01 00:0{i % 10}:00") for i in range(40)]
    spark.createDataFrame(rows, "k bigint, ts string").withColumn("ts", F.to_timestamp("ts")) \
        .write.parquet(f"{tmp}/in")
    st = spark.readStream.schema("k bigint, ts timestamp").parquet(f"{tmp}/in")
    q = start(dedupe(st, ["k"], time_col="ts", delay="1 hour"),
              SinkSpec("parquet", path=f"{tmp}/out", state_store="rocksdb", state_partitions=3))
    run.drain(q)
    assert sorted(r.k for r in spark.read.parquet(f"{tmp}/out").collect()) == list(range(7))
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"      # session setting restored


def test_crash_after_write_then_restart_leaves_table_exact(spark, tmp):
    """Epoch 1 fails after its merge was written (no commit); the restart
    replays epoch 1 under the same query id, overwriting its own batch."""
    from streamkit.streaming.sinks import stream_id
    src, out, ck = f"{tmp}/in", f"{tmp}/table", f"{tmp}/ck"
    for part in ([(1, "a"), (2, "b")], [(2, "x"), (3, "c"), (None, "n")], [(4, "d")]):
        _write(spark, src, part)
    tables.overwrite(spark.createDataFrame([(1, "old")], "k bigint, v string"), out)
    qid = stream_id()
    state = {"crash": True}

    def merge_then_maybe_crash(batch, epoch):
        tables.merge_insert(batch, out, ["k"], stream_id=qid(batch), batch_id=epoch)
        if epoch == 1 and state["crash"]:
            state["crash"] = False
            raise RuntimeError("executor lost after write")

    st = spark.readStream.schema("k bigint, v string").option("maxFilesPerTrigger", 1).parquet(src)
    spec = SinkSpec("foreach_batch", fn=merge_then_maybe_crash, checkpoint=ck)
    with pytest.raises(Exception):
        run.drain(start(st, spec))
    run.drain(start(st, spec))
    got = sorted(((r.k if r.k is not None else -1), r.v) for r in tables.read(spark, out).collect())
    assert got == [(-1, "n"), (1, "old"), (2, "b"), (3, "c"), (4, "d")]


def test_schema_evolution_stop_widen_restart(spark, tmp):
    """A running query's schema is fixed: stop it, widen the read schema,
    restart from the same checkpoint; the table gains the column."""
    import json as _json
    src, out, ck = f"{tmp}/in", f"{tmp}/t", f"{tmp}/ck"
    os.makedirs(src)
    with open(f"{src}/a.json", "w") as fh:
        fh.write(_json.dumps({"k": 1}) + "\n")
    v1 = spark.readStream.schema("k bigint").json(src)
    run.drain(start(v1, SinkSpec("table_append", path=out, checkpoint=ck)))
    with open(f"{src}/b.json", "w") as fh:
        fh.write(_json.dumps({"k": 2, "note": "new"}) + "\n")
    from streamkit.functions.schema import widen
    from pyspark.sql import types as T
    v2 = spark.readStream.schema(widen(T.StructType.fromDDL("k bigint"), T.StructType.fromDDL("note string"))).json(src)
    with pytest.raises(Exception):
        run.drain(start(v2, SinkSpec("table_append", path=out, checkpoint=ck)))   # not allowed silently
    run.drain(start(v2, SinkSpec("table_append", path=out, checkpoint=ck, evolve=True)))
    got = sorted((r.k, r.note) for r in tables.read(spark, out).collect())
    assert got == [(1, None), (2, "new")]


def test_progress_of_idle_query_is_empty_frame(spark, tmp):
    os.makedirs(f"{tmp}/empty")
    q = start(_stream(spark, f"{tmp}/empty"), SinkSpec("memory", name="idle_q", trigger=Trigger.once()))
    run.drain(q)
    p = run.progress(spark, q)
    assert "batch_id" in p.columns and p.where("input_rows > 0").count() == 0


def test_table_sinks_cap_rows_per_file(spark, tmp):
    spark.range(100).select(F.col("id").alias("k"), F.lit("v").alias("v")).coalesce(1).write.parquet(f"{tmp}/in")
    run.drain(start(_stream(spark, f"{tmp}/in"), SinkSpec("table_append", path=f"{tmp}/a", rows_per_file=30)))
    run.drain(start(_stream(spark, f"{tmp}/in"), SinkSpec("table_merge", path=f"{tmp}/m", keys=["k"], rows_per_file=30)))
    for t in ("a", "m"):
        files = [f for _, _, fs in os.walk(f"{tmp}/{t}") for f in fs if f.endswith(".parquet")]
        assert len(files) >= 4 and tables.read(spark, f"{tmp}/{t}").count() == 100
