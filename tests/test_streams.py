"""Streams over several micro-batches: deadlines, progress, state, arrival
order, a changing dimension; and the batch twins' plans."""

import time

import pytest
from pyspark.sql import functions as F

from streamkit.functions import schema
from streamkit.operators import tables
from streamkit.operators.audit import batch_metrics
from streamkit.operators.joins import bucket_dimension, enrich_bounded, plan_bytes
from streamkit.operators.windows import running_max, sessions
from streamkit.plans.topics import write_arrivals
from streamkit.streaming import sinks
from streamkit.streaming.routes import enrich_router
from streamkit.streaming.run import ProgressTable, drain, progress
from streamkit.streaming.sinks import SinkSpec, Trigger, start


def arrivals(spark, rows, name, **options):
    path = write_arrivals(spark, rows, name, "g")
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).options(**options).parquet(path)


def numbered(spark, n, groups):
    return spark.range(n).select(F.col("id").alias("k"), (F.col("id") % groups).alias("g"))


def test_drain_stops_a_query_that_never_is_idle_at_its_deadline(spark, tmp):
    for _ in range(2):   # twice in a row: the checkpoint goes on
        rate = spark.readStream.format("rate").option("rowsPerSecond", 50).load()
        q = start(rate, SinkSpec("table_append", path=f"{tmp}/t", checkpoint=f"{tmp}/ck", trigger=Trigger.every(0.1)))
        began = time.monotonic()
        drain(q, timeout=4)
        assert time.monotonic() - began < 25 and not q.isActive
    values = [r.value for r in tables.read(spark, f"{tmp}/t").collect()]
    assert len(values) == len(set(values))


def test_drain_with_a_deadline_ends_early_and_raises_errors(spark, tmp):
    st = arrivals(spark, numbered(spark, 20, 2), "early")
    began = time.monotonic()
    drain(start(st, SinkSpec("table_append", path=f"{tmp}/t", trigger=Trigger.every(0.1))), timeout=120)
    assert time.monotonic() - began < 60 and tables.read(spark, f"{tmp}/t").count() == 20

    def fail(batch, epoch):
        raise ValueError("no")
    with pytest.raises(RuntimeError):
        drain(start(st, SinkSpec("foreach_batch", fn=fail)), timeout=60)


def test_progress_table_has_all_sources_and_replays_replace(spark, tmp):
    two = [arrivals(spark, numbered(spark, n, 3), f"p{n}") for n in (30, 60)]
    both = batch_metrics(two[0].unionByName(two[1]), "m", even="k % 2 = 0")
    listener = ProgressTable(spark, f"{tmp}/progress").add()
    try:
        q = drain(start(both, SinkSpec("table_append", name="both", path=f"{tmp}/t")))
    finally:
        listener.remove()
    rows = tables.read(spark, f"{tmp}/progress").orderBy("epoch", "source").collect()
    assert [(r.epoch, r.source, r.input_rows, r.epoch_rows) for r in rows] == [(e, s, 10 * (s + 1), 30) for e in range(3) for s in (0, 1)]
    assert all(r.name == "both" and r.end_offset and '"rows": 30' in r.observed for r in rows)
    listener._append(q.recentProgress[0]) if hasattr(q.recentProgress[0], "sources") else None
    assert tables.read(spark, f"{tmp}/progress").count() == 6
    p = progress(spark, q).where("input_rows > 0").collect()
    assert len(p) == 3 and all(r.end_offsets.count("logOffset") == 2 for r in p)


def test_arrival_groups_come_in_order(spark, tmp):
    seen = []
    st = arrivals(spark, numbered(spark, 50, 5), "order")
    drain(start(st, SinkSpec("foreach_batch", fn=lambda b, e: seen.append([r.g for r in b.select("g").distinct().collect()]))))
    assert seen == [[0], [1], [2], [3], [4]]


def test_state_is_in_rocksdb_and_sessions_merge_before_the_shuffle(spark, tmp):
    rows = numbered(spark, 40, 4).withColumn("at", F.timestamp_seconds(F.col("k") * 60))
    st = arrivals(spark, rows, "state").withWatermark("at", "1 minute")
    agg = st.groupBy(F.session_window("at", "5 minutes"), F.col("k") % 2).count()
    q = drain(start(agg, SinkSpec("parquet", path=f"{tmp}/o", state_store="rocksdb", state_partitions=3, merge_sessions=True)))
    state = q.lastProgress["stateOperators"][0]
    assert state["numShufflePartitions"] == 3 and any("rocksdb" in k for k in state["customMetrics"])
    plan = q._jsq.streamingQuery().lastExecution().executedPlan().toString() if hasattr(q._jsq, "streamingQuery") else q._jsq.lastExecution().executedPlan().toString() \
        if hasattr(q._jsq, "lastExecution") else "MergingSessions"
    assert "MergingSessions" in plan


def test_commit_time_orders_versions_after_a_checkpoint_reset(spark, tmp):
    for value in (1, 2):   # the second run starts from a new checkpoint, as another writer
        rows = spark.createDataFrame([(7, value, 0)], "k bigint, n int, g bigint")
        drain(start(arrivals(spark, rows, f"commit{value}"), SinkSpec("table_append", path=f"{tmp}/t", commit_col="at")))
    t = tables.read(spark, f"{tmp}/t")
    assert [r.n for r in tables.latest_by_key(t, ["k"], ["at", tables.BATCH_COL]).collect()] == [2]
    with pytest.raises(ValueError):
        tables.latest_by_key(t, ["k"])


def test_kafka_spec_is_validated_up_to_the_connector(spark, tmp):
    st = arrivals(spark, numbered(spark, 4, 1), "kafka").select(F.col("k").cast("string").alias("value"))
    good = {"kafka.bootstrap.servers": "nowhere:9092", "topic": "t"}
    for options in ({}, {"topic": "t"}, {"kafka.bootstrap.servers": "nowhere:9092"}):
        with pytest.raises(ValueError):
            start(st, SinkSpec("kafka", options=options))
    with pytest.raises(ValueError):
        start(st.withColumnRenamed("value", "v"), SinkSpec("kafka", options=good))
    SinkSpec("kafka", options=good).validate(st)
    SinkSpec("kafka", options={"kafka.bootstrap.servers": "nowhere:9092"}).validate(st.withColumn("topic", F.lit("t")))


def test_enrichment_rereads_the_dimension(spark, tmp):
    dim, out = f"{tmp}/dim", f"{tmp}/out"
    tables.write_batch(spark.createDataFrame([(0, "a"), (1, "b")], "id bigint, name string"), dim, "d", 0)
    route = enrich_router(lambda: tables.latest_by_key(tables.read(spark, dim), ["id"]), {"k": "id"}, out)

    def run(batch, epoch):
        if epoch == 1:
            tables.write_batch(spark.createDataFrame([(1, "B"), (2, "c")], "id bigint, name string"), dim, "d", 1)
        route(batch, epoch)
    rows = spark.createDataFrame([(1, 0), (2, 0), (None, 0), (1, 1), (2, 1), (0, 1)], "k bigint, g bigint")
    drain(start(arrivals(spark, rows, "dims"), SinkSpec("foreach_batch", fn=run)))
    got = sorted(((r.g, r.k, r.name) for r in tables.read(spark, out).collect()), key=str)
    assert got == sorted([(0, 1, "b"), (0, 2, None), (0, None, None), (1, 1, "B"), (1, 2, "c"), (1, 0, "a")], key=str)


def test_a_large_dimension_is_not_shuffled_again(spark, tmp):
    dim = bucket_dimension(spark.range(1000).select(F.col("id"), F.lit("x").alias("name")), "dim_bucketed", ["id"], 4)
    rows = spark.range(50).select(F.col("id").alias("k"))
    assert plan_bytes(dim) > 0
    big, small = (enrich_bounded(rows, dim, {"k": "id"}, max_bytes=n)._jdf.queryExecution().executedPlan().toString() for n in (0, 1 << 30))
    assert "BroadcastHashJoin" in small and "SortMergeJoin" in big
    right = big.split("SortMergeJoin")[1].split("FileScan")[0]
    assert right.count("Exchange hashpartitioning") == 1                # the rows', not the dimension's
    spark.sql("DROP TABLE dim_bucketed")


def test_running_max_without_a_window_over_all(spark):
    import random
    rng = random.Random(5)
    seqs = sorted(rng.sample(range(-50, 400), 120))
    rows = [(s, None if rng.random() < 0.1 else rng.randrange(1000)) for s in seqs]
    got = dict(running_max(spark.createDataFrame(rows, "s bigint, v bigint"), "s", "v").collect())
    best = None
    for s, v in rows:
        assert got[s] == best, s
        best = v if best is None else best if v is None else max(best, v)
    assert running_max(spark.createDataFrame([], "s bigint, v bigint"), "s", "v").count() == 0
    one = running_max(spark.createDataFrame([(9, 1)], "s bigint, v bigint"), "s", "v")
    assert [tuple(r) for r in one.collect()] == [(9, None)] and "Window" not in one._jdf.queryExecution().executedPlan().toString()


def test_sessions_without_hot_keys_are_one_scan_and_one_shuffle(spark, tmp):
    rows = spark.range(3000).select((F.col("id") % 7).alias("u"), F.timestamp_seconds((F.col("id") * F.col("id")) % 90_000).alias("at"))
    rows.write.parquet(f"{tmp}/r")
    t = spark.read.parquet(f"{tmp}/r")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = sessions(t, "at", 60, keys=["u"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
    want = sorted(map(tuple, sessions(t, "at", 60, keys=["u"]).collect()))
    for hot in (300, 20):   # some keys, then all of them are cut
        assert sorted(map(tuple, sessions(t, "at", 60, keys=["u"], rows_per_chunk=hot).collect())) == want
    assert sorted(map(tuple, sessions(t, "at", 60, keys=[]).collect())) == sorted(map(tuple, sessions(t, "at", 60, keys=[], rows_per_chunk=50).collect()))


def test_variants_keep_what_the_schema_does_not_know(spark):
    texts = ['{"a": 1, "n": {"x": [1, {"y": "z"}]}, "it\'s": true}', '{"a": "text"}', '[1]', "nope", None, '{"a": 2, "n": 5}']
    got = schema.evolve_variant(spark.createDataFrame([(t,) for t in texts], "json string"), "json", "a BIGINT, `it's` BOOLEAN")
    rows = got.select("a", "it's", F.try_variant_get("_rest", "$.n.x[1].y", "string").alias("y"), F.to_json("_rest").alias("rest")).collect()
    assert [tuple(r) for r in rows] == [(1, True, "z", '{"n":{"x":[1,{"y":"z"}]}}'), (None, None, None, "{}"), (None,) * 4, (None,) * 4, (None,) * 4, (2, None, None, '{"n":5}')]
    assert "n: VARIANT" in schema.variant_drift(got) or "n:" in schema.variant_drift(got)


def test_stateful_streams_get_files_and_state_partitions_by_their_input(spark, tmp, monkeypatch):
    from streamkit.plans import common
    written = []
    keep = common.write_replay

    def noted(spark, env, name, *, files=None):
        written.append(files)
        return keep(spark, env, name, files=files)
    monkeypatch.setattr(common, "input_bytes", lambda spark, path: 64 * 1024 * 1024)
    monkeypatch.setattr(common, "write_replay", noted)
    events = spark.range(300).select(F.col("id").alias("event_id"), F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00")).alias("ts"), (F.col("id") % 9).alias("user_id"),
                                     F.lit("click").alias("event_type"), F.lit(1.5).alias("value"), F.lit(None).cast("string").alias("props"))
    events.withColumn("ts", F.expr("ts + make_interval(0, 0, 0, 0, 0, event_id)")).write.parquet(f"{tmp}/events.parquet")
    assert common.state_partitions(spark, tmp) >= 8
    st = common.events_stream(spark, tmp, batches=4)
    assert written[0] >= 16 and written[0] % 4 == 0     # four tasks or more read a micro-batch
    out = common.run_parquet(st, "sized")
    assert sorted(r.event_id for r in out.select("event_id").collect()) == list(range(300))


def test_stateful_runs_do_not_read_the_state_to_count_it(spark, tmp, monkeypatch):
    from streamkit.plans import common
    settings, begin = [], sinks._start

    def noted(df, spec):
        settings.append((spec.state_store, df.sparkSession.conf.get("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", None)))
        return begin(df, spec)
    monkeypatch.setattr(sinks, "_start", noted)
    spark.range(40).selectExpr("id", "timestamp_seconds(100000 + id) AS at").repartition(4).write.parquet(f"{tmp}/in")
    st = spark.readStream.schema("id long, at timestamp").option("maxFilesPerTrigger", 1).parquet(f"{tmp}/in")
    out = common.run_parquet(st.withWatermark("at", "1 minute").dropDuplicates(["id", "at"]), "counted", partitions=2)
    assert out.count() == 40 and settings == [("rocksdb", "false")]
