"""Physical-plan checks for the properties that matter at scale."""

from contextlib import contextmanager

from pyspark.sql import functions as F

from streamkit.operators import tables
from streamkit.operators.joins import join_interval, join_windowed
from streamkit.operators.windows import sessions


@contextmanager
def conf(spark, **kv):
    keys = {k.replace("__", "."): v for k, v in kv.items()}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_merge_pushes_key_range_to_target_scan(spark, tmp):
    path = f"{tmp}/t"
    tables.overwrite(spark.range(0, 10000).select(F.col("id").alias("k"), F.lit("x").alias("v")), path)
    batch = spark.range(9990, 10010).select(F.col("id").alias("k"), F.lit("y").alias("v"))
    rows = tables.new_rows(batch, tables.read(spark, path), ["k"])
    p = plan(rows)
    assert "GreaterThanOrEqual(k,9990)" in p and "LessThanOrEqual(k,10009)" in p
    assert "ReadSchema: struct<k:bigint>" in p            # only the key column of the target
    assert sorted(r.k for r in rows.collect()) == list(range(10000, 10010))


def test_interval_join_keys_on_time_bucket(spark):
    df = spark.range(100).select(F.col("id"), (F.col("id") % 3).alias("u"),
                                 F.timestamp_seconds(F.col("id") * 60).alias("ts"))
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false"):
        j = join_interval(df, df, keys=["u"], left_time="ts", right_time="ts", lower_seconds=0, upper_seconds=600)
        p = plan(j)
    assert "SortMergeJoin [u" in p and "_bucket" in p.split("SortMergeJoin")[1].split("\n")[0]


def test_window_join_reuses_aggregate_partitioning(spark):
    df = spark.range(1000).select(F.timestamp_seconds(F.col("id") * 37).alias("ts"), (F.col("id") % 2).alias("side"))
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false"):
        j = join_windowed(df.where("side = 0"), df.where("side = 1"), left_time="ts", right_time="ts",
                          size="5 minutes", left_aggs=[F.count(F.lit(1)).alias("a")],
                          right_aggs=[F.count(F.lit(1)).alias("b")])
        p = plan(j)
    assert "SortMergeJoin" in p
    assert p.count("Exchange hashpartitioning") == 2       # one per aggregate, none added by the join


def test_sessions_broadcast_hot_key_table(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("u"),
                                  F.timestamp_seconds(F.col("id") * 13).alias("ts"))
    with conf(spark, spark__sql__adaptive__enabled="false", spark__sql__autoBroadcastJoinThreshold="-1"):
        s = sessions(df, "ts", 600, keys=["u"], rows_per_chunk=100)
        p = plan(s)
    assert "BroadcastNestedLoopJoin" not in p and "BroadcastHashJoin" in p
    assert s.agg(F.sum("events")).first()[0] == 5000


def test_windowed_aggregate_is_partial_before_shuffle(spark):
    from streamkit.operators.windows import window_agg
    df = spark.range(1000).select(F.timestamp_seconds(F.col("id") * 7).alias("ts"), F.col("id").alias("v"))
    p = plan(window_agg(df, "ts", "15 minutes", [F.max("v").alias("m")]))
    assert "partial_max" in p


def test_read_table_prunes_columns_and_pushes_filters(spark):
    from streamkit.sources.files import read_table
    df = read_table(spark, "/root/testdata/sf0.001/events.parquet", columns=["event_id", "value"]) \
        .where(F.col("value") > 100)
    p = plan(df)
    assert "ReadSchema: struct<event_id:bigint,value:double>" in p
    assert "GreaterThan(value,100" in p


def test_audit_counts(spark):
    from streamkit.operators import audit
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    one = audit.count_where(ev, "event_type IN ('click', 'purchase')").first().cnt
    both = audit.counts(ev, clicks="event_type = 'click'", buys=F.col("event_type") == "purchase").first()
    assert both.total == 1000 and both.clicks + both.buys == one
    assert audit.delta_count(3, 5) == {"before": 3, "after": 5, "delta": 2}


def test_as_of_prunes_later_batches(spark, tmp_path):
    from streamkit.operators import tables
    path = str(tmp_path / "t")
    for b in range(4):
        tables.write_batch(spark.range(b * 10, b * 10 + 10).withColumnRenamed("id", "k"), path, "s", b)
    df = tables.as_of(spark, path, 1, stream_id="s")
    assert sorted(r.k for r in df.collect()) == list(range(20))
    p = plan(df)
    assert "PartitionFilters: [" in p and "batch_id" in p.split("PartitionFilters: [")[1].split("]")[0]
