import random

from pyspark.sql import functions as F

from streamkit.operators.joins import enrich, fits, join_interval, join_windowed


def _events(spark, n, seed):
    rnd = random.Random(seed)
    rows = [(i, 0 if i % 3 == 0 else rnd.randint(1, 15), rnd.randint(0, 5 * 86400)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id long, user long, t long").withColumn("ts", F.timestamp_seconds("t"))


def test_interval_join_matches_brute_force_with_hot_key(spark):
    lrows, left = _events(spark, 600, 1)
    rrows, right = _events(spark, 700, 2)
    lo, hi = -1800, 7200
    got = join_interval(left.drop("t"), right.drop("t"), keys=["user"], left_time="ts", right_time="ts",
                        lower_seconds=lo, upper_seconds=hi).select("l_id", "r_id").collect()
    want = sorted((a[0], b[0]) for a in lrows for b in rrows if a[1] == b[1] and a[2] + lo <= b[2] <= a[2] + hi)
    assert sorted((r.l_id, r.r_id) for r in got) == want
    # smaller buckets: more copies per left row, same pairs
    got2 = join_interval(left.drop("t"), right.drop("t"), keys=["user"], left_time="ts", right_time="ts",
                         lower_seconds=lo, upper_seconds=hi, bucket_seconds=1000).select("l_id", "r_id").collect()
    assert sorted((r.l_id, r.r_id) for r in got2) == want


def test_interval_left_join_keeps_lonely_rows(spark):
    lrows, left = _events(spark, 200, 3)
    rrows, right = _events(spark, 50, 4)
    got = join_interval(left.drop("t"), right.drop("t"), keys=["user"], left_time="ts", right_time="ts",
                        lower_seconds=0, upper_seconds=3600, how="left").select("l_id", "r_id").collect()
    pairs = [(a[0], b[0]) for a in lrows for b in rrows if a[1] == b[1] and a[2] <= b[2] <= a[2] + 3600]
    matched = {p[0] for p in pairs}
    want = sorted(pairs + [(a[0], None) for a in lrows if a[0] not in matched], key=lambda x: (x[0], x[1] or -1))
    assert sorted(((r.l_id, r.r_id) for r in got), key=lambda x: (x[0], x[1] or -1)) == want


def test_enrich_broadcasts_only_checked_small_dims(spark):
    facts = spark.range(1000).select(F.col("id"), (F.col("id") % 10).alias("k"))
    dim = spark.range(10).select(F.col("id").alias("k"), (F.col("id") * 100).alias("label"))
    assert fits(dim, 10) and not fits(dim, 9)
    small = enrich(facts, dim, ["k"], broadcast_rows=10)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString() or \
        "Broadcast" in small._jdf.queryExecution().optimizedPlan().toString()
    big = enrich(facts, dim, ["k"], broadcast_rows=5)
    assert "ResolvedHint (strategy=broadcast)" not in big._jdf.queryExecution().optimizedPlan().toString()
    assert small.count() == big.count() == 1000


def test_join_windowed_batch(spark):
    df = spark.createDataFrame([("2025-01-01 00:01:00", "a", 1.0), ("2025-01-01 00:02:00", "b", 5.0),
                                ("2025-01-01 00:03:00", "b", 2.0), ("2025-01-01 00:07:00", "a", 9.0)],
                               "ts string, kind string, v double").withColumn("ts", F.to_timestamp_ntz("ts"))
    j = join_windowed(df.where("kind = 'a'"), df.where("kind = 'b'"), left_time="ts", right_time="ts",
                      size="5 minutes", left_aggs=[F.count(F.lit(1)).alias("n")],
                      right_aggs=[F.min("v").alias("mn")]).collect()
    assert [(str(r.window_start)[11:16], r.n, r.mn) for r in j] == [("00:00", 1, 2.0)]


def test_interval_join_exact_at_bucket_edges(spark):
    # rows one microsecond either side of bucket edges and exactly on them
    w = 3600 * 1_000_000
    base = 1_735_689_600 * 1_000_000          # 2025-01-01 00:00:00
    lt = [base + w - 1, base + w, base + 2 * w - 1]
    rt = [base + w - 1, base + w, base + 2 * w - 1, base + 2 * w, base + 3 * w - 1]
    left = spark.createDataFrame([(i, 1, t) for i, t in enumerate(lt)], "id long, u long, t long") \
        .withColumn("ts", F.timestamp_micros("t")).drop("t")
    right = spark.createDataFrame([(i, 1, t) for i, t in enumerate(rt)], "id long, u long, t long") \
        .withColumn("ts", F.timestamp_micros("t")).drop("t")
    got = join_interval(left, right, keys=["u"], left_time="ts", right_time="ts",
                        lower_seconds=0, upper_seconds=3600).select("l_id", "r_id").collect()
    want = sorted((i, j) for i, a in enumerate(lt) for j, b in enumerate(rt) if a <= b <= a + w)
    assert sorted((r.l_id, r.r_id) for r in got) == want


def test_bucketed_dimension_is_not_reshuffled(spark):
    from streamkit.operators.joins import bucket_dimension
    dim = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 3).alias("label"))
    table = bucket_dimension(dim, "sk_dim_bucketed", ["k"], 8)
    facts = spark.range(20000).select((F.col("id") % 5000).alias("k"), F.col("id").alias("v"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # stands in for a large dimension
    try:
        j = enrich(facts, table, ["k"], broadcast_rows=100)      # too big to broadcast
        plan = j._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert plan.count("Exchange hashpartitioning") == 1        # the fact side only
    assert j.count() == 20000
    spark.sql("DROP TABLE sk_dim_bucketed")
