"""Property tests (hypothesis): merge idempotence and batch-split independence,
generator contracts for arbitrary id sets."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from streamkit.operators import quality, tables
from streamkit.session import work_path
from streamkit.sources import generators as gen

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(target=st.sets(st.integers(0, 40), max_size=15),
       rows=st.lists(st.integers(0, 40), min_size=1, max_size=40, unique=True),
       cut=st.integers(0, 40))
def test_merge_key_set_independent_of_batch_split(spark, target, rows, cut):
    """Unique non-NULL keys: final key set = target | source, however the
    source is split into micro-batches, and replaying a batch changes nothing."""
    path = work_path(spark, "prop-merge")
    tables.overwrite(spark.createDataFrame([(k, "t") for k in sorted(target)] or [(None, "t")], "k int, v string")
                     .where("k is not null"), path)
    first, second = rows[:cut], rows[cut:]
    for i, part in enumerate([first, second]):
        if part:
            batch = spark.createDataFrame([(k, "s") for k in part], "k int, v string")
            tables.merge_insert(batch, path, ["k"], stream_id="p", batch_id=i)
            tables.merge_insert(batch, path, ["k"], stream_id="p", batch_id=i)   # replay
    got = [r.k for r in tables.read(spark, path).collect()]
    assert sorted(got) == sorted(set(target) | set(rows))
    assert all(r.v == "t" for r in tables.read(spark, path).where(F.col("k").isin(list(target) or [-1])).collect())


@SETTINGS
@given(ids=st.lists(st.integers(0, 10**12), min_size=1, max_size=30, unique=True))
def test_generators_respect_contracts_for_any_ids(spark, ids):
    df = spark.createDataFrame([(i,) for i in ids], "id bigint")
    c = quality.summary(quality.clickstream_rules(gen.clickstream(spark, df))).first()
    assert all(c[f] == 0 for f in c.__fields__ if f.startswith("bad_"))
    t = quality.summary(quality.trip_rules(gen.trips(spark, df))).first()
    assert t.bad_order == 0 and t.bad_parse == 0 and t.bad_pickup_zone == 0 and t.bad_dropoff_zone == 0


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 3), st.integers(0, 20000)), min_size=1, max_size=60),
       lower=st.integers(-3000, 1000), width=st.integers(1, 5000), bucket=st.one_of(st.none(), st.integers(1, 4000)),
       how=st.sampled_from(["inner", "left"]))
def test_interval_join_equals_brute_force(spark, rows, lower, width, bucket, how):
    from streamkit.operators.joins import join_interval
    upper = lower + width
    data = [(i, u, t) for i, (u, t) in enumerate(rows)]
    df = spark.createDataFrame(data, "id long, u long, t long").withColumn("ts", F.timestamp_seconds("t")).drop("t")
    got = join_interval(df, df, keys=["u"], left_time="ts", right_time="ts", lower_seconds=lower,
                        upper_seconds=upper, bucket_seconds=bucket, how=how).select("l_id", "r_id").collect()
    pairs = [(a[0], b[0]) for a in data for b in data if a[1] == b[1] and a[2] + lower <= b[2] <= a[2] + upper]
    if how == "left":
        matched = {p[0] for p in pairs}
        pairs += [(a[0], None) for a in data if a[0] not in matched]
    key = lambda p: (p[0], -1 if p[1] is None else p[1])
    assert sorted(((r.l_id, r.r_id) for r in got), key=key) == sorted(pairs, key=key)


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 2), st.integers(0, 50000)), min_size=1, max_size=80),
       gap=st.integers(1, 3000), per_chunk=st.integers(1, 30))
def test_sessions_equal_brute_force(spark, rows, gap, per_chunk):
    from streamkit.operators.windows import sessions
    df = spark.createDataFrame(rows, "u long, t long").withColumn("ts", F.timestamp_seconds("t"))
    got = sessions(df, "ts", gap, keys=["u"], rows_per_chunk=per_chunk).collect()
    want = []
    for u in sorted({r[0] for r in rows}):
        ts = sorted(t for uu, t in rows if uu == u)
        start, last, n = ts[0], ts[0], 1
        for t in ts[1:]:
            if t - last > gap:
                want.append((u, start, last + gap, n))
                start, n = t, 0
            last = t
            n += 1
        want.append((u, start, last + gap, n))
    assert sorted((r.u, int(r.window_start.timestamp()), int(r.window_end.timestamp()), r.events)
                  for r in got) == sorted(want)


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 3), st.integers(0, 50)), min_size=1, max_size=120),
       slices=st.integers(1, 9))
def test_offsets_equal_row_number(spark, rows, slices):
    from streamkit.functions.encode import assign_offsets
    data = [(i, p, t) for i, (p, t) in enumerate(rows)]          # (id, partition, time) with ties on time
    df = spark.createDataFrame(data, "id long, p int, t long")
    got = {r.id: r.offset for r in assign_offsets(df, "p", ["t", "id"], slices=slices).collect()}
    want = {}
    for p in {r[1] for r in data}:
        for n, r in enumerate(sorted((r for r in data if r[1] == p), key=lambda r: (r[2], r[0]))):
            want[r[0]] = n
    assert got == want


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 4), st.one_of(st.none(), st.integers(0, 9)), st.integers(0, 5)),
                     min_size=1, max_size=60))
def test_key_reducers_equal_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k int, v int, batch_id bigint")
    got = {r.k: (r.v, r.batch_id) for r in tables.dedupe_by_key(df, ["k"]).collect()}
    # smallest (v, batch_id) struct per key; NULL sorts first in Spark's struct order
    want = {}
    for k, v, b in rows:
        cand = (v, b)
        cur = want.get(k)
        order = lambda t: (t[0] is not None, t[0] if t[0] is not None else 0, t[1])
        if cur is None or order(cand) < order(cur):
            want[k] = cand
    assert got == want
    unique = df.dropDuplicates(["k", "batch_id"]).persist()      # one version per (key, batch)
    latest = {r.k: r.v for r in tables.latest_by_key(unique, ["k"]).collect()}
    tops = {}
    for r in unique.collect():
        if r.k not in tops or r.batch_id > tops[r.k][0]:
            tops[r.k] = (r.batch_id, r.v)
    unique.unpersist()
    assert latest == {k: v for k, (_, v) in tops.items()}
