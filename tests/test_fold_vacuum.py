"""Folding of batches, the merge's key index, and the distributed vacuum."""

import glob
import os
import shutil

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from streamkit.operators import tables
from streamkit.operators.files import delete_files, list_tree


def data_files(path):
    return [f for f in glob.glob(f"{path}/**/*.parquet", recursive=True)]


def keys(spark, path):
    return sorted(r.k for r in tables.read(spark, path).select("k").collect())


def one_row_batches(spark, path, n, stream="s"):
    rows = spark.range(n).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v"), F.col("id").alias("b"))
    tables.write_batches(rows.repartition(4, "b"), path, stream, "b")


def test_a_thousand_one_row_batches_become_a_handful_of_files(spark, tmp):
    path = f"{tmp}/t"
    one_row_batches(spark, path, 1000)
    done = tables.fold(spark, path, "s", upto=899, rows_per_file=300)
    assert (done.upto, done.files_before, done.files_after) == (899, 900, 3)
    assert keys(spark, path) == list(range(1000))
    tables.vacuum(spark, path, retention_hours=0)
    assert len(data_files(path)) == 103 and keys(spark, path) == list(range(1000))
    # the next fold takes the folded batch and what came since
    tables.write_batch(spark.createDataFrame([(1000, "new")], "k bigint, v string"), path, "s", 1000)
    again = tables.fold(spark, path, "s", rows_per_file=5000)
    assert (again.upto, again.files_before, again.files_after) == (1000, 104, 1)
    tables.vacuum(spark, path, retention_hours=0)
    assert len(data_files(path)) == 1 and keys(spark, path) == list(range(1001))
    assert tables.fold(spark, path, "s").files_before == 0       # nothing left to fold


def test_replays_of_folded_epochs_insert_nothing(spark, tmp):
    path = f"{tmp}/t"
    one_row_batches(spark, path, 6)
    tables.fold(spark, path, "s", upto=3)
    replay = spark.createDataFrame([(77, "again")], "k bigint, v string")
    tables.write_batch(replay, path, "s", 3)
    tables.write_batches(replay.withColumn("b", F.lit(2)), path, "s", "b")
    assert tables.merge_insert(replay, path, ["k"], stream_id="s", batch_id=1).count() == 0
    assert keys(spark, path) == list(range(6))
    tables.write_batch(replay, path, "s", 5)                     # after the fold a replay replaces its batch
    tables.write_batch(replay, path, "other", 0)                 # other writers are not concerned
    assert keys(spark, path) == [0, 1, 2, 3, 4, 77, 77]
    with pytest.raises(ValueError):
        tables.as_of(spark, path, 2, stream_id="s")
    assert sorted(r.k for r in tables.as_of(spark, path, 4, stream_id="s").where("stream_id = 's'").collect()) == [0, 1, 2, 3, 4]
    n = tables.delete_where(spark, path, "k < 2 OR k = 4")       # the folded batch and batch 4
    assert n == 2 and keys(spark, path) == [2, 3, 77, 77]


def test_a_fold_that_fails_before_its_commit_changes_nothing(spark, tmp, monkeypatch):
    path = f"{tmp}/t"
    one_row_batches(spark, path, 8)
    with monkeypatch.context() as m:
        m.setattr(tables, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            tables.fold(spark, path, "s")
    assert keys(spark, path) == list(range(8)) and tables.folds(spark, path) == {}
    tables.vacuum(spark, path, retention_hours=0)                # what the failed fold wrote is no batch
    assert len(data_files(path)) == 8
    assert tables.fold(spark, path, "s").files_after == 1 and keys(spark, path) == list(range(8))


def test_fold_of_versions_and_of_partitioned_tables(spark, tmp):
    path = f"{tmp}/v"
    for b in range(4):
        tables.write_batch(spark.createDataFrame([(b % 2, 10 * b)], "k bigint, n bigint"), path, "s", b)
    tables.fold(spark, path, "s", keys=["k"])
    assert sorted((r.k, r.n) for r in tables.read(spark, path).collect()) == [(0, 20), (1, 30)]
    part = f"{tmp}/p"
    dated = spark.range(60).select(F.col("id").alias("k"), (F.col("id") % 3).cast("string").alias("day"))
    tables.overwrite(dated.where("k < 6"), part, partition_by=["day"])
    for b in range(4):
        tables.write_batch(dated.where(F.col("k") % 4 == b).where("k >= 6"), part, "s", b)
    before = keys(spark, part)
    done = tables.fold(spark, part, "s", rows_per_file=10_000)
    assert keys(spark, part) == before and done.files_after == 3
    assert os.path.isdir(f"{part}/stream_id=s/batch_id=-4/day=1")


def test_fold_writes_many_small_files_in_few_tasks(spark, tmp, monkeypatch):
    monkeypatch.setattr(tables, "TASK_FILES", 50, raising=False)
    for day, name in ((None, "plain"), ("day", "dated")):
        path = f"{tmp}/{name}"
        rows = [(k, None if k % 7 == 0 else f"v{k}", f"d{k % 3}" if k % 5 else None) for k in range(1003)] + [(None, None, None)] * 12 + [(5, "v5", "d2")] * 12
        df = spark.createDataFrame(rows, "k bigint, v string, day string").repartition(3)
        if day:
            tables.overwrite(df.limit(0), path, partition_by=[day])
        for b in range(2):
            tables.write_batch(df, path, "s", b)
        before = sorted(map(str, tables.read(spark, path).select("k", "v", "day").collect()))
        done = tables.fold(spark, path, "s", rows_per_file=10)
        sizes = [df.where(F.col("day").eqNullSafe(d)).count() * 2 for d in ("d0", "d1", "d2", None)] if day else [len(before)]
        files = [f for f in data_files(path) if "batch_id=-" in f]
        assert done.files_after == len(files) == sum(-(-n // 10) for n in sizes)
        assert max(pq.ParquetFile(f).metadata.num_rows for f in files) <= 10
        assert 2 <= len({os.path.basename(f).split("-")[1] for f in files}) <= 5   # tasks: part numbers
        assert sorted(map(str, tables.read(spark, path).select("k", "v", "day").collect())) == before


def test_vacuum_of_many_orphans(spark, tmp):
    path = f"{tmp}/t"
    tables.write_batch(spark.range(10).withColumnRenamed("id", "k"), path, "a:b c", 0)
    tables.write_batch(spark.range(5).withColumnRenamed("id", "k"), path, "s", 0)
    for d in range(40):
        os.makedirs(f"{path}/stream_id=s/batch_id=0/.spark-staging-{d}/x", exist_ok=True)
        os.makedirs(f"{path}/_temporary/{d}", exist_ok=True)
        for i in range(50):
            open(f"{path}/stream_id=s/batch_id=0/.spark-staging-{d}/x/part-{i}.parquet", "w").close()
            open(f"{path}/_temporary/{d}/part-{i}", "w").close()
            open(f"{path}/stream_id=s/stray-{d}-{i}", "w").close()
    os.makedirs(f"{path}/stream_id=gone/batch_id=3/day=x")
    assert tables.vacuum(spark, path, retention_hours=1).count() == 0           # all too young
    calls = []
    original = tables.FS.delete
    tables.FS.delete = lambda self, p, recursive=True: calls.append(p) or original(self, p, recursive)
    try:
        removed = {r.path for r in tables.vacuum(spark, path, retention_hours=0).collect()}
    finally:
        tables.FS.delete = original
    assert not calls                                                            # the driver deletes nothing itself
    assert len(removed) == 40 + 1 + 2000 + 3
    assert f"{path}/_temporary" in removed and f"{path}/stream_id=gone" in removed
    assert len(data_files(path)) == len([r for r in list_tree(spark, path).collect() if r.path.endswith(".parquet")])
    assert tables.read(spark, path).count() == 15
    assert tables.vacuum(spark, path, retention_hours=0).count() == 0


def test_delete_files_takes_raw_and_escaped_names(spark, tmp):
    for name in ("plain", "a b%3Ac", "x%20y"):
        open(f"{tmp}/{name}", "w").close()
    paths = spark.createDataFrame([(f"{tmp}/plain",), (f"file:{tmp}/a b%3Ac",), (f"file://{tmp}/x%2520y",), (f"{tmp}/never",)], "path string")
    assert all(r.removed for r in delete_files(paths).collect()) and os.listdir(tmp) == []


def test_batches_replaced_on_partitioned_tables(spark, tmp):
    path = f"{tmp}/t"
    tables.overwrite(spark.createDataFrame([(0, "A")], "k bigint, d string"), path, partition_by=["d"])
    rows = spark.createDataFrame([(1, "A", 0), (2, "B", 0), (3, "B", 1)], "k bigint, d string, b int")
    tables.write_batches(rows, path, "s", "b")
    tables.write_batches(rows.where("k = 1"), path, "s", "b")                   # batch 0 comes again without its row in B
    assert keys(spark, path) == [0, 1, 3]


def test_merge_refuses_types_before_it_runs(spark, tmp):
    path = f"{tmp}/t"
    tables.overwrite(spark.createDataFrame([(1, 2.0)], "k bigint, v double"), path)
    with pytest.raises(ValueError):
        tables.merge_insert(spark.createDataFrame([(2, "x")], "k bigint, v string"), path, ["k"], stream_id="s", batch_id=0)
    assert keys(spark, path) == [1]


def test_latest_by_key_of_several_writers_needs_an_order(spark, tmp):
    path = f"{tmp}/t"
    tables.write_batch(spark.createDataFrame([(1, "old", 5)], "k bigint, v string, at int"), path, "first", 7)
    tables.write_batch(spark.createDataFrame([(1, "new", 6)], "k bigint, v string, at int"), path, "second", 0)
    with pytest.raises(ValueError):
        tables.latest_by_key(tables.read(spark, path), ["k"])
    assert [r.v for r in tables.latest_by_key(tables.read(spark, path), ["k"], ["at"]).collect()] == ["new"]


# ---------------------------------------------------------------- key index

def plan_files(df):
    return sorted(f.split("batch_id=")[1].split("/")[0] for f in df.inputFiles())


def test_only_batches_that_meet_the_keys_are_opened(spark, tmp, monkeypatch):
    path = f"{tmp}/t"
    make = lambda lo, hi: spark.range(lo, hi).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    tables.overwrite(make(0, 100), path)
    index = tables.KeyIndex(spark, path, ["k"])
    read, seen = tables.read_batches, []
    monkeypatch.setattr(tables, "read_batches", lambda s, p, b: seen.append(sorted(x[1] for x in b)) or read(s, p, b))
    monkeypatch.setattr(tables, "read", lambda *a, **k: pytest.fail("the whole table is listed"))
    for b in range(12):
        tables.merge_insert(make(100 * b + 95, 100 * b + 205), path, ["k"], stream_id="s", batch_id=b, index=index)
    monkeypatch.undo()
    assert all(len(x) <= 2 for x in seen) and seen[5] == [4]
    assert keys(spark, path) == list(range(1305))
    # a replay sees what it saw, a new writer reads the records, and measures what has none
    tables.merge_insert(make(595, 705), path, ["k"], stream_id="s", batch_id=5, index=index)
    tables.write_batch(make(5000, 5010), path, "other", 0)
    fresh = tables.KeyIndex(spark, path, ["k"])
    assert fresh.ranges["s", 5] == ([605], [704]) and fresh.ranges["other", 0] == ([5000], [5009])
    assert fresh.candidates([5001], [5002]) == [("other", 0)]
    tables.merge_insert(make(5005, 5020), path, ["k"], stream_id="s", batch_id=12, index=fresh)
    assert keys(spark, path) == list(range(1305)) + list(range(5000, 5020))


def test_index_follows_a_fold_and_keys_of_several_kinds(spark, tmp):
    path = f"{tmp}/t"
    make = lambda lo, hi: spark.range(lo, hi).select(F.format_string("%05d", "id").alias("name"), F.timestamp_seconds(F.col("id") * 60).alias("at"), F.col("id").alias("k"))
    tables.write_batch(make(0, 10), path, "s", 0)
    index = tables.KeyIndex(spark, path, ["name", "at"])
    for b in range(1, 6):
        tables.merge_insert(make(10 * b - 3, 10 * b + 10), path, ["name", "at"], stream_id="s", batch_id=b, index=index)
    assert keys(spark, path) == list(range(60))
    tables.fold(spark, path, "s", upto=4)
    tables.vacuum(spark, path, retention_hours=0)
    tables.merge_insert(make(20, 63).unionByName(make(0, 1).withColumn("name", F.lit(None).cast("string"))), path, ["name", "at"], stream_id="s", batch_id=6, index=index)
    assert keys(spark, path) == sorted([*range(63), 0]) and set(index.ranges) == {("s", -5), ("s", 5), ("s", 6)}


def test_merged_batches_have_bloom_filters_that_skip(spark, tmp):
    path = f"{tmp}/t"
    tables.overwrite(spark.range(10).select((F.col("id") * 2).alias("k")), path)
    tables.merge_insert(spark.range(500).select((F.col("id") * 1000).alias("k")), path, ["k"], stream_id="s", batch_id=0)
    meta = pq.ParquetFile(data_files(f"{path}/stream_id=s")[0])
    assert meta.metadata.num_rows > 0
    with open(data_files(f"{path}/stream_id=s")[0], "rb") as f:
        raw = f.read()
    sized = f"{tmp}/plain"
    tables.write_batch(spark.range(500).select((F.col("id") * 1000).alias("k")), sized, "s", 0)
    assert len(raw) > os.path.getsize(data_files(sized)[0]) + 500               # the filter is stored
    rows = tables.new_rows(spark.createDataFrame([(7,), (9,)], "k bigint"), tables.read(spark, path), ["k"], in_list=10)
    assert "In(k, [7,9])" in rows._jdf.queryExecution().executedPlan().toString() and sorted(r.k for r in rows.collect()) == [7, 9]


def test_rows_without_a_key_go_past_the_join(spark, tmp):
    path = f"{tmp}/t"
    tables.overwrite(spark.range(100).select(F.col("id").alias("k")), path)
    batch = spark.range(20_000, numPartitions=8).select(F.when(F.col("id") % 2 == 0, F.col("id") % 120).alias("k"))
    rows = tables.new_rows(batch, tables.read(spark, path), ["k"], broadcast_keys=0)
    per_task = [r[1] for r in rows.where("k IS NULL").groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == 10_000 and max(per_task) == 1250                    # as they lay, in eight tasks
    assert rows.where("k IS NOT NULL").count() == sum(1 for i in range(0, 20_000, 2) if i % 120 >= 100)


# ---------------------------------------------------------------- small files of a fold

EVERY_TYPE = ["k AS k", "CAST(k AS string) AS s", "CAST(CAST(k AS string) AS binary) AS b", "CAST(k / 7 AS decimal(20, 6)) AS d", "CAST(k AS double) AS f", "k % 2 = 0 AS t",
              "date_add(DATE'0999-12-25', CAST(k AS int)) AS day", "timestamp_seconds(k) AS at", "make_timestamp_ntz(1200, 1, 1, 0, 0, 0) + make_dt_interval(0, 0, 0, k) AS local",
              "IF(k % 3 = 0, NULL, array(k, NULL)) AS `a b`", "map(CAST(k AS string), k) AS m", "named_struct('x', k, 'y', array(named_struct('z', NULLIF(k, 5)))) AS st"]


def test_fold_writes_small_files_of_every_type_in_its_tasks(spark, tmp):
    path = f"{tmp}/t"
    rows = spark.range(1003).withColumnRenamed("id", "k").selectExpr(*EVERY_TYPE, "k % 3 AS b_no")
    tables.write_batches(rows, path, "a/b %", "b_no")
    before = sorted(tables.read(spark, path).drop("batch_id").collect(), key=lambda r: r.k)
    folder = f"{glob.glob(f'{path}/stream_id=*')[0]}/batch_id=-3"
    os.mkdir(folder)
    shutil.copy(data_files(path)[0], f"{folder}/part-of-a-fold-that-failed.parquet")
    done = tables.fold(spark, path, "a/b %", rows_per_file=50)
    files = sorted(os.listdir(folder))
    assert (done.upto, done.files_after) == (2, 21) and files == [f"part-00000-{i:09d}.parquet" for i in range(21)]   # no checksum, whose file costs a process
    assert [pq.ParquetFile(f"{folder}/{f}").metadata.num_rows for f in files] == [50] * 20 + [3]
    tables.vacuum(spark, path, retention_hours=0)
    assert sorted(tables.read(spark, path).drop("batch_id").collect(), key=lambda r: r.k) == before


@pytest.mark.parametrize("by, extra", [(["p"], "k % 2 AS p"), ([], "parse_json(CAST(k AS string)) AS v"), ([], "make_dt_interval(0, 0, 0, k) AS i")])
def test_fold_of_partitioned_tables_and_other_types(spark, tmp, by, extra):
    path = f"{tmp}/t"
    rows = spark.range(100).withColumnRenamed("id", "k").selectExpr("k", extra)
    tables.overwrite(rows.where("false"), path, partition_by=by)
    tables.write_batches(rows.withColumn("b_no", F.col("k") % 3), path, "s", "b_no")
    text = lambda: sorted(map(str, tables.read(spark, path).drop("batch_id").collect()))
    before = text()
    assert tables.fold(spark, path, "s", rows_per_file=20).files_after == (6 if by else 5)
    assert text() == before and len(before) == 100
