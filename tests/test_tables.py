import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from streamkit.operators import tables


def _target(spark, path):
    tables.overwrite(spark.createDataFrame([(1, "a"), (None, "n")], "k int, v string"), path)


def _batch(spark):
    return spark.createDataFrame([(1, "b"), (2, "c"), (2, "d"), (None, "x")], "k int, v string")


def _rows(spark, path):
    return sorted((r.k if r.k is not None else -1, r.v) for r in tables.read(spark, path).collect())


def test_merge_default_semantics(spark, tmp):
    path = f"{tmp}/t"
    _target(spark, path)
    tables.merge_insert(_batch(spark), path, ["k"], stream_id="s", batch_id=0)
    # NULL keys never match, duplicate batch keys are all inserted
    assert _rows(spark, path) == [(-1, "n"), (-1, "x"), (1, "a"), (2, "c"), (2, "d")]


def test_merge_dedupe_and_null_safe(spark, tmp):
    path = f"{tmp}/t"
    _target(spark, path)
    tables.merge_insert(_batch(spark), path, ["k"], stream_id="s", batch_id=0,
                        dedupe_source=True, null_safe=True)
    assert _rows(spark, path) == [(-1, "n"), (1, "a"), (2, "c")]


def test_merge_replay_is_idempotent(spark, tmp):
    path = f"{tmp}/t"
    _target(spark, path)
    for _ in range(3):   # the same micro-batch replayed
        tables.merge_insert(_batch(spark), path, ["k"], stream_id="s", batch_id=0)
    assert _rows(spark, path) == [(-1, "n"), (-1, "x"), (1, "a"), (2, "c"), (2, "d")]
    # next batch sees batch 0's rows
    tables.merge_insert(_batch(spark), path, ["k"], stream_id="s", batch_id=1)
    assert _rows(spark, path) == [(-1, "n"), (-1, "x"), (-1, "x"), (1, "a"), (2, "c"), (2, "d")]


def test_merge_without_broadcast_gives_same_rows(spark, tmp):
    a, b = f"{tmp}/a", f"{tmp}/b"
    for p in (a, b):
        _target(spark, p)
    tables.merge_insert(_batch(spark), a, ["k"], stream_id="s", batch_id=0)
    tables.merge_insert(_batch(spark), b, ["k"], stream_id="s", batch_id=0, broadcast_keys=0)
    assert _rows(spark, a) == _rows(spark, b)


def test_merge_rejects_unknown_keys_and_columns(spark, tmp):
    path = f"{tmp}/t"
    _target(spark, path)
    with pytest.raises(ValueError):
        tables.merge_insert(_batch(spark), path, ["vendor_id"], stream_id="s", batch_id=0)
    extra = _batch(spark).withColumn("w", F.lit(1))
    with pytest.raises(ValueError):
        tables.merge_insert(extra, path, ["k"], stream_id="s", batch_id=0)
    tables.merge_insert(extra, path, ["k"], stream_id="s", batch_id=0, evolve=True)
    assert "w" in tables.read(spark, path, merge_schema=True).columns
    assert "w" in tables.read(spark, path).columns          # recorded schema, no footer merge
    tables.merge_insert(_batch(spark), path, ["k"], stream_id="s", batch_id=1)   # narrower batch: NULL-filled
    assert tables.read(spark, path).where("w is null").count() >= 1


def test_merge_fills_missing_columns_typed(spark, tmp):
    path = f"{tmp}/t"
    tables.overwrite(spark.createDataFrame([(1, "a", 2.5)], "k int, v string, d double"), path)
    tables.merge_insert(spark.createDataFrame([(3, "z")], "k int, v string"), path, ["k"],
                        stream_id="s", batch_id=0)
    t = tables.read(spark, path)
    assert dict(t.dtypes)["d"] == "double"
    assert t.where("k = 3").first().d is None


def test_delete_where_rewrites_only_touched(spark, tmp):
    path = f"{tmp}/t"
    df = spark.range(100).select(F.col("id").alias("k"), (F.col("id") % 3).alias("g"))
    tables.write_batch(df.where("k < 50"), path, "s", 0)
    tables.write_batch(df.where("k >= 50"), path, "s", 1)
    tables.write_batch(spark.createDataFrame([(1000, None)], "k bigint, g bigint"), path, "s", 2)
    n = tables.delete_where(spark, path, "g = 0 OR (k >= 50 AND k < 1000)")
    assert n == 2
    left = tables.read(spark, path)
    assert left.where("g = 0").count() == 0
    assert left.count() == len([k for k in range(50) if k % 3 != 0]) + 1   # NULL predicate row kept
    assert not os.path.exists(f"{path}/stream_id=s/batch_id=1")


def test_compact_keeps_rows_and_cuts_files(spark, tmp):
    path = f"{tmp}/t"
    df = spark.range(4000).select(F.col("id").alias("k"))
    for b in range(4):
        tables.write_batch(df.where(F.col("k") % 4 == b).repartition(10), path, "s", b)
    before = sorted(r.k for r in tables.read(spark, path).collect())
    files = sum(len([f for f in fs if f.endswith(".parquet")]) for _, _, fs in os.walk(path))
    planned = tables.compact(spark, path, rows_per_file=500)
    after_files = sum(len([f for f in fs if f.endswith(".parquet")]) for _, _, fs in os.walk(path))
    assert sorted(r.k for r in tables.read(spark, path).collect()) == before
    assert planned == 8 and after_files < files


def test_compact_writes_many_small_files_in_few_tasks(spark, tmp, monkeypatch):
    monkeypatch.setattr(tables, "TASK_FILES", 50, raising=False)
    path = f"{tmp}/t"
    rows = [(k, None if k % 7 == 0 else f"v{k}") for k in range(1000)] + [(None, None)] * 25 + [(5, "v5")] * 25
    df = spark.createDataFrame(rows, "k bigint, v string")
    for b in range(2):
        tables.write_batch(df, path, "s", b)
    before = sorted(map(str, tables.read(spark, path).collect()))
    assert tables.compact(spark, path, rows_per_file=10) == 210
    files = [f for f in glob.glob(f"{path}/**/*.parquet", recursive=True)]
    assert len(files) >= 210 and max(pq.ParquetFile(f).metadata.num_rows for f in files) <= 10
    assert 2 <= len({os.path.basename(f).split("-")[1] for f in files}) <= 5   # tasks: part numbers
    assert sorted(map(str, tables.read(spark, path).collect())) == before


def test_expire_removes_orphans_only(spark, tmp):
    path = f"{tmp}/t"
    tables.write_batch(spark.range(10), path, "s", 0)
    os.makedirs(f"{path}/_temporary/0")
    open(f"{path}/_temporary/0/part-x.parquet", "w").close()
    os.makedirs(f"{path}/stream_id=s/batch_id=7")
    removed = tables.expire(spark, path, retention_hours=0)
    assert any("_temporary" in r for r in removed) and any("batch_id=7" in r for r in removed)
    assert tables.read(spark, path).count() == 10
    with pytest.raises(ValueError):
        tables.expire(spark, path, retention_hours=0, checkpoints=[f"{path}/_checkpoint"])


def test_bootstrap_history_register_latest(spark, tmp):
    path = f"{tmp}/t"
    src = spark.range(5).withColumn("x", F.col("id") * 2)
    assert tables.bootstrap(spark, path, src, ["id"], view="boot_v") is True
    assert tables.bootstrap(spark, path, src, ["id"]) is False
    assert spark.sql("select count(*) c from boot_v").first().c == 5
    with pytest.raises(ValueError):
        tables.bootstrap(spark, f"{tmp}/u", src, ["nope"])
    tables.write_batch(spark.createDataFrame([(1, 10)], "id bigint, x bigint"), f"{tmp}/v", "s", 0)
    tables.write_batch(spark.createDataFrame([(1, 11)], "id bigint, x bigint"), f"{tmp}/v", "s", 1)
    h = tables.history(spark, f"{tmp}/v").orderBy("batch_id").collect()
    assert [(r.batch_id, r.rows) for r in h] == [(0, 1), (1, 1)]
    latest = tables.latest_by_key(tables.read(spark, f"{tmp}/v"), ["id"]).collect()
    assert [(r.id, r.x) for r in latest] == [(1, 11)]


def test_append_rejects_unknown_columns_unless_evolving(spark, tmp):
    path = f"{tmp}/t"
    tables.write_batch(spark.createDataFrame([(1,)], "k int"), path, "s", 0)
    wider = spark.createDataFrame([(2, "x")], "k int, extra string")
    with pytest.raises(ValueError):
        tables.write_batch(wider, path, "s", 1)
    tables.write_batch(wider, path, "s", 1, evolve=True)
    got = sorted((r.k, r.extra) for r in tables.read(spark, path).collect())
    assert got == [(1, None), (2, "x")]


def test_overwrite_replaces_every_batch_even_in_dynamic_sessions(spark, tmp):
    path = f"{tmp}/t"
    tables.write_batch(spark.createDataFrame([(1,)], "k int"), path, "s", 3)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        tables.overwrite(spark.createDataFrame([(9,)], "k int"), path)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert [r.k for r in tables.read(spark, path).collect()] == [9]


def _dated(spark, lo, hi):
    return spark.range(lo, hi).select(F.col("id").alias("k"),
                                      F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 5).cast("int"))
                                      .alias("day"))


def test_partitioned_table_merge_prunes_and_maintains(spark, tmp):
    path = f"{tmp}/t"
    tables.overwrite(_dated(spark, 0, 100), path, partition_by=["day"])
    assert tables.partition_cols(tables.stored_schema(spark, path)) == ["day"]
    batch = _dated(spark, 95, 110).where("day = date'2024-01-02'")      # one day only
    target = tables.read(spark, path)
    pruned = tables._prune_partitions(batch, target, ["day"])
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "day" in plan.split("PartitionFilters: [")[1].split("]")[0]
    tables.merge_insert(batch, path, ["k"], stream_id="s", batch_id=0)
    got = sorted(r.k for r in tables.read(spark, path).collect())
    assert got == sorted(set(range(100)) | {k for k in range(95, 110) if k % 5 == 1})
    assert os.path.isdir(f"{path}/stream_id=s/batch_id=0/day=2024-01-02")
    # delete a whole day: its folder in every batch goes, other days stay
    tables.delete_where(spark, path, "day = date'2024-01-02'")
    assert tables.read(spark, path).where("day = date'2024-01-02'").count() == 0
    assert not os.path.exists(f"{path}/stream_id=bootstrap/batch_id=0/day=2024-01-02")
    n = tables.read(spark, path).count()
    tables.compact(spark, path, rows_per_file=7)
    assert tables.read(spark, path).count() == n
    tables.expire(spark, path, retention_hours=0)
    assert tables.read(spark, path).count() == n
    # widening keeps the partition flag
    tables.merge_insert(_dated(spark, 200, 201).withColumn("note", F.lit("x")), path, ["k"],
                        stream_id="s", batch_id=1, evolve=True)
    assert tables.partition_cols(tables.stored_schema(spark, path)) == ["day"]
    assert tables.read(spark, path).where("k = 200").first().note == "x"


def test_partitioned_merge_without_partition_column_reads_everything(spark, tmp):
    path = f"{tmp}/t"
    tables.overwrite(_dated(spark, 0, 10), path, partition_by=["day"])
    batch = spark.range(5, 15).select(F.col("id").alias("k"))          # no day column
    tables.merge_insert(batch, path, ["k"], stream_id="s", batch_id=0)
    assert sorted(r.k for r in tables.read(spark, path).collect()) == list(range(15))


def test_type_widening_on_evolve(spark, tmp):
    path = f"{tmp}/t"
    tables.overwrite(spark.createDataFrame([(1, 1.5)], "k int, v float"), path)
    tables.merge_insert(spark.createDataFrame([(2, 2.5)], "k bigint, v double"), path, ["k"],
                        stream_id="s", batch_id=0, evolve=True)
    assert tables.stored_schema(spark, path).simpleString() == "struct<k:bigint,v:double>"
    assert sorted(tuple(r) for r in tables.read(spark, path).select("k", "v").collect()) == [(1, 1.5), (2, 2.5)]


def test_nested_field_added_on_evolve(spark, tmp):
    path = f"{tmp}/t"
    tables.overwrite(spark.createDataFrame([(1, (1, "a"))], "k int, s struct<a:int,b:string>"), path)
    tables.merge_insert(spark.createDataFrame([(2, (2, "b", 2.5))], "k int, s struct<a:int,b:string,c:double>"),
                        path, ["k"], stream_id="s", batch_id=0, evolve=True)
    rows = {r.k: r.s.asDict() for r in tables.read(spark, path).collect()}
    assert rows == {1: {"a": 1, "b": "a", "c": None}, 2: {"a": 2, "b": "b", "c": 2.5}}


def test_compact_named_batches_and_delete_by_batch(spark, tmp):
    path = f"{tmp}/t"
    for b in range(3):
        tables.write_batch(spark.range(b * 100, b * 100 + 100).withColumnRenamed("id", "k").repartition(5),
                           path, "s", b)
    before = sorted(r.k for r in tables.read(spark, path).collect())
    assert tables.compact(spark, path, rows_per_file=1000, batches=[("s", 1)]) == 1
    files = [f for f in os.listdir(f"{path}/stream_id=s/batch_id=1") if f.endswith(".parquet")]
    assert len(files) == 1
    assert sorted(r.k for r in tables.read(spark, path).collect()) == before
    assert tables.delete_where(spark, path, "batch_id = 2") == 1          # a predicate on the layout only
    assert not os.path.exists(f"{path}/stream_id=s/batch_id=2")
    assert tables.read(spark, path).count() == 200


def test_merge_finds_keys_under_other_partitions_for_any_batch_split(spark, tmp):
    for split in (1, 3):
        path = f"{tmp}/split{split}"
        tables.overwrite(_dated(spark, 0, 30), path, partition_by=["day"])
        moved = _dated(spark, 0, 45).withColumn("day", F.date_add("day", 40))
        for b in range(split):
            tables.merge_insert(moved.where(F.col("k") % split == b), path, ["k"], stream_id="s", batch_id=b)
        assert sorted(r.k for r in tables.read(spark, path).collect()) == list(range(45))


def test_partition_filter_has_a_fixed_size(spark, tmp):
    path = f"{tmp}/t"
    rows = spark.range(20).select(F.col("id").alias("k"), F.lit(1).alias("a"), F.lit("x").alias("b"))
    tables.overwrite(rows, path, partition_by=["a", "b"])
    batch = spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") % 200).cast("int").alias("a"),
                                       F.concat(F.lit("x"), F.col("id") % 100).alias("b"))
    target = tables._prune_partitions(batch.unionByName(rows), tables.read(spark, path), ["a", "b"])
    assert target.count() == 20
    nulls = batch.limit(1).withColumn("a", F.lit(None).cast("int"))
    assert tables._prune_partitions(nulls, tables.read(spark, path), ["a"]).count() == 0


def test_delete_removes_folders_whose_names_need_escapes(spark, tmp):
    path = f"{tmp}/t"
    rows = spark.range(6).select(F.col("id").alias("k"), F.when(F.col("id") < 3, "x:y z%").otherwise("plain").alias("p"))
    tables.overwrite(rows, path, partition_by=["p"])
    tables.delete_where(spark, path, "p = 'x:y z%'")
    assert sorted(r.k for r in tables.read(spark, path).collect()) == [3, 4, 5]


def _values(spark, path, *cols):
    return sorted(tuple(r) for r in tables.read(spark, path).select(*cols).collect())


def test_replays_replace_the_whole_batch(spark, tmp):
    path = f"{tmp}/t"
    tables.write_batch(spark.range(10), path, "a:b c", 0)
    tables.write_batch(spark.range(3), path, "a:b c", 1)
    tables.write_batch(spark.range(0), path, "a:b c", 0)         # empty replay
    assert _values(spark, path, "id") == [(0,), (1,), (2,)]
    split = f"{tmp}/p"
    tables.overwrite(spark.createDataFrame([(0, "A")], "k int, d string"), split, partition_by=["d"])
    tables.write_batch(spark.createDataFrame([(1, "A"), (2, "B")], "k int, d string"), split, "s", 0)
    tables.write_batch(spark.createDataFrame([(1, "A")], "k int, d string"), split, "s", 0)   # no row for d=B
    assert _values(spark, split, "k", "d") == [(0, "A"), (1, "A")]


def test_named_batches_of_an_escaped_writer(spark, tmp):
    path = f"{tmp}/t"
    tables.write_batch(spark.range(10), path, "a:b c", 0)
    assert tables.read_batches(spark, path, [("a:b c", 0)]).count() == 10
    assert tables.delete_where(spark, path, "id < 4") == 1
    assert tables.read(spark, path).count() == 6


def test_appends_take_the_recorded_types_or_are_refused(spark, tmp):
    path = f"{tmp}/t"
    tables.write_batch(spark.createDataFrame([(1, 1)], "k bigint, v bigint"), path, "s", 0)
    tables.write_batch(spark.createDataFrame([(2, 2)], "k int, v smallint"), path, "s", 1)
    for ddl, row in (("k bigint, v string", (3, "x")), ("k bigint, v double", (3, 0.5))):
        for evolve in (False, True):
            with pytest.raises(ValueError):
                tables.write_batch(spark.createDataFrame([row], ddl), path, "s", 2, evolve=evolve)
        with pytest.raises(ValueError):
            tables.merge_insert(spark.createDataFrame([row], ddl), path, ["k"], stream_id="m", batch_id=0, evolve=True)
    assert _values(spark, path, "k", "v") == [(1, 1), (2, 2)]


@pytest.mark.parametrize("old, new", [("tinyint", "int"), ("smallint", "bigint"), ("int", "bigint"), ("int", "double"),
                                      ("tinyint", "double"), ("float", "double"), ("decimal(9,2)", "decimal(20,4)"),
                                      ("array<int>", "array<bigint>"), ("struct<a:int>", "struct<a:bigint,b:string>")])
def test_tables_stay_readable_after_each_promotion(spark, tmp, old, new):
    path = f"{tmp}/t"
    make = {"array": "array(1)", "struct": "named_struct('a', 1)"}.get(old.split("<")[0], "1")
    tables.write_batch(spark.sql(f"SELECT 1 AS k, CAST({make} AS {old}) AS v"), path, "s", 0)
    wide = "named_struct('a', 1, 'b', 'x')" if old.startswith("struct") else make
    tables.write_batch(spark.sql(f"SELECT 2 AS k, CAST({wide} AS {new}) AS v"), path, "s", 1, evolve=True)
    assert tables.stored_schema(spark, path)["v"].dataType.simpleString() == new
    assert [r.k for r in tables.read(spark, path).where("v IS NOT NULL").orderBy("k").collect()] == [1, 2]


def test_half_written_table_is_bootstrapped_again(spark, tmp):
    path = f"{tmp}/t"
    os.makedirs(f"{path}/stream_id=bootstrap/batch_id=0")       # a create that died
    assert not tables.exists(spark, path)
    assert tables.bootstrap(spark, path, spark.range(5)) is True
    assert tables.exists(spark, path) and tables.read(spark, path).count() == 5


def test_compact_writes_the_same_files_past_the_broadcast_bound(spark, tmp, monkeypatch):
    sizes = []
    for bound in (1_000_000, 0):
        path = f"{tmp}/t{bound}"
        for b in range(3):
            tables.write_batch(spark.range(20).repartition(4), path, "s", b)
        monkeypatch.setattr(tables, "MAX_BROADCAST_BATCHES", bound)
        planned = tables.compact(spark, path, rows_per_file=100)
        sizes.append((planned, sum(len([f for f in fs if f.endswith(".parquet")]) for _, _, fs in os.walk(path))))
    assert sizes[0] == sizes[1] == (3, 3)
