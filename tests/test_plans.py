"""Every registered query against its DuckDB oracle on the smallest tables,
plus plan-shape checks (pushdown, pruning, join strategy, no Python UDFs)."""

import duckdb
import pytest

import __spark_entry__ as E
from streamkit.plans import ORACLE, QUERIES
from tools.oracle_check import TABLES, rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES) <= set(E.queries())
    assert set(ORACLE) <= set(E.oracle_sql()) <= set(E.queries())
    assert len(QUERIES) >= 50


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    if sql is None:
        return
    rel = duck.sql(sql)
    assert sorted(df.columns) == sorted(rel.columns)
    assert rows_of(df.columns, rows) == rows_of(rel.columns, rel.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns == ["window_start", "window_end", "max_value", "events"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_and_columns_reach_the_scan(spark):
    df = E.queries()["count_where_in"](spark, SF)
    plan = _plan(df)
    assert "PushedFilters: [In(event_type, [click,purchase])]" in plan or "In(event_type" in plan
    assert "ReadSchema: struct<event_type:string>" in plan


def test_no_python_udf_in_any_batch_query(spark):
    for name, fn in QUERIES.items():
        if "stream" in name or name in ("merge_insert_events", "merge_evolve", "delete_where", "compact",
                                        "expire", "dedupe_events", "window_join_5m", "enrich_orders",
                                        "offsets_from"):
            continue
        plan = _plan(fn(spark, SF))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_merge_plan_reduces_target_with_semi_join(spark, tmp):
    from streamkit.operators import tables
    path = f"{tmp}/t"
    tables.overwrite(spark.range(100).withColumnRenamed("id", "k"), path)
    batch = spark.range(90, 110).withColumnRenamed("id", "k")
    rows = tables.new_rows(batch, tables.read(spark, path), ["k"])
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "LeftSemi" in plan
    assert sorted(r.k for r in rows.collect()) == list(range(100, 110))
