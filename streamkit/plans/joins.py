"""Registered queries: windowed stream-stream joins, interval joins,
stream-batch enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from streamkit.functions import decode
from streamkit.operators.joins import enrich, join_interval, join_windowed
from streamkit.plans.common import TS0_SQL, events_stream, hsql, run_parquet, state_partitions, STATEFUL_BATCHES, trip_sql
from streamkit.plans.registry import query
from streamkit.operators import tables
from streamkit.plans.topics import FLUSH_TS, table, write_arrivals
from streamkit.session import work_path
from streamkit.sources import generators as gen
from streamkit.sources.files import stream_file
from streamkit.streaming.routes import enrich_router
from streamkit.streaming.run import drain
from streamkit.streaming.sinks import SinkSpec, start


WINDOW_JOIN_SQL = """
WITH c AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, count(*) AS clicks
           FROM events WHERE event_type = 'click' GROUP BY 1),
     v AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, min(value) AS min_view_value
           FROM events WHERE event_type = 'view' GROUP BY 1)
SELECT c.window_start, c.window_start + INTERVAL 5 MINUTE AS window_end, clicks, min_view_value
FROM c JOIN v ON c.window_start = v.window_start
"""


@query("window_join_5m", WINDOW_JOIN_SQL)
def window_join_5m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two 5-minute window aggregates of one stream, joined (stream-stream)."""
    st = events_stream(spark, sf_dir, batches=STATEFUL_BATCHES, flush_types=["click", "view"])
    joined = join_windowed(st.where(F.col("event_type") == "click"), st.where(F.col("event_type") == "view"),
                           left_time="ts", right_time="ts", size="5 minutes",
                           left_aggs=[F.count(F.lit(1)).alias("clicks")],
                           right_aggs=[F.min("value").alias("min_view_value")], delay="2 minutes")
    out = run_parquet(joined, "window-join", partitions=state_partitions(spark, sf_dir))
    return out.where(F.col("window_start") < F.to_timestamp_ntz(F.lit(FLUSH_TS)))


@query("window_join_5m_batch", WINDOW_JOIN_SQL)
def window_join_5m_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 batch twin."""
    ev = table(spark, sf_dir, "events")
    return join_windowed(ev.where(F.col("event_type") == "click"), ev.where(F.col("event_type") == "view"),
                         left_time="ts", right_time="ts", size="5 minutes",
                         left_aggs=[F.count(F.lit(1)).alias("clicks")],
                         right_aggs=[F.min("value").alias("min_view_value")])


INTERVAL_SQL = """
SELECT a.user_id, a.event_id AS l_event_id, a.ts AS l_ts, b.event_id AS r_event_id, b.ts AS r_ts
FROM (SELECT * FROM events WHERE event_type = 'signup') a
{how} JOIN (SELECT * FROM events WHERE event_type = 'purchase') b
  ON a.user_id = b.user_id AND b.ts BETWEEN a.ts AND a.ts + INTERVAL 12 HOUR
"""


def _interval(spark: SparkSession, sf_dir: str, how: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    j = join_interval(ev.where(F.col("event_type") == "signup"), ev.where(F.col("event_type") == "purchase"),
                      keys=["user_id"], left_time="ts", right_time="ts",
                      lower_seconds=0, upper_seconds=12 * 3600, how=how)
    return j.select("user_id", "l_event_id", "l_ts", "r_event_id", "r_ts")


@query("interval_join", INTERVAL_SQL.format(how=""))
def interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases within 12 hours after a signup of the same user (time-bucketed)."""
    return _interval(spark, sf_dir, "inner")


@query("interval_join_left", INTERVAL_SQL.format(how="LEFT"))
def interval_join_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 left outer: signups with or without a purchase within 12 hours."""
    return _interval(spark, sf_dir, "left")


@query("interval_join_stream", INTERVAL_SQL.format(how=""))
def interval_join_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 as a stream-stream join with 2-minute watermarks on both sides."""
    st = events_stream(spark, sf_dir, batches=STATEFUL_BATCHES).select("event_id", "ts", "user_id", "event_type")
    j = join_interval(st.where(F.col("event_type") == "signup"), st.where(F.col("event_type") == "purchase"),
                      keys=["user_id"], left_time="ts", right_time="ts",
                      lower_seconds=0, upper_seconds=12 * 3600, delay="2 minutes")
    return run_parquet(j.select("user_id", "l_event_id", "l_ts", "r_event_id", "r_ts"), "interval-join",
                       partitions=state_partitions(spark, sf_dir))


@query("interval_join_left_stream", INTERVAL_SQL.format(how="LEFT"))
def interval_join_left_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 left outer as a stream: a signup without a purchase within 12 hours
    is emitted with NULLs once the watermark passes its interval (end-of-input
    markers close the last intervals)."""
    st = events_stream(spark, sf_dir, batches=STATEFUL_BATCHES, flush_types=["signup", "purchase"]) \
        .select("event_id", "ts", "user_id", "event_type")
    j = join_interval(st.where(F.col("event_type") == "signup"), st.where(F.col("event_type") == "purchase"),
                      keys=["user_id"], left_time="ts", right_time="ts",
                      lower_seconds=0, upper_seconds=12 * 3600, how="left", delay="2 minutes")
    out = run_parquet(j.select("user_id", "l_event_id", "l_ts", "r_event_id", "r_ts"), "interval-left",
                      partitions=state_partitions(spark, sf_dir))
    return out.where(F.col("l_ts") < F.to_timestamp_ntz(F.lit(FLUSH_TS)))


ENRICH_SQL = """
SELECT o.o_orderkey, o.o_custkey, o.o_totalprice, o.o_orderdate, c.c_name, c.c_mktsegment, n.n_name
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
"""


def _enriched(orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    cust = customer.select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    j = enrich(orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"),
               cust, {"o_custkey": "c_custkey"})
    j = enrich(j, nation.select("n_nationkey", "n_name"), {"c_nationkey": "n_nationkey"})
    return j.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "c_name", "c_mktsegment", "n_name")


@query("enrich_orders", ENRICH_SQL)
def enrich_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders stream enriched with customer and nation (stream-static joins)."""
    st = stream_file(spark, f"{sf_dir.rstrip('/')}/orders.parquet")
    return run_parquet(_enriched(st, table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")),
                       "enrich")


@query("enrich_orders_batch", ENRICH_SQL)
def enrich_orders_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J4 batch twin."""
    return _enriched(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"),
                     table(spark, sf_dir, "nation"))


@query("enrich_changing_customer", """
SELECT o.o_orderkey, o.o_custkey, c.c_name,
       CASE WHEN o.o_orderkey % 4 >= 2 AND c.c_custkey % 10 = 0 THEN 'CHANGED' ELSE c.c_mktsegment END AS c_mktsegment
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
""")
def enrich_changing_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J4 with a dimension that changes while the stream runs: orders arrive in
    four micro-batches; before the third, a tenth of the customers get another
    segment (a new version in the customer table), which orders from there on see."""
    customers, out = work_path(spark, "customers"), work_path(spark, "orders-enriched")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    tables.write_batch(cust, customers, "crm", 0)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.pmod("o_orderkey", F.lit(4)).alias("arrival"))
    topic = write_arrivals(spark, orders, "orders-arrivals", "arrival")
    st = spark.readStream.schema(orders.schema).option("maxFilesPerTrigger", 1).parquet(topic)
    route = enrich_router(lambda: tables.latest_by_key(tables.read(spark, customers), ["c_custkey"]), {"o_custkey": "c_custkey"}, out)

    def run(batch: DataFrame, epoch_id: int) -> None:
        if epoch_id == 2:   # a customer system writes meanwhile
            tables.write_batch(cust.where("c_custkey % 10 = 0").withColumn("c_mktsegment", F.lit("CHANGED")), customers, "crm", 1)
        route(batch, epoch_id)

    drain(start(st, SinkSpec("foreach_batch", fn=run)))
    return tables.read(spark, out).select("o_orderkey", "o_custkey", "c_name", "c_mktsegment")


DROPS_SQL = f"""
WITH t AS ({trip_sql()}),
d AS (SELECT time_bucket(INTERVAL 5 MINUTE, strptime(dropoff_datetime, '%Y-%m-%d %H:%M:%S')) AS window_start,
             count(*) AS drops
      FROM t WHERE DOLocationID = 258 GROUP BY 1),
r AS (SELECT time_bucket(INTERVAL 5 MINUTE, {TS0_SQL} + to_seconds({hsql(2)} % 86401)) AS window_start,
             min(round(10 + ({hsql(1)} % 2001) / 100.0::DOUBLE, 2)) AS min_temperature
      FROM events WHERE {hsql(0)} % 265 + 1 = 258 GROUP BY 1)
SELECT d.window_start, d.window_start + INTERVAL 5 MINUTE AS window_end, drops, min_temperature
FROM d JOIN r ON d.window_start = r.window_start
"""


def _drops_vs_temperature(trips: DataFrame, temps: DataFrame, delay: str | None) -> DataFrame:
    drops = decode.cast_timestamps(trips.where(F.col("DOLocationID") == 258), ["dropoff_datetime"])
    readings = temps.where(F.col("locationId") == 258)
    return join_windowed(drops, readings, left_time="dropoff_datetime", right_time="record_datetime",
                         size="5 minutes", left_aggs=[F.count(F.lit(1)).alias("drops")],
                         right_aggs=[F.min("temperature").alias("min_temperature")], delay=delay)


@query("drops_vs_temperature", DROPS_SQL)
def drops_vs_temperature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2/A6 as the notebook states it: per 5-minute window at location 258,
    the number of drop-offs and the lowest temperature (batch)."""
    ev = table(spark, sf_dir, "events")
    return _drops_vs_temperature(gen.trips(spark, ev, id_col="event_id"),
                                 gen.temperatures(spark, ev, id_col="event_id"), None)


@query("drops_vs_temperature_stream", DROPS_SQL)
def drops_vs_temperature_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as two generated streams (trips and temperatures over the
    ``events`` file stream) joined with 2-minute watermarks."""
    ids = stream_file(spark, f"{sf_dir.rstrip('/')}/events.parquet").select("event_id")
    trips = gen.trips(spark, ids, id_col="event_id")
    temps = gen.temperatures(spark, ids, id_col="event_id")
    # end-of-input markers at the watermark flush time close the last windows
    marks = work_path(spark, "flush-marks")
    spark.createDataFrame([(-1, "", "", 258, 258, FLUSH_TS, FLUSH_TS)], trips.schema) \
        .write.parquet(f"{marks}/trips")
    spark.createDataFrame([(-1, 258, 99.0, None)], "id bigint, locationId int, temperature double, "
                                                   "record_datetime timestamp_ntz") \
        .withColumn("record_datetime", F.to_timestamp_ntz(F.lit(FLUSH_TS))).write.parquet(f"{marks}/temps")
    trips = trips.unionByName(spark.readStream.schema(trips.schema).parquet(f"{marks}/trips"))
    temps = temps.unionByName(spark.readStream.schema(temps.schema).parquet(f"{marks}/temps"))
    out = run_parquet(_drops_vs_temperature(trips, temps, "2 minutes"), "drops-temperature")
    return out.where(F.col("window_start") < F.to_timestamp_ntz(F.lit(FLUSH_TS)))
