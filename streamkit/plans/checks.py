"""Registered queries: quality rules on the given tables, progress rows of a
stream, and drift of JSON payloads kept as variants."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from streamkit.functions import schema
from streamkit.operators import quality, tables
from streamkit.operators.audit import batch_metrics
from streamkit.plans.registry import query
from streamkit.plans.topics import table, write_arrivals
from streamkit.session import work_path
from streamkit.sources.generators import CLICK_EVENT_TYPES
from streamkit.streaming.run import ProgressTable, drain
from streamkit.streaming.sinks import SinkSpec, start

# How a shop's events are laid out as clickstream fields in the check below.
WIRE = "%Y-%m-%d %H:%M:%S"


@query("quality_events", f"""
WITH c AS (
  SELECT event_type,
         CASE WHEN event_type = 'click' OR user_id % 5 = 0 THEN props END AS page,
         CASE WHEN event_type = 'click' AND user_id % 3 > 0 THEN props END AS element,
         CASE WHEN value > 90 THEN props END AS query,
         CASE WHEN event_type = 'purchase' THEN props END AS product,
         CASE WHEN event_type = 'purchase' AND value > 10 THEN value END AS price,
         CASE WHEN user_id % 7 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M') ELSE strftime(ts, '{WIRE}') END AS timestamp
  FROM events)
SELECT event_type, count(*) AS rows,
  count(*) FILTER (WHERE NOT coalesce(event_type IN {tuple(CLICK_EVENT_TYPES)}, false)) AS bad_event_type,
  count(*) FILTER (WHERE (page IS NOT NULL) <> coalesce(event_type IN ('page_view', 'click'), false)) AS bad_page,
  count(*) FILTER (WHERE (element IS NOT NULL) <> coalesce(event_type = 'click', false)) AS bad_element,
  count(*) FILTER (WHERE (query IS NOT NULL) <> coalesce(event_type = 'search', false)) AS bad_query,
  count(*) FILTER (WHERE NOT ((product IS NOT NULL) = coalesce(event_type IN ('add_to_cart', 'purchase'), false)
                          AND (price IS NOT NULL) = coalesce(event_type IN ('add_to_cart', 'purchase'), false))) AS bad_product,
  count(*) FILTER (WHERE try_strptime(timestamp, '{WIRE}') IS NULL) AS bad_timestamp
FROM c GROUP BY event_type
""")
def quality_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1 on ``events``: the clickstream rules over fields made of its columns;
    each rule is broken by some of the rows."""
    ev, et = table(spark, sf_dir, "events"), F.col("event_type")
    fields = ev.select(
        "event_type",
        F.when((et == "click") | (F.col("user_id") % 5 == 0), F.col("props")).alias("page"),
        F.when((et == "click") & (F.col("user_id") % 3 > 0), F.col("props")).alias("element"),
        F.when(F.col("value") > 90, F.col("props")).alias("query"),
        F.when(et == "purchase", F.col("props")).alias("product"),
        F.when((et == "purchase") & (F.col("value") > 10), F.col("value")).alias("price"),
        F.when(F.col("user_id") % 7 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm"))
         .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("timestamp"))
    return quality.summary(quality.clickstream_rules(fields), ["event_type"])


@query("quality_shipments", f"""
WITH t AS (
  SELECT l_returnflag, strftime(o_orderdate, '{WIRE}') AS pickup_datetime,
         CASE WHEN l_linenumber = 7 THEN strftime(l_shipdate, '%d.%m.%Y') ELSE strftime(l_shipdate, '{WIRE}') END AS dropoff_datetime,
         l_orderkey % 300 AS PULocationID, l_partkey % 300 AS DOLocationID
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
p AS (SELECT *, try_strptime(pickup_datetime, '{WIRE}') AS pu, try_strptime(dropoff_datetime, '{WIRE}') AS dof FROM t)
SELECT l_returnflag, count(*) AS rows,
       count(*) FILTER (WHERE pu IS NULL OR dof IS NULL) AS bad_parse,
       count(*) FILTER (WHERE NOT coalesce(dof >= pu, false)) AS bad_order,
       count(*) FILTER (WHERE NOT coalesce(PULocationID BETWEEN 1 AND 265, false)) AS bad_pickup_zone,
       count(*) FILTER (WHERE NOT coalesce(DOLocationID BETWEEN 1 AND 265, false)) AS bad_dropoff_zone
FROM p GROUP BY l_returnflag
""")
def quality_shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2 on ``orders`` and ``lineitem``: the trip rules over shipments, from
    order date to ship date; each rule is broken by some of the rows."""
    li, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    wire = "yyyy-MM-dd HH:mm:ss"
    trips = li.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_returnflag", F.date_format("o_orderdate", wire).alias("pickup_datetime"),
        F.when(F.col("l_linenumber") == 7, F.date_format("l_shipdate", "dd.MM.yyyy")).otherwise(F.date_format("l_shipdate", wire)).alias("dropoff_datetime"),
        (F.col("l_orderkey") % 300).alias("PULocationID"), (F.col("l_partkey") % 300).alias("DOLocationID"))
    return quality.summary(quality.trip_rules(trips), ["l_returnflag"])


@query("progress_rows", """
WITH a AS (SELECT event_id % 4 AS epoch, CAST(event_id // 4 % 2 AS INTEGER) AS source, event_type FROM events),
e AS (SELECT epoch, count(*) AS n, count(*) FILTER (WHERE event_type = 'purchase') AS purchases FROM a GROUP BY epoch)
SELECT a.epoch, a.source, count(*) AS input_rows, any_value(e.n) AS epoch_rows, any_value(e.n) AS observed_rows, any_value(e.purchases) AS observed_purchases
FROM a JOIN e ON e.epoch = a.epoch GROUP BY a.epoch, a.source
""")
def progress_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of two sources in four micro-batches; the progress
    table has each source's rows, and what each micro-batch observed."""
    ev = table(spark, sf_dir, "events").withColumn("epoch", F.pmod("event_id", F.lit(4)))
    sides = []
    for side in (0, 1):
        mine = ev.where(F.expr("event_id div 4 % 2") == side)
        path = write_arrivals(spark, mine, f"progress-side{side}", "epoch")
        sides.append(spark.readStream.schema(mine.schema).option("maxFilesPerTrigger", 1).parquet(path))
    both = batch_metrics(sides[0].unionByName(sides[1]), "seen", purchases="event_type = 'purchase'")
    path = work_path(spark, "progress")
    listener = ProgressTable(spark, path).add()
    try:
        drain(start(both, SinkSpec("table_append", name="two_sources", path=work_path(spark, "two-sources"))))
    finally:
        listener.remove()
    seen = lambda name: F.get_json_object("observed", f"$.seen.{name}").cast("bigint")
    return tables.read(spark, path).select("epoch", "source", "input_rows", "epoch_rows",
                                           seen("rows").alias("observed_rows"), seen("purchases").alias("observed_purchases"))


@query("evolve_variant", """
SELECT event_id, event_type, user_id AS rest_user, value AS rest_value, event_type || '!' AS rest_tag,
       CAST(2 AS BIGINT) AS rest_fields FROM events
""")
def evolve_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads carry nested fields the reader's schema does not know; one
    parse gives the known fields by type and the rest as a variant, in which
    nothing is lost."""
    ev = table(spark, sf_dir, "events")
    payload = F.to_json(F.struct("event_id", "event_type", F.struct(F.col("user_id").alias("id"), F.col("value").alias("score")).alias("user"),
                                 F.array(F.struct(F.col("event_type").alias("tag")), F.struct(F.concat("event_type", F.lit("!")).alias("tag"))).alias("tags")))
    parsed = schema.evolve_variant(ev.select(payload.alias("json")), "json", "event_id BIGINT, event_type STRING")
    get = lambda path, kind: F.try_variant_get("_rest", path, kind)
    return parsed.select("event_id", "event_type", get("$.user.id", "bigint").alias("rest_user"), get("$.user.score", "double").alias("rest_value"),
                         get("$.tags[1].tag", "string").alias("rest_tag"), F.size(get("$", "map<string, variant>")).cast("bigint").alias("rest_fields"))
