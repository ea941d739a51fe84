"""Registered queries: synthetic clickstream, trip and temperature events
derived from the ``events`` ids, and their quality checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from streamkit.plans.common import CLICK_SQL, PICKUP_ONLY, TRIP_OVERRIDES, TS0_SQL, hsql, many_sql, trip_sql
from streamkit.plans.registry import query
from streamkit.plans.topics import table
from streamkit.sources import generators as gen


@query("gen_clickstream", CLICK_SQL)
def gen_clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One clickstream event per ``events`` row (ids from ``event_id``)."""
    return gen.clickstream(spark, table(spark, sf_dir, "events"), id_col="event_id")


@query("gen_trips", trip_sql())
def gen_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One taxi trip per ``events`` row."""
    return gen.trips(spark, table(spark, sf_dir, "events"), id_col="event_id")


@query("gen_trips_many", many_sql(TRIP_OVERRIDES))
def gen_trips_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The producer notebook's two override sets, interleaved into one output."""
    return gen.trips_many(spark, table(spark, sf_dir, "events"), TRIP_OVERRIDES, id_col="event_id")


@query("gen_temperatures", f"""
SELECT event_id AS id, CAST({hsql(0)} % 265 + 1 AS INTEGER) AS locationId,
       round(10 + ({hsql(1)} % 2001) / 100.0::DOUBLE, 2) AS temperature,
       {TS0_SQL} + to_seconds({hsql(2)} % 86401) AS record_datetime
FROM events
""")
def gen_temperatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One temperature reading per ``events`` row."""
    return gen.temperatures(spark, table(spark, sf_dir, "events"), id_col="event_id")


@query("quality_trips", f"""
WITH t AS ({many_sql(TRIP_OVERRIDES + [PICKUP_ONLY])}),
p AS (SELECT *, try_strptime(pickup_datetime, '%Y-%m-%d %H:%M:%S') AS pu,
                try_strptime(dropoff_datetime, '%Y-%m-%d %H:%M:%S') AS dof FROM t)
SELECT variant, count(*) AS rows,
       count(*) FILTER (WHERE pu IS NULL OR dof IS NULL) AS bad_parse,
       count(*) FILTER (WHERE NOT coalesce(dof >= pu, false)) AS bad_order,
       count(*) FILTER (WHERE NOT coalesce(PULocationID BETWEEN 1 AND 265, false)) AS bad_pickup_zone,
       count(*) FILTER (WHERE NOT coalesce(DOLocationID BETWEEN 1 AND 265, false)) AS bad_dropoff_zone
FROM p GROUP BY variant
""")
def quality_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2: trip rules per override set; a pickup-only override yields dropoffs before pickups."""
    trips = gen.trips_many(spark, table(spark, sf_dir, "events"), TRIP_OVERRIDES + [PICKUP_ONLY],
                           id_col="event_id")
    from streamkit.operators import quality
    return quality.summary(quality.trip_rules(trips), ["variant"])


@query("quality_clickstream", f"""
WITH c AS ({CLICK_SQL})
SELECT count(*) AS rows,
  count(*) FILTER (WHERE NOT coalesce(event_type IN {tuple(gen.CLICK_EVENT_TYPES)}, false)) AS bad_event_type,
  count(*) FILTER (WHERE (page IS NOT NULL) <> coalesce(event_type IN ('page_view', 'click'), false)) AS bad_page,
  count(*) FILTER (WHERE (element IS NOT NULL) <> coalesce(event_type = 'click', false)) AS bad_element,
  count(*) FILTER (WHERE (query IS NOT NULL) <> coalesce(event_type = 'search', false)) AS bad_query,
  count(*) FILTER (WHERE NOT ((product IS NOT NULL) = coalesce(event_type IN ('add_to_cart', 'purchase'), false)
                          AND (price IS NOT NULL) = coalesce(event_type IN ('add_to_cart', 'purchase'), false)))
    AS bad_product,
  count(*) FILTER (WHERE try_strptime(timestamp, '%Y-%m-%d %H:%M:%S') IS NULL) AS bad_timestamp
FROM c
""")
def quality_clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1: the clickstream sparse-field contract, as violation counts."""
    from streamkit.operators import quality
    clicks = gen.clickstream(spark, table(spark, sf_dir, "events"), id_col="event_id")
    return quality.summary(quality.clickstream_rules(clicks))
