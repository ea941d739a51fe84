"""Data-quality rules for the event kinds, as boolean columns and counts.

``*_rules`` return the input with one boolean column per rule (True = the
row passes); ``summary`` turns those into one row of violation counts.
Everything is a projection plus one global aggregate with map-side partial
counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamkit.sources.generators import CLICK_EVENT_TYPES, ZONES, WIRE_TS


def _present(c: str) -> Column:
    return F.col(c).isNotNull()


def clickstream_rules(df: DataFrame) -> DataFrame:
    """Sparse-field contract: ``page`` iff page_view/click, ``element`` iff
    click, ``query`` iff search, ``product`` and ``price`` iff add_to_cart or
    purchase; event type known; timestamp parses."""
    et = F.col("event_type")
    shopping = et.isin("add_to_cart", "purchase")
    return df.select(
        "*",
        F.coalesce(et.isin(*CLICK_EVENT_TYPES), F.lit(False)).alias("ok_event_type"),
        (_present("page") == F.coalesce(et.isin("page_view", "click"), F.lit(False))).alias("ok_page"),
        (_present("element") == F.coalesce(et == "click", F.lit(False))).alias("ok_element"),
        (_present("query") == F.coalesce(et == "search", F.lit(False))).alias("ok_query"),
        ((_present("product") == F.coalesce(shopping, F.lit(False))) &
         (_present("price") == F.coalesce(shopping, F.lit(False)))).alias("ok_product"),
        F.try_to_timestamp(F.col("timestamp"), F.lit(WIRE_TS)).isNotNull().alias("ok_timestamp"))


def trip_rules(df: DataFrame) -> DataFrame:
    """Trip sanity: both datetimes parse, dropoff not before pickup, zones in 1..265."""
    pu = F.try_to_timestamp(F.col("pickup_datetime").cast("string"), F.lit(WIRE_TS))
    do = F.try_to_timestamp(F.col("dropoff_datetime").cast("string"), F.lit(WIRE_TS))
    return df.select(
        "*",
        (pu.isNotNull() & do.isNotNull()).alias("ok_parse"),
        F.coalesce(do >= pu, F.lit(False)).alias("ok_order"),
        F.coalesce(F.col("PULocationID").between(1, ZONES), F.lit(False)).alias("ok_pickup_zone"),
        F.coalesce(F.col("DOLocationID").between(1, ZONES), F.lit(False)).alias("ok_dropoff_zone"))


def null_rows(df: DataFrame, cols: list[str] | None = None) -> Column:
    """True when every one of ``cols`` is NULL (a message that decoded to nothing)."""
    cols = cols or df.columns
    out = F.lit(True)
    for c in cols:
        out = out & F.col(f"`{c}`").isNull()
    return out


def summary(checked: DataFrame, group_by: list[str] | None = None) -> DataFrame:
    """Rows and violations per rule (``bad_<rule>``), optionally per group."""
    rules = [c for c in checked.columns if c.startswith("ok_")]
    aggs = [F.count(F.lit(1)).alias("rows")] + \
           [F.count_if(~F.col(r)).alias("bad_" + r[3:]) for r in rules]
    return checked.groupBy(*group_by).agg(*aggs) if group_by else checked.agg(*aggs)
