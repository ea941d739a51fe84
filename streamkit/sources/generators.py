"""Deterministic synthetic sources: clickstream, taxi trips, temperatures.

Every field is pure arithmetic on a row id, so output does not depend on
partitioning, task retries or executor count, and it scales with the id
source: ``spark.range(n)``, a column of an existing table, or the ``rate``
stream.  The per-field hash is ``((id mod P) * M_k + C_k) mod P`` with the
prime P below -- small enough that no intermediate overflows a BIGINT for
any id -- and the same formula written in SQL reproduces the rows exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Hash modulus and per-field multipliers/increments.
HASH_PRIME = 1000003
MULTIPLIERS = [7919, 104729, 1299709, 15485863, 2750159, 611953, 486187, 3021377]
INCREMENTS = [11, 23, 37, 53, 71, 89, 101, 131]

# The record vocabularies of the three event kinds.
CLICK_USER_IDS = [1, 2, 3, 4, 5]
CLICK_EVENT_TYPES = ["page_view", "click", "search", "add_to_cart", "purchase"]
CLICK_PAGES = ["/home", "/product", "/search", "/cart", "/checkout"]
CLICK_PRODUCTS = ["widget", "gadget", "thingamajig", "doodad", "whatchamacallit"]
TRIP_BASES = ["B03404", "B03406", "B02510", "B02764", "B03288"]
TRIP_LICENSES = 9          # HV00001 .. HV00009
ZONES = 265                # location ids 1 .. 265
BASE_TIME = "2025-01-01 00:00:00"
TRIP_WINDOW_S = 1800       # pickup and trip length: 0 .. 1800 s
DAY_S = 86400
CLICK_STEP_S = 150          # mean seconds between consecutive clickstream ids
CLICK_PERIOD = 10**9        # ids per lap of the clickstream clock (about 4,750 years)
WIRE_TS = "yyyy-MM-dd HH:mm:ss"


def field_hash(id_col: Column, k: int) -> Column:
    """Non-negative pseudo-random BIGINT in [0, HASH_PRIME) for field k (any id,
    negative ones included)."""
    return (F.pmod(id_col.cast("bigint"), F.lit(HASH_PRIME)) * MULTIPLIERS[k] + INCREMENTS[k]) % HASH_PRIME


def _pick(values: list[str], h: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (h % len(values) + 1).cast("int"))


def _seconds_after_base(secs: Column) -> Column:
    return F.to_timestamp_ntz(F.lit(BASE_TIME)) + F.make_dt_interval(secs=secs.cast("decimal(18,6)"))


def _ids(spark: SparkSession, ids: int | DataFrame, id_col: str) -> DataFrame:
    if isinstance(ids, int):
        return spark.range(ids).withColumnRenamed("id", "_id")
    return ids.select(F.col(id_col).cast("bigint").alias("_id"))


def _override(name: str, generated: Column, overrides: dict) -> Column:
    if name in overrides:
        return F.coalesce(F.lit(overrides[name]).cast(generated_type(name)), generated).alias(name)
    return generated.alias(name)


_TYPES = {"user_id": "int", "PULocationID": "int", "DOLocationID": "int", "locationId": "int",
          "price": "double", "temperature": "double", "record_datetime": "timestamp_ntz"}


def generated_type(name: str) -> str:
    return _TYPES.get(name, "string")


def clickstream(spark: SparkSession, ids: int | DataFrame, *, id_col: str = "id",
                keep_id: bool = True) -> DataFrame:
    """Clickstream events; sparse fields follow the event type:
    ``page`` for page_view/click, ``element`` for click, ``query`` for search,
    ``product`` and ``price`` for add_to_cart/purchase.  Event time rises by
    1-299 s from one id to the next without any global ordering step; the
    clock starts over every ``CLICK_PERIOD`` ids so that any id maps to a
    valid timestamp."""
    base = _ids(spark, ids, id_col)
    i = F.col("_id")
    et = _pick(CLICK_EVENT_TYPES, field_hash(i, 1))
    shopping = F.col("event_type").isin("add_to_cart", "purchase")
    secs = F.pmod(i, F.lit(CLICK_PERIOD)) * CLICK_STEP_S + field_hash(i, 7) % CLICK_STEP_S
    out = (base.select(i, et.alias("event_type"))
           .select(
               *( [i.alias("id")] if keep_id else [] ),
               (field_hash(i, 0) % len(CLICK_USER_IDS) + 1).cast("int").alias("user_id"),
               F.date_format(_seconds_after_base(secs), WIRE_TS).alias("timestamp"),
               "event_type",
               F.when(F.col("event_type").isin("page_view", "click"),
                      _pick(CLICK_PAGES, field_hash(i, 2))).alias("page"),
               F.when(F.col("event_type") == "click",
                      F.concat(F.lit("button"), (field_hash(i, 3) % 50 + 1).cast("string"))).alias("element"),
               F.when(F.col("event_type") == "search",
                      F.concat(F.lit("example search term"),
                               (field_hash(i, 4) % 10 + 1).cast("string"))).alias("query"),
               F.when(shopping, _pick(CLICK_PRODUCTS, field_hash(i, 5))).alias("product"),
               F.when(shopping, F.round(10 + (field_hash(i, 6) % 9001) / 100.0, 2)).alias("price")))
    return out


def trips(spark: SparkSession, ids: int | DataFrame, *, id_col: str = "id",
          keep_id: bool = True, **overrides) -> DataFrame:
    """Taxi trip events.  Pickup is 0-1800 s after the base time (unordered
    on purpose), dropoff 0-1800 s after the generated pickup.  Any field can
    be fixed through ``overrides``; overriding pickup alone keeps the
    generated dropoff, which may then precede pickup (see ``quality``)."""
    base = _ids(spark, ids, id_col)
    i = F.col("_id")
    pickup = _seconds_after_base(field_hash(i, 4) % (TRIP_WINDOW_S + 1))
    dropoff = pickup + F.make_dt_interval(secs=(field_hash(i, 5) % (TRIP_WINDOW_S + 1)).cast("decimal(18,6)"))
    cols = [
        _override("hvfhs_license_num",
                  F.concat(F.lit("HV"), F.lpad((field_hash(i, 0) % TRIP_LICENSES + 1).cast("string"), 5, "0")),
                  overrides),
        _override("dispatching_base_num", _pick(TRIP_BASES, field_hash(i, 1)), overrides),
        _override("PULocationID", (field_hash(i, 2) % ZONES + 1).cast("int"), overrides),
        _override("DOLocationID", (field_hash(i, 3) % ZONES + 1).cast("int"), overrides),
        _override("pickup_datetime", F.date_format(pickup, WIRE_TS), overrides),
        _override("dropoff_datetime", F.date_format(dropoff, WIRE_TS), overrides),
    ]
    return base.select(*([i.alias("id")] if keep_id else []), *cols)


def trips_many(spark: SparkSession, ids: int | DataFrame, overrides_list: list[dict], *,
               id_col: str = "id") -> DataFrame:
    """Several override sets at once, interleaved into one output.

    Each id yields one row per override set through ``explode`` of a literal
    array (no join); ``variant`` numbers the set.
    """
    names = ["hvfhs_license_num", "dispatching_base_num", "PULocationID", "DOLocationID",
             "pickup_datetime", "dropoff_datetime"]
    sets = F.array(*[F.struct(F.lit(v).alias("variant"),
                              *[F.lit(o.get(n)).cast(generated_type(n)).alias(n) for n in names])
                     for v, o in enumerate(overrides_list)])
    plain = trips(spark, ids, id_col=id_col)
    exploded = plain.select("*", F.explode(sets).alias("_o"))
    return exploded.select("id", F.col("_o.variant").alias("variant"),
                           *[F.coalesce(F.col(f"_o.{n}"), F.col(n)).alias(n) for n in names])


def temperatures(spark: SparkSession, ids: int | DataFrame, *, id_col: str = "id",
                 keep_id: bool = True, **overrides) -> DataFrame:
    """Temperature readings: location 1-265, 10.00-30.00 degrees, any second of the base day."""
    base = _ids(spark, ids, id_col)
    i = F.col("_id")
    cols = [
        _override("locationId", (field_hash(i, 0) % ZONES + 1).cast("int"), overrides),
        _override("temperature", F.round(10 + (field_hash(i, 1) % 2001) / 100.0, 2), overrides),
        _override("record_datetime", _seconds_after_base(field_hash(i, 2) % (DAY_S + 1)), overrides),
    ]
    return base.select(*([i.alias("id")] if keep_id else []), *cols)


KINDS = {"clickstream": clickstream, "trips": trips, "temperatures": temperatures}


def rate_events(spark: SparkSession, kind: str, rows_per_second: int, *,
                num_partitions: int | None = None, **overrides) -> DataFrame:
    """Paced stream of generated events from the ``rate`` source: ids are the
    rate source's ``value`` column, so pacing is Spark's, not a sleep loop."""
    reader = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second)
    if num_partitions:
        reader = reader.option("numPartitions", num_partitions)
    ticks = reader.load()
    fn = KINDS[kind]
    return fn(spark, ticks.select(F.col("value").alias("id")), **overrides)


def hash_sql(id_expr: str, k: int) -> str:
    """``field_hash`` written as SQL, for oracles and SQL users."""
    return (f"((((({id_expr}) % {HASH_PRIME}) + {HASH_PRIME}) % {HASH_PRIME}) * {MULTIPLIERS[k]}"
            f" + {INCREMENTS[k]}) % {HASH_PRIME}")
