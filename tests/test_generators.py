from pyspark.sql import functions as F

from streamkit.operators import quality
from streamkit.sources import generators as gen


def test_generators_are_partition_independent(spark):
    a = gen.trips(spark, spark.range(0, 500, numPartitions=1)).collect()
    b = gen.trips(spark, spark.range(0, 500, numPartitions=7)).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    assert gen.trips(spark, 500).count() == 500


def test_clickstream_contract_and_spacing(spark):
    c = gen.clickstream(spark, 2000)
    s = quality.summary(quality.clickstream_rules(c)).first()
    assert s.rows == 2000 and all(s[f] == 0 for f in s.__fields__ if f.startswith("bad_"))
    ts = [r.timestamp for r in c.orderBy("id").select("timestamp").collect()]
    secs = [int(__import__("datetime").datetime.strptime(t, "%Y-%m-%d %H:%M:%S").timestamp()) for t in ts]
    gaps = [b - a for a, b in zip(secs, secs[1:])]
    assert min(gaps) >= 1 and max(gaps) <= 299


def test_trip_overrides_and_quality(spark):
    t = gen.trips(spark, 1000, dispatching_base_num="B03494", PULocationID=100)
    assert t.where("dispatching_base_num != 'B03494' or PULocationID != 100").count() == 0
    ok = quality.summary(quality.trip_rules(gen.trips(spark, 1000))).first()
    assert ok.bad_order == 0 and ok.bad_parse == 0 and ok.bad_pickup_zone == 0
    bad = quality.summary(quality.trip_rules(gen.trips(spark, 1000, pickup_datetime="2025-01-01 00:20:00"))).first()
    assert bad.bad_order > 0                      # pickup-only override: dropoff may precede pickup
    many = gen.trips_many(spark, 100, [{"dispatching_base_num": "B03494"}, {"PULocationID": 7}])
    assert many.count() == 200 and many.where("variant = 1 and PULocationID != 7").count() == 0


def test_temperatures_ranges(spark):
    t = gen.temperatures(spark, 3000).agg(F.min("temperature"), F.max("temperature"),
                                          F.min("locationId"), F.max("locationId")).first()
    assert 10 <= t[0] and t[1] <= 30 and 1 <= t[2] and t[3] <= 265


def test_negative_ids_generate_valid_events(spark):
    ids = spark.createDataFrame([(-1,), (-1000003,), (-7,)], "id bigint")
    c = quality.summary(quality.clickstream_rules(gen.clickstream(spark, ids))).first()
    assert c.rows == 3 and all(c[f] == 0 for f in c.__fields__ if f.startswith("bad_"))
    assert gen.trips(spark, ids).where("PULocationID < 1").count() == 0
