from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackmill.operators import analytics
from trackmill.operators.flatten import providers, register_provider, union_providers
from trackmill.operators.keep import keep_last, sort_telemetry
from trackmill.plans import unified

ROW = {
    "provider": "motive", "provider_vehicle_id": "motive_12345", "vin": "1HGBH41JXMN109186", "fleet_number": "T-1", "timestamp": "2025-12-05T10:00:00Z", "latitude": "37.7749", "longitude": "-122.4194",
    "speed_mph": "55.5", "heading_degrees": "270", "engine_state": "On", "driver_id": "7", "driver_name": "Ann Lee", "location_description": "Depot", "odometer": "125000.5",
}


def frame(spark, *changes):
    rows = [{**ROW, **c} for c in changes] or []
    return spark.createDataFrame([tuple(r[c] for c in unified.TELEMETRY_COLUMNS) for r in rows], ", ".join(f"`{c}` string" for c in unified.TELEMETRY_COLUMNS))


def five(spark):
    changes = [
        {"provider": ("motive", "samsara")[i % 2], "provider_vehicle_id": f"vehicle_{i:05d}", "timestamp": f"2025-12-05T10:{i}0:00Z", "speed_mph": str(50 + 5 * i), "engine_state": ("On", "Off")[i % 2], "odometer": str(100000 + 1000 * i), "fleet_number": f"T-{i % 2}"}
        for i in range(5)
    ]
    return unified.enforce_schema(frame(spark, *changes))


def test_types_and_values(spark):
    out = unified.enforce_schema(frame(spark, {}).withColumn("extra", F.lit(1)))
    assert out.schema == unified.TELEMETRY_SCHEMA
    r = out.first()
    assert (r.latitude, r.speed_mph, r.heading_degrees, r.odometer) == (37.7749, 55.5, 270.0, 125000.5)
    assert out.select(F.unix_seconds("timestamp")).first()[0] == int(datetime.fromisoformat("2025-12-05T10:00:00+00:00").timestamp())


def test_bad_values_are_null(spark):
    out = unified.enforce_schema(frame(spark, {"latitude": "invalid", "speed_mph": "N/A", "odometer": "1.0d", "timestamp": "soon", "vin": "  ", "driver_id": " ", "driver_name": ""}, {"longitude": "NaN", "odometer": " 7 ", "timestamp": "2025-12-05T12:00:00+02:00", "speed_mph": "inf"}))
    a, b = out.collect()
    assert [a.latitude, a.speed_mph, a.odometer, a.timestamp, a.vin, a.driver_id, a.driver_name] == [None] * 7 and a.longitude == -122.4194
    assert b.longitude is None and b.odometer == 7.0 and b.speed_mph == float("inf")
    assert out.where("vin IS NOT NULL").select(F.date_format("timestamp", "HH")).first()[0] == "10"


def test_numbers_as_ids(spark):
    out = unified.enforce_schema(frame(spark, {}).withColumn("driver_id", F.lit(101)).withColumn("provider_vehicle_id", F.lit(12345678.0)).withColumn("fleet_number", F.lit(1.5)).withColumn("vin", F.lit(None).cast("double")))
    assert tuple(out.select("driver_id", "provider_vehicle_id", "fleet_number", "vin").first()) == ("101", "12345678", "1.5", None)


def test_idempotent_empty_and_missing(spark):
    once = five(spark)
    assert sorted(map(str, unified.enforce_schema(once).collect())) == sorted(map(str, once.collect()))
    assert unified.enforce_schema(frame(spark)).count() == 0 and unified.enforce_schema(frame(spark)).schema == unified.TELEMETRY_SCHEMA
    with pytest.raises(ValueError, match=r"\['driver_id', 'driver_name'.*'speed_mph'\]"):
        unified.enforce_schema(frame(spark, {}).select("provider", "vin", "timestamp"))


def test_trim(spark):
    df = spark.createDataFrame([(" a ", [" b "], {"k": " c "}, (" d ", [(" e ",)]))], "s string, l array<string>, m map<string,string>, t struct<x:string,y:array<struct<z:string>>>")
    r = unified.trim_strings(df).first()
    assert (r.s, r.l, r.m, r.t.x, r.t.y[0].z) == ("a", ["b"], {"k": "c"}, "d", "e")
    assert unified.trim_strings(df).schema.simpleString() == df.schema.simpleString()


def test_quarantine(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "a"), (3, None)], "id int, kind string")
    good, bad = unified.quarantine(df, {"id": F.col("id").isNotNull(), "kind": unified.in_domain(F.col("kind"), ["a"]), "small": F.col("id") < 3})
    assert [r.id for r in good.collect()] == [1]
    assert sorted(tuple(r._errors) for r in bad.collect()) == [("id", "small"), ("kind",), ("small",)]


def test_filters(spark):
    df = five(spark)
    start, end = datetime.fromisoformat("2025-12-05T10:10:00+00:00"), datetime.fromisoformat("2025-12-05T10:30:00+00:00")
    assert unified.filter_time_range(df, "timestamp", start, end).count() == 3
    assert unified.filter_provider(df, "motive").count() == 3
    assert unified.filter_vehicle(df, fleet_number="T-1").count() == 2
    gaps = df.withColumn("driver_name", F.when(F.col("speed_mph") > 60, F.col("driver_name"))).withColumn("vin", F.when(F.col("speed_mph") > 60, F.col("vin")))
    assert unified.filter_known_driver(gaps).count() == 2 and unified.missing_vin_report(gaps).agg(F.sum("rows_without_vin")).first()[0] == 3
    assert unified.null_counts(gaps).first().vin == 3
    assert unified.filter_not_passenger(spark.createDataFrame([(True,), (False,)], "is_passenger boolean")).count() == 1


def test_keep_last(spark):
    df = unified.enforce_schema(frame(spark, *[{"timestamp": f"2025-12-05T1{i}:00:00Z", "speed_mph": s} for i in range(5) for s in ("50.0", "60.0")])).withColumn("_seq", (F.col("speed_mph") > 55).cast("int"))
    out = keep_last(df)
    assert out.columns == unified.TELEMETRY_COLUMNS and [r.speed_mph for r in out.collect()] == [60.0] * 5
    nulls = spark.createDataFrame([(None, 1, 0), (None, 2, 1), ("a", 3, 0)], "k string, v int, _seq int")
    assert sorted(map(tuple, keep_last(nulls, ["k"]).collect()), key=str) == [("a", 3), (None, 2)]
    last_is_null = spark.createDataFrame([("a", 1, 0), ("a", None, 1)], "k string, v int, _seq int")
    assert keep_last(last_is_null, ["k"]).first().v is None
    assert keep_last(nulls.union(nulls), None).count() == 3


def test_sort(spark):
    df = spark.createDataFrame([("b", "1", None), (None, "1", None), ("a", "2", None), ("a", "1", None)], "provider string, provider_vehicle_id string, timestamp timestamp")
    assert [(r.provider, r.provider_vehicle_id) for r in sort_telemetry(df).collect()] == [("a", "1"), ("a", "2"), ("b", "1"), (None, "1")]


def test_union_and_registry(spark):
    df = five(spark)
    both = union_providers([df, df.withColumn("extra", F.lit(1))])
    assert both.count() == 10 and both.columns == unified.TELEMETRY_COLUMNS
    with pytest.raises(ValueError):
        union_providers([])
    register_provider("zeta", lambda *a: df)
    register_provider("alpha", lambda *a: df)
    assert list(providers(["zeta", "alpha", "unknown"])) == ["alpha", "zeta"]


def test_analytics(spark):
    df = five(spark)
    activity = {r.fleet_number + r.provider[0]: r for r in analytics.vehicle_activity(df).collect()}
    assert activity["T-0m"].records == 3 and activity["T-0m"].mean_speed_mph == 60.0 and activity["T-0m"].max_odometer == 104000.0
    assert analytics.vehicle_summary(df, "T-1").first().distance == 2000.0
    assert analytics.driver_activity(df).first().records == 5
    assert [tuple(r) for r in analytics.value_counts(df, "engine_state").collect()] == [("On", 3), ("Off", 2)]
    d = analytics.describe_numeric(df, "speed_mph").first()
    assert (d["count"], d["mean"], d["p25"], d["p50"], d["max"]) == (5, 60.0, 55.0, 60.0, 70.0)
    hours = analytics.hourly_mean_speed(df.union(df.withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 3 HOURS"))))
    assert hours.count() == 8 and hours.where("mean_speed_mph IS NULL").count() == 4
    days = analytics.daily_counts(df.union(df.withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 2 DAYS"))))
    assert days.count() == 6 and days.where("records = 0").count() == 2
    assert tuple(analytics.dataset_summary(df).first())[:3] == (5, 2, 1)
    assert analytics.distinct_vehicles_by_provider(df, approximate=True).count() == 2 and analytics.mean_speed_by(df, "vin").count() == 1
    util = spark.createDataFrame([(12087, 10921, ""), (13, 8, "device offline")], "idle_time long, driving_time long, message string")
    assert tuple(analytics.utilization_rollup(util).first()) == (23029, pytest.approx(23029 / 3600), 1)
    assert isinstance(df.schema["timestamp"].dataType, T.TimestampType)
