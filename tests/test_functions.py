from datetime import datetime

import pytest
from pyspark.sql import functions as F

from trackmill.functions import telemetry as fn
from trackmill.sources.schemas import DOMAINS


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


def lit(value, kind):
    return F.lit(value).cast(kind)


@pytest.mark.parametrize("speed, metric, want", [(100.0, True, 62.1371), (100.0, False, 100.0), (None, True, None), (50.0, None, 50.0), (0.0, True, 0.0)])
def test_speed(spark, speed, metric, want):
    assert one(spark, fn.speed_to_mph(lit(speed, "double"), lit(metric, "boolean"))) == (None if want is None else pytest.approx(want))


def state_by_hand(kind, mph):
    if kind is None and mph is None:
        return None
    if kind in ("vehicle_stopped", "gps_stopped"):
        return "Idle"
    if kind in ("ignition_off", "engine_stop"):
        return "Off"
    if mph is not None:
        return "On" if mph > 3.0 else "Idle"
    if kind in ("vehicle_moving", "vehicle_driving", "gps_moving"):
        return "On"
    if kind in ("ignition_on", "engine_start"):
        return "Idle"
    return "Off"


def test_engine_state_for_every_type_and_speed(spark):
    cases = [(k, s) for k in (*DOMAINS["location_type"], "vehicle_driving", None) for s in (None, 0.0, 3.0, 3.0001, 50.0)]
    got = spark.createDataFrame(cases, "k string, s double").select("k", "s", fn.derive_engine_state(F.col("k"), F.col("s")).alias("x"))
    for r in got.collect():
        assert r.x == state_by_hand(r.k, r.s), r


def test_names_and_places(spark):
    person = F.struct(F.lit("Ann").alias("first_name"), F.lit("Lee").alias("last_name"))
    assert one(spark, fn.full_name(person)) == "Ann Lee"
    assert one(spark, fn.full_name(F.lit(None).cast("struct<first_name:string,last_name:string>"))) is None
    assert one(spark, fn.terminal_location(F.lit("Reno"), F.lit("NV"))) == "Reno, NV"
    assert one(spark, fn.terminal_location(F.lit("Reno"), F.lit(""))) is None
    assert one(spark, fn.coordinates(F.lit(1.0), lit(None, "double"))) is None
    ids = F.create_map(F.lit("samsara.vin"), F.lit("V1"))
    assert one(spark, fn.vin(ids)) == "V1" and one(spark, fn.serial(ids)) is None


def test_units_and_domains(spark):
    assert one(spark, fn.meters_to_miles(F.lit(1609344))) == 1000.0
    assert one(spark, fn.meters_to_km(F.lit(1500))) == 1.5
    assert one(spark, fn.normalize_engine_state(F.lit("iDLE"))) == "Idle" and one(spark, fn.normalize_engine_state(F.lit("x"))) is None
    assert one(spark, fn.normalize_fuel_type(F.lit("Diesel"))) == "diesel" and one(spark, fn.normalize_fuel_type(F.lit("coal"))) is None
    assert one(spark, fn.normalize_message(F.lit(""))) is None and one(spark, fn.normalize_message(F.lit(" "))) == " "
    assert one(spark, fn.engine_on_seconds(F.lit(12087), F.lit(10921))) == 23008
    assert one(spark, fn.engine_on_hours(F.lit(3600), F.lit(1800))) == 1.5
    assert one(spark, fn.size_in(F.lit(1024.0 * 1024), "mb")) == 1.0
    assert one(spark, fn.best_odometer(lit(None, "double"), F.lit(2.0))) == 2.0


def test_flags(spark):
    assert one(spark, fn.is_moving_motive(F.lit("gps_moving"), lit(None, "double"))) is True
    assert one(spark, fn.is_moving_motive(F.lit("ignition_off"), lit(None, "double"))) is False
    assert one(spark, fn.is_moving_motive(F.lit("ignition_off"), F.lit(1.0))) is True
    assert one(spark, fn.is_moving_samsara(lit(None, "double"))) is False
    assert one(spark, fn.has_items(lit(None, "array<int>"))) is False
    assert one(spark, fn.has_items(F.array(F.lit(1)))) is True
    assert one(spark, fn.equals(lit(None, "string"), "active")) is False
    assert one(spark, fn.is_top_level(lit(None, "long"))) is True


@pytest.mark.parametrize("total, per, want", [(1455, 25, 59), (100, 100, 1), (101, 100, 2), (0, 100, 0), (5, 0, 0)])
def test_pages(spark, total, per, want):
    assert one(spark, fn.total_pages(F.lit(total), F.lit(per))) == want
    assert one(spark, fn.next_page(F.lit(1), F.lit(total), F.lit(per))) == (2 if want > 1 else None)


def test_times(spark):
    at = F.lit(datetime(2024, 1, 31, 23, 59, 59, 999999)).cast("timestamp_ntz").cast("timestamp")
    assert one(spark, fn.format_utc_z(at)) == "2024-01-31T23:59:59Z"
    assert str(one(spark, fn.to_partition_date(at))) == "2024-01-31"
    a, b = lit("2024-01-01T00:00:00Z", "timestamp"), lit("2024-01-01T01:00:00.5Z", "timestamp")
    assert one(spark, fn.duration_seconds(a, b)) == 3600.5
    assert one(spark, fn.contains_timestamp(a, b, b)) is True and one(spark, fn.contains_timestamp(a, b, b + F.expr("INTERVAL 1 MICROSECOND"))) is False
