import json
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from trackmill.operators import storage
from trackmill.operators.flatten import flatten_motive, flatten_samsara
from trackmill.plans.unified import TELEMETRY_COLUMNS, enforce_schema
from trackmill.sources import pages
from trackmill.streaming import incremental


def land(folder, *documents):
    Path(folder).mkdir(parents=True, exist_ok=True)
    Path(folder, f"p{len(list(Path(folder).iterdir()))}.json").write_text("\n".join(json.dumps(d) for d in documents))
    return str(folder)


PERSON = {"id": 9, "first_name": "Ann", "last_name": "Lee", "status": "active", "role": "driver"}
VEHICLE = {"id": 1, "company_id": 2, "number": " T-1 ", "status": "active", "ifta": True, "vin": "V1", "metric_units": True, "fuel_type": "DIESEL", "created_at": "2024-01-01T00:00:00Z", "updated_at": "2024-01-01T00:00:00Z", "external_ids": [{"a": 1}], "surprise": 5}


def location(i, at, **more):
    return {"vehicle_location": {"id": str(i), "located_at": at, "lat": 1.0, "lon": 2.0, "type": "breadcrumb", "description": "Depot", "speed": 100.0, "bearing": 90.0, "odometer": 10.0, "true_odometer": 11.0, "driver": PERSON, **more}}


def motive(tmp_path, *locations):
    v = land(tmp_path / "vehicles", {"vehicles": [{"vehicle": VEHICLE}, {"vehicle": {**VEHICLE, "id": 2, "status": "lost"}}], "pagination": {"per_page": 2, "page_no": 1, "total": 2}})
    return v, land(tmp_path / "locations", {"vehicle_id": 1, "vehicle_locations": list(locations)}, {"vehicle_id": 77, "vehicle_locations": [location(5, "2024-01-01T00:00:00Z")]})


def test_two_level_pages(spark, tmp_path):
    v, _ = motive(tmp_path)
    items = pages.unwrap_items(pages.read_pages(spark, "motive_vehicles", v), "motive_vehicles")
    good, bad = pages.validated(items, "motive_vehicles")
    r = good.first()
    assert (r.number, r.fuel_type, r.metric_units, r.prevent_auto_odometer_entry, r.driver_facing_camera, r.external_ids) == ("T-1", "diesel", True, False, -1, ['{"a": 1}'])
    assert bad.first()._errors == ["status unknown"]
    table = pages.to_table(good)
    assert "_file" not in table.columns and pages.to_table(good.limit(0)).columns == table.columns


def test_bad_fields_mark_the_page(spark, tmp_path):
    path = land(tmp_path, {"vehicles": [{"vehicle": {**VEHICLE, "company_id": "x"}}], "pagination": {"per_page": 1, "page_no": 1, "total": 1}})
    read = pages.read_pages(spark, "motive_vehicles", path).cache()
    assert read.where("_corrupt IS NOT NULL").count() == 1
    good, bad = pages.validated(pages.unwrap_items(read, "motive_vehicles"), "motive_vehicles")
    assert good.count() == 0 and bad.count() <= 1


def test_flatten_motive(spark, tmp_path):
    v, l = motive(tmp_path, location(1, "2024-01-01T10:00:00Z"), location(2, "2024-01-01T11:00:00Z", speed=None, true_odometer=None, driver=None), location(3, "2024-01-01T12:00:00Z", speed=None, type="ignition_off"))
    rows = flatten_motive(pages.motive_vehicle_locations(spark, l), pages.motive_vehicles(spark, v))
    assert rows.columns == TELEMETRY_COLUMNS
    a, b, c = enforce_schema(rows).orderBy("timestamp").collect()
    assert (a.provider, a.provider_vehicle_id, a.vin, a.fleet_number, a.speed_mph, a.engine_state, a.driver_id, a.driver_name, a.odometer) == ("motive", "1", "V1", "T-1", pytest.approx(62.1371), "On", "9", "Ann Lee", 11.0)
    assert (b.speed_mph, b.engine_state, b.driver_id, b.driver_name, b.odometer) == (None, "Off", None, None, 10.0)
    assert c.engine_state == "Off"


STATS = {
    "id": "s1", "name": "Truck", "externalIds": {"samsara.vin": "SV"}, "engineStates": [{"time": "2024-01-01T10:00:00Z", "value": "on"}, {"time": "2024-01-01T09:00:00Z", "value": "IDLE"}],
    "gps": [{"time": f"2024-01-01T{h}:00Z", "latitude": 1.0, "longitude": 2.0, "speedMilesPerHour": 5.0, "headingDegrees": 7.0, "reverseGeo": {"formattedLocation": " Main St "}} for h in ("08:00", "09:30", "10:00", "11:00")],
    "obdOdometerMeters": [{"time": "2024-01-01T09:45:00Z", "value": 1609344}],
}
ASSIGNMENTS = [
    {"startTime": "2024-01-01T09:00:00Z", "endTime": "2024-01-01T10:00:00Z", "isPassenger": p, "assignmentType": "HOS", "driver": {"id": d, "name": n}, "vehicle": {"id": "s1", "name": "Truck"}} for p, d, n in ((True, "0", "Rider"), (False, "1", "Ann"), (False, "2", "Bob"))
]


def test_flatten_samsara(spark, tmp_path):
    s = land(tmp_path / "stats", {"data": [STATS, {"id": "s2", "name": "Idle one"}], "pagination": {"endCursor": "x", "hasNextPage": False}})
    a = land(tmp_path / "assignments", {"data": ASSIGNMENTS})
    stats = pages.samsara_vehicle_stats(spark, s)
    rows = enforce_schema(flatten_samsara(stats, pages.samsara_driver_assignments(spark, a))).orderBy("timestamp").collect()
    assert [(r.engine_state, r.driver_name, r.odometer) for r in rows] == [(None, None, None), ("Idle", "Ann", 1000.0), ("On", "Ann", 1000.0), ("On", None, None)]
    assert (rows[0].vin, rows[0].fleet_number, rows[0].location_description) == ("SV", "Truck", "Main St")
    without = flatten_samsara(stats, None)
    assert without.count() == 4 and without.where("driver_id IS NOT NULL").count() == 0
    assert pages.explode_series(stats, "engine_states").count() == 2
    with pytest.raises(ValueError):
        pages.explode_series(stats, "fuel")


def test_other_endpoints(spark, tmp_path):
    d = land(tmp_path / "d", {"data": [{"id": "1", "name": "A", "driverActivationStatus": "active", "eldSettings": {"rulesets": [{"break": "b", "cycle": "c"}]}}, {"id": "2", "name": "B", "driverActivationStatus": "deactivated"}]})
    assert [r.eld_settings.rulesets[0].break_rule for r in pages.samsara_drivers(spark, d, "active").collect()] == ["b"]
    ad = land(tmp_path / "a", {"data": [{"id": "1", "name": "Yard", "geofence": {"polygon": {"vertices": [{"latitude": 1.0, "longitude": 2.0}]}}}]})
    assert pages.samsara_addresses(spark, ad).first().geofence.polygon.vertices[0].longitude == 2.0
    sv = land(tmp_path / "v", {"data": [{"id": "1", "name": "V", "tags": [{"id": "t", "name": "n", "parentTagId": "p"}], "vehicleRegulationMode": "regulated"}]})
    assert pages.samsara_vehicles(spark, sv).first().tags[0].parent_tag_id == "p"
    ls = land(tmp_path / "l", {"data": [{"happenedAtTime": f"2024-01-01T0{h}:00:00Z", "asset": {"id": "1"}, "location": {"latitude": 1.0, "longitude": 2.0}} for h in range(4)]})
    start, end = datetime(2024, 1, 1, 1, tzinfo=timezone.utc), datetime(2024, 1, 1, 2, tzinfo=timezone.utc)
    assert pages.samsara_location_stream(spark, ls, ["1"], start, end).count() == 2 and pages.samsara_location_stream(spark, ls, ["2"]).count() == 0
    g = land(tmp_path / "g", {"groups": [{"group": {"id": 1, "name": "G", "company_id": 2, "user": PERSON}}], "pagination": {"per_page": 1, "page_no": 1, "total": 1}})
    assert pages.motive_groups(spark, g).first().parent_id is None
    u = land(tmp_path / "u", {"users": [{"user": {"id": 1, "first_name": "A", "last_name": "B", "role": "driver", "status": "active", "created_at": "2024-01-01T00:00:00Z", "updated_at": "2024-01-01T00:00:00Z"}}]})
    r = pages.motive_users(spark, u).first()
    assert r.minute_logs is True and r.exception_wait_time is False and r.exception_24_hour_restart2 is False
    x = {"last_located_at": "2026-05-07T12:11:17+09:00", "utilization_percentage": 1.0, "idle_time": 12087, "idle_fuel": 1.0, "driving_time": 10921, "driving_fuel": 1.0, "total_fuel": 2.0, "total_distance": 3.0, "vehicle": {"id": 1, "number": "n"}}
    mu = land(tmp_path / "mu", {"vehicle_utilizations": [{"vehicle_utilization": {**x, "message": ""}}, {"vehicle_utilization": {**x, "message": "bad", "last_located_at": None}}], "pagination": {"per_page": 25, "page_no": 1, "total": 1455}})
    rows = pages.motive_vehicle_utilization(spark, mu)
    assert [r.message for r in rows.orderBy("_pos").collect()] == [None, "bad"]
    assert pages.audit_pages(pages.read_pages(spark, "motive_vehicle_utilization", mu), "motive_vehicle_utilization").first().expected == 59
    ids = spark.createDataFrame([("1",)], "id string")
    a = land(tmp_path / "as", {"data": ASSIGNMENTS})
    assert pages.samsara_driver_assignments(spark, a, "drivers", ids).count() == 1 and pages.samsara_driver_assignments(spark, a, "vehicles", ids).count() == 0
    assert pages.samsara_driver_assignments(spark, a, start=datetime(2024, 1, 2, tzinfo=timezone.utc), end=datetime(2024, 1, 3, tzinfo=timezone.utc)).count() == 0
    with pytest.raises(ValueError):
        pages.samsara_driver_assignments(spark, a, "cars")


def test_what_is_left_out_and_what_is_missing(spark, tmp_path):
    g = land(tmp_path / "g", {"groups": [{"group": {"id": 1, "name": "G", "company_id": 2}}, {"group": {"id": 2, "company_id": 2}}], "pagination": {"per_page": 2, "page_no": 1, "total": 2}})
    Path(g, "broken.json").write_text("{not json")
    found = pages.rejected(pages.read_pages(spark, "motive_groups", g), "motive_groups").orderBy("reason").collect()
    assert [r.reason for r in found] == ["name missing", "unreadable page"] and found[1].content == "{not json" and '"id":2' in found[0].content
    assert pages.or_none(pages.motive_groups, spark, str(tmp_path / "nowhere")) is None and pages.or_none(pages.motive_groups, spark, g).count() == 1
    stats = spark.createDataFrame([("v", [("warp",), ("on",), (None,)])], "id string, engine_states array<struct<value: string>>")
    assert [r.value for r in pages.unknown_states(stats).collect()] == ["warp", None]


def test_audits(spark, tmp_path):
    p = land(tmp_path / "m", *[{"groups": [], "pagination": {"per_page": 10, "page_no": n, "total": 35}} for n in (1, 2, 4)])
    r = pages.audit_pages(pages.read_pages(spark, "motive_groups", p), "motive_groups").first()
    assert (r.expected, r.seen, r.missing, r.complete) == (4, [1, 2, 4], [3], False)
    c = land(tmp_path / "s", {"data": [], "pagination": {"endCursor": "a", "hasNextPage": True}})
    assert not pages.audit_pages(pages.read_pages(spark, "samsara_vehicles", c), "samsara_vehicles").first().complete
    land(tmp_path / "s", {"data": [], "pagination": {"endCursor": "", "hasNextPage": False}})
    assert pages.audit_pages(pages.read_pages(spark, "samsara_vehicles", c), "samsara_vehicles").first().complete


def test_windows_and_start(spark, tmp_path):
    t = datetime(2024, 1, 1, tzinfo=timezone.utc)
    assert len(incremental.batch_windows(t, t + timedelta(hours=12))) == 1 and incremental.batch_windows(t, t) == []
    three = incremental.batch_windows(t, t + timedelta(days=2.5))
    assert len(three) == 3 and three[-1][1] == t + timedelta(days=2.5) and all(a[1] == b[0] for a, b in zip(three, three[1:], strict=False))
    for bad in (0.1, 8):
        with pytest.raises(ValueError):
            incremental.batch_windows(t, t, bad)
    root = str(tmp_path / "d")
    assert incremental.incremental_start(spark, root, "2024-02-03", 7) == datetime(2024, 2, 3, tzinfo=timezone.utc)
    Path(root, "date=2024-03-10").mkdir(parents=True)
    assert incremental.incremental_start(spark, root, "2024-02-03", 7) == datetime(2024, 3, 3, tzinfo=timezone.utc)
    with pytest.raises(ValueError):
        incremental.incremental_start(spark, root, "2024-02-03", 31)


def test_run_incremental(spark, tmp_path):
    v, l = motive(tmp_path, location(1, "2024-01-01T10:00:00Z"), location(2, "2024-01-02T10:00:00Z"))
    good = lambda s, a, b: flatten_motive(pages.motive_vehicle_locations(s, l), pages.motive_vehicles(s, v))
    broken = lambda s, a, b: s.read.parquet(str(tmp_path / "nowhere"))
    root, start = str(tmp_path / "data"), datetime(2024, 1, 1, tzinfo=timezone.utc)
    done = incremental.run_incremental(spark, {"good": good, "broken": broken}, root, start, start + timedelta(days=3))
    assert (done.batches, done.batches_with_data, done.records) == (3, 2, 2) and len(done.failed) == 3
    assert storage.partition_count(spark, root) == 2
    again = incremental.run_incremental(spark, {"good": good}, root, start, start + timedelta(days=3))
    assert again.records == 2 and spark.read.parquet(root).count() == 2
    # what has no time, what was rejected, and which version came last
    def several(s, a, b):
        rows = enforce_schema(good(s, a, b)).where("timestamp < '2024-01-02'")
        versions = [rows.withColumn("speed_mph", F.lit(float(n))).withColumn("_pos", F.lit(n)) for n in (3, 9, 5)]
        return versions[0].union(versions[1]).union(versions[2]).union(versions[0].withColumn("timestamp", F.lit(None).cast("timestamp"))), rows.limit(1)

    done = incremental.run_incremental(spark, {"m": several}, str(tmp_path / "several"), start, start + timedelta(days=1))
    assert (done.records, done.dropped_null_time, done.rejected) == (3, 1, 1)
    assert [r.speed_mph for r in spark.read.parquet(str(tmp_path / "several")).collect()] == [9.0]
    calls = []

    def dies_later(s, a, b):
        calls.append(a)
        return good(s, a, b) if len(calls) == 1 else broken(s, a, b)

    with pytest.raises(incremental.AllProvidersFailed) as failure:
        incremental.run_incremental(spark, {"x": dies_later}, str(tmp_path / "other"), start, start + timedelta(days=3))
    assert failure.value.batch == 1 and failure.value.partial_data_saved and len(failure.value.partitions) == 1


def test_stream_ingest(spark, tmp_path):
    v, l = motive(tmp_path, location(1, "2024-01-01T10:00:00Z"))
    root, check = str(tmp_path / "data"), str(tmp_path / "check")
    dim = pages.motive_vehicles(spark, v)
    aside = str(tmp_path / "aside")
    take = lambda: incremental.stream_ingest(spark, "motive_vehicle_locations", l, root, check, lambda items: flatten_motive(items, dim, origin=True), quarantine=aside)
    done = take()
    assert (done.records, done.rejected, done.batches_with_data) == (1, 0, 1)
    assert spark.read.parquet(root).count() == 1
    land(l, {"vehicle_id": 1, "vehicle_locations": [location(7, "2024-01-01T10:00:00Z", speed=5.0), location(9, "2024-01-01T10:00:00Z", speed=1.0), location(8, "2024-01-02T10:00:00Z"), location(6, "2024-01-02T10:00:00Z", type="teleport")]})
    Path(l, "broken.json").write_text("{not json")
    done = take()
    assert (done.records, done.rejected) == (3, 2)
    assert sorted(r.reason for r in spark.read.parquet(aside).collect()) == ["location_type unknown", "unreadable page"]
    rows = spark.read.parquet(root).orderBy("timestamp").collect()
    assert len(rows) == 2 and rows[0].speed_mph == pytest.approx(0.621371)


def test_stream_windows(spark, tmp_path):
    enforce_schema(spark.createDataFrame([["motive", "1", *[None] * 12]] * 2, ", ".join(f"`{c}` string" for c in TELEMETRY_COLUMNS))).withColumn("timestamp", F.lit("2024-01-01T10:20:00Z").cast("timestamp")).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(spark.read.parquet(str(tmp_path / "in")).schema).parquet(str(tmp_path / "in"))
    q = incremental.tumbling_counts(stream).writeStream.outputMode("complete").format("memory").queryName("tumbling").trigger(availableNow=True).start()
    q.awaitTermination()
    assert [r.records for r in spark.sql("SELECT * FROM tumbling").collect()] == [2]
    q = incremental.first_within(stream).writeStream.outputMode("append").format("memory").queryName("firsts").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.sql("SELECT * FROM firsts").count() == 1
