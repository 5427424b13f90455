"""Registered queries over landed pages, stored days and streams, each with the SQL that says the same.

Pages are made of the driver's tables, as Spark writes them, and read back as a vendor's: customers are vehicles, users,
drivers and places, events are readings.
"""

from __future__ import annotations

from datetime import date, datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmill.functions import telemetry as fn
from trackmill.operators import analytics, flatten, keep, storage, temporal
from trackmill.plans import unified
from trackmill.queries import _FIRST, FLAT, _assignments, _events, _nearest_sql, _ntz, _register, _root, _table, flat
from trackmill.sources import landing, pages
from trackmill.streaming import incremental

PER_PAGE = 100
_AT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def _land(spark: SparkSession, items: DataFrame, array: str, item: Column, key: Column, order: Column, name: str, *by: str) -> str:
    """Items as pages of about a hundred under the field array; a page per value of by and of key divided."""
    page = F.floor(key / PER_PAGE).alias("page")
    # items may hold maps, which have no order of their own
    placed = lambda a, b: F.when(a["o"] < b["o"], -1).when(a["o"] > b["o"], 1).otherwise(0)
    rows = items.groupBy(*by, page).agg(F.array_sort(F.collect_list(F.struct(order.alias("o"), item.alias("item"))), placed).alias("x"))
    path = _root(spark, name)
    rows.select(*by, F.col("x.item").alias(array)).write.json(path)
    return path


def _said(at: Column) -> Column:
    return F.date_format(at, _AT)


# --- offset-paged vendor ---

_METRIC = "c_mktsegment IN ('BUILDING', 'MACHINERY')"


def _motive_vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = F.lit("2024-01-01T00:00:00Z")
    item = F.struct(
        F.struct(
            F.col("c_custkey").alias("id"), F.lit(1).alias("company_id"), F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("number"), F.when(F.col("c_custkey") % 10 == 0, "lost").otherwise("active").alias("status"),
            F.lit(True).alias("ifta"), F.concat(F.lit("VIN"), "c_custkey").alias("vin"), F.expr(_METRIC).alias("metric_units"), F.when(F.col("c_custkey") % 3 == 0, "DIESEL").when(F.col("c_custkey") % 3 == 1, "coal").alias("fuel_type"), made.alias("created_at"), made.alias("updated_at"),
        ).alias("vehicle")
    )
    path = _land(spark, _table(spark, sf_dir, "customer"), "vehicles", item, F.col("c_custkey"), F.col("c_custkey"), "vehicles")
    return pages.motive_vehicles(spark, path)


@_register(
    f"SELECT c_custkey AS id, trim(c_name) AS number, {_METRIC} AS metric_units, CASE WHEN c_custkey % 3 = 0 THEN 'diesel' END AS fuel_type, -1::BIGINT AS driver_facing_camera, false AS prevent_auto_odometer_entry FROM customer WHERE c_custkey % 10 <> 0"
)
def motive_vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicles of an unknown status are rejected, unknown fuels are null, defaults filled in."""
    return _motive_vehicles(spark, sf_dir).select("id", "number", "metric_units", "fuel_type", "driver_facing_camera", "prevent_auto_odometer_entry")


_KIND = "CASE event_id % 5 WHEN 0 THEN 'breadcrumb' WHEN 1 THEN 'vehicle_stopped' WHEN 2 THEN 'ignition_on' WHEN 3 THEN 'ignition_off' ELSE 'vehicle_moving' END"


def _motive_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id")
    driver = F.struct(i.alias("id"), F.concat(F.lit("Ann"), i % 7).alias("first_name"), F.lit("Lee").alias("last_name"))
    item = F.struct(
        F.struct(
            i.cast("string").alias("id"), _said(F.col("ts")).alias("located_at"), (i % 90).cast("double").alias("lat"), (i % 180).cast("double").alias("lon"), F.expr(_KIND).alias("type"), F.lit(" Depot ").alias("description"),
            F.when(i % 3 != 0, F.col("value")).alias("speed"), (i % 360).cast("double").alias("bearing"), F.col("value").alias("odometer"), F.when(i % 2 == 0, F.col("value") + 1).alias("true_odometer"), F.when(i % 4 != 0, driver).alias("driver"),
        ).alias("vehicle_location")
    )
    e = _events(spark, sf_dir, "view").withColumn("vehicle_id", F.col("user_id"))
    return pages.motive_vehicle_locations(spark, _land(spark, e, "vehicle_locations", item, i, i, "locations", "vehicle_id"))


@_register(
    f"""WITH x AS (SELECT e.*, c.c_name, {_KIND} AS kind, CASE WHEN event_id % 3 <> 0 THEN CASE WHEN {_METRIC} THEN value * 0.621371::DOUBLE ELSE value END END AS mph FROM events e JOIN customer c ON c.c_custkey = e.user_id WHERE event_type = 'view' AND c_custkey % 10 <> 0)
    SELECT 'motive' AS provider, user_id::VARCHAR AS provider_vehicle_id, 'VIN' || user_id AS vin, trim(c_name) AS fleet_number, ts AS timestamp, (event_id % 90)::DOUBLE AS latitude, (event_id % 180)::DOUBLE AS longitude, mph AS speed_mph, (event_id % 360)::DOUBLE AS heading_degrees,
    CASE WHEN kind = 'vehicle_stopped' THEN 'Idle' WHEN kind = 'ignition_off' THEN 'Off' WHEN mph > 3.0 THEN 'On' WHEN mph <= 3.0 THEN 'Idle' WHEN kind = 'vehicle_moving' THEN 'On' WHEN kind = 'ignition_on' THEN 'Idle' ELSE 'Off' END AS engine_state,
    CASE WHEN event_id % 4 <> 0 THEN event_id::VARCHAR END AS driver_id, CASE WHEN event_id % 4 <> 0 THEN 'Ann' || (event_id % 7) || ' Lee' END AS driver_name, 'Depot' AS location_description, CASE WHEN event_id % 2 = 0 THEN value + 1 ELSE value END AS odometer FROM x"""
)
def flatten_motive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ntz(flatten.flatten_motive(_motive_locations(spark, sf_dir), _motive_vehicles(spark, sf_dir)))


@_register("SELECT c_custkey AS id, 'Group ' || c_custkey AS name, c_custkey % 4 = 0 AS top_level FROM customer WHERE c_custkey % 6 <> 0")
def motive_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups without a name are rejected."""
    k = F.col("c_custkey")
    item = F.struct(F.struct(k.alias("id"), F.when(k % 6 != 0, F.concat(F.lit("Group "), k)).alias("name"), F.lit(1).alias("company_id"), F.when(k % 4 != 0, k - 1).alias("parent_id")).alias("group"))
    found = pages.motive_groups(spark, _land(spark, _table(spark, sf_dir, "customer"), "groups", item, k, k, "groups"))
    return found.select("id", "name", fn.is_top_level(F.col("parent_id")).alias("top_level"))


@_register(
    """SELECT c_custkey AS id, 'First' || c_custkey || ' Last' AS full_name, c_custkey % 2 = 0 AS is_driver, CASE WHEN c_custkey % 5 IN (1, 2) THEN 'Reno, NV' END AS terminal, true AS minute_logs, false AS exception_wait_time FROM customer WHERE c_custkey % 7 <> 0"""
)
def motive_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users of an unknown role are rejected; a terminal needs a city and a state, neither empty."""
    k, made = F.col("c_custkey"), F.lit("2024-01-01T00:00:00Z")
    role = F.when(k % 7 == 0, "pilot").when(k % 2 == 0, "driver").otherwise("admin")
    city, state = F.when(k % 5 != 0, "Reno"), F.when(k % 5 == 3, "").when(k % 5 != 4, "NV")
    item = F.struct(F.struct(k.alias("id"), F.concat(F.lit("First"), k).alias("first_name"), F.lit("Last").alias("last_name"), role.alias("role"), F.lit("active").alias("status"), city.alias("terminal_city"), state.alias("terminal_state"), made.alias("created_at"), made.alias("updated_at")).alias("user"))
    found = pages.motive_users(spark, _land(spark, _table(spark, sf_dir, "customer"), "users", item, k, k, "users"))
    name = fn.full_name(F.struct("first_name", "last_name"))
    return found.select("id", name.alias("full_name"), fn.equals(F.col("role"), "driver").alias("is_driver"), fn.terminal_location(F.col("terminal_city"), F.col("terminal_state")).alias("terminal"), "minute_logs", "exception_wait_time")


@_register("SELECT user_id AS vehicle, sum(event_id % 3600 + event_id % 1000)::BIGINT AS engine_on_seconds, count(*) FILTER (event_id % 3 <> 0) AS issues, count(*) AS records FROM events GROUP BY ALL")
def motive_vehicle_utilization(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An empty message is none, a message of blanks is an issue."""
    i = F.col("event_id")
    message, zero = F.when(i % 3 == 0, "").when(i % 3 == 1, "   ").otherwise("offline"), F.lit(0.5)
    numbers = [zero.alias(n) for n in ("utilization_percentage", "idle_fuel", "driving_fuel", "total_fuel", "total_distance")]
    item = F.struct(F.struct(message.alias("message"), *numbers, (i % 3600).alias("idle_time"), (i % 1000).alias("driving_time"), F.struct(F.col("user_id").alias("id"), F.lit("n").alias("number")).alias("vehicle")).alias("vehicle_utilization"))
    found = pages.motive_vehicle_utilization(spark, _land(spark, _events(spark, sf_dir), "vehicle_utilizations", item, i, i, "utilization"))
    seconds = fn.engine_on_seconds(F.col("idle_time"), F.col("driving_time"))
    return found.groupBy(F.col("vehicle.id").alias("vehicle")).agg(F.sum(seconds).alias("engine_on_seconds"), F.count_if(fn.has_communication_issue(F.col("message"))).alias("issues"), F.count("*").alias("records"))


@_register("SELECT count(*) FILTER (c_custkey % 6 = 0) AS missing_name, count(*) FILTER (c_custkey % 6 <> 0) AS good FROM customer")
def rejected_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a reader leaves out is counted."""
    k = F.col("c_custkey")
    item = F.struct(F.struct(k.alias("id"), F.when(k % 6 != 0, "x").alias("name"), F.lit(1).alias("company_id")).alias("group"))
    path = _land(spark, _table(spark, sf_dir, "customer"), "groups", item, k, k, "groups")
    bad = pages.rejected(pages.read_pages(spark, "motive_groups", path), "motive_groups").agg(F.count_if(F.col("reason") == "name missing").alias("missing_name"))
    return bad.join(pages.motive_groups(spark, path).agg(F.count("*").alias("good")))  # one row each


# --- cursor-paged vendor ---


def _flat_land(spark: SparkSession, items: DataFrame, item: Column, key: Column, name: str) -> str:
    return _land(spark, items, "data", item, key, key, name)


@_register("SELECT c_custkey::VARCHAR AS id, trim(c_name) AS name, CASE WHEN c_custkey % 3 <> 0 THEN 'V' || c_custkey END AS vin, CASE WHEN c_custkey % 3 = 1 THEN 'S' || c_custkey END AS serial, c_custkey % 4 = 0 AS has_gateway, c_custkey % 2 = 0 AS regulated FROM customer")
def samsara_vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-level pages in camelCase, ids by a map."""
    k = F.col("c_custkey")
    ids = F.when(k % 3 == 1, F.create_map(F.lit("samsara.vin"), F.concat(F.lit("V"), k), F.lit("samsara.serial"), F.concat(F.lit("S"), k))).when(k % 3 == 2, F.create_map(F.lit("samsara.vin"), F.concat(F.lit("V"), k)))
    item = F.struct(k.cast("string").alias("id"), F.concat(F.col("c_name"), F.lit("\t")).alias("name"), ids.alias("externalIds"), F.when(k % 4 == 0, F.struct(F.lit("g").alias("serial"), F.lit("VG34").alias("model"))).alias("gateway"), F.when(k % 2 == 0, "regulated").otherwise("unregulated").alias("vehicleRegulationMode"))
    found = pages.to_table(pages.samsara_vehicles(spark, _flat_land(spark, _table(spark, sf_dir, "customer"), item, k, "vehicles")))
    return found.select("id", "name", fn.vin(F.col("external_ids")).alias("vin"), fn.serial(F.col("external_ids")).alias("serial"), fn.has_value(F.col("gateway")).alias("has_gateway"), fn.equals(F.col("vehicle_regulation_mode"), "regulated").alias("regulated"))


@_register("SELECT c_custkey::VARCHAR AS id, CASE WHEN c_custkey % 5 <> 0 THEN 'Home ' || (c_custkey % 9) END AS home FROM customer WHERE c_custkey % 2 = 0")
def samsara_drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active drivers only."""
    k = F.col("c_custkey")
    carrier = F.when(k % 5 != 0, F.struct(F.concat(F.lit("Home "), k % 9).alias("homeTerminalName")))
    item = F.struct(k.cast("string").alias("id"), F.lit("n").alias("name"), F.when(k % 2 == 0, "active").otherwise("deactivated").alias("driverActivationStatus"), carrier.alias("carrierSettings"))
    found = pages.samsara_drivers(spark, _flat_land(spark, _table(spark, sf_dir, "customer"), item, k, "drivers"), "active")
    return found.select("id", fn.home_terminal(F.col("carrier_settings")).alias("home"))


@_register("SELECT c_custkey::VARCHAR AS id, c_custkey % 3 = 0 AS has_geofence, CASE WHEN c_custkey % 2 = 0 THEN c_custkey::DOUBLE END AS latitude, c_custkey % 2 = 0 AS located FROM customer")
def samsara_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    fence = F.when(k % 3 == 0, F.struct(F.struct(F.array(F.struct(F.lit(1.0).alias("latitude"), F.lit(2.0).alias("longitude"))).alias("vertices")).alias("polygon")))
    item = F.struct(k.cast("string").alias("id"), F.lit("Yard").alias("name"), F.when(k % 2 == 0, k.cast("double")).alias("latitude"), F.lit(2.0).alias("longitude"), fence.alias("geofence"))
    found = pages.samsara_addresses(spark, _flat_land(spark, _table(spark, sf_dir, "customer"), item, k, "addresses"))
    place = fn.coordinates(F.col("latitude"), F.col("longitude"))
    return found.select("id", fn.has_value(F.col("geofence")).alias("has_geofence"), place["latitude"].alias("latitude"), fn.has_value(place).alias("located"))


_DAY_FROM, _DAY_TO = datetime(2024, 1, 10, tzinfo=timezone.utc), datetime(2024, 1, 12, tzinfo=timezone.utc)
_DAYS = "BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-12'"


@_register(f"SELECT user_id::VARCHAR AS asset, ts AS at, value AS latitude FROM events WHERE event_type = 'view' AND user_id IN (3, 5, 8) AND ts {_DAYS}")
def samsara_location_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages taken in as a stream of files, for some vehicles and a time range."""
    i = F.col("event_id")
    item = F.struct(_said(F.col("ts")).alias("happenedAtTime"), F.struct(F.col("user_id").cast("string").alias("id")).alias("asset"), F.struct(F.col("value").alias("latitude"), F.lit(2.0).alias("longitude")).alias("location"))
    path, out = _flat_land(spark, _events(spark, sf_dir, "view"), item, i, "positions"), _root(spark, "positions")
    found = pages.samsara_location_stream(spark, path, ["3", "5", "8"], _DAY_FROM, _DAY_TO, stream=True)
    found = found.select(F.col("asset.id").alias("asset"), F.col("happened_at_time").alias("at"), F.col("location.latitude").alias("latitude"))
    found.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-checkpoint").trigger(availableNow=True).start().awaitTermination()
    return _ntz(spark.read.schema(found.schema).parquet(out))


def _samsara_assignments(spark: SparkSession, sf_dir: str) -> str:
    a = _assignments(spark, sf_dir)
    item = F.struct(
        _said(F.col("start_time")).alias("startTime"), _said(F.col("end_time")).alias("endTime"), F.col("is_passenger").alias("isPassenger"), F.lit("HOS").alias("assignmentType"),
        F.struct(F.col("driver_id").alias("id"), F.col("driver_name").alias("name")).alias("driver"), F.struct(F.col("user_id").cast("string").alias("id"), F.lit("n").alias("name")).alias("vehicle"),
    )
    path = _root(spark, "assignments")
    # one page per vehicle, its assignments in order, so that list order is that of the events
    a.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("ordinal", item.alias("item")))).alias("x")).select(F.col("x.item").alias("data")).write.json(path)
    return path


@_register(f"SELECT event_id % 100 AS driver, user_id::VARCHAR AS vehicle, ts AS start_time FROM events WHERE event_type = 'signup' AND event_id % 100 < 40 AND ts <= TIMESTAMP '2024-01-12' AND ts + INTERVAL 12 HOUR >= TIMESTAMP '2024-01-10'")
def samsara_driver_assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Those of some drivers that overlap a time range."""
    ids = spark.range(40).select(F.col("id").cast("string").alias("id"))
    found = pages.samsara_driver_assignments(spark, _samsara_assignments(spark, sf_dir), "drivers", ids, _DAY_FROM, _DAY_TO)
    return _ntz(found.select(F.col("driver.id").cast("long").alias("driver"), F.col("vehicle.id").alias("vehicle"), "start_time"))


@_register("SELECT event_id, event_type <> 'signup' AND ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-10' + to_hours((event_id % 48)::INTEGER) AS inside FROM events WHERE event_id % 5 <> 0")
def contains_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With passengers left out; both ends count."""
    start = F.lit(_DAY_FROM)
    rows = _events(spark, sf_dir).withColumn("is_passenger", F.col("event_id") % 5 == 0)
    end = F.timestamp_micros(F.unix_micros(start) + F.col("event_id") % 48 * 3_600_000_000)
    return unified.filter_not_passenger(rows).select("event_id", ((F.col("event_type") != "signup") & fn.contains_timestamp(start, end, F.col("ts"))).alias("inside"))


def _samsara_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, i = _events(spark, sf_dir), F.col("event_id")
    at = _said(F.col("ts")).alias("time")

    def series(types: tuple[str, ...], *fields: Column) -> Column:
        own = F.when(F.col("event_type").isin(*types), F.struct(i.alias("o"), F.struct(at, *fields).alias("r")))
        return F.transform(F.array_sort(F.collect_list(own)), lambda x: x["r"])

    place = F.struct(F.concat(F.lit(" Road "), i % 9).alias("formattedLocation"))
    gps = series(("view",), (i % 90).cast("double").alias("latitude"), F.lit(2.0).alias("longitude"), F.col("value").alias("speedMilesPerHour"), F.lit(7.0).alias("headingDegrees"), place.alias("reverseGeo"))
    states = series(("click", "error"), F.when(F.col("event_type") == "click", "ON").when(i % 3 == 0, "broken").otherwise("off").alias("value"))
    meters = series(("purchase",), F.floor(F.col("value") * 1000).cast("long").alias("value"))
    u = F.col("user_id")
    found = e.groupBy(u).agg(gps.alias("gps"), states.alias("engineStates"), meters.alias("obdOdometerMeters"))
    item = F.struct(u.cast("string").alias("id"), F.concat(F.lit("Truck "), u).alias("name"), F.create_map(F.lit("samsara.vin"), F.concat(F.lit("SV"), u)).alias("externalIds"), "gps", "engineStates", "obdOdometerMeters")
    path = _root(spark, "stats")
    found.select(F.array(item).alias("data")).write.json(path)
    return pages.samsara_vehicle_stats(spark, path)


_STATE = "CASE WHEN event_type = 'click' THEN 'On' WHEN event_id % 3 = 0 THEN NULL ELSE 'Off' END"


@_register(
    f"""SELECT 'samsara' AS provider, g.user_id::VARCHAR AS provider_vehicle_id, 'SV' || g.user_id AS vin, 'Truck ' || g.user_id AS fleet_number, g.ts AS timestamp, (g.event_id % 90)::DOUBLE AS latitude, 2.0::DOUBLE AS longitude, g.value AS speed_mph, 7.0::DOUBLE AS heading_degrees,
    s.engine_state, f.driver_id, f.driver_name, 'Road ' || (g.event_id % 9) AS location_description, floor(n.odometer) / 1609.344::DOUBLE AS odometer
    FROM (SELECT * FROM events WHERE event_type = 'view') g ASOF LEFT JOIN (SELECT user_id, ts, {_STATE} AS engine_state FROM events WHERE event_type IN ('click', 'error')) s ON g.user_id = s.user_id AND g.ts >= s.ts
    JOIN ({_nearest_sql(1800)}) n ON g.event_id = n.event_id JOIN {_FIRST} f ON g.event_id = f.gid AND f.nth = 1"""
)
def flatten_samsara(spark: SparkSession, sf_dir: str) -> DataFrame:
    assignments = pages.samsara_driver_assignments(spark, _samsara_assignments(spark, sf_dir))
    return _ntz(flatten.flatten_samsara(_samsara_stats(spark, sf_dir), assignments))


@_register("SELECT user_id::VARCHAR AS id, ts AS time, value AS speed, count(*) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) - 1 AS ordinal, 'Road ' || (event_id % 9) AS place FROM events WHERE event_type = 'view'")
def explode_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pages.explode_series(_samsara_stats(spark, sf_dir), "gps")
    return _ntz(found.select("id", "time", F.col("speed_miles_per_hour").alias("speed"), F.col("ordinal").cast("long").alias("ordinal"), fn.formatted_location(F.col("reverse_geo")).alias("place")))


@_register("SELECT user_id::VARCHAR AS id, ts AS time, 'broken' AS value FROM events WHERE event_type = 'error' AND event_id % 3 = 0")
def unknown_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ntz(pages.unknown_states(_samsara_stats(spark, sf_dir)).select("id", "time", "value"))


@_register("SELECT user_id::VARCHAR AS id, count(*) FILTER (event_type = 'view') > 0 AS has_gps, count(*) FILTER (event_type = 'purchase') > 0 AS has_odometer, count(*) FILTER (event_type IN ('click', 'error')) > 0 AS has_states FROM events GROUP BY user_id")
def series_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _samsara_stats(spark, sf_dir)
    return s.select("id", fn.has_items(F.col("gps")).alias("has_gps"), fn.has_items(F.col("obd_odometer_meters")).alias("has_odometer"), fn.has_items(F.col("engine_states")).alias("has_states"))


@_register("SELECT o_orderkey AS id, o_orderkey % 9 + 1 < CASE WHEN o_custkey % 7 = 0 THEN 0 ELSE ceil((o_custkey % 100) / (o_custkey % 7)::DOUBLE) END AS more, CASE WHEN o_orderkey % 9 + 1 < CASE WHEN o_custkey % 7 = 0 THEN 0 ELSE ceil((o_custkey % 100) / (o_custkey % 7)::DOUBLE) END THEN o_orderkey % 9 + 2 END AS next FROM orders")
def next_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    page, total, size = F.col("o_orderkey") % 9 + 1, F.col("o_custkey") % 100, F.col("o_custkey") % 7
    return _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), fn.has_next_page(page, total, size).alias("more"), fn.next_page(page, total, size).alias("next"))


@_register("SELECT doc_id, strlen(text) / 1024.0::DOUBLE AS kb, strlen(text) / 1048576.0::DOUBLE AS mb FROM documents")
def size_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.octet_length("text")
    return _table(spark, sf_dir, "documents").select("doc_id", fn.size_in(size, "kb").alias("kb"), fn.size_in(size, "mb").alias("mb"))


@_register("SELECT c_custkey AS id, trim(c_name) AS name, trim(c_mktsegment) AS inner_name, trim(c_name) || '|' AS names FROM customer")
def trim_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inside structs and arrays too, with white space beyond ASCII."""
    c = _table(spark, sf_dir, "customer")
    padded = lambda x: F.concat(F.lit(" \t "), x, F.lit("\n "))
    rows = c.select(F.col("c_custkey").alias("id"), padded("c_name").alias("name"), F.struct(padded("c_mktsegment").alias("inner")).alias("s"), F.array(padded("c_name"), F.lit("  ")).alias("names"))
    return unified.trim_strings(rows).select("id", "name", F.col("s.inner").alias("inner_name"), F.array_join("names", "|").alias("names"))


@_register(f"WITH {FLAT} SELECT timestamp, speed_mph, engine_state FROM flat WHERE vin = 'VIN8' AND fleet_number = 'F8' ORDER BY timestamp")
def vehicle_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ntz(keep.sort_telemetry(unified.filter_vehicle(flat(spark, sf_dir), "VIN8", "F8")).select("timestamp", "speed_mph", "engine_state"))


# --- days on disk ---


def _saved(spark: SparkSession, sf_dir: str, **more) -> str:
    root = _root(spark, "dataset")
    storage.save_partitioned(flat(spark, sf_dir), root, **more)
    return root


@_register(f"WITH {FLAT} SELECT *, timestamp::DATE AS date FROM flat WHERE timestamp::DATE BETWEEN DATE '2024-01-05' AND DATE '2024-01-08'")
def load_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ntz(storage.load_date_range(spark, _saved(spark, sf_dir), date(2024, 1, 5), date(2024, 1, 8), sort=True))


@_register(f"WITH {FLAT} SELECT *, timestamp::DATE AS date FROM flat WHERE timestamp::DATE = DATE '2024-01-05'")
def load_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ntz(storage.load_partition(spark, _saved(spark, sf_dir, compression="zstd"), date(2024, 1, 5)))


@_register("SELECT count(DISTINCT ts::DATE) AS days, min(ts::DATE) AS earliest, max(ts::DATE) AS latest, bool_or(ts::DATE = DATE '2024-01-05') AS there, false AS elsewhere, max(ts::DATE)::TIMESTAMP - INTERVAL 7 DAY AS next_start FROM events")
def partition_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _saved(spark, sf_dir)
    row = (storage.partition_count(spark, root), storage.earliest_partition_date(spark, root), storage.latest_partition_date(spark, root), storage.partition_exists(spark, root, date(2024, 1, 5)), storage.partition_exists(spark, root, date(2000, 1, 1)), incremental.incremental_start(spark, root, "2020-01-01", 7))
    return _ntz(spark.createDataFrame([row], "days long, earliest date, latest date, there boolean, elsewhere boolean, next_start timestamp"))


@_register("SELECT count(DISTINCT ts::DATE) AS partitions, min(ts::DATE) AS earliest, max(ts::DATE) AS latest, true AS sized FROM events")
def storage_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sizes are held against those that a reader of the files' rows gives for them."""
    root = _saved(spark, sf_dir)
    found, sizes = storage.storage_statistics(spark, root), storage.partition_sizes(spark, root, "bytes")
    seen = spark.read.parquet(root).select("date", "_metadata.file_path", "_metadata.file_size").distinct().groupBy("date").agg(F.sum("file_size").alias("n"))
    seen = {r.date: r.n for r in seen.collect()}
    sized = sizes == seen and found["total_mb"] == round(sum(seen.values()) / 1024**2, 2)
    return spark.createDataFrame([(found["partitions"], found["earliest"], found["latest"], sized)], "partitions long, earliest date, latest date, sized boolean")


@_register("SELECT DATE '2024-03-01' AS date, count(*) AS records, round(sum(value), 4) AS speeds FROM events WHERE event_type = 'click'")
def save_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day that is saved again is replaced."""
    root = _root(spark, "dataset")
    for kind in ("view", "click"):
        rows = flat(spark, sf_dir).where(F.col("location_description") == kind).withColumn("speed_mph", (F.col("odometer") - F.col("provider_vehicle_id").cast("long")) / 10)
        storage.save_partition(rows, root, date(2024, 3, 1))
    return storage.load_partition(spark, root, date(2024, 3, 1)).groupBy("date").agg(F.count("*").alias("records"), F.round(F.sum("speed_mph"), 4).alias("speeds"))


def _versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as readings of the hour, so that several are versions of one, numbered as they came."""
    own = {"provider": F.lit("motive"), "provider_vehicle_id": F.col("user_id").cast("string"), "timestamp": F.date_trunc("hour", "ts"), "speed_mph": F.col("value")}
    columns = [own.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in unified.TELEMETRY_SCHEMA.fields]
    return _events(spark, sf_dir).select(*columns, F.col("event_id").alias("_pos"))


_LAST = "SELECT user_id::VARCHAR AS provider_vehicle_id, date_trunc('hour', ts)::TIMESTAMP AS timestamp, arg_max(value, event_id) AS speed_mph FROM events GROUP BY ALL"


@_register(_LAST)
def merge_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions inside one batch and over two: the last to arrive stays."""
    root, rows = _root(spark, "dataset"), _versions(spark, sf_dir)
    half = F.col("_pos") % 2 == 0
    latest = rows.groupBy("provider_vehicle_id", "timestamp").agg(F.max("_pos").alias("_last"))
    rows = rows.join(latest, ["provider_vehicle_id", "timestamp"])
    first, second = rows.where(half | (F.col("_pos") != F.col("_last"))).drop("_last"), rows.where(~half & (F.col("_pos") == F.col("_last"))).drop("_last")
    for batch in (first, second):
        storage.merge_partitions(batch, root, order=["_pos"])
    return _ntz(spark.read.parquet(root).select("provider_vehicle_id", "timestamp", "speed_mph"))


@_register(_LAST)
def save_partitioned_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _root(spark, "dataset")
    storage.save_partitioned(_versions(spark, sf_dir), root, dedup=True, order=["_pos"])
    return _ntz(spark.read.parquet(root).select("provider_vehicle_id", "timestamp", "speed_mph"))


@_register(f"WITH {FLAT} SELECT fmt, count(*) AS records, round(sum(speed_mph), 4) AS speeds FROM flat, (SELECT unnest(['parquet', 'csv', 'json']) AS fmt) GROUP BY ALL")
def export(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, rows, out = _root(spark, "export"), flat(spark, sf_dir), []
    for fmt in ("parquet", "csv", "json"):
        storage.export(rows, fmt, f"{root}/{fmt}")
        back = spark.read.option("header", True).format(fmt).schema(rows.schema).load(f"{root}/{fmt}")
        out.append(back.agg(F.lit(fmt).alias("fmt"), F.count("*").alias("records"), F.round(F.sum("speed_mph"), 4).alias("speeds")))
    return out[0].union(out[1]).union(out[2])


@_register(f"WITH {FLAT} SELECT provider, count(*) AS records FROM flat GROUP BY ALL")
def export_by_provider(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _root(spark, "export")
    storage.export_by_provider(flat(spark, sf_dir), path)
    return spark.read.parquet(path).groupBy("provider").agg(F.count("*").alias("records"))


@_register("SELECT ts::DATE AS date, count(*) AS records FROM events WHERE ts::DATE > DATE '2024-01-20' GROUP BY ALL")
def external_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _saved(spark, sf_dir)
    name = f"readings_{root.rsplit('-', 1)[1]}"
    storage.register_external_table(spark, name, root)
    return analytics.partition_counts(spark.table(name).where("date > DATE '2024-01-20'"))


@_register("SELECT ts::DATE AS date, count(*) AS records FROM events WHERE ts::DATE IN (SELECT ts::DATE FROM events WHERE value > 99.9) GROUP BY ALL")
def affected_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored days that some new rows touch; the others are pruned while it runs."""
    stored = storage.load_date_range(spark, _saved(spark, sf_dir), date(2000, 1, 1), date(2100, 1, 1))
    new = _events(spark, sf_dir).where("value > 99.9").withColumn("date", F.to_date("ts"))
    return analytics.partition_counts(temporal.affected_partitions(stored, new))


@_register("SELECT 'date=' || ts::DATE AS partition, count(*) AS records FROM events WHERE ts::DATE >= DATE '2024-01-21' GROUP BY ALL")
def retention_registered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retention on a registered table: the days that SQL lists are those that are left, a new one among them."""
    root = _root(spark, "dataset")
    rows = flat(spark, sf_dir)
    newest = F.to_date("timestamp") == F.lit(date(2024, 1, 30))
    storage.save_partitioned(rows.where(~newest), root)
    name = f"kept_{root.rsplit('-', 1)[1]}"
    storage.register_external_table(spark, name, root)
    storage.save_partitioned(rows.where(newest), root)
    storage.sync_external_table(spark, name)
    storage.apply_retention(spark, root, 10, datetime(2024, 1, 31, 12, tzinfo=timezone.utc), name)
    counts = analytics.partition_counts(spark.table(name)).select(F.concat(F.lit("date="), "date").alias("partition"), "records")
    return spark.sql(f"SHOW PARTITIONS {name}").join(counts, "partition", "left")


def _spoil(spark: SparkSession, file: str, keep: int = 0) -> None:
    """Leave a file its first bytes only, and garbage after them."""
    path = spark._jvm.org.apache.hadoop.fs.Path(file)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    start = bytearray(keep)
    if keep:
        held = spark.read.format("binaryFile").load(file).select(F.substring(F.col("content"), F.lit(1), F.lit(keep)).alias("x")).first().x
        start = bytearray(held)
    out = fs.create(path, True)
    out.write(start + bytearray(b"not what was written here"))
    out.close()


@_register("SELECT ts::DATE AS date, count(*) AS records, 2::BIGINT AS days_skipped FROM events WHERE ts::DATE BETWEEN DATE '2024-01-03' AND DATE '2024-01-12' AND ts::DATE NOT IN (DATE '2024-01-05', DATE '2024-01-09') GROUP BY ALL")
def damaged_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two stored days are damaged, one wholly and one behind its beginning; they are left out and named."""
    root = _saved(spark, sf_dir)
    for file in storage.data_files(spark, root).where("date IN (DATE '2024-01-05', DATE '2024-01-09')").collect():
        _spoil(spark, file.file, 200 if file.date.day == 9 else 0)
    rows, skipped = storage.load_readable(spark, root, date(2024, 1, 3), date(2024, 1, 12))
    days = skipped.where("date IN (DATE '2024-01-05', DATE '2024-01-09')").agg(F.count_distinct("date").alias("days_skipped"))
    return analytics.partition_counts(rows).join(days)  # one row


# --- runs and streams ---


@_register(f"WITH {FLAT} SELECT provider, count(*) AS records FROM flat WHERE provider = 'motive' GROUP BY ALL")
def registered_provider(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A provider by its registered name; names that nobody registered are skipped."""
    flatten.register_provider("motive", lambda s, landing, start, end: unified.filter_provider(flat(s, landing), "motive"))
    frames = [fetch(spark, sf_dir, None, None) for fetch in flatten.providers(["motive", "unheard of"]).values()]
    return union_counts(frames)


def union_counts(frames: list[DataFrame]) -> DataFrame:
    return flatten.union_providers(frames).groupBy("provider").agg(F.count("*").alias("records"))


@_register("""SELECT count(*) FILTER (event_id % 50 <> 0 AND ts >= TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-11') AS stored, 4 * count(*) FILTER (event_id % 50 = 0) AS dropped_null_time, 4 * count(*) FILTER (event_id % 11 = 0) AS rejected, 4::BIGINT AS batches FROM events""")
def run_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four windows over a source that gives everything each time, some of it without a time, some rejected."""
    i, root = F.col("event_id"), _root(spark, "dataset")

    def fetch(s: SparkSession, start: datetime, end: datetime) -> tuple[DataFrame, DataFrame]:
        e = _events(s, sf_dir)
        rows = e.select(F.lit("motive").alias("provider"), i.cast("string").alias("provider_vehicle_id"), F.when(i % 50 != 0, F.col("ts")).alias("timestamp"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in unified.TELEMETRY_SCHEMA.fields if f.name not in ("provider", "provider_vehicle_id", "timestamp")], i.alias("_pos"))
        return rows, e.where(i % 11 == 0)

    done = incremental.run_incremental(spark, {"motive": fetch}, root, datetime(2024, 1, 5, tzinfo=timezone.utc), datetime(2024, 1, 11, tzinfo=timezone.utc), 1.5)
    told = spark.createDataFrame([(done.dropped_null_time, done.rejected, done.batches)], "dropped_null_time long, rejected long, batches long")
    return spark.read.parquet(root).agg(F.count("*").alias("stored")).join(told)  # one row each


@_register(f"WITH {FLAT} SELECT date_trunc('hour', timestamp)::TIMESTAMP AS bucket, provider, count(*) AS records, round(avg(speed_mph), 6) AS mean_speed_mph FROM flat GROUP BY ALL")
def stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly windows over a stream of files; the last state of each window."""
    landed = _root(spark, "landing")
    flat(spark, sf_dir).write.parquet(landed)
    name = f"windows_{landed.rsplit('-', 1)[1]}"
    stream = incremental.tumbling_counts(spark.readStream.schema(unified.TELEMETRY_SCHEMA).parquet(landed), late="60 days")
    stream.writeStream.outputMode("complete").format("memory").queryName(name).trigger(availableNow=True).start().awaitTermination()
    return _ntz(spark.table(name)).withColumn("mean_speed_mph", F.round("mean_speed_mph", 6))


@_register("SELECT user_id::VARCHAR AS provider_vehicle_id, date_trunc('hour', ts)::TIMESTAMP AS timestamp, 1::BIGINT AS kept FROM events GROUP BY ALL")
def stream_first_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the readings of one key within the lookback, one goes on."""
    landed, out = _root(spark, "landing"), _root(spark, "firsts")
    unified.enforce_schema(_versions(spark, sf_dir)).write.parquet(landed)
    stream = incremental.first_within(spark.readStream.schema(unified.TELEMETRY_SCHEMA).parquet(landed), 60)
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-checkpoint").trigger(availableNow=True).start().awaitTermination()
    return _ntz(spark.read.parquet(out).groupBy("provider_vehicle_id", "timestamp").agg(F.count("*").alias("kept")))


@_register(
    """WITH e AS (SELECT CASE WHEN user_id % 2 = 0 THEN 'motive' ELSE 'samsara' END AS provider, CASE WHEN event_id % 7 <> 0 THEN value END AS speed, event_id % 10 = 0 AS second, date_trunc('hour', ts) AS bucket, ts FROM events),
    w AS (SELECT date_trunc('milliseconds', max(ts) FILTER (NOT second)) - INTERVAL 2 DAY AS one, date_trunc('milliseconds', max(ts)) - INTERVAL 2 DAY AS two FROM e),
    late AS (SELECT count(DISTINCT (bucket, provider)) AS n FROM e, w WHERE second AND bucket + INTERVAL 1 HOUR <= one)
    SELECT bucket::TIMESTAMP AS bucket, provider, count(*) AS records, round(avg(speed), 6) AS mean_speed_mph, (SELECT n FROM late) AS late_windows FROM e, w
    WHERE bucket + INTERVAL 1 HOUR <= two AND (NOT second OR bucket + INTERVAL 1 HOUR > one) GROUP BY ALL"""
)
def stream_windows_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly windows appended to files as they close; the tenth of the rows that comes later is late for most of them."""
    landed, out = _root(spark, "landing"), _root(spark, "windows")
    second, late = F.col("latitude") % 10 == 0, 0
    for rows in (flat(spark, sf_dir).where(~second), flat(spark, sf_dir).where(second)):
        rows.write.mode("append").parquet(landed)
        late += incremental.ingest_windows(spark.readStream.schema(unified.TELEMETRY_SCHEMA).parquet(landed), out, f"{out}-checkpoint", "1 hour", "2 days").late
    return _ntz(spark.read.parquet(out)).withColumn("mean_speed_mph", F.round("mean_speed_mph", 6)).withColumn("late_windows", F.lit(late).cast("long"))


@_register("SELECT count(*) FILTER (event_id % 5 <> 0) AS stored, count(*) FILTER (event_id % 5 = 0) AS quarantined, 1::BIGINT AS batches, 1::BIGINT AS replayed, count(*) FILTER (event_id % 5 <> 0) AS told FROM events WHERE event_type = 'view'")
def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that stops after a batch's work and before its commit hands it out again, twice; it takes effect once."""
    i = F.col("event_id")
    item = F.struct(F.struct(i.cast("string").alias("id"), _said(F.col("ts")).alias("located_at"), F.lit(1.5).alias("lat"), F.lit(2.5).alias("lon"), F.when(i % 5 == 0, "unheard of").otherwise("breadcrumb").alias("type"), F.col("value").alias("speed")).alias("vehicle_location"))
    landed = _land(spark, _events(spark, sf_dir, "view").withColumn("vehicle_id", i), "vehicle_locations", item, i, i, "landing", "vehicle_id")
    root, aside = _root(spark, "dataset"), _root(spark, "quarantine")
    dim = spark.range(1).selectExpr("CAST(NULL AS BIGINT) AS id", "'' AS vin", "'' AS number", "false AS metric_units")

    def unify(items: DataFrame) -> DataFrame:
        vehicles = items.select(F.col("vehicle_id").alias("id")).distinct().join(dim.drop("id"))  # one row
        return flatten.flatten_motive(items, vehicles, origin=True)

    def run() -> incremental.RunSummary:
        return incremental.stream_ingest(spark, "motive_vehicle_locations", landed, root, f"{root}-checkpoint", unify, quarantine=aside)

    def undo(*names: str) -> None:
        for name in names:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

    run()
    undo(f"{root}-checkpoint/commits/0", f"{root}-checkpoint-ledger/entry-0")  # it stopped before the ledger's entry
    run()
    undo(f"{root}-checkpoint/commits/0")  # and now after it
    replayed = run().replayed
    entries = incremental.Ledger(spark, f"{root}-checkpoint-ledger").entries().agg(F.count("*").alias("batches"), F.sum("records").alias("told"))
    frames = [spark.read.parquet(root).agg(F.count("*").alias("stored")), spark.read.parquet(aside).agg(F.count("*").alias("quarantined")), entries.withColumn("replayed", F.lit(replayed).cast("long"))]
    return reduce(DataFrame.join, frames)  # one row each


@_register(
    f"""WITH e AS (SELECT * FROM events WHERE event_type = 'view'),
    m AS (SELECT 'motive' AS provider, count(*) FILTER (user_id <> 3) AS records, count(*) FILTER (user_id <> 3) AS with_driver, count(DISTINCT user_id) FILTER (user_id = 3) AS skipped FROM e JOIN customer c ON c.c_custkey = e.user_id WHERE c_custkey % 10 <> 0),
    s AS (SELECT 'samsara' AS provider, count(*) AS records, count(CASE WHEN f.user_id % 8 <> 1 THEN f.driver_id END) AS with_driver, 1::BIGINT AS skipped FROM (SELECT g.user_id, f.driver_id FROM e g JOIN {_FIRST} f ON g.event_id = f.gid AND f.nth = 1) f)
    SELECT * FROM m UNION ALL SELECT * FROM s"""
)
def degrade_on_missing_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One vehicle's locations and one of eight chunks of assignments are damaged: the vehicle goes, the drivers are null."""
    e, i = _events(spark, sf_dir, "view"), F.col("event_id")
    person = F.struct(i.alias("id"), F.lit("Ann").alias("first_name"), F.lit("Lee").alias("last_name"))
    item = F.struct(F.struct(i.cast("string").alias("id"), _said(F.col("ts")).alias("located_at"), F.lit(1.0).alias("lat"), F.lit(2.0).alias("lon"), F.lit("breadcrumb").alias("type"), person.alias("driver")).alias("vehicle_location"))
    located, assigned = _root(spark, "locations"), _root(spark, "assignments")
    pages_of = e.groupBy(F.col("user_id").alias("vehicle_id"), F.floor(i / 1000).alias("page")).agg(F.collect_list(item).alias("vehicle_locations")).drop("page")
    # a folder and a file for each vehicle, dealt out to all cores
    pages_of = pages_of.repartition(4 * spark.sparkContext.defaultParallelism, "vehicle_id").sortWithinPartitions("vehicle_id")
    pages_of.write.partitionBy("vehicle_id").option("compression", "gzip").json(located)
    made = spark.read.json(_samsara_assignments(spark, sf_dir))
    made.withColumn("chunk", F.get("data", F.lit(0))["vehicle"]["id"].cast("int") % 8).repartition(8, "chunk").write.partitionBy("chunk").option("compression", "gzip").json(assigned)
    for path, unit, value, keep in ((located, "vehicle_id", "3", 0), (assigned, "chunk", "1", 100)):
        for file in landing.landed_files(spark, f"{path}/{unit}={value}", unit).collect():
            _spoil(spark, file.file, keep)
    k = F.col("c_custkey")
    vehicle = F.struct(F.struct(k.alias("id"), F.lit(1).alias("company_id"), F.lit("n").alias("number"), F.when(k % 10 == 0, "lost").otherwise("active").alias("status"), F.lit(True).alias("ifta"), F.lit("2024-01-01T00:00:00Z").alias("created_at"), F.lit("2024-01-01T00:00:00Z").alias("updated_at")).alias("vehicle"))
    vehicles = _land(spark, _table(spark, sf_dir, "customer"), "vehicles", vehicle, k, k, "vehicles")
    read, lost = landing.isolated_pages(spark, "samsara_driver_assignments", assigned, "chunk")
    drivers = flatten.flatten_samsara(_samsara_stats(spark, sf_dir), pages.validated(pages.unwrap_items(read, "samsara_driver_assignments"), "samsara_driver_assignments")[0])
    found = [landing.motive_rows(spark, vehicles, located), (drivers, lost)]
    out = []
    for name, (rows, skipped) in zip(("motive", "samsara"), found, strict=True):
        counts = rows.agg(F.lit(name).alias("provider"), F.count("*").alias("records"), F.count("driver_id").alias("with_driver"))
        out.append(counts.join(landing.skipped_units(skipped).agg(F.count("*").alias("skipped"))))  # one row each
    return out[0].unionByName(out[1])


@_register(f"WITH {FLAT} SELECT provider, count(DISTINCT vin) AS vehicles, true AS near FROM flat GROUP BY ALL")
def vehicle_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches stored day by day, one day twice, merged to a fleet's count: within five percent of the exact one."""
    path, sketches = _root(spark, "sketches"), analytics.daily_vehicle_sketches(flat(spark, sf_dir))
    for days in (sketches, sketches.where("date = DATE '2024-01-05'")):
        days.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path)
    about = analytics.vehicles_in_sketches(spark.read.parquet(path), "provider").withColumnRenamed("vehicles", "about")
    exact = analytics.distinct_vehicles_by_provider(flat(spark, sf_dir))
    return exact.join(about, "provider").select("provider", "vehicles", (F.abs(F.col("about") - F.col("vehicles")) <= 0.05 * F.col("vehicles")).alias("near"))


@_register(
    f"""WITH {FLAT} SELECT provider, location_description AS kind, count(speed_mph) AS count, round(avg(speed_mph), 6) AS mean, round(stddev_samp(speed_mph), 6) AS std, min(speed_mph) AS min,
    round(quantile_cont(speed_mph, 0.25), 6) AS p25, round(quantile_cont(speed_mph, 0.5), 6) AS p50, round(quantile_cont(speed_mph, 0.75), 6) AS p75, max(speed_mph) AS max FROM flat GROUP BY ALL"""
)
def describe_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quartiles of every group, narrowed down together until few values are left to sort."""
    rows = flat(spark, sf_dir).withColumnRenamed("location_description", "kind")
    found = analytics.describe_numeric(rows, "speed_mph", most=200, by=["provider", "kind"])
    return found.withColumns({c: F.round(c, 6) for c in ("mean", "std", "p25", "p50", "p75")})
