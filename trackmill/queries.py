"""The library's registered queries over the driver's tables, each with the SQL that says the same.

events and customer stand in for telemetry: views are gps readings, clicks and errors engine states, purchases odometer
readings, signups driver assignments; a user is a vehicle.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackmill.functions import telemetry as fn
from trackmill.operators import analytics, keep, storage, temporal
from trackmill.operators.flatten import union_providers
from trackmill.plans import unified
from trackmill.sources.pages import audit_pages, read_pages, unwrap_items
from trackmill.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str, *types: str) -> DataFrame:
    rows = _table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return rows.where(F.col("event_type").isin(*types)) if types else rows


def _ntz(df: DataFrame) -> DataFrame:
    """Instants as the tables have them, without a zone."""
    return df.withColumns({f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)})


def flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unified columns of every event."""
    e = _events(spark, sf_dir)
    u, i = F.col("user_id"), F.col("event_id")
    return e.select(
        F.when(u % 2 == 0, "motive").otherwise("samsara").alias("provider"),
        u.cast("string").alias("provider_vehicle_id"),
        F.when(u % 17 != 0, F.concat(F.lit("VIN"), u)).alias("vin"),
        F.concat(F.lit("F"), u % 40).alias("fleet_number"),
        F.col("ts").alias("timestamp"),
        (i % 180 - 90).cast("double").alias("latitude"),
        (u % 360 - 180).cast("double").alias("longitude"),
        F.when(i % 7 != 0, F.col("value")).alias("speed_mph"),
        (i * 7 % 360).cast("double").alias("heading_degrees"),
        F.when(F.col("event_type") == "click", "On").when(F.col("event_type") == "error", "Off").when(F.col("event_type") == "view", "Idle").alias("engine_state"),
        F.when(i % 4 != 0, (i % 100).cast("string")).alias("driver_id"),
        F.when(i % 4 != 0, F.concat(F.lit("Driver "), i % 100)).alias("driver_name"),
        F.col("event_type").alias("location_description"),
        (F.col("value") * 10 + u).alias("odometer"),
    )


FLAT = """flat AS (SELECT CASE WHEN user_id % 2 = 0 THEN 'motive' ELSE 'samsara' END AS provider, user_id::VARCHAR AS provider_vehicle_id,
    CASE WHEN user_id % 17 <> 0 THEN 'VIN' || user_id END AS vin, 'F' || (user_id % 40) AS fleet_number, ts AS timestamp,
    (event_id % 180 - 90)::DOUBLE AS latitude, (user_id % 360 - 180)::DOUBLE AS longitude, CASE WHEN event_id % 7 <> 0 THEN value END AS speed_mph,
    (event_id * 7 % 360)::DOUBLE AS heading_degrees, CASE event_type WHEN 'click' THEN 'On' WHEN 'error' THEN 'Off' WHEN 'view' THEN 'Idle' END AS engine_state,
    CASE WHEN event_id % 4 <> 0 THEN (event_id % 100)::VARCHAR END AS driver_id, CASE WHEN event_id % 4 <> 0 THEN 'Driver ' || (event_id % 100) END AS driver_name,
    event_type AS location_description, value * 10 + user_id AS odometer FROM events)"""

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _register(sql: str, name: str = ""):
    def add(query: Query) -> Query:
        QUERIES[name or query.__name__] = query
        ORACLES[name or query.__name__] = sql
        return query

    return add


# --- typing and validation ---


DIRTY = "CASE event_id % 6 WHEN 0 THEN CAST(value AS {text}) WHEN 1 THEN 'N/A' WHEN 2 THEN '  ' WHEN 3 THEN '' WHEN 4 THEN '2024-03-01T05:06:07' ELSE 'junk' END"


def _dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select("event_id", F.expr(DIRTY.format(text="STRING")).alias("raw"))


@_register(f"SELECT event_id, CASE WHEN trim(raw) <> '' THEN raw END AS raw FROM (SELECT event_id, {DIRTY.format(text='VARCHAR')} AS raw FROM events)")
def blank_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unified.blank_to_null(_dirty(spark, sf_dir))


@_register(f"SELECT event_id, TRY_CAST(raw AS DOUBLE) AS number FROM (SELECT event_id, {DIRTY.format(text='VARCHAR')} AS raw FROM events)")
def coerce_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dirty(spark, sf_dir).select("event_id", unified.coerce_double(F.col("raw"), T.StringType()).alias("number"))


@_register("SELECT event_id, TRY_CAST(raw AS TIMESTAMP) AS at FROM (SELECT event_id, CASE event_id % 6 WHEN 1 THEN 'N/A' WHEN 2 THEN '  ' WHEN 3 THEN '' WHEN 4 THEN '2024-03-01T05:06:07' WHEN 5 THEN '2024-03-01T05:06:07.25Z' ELSE 'junk' END AS raw FROM events)")
def coerce_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.expr("CASE event_id % 6 WHEN 1 THEN 'N/A' WHEN 2 THEN '  ' WHEN 3 THEN '' WHEN 4 THEN '2024-03-01T05:06:07' WHEN 5 THEN '2024-03-01T05:06:07.25Z' ELSE 'junk' END")
    return _ntz(_events(spark, sf_dir).select("event_id", unified.coerce_timestamp(raw).alias("at")))


@_register(f"""WITH {FLAT} SELECT provider, provider_vehicle_id, CASE WHEN vin IS NULL THEN NULL ELSE vin END AS vin, fleet_number, timestamp, latitude, longitude,
    TRY_CAST(CASE WHEN speed_mph > 100 THEN 'fast' ELSE speed_mph::VARCHAR END AS DOUBLE) AS speed_mph, heading_degrees, engine_state, driver_id, driver_name, location_description, odometer FROM flat""")
def enforce_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    speed = F.col("speed_mph")
    dirty = flat(spark, sf_dir).withColumns(
        {
            "speed_mph": F.when(speed > 100, "fast").otherwise(speed.cast("string")),
            "vin": F.coalesce("vin", F.lit("  ")),
            "timestamp": F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"),
            "provider_vehicle_id": F.col("provider_vehicle_id").cast("double"),
            "extra": F.lit(1),
        }
    )
    return _ntz(unified.enforce_schema(dirty))


@_register(f"WITH {FLAT} SELECT provider, fleet_number, provider_vehicle_id, count(*) AS rows_without_vin FROM flat WHERE vin IS NULL GROUP BY ALL")
def missing_vin_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unified.missing_vin_report(flat(spark, sf_dir))


@_register(f"WITH {FLAT} SELECT " + ", ".join(f"count(*) FILTER ({c} IS NULL) AS {c}" for c in unified.TELEMETRY_COLUMNS) + " FROM flat")
def null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unified.null_counts(flat(spark, sf_dir))


@_register(
    """WITH x AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'ON' WHEN 1 THEN 'off' WHEN 2 THEN 'iDle' WHEN 3 THEN 'broken' END AS raw, CASE event_id % 3 WHEN 0 THEN 'DIESEL' WHEN 1 THEN 'coal' ELSE 'cng' END AS fuel FROM events)
    SELECT event_id, CASE lower(raw) WHEN 'on' THEN 'On' WHEN 'off' THEN 'Off' WHEN 'idle' THEN 'Idle' END AS state, CASE WHEN lower(fuel) IN ('diesel', 'gasoline', 'electric', 'hybrid', 'cng', 'lng', 'propane') THEN lower(fuel) END AS fuel FROM x"""
)
def normalize_enums(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.expr("CASE event_id % 5 WHEN 0 THEN 'ON' WHEN 1 THEN 'off' WHEN 2 THEN 'iDle' WHEN 3 THEN 'broken' END")
    fuel = F.expr("CASE event_id % 3 WHEN 0 THEN 'DIESEL' WHEN 1 THEN 'coal' ELSE 'cng' END")
    return _events(spark, sf_dir).select("event_id", fn.normalize_engine_state(raw).alias("state"), fn.normalize_fuel_type(fuel).alias("fuel"))


@_register(f"""WITH {FLAT} SELECT provider_vehicle_id, timestamp, array_to_string(list_concat(CASE WHEN vin IS NULL THEN ['vin missing'] ELSE [] END, CASE WHEN engine_state IN ('On', 'Off') OR engine_state IS NULL THEN [] ELSE ['state unknown'] END), ',') AS errors
    FROM flat WHERE vin IS NULL OR engine_state NOT IN ('On', 'Off')""")
def quarantine_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = unified.quarantine(flat(spark, sf_dir), {"vin missing": F.col("vin").isNotNull(), "state unknown": unified.in_domain(F.col("engine_state"), ["On", "Off"])})[1]
    return _ntz(bad.select("provider_vehicle_id", "timestamp", F.array_join("_errors", ",").alias("errors")))


# --- filters and scans ---


@_register(f"WITH {FLAT} SELECT * FROM flat WHERE timestamp BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-09 12:00:00'")
def time_range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    start, end = datetime(2024, 1, 5, tzinfo=timezone.utc), datetime(2024, 1, 9, 12, tzinfo=timezone.utc)
    return _ntz(unified.filter_time_range(flat(spark, sf_dir), "timestamp", start, end))


@_register(f"WITH {FLAT} SELECT *, timestamp::DATE AS date FROM flat WHERE timestamp::DATE BETWEEN DATE '2024-01-05' AND DATE '2024-01-08' AND timestamp BETWEEN TIMESTAMP '2024-01-05 06:00:00' AND TIMESTAMP '2024-01-08 06:00:00'")
def date_range_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    start, end = datetime(2024, 1, 5, 6, tzinfo=timezone.utc), datetime(2024, 1, 8, 6, tzinfo=timezone.utc)
    dated = flat(spark, sf_dir).withColumn("date", fn.to_partition_date(F.col("timestamp")))
    return _ntz(unified.date_superset_filter(dated, "timestamp", start, end))


@_register(f"WITH {FLAT} SELECT * FROM flat WHERE driver_name IS NOT NULL AND provider = 'samsara' AND fleet_number = 'F7'")
def telemetry_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = unified.filter_provider(unified.filter_known_driver(flat(spark, sf_dir)), "samsara")
    return _ntz(unified.filter_vehicle(rows, fleet_number="F7"))


# --- joins ---


@_register("SELECT e.event_id, e.user_id, c.c_name, c.c_mktsegment IN ('BUILDING', 'MACHINERY') AS metric FROM events e JOIN customer c ON c.c_custkey = e.user_id WHERE e.event_type = 'view'")
def vehicle_dim_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_name", F.col("c_mktsegment").isin("BUILDING", "MACHINERY").alias("metric"))
    return temporal.join_vehicle_dim(_events(spark, sf_dir, "view").select("event_id", "user_id"), dim, "user_id")


def _gps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir, "view").select("event_id", "user_id", "ts", F.col("value").alias("speed"))


def _states(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = F.when(F.col("event_type") == "click", "On").otherwise("Off")
    return _events(spark, sf_dir, "click", "error").select("user_id", "ts", state.alias("engine_state"), F.col("event_id").alias("ordinal"))


def _odometers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir, "purchase").select("user_id", "ts", (F.col("value") * 1000).alias("odometer"), F.col("event_id").alias("ordinal"))


def _assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    driver = (F.col("event_id") % 100).cast("string")
    return _events(spark, sf_dir, "signup").select(
        "user_id", F.col("ts").alias("start_time"), (F.col("ts") + F.expr("INTERVAL 12 HOURS")).alias("end_time"), (F.col("event_id") % 5 == 0).alias("is_passenger"), driver.alias("driver_id"), F.concat(F.lit("Driver "), driver).alias("driver_name"), F.col("event_id").alias("ordinal")
    )


@_register("SELECT g.event_id, g.user_id, g.ts, g.value AS speed, s.engine_state FROM (SELECT * FROM events WHERE event_type = 'view') g ASOF LEFT JOIN (SELECT user_id, ts, CASE event_type WHEN 'click' THEN 'On' ELSE 'Off' END AS engine_state FROM events WHERE event_type IN ('click', 'error')) s ON g.user_id = s.user_id AND g.ts >= s.ts")
def asof_engine_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ntz(temporal.asof_backward(_gps(spark, sf_dir), _states(spark, sf_dir), ["user_id"], "ts", "engine_state"))


def _nearest_sql(seconds: int) -> str:
    return f"""SELECT event_id, user_id, ts, speed, odometer FROM (SELECT g.event_id, g.user_id, g.ts, g.value AS speed, o.value * 1000 AS odometer,
        row_number() OVER (PARTITION BY g.event_id ORDER BY abs(epoch_us(g.ts) - epoch_us(o.ts)) NULLS LAST, o.event_id) AS nth
        FROM (SELECT * FROM events WHERE event_type = 'view') g LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') o ON g.user_id = o.user_id AND abs(epoch_us(g.ts) - epoch_us(o.ts)) <= {seconds}::BIGINT * 1000000) WHERE nth = 1"""


@_register(_nearest_sql(1800))
def nearest_odometer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ntz(temporal.asof_nearest(_gps(spark, sf_dir), _odometers(spark, sf_dir), ["user_id"], "ts", "odometer"))


@_register(_nearest_sql(21600))
def nearest_odometer_6h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ntz(temporal.asof_nearest(_gps(spark, sf_dir), _odometers(spark, sf_dir), ["user_id"], "ts", "odometer", tolerance_s=21600))


_FIRST = """(SELECT g.event_id AS gid, (a.event_id % 100)::VARCHAR AS driver_id, 'Driver ' || (a.event_id % 100) AS driver_name, row_number() OVER (PARTITION BY g.event_id ORDER BY a.event_id NULLS LAST) AS nth
    FROM (SELECT * FROM events WHERE event_type = 'view') g LEFT JOIN (SELECT * FROM events WHERE event_type = 'signup' AND event_id % 5 <> 0) a ON g.user_id = a.user_id AND g.ts BETWEEN a.ts AND a.ts + INTERVAL 12 HOUR)"""


@_register(f"SELECT g.event_id, g.user_id, g.ts, g.value AS speed, f.driver_id, f.driver_name FROM events g JOIN {_FIRST} f ON g.event_id = f.gid AND f.nth = 1")
def driver_interval_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ntz(temporal.interval_join_first(_gps(spark, sf_dir), _assignments(spark, sf_dir), ["user_id"], "ts", ["driver_id", "driver_name"]))


@_register(f"SELECT s.event_id, s.user_id, s.ts, s.speed, s.engine_state, n.odometer, f.driver_id, f.driver_name FROM ({ORACLES['asof_engine_state']}) s JOIN ({_nearest_sql(1800)}) n ON s.event_id = n.event_id JOIN {_FIRST} f ON s.event_id = f.gid AND f.nth = 1")
def enrich_gps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ntz(temporal.enrich_gps(_gps(spark, sf_dir), _states(spark, sf_dir), _odometers(spark, sf_dir), _assignments(spark, sf_dir), ["user_id"]))


@_register(f"SELECT g.event_id, g.user_id, g.ts, f.driver_name FROM events g JOIN {_FIRST} f ON g.event_id = f.gid AND f.nth = 1")
def driver_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ntz(temporal.driver_at(_assignments(spark, sf_dir), _gps(spark, sf_dir).drop("speed"), ["user_id"]))


@_register("SELECT event_id AS ordinal, user_id, ts AS start_time FROM events WHERE event_type = 'signup' AND user_id IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 90)")
def assignments_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = _events(spark, sf_dir, "purchase").where("value > 90")
    return _ntz(temporal.assignments_for(_assignments(spark, sf_dir), ids, "user_id").select("ordinal", "user_id", "start_time"))


# --- scalar functions ---


@_register("SELECT e.event_id, CASE WHEN coalesce(c.c_mktsegment IN ('BUILDING', 'MACHINERY'), false) THEN e.value * 0.621371::DOUBLE ELSE e.value END AS mph FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id")
def speed_to_mph(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").isin("BUILDING", "MACHINERY").alias("metric"))
    return _events(spark, sf_dir).join(dim, "user_id", "left").select("event_id", fn.speed_to_mph(F.col("value"), F.col("metric")).alias("mph"))


_TYPE = "CASE event_id % 10 WHEN 0 THEN 'breadcrumb' WHEN 1 THEN 'vehicle_stopped' WHEN 2 THEN 'vehicle_moving' WHEN 3 THEN 'ignition_on' WHEN 4 THEN 'ignition_off' WHEN 5 THEN 'engine_start' WHEN 6 THEN 'engine_stop' WHEN 7 THEN 'gps_moving' WHEN 8 THEN 'gps_stopped' END"
_MPH = "CASE WHEN event_id % 7 <> 0 THEN value / 20 END"


@_register(
    f"""WITH x AS (SELECT event_id, {_TYPE} AS t, {_MPH} AS v FROM events) SELECT event_id, CASE WHEN t IS NULL AND v IS NULL THEN NULL WHEN t IN ('vehicle_stopped', 'gps_stopped') THEN 'Idle' WHEN t IN ('ignition_off', 'engine_stop') THEN 'Off'
    WHEN v > 3.0 THEN 'On' WHEN v <= 3.0 THEN 'Idle' WHEN t IN ('vehicle_moving', 'vehicle_driving', 'gps_moving') THEN 'On' WHEN t IN ('ignition_on', 'engine_start') THEN 'Idle' ELSE 'Off' END AS state FROM x"""
)
def derive_engine_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select("event_id", fn.derive_engine_state(F.expr(_TYPE), F.expr(_MPH)).alias("state"))


@_register("SELECT event_id, value * 1000 / 1609.344::DOUBLE AS miles, value * 1000 / 1000.0::DOUBLE AS km, coalesce(CASE WHEN event_id % 3 = 0 THEN value END, value + 1) AS best FROM events WHERE event_type = 'purchase'")
def odometer_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    meters = F.col("value") * 1000
    best = fn.best_odometer(F.when(F.col("event_id") % 3 == 0, F.col("value")), F.col("value") + 1)
    return _events(spark, sf_dir, "purchase").select("event_id", fn.meters_to_miles(meters).alias("miles"), fn.meters_to_km(meters).alias("km"), best.alias("best"))


@_register("SELECT event_id AS ordinal, (43200 + event_id % 36000)::DOUBLE AS seconds, round((43200 + event_id % 36000) / 3600.0::DOUBLE, 9) AS hours FROM events WHERE event_type = 'signup'")
def assignment_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = F.col("start_time"), F.timestamp_micros(F.unix_micros("end_time") + F.col("ordinal") % 36000 * 1_000_000)
    return _assignments(spark, sf_dir).select("ordinal", fn.duration_seconds(a, b).alias("seconds"), F.round(fn.duration_hours(a, b), 9).alias("hours"))


@_register(f"""WITH x AS (SELECT event_id, {_TYPE} AS t, CASE WHEN event_id % 7 <> 0 THEN value - 50 END AS v FROM events)
    SELECT event_id, CASE WHEN v IS NOT NULL THEN v > 0 ELSE coalesce(t, '') NOT IN ('vehicle_stopped', 'ignition_off') END AS moving_motive, coalesce(v > 0, false) AS moving_samsara FROM x""")
def motion_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    speed = F.when(F.col("event_id") % 7 != 0, F.col("value") - 50)
    return _events(spark, sf_dir).select("event_id", fn.is_moving_motive(F.expr(_TYPE), speed).alias("moving_motive"), fn.is_moving_samsara(speed).alias("moving_samsara"))


@_register("SELECT event_id, ts::DATE AS day FROM events")
def partition_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select("event_id", fn.to_partition_date(F.col("ts")).alias("day"))


@_register("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS said FROM events")
def format_utc_z(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select("event_id", fn.format_utc_z(F.col("ts")).alias("said"))


# --- versions, unions, order ---


@_register("SELECT provider_vehicle_id, hour, speed_mph, version FROM (SELECT user_id::VARCHAR AS provider_vehicle_id, date_trunc('hour', ts) AS hour, value AS speed_mph, event_id AS version, row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY event_id DESC) AS nth FROM events) WHERE nth = 1")
def keep_last_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir).select(F.col("user_id").cast("string").alias("provider_vehicle_id"), F.date_trunc("hour", "ts").alias("hour"), F.col("value").alias("speed_mph"), F.col("event_id").alias("version"), F.col("event_id").alias("_seq"))
    return _ntz(keep.keep_last(e, ["provider_vehicle_id", "hour"], ("_seq",)))


@_register(f"WITH {FLAT} SELECT provider, provider_vehicle_id, timestamp, speed_mph FROM flat", name="union_providers")
def union_of_providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = flat(spark, sf_dir)
    both = union_providers([unified.filter_provider(rows, p) for p in ("motive", "samsara")])
    return _ntz(both.select("provider", "provider_vehicle_id", "timestamp", "speed_mph"))


@_register(f"WITH {FLAT} SELECT provider, provider_vehicle_id, timestamp FROM flat ORDER BY provider NULLS LAST, provider_vehicle_id NULLS LAST, timestamp NULLS LAST")
def sort_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ntz(keep.sort_telemetry(flat(spark, sf_dir)).select("provider", "provider_vehicle_id", "timestamp"))


# --- analyses; sums of doubles hang on their order, so means are rounded on both sides ---


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({f.name: F.round(f.name, 6) for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)})


@_register(f"WITH {FLAT} SELECT provider, fleet_number, min(timestamp) AS first_seen, max(timestamp) AS last_seen, count(timestamp) AS records, round(avg(speed_mph), 6) AS mean_speed_mph, round(max(odometer), 6) AS max_odometer FROM flat WHERE fleet_number IS NOT NULL GROUP BY ALL")
def vehicle_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ntz(_rounded(analytics.vehicle_activity(flat(spark, sf_dir))))


@_register(f"WITH {FLAT} SELECT driver_name, count(timestamp) AS records, round(avg(speed_mph), 6) AS mean_speed_mph FROM flat WHERE driver_name IS NOT NULL GROUP BY ALL ORDER BY records DESC, driver_name LIMIT 10")
def driver_activity_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(analytics.driver_activity(flat(spark, sf_dir)))


@_register(f"WITH {FLAT} SELECT engine_state, count(*) AS n FROM flat WHERE engine_state IS NOT NULL GROUP BY ALL")
def value_counts_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.value_counts(flat(spark, sf_dir), "engine_state")


@_register(f"WITH {FLAT} SELECT count(speed_mph) AS count, round(avg(speed_mph), 6) AS mean, round(stddev_samp(speed_mph), 6) AS std, min(speed_mph) AS min, round(quantile_cont(speed_mph, 0.25), 6) AS p25, round(quantile_cont(speed_mph, 0.5), 6) AS p50, round(quantile_cont(speed_mph, 0.75), 6) AS p75, max(speed_mph) AS max FROM flat")
def describe_speed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(analytics.describe_numeric(flat(spark, sf_dir), "speed_mph"))


@_register(f"WITH {FLAT} SELECT provider, count(DISTINCT vin) AS vehicles FROM flat GROUP BY ALL")
def distinct_vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.distinct_vehicles_by_provider(flat(spark, sf_dir))


@_register(f"WITH {FLAT} SELECT vin, round(avg(speed_mph), 6) AS mean_speed_mph FROM flat WHERE vin IS NOT NULL GROUP BY ALL")
def mean_speed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(analytics.mean_speed_by(flat(spark, sf_dir), "vin"))


@_register(f"WITH {FLAT} SELECT fleet_number, min(timestamp) AS first_seen, max(timestamp) AS last_seen, round(max(odometer) - min(odometer), 6) AS distance, round(avg(speed_mph), 6) AS mean_speed_mph, array_to_string(list_sort(list(DISTINCT driver_name) FILTER (driver_name IS NOT NULL)), ',') AS drivers FROM flat GROUP BY ALL")
def vehicle_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ntz(_rounded(analytics.vehicle_summary(flat(spark, sf_dir)).withColumn("drivers", F.array_join("drivers", ","))))


@_register(f"WITH {FLAT} SELECT count(*) AS records, count(DISTINCT provider) AS providers, count(DISTINCT vin) AS vehicles, min(timestamp) AS first_seen, max(timestamp) AS last_seen FROM flat")
def dataset_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ntz(analytics.dataset_summary(flat(spark, sf_dir)))


def _gaps_sql(unit: str, value: str, alias: str, fill: str, rows: str = "location_description = 'view'") -> str:
    return f"""WITH {FLAT}, b AS (SELECT provider, date_trunc('{unit}', timestamp)::TIMESTAMP AS bucket, {value} AS v FROM flat WHERE event_hour GROUP BY ALL),
        r AS (SELECT provider, unnest(generate_series(min(bucket), max(bucket), INTERVAL 1 {unit})) AS bucket FROM b GROUP BY provider)
        SELECT r.provider, r.bucket, {fill} AS {alias} FROM r LEFT JOIN b ON r.provider = b.provider AND r.bucket = b.bucket""".replace("WHERE event_hour ", f"WHERE {rows} ")


@_register(_gaps_sql("hour", "round(avg(speed_mph), 6)", "mean_speed_mph", "b.v"))
def hourly_mean_speed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of one event type, so that hours without rows lie between at small scales."""
    return _ntz(_rounded(analytics.hourly_mean_speed(flat(spark, sf_dir).where("location_description = 'view'"))))


#: So few rows that days without any lie between.
_SPARSE = "speed_mph > 99.2 AND location_description <> 'view'"


@_register(_gaps_sql("day", "count(*)", "records", "coalesce(b.v, 0)", _SPARSE))
def daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ntz(analytics.daily_counts(flat(spark, sf_dir).where(_SPARSE)))


@_register("SELECT ts::DATE AS date, count(*) AS records FROM events GROUP BY ALL")
def partition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.partition_counts(_events(spark, sf_dir).select(F.to_date("ts").alias("date")))


@_register(f"WITH {FLAT} SELECT provider, count(*) AS vehicles FROM (SELECT DISTINCT provider, provider_vehicle_id FROM flat) GROUP BY ALL")
def fleet_union_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.fleet_union_summary(flat(spark, sf_dir).select("provider", "provider_vehicle_id").distinct())


@_register("SELECT user_id, sum(event_id % 3600 + event_id % 1000)::BIGINT AS engine_on_seconds, sum(event_id % 3600 + event_id % 1000) / 3600.0::DOUBLE AS engine_on_hours, count(*) FILTER (event_id % 3 = 0) AS communication_issues FROM events GROUP BY ALL")
def utilization_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id")
    rows = _events(spark, sf_dir).select("user_id", (i % 3600).alias("idle_time"), (i % 1000).alias("driving_time"), F.when(i % 3 == 0, "offline").when(i % 3 == 1, "").alias("message"))
    return analytics.utilization_rollup(rows, "user_id")


# --- incremental ---

_START, _END = datetime(2024, 1, 1, tzinfo=timezone.utc), datetime(2024, 1, 30, 6, tzinfo=timezone.utc)


@_register(
    """WITH w AS (SELECT unnest(range(0, 12)) AS batch), x AS (SELECT batch::BIGINT AS batch_id, TIMESTAMP '2024-01-01' + to_hours((60 * batch)::INTEGER) AS start_at, least(TIMESTAMP '2024-01-01' + to_hours((60 * batch + 60)::INTEGER), TIMESTAMP '2024-01-30 06:00:00') AS end_at FROM w)
    SELECT x.batch_id, x.start_at, x.end_at, count(e.event_id) AS records FROM x LEFT JOIN events e ON e.ts >= x.start_at AND e.ts <= x.end_at WHERE x.start_at < x.end_at GROUP BY ALL"""
)
def batch_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both ends of a window count, so a row on a border is in two; each row knows its windows by arithmetic."""
    rows = [(k, a, b) for k, (a, b) in enumerate(incremental.batch_windows(_START, _END, 2.5))]
    windows = spark.createDataFrame(rows, "batch_id long, start_at timestamp, end_at timestamp")
    e = _events(spark, sf_dir).where((F.col("ts") >= F.lit(_START)) & (F.col("ts") <= F.lit(_END)))
    counts = e.select(F.explode(incremental.batch_ids(F.col("ts"), _START, 2.5)).alias("batch_id")).groupBy("batch_id").agg(F.count("*").alias("records"))
    return _ntz(windows.join(counts, "batch_id", "left").withColumn("records", F.coalesce("records", F.lit(0))))


@_register("SELECT floor((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) / 216000000000)::BIGINT AS batch_id, count(*) AS records FROM events GROUP BY ALL")
def batch_tagged_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).groupBy(incremental.batch_id(F.col("ts"), _START, 2.5).alias("batch_id")).agg(F.count("*").alias("records"))


@_register(
    """WITH p AS (SELECT o_custkey AS batch_id, o_orderkey % 7 + 1 AS page_no, o_custkey % 9 * 10 AS total, 10 AS per_page FROM orders),
    s AS (SELECT batch_id, ceil(max(total) / 10.0)::BIGINT AS expected, list_sort(list(DISTINCT page_no)) AS seen FROM p GROUP BY batch_id)
    SELECT batch_id, expected, len(seen)::INTEGER AS n_seen, len(list_filter(range(1, expected + 1), lambda x: NOT list_contains(seen, x)))::INTEGER AS n_missing,
    len(list_filter(range(1, expected + 1), lambda x: NOT list_contains(seen, x))) = 0 AS complete FROM s"""
)
def page_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = F.struct(F.lit(10).cast("long").alias("per_page"), (F.col("o_orderkey") % 7 + 1).cast("long").alias("page_no"), (F.col("o_custkey") % 9 * 10).cast("long").alias("total"))
    pages = _table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("batch_id"), page.alias("pagination"))
    found = audit_pages(pages, "motive_vehicles", ["batch_id"])
    return found.select("batch_id", "expected", F.size("seen").alias("n_seen"), F.size("missing").alias("n_missing"), "complete")


# --- storage and streams: written to the shared folder under a new name each time ---


def _root(spark: SparkSession, name: str) -> str:
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.match(r"local(\[.*)?$", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="trackmill-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@_register("SELECT user_id AS vehicle_id, count(*) AS items, sum(event_id)::BIGINT AS positions FROM events WHERE event_type = 'view' GROUP BY ALL")
def json_page_unwrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events landed as pages of locations, one page per vehicle, read back and unwrapped."""
    item = F.struct(F.struct(F.col("event_id").cast("string").alias("id"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("located_at"), F.lit(1.5).alias("lat"), F.lit(2.5).alias("lon"), F.lit("breadcrumb").alias("type"), F.col("value").alias("speed")).alias("vehicle_location"))
    pages = _events(spark, sf_dir, "view").groupBy(F.col("user_id").alias("vehicle_id"), F.floor(F.col("event_id") / 1000).alias("page")).agg(F.collect_list(item).alias("vehicle_locations"))
    path = _root(spark, "landing")
    pages.drop("page").write.json(path)
    items = unwrap_items(read_pages(spark, "motive_vehicle_locations", path), "motive_vehicle_locations")
    return items.groupBy("vehicle_id").agg(F.count("*").alias("items"), F.sum(F.col("id").cast("long")).alias("positions"))


@_register(f"WITH {FLAT} SELECT timestamp::DATE AS date, count(*) AS records, round(sum(speed_mph), 4) AS speeds FROM (SELECT provider, provider_vehicle_id, timestamp, CASE WHEN provider = 'samsara' THEN speed_mph + 1 ELSE speed_mph END AS speed_mph FROM flat) GROUP BY ALL")
def merge_partitions_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows merged, then one provider's with other speeds: those replace the stored ones."""
    root, rows = _root(spark, "dataset"), flat(spark, sf_dir)
    storage.merge_partitions(rows, root)
    storage.merge_partitions(unified.filter_provider(rows, "samsara").withColumn("speed_mph", F.col("speed_mph") + 1), root)
    return spark.read.parquet(root).groupBy("date").agg(F.count("*").alias("records"), F.round(F.sum("speed_mph"), 4).alias("speeds"))


@_register("SELECT ts::DATE AS date, count(*) AS records FROM events WHERE ts::DATE >= DATE '2024-01-21' GROUP BY ALL")
def retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _root(spark, "dataset")
    storage.save_partitioned(flat(spark, sf_dir), root)
    storage.apply_retention(spark, root, 10, datetime(2024, 1, 31, 12, tzinfo=timezone.utc))
    return analytics.partition_counts(spark.read.parquet(root))


@_register("SELECT ts::DATE AS date, count(*) AS records, round(sum(value), 4) AS speeds FROM events WHERE event_type = 'view' GROUP BY ALL")
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed pages taken in as a stream, twice; the second time changes nothing."""
    item = F.struct(F.struct(F.col("event_id").cast("string").alias("id"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("located_at"), F.lit(1.5).alias("lat"), F.lit(2.5).alias("lon"), F.lit("breadcrumb").alias("type"), F.col("value").alias("speed")).alias("vehicle_location"))
    pages = _events(spark, sf_dir, "view").groupBy(F.col("user_id").alias("vehicle_id"), F.floor(F.col("event_id") / 1000).alias("page")).agg(F.collect_list(item).alias("vehicle_locations"))
    landing, root = _root(spark, "landing"), _root(spark, "dataset")

    def unify(items: DataFrame) -> DataFrame:
        nothing = F.lit(None).cast("string")
        return items.select(
            F.lit("motive").alias("provider"), F.col("vehicle_id").cast("string").alias("provider_vehicle_id"), nothing.alias("vin"), nothing.alias("fleet_number"), F.col("located_at").alias("timestamp"), "latitude", "longitude", F.col("speed").alias("speed_mph"),
            F.col("bearing").alias("heading_degrees"), nothing.alias("engine_state"), nothing.alias("driver_id"), nothing.alias("driver_name"), F.col("description").alias("location_description"), "odometer",
        )

    for turn in range(2):
        pages.drop("page").write.mode("append").json(landing)
        incremental.stream_ingest(spark, "motive_vehicle_locations", landing, root, f"{root}-checkpoint", unify)
    return spark.read.parquet(root).groupBy("date").agg(F.count("*").alias("records"), F.round(F.sum("speed_mph"), 4).alias("speeds"))


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as telemetry, the engine state as of each reading, typed and summed up by vehicle."""
    readings = flat(spark, sf_dir).where("location_description = 'view'").drop("engine_state")
    states = _states(spark, sf_dir).select(F.col("user_id").cast("string").alias("provider_vehicle_id"), "ts", "engine_state", "ordinal")
    joined = temporal.asof_backward(readings, states, ["provider_vehicle_id"], "timestamp", "engine_state")
    return analytics.vehicle_activity(unified.enforce_schema(joined))


from trackmill import page_queries  # noqa: E402, F401  registers the queries over pages, stored days and streams
