"""Scalar expressions on telemetry columns; all are built-in functions, so they stay inside code generation."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the vendors' data and of the unified table.
MPH_PER_KPH = 0.621371
METERS_PER_MILE = 1609.344
MOVING_MPH = 3.0
STOPPED_TYPES = ("vehicle_stopped", "gps_stopped")
OFF_TYPES = ("ignition_off", "engine_stop")
MOVING_TYPES = ("vehicle_moving", "vehicle_driving", "gps_moving")
STARTED_TYPES = ("ignition_on", "engine_start")
FUEL_TYPES = ("diesel", "gasoline", "electric", "hybrid", "cng", "lng", "propane")
ENGINE_STATES = ("On", "Off", "Idle")
SIZE_UNITS = {"bytes": 1.0, "kb": 1024.0, "mb": 1024.0**2, "gb": 1024.0**3}


def speed_to_mph(speed: Column, metric: Column) -> Column:
    """Speeds of vehicles with metric units from km/h; others, and an unknown unit, unchanged."""
    return F.when(F.coalesce(metric, F.lit(False)), speed * MPH_PER_KPH).otherwise(speed)


def derive_engine_state(location_type: Column, mph: Column) -> Column:
    """On, Off or Idle from an event type and a speed; null if both are null. The first rule that holds decides."""
    return (
        F.when(location_type.isNull() & mph.isNull(), F.lit(None).cast("string"))
        .when(location_type.isin(*STOPPED_TYPES), "Idle")
        .when(location_type.isin(*OFF_TYPES), "Off")
        .when(mph > MOVING_MPH, "On")
        .when(mph <= MOVING_MPH, "Idle")
        .when(location_type.isin(*MOVING_TYPES), "On")
        .when(location_type.isin(*STARTED_TYPES), "Idle")
        .otherwise("Off")
    )


def best_odometer(true_odometer: Column, odometer: Column) -> Column:
    """The engine's own reading, else the computed one."""
    return F.coalesce(true_odometer, odometer)


def full_name(person: Column) -> Column:
    """First and last name of a struct with both; null for no person."""
    return F.when(person.isNotNull(), F.concat(person["first_name"], F.lit(" "), person["last_name"]))


def meters_to_miles(meters: Column) -> Column:
    return meters.cast("double") / METERS_PER_MILE


def meters_to_km(meters: Column) -> Column:
    return meters.cast("double") / 1000.0


def normalize_engine_state(state: Column) -> Column:
    """On, Off or Idle whatever the case; anything else is null and for quarantine."""
    named = F.initcap(F.lower(state))
    return F.when(named.isin(*ENGINE_STATES), named)


def normalize_fuel_type(fuel: Column) -> Column:
    """Lower case; unknown types are null."""
    return F.when(F.lower(fuel).isin(*FUEL_TYPES), F.lower(fuel))


def normalize_message(message: Column) -> Column:
    """An empty message is none; a blank one stays."""
    return F.nullif(message, F.lit(""))


def engine_on_seconds(idle: Column, driving: Column) -> Column:
    return idle + driving


def engine_on_hours(idle: Column, driving: Column) -> Column:
    return (idle + driving) / 3600.0


def has_communication_issue(message: Column) -> Column:
    """Of a normalised message; one of blanks is an issue, also after it was trimmed."""
    return message.isNotNull()


def external_id(ids: Column, key: str) -> Column:
    """A map's value, null where it has no such key."""
    return F.try_element_at(ids, F.lit(key))


def vin(ids: Column) -> Column:
    return external_id(ids, "samsara.vin")


def serial(ids: Column) -> Column:
    return external_id(ids, "samsara.serial")


def formatted_location(reverse_geo: Column) -> Column:
    return reverse_geo["formatted_location"]


def coordinates(latitude: Column, longitude: Column) -> Column:
    """(latitude, longitude); null unless both are there."""
    return F.when(latitude.isNotNull() & longitude.isNotNull(), F.struct(latitude.alias("latitude"), longitude.alias("longitude")))


def is_moving_motive(location_type: Column, speed: Column) -> Column:
    """By the speed if there is one, else unless the event says that the vehicle stands."""
    return F.when(speed.isNotNull(), speed > 0).otherwise(~F.coalesce(location_type, F.lit("")).isin("vehicle_stopped", "ignition_off"))


def is_moving_samsara(speed: Column) -> Column:
    return F.coalesce(speed > 0, F.lit(False))


def duration_seconds(start: Column, end: Column) -> Column:
    """Seconds with their fraction, from microseconds."""
    return (F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / 1e6


def duration_hours(start: Column, end: Column) -> Column:
    return duration_seconds(start, end) / 3600.0


def to_snake(name: str) -> str:
    """vendorName as vendor_name."""
    return re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name).lower()


def contains_timestamp(start: Column, end: Column, at: Column) -> Column:
    """Both ends count."""
    return at.between(start, end)


def has_items(items: Column) -> Column:
    """Whether an array has elements; null has none. Serves the flags for engine, gps and odometer series."""
    return F.size(F.coalesce(items, F.array())) > 0


def has_value(value: Column) -> Column:
    """Serves the flags for a current driver, a gateway and a geofence."""
    return value.isNotNull()


def is_top_level(parent: Column) -> Column:
    return parent.isNull()


def equals(value: Column, wanted: str) -> Column:
    """Null is not equal. Serves is_active, is_driver and is_regulated."""
    return value.eqNullSafe(F.lit(wanted))


def terminal_location(city: Column, state: Column) -> Column:
    """'city, state' if both are there and not empty."""
    return F.when((F.coalesce(city, F.lit("")) != "") & (F.coalesce(state, F.lit("")) != ""), F.concat(city, F.lit(", "), state))


def home_terminal(carrier: Column) -> Column:
    return carrier["home_terminal_name"]


def total_pages(total: Column, per_page: Column) -> Column:
    """Pages rounded up; 0 for pages of no size."""
    return F.when(per_page == 0, 0).otherwise(F.try_divide(total + per_page - 1, per_page).cast("double")).cast("double").cast("long")


def has_next_page(page: Column, total: Column, per_page: Column) -> Column:
    return page < total_pages(total, per_page)


def next_page(page: Column, total: Column, per_page: Column) -> Column:
    return F.when(has_next_page(page, total, per_page), page + 1)


def to_partition_date(at: Column) -> Column:
    """The UTC day of an instant, under a session in UTC."""
    return F.to_date(at)


def format_utc_z(at: Column) -> Column:
    """2024-01-31T12:00:00Z; fractions of a second are cut."""
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def size_in(size: Column, unit: str = "mb") -> Column:
    return size / SIZE_UNITS[unit]
