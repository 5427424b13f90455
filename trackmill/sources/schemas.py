"""Declared JSON schemas of the vendors' pages. Fields that aren't listed are dropped by the reader.

Entity fields are written with our snake_case names; where a vendor's JSON has camelCase, json_name() turns the name
back, with the exceptions listed by hand.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

_S, _L, _D, _B, _T = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.TimestampType()


def _fields(kind: T.DataType, names: str) -> list[T.StructField]:
    return [T.StructField(n, kind) for n in names.split()]


def _struct(*parts: T.StructField | list[T.StructField]) -> T.StructType:
    out: list[T.StructField] = []
    for p in parts:
        out += p if isinstance(p, list) else [p]
    return T.StructType(out)


def _one(name: str, kind: T.DataType) -> T.StructField:
    return T.StructField(name, kind)


_PERSON = _struct(_fields(_L, "id"), _fields(_S, "first_name last_name username email driver_company_id status role"))
_DEVICE = _struct(_fields(_L, "id"), _fields(_S, "identifier model"))
_REF = _struct(_fields(_S, "id name"))
_TAGS = T.ArrayType(_struct(_fields(_S, "id name parent_tag_id")))
_STRINGS, _LONGS, _MAP = T.ArrayType(_S), T.ArrayType(_L), T.MapType(_S, _S)
_PLACE = _struct(_fields(_D, "latitude longitude"))
_EXCEPTIONS = " ".join(f"exception_{n}{k}" for n in "24_hour_restart 8_hour_break wait_time short_haul ca_farm_school_bus adverse_driving".split() for k in ("", "2"))

MOTIVE_VEHICLE = _struct(
    _fields(_L, "id company_id"), _fields(_S, "number status"), _fields(_B, "ifta"), _fields(_S, "vin make model year license_plate_state license_plate_number"),
    _fields(_B, "metric_units"), _fields(_S, "fuel_type"), _fields(_B, "prevent_auto_odometer_entry"), _fields(_S, "notes"),
    _fields(_L, "incab_alert_live_stream_enable driver_facing_camera incab_audio_recording"), _one("group_ids", _LONGS), _fields(_T, "created_at updated_at"),
    _one("permanent_driver", _PERSON), _one("availability_details", _struct(_fields(_S, "availability_status"), _fields(_T, "updated_at"), _fields(_S, "updated_by_user"))),
    _one("eld_device", _DEVICE), _one("current_driver", _PERSON), _one("external_ids", _STRINGS), _fields(_B, "carb_ctc_test_enabled"), _fields(_S, "carb_ctc_emission_status registration_expiry_date"),
)
MOTIVE_LOCATION = _struct(
    _fields(_S, "id"), _fields(_T, "located_at"), _fields(_D, "latitude longitude"), _fields(_S, "location_type description"),
    _fields(_D, "speed bearing battery_voltage odometer true_odometer engine_hours true_engine_hours fuel fuel_primary_remaining_percentage fuel_secondary_remaining_percentage veh_range hvb_state_of_charge"),
    _fields(_S, "hvb_charge_status hvb_charge_source"), _fields(_D, "hvb_lifetime_energy_output"), _one("driver", _PERSON), _one("eld_device", _DEVICE),
)
MOTIVE_GROUP = _struct(_fields(_L, "id"), _fields(_S, "name"), _fields(_L, "company_id parent_id"), _one("user", _PERSON))
MOTIVE_USER = _struct(
    _fields(_L, "id"), _fields(_S, "email first_name last_name username driver_company_id phone phone_country_code phone_ext time_zone"), _fields(_B, "metric_units"),
    _fields(_S, "role status duty_status eld_mode"), _one("group_ids", _LONGS),
    _fields(_S, "company_reference_id drivers_license_number drivers_license_state carrier_name carrier_street carrier_city carrier_state carrier_zip terminal_street terminal_city terminal_state terminal_zip cycle cycle2"),
    _fields(_B, _EXCEPTIONS), _fields(_B, "export_combined export_recap export_odometers minute_logs yard_moves_enabled personal_conveyance_enabled manual_driving_enabled"), _fields(_S, "violation_alerts"),
    _fields(_T, "mobile_last_active_at mobile_current_sign_in_at mobile_last_sign_in_at web_last_active_at web_current_sign_in_at web_last_sign_in_at created_at updated_at"), _one("external_ids", _STRINGS),
)
MOTIVE_UTILIZATION = _struct(
    _fields(_S, "message"), _fields(_T, "last_located_at"), _fields(_D, "utilization_percentage"), _fields(_L, "idle_time"), _fields(_D, "idle_fuel"), _fields(_L, "driving_time"),
    _fields(_D, "driving_fuel total_fuel total_distance"), _one("vehicle", _struct(_fields(_L, "id"), _fields(_S, "number year make model vin"), _fields(_B, "metric_units"))),
)
SAMSARA_VEHICLE = _struct(
    _fields(_S, "id name vin make model year serial notes camera_serial vehicle_regulation_mode harsh_acceleration_setting_type"), _one("gateway", _struct(_fields(_S, "serial model"))),
    _one("static_assigned_driver", _REF), _one("tags", _TAGS), _one("attributes", T.ArrayType(_struct(_fields(_S, "id name"), _one("string_values", _STRINGS)))), _one("external_ids", _MAP), _fields(_T, "created_at_time updated_at_time"),
)
SAMSARA_DRIVER = _struct(
    _fields(_S, "id name username phone license_number license_state timezone driver_activation_status"), _fields(_B, "is_deactivated eld_exempt"), _fields(_S, "eld_exempt_reason"),
    _fields(_B, "eld_big_day_exemption_enabled eld_adverse_weather_exemption_enabled eld_pc_enabled eld_ym_enabled waiting_time_duty_status_enabled"),
    _one("eld_settings", _struct(_one("rulesets", T.ArrayType(_struct(_fields(_S, "cycle shift restart break_rule")))))),
    _one("carrier_settings", _struct(_fields(_S, "carrier_name main_office_address"), _fields(_L, "dot_number"), _fields(_S, "home_terminal_name home_terminal_address"))),
    _one("hos_setting", _struct(_fields(_B, "heavy_haul_exemption_toggle_enabled"))), _one("static_assigned_vehicle", _REF), _one("tags", _TAGS), _fields(_B, "has_vehicle_unpinning_enabled"), _fields(_T, "created_at_time updated_at_time"),
)
SAMSARA_ADDRESS = _struct(
    _fields(_S, "id name formatted_address"), _fields(_D, "latitude longitude"),
    _one("geofence", _struct(_one("polygon", _struct(_one("vertices", T.ArrayType(_PLACE)))), _one("settings", _struct(_fields(_B, "show_addresses"))))),
    _one("address_types", _STRINGS), _one("tags", _TAGS), _fields(_T, "created_at_time"),
)
SAMSARA_STATS = _struct(
    _fields(_S, "id name"), _one("external_ids", _MAP), _one("engine_states", T.ArrayType(_struct(_fields(_T, "time"), _fields(_S, "value")))),
    _one("gps", T.ArrayType(_struct(_fields(_T, "time"), _fields(_D, "latitude longitude heading_degrees speed_miles_per_hour"), _one("reverse_geo", _struct(_fields(_S, "formatted_location"))), _one("address", _REF), _fields(_B, "is_ecu_speed")))),
    _one("obd_odometer_meters", T.ArrayType(_struct(_fields(_T, "time"), _fields(_L, "value")))),
)
SAMSARA_LOCATION = _struct(_fields(_T, "happened_at_time"), _one("asset", _struct(_fields(_S, "id"))), _one("location", _struct(_fields(_D, "latitude longitude heading_degrees accuracy_meters"), _fields(_S, "geofence"))))
SAMSARA_ASSIGNMENT = _struct(
    _fields(_T, "start_time end_time"), _fields(_B, "is_passenger"), _fields(_S, "assigned_at_time assignment_type"), _one("driver", _REF), _one("vehicle", _struct(_fields(_S, "id name"), _one("external_ids", _MAP)))
)

_OFFSET = _struct(_fields(_L, "per_page page_no total"))
_CURSOR = _struct(_fields(_S, "end_cursor"), _fields(_B, "has_next_page"))


@dataclass(frozen=True)
class Endpoint:
    """One kind of page: vendor, the array that holds items, what wraps each, the item's schema and its rules."""

    name: str
    vendor: str
    array: str
    wrapper: str | None
    item: T.StructType
    paging: T.StructType | None
    carried: tuple[T.StructField, ...] = ()
    required: tuple[str, ...] = ()
    defaults: dict[str, object] = field(default_factory=dict)
    json_names: dict[str, str] = field(default_factory=dict)

    def page_schema(self) -> T.StructType:
        item = to_json_schema(self.item, self.vendor == "samsara", self.json_names)
        items = T.ArrayType(_struct(_one(self.wrapper, item)) if self.wrapper else item)
        paging = [_one("pagination", to_json_schema(self.paging, self.vendor == "samsara", {}))] if self.paging else []
        return _struct(_one(self.array, items), paging, list(self.carried))


def json_name(name: str, camel: bool, exceptions: dict[str, str]) -> str:
    """The vendor's name of a field."""
    if name in exceptions:
        return exceptions[name]
    first, *rest = name.split("_")
    return first + "".join(w.capitalize() for w in rest) if camel else name


def to_json_schema(kind: T.DataType, camel: bool, exceptions: dict[str, str]) -> T.DataType:
    """kind with the vendor's field names at every level."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(json_name(f.name, camel, exceptions), to_json_schema(f.dataType, camel, exceptions)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(to_json_schema(kind.elementType, camel, exceptions))
    return kind


_USER_ON = {n: True for n in "export_combined export_recap export_odometers minute_logs".split()}
_USER_OFF = {n: False for n in [*_EXCEPTIONS.split(), *"metric_units yard_moves_enabled personal_conveyance_enabled manual_driving_enabled".split()]}
_VEHICLE_DEFAULTS = {"metric_units": False, "prevent_auto_odometer_entry": False, "incab_alert_live_stream_enable": -1, "driver_facing_camera": -1, "incab_audio_recording": -1}

ENDPOINTS: dict[str, Endpoint] = {
    e.name: e
    for e in (
        Endpoint("motive_vehicles", "motive", "vehicles", "vehicle", MOTIVE_VEHICLE, _OFFSET, (), ("id", "company_id", "number", "status", "ifta", "created_at", "updated_at"), _VEHICLE_DEFAULTS),
        Endpoint("motive_vehicle_locations", "motive", "vehicle_locations", "vehicle_location", MOTIVE_LOCATION, None, (_one("vehicle_id", _L),), ("id", "located_at", "latitude", "longitude", "location_type"), {}, {"latitude": "lat", "longitude": "lon", "location_type": "type"}),
        Endpoint("motive_groups", "motive", "groups", "group", MOTIVE_GROUP, _OFFSET, (), ("id", "name", "company_id")),
        Endpoint("motive_users", "motive", "users", "user", MOTIVE_USER, _OFFSET, (), ("id", "first_name", "last_name", "role", "status", "created_at", "updated_at"), _USER_ON | _USER_OFF),
        Endpoint("motive_vehicle_utilization", "motive", "vehicle_utilizations", "vehicle_utilization", MOTIVE_UTILIZATION, _OFFSET, (), ("utilization_percentage", "idle_time", "idle_fuel", "driving_time", "driving_fuel", "total_fuel", "total_distance", "vehicle")),
        Endpoint("samsara_vehicles", "samsara", "data", None, SAMSARA_VEHICLE, _CURSOR, (), ("id", "name")),
        Endpoint("samsara_drivers", "samsara", "data", None, SAMSARA_DRIVER, _CURSOR, (), ("id", "name"), {}, {"break_rule": "break"}),
        Endpoint("samsara_addresses", "samsara", "data", None, SAMSARA_ADDRESS, _CURSOR, (), ("id", "name")),
        Endpoint("samsara_vehicle_stats", "samsara", "data", None, SAMSARA_STATS, _CURSOR, (), ("id", "name")),
        Endpoint("samsara_location_stream", "samsara", "data", None, SAMSARA_LOCATION, _CURSOR, (), ("happened_at_time", "asset", "location")),
        Endpoint("samsara_driver_assignments", "samsara", "data", None, SAMSARA_ASSIGNMENT, _CURSOR, (), ("start_time", "end_time", "is_passenger", "assignment_type", "driver", "vehicle")),
    )
}

#: Values that a field may have.
DOMAINS = {
    "user_role": ("driver", "admin", "fleet_manager", "safety_manager"),
    "status": ("active", "inactive", "deactivated"),
    "availability_status": ("in_service", "out_of_service"),
    "duty_status": ("off_duty", "sleeper", "driving", "on_duty", "yard_moves", "personal_conveyance"),
    "eld_mode": ("logs", "exempt"),
    "location_type": ("breadcrumb", "vehicle_stopped", "vehicle_moving", "ignition_on", "ignition_off", "engine_start", "engine_stop", "gps_moving", "gps_stopped"),
    "driver_activation_status": ("active", "deactivated"),
    "vehicle_regulation_mode": ("regulated", "unregulated"),
    "harsh_acceleration_setting_type": ("automatic", "manual", "off"),
    "assignment_type": ("HOS", "dispatch", "manual", "static", "idCard", "faceId", "tachograph", "safetyManual", "RFID", "trailer", "external", "qrCode", "invalid", "unknown"),
}
#: Which fields of an endpoint have which domain.
FIELD_DOMAINS = {
    "motive_vehicles": {"status": "status"},
    "motive_vehicle_locations": {"location_type": "location_type"},
    "motive_users": {"role": "user_role", "status": "status", "duty_status": "duty_status", "eld_mode": "eld_mode"},
    "samsara_vehicles": {"vehicle_regulation_mode": "vehicle_regulation_mode", "harsh_acceleration_setting_type": "harsh_acceleration_setting_type"},
    "samsara_drivers": {"driver_activation_status": "driver_activation_status"},
    "samsara_driver_assignments": {"assignment_type": "assignment_type"},
}
