"""Landed JSON pages, one per line, to rows: reading, unwrapping, validating and auditing."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackmill.functions.telemetry import normalize_engine_state, normalize_fuel_type, normalize_message, total_pages
from trackmill.plans.unified import filter_time_range, in_domain, quarantine, trim_strings
from trackmill.sources.schemas import DOMAINS, ENDPOINTS, FIELD_DOMAINS, Endpoint

#: Where an item came from; with these as the order, runs agree. A reading in a series has its ordinal besides.
ORIGIN = ("_file", "_page", "_pos")
ARRIVAL = (*ORIGIN, "_ordinal")


def read_pages(spark: SparkSession, endpoint: str, path: str | Sequence[str], stream: bool = False, skip_unreadable: bool = False) -> DataFrame:
    """Typed pages of one endpoint with _corrupt (the text of a page with a bad field) and _file.

    A bad nested field nulls that field and marks its page; the page's other fields stay. Unknown fields are ignored.
    skip_unreadable passes over files that are missing or damaged, and reads the others.
    """
    schema = T.StructType([*ENDPOINTS[endpoint].page_schema().fields, T.StructField("_corrupt", T.StringType())])
    reader = (spark.readStream if stream else spark.read).schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt")
    if skip_unreadable:
        reader = reader.option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True)
    return reader.json(path).withColumn("_file", F.col("_metadata.file_path"))


def _renamed(c: Column, e: Endpoint) -> Column:
    return c.cast(e.item)


def unwrap_items(pages: DataFrame, endpoint: str) -> DataFrame:
    """One row per item, in snake_case and trimmed, with its origin; carried page columns and defaults filled in."""
    e = ENDPOINTS[endpoint]
    page_no = F.col("pagination.page_no") if e.paging is not None and e.vendor == "motive" else F.lit(None).cast("long")
    carried = [f.name for f in e.carried] + [c for c in ("batch_id",) if c in pages.columns]
    rows = pages.select(*carried, F.col("_file") if "_file" in pages.columns else F.lit(None).cast("string").alias("_file"), page_no.alias("_page"), F.posexplode(e.array).alias("_pos", "_item"))
    item = F.col(f"_item.{e.wrapper}") if e.wrapper else F.col("_item")
    rows = rows.withColumn("_item", _renamed(item, e)).select(*carried, *ORIGIN, "_item.*")
    for name, value in e.defaults.items():
        rows = rows.withColumn(name, F.coalesce(F.col(name), F.lit(value)))
    return trim_strings(_normalised(rows, endpoint))


def _normalised(rows: DataFrame, endpoint: str) -> DataFrame:
    if endpoint == "motive_vehicles":
        rows = rows.withColumn("fuel_type", normalize_fuel_type(F.col("fuel_type")))
    if endpoint == "motive_vehicle_utilization":
        rows = rows.withColumn("message", normalize_message(F.col("message")))
    return rows


def validated(items: DataFrame, endpoint: str) -> tuple[DataFrame, DataFrame]:
    """(good, bad): items with every required field and values inside their domains, and the rest with _errors."""
    e = ENDPOINTS[endpoint]
    rules = {f"{name} missing": F.col(name).isNotNull() for name in e.required}
    rules |= {f"{name} unknown": in_domain(F.col(name), DOMAINS[d]) for name, d in FIELD_DOMAINS.get(endpoint, {}).items()}
    return quarantine(items, rules)


def read_items(spark: SparkSession, endpoint: str, path: str | Sequence[str]) -> DataFrame:
    """The valid items of an endpoint's pages."""
    return validated(unwrap_items(read_pages(spark, endpoint, path), endpoint), endpoint)[0]


def rejected(pages: DataFrame, endpoint: str) -> DataFrame:
    """What read_items leaves out: (_file, reason, content), a row per bad item and per page with a bad field.

    A page that can't be parsed at all has no items, and its text is the content.
    """
    bad = validated(unwrap_items(pages, endpoint), endpoint)[1]
    items = bad.select("_file", F.array_join("_errors", ", ").alias("reason"), F.to_json(F.struct(*[c for c in bad.columns if c not in (*ORIGIN, "_errors")])).alias("content"))
    reason = F.when(F.col(ENDPOINTS[endpoint].array).isNull(), "unreadable page").otherwise("page with a bad field")
    # the reader refuses to give _corrupt without another field
    some = F.coalesce(F.size(ENDPOINTS[endpoint].array), F.lit(0)) >= 0
    broken = pages.where(F.col("_corrupt").isNotNull() & some).select("_file", reason.alias("reason"), F.col("_corrupt").alias("content"))
    return items.unionByName(broken)


def or_none(read: Callable[..., DataFrame], *args, **more) -> DataFrame | None:
    """What read gives, or None where its path can't be read: an input that a run can do without."""
    try:
        return read(*args, **more)
    except AnalysisException:
        return None


def to_table(items: DataFrame) -> DataFrame:
    """Items without their origin; without items the columns stay."""
    return items.drop(*ORIGIN)


def motive_vehicles(spark: SparkSession, path: str) -> DataFrame:
    return read_items(spark, "motive_vehicles", path)


def motive_vehicle_locations(spark: SparkSession, path: str) -> DataFrame:
    """Breadcrumbs; their vehicle_id is the page's."""
    return read_items(spark, "motive_vehicle_locations", path)


def motive_groups(spark: SparkSession, path: str) -> DataFrame:
    return read_items(spark, "motive_groups", path)


def motive_users(spark: SparkSession, path: str) -> DataFrame:
    return read_items(spark, "motive_users", path)


def motive_vehicle_utilization(spark: SparkSession, path: str) -> DataFrame:
    return read_items(spark, "motive_vehicle_utilization", path)


def samsara_vehicles(spark: SparkSession, path: str) -> DataFrame:
    return read_items(spark, "samsara_vehicles", path)


def samsara_drivers(spark: SparkSession, path: str, activation_status: str) -> DataFrame:
    """The drivers with that status, which must be named."""
    return read_items(spark, "samsara_drivers", path).where(F.col("driver_activation_status") == activation_status)


def samsara_addresses(spark: SparkSession, path: str) -> DataFrame:
    return read_items(spark, "samsara_addresses", path)


def samsara_vehicle_stats(spark: SparkSession, path: str, types: Sequence[str] = ("engine_states", "gps", "obd_odometer_meters")) -> DataFrame:
    """Vehicles with the series named in types."""
    return read_items(spark, "samsara_vehicle_stats", path).select(*ORIGIN, "id", "name", "external_ids", *types)


def samsara_location_stream(spark: SparkSession, path: str, vehicle_ids: Sequence[str] | None = None, start=None, end=None, stream: bool = False) -> DataFrame:
    """Positions of the vehicles and the time range asked for; both ends count. stream reads pages as they land."""
    endpoint = "samsara_location_stream"
    rows = validated(unwrap_items(read_pages(spark, endpoint, path, stream), endpoint), endpoint)[0]
    if vehicle_ids is not None:
        rows = rows.where(F.col("asset.id").isin(*vehicle_ids))
    return rows if start is None else filter_time_range(rows, "happened_at_time", start, end)


def samsara_driver_assignments(spark: SparkSession, path: str, filter_by: str = "vehicles", ids: DataFrame | None = None, start=None, end=None) -> DataFrame:
    """Assignments of the vehicles or drivers in ids(id) that overlap the time range."""
    if filter_by not in ("vehicles", "drivers"):
        raise ValueError("filter_by is 'vehicles' or 'drivers'")
    rows = read_items(spark, "samsara_driver_assignments", path)
    if ids is not None:
        wanted = ids.select(F.col("id").alias("_wanted")).distinct()
        rows = rows.join(wanted, F.col("vehicle.id" if filter_by == "vehicles" else "driver.id") == F.col("_wanted"), "left_semi")
    return rows if start is None else rows.where((F.col("start_time") <= F.lit(end)) & (F.col("end_time") >= F.lit(start)))


def explode_series(stats: DataFrame, series: str) -> DataFrame:
    """One row per reading of a series, with its vehicle and its ordinal in the list; vehicles without any have none.

    An engine state that isn't known is null here and a row of unknown_states.
    """
    if series not in ("gps", "engine_states", "obd_odometer_meters"):
        raise ValueError(f"unknown series {series}")
    own = [c for c in ("batch_id", "id", "name", "external_ids") if c in stats.columns]
    rows = stats.select(*own, *[c for c in ORIGIN if c in stats.columns], F.posexplode(series).alias("ordinal", "_r")).select("*", "_r.*").drop("_r")
    return rows.withColumn("value", normalize_engine_state(F.col("value"))) if series == "engine_states" else rows


def unknown_states(stats: DataFrame) -> DataFrame:
    """The engine-state readings to quarantine, with their values as they came."""
    raw = F.filter("engine_states", lambda r: r["value"].isNull() | normalize_engine_state(r["value"]).isNull())
    own = [c for c in ("batch_id", "id", "name", *ORIGIN) if c in stats.columns]
    return stats.select(*own, F.explode(raw).alias("_r")).select(*own, "_r.*")


def audit_pages(pages: DataFrame, endpoint: str, batch: Sequence[str] = ()) -> DataFrame:
    """Whether every page of a collection is there, one row per batch.

    Offset paging: expected pages, those seen and the numbers missing. Cursor paging: whether the last page came; cursors
    don't say which page they lead to, so a page missing in the middle isn't seen.
    """
    if ENDPOINTS[endpoint].vendor == "motive":
        p = F.col("pagination")
        expected = F.max(total_pages(p["total"], p["per_page"])).alias("expected")
        found = pages.groupBy(*batch).agg(expected, F.array_sort(F.collect_set(p["page_no"])).alias("seen"))
        every = F.when(F.col("expected") > 0, F.sequence(F.lit(1).cast("long"), "expected")).otherwise(F.array().cast("array<bigint>"))
        return found.withColumn("missing", F.array_except(every, "seen")).withColumn("complete", F.size("missing") == 0)
    last = ~F.coalesce(F.col("pagination.hasNextPage"), F.lit(False))
    return pages.groupBy(*batch).agg(F.count("*").alias("pages"), F.bool_or(last).alias("complete"))
