"""The unified telemetry table: its columns, typing, validation and simple filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TELEMETRY_SCHEMA = T.StructType(
    [
        T.StructField("provider", T.StringType()),
        T.StructField("provider_vehicle_id", T.StringType()),
        T.StructField("vin", T.StringType()),
        T.StructField("fleet_number", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("speed_mph", T.DoubleType()),
        T.StructField("heading_degrees", T.DoubleType()),
        T.StructField("engine_state", T.StringType()),
        T.StructField("driver_id", T.StringType()),
        T.StructField("driver_name", T.StringType()),
        T.StructField("location_description", T.StringType()),
        T.StructField("odometer", T.DoubleType()),
    ]
)
TELEMETRY_COLUMNS = TELEMETRY_SCHEMA.fieldNames()
#: Rows with equal keys are versions of one reading; the table is sorted by the same columns.
DEDUP_KEYS = SORT_KEYS = ("provider", "provider_vehicle_id", "timestamp")


def require_columns(df: DataFrame, columns: Sequence[str] = tuple(TELEMETRY_COLUMNS)) -> DataFrame:
    """df itself, or an error that names the missing columns in order."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def blank(c: Column) -> Column:
    return c.rlike(r"(?U)^\s*$")


def blank_to_null(df: DataFrame) -> DataFrame:
    """Text of white space alone, Unicode's included, becomes null in every string column."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.when(~blank(F.col(f"`{c}`")), F.col(f"`{c}`")) for c in text}) if text else df


def coerce_timestamp(c: Column) -> Column:
    """An instant; text that is no time is null, text without a zone is UTC under a session in UTC."""
    return c.try_cast("timestamp")


def coerce_double(c: Column, kind: T.DataType) -> Column:
    """A double; text that is no number is null. Java's number suffixes, as in 1.0d, are not taken; nor is NaN."""
    if isinstance(kind, T.StringType):
        number = c.rlike(r"(?i)^\s*[+-]?inf(inity)?\s*$") | ~c.rlike(r"[dDfF]\s*$")
        value = F.when(number, F.trim(c).try_cast("double"))
    elif isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType, T.ArrayType, T.MapType, T.StructType, T.BinaryType)):
        return F.lit(None).cast("double")
    else:
        value = c.cast("double")
    return F.when(~F.isnan(value), value)


def coerce_string(c: Column, kind: T.DataType) -> Column:
    """Text of anything; whole doubles print without an exponent or a fraction."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        whole = (c == F.floor(c)) & (F.abs(c) < 1e15)
        return F.when(whole, c.cast("long").cast("string")).when(~F.isnan(c), c.cast("string"))
    return c.cast("string")


def enforce_schema(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The 14 columns in order with their types. Blanks and bad values are null; idempotent.

    Further columns go, but for those in keep, which follow as they are.
    """
    df, out = blank_to_null(require_columns(df).select(*TELEMETRY_COLUMNS, *keep)), []
    for field in TELEMETRY_SCHEMA.fields:
        c, kind = F.col(field.name), df.schema[field.name].dataType
        if isinstance(field.dataType, T.TimestampType):
            c = coerce_timestamp(c)
        elif isinstance(field.dataType, T.DoubleType):
            c = coerce_double(c, kind)
        else:
            c = coerce_string(c, kind)
        out.append(c.alias(field.name))
    return df.select(*out, *keep)


def trimmed(c: Column, kind: T.DataType) -> Column:
    """c with all its text trimmed, in structs, arrays and maps too."""
    if isinstance(kind, T.StringType):
        return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: trimmed(x, kind.elementType))
    if isinstance(kind, T.MapType) and isinstance(kind.valueType, T.StringType):
        return F.transform_values(c, lambda _, v: trimmed(v, kind.valueType))
    if isinstance(kind, T.StructType):
        return F.when(c.isNotNull(), F.struct(*[trimmed(c[f.name], f.dataType).alias(f.name) for f in kind.fields]))
    return c


def trim_strings(df: DataFrame) -> DataFrame:
    return df.select(*[trimmed(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])


def quarantine(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(good, bad): rows that meet every rule, and the others with the broken rules' names in _errors.

    A rule that is null for a row is broken by it.
    """
    errors = F.array_compact(F.array(*[F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]))
    marked = df.withColumn("_errors", errors)
    return marked.where(F.size("_errors") == 0).drop("_errors"), marked.where(F.size("_errors") > 0)


def in_domain(c: Column, values: Sequence[str], required: bool = False) -> Column:
    """A rule: one of the values, or null unless required."""
    return F.coalesce(c.isin(*values), F.lit(not required))


def filter_time_range(df: DataFrame, ts: str, start, end) -> DataFrame:
    """Both ends count, so a row on a border belongs to both batches and later keeps one version."""
    return df.where(F.col(ts).between(F.lit(start), F.lit(end)))


def date_superset_filter(df: DataFrame, ts: str, start, end, date_col: str = "date") -> DataFrame:
    """The days that the range touches, which prunes partitions, then the exact range."""
    return filter_time_range(df.where(F.col(date_col).between(F.to_date(F.lit(start)), F.to_date(F.lit(end)))), ts, start, end)


def filter_not_passenger(df: DataFrame) -> DataFrame:
    """Those who drive; a missing flag counts as false, as in interval_join_first."""
    return df.where(~F.coalesce("is_passenger", F.lit(False)))


def filter_known_driver(df: DataFrame) -> DataFrame:
    return df.where(F.col("driver_name").isNotNull())


def filter_vehicle(df: DataFrame, vin: str | None = None, fleet_number: str | None = None) -> DataFrame:
    for name, value in (("vin", vin), ("fleet_number", fleet_number)):
        if value is not None:
            df = df.where(F.col(name) == value)
    return df


def filter_provider(df: DataFrame, provider: str) -> DataFrame:
    return df.where(F.col("provider") == provider)


def missing_vin_report(df: DataFrame) -> DataFrame:
    """Vehicles with rows that lack a vin, and how many rows."""
    return df.where(F.col("vin").isNull()).groupBy("provider", "fleet_number", "provider_vehicle_id").agg(F.count("*").alias("rows_without_vin"))


def null_counts(df: DataFrame) -> DataFrame:
    """One row: nulls by column."""
    return df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
