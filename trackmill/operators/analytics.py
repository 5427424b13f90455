"""Analyses of the unified table; each is one aggregation over it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackmill.functions.telemetry import engine_on_seconds, has_communication_issue, normalize_message


def vehicle_activity(df: DataFrame) -> DataFrame:
    """First and last time, rows, mean speed and greatest odometer by provider and fleet number; null keys go."""
    return (
        df.dropna(subset=["provider", "fleet_number"])
        .groupBy("provider", "fleet_number")
        .agg(
            F.min("timestamp").alias("first_seen"),
            F.max("timestamp").alias("last_seen"),
            F.count("timestamp").alias("records"),
            F.avg("speed_mph").alias("mean_speed_mph"),
            F.max("odometer").alias("max_odometer"),
        )
    )


def driver_activity(df: DataFrame, n: int | None = 10) -> DataFrame:
    """Rows and mean speed by driver, the busiest first; n of them, or all."""
    found = df.where(F.col("driver_name").isNotNull()).groupBy("driver_name").agg(F.count("timestamp").alias("records"), F.avg("speed_mph").alias("mean_speed_mph"))
    found = found.orderBy(F.desc("records"), "driver_name")
    return found if n is None else found.limit(n)


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows by value, most first; nulls don't count."""
    return df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n")).orderBy(F.desc("n"), col)


#: Shares at which quartiles are bracketed.
_GRID = [i / 1000 for i in range(1001)]


def describe_numeric(df: DataFrame, col: str, most: int = 1_000_000, by: Sequence[str] = ()) -> DataFrame:
    """Count, mean, sample deviation, least, quartiles with interpolation, greatest, of all or by group; exact at any size.

    One pass of quantile sketches brackets all three quartiles of every group, and each further pass narrows the brackets
    and counts what lies below and inside them, until at most so many rows are inside any. Only those are sorted, by
    group and quartile. NaN is null, and so doesn't count; without values all but the count are null.
    """
    c = F.col(col)
    value = F.when(~F.isnan(c.cast("double")), c)
    shape = df.groupBy(*by).agg(F.count(value).alias("count"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.min(value).alias("min"), F.max(value).alias("max"))
    rows = df.select(*by, value.cast("double").alias("_v")).where("_v IS NOT NULL")
    found = _joined(shape, _quartiles(rows, by, most), by, "left")
    return found.select(*by, "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def _joined(left: DataFrame, right: DataFrame, by: Sequence[str], how: str = "inner") -> DataFrame:
    """Joined by group, null groups too; without groups the right side has one row or none."""
    right = right.withColumnsRenamed({c: f"_g_{c}" for c in by})
    on = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in by], F.lit(True))
    return left.join(right, on, how).drop(*[f"_g_{c}" for c in by])


def _bracketed(shares: Column, inside: Column, below: Column, p: Column) -> Column:
    """p with the bracket that a quantile sketch (shares, at _GRID) of the inside values gives its rank and the next one."""
    steps = len(_GRID) - 1
    first = F.greatest(F.floor((p["rank"] - below) / inside * steps).cast("int") - 1, F.lit(0))
    last = F.least(F.ceil((p["rank"] + 1 - below) / inside * steps).cast("int") + 1, F.lit(steps))
    return F.struct(p["percent"].alias("percent"), p["rank"].alias("rank"), p["parts"].alias("parts"), F.get(shares, first).alias("lo"), F.get(shares, last).alias("hi"))


def _quartiles(rows: DataFrame, by: Sequence[str], most: int) -> DataFrame:
    """by and p25, p50, p75 of rows(by, _v)."""
    shares = F.percentile_approx("_v", _GRID, 10_000)
    counted = rows.groupBy(*by).agg(F.count("*").alias("_n"), shares.alias("_q"))
    counted = counted.where("_n > 0").withColumn("_p", F.explode(F.array(*[F.struct(F.lit(p).alias("percent"), F.expr(f"(_n - 1) * {p} div 100").alias("rank"), ((F.col("_n") - 1) * p % 100).alias("parts")) for p in (25, 50, 75)])))
    brackets = counted.select(*by, _bracketed(F.col("_q"), F.col("_n"), F.lit(0), F.col("_p")).alias("_b"))
    while True:
        at, lo, hi = F.col("_v"), F.col("_b.lo"), F.col("_b.hi")
        told = _joined(rows, brackets, by).groupBy(*by, "_b").agg(F.count_if(at < lo).alias("_below"), F.count_if(at.between(lo, hi)).alias("_inside"), F.percentile_approx(F.when(at.between(lo, hi), at), _GRID, 10_000).alias("_q")).persist()
        wide = told.where((F.col("_inside") > most) & (lo < hi)).agg(F.max("_inside")).first()[0]
        if wide is None:
            break
        narrower = told.select(*by, _bracketed(F.col("_q"), F.col("_inside"), F.col("_below"), F.col("_b")).alias("_b")).persist()
        if narrower.exceptAll(told.select(*by, "_b")).isEmpty():
            break  # equal values fill a step of the grid
        brackets = narrower
    inside = _joined(rows, told.select(*by, "_b", "_below"), by).where(F.col("_v").between(F.col("_b.lo"), F.col("_b.hi")))
    values = inside.groupBy(*by, "_b", "_below", "_v").agg(F.count("*").alias("_c"))
    upto = F.col("_below") + F.sum("_c").over(Window.partitionBy(*by, "_b").orderBy("_v"))
    values = values.withColumn("_to", upto)
    holds = lambda rank: (F.col("_to") - F.col("_c") <= rank) & (rank < F.col("_to"))
    rank = F.col("_b.rank")
    ends = values.groupBy(*by, "_b").agg(F.max(F.when(holds(rank), F.col("_v"))).alias("_lo"), F.max(F.when(holds(rank + 1), F.col("_v"))).alias("_hi"))
    exact = F.col("_lo") + (F.coalesce("_hi", "_lo") - F.col("_lo")) * F.col("_b.parts") / 100
    return ends.groupBy(*by).agg(*[F.max(F.when(F.col("_b.percent") == p, exact)).alias(f"p{p}") for p in (25, 50, 75)])


def daily_vehicle_sketches(df: DataFrame, lg_k: int = 12) -> DataFrame:
    """(provider, date, vehicles): sketches of the different vins of each day, to be kept and merged; nulls don't count."""
    rows = df.where(F.col("provider").isNotNull() & F.col("timestamp").isNotNull())
    return rows.groupBy("provider", F.to_date("timestamp").alias("date")).agg(F.hll_sketch_agg("vin", lg_k).alias("vehicles"))


def vehicles_in_sketches(sketches: DataFrame, *keys: str) -> DataFrame:
    """About how many different vins daily sketches hold together, by the keys; no reading is read again.

    The standard error is 1.04 / sqrt(2 ** lg_k), 1.6 % for 12.
    """
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("vehicles")).alias("vehicles"))


def distinct_vehicles_by_provider(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Different vins by provider; nulls don't count."""
    count = F.approx_count_distinct("vin") if approximate else F.count_distinct("vin")
    return df.where(F.col("provider").isNotNull()).groupBy("provider").agg(count.alias("vehicles"))


def mean_speed_by(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.avg("speed_mph").alias("mean_speed_mph"))


def vehicle_summary(df: DataFrame, fleet_number: str | None = None) -> DataFrame:
    """Times, distance (odometer range), mean speed and the drivers in order, of one vehicle or of each."""
    rows = df.where(F.col("fleet_number") == fleet_number) if fleet_number is not None else df.where(F.col("fleet_number").isNotNull())
    return rows.groupBy("fleet_number").agg(
        F.min("timestamp").alias("first_seen"),
        F.max("timestamp").alias("last_seen"),
        (F.max("odometer") - F.min("odometer")).alias("distance"),
        F.avg("speed_mph").alias("mean_speed_mph"),
        F.array_sort(F.collect_set("driver_name")).alias("drivers"),
    )


def dataset_summary(df: DataFrame) -> DataFrame:
    """One row: records, providers, vehicles, first and last time."""
    return df.agg(
        F.count("*").alias("records"),
        F.count_distinct("provider").alias("providers"),
        F.count_distinct("vin").alias("vehicles"),
        F.min("timestamp").alias("first_seen"),
        F.max("timestamp").alias("last_seen"),
    )


def _with_gaps(df: DataFrame, unit: str, value: Column) -> DataFrame:
    """value by provider and bucket, and a row for every bucket from a provider's first to its last."""
    rows = df.where(F.col("provider").isNotNull() & F.col("timestamp").isNotNull()).withColumn("bucket", F.date_trunc(unit, F.col("timestamp")))
    found = rows.groupBy("provider", "bucket").agg(value.alias("_v"))
    ends = found.groupBy("provider").agg(F.min("bucket").alias("_a"), F.max("bucket").alias("_b"))
    every = ends.select("provider", F.explode(F.sequence("_a", "_b", F.expr(f"interval 1 {unit}"))).alias("bucket"))
    return every.join(found, ["provider", "bucket"], "left")


def hourly_mean_speed(df: DataFrame) -> DataFrame:
    """Mean speed by provider and hour; hours without rows between a provider's first and last have null."""
    return _with_gaps(df, "hour", F.avg("speed_mph")).withColumnRenamed("_v", "mean_speed_mph")


def daily_counts(df: DataFrame) -> DataFrame:
    """Rows by provider and day; days without rows between a provider's first and last have 0."""
    return _with_gaps(df, "day", F.count("*")).select("provider", "bucket", F.coalesce("_v", F.lit(0)).alias("records"))


def partition_counts(df: DataFrame, date_col: str = "date") -> DataFrame:
    return df.groupBy(date_col).agg(F.count("*").alias("records"))


def fleet_union_summary(df: DataFrame) -> DataFrame:
    """Vehicles of all providers together, by provider."""
    return df.groupBy("provider").agg(F.count("*").alias("vehicles"))


def utilization_rollup(df: DataFrame, *keys: str) -> DataFrame:
    """Seconds and hours of running engines and rows with a message, over utilization rows."""
    seconds = engine_on_seconds(F.col("idle_time"), F.col("driving_time"))
    return df.groupBy(*keys).agg(
        F.sum(seconds).alias("engine_on_seconds"), (F.sum(seconds) / 3600.0).alias("engine_on_hours"), F.count_if(has_communication_issue(normalize_message(F.col("message")))).alias("communication_issues")
    )
