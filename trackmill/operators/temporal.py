"""Temporal joins: backward as-of, nearest within a tolerance, first containing interval.

All deal rows out by key and time bucket, not by key alone, so one vehicle's long history is no single task's work.
Times are compared in whole microseconds. Left rows keep their number and columns. A null key matches nothing, as in an
equality join.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY = 86_400


def _micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def _bucket(micros: Column, seconds: int) -> Column:
    return F.floor(micros / F.lit(seconds * 1_000_000)).cast("long")


def _known(by: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in by])


def _dealt(df: DataFrame, by: Sequence[str], seconds: int) -> DataFrame:
    """df with its bucket _b; rows without a key have no partner and are spread by their time."""
    return df.withColumn("_b", F.when(_known(by), _bucket(F.col("_us"), seconds)).otherwise(F.xxhash64("_us")))


def _tagged(df: DataFrame, by: Sequence[str], ts: str, is_left: int, row: Column, value: Column, ordinal: Column) -> DataFrame:
    return df.select(*by, _micros(F.col(ts)).alias("_us"), F.lit(is_left).alias("_left"), row.alias("_row"), value.alias("_value"), ordinal.cast("long").alias("_ord"))


def _payload(left: DataFrame, right: DataFrame, by: Sequence[str], ts: str, right_ts: str, value: str, ordinal: str):
    row = F.struct(*left.columns)
    kind = f"struct<value:{right.schema[value].dataType.simpleString()},us:bigint,ord:bigint>"
    some = F.struct(F.col(value).alias("value"), _micros(F.col(right_ts)).alias("us"), F.col(ordinal).cast("long").alias("ord"))
    none_row = F.lit(None).cast(left.select(row.alias("r")).schema["r"].dataType)
    l_rows = _tagged(left, by, ts, 1, row, F.lit(None).cast(kind), F.lit(None))
    r_rows = _tagged(right.where(F.col(right_ts).isNotNull() & _known(by)), by, right_ts, 0, none_row, some, F.col(ordinal))
    return l_rows, r_rows


def asof_backward(left: DataFrame, right: DataFrame, by: Sequence[str], ts: str, value: str, *, right_ts: str = "ts", ordinal: str = "ordinal", out: str | None = None, bucket_seconds: int = DAY) -> DataFrame:
    """left with value of the latest right row of the same key at or before ts; null without one.

    Of right rows at one time the last in list order (ordinal) counts, and a null value there is a match. Rows are
    dealt by key and bucket; what a bucket inherits is the last value of the buckets before, found on one row each.
    """
    out = out or value
    l_rows, r_rows = _payload(left, right, by, ts, right_ts, value, ordinal)
    l_rows, r_rows = (_dealt(d, by, bucket_seconds) for d in (l_rows, r_rows))
    carried = _carried(l_rows, r_rows, by)
    frame = Window.partitionBy(*by, "_b").orderBy(F.col("_us").asc_nulls_first(), "_left", "_ord").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # a left row without a time sorts by the carried rows and must not see them
    found = F.when(F.col("_us").isNotNull() & _known(by), F.last("_value", ignorenulls=True).over(frame))
    rows = l_rows.unionByName(r_rows).unionByName(carried).withColumn("_found", found)
    return rows.where("_left = 1").select("_row.*", F.col("_found.value").alias(out))


def _carried(l_rows: DataFrame, r_rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """A row per key and bucket with left rows: the last value of the buckets before, to stand ahead of the bucket's own."""
    ends = r_rows.groupBy(*by, "_b").agg(F.max_by("_value", F.struct("_us", "_ord")).alias("_value"))
    wanted = l_rows.where(_known(by)).select(*by, "_b").distinct().withColumn("_value", F.lit(None).cast(ends.schema["_value"].dataType))
    line = Window.partitionBy(*by).orderBy("_b", F.col("_value").isNotNull())
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.unionByName(wanted).withColumn("_carry", F.last("_value", ignorenulls=True).over(before))
    return carried.where("_value IS NULL AND _carry IS NOT NULL").select(*by, F.lit(None).cast("long").alias("_us"), F.lit(0).alias("_left"), F.lit(None).cast(l_rows.schema["_row"].dataType).alias("_row"), F.col("_carry").alias("_value"), F.lit(None).cast("long").alias("_ord"), "_b")


def asof_nearest(left: DataFrame, right: DataFrame, by: Sequence[str], ts: str, value: str, *, right_ts: str = "ts", ordinal: str = "ordinal", tolerance_s: float = 1800, out: str | None = None) -> DataFrame:
    """left with value of the right row of the same key nearest to ts, if not farther than tolerance_s; else null.

    Exactly tolerance_s away counts. Of equally near rows the first in list order counts. A right row is put into
    every bucket that its tolerance reaches, so buckets are independent.
    """
    out = out or value
    reach = int(round(tolerance_s * 1_000_000))
    seconds = max(DAY, int(2 * tolerance_s) + 1)
    l_rows, r_rows = _payload(left, right, by, ts, right_ts, value, ordinal)
    rows = _dealt(l_rows, by, seconds).unionByName(_reaching(r_rows, reach, seconds))
    part = Window.partitionBy(*by, "_b")
    back = part.orderBy("_us", "_left", F.col("_ord").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = part.orderBy("_us", F.col("_left").desc(), "_ord").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rows = rows.withColumn("_p", F.last("_value", ignorenulls=True).over(back)).withColumn("_n", F.first("_value", ignorenulls=True).over(ahead))
    return rows.where("_left = 1").select("_row.*", _nearest(reach)["value"].alias(out))


def _reaching(r_rows: DataFrame, reach: int, seconds: int) -> DataFrame:
    """Each right row in every bucket that its tolerance reaches."""
    return r_rows.withColumn("_b", F.explode(F.sequence(_bucket(F.col("_us") - reach, seconds), _bucket(F.col("_us") + reach, seconds))))


def _nearest(reach: int) -> Column:
    """The nearer of _p and _n, the values before and after, if within reach."""

    def candidate(c: str) -> Column:
        gap = F.abs(F.col(f"{c}.us") - F.col("_us"))
        return F.when(gap <= reach, F.struct(gap.alias("gap"), F.col(f"{c}.ord").alias("ord"), F.col(f"{c}.value").alias("value")))

    p, n = candidate("_p"), candidate("_n")
    order = lambda c: F.struct(c["gap"], c["ord"])
    return F.when(p.isNull(), n).when(n.isNull(), p).when(order(p) <= order(n), p).otherwise(n)


def interval_join_first(left: DataFrame, intervals: DataFrame, by: Sequence[str], ts: str, values: Sequence[str], *, start: str = "start_time", end: str = "end_time", ordinal: str = "ordinal", passenger: str | None = "is_passenger", bucket_seconds: int = DAY) -> DataFrame:
    """left with values of the first interval, in list order, of the same key that holds ts, both ends included.

    Passengers' intervals don't count; without an interval values are null, and overlaps don't repeat rows. The answer
    hangs on key and time alone, so distinct probes are joined by key and bucket. Intervals are clipped to the key's
    own probes before they are put into buckets, so open ends cost no more than the probes' range.
    """
    probes = left.where(F.col(ts).isNotNull()).select(*by, F.col(ts).alias("_ts"), _micros(F.col(ts)).alias("_us")).distinct()
    reach = probes.groupBy(*by).agg(F.min("_us").alias("_lo"), F.max("_us").alias("_hi"))
    good = intervals.where(~F.coalesce(F.col(passenger), F.lit(False))) if passenger else intervals
    good = good.select(*by, _micros(F.col(start)).alias("_s"), _micros(F.col(end)).alias("_e"), F.col(ordinal).alias("_ord"), F.struct(*values).alias("_v"))
    clipped = good.join(reach, list(by)).withColumns({"_lo": F.greatest("_s", "_lo"), "_hi": F.least("_e", "_hi")}).where("_lo <= _hi")
    dealt = clipped.withColumn("_b", F.explode(F.sequence(_bucket(F.col("_lo"), bucket_seconds), _bucket(F.col("_hi"), bucket_seconds))))
    probes = probes.withColumn("_b", _bucket(F.col("_us"), bucket_seconds))
    found = probes.join(dealt.drop("_lo", "_hi"), [*by, "_b"]).where("_us BETWEEN _s AND _e").groupBy(*by, "_ts").agg(F.min_by("_v", "_ord").alias("_v"))
    found = found.withColumnsRenamed({c: f"_k_{c}" for c in by})
    on = F.col(ts).eqNullSafe(F.col("_ts"))
    for c in by:
        on &= F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    return left.join(found, on, "left").select(*left.columns, *[F.col(f"_v.{v}").alias(v) for v in values])


def enrich_gps(gps: DataFrame, states: DataFrame, odometers: DataFrame, assignments: DataFrame, by: Sequence[str], ts: str = "ts", tolerance_s: float = 1800) -> DataFrame:
    """gps with the engine state as of its time, the nearest odometer and the driver then.

    states(ts, engine_state, ordinal), odometers(ts, odometer, ordinal) and assignments(start_time, end_time,
    is_passenger, driver_id, driver_name, ordinal) share the key columns by. States and odometers are dealt out with
    the readings at once, so a reading moves once for both.
    """
    reach, seconds = int(round(tolerance_s * 1_000_000)), max(DAY, int(2 * tolerance_s) + 1)
    l_rows, s_rows = (_dealt(d, by, seconds) for d in _payload(gps, states, by, ts, "ts", "engine_state", "ordinal"))
    o_rows = _reaching(_payload(gps, odometers, by, ts, "ts", "odometer", "ordinal")[1], reach, seconds)
    s_rows = l_rows.unionByName(s_rows).unionByName(_carried(l_rows, s_rows, by)).withColumnRenamed("_value", "_state")
    o_rows = o_rows.withColumn("_ord", -F.col("_ord"))  # of equal times the first counts, so it comes last
    rows = s_rows.unionByName(o_rows, allowMissingColumns=True)
    part = Window.partitionBy(*by, "_b")
    back = part.orderBy(F.col("_us").asc_nulls_first(), "_left", "_ord").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = part.orderBy("_us", F.col("_left").desc(), F.col("_ord").desc()).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rows = rows.withColumns({"_s": F.last("_state", ignorenulls=True).over(back), "_p": F.last("_value", ignorenulls=True).over(back), "_n": F.first("_value", ignorenulls=True).over(ahead)})
    state = F.when(F.col("_us").isNotNull() & _known(by), F.col("_s.value"))
    out = rows.where("_left = 1").select("_row.*", state.alias("engine_state"), _nearest(reach)["value"].alias("odometer"))
    return interval_join_first(out, assignments, by, ts, ["driver_id", "driver_name"])


def driver_at(assignments: DataFrame, probes: DataFrame, by: Sequence[str], ts: str = "ts") -> DataFrame:
    """probes with the driver's name at their time."""
    return interval_join_first(probes, assignments, by, ts, ["driver_name"])


def join_vehicle_dim(locations: DataFrame, vehicles: DataFrame, key: str = "vehicle_id") -> DataFrame:
    """Inner join with the vehicles; Spark broadcasts them if their measured size allows and shuffles otherwise."""
    return locations.join(vehicles, key)


def assignments_for(assignments: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The assignments of the vehicles or drivers in ids."""
    return assignments.join(ids.select(key).distinct(), key, "left_semi")


def affected_partitions(existing: DataFrame, new: DataFrame, date_col: str = "date") -> DataFrame:
    """The rows of existing on days that new touches.

    The days are broadcast, being no more than the calendar has, and prune the partitions of existing at run time. The
    lower bound, which every day is above, is what makes the planner prune for days that carry no other condition.
    """
    days = new.select(date_col).where(F.col(date_col) > F.lit("0001-01-01").cast("date")).distinct()
    return existing.join(F.broadcast(days), date_col, "left_semi")
