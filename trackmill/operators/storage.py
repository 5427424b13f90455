"""The dataset on disk: one folder per day (date=YYYY-MM-DD), Parquet files inside."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackmill.functions.telemetry import SIZE_UNITS
from trackmill.operators.keep import keep_last
from trackmill.operators.temporal import affected_partitions
from trackmill.plans.unified import DEDUP_KEYS, SORT_KEYS, TELEMETRY_COLUMNS, TELEMETRY_SCHEMA, require_columns

COMPRESSIONS = ("snappy", "gzip", "zstd", "lz4", "lz4_raw", "none", "uncompressed")
MOST_ROWS_PER_FILE = 5_000_000
#: Days that one write's rows are counted by as they are written; of more, the written days are counted.
MOST_DAYS = 10_000
_DAY = re.compile(r"^date=(\d{4}-\d{2}-\d{2})$")


def _codec(name: str) -> str:
    if name not in COMPRESSIONS:
        raise ValueError(f"compression {name!r} is not available; use one of {', '.join(COMPRESSIONS)}")
    return name


def _children(spark: SparkSession, root: str) -> list:
    """The folder's entries by Hadoop's listing, which works on any store; none if it doesn't exist."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return list(fs.listStatus(path)) if fs.exists(path) else []


def _day_path(root: str, d: date | str) -> str:
    return f"{root.rstrip('/')}/date={d}"


def _as_date(text: str) -> date | None:
    try:
        return date.fromisoformat(text)
    except ValueError:
        return None


def list_partition_dates(spark: SparkSession, root: str) -> list[date]:
    """The days there are, in order; folders of other names don't count. No data is read."""
    names = (_DAY.match(s.getPath().getName()) for s in _children(spark, root) if s.isDirectory())
    return sorted(d for m in names if m and (d := _as_date(m[1])))


def partition_exists(spark: SparkSession, root: str, d: date) -> bool:
    return d in list_partition_dates(spark, root)


def partition_count(spark: SparkSession, root: str) -> int:
    return len(list_partition_dates(spark, root))


def latest_partition_date(spark: SparkSession, root: str) -> date | None:
    return max(list_partition_dates(spark, root), default=None)


def earliest_partition_date(spark: SparkSession, root: str) -> date | None:
    return min(list_partition_dates(spark, root), default=None)


def _stored(spark: SparkSession, root: str, days: Sequence[date], schema: T.StructType | None, **options: bool) -> DataFrame:
    """The rows of days that are there, with their date, in the declared schema."""
    if not days:
        return spark.createDataFrame([], T.StructType([*(schema or TELEMETRY_SCHEMA).fields, T.StructField("date", T.DateType())]))
    reader = spark.read.option("basePath", root).options(**options)
    if schema:
        reader = reader.schema(T.StructType([*schema.fields, T.StructField("date", T.DateType())]))
    return reader.parquet(*[_day_path(root, d) for d in days])


def _dataset(spark: SparkSession, root: str, days: Sequence[date], schema: T.StructType | None) -> DataFrame:
    """The given days' rows with their date; those that aren't there are skipped."""
    return _stored(spark, root, sorted(set(days) & set(list_partition_dates(spark, root))), schema)


def load_partition(spark: SparkSession, root: str, d: date, schema: T.StructType | None = None, skip_unreadable: bool = False) -> DataFrame:
    """One day; a day that isn't there gives no rows. skip_unreadable leaves out damaged files, which load_readable names."""
    if skip_unreadable:
        return load_readable(spark, root, d, d, schema or TELEMETRY_SCHEMA)[0]
    return _dataset(spark, root, [d], schema)


def load_date_range(spark: SparkSession, root: str, d0: date, d1: date, sort: bool = False, schema: T.StructType | None = None, skip_unreadable: bool = False) -> DataFrame:
    """The days from d0 to d1, both included; days that aren't there are skipped, d0 after d1 gives no rows.

    skip_unreadable leaves out damaged files, which load_readable names.
    """
    if skip_unreadable:
        rows = load_readable(spark, root, d0, d1, schema or TELEMETRY_SCHEMA)[0]
    else:
        rows = _dataset(spark, root, [d for d in list_partition_dates(spark, root) if d0 <= d <= d1], schema)
    return rows.orderBy(*[F.col(c).asc_nulls_last() for c in SORT_KEYS]) if sort else rows


def load_readable(spark: SparkSession, root: str, d0: date, d1: date, schema: T.StructType = TELEMETRY_SCHEMA) -> tuple[DataFrame, DataFrame]:
    """(rows, skipped): the days from d0 to d1 without the files that are damaged, and those as (date, file, bytes).

    A file counts as damaged if reading all its columns gives other rows than its footer says, or if it has no readable
    footer; none of its rows are given then. So a day whose files are all damaged has no data, and is named. The days
    are read twice for that, once to find out.
    """
    days = [d for d in list_partition_dates(spark, root) if d0 <= d <= d1]
    if not days:
        return _stored(spark, root, days, schema), spark.createDataFrame([], "date date, file string, bytes bigint")
    rows = _stored(spark, root, days, schema, ignoreCorruptFiles=True, ignoreMissingFiles=True).withColumn("_file", F.col("_metadata.file_path"))
    # the hashes make the reader decode every column; the other count comes from footers alone
    whole = rows.groupBy("_file").agg(F.count("*").alias("got"), F.max(F.xxhash64(*schema.fieldNames())).alias("decoded"))
    footers = rows.groupBy("_file").agg(F.count("*").alias("said"))
    intact = footers.join(whole, "_file").where("got = said AND decoded IS NOT NULL").select("_file")
    files = data_files(spark, root).where(F.col("date").between(F.lit(d0), F.lit(d1)))
    skipped = files.join(intact, files["file"] == intact["_file"], "left_anti")
    return rows.join(intact, "_file", "left_semi").drop("_file"), skipped


def _write_days(df: DataFrame, root: str, compression: str) -> dict[date, int]:
    """Replace the days of df, and say how many rows each has now, as counted while they were written.

    Rows are rebalanced by day: a large day is split over tasks, small days share one.
    """
    sort = [c for c in SORT_KEYS if c in df.columns]
    told = Observation()
    # with more bins than days a histogram is a count by day
    by_day = F.expr(f"histogram_numeric(`date`, {MOST_DAYS})").alias("days")
    dealt = df.hint("rebalance", "date").sortWithinPartitions("date", *sort).observe(told, F.count("date").alias("rows"), by_day)
    writer = dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", MOST_ROWS_PER_FILE)
    writer.option("compression", _codec(compression)).partitionBy("date").parquet(root)
    found = told.get
    counts = {r["x"]: int(r["y"]) for r in found.get("days") or []}
    if len(counts) < MOST_DAYS:
        return counts
    written = _dataset(df.sparkSession, root, list_partition_dates(df.sparkSession, root), None).join(F.broadcast(df.select("date").distinct()), "date", "left_semi")
    return {r["date"]: r["count"] for r in written.groupBy("date").count().collect()}


def save_partition(df: DataFrame, root: str, d: date, compression: str = "snappy") -> None:
    """Replace one day by df."""
    _write_days(df.withColumn("date", F.lit(d).cast("date")), root, compression)


def save_partitioned(df: DataFrame, root: str, date_col: str = "timestamp", dedup: bool = False, compression: str = "snappy", order: Sequence[str] = ()) -> dict[date, int]:
    """Replace each day that df touches by its rows, and say how many they are. Rows without a date are left out.

    dedup keeps of each key's rows those last by the columns of order, which aren't stored.
    """
    days = require_columns(df, [date_col]).withColumn("date", F.to_date(date_col)).where("date IS NOT NULL")
    if dedup:
        days = keep_last(days.withColumn("_seq", F.struct(F.lit(0), *order)).drop(*order), [*DEDUP_KEYS, "date"], ("_seq",))
    return _write_days(days, root, compression)


def merge_partitions(
    new: DataFrame, root: str, keys: Sequence[str] | None = DEDUP_KEYS, ts: str = "timestamp", order: Sequence[str] = (), compression: str = "snappy", dedup_first_write: bool = True, schema: T.StructType = TELEMETRY_SCHEMA,
    told: Observation | None = None, counts: Sequence[Column] = (),
) -> dict[date, int]:
    """Unite new with what its days hold, keep the last row per key, replace those days; rows by day.

    New rows come after stored ones, and among new rows those last by the columns of order (null first), which aren't
    stored. Without keys whole rows are compared. dedup_first_write=False leaves copies in a day's first write. The
    table has the columns of schema: others of new are left out, missing ones are an error, and stored days are read by
    it, whatever their files have. One job does all but the listing: the days that new touches prune the stored ones
    while it runs, and the rows are counted as they are written. The new rows are held, so the days that are read are
    the days written. told is told counts over all new rows, those without a day too, of which nothing is stored; they
    are counted where the held rows go into the merge, as executors may compute a row that isn't held yet several times.
    """
    if told and not dedup_first_write:
        raise ValueError("new rows are counted only where copies go from first writes too")
    own = [f for f in schema.fields if f.name != "date"]
    extra = [c for c in order if c not in schema.fieldNames()]
    fresh = require_columns(new, [ts, *[f.name for f in own]]).withColumn("date", F.to_date(ts))
    fresh = fresh if told else fresh.where("date IS NOT NULL")
    fresh = fresh.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in own], *extra, "date").persist()
    try:
        return _write_days(_merged(fresh, root, keys, order, dedup_first_write, T.StructType(own), told, counts), root, compression)
    finally:
        fresh.unpersist()


def _merged(fresh: DataFrame, root: str, keys: Sequence[str] | None, order: Sequence[str], dedup_first_write: bool, schema: T.StructType, told: Observation | None = None, counts: Sequence[Column] = ()) -> DataFrame:
    """The days of fresh as they will be."""
    spark = fresh.sparkSession
    stored = list_partition_dates(spark, root)
    columns = [*schema.fieldNames(), "date"]
    counted = fresh.observe(told, *counts).where("date IS NOT NULL") if told else fresh
    tagged = counted.select(*columns, F.lit(1).alias("_seq"), F.struct(F.lit(0), *order).alias("_order"))
    old = affected_partitions(_stored(spark, root, stored, schema), fresh).select(*columns, F.lit(0).alias("_seq"), F.lit(None).cast(tagged.schema["_order"].dataType).alias("_order"))
    both = old.unionByName(tagged)
    kept = keep_last(both, [*keys, "date"] if keys else None, ("_seq", "_order"))
    if not dedup_first_write:
        again = F.col("date").isin(*stored) if stored else F.lit(False)
        kept = kept.where(again).unionByName(both.where(~again).drop("_seq", "_order"))
    return kept


def _drop_from(spark: SparkSession, table: str | None, days: Sequence[date]) -> None:
    """Take days out of a registered table, whose files stay as they are."""
    if table and days:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(f"PARTITION (`date` = DATE '{d}')" for d in days)}")


def delete_partition(spark: SparkSession, root: str, d: date, table: str | None = None) -> bool:
    """Whether there was such a day to delete. A table that is registered over root forgets it."""
    _drop_from(spark, table, [d])
    path = spark._jvm.org.apache.hadoop.fs.Path(_day_path(root, d))
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.exists(path) and fs.delete(path, True))


def delete_partitions_before(spark: SparkSession, root: str, cutoff: date, table: str | None = None) -> int:
    """Delete the days before cutoff; how many there were. A table that is registered over root forgets them first."""
    days = [d for d in list_partition_dates(spark, root) if d < cutoff]
    _drop_from(spark, table, days)
    return sum(delete_partition(spark, root, d) for d in days)


def apply_retention(spark: SparkSession, root: str, days: int, now: datetime | None = None, table: str | None = None) -> int:
    """Delete the days older than so many days before now, in UTC; a now without a zone is in UTC too."""
    now = now or datetime.now(timezone.utc)
    today = (now if now.tzinfo else now.replace(tzinfo=timezone.utc)).astimezone(timezone.utc).date()
    return delete_partitions_before(spark, root, today - timedelta(days=days), table)


def export(df: DataFrame, fmt: str, path: str, compression: str | None = None) -> None:
    """Parquet, CSV with a header, or JSON lines; times in ISO form."""
    writer = df.write.mode("overwrite")
    if fmt == "parquet":
        writer.option("compression", _codec(compression or "snappy")).parquet(path)
    elif fmt in ("csv", "json"):
        writer = writer.option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
        writer.option("header", True).csv(path) if fmt == "csv" else writer.json(path)
    else:
        raise ValueError(f"unknown format {fmt}")


def export_by_provider(df: DataFrame, path: str) -> None:
    """A Parquet subset per provider."""
    df.write.mode("overwrite").partitionBy("provider").parquet(path)


def register_external_table(spark: SparkSession, name: str, root: str) -> None:
    """A table over the day folders, whose queries by date read only those days."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in TELEMETRY_SCHEMA.fields)}, `date` date) USING parquet PARTITIONED BY (`date`) LOCATION '{root}'")
    spark.sql(f"MSCK REPAIR TABLE {name}")


def sync_external_table(spark: SparkSession, name: str) -> None:
    """Make the table's days those that lie in its folder: new ones come in, deleted ones go."""
    spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")


def data_files(spark: SparkSession, root: str) -> DataFrame:
    """(date, file, bytes) of the Parquet files in day folders; folders of other names don't count.

    One distributed scan of the listing, a row per file, whatever the number of days; no file is opened.
    """
    if not _children(spark, root):
        return spark.createDataFrame([], "date date, file string, bytes bigint")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(root)
    files = files.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
    day = F.regexp_extract("file", r"/date=(\d{4}-\d{2}-\d{2})/[^/]+$", 1)
    return files.select(day.try_cast("date").alias("date"), "file", "bytes").where("date IS NOT NULL")


def partition_sizes(spark: SparkSession, root: str, unit: str = "mb") -> dict[date, float]:
    """Size of each day's files; units by 1024."""
    sizes = data_files(spark, root).groupBy("date").agg(F.sum("bytes").alias("bytes"))
    return {r["date"]: r["bytes"] / SIZE_UNITS[unit] for r in sizes.collect()}


def storage_statistics(spark: SparkSession, root: str) -> dict:
    """Days, first, last and total MB, of files in day folders; from the listing alone."""
    found = data_files(spark, root).agg(F.count_distinct("date").alias("partitions"), F.min("date").alias("earliest"), F.max("date").alias("latest"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    return {"partitions": found.partitions, "earliest": found.earliest, "latest": found.latest, "total_mb": round(found.bytes / SIZE_UNITS["mb"], 2)}
