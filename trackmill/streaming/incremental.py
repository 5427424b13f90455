"""Incremental loading in time windows, and the same as a stream."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from trackmill.operators.flatten import union_providers
from trackmill.operators.storage import latest_partition_date, merge_partitions
from trackmill.plans.unified import DEDUP_KEYS, enforce_schema
from trackmill.sources.pages import ARRIVAL, read_pages, rejected, unwrap_items, validated

#: Gives a provider's rows of a window; or those and what it rejected; or these two and what it skipped (unit, …).
Fetch = Callable[[SparkSession, datetime, datetime], DataFrame | tuple[DataFrame, ...]]


def incremental_start(spark: SparkSession, root: str, default: str, lookback_days: int) -> datetime:
    """Midnight UTC of the latest day less the lookback (0 to 30 days); of the default date if there is no day."""
    if not 0 <= lookback_days <= 30:
        raise ValueError("lookback_days is 0 to 30")
    latest = latest_partition_date(spark, root)
    day = date.fromisoformat(default[:10]) if latest is None else latest - timedelta(days=lookback_days)
    return datetime(day.year, day.month, day.day, tzinfo=timezone.utc)


def batch_windows(start: datetime, end: datetime, days: float = 1.0) -> list[tuple[datetime, datetime]]:
    """Windows of so many days (0.25 to 7) that join up from start to end; none if start isn't before end."""
    if not 0.25 <= days <= 7:
        raise ValueError("days is 0.25 to 7")
    out = []
    while start < end:
        out.append((start, min(start + timedelta(days=days), end)))
        start = out[-1][1]
    return out


def batch_id(ts: Column, start: datetime, days: float) -> Column:
    """The number of the window that holds ts, so that one job can do many windows."""
    micros = F.unix_micros(ts.cast("timestamp")) - F.unix_micros(F.lit(start))
    return F.floor(micros / F.lit(int(days * 86_400_000_000))).cast("long")


def batch_ids(ts: Column, start: datetime, days: float) -> Column:
    """The numbers of the windows that hold ts, both ends counted: two on a border."""
    own, width = batch_id(ts, start, days), int(days * 86_400_000_000)
    border = (F.unix_micros(ts.cast("timestamp")) - F.unix_micros(F.lit(start))) % width == 0
    return F.when(border, F.array(own - 1, own)).otherwise(F.array(own))


@dataclass
class RunSummary:
    """What a run did."""

    batches: int = 0
    batches_with_data: int = 0
    records: int = 0
    dropped_null_time: int = 0
    rejected: int = 0
    skipped: int = 0
    replayed: int = 0
    partitions: set[date] = field(default_factory=set)
    failed: list[tuple[int, str]] = field(default_factory=list)

    def add(self, more: RunSummary) -> None:
        """Take in what another run, or a part of this one, did."""
        for f in ("batches", "batches_with_data", "records", "dropped_null_time", "rejected", "skipped", "replayed"):
            setattr(self, f, getattr(self, f) + getattr(more, f))
        self.partitions |= more.partitions
        self.failed += more.failed


class AllProvidersFailed(RuntimeError):
    """No provider gave a batch; earlier batches are saved."""

    def __init__(self, batch: int, summary: RunSummary) -> None:
        super().__init__(f"all providers failed in batch {batch}")
        self.batch, self.summary = batch, summary
        self.partial_data_saved = bool(summary.partitions)
        self.partitions = sorted(summary.partitions)


@dataclass
class _Given:
    """What a provider gave for a window: its typed rows, what it rejected and what it skipped."""

    frame: DataFrame
    bad: DataFrame | None
    lost: DataFrame | None

    def left_out(self) -> tuple[int, int]:
        """How many items were rejected and how many units skipped."""
        return self.bad.count() if self.bad is not None else 0, self.lost.select("unit").distinct().count() if self.lost is not None else 0


def _fetched(spark: SparkSession, sources: Mapping[str, Fetch], a: datetime, b: datetime, fail: Callable[[str, Exception], None]) -> dict[str, _Given]:
    given = {}
    for place, name in enumerate(sorted(sources)):
        try:
            found = sources[name](spark, a, b)
            found, bad, lost = (*found, None, None)[:3] if isinstance(found, tuple) else (found, None, None)
            frame = enforce_schema(found, [c for c in ARRIVAL if c in found.columns]).withColumn("_source", F.lit(place))
        except Exception as failure:  # whatever stops a provider, the others go on
            fail(name, failure)
            continue
        given[name] = _Given(frame, bad, lost)
    return given


def _merged_and_counted(new: DataFrame, root: str, ts: str, order: Sequence[str]) -> tuple[int, int, dict[date, int]]:
    """Merge new rows, and say how many of them have a time, how many have none, and the rows of the days they touch."""
    told, at = Observation(), F.col(ts)
    days = merge_partitions(new, root, ts=ts, order=order, told=told, counts=[F.count(at).alias("rows"), F.count_if(at.isNull()).alias("nulls")])
    return told.get.get("rows") or 0, told.get.get("nulls") or 0, days


def _merge_window(given: Mapping[str, _Given], root: str, a: datetime, b: datetime) -> RunSummary:
    """Unite and merge what the providers gave for one window, in one write that counts as it goes."""
    frames = [g.frame for g in given.values()]
    order = ["_source", *[c for c in ARRIVAL if any(c in f.columns for f in frames)]]
    at = F.col("timestamp")
    everything = union_providers(frames, order).where(at.between(F.lit(a), F.lit(b)) | at.isNull())
    left_out = [g.left_out() for g in given.values()]
    rows, nulls, touched = _merged_and_counted(everything, root, "timestamp", order)
    return RunSummary(0, int(rows > 0), rows, nulls, sum(x for x, _ in left_out), sum(y for _, y in left_out), partitions=set(touched))


def _working(given: Mapping[str, _Given], fail: Callable[[str, Exception], None]) -> dict[str, _Given]:
    """The providers whose rows can be computed, each tried by itself; their rows stay cached."""
    out = {}
    for name, g in given.items():
        held = _Given(g.frame.persist(), g.bad, g.lost)
        try:
            held.frame.count()
            held.left_out()
        except Exception as failure:  # it fails where it is computed
            held.frame.unpersist()
            fail(name, failure)
            continue
        out[name] = held
    return out


def run_incremental(spark: SparkSession, sources: Mapping[str, Fetch], root: str, start: datetime, end: datetime, days: float = 1.0) -> RunSummary:
    """Fetch, unite, type and merge each window in turn.

    A provider that fails is left out of that window; if all fail the run stops. A provider's frame fails where it is
    computed, which is in the one write of the window. Only then each is tried by itself, and those that work are
    written without the others; nothing of the failed write is stored. Rows are counted by that write; what providers
    rejected or skipped is counted where they say so. Of versions of a reading in one window the last to arrive stays:
    by provider in sorted order, then by the ARRIVAL columns that a frame has, so reruns agree. If an executor is lost,
    rows that are computed again may be counted again; what is stored is not affected.
    """
    summary = RunSummary()
    for k, (a, b) in enumerate(batch_windows(start, end, days)):
        summary.batches += 1

        def fail(name: str, failure: Exception, k: int = k) -> None:
            summary.failed.append((k, f"{name}: {type(failure).__name__}"))

        given = _fetched(spark, sources, a, b, fail)
        if not given:
            raise AllProvidersFailed(k, summary)
        try:
            summary.add(_merge_window(given, root, a, b))
        except Exception:  # a provider's, or the store's
            working = _working(given, fail)
            if not working:
                raise AllProvidersFailed(k, summary) from None
            try:
                if len(working) == len(given):
                    raise
                summary.add(_merge_window(working, root, a, b))
            finally:
                for g in working.values():
                    g.frame.unpersist()
    return summary


class Ledger:
    """The micro-batches of a stream that are done with, and what each did: a folder of small files, one per batch.

    An entry is written after all else, and whole or not at all.
    """

    SCHEMA = "batch long, records long, dropped_null_time long, rejected long, days array<date>"

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def has(self, batch: int) -> bool:
        mark = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/entry-{batch}/_SUCCESS")
        return mark.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(mark)

    def add(self, batch: int, records: int, nulls: int, rejected: int, days: Sequence[date]) -> None:
        entry = self.spark.createDataFrame([(batch, records, nulls, rejected, sorted(days))], self.SCHEMA)
        entry.coalesce(1).write.mode("overwrite").json(f"{self.path}/entry-{batch}")

    def entries(self) -> DataFrame:
        """One row per batch, of all runs of the stream."""
        return self.spark.read.schema(self.SCHEMA).json(f"{self.path}/entry-*")


def stream_ingest(
    spark: SparkSession, endpoint: str, path: str, root: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame], ts: str = "timestamp", quarantine: str | None = None, ledger: str | None = None, name: str | None = None
) -> RunSummary:
    """Merge new landed pages into the dataset, whatever has come since the last call, and say what was done.

    transform gives the unified columns from an endpoint's valid items, and those of ARRIVAL if it keeps them. Each
    micro-batch is merged like a batch, so a repeated or late reading replaces the stored one, and of a batch's versions
    the last to arrive stays. Bad items and unreadable pages are counted, and kept in the folder quarantine if it is
    given, under stream=…/batch=….

    A batch takes effect once, though Spark may hand it out again after a failure: what it merges and what it
    quarantines replaces what it wrote before, and the ledger (a folder, by the checkpoint if not given) has an entry
    for each batch that is done, which is passed over and counted as replayed. name tells the batches of streams that
    share a quarantine apart; it is the checkpoint's own if not given.
    """
    summary = RunSummary()
    done = Ledger(spark, ledger or f"{checkpoint.rstrip('/')}-ledger")
    name = name or checkpoint.rstrip("/").rsplit("/", 1)[-1]

    def upsert(batch: DataFrame, number: int) -> None:
        if done.has(number):
            summary.replayed += 1
            return
        pages = batch.persist()
        found = transform(validated(unwrap_items(pages, endpoint), endpoint)[0])
        order = [c for c in ARRIVAL if c in found.columns]
        rows, nulls, days = _merged_and_counted(enforce_schema(found, order), root, ts, order)
        bad, refused = Observation(), rejected(pages, endpoint)
        refused = refused.observe(bad, F.count(F.lit(1)).alias("rows"))
        if quarantine:
            refused.write.mode("overwrite").parquet(f"{quarantine.rstrip('/')}/stream={name}/batch={number}")
        else:
            refused.write.format("noop").mode("overwrite").save()
        counts = rows, nulls, bad.get.get("rows") or 0
        done.add(number, *counts, list(days))
        summary.add(RunSummary(1, int(counts[0] > 0), *counts, partitions=set(days)))
        pages.unpersist()

    query = read_pages(spark, endpoint, path, stream=True).writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return summary


def first_within(stream: DataFrame, lookback_days: int = 7) -> DataFrame:
    """A stream's first row per key within the lookback. To keep the last one instead, merge as stream_ingest does."""
    return stream.withWatermark("timestamp", f"{lookback_days} days").dropDuplicatesWithinWatermark(list(DEDUP_KEYS))


def tumbling_counts(stream: DataFrame, width: str = "1 hour", late: str = "7 days") -> DataFrame:
    """Rows and mean speed by provider and window; a window is given out when the watermark has passed it."""
    found = stream.withWatermark("timestamp", late).groupBy(F.window("timestamp", width), "provider").agg(F.count("*").alias("records"), F.avg("speed_mph").alias("mean_speed_mph"))
    return found.select(F.col("window.start").alias("bucket"), "provider", "records", "mean_speed_mph")


@dataclass
class WindowRun:
    """What a run over windows did: rows taken in, windows closed, and late windows, whose rows were dropped."""

    rows: int = 0
    closed: int = 0
    late: int = 0


def ingest_windows(stream: DataFrame, out: str, checkpoint: str, width: str = "1 hour", late: str = "7 days") -> WindowRun:
    """Append the windows of tumbling_counts that are closed to the Parquet files in out, and say what was done.

    Takes in whatever has come since the last call. A window is written once, when the watermark (the latest time less
    late) has passed its end, and its state is dropped then, so state is as large as the lookback, not as the stream.
    Rows of windows that are closed already are dropped; late counts such windows by provider and micro-batch.
    """
    spark, kept = stream.sparkSession, "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(kept)
    spark.conf.set(kept, "100000")  # every micro-batch's progress counts
    try:
        query = tumbling_counts(stream, width, late).writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        told = [json.loads(p.json) for p in query.recentProgress]
    finally:
        spark.conf.set(kept, before)
    state = [s for p in told for s in p["stateOperators"]]
    return WindowRun(sum(p["numInputRows"] for p in told), sum(s["numRowsRemoved"] for s in state), sum(s["numRowsDroppedByWatermark"] for s in state))
