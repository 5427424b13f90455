import os
import subprocess
import sys
from datetime import date, datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from test_pages import VEHICLE, land, location
from test_storage import actions
from test_unified import frame
from trackmill.operators import storage
from trackmill.operators.flatten import flatten_motive
from trackmill.plans import unified
from trackmill.sources import pages
from trackmill.streaming import incremental

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def readings(spark, name, *hours):
    return frame(spark, *[{"provider": name, "provider_vehicle_id": f"v{h}", "timestamp": f"2024-01-{1 + h // 24:02d}T{h % 24:02d}:00:00Z"} for h in hours])


def test_one_action_per_window(spark, tmp_path):
    """Providers that work are counted by the write alone; what they leave out is counted beside it."""
    root = str(tmp_path / "data")
    sources = {n: lambda s, a, b, n=n: readings(s, n, 1, 2, 30) for n in ("motive", "samsara")}
    before = actions(spark)
    done = incremental.run_incremental(spark, sources, root, START, START + timedelta(days=2))
    assert actions(spark) == before + 2
    assert (done.batches, done.batches_with_data, done.records) == (2, 2, 6) and done.partitions == {date(2024, 1, 1), date(2024, 1, 2)}

    def complete(s, a, b):
        return readings(s, "motive", 1), s.range(3), s.createDataFrame([("7", "f", "r"), ("7", "g", "r"), ("8", "f", "r")], "unit string, file string, reason string")

    done = incremental.run_incremental(spark, {"motive": complete}, root, START, START + timedelta(days=1))
    assert (done.records, done.rejected, done.skipped) == (1, 3, 2)


def test_a_provider_that_fails_where_it_is_computed(spark, tmp_path):
    root = str(tmp_path / "data")
    bad = lambda s, a, b: readings(s, "samsara", 2).withColumn("vin", F.raise_error(F.lit("no")).cast("string"))
    done = incremental.run_incremental(spark, {"motive": lambda s, a, b: readings(s, "motive", 1, 2), "samsara": bad}, root, START, START + timedelta(days=1))
    assert done.records == 2 and [f[0] for f in done.failed] == [0] and done.failed[0][1].startswith("samsara")
    assert {r.provider for r in storage.load_partition(spark, root, date(2024, 1, 1)).collect()} == {"motive"}
    with pytest.raises(incremental.AllProvidersFailed) as failed:
        incremental.run_incremental(spark, {"samsara": bad}, root, START, START + timedelta(days=1))
    assert failed.value.batch == 0 and not failed.value.partial_data_saved


def test_a_store_that_fails_is_no_providers_fault(spark, tmp_path, monkeypatch):
    def full(*_, **__):
        raise OSError("disk full")

    monkeypatch.setattr(incremental, "merge_partitions", full)
    with pytest.raises(OSError, match="disk full"):
        incremental.run_incremental(spark, {"motive": lambda s, a, b: readings(s, "motive", 1)}, str(tmp_path / "data"), START, START + timedelta(days=1))


@pytest.mark.parametrize("after", ["merge", "quarantine", "ledger"])
def test_a_batch_takes_effect_once(spark, tmp_path, monkeypatch, after):
    """A stream that dies after part of a batch's work does that batch again when it starts again."""
    places = land(tmp_path / "places", {"vehicle_id": 1, "vehicle_locations": [location(i, f"2024-01-01T0{i}:00:00Z") for i in range(4)] + [location(9, "2024-01-01T09:00:00Z", type="unheard of")]})
    dim = pages.motive_vehicles(spark, land(tmp_path / "vehicles", {"vehicles": [{"vehicle": VEHICLE}], "pagination": {"per_page": 1, "page_no": 1, "total": 1}}))
    root, check, aside = (str(tmp_path / n) for n in ("data", "checkpoint", "aside"))
    run = lambda: incremental.stream_ingest(spark, "motive_vehicle_locations", places, root, check, lambda items: flatten_motive(items, dim, origin=True), quarantine=aside)
    died = []

    def dies(owner, name, before):
        real = getattr(owner, name)

        def step(*a, **k):
            out = None if before else real(*a, **k)
            if not died:
                died.append(name)
                raise RuntimeError("killed")
            return real(*a, **k) if before else out

        monkeypatch.setattr(owner, name, step)

    if after == "merge":
        dies(incremental, "merge_partitions", False)
    elif after == "quarantine":
        dies(incremental.Ledger, "add", True)
    else:
        dies(incremental.Ledger, "add", False)
    with pytest.raises(Exception, match="killed"):
        run()
    again = run()
    assert died and (again.replayed, again.records) == ((1, 0) if after == "ledger" else (0, 4))
    assert storage.load_partition(spark, root, date(2024, 1, 1)).count() == 4
    assert spark.read.parquet(aside).count() == 1
    assert [(r.batch, r.records, r.rejected, r.days) for r in incremental.Ledger(spark, f"{check}-ledger").entries().collect()] == [(0, 4, 1, [date(2024, 1, 1)])]
    land(tmp_path / "places", {"vehicle_id": 1, "vehicle_locations": [location(5, "2024-01-02T05:00:00Z")]})
    more = run()
    assert (more.batches, more.records, more.replayed) == (1, 1, 0) and incremental.Ledger(spark, f"{check}-ledger").entries().count() == 2


def test_windows_close_once(spark, tmp_path):
    landed, out = str(tmp_path / "landed"), str(tmp_path / "out")

    def turn(*hours):
        unified.enforce_schema(readings(spark, "motive", *hours)).write.mode("append").parquet(landed)
        stream = spark.readStream.schema(unified.TELEMETRY_SCHEMA).parquet(landed)
        return incremental.ingest_windows(stream, out, f"{out}-check", "1 hour", "2 hours")

    first = turn(1, 1, 3, 6)  # closed up to four o'clock
    assert (first.rows, first.closed, first.late) == (4, 2, 0)
    second = turn(2, 5, 9)  # two o'clock's window is closed already, though nothing stood in it
    assert (second.rows, second.late) == (3, 1)
    third = turn(40)
    assert third.late == 0
    rows = sorted((r.bucket.hour, r.records) for r in spark.read.parquet(out).collect())
    assert rows == [(1, 2), (3, 1), (5, 1), (6, 1), (9, 1)]
    assert Path(f"{out}-check").exists()


ON_EXECUTORS = """
import sys, tempfile
from datetime import datetime, timedelta, timezone
from pyspark.sql import SparkSession, functions as F
from trackmill.plans.unified import TELEMETRY_SCHEMA
from trackmill.streaming.incremental import run_incremental

spark = SparkSession.builder.master("local-cluster[2,2,1024]").config("spark.executor.memory", "700m").config("spark.driver.host", "127.0.0.1").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
start = datetime(2024, 1, 1, tzinfo=timezone.utc)

def fetch(s, a, b):
    i = F.col("id")
    at = F.when(i % 10 != 0, F.timestamp_seconds(i % 48 * 3600 + int(start.timestamp())))
    slow = F.expr("aggregate(sequence(1, 4000), 0D, (x, y) -> x + y * id)")  # so that tasks meet
    rest = [(slow if f.name == "speed_mph" else F.lit(None)).cast(f.dataType).alias(f.name) for f in TELEMETRY_SCHEMA.fields if f.name not in ("provider", "provider_vehicle_id", "timestamp")]
    return s.range(0, 4000, 1, 8).select(F.lit("motive").alias("provider"), i.cast("string").alias("provider_vehicle_id"), at.alias("timestamp"), *rest)

done = run_incremental(spark, {"motive": fetch}, "file://" + sys.argv[1], start, start + timedelta(days=2))
print("told", done.records, done.dropped_null_time, spark.read.parquet("file://" + sys.argv[1]).count())
"""


def test_counts_on_several_executors(tmp_path):
    """Executors may both compute what neither holds yet; it counts once."""
    env = os.environ | {"PYTHONPATH": str(Path(__file__).parents[1]), "SPARK_LOCAL_IP": "127.0.0.1", "SPARK_SCALA_VERSION": "2.13", "SPARK_LOCAL_DIRS": str(tmp_path), "PYSPARK_PYTHON": sys.executable}
    for name in ("PYSPARK_GATEWAY_PORT", "PYSPARK_GATEWAY_SECRET"):
        env.pop(name, None)
    run = subprocess.run([sys.executable, "-c", ON_EXECUTORS, str(tmp_path / "data")], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=300)
    hours = [i % 48 for i in range(4000) if i % 10]
    inside = len(hours) + hours.count(24)  # midnight is in both windows
    assert f"told {inside} {2 * 400} {len(hours)}" in run.stdout, run.stdout + run.stderr[-2000:]
