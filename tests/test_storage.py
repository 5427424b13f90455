from datetime import date, datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from test_unified import five, frame
from trackmill.operators import storage
from trackmill.plans import unified


def days(spark, *ds, **more):
    return unified.enforce_schema(frame(spark, *[{"timestamp": f"2024-01-{d:02d}T12:00:00Z", "provider_vehicle_id": f"v{i}", **more} for i, d in enumerate(ds)]))


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "data")


def test_write_and_read_a_day(spark, root):
    storage.save_partition(five(spark), root, date(2024, 1, 15))
    assert storage.load_partition(spark, root, date(2024, 1, 15)).count() == 5
    assert storage.load_partition(spark, root, date(2024, 1, 16)).count() == 0
    storage.save_partition(five(spark).limit(2), root, date(2024, 1, 15))
    assert storage.load_partition(spark, root, date(2024, 1, 15)).count() == 2


def test_split_by_day(spark, root):
    assert storage.save_partitioned(days(spark, 15, 15, 16, 16, 17), root) == {date(2024, 1, 15): 2, date(2024, 1, 16): 2, date(2024, 1, 17): 1}
    with pytest.raises(ValueError, match="nowhere"):
        storage.save_partitioned(five(spark), root, "nowhere")
    twice = days(spark, 15).union(days(spark, 15))
    assert storage.save_partitioned(twice, root, dedup=True) == {date(2024, 1, 15): 1}
    assert storage.load_partition(spark, root, date(2024, 1, 16)).count() == 2


def test_null_times_are_left_out(spark, root):
    assert storage.save_partitioned(days(spark, 15).union(days(spark, 15).withColumn("timestamp", F.lit(None).cast("timestamp"))), root) == {date(2024, 1, 15): 1}


def test_range(spark, root):
    for d in range(13, 18):
        storage.save_partition(five(spark), root, date(2024, 1, d))
    assert storage.load_date_range(spark, root, date(2024, 1, 14), date(2024, 1, 16)).count() == 15
    assert storage.load_date_range(spark, root, date(2024, 1, 16), date(2024, 1, 14)).count() == 0
    assert storage.load_date_range(spark, root, date(2023, 1, 1), date(2024, 1, 13), sort=True).count() == 5
    plan = spark.read.parquet(root).where("date between '2024-01-14' and '2024-01-16'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_merge(spark, root):
    assert storage.merge_partitions(days(spark, 15, 16, speed_mph="45.0"), root) == {date(2024, 1, 15): 1, date(2024, 1, 16): 1}
    storage.merge_partitions(days(spark, 15, speed_mph="50.0"), root)
    got = storage.load_date_range(spark, root, date(2024, 1, 1), date(2024, 2, 1))
    assert sorted((str(r.date), r.speed_mph) for r in got.collect()) == [("2024-01-15", 50.0), ("2024-01-16", 45.0)]
    assert storage.merge_partitions(days(spark), root) == {}


def test_merge_orders_new_rows(spark, root):
    two = days(spark, 15, speed_mph="1.0").withColumn("_batch", F.lit(2)).union(days(spark, 15, speed_mph="2.0").withColumn("_batch", F.lit(1)))
    storage.merge_partitions(two, root, order=["_batch"])
    assert [r.speed_mph for r in storage.load_partition(spark, root, date(2024, 1, 15)).collect()] == [1.0]
    storage.merge_partitions(two, root, order=["_batch"])
    assert storage.load_partition(spark, root, date(2024, 1, 15)).count() == 1


def test_ties_agree_between_reruns(spark, root):
    speeds = [str(n) + ".0" for n in range(8)]
    rows = [days(spark, 15, speed_mph=x) for x in speeds]
    got = set()
    for turn in (rows, rows[::-1], rows[3:] + rows[:3]):
        both = turn[0]
        for r in turn[1:]:
            both = both.union(r)
        for n, save in enumerate((lambda df, to: storage.merge_partitions(df, to), lambda df, to: storage.save_partitioned(df, to, dedup=True))):
            to = f"{root}-{len(got)}-{n}-{rows.index(turn[0])}"
            save(both.repartition(4), to)
            got.add(storage.load_partition(spark, to, date(2024, 1, 15)).first().speed_mph)
    assert len(got) == 1


def test_merge_like_a_first_write_without_dedup(spark, root):
    twice = days(spark, 15).union(days(spark, 15))
    assert storage.merge_partitions(twice, root, dedup_first_write=False) == {date(2024, 1, 15): 2}
    assert storage.merge_partitions(days(spark, 15), root, dedup_first_write=False) == {date(2024, 1, 15): 1}
    assert storage.merge_partitions(days(spark, 15), root, keys=None) == {date(2024, 1, 15): 1}


def test_merge_keeps_to_the_declared_columns(spark, root):
    storage.merge_partitions(days(spark, 15).withColumn("extra", F.lit(1)), root)
    Path(root, "date=2024-01-16").mkdir()
    days(spark, 16).withColumn("odd", F.lit("x")).drop("odometer").coalesce(1).write.mode("overwrite").parquet(f"{root}/date=2024-01-16")
    storage.merge_partitions(days(spark, 15, 16, speed_mph="3.0"), root)
    for d in (15, 16):
        assert set(spark.read.parquet(f"{root}/date=2024-01-{d}").columns) == set(unified.TELEMETRY_COLUMNS)
    with pytest.raises(ValueError, match="odometer"):
        storage.merge_partitions(days(spark, 15).drop("odometer"), root)


def test_merge_prunes_days_while_it_runs(spark, root):
    storage.save_partitioned(days(spark, *range(1, 29)), root)
    fresh = days(spark, 15).withColumn("date", F.to_date("timestamp")).persist()
    df = storage._merged(fresh, root, unified.DEDUP_KEYS, (), True, unified.TELEMETRY_SCHEMA)
    assert df.count() == 2
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    scanned = [r.f for r in storage.affected_partitions(storage._stored(spark, root, storage.list_partition_dates(spark, root), unified.TELEMETRY_SCHEMA).withColumn("f", F.input_file_name()), fresh).select("f").distinct().collect()]
    assert len(scanned) == 1
    fresh.unpersist()


def actions(spark):
    return spark._jsparkSession.sharedState().statusStore().executionsCount()


def test_merge_is_one_action(spark, root):
    """No pass of its own finds the days or counts the rows."""
    storage.save_partitioned(days(spark, 15, 16), root)
    new, before = days(spark, 15, 16, 17, 17), actions(spark)
    assert storage.merge_partitions(new, root) == {date(2024, 1, 15): 1, date(2024, 1, 16): 1, date(2024, 1, 17): 2}
    assert actions(spark) == before + 1


def test_more_days_than_are_counted_on_the_way(spark, root, monkeypatch):
    monkeypatch.setattr(storage, "MOST_DAYS", 3)
    assert storage.save_partitioned(days(spark, 15, 15, 16, 17, 18), root) == {date(2024, 1, 15): 2, date(2024, 1, 16): 1, date(2024, 1, 17): 1, date(2024, 1, 18): 1}
    assert storage.save_partitioned(days(spark, 16), root) == {date(2024, 1, 16): 1}


def damage(root, d, at):
    """Spoil one file of a day: its end (the footer) or its middle (a data page)."""
    f = next(Path(root, f"date=2024-01-{d}").glob("*.parquet"))
    data = bytearray(f.read_bytes())
    if at == "end":
        data = data[: len(data) // 2]
    else:
        for i in range(30, 90):
            data[i] ^= 0xFF
    f.write_bytes(data)
    f.with_name(f".{f.name}.crc").unlink(missing_ok=True)
    return f.name


def test_damaged_days(spark, root):
    storage.save_partitioned(days(spark, 15, 16, 16, 17, 18), root)
    bad = {damage(root, 16, "end"), damage(root, 17, "middle")}
    rows, skipped = storage.load_readable(spark, root, date(2024, 1, 15), date(2024, 1, 18))
    assert sorted(str(r.date) for r in rows.collect()) == ["2024-01-15", "2024-01-18"]
    assert {Path(r.file).name for r in skipped.collect()} == bad and sorted(str(r.date) for r in skipped.collect()) == ["2024-01-16", "2024-01-17"]
    with pytest.raises(Exception):  # noqa: B017  by default a damaged day is an error
        storage.load_partition(spark, root, date(2024, 1, 16)).collect()
    assert storage.load_partition(spark, root, date(2024, 1, 16), skip_unreadable=True).count() == 0
    assert storage.load_date_range(spark, root, date(2024, 1, 15), date(2024, 1, 17), sort=True, skip_unreadable=True).count() == 1
    rows, skipped = storage.load_readable(spark, root, date(2024, 1, 18), date(2024, 1, 18))
    assert (rows.count(), skipped.count()) == (1, 0)
    rows, skipped = storage.load_readable(spark, root, date(2020, 1, 1), date(2020, 1, 2))
    assert (rows.count(), skipped.count()) == (0, 0)


def test_retention_on_a_registered_table(spark, root):
    storage.save_partitioned(days(spark, 15, 16, 17, 18), root)
    storage.register_external_table(spark, "kept", root)
    listed = lambda: sorted(r.partition for r in spark.sql("SHOW PARTITIONS kept").collect())
    assert storage.apply_retention(spark, root, 2, datetime(2024, 1, 18, tzinfo=timezone.utc), "kept") == 1
    assert listed() == ["date=2024-01-16", "date=2024-01-17", "date=2024-01-18"]
    assert storage.delete_partition(spark, root, date(2024, 1, 17), "kept")
    assert listed() == ["date=2024-01-16", "date=2024-01-18"] and spark.table("kept").count() == 2
    storage.merge_partitions(days(spark, 19), root)
    storage.delete_partition(spark, root, date(2024, 1, 16))
    storage.sync_external_table(spark, "kept")
    assert listed() == ["date=2024-01-18", "date=2024-01-19"] and spark.table("kept").count() == 2
    spark.sql("DROP TABLE kept")


def test_metadata(spark, root):
    assert storage.list_partition_dates(spark, root) == [] and storage.latest_partition_date(spark, root) is None
    storage.save_partitioned(days(spark, 15, 17), root)
    for name in ("date=not-a-day", "date=2024-13-01", "other"):
        Path(root, name).mkdir()
    assert storage.list_partition_dates(spark, root) == [date(2024, 1, 15), date(2024, 1, 17)]
    assert storage.partition_count(spark, root) == 2 and storage.partition_exists(spark, root, date(2024, 1, 17)) and not storage.partition_exists(spark, root, date(2024, 1, 16))
    assert (storage.earliest_partition_date(spark, root), storage.latest_partition_date(spark, root)) == (date(2024, 1, 15), date(2024, 1, 17))
    stats = storage.storage_statistics(spark, root)
    assert stats["partitions"] == 2 and stats["latest"] == date(2024, 1, 17)
    sizes = storage.partition_sizes(spark, root, "bytes")
    assert sizes[date(2024, 1, 15)] > 100 and storage.partition_sizes(spark, root, "kb")[date(2024, 1, 15)] == sizes[date(2024, 1, 15)] / 1024


def test_delete_and_retention(spark, root):
    now = datetime(2024, 3, 1, 12, tzinfo=timezone.utc)
    for age in (30, 25, 20, 5, 3, 1):
        storage.save_partition(five(spark).limit(1), root, (now - timedelta(days=age)).date())
    assert storage.apply_retention(spark, root, 10, now.replace(tzinfo=None)) == 3 and storage.partition_count(spark, root) == 3
    assert storage.delete_partition(spark, root, (now - timedelta(days=5)).date()) and not storage.delete_partition(spark, root, date(2000, 1, 1))
    assert storage.delete_partitions_before(spark, root, (now - timedelta(days=1)).date()) == 1


def test_export(spark, root):
    df = five(spark)
    for fmt in ("parquet", "csv", "json"):
        storage.export(df, fmt, f"{root}/{fmt}")
    assert spark.read.parquet(f"{root}/parquet").count() == spark.read.csv(f"{root}/csv", header=True).count() == spark.read.json(f"{root}/json").count() == 5
    assert spark.read.json(f"{root}/json").first().timestamp.startswith("2025-12-05T10:")
    storage.export_by_provider(df, f"{root}/by")
    assert {p.name for p in Path(root, "by").glob("provider=*")} == {"provider=motive", "provider=samsara"}
    for bad in ("brotli", "lzo"):
        with pytest.raises(ValueError, match=bad):
            storage.export(df, "parquet", f"{root}/x", bad)
    with pytest.raises(ValueError):
        storage.export(df, "xlsx", f"{root}/x")
    for c in ("gzip", "zstd", "lz4", "none"):
        storage.save_partition(df, f"{root}/{c}", date(2024, 1, 1), c)


def test_external_table(spark, root, tmp_path):
    storage.save_partitioned(days(spark, 15, 16), root)
    storage.register_external_table(spark, "readings", root)
    assert spark.sql("SELECT count(*) FROM readings WHERE date = DATE '2024-01-15'").first()[0] == 1
    spark.sql("DROP TABLE readings")
