import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from trackmill.operators.temporal import affected_partitions, asof_backward, asof_nearest, assignments_for, driver_at, enrich_gps, interval_join_first

T0 = datetime(2024, 1, 1)
US = timedelta(microseconds=1)


def at(seconds, us=0):
    return T0 + timedelta(seconds=seconds, microseconds=us)


def left(spark, rows):
    return spark.createDataFrame(rows, "k string, id long, ts timestamp_ntz")


def right(spark, rows):
    return spark.createDataFrame(rows, "k string, ts timestamp_ntz, v string, ordinal long")


def answers(df, col="v"):
    return {r.id: r[col] for r in df.collect()}


def test_backward_cases(spark):
    l = left(spark, [("a", 1, at(0)), ("a", 2, at(10)), ("a", 3, at(11)), ("a", 4, at(200_000)), ("b", 5, at(50)), ("c", 6, at(50)), ("a", 7, None), ("d", 8, at(5))])
    r = right(spark, [("a", at(20), "later", 0), ("a", at(10), "first", 1), ("a", at(10), "second", 2), ("b", at(60), "b", 0), ("a", None, "no time", 3), ("d", at(1), "x", 0), ("d", at(2), None, 1)])
    assert answers(asof_backward(l, r, ["k"], "ts", "v")) == {1: None, 2: "second", 3: "second", 4: "later", 5: None, 6: None, 7: None, 8: None}


def test_backward_is_confined_to_batches(spark):
    l = spark.createDataFrame([(1, "a", 1, at(10)), (2, "a", 2, at(20))], "batch long, k string, id long, ts timestamp_ntz")
    r = spark.createDataFrame([(1, "a", at(5), "v1", 0)], "batch long, k string, ts timestamp_ntz, v string, ordinal long")
    assert answers(asof_backward(l, r, ["batch", "k"], "ts", "v")) == {1: "v1", 2: None}
    assert answers(asof_backward(l, r.drop("batch"), ["k"], "ts", "v")) == {1: "v1", 2: "v1"}


def test_nearest_cases(spark):
    l = left(spark, [("a", 1, at(100)), ("a", 2, at(120)), ("a", 3, at(110)), ("a", 4, at(2000)), ("a", 5, at(2000, 1)), ("b", 6, at(0)), ("a", 7, None), ("c", 8, at(86_399)), ("a", 9, at(-1700))])
    r = right(spark, [("a", at(120), "after", 5), ("a", at(100), "before", 7), ("a", at(200), "far", 1), ("c", at(86_401), "next day", 0)])
    assert answers(asof_nearest(l, r, ["k"], "ts", "v")) == {1: "before", 2: "after", 3: "after", 4: "far", 5: None, 6: None, 7: None, 8: "next day", 9: "before"}


def test_nearest_ties_go_to_the_first_in_the_list(spark):
    l = left(spark, [("a", 1, at(10))])
    for rows in ([("a", at(5), "p", 1), ("a", at(15), "q", 0)], [("a", at(5), "q", 0), ("a", at(15), "p", 1)], [("a", at(15), "p", 2), ("a", at(15), "q", 1)], [("a", at(10), "p", 2), ("a", at(10), "q", 1)]):
        assert answers(asof_nearest(l, right(spark, rows), ["k"], "ts", "v")) == {1: "q"}


def spans(spark, rows):
    return spark.createDataFrame(rows, "k string, start_time timestamp_ntz, end_time timestamp_ntz, is_passenger boolean, driver_name string, ordinal long")


def test_interval_cases(spark):
    l = left(spark, [("a", 1, at(100)), ("a", 2, at(200)), ("a", 3, at(200, 1)), ("a", 4, at(100, -1)), ("a", 5, at(150)), ("b", 6, at(150)), ("a", 7, None), ("a", 7, None), ("a", 8, at(10**6))])
    i = spans(spark, [("a", at(140), at(160), False, "late", 2), ("a", at(100), at(200), False, "first", 1), ("a", at(0), at(300), True, "rider", 0), ("a", at(900_000), at(10**9), False, "long", 3)])
    got = interval_join_first(l, i, ["k"], "ts", ["driver_name"])
    assert answers(got, "driver_name") == {1: "first", 2: "first", 3: None, 4: None, 5: "first", 6: None, 7: None, 8: "long"}
    assert got.count() == 9
    assert answers(driver_at(i, l, ["k"]), "driver_name")[5] == "first"


@pytest.mark.parametrize("seed", range(2))
def test_against_loops(spark, seed):
    rng = random.Random(seed)
    when = lambda: at(rng.randrange(0, 4 * 86_400), rng.choice([0, 0, 1]))
    gps = [(rng.choice("abc"), i, when()) for i in range(150)]
    right_rows = [(rng.choice("abcd"), when(), f"v{i}", i) for i in range(60)]
    tied = [(k, t, f"t{i}", 100 + i) for i, (k, t, _, _) in enumerate(right_rows[:20])] + [(k, t, f"l{i}", 200 + i) for i, (k, _, t) in enumerate(gps[:20])]
    right_rows += tied
    intervals = [(rng.choice("abc"), s, s + timedelta(seconds=rng.randrange(0, 200_000)), rng.random() < 0.2, f"d{i}", i) for i, s in enumerate(when() for _ in range(25))]
    l, r, i = left(spark, gps), right(spark, right_rows), spans(spark, intervals)

    def back(k, t):
        c = [(x[1], x[3], x[2]) for x in right_rows if x[0] == k and x[1] <= t]
        return max(c)[2] if c else None

    def near(k, t, tol):
        c = [(abs(x[1] - t), x[3], x[2]) for x in right_rows if x[0] == k and abs(x[1] - t) <= tol]
        return min(c)[2] if c else None

    def first(k, t):
        c = [(x[5], x[4]) for x in intervals if x[0] == k and x[1] <= t <= x[2] and not x[3]]
        return min(c)[1] if c else None

    assert answers(asof_backward(l, r, ["k"], "ts", "v")) == {n: back(k, t) for k, n, t in gps}
    for tol in (1800, 100_000):
        assert answers(asof_nearest(l, r, ["k"], "ts", "v", tolerance_s=tol)) == {n: near(k, t, timedelta(seconds=tol)) for k, n, t in gps}
    assert answers(interval_join_first(l, i, ["k"], "ts", ["driver_name"]), "driver_name") == {n: first(k, t) for k, n, t in gps}


def test_empty_sides(spark):
    l, r, i = left(spark, [("a", 1, at(0))]), right(spark, []), spans(spark, [])
    assert answers(asof_backward(l, r, ["k"], "ts", "v")) == answers(asof_nearest(l, r, ["k"], "ts", "v")) == {1: None}
    assert answers(interval_join_first(l, i, ["k"], "ts", ["driver_name"]), "driver_name") == {1: None}
    none = left(spark, [])
    full = right(spark, [("a", at(0), "v", 0)])
    assert asof_backward(none, full, ["k"], "ts", "v").count() == asof_nearest(none, full, ["k"], "ts", "v").count() == interval_join_first(none, i, ["k"], "ts", ["driver_name"]).count() == 0


def test_enrich_and_semi_joins(spark):
    gps = left(spark, [("a", 1, at(10))])
    states = right(spark, [("a", at(5), "On", 0)]).withColumnRenamed("v", "engine_state")
    meters = right(spark, [("a", at(12), "7", 0)]).select("k", "ts", F.col("v").cast("double").alias("odometer"), "ordinal")
    i = spans(spark, [("a", at(0), at(20), False, "Ann", 0)]).withColumn("driver_id", F.lit("1"))
    assert tuple(enrich_gps(gps, states, meters, i, ["k"]).first())[3:] == ("On", 7.0, "1", "Ann")
    assert assignments_for(i, gps, "k").count() == 1 and assignments_for(i, left(spark, [("z", 1, at(0))]), "k").count() == 0
    days = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2)], "date string, x int")
    assert affected_partitions(days, days.where("x = 2")).count() == 1


def test_null_keys_match_nothing(spark):
    left = spark.createDataFrame([(None, 5, 1), ("a", 5, 2), (None, None, 3)], "k string, s long, n int").withColumn("ts", F.timestamp_seconds("s"))
    right = spark.createDataFrame([(None, 4, 7.0), ("a", 4, 8.0)], "k string, s long, v double").select("k", F.timestamp_seconds("s").alias("ts"), "v", F.lit(0).alias("ordinal"))
    want = [(1, None), (2, 8.0), (3, None)]
    for out in (asof_backward(left, right, ["k"], "ts", "v"), asof_nearest(left, right, ["k"], "ts", "v")):
        assert sorted((r.n, r.v) for r in out.collect()) == want
    spans = right.select("k", F.col("ts").alias("start_time"), F.timestamp_seconds(F.lit(9)).alias("end_time"), F.lit(False).alias("is_passenger"), F.lit("d").alias("driver_id"), F.lit("D").alias("driver_name"), "ordinal")
    out = enrich_gps(left, right.withColumnRenamed("v", "engine_state"), right.withColumnRenamed("v", "odometer"), spans, ["k"])
    assert sorted((r.n, r.engine_state, r.odometer, r.driver_id) for r in out.collect()) == [(1, None, None, None), (2, 8.0, 8.0, "d"), (3, None, None, None)]


def test_quartiles_by_narrowing(spark):
    import random
    import statistics

    from trackmill.operators.analytics import describe_numeric

    rng = random.Random(4)
    for values in ([rng.random() for _ in range(4001)], [float(rng.randint(0, 3)) for _ in range(3000)], [1.0] * 2000, [rng.gauss(0, 1) for _ in range(1499)] + [None] * 7):
        row = describe_numeric(spark.createDataFrame([(v,) for v in values], "v double").repartition(3), "v", most=50).first()
        whole = statistics.quantiles([v for v in values if v is not None], n=4, method="inclusive")
        assert (row.p25, row.p50, row.p75) == pytest.approx(tuple(whole))
    assert describe_numeric(spark.createDataFrame([], "v double"), "v").first().p50 is None
