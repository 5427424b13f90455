import random

import pytest
from pyspark.sql import functions as F

from trackmill.llm.common import connected_components


def by_hand(pairs):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    return {x: root(x) for x in parent}


@pytest.mark.parametrize("shape", ["chain", "random", "cliques"])
def test_components(spark, shape):
    rng = random.Random(2)
    pairs = {"chain": [(i, i + 1) for i in range(60)], "random": [(rng.randrange(90), rng.randrange(90)) for _ in range(70)], "cliques": [(10 * c + i, 10 * c + j) for c in range(5) for i in range(6) for j in range(i)]}[shape]
    pairs = [(a, b) for a, b in pairs if a != b]
    rng.shuffle(pairs)
    links = spark.createDataFrame([*pairs, (None, 3), (4, 4)], "a long, b long")
    assert {r.node: r.component for r in connected_components(links).collect()} == by_hand(pairs)


def test_stars_take_no_round(spark, monkeypatch):
    """Links to the least node of each component are told from others, and only the others take rounds."""
    from trackmill.llm import common

    written, names = common.written, []
    monkeypatch.setattr(common, "written", lambda df, name, codec=None: names.append(name) or written(df, name, codec))
    for pairs, rounds in (([(1, 5), (1, 6), (2, 7)], 0), ([], 0), ([(1, 5), (5, 6)], 1), ([(1, 6), (2, 6)], 1)):
        names.clear()
        found = connected_components(spark.createDataFrame(pairs, "a long, b long"))
        assert {r.node: r.component for r in found.collect()} == by_hand(pairs)
        assert names.count("links") == 1 + rounds


SMALL = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "16",
}


def test_a_hub_is_dealt_out(spark):
    """A star of 100,000 links, and a join like those of each round: no task has over half of its rows."""
    from trackmill.llm.common import written

    before = {k: spark.conf.get(k, None) for k in SMALL}
    try:
        for k, v in SMALL.items():
            spark.conf.set(k, v)
        n = 100_000
        star = spark.range(1, n + 1).select(F.lit(0).cast("long").alias("a"), F.col("id").alias("b")).repartition(8)
        found = connected_components(star)
        assert found.count() == n + 1 and found.where("component != 0").count() == 0
        edges = written(star.select(F.col("b").alias("v"), F.col("a").alias("u")), "star")
        least = written(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
        tasks = written(edges.join(least, "u").select("v", "m", F.spark_partition_id().alias("p")), "joined").groupBy("p").count()
        assert tasks.agg(F.max("count")).first()[0] <= n / 2
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
