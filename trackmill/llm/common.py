"""Helpers shared by the corpus operators: shared-folder tables, hashing splits, components."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space as the query contracts define it, for Java regular expressions.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
#: Spark's setting to drop shuffle files at the end of an execution.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. A local master may leave it unset and gets a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("trackmill.shared.dir", None)
    if not folder:
        if not re.match(r"local(\[.*)?$", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="trackmill-")
        spark.conf.set("trackmill.shared.dir", folder)
    return folder.rstrip("/")


def written(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write df to the shared folder and read it back, which cuts its lineage and survives lost executors.

    The write's shuffle files go when it ends, so the disk holds one step's shuffles at a time. codec is the session's
    if not given.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    with cleaned_up(spark):
        df.write.options(**({"compression": codec} if codec else {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def cleaned_up(spark: SparkSession) -> Iterator[None]:
    """Inside, an action's shuffle files go when it ends."""
    before = spark.conf.get(CLEAN_UP)
    spark.conf.set(CLEAN_UP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEAN_UP, before)


@contextmanager
def joins_by_hash(spark: SparkSession) -> Iterator[None]:
    """Inside, Spark may join by hash instead of by sorting where each partition of a side is small.

    Small is the size that it cuts partitions to at any rate, as measured when the join is about to run; others are
    sorted.
    """
    name = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes"))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Inside, Python gets no more than so many rows at once; a batch is held by both the executor and its worker."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def few(table: DataFrame, most: int) -> DataFrame:
    """A written table, to be broadcast if a count finds at most so many rows; others are left to a shuffle."""
    return F.broadcast(table) if table.count() <= most else table


def discard(*tables: DataFrame) -> None:
    """Delete tables that written() made and that nothing reads any more."""
    for df in tables:
        files = df.inputFiles()
        if files:
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def one_row_each(docs: DataFrame, rows: DataFrame, id_col: str, text_col: str, key: Callable[[Column], Column]) -> DataFrame:
    """docs with one row of each group; columns stay as they are.

    rows(id, key, group) has a row per row of docs, key(text) being what tells texts apart. Of a group the row with the
    smallest id stays, null ids last; of several texts with that id the one with the smallest key; of rows that repeat
    id and key the one with the smallest text. Rows are found by id and key together, so a row never goes because
    another one shares its id.
    """
    place = F.struct(F.col("id").isNull().alias("none"), "id", "key")
    pairs = rows.groupBy("group", "id", "key").agg(F.count("*").alias("n"))
    # written, so that the join deals both sides anew and can split a group of very many copies
    least = written(pairs.groupBy("group").agg(F.min(place).alias("least")), "row-least")
    pairs = pairs.join(least, "group").select("id", "key", "n", (place == F.col("least")).alias("stays"))
    pairs = written(pairs.where("NOT stays OR n > 1").select("id", "key", "stays"), "row-marks")
    discard(least)
    own_id, own_key, row = scratch(docs, "_id"), scratch(docs, "_key"), scratch(docs, "_row")

    def matched(frame: DataFrame, stays: bool, how: str) -> DataFrame:
        own = pairs.where(F.col("stays") == stays).select(F.col("id").alias(own_id), F.col("key").alias(own_key))
        return frame.join(own, F.col(id_col).eqNullSafe(F.col(own_id)) & (key(F.col(text_col)) == F.col(own_key)), how)

    kept = matched(docs, False, "left_anti")
    if not pairs.where("stays").isEmpty():
        often = matched(docs, True, "left_semi").groupBy(F.col(id_col).alias(own_id), key(F.col(text_col)).alias(own_key))
        often = often.agg(F.min_by(F.struct(*docs.columns), F.coalesce(F.col(text_col), F.lit(""))).alias(row)).select(f"{row}.*")
        kept = matched(kept, True, "left_anti").unionByName(often)
    return kept.select(*docs.columns)


def scratch(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have."""
    have = {c.lower() for c in df.columns}
    while name in have:
        name = f"_{name}"
    return name


def crc_mod(col: Column, modulus: int) -> Column:
    """crc32 of the value's text, modulo; null where the value is null."""
    return F.crc32(col.cast("string").cast("binary")) % F.lit(modulus)


def held_out(col: Column, modulus: int) -> Column:
    """True on the remainder 2; a null id is never held out."""
    return F.coalesce(crc_mod(col, modulus) == 2, F.lit(False))


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def connected_components(links: DataFrame) -> DataFrame:
    """Columns (node, component): component is the smallest node reachable over links(a, b).

    Alternates large-star and small-star steps, each a groupBy-min and a join. The minima are written before they are
    joined, so both sides of a join come from exchanges of their own and Spark can deal a hub's links out to several
    tasks. Every round is a written table; it ends when the links are stars around least nodes, which links that come so
    are from the start. Nodes without links are not returned; null ends and loops are ignored.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"), (F.col("a") != F.col("b")).alias("ok"))
    edges = written(edges.where("ok").select("u", "v").distinct(), "links")
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = written(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "links-large")
        discard(least)
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        done, edges = edges, written(small.select("e.*").where("u != v").distinct(), "links")
        discard(done, large, least)
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _stars(edges: DataFrame) -> bool:
    """Whether each node of edges(u, v), u > v, has links to greater nodes only or one link, to a lesser node."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up")), F.struct(F.col("v").alias("node"), F.lit(0).alias("up")))).alias("e"))
    counted = ends.select("e.*").groupBy("node").agg(F.sum("up").alias("up"), F.count("*").alias("n"))
    with cleaned_up(edges.sparkSession):
        return not counted.agg(F.bool_or((F.col("up") > 0) & (F.col("n") > 1))).first()[0]
