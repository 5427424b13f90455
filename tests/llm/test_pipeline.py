import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from trackmill.llm import queries
from trackmill.llm.decontaminate import ERROR_RATE, edit_search
from test_similar import by_hand

SF = "/root/testdata/sf0.001"


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.written(stage(spark, docs, SF), "stage-test")
        out.append((before, docs))
    return out


def test_stages_by_hand(spark, stages):
    columns = spark.read.parquet(f"{SF}/documents.parquet").columns
    assert all(after.columns == columns for _, after in stages[:-1])
    rows = [[r.asDict() for r in before.collect()] for before, _ in stages]
    kept = [{r.doc_id for r in after.select("doc_id").collect()} for _, after in stages]
    assert kept[0] == {r["doc_id"] for r in rows[0] if re.search(r"[^\W\d_]", r["text"] or "")}
    least = {}
    for r in sorted(rows[1], key=lambda r: r["doc_id"]):
        least.setdefault(norm(r["text"]), r["doc_id"])
    assert kept[1] == set(least.values())
    assert kept[2] == {least for _, least in by_hand([(r["doc_id"], r["text"]) for r in rows[2]])}
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    found = [(i, int(len(i) * ERROR_RATE)) for i in items if i]
    clean = {r["doc_id"] for r in rows[3] if not any(edit_search(i, " ".join(r["text"].lower().split()), e) for i, e in found)}
    assert kept[3] == clean
    assert kept[4] == {r["doc_id"] for r in rows[4]}
    final = stages[4][1]
    assert final.where("taken > 2 * size").count() == 0
    off = final.join(stages[4][0].select("doc_id", "source"), "doc_id").groupBy("source").agg(F.sum("taken").alias("t"), F.max("target").alias("g"))
    assert off.where("abs(t - g) > 0.05 * g + 5").count() == 0


def test_registered():
    names = set(entry.queries())
    assert {"pipeline", *(q for q in queries.QUERIES)} <= names and {q.split("_")[0] for q in queries.QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(entry.oracle_sql()) <= names


def test_clashing_columns_pass_the_stages(spark, clashing):
    docs = clashing.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == clashing.columns
    assert 0 < corpus_pipeline.mix(spark, docs, SF).count() < clashing.count()


def test_empty_pipeline(spark, empty):
    docs = empty
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
