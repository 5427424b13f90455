"""The corpus pipeline: language ID, exact dedup, near dedup, decontamination, mixing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmill.llm.common import table, written
from trackmill.llm.decontaminate import drop_contaminated
from trackmill.llm.exact_dedup import drop_exact_copies
from trackmill.llm.language_id import drop_unidentified, train_on_kept_in
from trackmill.llm.mixing import mix_sources
from trackmill.llm.similar import drop_similar_copies


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents of a known language; those without a letter, or of no likely language, go.

    Null, empty and letterless texts go. Rows are judged one by one, so repeated rows and null ids are treated alike.
    """
    return drop_unidentified(docs, train_on_kept_in(docs))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of equal texts: the one with the smallest id, null ids last.

    A row goes for its own text alone, whatever other rows share its id; of rows that repeat id and text one stays.
    """
    return drop_exact_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each component of near copies: the one with the smallest id, null ids last.

    Near copies are texts whose five-word shingles are of at least 4/5 Jaccard similarity, or whose fingerprints over
    these differ in three bits at most. Ties and repeated rows as in exact.
    """
    return drop_similar_copies(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents without a passage of the benchmark; null and empty texts hold none and stay."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often the mix takes each row; rows without words are taken 0 times, repeated rows are documents of their own."""
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", F.col("copies"), "taken")


STAGES = [("language", language), ("exact", exact), ("near", near), ("decontaminate", decontaminate), ("mix", mix)]

#: Learned language models, fingerprints and balanced draws have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to documents; each stage's result is written and read again. An empty table gives an empty mix."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
