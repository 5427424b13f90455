"""The registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmill.llm import collocations, decontaminate, exact_dedup, language_id, line_dedup, lm_score, mixing, secrets, simhash, spelling, suffixes, toxicity, url_filter
from trackmill.llm.common import held_out, table


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = language_id.train_on_kept_in(docs)
    return language_id.identify(docs.select("doc_id", held_out(F.col("doc_id"), 4).alias("held_out"), "text"), model).drop("text")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal normalised texts over all documents."""
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of three-word shingles and their components within three bits, over all documents."""
    return simhash.near_copies(table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each document loses to lines that stand earlier in the corpus, equal or within a few edits."""
    return line_dedup.repeated_lines(table(spark, sf_dir, "documents"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict of dated lists, made of the pages themselves, on every page at its fetch day."""
    pages = table(spark, sf_dir, "pages")
    return url_filter.filter_urls(url_filter.page_captures(pages), url_filter.derived_entries(pages))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items that every document holds a passage of."""
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix takes."""
    return mixing.mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets of every document, weak ones where a complementary part is near."""
    return secrets.secret_digest(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, learned from labels that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.where(~held_out(F.col("doc_id"), 4)))
    scored = toxicity.score(docs.withColumn("held_out", held_out(F.col("doc_id"), 4)), model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and class bigram scores of every document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held_out(F.col("doc_id"), 7).alias("held_out"))
    return lm_score.score_texts(docs, ~F.col("held_out"), keep=["doc_id", "held_out"])


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near words, form and root of every word of all documents."""
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document loses to passages of 50 bytes or more that earlier documents hold."""
    return suffixes.remove_repeats(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strongest phrases of two and three words of each language, over all documents."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_simhash": op3_simhash,
    "op4_line_dedup": op4_line_dedup,
    "op5_url_filter": op5_url_filter,
    "op6_decontamination": op6_decontamination,
    "op7_mixing": op7_mixing,
    "op8_secret_scan": op8_secret_scan,
    "op9_toxicity": op9_toxicity,
    "op10_lm_score": op10_lm_score,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_suffix_dedup": op12_suffix_dedup,
    "op13_collocations": op13_collocations,
}

ORACLES: dict[str, str] = {
    "op2_exact_dedup": r"""
        WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
        FROM t WINDOW w AS (PARTITION BY norm)
    """,
    "op5_url_filter": url_filter.ORACLE_SQL,
    "op8_secret_scan": secrets.ORACLE_SQL,
}
