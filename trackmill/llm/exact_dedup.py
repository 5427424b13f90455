"""Exact dedup with content-defined chunk recipes, in DataFrame functions only.

Each normalised text is cut where its own content says so (a word end of certain letters, past a minimum length), so
that copies and shifted copies are cut alike. A document's recipe is the ordered list of its chunks' identifiers.
Identifiers are verified on the chunks themselves: distinct (identifier, chunk) pairs are formed, which moves each
different chunk about once, and no identifier may stand for two chunks; where one does, the next wider identifier is
taken. After that only recipes move: documents with equal recipes are equal, whatever their length.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackmill.llm.common import SPACE, discard, one_row_each, written

#: A chunk has 256 to 4096 characters and ends after one of these letters and a space; the last one may be shorter.
CHUNK = r"(?s)(?:.{256,4096}?(?:(?<=[dgkpvw]\x20)|\z)|.{1,4096})"

#: From narrow to wide; the first that proves free of collisions on the chunks at hand is used.
IDENTIFIERS: tuple[Callable[[Column], Column], ...] = (F.xxhash64, lambda c: F.sha2(c, 256))


def normalised(text: Column) -> Column:
    """Null as empty, each run of ASCII white space as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def chunks(text: Column) -> Column:
    """The chunks of a normalised text in order; they join to the text again. An empty text has none."""
    return F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0))


def verified(docs: DataFrame, text_col: str, identify: Callable[[Column], Column]) -> bool:
    """Whether identify gives different chunks of docs different identifiers; chunks are compared whole."""
    chunk = docs.select(F.explode(chunks(normalised(F.col(text_col)))).alias("chunk"))
    distinct = chunk.select(identify(F.col("chunk")).alias("id"), "chunk").distinct()
    return distinct.groupBy("id").count().where("count > 1").isEmpty()


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", identifiers: Sequence[Callable[[Column], Column]] = IDENTIFIERS) -> DataFrame:
    """One row per row of docs: id_col, keep_id, group_size, kept, text_sha256.

    keep_id is the smallest id among equal normalised texts, group_size the number of rows with that text. Null and
    empty texts are equal and have an empty recipe. Rows that repeat an id are counted each, and all rows that carry
    the smallest id are kept; null ids are never the smallest unless a group has no other. Other columns of docs are
    not read. An empty table gives an empty result.
    """
    recipes, groups = _recipes(docs, id_col, text_col, identifiers)
    return recipes.join(groups, "recipe").select(
        F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def _recipes(docs: DataFrame, id_col: str, text_col: str, identifiers: Sequence[Callable[[Column], Column]] = IDENTIFIERS) -> tuple[DataFrame, DataFrame]:
    """(id, text_sha256, recipe) of each row and (recipe, keep_id, group_size) of each group, both written."""
    for identify in identifiers:
        if verified(docs, text_col, identify):
            break
    else:
        raise ValueError("every chunk identifier has collisions")
    text = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("text"))
    recipes = written(text.select("id", F.sha2("text", 256).alias("text_sha256"), F.transform(chunks(F.col("text")), lambda c: identify(c)).alias("recipe")), "recipes")
    # written, so that the join deals both sides anew and can split a group of very many copies
    return recipes, written(recipes.groupBy("recipe").agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size"), F.min("text_sha256").alias("name")), "groups")


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each group of equal normalised texts; columns stay as they are.

    The row with the smallest id stays, null ids last; of rows that repeat that id the one with the smallest text.
    Rows go by id and text together: a row whose id also stands by a copy isn't touched. Null, empty and blank texts
    are texts like others and leave one row each; an empty table stays empty.
    """
    recipes, groups = _recipes(docs, id_col, text_col)
    rows = recipes.join(groups, "recipe").select("id", F.col("text_sha256").alias("key"), F.col("name").alias("group"))
    out = one_row_each(docs, rows, id_col, text_col, lambda text: F.sha2(normalised(text), 256))
    discard(recipes, groups)
    return out
