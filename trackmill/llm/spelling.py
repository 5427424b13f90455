"""Spelling variants: words one edit apart, found by asymmetric q-chunks, and the frequent form that each stands for.

Of two words one edit apart the shorter one (either, if they are as long) gives two disjoint chunks, its halves; the
edit falls into one of them, so the other one is a positional gram of the longer word, shifted by at most one. Of all
its positional grams a word gives those at the place and size that a partner's chunk can have: the same length or one
letter less. Equal keys are joined and the pairs verified. Where very many words share a chunk, the half that holds the
edit is halved again, and so on, so that a key's words come to differ in one place only.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackmill.llm.common import discard, written

#: A word has this many letters and occurrences at least; a form occurs this many times as often as its variant.
LEAST_LETTERS, LEAST_COUNT, FORM_FACTOR = 5, 3, 2
#: One in so many pairs of a document and a run loses a letter: the noise that the query's contract asks for.
NOISE = 97
#: Entries under one chunk beyond which the other half is halved again.
HEAVY = 200
#: Different words that a task counts before it hands its counts on.
MOST_HELD = 300_000

_RUN = re.compile("[a-zÀ-ÿ]+")
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def runs_of(doc_id: str, text: str | None, least: int = LEAST_LETTERS, noise: int = NOISE) -> Counter:
    """The words of one text with their counts; of one in noise runs, by a hash of id and run, a letter is missing."""
    lowered = (text or "").encode().translate(_LOWER).decode()
    out, start = Counter(), zlib.crc32(f"{doc_id}:".encode())
    for run, n in Counter(_RUN.findall(lowered)).items():
        if len(run) >= least:
            h = zlib.crc32(run.encode(), start)
            if noise and h % noise == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= least:
                out[run] += n
    return out


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_LETTERS, noise: int = NOISE, held: int = MOST_HELD) -> DataFrame:
    """(word, n) over all texts. A null text has no words, a null id counts as an empty one."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.record_batch([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
            counts.clear()
            return batch

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                counts.update(runs_of(doc_id.as_py(), text.as_py(), least, noise))
                if len(counts) > held:
                    yield out()
        if counts:
            yield out()

    texts = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("text"))
    return texts.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _entries(words: DataFrame) -> DataFrame:
    """(word, n, more, longer, size, i, j): a word as the longer or shorter one of a pair whose lengths differ by more.

    size is the shorter word's length. Its letters from i to j hold the edit, those beside them are shared.
    """
    length = F.length("word")
    roles = [(0, False), (1, False), (1, True)]
    parts = []
    for more, longer in roles:
        size = length - int(more and longer)
        half = F.floor(size / 2).cast("int")
        for i, j in ((half, size), (F.lit(0), half)):
            parts.append(F.struct(F.lit(more).alias("more"), F.lit(longer).alias("longer"), size.alias("size"), i.alias("i"), j.alias("j")))
    return words.select("word", "n", F.explode(F.array(*parts)).alias("e")).select("word", "n", "e.*")


def _key() -> Column:
    """What a pair's words share: their place in it and the letters beside the edit. Collisions are seen by verifying."""
    beyond = F.col("j") + F.when(F.col("longer"), F.col("more")).otherwise(0)
    return F.xxhash64("more", "size", "i", "j", F.expr("left(word, i)"), F.substring(F.col("word"), beyond + 1, F.length("word")))


def _halved(entries: DataFrame) -> DataFrame:
    half = F.floor((F.col("i") + F.col("j")) / 2).cast("int")
    ends = F.array(F.struct(half.alias("i"), F.col("j").alias("j")), F.struct(F.col("i").alias("i"), half.alias("j")))
    return entries.withColumn("e", F.explode(ends)).select("word", "n", "more", "longer", "size", "e.i", "e.j")


def _met(entries: DataFrame) -> DataFrame:
    """The pairs one edit apart among words that share a key."""
    a = entries.select("key", F.col("word").alias("a"), F.col("n").alias("n_a"), "more", F.col("longer").alias("longer_a"))
    b = entries.select("key", F.col("word").alias("b"), F.col("n").alias("n_b"), F.col("longer").alias("longer_b"))
    same = (F.col("more") == 0) & (F.col("a") < F.col("b")) & ~F.col("longer_b")
    other = (F.col("more") == 1) & ~F.col("longer_a") & F.col("longer_b")
    pairs = a.join(b, "key").where((same | other) & (F.levenshtein("a", "b", 1) == 1))
    return pairs.select("a", "b", "n_a", "n_b")


def near_words(words: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """(a, b, n_a, n_b): the pairs of words(word, n) that differ by one inserted, deleted or replaced letter, each once.

    Words must be distinct and have two letters at least. No pair is lost to crowded chunks: they are halved until
    heavy words or fewer share one, or until its words differ in one place only, which the alphabet bounds.
    """
    entries, found, done = _entries(words).withColumn("key", _key()), [], []
    while True:
        entries = written(entries, "chunks")
        done.append(entries)
        crowded = entries.where("j - i > 1").groupBy("key").count().where(F.col("count") > heavy).select("key")
        crowded = written(crowded, "chunks-crowded")
        if crowded.isEmpty():
            found.append(_met(entries))
            break
        found.append(_met(entries.join(crowded, "key", "left_anti")))
        entries = _halved(entries.join(crowded, "key", "left_semi").drop("key")).withColumn("key", _key())
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    pairs = written(pairs.distinct(), "words-near")
    discard(*done)
    return pairs


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of the chain of forms(word, form) from each word, by steps that double in length.

    A form occurs more often than its variant, so there are no cycles and a chain is as long as the logarithm of a count.
    """
    state = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = written(state.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        discard(state)
        state = stepped.select("word", "root")
        if stepped.where("moved").isEmpty():
            return state


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, factor: int = FORM_FACTOR, noise: int = NOISE, heavy: int = HEAVY) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    form is the near word that occurs most often, of equals the first by code points, if it occurs factor times as often
    as the word; root the last form of the chain, the word itself without one. Null and empty texts have no words; rows
    that repeat count each; null ids count as empty ones. Other columns of docs are not read. An empty table gives an
    empty result.
    """
    words = written(word_counts(docs, id_col, text_col, least_letters, noise).where(F.col("n") >= least_count), "words")
    pairs = near_words(words, heavy)
    sides = pairs.select(F.col("a").alias("word"), "n_a", F.col("b").alias("near"), "n_b").unionByName(pairs.select(F.col("b").alias("word"), F.col("n_b").alias("n_a"), F.col("a").alias("near"), F.col("n_a").alias("n_b")))
    best = F.min(F.struct((-F.col("n_b")).alias("less"), "near"))
    near = sides.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"), F.any_value("n_a").alias("own"))
    enough = -F.col("best.less") >= factor * F.col("own")
    near = written(near.select("word", "n_near", F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n")), "words-form")
    found = words.join(near, "word", "left").join(roots(near.where("form IS NOT NULL")), "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")
