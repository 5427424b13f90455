"""Language ID by word-first backoff.

A word that was learned scores its log frequency in each language. A word that wasn't falls back to its character
n-grams: the longest length of which any n-gram was learned decides, with the mean of those n-grams' log frequencies.
The languages' sums over all words of a text give a softmax; the likeliest language and its share are returned.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackmill.llm.common import held_out, scratch, written

#: Runs of letters, and of what Python counts among them though it is a number: letters that are numerals, fractions.
LETTERS = re.compile(r"[^\W\d_]+")
NUMERALS = frozenset(c for c in map(chr, range(0x110000)) if unicodedata.category(c) in ("Nl", "No"))
UNKNOWN = "und"
#: Labelled rows the model is fitted on at most, and how often a word or n-gram must occur among them to be learned.
MAX_DOCS, LEAST_COUNT = 6000, 2
#: Longest n-grams.
LONGEST = 5
#: Scores of words are remembered up to so many per Python worker; longer words are scored anew each time.
MEMO, MEMO_LETTERS = 200_000, 64


def words(text: str) -> list[str]:
    text = text.lower()
    found = LETTERS.findall(text)
    if not text.isascii() and not NUMERALS.isdisjoint(text):
        found = [part for run in found for part in "".join(" " if c in NUMERALS else c for c in run).split()]
    return found


def grams(word: str, n: int) -> Iterator[str]:
    """The n-grams of the whole word, with a space on either side if n is over 1."""
    padded = f" {word} " if n > 1 else word
    return (padded[i : i + n] for i in range(len(padded) - n + 1))


@dataclass
class LanguageModel:
    """langs; the row of each known word and n-gram; log frequencies by row and language."""

    langs: list[str]
    words: dict[str, int]
    grams: dict[str, int]
    logs: np.ndarray

    def score_word(self, word: str) -> np.ndarray:
        known = self.words.get(word)
        if known is not None:
            return self.logs[known]
        for n in range(LONGEST, 0, -1):
            rows = np.fromiter((r for g in grams(word, n) if (r := self.grams.get(g, -1)) >= 0), dtype=np.int64)
            if len(rows):
                # in numpy's pairwise sums, so that long words lose no precision
                return self.logs[rows].mean(axis=0, dtype=np.float64)
        return np.zeros(len(self.langs))


def model_from_counts(words: Iterable[tuple[str, str, int]], grams: Iterable[tuple[str, str, int]], least: int = LEAST_COUNT) -> LanguageModel:
    """From (lang, word, n) and (lang, n-gram, n): add-half smoothed log shares of those that occur least times.

    A word's share is of all words of a language, an n-gram's of all n-grams of its length.
    """
    words, grams = sorted(words), sorted(grams)
    langs = sorted({r[0] for r in words})
    at = {lang: i for i, lang in enumerate(langs)}
    rows: list[dict[str, int]] = [{}, {}]
    logs = [np.zeros((0, len(langs)), np.float32)]
    for known, kinds in ((rows[0], [words]), (rows[1], [[r for r in grams if len(r[1]) == n] for n in range(1, LONGEST + 1)])):
        for kind in kinds:
            own = {name: i for i, name in enumerate(dict.fromkeys(r[1] for r in kind))}
            counts = np.zeros((len(own), len(langs)))
            for lang, name, n in kind:
                counts[own[name], at[lang]] += n
            keep = counts.sum(axis=1) >= least
            first = sum(map(len, logs))
            number = first + np.cumsum(keep) - 1
            known.update((name, int(number[i])) for name, i in own.items() if keep[i])
            logs.append(np.log((counts[keep] + 0.5) / (counts.sum(axis=0) + 0.5 * max(1, len(own)))).astype(np.float32))
    return LanguageModel(langs, *rows, np.concatenate(logs))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_docs: int = MAX_DOCS, least: int = LEAST_COUNT) -> LanguageModel:
    """Fit on at most max_docs different labelled rows, those first by a hash of id and text.

    Null labels and null texts are left out; rows that repeat id and text are one, under the smallest label. All words
    of those rows and all n-grams of the words are counted; those that occur least times are learned. An empty table
    gives a model without languages, which answers und.
    """
    labelled = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    labelled = labelled.select(F.xxhash64(id_col, text_col).alias("pick"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    last = labelled.select("pick").distinct().orderBy("pick").limit(max_docs).agg(F.max("pick")).first()[0]
    picked = labelled.where(F.col("pick") <= F.lit(last)).groupBy("pick").agg(F.min("lang").alias("lang"), F.min("text").alias("text"))
    counts = _summed(picked.select("lang", "text").mapInArrow(_count_words, "lang string, name string, n long"))
    counts = written(counts, "words-counted")
    found = _summed(counts.mapInArrow(_count_grams, "lang string, name string, n long"))
    # what occurs less than least times counts in the totals, so it is sent too; the sample bounds it
    return model_from_counts(_collected(counts), _collected(found), least)


def _summed(counts: DataFrame) -> DataFrame:
    return counts.groupBy("lang", "name").agg(F.sum("n").alias("n"))


def _collected(counts: DataFrame) -> list[tuple[str, str, int]]:
    found = counts.toArrow()
    return list(zip(*(found.column(c).to_pylist() for c in ("lang", "name", "n")), strict=True))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: Counter[tuple[str, str]] = Counter()
        for lang, text in zip(batch.column(0), batch.column(1), strict=True):
            own = lang.as_py()
            counts.update((own, w) for w in words(text.as_py()))
        yield _batch(counts)


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: Counter[tuple[str, str]] = Counter()
        for lang, word, times in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            for n in range(1, LONGEST + 1):
                for g in grams(word, n):
                    counts[lang, g] += times
        yield _batch(counts)


def _batch(counts: Counter[tuple[str, str]]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.string()), pa.array(list(counts.values()), pa.int64())], names=["lang", "name", "n"])


class Predictor:
    """Scores texts with a model and remembers words; the memory is bounded and emptied when full."""

    def __init__(self, model: LanguageModel, memo: int = MEMO) -> None:
        self.model, self.memo = model, memo
        self.at: dict[str, int] = {}
        self.table = np.zeros((1024, len(model.langs)), dtype=np.float32)

    def _row(self, word: str) -> int:
        if len(self.at) == len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        row = self.at[word] = len(self.at)
        self.table[row] = self.model.score_word(word)
        return row

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = Counter(words(text or ""))
        if not counts or not self.model.langs:
            return UNKNOWN, 0.0
        total = np.zeros(len(self.model.langs))
        for word in [w for w in counts if len(w) > MEMO_LETTERS]:
            total += counts.pop(word) * self.model.score_word(word)
        if len(self.at) > self.memo:
            self.at.clear()
        get = self.at.get
        rows = np.fromiter((r if (r := get(w)) is not None else self._row(w) for w in counts), dtype=np.int64, count=len(counts))
        n = np.fromiter(counts.values(), dtype=np.float64, count=len(counts))
        total += n @ self.table[rows]
        best = int(total.argmax())
        return self.model.langs[best], float(1 / np.exp(total - total[best]).sum())


def _prediction(docs: DataFrame, model: LanguageModel):
    # the labelled rows that a model is fitted on bound its size
    sent = docs.sparkSession.sparkContext.broadcast(vars(model))

    @F.arrow_udf("lang_pred string, score double")
    def predict(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        predictor = Predictor(LanguageModel(**sent.value))
        for batch in texts:
            found = [predictor.predict(x.as_py()) for x in batch]
            yield pa.StructArray.from_arrays([pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], ["lang_pred", "score"])

    return predict


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """docs with lang_pred and score (0 to 1) added; columns of those names are replaced.

    Texts that are null, empty or without a letter get und and 0. Long texts and long words are read whole. Rows that
    repeat are each predicted, alike; of languages that tie the first by name is named. An empty table stays so.
    """
    found = scratch(docs, "_found")
    out = docs.withColumn(found, _prediction(docs, model)(F.col(text_col)))
    return out.withColumns({"lang_pred": F.col(f"{found}.lang_pred"), "score": F.col(f"{found}.score")}).drop(found)


def train_on_kept_in(docs: DataFrame, id_col: str = "doc_id") -> LanguageModel:
    """Fit on the documents that are not held out."""
    return train(docs.where(~held_out(F.col(id_col), 4)), id_col)


def drop_unidentified(docs: DataFrame, model: LanguageModel, min_score: float = 0.5, text_col: str = "text") -> DataFrame:
    """docs without those whose language is und or whose share is under min_score; columns stay as they are.

    Null, empty and letterless texts go. Rows are judged one by one, so repeated rows go or stay together.
    """
    found = scratch(docs, "_found")
    out = docs.withColumn(found, _prediction(docs, model)(F.col(text_col)))
    return out.where((F.col(f"{found}.lang_pred") != UNKNOWN) & (F.col(f"{found}.score") >= min_score)).select(*docs.columns)
