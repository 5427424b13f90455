"""Toxicity as gradient-boosted trees over dense features, with isotonic calibration.

The lexicon is learned from labelled documents: words, and beginnings of words, that toxic documents hold far more
often. Features of a text are densities of lexicon words, of lexicon beginnings and of disguised lexicon words, second
persons near them, capitals, punctuation and disguise rates. Boosted trees are fitted on one part of the labelled
documents and their scores calibrated by isotonic regression on the other.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackmill.llm.common import scratch, written

#: Labelled documents the model is fitted on at most; fewest toxic documents a term must be in.
MAX_DOCS, LEAST_DOCS = 20_000, 4
#: Steps into which scores are gathered for their calibration.
STEPS = 1_000
#: A term's share among toxic documents is at least so many times its share among the others.
LEAST_LIFT = 20.0
TREES, DEPTH = 20, 4
#: Beginnings of words that are learned have these lengths.
STEMS = (5, 6)
#: Words within so many of a second person count as near.
NEAR = 4

#: Pronouns of the second person in English, German, French and Spanish.
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch euer tu te toi ton ta tes vous votre vos tú ti usted ustedes vosotros os".split())
#: Signs that stand for letters.
DISGUISE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": "", "|": "l"})

TOKEN = re.compile(r"[^\W_]+(?:[@$!*|0-9][^\W_]+)*")
CAPITALS = re.compile(r"\b[^\W\d_]*[A-Z]{3,}[^\W\d_]*\b")
MIXED = re.compile(r"[^\W\d_][0-9@$*|]+[^\W\d_]")
FEATURES = ("words", "lexicon_words", "lexicon_density", "stem_words", "stem_density", "disguised_density", "second_person", "second_person_near", "capitals", "capital_words", "punctuation", "exclamations", "disguise_rate")


def tokens(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


def terms(found: Counter[str]) -> set[str]:
    """What may be learned from a text's words: the words, and their beginnings marked with a star."""
    out = set(found)
    for w in found:
        out.update(f"{w[:n]}*" for n in STEMS if len(w) > n)
    return out


def features(text: str | None, lexicon: frozenset[str]) -> tuple[float, ...]:
    """The dense features in the order of FEATURES; an empty text has zeros."""
    text = text or ""
    row = tokens(text)
    if not row:
        return (0.0,) * len(FEATURES)
    found = Counter(row)
    n = len(row)
    plain = {w for w in found if w in lexicon}
    stems = {w for w in found if any(len(w) > k and f"{w[:k]}*" in lexicon for k in STEMS)}
    odd = [w for w in found if not w.isalpha()]
    hidden = {w for w in odd if w not in plain and w.translate(DISGUISE) in lexicon}
    toxic = plain | stems | hidden
    near = 0
    if toxic:
        persons = [i for i, w in enumerate(row) if w in SECOND_PERSON]
        hits = [i for i, w in enumerate(row) if w in toxic]
        at = 0
        for i in hits:
            while at < len(persons) and persons[at] < i - NEAR:
                at += 1
            near += at < len(persons) and persons[at] <= i + NEAR
    letters = max(1, len(text))
    tf = lambda group: sum(found[w] for w in group)
    return (
        math.log1p(n), float(tf(plain)), tf(plain) / n, float(tf(stems)), tf(stems) / n, tf(hidden) / n, tf(SECOND_PERSON & found.keys()) / n, near / n,
        sum(map(text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ")) / letters, len(CAPITALS.findall(text)) / n, sum(map(text.count, ".,;:!?")) / letters, (text.count("!") + text.count("?")) / letters, len(MIXED.findall(text)) / n,
    )


@dataclass
class ToxicityModel:
    """A lexicon, trees over the features and their calibration; without both classes only a constant."""

    lexicon: frozenset[str]
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    constant: float


def _with_features(docs: DataFrame, lexicon: frozenset[str], text_col: str, out: str) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(lexicon)
    fields = T.StructType([T.StructField(name, T.DoubleType()) for name in FEATURES])

    @F.pandas_udf(fields)
    def extract(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            yield pd.DataFrame([features(x, sent.value) for x in batch], columns=list(FEATURES), dtype="float64")

    return docs.withColumn(out, extract(F.col(text_col)))


def _count_terms(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        counts: dict[int, Counter[str]] = {0: Counter(), 1: Counter()}
        for text, toxic in zip(frame["text"], frame["toxic"], strict=True):
            counts[int(toxic)].update(terms(Counter(tokens(text or ""))))
        for toxic, found in counts.items():
            yield pd.DataFrame({"term": list(found), "toxic": toxic, "n": list(found.values())}).astype({"toxic": "int32", "n": "int64"})


def learn_lexicon(labelled: DataFrame) -> frozenset[str]:
    """Terms of labelled(text, toxic) that toxic documents hold LEAST_LIFT times as often as the others."""
    sizes = {r.toxic: r["count"] for r in labelled.groupBy("toxic").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    counts = labelled.select("text", "toxic").mapInPandas(_count_terms, "term string, toxic int, n long")
    counts = counts.groupBy("term").agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("bad"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("good"))
    lift = (F.col("bad") / max(1, toxic)) / ((F.col("good") + 0.5) / max(1, clean))
    # the labelled documents bound what is found
    return frozenset(r.term for r in counts.where((F.col("bad") >= LEAST_DOCS) & (lift >= LEAST_LIFT)).select("term").collect())


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_docs: int = MAX_DOCS) -> ToxicityModel:
    """Fit on at most max_docs labelled documents, those first by a hash of their id.

    Labels are 0 and 1; null labels and null ids are left out; of several labels of one id the greatest counts, of
    several texts of one id the least. A third of each class is held back for the calibration; where that leaves a part
    without one of the classes, all is learned from and the trees' own probability stands. With one class among the
    labels the model is that class's constant, without labels 0.
    """
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("key")).agg(F.max(label_col).cast("int").alias("toxic"))
    some = known.orderBy(F.xxhash64("key"), "key").limit(max_docs)
    labelled = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text")).join(F.broadcast(some), "key").groupBy("key", "toxic").agg(F.min("text").alias("text"))
    labelled = written(labelled.withColumn("place", F.xxhash64("key", F.lit("fold"))), "labelled")
    cuts = {r.toxic: (r.cut, r.n) for r in labelled.groupBy("toxic").agg(F.percentile_approx("place", 1 / 3).alias("cut"), F.count("*").alias("n")).collect()}
    if len(cuts) < 2:
        return ToxicityModel(frozenset(), None, None, float(max(cuts, default=0)))
    back = F.lit(False)
    if all(n > 1 for _, n in cuts.values()):
        for toxic, (cut, _) in cuts.items():
            back = back | ((F.col("toxic") == toxic) & (F.col("place") <= F.lit(cut)))
    labelled = labelled.withColumn("back", back)
    lexicon = learn_lexicon(labelled.where("NOT back"))
    rows = written(_with_features(labelled, lexicon, "text", "f").select("back", F.col("toxic").cast("double").alias("label"), "f.*"), "features")
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows).coalesce(rows.sparkSession.sparkContext.defaultParallelism)
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=1, maxBins=64).fit(vectors.where("NOT back"))
    raw = trees.transform(vectors.where("back")).select("label", vector_to_array("probability")[1].alias("raw"))
    # calibrated on one row per step of the score, however many labels there are
    steps = raw.groupBy(F.round(F.col("raw") * STEPS).alias("step")).agg(F.avg("raw").alias("raw"), F.avg("label").alias("label"), F.count("*").cast("double").alias("n"))
    steps = written(steps, "calibration")
    if steps.isEmpty():
        return ToxicityModel(lexicon, trees, None, 0.0)
    calibration = IsotonicRegression(featuresCol="raw", labelCol="label", weightCol="n", predictionCol="calibrated").fit(steps)
    return ToxicityModel(lexicon, trees, calibration, 0.0)


def score(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """docs with score added (0 to 1, higher is likelier toxic); a column of that name is replaced.

    Null and empty texts have all features zero and get what the trees say to that. The score is the calibrated share,
    with a hundredth of the trees' own probability mixed in so that equal steps of the calibration still rank.
    """
    if model.trees is None:
        return docs.withColumn("score", F.lit(model.constant))
    keep = [c for c in docs.columns if c != "score"]
    f, row = scratch(docs, "_features"), scratch(docs, "_row")
    packed = docs.select(F.struct(*keep).alias(row), F.col(text_col).alias("text"))
    flat = _with_features(packed, model.lexicon, "text", f).select(row, f"{f}.*")
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(flat)
    raw = model.trees.transform(vectors).select(row, vector_to_array("probability")[1].alias("raw"))
    if model.calibration is not None:
        raw = model.calibration.transform(raw).select(row, (F.col("calibrated") * 0.99 + F.col("raw") * 0.01).alias("raw"))
    return raw.select(f"{row}.*", F.col("raw").alias("score"))
