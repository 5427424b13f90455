"""LM scoring with Brown class-based n-grams.

Exchange clustering assigns words to classes so that class bigrams say most about each other; a text's probability is
the product of class transitions and of words given their classes. All training tokens are counted on Spark. The most
frequent words start in classes found by exchange on their own bigrams; then rounds follow in which every word of the
dictionary moves to the class that its neighbours' classes make likeliest, over counts of all training tokens by word
and neighbouring class. The dictionary is what the driver and the tasks hold, and its length is bounded; the words
beyond it, however many, are clustered by the class before them, in a table that is joined and never sent. Only words
under a small count share one class.

As history a word stands for its class, a word beyond the dictionary for the class of rare words; so a text's words
beyond it depend on nothing but the class before them, and are joined as a bag.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackmill.llm.common import discard, written

#: Words the dictionary holds at most, the most frequent first; occurrences from which a word is clustered.
MOST_WORDS, LEAST_COUNT = 100_000, 5
#: Words that the rounds start from, sweeps over those, and rounds over all words.
CORE, SWEEPS, ROUNDS = 1_000, 10, 3
#: Fewest and most clustered classes; their number grows with the root of the dictionary's length.
CLASSES = (16, 40)
ADD = 0.5
#: The end token among the words, none of which is empty.
END_WORD = b""
FLUSH = 400_000


def class_count(words: int) -> int:
    return max(CLASSES[0], min(CLASSES[1], isqrt(words) // 7))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().split()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[bytes] = Counter()
    for batch in batches:
        for text in batch.column(0):
            counts.update(words(text.as_py()))
            counts[END_WORD] += 1
            if len(counts) > FLUSH:
                yield _pairs(counts)
                counts.clear()
    if counts:
        yield _pairs(counts)


def _pairs(counts: Counter[bytes]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])


def token_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, c): how often each token occurs in docs; the end token is the empty word."""
    counted = docs.select(text_col).mapInArrow(_count, "word binary, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("c"))


def exchange(bigrams: np.ndarray, fixed: dict[int, int], classes: int, total: int, sweeps: int = SWEEPS) -> np.ndarray:
    """Classes of the items of a bigram count matrix by exchange clustering.

    fixed items stay in their class. The others begin in turn by frequency; in each sweep every one moves to the class
    that raises the class bigrams' mutual information most, until none moves or sweeps are over.
    """
    n = len(bigrams)
    free = [i for i in np.argsort(-bigrams.sum(axis=1), kind="stable") if i not in fixed]
    of = np.zeros(n, dtype=np.int64)
    for i, c in fixed.items():
        of[i] = c
    for rank, i in enumerate(free):
        of[i] = rank % classes
    member = np.zeros((n, total))
    member[np.arange(n), of] = 1
    table = member.T @ bigrams @ member
    every = np.arange(classes)

    def h(x: np.ndarray) -> np.ndarray:
        return x * np.log(np.maximum(x, 1e-300))

    for _ in range(sweeps):
        moved = False
        for i in free:
            own = bigrams[i, i]
            right = bigrams[i] @ member
            left = bigrams[:, i] @ member
            a = of[i]
            right[a] -= own
            left[a] -= own
            table[a, :] -= right
            table[:, a] -= left
            table[a, a] -= own
            logs, out, into = h(table), table.sum(axis=1)[:classes], table.sum(axis=0)[:classes]
            corner = table[every, every] + right[:classes] + left[:classes] + own
            rows, columns = table[:classes] + right, table[:, :classes].T + left
            rows[every, every] = columns[every, every] = corner
            before = logs[:classes].sum(axis=1) + logs[:, :classes].sum(axis=0) - logs[every, every] - h(out) - h(into)
            after = h(rows).sum(axis=1) + h(columns).sum(axis=1) - h(corner) - h(rows.sum(axis=1)) - h(columns.sum(axis=1))
            gain = after - before
            b = int(gain.argmax())
            if gain[b] <= gain[a] + 1e-9:
                b = int(a)
            table[b, :] += right
            table[:, b] += left
            table[b, b] += own
            if b != a:
                member[i, a], member[i, b], of[i], moved = 0, 1, b, True
        if not moved:
            break
    return of


_INTS = T.ArrayType(T.IntegerType())
_ENCODED = [T.StructField("key", T.LongType()), T.StructField("ids", _INTS), T.StructField("rare", T.ArrayType(T.BinaryType())), T.StructField("before", _INTS), T.StructField("times", _INTS)]
_BEYOND = [T.StructField("word", T.BinaryType()), T.StructField("before", T.IntegerType()), T.StructField("times", T.IntegerType())]


def _encoded(given: DataFrame, number: dict[bytes, int]) -> DataFrame:
    """given(..., text) with key, ids and the words beyond the dictionary instead of the text.

    ids has the number of each token, the end included, or -1. Of the words without a number, each different one after
    each different token is listed with its times.
    """
    sent = given.sparkSession.sparkContext.broadcast(number)  # MOST_WORDS at most
    end = number[END_WORD]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, task, at = sent.value, TaskContext.get().partitionId(), 0
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                batch = whole.slice(start, 1000)
                ids, rare, before, times, id_ends, rare_ends = [], [], [], [], [0], [0]
                for x in batch.column(batch.num_columns - 1):
                    row = [*words(x.as_py()), END_WORD]
                    numbers = list(map(of.get, row, repeat(-1)))
                    ids.append(np.array(numbers, dtype=np.int32))
                    odd = Counter([(row[i], numbers[i - 1] if i else end) for i in np.flatnonzero(ids[-1] < 0).tolist()])
                    rare += [w for w, _ in odd]
                    before += [b for _, b in odd]
                    times += odd.values()
                    id_ends.append(id_ends[-1] + len(numbers))
                    rare_ends.append(len(rare))
                key = pa.array(range((task << 40) + at, (task << 40) + at + batch.num_rows), pa.int64())
                at += batch.num_rows
                lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values) for ends, values in (
                    (id_ends, pa.array(np.concatenate([np.zeros(0, np.int32), *ids]))), (rare_ends, pa.array(rare, pa.binary())), (rare_ends, pa.array(before, pa.int32())), (rare_ends, pa.array(times, pa.int32())))]
                yield pa.record_batch([*batch.columns[:-1], key, *lists], names=[*batch.schema.names[:-1], "key", "ids", "rare", "before", "times"])

    return given.mapInArrow(encode, T.StructType([*given.schema.fields[:-1], *_ENCODED]))


def _coded_counts(encoded: DataFrame, code, width: int) -> DataFrame:
    """Sum over all rows of what code makes of their ids: (code, n); codes are below width.

    Rows' ids come one after the other; each ends with the end token, which is also what stands before a text.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, np.int32)  # of one task's tokens
        for batch in batches:
            ids = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            for start in range(0, len(ids), 1_000_000):
                codes = code(ids, start, min(len(ids), start + 1_000_000))
                if len(codes) * 8 > width:
                    np.add(total, np.bincount(codes, minlength=width), out=total, casting="unsafe")
                else:
                    found, n = np.unique(codes, return_counts=True)
                    total[found] += n.astype(np.int32)
        found = np.flatnonzero(total)
        yield pa.record_batch([pa.array(found, pa.int64()), pa.array(total[found].astype(np.int64), pa.int64())], names=["code", "n"])

    return encoded.select("ids").mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def _table(counts: DataFrame, width: int) -> np.ndarray:
    got = written(counts, "bigrams")
    found, out = got.toArrow(), np.zeros(width)
    out[found.column("code").to_numpy()] = found.column("n").to_numpy()
    discard(got)
    return out


@dataclass
class ClassModel:
    """Logs by dictionary number (the last entry stands for words beyond it) and by class pair, and the totals.

    The clustered classes come first, then that of the end and that of rare words.
    """

    classes: np.ndarray
    log_count: np.ndarray
    log_emit: np.ndarray
    log_step: np.ndarray
    tokens: int
    distinct: int
    log_rare: float

    def parts(self, ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of each text: tokens, those beyond the dictionary, log counts and the model's logs, without the latter ones."""
        c, known = self.classes[ids], ids >= 0
        before = np.concatenate([[len(self.log_step) - 2], c[:-1]])
        logs = np.where(known, self.log_emit[ids] + self.log_step[before, c], 0.0)
        add = np.add.reduceat
        return add(np.ones(len(ids), np.int64), starts), add((~known).astype(np.int64), starts), add(self.log_count[ids], starts), add(logs, starts)


def _steps(encoded: DataFrame, classes: np.ndarray, total: int) -> np.ndarray:
    """Counts of (class before, class) over dictionary words and the end."""

    def steps(ids: np.ndarray, start: int, stop: int) -> np.ndarray:
        row = classes[ids[start:stop]]
        before = np.concatenate([[classes[ids[start - 1]] if start else total - 2], row[:-1]])
        return (before * total + row)[ids[start:stop] >= 0]

    return _table(_coded_counts(encoded, steps, total * total), total * total).reshape(total, total)


def _moved(encoded: DataFrame, classes: np.ndarray, table: np.ndarray, total: int) -> np.ndarray:
    """For each dictionary word the class under which its neighbours are likeliest; table has the class bigrams."""
    end = len(classes) - 2

    def neighbours(ids: np.ndarray, start: int, stop: int) -> np.ndarray:
        row = classes[ids[max(0, start - 1) : stop + 1]]
        if not start:
            row = np.concatenate([[total - 2], row])
        at = np.flatnonzero((ids[start:stop] >= 0) & (ids[start:stop] < end))
        word = ids[start:stop][at].astype(np.int64) * 2
        # a word is never last, as the end follows
        return np.concatenate([word * total + row[at], (word + 1) * total + row[at + 2]])

    counts = _coded_counts(encoded, neighbours, end * 2 * total)
    both = F.lit(2 * total)
    cells = counts.select(F.floor(F.col("code") / both).cast("int").alias("word"), F.struct((F.col("code") % both).cast("int").alias("cell"), "n").alias("x"))
    smooth = table + ADD
    after, before = np.log(smooth / smooth.sum(axis=1, keepdims=True)), np.log(smooth / smooth.sum(axis=0, keepdims=True))
    weigh = np.concatenate([before[:, : total - 2], after[: total - 2].T])

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            cell, n = (lists.flatten().field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            sides = np.zeros((batch.num_rows, 2 * total))
            sides[np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy())), cell] = n
            yield pa.record_batch([batch.column(0).cast(pa.int64()), pa.array((sides @ weigh).argmax(axis=1), pa.int64())], names=["code", "n"])

    # of a word there are twice as many cells as classes at most
    grouped = cells.groupBy("word").agg(F.collect_list("x").alias("x"))
    out = classes.copy()
    out[:end] = _table(grouped.mapInArrow(best, "code long, n long"), end).astype(np.int64)
    return out


def _objective(table: np.ndarray) -> float:
    """What the class bigrams say about the tokens; an exchange is to raise it."""
    h = lambda x: float((x * np.log(np.maximum(x, 1.0))).sum())
    return h(table) - h(table.sum(axis=0)) - h(table.sum(axis=1))


def _clustered(encoded: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Classes by dictionary number, the end and the rare ones after the words; and their bigrams."""
    core, classes = min(words, CORE), class_count(words)
    total, size = classes + 2, core + 3
    # the items: core words, other words, the end, words beyond the dictionary; all but the first stand still
    item = np.concatenate([np.arange(core), np.full(words - core, core), [core + 1, core + 2]])

    def pairs(ids: np.ndarray, start: int, stop: int) -> np.ndarray:
        row = item[ids[max(0, start - 1) : stop]]
        return (row[:-1] if start else np.concatenate([[core + 1], row[:-1]])) * size + row[1 if start else 0 :]

    bigrams = _table(_coded_counts(encoded, pairs, size * size), size * size).reshape(size, size)
    of = exchange(bigrams, {core: classes + 1, core + 1: classes, core + 2: classes + 1}, classes, total)
    # words besides the core count as rare until the first round gives them a class
    now = np.concatenate([of[:core], np.full(words - core, classes + 1), [classes, classes + 1]])
    table = _steps(encoded, now, total)
    for turn in range(ROUNDS if words else 0):
        then = _moved(encoded, now, table, total)
        changed = _steps(encoded, then, total)
        if turn and _objective(changed) <= _objective(table):
            break
        now, table = then, changed
    return now, table


def _beyond(encoded: DataFrame, classes: np.ndarray, keep: list[str]) -> DataFrame:
    """One row per row of encoded and different word beyond the dictionary after one class: keep, word, before, times."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.columns[-3:]
            row = pa.array(np.repeat(np.arange(batch.num_rows), np.diff(lists[0].offsets.to_numpy())))
            before = pa.array(classes[lists[1].flatten().to_numpy(zero_copy_only=False)].astype(np.int32))
            yield pa.record_batch([*(c.take(row) for c in batch.columns[:-3]), lists[0].flatten(), before, lists[2].flatten()], names=[*batch.schema.names[:-3], "word", "before", "times"])

    given = encoded.select(*keep, "rare", "before", "times")
    return given.mapInArrow(rows, T.StructType([*given.schema.fields[:-3], *_BEYOND]))


def _tail(encoded: DataFrame, classes: np.ndarray, table: np.ndarray, least: int) -> DataFrame:
    """(word, c, class, before, n): training words beyond the dictionary, their counts in all and after each class.

    A word goes to the class that is likeliest after the classes before it and in which it weighs most; those under
    least times are rare.
    """
    total = len(table)
    smooth = table + ADD
    weigh = np.log(smooth / smooth.sum(axis=1, keepdims=True)) - np.log(smooth.sum(axis=0))
    weigh = weigh[:, : total - 2]

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, c = batch.column(2), batch.column(1).to_numpy()
            cell, n = (lists.flatten().field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            seen = np.zeros((batch.num_rows, total))
            seen[np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy())), cell] = n
            of = np.where(c < least, total - 1, (seen @ weigh).argmax(axis=1))
            yield pa.record_batch([*batch.columns, pa.array(of, pa.int32())], names=["word", "c", "x", "class"])

    found = _beyond(encoded, classes, []).groupBy("word", "before").agg(F.sum("times").alias("n"))
    # of a word there are as many entries as classes at most
    grouped = found.groupBy("word").agg(F.sum("n").alias("c"), F.collect_list(F.struct("before", "n")).alias("x"))
    return grouped.mapInArrow(best, "word binary, c long, x array<struct<before:int,n:bigint>>, class int")


@dataclass
class Fitted:
    """All texts encoded, the model, and the training words beyond the dictionary (word, c, class)."""

    encoded: DataFrame
    model: ClassModel
    tail: DataFrame


def fit(given: DataFrame, most_words: int = MOST_WORDS, least: int = LEAST_COUNT) -> Fitted:
    """Learn from the rows of given(..., learn, text) that are to be learned from."""
    counts = written(token_counts(given.where("learn"), "text"), "tokens")
    total = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v"), F.sum(F.when(F.col("word") == F.lit(END_WORD), F.col("c"))).alias("ends")).first()
    n, v, ends = total.n or 0, total.v, total.ends or 0
    frequent = counts.where((F.col("c") >= least) & (F.col("word") != F.lit(END_WORD))).orderBy(F.desc("c"), "word").limit(most_words).collect()
    discard(counts)
    number = {bytes(r.word): i for i, r in enumerate(frequent)} | {END_WORD: len(frequent)}
    encoded = written(_encoded(given, number), "encoded")
    count = np.array([r.c for r in frequent] + [ends, 0], dtype=np.float64)
    learn = encoded.where("learn")
    classes, table = _clustered(learn, len(frequent))
    tail, all_, rare = written(_tail(learn, classes, table, least), "tail"), len(table), len(table) - 1
    steps = tail.select("class", F.explode("x").alias("x")).groupBy(F.col("x.before").alias("before"), "class").agg(F.sum("x.n").alias("n"))
    for r in written(steps, "tail-steps").collect():  # a row per pair of classes
        table[r.before, r["class"]] += r.n
    own = {r["class"]: (r.c, r.v) for r in tail.groupBy("class").agg(F.sum("c").alias("c"), F.count("*").alias("v")).collect()}
    of_class = np.bincount(classes, weights=count, minlength=all_) + np.array([own.get(k, (0, 0))[0] for k in range(all_)], dtype=np.float64)
    smooth = table + ADD
    log_class = np.log10(np.maximum(of_class, 1))
    emit = np.log10(np.maximum(count, 1)) - log_class[classes]
    log_rare = float(np.log10(own.get(rare, (0, 0))[0] + own.get(rare, (0, 0))[1] + 1))
    model = ClassModel(classes, np.log10(count + 1), emit, np.log10(smooth / smooth.sum(axis=1, keepdims=True)), n, v, log_rare)
    logs = [-float(log_class[k]) for k in range(rare)]
    weight = F.when(F.col("class") == rare, F.log10(F.col("c") + 1) - F.lit(log_rare)).otherwise(F.log10("c") + F.get(F.array(*map(F.lit, logs)), F.col("class")))
    return Fitted(encoded, model, tail.select("word", "c", "class", weight.alias("log_emit")))


def score_texts(docs: DataFrame, train: Column, keep: list[str], text_col: str = "text", most_words: int = MOST_WORDS, least: int = LEAST_COUNT) -> DataFrame:
    """One row per row of docs: keep, n_tokens, n_known, train_tokens, base_score, score, perplexity.

    Rows where train holds are learned from. base_score is the add-one unigram log10 probability, score the class
    model's; perplexity is per token. Null and empty texts are an end alone. Without training rows every token is
    unknown and the model even over its classes. Rows that repeat an id are scored each. An empty table stays so.
    """
    names = [f"k{i}" for i in range(len(keep))]
    given = docs.select(*[F.col(c).alias(k) for c, k in zip(keep, names, strict=True)], F.coalesce(train, F.lit(False)).alias("learn"), F.col(text_col).alias("text"))
    found = _scored(fit(given, most_words, least), names)
    return found.withColumnsRenamed(dict(zip(names, keep, strict=True)))


_PARTS = "n_tokens long, n_beyond long, log_count double, log_model double"


def _scored(fitted: Fitted, names: list[str]) -> DataFrame:
    encoded, model = fitted.encoded, fitted.model
    spark, all_ = encoded.sparkSession, len(model.log_step)
    sent = spark.sparkContext.broadcast(vars(model))  # MOST_WORDS numbers at most

    @F.arrow_udf(_PARTS)
    def parts(rows: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = ClassModel(**sent.value)
        for batch in rows:
            if isinstance(batch, pa.ChunkedArray):
                batch = batch.combine_chunks()
            ids, ends = batch.flatten().to_numpy(zero_copy_only=False), batch.offsets.to_numpy()
            yield pa.StructArray.from_arrays([pa.array(x) for x in own.parts(ids, ends[:-1] - ends[0])], [x.split()[0] for x in _PARTS.split(", ")])

    steps = spark.createDataFrame([(a, b, float(model.log_step[a, b])) for a in range(all_) for b in range(all_)], "before int, class int, log_step double")
    rows = _beyond(encoded, model.classes, ["key"]).join(fitted.tail, "word", "left")
    rows = rows.withColumns({"class": F.coalesce("class", F.lit(all_ - 1)), "log_emit": F.coalesce("log_emit", F.lit(-model.log_rare))})
    rows = rows.join(F.broadcast(steps), ["before", "class"])  # a row per pair of classes
    sums = rows.groupBy("key").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + 1)).alias("log_c"), F.sum(F.when(F.col("c").isNotNull(), F.col("times"))).alias("known"), F.sum(F.col("times") * (F.col("log_emit") + F.col("log_step"))).alias("log_p")
    )
    n = encoded.select(*names, "key", parts("ids").alias("n")).join(sums, "key", "left")
    tokens, zero = F.col("n.n_tokens"), F.lit(0.0)
    base = F.col("n.log_count") + F.coalesce("log_c", zero) - tokens * F.lit(float(np.log10(model.tokens + model.distinct + 1)))
    score = F.col("n.log_model") + F.coalesce("log_p", zero)
    known = (tokens - F.col("n.n_beyond") if model.tokens else F.lit(0)) + F.coalesce("known", F.lit(0))
    out = n.select(*names, tokens.alias("n_tokens"), known.cast("long").alias("n_known"), F.lit(model.tokens).cast("long").alias("train_tokens"), base.alias("base_score"), score.alias("score"))
    return out.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
