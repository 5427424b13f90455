"""Phrase collocations by dynamic itemset counting over shards.

The corpus is dealt into shards that are read in turn, round and round. Words are counted from the first shard on. As
soon as both phrases inside a longer one have reached the threshold, wherever in the cycle that is, the longer one is
counted too, from the next shard on, and goes on until every shard has been counted for it once. So lengths interleave,
and no length waits for the one before it to have seen the whole corpus. What has reached the threshold is told to the
tasks in a table of bits, by hashed phrases; a bit that another phrase has set costs work and loses nothing. The hashed
counts only find what can be frequent: one last scan counts those phrases themselves.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackmill.llm.common import discard, small_batches, written

#: Occurrences of a phrase at least, words of the longest one, phrases reported per language.
LEAST, LONGEST, TOP = 10, 3, 2000
#: A phrase in a longer one that makes up this share (percent) of its occurrences is dropped.
COVERED = 50
SHARDS = 3
#: The table of what has reached the threshold has 2**TABLE_BITS bits: 8 MB, at any size of the corpus.
TABLE_BITS = 26
#: Words that a task holds before it hands its counts on, different words that it knows; bytes that it splits at once.
MOST_HELD, MOST_KNOWN, PIECE_BYTES = 1_500_000, 200_000, 1 << 20
#: Texts that a task gets at once, and places that it looks up at once.
BATCH_TEXTS, LOOKED_UP = 500, 1 << 17
#: Parts that the phrases of a language are ranked in first.
PARTS = 64

_TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\x09\x0b\x0c\r.,;:!?", b"abcdefghijklmnopqrstuvwxyz " + b"\n" * 9)
_MIX, _STEP = np.uint64(0xD6E8FEB86659FD93), np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes) -> list[bytes]:
    """The words of a text in order; between pieces, and in the end, stands a line feed."""
    return [w for w in text.translate(_TABLE).replace(b"\n", b" \n ").split(b" ") if w] + [b"\n"]


class Vocabulary(dict):
    """Numbers for words in order of their coming; 0 is the border between pieces."""

    def __init__(self) -> None:
        super().__init__({b"\n": 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _held(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[str, Vocabulary, np.ndarray]]:
    """(lang, vocabulary, the texts' words as its numbers), language by language, as often as most words are held."""
    vocabularies: dict[str, Vocabulary] = {}
    numbers: dict[str, list[np.ndarray]] = {}
    held = 0

    def out() -> Iterator[tuple[str, Vocabulary, np.ndarray]]:
        while numbers:  # a language goes as it is given out
            lang, parts = numbers.popitem()
            yield lang, vocabularies.pop(lang), np.concatenate(parts)

    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1), strict=True):
            lang, data = lang.as_py(), text.as_py().encode()
            vocabulary = vocabularies.setdefault(lang, Vocabulary())
            for piece in _pieces(data):
                numbers.setdefault(lang, []).append(np.array(list(map(vocabulary.__getitem__, words_of(piece))), dtype=np.int32))
                held += len(numbers[lang][-1])
            del vocabulary
            if held > most:
                yield from out()
                held = 0
    yield from out()


def _pieces(data: bytes) -> Iterator[bytes]:
    """A long text in parts that end where a piece of it does, or else the whole."""
    start = 0
    while len(data) - start > PIECE_BYTES:
        end = data.find(b"\n", start + PIECE_BYTES)
        if end < 0:
            break
        yield data[start:end]
        start = end + 1
    yield data[start:]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29))


class Hashes(dict):
    """Hashes of a language's words, never 0, which is the border between pieces."""

    def __init__(self, lang: str) -> None:
        super().__init__({b"\n": 0})
        self.seed = xxhash.xxh64_intdigest(lang.encode())

    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxhash.xxh64_intdigest(word, self.seed) or 1
        return h


def _word_hashes(lang: str, vocabulary: Vocabulary) -> np.ndarray:
    seed = Hashes(lang).seed
    out = np.fromiter((xxhash.xxh64_intdigest(word, seed) or 1 for word in vocabulary), np.uint64, len(vocabulary))
    out[0] = 0  # the border between pieces comes first
    return out


def _encoded(docs: DataFrame, most: int) -> DataFrame:
    """(words): the hashes of each text's words, as bytes."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Hashes] = {}
        for batch in batches:
            out, size = [], 0
            for lang, text in zip(batch.column(0), batch.column(1), strict=True):
                own = known.setdefault(lang.as_py(), Hashes(lang.as_py()))
                found = [np.array(list(map(own.__getitem__, words_of(piece))), dtype=np.uint64) for piece in _pieces(text.as_py().encode())]
                out.append(b"".join(x.tobytes() for x in found))
                if sum(map(len, known.values())) > MOST_KNOWN:
                    known.clear()
                size += len(out[-1])
                if size > 8 * most:
                    yield pa.record_batch([pa.array(out, pa.binary())], ["words"])
                    out, size = [], 0
            if out:
                yield pa.record_batch([pa.array(out, pa.binary())], ["words"])

    return docs.mapInArrow(encode, "words binary")


def _joined(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[np.ndarray]:
    """The words of encoded texts, most of them at once or as many as one text has."""
    parts, held = [], 0
    for batch in batches:
        for x in batch.column(0):
            parts.append(np.frombuffer(x.as_buffer(), np.uint64))
            held += len(parts[-1])
            if held > most:
                yield np.concatenate(parts)
                parts, held = [], 0
    if held:
        yield np.concatenate(parts)


def _longer(shorter: np.ndarray, words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the phrases of k words at each place, from those of k - 1."""
    return _mixed(shorter[: len(words) - k + 1] * _STEP + words[k - 1 :])


def _set(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = h >> np.uint64(64 - int(len(table) * 64).bit_length() + 1)
    return (table[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _active(tables: list[np.ndarray], shorter: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Of the places at, those where both phrases inside the one there have reached the threshold by the last table.

    A second table, if any, is that of the shard's last turn: what was active then has been counted in this shard.
    """
    out = np.zeros(len(at), dtype=bool)
    for i in range(0, len(at), LOOKED_UP):  # what a look-up takes is several times the places
        own = at[i : i + LOOKED_UP]
        first, second = shorter[own], shorter[own + 1]
        found = _set(tables[-1], first) & _set(tables[-1], second)
        out[i : i + LOOKED_UP] = found & ~(_set(tables[0], first) & _set(tables[0], second)) if len(tables) > 1 else found
    return out


def _places(words: np.ndarray, k: int) -> np.ndarray:
    """Where k words stand without a border between them."""
    inside, n = words != 0, len(words) - k + 1
    out = np.ones(max(n, 0), dtype=bool)
    for i in range(k if n > 0 else 0):
        out &= inside[i : i + n]
    return np.flatnonzero(out)


def _sent(docs: DataFrame, *tables: np.ndarray | None) -> Broadcast:
    """The tables, of bounded size, for the tasks; to be destroyed when the counts are written."""
    return docs.sparkSession.sparkContext.broadcast([zlib.compress(t.tobytes(), 1) for t in tables if t is not None])


def _received(sent: Broadcast) -> list[np.ndarray]:
    return [np.frombuffer(zlib.decompress(t), np.uint64) for t in sent.value]


def _hashed_counts(encoded: DataFrame, sent: Broadcast, longest: int, most: int) -> DataFrame:
    """(h, n): counts by hash of what is active by the last table and wasn't by a first one; of words if there is none.

    The last bit of h is 1 for the longest phrases, inside no other.
    """

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _received(sent)
        for words in _joined(batches, most):
            if len(tables) == 1:
                yield _counts(words[words != 0], longest == 1)
            shorter = words
            for k in range(2, longest + 1):
                at = _places(words, k)
                if not len(at):
                    break
                at = at[_active(tables, shorter, at)]
                shorter = _longer(shorter, words, k)
                yield _counts(shorter[at], k == longest)

    return encoded.mapInArrow(tally, "h long, n long")


def _counts(h: np.ndarray, last: bool) -> pa.RecordBatch:
    h, n = np.unique((h & ~np.uint64(1)) | np.uint64(last), return_counts=True)
    return pa.record_batch([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], ["h", "n"])


def _exact_counts(docs: DataFrame, sent: Broadcast, longest: int, most: int) -> DataFrame:
    """(lang, phrase, k, n): counts of the phrases whose bit is set; with k 0 the number of all words."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _spelled(batches, _received(sent)[0], longest, most)

    return docs.mapInArrow(tally, "lang string, phrase string, k int, n long").groupBy("lang", "phrase", "k").agg(F.sum("n").alias("n"))


def _spelled(batches: Iterator[pa.RecordBatch], table: np.ndarray, longest: int, most: int) -> Iterator[pa.RecordBatch]:
    for lang, vocabulary, numbers in _held(batches, most):
        yield _named(lang, 0, pa.array([b""], pa.binary()), np.array([np.count_nonzero(numbers)]))
        yield from _spelled_phrases(lang, vocabulary, numbers, table, longest)
        del vocabulary, numbers  # or they stay while the next words are gathered


def _spelled_phrases(lang: str, vocabulary: Vocabulary, numbers: np.ndarray, table: np.ndarray, longest: int) -> Iterator[pa.RecordBatch]:
    hashes, spelled = _word_hashes(lang, vocabulary), pa.array(list(vocabulary), pa.binary())
    words = shorter = hashes[numbers]
    rank = numbers.astype(np.int64)  # numbers the phrases of k words at each place, one by one
    for k in range(1, longest + 1):
        at = _places(numbers, k)
        if not len(at):
            break
        if k > 1:
            shorter = _longer(shorter, words, k)
        at = at[_set(table, shorter[at]) & (rank[at] >= 0)]
        same = rank[at] * len(spelled) + numbers[at + k - 1] if k > 1 else rank[at]
        _, first, own, n = np.unique(same, return_index=True, return_inverse=True, return_counts=True)
        if k < longest:
            rank = np.full(len(numbers), -1, dtype=np.int64)
            rank[at] = own
        each = [spelled.take(pa.array(numbers[at[first] + j])) for j in range(k)]
        yield _named(lang, k, pc.binary_join_element_wise(*each, b" "), n)


def _named(lang: str, k: int, phrases: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    size = len(phrases)
    columns = [pa.repeat(pa.scalar(lang, pa.string()), size), phrases.cast(pa.string()), pa.repeat(pa.scalar(k, pa.int32()), size), pa.array(n.astype(np.int64))]
    return pa.record_batch(columns, ["lang", "phrase", "k", "n"])


def _with_bits(tables: list[np.ndarray], reached: DataFrame) -> list[np.ndarray]:
    """The tables (of all phrases, of those that can be inside longer ones) with the bits of reached(h) set.

    They come as at most one row for each 64 bits of a table.
    """
    at = F.shiftrightunsigned("h", 64 - int(len(tables[0]) * 64).bit_length() + 1)
    bit = F.expr("shiftleft(1L, cast(at & 63 AS int))")
    rows = reached.select(at.alias("at"), (F.col("h") % 2 == 0).alias("inner"))
    words = rows.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(bit).alias("all"), F.bit_or(F.when(F.col("inner"), bit).otherwise(F.lit(0).cast("long"))).alias("inner")).toArrow()
    out = [t.copy() for t in tables]
    for table, name in zip(out, ("all", "inner"), strict=True):
        table[words["word"].to_numpy()] |= words[name].to_numpy().view(np.uint64)
    return out


def frequent_bits(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, shards: int = SHARDS, table_bits: int = TABLE_BITS, most: int = MOST_HELD) -> tuple[np.ndarray, list[tuple[int, bool]]]:
    """The table of all phrases in docs(lang, text) that can occur least times, and the turns (shard, whether new).

    A step reads one shard and counts what is active there and wasn't at the shard's last turn, so that each phrase is
    counted once in each shard, from the step on in which it became active. What a step has counted joins the state;
    phrases whose cycle is complete leave it. It ends when no shard is left with anything new to count. At its first
    turn a shard's words are hashed; later turns read the hashes.
    """
    found = [np.zeros((1 << table_bits) // 64, dtype=np.uint64)] * 2
    used: list[np.ndarray | None] = [None] * shards
    encoded: list[DataFrame] = []
    turns, idle, state = [], 0, None
    own = F.pmod(F.xxhash64("text"), F.lit(shards))
    for step in count():
        shard, table = step % shards, found[1]
        if used[shard] is not None and np.array_equal(used[shard], table):
            idle += 1
            if idle < shards:
                continue
            discard(*encoded, state)
            return found[0], turns
        idle = 0
        turns.append((shard, used[shard] is None))
        if used[shard] is None:
            with small_batches(docs.sparkSession, BATCH_TEXTS):
                encoded.append(written(_encoded(docs.where(own == shard), most), "words"))
        sent = _sent(docs, used[shard], table)
        rows = _hashed_counts(encoded[shard], sent, longest, most).withColumn("since", F.lit(step))
        used[shard] = table
        # first seen so many steps ago, a phrase has been counted in every shard
        rows = rows if state is None else rows.unionByName(state.where(F.col("since") > step - shards))
        with small_batches(docs.sparkSession, BATCH_TEXTS):
            counted = written(rows.groupBy("h").agg(F.sum("n").alias("n"), F.min("since").alias("since")), "phrases-counted")
        sent.destroy()
        if state is not None:
            discard(state)
        state = counted
        found = _with_bits(found, state.where(F.col("n") >= least).select("h"))


def _texts(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.col(text_col).alias("text")).where("text IS NOT NULL")


def phrase_counts(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, longest: int = LONGEST, shards: int = SHARDS, table_bits: int = TABLE_BITS, most: int = MOST_HELD) -> DataFrame:
    """(lang, phrase, k, n): all phrases of 1 to longest words that occur least times; with k 0 each language's words."""
    texts = _texts(docs, lang_col, text_col)
    table, _ = frequent_bits(texts, least, longest, shards, table_bits, most)
    sent = _sent(texts, table)
    with small_batches(docs.sparkSession, BATCH_TEXTS):
        # spelled out, words take several times the memory of their hashes
        found = written(_exact_counts(texts, sent, longest, most // 4).where((F.col("n") >= least) | (F.col("k") == 0)), "phrases")
    sent.destroy()
    return found


def _score() -> Column:
    """floor(1000000 * a * a / (l * r)) in whole numbers of up to 38 digits; counts have up to 15."""
    a, left, right = (f"CAST({c} AS DECIMAL(15, 0))" for c in ("a", "l", "r"))
    return F.expr(f"(CAST(1000000 AS DECIMAL(7, 0)) * ({a} * {a})) div ({left} * {right})")


def scored(counts: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(lang, phrase, k, a, l, r, score) of the phrases of two words or more, by their lowest-scoring cut."""
    part = lambda cut: F.struct(F.lit(cut).alias("cut"), F.substring_index("phrase", " ", cut).alias("head"), F.expr(f"substring_index(phrase, ' ', {cut} - k)").alias("tail"))
    cuts = F.array(*[F.when(F.col("k") > cut, part(cut)) for cut in range(1, longest)])
    rows = counts.where("k > 1").select("lang", "phrase", "k", F.col("n").alias("a"), F.explode(F.array_compact(cuts)).alias("c")).select("lang", "phrase", "k", "a", "c.*")
    known = counts.where("k > 0")
    left = known.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l"))
    right = known.select("lang", F.col("phrase").alias("tail"), F.col("n").alias("r"))
    found = rows.join(left, ["lang", "head"]).join(right, ["lang", "tail"])
    best = F.min(F.struct(_score().alias("score"), "cut", "l", "r")).alias("best")
    return found.groupBy("lang", "phrase", "k", "a").agg(best).select("lang", "phrase", "k", "a", "best.l", "best.r", "best.score")


def uncovered(counts: DataFrame, covered: int = COVERED) -> DataFrame:
    """(lang, phrase) of the phrases that no longer one makes up covered percent of.

    Of the phrases that hold another one those of one more word occur most often, so they alone decide.
    """
    inner = F.array(F.expr("substring_index(phrase, ' ', k - 1)"), F.expr("substring_index(phrase, ' ', 1 - k)"))
    longer = counts.where("k > 2").select("lang", F.explode(inner).alias("phrase"), "n").groupBy("lang", "phrase").agg(F.max("n").alias("more"))
    own = counts.where("k > 1").join(longer, ["lang", "phrase"], "left")
    return own.where(F.col("more").isNull() | (100 * F.col("more") < covered * F.col("n"))).select("lang", "phrase")


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, longest: int = LONGEST, top: int = TOP, covered: int = COVERED, shards: int = SHARDS, table_bits: int = TABLE_BITS, most: int = MOST_HELD) -> DataFrame:
    """The first top phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Phrases have 2 to longest words of one piece and occur least times (a); l and r are the occurrences of the two parts
    at the cut that scores lowest, n those of all words of the language. Phrases that a longer one covers are dropped.
    They are ordered by score, then a, both descending, then by their bytes. Null languages are `und`; null and empty
    texts have no words; rows that repeat count each. Other columns of docs are not read. An empty table gives an empty
    result.
    """
    counts = phrase_counts(docs, lang_col, text_col, least, longest, shards, table_bits, most)
    found = scored(counts, longest).join(uncovered(counts, covered), ["lang", "phrase"], "left_semi")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # ranked in parts first, so that no task sorts all phrases of a language
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS)).alias("part")
    some = found.select("*", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    total = counts.where("k = 0").select("lang", F.col("n").alias("n"))
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
