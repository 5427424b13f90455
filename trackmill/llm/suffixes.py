"""Suffix-array dedup by prefix-free parsing: bytes of repeated passages, whatever their length or place.

Texts are cut into phrases at rolling-hash triggers, so that equal passages are cut alike wherever they stand. A phrase
overlaps the next one by a string of the length looked for, less one byte, so each such string lies in just one phrase.
The dictionary holds each different phrase once, the parse says which documents hold it where. The beginning of every
suffix, as far as it matters, lies inside one phrase: in corpus order suffixes with equal beginnings are neighbours,
those of one phrase through its places in the parse, those of different phrases in the dictionary's suffix order. Most
of the dictionary's suffixes have no such neighbour. So its suffixes are sorted sparsely first, at anchors (each string
has one, the least rolling hash in it), and in full only around anchors that two phrases share. Both orders are Spark
shuffles by the suffixes' beginnings, which put equal ones together; no order of unequal ones is needed. Suffixes that
run in parallel go as one: those around an anchor, then those of an eighth of the length, are told apart singly only
where different strings hold them. In the end documents take from the parse what each phrase, and each suffix in it,
says of earlier documents.

On large inputs the steps go by slices, one after the other, so that the disk holds a part of their shuffles at a time:
what depends on anchors by their hashes, what depends on texts by their ids.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackmill.llm.common import discard, few, joins_by_hash, written

#: Bytes of a repeated passage at least; anchors of which one is a trigger; bytes that an anchor compares.
LENGTH, TRIGGER, ANCHOR = 50, 4, 20
#: Neighbouring suffixes that go as one before they are told apart.
TOGETHER = 8
#: Numbers (of 8 to 24 bytes) that are broadcast at most; more of them take a shuffle.
MOST_BROADCAST = 2_000_000
#: Slices at most, and the phrases of the parse that make one.
SLICES, SLICE = 4, 8_000_000
#: Windows that are hashed at once: memory for a text of any length.
BLOCK = 1 << 18
#: Constants of the rolling hash (odd) and of its finisher.
BASE, FINISH = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
#: The bits of an anchor's hash that are kept; the others are zero, which compresses.
KEPT = np.uint64(0xFFFF_FFFF_FFFF_0000)


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse modulo 2**64, for i below n."""
    out = []
    for base in (BASE, pow(BASE, -1, 1 << 64)):
        steps = np.full(n, base, dtype=np.uint64)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps))
    return out[0], out[1]


def _finish(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(FINISH)
    return h ^ (h >> np.uint64(29))


def _rolling(sums: np.ndarray, inverse: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all windows of width bytes, from the running sums of a block."""
    return _finish((sums[width:] - sums[:-width]) * inverse[: len(sums) - width])


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while done * 2 <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    return x if done == width else np.minimum(x[: len(x) - (width - done)], x[width - done :])


def _blocks(data: bytes, length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first window, running sums, inverse powers) of the text's blocks of windows."""
    powers, inverse = _powers(BLOCK + length)
    windows = len(data) - length + 1
    for first in range(0, windows, BLOCK):
        part = np.frombuffer(data, np.uint8, min(BLOCK, windows - first) + length - 1, first).astype(np.uint64)
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum((part + np.uint64(1)) * powers[: len(part)], out=sums[1:])
        yield first, sums, inverse


def parsed(data: bytes, length: int = LENGTH, trigger: int = TRIGGER, width: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """A text's runs of windows, by first window, anchor's hash and place, and its phrases, by start, end and first run.

    A window is a string of length bytes. Its anchor is its least hash over width bytes, the first of equals, so equal
    windows have equal anchors. A run is the windows of one anchor; a phrase begins with the first run, and with each
    later one whose anchor's hash is a trigger. Of hashes 45 bits are compared and the place breaks ties.
    """
    low, starts, cores, places, last = np.uint64((1 << 19) - 1), [np.empty(0, np.int64)], [np.empty(0, np.uint64)], [np.empty(0, np.int64)], -1
    for first, sums, inverse in _blocks(data, length):
        hashes = _rolling(sums, inverse, width)
        least = _sliding_min((hashes & ~low) | np.arange(len(hashes), dtype=np.uint64), length - width + 1)
        own = (least & low).astype(np.int64)
        cut = np.empty(len(own), dtype=bool)
        cut[0], cut[1:] = own[0] + first != last, own[1:] != own[:-1]
        last = own[-1] + first
        at = np.flatnonzero(cut)
        starts.append(at + first)
        cores.append(hashes[own[at]])
        places.append(own[at] + first)
    starts, cores, places = np.concatenate(starts), np.concatenate(cores), np.concatenate(places)
    runs = np.flatnonzero((cores >> np.uint64(24)) % np.uint64(trigger) == 0)
    if len(starts):
        runs = np.concatenate([[0], runs[runs > 0]])
    begin = starts[runs]
    end = np.append(begin[1:] + length - 1, len(data)) if len(begin) else begin
    return starts, (cores & KEPT).view(np.int64), places, begin, end, runs


def names(data: bytes, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """128-bit hashes of the strings from begin to end, as pairs of integers."""
    digests = b"".join(xxhash.xxh3_128_digest(data[a:b]) for a, b in zip(begin.tolist(), end.tolist(), strict=True))
    return np.frombuffer(digests, "<i8").reshape(-1, 2)


def phrases(data: bytes, length: int = LENGTH, trigger: int = TRIGGER) -> list[np.ndarray]:
    """The start, size and name (in two parts) of each phrase of a text, its number of runs; and all runs' anchors' hashes."""
    starts, cores, _, begin, end, runs = parsed(data, length, trigger)
    found = names(data, begin, end)
    return [begin, end - begin, found[:, 0], found[:, 1], np.diff(np.append(runs, len(starts))), cores]


def chosen_runs(data: bytes, wanted: np.ndarray, cores: np.ndarray, length: int = LENGTH, trigger: int = TRIGGER) -> tuple:
    """The runs of a text's wanted phrases, given by their starts, as far as their anchors' hashes are among the cores.

    Of each run: number of the phrase in wanted, first window in the phrase, anchor's place in the run, hash, string.
    """
    starts, own, places, begin, _, runs = parsed(data, length, trigger)
    stop = np.append(starts[1:], len(data) - length + 1)
    k = np.searchsorted(begin, wanted)
    n = np.append(runs[1:], len(starts))[k] - runs[k]
    number = np.repeat(np.arange(len(wanted)), n)
    at = np.arange(len(number)) + np.repeat(runs[k] - (np.cumsum(n) - n), n)
    known = np.append(np.sort(cores), np.iinfo(np.int64).max)  # no core is that number
    keep = known[np.searchsorted(known, own[at])] == own[at]
    number, at = number[keep], at[keep]
    strings = [data[a:b] for a, b in zip(starts[at].tolist(), (stop[at] - 1 + length).tolist(), strict=True)]
    return number, starts[at] - wanted[number], places[at] - starts[at], own[at], strings


def merged(spans: np.ndarray) -> np.ndarray:
    """Half-open spans (n, 2) as disjoint ones in order; touching ones become one."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.ones(len(spans), dtype=bool)
    new[1:] = spans[1:, 0] > reach[:-1]
    at = np.flatnonzero(new)
    return np.stack([spans[at, 0], reach[np.append(at[1:], len(spans)) - 1]], axis=1)


_INT, _LONG = T.IntegerType(), T.LongType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_PHRASES = T.ArrayType(_struct(start=_INT, size=_INT, h1=_LONG, h2=_LONG, cores=T.ArrayType(_LONG)))
_RUNS = T.ArrayType(_struct(number=_INT, at=_INT, anchor=_INT, core=_LONG, s=T.BinaryType()))
_DIGEST = _struct(n_removed=_LONG, n_spans=_LONG, kept_sha256=T.StringType())
_SPANS = T.ArrayType(_struct(a=_INT, b=_INT))


def _data(text: pa.Scalar) -> bytes:
    return (text.as_py() or "").encode()


def _ends(sizes: list[int] | np.ndarray) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())


def _parse(length: int, trigger: int):
    @F.arrow_udf(_PHRASES)
    def parse(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            found = [phrases(_data(x), length, trigger) for x in batch] or [phrases(b"")]
            start, size, h1, h2, n, cores = (np.concatenate(x) for x in zip(*found, strict=True))
            columns = [pa.array(start, pa.int64()).cast(pa.int32()), pa.array(size, pa.int64()).cast(pa.int32()), pa.array(h1), pa.array(h2), pa.ListArray.from_arrays(_ends(n), pa.array(cores))]
            rows = pa.StructArray.from_arrays(columns, [f.name for f in _PHRASES.elementType.fields])
            yield pa.ListArray.from_arrays(_ends([len(x[0]) for x in found[: len(batch)]]), rows)

    return parse


def _runs(length: int, trigger: int):
    """The runs of the phrases that are given with a text, by their starts, around the cores that are given with these."""

    @F.arrow_udf(_RUNS)
    def runs(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, wanted in parts:
            starts, lists = wanted.values.field("start").to_numpy().astype(np.int64), wanted.values.field("cores")
            cores, ends, of = lists.values.to_numpy(), lists.offsets.to_numpy(), wanted.offsets.to_numpy()
            found = [chosen_runs(_data(x), starts[a:b], cores[ends[a] : ends[b]], length, trigger) for x, a, b in zip(texts, of[:-1].tolist(), of[1:].tolist(), strict=True)]
            number, at, anchor, core = (np.concatenate([np.empty(0, np.int64), *x]) for x in list(zip(*found, strict=True))[:4] or [()] * 4)
            columns = [*(pa.array(x, pa.int64()).cast(pa.int32()) for x in (number, at, anchor)), pa.array(core), pa.array([s for x in found for s in x[4]], pa.binary())]
            rows = pa.StructArray.from_arrays(columns, [f.name for f in _RUNS.elementType.fields])
            yield pa.ListArray.from_arrays(_ends([len(x[0]) for x in found]), rows)

    return runs


@F.arrow_udf(_DIGEST)
def _digests(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """What is left of each text without its spans."""
    for texts, spans in parts:
        out = []
        for text, own in zip(texts, spans, strict=True):
            data, gone = _data(text), merged(_pairs(own)) if own.is_valid and len(own) else np.empty((0, 2), np.int64)
            kept, last = hashlib.sha256(), 0
            for a, b in gone.tolist():
                kept.update(data[last:a])
                last = b
            kept.update(data[last:])
            out.append((int((gone[:, 1] - gone[:, 0]).sum()), len(gone), kept.hexdigest()))
        n = zip(*out, strict=True) if out else ((), (), ())
        yield pa.StructArray.from_arrays([pa.array(list(x), t) for x, t in zip(n, (pa.int64(), pa.int64(), pa.string()), strict=True)], ["n_removed", "n_spans", "kept_sha256"])


def _pairs(own: pa.ListScalar) -> np.ndarray:
    values = own.values
    return np.stack([values.field("a").to_numpy(), values.field("b").to_numpy()], axis=1).astype(np.int64)


def _slices(key: Column | str, n: int) -> list[Column]:
    """Conditions that deal rows out to n slices by a key; their hash isn't the one that shuffles go by."""
    return [F.pmod(F.xxhash64(key), F.lit(n)) == k for k in range(n)] if n > 1 else [F.lit(True)]


def _earlier(a: Column | str, b: Column | str) -> Column:
    """Whether id a comes before id b; null ids come last and are level with one another."""
    a, b = (F.col(c) if isinstance(c, str) else c for c in (a, b))
    return a.isNotNull() & (b.isNull() | (a < b))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, trigger: int = TRIGGER) -> DataFrame:
    """(id, t, spans): for texts with repeats the byte ranges (a, b) that stand in documents with smaller ids.

    Ranges may overlap. t tells the texts of one id apart, by a 64-bit hash.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("t"), F.col(text_col).alias("text")).where(F.octet_length(F.col(text_col)) >= length)
    parse = texts.select("id", "t", F.explode(_parse(length, trigger)(F.col("text"))).alias("p")).select("id", "t", "p.*")
    parse = written(parse, "parse", "zstd")
    n = min(SLICES, 1 + parse.count() // SLICE)
    mixed = _mixed_phrases(parse, n)
    wide, parse = parse, written(parse.drop("cores"), "parse-narrow", "zstd")
    discard(wide)
    rows = _mixed_runs(texts, parse, mixed, length, trigger, n)
    discard(mixed)
    inside = [_inside(reduce(DataFrame.unionByName, rows).where(own), length) for own in _slices("core", n)]
    discard(*rows)
    several = parse.groupBy("h1", "h2").agg(*_ids("id")).where(SEVERAL).select("h1", "h2", F.col("first").alias("low"))
    ranges = reduce(DataFrame.unionByName, inside).groupBy("h1", "h2").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))
    known = written(several.join(ranges, ["h1", "h2"], "full"), "known", "zstd")
    discard(*inside)
    whole = F.array(F.struct(F.col("start").alias("a"), (F.col("start") + F.col("size")).alias("b")))
    parts = F.transform("ranges", lambda r: F.struct((F.col("start") + r["at"]).alias("a"), (F.col("start") + r["at"] + r["n"] - 1 + length).alias("b")))
    out = []
    for own in _slices("id", n):
        found = parse.where(own).join(known, ["h1", "h2"]).select("id", "t", F.when(_earlier("low", "id"), whole).otherwise(parts).alias("spans")).where("spans IS NOT NULL")
        out.append(written(found.groupBy("id", "t").agg(F.flatten(F.collect_list("spans")).cast(_SPANS).alias("spans")), "spans"))
    discard(parse, known)
    return reduce(DataFrame.unionByName, out)


def _mixed_phrases(parse: DataFrame, n: int) -> DataFrame:
    """(h1, cores): of each phrase the anchors that other phrases hold too, found in n slices of anchors."""
    anchors, out = parse.select("h1", F.explode("cores").alias("core")), []
    for own in _slices("core", n):
        cores = anchors.where(own).groupBy("core").agg(F.min("h1").alias("lo"), F.max("h1").alias("hi"))
        cores = written(cores.where("lo != hi").select("core"), "cores-shared")
        out.append(written(anchors.where(own).join(few(cores, MOST_BROADCAST), "core", "left_semi").distinct(), "anchors-mixed"))
        discard(cores)
    mixed = written(reduce(DataFrame.unionByName, out).groupBy("h1").agg(F.collect_list("core").alias("cores")), "phrases-mixed")
    discard(*out)
    return mixed


def _mixed_runs(texts: DataFrame, parse: DataFrame, mixed: DataFrame, length: int, trigger: int, n: int) -> list[DataFrame]:
    """(h1, h2, id, at, anchor, core, s): the runs around shared anchors of each different phrase, with its first id.

    A table for each of n slices of texts.
    """
    wanted = parse.join(mixed.select("h1"), "h1", "left_semi").groupBy("h1", "h2").agg(F.min("id").alias("low"), F.min(F.struct("t", "start", "id")).alias("host"))
    wanted = written(wanted.select("h1", "h2", "low", "host.*"), "phrases-wanted")
    asked = wanted.join(mixed, "h1").groupBy(F.col("id").alias("host_id"), F.col("t").alias("host_t")).agg(F.collect_list(F.struct("start", "h1", "h2", "low", "cores")).alias("wanted"))
    asked = written(asked, "phrases-asked")
    discard(wanted)
    needed = F.transform("wanted", lambda p: F.struct(p["start"].alias("start"), p["cores"].alias("cores")))
    phrase, out = F.get("wanted", F.col("r.number")), []
    for here, there in zip(_slices("id", n), _slices("host_id", n), strict=True):
        hosts = texts.where(here).join(asked.where(there), F.col("id").eqNullSafe(F.col("host_id")) & (F.col("t") == F.col("host_t")))
        rows = hosts.select("wanted", F.explode(_runs(length, trigger)(F.col("text"), needed)).alias("r"))
        out.append(written(rows.select(phrase["h1"].alias("h1"), phrase["h2"].alias("h2"), phrase["low"].alias("id"), "r.at", "r.anchor", "r.core", "r.s"), "runs-mixed", "zstd"))
    discard(asked)
    return out


def _ids(id_col: str) -> list[Column]:
    """The first and last of some ids, and whether one is null."""
    return [F.min(id_col).alias("first"), F.max(id_col).alias("last"), F.bool_or(F.col(id_col).isNull()).alias("none")]


#: Of what _ids gives: whether the ids are of several places.
SEVERAL = "first IS NOT NULL AND (first < last OR none)"


def _inside(rows: DataFrame, length: int) -> DataFrame:
    """(h1, h2, ranges): the windows (at, n) of a phrase that stand, in other phrases, before the phrase does itself.

    Three times different strings are formed with the first id of each: runs of windows, parts of runs, windows. The
    next ones are formed only of strings that share what is common to all their windows with a different string. Runs
    go by their MD5 hash, as they are long.
    """
    named = rows.withColumn("x", F.unhex(F.md5("s")))
    windows = F.octet_length("s") - (length - 1)
    runs = written(named.groupBy("core", "anchor", "s", "x").agg(*_ids("id")), "runs", "zstd")
    several = runs.groupBy("core").agg(F.count("*").alias("n")).where("n > 1").select("core")
    # a window's anchor lies o bytes after its start; a part has the windows of TOGETHER neighbouring o
    least, most = (F.floor(o / TOGETHER).cast("int") for o in (F.greatest(F.col("anchor") - windows + 1, F.lit(0)), F.col("anchor")))
    several = written(several, "cores-several")
    cut = runs.join(few(several, MOST_BROADCAST), "core", "left_semi").select("x", F.col("first").alias("low"), "s", "anchor", windows.alias("windows"), F.explode(F.sequence(least, most)).alias("j"))
    begin = F.greatest(F.lit(0), F.col("anchor") - (F.col("j") + 1) * TOGETHER + 1)
    cut = cut.withColumn("i", begin).withColumn("n", F.least(F.col("windows") - 1, F.col("anchor") - F.col("j") * TOGETHER) - F.col("i") + 1)
    common = F.substring(F.col("s"), F.col("anchor") - F.col("j") * TOGETHER + 1, F.lit(length - TOGETHER + 1))
    cut = cut.select("x", "low", "i", "n", F.substring(F.col("s"), F.col("i") + 1, F.col("n") + length - 1).alias("part"), F.xxhash64("j", common).alias("common"))
    told = cut.select("common", "low", F.xxhash64("part").alias("y"), F.xxhash64(F.lit("part"), "part").alias("z")).groupBy("common")
    told = told.agg(*_ids("low"), (F.min("y") != F.max("y")).alias("y"), (F.min("z") != F.max("z")).alias("z"))
    told = written(told.where(f"y OR z OR {SEVERAL}").select("common", "first", F.expr("y OR z").alias("mixed")), "parts-common")
    parts = written(cut.join(few(told, MOST_BROADCAST), "common").select("x", "low", "i", "n", F.when(F.col("mixed"), F.col("part")).alias("part"), "first"), "parts")
    discard(several, told)
    single = parts.where("part IS NOT NULL").groupBy("part").agg(F.min("low").alias("low"))
    single = written(single.withColumn("i", F.explode(F.sequence(F.lit(0), F.octet_length("part") - length))).withColumn("w", F.substring(F.col("part"), F.col("i") + 1, F.lit(length))), "windows")
    # written, so that the join deals both sides anew and can split a window that very many parts share
    firsts = written(single.groupBy("w").agg(*_ids("low")).where(SEVERAL).select("w", "first"), "windows-first")
    ahead = single.join(firsts, "w").where(_earlier("first", "low")).groupBy("part").agg(F.collect_list("i").alias("ahead"))
    own = written(single.groupBy("part").agg(F.min("low").alias("first")).join(ahead, "part", "left"), "parts-first")
    discard(single, firsts)
    whole = F.when(_earlier("first", "low"), F.array(F.struct("i", "n")))
    some = F.transform("ahead", lambda x: F.struct((F.col("i") + x).cast("int").alias("i"), F.lit(1).alias("n")))
    marks = parts.where("part IS NULL").select("x", whole.alias("marks"))
    marks = marks.unionByName(parts.drop("first").join(own, "part").select("x", F.coalesce(whole, some).alias("marks"))).where("marks IS NOT NULL")
    marks = marks.groupBy("x").agg(F.flatten(F.collect_list("marks")).alias("marks"))
    ahead = runs.select("x", "first", "last", "none").join(marks, "x", "left").where(f"marks IS NOT NULL OR {SEVERAL}").select("x", "first", "marks")
    ahead = written(ahead, "runs-first")
    discard(runs, parts, own)
    whole = F.when(_earlier("first", "id"), F.array(F.struct("at", F.col("windows").alias("n"))))
    some = F.transform("marks", lambda m: F.struct((F.col("at") + m["i"]).alias("at"), m["n"].alias("n")))
    found = named.select("h1", "h2", "id", "at", "x", windows.alias("windows")).join(ahead, "x").select("h1", "h2", F.coalesce(whole, some).alias("ranges")).where("ranges IS NOT NULL")
    found = written(found.groupBy("h1", "h2").agg(F.flatten(F.collect_list("ranges")).alias("ranges")), "inside")
    discard(ahead)
    return found


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, trigger: int = TRIGGER) -> DataFrame:
    """One row per row of docs: id_col, n_bytes, n_removed, n_spans, kept_sha256.

    A byte goes if it lies in a string of length bytes that also starts in a document with a smaller id; texts are their
    UTF-8 bytes, strings don't cross texts and overlap freely, and all are judged on the texts as they came. n_spans
    counts the maximal removed runs. Null ids come after all others and are level with one another; rows of one id, be
    they repeats or different texts, don't take from each other. Null and empty texts have no bytes. Other columns of
    docs are not read. An empty table gives an empty result. Phrases are told apart by 128-bit hashes, strings inside them
    by their bytes.
    """
    with joins_by_hash(docs.sparkSession):
        found = repeated_spans(docs, id_col, text_col, length, trigger).withColumnsRenamed({"id": "gone_id", "t": "gone_t"})
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("t"))
    rows = rows.join(found, F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("t") == F.col("gone_t")), "left")
    out = rows.select("id", F.octet_length("text").cast("long").alias("n_bytes"), _digests(F.col("text"), F.col("spans")).alias("d"))
    return out.select(F.col("id").alias(id_col), "n_bytes", "d.*")
