"""Near copies at a stated similarity: SimHash links, completed by an exact prefix join on word shingles.

Three of 64 bits is far stricter than 4/5 Jaccard similarity of five-word shingles, and a bit budget that reaches it
(13 or more) would leave segments of 9 bits, under which variants no longer tell texts apart. So fingerprints link what
they can, and the rest is found exactly: two sets of at least 4/5 similarity share a shingle among the first fifth of
each in any one order of all shingles, so only those are dealt out. Common shingles come last in that order; which ones
they are is estimated on a part of the texts, as the order alone depends on it. Texts that meet are verified on their
whole sets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackmill.llm.common import cleaned_up, connected_components, discard, few, one_row_each, written
from trackmill.llm.simhash import _LOWER, fingerprint_links, majority

#: Words of a shingle, of fingerprints too, and the least similarity of near copies as a fraction.
WIDTH, LEAST, OF = 5, 4, 5
#: Two sets of n and m are similar if (OF + LEAST) times what they don't share is at most n + m, as OF - LEAST is 1.
OF_BOTH = OF + LEAST
#: Of how many texts one is looked at for common shingles, and the shingles (8 bytes each) that come last at most.
ONE_OF, MOST_COMMON = 32, 500_000
#: Bits in which fingerprints may differ for a pair to be looked at before all others.
CLOSE = 16
#: Texts under one shingle beyond which they are compared by what sets them apart from one of them.
HEAVY = 64
#: Text numbers (8 bytes each) that are broadcast at most.
MOST_BROADCAST = 500_000
#: Members of sets that pairs carry at once at least, 32 MB of whole hashes; beyond, half as many as the sets have.
MOVED = 4_000_000
#: Numbers that texts may go by; the first that proves free of collisions on the texts at hand is used.
SEEDS = (0, 1, 2, 3)


def hashed(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Hashes of the word shingles in order, repeats included; a text of fewer words has one, one without words none."""
    words = (text or "").encode("utf-8", "replace").translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    own = np.array(list(map(xxhash.xxh64_intdigest, words)), dtype=np.uint64)
    width = min(width, len(own))
    n = len(own) - width + 1
    out = np.full(n, width, np.uint64)
    for i in range(width):
        out = out * _FACTOR + own[i : i + n]
    out = (out ^ (out >> np.uint64(32))) * _FACTOR
    return (out ^ (out >> np.uint64(29))) * _FACTOR


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Distinct hashes of the word shingles in ascending order."""
    return np.unique(hashed(text, width).view(np.int64))


_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _lists(found: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, found)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *found]), pa.int64()))


@F.arrow_udf(T.ArrayType(T.LongType()))
def _sets(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in texts:
        yield _lists([shingles(x.as_py()) for x in batch])


@F.arrow_udf(T.StructType([T.StructField("n", T.IntegerType()), T.StructField("set", T.ArrayType(T.IntegerType()))]))
def _halves(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The number of shingles, and the distinct upper halves of their hashes."""
    for batch in texts:
        found = [shingles(x.as_py()) for x in batch]
        halves = [np.unique((x >> 32).astype(np.int32)) for x in found]
        ends = np.cumsum([0, *map(len, halves)])
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int32), *halves]), pa.int32()))
        yield pa.StructArray.from_arrays([pa.array(list(map(len, found)), pa.int32()), lists], ["n", "set"])


def _prefixes(docs: DataFrame, common: np.ndarray):
    sent = docs.sparkSession.sparkContext.broadcast(common)  # MOST_COMMON numbers at most

    @F.arrow_udf(T.StructType([T.StructField("fp", T.LongType()), T.StructField("n", T.IntegerType()), T.StructField("first", T.ArrayType(T.LongType()))]))
    def prefixes(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        last = sent.value
        for batch in texts:
            prints, sizes, firsts = [], [], []
            for x in batch:
                each = hashed(x.as_py())
                found = np.unique(each.view(np.int64))
                late = last[np.searchsorted(last, found) - (found > last[-1])] == found if len(last) else np.zeros(len(found), bool)
                n = len(found)
                prints.append(majority(each))
                sizes.append(n)
                firsts.append(np.concatenate([found[~late], found[late]])[: n + LEAST * n // -OF + 1 if n else 0])
            yield pa.StructArray.from_arrays([pa.array(prints, pa.int64()), pa.array(sizes, pa.int32()), _lists(firsts)], ["fp", "n", "first"])

    return prefixes


def _common(texts: DataFrame, one_of: int) -> np.ndarray:
    part = texts.where(F.pmod(F.xxhash64("text"), F.lit(one_of)) == 0)
    counted = part.select(F.explode(_sets("text")).alias("key")).groupBy("key").count().where("count > 1")
    most = written(counted.orderBy(F.desc("count"), "key").limit(MOST_COMMON).select("key"), "common")
    return np.sort(most.toArrow().column("key").to_numpy())


def _similar(both: Column, n: Column, m: Column) -> Column:
    return both * OF >= (n + m - both) * LEAST


def _possible(n: Column, at: Column, m: Column, at_m: Column) -> Column:
    """Whether sizes, and places of the first shingle two sets share, leave them a chance; it holds there if they are similar."""
    sizes = F.least(n, m) * OF >= F.greatest(n, m) * LEAST
    return sizes & (F.least(n - at, m - at_m) * (LEAST + OF) >= (n + m) * LEAST)


def _candidates(meetings: DataFrame) -> DataFrame:
    """(a, b) of meetings(a, b, n, m, at, at_m), a row per shared shingle of two sets' firsts, that may be similar.

    What two sets share is at most what they were seen to share and what follows the last of it.
    """
    seen = meetings.groupBy("a", "b").agg(F.count("*").alias("k"), F.max("n").alias("n"), F.max("m").alias("m"), F.max("at").alias("at"), F.max("at_m").alias("at_m"))
    most = F.col("k") + F.least(F.col("n") - F.col("at"), F.col("m") - F.col("at_m")) - 1
    return seen.where(most * (LEAST + OF) >= (F.col("n") + F.col("m")) * LEAST).select("a", "b")


def number(text: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.coalesce(text, F.lit("")))


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of the written pairs(a, b) whose whole sets are similar; texts(node, text) has their texts.

    Halves of the hashes, which move half the bytes, rule most pairs out; the others are compared by the whole hashes.
    """
    near = _compared(pairs, texts, True)
    found = _compared(near, texts, False)
    discard(near)
    return found


def _joined(pairs: DataFrame, left: DataFrame, right: DataFrame, shares: int | None = None) -> Iterator[DataFrame]:
    """The written pairs with what left(…, a, x) and right(…, b, y) have for them, in shares to be written one by one.

    A pair carries a whole set, and a text of very many pairs is carried as often. In each share pairs carry about half
    as many members as left's sets have, so the shuffles take no more disk than a few times these, however many pairs
    there are; shares grow with the pairs by text, not with the texts.
    """
    on_a, on_b = ([c for c in pairs.columns if c in side.columns] for side in (left, right))
    if shares is None:
        sizes = left.select(*on_a, F.size("x").cast("long").alias("size"))
        with cleaned_up(pairs.sparkSession):
            held, moved = (sizes.agg(F.sum("size")).first()[0] or 0), (pairs.join(sizes, on_a).agg(F.sum("size")).first()[0] or 0)
        shares = max(1, -(-moved // max(MOVED, held // 2)))
    if shares == 1:
        yield pairs.join(left, on_a).join(right, on_b)
        return
    for i in range(shares):
        part = few(written(pairs.where(F.pmod(F.xxhash64("a", "b"), F.lit(shares)) == i), "share"), MOST_BROADCAST)
        # the pairs, not the sets, are sent to where these are
        yield part.join(left, on_a).join(right.join(part.select(*on_b).distinct(), on_b, "left_semi"), on_b)
        discard(part)


def _written_pairs(shares: Iterator[DataFrame], where: Column) -> DataFrame:
    """(a, b) of the pairs that where holds for, share by share."""
    parts = [written(x.where(where).select("a", "b"), "similar-share") for x in shares]
    if len(parts) == 1:
        return parts[0]
    found = written(reduce(DataFrame.unionByName, parts), "similar")
    discard(*parts)
    return found


def _compared(pairs: DataFrame, texts: DataFrame, halves: bool) -> DataFrame:
    flags = F.explode(F.array(F.struct(F.col("a").alias("met"), F.lit(True).alias("is_a")), F.struct(F.col("b").alias("met"), F.lit(False).alias("is_a"))))
    met = pairs.select(flags.alias("x")).select("x.*").groupBy("met").agg(F.bool_or("is_a").alias("is_a"), F.bool_or(~F.col("is_a")).alias("is_b"))
    met = written(met, "met")
    side = F.broadcast(met) if met.count() <= MOST_BROADCAST else met
    chosen = texts.join(side, F.col("node") == F.col("met")).drop("met").dropDuplicates(["node"])
    if halves:
        sets = chosen.select("node", "is_a", "is_b", _halves("text").alias("x")).select("node", "is_a", "is_b", "x.n", "x.set")
    else:
        sets = chosen.select("node", "is_a", "is_b", _sets("text").alias("set")).withColumn("n", F.size("set"))
    sets = written(sets, "sets")
    left = sets.where("is_a").select(F.col("node").alias("a"), F.col("n"), F.col("set").alias("x"))
    right = sets.where("is_b").select(F.col("node").alias("b"), F.col("n").alias("m"), F.col("set").alias("y"))
    # shingles whose halves are equal count once, so that many more may be shared
    both = F.size(F.array_intersect("x", "y")) + F.col("n") - F.size("x") + F.col("m") - F.size("y")
    found = _written_pairs(_joined(pairs, left, right), _similar(both, F.col("n"), F.col("m")))
    discard(met, sets)
    return found


def _apart(rows: DataFrame, links: DataFrame) -> DataFrame:
    """rows(key, node, n, at) with part, the component of each node over links; only keys that several parts hold."""
    parts = written(connected_components(links), "parts")
    named = rows.select("key", "node", "n", "at").join(parts, "node", "left")
    named = written(named.select("key", "node", "n", "at", F.coalesce("component", "node").alias("part")), "parted")
    several = written(named.groupBy("key").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo != hi").select("key"), "several")
    found = written(named.join(several, "key", "left_semi"), "apart")
    discard(parts, named, several)
    return found


def _chance(x: Callable[[str], Column], y: Callable[[str], Column]) -> Column:
    """Whether two of apart-firsts of one key can be similar if that is the first shingle they share.

    What they share is then this one and, at most, what follows it; of similar ones the first shared one says so.
    """
    needed = F.ceil((x("score") + y("score")) / (2 * OF_BOTH))
    open_yet = (x("part") != y("part")) & (x("hub") != y("hub")) & (x("score") + y("score") > 0)
    return open_yet & (F.least(x("s") - x("at"), y("s") - y("at")) >= needed)


def _pivoted(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b): links that connect the similar ones of the texts that rows(key, node, part) has under one key, where those are very many.

    Such texts have most in common, so a shingle tells nothing; what sets each apart from the key's pivot, the text that
    has the most such keys for its size, does. With d shingles set apart, of n in all, two texts are similar if and only
    if d + d' less twice what the two have in common of these is at most (n + n') / 9. So they are joined on these, the
    rarest first, and only as many as leave too few for the rest; with 9 d - n of at most 0 together they are similar at
    any rate, and all such are linked to the text of the least 9 d - n. Two texts meet only under shingles that can be
    the first they share, and are compared only if what they were seen to have in common and what follows the last of it
    suffices.

    The texts under a shingle are first compared with the one of least 9 d - n alone. Each text's hub is the part of the
    least text it was linked to, so texts of one hub are connected and don't meet again.
    """
    central = rows.groupBy("node").agg((F.count("*") / F.max("n")).alias("keys"))
    pivots = written(rows.join(central, "node").groupBy("key").agg(F.max_by("node", F.struct("keys", "node")).alias("pivot")), "pivots")
    pairs = written(rows.join(pivots, "key").select("pivot", "node", "part").distinct(), "pivot-pairs")
    met = written(pairs.select(F.explode(F.array("pivot", "node")).alias("met")).distinct(), "met")
    side = F.broadcast(met) if met.count() <= MOST_BROADCAST else met
    sets = texts.join(side, F.col("node") == F.col("met"), "left_semi").dropDuplicates(["node"])
    sets = written(sets.select("node", _sets("text").alias("set")), "sets")
    apart = pairs.join(sets.select(F.col("node").alias("pivot"), F.col("set").alias("x")), "pivot").join(sets.withColumnRenamed("set", "y"), "node")
    apart = apart.withColumn("own", F.concat(F.array_except("x", "y"), F.array_except("y", "x"))).withColumn("score", OF_BOTH * F.size("own") - F.size("y"))
    # i, a small number for the two, is what pairs are made of
    apart = written(apart.select("pivot", "node", "part", "own", "score", F.monotonically_increasing_id().alias("i")), "apart-sets")
    # the pivot itself is among its texts, with nothing to set it apart
    best = apart.groupBy("pivot").agg(F.min_by(F.struct("node", "part"), F.struct("score", "node")).alias("best"), F.min("score").alias("least"))
    best = written(best.select("pivot", F.col("best.node").alias("best"), F.col("best.part").alias("best_part"), "least"), "nearest")
    is_sure = F.col("score") + F.col("least") <= 0
    scored = apart.join(best, "pivot").withColumn("hub", F.when(is_sure, F.col("best_part")).otherwise(F.col("part")))
    sure = scored.where(is_sure & (F.col("node") != F.col("best"))).select(F.col("best").alias("a"), F.col("node").alias("b"))
    entries = apart.select("pivot", "i", F.explode("own").alias("key"))
    often = written(entries.groupBy("pivot", "key").agg(F.count("*").alias("often")).where("often > 1"), "often")
    # a set's shingles that no other set has come first and need no entry
    ranked = entries.join(often, ["pivot", "key"]).groupBy("i").agg(F.array_sort(F.collect_list(F.struct("often", "key"))).alias("shared"))
    looked = F.size("shared") - F.greatest(F.lit(1), F.ceil((F.col("score") + F.col("least")) / (2 * OF_BOTH))) + 1
    first = scored.join(ranked, "i").where(looked > 0)
    first = first.select("pivot", "i", "part", "hub", is_sure.alias("sure"), "score", F.size("own").alias("d"), F.size("shared").alias("s"), F.posexplode(F.slice("shared", 1, looked.cast("int"))).alias("at", "x"))
    first = written(first.select("pivot", "i", "part", "hub", "sure", "score", "d", "s", "at", F.col("x.key").alias("key")), "apart-firsts")
    looks = apart.select("i", "node", "part", "score")

    def compared(pairs: DataFrame) -> DataFrame:
        """The similar ones of pairs(a, b), as the rows l and r of looks, l being of lesser score."""
        left = apart.select(F.col("i").alias("a"), F.col("own").alias("x"), F.col("score").alias("s"))
        right = apart.select(F.col("i").alias("b"), F.col("own").alias("y"), F.col("score").alias("t"))
        both = 2 * OF_BOTH * F.size(F.array_intersect("x", "y"))
        found = _written_pairs(_joined(pairs, left, right), both >= F.col("s") + F.col("t"))
        ends = [looks.select(F.col("i").alias(end), F.struct("score", "i", "node", "part").alias(f"end_{end}")) for end in ("a", "b")]
        named = written(found.join(ends[0], "a").join(ends[1], "b").select(F.least("end_a", "end_b").alias("l"), F.greatest("end_a", "end_b").alias("r")), "pivot-similar")
        discard(found)
        return named

    # the smaller one is carried to the larger one
    def carried(x: Callable[[str], Column], y: Callable[[str], Column]) -> tuple[Column, Column]:
        smaller = x("d") <= y("d")
        return F.when(smaller, x("i")).otherwise(y("i")).alias("a"), F.when(smaller, y("i")).otherwise(x("i")).alias("b")

    lead, own, other = (lambda c: F.col(f"lead.{c}")), F.col, (lambda c: F.col(f"{c}_r"))
    leaders = first.groupBy("pivot", "key").agg(F.min_by(F.struct("i", "part", "hub", "score", "d", "s", "at"), F.struct("score", "i")).alias("lead"))
    leaders = written(leaders, "apart-leaders")
    star_met = written(first.join(leaders, ["pivot", "key"]).where(_chance(own, lead)).select(*carried(own, lead)).distinct(), "star-met")
    stars = compared(star_met)
    hubs = written(stars.groupBy(F.col("r.i").alias("i")).agg(F.min("l").alias("l")).select("i", F.col("l.part").alias("star")), "hubs")
    open_yet = first.join(hubs, "i", "left").withColumn("hub", F.when(F.col("sure"), F.col("hub")).otherwise(F.coalesce("star", "hub"))).drop("star", "sure")
    on = (F.col("pivot") == F.col("pivot_r")) & (F.col("key") == F.col("key_r")) & (F.col("i") < F.col("i_r")) & _chance(own, other)
    after = F.least(own("s") - own("at"), other("s") - other("at")) - 1
    rest = after - F.ceil((own("score") + other("score")) / (2 * OF_BOTH))
    seen = open_yet.join(open_yet.select(*[F.col(c).alias(f"{c}_r") for c in open_yet.columns]), on)
    seen = seen.select(*carried(own, other), rest.alias("rest")).groupBy("a", "b").agg(F.count("*").alias("k"), F.min("rest").alias("rest"))
    met_there = written(seen.where(F.col("k") + F.col("rest") >= 0).select("a", "b"), "pivot-met")
    discard(sets, first, hubs, leaders)
    found = compared(met_there)
    links = sure.unionByName(stars.unionByName(found).select(F.col("l.node").alias("a"), F.col("r.node").alias("b")))
    links = written(links.distinct(), "pivot-links")
    discard(pivots, pairs, met, apart, best, often, star_met, stars, met_there, found)
    return links


def similar_links(texts: DataFrame, firsts: DataFrame, prints: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """(a, b): text numbers that connect the similar texts of texts(node, text).

    The written firsts(node, n, first) is used up; prints(node, fp) has the fingerprints. Each shingle's texts are first
    compared with the one of least number, then, where that leaves parts, with the one of greatest number, as far as
    their fingerprints are close. What is connected isn't compared again, so the pairs of a large group of near copies
    aren't formed; all others that meet are, whatever their fingerprints, but for those of over heavy texts under one
    shingle: they are found by what sets them apart.
    """
    shared = firsts.select("node", F.explode("first").alias("key")).groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi"))
    shared = written(shared.where("lo != hi").select("key"), "shared")
    rows = written(firsts.select("node", "n", F.posexplode("first").alias("at", "key")).join(shared, "key"), "meetings")
    discard(shared, firsts)
    rows, links = rows.withColumn("part", F.col("node")), None
    for leader in (F.min, F.max):
        ends = written(rows.groupBy("key").agg(leader("node").alias("node")).join(rows, ["key", "node"]).select("key", *[F.col(c).alias(f"{c}_l") for c in ("node", "part", "n", "at")]), "leaders")
        met = rows.join(ends, "key").where((F.col("part") != F.col("part_l")) & _possible(F.col("n"), F.col("at"), F.col("n_l"), F.col("at_l")))
        pairs = _candidates(met.select(F.col("node_l").alias("a"), F.col("node").alias("b"), F.col("n_l").alias("n"), F.col("n").alias("m"), F.col("at_l").alias("at"), F.col("at").alias("at_m")))
        for end in ("a", "b"):
            pairs = pairs.join(prints.select(F.col("node").alias(end), F.col("fp").alias(f"fp_{end}")), end)
        pairs = written(pairs.where(F.bit_count(F.col("fp_a").bitwiseXOR(F.col("fp_b"))) <= CLOSE).select("a", "b"), "star-pairs")
        found = _verified(pairs, texts)
        links = found if links is None else links.unionByName(found)
        apart = _apart(rows, links)
        discard(pairs, ends, rows)
        rows = apart
    crowded = written(rows.groupBy("key").count().where(F.col("count") > heavy).select("key"), "crowded")
    if not crowded.isEmpty():
        links = links.unionByName(_pivoted(rows.join(crowded, "key", "left_semi"), texts))
    left = rows.join(crowded, "key", "left_anti").alias("l")
    right = rows.join(crowded, "key", "left_anti").select(*[F.col(c).alias(f"{c}_r") for c in ("key", "node", "n", "at", "part")])
    on = (F.col("key") == F.col("key_r")) & (F.col("node") < F.col("node_r")) & (F.col("part") != F.col("part_r"))
    on &= F.least("n", "n_r") * OF >= F.greatest("n", "n_r") * LEAST
    met = left.join(right, on).select(F.col("node").alias("a"), F.col("node_r").alias("b"), "n", F.col("n_r").alias("m"), "at", F.col("at_r").alias("at_m"))
    pairs = written(_candidates(met), "pairs")
    discard(rows)
    # pairs of the stars that failed come again where their parts differ
    return links.unionByName(_verified(pairs, texts))


def _numbered(docs: DataFrame, id_col: str, text_col: str, one_of: int) -> tuple[DataFrame, int]:
    """(id, node, fp, n, first) of each row, written, and the seed of its numbers."""
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    prefixes = _prefixes(docs, _common(texts, one_of))
    for seed in SEEDS:
        prints = texts.select("id", number(F.col("text"), seed).alias("node"), F.sha2("text", 256).alias("sha"), prefixes("text").alias("p"))
        prints = written(prints.select("id", "node", "sha", "p.*"), "prefixes")
        if prints.groupBy("node").agg(F.min("sha").alias("lo"), F.max("sha").alias("hi")).where("lo != hi").isEmpty():
            return prints, seed
    raise ValueError("every text number has collisions")


def similar_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", one_of: int = ONE_OF) -> tuple[DataFrame, int]:
    """(id, node, component): of each row its text's number and its component's, the least of its texts' numbers; and the seed."""
    prints, seed = _numbered(docs, id_col, text_col, one_of)
    rows = written(prints.select("id", "node"), "numbers")
    nodes = written(prints.groupBy("node").agg(F.any_value("fp").alias("fp")), "texts")
    firsts = written(prints.groupBy("node").agg(F.any_value("n").alias("n"), F.any_value("first").alias("first")), "firsts")
    discard(prints)
    texts = docs.select(number(F.col(text_col), seed).alias("node"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    links = written(similar_links(texts, firsts, nodes), "links-similar")
    prints_of = written(nodes.groupBy("fp").agg(F.min("node").alias("least")), "fingerprints")
    same = nodes.join(prints_of, "fp").where("node != least").select(F.col("node").alias("a"), F.col("least").alias("b"))
    close = fingerprint_links(prints_of.select("fp")).join(prints_of.select(F.col("fp").alias("fp_a"), F.col("least").alias("a")), "fp_a")
    close = close.join(prints_of.select(F.col("fp").alias("fp_b"), F.col("least").alias("b")), "fp_b").select("a", "b")
    parts = written(connected_components(links.unionByName(same).unionByName(close)), "parts")
    discard(links)
    return rows.join(parts, "node", "left").select("id", "node", F.coalesce("component", "node").alias("component")), seed


def similar_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", one_of: int = ONE_OF) -> DataFrame:
    """One row per row of docs: id_col, component_id (the smallest id reachable).

    Linked are texts of at least 4/5 Jaccard similarity of their five-word shingles, and texts whose SimHash
    fingerprints are at most three bits apart. Null ids are never the smallest unless a component has no other. An
    empty table gives an empty result.
    """
    rows = written(similar_components(docs, id_col, text_col, one_of)[0], "components")
    # written, so that the last join deals both sides anew and can split a component of very many copies
    least = written(rows.groupBy("component").agg(F.min("id").alias("component_id")), "found")
    return rows.join(least, "component").select(F.col("id").alias(id_col), "component_id")


def drop_similar_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each component of similar_copies; columns stay as they are.

    The row with the smallest id stays, null ids last; of several texts with that id any one, the same in each run; of
    rows that repeat it one. Rows go by id and text together: a row whose id also stands by a near copy isn't touched.
    Null, empty and blank texts are near copies of one another and leave one row; an empty table stays empty.
    """
    found, seed = similar_components(docs, id_col, text_col)
    rows = written(found.select("id", F.col("node").alias("key"), F.col("component").alias("group")), "components")
    return one_row_each(docs, rows, id_col, text_col, lambda text: number(text, seed))
