"""Mixing sources to target weights by the cube method.

A source whose target is r times its size takes each document floor(r) times and once more with the probability
r - floor(r). Which documents those are is balanced sampling: probabilities move along the null space of the balance
constraints (words, documents) until they are 0 or 1. Three undecided documents and two constraints always leave one
direction, so a block is worked through until at most two are undecided. Blocks are hash ranges of a source and their
leftovers meet in fewer blocks, round by round. In a source's last block a short ladder of sizes is left out of the
flight; it and the last two open documents are the landing problem.
"""

from __future__ import annotations

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackmill.llm.common import scratch, word_count, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
BLOCK = 4096
#: Documents of a source that wait for its landing, and draws tried there.
LADDER, DRAWS = 16, 8
_EPS = 1e-9


def _ranked(sources: DataFrame) -> DataFrame:
    """sources with nth, their number from 0 by code point, null last.

    Ranges of sources are numbered on their own and moved by the sizes of the ranges before, one number per partition.
    """
    ranges = sources.repartitionByRange(F.col("source").isNull(), "source").withColumn("range", F.spark_partition_id())
    ranges = written(ranges, "source-ranges")
    sizes = {r.range: r["count"] for r in ranges.groupBy("range").count().collect()}
    before = {k: sum(n for j, n in sizes.items() if j < k) for k in sizes}
    moved = F.coalesce(*[F.when(F.col("range") == k, F.lit(n)) for k, n in before.items()], F.lit(0))
    inside = Window.partitionBy("range").orderBy(F.col("source").asc_nulls_last())
    return ranges.withColumn("nth", F.row_number().over(inside) - 1 + moved).drop("range")


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Adds target to sources(source, source_size), one row per source.

    Sources by code point, null last, weigh as in weights, repeating. They share share times the whole size by weight;
    a target stops at most times its source's size and the excess is shared again by weight until none is above. Each
    sharing is one aggregation, and what stops at one level stops at all later ones.
    """
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = _ranked(sources).withColumn("_weight", F.get(cycle, F.col("nth") % len(weights))).withColumn("_cap", F.col("source_size") * F.lit(most))
    ranked = written(ranked.drop("nth"), "source-weights")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, stopped = 0.0, -1
    while True:
        full = F.col("_cap") <= F.col("_weight") * F.lit(level)
        row = ranked.agg(F.count_if(full).alias("n"), F.sum(F.when(full, F.col("source_size")).otherwise(0)).alias("size"), F.sum(F.when(full, 0.0).otherwise(F.col("_weight"))).alias("weight")).first()
        if row.n == stopped or not row.weight:
            break
        stopped, level = row.n, (total * share - row.size * most) / row.weight
    target = F.when(full, F.col("_cap")).otherwise(F.col("_weight") * F.lit(level))
    return ranked.withColumn("target", target).drop("_weight", "_cap")


def _draw(seed: str) -> float:
    return xxhash.xxh64_intdigest(seed, 42) / 2.0**64


def flight(sizes: list[float], chances: list[float], seed: str) -> list[float]:
    """The flight phase: chances moved, their sum and their sum weighted by sizes kept, until at most two are open."""
    out, open_ = list(chances), []
    for i, p in enumerate(chances):
        if not _EPS < p < 1 - _EPS:
            out[i] = round(p)
            continue
        open_.append(i)
        while len(open_) == 3:
            a, b, c = open_
            # the direction that keeps both sums: the cross product of (1, 1, 1) and the sizes
            u = (sizes[c] - sizes[b], sizes[a] - sizes[c], sizes[b] - sizes[a])
            if not any(u):
                u = (1.0, -1.0, 0.0)
            up = min((1 - out[k]) / x if x > 0 else -out[k] / x for k, x in zip(open_, u, strict=True) if x)
            down = min(out[k] / x if x > 0 else (out[k] - 1) / x for k, x in zip(open_, u, strict=True) if x)
            step = up if _draw(f"{seed}:{i}:{len(open_)}") * (up + down) < down else -down
            for k, x in zip(open_, u, strict=True):
                out[k] += step * x
                if out[k] < _EPS or out[k] > 1 - _EPS:
                    out[k] = float(round(out[k]))
            open_ = [k for k in open_ if 0 < out[k] < 1]
    return out


_FLOWN = "source string, id string, size long, row int, n long, order long, chance double, block long"


def _fly(frame: pd.DataFrame, last: bool = False) -> pd.DataFrame:
    """One block, long documents first so that short ones stay open; last lands those that do."""
    frame = frame.sort_values(["size", "order", "row"], ascending=[False, True, True], ignore_index=True)
    seed = f"{frame['source'].iloc[0]}:{frame['order'].iloc[0]}:{len(frame)}"
    sizes, chances = frame["size"].tolist(), frame["chance"].tolist()
    if not last:
        return frame.assign(chance=flight(sizes, chances, seed))
    # a ladder of sizes waits for the landing, so that what remains there can meet the words closely
    open_ = [k for k, p in enumerate(chances) if _EPS < p < 1 - _EPS]
    ladder = sorted({open_[(len(open_) - 1) * i // (LADDER - 1)] for i in range(LADDER)}) if open_ else []
    held = set(ladder)
    rest = [k for k in range(len(sizes)) if k not in held]
    moved = flight([sizes[k] for k in rest], [chances[k] for k in rest], seed)
    for k, p in zip(rest, moved, strict=True):
        chances[k] = p
    return frame.assign(chance=land(sizes, chances, seed))


def _fly_only(frame: pd.DataFrame) -> pd.DataFrame:
    return _fly(frame)


def _fly_and_land(frame: pd.DataFrame) -> pd.DataFrame:
    return _fly(frame, last=True)


def land(sizes: list[float], chances: list[float], seed: str) -> list[float]:
    """The landing phase over what is still open, at most the ladder and two more.

    From each of a few draws by the chances, single flips and then swaps bring the words nearest to their balance; the
    draw that ends nearest, in words and then in documents, lands.
    """
    out = [float(round(p)) for p in chances]
    open_ = [k for k, p in enumerate(chances) if _EPS < p < 1 - _EPS]
    words = sum(sizes[k] * chances[k] for k in open_)
    count = sum(chances[k] for k in open_)
    best: tuple[float, float] | None = None
    for attempt in range(DRAWS if open_ else 0):
        z = {k: int(_draw(f"{seed}:{attempt}:{k}") < chances[k]) for k in open_}
        miss = (abs(sum(sizes[k] * z[k] for k in open_) - words), abs(sum(z.values()) - count))
        while True:
            moves = []
            over = sum(sizes[k] * z[k] for k in open_) - words
            more = sum(z.values()) - count
            for i in open_:
                w, c = over + sizes[i] * (1 - 2 * z[i]), more + 1 - 2 * z[i]
                moves.append(((abs(w), abs(c)), (i,)))
                moves += [((abs(w + sizes[j] * (1 - 2 * z[j])), abs(c + 1 - 2 * z[j])), (i, j)) for j in open_ if j > i]
            step = min(moves)
            if step[0] >= miss:
                break
            miss = step[0]
            for k in step[1]:
                z[k] = 1 - z[k]
        if best is None or miss < best:
            best = miss
            for k in open_:
                out[k] = float(z[k])
    return out


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block: int = BLOCK) -> DataFrame:
    """One row per row of docs: id_col, source, size, source_size, target, copies, taken.

    size counts words; null and empty texts have none and are taken 0 times. Rows that repeat an id with the same size,
    those without ids too, are documents of their own that nothing tells apart, so any of them may be the ones taken
    once more. Choices depend on ids, sizes and sources alone, so reruns agree. A null source is a source of its own.
    Other columns of docs are not read. An empty table gives an empty result.
    """
    sized = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
    keys = written(sized.groupBy("id", "source", "size").agg(F.count("*").alias("times")), "sizes")
    sources = keys.groupBy("source").agg(F.sum(F.col("size") * F.col("times")).alias("source_size"), F.sum(F.when(F.col("size") > 0, F.col("times")).otherwise(0)).alias("n"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    targets = written(source_targets(sources).withColumn("rate", rate), "targets")
    # equal rows of one id are numbered so that each is a document of its own
    units = _repeated(keys.where("size > 0").select(F.col("id").cast("string").alias("id"), "source", "size", "times"), "times", "row")
    rates = targets.select(F.col("source").alias("t_source"), "rate", "n")
    units = units.join(rates, units["source"].eqNullSafe(rates["t_source"])).drop("t_source")
    undecided = units.select("source", "id", "size", "row", "n", F.xxhash64("id", "size", "row").alias("order"), (F.col("rate") - F.floor("rate")).alias("chance"))
    chosen, left = None, undecided
    blocks = F.ceil(F.col("n") / F.lit(block)).cast("long")
    most = targets.agg(F.max("n")).first()[0] or 0
    while True:
        last = most <= block
        flown = left.withColumn("block", _block(blocks)).groupBy("source", "block").applyInPandas(_fly_and_land if last else _fly_only, _FLOWN)
        flown = written(flown.drop("block"), "flight")
        done = flown.where("chance <= 0 or chance >= 1")
        chosen = done if chosen is None else chosen.unionByName(done)
        if last:
            break
        left = flown.where("chance > 0 and chance < 1")
        # two of each block go on; blocks are that much fewer in the next round
        most = -(-most * 3 // block)
        left = left.withColumn("n", F.ceil(F.col("n") * 3 / F.lit(block)).cast("long"))
    extra = written(chosen.where("chance >= 1").groupBy("source", "id", "size").agg(F.count("*").alias("more")), "extra")
    return _taken(keys, targets, extra, id_col)


def _block(blocks: Column) -> Column:
    return F.pmod(F.col("order"), F.greatest(blocks, F.lit(1)))


def _repeated(rows: DataFrame, times: str, row: str, piece: int = BLOCK) -> DataFrame:
    """Each row as often as the column times says, which row numbers from 1; a large number is dealt out in pieces."""
    once = rows.where(F.col(times) == 1).withColumn(row, F.lit(1)).drop(times)
    first = F.sequence(F.lit(1).cast("long"), F.col(times), F.lit(piece).cast("long"))
    many = rows.where(F.col(times) > 1).withColumn(row, F.explode(first)).hint("rebalance")
    each = F.explode(F.sequence(F.col(row), F.least(F.col(row) + piece - 1, F.col(times))))
    return once.unionByName(many.withColumn(row, each).withColumn(row, F.col(row).cast("int")).drop(times))


def _taken(keys: DataFrame, targets: DataFrame, extra: DataFrame, id_col: str) -> DataFrame:
    e = extra.select(F.col("id").alias("e_id"), F.col("source").alias("e_source"), F.col("size").alias("e_size"), "more")
    on = F.col("id").cast("string").eqNullSafe(F.col("e_id")) & F.col("source").eqNullSafe(F.col("e_source")) & (F.col("size") == F.col("e_size"))
    t = targets.select(F.col("source").alias("t_source"), "source_size", "target", "rate")
    joined = keys.join(e, on, "left").join(t, F.col("source").eqNullSafe(F.col("t_source")))
    copies, more = F.when(F.col("size") > 0, F.floor("rate")).otherwise(0).cast("long"), F.coalesce("more", F.lit(0))
    # of rows that nothing tells apart, so many are taken once more
    parts = F.array(F.struct((copies + 1).alias("copies"), more.cast("long").alias("times")), F.struct(copies.alias("copies"), (F.col("times") - more).cast("long").alias("times")))
    joined = joined.select("id", "source", "size", "source_size", "target", F.explode(parts).alias("part")).select("*", "part.copies", "part.times").drop("part")
    each = _repeated(joined.where("times > 0"), "times", "row")
    return each.select(F.col("id").alias(id_col), "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def repeated(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The mix itself: docs, each as often as mixed has copies of it. Ids must be unique in docs; null ids are left out."""
    often = mixed.where("copies > 0").select(id_col, F.col("copies").alias(times := scratch(docs, "_times")))
    row = scratch(docs, "_row")
    return docs.join(often, id_col).withColumn(row, F.explode(F.sequence(F.lit(1), F.col(times).cast("int")))).select(*docs.columns)
