"""Benchmark decontamination by pigeonhole edit matching.

An item within e edits of a passage, cut into e + 1 pieces, has at least one piece in it unchanged. All pieces are
looked up in each text with one automaton; around each hit the window the whole item could fill is verified with
Myers' bit-parallel edit distance. Windows of one item that overlap are verified as one. Where very many items share a
piece, as prompts do, their three-letter sequences are counted in the passage first, which rules most of them out.
Items that allow no edit are too short to tell a passage by, and count only where they make up a line.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackmill.llm.common import scratch, written

#: Edits allowed per character of an item, and bytes of items that one automaton is built from.
ERROR_RATE, BLOCK_BYTES = 0.05, 4_000_000
#: Items under one piece beyond which they are counted first; different numbers for sequences of three letters.
SHARED, GRAMS = 16, 1 << 15


def hits_type(item_id: T.DataType) -> T.ArrayType:
    return T.ArrayType(T.StructType([T.StructField("item_id", item_id), T.StructField("end", T.IntegerType()), T.StructField("edits", T.IntegerType())]))


def normalised(text: str | None) -> str:
    """Lower case, runs of white space as one space."""
    return " ".join((text or "").lower().split())


def pieces(item: str, edits: int) -> list[tuple[int, str]]:
    """edits + 1 pieces of about equal length with their offsets."""
    cuts = [len(item) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False) if b > a]


def edit_search(item: str, text: str, edits: int) -> tuple[int, int] | None:
    """(edits, end) of the best passage of text within so many edits of item, the first of equals; None without one."""
    m = len(item)
    full, top = (1 << m) - 1, 1 << (m - 1)
    eq: dict[str, int] = {}
    for i, c in enumerate(item):
        eq[c] = eq.get(c, 0) | (1 << i)
    pv, mv, score, best = full, 0, m, None
    for end, c in enumerate(text, 1):
        e = eq.get(c, 0)
        d = (((e & pv) + pv) ^ pv) | e | mv
        ph, mh = mv | ~(d | pv), pv & d
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph, mh = ph << 1, mh << 1  # a passage may begin anywhere, so the first row stays zero
        pv, mv = (mh | ~(d | ph)) & full, ph & d & full
        if score <= edits and (best is None or score < best[0]):
            best = (score, end)
    return best


def grams(text: str) -> np.ndarray:
    """Numbers of the sequences of three letters in order; different ones may have one number."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    return (c[:-2] * 7919 + c[1:-1] * 131 + c[2:]) % GRAMS


class Matcher:
    """All items of one block."""

    def __init__(self, items: Iterable[tuple[int, str]], error_rate: float = ERROR_RATE, shared: int = SHARED) -> None:
        self.items: dict[int, tuple[str, int]] = {}
        self.lines: dict[str, list[int]] = {}
        found: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            item = normalised(text)
            edits = int(len(item) * error_rate)
            if item and not edits:
                self.lines.setdefault(item, []).append(item_id)
            elif item:
                self.items[item_id] = (item, edits)
                for offset, piece in pieces(item, edits):
                    found.setdefault(piece, []).append((item_id, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, places in found.items():
            self.automaton.add_word(piece, (len(piece), places, _Crowd(self.items, places) if len(places) > shared else None))
        if found:
            self.automaton.make_automaton()

    def match(self, text: str | None) -> list[tuple[int, int, int]]:
        """(item, end in the normalised text, edits) of the best passage of each item found, by item."""
        out = [(item_id, end, 0) for item_id, end in self._lines(text or "")] if self.lines else []
        text = normalised(text)
        windows: dict[int, list[tuple[int, int]]] = {}
        crowds: dict[int, tuple[_Crowd, int, list[int]]] = {}

        def look(item_id: int, start: int) -> None:
            item, edits = self.items[item_id]
            span = (max(0, start - edits), min(len(text), start + len(item) + edits))
            own = windows.setdefault(item_id, [])
            if own and span[0] <= own[-1][1] and span[0] >= own[-1][0]:
                own[-1] = (own[-1][0], max(own[-1][1], span[1]))
            else:
                own.append(span)

        for end, (length, places, crowd) in self.automaton.iter(text) if self.items else ():
            if crowd:
                crowds.setdefault(id(crowd), (crowd, length, []))[2].append(end + 1 - length)
            else:
                for item_id, offset in places:
                    look(item_id, end + 1 - length - offset)
        for crowd, _, starts in crowds.values():
            for item_id, start in crowd.possible(text, starts):
                look(item_id, start)
        for item_id, spans in windows.items():
            item, edits = self.items[item_id]
            best = None
            for a, b in _merged(spans):
                if (hit := edit_search(item, text[a:b], edits)) and (best is None or hit[0] < best[0]):
                    best = (hit[0], a + hit[1])
            if best:
                out.append((item_id, best[1], best[0]))
        return sorted(out)

    def _lines(self, text: str) -> Iterator[tuple[int, int]]:
        """(item, end in the normalised text) of the first line that a short item makes up."""
        end, seen = -1, set()
        for line in text.splitlines():
            line = normalised(line)
            end += len(line) + 1 if line else 0
            for item_id in self.lines.get(line, ()) if line not in seen else ():
                yield item_id, end
            seen.add(line)


class _Crowd:
    """The items that share a piece, with the numbers of all their sequences of three letters."""

    def __init__(self, items: dict[int, tuple[str, int]], places: list[tuple[int, int]]) -> None:
        self.places = places
        own = [items[item_id] for item_id, _ in places]
        self.before = max(offset + edits for (_, offset), (_, edits) in zip(places, own, strict=True))
        self.after = max(len(item) - offset + edits for (_, offset), (item, edits) in zip(places, own, strict=True))
        each = [grams(item) for item, _ in own]
        self.grams, self.at = np.concatenate(each), np.cumsum([0, *map(len, each)])[:-1]
        # an edit touches three sequences at most
        self.need = np.array([len(g) - 3 * edits for g, (_, edits) in zip(each, own, strict=True)])

    def possible(self, text: str, starts: list[int]) -> Iterator[tuple[int, int]]:
        """(item, start) for the places of the piece in text of those items whose sequences are there often enough."""
        for group in _near(starts, self.before + self.after):
            there = np.zeros(GRAMS, dtype=np.int64)
            there[grams(text[max(0, group[0] - self.before) : group[-1] + self.after])] = 1
            for k in np.flatnonzero(np.add.reduceat(there[self.grams], self.at) >= self.need).tolist():
                item_id, offset = self.places[k]
                for start in group:
                    yield item_id, start - offset


def _near(starts: list[int], reach: int) -> Iterator[list[int]]:
    """Ascending places in groups of which each is within reach of the next."""
    group: list[int] = []
    for s in starts:
        if group and s - group[-1] > reach:
            yield group
            group = []
        group.append(s)
    if group:
        yield group


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def benchmark_hits(
    docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", error_rate: float = ERROR_RATE, block_bytes: int = BLOCK_BYTES, hits_col: str = "hits"
) -> DataFrame:
    """docs with hits_col added: an array of (item_id, end, edits), ordered by item; a column of that name is replaced.

    Items go to the executors in blocks of about block_bytes of text, cut by a hash of the item, so what is broadcast
    is bounded. Where there are several, each block's hits are written before the next block is read, and joined to the
    texts in the end, so that one block is in memory at a time and the texts are read once for each block. Null, empty and blank texts have no hits; null, empty
    and blank items and those with null ids match nothing; items too short for an edit (20 characters at
    the usual rate) match a whole line exactly; of items that
    repeat an id, the one last in text order counts. Ids may have any type that has an order. Rows that repeat have the
    same hits. Empty tables give empty hits or an empty result.
    """
    kind = hits_type(items.schema[item_id].dataType)
    items = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text")).where("item_id IS NOT NULL AND text IS NOT NULL").groupBy("item_id").agg(F.max("text").alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    if n > 1:
        items = written(items, "items")
    found, key = [], scratch(docs, "_key")
    texts = docs.select(F.col(text_col).alias("text")).where("text IS NOT NULL")
    for k in range(n):
        block = [(r.item_id, r.text) for r in items.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == k).collect()]
        find = _find(docs, block, error_rate, kind)
        if n == 1:
            return docs.withColumn(hits_col, find(F.col(text_col)))
        hits = texts.select(F.sha2("text", 256).alias(key), find(F.col("text")).alias("hits")).where(F.size("hits") > 0)
        found.append(written(hits, "hits"))
    every = reduce(DataFrame.unionByName, found).groupBy(key).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("hits")))).alias(hits_col))
    kept = docs.drop(hits_col).withColumn(key, F.sha2(F.col(text_col), 256)).join(written(every, "hits"), key, "left")
    return kept.withColumn(hits_col, F.coalesce(hits_col, F.array().cast(kind))).select(*docs.columns, *([] if hits_col in docs.columns else [hits_col]))


def _find(docs: DataFrame, block: list[tuple[object, str]], error_rate: float, kind: T.ArrayType):
    sent = docs.sparkSession.sparkContext.broadcast((block, error_rate))  # a block of bounded size

    @F.pandas_udf(kind)
    def find(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        items, rate = sent.value
        ordered = sorted(items)
        matcher = Matcher([(k, text) for k, (_, text) in enumerate(ordered)], rate)
        for batch in texts:
            yield pd.Series([[{"item_id": ordered[i][0], "end": e, "edits": d} for i, e, d in matcher.match(x)] for x in batch], dtype=object)

    return find


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id_col, contaminated, item_ids, n_items, least_edits (null without a hit).

    What benchmark_hits says of nulls, empty and repeated texts and items holds; other columns aren't read.
    """
    hits = benchmark_hits(docs.select(F.col(id_col), F.col(text_col).alias("text")), items)
    return hits.select(id_col, (F.size("hits") > 0).alias("contaminated"), F.col("hits.item_id").alias("item_ids"), F.size("hits").cast("long").alias("n_items"), F.array_min("hits.edits").alias("least_edits"))


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text") -> DataFrame:
    """docs without those that hold a passage of the benchmark; columns stay as they are.

    Null, empty and blank texts hold none and stay; rows that repeat go or stay together. An empty table stays so.
    """
    return benchmark_hits(docs, items, text_col, hits_col=(found := scratch(docs, "_hits"))).where(F.size(found) == 0).select(*docs.columns)
