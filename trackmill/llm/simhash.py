"""SimHash near-duplicate detection with deletion-variant signatures.

Two 64-bit fingerprints that differ in at most three bits are cut into two segments of 32 bits; one segment then
differs in at most one bit. Each segment is indexed under its 32 one-wildcard variants, equal variants are joined, and
the join's own condition verifies the whole distance, so only true links leave it, each once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackmill.llm.common import connected_components, one_row_each, written

MAX_BITS = 3
#: Index entries under one variant beyond which the variant is refined by the other segment's halves.
HEAVY = 1000


def fingerprint(text: str | None, width: int = 3) -> int:
    """64-bit SimHash of the word shingles as a signed integer; zero without words."""
    words = (text or "").encode("utf-8", "replace").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        hashes = [xxhash.xxh64_intdigest(joined, 42)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = [0, *ends[: -width].tolist()]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[s:e], 42) for s, e in zip(starts, (ends[width - 1 :] - 1).tolist(), strict=True)]
    return majority(np.array(hashes, dtype="<u8"))


def majority(values: np.ndarray) -> int:
    """The bits that over half the values have, as a signed integer."""
    if not len(values):
        return 0
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(values), 65536):
        ones += np.unpackbits(values[at : at + 65536].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits((2 * ones > len(values)).astype(np.uint8), bitorder="little").view("<i8")[0])


_LOWER = bytes(range(256)).lower()


@F.arrow_udf(T.LongType())
def _fingerprints(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in texts:
        # one text at a time is a Python object
        yield pa.array([fingerprint(x.as_py()) for x in batch], pa.int64())


def variants(fp: Column, parts: list[tuple[int, int]], first: int = 0) -> list[Column]:
    """One-wildcard variants of the parts (offset, width) of fp: (number << 32 | part without one bit) each."""
    out = []
    for offset, width in parts:
        part = F.shiftrightunsigned(fp, offset).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
        for bit in range(width):
            out.append(part.bitwiseAND(F.lit(((1 << width) - 1) & ~(1 << bit)).cast("long")).bitwiseOR(F.lit((first + len(out)) << 32).cast("long")))
    return out


def _first_shared(x: Column, parts: list[tuple[int, int]]) -> Column:
    """Number of the first variant over parts that two fingerprints with the difference x share."""
    found, number = None, 0
    for offset, width in parts:
        part = F.shiftrightunsigned(x, offset).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
        here = F.when(part == 0, F.lit(number)).otherwise(F.bit_count(part - 1) + number)
        found = F.when(F.bit_count(part) <= 1, here) if found is None else found.when(F.bit_count(part) <= 1, here)
        number += width
    return found.cast("long")


_HALVES = [(0, 32), (32, 32)]
_QUARTERS = {0: [(32, 16), (48, 16)], 1: [(0, 16), (16, 16)]}


def fingerprint_links(prints: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """Pairs (fp_a, fp_b) of different fingerprints in prints(fp) at most three bits apart, each once; none is lost.

    Fingerprints must be distinct. A variant with more than heavy entries is joined on a second key as well: the other
    segment differs in at most three bits, so one of its halves differs in at most one, and its variants are shared.
    """
    index = written(prints.select("fp", F.explode(F.array(*variants(F.col("fp"), _HALVES))).alias("key")), "variants")
    crowded = written(index.groupBy("key").count().where(F.col("count") > heavy).select("key"), "crowded")
    if crowded.isEmpty():
        return _verified(index, index.withColumnRenamed("fp", "other"), ["key"])
    light = index.join(crowded, "key", "left_anti")
    dense = index.join(crowded, "key", "left_semi")
    number = F.shiftrightunsigned(F.col("key"), 32)
    second = F.when(number < 32, F.array(*variants(F.col("fp"), _QUARTERS[0]))).otherwise(F.array(*variants(F.col("fp"), _QUARTERS[1])))
    dense = dense.withColumn("second", F.explode(second))
    return _verified(light, light.withColumnRenamed("fp", "other"), ["key"]).unionByName(_verified(dense, dense.withColumnRenamed("fp", "other"), ["key", "second"]))


def _verified(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    a, b = a.alias("a"), b.alias("b")
    x = F.col("a.fp").bitwiseXOR(F.col("b.other"))
    number = F.shiftrightunsigned(F.col("a.key"), 32)
    on = (F.col("a.fp") < F.col("b.other")) & (F.bit_count(x) <= MAX_BITS) & (number == _first_shared(x, _HALVES))
    for k in keys:
        on &= F.col(f"a.{k}") == F.col(f"b.{k}")
    if len(keys) > 1:
        second = F.shiftrightunsigned(F.col("a.second"), 32)
        on &= second == F.when(number < 32, _first_shared(x, _QUARTERS[0])).otherwise(_first_shared(x, _QUARTERS[1]))
    return a.join(b, on).select(F.col("a.fp").alias("fp_a"), F.col("b.other").alias("fp_b"))


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id_col, fingerprint (16 hex digits), component_id (the smallest id reachable).

    Null, empty and blank texts have the fingerprint zero and are linked like any other. Copies share a fingerprint
    and are joined as one entry. Null ids are never the smallest unless a component has no other. Other columns of
    docs are not read. An empty table gives an empty result.
    """
    prints = written(docs.select(F.col(id_col).alias("id"), _fingerprints(F.col(text_col)).alias("fp")), "fingerprints")
    found = fingerprint_components(prints)
    return prints.join(found, "fp").select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def fingerprint_components(prints: DataFrame) -> DataFrame:
    """(fp, component, component_id) of each fingerprint in prints(id, fp): its component's least fingerprint and id."""
    nodes = written(prints.groupBy("fp").agg(F.min("id").alias("node")), "nodes")
    links = fingerprint_links(nodes.select("fp"))
    components = connected_components(links.select(F.col("fp_a").alias("a"), F.col("fp_b").alias("b"))).withColumnRenamed("node", "fp")
    # written, so that this join and the last one deal both sides anew and can split a component, or a fingerprint, of many
    linked = written(components.join(nodes, "fp"), "linked")
    least = written(linked.groupBy("component").agg(F.min("node").alias("least")), "least")
    linked = linked.join(least, "component").select("fp", "component", "least")
    found = nodes.join(linked, "fp", "left")
    return written(found.select("fp", F.coalesce("component", "fp").alias("component"), F.when(F.col("component").isNull(), F.col("node")).otherwise(F.col("least")).alias("component_id")), "found")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each component of near_copies; columns stay as they are.

    The row with the smallest id stays, null ids last; of several texts with that id the one with the smallest SHA-256,
    of rows that repeat it one. Rows go by id and text together: a row whose id also stands by a near copy isn't
    touched. Null, empty and blank texts are near copies of one another; an empty table stays empty.
    """

    def key(text: Column) -> Column:
        return F.sha2(F.coalesce(text, F.lit("")), 256)

    prints = written(docs.select(F.col(id_col).alias("id"), key(F.col(text_col)).alias("key"), _fingerprints(F.col(text_col)).alias("fp")), "fingerprints")
    rows = written(prints.join(fingerprint_components(prints), "fp").select("id", "key", F.col("component").alias("group")), "components")
    return one_row_each(docs, rows, id_col, text_col, key)
