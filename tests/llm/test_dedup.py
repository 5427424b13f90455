import hashlib
import re
from collections import defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from trackmill.llm.common import connected_components, shared_dir
from trackmill.llm.exact_dedup import chunks, drop_exact_copies, exact_groups, normalised
from trackmill.llm.simhash import drop_near_copies, fingerprint, fingerprint_links, near_copies
from trackmill.llm.similar import drop_similar_copies


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def exact_by_hand(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[norm(r[1])].append(r[0])
    out = []
    for r in rows:
        ids = groups[norm(r[1])]
        keep = min((i for i in ids if i is not None), default=None)
        out.append((r[0], keep, len(ids), r[0] == keep, hashlib.sha256(norm(r[1]).encode()).hexdigest()))
    return sorted(out, key=str)


def test_chunks_join_to_the_text(docs):
    back = docs.select(normalised(F.col("text")).alias("t")).select("t", F.array_join(chunks(F.col("t")), "").alias("j"), F.size(chunks(F.col("t"))).alias("n"))
    assert all(r.t == r.j for r in back.collect())
    assert back.agg(F.max("n")).first()[0] > 20


def test_a_shift_leaves_later_chunks_alone(spark, rows):
    long = max((r[1] for r in rows if r[1]), key=len)
    a, b = (set(spark.createDataFrame([(t,)], "t string").select(chunks(F.col("t"))).first()[0]) for t in (long, "new words in front " + long))
    assert len(a & b) > 0.8 * len(a)


def test_exact_groups(docs, rows, clashing):
    want = exact_by_hand(rows)
    for frame in (docs, clashing):
        assert sorted(map(tuple, exact_groups(frame).collect()), key=str) == want


def test_identifiers_that_collide_are_replaced(docs, rows):
    weak = lambda c: F.length(c) % 7
    got = exact_groups(docs, identifiers=[weak, lambda c: F.sha2(c, 256)])
    assert sorted(map(tuple, got.collect()), key=str) == exact_by_hand(rows)
    with pytest.raises(ValueError):
        exact_groups(docs, identifiers=[weak])


def test_drop_exact_copies(docs, rows):
    got = drop_exact_copies(docs)
    assert got.columns == docs.columns
    texts = {norm(r.text) for r in got.collect()}
    assert texts == {norm(r[1]) for r in rows}


def simhash_by_hand(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_by_hand(nodes, linked):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a in nodes:
        for b in nodes:
            if linked(a, b):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {n: root(n) for n in nodes}


def test_fingerprint(rows):
    for r in rows:
        assert fingerprint(r[1]) % 2**64 == simhash_by_hand(r[1])


@pytest.mark.parametrize("heavy", [1000, 1])
def test_links(spark, heavy):
    base = 0x0123456789ABCDEF
    prints = {base, base ^ 1, base ^ 0b111, base ^ (1 << 63), base ^ (0b111 << 40), base ^ (1 | 1 << 33 | 1 << 50), base ^ 0b1111, base ^ (0b1111 << 32), 0, 3, 2**64 - 1, (2**64 - 1) ^ (7 << 30)}
    prints |= {xxhash.xxh64_intdigest(str(i)) for i in range(50)}
    signed = [(p - 2**64 if p >= 2**63 else p,) for p in prints]
    got = {frozenset(r) for r in fingerprint_links(spark.createDataFrame(signed, "fp long"), heavy).collect()}
    want = {frozenset((a, b)) for (a,) in signed for (b,) in signed if a < b and ((a ^ b) % 2**64).bit_count() <= 3}
    assert got == want and len(want) > 10
    pairs = fingerprint_links(spark.createDataFrame(signed, "fp long"), heavy)
    assert pairs.count() == len(want)


def test_near_copies(docs, rows, clashing):
    prints = {simhash_by_hand(r[1]) for r in rows}
    parts = components_by_hand(sorted(prints), lambda a, b: (a ^ b).bit_count() <= 3)
    least = {}
    for r in rows:
        if r[0] is not None:
            c = parts[simhash_by_hand(r[1])]
            least[c] = min(least.get(c, r[0]), r[0])
    want = sorted(((r[0], f"{simhash_by_hand(r[1]):016x}", least.get(parts[simhash_by_hand(r[1])])) for r in rows), key=str)
    for frame in (docs, clashing):
        assert sorted(map(tuple, near_copies(frame).collect()), key=str) == want
    assert len({w[2] for w in want}) < len({w[1] for w in want}) or len(prints) < len(rows)


def test_drop_near_copies(docs):
    got = drop_near_copies(docs)
    kept = near_copies(got)
    assert kept.where("doc_id != component_id").count() == 0 and got.columns == docs.columns


def test_components(spark):
    pairs = [(i, i + 1) for i in range(1, 30)] + [(100, 200), (200, 50), (7, 7), (None, 3), (60, 60)] + [(1000, 1000 + i) for i in range(1, 40)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = {i: 1 for i in range(1, 31)} | {100: 50, 200: 50, 50: 50} | {1000 + i: 1000 for i in range(40)}
    assert got == want


def test_empty(empty):
    assert exact_groups(empty).count() == near_copies(empty).count() == drop_exact_copies(empty).count() == drop_near_copies(empty).count() == 0


def kept_by_hand(rows, group):
    """One row of each group: the smallest id, null ids last."""
    best = {}
    for r in rows:
        g = group[rows.index(r)]
        if g not in best or (r[0] is None, r[0] or 0) < (best[g][0] is None, best[g][0] or 0):
            best[g] = r
    return sorted(((r[0], norm(r[1])) for r in best.values()), key=str)


#: One id with several texts, repeated rows, and null ids, each with and without a copy elsewhere.
AWKWARD = [(1, "copy me"), (5, "copy me"), (5, "only text of its kind"), (None, "copy me"), (1, "copy me"), (None, "alone and without id"), (None, "alone  and without id"), (7, None), (7, ""), (8, "other words"), (8, "other words here and there"), (8, "other words")]


@pytest.mark.parametrize("drop", [drop_exact_copies, drop_near_copies, drop_similar_copies])
def test_drops_decide_by_row(spark, drop):
    frame = spark.createDataFrame(AWKWARD, "doc_id long, text string").withColumn("_id", F.lit("x")).repartition(3)
    got = drop(frame)
    assert got.columns == frame.columns
    found = sorted(((r.doc_id, norm(r.text)) for r in got.collect()), key=str)
    assert found == kept_by_hand(AWKWARD, [norm(t) for _, t in AWKWARD])


def test_a_local_folder_is_no_shared_one():
    class Context:
        master = "spark://host:7077"

    class Conf:
        get = staticmethod(lambda key, other: other)

    class Session:
        conf, sparkContext = Conf, Context

    with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
        shared_dir(Session)
