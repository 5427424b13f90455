import random
import re
import tracemalloc
import weakref
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from trackmill.llm import collocations
from trackmill.llm.collocations import frequent_bits, phrase_counts

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counts_by_hand(rows, longest=3):
    f, total = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    return f, total


def by_hand(rows, least, longest=3, top=2000):
    f, total = counts_by_hand(rows, longest)
    kept = {p: n for p, n in f.items() if n >= least and len(p[1]) > 1}
    out = []
    for (lang, words), a in kept.items():
        inside = lambda other: any(other[i : i + len(words)] == words for i in range(len(other) - len(words) + 1))
        if any(100 * n >= 50 * a for (x, other), n in kept.items() if x == lang and len(other) > len(words) and inside(other)):
            continue
        score, k = min((1_000_000 * a * a // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words)))
        out.append((lang, -score, -a, " ".join(words).encode(), f[lang, words[:k]], f[lang, words[k:]]))
    ranked, rank = [], Counter()
    for lang, score, a, phrase, left, right in sorted(out):
        rank[lang] += 1
        if rank[lang] <= top:
            ranked.append((lang, rank[lang], phrase.decode(), -a, left, right, total[lang], -score))
    return ranked


def spoken(rng):
    words = ["de", "la", "Casa", "\x00", "ünder", "漢字", "w-1", "Élan", "x" * 300, "of", "the", "end"]
    rows = []
    for i in range(120):
        said = []
        for _ in range(rng.randint(0, 80)):
            said.append(rng.choice([rng.choice(words), "of the end", "la casa de la", f"rare{rng.randint(0, 400)}"]))
            said.append(rng.choice([" "] * 8 + ["\t", "  ", ", ", ".", "\n", " ; ", "\x0b", "\r\n", "-"]))
        rows.append((i, "".join(said), rng.choice(["en", "en", "fr", None, "und"]), "s", 0))
    return rows + [rows[4], rows[4], (900, None, "en", None, 0), (901, "", "de", None, 0), (902, ". .\n", None, None, 0), (None, "ab " * 3000 + "\n" + "one two three " * 2000, "en", None, 0)]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize(("bits", "shards", "most", "least", "longest"), [(26, 4, 4_000_000, 10, 3), (6, 3, 500, 3, 3), (12, 1, 10_000, 4, 4), (20, 5, 2_000, 2, 2)])
def test_collocations(spark, monkeypatch, bits, shards, most, least, longest):
    monkeypatch.setattr(collocations, "PIECE_BYTES", 1000)
    rows = spoken(random.Random(bits))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4).withColumns({c: F.lit("x") for c in ("phrase", "n", "k", "h")})
    got = collocations.collocations(docs, least=least, longest=longest, table_bits=bits, shards=shards, most=most)
    have = sorted(tuple(r) for r in got.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())
    want = sorted(by_hand(rows, least, longest))
    assert have == want
    assert len(want) > 40


def test_all_counts(spark):
    rows = spoken(random.Random(9))
    f, total = counts_by_hand(rows)
    got = {(r.lang, tuple(r.phrase.split(" ")) if r.k else ()): r.n for r in phrase_counts(spark.createDataFrame(rows, SCHEMA), least=5, table_bits=16).collect()}
    assert got == {p: n for p, n in f.items() if n >= 5} | {(lang, ()): n for lang, n in total.items() if (lang, ()) in got}
    assert all(got.get((lang, ()), 0) == n for lang, n in total.items())


def test_cycles_interleave(spark):
    """What is frequent in the first shard is counted as a pair from the second one on, and the first one comes again."""
    rows = [(i, f"often here {i % 7} text{i}", "en", None, 0) for i in range(400)]
    docs = spark.createDataFrame(rows, SCHEMA).select("lang", "text")
    _, turns = frequent_bits(docs, least=5, longest=3, shards=4, table_bits=20)
    assert turns[:6] == [(0, True), (1, True), (2, True), (3, True), (0, False), (1, False)] and len(turns) < 9


def test_exact_scores(spark):
    """Products beyond 64 bits."""
    big = 10**12
    counts = spark.createDataFrame([("en", "a", 1, big), ("en", "b", 1, big + 7), ("en", "a b", 2, big - 3)], "lang string, phrase string, k int, n long")
    (row,) = collocations.scored(counts).collect()
    assert row.score == 1_000_000 * (big - 3) ** 2 // (big * (big + 7))


def test_top_and_ties(spark):
    rows = [(0, " . ".join(f"a{i} b{i}" for i in range(30) for _ in range(3)), "en", None, 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = collocations.collocations(docs, least=3, top=7, table_bits=16).orderBy("rank").collect()
    assert [r.phrase for r in got] == sorted(f"a{i} b{i}" for i in range(30))[:7] and [r["rank"] for r in got] == list(range(1, 8))


def test_empty(spark, empty):
    got = collocations.collocations(empty)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and got.count() == 0


def test_words_that_are_counted_are_let_go(monkeypatch):
    """When a language's words are spelled out, those given out before it are no longer in memory."""
    real, given = collocations._held, []

    def watched(batches, most):
        for lang, vocabulary, numbers in real(batches, most):
            assert not [x for x in given if x() is not None]
            given.append(weakref.ref(vocabulary))
            yield lang, vocabulary, numbers
            del vocabulary, numbers

    monkeypatch.setattr(collocations, "_held", watched)
    batches = [pa.record_batch([pa.array(["en", "de", "en"]), pa.array([f"one two {i}", "eins zwei", "one two."])], ["lang", "text"]) for i in range(5)]
    every = np.full(1 << 6, ~np.uint64(0))
    rows = pa.Table.from_batches(collocations._spelled(iter(batches), every, 3, 6)).to_pylist()
    assert len(given) > 4
    found = Counter()
    for r in rows:
        found[r["lang"], r["phrase"], r["k"]] += r["n"]
    assert found["en", "one two", 2] == 10 and found["de", "eins zwei", 2] == 5 and found["en", "", 0] == 25


def test_looking_up_takes_little_memory():
    """What is active among 1.5 million places is found in a few MB besides the places, and is the same as all at once."""
    rng = np.random.default_rng(3)
    words = rng.integers(1, 2**64, 1_500_000, dtype=np.uint64)
    tables = [rng.integers(0, 2**64, 1 << 12, dtype=np.uint64) for _ in range(2)]
    at = np.arange(len(words) - 1)
    both = lambda table: collocations._set(table, words[at]) & collocations._set(table, words[at + 1])
    want = both(tables[1]) & ~both(tables[0])
    tracemalloc.start()
    got = collocations._active(tables, words, at)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.array_equal(got, want) and 0 < got.sum() < len(got)
    assert peak < 20e6


def test_texts_come_in_small_batches(spark, monkeypatch):
    """While texts are read few rows go to Python at once; then the session's setting holds again."""
    name, seen, real = "spark.sql.execution.arrow.maxRecordsPerBatch", {}, collocations.written
    before = spark.conf.get(name)

    def watched(df, table):
        seen[table] = int(spark.conf.get(name))
        return real(df, table)

    monkeypatch.setattr(collocations, "written", watched)
    assert phrase_counts(spark.createDataFrame(spoken(random.Random(4))[:20], SCHEMA), table_bits=12, shards=1).count()
    assert set(seen) == {"words", "phrases-counted", "phrases"} and max(seen.values()) <= 500 and spark.conf.get(name) == before
