import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackmill.llm import suffixes
from trackmill.llm.suffixes import merged, parsed, phrases, remove_repeats


def by_hand(rows, length):
    """Every string of every text against the smallest id that it starts in."""
    rank = lambda i: (i is None, i or 0)
    first = {}
    for i, t, *_ in rows:
        data = (t or "").encode()
        for p in range(len(data) - length + 1):
            w = data[p : p + length]
            first[w] = min(first.get(w, rank(i)), rank(i))
    out = []
    for i, t, *_ in rows:
        data = (t or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            if first[data[p : p + length]] < rank(i):
                gone[p : p + length] = b"\1" * length
        spans = sum(1 for k in range(len(data)) if gone[k] and (k == 0 or not gone[k - 1]))
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        out.append((i, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def repetitive(rng):
    word = lambda: "".join(rng.choice("abcdefé") for _ in range(rng.randint(2, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(rng.randint(8, 60)) for _ in range(8)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rng.randint(0, 4)):
            parts.append(prose(rng.randint(0, 40)))
            p = rng.choice(passages)
            cut = rng.randrange(len(p) // 2)
            parts.append(p[cut : cut + rng.randint(20, 400)])
        rows.append((rng.randint(0, 1000) * 100 + i, " ".join(parts), "en", "s", 0))
    rows += [rows[3], rows[3], (7, rows[5][1], None, None, 0), (7, rows[6][1] + "x", None, None, 0), (8, rows[5][1][:-1] + "?", None, None, 0)]
    rows += [(None, rows[9][1], None, None, 0), (None, rows[9][1] + " end", None, None, 0), (900, None, None, None, 0), (901, "", None, None, 0), (902, "x" * 49, None, None, 0)]
    rows += [(903, "x" * 50, None, None, 0), (904, "x" * 700, None, None, 0), (905, "ab" * 300, None, None, 0), (906, "yab" + "ab" * 40, None, None, 0)]
    return rows


@pytest.mark.parametrize(("length", "trigger"), [(50, 4), (50, 1), (50, 10**9), (24, 2)])
def test_repeats(spark, monkeypatch, length, trigger):
    if trigger == 1:  # all joins take a shuffle
        monkeypatch.setattr(suffixes, "MOST_BROADCAST", 0)
    rows = repetitive(random.Random(length + trigger % 97))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4).withColumns({c: F.lit("x") for c in ("id", "t", "spans", "place")})
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in remove_repeats(docs, length=length, trigger=trigger).collect()), key=str)
    want = by_hand(rows, length)
    assert got == want
    assert sum(w[2] for w in want) > 3000 and max(w[3] for w in want) > 1


def test_slices(spark, monkeypatch):
    """Large inputs go slice by slice: a step has a part of the rows at a time, and all is found that one slice finds."""
    rows, most, real = repetitive(random.Random(11)), [], suffixes.written
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)

    def told(df, name, *codec):
        out = real(df, name, *codec)
        most[-1][name] = max(most[-1].get(name, 0), out.count())
        return out

    monkeypatch.setattr(suffixes, "written", told)
    for size in (10**9, 1):
        monkeypatch.setattr(suffixes, "SLICE", size, raising=False)
        most.append({})
        got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in remove_repeats(docs).collect()), key=str)
        assert got == by_hand(rows, 50)
    for name in ("cores-shared", "runs-mixed", "runs", "parts", "windows", "inside", "spans"):
        assert 0 < most[1][name] < 0.7 * most[0][name]


def test_long_texts_in_blocks(spark, monkeypatch):
    rng = random.Random(4)
    long = "".join(rng.choice("abcdefgh ") for _ in range(40_000))
    rows = [(5, long, None, None, 0), (6, "start " + long[100:30_000] + "?" + long[30_001:], None, None, 0), (1, long[20_000:20_060], None, None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    want = by_hand(rows, 50)
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in remove_repeats(docs).collect()), key=str) == want
    data = long.encode()
    whole = phrases(data)
    monkeypatch.setattr(suffixes, "BLOCK", 1000)
    assert all((a == b).all() for a, b in zip(whole, phrases(data), strict=True))
    assert len(whole[0]) > 300


def test_equal_windows_have_equal_anchors():
    rng = random.Random(8)
    shared = bytes(rng.choice(b"abc") for _ in range(50))
    for _ in range(50):
        seen = []
        for _ in range(2):
            before = bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 90)))
            data = before + shared + bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 90)))
            starts, cores, places, *_ = parsed(data)
            run = np.searchsorted(starts, len(before), side="right") - 1
            seen.append((cores[run], places[run] - len(before)))
        assert seen[0] == seen[1]


def test_merged():
    spans = np.array([[5, 9], [0, 3], [3, 4], [20, 21], [6, 7]])
    assert merged(spans).tolist() == [[0, 4], [5, 9], [20, 21]]


def test_empty(spark, empty):
    assert remove_repeats(empty).count() == 0
    assert remove_repeats(empty).columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
