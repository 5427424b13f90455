import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from trackmill.llm import line_dedup
from trackmill.llm.line_dedup import drop_repeated_lines, edit_distance_within, repeated_lines


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def mutate(rng, s, n):
    s = list(s)
    for _ in range(n):
        what, at = rng.randrange(3), rng.randrange(len(s))
        if what == 0:
            s[at] = rng.choice("abcdé漢")
        elif what == 1:
            s.insert(at, rng.choice("abcdé漢"))
        elif len(s) > 8:
            s.pop(at)
    return "".join(s)


def test_edit_distance(spark):
    rng = random.Random(1)
    for k in (1, 2, 3):
        pairs = []
        for _ in range(300):
            a = "".join(rng.choice("abcdé") for _ in range(rng.randint(k + 1, 40)))
            b = mutate(rng, a, rng.randint(0, k + 2))
            if abs(len(a) - len(b)) <= k and len(a) > k and len(b) > 0:
                pairs.append((a, b))
        got = spark.createDataFrame(pairs, "a string, b string").select("a", "b", edit_distance_within(F.col("a"), F.col("b"), k).alias("d"))
        for r in got.collect():
            d = distance(r.a, r.b)
            assert (r.d == d) if d <= k else r.d > k, (k, r, d)


def near(a, b):
    """Whether two lines are within the edits that the shorter one allows, none of them on a digit."""
    least = min(len(a), len(b))
    k = 2 if least >= 20 else 1 if least >= 8 else 0
    return k > 0 and abs(len(a) - len(b)) <= k and re.sub(r"\D", "", a) == re.sub(r"\D", "", b) and distance(a, b) <= k


def by_hand(rows):
    """Lines in order of their first places: one goes if an earlier one that stays is near."""
    strip = lambda s: re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", s)
    docs = {(r[0], r[1] or ""): [(at, strip(line)) for at, line in enumerate((r[1] or "").split("\n")) if strip(line)] for r in rows}
    first = {}
    for (i, t), own in docs.items():
        for at, line in own:
            place = (i is None, i or 0, t, at)
            first[line] = min(first.get(line, place), place)
    stay, goes = [], {}
    for line in sorted(first, key=first.get):
        kept = next((x for x in stay if near(x, line)), None)
        if kept is None:
            stay.append(line)
        else:
            goes[line] = kept
    out = {}
    for (i, t), own in docs.items():
        gone, close = [], 0
        for at, line in own:
            place = first[goes.get(line, line)]
            if (i is None, i or 0, t, at) != place:
                gone.append((at, None if place[0] else place[1]))
                close += line in goes
        out[i, t] = (i, len(own), len(gone), close, sorted(gone, key=str))
    return out


def line_rows():
    rng = random.Random(3)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(20, 90))) for _ in range(12)]
    rows = []
    for i in range(40):
        chosen = [mutate(rng, rng.choice(base), rng.randint(0, 4)) for _ in range(rng.randint(0, 5))] + rng.choice([[], ["short"], ["", "  x  ", "short"], [base[0], base[0] + " "]])
        rows.append((i, "\n".join(chosen), "en", "s", 0))
    rows += [(100, None, None, None, None), (101, "", None, None, None), (102, "Ertionat.\nshorts\nfour\nErtionnt.\nClick here to read\nClick here to reads\nfours", None, None, None)]
    # one id with two texts, a row that repeats, and rows without ids: no line goes for another text's sake
    rows += [(103, base[5], None, None, None), (103, "a line of its own, in the second text of its id\n" + base[6], None, None, None), (103, base[5], None, None, None)]
    return rows + [(None, base[1], None, None, None), (None, base[2] + "\nnew and never seen line", None, None, None), (None, "x\nanother one without an id, and unique", None, None, None)]


@pytest.mark.parametrize("most", [500_000, 0])
def test_repeated_lines(spark, most, monkeypatch):
    monkeypatch.setattr(line_dedup, "MOST_BROADCAST", most)
    rows = line_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("line", F.lit("x"))
    got = repeated_lines(docs)
    have = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.n_near, sorted((tuple(x) for x in r.dropped), key=str)) for r in got.collect()), key=str)
    assert have == sorted(by_hand(rows).values(), key=str)
    assert sum(h[3] for h in have) > 20 and [h for h in have if h[0] == 102][0][2:4] == (2, 2)


def test_drop_and_empty(spark, docs, empty):
    rows = line_rows()
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumns({c: F.lit("x") for c in ("_gone", "_gone_id", "t", "at")})
    out = drop_repeated_lines(frame)
    assert out.columns == frame.columns and out.count() == len(rows)
    gone = {key: {g[0] for g in found[4]} for key, found in by_hand(rows).items()}
    want = [(i, t and "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone[i, t])) for i, t, *_ in rows]
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted(want, key=str)
    assert repeated_lines(empty).count() == 0
    got = repeated_lines(docs)
    assert got.count() == len({(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()})


def test_a_segment_that_very_many_lines_share(spark):
    """Refined keys give the same links as plain ones, and no task forms a key's pairs alone."""
    rng = random.Random(11)
    tails = ["".join(rng.choice("abcdefghijklmnop0123456789") for _ in range(24)) for _ in range(1500)]
    tails += [mutate(rng, t, 1) for t in tails[:60]] + [mutate(rng, t, 2) for t in tails[60:120]]
    lines = ["https://www." + t for t in tails]
    frame = spark.createDataFrame([(x,) for x in lines], "line string").repartition(4)
    links = {n: {frozenset((r.a, r.b)) for r in line_dedup.line_links(frame, heavy=n).collect()} for n in (10, 10**9)}
    assert links[10] == links[10**9]
    want = {frozenset((a, b)) for i, a in enumerate(lines[1500:], 1500) for b in lines[:i] if a != b and near(a, b)}
    assert len(links[10]) == len(want) > 40


def test_each_line_is_indexed_under_its_segments(spark):
    rows = spark.createDataFrame([(1, "abcdefghijklmnopqrstuvwxyz äöü"), (2, "x" * 8), (3, "x" * 7), (4, "y" * 21)], "h1 long, line string")
    got = {r.h1: (r.own, r.all) for r in line_dedup.entries(rows).groupBy("h1").agg(F.count_if("own").alias("own"), F.count("*").alias("all")).collect()}
    assert got[1] == (3, 12) and got[2][0] == 2 and got[4][0] == 3 and 3 not in got


def test_numbered_lines_stay(spark):
    """Lines that differ in digits are no copies, and a chain of edits doesn't reach from one end to the other."""
    numbered = [(i, f"Section {i:03d}\nTotal: {i % 10}\nPayment due 2031-07-{i % 28 + 1:02d}", None, None, 0) for i in range(60)]
    words = [(1000 + i, "chain of lines " + "a" * i + "b" * (8 - i), None, None, 0) for i in range(9)]
    rows = numbered + words
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    have = {r.doc_id: (r.n_dropped, r.n_near) for r in repeated_lines(docs).collect()}
    want = by_hand(rows)
    assert have == {i: (x[2], x[3]) for (i, _), x in want.items()}
    assert sum(near for _, near in have.values()) == 6 and not any(have[i][1] for i in range(60))


@pytest.mark.parametrize("shape", ["random", "chain", "hub"])
def test_stars(spark, shape):
    rng = random.Random(5)
    n = 40
    pairs = {"random": {tuple(sorted(rng.sample(range(n), 2))) for _ in range(50)}, "chain": {(i, i + 1) for i in range(n - 1)}, "hub": {(7, i) for i in range(n) if i != 7}}[shape]
    at = list(range(n))
    if shape == "random":
        rng.shuffle(at)
    stay, want = [], {}
    linked = {frozenset(p) for p in pairs}
    for line in sorted(range(n), key=at.__getitem__):
        kept = next((x for x in stay if frozenset((x, line)) in linked), None)
        if kept is None:
            stay.append(line)
        else:
            want[line] = at[kept]
    places = spark.createDataFrame([(i, at[i]) for i in range(n)], "line long, place long")
    links = spark.createDataFrame(sorted(pairs), "a long, b long")
    assert {r.line: r.kept for r in line_dedup.stars(links, places).collect()} == want
    assert line_dedup.stars(links.limit(0), places).count() == 0


def test_stages_compile(spark):
    """No generated method is too large: without Spark's fallback such a stage would be an error."""
    spark.conf.set("spark.sql.codegen.fallback", "false")
    try:
        docs = spark.createDataFrame(line_rows(), "doc_id long, text string, lang string, source string, n_chars long")
        assert repeated_lines(docs).count() > 0
    finally:
        spark.conf.unset("spark.sql.codegen.fallback")


def test_only_lines_with_white_space_at_their_ends_are_trimmed(spark):
    """Each character at either end, alone or mixed; other white space stays. Lines without any aren't gone through."""
    odd = ["", " ", "a", " a", "a\t", "\x0b\x0ca b\r", "\r\r", " a ", "ä ", " 　 ", "a\tb"]
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(odd)], "doc_id long, text string")
    got = {r.id: r.line for r in line_dedup.lines(frame).collect()}
    assert got == {i: x.strip(" \t\n\x0b\x0c\r") for i, x in enumerate(odd) if x.strip(" \t\n\x0b\x0c\r")}
    plan = line_dedup.lines(frame)._jdf.queryExecution().optimizedPlan().toString()
    assert "trim(" in plan and all(" THEN trim(" in part for part in re.findall(r".{0,6}trim\(", plan))
