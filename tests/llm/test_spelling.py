import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from trackmill.llm.spelling import near_words, roots, spelling_variants, word_counts

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counts_by_hand(rows):
    out = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    """Whether b comes from a by one edit, tried out."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def by_hand(rows):
    counts = counts_by_hand(rows)
    near = defaultdict(list)
    words = sorted(counts)
    for i, a in enumerate(words):
        for b in words[:i]:
            if one_edit(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= 2 * counts[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {w: (form[w], root(w), counts[w], len(near[w]), counts[form[w]] if form[w] else None) for w in words}


def spelled(rng):
    stems = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(4, 9))) for _ in range(60)]
    rows = []
    for i in range(150):
        said = []
        for _ in range(rng.randint(0, 60)):
            w = list(rng.choice(stems[: rng.choice([3, 10, 60])]))
            if rng.random() < 0.3:
                at, what = rng.randrange(len(w)), rng.randrange(3)
                w[at : at + 1] = [] if what == 0 else [rng.choice("abÀ")] if what == 1 else [w[at], rng.choice("aÿ×")]
            said.append("".join(w).upper() if rng.random() < 0.2 else "".join(w))
        rows.append((i, rng.choice([" ", "-", "1", " 漢 "]).join(said), "en", "s", 0))
    rows.append((899, " ".join(["planeten"] * 20 + ["Planete"] * 8 + ["planet"] * 3), None, None, 0))
    return rows + [(900, None, None, None, 0), (901, "", None, None, 0), (902, "x" * 50_000 + " " + "x" * 49_999, None, None, 0), (902, "x" * 50_000 + " " + "x" * 49_999, None, None, 0), (None, ("x" * 50_000 + " ") * 2, None, None, 0)]


@pytest.mark.parametrize("heavy", [200, 2])
def test_variants(spark, heavy):
    rows = spelled(random.Random(5))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5).withColumns({c: F.lit("x") for c in ("word", "n", "key", "id")})
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling_variants(docs, heavy=heavy).collect()}
    want = by_hand(rows)
    assert got == want
    assert sum(v[3] for v in want.values()) > 200 and sum(1 for w, v in want.items() if v[0] and v[0] != v[1])


def test_crowded_chunks_lose_nothing(spark):
    """All words over a few letters: each chunk is shared by very many words."""
    import itertools

    words = ["".join(w) for n in (4, 5) for w in itertools.product("abç", repeat=n)] + ["long" * 8 + x for x in ("", "a", "b", "ab")]
    frame = spark.createDataFrame([(w, 3) for w in words], "word string, n long").repartition(3)
    want = {frozenset((a, b)) for i, a in enumerate(words) for b in words[:i] if one_edit(a, b)}
    for heavy in (5, 10**6):
        got = [frozenset((r.a, r.b)) for r in near_words(frame, heavy).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_roots_of_long_chains(spark):
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(37)] + [("a", "b")], "word string, form string")
    assert {r.word: r.root for r in roots(forms).collect()} == {f"w{i}": "w37" for i in range(37)} | {"a": "b"}


def test_counts_are_handed_on_in_parts(spark):
    rows = spelled(random.Random(6))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.word: r.n for r in word_counts(docs, held=3).where("n >= 3").collect()}
    assert got == counts_by_hand(rows)


def test_empty(spark, empty):
    assert spelling_variants(empty).count() == 0
    assert spelling_variants(empty).columns == ["word", "form", "root", "n", "n_near", "form_n"]
