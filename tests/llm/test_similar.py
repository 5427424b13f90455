import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from trackmill.llm import similar
from trackmill.llm.common import written
from trackmill.llm.simhash import majority
from trackmill.llm.similar import hashed, similar_copies

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randint(2, 8))) for _ in range(n))


def shingle_set(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(min(1, len(words)), len(words) - 4))}


def fingerprint(text):
    return majority(hashed(text))


def linked(x, y):
    """Of two (shingle set, fingerprint)."""
    return ((x[1] ^ y[1]) % 2**64).bit_count() <= 3 or 5 * len(x[0] & y[0]) >= 4 * len(x[0] | y[0]) > 0


def by_hand(rows):
    part, looks = list(range(len(rows))), [(shingle_set(r[1]), fingerprint(r[1])) for r in rows]
    for i in range(len(rows)):
        for j in range(i):
            if part[i] != part[j] and linked(looks[i], looks[j]):
                part = [part[j] if p == part[i] else p for p in part]
    least = {p: min((r[0] for r, q in zip(rows, part, strict=True) if q == p and r[0] is not None), default=None) for p in part}
    return sorted(((r[0], least[p]) for r, p in zip(rows, part, strict=True)), key=str)


def edited(rng, words, times):
    words = list(words)
    for _ in range(times):
        words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
    return " ".join(words)


def copies():
    rng = random.Random(5)
    shared = sentence(rng, 30)
    out = []
    for _ in range(12):
        words = (sentence(rng, rng.randint(20, 160)) + " " + shared).split()
        out += [" ".join(words), *[edited(rng, words, rng.randint(1, 6)) for _ in range(4)], " ".join(words[: int(len(words) * 0.9)])]
    rng.shuffle(out)
    return [(i, t, "en", "s", len(t)) for i, t in enumerate(out)]


@pytest.mark.parametrize("one_of", [8, 1])
def test_similar_copies(spark, rows, one_of):
    own = copies()
    every = own + [(None if r[0] is None else r[0] + 1000, *r[1:]) for r in rows]
    frame = spark.createDataFrame(every, SCHEMA)
    got = sorted(((r.doc_id, r.component_id) for r in similar_copies(frame, one_of=one_of).collect()), key=str)
    assert got == by_hand(every)
    looks = [(shingle_set(r[1]), fingerprint(r[1])) for r in own]
    assert sum(linked(x, y) and ((x[1] ^ y[1]) % 2**64).bit_count() > 3 for i, x in enumerate(looks) for y in looks[:i]) > 10


def test_the_stage_finds_similar_texts_of_distant_fingerprints(spark):
    every = copies()
    got = {r.doc_id for r in corpus_pipeline.near(spark, spark.createDataFrame(every, SCHEMA), "").collect()}
    assert got == {least for _, least in by_hand(every)}


def test_empty(empty):
    assert similar_copies(empty).count() == 0


def test_a_crowd_around_one_text(spark):
    """More texts under one shingle than are compared pair by pair, near enough to one text and too far from others."""
    rng = random.Random(21)
    words = sentence(rng, 120).split()
    crowd = [edited(rng, words, rng.randint(1, 7)) for _ in range(160)]
    added = sentence(rng, 25)
    crowd += [edited(rng, words + added.split(), rng.randint(1, 6)) for _ in range(60)] + [edited(rng, crowd[k].split(), 2) for k in range(0, 60, 2)]
    rng.shuffle(crowd)
    every = [(i, t, "en", "s", len(t)) for i, t in enumerate(crowd)]
    got = sorted(((r.doc_id, r.component_id) for r in similar_copies(spark.createDataFrame(every, SCHEMA)).collect()), key=str)
    assert got == by_hand(every)
    assert 20 < len({c for _, c in got}) < len(got) - 20


def test_pairs_carry_few_sets_at_once(spark):
    """However many pairs a text has, what a share of them carries is bounded; no pair is lost, none comes twice."""
    sets = spark.range(60).select("id", F.sequence(F.lit(1).cast("long"), F.col("id") + 40).alias("set"))
    pairs = written(spark.range(60).alias("p").join(spark.range(60).alias("q"), F.col("p.id") < F.col("q.id")).select(F.col("p.id").alias("a"), F.col("q.id").alias("b")), "pairs")
    left, right = (sets.select(F.col("id").alias(n), F.col("set").alias(x)) for n, x in (("a", "x"), ("b", "y")))
    carried = []
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(similar, "MOVED", 1000)
        for share in similar._joined(pairs, left, right):
            carried.append([(r.a, r.b, r.n, r.m) for r in share.select("a", "b", F.size("x").alias("n"), F.size("y").alias("m")).collect()])
    assert sorted(x for share in carried for x in share) == [(a, b, a + 40, b + 40) for a in range(60) for b in range(a + 1, 60)]
    held = sum(a + 40 for a in range(60))
    assert len(carried) > 10 and max(sum(n for _, _, n, _ in share) for share in carried) < held


def test_few_pairs_of_a_crowd_are_compared(spark, monkeypatch):
    """Texts that share little of what sets them apart from the pivot aren't compared by their sets."""
    rng = random.Random(22)
    words = sentence(rng, 120).split()
    pool = [f"pool{i}" for i in range(12)]
    crowd = []
    for _ in range(150):
        text = list(words)
        for at in rng.sample(range(0, 120, 5), 6):
            text[at : at + 2] = [rng.choice(pool[:4]), rng.choice(pool)]
        crowd.append(" ".join(text))
    crowd += [edited(rng, crowd[k].split(), 2) for k in range(0, 60, 2)]
    every = [(i, t, "en", "s", len(t)) for i, t in enumerate(crowd)]
    compared, real = [], similar._joined

    def joined(pairs, left, right, shares=None):
        if "s" in left.columns:
            compared.append((pairs.count(), len(crowd)))
        return real(pairs, left, right, shares)

    monkeypatch.setattr(similar, "_joined", joined)
    got = sorted(((r.doc_id, r.component_id) for r in similar_copies(spark.createDataFrame(every, SCHEMA)).collect()), key=str)
    assert got == by_hand(every)
    assert compared and all(pairs < 3 * texts for pairs, texts in compared)


def rows_met(spark, since):
    """Rows made by the join of a crowd's shingles, of executions after since."""
    store, out = spark._jsparkSession.sharedState().statusStore(), 0
    executions = store.executionsList()
    for i in range(executions.size()):
        number = executions.apply(i).executionId()
        if number <= since:
            continue
        nodes, counts = store.planGraph(number).allNodes(), store.executionMetrics(number)
        for node in map(nodes.apply, range(nodes.size())):
            if "Join" in node.name() and "pivot_r" in node.desc():
                found = [counts.get(m.accumulatorId()) for m in map(node.metrics().apply, range(node.metrics().size())) if m.name() == "number of output rows"]
                out += sum(int(x.get().replace(",", "")) for x in found if x.isDefined())
    return out


def latest(spark):
    spark.range(1).collect()
    executions = spark._jsparkSession.sharedState().statusStore().executionsList()
    return max(executions.apply(i).executionId() for i in range(executions.size()))


def test_rows_met_in_a_crowd_grow_with_its_texts(spark):
    """Near copies with edits of a small pool: twice the texts don't meet four times as often."""
    made = {}
    for n in (150, 300):
        rng = random.Random(23)
        words = sentence(rng, 120).split()
        crowd = []
        for i in range(n):
            text = list(words)
            for at in rng.sample(range(0, 120, 6), rng.randint(1, 6)):
                text[at] = f"pool{at}" if rng.random() < 0.5 else f"own{i}at{at}"
            crowd.append(" ".join(text))
        every = [(i, t, "en", "s", len(t)) for i, t in enumerate(dict.fromkeys(crowd))]
        since = latest(spark)
        got = sorted(((r.doc_id, r.component_id) for r in similar_copies(spark.createDataFrame(every, SCHEMA)).collect()), key=str)
        made[n] = rows_met(spark, since)
        assert got == by_hand(every)
        assert 1 < len({c for _, c in got}) < len(got) - 20
    assert made[300] < 3 * made[150] + 300 and made[300] < 20 * 300, made
