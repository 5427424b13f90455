import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackmill.llm import decontaminate, language_id, lm_score, toxicity
from trackmill.llm.common import crc_mod, held_out
from trackmill.llm.lm_score import END_WORD, exchange, score_texts

SYLLABLES = {"aa": "ka ro mi te lu".split(), "bb": "zei fur ock ing ard".split(), "cc": "ña llo que ció esa".split()}


def text_of(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(5)
    rows = [(i, text_of(rng, lang := rng.choice("abc") * 2, rng.randint(1, 40)), lang, "s", 0) for i in range(300)]
    rows += [(1000, None, "aa", "s", 0), (1001, "", None, "s", 0), (1002, "12 34 !!", "bb", "s", 0), (1003, "karomi", None, "s", 0), (None, "zeifur ocking", "bb", "s", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_crc(spark):
    got = spark.range(50).select("id", crc_mod(F.col("id"), 4).alias("m"), held_out(F.col("id"), 4).alias("h")).collect()
    assert all(r.m == zlib.crc32(str(r.id).encode()) % 4 and r.h == (r.m == 2) for r in got)


def test_language(corpus):
    model = language_id.train_on_kept_in(corpus)
    assert model.langs == ["aa", "bb", "cc"]
    got = {r.doc_id: r for r in language_id.identify(corpus.withColumn("score", F.lit("x")), model).withColumn("h", held_out(F.col("doc_id"), 4)).collect()}
    held = [r for r in got.values() if r.h and r.lang and r.lang_pred != "und"]
    assert len(held) > 40 and sum(r.lang == r.lang_pred for r in held) / len(held) > 0.95
    assert [(got[i].lang_pred, got[i].score) for i in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert got[1003].lang_pred == "aa" and got[None].lang_pred == "bb" and all(0 <= r.score <= 1 for r in got.values())
    kept = language_id.drop_unidentified(corpus, model)
    assert kept.columns == corpus.columns and kept.count() == len(got) - 3


def counts_of(rows):
    found = Counter((lang, w) for lang, text in rows for w in language_id.words(text))
    grams = Counter()
    for (lang, w), n in found.items():
        for size in range(1, 6):
            grams.update({(lang, g): n * k for g, k in Counter(language_id.grams(w, size)).items()})
    return [(*k, n) for k, n in found.items()], [(*k, n) for k, n in grams.items()]


def language_by_hand(rows, text):
    """The docstring's words, with plain dictionaries."""
    words, grams = counts_of(rows)
    langs = sorted({r[0] for r in rows})

    def log(table, name, lang):
        own = {(x, g): n for x, g, n in table}
        return math.log((own.get((lang, name), 0) + 0.5) / (sum(n for (x, _), n in own.items() if x == lang) + 0.5 * len({g for _, g in own})))

    known = {name for name in {r[1] for r in words} if sum(r[2] for r in words if r[1] == name) >= 2}
    total = dict.fromkeys(langs, 0.0)
    for w in language_id.words(text):
        if w in known:
            for lang in langs:
                total[lang] += log(words, w, lang)
            continue
        for n in range(5, 0, -1):
            table = [r for r in grams if len(r[1]) == n]
            found = [g for g in language_id.grams(w, n) if sum(r[2] for r in table if r[1] == g) >= 2]
            if found:
                for lang in langs:
                    total[lang] += sum(log(table, g, lang) for g in found) / len(found)
                break
    best = max(langs, key=lambda x: total[x])
    return best, 1 / sum(math.exp(t - total[best]) for t in total.values())


def test_language_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(lang, text_of(rng, lang, 12)) for lang in ("aa", "bb", "cc") for _ in range(4)]
    frame = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], "_pick long, text string, lang string").withColumn("pick", F.lit(1))
    model = language_id.train(frame.union(frame), id_col="_pick")
    probes = [text_of(rng, lang, n) for lang in ("aa", "bb", "cc") for n in (1, 3, 9)] + ["qqqq", "karofur", rows[0][1] * 3, "".join(rows[5][1].split()) * 9]
    got = language_id.identify(spark.createDataFrame([(t,) for t in probes], "text string"), model).collect()
    for r in got:
        want = language_by_hand(rows, r.text)
        assert (r.lang_pred, r.score) == (want[0], pytest.approx(want[1], rel=1e-3)), r.text


def test_backoff_goes_to_shorter_grams():
    model = language_id.model_from_counts(*counts_of([("x", "abcdef " * 4 + "abc " * 2), ("y", "uvwxyz " * 5)]))
    assert model.score_word("abc").tolist() == model.logs[model.words["abc"]].tolist()
    longest = [g for g in language_id.grams("abcdxq", 5) if g in model.grams]
    assert longest and model.score_word("abcdxq") == pytest.approx(sum(model.logs[model.grams[g]] for g in longest) / len(longest))
    assert model.score_word("qqa") == pytest.approx(model.logs[model.grams["a"]])


def test_long_words_and_texts_are_read_whole():
    rng = random.Random(6)
    run = {lang: "".join(text_of(rng, lang, 300).split()) for lang in ("aa", "bb")}
    model = language_id.model_from_counts(*counts_of([(lang, text_of(rng, lang, 200)) for lang in ("aa", "bb")]))
    predict = language_id.Predictor(model).predict
    assert predict(run["aa"][:64] + run["bb"][:500])[0] == "bb" and predict(run["bb"][:64] + run["aa"][:500])[0] == "aa"
    assert predict("12 " * 200_000 + text_of(rng, "bb", 30))[0] == "bb" and predict("x" * 500_000) is not None


def test_language_sample_is_bounded(spark):
    rows = [(None, f"karo mite {i}", "aa") for i in range(50)] + [(None, "zeifur", "bb")] * 50 + [(7, "lukaro", "aa"), (7, "zeifur", "bb")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.train(frame, max_docs=10, least=1)
    assert sum(np.exp(model.logs[model.words[w]]).sum() > 0 for w in model.words) <= 20
    assert language_id.identify(frame, model).count() == len(rows)


def test_language_without_labels(corpus, empty):
    model = language_id.train(corpus.where("lang = 'none'"))
    assert {r.lang_pred for r in language_id.identify(corpus, model).collect()} == {"und"}
    assert language_id.identify(empty, model).count() == 0


def semi_global(item, text):
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def test_decontamination_against_brute_force(spark):
    rng = random.Random(9)
    letters = "abcdefghij äé"
    items = [(i, "".join(rng.choice(letters) for _ in range(n))) for i, n in enumerate((40, 60, 100, 5, 0, 25, 64, 65))] + [(8, None), (9, "  "), (None, "x" * 30)]
    docs = []
    for i in range(60):
        body = "".join(rng.choice(letters) for _ in range(rng.randint(0, 80)))
        item = list(rng.choice(items[:8])[1])
        for _ in range(rng.randint(0, 7)):
            if item:
                at = rng.randrange(len(item))
                item[at : at + rng.randint(0, 1)] = rng.choice(["", "q", "A"])
        docs.append((i, body[:30] + "".join(item).replace(" ", rng.choice([" ", "\n "])) + body[30:]))
    docs += [(100, None), (101, ""), (102, items[2][1] * 2)]
    want = {}
    for i, text in docs:
        t = decontaminate.normalised(text)
        lines = {decontaminate.normalised(line) for line in (text or "").splitlines()}
        # too short for an edit, an item counts where it makes up a line
        found = lambda n, t=t, lines=lines: semi_global(n, t) <= int(len(n) * 0.05) if len(n) >= 20 else n in lines
        want[i] = sorted(k for k, x in items if k is not None and (n := decontaminate.normalised(x)) and found(n))
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("hits", F.lit(1))
    b = spark.createDataFrame(items, "item_id long, text string")
    blocks = decontaminate.benchmark_hits(d, b, block_bytes=100)
    for frame in (decontaminate.benchmark_hits(d, b), blocks):
        assert frame.columns == d.columns
        assert {r.doc_id: [h.item_id for h in r.hits] for r in frame.collect()} == want
    plan = blocks._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in plan  # each block's hits are written before the next is read
    named = b.withColumn("item_id", F.concat(F.lit("item "), "item_id"))
    got = {r.doc_id: sorted(h.item_id for h in r.hits) for r in decontaminate.benchmark_hits(d.union(d), named).collect()}
    assert got == {i: sorted(f"item {k}" for k in w) for i, w in want.items()}
    got = {r.doc_id: r for r in decontaminate.contamination(d, b).collect()}
    assert all(got[i].contaminated == bool(w) and got[i].item_ids == w for i, w in want.items()) and sum(map(bool, want.values())) > 20
    kept = decontaminate.drop_contaminated(d, b)
    assert kept.columns == d.columns and {r.doc_id for r in kept.collect()} == {i for i, w in want.items() if not w}
    assert decontaminate.contamination(d, b.limit(0)).where("contaminated").count() == 0 and decontaminate.contamination(d.limit(0), b).count() == 0


def test_toxicity(spark):
    rng = random.Random(2)
    bad = "grubber snot twerp".split()
    docs, labels = [], []
    for i in range(500):
        words = text_of(rng, rng.choice(["aa", "bb"]), rng.randint(5, 60)).split()
        toxic = i % 5 == 0
        if toxic:
            for _ in range(rng.randint(2, 5)):
                words.insert(rng.randrange(len(words)), rng.choice([*bad, "you " + rng.choice(bad), "snotten" + rng.choice("abcdefgh")]))
        docs.append((i, " ".join(words)))
        if i % 7:
            labels.append((i, int(toxic)))
    docs += [(900, None), (901, ""), (902, "sn0t"), (None, "twerp")]
    labels += [(1, None), (None, 1), (labels[0][0], labels[0][1])]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("raw", F.lit("x")).withColumn("features", F.lit(1))
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(d, lab.where(~held_out(F.col("doc_id"), 4)))
    assert {"grubber", "snot", "twerp"} <= model.lexicon
    out = toxicity.score(d, model)
    assert out.columns == [*d.columns, "score"]
    got = {r.doc_id: r.score for r in out.collect()}
    assert all(0 <= s <= 1 for s in got.values()) and len(got) == len(docs)
    held = [i for i in range(500) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum((got[i] >= 0.3) == (i % 5 == 0) for i in held) / len(held) > 0.95
    constant = toxicity.train(d, lab.where("toxic = 0"))
    assert {r.score for r in toxicity.score(d, constant).collect()} == {0.0}
    assert toxicity.score(d.limit(0), model).count() == 0


def toxic_rows(n, every):
    rng = random.Random(12)
    docs = [(i, text_of(rng, "aa", 30) + (" you grubber snot grubber" if i % every == 0 else "")) for i in range(n)]
    return docs, [(i, int(i % every == 0)) for i in range(n)]


def test_toxicity_calibration_has_both_classes(spark):
    """However the labels fall, toxic documents are found: few of them, all in one part of a hash, or one alone."""
    docs, labels = toxic_rows(300, 5)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    part = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(3))
    for shown in (lab.where((part > 0) | (F.col("toxic") == 0)), lab.where((part == 0) | (F.col("toxic") == 0)), lab.where("toxic = 0 OR doc_id < 40")):
        model = toxicity.train(d, shown)
        got = {r.doc_id: r.score for r in toxicity.score(d, model).collect()}
        assert sum((got[i] >= 0.3) == bool(t) for i, t in labels) > 0.97 * len(labels)
    one = toxicity.train(d, lab.where("toxic = 0 OR doc_id = 0"))
    assert one.calibration is None and one.trees is not None
    none = toxicity.train(d, lab.limit(0))
    assert {r.score for r in toxicity.score(d, none).collect()} == {0.0}


def test_toxicity_of_long_and_repeated_texts(spark):
    docs, labels = toxic_rows(200, 4)
    many = docs + docs[:3] + [(0, "another text of that id")] * 2 + [(900, "you grubber snot " * 40_000)]
    d = spark.createDataFrame(many, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int").withColumn("_id", F.lit(1))
    model = toxicity.train(d.withColumn("_id", F.lit("x")), lab)
    got = toxicity.score(d, model).collect()
    assert len(got) == len(many) and all(0 <= r.score <= 1 for r in got)
    assert all(r.score >= 0.3 for r in got if r.doc_id == 900)


def test_toxicity_features():
    f = dict(zip(toxicity.FEATURES, toxicity.features("You are a SNOT, you sn0t! snotter", frozenset(["snot", "snott*"])), strict=True))
    assert f["lexicon_words"] == 1 and f["stem_words"] == 1 and f["disguised_density"] > 0 and f["second_person_near"] > 0 and f["capital_words"] > 0 and f["exclamations"] > 0
    assert toxicity.features(None, frozenset()) == toxicity.features("", frozenset()) == (0.0,) * len(toxicity.FEATURES)


def test_exchange_finds_alternating_classes():
    rng = random.Random(4)
    left, right = list(range(0, 8)), list(range(8, 16))
    table = np.zeros((17, 17))
    seq = [16]
    for _ in range(4000):
        seq += [rng.choice(left), rng.choice(right)]
    for a, b in zip(seq, seq[1:], strict=False):
        table[a, b] += 1
    of = exchange(table, {16: 2}, classes=2, total=3)
    assert len({of[i] for i in left}) == len({of[i] for i in right}) == 1 and of[0] != of[8]


def test_lm_base_against_counts(spark, docs, rows):
    held = F.coalesce(F.col("doc_id") % 3 == 1, F.lit(False))
    got = score_texts(docs.withColumn("held", held).withColumn("word", F.lit("x")), ~held, keep=["doc_id", "held", "text"]).collect()
    tokens = lambda t: [*(t or "").encode().lower().split(), END_WORD]
    counts = Counter(w for r in rows if r[0] is None or r[0] % 3 != 1 for w in tokens(r[1]))
    n, v = sum(counts.values()), len(counts)
    assert len(got) == len(rows)
    for r in got:
        row = tokens(r.text)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(row), sum(counts[w] > 0 for w in row), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in row))
        assert r.score < 0 and r.perplexity > 1


def test_lm_probabilities_sum_to_one(spark):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(30)]
    texts = [" ".join(rng.choice(vocabulary[: 10 + i % 20]) for _ in range(rng.randint(1, 12))) for i in range(80)]
    train = [(i, t, True) for i, t in enumerate(texts)]
    seen = sorted({w for t in texts for w in t.split()})
    probe = [(1000 + i, f"{w} " if w else "", False) for i, w in enumerate([*seen, "neverseen", ""])]
    frame = spark.createDataFrame(train + probe, "doc_id long, text string, learn boolean")
    got = {r.doc_id: r.score for r in score_texts(frame, F.col("learn"), keep=["doc_id"]).collect()}
    # texts of one word and the end: their chance is first step times the step to the end, the end alone is one more
    first = {w: 10 ** got[1000 + i] for i, w in enumerate([*seen, "neverseen", ""])}
    assert all(0 < p < 1 for p in first.values()) and sum(first.values()) < 1


def test_lm_without_training(spark, docs, empty):
    got = score_texts(docs, F.lit(False), keep=["doc_id"])
    assert got.where("n_known > 0 OR train_tokens > 0 OR score IS NULL").count() == 0 and got.count() == docs.count()
    assert score_texts(empty, F.lit(True), keep=["doc_id"]).count() == 0


def lm_texts(n=120):
    """Texts over words of several kinds that alternate, with many rare words."""
    rng = random.Random(8)
    kinds = [[f"{k}{i}" for i in range(12)] for k in "abcd"]
    out = []
    for i in range(n):
        row = [w for _ in range(rng.randint(0, 12)) for w in (rng.choice(kinds[0]), rng.choice(kinds[1]), rng.choice(kinds[2 + i % 2]))]
        out.append(" ".join(row + [f"rare{rng.randint(0, 90)}"] * rng.randint(0, 2) + [f"Odd{i}"] * (i % 3 == 0)))
    return [*out, None, "", "  \n", out[3], out[3]]


@pytest.mark.parametrize("most", [100_000, 20, 0])
def test_lm_score_against_its_definition(spark, most):
    """Class transitions and emissions, counted anew from the classes that were found."""
    texts = [(i, t, i % 5 != 2) for i, t in enumerate(lm_texts())]
    frame = spark.createDataFrame(texts, "doc_id long, text string, learn boolean").repartition(3)
    fitted = lm_score.fit(frame.select(F.col("doc_id").alias("k0"), "learn", "text"), most_words=most)
    all_ = len(fitted.model.log_step)
    end, rare = all_ - 2, all_ - 1
    tokens = lambda t: [*(t or "").encode().lower().split(), END_WORD]
    counts = Counter(w for _, t, learn in texts if learn for w in tokens(t))
    listed = sorted((w for w, c in counts.items() if c >= 5 and w != END_WORD), key=lambda w: (-counts[w], w))[:most]
    own = dict(zip(listed, fitted.model.classes.tolist(), strict=False)) | {END_WORD: end}
    tail = {bytes(r.word): r for r in fitted.tail.collect()}
    assert set(tail) == set(counts) - set(own) and all(r.c == counts[w] and (r["class"] == rare) == (r.c < 5) for w, r in tail.items())
    class_of = lambda w: own[w] if w in own else tail[w]["class"] if w in tail else rare
    history = lambda w: own.get(w, rare)
    step = np.full((all_, all_), 0.5)
    for _, t, learn in texts:
        row = tokens(t)
        for a, b in zip([END_WORD, *row], row, strict=False):
            step[history(a), class_of(b)] += learn
    size = Counter()
    for w, c in counts.items():
        size[class_of(w)] += c
    in_rare = sum(class_of(w) == rare for w in counts)
    emit = lambda w: (counts[w] + 1) / (size[rare] + in_rare + 1) if class_of(w) == rare else counts[w] / size[class_of(w)]
    step /= step.sum(axis=1, keepdims=True)
    got = {r.doc_id: r for r in score_texts(frame, F.col("learn"), keep=["doc_id"], most_words=most).collect()}
    n, v = sum(counts.values()), len(counts)
    for i, t, _ in texts:
        row = tokens(t)
        assert got[i].score == pytest.approx(sum(math.log10(step[history(a), class_of(b)] * emit(b)) for a, b in zip([END_WORD, *row], row, strict=False)))
        assert got[i].base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in row))
    # after any word the chances of all words, and of one never seen, sum to one
    chances = [sum(emit(w) for w in counts if class_of(w) == k) + (k == rare) / (size[rare] + in_rare + 1) for k in range(all_) if size[k] or k == rare]
    assert chances == pytest.approx([1.0] * len(chances))
    if most > 20:
        # the last two kinds have the same neighbours
        kinds = [{own[w] for w in listed if w[:1] in k} for k in (b"a", b"b", b"cd")]
        assert all(kinds[i] and not kinds[i] & kinds[j] for i in range(3) for j in range(i))


def test_words_beyond_the_dictionary_are_clustered(spark, docs):
    want = {(r.doc_id, r.text): r.base_score for r in score_texts(docs, F.lit(True), keep=["doc_id", "text"]).collect()}
    got = {(r.doc_id, r.text): r.base_score for r in score_texts(docs, F.lit(True), keep=["doc_id", "text"], most_words=3).collect()}
    assert got == {k: pytest.approx(x) for k, x in want.items()}
    frame = docs.select("doc_id", "text", *[F.lit(1).alias(c) for c in ("_key", "key", "ids", "rare", "times", "learn", "k0", "n", "word", "class")])
    assert score_texts(frame, F.lit(True), keep=frame.columns).columns[: len(frame.columns)] == frame.columns


def test_numerals_are_no_letters(spark):
    from trackmill.llm.language_id import words

    assert words("½ ²³ Ⅷ ① 42 _") == [] and words("m² und Ⅷa, 3½b") == ["m", "und", "a", "b"]
