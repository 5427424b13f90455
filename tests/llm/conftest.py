import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randint(2, 8))) for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    """Texts with exact copies, near copies, odd cases, repeated rows and null ids."""
    rng = random.Random(7)
    texts = [sentence(rng, rng.randint(3, 300)) for _ in range(40)]
    texts += [texts[0], texts[1].replace(" ", " \n\t "), texts[1], texts[2] + " ", "", None, "   ", "\n", "?!", "Ä ß 漢字 😀 ok", "one", "one two", "ONE two"]
    long = sentence(rng, 4000)
    texts += [long, long, long + " end"]
    for i in range(12):
        words = texts[3].split() * 3
        words[i * 5] = f"edit{i}"
        texts.append(" ".join(words))
    out = [(i, t, ["en", "fr", None][i % 3], ["a", "b", None, "ü"][i % 4], len(t or "")) for i, t in enumerate(texts)]
    return out + [out[5], out[5], (None, "no id here", None, None, None)]


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def clashing(docs):
    """The same with further columns, named like what operators add."""
    from pyspark.sql import functions as F

    names = ["id", "hits", "score", "lang_pred", "keep_id", "fp", "node", "size", "copies", "_found", "_hits", "chunk"]
    return docs.select("*", *[F.lit("x").alias(n) for n in names])


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
