import random

import pytest

DOCS = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG"
SYLLABLES = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "é", "ß"]


def words(rng, n):
    return ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n)]


@pytest.fixture(scope="session")
def rng_words():
    return words


@pytest.fixture(scope="session")
def corpus():
    """Documents with copies, near copies, ties, nulls, empty and long texts."""
    rng = random.Random(3)
    rows, base = [], words(rng, 120)
    for i in range(60):
        rows.append((i, " ".join(words(rng, rng.choice([1, 3, 4, 7, 20, 60, 150])))))
    for i in range(60, 90):  # near copies of one text, each another one
        copy = list(base)
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(len(copy))] = words(rng, 1)[0]
        rows.append((i, " ".join(copy)))
    rows += [(90, rows[5][1]), (91, rows[5][1].upper()), (92, rows[70][1] + "\n"), (93, ""), (94, None), (95, " \t\x0b\n"), (96, "\x00 a\x1fb"), (97, " ".join(words(rng, 6000)))]
    rows += [(98, " ".join(base[:60])), (99, " ".join(base + base)), (None, rows[5][1]), (None, None), (7, rows[7][1])]
    langs, sources = ["en", "fr", None], ["b", "a", None, "c"]
    return [(i, t, langs[k % 3], sources[k % 4], len(t or "")) for k, (i, t) in enumerate(rows)]


@pytest.fixture
def docs(spark, corpus):
    return spark.createDataFrame(corpus, DOCS)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture
def clashing():
    """Extra columns whose names the operators may use themselves."""
    from pyspark.sql import functions as F

    names = ["n", "key", "node", "component", "size", "shard", "bucket", "row", "word", "keys", "found", "low", "high", "target", "rule", "vector", "copies", "text_key", "rate_source", "group_node"]
    return lambda df: df.select("*", *[F.lit(i).alias(name) for i, name in enumerate(names)])
