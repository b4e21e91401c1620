import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from smelter.llm import quality_rules as rules
from smelter.llm.quality_rules import distance, kept_documents, quality

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
EXTRA = ["a b c a b c d", "x\ny\nx\n\n \n\nx", "é " * 60, "#*$%&|<> " * 10, "a b " * 100, " ".join(map(str, range(50))), " ".join(map(str, range(49))), "a\x0b\x0cb\r\nc"]


def base_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated), failed)


def test_base_counts_are_those_of_whole_texts(spark, docs, corpus, clashing):
    more = spark.createDataFrame([(1000 + i, t, "en", "a", 0) for i, t in enumerate(EXTRA)], docs.schema)
    texts = [(i, t) for i, t, *_ in corpus] + [(1000 + i, t) for i, t in enumerate(EXTRA)]
    found = Counter((r["doc_id"], *(r[c] for c in BASE)) for r in quality(clashing(docs.unionByName(more))).collect())
    assert found == Counter((i, *base_counts(t or "")) for i, t in texts)


def js(a, b):
    total = 0.0
    for x, y in zip(a, b, strict=True):
        p, q = x / sum(a), y / sum(b)
        m = (p + q) / 2
        total += (p * math.log2(p / m) if p else 0) / 2 + (q * math.log2(q / m) if q else 0) / 2
    return math.sqrt(max(total, 0))


@pytest.mark.parametrize(("a", "b"), [([1, 2, 3], [3, 2, 1]), ([1, 0], [0, 1]), ([5, 5], [1, 1]), ([0, 7, 0], [1, 1, 1])])
def test_distance_is_jensen_shannon(spark, a, b):
    row = spark.createDataFrame([(a, b)], "a ARRAY<LONG>, b ARRAY<LONG>").select(distance(F.col("a"), F.col("b")).alias("d")).first()
    assert row["d"] == pytest.approx(js(a, b), abs=1e-9)


def test_empty_histograms_have_no_distance(spark):
    df = spark.createDataFrame([([0, 0], [1, 1])], "a ARRAY<LONG>, b ARRAY<LONG>")
    assert df.select(distance(F.col("a"), F.col("b")).alias("d")).first()["d"] is None


@pytest.fixture
def judged_docs(spark, rng_words):
    import random

    rng = random.Random(5)
    clean = [(i, " ".join(w if rng.random() < 0.6 else rng.choice(rules.COMMON[:15]) for w in rng_words(rng, 150)) + ".", "en") for i in range(80)]
    junk = [(100, " ".join(f"{w.upper()}$$$" for w in rng_words(rng, 150)), "en"), (101, "0123456 " * 3 + " ".join(str(i * 977) for i in range(200)), "en")]
    other = [(200, " ".join(str(i * 977) for i in range(60)), "xx")]  # too small a language to compare with
    return spark.createDataFrame(clean + junk + other, "doc_id LONG, text STRING, lang STRING")


def test_texts_far_from_their_language_are_rejected(judged_docs):
    kept = {r["doc_id"]: r["kept"] for r in quality(judged_docs).collect()}
    assert not kept.pop(100) and not kept.pop(101) and all(kept.values())


def test_texts_without_common_words_are_rejected(spark, rng_words):
    import random

    rng = random.Random(6)
    rare = [w for w in rng_words(rng, 20_000) if w not in rules.COMMON]
    good = [(i, " ".join(rng.choice(rules.COMMON[:15]) if rng.random() < 0.22 else rng.choice(rare) for _ in range(150)), "en") for i in range(80)]
    other = [(300 + i, " ".join(rng.choices(rare, k=150)), "yy") for i in range(20)]  # a language that has none of these words
    found = {r["doc_id"]: r for r in quality(spark.createDataFrame([*good, (100, " ".join(rng.choices(rare, k=150)), "en"), *other], "doc_id LONG, text STRING, lang STRING")).collect()}
    junk = found.pop(100)
    assert not junk["base_failed"] and junk["class_distance"] < rules.CLASS_LIMIT and not junk["kept"]
    assert all(r["kept"] for r in found.values())


def test_kept_documents_have_their_columns(judged_docs, docs, no_docs, clashing):
    kept = kept_documents(clashing(judged_docs))
    assert kept.columns == clashing(judged_docs).columns
    assert {r["doc_id"] for r in kept.collect()} == {*range(80), 200}
    verdicts = Counter(r["doc_id"] for r in quality(docs).filter("kept").collect())
    assert Counter(r["doc_id"] for r in kept_documents(docs).collect()) == verdicts
    assert kept_documents(no_docs).collect() == [] == quality(no_docs).collect()


def test_no_python_runs(docs):
    for df in (quality(docs), kept_documents(docs)):
        assert not re.search("Python|Arrow|Pandas", df._jdf.queryExecution().toString())
