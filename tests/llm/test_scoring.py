import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from smelter.llm import scoring
from smelter.llm.scoring import CLASSES, initial, log_table, score, trained

LOWER = {i: i + 32 for i in range(65, 91)}


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)) + [None]


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


@pytest.mark.parametrize("known", [1 << 18, 20])
def test_base_scores_and_counts(docs, corpus, clashing, monkeypatch, known):
    monkeypatch.setattr(scoring.vocabulary, "__defaults__", (known,))
    counts = Counter()
    for i, t, *_ in corpus:
        if not held(i):
            counts.update(tokens(t))
    n, v = sum(counts.values()), len(counts)
    expected = sorted((i is None, i or 0, held(i), len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens(t)), 6)) for i, t, *_ in corpus)
    rows = score(clashing(docs)).collect()
    found = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in rows)
    assert found == expected
    assert all(r["score"] < 0 for r in rows)


def test_log_probabilities_are_normalised():
    table = log_table(initial(np.full(CLASSES, 1 / CLASSES)))
    assert np.allclose((10**table).sum(axis=1), 1)


def test_training_learns_which_class_follows():
    draw = np.random.default_rng(1)
    one = draw.integers(0, 10, 20_000)
    codes, counts = np.unique((draw.integers(0, 10, 20_000) * CLASSES + one) * CLASSES + (one + 1) % 10, return_counts=True)
    noise = np.full(CLASSES, 1 / CLASSES)
    found = log_table(trained(initial(noise), noise, codes, counts, 1)).reshape(CLASSES, CLASSES, CLASSES)
    assert np.mean([found[b, a, (a + 1) % 10] for a in range(10) for b in range(10)]) > -0.7


def test_every_triple_is_trained_on():
    rare = np.arange(1, CLASSES)
    codes, counts = np.append(0, rare * CLASSES**2 + 1), np.append(1_000_000, np.ones(len(rare), dtype=np.int64))
    noise = np.full(CLASSES, 1 / CLASSES)
    before = initial(noise)
    vectors = slice(0, CLASSES * scoring.WIDTH)
    moved = (trained(before, noise, codes, counts, 1)[vectors] != before.astype(np.float32)[vectors]).reshape(CLASSES, scoring.WIDTH)
    assert moved.any(axis=1).all()


def test_shares_of_a_class_are_normalised(docs):
    counted = scoring.word_counts(docs.select("text"))
    vocab = scoring.vocabulary(counted)
    own = set(vocab.own.view(np.int64).tolist())
    sums = Counter()
    for r in counted.collect():
        if r["word"] not in own:
            sums[r["ending"]] += (r["n"] + 1) / vocab.in_class[scoring.OWN + r["ending"]]
    assert all(s + 1 / vocab.in_class[scoring.OWN + e] == pytest.approx(1) for e, s in sums.items())


def test_held_out_texts_score_better_than_by_single_words(spark):
    draw = random.Random(1)
    languages = [[f"{a}{b}" for a in first for b in "aeiou"] for first in ("kmpt", "bdgz", "lrsn")]
    rows = [(i, " ".join(draw.choices(languages[i % 3], k=60))) for i in range(600)]
    found = [r for r in score(spark.createDataFrame(rows, "doc_id LONG, text STRING")).collect() if r["held_out"]]
    assert len(found) > 40 and sum(r["score"] for r in found) > 0.85 * sum(r["base_score"] for r in found)


def test_empty_tables_and_no_training_texts(spark, no_docs):
    assert score(no_docs).collect() == []
    alone = next(i for i in range(50) if held(i))
    row = score(spark.createDataFrame([(alone, "a b")], "doc_id LONG, text STRING")).first()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"], row["held_out"]) == (3, 0, 0, True) and math.isfinite(row["score"])
