import math
import random

import pytest
from pyspark.sql import functions as F

from smelter.llm import topk

VECTORS = "vec_id LONG, embedding ARRAY<FLOAT>"


def brute_force(rows, k, modulus=5):
    vectors = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole = [math.floor(1024 * x) for x in v]
            vectors[i] = min(vectors.get(i, whole), whole)
    found = []
    for i, v in vectors.items():
        if i % modulus == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), j) for j, w in vectors.items() if j != i)
            found += [(i, rank, j, -s) for rank, (s, j) in enumerate(scores[:k], 1)]
    return sorted(found)


def vectors(seed=0, n=80):
    draw = random.Random(seed)
    rows = [(i, [draw.randint(-64, 64) / 32 for _ in range(4)]) for i in range(n)]
    rows += [(n + i, [0.5, 0.5, 0.5, 0.5]) for i in range(30)]  # ties
    rows += [(500, None), (501, [1.0, None, 0.0, 0.0]), (502, [float("nan")] * 4), (503, [float("inf")] * 4), (None, [1.0] * 4), (505, []), (506, [2.0]), (7, rows[7][1]), (8, [9.0, 9.0, 9.0, 9.0])]
    return rows


def found(spark, rows, k, clashing=lambda df: df):
    return sorted(map(tuple, topk.top_k(clashing(spark.createDataFrame(rows, VECTORS)), F.col("vec_id") % 5 == 0, k).collect()))


@pytest.mark.parametrize("k", [1, 10, 500])
def test_results_are_those_of_all_scores(spark, clashing, k):
    assert found(spark, vectors(), k, clashing) == brute_force(vectors(), k)


def test_blocks_and_slices_make_no_difference(spark, monkeypatch):
    for name, value in (("QUERY_BLOCK", 5), ("CANDIDATE_BLOCK", 17), ("SLICE", 2), ("CELLS", 4)):
        monkeypatch.setattr(topk, name, value)
    assert found(spark, vectors(1), 6) == brute_force(vectors(1), 6)


@pytest.mark.parametrize("rows", [[], [(1, [1.0])], [(5, [1.0])], [(5, []), (6, [])]])
def test_few_vectors(spark, rows):
    assert found(spark, rows, 3) == brute_force(rows, 3)


def held(score):
    return max(-topk.LONGEST, min(topk.LONGEST, score))


@pytest.mark.parametrize("size", [9.0, 3e5, 1e6, 1e9, 1e12, 1e300])
def test_large_components_give_exact_scores(spark, size):
    draw = random.Random(int(math.log10(size)))
    rows = [(i, [float(draw.randint(-9, 9)) if draw.random() < 0.3 else draw.uniform(-size, size) for _ in range(6)]) for i in range(40)]
    rows += [(40, [size] * 6), (45, [size, -size, 1.0, 2.0, 3.0, 4.0]), (46, [size, size, 4.0, 3.0, 2.0, 1.0])]
    whole = {i: [max(-(2**63), min(2**63 - 1, math.floor(1024 * x) if math.isfinite(1024 * x) else int(math.copysign(2**63, x)))) for x in v] for i, v in rows}
    expected = []
    for i in whole:
        if i % 5 == 0:
            scores = sorted((-held(sum(a * b for a, b in zip(whole[i], w, strict=True))), j) for j, w in whole.items() if j != i)
            expected += [(i, rank, j, -s) for rank, (s, j) in enumerate(scores[:7], 1)]
    table = spark.createDataFrame(rows, "vec_id LONG, embedding ARRAY<DOUBLE>")
    assert sorted(map(tuple, topk.top_k(table, F.col("vec_id") % 5 == 0, 7).collect())) == sorted(expected)
