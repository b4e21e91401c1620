import math
import random

import numpy as np
import pyarrow as pa
import pytest

from smelter.llm import whitening
from smelter.llm.whitening import Vectors, components, whitened

VECTORS = "vec_id LONG, embedding ARRAY<DOUBLE>"


def takes_part(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def brute_force(rows, most=32):
    """By whole numbers and the full covariance: deviations, eigenvalues, eigenvectors and centred vectors."""
    kept = [(i, v) for i, v in rows if takes_part(v)]
    width = max(len(v) for _, v in kept)
    x = [[math.floor(64 * c) + 1000000 for c in [*v, *[0.0] * (width - len(v))]] for _, v in kept]
    n, sums = len(x), [sum(col) for col in zip(*x, strict=True)]
    dev = [[n * c - s for c, s in zip(row, sums, strict=True)] for row in x]
    centred = np.array([[d / n for d in row] for row in dev])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    k = min(most, width)
    return [i for i, _ in kept], [sum(d * d for d in row) for row in dev], values[::-1][:k], axes[:, ::-1][:, :k], centred, values.sum()


def check(spark, rows, clashing=lambda df: df, parts=3, most=32, tolerance=1e-6):
    ids, deviations, values, axes, centred, trace = brute_force(rows, most)
    found = whitened(clashing(spark.createDataFrame(rows, VECTORS)).repartition(parts), most).collect()
    k, n = len(values), len(ids)
    assert len(found) == n * k and {r["n"] for r in found} == {n}
    by_key = {}
    for r in found:
        by_key.setdefault((r["vec_id"], r["deviation"]), {}).setdefault(r["component"], []).append(r)
    positive = [j for j in range(k) if values[j] > 1e-9 * values[0]]
    expected = centred @ axes / np.sqrt(np.where(values > 0, values, 1.0))
    signs = {}
    for row, (i, d) in enumerate(zip(ids, deviations, strict=True)):
        each = by_key[i, d if d < 1 << 63 else None]
        assert set(each) == set(range(1, k + 1))
        for j in range(k):
            assert all(math.isclose(r["explained"], values[j] / trace, rel_tol=1e-6, abs_tol=1e-12) for r in each[j + 1])
            if j not in positive:
                assert all(r["whitened"] is None for r in each[j + 1])
                continue
            want = expected[row, j]
            sign = signs.setdefault(j, next((math.copysign(1, want * r["whitened"]) for r in each[j + 1] if abs(want) > 1e-3), None))
            if sign is not None:
                assert min(abs(r["whitened"] * sign - want) for r in each[j + 1]) < tolerance
    assert len({r["identity_error"] for r in found}) == 1 and found[0]["identity_error"] < 1e-8
    return found


def drawn(n, width, seed=0, spread=None):
    draw = np.random.default_rng(seed)
    basis = draw.standard_normal((width, width))
    scale = spread if spread is not None else np.linspace(3, 0.5, width)
    return [(i, v.tolist()) for i, v in enumerate((draw.standard_normal((n, width)) * scale) @ np.linalg.qr(basis)[0])]


ODD = [(500, None), (501, [1.0, None, 0.0]), (502, [float("nan")] * 4), (503, [float("inf")] * 4), (None, [0.5] * 10), (505, []), (506, [2.0]), (7, [0.25] * 70), (7, [0.25] * 70)]


@pytest.mark.parametrize("n, width", [(400, 70), (300, 64), (50, 20), (200, 3), (40, 64)])
def test_components_are_those_of_the_full_covariance(spark, clashing, n, width):
    odd = [(i, v and v[:width]) for i, v in ODD]
    check(spark, drawn(n, width) + odd, clashing)


def test_partitions_make_no_difference(spark):
    rows = drawn(300, 60, 2)
    one, eight = (sorted(map(tuple, whitened(spark.createDataFrame(rows, VECTORS).repartition(p)).collect())) for p in (1, 8))
    assert [r[:4] for r in one] == [r[:4] for r in eight]
    assert np.abs(np.array([r[4:] for r in one]) - np.array([r[4:] for r in eight])).max() < 1e-8


def test_the_iteration_filters_a_flat_spectrum(spark):
    rows = drawn(4000, 100, 3, np.sqrt(np.linspace(1.2, 0.9, 100)) * 8)
    vectors = Vectors.of(spark.createDataFrame(rows, VECTORS))
    passes = []
    times = vectors.covariance_times
    vectors.covariance_times = lambda q: passes.append(q.shape[1]) or times(q)
    values, axes = components(vectors, 32)
    _, _, expected, eigenvectors, _, _ = brute_force(rows)
    assert np.abs(values / expected - 1).max() < 1e-12
    assert set(passes) == {32 + whitening.BUFFER + 1} and len(passes) < 150
    assert (np.abs((axes * eigenvectors).sum(axis=0)) > 1 - 1e-9).all()


def test_equal_eigenvalues_beyond_the_block_are_certified(spark):
    rows = [(i, [3.0 * s if j == i // 2 else 0.0 for j in range(80)]) for i, s in ((i, 1 - 2 * (i % 2)) for i in range(160))]
    rows += [(200, [1.0] + [0.0] * 79), (201, [-1.0] + [0.0] * 79)]
    found = whitened(spark.createDataFrame(rows, VECTORS)).collect()
    assert len(found) == 162 * 32 and found[0]["identity_error"] < 1e-8


def test_few_distinct_vectors_leave_components_without_variance(spark):
    found = check(spark, [(i, [float(i % 3), 1.0, float(i % 2), 5.0]) for i in range(30)])
    assert {r["component"] for r in found if r["whitened"] is None} == {3, 4}
    assert all(r["whitened"] is None and r["explained"] == 0 and r["deviation"] == 0 for r in whitened(spark.createDataFrame([(1, [1.0, 2.0])], VECTORS)).collect())


def test_large_entries_stay_exact(spark):
    rng = random.Random(1)
    rows = [(i, [rng.uniform(-1, 1) * 1e6, rng.uniform(-1, 1) * 1e5, i * 1e3]) for i in range(50)]
    check(spark, rows)
    check(spark, rows + [(60, [1e8, -1e8, 3e6])], tolerance=1e-4)
    found = whitened(spark.createDataFrame(rows + [(61, [1e300, 0.0, 0.0])], VECTORS)).collect()
    assert {r["deviation"] for r in found} == {None}


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, []), (2, [])]])
def test_without_vectors_there_are_no_rows(spark, rows):
    assert whitened(spark.createDataFrame(rows, VECTORS)).collect() == []


def test_stored_rows_are_small_whatever_their_number(spark):
    """Spark's readers hold 4,096 rows of a column at once."""
    rows = drawn(5000, 64, 4)
    blocks = Vectors.of(spark.createDataFrame(rows, VECTORS).coalesce(1)).blocks.selectExpr("size(ids) n", "length(block) bytes").collect()
    assert sum(r["n"] for r in blocks) == 5000 and all(r["bytes"] == 8 * 64 * r["n"] for r in blocks)
    assert max(r["bytes"] for r in blocks) <= 8192
    wide = Vectors.of(spark.createDataFrame(drawn(3, 3000, 5), VECTORS)).blocks.selectExpr("size(ids) n").collect()
    assert [r["n"] for r in wide] == [1] * 3


@pytest.mark.parametrize("n, width", [(1, 1), (5000, 64), (4097, 63), (9, 700)])
def test_rows_come_back_in_blocks(n, width):
    draw = np.random.default_rng(n)
    vectors = draw.integers(-100, 100, (n, width)) / 64
    ids = [None if i % 7 == 0 else i for i in range(n)]
    batch = pa.record_batch([pa.array(ids, pa.int64()), pa.array(vectors.tolist(), pa.list_(pa.float64()))], ["vec_id", "embedding"])
    stored = pa.Table.from_batches(whitening._packing(width)(iter([batch, batch]))).combine_chunks().to_batches()[0]
    found = list(whitening._blocks(stored, width))
    assert [i for own, _ in found for i in own.to_pylist()] == ids * 2
    assert (np.concatenate([x for _, x in found]) == np.tile(vectors * 64, (2, 1)) + 1000000).all()
    assert max(x.size for _, x in found) <= max(whitening.BLOCK_ENTRIES, width)


class Given:
    """A covariance of given eigenvalues, in place of stored vectors."""

    def __init__(self, values):
        self.width, self.passes = len(values), 0
        basis = np.linalg.qr(np.random.default_rng(1).standard_normal((self.width, self.width)))[0]
        self.covariance = (basis * values) @ basis.T

    def covariance_times(self, q):
        self.passes += 1
        return self.covariance @ q


SPECTRA = {
    "of many vectors without a direction": 1 + 0.013 * np.cos(np.linspace(0.05, math.pi - 0.05, 64)),
    "flatter": 1 + 1e-5 * np.linspace(1, 0, 200),
    "one value beyond the block": np.r_[np.ones(60), np.linspace(0.999, 0.99, 140)],
    "two values": np.r_[np.full(40, 2.0), np.ones(160)],
    "equal values after the wanted ones": np.r_[np.linspace(2, 1.5, 32), np.ones(168)],
    "equal values among the wanted ones": np.r_[np.linspace(3, 2, 5), np.ones(195)],
    "one value": np.ones(100),
    "no values": np.r_[np.linspace(5, 1, 20), np.zeros(180)],
}


@pytest.mark.parametrize("name", SPECTRA)
def test_flat_spectra_are_certified(name):
    given = Given(np.array(SPECTRA[name]))
    values, axes = components(given, 32)
    assert np.abs(values - SPECTRA[name][:32]).max() < 1e-12 * SPECTRA[name][0] and given.passes < 150
    assert np.abs(axes.T @ axes - np.eye(32)).max() < 1e-12
    assert np.abs(given.covariance @ axes - axes * values).max() < 1e-11
