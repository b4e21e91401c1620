"""PCA whitening of embeddings by Chebyshev-filtered subspace iteration.

Components become whole numbers ``floor(64 * c) + 1000000``. Their covariance is never formed: all that is done with it is
multiplying a block of ``BUFFER`` more vectors than are wanted, as ``X'(XQ) / n`` over the centred rows. Each task adds up its
rows' part, and the parts are added up by dimension; so what is shuffled and collected depends on the number of dimensions
alone. The vectors are stored once, a few packed into each row, which every pass reads. Spark's readers hold thousands of
rows at once, so a row is held to ``ROW_ENTRIES``; a task puts the rows of a batch together again and multiplies by blocks.

Each round applies a Chebyshev polynomial by its three-term recurrence, one pass a degree. It is small on the interval that
holds the unwanted eigenvalues and grows fast above it, so the block turns towards the largest ones; then come QR and a
Rayleigh-Ritz step. The interval begins at a lower bound of the spectrum, from a Lanczos vector that goes through the same passes,
and ends at the block's smallest Ritz value, or a little below the last wanted one where the two are close. Rounds go on until
every wanted pair is certified by its residual ``|Vq - eq|``, and then until the residual no longer falls.

A vector takes no part if it is null or holds a null or non-finite entry. Shorter vectors are filled up with 0. Rows without an id
or with a repeated one take part like all others. Entries are held within 2**60 after scaling. ``deviation`` is null if it
exceeds a long. A component without variance (fewer distinct vectors than components) has ``explained`` 0, and ``whitened``
null; ``identity_error`` is that of the others. Extra columns aren't read. Without vectors or dimensions there are no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smelter.llm.shared import map_batches, needed, stored

SCALE, SHIFT = 64, 1_000_000
MOST = 2.0**60
SAFE = 1 << 62
BUFFER = 16
BLOCK_ENTRIES = 1 << 18  # multiplied at once
ROW_ENTRIES = 1 << 9  # stored in a row, or one vector if that is longer
DEGREE = 12
STEPS = 6  # of the lower bound, until it is used
ROUNDS = 300
CERTIFIED = 1e-12  # residual, beside the largest eigenvalue
SPREAD = 1e10  # between the largest and the smallest wanted value of the polynomial
ROWS = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


class NotCertified(RuntimeError):
    """The wanted components didn't reach the residual that certifies them."""


def usable(table: DataFrame) -> DataFrame:
    rows = needed(table, {"vec_id": "long", "embedding": "array<double>"})
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.coalesce(fine, F.lit(False)))


def _packing(width: int) -> Callable:
    per_row, per_block = max(1, ROW_ENTRIES // width), max(1, BLOCK_ENTRIES // width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, per_block):
                part = batch.slice(at, per_block)
                ids, lists = part.column(0), part.column(1)
                sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
                entries = np.zeros((part.num_rows, width))
                entries[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
                with np.errstate(over="ignore"):
                    whole = np.clip(np.floor(SCALE * entries), -MOST, MOST).astype(np.int64) + SHIFT
                cuts = [*range(0, part.num_rows, per_row), part.num_rows]
                blocks = [whole[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]
                yield pa.record_batch([pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), ids), pa.array(blocks, pa.binary())], ["ids", "block"])

    return run


def _blocks(batch: pa.RecordBatch, width: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """The ids and vectors of a batch's rows, put together to blocks."""
    ids, blocks = batch.column(batch.schema.get_field_index("ids")), batch.column(batch.schema.get_field_index("block"))
    per_row, per_block = max(1, ROW_ENTRIES // width), max(1, BLOCK_ENTRIES // width)
    for at in range(0, batch.num_rows, max(1, per_block // per_row)):
        part = slice(at, at + max(1, per_block // per_row))
        whole = b"".join(blocks[part].to_pylist())
        yield ids[part].flatten(), np.frombuffer(whole, dtype=np.int64).reshape(-1, width)


def _summing(width: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(width, dtype=object), 0
        for batch in batches:
            for _, x in _blocks(batch, width):
                total += (x if float(np.abs(x).max()) * len(x) < SAFE else x.astype(object)).sum(axis=0).astype(object)
                n += len(x)
        if n:
            sums = [Decimal(n), *map(Decimal, total.tolist())]
            yield pa.record_batch([pa.array(range(-1, width), pa.int32()), pa.array(sums, pa.decimal128(38, 0))], ["dimension", "total"])

    return run


@dataclass
class Vectors:
    """Stored vectors in whole numbers, their number and their sums per dimension."""

    blocks: DataFrame
    width: int
    n: int
    sums: list[int]

    @classmethod
    def of(cls, table: DataFrame) -> Vectors:
        rows = usable(table)
        width = rows.agg(F.max(F.size("embedding"))).first()[0] or 0
        if not width:
            return cls(rows, 0, 0, [])
        blocks = stored(map_batches(rows, _packing(width), "ids array<long>, block binary"), "vectors")
        sums = map_batches(blocks, _summing(width), "dimension int, total decimal(38,0)").groupBy("dimension").agg(F.sum("total").alias("total"))
        n, *sums = [int(r["total"]) for r in sorted(sums.collect())]  # one row per dimension
        return cls(blocks, width, n, sums)

    def deviations(self) -> Callable[[np.ndarray], np.ndarray]:
        """n times each entry less the dimension's sum, exactly: as int64 where that holds it, else as whole numbers of any size."""
        n, sums = self.n, self.sums
        small = np.array(sums, dtype=np.int64) if max(map(abs, sums)) < SAFE else None

        def run(x: np.ndarray) -> np.ndarray:
            if small is not None and float(np.abs(x).max()) * n < SAFE // 2:
                return x * n - small
            return x.astype(object) * n - np.array(sums, dtype=object)

        return run

    def summed(self, per_block: Callable[[np.ndarray], np.ndarray], rows: int, columns: int) -> np.ndarray:
        """The sum over all blocks of a matrix of ``rows`` times ``columns`` per block of centred vectors."""
        width, n, deviations = self.width, self.n, self.deviations()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((rows, columns))
            for batch in batches:
                for _, x in _blocks(batch, width):
                    total += per_block(deviations(x).astype(np.float64) / n)
            yield pa.record_batch([pa.array(range(rows), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["i", "part"])

        parts = map_batches(self.blocks, run, "i int, part array<double>").select("i", F.posexplode("part").alias("j", "part"))
        whole = parts.groupBy("i", "j").agg(F.sum("part").alias("total")).toArrow()  # one row per entry of the matrix
        found = np.zeros((rows, columns))
        found[whole["i"].to_numpy(), whole["j"].to_numpy()] = whole["total"].to_numpy()
        return found

    def covariance_times(self, q: np.ndarray) -> np.ndarray:
        """The covariance times the columns of ``q``, in one pass."""
        return self.summed(lambda c: c.T @ (c @ q), self.width, q.shape[1]) / self.n


@dataclass
class Lower:
    """A lower bound of a positive semidefinite operator's spectrum, by Lanczos steps: one vector to multiply at a time.

    The smallest Ritz value less the residual's norm bounds the spectrum once some steps are done. After a few it need not, as
    where all eigenvalues are nearly equal: the first one is then about their mean less their deviation. Until ``STEPS`` the
    bound is 0, and it is always that of the last step.
    """

    vector: np.ndarray
    basis: list[np.ndarray] = field(default_factory=list)
    alpha: list[float] = field(default_factory=list)
    beta: list[float] = field(default_factory=list)
    bound: float = 0.0

    def step(self, product: np.ndarray) -> None:
        if self.beta and self.beta[-1] <= 0.0:
            return
        self.basis.append(self.vector)
        self.alpha.append(float(self.vector @ product))
        rest = product
        for _ in range(2):  # twice is enough
            rest = rest - np.column_stack(self.basis) @ (np.column_stack(self.basis).T @ rest)
        norm = float(np.linalg.norm(rest))
        small = norm <= 1e-12 * max(abs(self.alpha[0]), 1e-300) or len(self.basis) == len(rest)
        ritz = np.linalg.eigvalsh(np.diag(self.alpha) + np.diag(self.beta, 1) + np.diag(self.beta, -1))
        if small or len(self.basis) >= STEPS:
            self.bound = max(float(ritz[0]) - (0.0 if small else norm), 0.0)
        self.beta.append(0.0 if small else norm)
        self.vector = self.vector if small else rest / norm


def components(vectors: Vectors, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit eigenvectors in columns."""
    d = vectors.width
    wanted, size = min(wanted, d), min(wanted + BUFFER, d)
    draw = np.random.default_rng(0)
    start = np.linalg.qr(draw.standard_normal((d, size + 1)))[0] if size < d else np.eye(d)
    q, lower = start[:, :size], Lower(start[:, -1])

    def multiply(y: np.ndarray) -> np.ndarray:
        product = vectors.covariance_times(np.column_stack([y, lower.vector]))
        lower.step(product[:, -1])
        return product[:, :-1]

    last = np.inf
    for _ in range(ROUNDS):
        vq = multiply(q)
        ritz, turn = np.linalg.eigh((q.T @ vq + vq.T @ q) / 2)
        ritz, turn = ritz[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        residual = float(np.linalg.norm(vq - q * ritz, axis=0)[:wanted].max())
        limit = max(ritz[0], 0.0)
        if residual <= CERTIFIED * limit and residual > last / 4 or residual <= 2e-16 * limit:
            return np.maximum(ritz[:wanted], 0.0), q[:, :wanted]
        last = residual
        q = np.linalg.qr(_filtered(multiply, q, vq, ritz, wanted, lower))[0]
    raise NotCertified(f"residual {last} after {ROUNDS} rounds")


def _filtered(multiply: Callable, q: np.ndarray, vq: np.ndarray, ritz: np.ndarray, wanted: int, lower: Lower) -> np.ndarray:
    """The scaled Chebyshev polynomial of the covariance times ``q``, whose product is known already."""
    low = lower.bound if lower.bound <= ritz[-1] else 0.0  # no Ritz value is below the spectrum
    most = DEGREE if len(lower.basis) >= STEPS else STEPS
    high = min(ritz[-1], ritz[wanted - 1] - 0.05 * (ritz[wanted - 1] - low))
    centre, half = (high + low) / 2, (high - low) / 2
    if half <= 1e-14 * ritz[0]:
        return vq - high * q
    far = (ritz[0] - centre) / half
    growth = np.arccosh(far) - np.arccosh(max((ritz[wanted - 1] - centre) / half, 1.0))
    degree = int(np.clip(np.log(SPREAD) / growth if growth > 0 else most, 2, most))
    sigma = first = 1.0 / far
    before, now = q, (vq - centre * q) * (sigma / half)
    for _ in range(degree - 1):
        new = 1.0 / (2.0 / first - sigma)
        before, now = now, (multiply(now) - centre * now) * (2.0 * new / half) - before * (sigma * new)
        sigma = new
    return now


def whitened(table: DataFrame, most: int = 32) -> DataFrame:
    """Per usable row and component: see ``ROWS``."""
    vectors = Vectors.of(table)
    if not vectors.width:
        return table.sparkSession.createDataFrame([], ROWS)
    values, axes = components(vectors, most)
    axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])] < 0, -1.0, 1.0)
    k, width, n = len(values), vectors.width, vectors.n
    varies = values > np.finfo(float).eps * width * values[0]
    scaled = axes / np.sqrt(np.where(varies, values, 1.0))

    trace = float(vectors.summed(lambda c: np.array([[(c * c).sum()]]), 1, 1)[0, 0]) / n
    means = vectors.summed(lambda c: (c @ scaled).sum(axis=0, keepdims=True), 1, k) / n

    def gram(c: np.ndarray) -> np.ndarray:
        w = c @ scaled - means
        return w.T @ w

    off = np.abs(vectors.summed(gram, k, k) / n - np.eye(k))[varies][:, varies]
    error = float(off.max()) if off.size else 0.0
    explained = np.where(varies, values / trace if trace > 0 else 0.0, 0.0)
    deviations = vectors.deviations()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, x in _blocks(batch, width):
                dev, m = deviations(x), len(x)
                off = _squares(dev)
                w = (dev.astype(np.float64) / n) @ scaled
                each = np.repeat(np.arange(m), k)
                yield pa.record_batch(
                    [
                        ids.take(pa.array(each)),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, n, dtype=np.int64)),
                        pa.array(off, pa.int64()).take(pa.array(each)),
                        pa.array(w.ravel(), mask=np.tile(~varies, m)),
                        pa.array(np.tile(explained, m)),
                        pa.array(np.full(m * k, error)),
                    ],
                    [c.split()[0] for c in ROWS.split(", ")],
                )

    return map_batches(vectors.blocks, run, ROWS)


def _squares(deviations: np.ndarray) -> list[int | None]:
    """Each row's sum of squares, exactly; none beyond a long."""
    if deviations.dtype != object and float(np.abs(deviations).max()) ** 2 * deviations.shape[1] < SAFE:
        return (deviations * deviations).sum(axis=1).tolist()
    sums = (deviations.astype(object) ** 2).sum(axis=1)
    return [s if s < 1 << 63 else None for s in sums.tolist()]
