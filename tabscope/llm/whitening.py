"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

The covariance of the vectors is never formed. A pass hands tasks a thin matrix Q; each
returns its part of the centred product XᵀXQ, and parts are added up in a tree. A filter
of degree m is m such passes in the Chebyshev three-term recurrence, scaled so that the
unwanted low end of the spectrum stays within [-1, 1] and the wanted top grows. QR and
Rayleigh-Ritz follow; pairs whose residual has come down to rounding are locked and
projected out of what is left. Rounds go on until every wanted pair is certified by its
residual. The lower end of the unwanted interval is a Lanczos bound, gathered by one more
column in the passes of the first round. Each round one guard column starts afresh at
random, so that a direction the start has missed is picked up later.

Entries become integers (:data:`SCALE` steps a unit), so that repeated vectors are equal
and sums are exact. The fit list holds each distinct vector once and is written as blocks
of vectors, which passes read without touching single values on the JVM.

Defined results: rows whose vector is null or holds a null or non-finite entry are left
out, and so are vectors of another length than the commonest (the shorter one on a tie).
Repeated rows, and rows without an id, are projected like others. A component without
variance (one distinct vector, a constant dimension) has null ``whitened`` and an
``explained`` of 0. An entry whose integer lies beyond 2^62 counts as that bound; a
``deviation`` that does not fit 64 bits is null. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.errors import PySparkRuntimeError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabscope.llm.common import map_batches, scratch_table

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16
#: Columns beside the wanted ones: they carry the edge of the unwanted spectrum.
GUARD = 16
SEED = 11
BLOCK_BYTES = 128 << 10
#: Residuals of at most this, relative to the largest eigenvalue, certify a pair ...
CERTIFIED = 1e-11
#: ... but rounds go on while they still fall, down to this.
ROUNDING = 1e-14
#: Most growth of the largest eigenvector against the edge within one filter.
GROWTH = 1e8
MOST_DEGREE = 24
MOST_ROUNDS = 400
#: Parts of a product that the driver adds itself; more are added on the executors first.
PARTS = 64
_LARGEST = 2**62 - 2**21


def finite(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector) of the rows whose vector can be used."""
    entries = F.col(vector_col).cast("array<double>")
    infinite = F.lit(float("inf"))
    odd = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == infinite)
    return vectors.select(F.col(id_col).alias("id"), entries.alias("vector")).where(
        F.col("vector").isNotNull() & ~F.coalesce(F.exists("vector", odd), F.lit(False))
    )


def integers(vectors: pa.Array, width: int) -> np.ndarray:
    """Rows of integer entries of an Arrow list column whose lists have ``width`` entries."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    wide = np.clip(np.floor(SCALE * flat), -_LARGEST, _LARGEST)
    return (wide.astype(np.int64) + OFFSET).reshape(len(vectors), width)


def _width(vectors: DataFrame) -> int:
    """The commonest length; 0 for an empty table."""
    sizes = vectors.groupBy(F.size("vector").alias("size")).count()
    most = sizes.orderBy(F.desc("count"), "size").first()
    return most["size"] if most else 0


def fit_blocks(vectors: DataFrame, width: int) -> DataFrame:
    """(rows, block): each distinct integer vector once, packed many to a row."""

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.unique(integers(batch.column(0), width), axis=0)
            rows = pa.array([x.tobytes() for x in found], pa.binary())
            yield pa.RecordBatch.from_arrays([rows], names=["x"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        size = 0

        def block() -> pa.RecordBatch:
            # Dimension by dimension: neighbouring values are alike and compress well.
            rows = np.frombuffer(b"".join(held), np.int64).reshape(len(held), -1)
            return pa.RecordBatch.from_arrays(
                [pa.array([len(held)], pa.int64()), pa.array([rows.T.tobytes()], pa.binary())],
                names=["rows", "block"],
            )

        for batch in batches:
            for x in batch.column(0).to_pylist():
                held.append(x)
                size += len(x)
                if size >= BLOCK_BYTES:
                    yield block()
                    held, size = [], 0
        if held:
            yield block()

    distinct = map_batches(vectors.select("vector"), key, "x binary").distinct()
    packed = map_batches(distinct, pack, "rows long, block binary")
    return scratch_table(packed, "whitening-fit")


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        for rows, block in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            yield np.frombuffer(block, np.int64).reshape(-1, rows).T


@dataclass
class Centre:
    """Count and exact sums of the fit list; they centre integers without losing digits."""

    n: int
    sums: list[int]

    def __post_init__(self) -> None:
        parts = [divmod(s, self.n) for s in self.sums]
        self.whole = np.array([w for w, _ in parts], np.int64)
        self.rest = np.array([r for _, r in parts], np.float64) / self.n
        self.over = np.array([r for _, r in parts], np.int64)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(np.float64) - self.rest

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Exact sums of (n x - S)²; null beyond 64 bits."""
        near = ((self(x) * self.n) ** 2).sum(axis=1)
        far = near >= 2.0**63 * (1 - 1e-9)
        # Arithmetic modulo 2^64 is exact for results that fit.
        off = (x - self.whole).view(np.uint64) * np.uint64(self.n) - self.over.view(np.uint64)
        exact = (off * off).sum(axis=1, dtype=np.uint64).view(np.int64)
        for i in np.flatnonzero(far & (near <= 2.0**63 * (1 + 1e-9))):
            parts = (self.n * int(a) - s for a, s in zip(x[i], self.sums, strict=True))
            total = sum(p * p for p in parts)
            far[i] = total >= 2**63
            exact[i] = 0 if far[i] else total
        return pa.array(exact, pa.int64(), mask=far)


def centre(blocks: DataFrame, width: int) -> Centre:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * width
        for x in _matrices(batches):
            high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
            n += len(x)
            sums = [s + (int(h) << 32) + int(v) for s, h, v in zip(sums, high, low, strict=True)]
        every = [n, *sums]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(every)), pa.int32()), pa.array(list(map(str, every)))],
            names=["at", "part"],
        )

    parts = map_batches(blocks, add, "at int, part string")
    sums = parts.groupBy("at").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("s"))
    found = dict(tuple(r) for r in sums.collect())
    n, *rest = (int(found[i]) for i in range(width + 1))
    return Centre(n, rest)


def _folded(
    frame: DataFrame, tasks: int, shape: tuple[int, int], part: Callable[[np.ndarray], np.ndarray]
) -> np.ndarray:
    """Sum over all blocks of ``part(rows)``, a matrix of fixed size.

    A task sends one matrix. Where there are many tasks, some square root of them add
    the matrices up before the driver does.
    """

    def sent(total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for x in _matrices(batches):
            total += part(x)
        yield sent(total)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            for row in batch.column(0).to_pylist():
                total += np.frombuffer(row).reshape(shape)
        yield sent(total)

    parts = map_batches(frame, local, "part binary")
    if tasks > PARTS:
        parts = map_batches(parts.repartition(math.isqrt(tasks)), added, "part binary")
    total = np.zeros(shape)
    for row in parts.collect():
        total += np.frombuffer(row.part).reshape(shape)
    return total


@dataclass
class Components:
    """What projects a vector: ``vectors`` has a unit eigenvector a column."""

    centre: Centre
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float
    passes: int

    @property
    def live(self) -> np.ndarray:
        """Components that have variance."""
        return self.values > self.trace * 1e-14

    def scaled(self) -> np.ndarray:
        with np.errstate(divide="ignore"):
            return self.vectors * np.where(self.live, 1 / np.sqrt(np.abs(self.values)), 0.0)


class Spectrum:
    """Products of the covariance with thin matrices, a distributed pass each."""

    def __init__(self, blocks: DataFrame, width: int) -> None:
        self.blocks = blocks
        self.tasks = blocks.rdd.getNumPartitions()
        self.width = width
        self.centre = centre(blocks, width)
        self.passes = 0

    def times(self, q: np.ndarray) -> np.ndarray:
        middle = self.centre

        def part(x: np.ndarray) -> np.ndarray:
            c = middle(x)
            return c.T @ (c @ q)

        self.passes += 1
        return _folded(self.blocks, self.tasks, q.shape, part) / middle.n

    def trace(self) -> float:
        middle = self.centre
        total = _folded(self.blocks, self.tasks, (1, 1), lambda x: (middle(x) ** 2).sum().reshape(1, 1))
        return float(total[0, 0]) / middle.n

    def identity_error(self, projection: np.ndarray) -> float:
        """Largest entry of the covariance of projected vectors minus the identity."""
        middle, k = self.centre, projection.shape[1]
        if not k:
            return 0.0

        def part(x: np.ndarray) -> np.ndarray:
            w = middle(x) @ projection
            return np.vstack([w.T @ w, w.sum(axis=0)])

        total = _folded(self.blocks, self.tasks, (k + 1, k), part) / middle.n
        return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())


class _Lower:
    """Lanczos from one random vector: a lower bound of the spectrum."""

    def __init__(self, start: np.ndarray) -> None:
        self.basis = [start / np.linalg.norm(start)]
        self.alpha: list[float] = []
        self.beta: list[float] = []

    def column(self) -> np.ndarray:
        return self.basis[-1][:, None]

    def take(self, product: np.ndarray) -> None:
        self.alpha.append(float(self.basis[-1] @ product))
        rest = product
        for _ in range(2):
            rest = rest - np.column_stack(self.basis) @ (np.column_stack(self.basis).T @ rest)
        self.beta.append(float(np.linalg.norm(rest)))
        if self.beta[-1] > 1e-12 * abs(self.alpha[0]) and len(self.basis) < len(product):
            self.basis.append(rest / self.beta[-1])

    def bound(self) -> float:
        off = self.beta[: len(self.alpha) - 1]
        t = np.diag(self.alpha) + np.diag(off, 1) + np.diag(off, -1)
        return max(0.0, float(np.linalg.eigvalsh(t)[0]) - self.beta[-1])


def _degree(top: float, low: float, edge: float) -> int:
    """The highest degree that keeps the growth of the top against the edge bounded."""
    t = (2 * top - edge - low) / max(edge - low, 1e-300)
    each = math.acosh(max(t, 1 + 1e-12))
    return int(min(MOST_DEGREE, max(2, math.log(GROWTH) / each)))


def principal(blocks: DataFrame, width: int, wanted: int = COMPONENTS) -> Components:
    """The first ``wanted`` principal components of the fit list, certified by residuals."""
    spectrum = Spectrum(blocks, width)
    wanted = min(wanted, width)
    block = min(width, wanted + GUARD)
    rng = np.random.default_rng(SEED)
    trace = spectrum.trace()
    locked, values = np.empty((width, 0)), np.empty(0)
    if trace <= 0:
        basis = np.eye(width)[:, :wanted]
        return Components(spectrum.centre, np.zeros(wanted), basis, 0.0, 0.0, spectrum.passes)

    def outside(y: np.ndarray) -> np.ndarray:
        return y - locked @ (locked.T @ y)

    q = np.linalg.qr(rng.standard_normal((width, block)))[0]
    lower = _Lower(rng.standard_normal(width))
    bound, before, still = None, math.inf, 0
    product = spectrum.times(q)
    for _ in range(MOST_ROUNDS):
        # Rayleigh-Ritz in the span of the block.
        inner = q.T @ product
        theta, turn = np.linalg.eigh((inner + inner.T) / 2)
        order = np.argsort(-theta)
        theta, turn = theta[order], turn[:, order]
        q, product = q @ turn, outside(product @ turn)
        residual = np.linalg.norm(product - q * theta, axis=0)
        top = max(float(values[0]) if len(values) else 0.0, float(theta[0]))
        left = wanted - len(values)
        worst = float(residual[:left].max()) / top
        # Below the last digits residuals no longer fall: that is as far as doubles go.
        still = still + 1 if worst > before / 2 else 0
        done = worst <= ROUNDING or (worst <= CERTIFIED and still >= 2) or block >= width
        before = min(before, worst)
        ready = left if done else 0
        while not done and ready < left - 1 and residual[ready] <= ROUNDING * top:
            ready += 1
        if ready:
            locked = np.column_stack([locked, q[:, :ready]])
            values = np.concatenate([values, theta[:ready]])
            q, product, theta = q[:, ready:], product[:, ready:], theta[ready:]
        if len(values) >= wanted:
            break
        edge = float(theta[-1])
        low = min(bound if bound is not None else 0.0, edge)
        if edge - low <= 1e-12 * top:
            low = 0.0 if edge > 0 else -top
        degree = _degree(float(theta[0]), low, edge)
        # One guard column starts afresh.
        fresh = outside(rng.standard_normal((width, 1)))
        q[:, -1:] = fresh - q[:, :-1] @ (q[:, :-1].T @ fresh)
        q[:, -1] /= np.linalg.norm(q[:, -1]) or 1.0
        product[:, -1:] = 0
        q, product = _filtered(spectrum, q, outside, (low, edge, float(theta[0])), degree, lower if bound is None else None)
        if bound is None:
            bound = lower.bound()
    else:
        raise PySparkRuntimeError(f"components not certified after {MOST_ROUNDS} rounds")

    order = np.argsort(-values, kind="stable")
    values, vectors = np.maximum(values[order], 0.0), locked[:, order]
    made = Components(spectrum.centre, values, vectors, trace, 0.0, spectrum.passes)
    made.identity_error = spectrum.identity_error(made.scaled()[:, made.live])
    return made


def _filtered(
    spectrum: Spectrum,
    q: np.ndarray,
    outside: Callable[[np.ndarray], np.ndarray],
    interval: tuple[float, float, float],
    degree: int,
    lower: _Lower | None,
) -> tuple[np.ndarray, np.ndarray]:
    """A Chebyshev filter, QR, and the product of the new basis: ``degree + 1`` passes.

    ``lower`` rides along: its Lanczos column is one more column of each product.
    """

    def times(y: np.ndarray) -> np.ndarray:
        if lower is None:
            return outside(spectrum.times(y))
        both = spectrum.times(np.column_stack([y, lower.column()]))
        lower.take(both[:, -1])
        return outside(both[:, :-1])

    low, edge, top = interval
    half, middle = (edge - low) / 2, (edge + low) / 2
    # Scaled by the growth at the top, so that nothing overflows.
    sigma = first = half / max(top - middle, half)
    last, now = q, (times(q) - middle * q) * (sigma / half)
    for _ in range(1, degree):
        then = 1 / (2 / first - sigma)
        step = (times(now) - middle * now) * (2 * then / half) - (sigma * then) * last
        last, now, sigma = now, step, then
    size = np.linalg.norm(now, axis=0)
    now = outside(now / np.where(size > 0, size, 1.0))
    basis = np.linalg.qr(now)[0]
    basis = np.linalg.qr(outside(basis))[0]
    return basis, times(basis)


def whitened(
    vectors: DataFrame,
    components: int = COMPONENTS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """A row per usable vector and component: its whitened coordinate and the fit's figures."""
    usable = finite(vectors, id_col, vector_col)
    width = _width(usable)
    kind = dict(usable.dtypes)["id"]
    schema = (
        f"`{id_col}` {kind}, component int, n long, deviation long, whitened double,"
        " explained double, identity_error double"
    )
    if not width:
        return _none(vectors.sparkSession, schema)
    usable = usable.where(F.size("vector") == width)
    model = principal(fit_blocks(usable, width), width, components)
    middle, live = model.centre, model.live
    projection = model.scaled()
    share = model.values / model.trace if model.trace > 0 else np.zeros(len(live))
    share = np.where(live, share, 0.0)
    error, k = model.identity_error, len(live)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = integers(batch.column(1), width)
            rows = np.repeat(np.arange(len(x)), k)
            at = pa.array(rows)
            dead = np.tile(~live, len(x))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(at),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(rows), middle.n, np.int64)),
                    middle.deviations(x).take(at),
                    pa.array((middle(x) @ projection).ravel(), pa.float64(), mask=dead),
                    pa.array(np.tile(share, len(x))),
                    pa.array(np.full(len(rows), error)),
                ],
                names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return map_batches(usable, project, schema)


def _none(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)
