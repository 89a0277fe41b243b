"""Whitening of embeddings by a spectral divide and conquer on polar decompositions.

Sums, the covariance and the whitened rows are Spark passes over all vectors; only sums
of the size of one covariance matrix (dimensions squared, whatever the number of rows)
reach the driver, where the eigenvectors are found:

- the unitary polar factor U of V - sI, by the QR-based dynamically weighted Halley
  iteration (QDWH), is the sign of V - sI, so (I + U)/2 projects on the eigenvectors with
  eigenvalues above the shift s;
- bases of both projectors' ranges split V into two smaller symmetric blocks; these are
  split in turn until a block is one eigenvalue (or one repeated eigenvalue) wide.  Only
  blocks that can hold one of the wanted components are split.

The components over the roots of their eigenvalues are then applied map-side.  Vectors
are whole numbers (a grid, see :func:`on_grid`), and are centred before they are
multiplied; sums of them are exact.

Defined results: a vector that is null or holds a null or non-finite entry has no row,
nor has one whose length is not the commonest (the longer one where two are as common);
rows with a null or repeated vec_id stay, each by itself; a component without variance
(its eigenvalue is not above the rounding error of the trace) has null ``whitened`` and
takes no part in ``identity_error``; with no variance at all ``explained`` is null too.
``deviation`` is null where it is too large for a long; ``deviation_exact`` has it as text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pathloom.llm.base import query, step, table

#: Rows x dimensions worked on at once in a task.
CELLS = 4 << 20
#: Partial sums are added up in so many tasks before the driver adds the rest.
FOLD = 16
EPS = float(np.finfo(float).eps)


# The decomposition: small matrices on the driver.


def polar_factor(a: np.ndarray) -> np.ndarray:
    """The unitary factor of the polar decomposition of a square matrix, by QDWH."""
    n = len(a)
    scale = np.linalg.norm(a)
    if scale == 0:
        return np.eye(n)
    x = a / scale
    low = max(np.linalg.norm(x, -2) * 0.9, EPS)  # below the least singular value
    for _ in range(40):
        low2 = low * low
        d = np.cbrt(4 * (1 - low2) / (low2 * low2))
        wa = np.sqrt(1 + d) + 0.5 * np.sqrt(max(8 - 4 * d + 8 * (2 - low2) / (low2 * np.sqrt(1 + d)), 0))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, np.eye(n)]))
        new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        moved = np.linalg.norm(new - x)
        x = new
        low = min(low * (wa + wb * low2) / (1 + wc * low2), 1.0)
        if moved < np.cbrt(EPS) and abs(1 - low) < 10 * EPS:
            break
    return x


def range_of(projector: np.ndarray, k: int, seed: int) -> np.ndarray:
    """An orthonormal basis of the range of a projector of rank k."""
    q, _ = np.linalg.qr(projector @ np.random.default_rng(seed).standard_normal((len(projector), k)))
    for _ in range(2):
        q, _ = np.linalg.qr(projector @ q)
    return q


def split(a: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of the invariant subspaces above and below a shift inside the spectrum;
    None where no shift parts it."""
    n = len(a)
    spread = np.linalg.norm(a - np.trace(a) / n * np.eye(n))
    # shifts between the mean and the ends of the diagonal lie inside the spectrum
    diag = np.sort(np.diag(a))
    shifts = [np.median(diag), np.trace(a) / n, *np.linspace(diag[0], diag[-1], 7)[1:-1]]
    shifts += [np.trace(a) / n + k * spread / (8 * np.sqrt(n)) for k in (1, -1, 2, -2, 3, -3)]
    for shift in shifts:
        u = polar_factor(a - shift * np.eye(n))
        projector = (u + u.T) / 4 + np.eye(n) / 2
        rank = float(np.trace(projector))
        k = round(rank)
        if not 0 < k < n or abs(rank - k) > 1e-5 or np.linalg.norm(projector @ projector - projector) > 1e-5:
            continue
        up, down = range_of(projector, k, n), range_of(np.eye(n) - projector, n - k, n)
        both, r = np.linalg.qr(np.hstack([up, down]))
        both *= np.sign(np.diag(r))
        if np.linalg.norm(both[:, :k].T @ a @ both[:, k:]) < max(1e-9 * spread, 8 * EPS * n * np.linalg.norm(a)):
            return both[:, :k], both[:, k:]
    return None


def principal_components(v: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest ``wanted`` eigenvalues of a symmetric matrix, falling, and their unit
    eigenvectors as columns."""
    wanted = min(wanted, len(v))
    floor = EPS * len(v) * max(abs(np.trace(v)), np.finfo(float).tiny)
    values, vectors = [], []
    stack = [np.eye(len(v))]  # bases of subspaces, the one with the largest eigenvalues last
    while stack and len(values) < wanted:
        basis = stack.pop()
        block = basis.T @ v @ basis
        block = (block + block.T) / 2
        width = len(block)
        mean = np.trace(block) / width
        parts = None
        if width > 1 and np.linalg.norm(block - mean * np.eye(width)) > floor:
            parts = split(block)
        if parts is None:  # one eigenvalue, or several that rounding can't part
            values += list(np.diag(block))
            vectors += list(basis.T)
            continue
        up, down = parts
        stack += [basis @ down, basis @ up]
    order = np.argsort(-np.array(values), kind="stable")[:wanted]
    q = np.array(vectors)[order].T
    q, r = np.linalg.qr(q)
    q = q * np.sign(np.diag(r))
    return np.einsum("ij,ij->j", q, v @ q), q


# The passes over the rows.


def on_grid(vector: Column, scale: int, offset: int) -> Column:
    """floor(scale * entry) + offset as longs; what no long can hold is held at 2^62."""
    far = float(1 << 62)
    return F.transform(vector, lambda c: F.floor(F.greatest(F.least(c.cast("double") * scale, F.lit(far)), F.lit(-far))).cast("bigint") + offset)


def finite(vector: Column) -> Column:
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    return vector.isNotNull() & ~bad


def matrices(column: pa.Array, d: int) -> Iterator[tuple[int, np.ndarray]]:
    """The vectors of a batch as matrices of bounded size, with their first row."""
    flat = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
    each = max(1, CELLS // d)
    for a in range(0, len(flat), each):
        yield a, flat[a : a + each]


def summed(rows: DataFrame, vector: str, d: int, shape: tuple[int, ...], dtype: str, kernel: Callable) -> np.ndarray:
    """The sum of kernel(matrix) over all rows, added up in tasks, then in FOLD tasks."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape, dtype)
        for batch in batches:
            for _, m in matrices(batch.column(0), d):
                total += kernel(m)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sum"])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape, dtype)
        for batch in batches:
            for x in batch.column(0):
                total += np.frombuffer(x.as_buffer(), dtype).reshape(shape)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sum"])

    parts = rows.select(vector).mapInArrow(local, "sum binary").repartition(FOLD).mapInArrow(fold, "sum binary")
    return sum((np.frombuffer(r["sum"], dtype).reshape(shape) for r in parts.collect()), np.zeros(shape, dtype))


@dataclass(frozen=True)
class Whitening:
    """What the whitening of one table needs; small, and sent with the tasks."""

    n: int
    sums: list[int]  # exact sum of each dimension
    vectors: np.ndarray  # components as columns
    values: np.ndarray  # their eigenvalues
    trace: float
    identity_error: float | None = None

    @property
    def dim(self) -> int:
        return len(self.sums)

    @property
    def spreads(self) -> np.ndarray:
        """Which components have variance."""
        return self.values > EPS * self.dim * self.trace

    def centred(self, m: np.ndarray) -> np.ndarray:
        """The rows less the mean: first its whole part, exactly, then the rest."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([(s % self.n) / self.n for s in self.sums])
        return (m - whole).astype(float) - rest

    def whiten(self, m: np.ndarray) -> np.ndarray:
        ok = self.spreads
        out = np.full((len(m), len(self.values)), np.nan)
        out[:, ok] = self.centred(m) @ (self.vectors[:, ok] / np.sqrt(self.values[ok]))
        return out

    def deviations(self, m: np.ndarray) -> list[int]:
        """Sum over the dimensions of (n*x - S)^2, exact."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = [s % self.n for s in self.sums]
        u = m - whole
        if int(np.abs(u).max(initial=0)) ** 2 * self.dim * self.n * self.n < 1 << 62:
            return ((u * self.n - np.array(rest, np.int64)) ** 2).sum(axis=1).tolist()
        return [sum((x * self.n - r) ** 2 for x, r in zip(row, rest)) for row in u.tolist()]


def fit_whitening(rows: DataFrame, vector: str, components: int) -> Whitening | None:
    """Sums, covariance and components of a table of whole-number vectors of one length."""
    size = F.size(vector)
    lengths = rows.groupBy(size.alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    if not lengths or lengths[0]["d"] == 0:
        return None
    d, n = int(lengths[0]["d"]), int(lengths[0]["count"])
    same = rows.where(size == d)
    # halves of 32 bits, so that no sum can leave the range of a long
    halves = summed(same, vector, d, (2, d), "int64", lambda m: np.array([(m >> 32).sum(axis=0), (m & 0xFFFFFFFF).sum(axis=0)]))
    sums = [(int(h) << 32) + int(low) for h, low in zip(*halves)]
    plain = Whitening(n, sums, np.empty((d, 0)), np.empty(0), 0.0)

    def products(m: np.ndarray) -> np.ndarray:
        x = plain.centred(m)
        return x.T @ x

    cov = summed(same, vector, d, (d, d), "float64", products) / n
    values, vectors = principal_components(cov, components)
    fitted = Whitening(n, sums, vectors, values, float(np.trace(cov)))
    k = int(fitted.spreads.sum())
    if not k:
        return fitted

    def moments(m: np.ndarray) -> np.ndarray:
        w = fitted.whiten(m)[:, fitted.spreads]
        return np.vstack([w.sum(axis=0), w.T @ w])

    found = summed(same, vector, d, (k + 1, k), "float64", moments) / n
    error = float(np.abs(found[1:] - np.outer(found[0], found[0]) - np.eye(k)).max())
    return Whitening(n, sums, vectors, values, fitted.trace, error)


def apply_whitening(rows: DataFrame, vector: str, fitted: Whitening, keep: list[str]) -> DataFrame:
    """A row per vector and component, after the columns ``keep``."""
    sent = rows.sparkSession.sparkContext.broadcast(fitted)
    part = rows.where(F.size(vector) == fitted.dim).select(vector, *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)])
    fields = [f"_k{i} {part.schema[i + 1].dataType.simpleString()}" for i in range(len(keep))]
    out = ["component int", "n long", "deviation long", "deviation_exact string", "whitened double", "explained double", "identity_error double"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = sent.value
        k = len(w.values)
        number = np.arange(1, k + 1, dtype=np.int32)
        share = w.values / w.trace if w.trace > 0 else np.full(k, np.nan)
        for batch in batches:
            for a, m in matrices(batch.column(0), w.dim):
                r = len(m)
                owner = np.repeat(np.arange(a, a + r), k)
                exact = w.deviations(m)
                dev = pa.array([x if x < 1 << 63 else None for x in exact], pa.int64())
                text = pa.array(list(map(str, exact)), pa.string())
                again = pa.array(owner - a)
                columns = [
                    *[c.take(pa.array(owner)) for c in batch.columns[1:]],
                    pa.array(np.tile(number, r)),
                    pa.array(np.full(r * k, w.n)),
                    dev.take(again),
                    text.take(again),
                    pa.array(w.whiten(m).ravel(), from_pandas=True),
                    pa.array(np.tile(share, r), from_pandas=True),
                    pa.array([w.identity_error] * (r * k), pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in [*fields, *out]])

    done = part.mapInArrow(run, ", ".join([*fields, *out]))
    return done.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], *[f.split()[0] for f in out])


def whitened_components(
    df: DataFrame, vector: str = "embedding", keep: list[str] | None = None, components: int = 32, scale: int = 64, offset: int = 1_000_000
) -> DataFrame:
    """Each vector's whitened components: ``component`` from 1 by falling eigenvalue,
    ``n``, ``deviation``, ``deviation_exact``, ``whitened``, ``explained`` and
    ``identity_error``, after the columns ``keep`` (vec_id)."""
    kept = ["vec_id"] if keep is None else keep
    rows = df.where(finite(F.col(vector))).select(on_grid(F.col(vector), scale, offset).alias("_x"), *[F.col(c).alias(f"_c{i}") for i, c in enumerate(kept)])
    rows = step(rows, "grid")
    fitted = fit_whitening(rows, "_x", components)
    if fitted is None:
        fitted = Whitening(0, [0], np.empty((1, 0)), np.empty(0), 0.0)
        rows = rows.limit(0)
    done = apply_whitening(rows, "_x", fitted, [f"_c{i}" for i in range(len(kept))])
    return done.withColumnsRenamed({f"_c{i}": c for i, c in enumerate(kept)})


@query("op12_whitening")
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened_components(table(spark, sf_dir, "embeddings"))
