"""Embedding whitening by QDWH spectral divide-and-conquer.

Every usable vector is put on a grid of whole numbers, x = floor(``GRID`` * c)
+ ``OFFSET`` for each entry c, so counts, sums and deviations are exact. The
covariance (divisor n, centred before multiplying) is summed in the tasks and
added up by matrix entry, so the driver receives d * d numbers whatever the
number of rows or tasks.

Spectrum. The orthogonal polar factor of the covariance less a shift, found by
the QR-based dynamically weighted Halley iteration (QDWH), is the matrix sign
of the difference: half of its sum with the identity projects on the
eigenvectors above the shift. An orthonormal basis of that subspace and one of
its complement split the matrix in two, and both parts are divided again until
they are single components. At the end one first-order correction removes what
rounding left between the components.

Whitening. Components are numbered by falling eigenvalue; a row's centred
vector is projected on each and divided by the square root of its eigenvalue.
Only the d * components matrix travels with the tasks. The whitened vectors'
own covariance is summed in a further pass, and its largest difference from
the identity is returned with every row.

Defined results: vectors that are null, have a null, non-finite or (beyond
2**40) oversized entry, or not the dimension that most usable vectors have (of
equally frequent ones the larger) are left out. Repeated rows count as often
as they stand there. A component whose eigenvalue is zero to rounding has the
whitened value 0 (so the identity error is 1) and, without any variance,
the share 0. Deviations beyond a long are null. Equal eigenvalues leave their
components free up to a rotation, the same one for all rows. An empty table,
or one without usable vectors, gives an empty result. Other columns, null ids
among them, pass through and give way to results of their name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanscore.llm.common import Written, packed, with_results

GRID = 1024
OFFSET = 100_000
COMPONENTS = 8
LARGEST = 2.0**40  # an entry beyond this is no embedding
BLOCK_VALUES = 1 << 18  # entries of vectors that one step of a task holds
HALLEY_ROUNDS = 30  # the iteration takes about six; more only if rounding keeps it moving
_EPS = float(np.finfo(float).eps)


# The spectrum of one symmetric matrix


def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix by QDWH."""
    d = len(a)
    x = a / (np.linalg.norm(a) or 1.0)
    low = _EPS  # a lower bound of the smallest singular value; too low only costs a round
    for _ in range(HALLEY_ROUNDS):
        square = low * low
        root = np.cbrt(4 * (1 - square) / square**2) if square < 1 else 0.0
        first = np.sqrt(1 + root) + np.sqrt(8 - 4 * root + 8 * (2 - square) / (square * np.sqrt(1 + root))) / 2
        second = (first - 1) ** 2 / 4
        third = first + second - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(third) * x, np.eye(d)]))
        after = second / third * x + (first - second / third) / np.sqrt(third) * (q[:d] @ q[d:].T)
        after = (after + after.T) / 2
        low = min(1.0, low * (first + second * square) / (1 + third * square))
        moved, x = np.linalg.norm(after - x), after
        if moved <= 10 * _EPS * np.sqrt(d) or (low >= 1 - 4 * _EPS and moved <= np.cbrt(_EPS) * _EPS**0.5):
            break
    return x


def _halves(a: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal bases of two invariant subspaces that make up the whole space, the one of larger eigenvalues first."""
    d = len(a)
    middle, spread = np.trace(a) / d, np.linalg.norm(a - np.trace(a) / d * np.eye(d)) / np.sqrt(d)
    shifts = [float(np.median(np.diag(a))), middle, *(middle + spread * step for step in (0.1, -0.1, 0.3, -0.3, 0.03, -0.03))]
    best = None
    for shift in shifts:
        projector = (polar_factor(a - shift * np.eye(d)) + np.eye(d)) / 2
        rank = int(round(np.trace(projector)))
        if not 0 < rank < d:
            continue
        basis = np.linalg.qr(projector @ rng.standard_normal((d, rank)))[0]
        full = np.linalg.qr(projector @ basis, mode="complete")[0]
        upper, lower = full[:, :rank], full[:, rank:]
        left = np.linalg.norm(lower.T @ a @ upper)  # what the split leaves between the two
        if best is None or left < best[0]:
            best = left, upper, lower
        if left <= 10 * d * _EPS * np.linalg.norm(a):
            break
    if best is None:  # no shift lies between two eigenvalues: they are equal to rounding
        return np.eye(d)[:, :1], np.eye(d)[:, 1:]
    return best[1], best[2]


def spectrum(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, falling; unit eigenvectors as columns) of a symmetric matrix."""
    a = (a + a.T) / 2
    d, scale = len(a), np.linalg.norm(a)
    rng = np.random.default_rng(d)
    found, open_ = [], [np.eye(d)]
    while open_:
        basis = open_.pop()
        part = basis.T @ a @ basis
        part = (part + part.T) / 2
        if len(part) <= 1 or np.linalg.norm(part - np.diag(np.diag(part))) <= _EPS * scale:
            found.append(basis)
            continue
        upper, lower = _halves(part, rng)
        open_ += [basis @ lower, basis @ upper]
    vectors = np.hstack(found) if found else np.eye(d)
    if d:
        rest = vectors.T @ a @ vectors
        values = np.diag(rest)
        gaps = values[None, :] - values[:, None]
        apart = np.abs(gaps) > np.sqrt(_EPS) * (scale or 1.0)
        vectors = vectors + vectors @ np.where(apart, rest / np.where(apart, gaps, 1.0), 0.0)
        vectors = vectors @ (3 * np.eye(d) - vectors.T @ vectors) / 2  # orthonormal again
        vectors /= np.linalg.norm(vectors, axis=0)
    values = np.einsum("ij,ik,kj->j", vectors, a, vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


# Passes over the vectors


@dataclass(frozen=True)
class Fit:
    """What the fit list gives: n, exact sums, and the whitening matrix (d x components)."""

    n: int
    sums: tuple[int, ...]
    matrix: np.ndarray
    explained: tuple[float, ...]

    @property
    def mean(self) -> np.ndarray:
        return np.array([float(s // self.n) + s % self.n / self.n for s in self.sums])


def grid(vectors: pa.Array, d: int) -> Iterator[np.ndarray]:
    """The vectors' whole numbers, in matrices (rows x d) of bounded size."""
    rows = max(1, BLOCK_VALUES // d)
    for start in range(0, len(vectors), rows):
        entries = vectors.slice(start, rows).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        yield np.floor(GRID * entries).astype(np.int64).reshape(-1, d) + OFFSET


def deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """Each row's sum over dimensions of (n * x - sum)**2, exact; null beyond a long."""
    most = max(int(np.abs(x).max(initial=0)) * n, max(map(abs, sums), default=0))
    if 4 * most * most * len(sums) < 1 << 63:
        off = x * n - np.array(sums, dtype=np.int64)
        return (off * off).sum(axis=1).tolist()
    centre = np.array(sums, dtype=object)
    exact = (((row.astype(object) * n - centre) ** 2).sum() for row in x)
    return [value if value < 1 << 63 else None for value in exact]


def _task_sums(d: int):
    """A mapInArrow function: one row for each task and dimension with the exact sum of its whole numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low, n = [0] * d, [0] * d, 0
        for batch in batches:
            for x in grid(batch.column(0), d):
                n += len(x)
                high = [a + int(b) for a, b in zip(high, (x >> 26).sum(axis=0))]
                low = [a + int(b) for a, b in zip(low, (x & (1 << 26) - 1).sum(axis=0))]
        if n:
            sums = pa.array([(a << 26) + b for a, b in zip(high, low)], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()), sums], names=["i", "n", "total"])

    return run


def _task_products(prepared: Callable[[np.ndarray], np.ndarray], d: int, size: int):
    """A mapInArrow function: the sum of a task's outer products of prepared(x), by rows of the matrix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            for x in grid(batch.column(0), d):
                y = prepared(x)
                total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], names=["i", "entries"])

    return run


def covariance(vectors: DataFrame, n: int, prepared: Callable[[np.ndarray], np.ndarray], d: int, size: int) -> np.ndarray:
    """1 / n times the sum of outer products; the driver receives size * size numbers."""
    parts = vectors.mapInArrow(_task_products(prepared, d, size), "i int, entries array<double>")
    cells = parts.select("i", F.posexplode("entries").alias("j", "entry")).groupBy("i", "j").agg(F.sum("entry").alias("entry")).toArrow()
    total = np.zeros((size, size))
    total[cells["i"].to_numpy(), cells["j"].to_numpy()] = cells["entry"].to_numpy()
    return total / n


def fit(vectors: DataFrame, d: int, components: int) -> Fit | None:
    """The fit of a frame with one column of usable vectors of d entries; None without rows."""
    totals = vectors.mapInArrow(_task_sums(d), "i int, n long, total decimal(38,0)").groupBy("i").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    found = sorted(totals.toArrow().to_pylist(), key=lambda r: r["i"])  # d rows
    if not found:
        return None
    n, sums = found[0]["n"], tuple(int(r["total"]) for r in found)
    centre = Fit(n, sums, np.empty(0), ()).mean
    spread = covariance(vectors, n, lambda x: x - centre, d, d)
    values, basis = spectrum(spread)
    whole = float(np.trace(spread))
    real = values[:components] > d * _EPS * max(float(values[0]), 0.0)
    scale = np.where(real, 1 / np.sqrt(np.where(real, values[:components], 1.0)), 0.0)
    shares = tuple(float(max(v, 0.0)) / whole if whole > 0 else 0.0 for v in values[:components])
    return Fit(n, sums, basis[:, :components] * scale, shares)


def _whitener(model: Fit):
    d, mean = len(model.sums), model.mean

    @F.arrow_udf("struct<deviation:long,whitened:array<double>>")
    def whitened(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            off: list[int | None] = []
            values: list[list[float]] = []
            for x in grid(batch, d):
                off += deviations(x, model.n, model.sums)
                values += ((x - mean) @ model.matrix).tolist()
            yield pa.StructArray.from_arrays([pa.array(off, pa.int64()), pa.array(values, pa.list_(pa.float64()))], names=["deviation", "whitened"])

    return whitened


def whiten(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS, carry: list[str] | None = None) -> DataFrame:
    """One row for each usable row of ``df`` (its columns, or those in ``carry``) and component.

    Adds component, n, deviation, whitened, explained and identity_error.
    """
    carried = df if carry is None else df.select(*carry)
    entries = F.col("vector")
    sound = F.forall(entries, lambda c: F.coalesce(F.abs(c) <= F.lit(LARGEST), F.lit(False)))  # NaN ranks above all numbers
    rows = df.select(packed(carried).alias("row"), F.col(vector).cast("array<double>").alias("vector")).where(
        F.col("vector").isNotNull() & (F.size("vector") > 0) & sound
    )
    stored = Written(rows, "vectors").df
    lengths = stored.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d"))
    usual = lengths.first()
    results = ["component", "n", "deviation", "whitened", "explained", "identity_error"]
    d = usual.d if usual else 1
    stored = stored.where(F.size("vector") == d)
    model = fit(stored.select("vector"), d, components) if usual else None
    if model is None:
        kinds = ["int", "long", "long", "double", "double", "double"]
        return with_results(stored.where("false"), "row", {name: F.lit(None).cast(kind) for name, kind in zip(results, kinds)})
    size, mean, matrix = len(model.explained), model.mean, model.matrix
    error = float(np.abs(covariance(stored.select("vector"), model.n, lambda x: (x - mean) @ matrix, d, size) - np.eye(size)).max())
    made = stored.select("row", _whitener(model)("vector").alias("made"))
    each = made.select("row", "made.deviation", F.posexplode("made.whitened").alias("at", "value"))
    shares = F.array(*[F.lit(share) for share in model.explained])
    columns = [F.col("at") + 1, F.lit(model.n).cast("long"), F.col("deviation"), F.col("value"), shares[F.col("at")], F.lit(error)]
    return with_results(each, "row", dict(zip(results, columns)))
