"""Embedding whitening: the leading eigenvectors of a covariance by LOBPCG, rows projected on them and scaled to variance 1.

Each component c of a vector becomes the whole number x = floor(64 * c) + 1000000; the distinct x vectors are the fit
list. The covariance V is never formed over the rows: a round multiplies it with a block of directions, which every task
does for its centred rows (rows' transpose times rows times block), and the tasks' blocks are added up in two levels, so
that the driver gets at most PARTIALS blocks of dimensions times directions. Rayleigh-Ritz on the span of the iterate, its
residuals and the previous directions gives the next iterate. GUARDS more vectors than asked for are iterated; where three
blocks span the whole space, as for 64 dimensions, a few rounds are exact. Rounds end when residuals of the components
asked for, measured by a fresh product, are at rounding level; if they don't get there, that is an error.

Centring is exact: sums are whole numbers, rows are taken less the rounded mean as whole numbers, and the mean's rest is
subtracted in double precision.

Defined results: a vector that is null, or holds a null or a non-finite component, is dropped, as is one of another length
than most; 64 * c beyond 2**52 counts as that; repeated rows and rows without a vec_id are rows; a table without usable
rows gives an empty result; components without variance (fewer distinct rows than dimensions, or equal ones) have a null
`whitened` and explain 0; a deviation that doesn't fit a long is null; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackloom.llm.common import written

SCALE, SHIFT, LARGEST = 64, 1_000_000, 1 << 52
COMPONENTS = 16
GUARDS = 8
#: Blocks of sums that the driver adds up.
PARTIALS = 64
#: Residuals relative to the largest eigenvalue: rounds go on while they fall towards the first, and must reach the second.
ROUNDING, CERTIFIED = 2e-15, 1e-11
MAX_ROUNDS = 500
#: A share of the variance below which a component has none.
NO_VARIANCE = 1e-13
_HALF = 31


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, x (array of longs) of each usable row."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.filter(F.size("v") > 0)
    size = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    limited = lambda c: F.greatest(F.least(c * SCALE, F.lit(float(LARGEST))), F.lit(-float(LARGEST)))
    good = rows.filter((F.size("v") == (size["n"] if size else 0)) & ~F.coalesce(bad, F.lit(True)))
    return good.select("vec_id", F.transform("v", lambda c: F.floor(limited(c)) + F.lit(SHIFT).cast("long")).alias("x"))


@dataclass
class Fit:
    """n distinct vectors; their mean as whole numbers `near` and the rest's sums (mean = near + rest / n); eigenvalues,
    falling, of the components (dimensions, components); the whole variance; the measured identity error."""

    n: int
    near: np.ndarray
    rest: np.ndarray
    values: np.ndarray
    components: np.ndarray
    trace: float
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.near) - self.rest / self.n

    def with_variance(self) -> np.ndarray:
        return self.values > NO_VARIANCE * max(self.trace, np.finfo(float).tiny)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """(rows, components); NaN where a component has no variance."""
        some = self.with_variance()
        out = np.full((len(x), len(self.values)), np.nan)
        out[:, some] = self.centred(x) @ self.components[:, some] / np.sqrt(self.values[some])
        return out

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums over the dimensions of (n * x - S)**2, exact; None beyond a long."""
        apart = x - self.near
        most = self.n * int(np.abs(apart).max(initial=0)) + int(np.abs(self.rest).max(initial=0))
        if most * most * x.shape[1] < 1 << 63:
            return ((self.n * apart - self.rest) ** 2).sum(1).tolist()
        rest = self.rest.tolist()
        sums = [sum((self.n * v - r) ** 2 for v, r in zip(row, rest)) for row in apart.tolist()]
        return [s if s < 1 << 63 else None for s in sums]


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    lists = batch.column(batch.schema.get_field_index("x"))
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1) if len(lists) else np.zeros((0, 0), np.int64)


def added_up(rows: DataFrame, of_rows: Callable[[np.ndarray], np.ndarray], kind: str) -> np.ndarray | None:
    """The sum over all rows of what of_rows gives for some of them, arrays of one size and kind; None for no rows. Tasks
    add up their own, PARTIALS tasks those of others in order of the first tasks' numbers, and the driver theirs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                part = of_rows(_matrix(b.slice(at, 4096)))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()]), pa.array([total.astype(kind).tobytes()], pa.binary())], names=["task", "total"])

    def join(parts: pd.DataFrame) -> pd.DataFrame:
        ordered = parts.sort_values("task")
        total = np.zeros(len(ordered["total"].iloc[0]) // 8, kind)
        for t in ordered["total"]:
            total += np.frombuffer(t, kind)
        return pd.DataFrame({"task": ordered["task"].iloc[:1], "total": [total.tobytes()]})

    parts = rows.mapInArrow(run, "task long, total binary").groupBy(F.pmod("task", F.lit(PARTIALS))).applyInPandas(join, "task long, total binary")
    found = sorted(parts.collect())
    return np.sum([np.frombuffer(r["total"], kind) for r in found], axis=0, dtype=kind) if found else None


def _halves(x: np.ndarray) -> np.ndarray:
    """Rows, and sums by dimension of the high and the low parts of the numbers: no sum overflows below 2**32 rows."""
    return np.concatenate([[len(x)], (x >> _HALF).sum(0), (x & ((1 << _HALF) - 1)).sum(0)]).astype(np.int64)


def _orthonormal(block: np.ndarray, against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what the block's columns, at length 1 each, have outside the span of `against`."""
    length = np.linalg.norm(block, axis=0)
    block = block[:, length > 0] / length[length > 0]
    for _ in range(2):
        block = block - against @ (against.T @ block)
    if not block.shape[1]:
        return block
    u, s, _ = np.linalg.svd(block, full_matrices=False)
    u = u[:, s > 1e-10]
    u = u - against @ (against.T @ u)
    return np.linalg.qr(u)[0]


def lobpcg(product: Callable[[np.ndarray], np.ndarray], size: int, k: int, guards: int = GUARDS, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues, falling, and their unit vectors of a symmetric operator that is not negative."""
    width = min(size, k + guards)
    x = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, width)))[0]
    before = np.zeros((size, 0))
    ax, fresh, best, stale = product(x), True, np.inf, 0
    for _ in range(MAX_ROUNDS):
        values, turn = np.linalg.eigh((x.T @ ax + ax.T @ x) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        x, ax = x @ turn, ax @ turn
        residual = ax - x * values
        far = np.linalg.norm(residual[:, :k], axis=0).max(initial=0.0) / max(values[0], np.finfo(float).tiny)
        stale = 0 if far < best / 2 else stale + 1
        best = min(best, far)
        others = _orthonormal(np.concatenate([residual, before], axis=1), x)
        if far <= ROUNDING or stale > 3 or not others.shape[1]:
            if fresh and far <= CERTIFIED:
                return values[:k], x[:, :k]
            if not fresh:
                x = np.linalg.qr(x)[0]
                ax, fresh, best, stale = product(x), True, np.inf, 0
                continue
        basis = np.concatenate([x, others], axis=1)
        all_ = np.concatenate([ax, product(others)], axis=1) if others.shape[1] else ax
        _, mix = np.linalg.eigh((basis.T @ all_ + all_.T @ basis) / 2)
        mix = mix[:, ::-1][:, :width]
        before = others @ mix[width:]
        x, ax, fresh = basis @ mix, all_ @ mix, False
    raise RuntimeError(f"residuals are {best:.1e} of the largest eigenvalue after {MAX_ROUNDS} rounds")


def fit(rows: DataFrame, k: int = COMPONENTS) -> Fit | None:
    """rows: x, each distinct vector once; None if there are none."""
    sums = added_up(rows, _halves, "<i8")
    if sums is None:
        return None
    n, size = int(sums[0]), len(sums) // 2
    total = [(int(h) << _HALF) + int(low) for h, low in zip(sums[1 : size + 1], sums[size + 1 :])]
    near = [(2 * s + n) // (2 * n) for s in total]
    made = Fit(n, np.array(near, np.int64), np.array([s - n * m for s, m in zip(total, near)], np.int64), np.zeros(0), np.zeros((size, 0)), 0.0)

    def product(block: np.ndarray) -> np.ndarray:
        def of(x: np.ndarray) -> np.ndarray:
            y = made.centred(x)
            return y.T @ (y @ block)

        return added_up(rows, of, "<f8").reshape(block.shape) / n

    made.trace = float(added_up(rows, lambda x: (made.centred(x) ** 2).sum(0), "<f8").sum() / n)
    k = min(k, size)
    if made.trace > 0:
        made.values, made.components = lobpcg(product, size, k)
        made.components = made.components * np.where(made.components[np.abs(made.components).argmax(0), np.arange(k)] < 0, -1.0, 1.0)
        some = np.flatnonzero(made.with_variance())

        def of(x: np.ndarray) -> np.ndarray:
            white = made.whiten(x)[:, some]
            return white.T @ white

        made.identity_error = float(np.abs(added_up(rows, of, "<f8").reshape(len(some), -1) / n - np.eye(len(some))).max(initial=0.0))
    else:
        made.values, made.components = np.zeros(k), np.eye(size)[:, :k]
    return made


SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, k: int = COMPONENTS) -> DataFrame:
    """SCHEMA: for each usable row of `vectors` (vec_id, embedding) its k leading whitened components, numbered from 1;
    n is the number of distinct vectors, explained a component's share of the variance."""
    rows = whole_vectors(vectors)
    made = fit(written(rows.select("x").distinct(), "whitening-fit"), k)
    if made is None:
        return vectors.sparkSession.createDataFrame([], SCHEMA)
    k = len(made.values)
    explained = np.where(made.with_variance(), made.values / made.trace if made.trace else 0.0, 0.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                b = whole.slice(at, 4096)
                x, each = _matrix(b), np.repeat(np.arange(b.num_rows), k)
                white = made.whiten(x).reshape(-1)
                arrays = [
                    b.column("vec_id").take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), b.num_rows)),
                    pa.array(np.full(len(each), made.n)), pa.array(made.deviations(x), pa.int64()).take(pa.array(each)),
                    pa.array(white, mask=np.isnan(white)), pa.array(np.tile(explained, b.num_rows)), pa.array(np.full(len(each), made.identity_error)),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in SCHEMA.split(", ")])

    return rows.mapInArrow(run, SCHEMA)

