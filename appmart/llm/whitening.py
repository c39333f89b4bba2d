"""Whitening of embeddings (operator 12), by Chebyshev-filtered subspace iteration.

Entries become whole numbers x = floor(64 c) + 1000000. V is the covariance of
all remaining x-vectors (divisor n). Nothing of the size of the table ever
reaches the driver, and V itself is never formed: the driver holds a block of
``k`` wanted and ``guard`` further directions (d x (k + guard) numbers) and gets
the products V Q from passes over the table.

* **A pass** centres each vector exactly ((n x - S) / n from whole numbers),
  multiplies it by the block and adds up Xc'(Xc Q) per task. The tasks' sums meet
  in a tree of fan-in ``FAN``, in a fixed order, so a lost and repeated task
  changes nothing.
* **The filter.** A few Lanczos passes bound the spectrum from below. Then rounds
  of the Chebyshev recurrence, one pass a degree, damp all between that bound and
  the least Ritz value of the block, and raise what lies above.
* **QR and Rayleigh-Ritz** follow each round. Its product V Q is the next round's
  first degree, so no pass is spent on it alone.
* **Certified** is a block whose ``k`` residuals |V q - e q| are at most
  ``TOLERANCE`` times the largest eigenvalue. If ``ROUNDS`` rounds do not get there
  (the eigenvalues at the edge lie too close), the guard doubles, at last to the
  whole space, where Rayleigh-Ritz is exact.

Cases: rows whose vector is null or holds null or non-finite entries are dropped,
and so are rows of another length than the commonest one (of several the
greatest), empty vectors among them. Components without variance (an eigenvalue
of under 10^-12 of the largest) cannot be whitened and are left out, so equal rows
alone give no result, and neither does an empty table. Null and repeated ids and
repeated rows stay rows of their own. A deviation beyond 64 bits is null.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .store import materialise

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: Directions beyond the wanted ones, degree of the filter and rounds before the guard doubles.
GUARD, DEGREE, ROUNDS = 16, 8, 12
LANCZOS_STEPS = 10
TOLERANCE = 1e-13
FLAT = 1e-12
#: So many partial results meet in one task, and so many come to the driver.
FAN = 32
#: Most that the filter may raise the largest eigenvalue over the edge, lest QR lose the others.
MOST_GAIN = 1e10
_LONG = 1 << 63


def whole_vectors(table: DataFrame, column: str, keep: list[str]) -> DataFrame:
    """Struct ``d`` of ``keep`` and ``x`` (array of long) of the rows that remain, stored."""
    v = F.col(column)
    sound = F.coalesce(F.forall(v, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")),
                                                        F.lit(False))), F.lit(False))
    rows = table.filter(sound & (F.size(v) > 0))
    sizes = rows.groupBy(F.size(v).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    x = F.transform(v, lambda c: F.floor(c.cast("double") * SCALE) + OFFSET)
    return materialise(rows.filter(F.size(v) == (sizes["d"] if sizes else 0)).select(F.struct(*keep).alias("d"),
                                                                                     x.alias("x")), "whole-vectors")


def tree_reduce(rows: DataFrame, part: Callable[[Iterator[pa.RecordBatch]], Any],
                add: Callable[[Any, Any], Any]) -> Any:
    """``add`` over ``part`` of every task, FAN at a time in the order of the tasks; None without rows."""
    def leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value = part(batches)
        if value is not None:
            yield pa.RecordBatch.from_pydict({"id": [TaskContext.get().partitionId()], "value": [pickle.dumps(value)]},
                                             schema=pa.schema([("id", pa.int64()), ("value", pa.binary())]))

    def fold(found: list[tuple[int, bytes]]) -> Any:
        total = None
        for _, value in sorted(found):
            value = pickle.loads(value)
            total = value if total is None else add(total, value)
        return total

    def branch(group: pa.Table) -> pa.Table:
        found = list(zip(group["id"].to_pylist(), group["value"].to_pylist()))
        return pa.table({"id": pa.array([found[0][0] // FAN], pa.int64()),
                         "value": pa.array([pickle.dumps(fold(found))], pa.binary())})

    level, parts = rows.mapInArrow(leaf, "id long, value binary"), rows.rdd.getNumPartitions()
    while parts > FAN:
        level = level.groupBy(F.expr(f"id div {FAN}")).applyInArrow(branch, "id long, value binary")
        parts = -(-parts // FAN)
    return fold([(r["id"], bytes(r["value"])) for r in level.collect()])


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal-length lists as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


class Fit:
    """Count, sums and components of the stored vectors."""

    def __init__(self, rows: DataFrame, components: int = COMPONENTS, guard: int = GUARD, degree: int = DEGREE):
        self.rows = rows.select("x")
        self.passes = self.rounds = 0
        self.n, self.sums, self.wide = 0, None, False

        def sums(batches: Iterator[pa.RecordBatch]) -> Any:
            n, total, most = 0, None, 0
            for b in batches:
                if b.num_rows:
                    x = _matrix(b.column(0))
                    high = max(abs(int(x.min())), abs(int(x.max())))
                    x = x if high * len(x) < _LONG else x.astype(object)
                    n, most = n + len(x), max(most, high)
                    total = x.sum(axis=0).astype(object) + (0 if total is None else total)
            return None if total is None else (n, total, most)

        found = tree_reduce(self.rows, sums, lambda a, b: (a[0] + b[0], a[1] + b[1], max(a[2], b[2])))
        if found is None:
            self.values, self.vectors = np.empty(0), np.empty((0, 0))
            return
        self.n, self.sums, most = found
        # n x - S in 64 bits, or in whole numbers of any size.
        self.wide = 2 * self.n * most >= _LONG
        if not self.wide:
            self.sums = self.sums.astype(np.int64)
        self._solve(components, guard, degree)

    def centred(self) -> Callable[[pa.Array], np.ndarray]:
        """A function from a column x to n x - S, exact."""
        n, sums, wide = self.n, self.sums, self.wide
        return lambda x: (_matrix(x).astype(object) if wide else _matrix(x)) * n - sums

    def product(self, block: np.ndarray) -> np.ndarray:
        """V times the block: one pass."""
        centred, n = self.centred(), self.n
        self.passes += 1

        def part(batches: Iterator[pa.RecordBatch]) -> Any:
            total = None
            for b in batches:
                if b.num_rows:
                    x = (centred(b.column(0)) / n).astype(np.float64)
                    y = x.T @ (x @ block)
                    total = y if total is None else total + y
            return total
        return tree_reduce(self.rows, part, lambda a, b: a + b) / n

    def _floor(self, d: int) -> float:
        """A lower bound of the spectrum, as far as some Lanczos steps see it."""
        rng = np.random.default_rng(1)
        q = rng.standard_normal((d, 1))
        basis, alpha, beta = [q / np.linalg.norm(q)], [], []
        for _ in range(min(d, LANCZOS_STEPS)):
            w = self.product(basis[-1])
            alpha.append(float((basis[-1].T @ w)[0, 0]))
            span = np.hstack(basis)
            for _ in range(2):
                w = w - span @ (span.T @ w)
            beta.append(float(np.linalg.norm(w)))
            if beta[-1] <= 1e-12 * max(map(abs, alpha)):
                break
            basis.append(w / beta[-1])
        m = len(alpha)
        values, vectors = np.linalg.eigh(np.diag(alpha) + np.diag(beta[:m - 1], 1) + np.diag(beta[:m - 1], -1))
        return max(0.0, float(values[0] - beta[m - 1] * abs(vectors[-1, 0])))

    def _solve(self, components: int, guard: int, degree: int) -> None:
        d = len(self.sums)
        k = min(components, d)
        width = min(d, k + guard)
        block = np.linalg.qr(np.random.default_rng(0).standard_normal((d, width)))[0]
        low = self._floor(d) if width < d else 0.0
        times, since = self.product(block), 0
        while True:
            self.rounds += 1
            values, turn = np.linalg.eigh((block.T @ times + times.T @ block) / 2)
            values, turn = values[::-1], turn[:, ::-1]
            block, times = block @ turn, times @ turn
            residual = np.linalg.norm(times - block * values, axis=0)[:k]
            self.residual = float(residual.max() / values[0]) if values[0] > 0 else 0.0
            if self.residual <= TOLERANCE or width == d:
                break
            since += 1
            if since > ROUNDS:
                # More directions, orthogonal to those there are.
                more = min(d, width + 2 * (width - k) + 1) - width
                fresh = np.random.default_rng(width).standard_normal((d, more))
                block = np.linalg.qr(np.hstack([block, fresh]))[0]
                width, since = width + more, 0
                times = self.product(block)
                continue
            edge = max(float(values[-1]), FLAT * float(values[0]))
            low = min(low, edge * (1 - 1e-3))
            half, middle = (edge - low) / 2, (edge + low) / 2
            gain = (values[0] - middle) / half
            gain = gain + np.sqrt(max(gain * gain - 1, 0))
            steps = max(1, min(degree, int(np.log(MOST_GAIN) / np.log(max(gain, 1.0001)))))
            # The scaled recurrence: what it does to the largest eigenvalue stays 1.
            scale = first = half / (values[0] - middle)
            before, now = block, (times - middle * block) * (scale / half)
            for _ in range(1, steps):
                nxt = 1 / (2 / first - scale)
                before, now = now, (self.product(now) - middle * now) * (2 * nxt / half) - scale * nxt * before
                scale = nxt
            block = np.linalg.qr(now / np.linalg.norm(now, axis=0))[0]
            times = self.product(block)
        with_variance = values[:k] > FLAT * max(values[0], 0)
        self.values, self.vectors = values[:k][with_variance], np.ascontiguousarray(block[:, :k][:, with_variance])
        self._measure()

    def _measure(self) -> None:
        """Trace of V and the greatest departure of the whitened covariance from the identity: one pass."""
        project, centred, n = self.projection(), self.centred(), self.n

        def part(batches: Iterator[pa.RecordBatch]) -> Any:
            total = None
            for b in batches:
                if b.num_rows:
                    x = (centred(b.column(0)) / n).astype(np.float64)
                    w = x @ project
                    one = ((x * x).sum(), w.sum(axis=0), w.T @ w)
                    total = one if total is None else tuple(p + q for p, q in zip(total, one))
            return total
        trace, first, second = tree_reduce(self.rows, part, lambda a, b: tuple(p + q for p, q in zip(a, b)))
        self.trace = float(trace) / n
        mean = first / n
        apart = second / n - np.outer(mean, mean) - np.eye(len(mean))
        self.identity_error = float(np.abs(apart).max()) if apart.size else 0.0

    def projection(self) -> np.ndarray:
        """From a centred vector to its whitened components."""
        return self.vectors / np.sqrt(self.values)


def whiten(table: DataFrame, column: str = "embedding", keep: list[str] | None = None, components: int = COMPONENTS,
           guard: int = GUARD, degree: int = DEGREE) -> DataFrame:
    """One row for each remaining row and component: struct ``d`` of ``keep``, ``component`` (from 1), ``n``,
    ``deviation``, ``whitened``, ``explained``, ``identity_error``."""
    rows = whole_vectors(table, column, keep or ["vec_id"])
    fit = Fit(rows, components, guard, degree)
    kind = rows.schema["d"].dataType.simpleString()
    schema = (f"d {kind}, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    k = len(fit.values)
    if not k:
        return rows.sparkSession.createDataFrame([], schema)
    n, centred, project, wide = fit.n, fit.centred(), fit.projection(), fit.wide
    explained, error = fit.values / fit.trace, fit.identity_error

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            off = centred(b.column(1))
            high = max(abs(int(off.min())), abs(int(off.max())))
            if wide or high * high * off.shape[1] >= _LONG:
                sums = [sum(int(c) * int(c) for c in row) for row in off]
                deviation = pa.array([s if s < _LONG else None for s in sums], pa.int64())
            else:
                deviation = pa.array((off * off).sum(axis=1))
            white = (off / n).astype(np.float64) @ project
            m = len(off)
            again = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(again), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                 pa.array(np.full(m * k, n)), deviation.take(again), pa.array(white.ravel()),
                 pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                names=["d", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select("d", "x").mapInArrow(spread, schema)
