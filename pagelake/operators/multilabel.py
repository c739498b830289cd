"""One-pass training of many logistic regressions.

All models - every label, and every point of a grid - are trained together: a pass over the feature table gives the
loss and the gradient of each of them, from the values that the rows' features hold (packed in blocks, once).
Each task sums its rows; the sums of many tasks are added in a second level before they reach the driver, which
holds one small matrix for them. There, each model has a limited-memory quasi-Newton search of its own; all of
them ask for their next points at the same time. So the number of passes is that of the slowest model, whatever the
number of labels.

The objective is the mean logistic loss plus ``reg / 2`` times the squared coefficients of the standardised features;
the intercept is not penalised.
"""

from __future__ import annotations

from collections.abc import Generator, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import LARGE_ROWS, arrow_bytes, ship_code, written

#: Cells of a dense block of features, values of a packed one, sums of tasks that reach the driver at once, and bytes of
#: an Arrow batch of features or blocks.
CELLS, PACKED, DIRECT, BATCH = 1 << 22, 1 << 16, 64, 8 << 20
#: Steps whose curvature a search remembers, points it tries on a line, and the relative gain at which it ends.
MEMORY, TRIES, TOLERANCE = 10, 30, 1e-6


def blocks(features: pa.Array) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Dense blocks of a column of ML vectors: (rows, their values in some columns, those columns)."""
    size, index, value = _sparse(features)
    at, n, first = np.concatenate([[0], np.cumsum(size)]), len(size), 0
    while first < n:
        # rows whose product with their number of values stays in bounds (at least one)
        step = np.arange(1, n - first + 1) * (at[first + 1 :] - at[first])
        last = first + max(1, int(np.searchsorted(step, CELLS, side="right")))
        some = slice(at[first], at[last])
        columns, place = _columns(index[some])
        x = np.zeros((last - first, len(columns)))
        x[np.repeat(np.arange(last - first), size[first:last]), place] = value[some]
        yield slice(first, last), x, columns
        first = last


def _columns(index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct indices, ascending, and each index's place among them: by marks, as sorting them cost most of a pass."""
    place = np.zeros(index.max(initial=-1) + 1, dtype=np.int64)
    place[index] = 1
    columns = np.flatnonzero(place)
    place[columns] = np.arange(len(columns))
    return columns, place[index]


def _sparse(features: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of values of each row, and all indices and values; dense vectors have all their indices."""
    def lists(name):
        f = features.field(name)
        n = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(f), 0), dtype=np.int64)
        return n, f.flatten().to_numpy(zero_copy_only=False)

    (n, index), (m, value) = lists("indices"), lists("values")
    if np.array_equal(n, m):
        return m, index.astype(np.int64), value
    dense = np.asarray(features.field("type")) == 1
    row_dense, start = np.repeat(dense, m), np.repeat(np.cumsum(m) - m, m)
    whole = np.arange(len(value)) - start
    whole[~row_dense] = index
    return m, whole, value


def packed(table: DataFrame) -> DataFrame:
    """The rows of ``features, y`` in blocks, written for many passes: each a row with the number of values of its rows,
    their indices and values, and the targets, all as bytes."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size, index, value = _sparse(b.column("features"))
            y = b.column("y").flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(b.num_rows, -1)
            at = np.concatenate([[0], np.cumsum(size)])
            cuts = np.flatnonzero(np.diff(at[1:] // PACKED)) + 1
            for first, last in zip([0, *cuts], [*cuts, b.num_rows], strict=True):
                some = slice(at[first], at[last])
                cells = size[first:last].astype(np.int32), index[some].astype(np.int32), value[some].astype(np.float64), y[first:last]
                if last > first:
                    yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in cells], names=list("nivy"))

    with arrow_bytes(table.sparkSession, BATCH):
        return written(table.mapInArrow(pack, "n binary, i binary, v binary, y binary"), "features", options=LARGE_ROWS)


def _unpacked(batches: Iterator[pa.RecordBatch], labels: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Of each block: the row, the index and the value of each value, and the targets of its rows."""
    for b in batches:
        for cells in zip(*(b.column(c) for c in "nivy"), strict=True):
            size, index, value, y = (np.frombuffer(x.as_buffer(), t) for x, t in zip(cells, (np.int32, np.int32, np.float64, np.float32), strict=True))
            yield np.repeat(np.arange(len(size)), size), index.astype(np.int64), value, y.astype(np.float64).reshape(len(size), labels)


def _summed(table: DataFrame, per_task) -> np.ndarray:
    """The sum over all tasks of the arrays that ``per_task`` (batches -> array) makes, in two levels if they are many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([per_task(batches).tobytes()], pa.binary())], names=["sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            for x in b.column("sums"):
                x = np.frombuffer(x.as_buffer(), dtype=np.float64)
                total = x.copy() if total is None else total + x
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    sums = table.mapInArrow(run, "sums binary")
    parts = table.rdd.getNumPartitions()
    if parts > DIRECT:
        level = int(np.ceil(np.sqrt(parts)))
        sums = sums.repartition(level, F.spark_partition_id() % level).mapInArrow(add, "sums binary")
    with arrow_bytes(table.sparkSession, BATCH):
        return sum(np.frombuffer(r.sums, dtype=np.float64) for r in sums.collect())


@dataclass
class Problem:
    """A packed table of ``features`` and ``y`` (0/1 targets as an array) with what standardises it."""

    table: DataFrame
    n: int
    scale: np.ndarray  # 1 / standard deviation of each feature, 0 for a constant one
    positive: np.ndarray  # rows with each label

    @staticmethod
    def of(table: DataFrame, dim: int, labels: int) -> Problem:
        ship_code(table.sparkSession)

        table = packed(table)

        def moments(batches):
            out = np.zeros(1 + 2 * dim + labels)
            for _, index, value, y in _unpacked(batches, labels):
                out[0] += len(y)
                out[1 + 2 * dim :] += y.sum(axis=0)
                out[1 : 1 + dim] += np.bincount(index, weights=value, minlength=dim)
                out[1 + dim : 1 + 2 * dim] += np.bincount(index, weights=value * value, minlength=dim)
            return out

        sums = _summed(table, moments)
        n = int(sums[0])
        mean, square = sums[1 : 1 + dim] / max(n, 1), sums[1 + dim : 1 + 2 * dim]
        variance = np.maximum(square - n * mean * mean, 0) / max(n - 1, 1)
        scale = np.divide(1.0, np.sqrt(variance), out=np.zeros(dim), where=variance > 1e-18)
        return Problem(table, n, scale, sums[1 + 2 * dim :])

    def losses(self, points: np.ndarray, label: np.ndarray, reg: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Objective and gradient of each model: a point has the scaled coefficients and the intercept."""
        sent = self.table.sparkSession.sparkContext.broadcast((points[:, :-1] * self.scale, points[:, -1], label))
        labels = len(self.positive)

        def one_pass(batches):
            w, bias, which = sent.value
            out = np.zeros((len(w), w.shape[1] + 2))
            for row, index, value, targets in _unpacked(batches, labels):
                for j, coefficients in enumerate(w):
                    margin = np.bincount(row, weights=value * coefficients[index], minlength=len(targets)) + bias[j]
                    y = targets[:, which[j]]
                    rest = 1 / (1 + np.exp(-margin)) - y
                    out[j, :-2] += np.bincount(index, weights=value * rest[row], minlength=w.shape[1])
                    out[j, -2] += rest.sum()
                    out[j, -1] += (np.logaddexp(0, margin) - y * margin).sum()
            return out

        sums = _summed(self.table, one_pass).reshape(len(points), -1)
        sent.destroy()
        gradient = sums[:, :-1] / self.n
        gradient[:, :-1] = gradient[:, :-1] * self.scale + reg[:, None] * points[:, :-1]
        return sums[:, -1] / self.n + 0.5 * reg * (points[:, :-1] ** 2).sum(axis=1), gradient


Search = Generator[np.ndarray, tuple[float, np.ndarray], np.ndarray]


def search(point: np.ndarray, max_iter: int) -> Search:
    """Limited-memory quasi-Newton descent: yields points, is sent (value, gradient), returns the best point."""
    value, gradient = yield point
    steps: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(max_iter):
        direction, weights = gradient.copy(), []
        for s, y, rho in reversed(steps):
            weights.append(rho * (s @ direction))
            direction -= weights[-1] * y
        if steps:
            s, y, _ = steps[-1]
            direction *= (s @ y) / (y @ y)
        for (s, y, rho), a in zip(steps, reversed(weights), strict=True):
            direction += (a - rho * (y @ direction)) * s
        slope = -(gradient @ direction)
        if slope >= 0:
            steps, direction, slope = [], gradient.copy(), -(gradient @ gradient)
        if slope == 0:
            break
        length = 1.0 if steps else min(1.0, 1 / np.linalg.norm(gradient))
        for _ in range(TRIES):
            there = point - length * direction
            new_value, new_gradient = yield there
            if new_value <= value + 1e-4 * length * slope:
                break
            length /= 2
        else:
            break
        s, y = there - point, new_gradient - gradient
        if s @ y > 1e-12 * (y @ y):
            steps = [*steps[-(MEMORY - 1) :], (s, y, 1 / (s @ y))]
        gain = value - new_value
        point, value, gradient = there, new_value, new_gradient
        if gain <= TOLERANCE * max(abs(value), 1e-12):
            break
    return point


def train(problem: Problem, models: list[tuple[int, float, int]]) -> tuple[list[tuple[np.ndarray, float]], int]:
    """Coefficients and intercept for each model (label, reg, max_iter), and the number of passes that took."""
    share = np.clip(problem.positive / max(problem.n, 1), 1e-12, 1 - 1e-12)
    searches, asked, found = {}, {}, {}
    for k, (label, _, max_iter) in enumerate(models):
        first = np.zeros(len(problem.scale) + 1)
        first[-1] = np.log(share[label] / (1 - share[label]))
        searches[k] = search(first, max_iter)
        asked[k] = next(searches[k])
    passes = 0
    while asked:
        which = sorted(asked)
        points = np.stack([asked[k] for k in which])
        values, gradients = problem.losses(points, np.array([models[k][0] for k in which]), np.array([models[k][1] for k in which]))
        passes += 1
        for k, v, g in zip(which, values.tolist(), gradients, strict=True):
            try:
                asked[k] = searches[k].send((v, g))
            except StopIteration as end:
                found[k] = end.value
                del asked[k]
    return [(found[k][:-1] * problem.scale, float(found[k][-1])) for k in range(len(models))], passes


def scorer(coefficients: np.ndarray, intercepts: np.ndarray):
    """A column function: the probability of each label (array of doubles) from a column of ML vectors."""

    @F.arrow_udf("array<double>")
    def probabilities(features: pa.Array) -> pa.Array:
        out = np.zeros((len(features), len(intercepts)))
        for rows, x, columns in blocks(features):
            out[rows] = 1 / (1 + np.exp(-(x @ coefficients[:, columns].T + intercepts)))
        at = np.arange(len(features) + 1, dtype=np.int32) * len(intercepts)
        return pa.ListArray.from_arrays(pa.array(at), pa.array(out.ravel()))

    return probabilities
