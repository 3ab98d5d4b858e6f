"""Whitening embeddings on their leading principal components, found by spectrum slicing.

Entries become whole numbers, ``floor(256 * c)``. The fit list holds each distinct vector
once; its sums are exact and its covariance is centred before multiplying, summed up by the
tasks and added up by Spark. Only sums over dimensions come to the driver, however many
vectors there are.

Leading eigenvalues are isolated by counting: by Sylvester's law the pivots of an LDLᵀ
factorisation of ``V - s I`` that are positive are as many as the eigenvalues above ``s``.
Bisection on that count finds a bracket with one eigenvalue; Rayleigh quotient iteration
takes it to double precision, cubically; two counts close around the result certify its
number. Eigenvalues that cannot be told apart share a bracket, and an orthonormal basis of
their common space serves for them.

Vectors that are null, or have null, non-finite or very large entries (beyond ``LARGEST``),
are left out. Shorter vectors are filled up with zeros. Repeated rows are whitened each but
fitted once. A component without variance has ``whitened`` and ``explained`` 0 and does not
count in ``identity_error``. A table without vectors gives no rows. Columns that are not asked for play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presscheck.llm.tables import materialise, share, shared

SCALE = 256
# Sums of a batch stay within 64 bits below this.
LARGEST = 1 << 40
COMPONENTS = 4
# Of the sum of variances; closer eigenvalues share a bracket.
CLOSE = 1e-13
_EPS = float(np.finfo(float).eps)
WHITENED = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whole_numbers(vectors: DataFrame, vector: str, carry: list[str]) -> DataFrame:
    """``carry`` and ``x`` for the vectors that take part."""
    entries = F.col(vector).cast("array<double>")
    fits = F.forall(entries, lambda c: F.coalesce(F.abs(c * SCALE) < LARGEST, F.lit(False)))
    kept = vectors.where(F.col(vector).isNotNull()).where(fits)
    return kept.select(*carry, F.transform(entries, lambda c: F.floor(c * SCALE)).alias("x"))


def _filled(x: str, dimensions: int) -> Column:
    missing = F.array_repeat(F.lit(0).cast("long"), F.lit(dimensions) - F.size(x))
    return F.concat(x, missing)


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def _sums(dimensions: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = _matrix(batch["x"], dimensions).sum(axis=0)
            place = np.arange(dimensions + 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(place), pa.array(np.append(total, batch.num_rows))], ["place", "value"]
            )

    return run


def _products(dimensions: int, centre: np.ndarray, onto: np.ndarray):
    """Sums of products of the centred vectors, projected by ``onto``; one row per upper entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            centred = (_matrix(batch["x"], dimensions) - centre) @ onto
            total = centred.T @ centred + (0 if total is None else total)
        if total is not None:
            upper = np.triu_indices(onto.shape[1])
            place = upper[0] * onto.shape[1] + upper[1]
            yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(total[upper])], ["place", "value"])

    return run


def _covariance(fit_list: DataFrame, n: int, centre: np.ndarray, onto: np.ndarray) -> np.ndarray:
    size = onto.shape[1]
    sums = (
        fit_list.mapInArrow(_products(len(centre), centre, onto), "place long, value double")
        .groupBy("place")
        .agg(F.sum("value").alias("value"))
        .toArrow()
    )
    upper = np.zeros(size * size)
    upper[sums["place"].to_numpy()] = sums["value"].to_numpy() / n
    upper = upper.reshape(size, size)
    return upper + np.triu(upper, 1).T


# Eigenvalues of a symmetric matrix, on the driver.


def count_above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues exceed ``shift``: positive pivots of the factored difference.

    Pivots are chosen on the diagonal, one or two rows at a time, as Bunch and Parlett do, so
    no pivot is small against what is left.
    """
    rest = matrix - shift * np.eye(len(matrix))
    grow = (1 + 17**0.5) / 8
    positive = 0
    while len(rest):
        size = np.abs(rest)
        i, j = np.unravel_index(size.argmax(), size.shape)
        if size[i, j] == 0.0:
            break  # what is left is zero: these eigenvalues equal the shift
        d = int(size.diagonal().argmax())
        if size[d, d] >= grow * size[i, j]:
            positive += rest[d, d] > 0
            rows = [d]
            change = np.outer(rest[:, d], rest[d]) / rest[d, d]
        else:
            # A pair without a dominant diagonal has one eigenvalue of each sign.
            positive += 1
            rows = [i, j]
            change = rest[:, rows] @ np.linalg.solve(rest[np.ix_(rows, rows)], rest[rows])
        rest = np.delete(np.delete(rest - change, rows, 0), rows, 1)
        rest = (rest + rest.T) / 2
    return int(positive)


def _bracket(matrix: np.ndarray, number: int, low: float, high: float, close: float) -> tuple[float, float, int, int]:
    """Bounds around eigenvalue ``number``, from 1 by falling size, and the first and last number in them.

    As many as ``first - 1`` lie above the upper bound; all from ``first`` to ``last`` within.
    """
    above_low, above_high = len(matrix), 0
    while above_low - above_high > 1 and high - low > close:
        middle = (low + high) / 2
        above = count_above(matrix, middle)
        if above >= number:
            low, above_low = middle, above
        else:
            high, above_high = middle, above
    return low, high, above_high + 1, above_low


def _solve(matrix: np.ndarray, shift: float, right: np.ndarray, scale: float) -> np.ndarray:
    """A solution for a shift that may be an eigenvalue: its direction is what is wanted then."""
    for nudge in (0.0, _EPS, 64 * _EPS):
        try:
            found = np.linalg.solve(matrix - (shift + nudge * scale) * np.eye(len(matrix)), right)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(found).all():
            return found
    return right


def _alone(matrix: np.ndarray, low: float, high: float, start: np.ndarray, scale: float) -> tuple[float, np.ndarray]:
    """The one eigenvalue between the bounds, by Rayleigh quotients kept between them."""
    vector, value = start / np.linalg.norm(start), (low + high) / 2
    best = np.inf
    for _ in range(60):
        vector = _solve(matrix, value, vector, scale)
        vector /= np.linalg.norm(vector)
        quotient = float(vector @ matrix @ vector)
        residual = float(np.linalg.norm(matrix @ vector - quotient * vector))
        inside = low <= quotient <= high
        if inside and residual <= 8 * _EPS * scale or inside and residual >= best / 2 and best < 1e-12 * scale:
            break
        if inside:
            value, best = quotient, min(best, residual)
        else:
            # Drawn to another eigenvalue: halve the bounds by a count and go on from their middle.
            low, high, _, _ = _bracket(matrix, count_above(matrix, low), low, high, (high - low) / 1.5)
            value = (low + high) / 2
    return quotient, vector


def _together(matrix: np.ndarray, low: float, high: float, size: int, scale: float, start: np.ndarray):
    """Eigenvalues that no count tells apart: a basis of their space, turned to the axes of the matrix in it."""
    basis = np.linalg.qr(start[:, :size])[0]
    for _ in range(20):
        basis = np.linalg.qr(_solve(matrix, (low + high) / 2, basis, scale))[0]
    inner = basis.T @ matrix @ basis
    return np.diag(inner), basis


def leading(matrix: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit eigenvectors as columns."""
    size = len(matrix)
    wanted = min(components, size)
    reach = float(np.abs(matrix).sum(axis=1).max()) if size else 0.0
    values, vectors = np.zeros(wanted), np.eye(size, wanted)
    if not reach > 0:
        return values, vectors
    starts = np.random.default_rng(1).normal(size=(size, size))
    low, high = -reach * (1 + 1e-9), reach * (1 + 1e-9)
    number, found_values, found_vectors = 1, [], []
    while number <= wanted:
        below, above, first, last = _bracket(matrix, number, low, high, CLOSE * reach)
        if last == first:
            value, vector = _alone(matrix, below, above, starts[:, number - 1], reach)
            found_values.append(value)
            found_vectors.append(vector)
        else:
            of_bracket, basis = _together(matrix, below, above, last - first + 1, reach, starts)
            found_values += of_bracket.tolist()
            found_vectors += list(basis.T)
        slack = max(64 * size * _EPS, 2 * CLOSE) * reach
        # The certificate: no more lie above the bracket's values than have been numbered.
        if count_above(matrix, max(found_values[first - 1 :]) + slack) > first - 1 or count_above(
            matrix, min(found_values[first - 1 :]) - slack
        ) < last:
            raise ArithmeticError(f"eigenvalue {number} is not certified by its counts")
        number = last + 1
    order = np.argsort(found_values)[::-1][:wanted]
    # Orthogonal up to rounding; this takes the rounding away and keeps the signs.
    basis, turned = np.linalg.qr(np.stack(found_vectors, 1)[:, order])
    return np.array(found_values)[order], basis * np.sign(np.diag(turned))


# The operator.


@dataclass(frozen=True)
class Whitening:
    n: int
    sums: list[int]
    centre: np.ndarray
    # One column per component, divided by the root of its variance; a column without variance is zero.
    onto: np.ndarray
    explained: np.ndarray
    identity_error: float


def fit(x_vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fitted on ``x`` of :func:`whole_numbers`; None if there are no vectors."""
    dimensions = x_vectors.agg(F.max(F.size("x"))).head()[0]
    if not dimensions:
        return None
    distinct = x_vectors.select(_filled("x", dimensions).alias("x")).distinct()
    fit_list = materialise(distinct, "fit-list")
    sums = fit_list.mapInArrow(_sums(dimensions), "place long, value long")
    sums = sums.groupBy("place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()
    exact = {row.place: int(row.value) for row in sums}
    n, totals = exact[dimensions], [exact[i] for i in range(dimensions)]
    centre = np.array([total / n for total in totals])
    covariance = _covariance(fit_list, n, centre, np.eye(dimensions))
    values, vectors = leading(covariance, components)
    trace = float(np.trace(covariance))
    varies = values > 8 * dimensions * _EPS * trace
    onto = vectors * np.where(varies, 1 / np.sqrt(np.where(varies, values, 1.0)), 0.0)
    explained = np.where(varies, values / (trace if trace > 0 else 1.0), 0.0)
    error = np.abs(_covariance(fit_list, n, centre, onto) - np.diag(varies.astype(float)))
    return Whitening(n, totals, centre, onto, explained, float(error.max()))


def _whitener(model, carry: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted: Whitening = shared(model)
        dimensions, width = fitted.onto.shape
        most = max([1, *map(abs, fitted.sums)])
        for batch in batches:
            x = _matrix(batch["x"], dimensions)
            rows = len(x)
            reach = 2 * max(fitted.n * int(np.abs(x).max(initial=0)), most)
            exact = x if reach * reach * dimensions < 1 << 62 else x.astype(object)
            squares = (exact * fitted.n - np.array(fitted.sums, exact.dtype)) ** 2
            total = squares.sum(axis=1)
            # Beyond 64 bits there is no long to return.
            deviation = pa.array([v if v < 1 << 63 else None for v in total.tolist()], pa.int64())
            white = (x - fitted.centre) @ fitted.onto
            again = pa.array(np.repeat(np.arange(rows), width))
            arrays = [batch[c].take(again) for c in carry] + [
                pa.array(np.tile(np.arange(1, width + 1), rows), pa.int32()),
                pa.array(np.full(rows * width, fitted.n), pa.int64()),
                deviation.take(again),
                pa.array(white.ravel()),
                pa.array(np.tile(fitted.explained, rows)),
                pa.array(np.full(rows * width, fitted.identity_error)),
            ]
            names = [*carry, "component", "n", "deviation", "whitened", "explained", "identity_error"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return run


def whiten(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """One row per vector that takes part and leading component, numbered from 1."""
    x_vectors = whole_numbers(vectors, vector, [key])
    kind = x_vectors.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, {WHITENED}"
    model = fit(x_vectors, components)
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    filled = x_vectors.select(key, _filled("x", len(model.centre)).alias("x"))
    return filled.mapInArrow(_whitener(share(vectors.sparkSession, model), [key]), schema)
