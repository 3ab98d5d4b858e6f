"""Logistic regression of two classes on sparse rows.

One weight per feature, and gradients that stay sparse: a task sends the sums of the
features its rows hold, never an array over all features. Spark adds these up by index.
The weights themselves, one number per feature, are on the driver and in every task; the
caller bounds their number.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Places of the loss and of the intercept among the sums of a pass.
LOSS, INTERCEPT = -2, -1
_SUMS = "index long, value double"
# Steps whose gradients shape the next one.
_MEMORY = 6


def _sums(shared):
    """Per Arrow batch of rows: loss, intercept's gradient and the gradient of each feature seen."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        for batch in batches:
            label = batch["label"].to_numpy(zero_copy_only=False)
            share = batch["weight"].to_numpy(zero_copy_only=False)
            places, values = (batch[c].flatten().to_numpy(zero_copy_only=False) for c in ("indices", "values"))
            row = batch["indices"].value_parent_indices().to_numpy(zero_copy_only=False)
            margin = weights[-1] + np.bincount(row, weights[places] * values, len(label))
            signed = np.where(label == 1, margin, -margin)
            loss = float(share @ np.logaddexp(0.0, -signed))
            residual = share * (0.5 * (1.0 + np.tanh(margin / 2.0)) - (label == 1))
            seen, where = np.unique(places, return_inverse=True)
            of_features = np.bincount(where, residual[row] * values, len(seen))
            index = np.concatenate([[LOSS, INTERCEPT], seen]).astype(np.int64)
            sums = np.concatenate([[loss, residual.sum()], of_features])
            yield pa.RecordBatch.from_arrays([pa.array(index), pa.array(sums)], ["index", "value"])

    return run


def _objective(rows: DataFrame, total: float, penalty: float):
    """Mean loss with its penalty, and the gradient; the last place is the intercept."""
    context = rows.sparkSession.sparkContext

    def evaluate(weights: np.ndarray) -> tuple[float, np.ndarray]:
        shared = context.broadcast(weights)
        try:
            sums = (
                rows.mapInArrow(_sums(shared), _SUMS).groupBy("index").agg(F.sum("value").alias("value")).toArrow()
            )
        finally:
            shared.destroy()
        index, value = sums["index"].to_numpy(), sums["value"].to_numpy()
        gradient = np.zeros(len(weights))
        places = index >= INTERCEPT
        # The intercept's -1 is the last place.
        gradient[index[places]] = value[places] / total
        gradient[:-1] += penalty * weights[:-1]
        loss = value[index == LOSS].sum() / total + penalty / 2 * float(weights[:-1] @ weights[:-1])
        return loss, gradient

    return evaluate


def _direction(gradient: np.ndarray, steps: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The quasi-Newton direction from the last steps and the changes of the gradient."""
    q, shares = gradient.copy(), []
    for step, change in reversed(steps):
        share = (step @ q) / (step @ change)
        q -= share * change
        shares.append(share)
    if steps:
        step, change = steps[-1]
        q *= (step @ change) / (change @ change)
    for (step, change), share in zip(steps, reversed(shares)):
        q += (share - (change @ q) / (step @ change)) * step
    return -q


def minimise(
    evaluate: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, passes: int, tolerance: float
) -> np.ndarray:
    """The lowest point found with at most ``passes`` calls for a value and its gradient.

    Ends early when a step improves the value by less than ``tolerance`` of it.
    """
    weights = start
    loss, gradient = evaluate(weights)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    used = 1
    while used < passes:
        direction = _direction(gradient, steps)
        slope = float(gradient @ direction)
        if slope >= 0:
            break
        # Without earlier steps nothing is known of the scale.
        size = 1.0 if steps else 1.0 / max(1e-12, float(np.linalg.norm(gradient)))
        while used < passes:
            trial = weights + size * direction
            used += 1
            new_loss, new_gradient = evaluate(trial)
            if new_loss <= loss + 1e-4 * size * slope:
                break
            size /= 4
        else:
            break
        step, change = trial - weights, new_gradient - gradient
        if step @ change > 1e-12:
            steps = [*steps, (step, change)][-_MEMORY:]
        done = loss - new_loss < tolerance * max(abs(loss), 1e-12)
        weights, loss, gradient = trial, new_loss, new_gradient
        if done:
            break
    return weights


def fit_weights(
    rows: DataFrame, features: int, penalty: float = 0.01, passes: int = 30, tolerance: float = 1e-5
) -> np.ndarray:
    """Weights of all features and, last, the intercept.

    ``rows`` is ``(label, weight, indices, values)`` with labels 0 and 1, read once in each
    of at most ``passes`` passes; keep it stored. The penalty, on squares, leaves the
    intercept out. Without rows all weights are zero.
    """
    total = rows.agg(F.coalesce(F.sum("weight"), F.lit(0.0))).head()[0]
    start = np.zeros(features + 1)
    return minimise(_objective(rows, total, penalty), start, passes, tolerance) if total > 0 else start
