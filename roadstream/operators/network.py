"""Train a perceptron by L-BFGS, with the loss and its gradient summed by Spark.

``MultilayerPerceptronClassifier`` gives the first weights and the model. Its own training
multiplies the matrices of each block of rows in scalar JVM code, which takes most of the
time of a fit. Here each task does it with numpy on the same blocks, and the driver takes the
same steps as Spark's L-BFGS, so that weights agree up to rounding.
"""

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import (
    MultilayerPerceptronClassificationModel,
    MultilayerPerceptronClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadstream.operators.sizes import checkpointed

BLOCKS_PER_MATRIX = 16
CORRECTIONS, TOLERANCE, VALUES = 10, 1e-6, 20
DECREASE, CURVATURE, TRIES = 1e-4, 0.9, 10  # strong Wolfe conditions

Loss = Callable[[np.ndarray], tuple[float, np.ndarray]]


class SearchFailed(Exception):
    """No step along a direction meets the conditions."""


def matrices(rows: DataFrame, classes: int, block: int) -> DataFrame:
    """``label`` and ``features`` as matrices of whole blocks, written once for all passes.

    As in Spark's training a partition's rows are stacked in blocks, the last one shorter.
    """
    size = block * BLOCKS_PER_MATRIX

    def pack(batches):
        def packed(x, y):
            columns = [pa.array([m.tobytes()], pa.binary()) for m in (x, y)]
            return pa.RecordBatch.from_arrays(columns, ["x", "y"])

        x, y = None, None
        for batch in batches:
            labels = batch.column("label")
            if not batch.num_rows:
                continue
            new_y = labels.to_numpy(zero_copy_only=False).astype(float)
            new_x = batch.column("x").flatten().to_numpy(zero_copy_only=False)
            new_x = new_x.reshape(batch.num_rows, -1)
            whole = (new_y >= 0) & (new_y < classes) & (new_y == np.floor(new_y))
            if not whole.all() or np.isnan(new_x).any():
                raise ValueError(f"labels are the numbers below {classes}, features never NaN")
            x = new_x if x is None else np.concatenate([x, new_x])
            y = new_y if y is None else np.concatenate([y, new_y])
            while len(y) >= size:
                yield packed(x[:size], y[:size])
                x, y = x[size:], y[size:]
        if y is not None and len(y):
            yield packed(x, y)

    given = rows.select(F.col("label").cast("double"), vector_to_array("features").alias("x"))
    return checkpointed(given.mapInArrow(pack, "x binary, y binary"))


def unrolled(weights: np.ndarray, layers: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """The matrix and the offsets of each layer, as views of Spark's vector of weights."""
    parts, at = [], 0
    for rows, columns in zip(layers, layers[1:]):
        end = at + rows * columns
        parts.append((weights[at:end].reshape(rows, columns), weights[end : end + columns]))
        at = end + columns
    return parts


def block_sums(x, y, layers: list[int], weights: np.ndarray, block: int) -> tuple[float, np.ndarray]:
    """Cross entropy and gradient, each block's mean summed over the blocks."""
    parts, outputs = unrolled(weights, layers), [x]
    for matrix, offsets in parts[:-1]:
        z = outputs[-1] @ matrix + offsets
        with np.errstate(over="ignore"):
            outputs.append(1 / (1 + np.exp(-z)))
    z = outputs[-1] @ parts[-1][0] + parts[-1][1]
    z -= z.max(axis=1, keepdims=True)
    log_p = z - np.log(np.exp(z).sum(axis=1, keepdims=True))
    share = np.full(len(y), 1 / block)
    if rest := len(y) % block:
        share[-rest:] = 1 / rest
    at = (np.arange(len(y)), y.astype(int))
    loss = -(share * log_p[at]).sum()
    delta = np.exp(log_p)
    delta[at] -= 1
    delta *= share[:, None]
    gradient = np.empty_like(weights)
    for k, (matrix, offsets) in reversed(list(enumerate(unrolled(gradient, layers)))):
        matrix[:], offsets[:] = outputs[k].T @ delta, delta.sum(axis=0)
        if k:
            delta = (delta @ parts[k][0].T) * outputs[k] * (1 - outputs[k])
    return loss, gradient


def loss_over(blocks: DataFrame, layers: list[int], block: int) -> Loss:
    """Mean loss of the blocks and its gradient; a task sends one vector of sums."""

    def loss(weights: np.ndarray) -> tuple[float, np.ndarray]:
        def sums(batches):
            total = np.zeros(len(weights) + 2)
            for batch in batches:
                for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                    y = np.frombuffer(y.as_buffer())
                    x = np.frombuffer(x.as_buffer()).reshape(len(y), -1)
                    value, gradient = block_sums(x, y, layers, weights, block)
                    total[0] += -(-len(y) // block)
                    total[1] += value
                    total[2:] += gradient
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

        total = np.zeros(len(weights) + 2)
        for row in blocks.mapInArrow(sums, "sums binary").collect():
            total += np.frombuffer(row.sums)
        return total[1] / total[0], total[2:] / total[0]

    return loss


def _direction(gradient: np.ndarray, steps: list[np.ndarray], changes: list[np.ndarray]):
    """Minus the gradient times the inverse Hessian that the last steps suggest, newest first."""
    out, kept = gradient.copy(), []
    for s, y in zip(steps, changes):
        rho = s @ y
        kept.append((s @ out / rho, rho))
        out -= kept[-1][0] * y
    if steps:
        curve = steps[0] @ changes[0]
        if not curve >= 0:
            raise SearchFailed
        out *= curve / (changes[0] @ changes[0])
    for (a, rho), s, y in reversed(list(zip(kept, steps, changes))):
        out += (a - y @ out / rho) * s
    return -out


def _between(low, high) -> float:
    """The minimum of the cubic through two points, kept off their ends."""
    (t0, f0, d0), (t1, f1, d1) = sorted([low[:3], high[:3]], key=lambda p: p[0])
    a = d0 + d1 - 3 * (f0 - f1) / (t0 - t1)
    root = a * a - d0 * d1
    b = np.sqrt(root) if root >= 0 else np.nan
    t = t1 - (t1 - t0) * (d1 + b - a) / (d1 - d0 + 2 * b)
    least, most = t0 + 0.1 * (t1 - t0), t0 + 0.9 * (t1 - t0)
    return least if t < least else most if t > most else t


def _search(loss: Loss, x, value: float, gradient, direction, t: float):
    """A step along ``direction`` that meets the strong Wolfe conditions: point, loss, gradient."""
    slope = gradient @ direction
    if slope > 0:
        raise SearchFailed

    def at(t: float):
        point = x + t * direction
        f, g = loss(point)
        return t, f, g @ direction, (point, f, g)

    def enough(c) -> bool:
        if abs(c[2]) > CURVATURE * abs(slope):
            return False
        if c[0] * np.linalg.norm(gradient) < 1e-10:
            raise SearchFailed
        return True

    def zoom(low, high):
        for _ in range(TRIES):
            c = at(_between(low, high))
            if c[1] > value + DECREASE * c[0] * slope or c[1] >= low[1]:
                high = c
            else:
                if enough(c):
                    return c[3]
                if c[2] * (high[0] - low[0]) >= 0:
                    high = low
                low = c
        raise SearchFailed

    low = (0.0, value, slope, None)
    for i in range(TRIES):
        c = at(t)
        if not np.isfinite(c[1]):
            t /= 2
            continue
        if c[1] > value + DECREASE * t * slope or (c[1] >= low[1] and i):
            return zoom(low, c)
        if enough(c):
            return c[3]
        if c[2] >= 0:
            return zoom(c, low)
        low, t = c, t * 1.5
    raise SearchFailed


def minimised(loss: Loss, x: np.ndarray, rounds: int) -> np.ndarray:
    """``x`` after up to ``rounds`` rounds of L-BFGS, which end as in Spark's."""
    value, gradient = loss(x)
    first, values, steps, changes = value, [np.inf], [], []
    done, failed = 0, False
    while done < rounds:
        still = abs(value - max(values)) <= TOLERANCE * first if len(values) > 1 else False
        if still or np.linalg.norm(gradient) <= max(TOLERANCE * value, 1e-8):
            break
        try:
            direction = _direction(gradient, steps, changes)
            t = 1.0 if done else 1 / np.linalg.norm(direction)
            point, value, slope = _search(loss, x, value, gradient, direction, t)
        except SearchFailed:
            if failed:
                break
            failed, steps, changes = True, [], []  # once more, down the gradient
            continue
        steps = [point - x, *steps][:CORRECTIONS]
        changes = [slope - gradient, *changes][:CORRECTIONS]
        x, gradient, failed, done = point, slope, False, done + 1
        values = [*values, value][-VALUES:]
    return x


def fit_network(
    rows: DataFrame, network: MultilayerPerceptronClassifier, blocks: DataFrame
) -> MultilayerPerceptronClassificationModel:
    """What ``network`` (L-BFGS) would fit to ``rows``, which ``blocks`` holds as matrices."""
    one, rounds = rows.limit(1), network.getMaxIter()
    still = network.copy({network.maxIter: 0})
    layers = list(network.getLayers())
    loss = loss_over(blocks, layers, network.getBlockSize())
    found = minimised(loss, still.fit(one).weights.toArray(), rounds)
    return still.setInitialWeights(found.tolist()).fit(one)
