"""Logistic regression by damped Newton steps, for many settings and folds in the same passes.

One pass over the rows sums, for every model that is still open, the loss, the gradient and the matrix of second
derivatives at its present coefficients: ``(d + 1)(d + 2) / 2 + d + 2`` numbers a model for d features, whatever the number
of rows. The driver solves the small systems. A model whose loss did not fall goes back half a step. So all settings of
a grid on all folds take as many passes as the slowest of them, about ten.

The penalised mean loss is ``sum(w * loss) / W + |b|^2 / (2 C W)`` over standardised features, W the sum of weights; the
intercept is free. Its minimum is unique, so the result does not depend on the path. Means and deviations (of the
sample, n - 1) are those of the rows a model is fitted on. A feature without deviation has no coefficient.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol, HasProbabilityCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.blocks import Block, blocked, blocks_of
from riskloom.session import TemporaryTables

#: A model is done when its Newton step promises to lower the loss by less than this.
GAIN = 1e-18
MOST_HALVINGS = 40


class Line:
    """Positive probabilities of a logistic model, for a matrix with a row a feature."""

    def __init__(self, weights: np.ndarray, intercept: float):
        self.weights, self.intercept = weights, intercept

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.exp(-np.logaddexp(0, -(self.weights @ x + self.intercept)))


class LinearModel(Model, HasFeaturesCol, HasProbabilityCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """A logistic model on raw features, evaluated by column expressions."""

    coefficients = Param(Params._dummy(), "coefficients", "weight of each feature", TypeConverters.toListFloat)
    intercept = Param(Params._dummy(), "intercept", "margin where all features are zero", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, coefficients: Sequence[float] = (), intercept: float = 0.0):
        super().__init__()
        self._setDefault(featuresCol="features", probabilityCol="probability", predictionCol="prediction")
        self._set(coefficients=list(coefficients), intercept=intercept)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        weights = self.getOrDefault(self.coefficients)
        x = vector_to_array(F.col(self.getFeaturesCol()))
        margin = F.lit(self.getOrDefault(self.intercept))
        for i, w in enumerate(weights):
            margin = margin + F.lit(w) * x[i]
        p = 1 / (1 + F.exp(-margin))
        # Each side by itself: one minus the other loses what is far from one half.
        both = F.array(1 / (1 + F.exp(margin)), p)
        scored = dataset.withColumn(self.getProbabilityCol(), array_to_vector(both))
        return scored.withColumn(self.getPredictionCol(), (margin > 0).cast("double"))

    def scorer(self) -> Line:
        return Line(np.array(self.getOrDefault(self.coefficients)), self.getOrDefault(self.intercept))


@dataclass
class _Fit:
    """One model on its way. Coefficients are those of standardised features, the intercept first."""

    params: Mapping
    weights: Mapping[int, float]
    without: int | None
    mean: np.ndarray
    deviation: np.ndarray
    total: float
    now: np.ndarray
    step: np.ndarray
    loss: float = np.inf
    halvings: int = 0
    passes: int = 0
    open: bool = True
    best: np.ndarray | None = None

    def penalty(self, at: np.ndarray) -> np.ndarray:
        return np.r_[0.0, at[1:]] / (self.params["C"] * self.total)

    def take(self, loss: float, gradient: np.ndarray, matrix: np.ndarray) -> None:
        """Move on from the sums at ``now``."""
        self.passes += 1
        loss = loss / self.total + 0.5 * self.penalty(self.now) @ self.now
        if not loss <= self.loss and self.halvings < MOST_HALVINGS:
            # Too far: half the step from the best point so far.
            self.step, self.halvings = self.step / 2, self.halvings + 1
            self.now = self.best + self.step
            return
        self.best, self.loss, self.halvings = self.now, loss, 0
        gradient = gradient / self.total + self.penalty(self.now)
        ridge = np.r_[0.0, np.full(len(self.now) - 1, 1 / (self.params["C"] * self.total))]
        self.step = -np.linalg.lstsq(matrix / self.total + np.diag(ridge), gradient, rcond=None)[0]
        self.open = -gradient @ self.step > GAIN and self.passes < self.params["max_iter"]
        if self.open:
            self.now = self.best + self.step

    def model(self) -> LinearModel:
        scale = np.divide(1.0, self.deviation, out=np.zeros_like(self.deviation), where=self.deviation > 0)
        raw = self.best[1:] * scale
        return LinearModel(coefficients=raw.tolist(), intercept=float(self.best[0] - raw @ self.mean))


def _summed(blocks: DataFrame, of_block, keys: int) -> np.ndarray:
    """The sum over all blocks of an array of ``keys`` numbers each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(keys)
        for block in blocks_of(batches):
            total += of_block(block)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(keys)), pa.array(total)], names=["key", "value"])

    rows = blocks.mapInArrow(run, "key bigint, value double").groupBy("key").agg(F.sum("value").alias("value")).toArrow()
    found = np.zeros(keys)
    found[rows.column("key").to_numpy()] = rows.column("value").to_numpy()
    return found


def standardised(block: Block, without: int | None, mean: np.ndarray, deviation: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ones and standardised features (a row each) of the rows outside a fold, and their labels."""
    some = slice(None) if without is None else np.flatnonzero(block.fold != without)
    scale = np.divide(1.0, deviation, out=np.zeros_like(deviation), where=deviation > 0)
    y = block.y[some]
    return np.vstack([np.ones(y.shape), (np.ascontiguousarray(block.x)[:, some] - mean[:, None]) * scale[:, None]]), y


def fit_linear(
    rows: DataFrame, settings: Sequence[tuple[Mapping, Mapping[int, float], int | None]], label: str, seed: int = 42
) -> list[LinearModel]:
    """A model for each (settings, weight per class, fold to leave out or None), from an assembled frame."""
    width = len(rows.select("features").first()[0])
    left_out = sorted({without for *_, without in settings}, key=str)
    with TemporaryTables(rows.sparkSession) as tables:
        blocks = tables.stored(blocked(rows, label, seed))

        def moments(block) -> np.ndarray:
            out = []
            for without in left_out:
                x = block.x[:, block.fold != without] if without is not None else block.x
                y = block.y[block.fold != without] if without is not None else block.y
                out += [[x.shape[1], (y == 1).sum()], x.sum(axis=1)]
            return np.concatenate(out)

        sums = _summed(blocks, moments, len(left_out) * (width + 2)).reshape(len(left_out), -1)
        means = sums[:, 2:] / np.maximum(1, sums[:, :1])

        def squares(block) -> np.ndarray:
            out = []
            for without, mean in zip(left_out, means, strict=True):
                x = block.x[:, block.fold != without] if without is not None else block.x
                out.append(((x - mean[:, None]) ** 2).sum(axis=1))
            return np.concatenate(out)

        spread = _summed(blocks, squares, len(left_out) * width).reshape(len(left_out), -1)
        fits = []
        for params, weights, without in settings:
            i = left_out.index(without)
            n, positive = sums[i, :2]
            total = weights.get(1, 0.0) * positive + weights.get(0, 0.0) * (n - positive)
            deviation = np.sqrt(spread[i] / max(1, n - 1))
            start = np.zeros(width + 1)
            fits.append(_Fit(params, weights, without, means[i], deviation, total, start, start.copy()))

        upper = np.triu_indices(width + 1)
        size = 1 + width + 1 + len(upper[0])
        while any(f.open for f in fits):
            asked = [(f.without, f.weights.get(0, 0.0), f.weights.get(1, 0.0), f.mean, f.deviation, f.now) for f in fits if f.open]

            def at(block, asked=asked) -> np.ndarray:
                out, seen = [], {}
                for without, of_0, of_1, mean, deviation, now in asked:
                    # All models without a fold have its means and deviations.
                    if without not in seen:
                        seen[without] = standardised(block, without, mean, deviation)
                    z, y = seen[without]
                    w = np.where(y == 1, of_1, of_0)
                    margin = now @ z
                    p = np.exp(-np.logaddexp(0, -margin))
                    loss = (w * (np.logaddexp(0, margin) - y * margin)).sum()
                    matrix = (z * (w * p * (1 - p))) @ z.T
                    out += [[loss], z @ (w * (p - y)), matrix[upper]]
                return np.concatenate(out)

            sums = _summed(blocks, at, size * len(asked)).reshape(len(asked), size)
            for f, found in zip([f for f in fits if f.open], sums, strict=True):
                matrix = np.zeros((width + 1, width + 1))
                matrix[upper] = found[width + 2 :]
                matrix = matrix + np.triu(matrix, 1).T
                f.take(found[0], found[1 : width + 2], matrix)
    return [f.model() for f in fits]
