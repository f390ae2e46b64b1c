"""Training: class weights, fits, search, refit and thresholded models, all as Spark ML models."""

from __future__ import annotations

import random
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import product
from statistics import fmean

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Model, PipelineModel, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasPredictionCol, HasProbabilityCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.config import FEATURES, TXN
from riskloom.operators.boosting import fit_boosting
from riskloom.operators.curve import average_precision, pr_curve
from riskloom.operators.forest import each_forest, fit_forest
from riskloom.operators.linear import fit_linear
from riskloom.session import TemporaryTables

WEIGHT = "weight"


def class_counts(df: DataFrame, label: str = TXN.label, by: str | None = None) -> dict:
    """Rows per class (per ``by`` value, if given). Two classes are all there may be."""
    rows = df.groupBy(*([by] if by else []), label).agg(F.count(F.lit(1)).alias("n"))
    odd = rows.filter(F.col(label).isNull() | ~F.col(label).isin(0, 1)).select(label).head()
    if odd is not None:
        raise ValueError(f"a label other than 0 and 1: {odd[0]}")
    return {((r[by], r[label]) if by else r[label]): r["n"] for r in rows.collect()}


def weight_per_class(counts: Mapping[int, int], mode: str | Mapping[int, float] | None) -> dict[int, float]:
    """The weight of each class's rows. 'balanced' gives every class the same total weight.

    Weights are taken over the whole frame. A forest replaces those of 'balanced_subsample' by each tree's own.
    """
    if mode is None:
        return dict.fromkeys(counts, 1.0)
    if isinstance(mode, Mapping):
        return {c: float(mode.get(c, 1.0)) for c in counts}
    if mode not in ("balanced", "balanced_subsample"):
        raise ValueError(f"unknown class weight {mode!r}")
    share = sum(counts.values()) / max(1, len(counts))
    return {c: share / n for c, n in counts.items()}


def class_weights(df: DataFrame, mode: str | Mapping[int, float] | None, label: str = TXN.label) -> DataFrame:
    """Rows and weight per class, as the fits use them."""
    counts = class_counts(df, label)
    weights = weight_per_class(counts, mode)
    kind = df.schema[label].dataType.simpleString()
    rows = [(c, n, weights[c]) for c, n in counts.items()]
    return df.sparkSession.createDataFrame(rows, f"`{label}` {kind}, row_count bigint, {WEIGHT} double")


def positive_probability(probability: str = "probability") -> Column:
    return vector_to_array(F.col(probability))[1]


class AtThreshold(
    Transformer, HasProbabilityCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable
):
    """Prediction 1 where the positive probability is at least the threshold, else 0."""

    threshold = Param(Params._dummy(), "threshold", "lowest flagged probability", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, threshold: float = 0.5, probabilityCol: str = "probability", predictionCol: str = "prediction"):
        super().__init__()
        self._setDefault(threshold=0.5)
        self._set(threshold=threshold, probabilityCol=probabilityCol, predictionCol=predictionCol)

    def getThreshold(self) -> float:
        return self.getOrDefault(self.threshold)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        flagged = positive_probability(self.getProbabilityCol()) >= self.getThreshold()
        return dataset.withColumn(self.getPredictionCol(), flagged.cast("int"))


def with_threshold(model: Model, threshold: float) -> PipelineModel:
    """The model followed by its decision, as one savable pipeline model."""
    return PipelineModel([model, AtThreshold(threshold=threshold)])


#: Fits that take all settings and folds in the same passes over the rows.
TOGETHER = {"logistic_regression": fit_linear, "hist_gradient_boosting": fit_boosting, "random_forest": fit_forest}
ALGORITHMS = tuple(TOGETHER)
#: Those whose models grow with the rows: a search asks for one after the other, and the driver holds one at a time.
ONE_BY_ONE = {"random_forest": each_forest}


def known_algorithms(grids: Mapping[str, Mapping]) -> tuple[list[str], list[str]]:
    """Configured algorithms that can run, and those that are ignored. None at all is an error."""
    known = [name for name in grids if name in ALGORITHMS]
    if not known:
        raise ValueError("no known algorithm is configured")
    return known, [name for name in grids if name not in ALGORITHMS]


def draw_settings(grid: Mapping[str, Sequence], limit: int, seed: int = 42) -> list[dict]:
    """Up to ``limit`` different settings of the grid, drawn without replacement."""
    every = [dict(zip(grid, values, strict=True)) for values in product(*grid.values())]
    return random.Random(seed).sample(every, min(limit, len(every)))


def assembled(df: DataFrame, features: Sequence[str] = FEATURES, label: str = TXN.label, keep: Sequence[str] = ()):
    """Label and feature vector, the narrow frame that estimators read again and again."""
    vector = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")
    return vector.transform(df.select(label, *keep, *features)).select(label, *keep, "features")


def fit_assembled(
    rows: DataFrame,
    algorithm: str,
    params: Mapping,
    label: str = TXN.label,
    seed: int = 42,
    counts: Mapping[int, int] | None = None,
) -> PipelineModel:
    """Fit one setting on an assembled frame; ``counts`` are its rows per class, where known."""
    if counts is None:
        counts = class_counts(rows, label)
    weights = weight_per_class(counts, params["class_weight"])
    return PipelineModel(TOGETHER[algorithm](rows, [(params, weights, None)], label, seed))


def fit(
    train: DataFrame,
    algorithm: str,
    params: Mapping,
    features: Sequence[str] = FEATURES,
    label: str = TXN.label,
    seed: int = 42,
) -> PipelineModel:
    """Fit one setting on a feature table; the result scores feature tables directly."""
    rows = assembled(train, features, label).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fitted = fit_assembled(rows, algorithm, params, label, seed)
    finally:
        rows.unpersist()
    vector = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")
    return PipelineModel([vector, fitted])


def held_out_scores(
    rows: DataFrame, scorers: Sequence[tuple[int, int, Callable[[np.ndarray], np.ndarray]]], label: str = TXN.label
) -> DataFrame:
    """``label, setting, fold, score`` of each row by the models that were fitted without its fold, in one pass.

    ``scorers`` are (setting, fold, function of a matrix with a row a feature)."""
    narrow = rows.select(F.col(label).cast("int"), F.col("fold").cast("int"), vector_to_array("features").alias("x"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y, fold = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            x = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1).T
            for setting, of, scorer in scorers:
                here = fold == of
                n = int(here.sum())
                if n:
                    columns = [y[here], np.full(n, setting, np.int32), fold[here], scorer(x[:, here])]
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=[label, "setting", "fold", "score"])

    return narrow.mapInArrow(run, f"`{label}` int, setting int, fold int, score double")


@dataclass(frozen=True)
class SearchResult:
    params: dict
    score: float
    tried: list[tuple[dict, float]]


def search(
    sample: DataFrame,
    algorithm: str,
    settings: Sequence[Mapping],
    folds: int = 3,
    features: Sequence[str] = FEATURES,
    label: str = TXN.label,
    seed: int = 42,
) -> SearchResult:
    """The setting with the best mean average precision over the folds in column ``fold``.

    The sample is assembled once and kept. All settings on all folds are fitted in the same passes. All held-out folds
    are then measured in one job, as groups of one curve. Forests are as large as the sample, so each is fitted, scores its
    held-out fold into a table, and goes. Equal scores go to the setting listed first.
    """
    rows = assembled(sample, features, label, keep=["fold"]).persist(StorageLevel.MEMORY_AND_DISK)
    tasks = [(i, fold) for i in range(len(settings)) for fold in range(folds)]
    by = ["setting", "fold"]
    try:
        per_fold = class_counts(rows, label, "fold")
        short = [fold for fold in range(folds) if not per_fold.get((fold, 1))]
        if short:
            raise ValueError(f"folds without a positive row cannot be measured: {short}")

        def counts_without(fold: int) -> dict[int, int]:
            counts: dict[int, int] = {}
            for (other, c), n in per_fold.items():
                if other != fold:
                    counts[c] = counts.get(c, 0) + n
            return counts

        weights = [weight_per_class(counts_without(fold), settings[i]["class_weight"]) for i, fold in tasks]
        every = [(settings[i], w, fold) for (i, fold), w in zip(tasks, weights, strict=True)]
        with TemporaryTables(rows.sparkSession) as tables:
            if algorithm in ONE_BY_ONE:
                parts, turns = [], iter(tasks)
                # Nothing refers to a forest beyond its turn (enumerate and zip would), so it is gone while the next one grows.
                for scorer in ONE_BY_ONE[algorithm](rows, every, label, seed):
                    i, fold = next(turns)
                    parts.append(tables.stored(held_out_scores(rows.filter(F.col("fold") == fold), [(i, fold, scorer)], label)))
                    del scorer
                scored = reduce(DataFrame.unionByName, parts)
            else:
                models = TOGETHER[algorithm](rows, every, label, seed)
                scorers = [(i, fold, m.scorer()) for (i, fold), m in zip(tasks, models, strict=True)]
                # The curve reads them more than once.
                scored = tables.stored(held_out_scores(rows, scorers, label))
            curves = pr_curve(scored, "score", label, by)
            found = {(r["setting"], r["fold"]): r["average_precision"] for r in average_precision(curves, by).collect()}
    finally:
        rows.unpersist()
    means = [fmean(found[i, fold] for fold in range(folds)) for i in range(len(settings))]
    best = max(range(len(settings)), key=lambda i: means[i])
    return SearchResult(dict(settings[best]), means[best], [(dict(p), m) for p, m in zip(settings, means, strict=True)])
