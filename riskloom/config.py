"""Column names, fixed values, thresholds and checked settings."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class TxnColumns:
    """Where an operator finds each role in a transaction frame."""

    step: str = "step"
    kind: str = "type"
    amount: str = "amount"
    sender: str = "nameOrig"
    receiver: str = "nameDest"
    label: str = "isFraud"
    key: str = "event_id"


TXN = TxnColumns()

# Names and order of the raw and feature tables.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("step", T.IntegerType()),
        T.StructField("type", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("nameOrig", T.StringType()),
        T.StructField("nameDest", T.StringType()),
        T.StructField("isFraud", T.IntegerType()),
    ]
)
ENCODED_TYPES = ("TRANSFER", "CASH_OUT")
NUMERIC_FEATURES = (
    "log_amount",
    "amount_is_zero",
    "hour_of_day",
    "simulation_day",
    "orig_is_customer",
    "dest_is_customer",
    "dest_is_merchant",
    "log_orig_txn_count",
    "log_dest_txn_count",
)
TYPE_FLAGS = tuple(f"type_{value}" for value in ENCODED_TYPES)
FEATURES = NUMERIC_FEATURES + TYPE_FLAGS
FEATURE_TABLE = (*NUMERIC_FEATURES, TXN.label, *TYPE_FLAGS)
NON_FEATURES = ("isFraud", "txn_id", "ingest_ts", "batch_id")
HASH_SEPARATOR = "||"
TABLE_LEVEL_ROW = ":table"

# Split, gate, drift and report thresholds.
TRAIN_SHARE_OF_STEPS = 0.80
GATE_AVG_PRECISION = 0.50
GATE_PRECISION_AT_80RECALL = 0.04
DRIFT_STATISTIC = 0.2
DRIFT_PVALUE = 0.05
OPERATING_RECALLS = (0.5, 0.6, 0.7, 0.8, 0.9)
DRIFT_SAMPLE_ROWS = 20000
DRIFT_AMOUNT_FACTOR = 3

# How the winner may be chosen, and the metric each choice reads.
SELECTION_KEYS = {
    "avg_precision": "val_avg_precision",
    "precision_at_80recall": "val_precision_at_80recall",
    "precision_at_target_recall": "val_precision_at_target_recall",
}

# The search grids.
PARAM_GRIDS = {
    "random_forest": {
        "n_estimators": [200, 300],
        "max_depth": [16, 24, None],
        "min_samples_leaf": [1, 3],
        "class_weight": [None, "balanced_subsample", {0: 1, 1: 20}],
    },
    "hist_gradient_boosting": {
        "max_iter": [200, 400],
        "learning_rate": [0.05, 0.1],
        "max_depth": [6, 8],
        "min_samples_leaf": [20, 100],
        "class_weight": [None, {0: 1, 1: 20}],
    },
    "logistic_regression": {
        "max_iter": [1000],
        "C": [0.1, 1.0, 10.0],
        "class_weight": [None, "balanced"],
    },
}


def grids_from(path: str) -> dict[str, dict[str, list]]:
    """Search grids from a JSON file of the shape of ``PARAM_GRIDS``; classes of weights may be strings there."""

    def value(v):
        return {int(c): float(w) for c, w in v.items()} if isinstance(v, dict) else v

    with open(path, encoding="utf-8") as file:
        grids = json.load(file)
    return {name: {p: [value(v) for v in values] for p, values in grid.items()} for name, grid in grids.items()}


@dataclass(frozen=True)
class TrainingSettings:
    """Settings of a training run; a bad value fails before any plan is built."""

    target_recall: float = 0.60
    selection_metric: str = "avg_precision"
    val_fraction: float = 0.12
    search_neg_per_pos: int = 40
    search_n_iter: int = 8
    search_folds: int = 3
    max_alerts_per_fraud: float = 100.0
    seed: int = 42
    features: tuple[str, ...] = field(default=FEATURES)

    def __post_init__(self):
        if not 0.0 < self.target_recall < 1.0:
            raise ValueError(f"target_recall={self.target_recall} is outside (0, 1)")
        if self.selection_metric not in SELECTION_KEYS:
            raise ValueError(f"selection_metric={self.selection_metric!r} is not among {sorted(SELECTION_KEYS)}")
        if not 0.0 < self.val_fraction < 0.5:
            raise ValueError(f"val_fraction={self.val_fraction} is outside (0, 0.5)")
