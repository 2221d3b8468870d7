"""Reading-table schema and the engine's default parameters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

KEYS = ["variant", "unit_id"]
CYCLE = "cycle"

# Column names of a reading, the variants and splits that exist.
OPS = [f"op_setting_{i}" for i in range(1, 4)]
SENSORS = [f"sensor_{i}" for i in range(1, 22)]
VARIANTS = ["FD001", "FD002", "FD003", "FD004"]
SPLITS = ["train", "test"]
META = ["variant", "unit_id", "cycle", "rul", "label_within_x"]

# Default parameters.
WINDOWS = [10, 20, 30]
LAGS = [1, 3, 5]
SEQUENCE_WINDOW = 30
HORIZON = 30
TRAIN_RATIO = 0.8
SEED = 42
CENSORING_RATIO = 0.3
RISK_THRESHOLD = 0.5
MAX_RUL = 340.0
RUL_CAP = 125.0
ALPHA = 0.1
QUANTILE_LOW = 0.1
QUANTILE_HIGH = 0.9
STOCHASTIC_PASSES = 50

READING = T.StructType(
    [
        T.StructField("variant", T.StringType()),
        T.StructField("unit_id", T.LongType()),
        T.StructField("cycle", T.IntegerType()),
    ]
    + [T.StructField(c, T.DoubleType()) for c in OPS + SENSORS]
)


@dataclass(frozen=True)
class CostPolicy:
    """Costs of the three maintenance actions, in one currency."""

    # Default costs.
    replacement: float = 8000.0
    unplanned_failure: float = 50000.0
    inspection: float = 400.0
    false_alarm: float = 200.0


def feature_columns(columns: list[str]) -> list[str]:
    """Columns that are neither keys nor labels, in order."""
    return [c for c in columns if c not in META]


def sensor_columns(columns: list[str]) -> list[str]:
    return [c for c in columns if c.startswith("sensor_") and c[7:].isdigit()]


def shared_features(left: list[str], right: list[str]) -> list[str]:
    """Feature columns that two frames have in common, in the order of the first."""
    return [c for c in feature_columns(left) if c in right]
