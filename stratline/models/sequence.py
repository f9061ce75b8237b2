"""Forecasting a unit's next observed value from its last observations.

The windows and their split are the inputs of a recurrent network; here they are
flattened and fitted with a linear and a boosted Spark ML model.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from stratline.models.evaluation import regression_metrics
from stratline.models.training import Fitted, fit_regressors, score
from stratline.operators import panel, targets
from stratline.operators.encode import Cut, no_cut
from stratline.settings import Settings


def flatten(windows: DataFrame, length: int, n_features: int) -> tuple[DataFrame, list[str]]:
    """One column per step and feature: x_<step>_<feature>."""
    names = {f"x_{t}_{i}": F.col("features")[t][i] for t in range(length) for i in range(n_features)}
    return windows.withColumns(names).drop("features"), list(names)


def forecast(
    df: DataFrame,
    feature_names: Sequence[str],
    target: str = "Data_Value",
    settings: Settings = Settings(),
    unit: Sequence[str] = ("LocationDesc", "stratum_category", "stratum_value"),
    regressors: dict | None = None,
    cut: Cut = no_cut,
) -> tuple[dict[str, Fitted], DataFrame]:
    """Models fitted on training windows, and predictions with a split for all windows."""
    windows = panel.sequences(df, feature_names, target, settings.seq_length, unit)
    flat, names = flatten(windows, settings.seq_length, len(feature_names))
    flat = flat.where(F.col("target").isNotNull())
    flat = flat.withColumn("split", targets.sequence_split_name(F.col("target_year"), settings))
    flat = cut(flat, "windows")
    chosen = regressors or {"ridge": {"alpha": 1.0}}
    train = flat.where(F.col("split") == "train")
    models = fit_regressors(train, names, "target", Settings(regressors=chosen))
    return models, score(flat, models, "target", keep=[*unit, "target_year", "split"])


def evaluate(predictions: DataFrame) -> DataFrame:
    """mae, mse, rmse and r2 per model and split."""
    return regression_metrics(predictions.where(F.col("split") != "train"))
