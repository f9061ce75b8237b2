"""Labels with a train-only threshold, temporal splits, feature-target join."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stratline.operators.ordering import next_in_order, quantiles
from stratline.operators.rows import keep_first
from stratline.settings import Settings

log = logging.getLogger(__name__)

TARGET_COLUMNS = [
    "YearStart",
    "LocationAbbr",
    "LocationDesc",
    "stratum_category",
    "stratum_value",
    "Data_Value",
]


@dataclass(frozen=True)
class TargetMetadata:
    high_risk_threshold: float
    high_risk_percentile: float
    early_warning_built: bool
    n_total_rows: int
    n_high_risk: int

    def as_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([asdict(self)])


def threshold(
    df: DataFrame,
    percentile: float = 75,
    train: Column | None = None,
    value: str = "Data_Value",
) -> DataFrame:
    """One row `high_risk_threshold`: the exact percentile of the training values."""
    rows = df.where(train) if train is not None else df
    return quantiles(rows, value, {"high_risk_threshold": percentile / 100}).select(
        "high_risk_threshold"
    )


def flag_high_risk(
    df: DataFrame, limit: Column, value: str = "Data_Value", name: str = "high_risk_obesity"
) -> DataFrame:
    """1 where the value reaches the limit, else 0; a missing value counts as 0."""
    return df.withColumn(name, F.coalesce(F.col(value) >= limit, F.lit(False)).cast("int"))


def early_warning(
    df: DataFrame,
    unit: Sequence[str],
    flag: str = "high_risk_obesity",
    name: str = "early_warning",
    year: str = "YearStart",
    tie: Sequence[str] = (),
    unique: bool = False,
) -> DataFrame:
    """Whether a unit that is not high-risk now is so in its next observed row.

    NULL for rows that are high-risk now, have no next row, or miss a key part. The next
    row is the next one observed, which need not be the following calendar year. Copies of a
    (unit, year) come in the order of `tie`, then of a hash of the row; the hash also cuts a
    hot (unit, year) into slices, whatever its other columns hold.
    """
    order = [year, *[c for c in tie if c != year]]
    if not unique:
        rest = [c for c in df.columns if c not in (*order, *unit, flag)] + [flag]
        df = df.withColumn("__hash", F.xxhash64(*[F.col(f"`{c}`") for c in rest]))
        order += ["__hash", *rest]
    out = next_in_order(df, unit, order, flag, "__next", unique)
    out = out.drop("__hash")
    keyed = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in unit])
    label = F.when(keyed & (F.col(flag) == 0) & F.col("__next").isNotNull(), F.col("__next"))
    return out.withColumn(name, label.cast("int")).drop("__next")


def label_counts(df: DataFrame, label: str) -> DataFrame:
    """One row: labelled rows, positives, negatives, imbalance ratio and share positive."""
    col = F.col(label)
    return df.agg(
        F.count(col).alias("n_labelled"),
        F.count_if(col == 1).alias("n_positive"),
        F.count_if(col == 0).alias("n_negative"),
        (F.count_if(col == 0) / F.greatest(F.count_if(col == 1), F.lit(1))).alias(
            "imbalance_ratio"
        ),
        F.try_divide(F.count_if(col == 1) * F.lit(100.0), F.count(col)).alias("pct_positive"),
    )


def build(
    df: DataFrame,
    train: Column | None = None,
    settings: Settings = Settings(),
    unique: bool = False,
) -> tuple[DataFrame, TargetMetadata]:
    """Target columns on the cleaned panel, and what is needed to choose among them.

    Two small actions run here: the threshold and the label counts. The early-warning
    column is kept only when enough rows carry a label.
    """
    if "Data_Value" not in df.columns:
        raise ValueError("'Data_Value' column not found")
    if train is None:
        log.warning("no training condition: the threshold sees every row")
    limit = threshold(df, settings.high_risk_percentile, train).first()
    limit = limit["high_risk_threshold"] if limit else None
    flag, label = settings.high_risk_col, settings.early_warning_col
    out = flag_high_risk(df, F.lit(limit).cast("double"), name=flag)
    unit = [k for k in settings.unit_key if k in df.columns]
    if unit:
        out = early_warning(out, unit, flag, label, unique=unique)
    counts = out.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(flag), F.lit(0)).alias("high"),
        (F.count(label) if unit else F.lit(0)).alias("pairs"),
    ).first()
    built = bool(unit) and counts["pairs"] >= settings.early_warning_min_pairs
    if unit and not built:
        log.warning(
            "%d early-warning pairs, %d needed", counts["pairs"], settings.early_warning_min_pairs
        )
        out = out.drop(label)
    metadata = TargetMetadata(
        limit, settings.high_risk_percentile, built, counts["rows"], counts["high"]
    )
    return out, metadata


def target_table(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    names = [*TARGET_COLUMNS, settings.high_risk_col, settings.early_warning_col]
    return df.select(*[c for c in names if c in df.columns])


def choose(metadata: TargetMetadata, settings: Settings = Settings()) -> str:
    """Classification target: the forced one if it exists, else early warning if feasible."""
    if settings.classification_target == settings.high_risk_col:
        return settings.high_risk_col
    if metadata.early_warning_built:
        return settings.early_warning_col
    if settings.classification_target == settings.early_warning_col:
        log.warning("early warning was not built, falling back to %s", settings.high_risk_col)
    return settings.high_risk_col


def join_targets(
    features: DataFrame,
    targets: DataFrame,
    keys: Sequence[str] = ("YearStart", "LocationAbbr", "stratum_category", "stratum_value"),
    source: Sequence[str] = ("StratificationCategory1", "Stratification1"),
) -> DataFrame:
    """Inner join of features and targets, one row per key.

    Both sides are reduced to one row per key before the join, so copies of a key never
    multiply. Units whose rare strata were collapsed share a key: `source` names the columns
    that tell them apart, and both sides keep the row of the same, smallest, unit. They must
    be on both sides, or on neither if a key belongs to one unit. NULL key parts match each
    other.
    """
    keys = [k for k in keys if k in features.columns and k in targets.columns]
    order = [c for c in source if c in features.columns and c in targets.columns]
    one_sided = [c for c in source if (c in features.columns) != (c in targets.columns)]
    if one_sided:
        raise ValueError(f"source columns on one side only: {one_sided}")
    left, right = keep_first(features, keys, order), keep_first(targets, keys, order)
    right = right.select(
        *[F.col(k).alias(f"__{k}") for k in keys],
        *[c for c in right.columns if c not in features.columns],
    )
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return left.join(right, on, "inner").drop(*[f"__{k}" for k in keys])


def split_name(year: Column, settings: Settings = Settings()) -> Column:
    """train / val / test by year; NULL in a gap between the bounds or without a year."""
    return (
        F.when(year <= settings.train_max_year, "train")
        .when((year >= settings.val_min_year) & (year <= settings.val_max_year), "val")
        .when(year >= settings.test_min_year, "test")
    )


def sequence_split_name(year: Column, settings: Settings = Settings()) -> Column:
    """Split of a sequence by its target year; the three parts leave no gap."""
    return (
        F.when(year <= settings.train_max_year, "train")
        .when(year <= settings.val_max_year, "val")
        .when(year > settings.val_max_year, "test")
    )


def temporal_split(
    df: DataFrame, settings: Settings = Settings(), year: str = "YearStart"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Train, validation and test rows as three lazy filters; warns when test is empty."""
    y = F.col(year)
    train = df.where(y <= settings.train_max_year)
    val = df.where((y >= settings.val_min_year) & (y <= settings.val_max_year))
    test = df.where(y >= settings.test_min_year)
    if test.isEmpty():
        log.warning("test split is empty: no rows from %d on", settings.test_min_year)
    return train, val, test


