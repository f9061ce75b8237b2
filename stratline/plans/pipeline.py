"""The whole job: raw extract to models, metrics and importances."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from stratline.models import evaluation, explain, sequence
from stratline.models.training import Fitted, fit_classifiers, fit_regressors
from stratline.operators import encode, panel, quality, rows, stats, targets
from stratline.operators.encode import Cut
from stratline.operators.targets import TargetMetadata
from stratline.settings import Settings
from stratline.sources import ingest, sinks

log = logging.getLogger(__name__)

KEYS = ["YearStart", "LocationAbbr", "stratum_category", "stratum_value"]


@dataclass
class ModelTable:
    """One row per key with features and targets, and what was learned on the way."""

    table: DataFrame
    feature_names: list[str]
    target: str
    metadata: TargetMetadata


@dataclass
class Result:
    interim: DataFrame
    quality: DataFrame
    model: ModelTable
    fitted: dict[str, dict[str, Fitted]] = field(default_factory=dict)
    metrics: DataFrame | None = None
    importances: DataFrame | None = None
    cross_validation: dict[str, DataFrame] = field(default_factory=dict)
    sequence_metrics: DataFrame | None = None


def clean_stage(raw: DataFrame, settings: Settings, cut: Cut) -> DataFrame:
    return cut(encode.clean(raw, settings, cut), "interim")


def model_table(clean: DataFrame, settings: Settings, cut: Cut) -> ModelTable:
    """Features and targets as columns of the same rows, so that nothing has to be joined.

    Medians and scales are fitted on every cleaned row (or on training rows, by setting);
    after that one row per key is kept, and rows without a year are left out.
    """
    unit = [k for k in settings.unit_key if k in clean.columns]
    unique = bool(unit) and panel.is_unique(clean, [*unit, "YearStart"])
    train = F.col("YearStart") <= settings.train_max_year
    fit_rows = clean.where(train) if settings.fit_on == "train" else clean

    labelled, metadata = targets.build(clean, train, settings, unique)
    wide = panel.year_scale(panel.ci_width(labelled), fit_rows)
    wide = panel.lag_features(wide, settings, unique)
    goals = [
        c
        for c in ("Data_Value", settings.high_risk_col, settings.early_warning_col)
        if c in wide.columns
    ]
    names = [c for c in panel.FEATURES if c in wide.columns and c not in panel.IDENTIFIERS]
    wide = wide.select(
        *[c for c in [*KEYS, "LocationDesc"] if c in wide.columns], *names, *goals
    )
    wide = cut(wide.where(F.col("YearStart").isNotNull()), "panel")
    medians = panel.fit_medians(wide.where(train) if settings.fit_on == "train" else wide, names)
    empty = [c for c in names if c not in medians]
    if empty:
        log.warning("features without any value, not used: %s", empty)
    filled = panel.fill(wide.drop(*empty), medians)
    keys = [k for k in KEYS if k in filled.columns]
    table = cut(rows.keep_first(filled, keys), "model_table")
    return ModelTable(
        table, [c for c in names if c in medians], targets.choose(metadata, settings), metadata
    )


def _track(name, model, settings, folder, cv, result, cut):
    label = "Data_Value" if name == "regression" else model.target
    if label not in model.table.columns:
        log.error("target %s was not built, %s skipped", label, name)
        return None, None
    train, val, _ = targets.temporal_split(model.table, settings)
    fit = fit_regressors if name == "regression" else fit_classifiers
    saved = f"{folder}/models" if folder and settings.save_models else None
    fitted = fit(train, model.feature_names, label, settings, saved)
    result.fitted[name] = fitted
    split = targets.split_name(F.col("YearStart"), settings)
    measured = evaluation.evaluate(fitted, model.table, label, split, name, cut)
    keys = [k for k in KEYS if k in model.table.columns]
    important = explain.importances(fitted, val, label, keys, name, settings)
    if cv:
        _, result.cross_validation[name] = evaluation.group_cv(
            model.table, model.feature_names, label, settings.cv_group_col, name, settings
        )
    return measured, important


def run(
    spark: SparkSession,
    source: str | DataFrame,
    folder: str | None = None,
    settings: Settings = Settings(),
    track: str = "both",
    cv: bool = False,
) -> Result:
    """Run every stage on a raw extract (a path or a table of text columns).

    With a folder, stage tables, metrics, importances and models are kept below it;
    otherwise stage tables go to the cluster's checkpoint folder.
    """
    if track not in ("regression", "classification", "both"):
        raise ValueError(f"unknown track: {track}")
    cut = sinks.table_cut(spark, f"{folder}/tables" if folder else None)
    raw = source
    if isinstance(source, str):
        raw = ingest.read_raw(spark, source, settings.keep_columns)
    raw = ingest.select_indicator(raw, settings.target_class, settings.target_question)
    raw = cut(raw, "indicator")
    if raw.isEmpty():
        raise ValueError(
            f"no rows with Class={settings.target_class!r} and Question={settings.target_question!r}"
        )
    report = cut(quality.check_raw(raw), "quality")
    quality.enforce(report)
    clean = clean_stage(raw, settings, cut)
    model = model_table(clean, settings, cut)
    result = Result(clean, report, model)

    measured, important = [], []
    for name in ("regression", "classification"):
        if track in (name, "both"):
            m, i = _track(name, model, settings, folder, cv, result, cut)
            measured += [m] if m is not None else []
            important += [i] if i is not None else []
    if measured:
        result.metrics = cut(reduce(DataFrame.unionByName, measured), "metrics")
        result.importances = cut(reduce(DataFrame.unionByName, important), "importances")
    if settings.run_sequences and track in ("regression", "both"):
        _, pred = sequence.forecast(
            model.table, model.feature_names, "Data_Value", settings, cut=cut
        )
        result.sequence_metrics = cut(sequence.evaluate(pred), "sequence_metrics")
    if folder and result.metrics is not None:
        sinks.write_metrics(result.metrics, f"{folder}/metrics")
    return result


def impact(spark: SparkSession, interim_path: str) -> dict[str, DataFrame]:
    """The hypothesis tests on a written interim table."""
    return stats.impact(ingest.read_table(spark, interim_path))
