"""Metrics of fitted models, and cross-validation by group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from stratline.models.training import (
    Fitted,
    boost,
    fit_classifiers,
    fit_linear,
    fit_regressors,
    score,
    training_facts,
)
from stratline.operators import metrics
from stratline.operators.encode import Cut, no_cut
from stratline.operators.ordering import attach, hold_small, running_totals
from stratline.settings import Settings


def regression_metrics(pred: DataFrame, by: Sequence[str] = ("model", "split")) -> DataFrame:
    """Long (by, metric, value): mae, mse, rmse, r2."""
    return metrics.to_long(metrics.regression(pred, by), by, metrics.REGRESSION)


def classification_metrics(pred: DataFrame, by: Sequence[str] = ("model", "split")) -> DataFrame:
    """Long (by, metric, value): accuracy, precision, recall, f1, roc_auc."""
    counted = metrics.to_long(metrics.classification(pred, by), by, metrics.CLASSIFICATION)
    area = metrics.to_long(metrics.roc_auc(pred, by, few_groups=True), by, ["roc_auc"])
    return counted.unionByName(area)


def evaluate(
    models: Mapping[str, Fitted],
    df: DataFrame,
    label: str,
    split: Column,
    track: str,
    cut: Cut = no_cut,
) -> DataFrame:
    """Long metrics of all models on the rows whose split is val or test.

    Ranking scores reads the predictions several times, so a job cuts there.
    """
    rows = df.withColumn("split", split).where(F.col("split").isin("val", "test"))
    pred = score(rows, models, label, keep=["split"])
    if track == "regression":
        out = regression_metrics(pred)
    else:
        out = classification_metrics(cut(pred, f"predictions_{track}"))
    return out.select(F.lit(track).alias("track"), "model", "split", "metric", "value")


# --- folds by group ---------------------------------------------------------------------


def fold_plan(sizes: Sequence[tuple[int, int]], k: int) -> list[tuple[int, int, int, list[int]]]:
    """Where groups go when, from the largest down, each joins the lightest fold.

    `sizes` are (group size, number of such groups). Groups of one size are handled
    together: folds take turns in a fixed cycle until the next lightest fold joins in. A
    result (size, first, end, cycle) says that the groups ranked first..end-1 of a size go
    to the folds of the cycle in turn.
    """
    loads = [0] * k
    plan = []
    for size, groups in sorted(sizes, reverse=True):
        at = 0
        while at < groups:
            order = sorted(range(k), key=lambda f: (loads[f], f))
            # Folds that get a group before the lightest one is due for its second.
            cycle = [f for f in order if (loads[f], f) < (loads[order[0]] + size, order[0])]
            outside = [f for f in order if f not in cycle]
            rounds = (groups - at) // len(cycle)
            if outside and rounds > 1:
                # Whole rounds that end before the nearest outside fold is reached.
                rounds = min(rounds, max(1, (loads[outside[0]] - loads[cycle[-1]]) // size))
            taken = max(rounds, 1) * len(cycle)
            taken = min(taken, groups - at)
            plan.append((size, at, at + taken, cycle))
            for i in range(taken) if taken < len(cycle) else range(len(cycle)):
                loads[cycle[i]] += size * (taken // len(cycle) if taken >= len(cycle) else 1)
            at += taken
    return plan


def group_folds(df: DataFrame, group: str, k: int = 5) -> DataFrame:
    """(group, fold): folds 1..k balanced by rows, ties between groups broken by name.

    The driver sees only how many groups there are of each size.
    """
    known = df.where(F.col(group).isNotNull())
    counts = known.groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    sizes = counts.groupBy("n").agg(F.count(F.lit(1)).alias("groups")).collect()
    plan = fold_plan([(r["n"], r["groups"]) for r in sizes], k)
    table = df.sparkSession.createDataFrame(plan, "n long, first long, end long, cycle array<int>")
    ranked = running_totals(counts.withColumn("one", F.lit(1)), group, ["one"], by=["n"])
    place = F.col("one_before")
    inside = (place >= F.col("first")) & (place < F.col("end"))
    turn = ((place - F.col("first")) % F.size("cycle")).cast("int")
    return (
        ranked.join(table, "n").where(inside).select(group, (F.get("cycle", turn) + 1).alias("fold"))
    )


def group_cv(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    group: str = "LocationDesc",
    track: str = "regression",
    settings: Settings = Settings(),
) -> tuple[DataFrame, DataFrame]:
    """Cross-validation in which a group is never split: (fold metrics, mean per model)."""
    rows = df.where(F.col(target).isNotNull())
    folds = hold_small(group_folds(rows, group, settings.cv_folds))
    rows = attach(rows, folds, [group]).persist()
    kind = "regressors" if track == "regression" else "classifiers"
    fit = fit_regressors if track == "regression" else fit_classifiers
    configs = getattr(settings, kind)
    scored = []
    try:
        numbers = range(1, settings.cv_folds + 1)
        facts = training_facts(rows, features, target)
        # Linear models of all folds come from the same passes, ensembles grow in step.
        together = fit_linear(rows, features, target, configs, track, facts, "fold", numbers)
        together |= boost(rows, features, target, configs, settings, track, facts, "fold", numbers)
        names = {n for n, _ in together}
        others = replace(settings, **{kind: {n: c for n, c in configs.items() if n not in names}})
        for fold in numbers:
            models = {n: m for (n, k), m in together.items() if k == fold}
            if getattr(others, kind):
                models |= fit(rows.where(F.col("fold") != fold), features, target, others)
            scored.append(score(rows.where(F.col("fold") == fold), models, target, keep=["fold"]))
        pred = reduce(DataFrame.unionByName, scored)
        by = ["model", "fold"]
        if track == "regression":
            out = metrics.to_long(metrics.regression(pred, by), by, ["mae", "r2"])
        else:
            f1 = metrics.classification(pred, by).select(*by, F.col("weighted_f1").alias("f1"))
            auc = metrics.roc_auc(pred, by, one_class=0.5, few_groups=True)
            auc = auc.withColumnRenamed("roc_auc", "auc")
            out = metrics.to_long(f1, by, ["f1"]).unionByName(metrics.to_long(auc, by, ["auc"]))
        # A few numbers per fold and model: fetched here, before the rows are released.
        found = out.collect()
    finally:
        rows.unpersist()
    folds = df.sparkSession.createDataFrame(
        found, "model string, fold int, metric string, value double"
    )
    return folds, folds.groupBy("model", "metric").agg(F.avg("value").alias("mean"))
