"""Feature importances of fitted models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import ceil

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from stratline.models.training import Fitted, score, standard_coefficients
from stratline.operators import metrics
from stratline.settings import Settings

SCHEMA = "model string, kind string, feature string, importance double, std double"

# Rows that exchange values with each other in one block of a permutation.
BLOCK_ROWS = 100_000


def _rank(df: DataFrame, top: int, signed: bool) -> DataFrame:
    size = F.abs("importance") if signed else F.col("importance")
    order = Window.partitionBy("model").orderBy(size.desc(), "feature")
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def built_in_importances(models: Mapping[str, Fitted], top: int = 20) -> DataFrame | None:
    """Tree importances by size and linear coefficients by absolute size, the `top` of each.

    None when no model has either. One short row per model and feature.
    """
    trees, lines = [], []
    spark = SparkSession.active()
    for name, fitted in models.items():
        names = fitted.model.stages[0].getInputCols()
        coefficients = standard_coefficients(fitted)
        if coefficients is not None:
            lines += [(name, "coefficient", c, v, None) for c, v in coefficients.items()]
        elif hasattr(fitted.last, "featureImportances"):
            values = fitted.last.featureImportances.toArray()
            trees += [(name, "tree", c, float(v), None) for c, v in zip(names, values)]
    parts = [
        _rank(spark.createDataFrame(rows, SCHEMA), top, signed)
        for rows, signed in ((trees, False), (lines, True))
        if rows
    ]
    if not parts:
        return None
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def permuted_vectors(
    rows: DataFrame, keys: Sequence[str], repeats: int, seed: int, n_rows: int
) -> DataFrame:
    """Each row once per repeat, with the features of another row as `donor`.

    Rows are put in the order of a hash of their key and the repeat, which is as good as
    random, and each takes the features of the next. The hash range is cut into blocks of
    equal width, and the last row of a block takes from its first: every block is permuted
    within itself, of bounded size whatever the data, and every row gives exactly once.
    """
    blocks = max(1, ceil(n_rows / BLOCK_ROWS))
    copies = rows.withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    draw = F.xxhash64(F.lit(seed), "repeat", *[F.col(k) for k in keys])
    copies = copies.withColumn("__draw", draw).withColumn("__block", F.pmod("__draw", F.lit(blocks)))
    block = Window.partitionBy("repeat", "__block")
    order = block.orderBy("__draw", *keys)
    donor = F.coalesce(F.lead("vector").over(order), F.first("vector").over(order))
    return copies.withColumn("donor", donor).drop("__draw", "__block")


def permutation_importances(
    models: Mapping[str, Fitted],
    df: DataFrame,
    label: str,
    keys: Sequence[str],
    track: str = "regression",
    repeats: int = 10,
    top: int = 20,
    seed: int = 42,
) -> DataFrame:
    """Mean and standard deviation of the score lost when one feature is permuted.

    The score is r2 or f1 of class 1. `keys` identify a row. Rows are shuffled once per
    repeat; the copies with one feature replaced are made after that shuffle, and scores
    are partial sums, so nothing larger than the rows times the repeats moves.
    """
    features = next(iter(models.values())).model.stages[0].getInputCols()
    rows = df.where(F.col(label).isNotNull())
    vector = F.array(*[F.col(f"`{c}`").cast("double") for c in features])
    rows = rows.select(*keys, F.col(label).cast("double").alias("y"), vector.alias("vector"))
    permuted = permuted_vectors(rows, keys, repeats, seed, rows.count())
    which = F.explode(F.sequence(F.lit(0), F.lit(len(features) - 1)))
    cells = permuted.select("y", "repeat", "vector", "donor", which.alias("f"))
    mixed = F.transform(
        "vector", lambda v, i: F.when(i == F.col("f"), F.get("donor", i)).otherwise(v)
    )
    base = rows.select("y", F.lit(-1).alias("f"), F.lit(0).alias("repeat"), F.col("vector").alias("v"))
    cells = cells.select("y", "f", "repeat", mixed.alias("v")).unionByName(base)
    pred = score_vectors(cells, models)
    by = ["model", "f", "repeat"]
    if track == "regression":
        scores = metrics.regression(pred, by).select(*by, F.col("r2").alias("s"))
    else:
        scores = metrics.classification(pred, by).select(*by, F.col("f1").alias("s"))
    whole = F.max(F.when(F.col("f") == -1, F.col("s"))).over(Window.partitionBy("model"))
    lost = scores.withColumn("lost", whole - F.col("s")).where(F.col("f") >= 0)
    names = F.array(*[F.lit(c) for c in features])
    return _rank(
        lost.groupBy("model", F.get(names, F.col("f")).alias("feature")).agg(
            F.avg("lost").alias("importance"), F.stddev_pop("lost").alias("std")
        ),
        top,
        signed=False,
    ).select("model", F.lit("permutation").alias("kind"), "feature", "importance", "std", "rank")


def score_vectors(cells: DataFrame, models: Mapping[str, Fitted]) -> DataFrame:
    """score() for rows whose features come as one array column v."""
    names = next(iter(models.values())).model.stages[0].getInputCols()
    wide = cells.select("f", "repeat", "y", *[F.get("v", F.lit(i)).alias(c) for i, c in enumerate(names)])
    return score(wide, models, "y", keep=["f", "repeat"])


def importances(
    models: Mapping[str, Fitted],
    df: DataFrame,
    label: str,
    keys: Sequence[str],
    track: str,
    settings: Settings = Settings(),
) -> DataFrame:
    """Long table (track, model, kind, feature, importance, std, rank).

    Built-in importances and coefficients are the primary ones; permutation importances
    are added as a kind of their own.
    """
    out = built_in_importances(models, settings.top_n_features)
    if settings.run_permutation or out is None:
        extra = permutation_importances(
            models, df, label, keys, track, settings.permutation_repeats,
            settings.top_n_features, settings.random_state,
        )
        out = extra if out is None else out.unionByName(extra)
    return out.withColumn("track", F.lit(track))

