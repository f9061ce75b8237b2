"""Fitting the configured regressors and classifiers.

Forests are Spark ML's; linear and boosted models come from sums over the rows, all models
and folds of a kind together. Penalties refer to features standardised with the population
standard deviation:

ridge     min |y - Xw|^2 + alpha |w|^2
lasso     min |y - Xw|^2 / 2n + alpha |w|_1
logistic  min sum w_i loss_i + |w|^2 / 2C
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import partial
from math import ceil
from multiprocessing.pool import ThreadPool

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, functions as F
from pyspark.util import inheritable_thread_target

from stratline.models import boosting, linear
from stratline.models.trees import Plan
from stratline.settings import Settings
from stratline.sources import sinks

log = logging.getLogger(__name__)

VECTOR, LABEL, WEIGHT = "__features", "__label", "__weight"
# The jobs that fit all boosted and all linear models.
BOOST, LINES = "__boost", "__lines"


ROWS_PER_TASK = 10_000


@dataclass(frozen=True)
class Facts:
    """What a fit needs to know about the training rows beforehand."""

    n_rows: int
    feature_sd: dict[str, float]


@dataclass(frozen=True)
class Fitted:
    name: str
    model: PipelineModel
    facts: Facts

    @property
    def last(self):
        return self.model.stages[-1]


def balanced_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Rows with weight n / (2 * rows of their class)."""
    counts = df.agg(
        F.count(label).alias("n"),
        F.count_if(F.col(label) == 1).alias("pos"),
        F.count_if(F.col(label) == 0).alias("neg"),
    ).select(F.struct("n", "pos", "neg").alias("c"))
    of_class = F.when(F.col(label) == 1, F.col("__c.pos")).otherwise(F.col("__c.neg"))
    weight = F.try_divide(F.col("__c.n"), 2 * of_class)
    return df.withColumn("__c", counts.scalar()).withColumn(name, weight).drop("__c")


def assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=VECTOR, handleInvalid="error")


# --- estimators by name -----------------------------------------------------------------


def _tree_params(params, seed):
    return dict(
        featuresCol=VECTOR,
        labelCol=LABEL,
        seed=seed,
        maxMemoryInMB=params.get("memory_mb", 256),
        maxBins=params.get("max_bins", 32),
        cacheNodeIds=True,  # else every level walks down all trees again
    )


def _forest(params, facts, seed, kind):
    extra = {"weightCol": WEIGHT} if kind is RandomForestClassifier else {}
    return [
        kind(
            numTrees=params.get("n_estimators", 200),
            maxDepth=params.get("max_depth", 10),
            minInstancesPerNode=params.get("min_samples_leaf", 4),
            featureSubsetStrategy="sqrt" if extra else "all",
            bootstrap=params.get("bootstrap", True),
            **extra,
            **_tree_params(params, seed),
        )
    ]


REGRESSOR_STAGES: dict[str, Callable] = {
    "random_forest": partial(_forest, kind=RandomForestRegressor),
}
CLASSIFIER_STAGES: dict[str, Callable] = {
    "random_forest": partial(_forest, kind=RandomForestClassifier),
}
# Linear models and their penalties unless a model's parameters say otherwise.
LINEAR = {
    "linear_regression": {"alpha": 0.0},
    "ridge": {"alpha": 1.0},
    "lasso": {"alpha": 0.1, "l1": True},
}
LOGISTIC = "logistic_regression"
# Boosted models and what differs between them unless a model's parameters say otherwise: the
# second adds a penalty on leaf values and draws rows for every tree.
BOOSTED = {
    "gradient_boosting": {"l2": 0.0, "least": 1e-3},
    "xgboost": {"l2": 1.0, "least": 1.0, "subsample": 0.8},
}


def training_facts(df: DataFrame, features: Sequence[str], label: str) -> Facts:
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.coalesce(F.stddev_pop(f"`{c}`"), F.lit(0.0)).alias(f"f{i}") for i, c in enumerate(features)],
    ).first()
    return Facts(row["n"], {c: row[f"f{i}"] for i, c in enumerate(features)})


def kind_of(name: str, params: Mapping) -> str:
    """What a model is; its name, unless its parameters say so."""
    return params.get("kind", name)


def fit_linear(
    rows: DataFrame, features: Sequence[str], label: str, configs: Mapping[str, Mapping], track: str,
    facts: Facts, fold: str | None = None, folds: Sequence[int | None] = (None,),
) -> dict[tuple[str, int | None], Fitted]:
    """The linear models among `configs`, one for each fold left out, from shared passes."""
    kinds = LINEAR if track == "regression" else (LOGISTIC,)
    names = [n for n, params in configs.items() if kind_of(n, params) in kinds]
    keys = [(n, k) for n in names for k in folds]
    if not keys:
        return {}
    if track == "regression":
        centre, sums = linear.gram(rows, features, label, fold)
        found = []
        for n, k in keys:
            usual = LINEAR[kind_of(n, configs[n])]
            alpha = configs[n].get("alpha", usual["alpha"])
            found.append(linear.solve(linear.moments(centre, sums, k), alpha, usual.get("l1", False)))
    else:
        cs = [configs[n].get("C", 1.0) for n, _ in keys]
        found = linear.newton(rows, features, label, cs, fold, [k for _, k in keys])
    kind = linear.LinearModel if track == "regression" else linear.LogisticModel
    vectorise = assembler(features)
    return {
        key: Fitted(key[0], PipelineModel([vectorise, kind(f, featuresCol=VECTOR)]), facts)
        for key, f in zip(keys, found)
    }


def boost_plan(name: str, params: Mapping, settings: Settings, track: str, fold: int | None) -> Plan:
    usual = BOOSTED[kind_of(name, params)]
    return Plan(
        trees=params.get("n_estimators", 200),
        depth=params.get("max_depth", 4),
        rate=params.get("learning_rate", 0.05),
        l2=params.get("reg_lambda", usual["l2"]),
        least=params.get("min_child_weight", usual["least"]),
        subsample=params.get("subsample", usual.get("subsample", 1.0)),
        positive_weight=float(params.get("scale_pos_weight", 1)),
        logistic=track == "classification",
        seed=settings.random_state,
        without_fold=fold,
    )


def boost(
    rows: DataFrame,
    features: Sequence[str],
    label: str,
    configs: Mapping[str, Mapping],
    settings: Settings,
    track: str,
    facts: Facts,
    fold: str | None = None,
    folds: Sequence[int | None] = (None,),
) -> dict[tuple[str, int | None], Fitted]:
    """The boosted models among `configs`, one for each fold left out, all grown in step."""
    keys = [(n, k) for n, params in configs.items() if kind_of(n, params) in BOOSTED for k in folds]
    if not keys:
        return {}
    plans = [boost_plan(name, configs[name], settings, track, k) for name, k in keys]
    cut = sinks.table_cut(rows.sparkSession)
    cuts, ensembles = boosting.grow(rows, features, label, plans, cut, fold=fold)
    kind = boosting.BoostedRegression if track == "regression" else boosting.BoostedClassification
    vectorise = assembler(features)
    return {
        key: Fitted(key[0], PipelineModel([vectorise, kind(cuts, e, featuresCol=VECTOR)]), facts)
        for key, e in zip(keys, ensembles)
    }


def shared_out(rows: DataFrame, n_rows: int) -> DataFrame:
    """Few rows are few tasks; many rows in few partitions are dealt out to all cores, as the
    passes of a forest over them are long."""
    tasks = max(1, ceil(n_rows / ROWS_PER_TASK))
    enough = min(tasks, rows.sparkSession.sparkContext.defaultParallelism)
    if rows.rdd.getNumPartitions() < enough:
        return rows.repartition(enough).persist()
    return rows.coalesce(tasks)


def _fit(train, features, label, configs, stages, settings, track, folder) -> dict[str, Fitted]:
    kinds = {name: kind_of(name, params) for name, params in configs.items()}
    known = {*stages, *BOOSTED, *(LINEAR if track == "regression" else (LOGISTIC,))}
    unknown = sorted(set(kinds.values()) - known)
    if unknown:
        raise ValueError(f"unknown {track} models: {unknown}")
    # Every model passes over these columns many times; vectors are put together on the way.
    rows = train.where(F.col(label).isNotNull())
    rows = rows.select(
        *[F.col(f"`{c}`").cast("double").alias(c) for c in features],
        F.col(label).cast("double").alias(LABEL),
    ).persist()
    facts = training_facts(rows, features, LABEL)
    vectorise = assembler(features)
    held = shared_out(rows, facts.n_rows)
    base = vectorise.transform(held)
    if track == "classification":
        base = balanced_weights(base, LABEL, WEIGHT)

    def fit_one(name: str) -> list[Fitted]:
        if name == BOOST:
            return list(boost(held, features, LABEL, configs, settings, track, facts).values())
        if name == LINES:
            return list(fit_linear(held, features, LABEL, configs, track, facts).values())
        params, data, done = configs[name], base, [vectorise]
        for stage in stages[kinds[name]](params, facts, settings.random_state):
            if hasattr(stage, "fit"):
                stage = stage.fit(data)
            data = stage.transform(data)
            done.append(stage)
        return [Fitted(name, PipelineModel(done), facts)]

    jobs = [name for name in configs if kinds[name] in stages]
    jobs += [BOOST] if set(kinds.values()) & set(BOOSTED) else []
    jobs += [LINES] if set(kinds.values()) & {*LINEAR, LOGISTIC} else []
    try:
        # Independent fits share the cached rows; one alone seldom fills a cluster.
        with ThreadPool(max(1, min(settings.parallel_fits, len(jobs)))) as pool:
            done = pool.map(inheritable_thread_target(train.sparkSession)(fit_one), jobs)
    finally:
        held.unpersist()
        rows.unpersist()
    fitted = {f.name: f for group in done for f in group}
    for name, f in fitted.items():
        log.info("fitted %s %s on %d rows", track, name, facts.n_rows)
        if folder:
            sinks.save_model(f.model, folder, track, name)
    return {name: fitted[name] for name in configs}


def fit_regressors(
    train: DataFrame,
    features: Sequence[str],
    label: str = "Data_Value",
    settings: Settings = Settings(),
    folder: str | None = None,
) -> dict[str, Fitted]:
    """All configured regressors on rows with a label; saved below `folder` if given."""
    return _fit(
        train, features, label, settings.regressors, REGRESSOR_STAGES, settings, "regression", folder
    )


def fit_classifiers(
    train: DataFrame,
    features: Sequence[str],
    label: str,
    settings: Settings = Settings(),
    folder: str | None = None,
) -> dict[str, Fitted]:
    """All configured classifiers on rows with a 0/1 label."""
    return _fit(
        train, features, label, settings.classifiers, CLASSIFIER_STAGES, settings,
        "classification", folder,
    )


def score(
    df: DataFrame, models: Mapping[str, Fitted | PipelineModel], label: str, keep: Sequence[str] = ()
) -> DataFrame:
    """Predictions of all models in one pass: (keep..., y, model, prediction, score).

    Classifiers give the probability of class 1 as score and predict 1 above one half;
    regressors have no score. Rows without a label are left out.
    """
    plain = {n: m.model if isinstance(m, Fitted) else m for n, m in models.items()}
    out = df.where(F.col(label).isNotNull())
    first = next(iter(plain.values())).stages[0]
    out = first.transform(out)
    answers = []
    for i, (name, model) in enumerate(plain.items()):
        for stage in model.stages[1:]:
            extra = {stage.predictionCol: f"__p{i}"}
            for other in ("rawPrediction", "probability"):
                if stage.hasParam(f"{other}Col"):
                    extra[stage.getParam(f"{other}Col")] = f"__{other}{i}"
            out = stage.copy(extra).transform(out)
        prediction, chance = F.col(f"__p{i}"), F.lit(None).cast("double")
        if f"__probability{i}" in out.columns:
            chance = vector_to_array(F.col(f"__probability{i}"))[1]
            prediction = (chance > 0.5).cast("double")
        answers.append(
            F.struct(
                F.lit(name).alias("model"), prediction.alias("prediction"), chance.alias("score")
            )
        )
    return out.select(
        *keep, F.col(label).cast("double").alias("y"), F.explode(F.array(*answers)).alias("__a")
    ).select(*keep, "y", "__a.*")


def standard_coefficients(fitted: Fitted) -> dict[str, float] | None:
    """Coefficients on features scaled by the population standard deviation, if linear."""
    if not hasattr(fitted.last, "coefficients"):
        return None
    names = fitted.model.stages[0].getInputCols()
    values = [float(v) for v in fitted.last.coefficients.toArray()]
    return {c: v * fitted.facts.feature_sd[c] for c, v in zip(names, values)}
