import random

import numpy as np
import pandas as pd
import pytest

from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from stratline.models import boosting, evaluation, explain, sequence, training
from stratline.models.evaluation import fold_plan
from stratline.models.trees import Plan
from stratline.settings import Settings
from stratline.sources import sinks

FEATURES = ["a", "b", "c"]


def rows(n=400, seed=3):
    rng = np.random.default_rng(seed)
    a, b, c = rng.normal(5, 2, n), rng.normal(0, 9, n), rng.normal(-3, 0.5, n)
    y = 3 * a - 0.4 * b + 2 * c + rng.normal(0, 1.5, n)
    label = (y > np.median(y) + 2).astype(int)
    pdf = pd.DataFrame({"row": range(n), "a": a, "b": b, "c": c, "y": y, "label": label})
    pdf["place"] = [f"p{i % 17:02d}" for i in range(n)]
    return pdf


@pytest.fixture(scope="module")
def data(spark):
    pdf = rows()
    return pdf, spark.createDataFrame(pdf).persist()


def standardised(pdf):
    x = pdf[FEATURES].to_numpy()
    return (x - x.mean(0)) / x.std(0)


def lasso(x, y, alpha):
    w, n = np.zeros(x.shape[1]), len(y)
    for _ in range(5000):
        for j in range(len(w)):
            r = y - x @ w + x[:, j] * w[j]
            rho = x[:, j] @ r / n
            w[j] = np.sign(rho) * max(abs(rho) - alpha, 0) / (x[:, j] @ x[:, j] / n)
    return w


def test_linear_models_equal_closed_forms(data):
    pdf, df = data
    configs = {"linear_regression": {}, "ridge": {"alpha": 30.0}, "lasso": {"alpha": 0.3}}
    models = training.fit_regressors(df, FEATURES, "y", Settings(regressors=configs))
    x, y = standardised(pdf), pdf["y"].to_numpy()
    yc = y - y.mean()
    expected = {
        "linear_regression": np.linalg.lstsq(x, yc, rcond=None)[0],
        "ridge": np.linalg.solve(x.T @ x + 30.0 * np.eye(3), x.T @ yc),
        "lasso": lasso(x, yc, 0.3),
    }
    for name, w in expected.items():
        got = training.standard_coefficients(models[name])
        assert [got[c] for c in FEATURES] == pytest.approx(list(w), abs=1e-6), name
    pred = training.score(df, models, "y", keep=["row"]).toPandas()
    for name, w in expected.items():
        own = pred[pred.model == name].sort_values("row")["prediction"].to_numpy()
        assert own == pytest.approx(x @ w + y.mean(), abs=1e-5), name


def test_constant_features_get_no_weight(spark, tmp_path):
    pdf = rows()
    pdf["flat"] = 7.0
    pdf["sum"] = pdf["a"] + pdf["b"] + np.random.default_rng(1).normal(0, 1e-3, len(pdf))
    names = ["a", "flat", "b", "sum"]
    df = spark.createDataFrame(pdf)
    models = training.fit_regressors(
        df, names, "y", Settings(regressors={"linear_regression": {}}), str(tmp_path)
    )
    x = pdf[["a", "b", "sum"]].to_numpy()
    z = (x - x.mean(0)) / x.std(0)
    w = np.linalg.lstsq(z, pdf["y"] - pdf["y"].mean(), rcond=None)[0]
    got = training.standard_coefficients(models["linear_regression"])
    assert got["flat"] == 0.0
    assert [got[c] for c in ("a", "b", "sum")] == pytest.approx(list(w), rel=1e-5)
    again = {"linear_regression": sinks.load_model(str(tmp_path), "regression", "linear_regression")}
    pred = training.score(df, again, "y", keep=["row"]).toPandas().sort_values("row")
    assert pred["prediction"].to_numpy() == pytest.approx(z @ w + pdf["y"].mean(), abs=1e-5)


def test_logistic_equals_newton_solution(data):
    pdf, df = data
    models = training.fit_classifiers(
        df, FEATURES, "label", Settings(classifiers={"logistic_regression": {"C": 0.5}})
    )
    x, y = standardised(pdf), pdf["label"].to_numpy()
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    z = np.column_stack([x, np.ones(len(y))])
    penalty = np.diag([2.0, 2.0, 2.0, 0.0])
    w = np.zeros(4)
    for _ in range(50):
        p = 1 / (1 + np.exp(-z @ w))
        gradient = z.T @ (weight * (p - y)) + penalty @ w
        hessian = z.T @ (z * (weight * p * (1 - p))[:, None]) + penalty
        w -= np.linalg.solve(hessian, gradient)
    got = training.standard_coefficients(models["logistic_regression"])
    assert [got[c] for c in FEATURES] == pytest.approx(list(w[:3]), abs=1e-4)
    chance = training.score(df, models, "label", keep=["row"]).toPandas().sort_values("row")
    assert chance["score"].to_numpy() == pytest.approx(1 / (1 + np.exp(-z @ w)), abs=1e-4)
    assert (chance["prediction"] == (chance["score"] > 0.5)).all()


SMALL_TREES = {
    "random_forest": {"n_estimators": 10, "max_depth": 5, "min_samples_leaf": 4},
    "gradient_boosting": {"n_estimators": 15, "max_depth": 3, "learning_rate": 0.2},
    "xgboost": {"n_estimators": 15, "max_depth": 3, "learning_rate": 0.2, "subsample": 0.8},
}


def test_trees_reach_a_quality_band_and_survive_saving(spark, data, tmp_path):
    _, df = data
    folder = str(tmp_path / "models")
    models = training.fit_regressors(df, FEATURES, "y", Settings(regressors=SMALL_TREES), folder)
    pred = training.score(df, models, "y", keep=["row"])
    found = {
        r.model: r.value
        for r in evaluation.regression_metrics(pred, ["model"]).where("metric = 'r2'").collect()
    }
    assert set(found) == set(SMALL_TREES) and min(found.values()) > 0.8
    again = {n: sinks.load_model(folder, "regression", n) for n in models}
    assert training.score(df, again, "y", keep=["row"]).exceptAll(pred).isEmpty()
    table = explain.built_in_importances(models)
    assert table.where("rank = 1 and feature = 'a'").count() == 3


def test_classifier_metrics(data):
    _, df = data
    configs = {
        "logistic_regression": {},
        "random_forest": {"n_estimators": 10, "max_depth": 5},
        "gradient_boosting": {"n_estimators": 10, "max_depth": 3, "learning_rate": 0.2},
        "xgboost": {"n_estimators": 10, "max_depth": 3, "scale_pos_weight": 3},
    }
    models = training.fit_classifiers(df, FEATURES, "label", Settings(classifiers=configs))
    pred = training.score(df, models, "label", keep=["row"])
    out = evaluation.classification_metrics(pred, ["model"])
    area = {r.model: r.value for r in out.where("metric = 'roc_auc'").collect()}
    assert set(area) == set(configs) and min(area.values()) > 0.85
    assert out.count() == 4 * 5


def test_unknown_model_name_raises(data):
    with pytest.raises(ValueError, match="unknown"):
        training.fit_regressors(data[1], FEATURES, "y", Settings(regressors={"nope": {}}))


def brute_folds(sizes, k):
    loads, out = [0] * k, {}
    for size, groups in sorted(sizes, reverse=True):
        for rank in range(groups):
            fold = min(range(k), key=lambda f: (loads[f], f))
            out[size, rank] = fold
            loads[fold] += size
    return out


def test_fold_plan_equals_the_greedy_rule():
    draw = random.Random(5)
    for _ in range(500):
        k = draw.randint(1, 6)
        sizes = {draw.randint(1, 60): draw.randint(1, 40) for _ in range(draw.randint(1, 6))}
        if draw.random() < 0.3:
            sizes[draw.randint(100, 3000)] = 1
        plan = {}
        for size, first, end, cycle in fold_plan(list(sizes.items()), k):
            for rank in range(first, end):
                plan[size, rank] = cycle[(rank - first) % len(cycle)]
        assert plan == brute_folds(list(sizes.items()), k)
    # A billion groups of one size take a handful of entries.
    assert len(fold_plan([(5, 10**9), (10**12, 1), (1, 10**9)], 5)) < 20


def test_group_folds_keep_groups_whole_and_balanced(data):
    pdf, df = data
    folds = evaluation.group_folds(df, "place", 5).toPandas().set_index("place")["fold"]
    sizes = pdf.groupby("place").size()
    order = sorted(sizes.index, key=lambda g: (-sizes[g], g))
    loads, expected = [0] * 5, {}
    for g in order:
        f = min(range(5), key=lambda i: (loads[i], i))
        expected[g], loads[f] = f + 1, loads[f] + sizes[g]
    assert folds.to_dict() == expected


def test_group_cv_summary(data):
    _, df = data
    settings = Settings(
        regressors={"ridge": {"alpha": 1.0}}, classifiers={"logistic_regression": {}}, cv_folds=3
    )
    folds, mean = evaluation.group_cv(df, FEATURES, "y", "place", "regression", settings)
    assert folds.count() == 3 * 2
    assert mean.where("metric = 'r2'").first()["mean"] > 0.9
    folds, mean = evaluation.group_cv(df, FEATURES, "label", "place", "classification", settings)
    assert {r.metric for r in mean.collect()} == {"f1", "auc"}


def test_permutation_is_a_permutation_and_finds_the_features(data, monkeypatch):
    _, df = data
    monkeypatch.setattr(explain, "BLOCK_ROWS", 60)
    base = df.select("row", F.array("a", "b", "c").alias("vector"))
    shuffled = explain.permuted_vectors(base, ["row"], 2, 1, base.count()).toPandas()
    for _, part in shuffled.groupby("repeat"):
        given = sorted(tuple(v) for v in part["vector"])
        assert sorted(tuple(v) for v in part["donor"]) == given
        assert (part["vector"].map(tuple) != part["donor"].map(tuple)).mean() > 0.9
    models = training.fit_regressors(df, FEATURES, "y", Settings(regressors={"ridge": {}}))
    out = explain.permutation_importances(models, df, "y", ["row"], repeats=3).toPandas()
    assert list(out.sort_values("rank")["feature"]) == ["a", "b", "c"]
    assert (out["std"] > 0).all()


def test_sequence_forecast(spark):
    rng = np.random.default_rng(1)
    panel = pd.DataFrame(
        [(f"u{u:02d}", y, 20 + u + 1.5 * (y - 2000) + rng.normal(0, 0.2)) for u in range(20) for y in range(2000, 2012)],
        columns=["unit", "YearStart", "Data_Value"],
    )
    settings = Settings(train_max_year=2007, val_max_year=2009)
    _, pred = sequence.forecast(
        spark.createDataFrame(panel), ["Data_Value"], settings=settings, unit=["unit"],
        regressors={"ridge": {}},
    )
    out = sequence.evaluate(pred).where("metric = 'r2'").collect()
    assert {r.split for r in out} == {"val", "test"} and min(r.value for r in out) > 0.98


def test_one_scan_serves_all_folds(spark, data):
    """Total less a fold equals a fit on the other rows, for every linear model."""
    pdf, df = data
    df = df.withColumn("fold", F.col("row") % 3)
    configs = {"linear_regression": {}, "ridge": {"alpha": 5.0}, "lasso": {"alpha": 0.2}, "stiff": {"kind": "ridge", "alpha": 900.0}}
    facts = training.training_facts(df, FEATURES, "y")
    found = training.fit_linear(df, FEATURES, "y", configs, "regression", facts, "fold", [0, 1, 2, None])
    assert len(found) == 16
    for k in (0, 1, None):
        part = df if k is None else df.where(F.col("fold") != k)
        alone = training.fit_regressors(part, FEATURES, "y", Settings(regressors=configs))
        for name in configs:
            a, b = found[name, k].last, alone[name].last
            assert a.coefficients.toArray() == pytest.approx(b.coefficients.toArray(), abs=1e-9)
            assert a.intercept == pytest.approx(b.intercept, abs=1e-8)
    classes = {"logistic_regression": {"C": 0.7}}
    together = training.fit_linear(df, FEATURES, "label", classes, "classification", facts, "fold", [0, 1])
    for k in (0, 1):
        alone = training.fit_classifiers(df.where(F.col("fold") != k), FEATURES, "label", Settings(classifiers=classes))
        a, b = together["logistic_regression", k].last, alone["logistic_regression"].last
        assert a.coefficients.toArray() == pytest.approx(b.coefficients.toArray(), abs=1e-7)


def test_logistic_with_one_class_and_far_values(spark):
    one = spark.createDataFrame([(1.0, 0.0), (2.0, 0.0)], "a double, y double")
    models = training.fit_classifiers(one, ["a"], "y", Settings(classifiers={"logistic_regression": {}}))
    assert training.score(one, models, "y").where("prediction = 0").count() == 2
    far = spark.createDataFrame([(1e9 + k, float(k > 50)) for k in range(100)], "a double, y double")
    models = training.fit_classifiers(far, ["a"], "y", Settings(classifiers={"logistic_regression": {"C": 100.0}}))
    assert training.score(far, models, "y").where("prediction <> y").count() <= 1


# --- boosting -----------------------------------------------------------------------------


def plain_tree(x, g, h, plan, depth):
    """The value of each row under one tree, by trying every split."""
    total_g, total_h = g.sum(), h.sum()
    value = np.full(len(x), -plan.rate * total_g / (total_h + plan.l2))
    best, at = 1e-9, None
    for f in range(x.shape[1]):
        for v in np.unique(x[:, f])[:-1]:
            left = x[:, f] <= v
            hl, hr = h[left].sum(), h[~left].sum()
            if min(hl, hr) >= plan.least:
                gain = g[left].sum() ** 2 / (hl + plan.l2) + g[~left].sum() ** 2 / (hr + plan.l2) - total_g**2 / (total_h + plan.l2)
                if gain > best + 1e-9:
                    best, at = gain, left
    if depth and at is not None:
        value[at] = plain_tree(x[at], g[at], h[at], plan, depth - 1)
        value[~at] = plain_tree(x[~at], g[~at], h[~at], plan, depth - 1)
    return value


def grid_rows(n=300):
    rng = np.random.default_rng(11)
    x = rng.integers(0, 12, (n, 3)).astype(float)
    y = x[:, 0] * 2 + (x[:, 1] > 5) * 7 + rng.normal(0, 2, n)
    return x, y


@pytest.mark.parametrize("logistic", [False, True])
@pytest.mark.parametrize("block_rows", [1000, 0], ids=["one block", "passes"])
def test_boosting_equals_trying_every_split(spark, monkeypatch, logistic, block_rows):
    monkeypatch.setattr(boosting, "BLOCK_ROWS", block_rows)
    x, y = grid_rows()
    if logistic:
        y = (y > 14).astype(float)
    plan = Plan(trees=4, depth=3, rate=0.3, l2=0.7, least=2.0, logistic=logistic, positive_weight=2.0 if logistic else 1.0)
    df = spark.createDataFrame(pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "y": y})).repartition(3)
    cuts, (ensemble,) = boosting.grow(df, FEATURES, "y", [plan], sinks.table_cut(spark))
    margin = np.full(len(y), np.log(2 * y.sum() / (1 - y).sum()) if logistic else y.mean())
    for _ in range(plan.trees):
        g, h = boosting.slopes(y, margin, plan)
        margin = margin + plain_tree(x, g, h, plan, plan.depth)
    got = ensemble.start + ensemble.margins(boosting.binned(x, cuts))
    assert got == pytest.approx(margin, abs=1e-9)


def test_ensembles_in_step_equal_ensembles_alone(spark, monkeypatch):
    monkeypatch.setattr(boosting, "REFRESH", 2)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 0)
    x, y = grid_rows(200)
    pdf = pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "y": y, "fold": np.arange(200) % 4})
    df = spark.createDataFrame(pdf).repartition(3)
    plans = [Plan(trees=5, depth=2, rate=0.2, subsample=0.7), Plan(trees=3, depth=3, without_fold=2), Plan(trees=1, depth=1)]
    cuts, together = boosting.grow(df, FEATURES, "y", plans, sinks.table_cut(spark), fold="fold")
    bins = boosting.binned(x, cuts)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 1000)
    for plan, e in zip(plans, together):
        _, (alone,) = boosting.grow(df, FEATURES, "y", [plan], sinks.table_cut(spark), fold="fold")
        assert e.margins(bins) == pytest.approx(alone.margins(bins), abs=1e-9) and e.start == alone.start
    kept = df.where("fold <> 2").drop("fold")
    _, (apart,) = boosting.grow(kept, FEATURES, "y", [Plan(trees=1, depth=1)], sinks.table_cut(spark))
    assert apart.start == pytest.approx(together[1].start)


def test_rows_are_drawn_by_their_values():
    draw = np.random.default_rng(0).integers(0, 1 << 63, 20_000).astype(np.uint64)
    plan = Plan(subsample=0.8)
    first, second = (boosting.drawn(draw, plan, k) for k in (0, 1))
    assert abs(first.mean() - 0.8) < 0.02 and abs((first & second).mean() - 0.64) < 0.02
    assert (boosting.drawn(draw[::-1], plan, 0) == first[::-1]).all()


def test_boosted_cross_validation_and_missing_values(spark, data):
    _, df = data
    settings = Settings(regressors={"gradient_boosting": {"n_estimators": 10, "max_depth": 3, "learning_rate": 0.3}}, cv_folds=3)
    folds, mean = evaluation.group_cv(df, FEATURES, "y", "place", "regression", settings)
    assert folds.count() == 6 and mean.where("metric = 'r2'").first()["mean"] > 0.7
    with_nulls = df.withColumn("a", F.when(F.col("row") % 5 > 0, F.col("a")))
    cuts, (e,) = boosting.grow(with_nulls, ["a"], "y", [Plan(trees=2, depth=2)], sinks.table_cut(spark))
    assert np.isfinite(e.margins(boosting.binned(np.array([[np.nan], [5.0]]), cuts))).all()
    empty = df.where("row < 0")
    _, (none,) = boosting.grow(empty, FEATURES, "y", [Plan(trees=2, depth=2)], sinks.table_cut(spark))
    assert none.start == 0 and not none.margins(np.zeros((1, 3), np.uint8)).any()


def test_rows_with_equal_bins_are_one_row_with_a_count(spark):
    x, y = grid_rows(120)
    pdf = pd.DataFrame({"a": x[:, 0] % 2, "b": x[:, 1] % 3, "c": 1.0, "y": y})
    df = spark.createDataFrame(pd.concat([pdf] * 3))
    cuts = boosting.cut_points(df, FEATURES, 63)
    rows = boosting.merged(df, FEATURES, "y", None, cuts, [Plan()]).collect()
    expected = pdf.groupby(["a", "b"])["y"].agg(["mean", "size"])
    assert sorted((round(r.y, 9), r.n) for r in rows) == sorted((round(m, 9), 3 * n) for m, n in expected.itertuples(index=False))
    # Rows of a different draw or, under logistic loss, label stay apart.
    assert len(boosting.merged(df, FEATURES, "y", None, cuts, [Plan(subsample=0.5)]).collect()) == 120
    flags = df.withColumn("y", (df["y"] > 14).cast("double"))
    logistic = boosting.merged(flags, FEATURES, "y", None, cuts, [Plan(logistic=True)]).collect()
    assert {r.y for r in logistic} == {0.0, 1.0} and sum(r.n for r in logistic) == 360


def test_many_rows_in_one_partition_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(training, "ROWS_PER_TASK", 10)
    rows = spark.range(25).coalesce(1).persist()
    held = training.shared_out(rows, 25)
    assert held.rdd.getNumPartitions() == min(3, spark.sparkContext.defaultParallelism) and held.count() == 25
    assert training.shared_out(rows, 5).rdd.getNumPartitions() == 1
    held.unpersist(), rows.unpersist()


def test_passes_of_boosting_plan_no_query_for_a_level(spark, monkeypatch):
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 0)
    monkeypatch.setattr(boosting, "SENT_BYTES", 0)  # sums in two steps
    arrow, calls = DataFrame.toArrow, []
    monkeypatch.setattr(DataFrame, "toArrow", lambda self: calls.append(self) or arrow(self))
    x, y = grid_rows(200)
    df = spark.createDataFrame(pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "y": y})).repartition(3)
    cuts, (e,) = boosting.grow(df, FEATURES, "y", [Plan(trees=3, depth=2)], sinks.table_cut(spark))
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 1000)
    _, (alone,) = boosting.grow(df, FEATURES, "y", [Plan(trees=3, depth=2)], sinks.table_cut(spark))
    bins = boosting.binned(x, cuts)
    assert e.margins(bins) == pytest.approx(alone.margins(bins), abs=1e-9) and not calls
