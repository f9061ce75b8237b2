"""Model queries, with the library's own model sizes."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from stratline.models import boosting, evaluation, explain, sequence, training
from stratline.models.trees import Plan
from stratline.operators import panel, targets
from stratline.plans import carriers, pipeline
from stratline.plans.carriers import SETTINGS, SPARSE_SQL, table
from stratline.plans.queries_panel import LAGGED_SQL, SPLIT_SQL, TRAIN_MAX, lagged, warned
from stratline.plans.registry import query
from stratline.settings import Settings
from stratline.sources import sinks

# Model sizes are the library's own; the carrier has few early warnings.
FULL = SETTINGS.override(save_models=False, early_warning_min_pairs=100)

FEATURES = ["lag_1", "lag_2"]


def lag_rows(spark, sf):
    """Sparse panel rows with both lags, values in thousands."""
    rows = lagged(spark, sf).where(F.col("lag_1").isNotNull() & F.col("lag_2").isNotNull())
    thousand = {c: F.col(c) / 1000.0 for c in ("Data_Value", "lag_1", "lag_2")}
    return rows.withColumns(thousand).select("unit", "YearStart", "Data_Value", *FEATURES)


LAG_ROWS_SQL = f"""{LAGGED_SQL},
lag_rows AS (SELECT unit, "YearStart", "Data_Value" / 1000.0 AS y, lag_1 / 1000.0 AS x1,
  lag_2 / 1000.0 AS x2, {SPLIT_SQL} AS split
  FROM lagged WHERE lag_1 IS NOT NULL AND lag_2 IS NOT NULL),
m AS (SELECT count(*) AS n, avg(y) AS my, avg(x1) AS m1, avg(x2) AS m2, var_pop(x1) AS s11,
  var_pop(x2) AS s22, covar_pop(x1, x2) AS s12, covar_pop(x1, y) AS s1y, covar_pop(x2, y) AS s2y
  FROM lag_rows WHERE "YearStart" <= {TRAIN_MAX})"""


def _two_feature_sql(name, alpha):
    """Closed form for two features, penalised on their standardised scale."""
    return f"""SELECT '{name}' AS model,
      ((s22 * (1 + {alpha} / n)) * s1y - s12 * s2y) / d AS b1,
      ((s11 * (1 + {alpha} / n)) * s2y - s12 * s1y) / d AS b2, m.* FROM m,
      (SELECT (s11 * (1 + {alpha} / n)) * (s22 * (1 + {alpha} / n)) - s12 * s12 AS d FROM m)"""


LINES_SQL = f"""{LAG_ROWS_SQL},
lines AS ({_two_feature_sql('linear_regression', '0.0')} UNION ALL {_two_feature_sql('ridge', '500.0')})"""

LINEAR = Settings(regressors={"linear_regression": {}, "ridge": {"alpha": 500.0}})


def linear_models(spark, sf):
    train = lag_rows(spark, sf).where(F.col("YearStart") <= TRAIN_MAX)
    return training.fit_regressors(train, FEATURES, "Data_Value", LINEAR)


@query(f"""WITH {LINES_SQL}
SELECT model, 'lag_1' AS feature, round(b1 * sqrt(s11), 4) AS coefficient FROM lines
UNION ALL SELECT model, 'lag_2', round(b2 * sqrt(s22), 4) FROM lines""")
def linear_coefficients(spark, sf):
    """Least squares and ridge coefficients on standardised features."""
    found = explain.built_in_importances(linear_models(spark, sf))
    return found.select("model", "feature", F.round("importance", 4).alias("coefficient"))


@query(f"""WITH {LINES_SQL}, pred AS (
  SELECT model, split, y, my + b1 * (x1 - m1) + b2 * (x2 - m2) AS p FROM lag_rows, lines
  WHERE split IN ('val', 'test')),
e AS (SELECT model, split, avg(abs(y - p)) AS mae, avg((y - p) * (y - p)) AS mse, var_pop(y) AS v
  FROM pred GROUP BY ALL)
SELECT model, split, metric, round(value, 4) AS value FROM (
  SELECT model, split, 'mae' AS metric, mae AS value FROM e
  UNION ALL SELECT model, split, 'mse', mse FROM e
  UNION ALL SELECT model, split, 'rmse', sqrt(mse) FROM e
  UNION ALL SELECT model, split, 'r2', 1 - mse / v FROM e)""")
def linear_model_metrics(spark, sf):
    split = targets.split_name(F.col("YearStart"), SETTINGS)
    rows = lag_rows(spark, sf)
    out = evaluation.evaluate(linear_models(spark, sf), rows, "Data_Value", split, "regression")
    return out.select("model", "split", "metric", F.round("value", 4).alias("value"))


@query(f"""WITH {LINES_SQL}
SELECT split, count(*) AS n, round(avg(my + b1 * (x1 - m1) + b2 * (x2 - m2)), 4) AS mean_prediction
FROM lag_rows, lines WHERE model = 'ridge' GROUP BY split""")
def saved_model_scores(spark, sf):
    """A fitted model, saved, loaded and applied to all rows."""
    folder = sinks.table_folder(spark)
    rows = lag_rows(spark, sf)
    train = rows.where(F.col("YearStart") <= TRAIN_MAX)
    training.fit_regressors(train, FEATURES, "Data_Value", LINEAR, folder)
    loaded = {"ridge": sinks.load_model(folder, "regression", "ridge")}
    split = targets.split_name(F.col("YearStart"), SETTINGS)
    out = training.score(rows.withColumn("split", split), loaded, "Data_Value", keep=["split"])
    return out.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("prediction"), 4).alias("mean_prediction"))


@query(f"""WITH {LAG_ROWS_SQL} SELECT 'lasso' AS model, 'lag_1' AS feature,
  round(sign(s1y) * greatest(abs(s1y) / sqrt(s11) - 0.5, 0), 4) AS coefficient FROM m""")
def lasso_coefficient(spark, sf):
    train = lag_rows(spark, sf).where(F.col("YearStart") <= TRAIN_MAX)
    settings = Settings(regressors={"lasso": {"alpha": 0.5}})
    models = training.fit_regressors(train, ["lag_1"], "Data_Value", settings)
    found = explain.built_in_importances(models)
    return found.select("model", "feature", F.round("importance", 4).alias("coefficient"))


_K = 5


def _folds_sql(tab, group):
    """folds(grp, fold): each group, from the largest down, joins the lightest fold."""
    lightest = "CAST(list_position(s.loads, list_min(s.loads)) AS INTEGER)"
    loads = ", ".join(
        f"s.loads[{i}] + CASE WHEN {lightest} = {i} THEN o.n ELSE 0 END" for i in range(1, _K + 1)
    )
    return f"""
sizes AS (SELECT {group} AS grp, count(*) AS n FROM {tab} GROUP BY 1),
ordered AS (SELECT *, row_number() OVER (ORDER BY n DESC, grp) AS r FROM sizes),
steps(r, grp, fold, loads) AS (
  SELECT CAST(0 AS BIGINT), CAST(NULL AS INTEGER), CAST(NULL AS INTEGER),
    [CAST(0 AS BIGINT) {', CAST(0 AS BIGINT)' * (_K - 1)}]
  UNION ALL
  SELECT o.r, o.grp, {lightest}, [{loads}] FROM steps s JOIN ordered o ON o.r = s.r + 1),
folds AS (SELECT grp, fold FROM steps WHERE r > 0)"""


@query(f"WITH RECURSIVE {_folds_sql('customer', 'c_nationkey')} SELECT grp AS c_nationkey, fold FROM folds")
def group_folds(spark, sf):
    return evaluation.group_folds(table(spark, sf, "customer"), "c_nationkey", _K)


@query(f"""WITH RECURSIVE {LAG_ROWS_SQL},
grouped AS (SELECT lag_rows.*, c_nationkey FROM lag_rows JOIN customer ON unit = c_custkey),
{_folds_sql('grouped', 'c_nationkey')},
tagged AS (SELECT g.*, fold FROM grouped g JOIN folds ON c_nationkey = grp),
fits AS (SELECT f.fold, regr_slope(y, x1) AS b, regr_intercept(y, x1) AS a
  FROM (SELECT DISTINCT fold FROM folds) f JOIN tagged t ON t.fold <> f.fold GROUP BY 1),
err AS (SELECT t.fold, avg(abs(y - a - b * x1)) AS mae,
  1 - avg((y - a - b * x1) * (y - a - b * x1)) / var_pop(y) AS r2
  FROM tagged t JOIN fits ON t.fold = fits.fold GROUP BY 1)
SELECT 'linear_regression' AS model, 'mae' AS metric, round(avg(mae), 4) AS mean FROM err
UNION ALL SELECT 'linear_regression', 'r2', round(avg(r2), 4) FROM err""")
def group_cv_line(spark, sf):
    """Five folds that keep nations whole, a straight line on the previous value."""
    cut = sinks.table_cut(spark)
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    rows = lag_rows(spark, sf).join(customer, F.col("unit") == F.col("c_custkey"))
    settings = Settings(regressors={"linear_regression": {}}, cv_folds=_K)
    _, mean = evaluation.group_cv(
        cut(rows, "grouped"), ["lag_1"], "Data_Value", "c_nationkey", "regression", settings
    )
    return mean.withColumn("mean", F.round("mean", 4))


_ALPHAS = (0, 10, 100, 1000, 10000, 100000)


@query(f"""WITH RECURSIVE {LAG_ROWS_SQL},
grouped AS (SELECT lag_rows.*, c_nationkey FROM lag_rows JOIN customer ON unit = c_custkey),
{_folds_sql('grouped', 'c_nationkey')},
tagged AS (SELECT g.*, fold FROM grouped g JOIN folds ON c_nationkey = grp),
alphas AS (SELECT unnest([{', '.join(map(str, _ALPHAS))}]) AS alpha),
slopes AS (SELECT alpha, f.fold, covar_pop(y, x1) / (var_pop(x1) * (1 + alpha / count(*))) AS b,
  avg(y) AS my, avg(x1) AS mx
  FROM alphas, (SELECT DISTINCT fold FROM folds) f JOIN tagged t ON t.fold <> f.fold GROUP BY 1, 2),
err AS (SELECT alpha, t.fold, avg(abs(y - my - b * (x1 - mx))) AS mae,
  1 - avg((y - my - b * (x1 - mx)) * (y - my - b * (x1 - mx))) / var_pop(y) AS r2
  FROM tagged t JOIN slopes s ON t.fold = s.fold GROUP BY 1, 2)
SELECT 'ridge_' || alpha AS model, 'mae' AS metric, round(avg(mae), 4) AS mean FROM err GROUP BY alpha
UNION ALL SELECT 'ridge_' || alpha, 'r2', round(avg(r2), 4) FROM err GROUP BY alpha""")
def group_cv_ridge_alphas(spark, sf):
    """Six penalties in five folds from one scan of sums and products."""
    cut = sinks.table_cut(spark)
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    rows = lag_rows(spark, sf).join(customer, F.col("unit") == F.col("c_custkey"))
    models = {f"ridge_{a}": {"kind": "ridge", "alpha": float(a)} for a in _ALPHAS}
    settings = Settings(regressors=models, cv_folds=_K)
    _, mean = evaluation.group_cv(
        cut(rows, "grouped"), ["lag_1"], "Data_Value", "c_nationkey", "regression", settings
    )
    return mean.withColumn("mean", F.round("mean", 4))


@query("""WITH base AS (SELECT CAST(o_orderpriority = '1-URGENT' AS INT) AS x,
  CAST(o_totalprice > 250000 AS INT) AS y FROM orders),
w AS (SELECT count(*) / (2.0 * sum(y)) AS up, count(*) / (2.0 * sum(1 - y)) AS down FROM base)
SELECT x, round(max(up) * sum(y) / (max(up) * sum(y) + max(down) * sum(1 - y)), 5) AS score
FROM base, w GROUP BY x""")
def balanced_logistic(spark, sf):
    """The balanced logistic model on one 0/1 feature, next to no penalty: balanced shares."""
    rows = table(spark, sf, "orders").select(
        (F.col("o_orderpriority") == "1-URGENT").cast("int").alias("x"),
        (F.col("o_totalprice") > 250000).cast("int").alias("y"),
    )
    models = training.fit_classifiers(rows, ["x"], "y", Settings(classifiers={"logistic_regression": {"C": 1e12}}))
    out = training.score(rows, models, "y", keep=["x"])
    return out.groupBy("x").agg(F.round(F.max("score"), 5).alias("score"))


# --- trees ------------------------------------------------------------------------------


def _stump_sql(cells, name, rate, l2):
    """name(x, m): the margins of cells (x, n, g, h, m) after one more split, chosen by gain."""
    gain = f"gl * gl / (hl + {l2}) + (g_all - gl) * (g_all - gl) / (h_all - hl + {l2})"
    return f"""{name}_run AS (SELECT *, sum(g) OVER (ORDER BY x) AS gl, sum(h) OVER (ORDER BY x) AS hl,
  sum(g) OVER () AS g_all, sum(h) OVER () AS h_all, max(x) OVER () AS last FROM {cells}),
{name}_best AS (SELECT x AS t, -{rate} * gl / (hl + {l2}) AS low,
  -{rate} * (g_all - gl) / (h_all - hl + {l2}) AS high
  FROM {name}_run WHERE x < last ORDER BY {gain} DESC, x LIMIT 1),
{name} AS (SELECT c.*, c.m + CASE WHEN x <= t THEN low ELSE high END AS fit FROM {cells} c, {name}_best)"""


def boosted_cells(df, x, label, plan):
    """What an ensemble on one feature answers for each of its values."""
    rows = df.select(F.col(x).cast("double").alias("x"), F.col(label).cast("double").alias("y"))
    cuts, (ensemble,) = boosting.grow(rows, ["x"], "y", [plan], sinks.table_cut(df.sparkSession), bins=256)
    kind = boosting.BoostedClassification if plan.logistic else boosting.BoostedRegression
    values = rows.groupBy("x").agg(F.count(F.lit(1)).alias("n"))
    vectors = training.assembler(["x"]).transform(values)
    return kind(cuts, ensemble, featuresCol=training.VECTOR).transform(vectors)


@query(f"""WITH base AS (SELECT l_quantity AS x, count(*) AS n, sum(l_extendedprice / 1000) AS s
  FROM lineitem GROUP BY 1),
start AS (SELECT sum(s) / sum(n) AS m0 FROM base),
first AS (SELECT x, n, s, m0 AS m, n * m0 - s AS g, n AS h FROM base, start),
{_stump_sql('first', 'one', 0.5, 1)},
second AS (SELECT x, n, s, fit AS m, n * fit - s AS g, n AS h FROM one),
{_stump_sql('second', 'two', 0.5, 1)},
third AS (SELECT x, n, s, fit AS m, n * fit - s AS g, n AS h FROM two),
{_stump_sql('third', 'three', 0.5, 1)}
SELECT x, n, round(fit, 4) AS prediction FROM three""")
def boosted_prices(spark, sf):
    """Three boosted splits of price by quantity: sums of gradients, penalised leaves."""
    lines = table(spark, sf, "lineitem").withColumn("price", F.col("l_extendedprice") / 1000)
    out = boosted_cells(lines, "l_quantity", "price", Plan(trees=3, depth=1, rate=0.5))
    return out.select("x", "n", F.round("prediction", 4).alias("prediction"))


@query(f"""WITH base AS (SELECT CAST(year(l_shipdate) AS DOUBLE) AS x, count(*) AS n,
  count(*) FILTER (l_returnflag = 'R') AS up FROM lineitem GROUP BY 1),
start AS (SELECT ln((2 * sum(up) + 1e-12) / (sum(n) - sum(up) + 1e-12)) AS m0 FROM base),
first AS (SELECT x, n, up, m0 AS m, (2 * up + n - up) / (1 + exp(-m0)) - 2 * up AS g,
  (2 * up + n - up) * (1 / (1 + exp(-m0))) * (1 - 1 / (1 + exp(-m0))) AS h FROM base, start),
{_stump_sql('first', 'one', 0.5, 1)},
second AS (SELECT x, n, up, fit AS m, (2 * up + n - up) / (1 + exp(-fit)) - 2 * up AS g,
  (2 * up + n - up) * (1 / (1 + exp(-fit))) * (1 - 1 / (1 + exp(-fit))) AS h FROM one),
{_stump_sql('second', 'two', 0.5, 1)}
SELECT x, n, round(1 / (1 + exp(-fit)), 4) AS chance FROM two""")
def boosted_returns(spark, sf):
    """Two boosted splits of returns by year, positives weighing twice."""
    lines = table(spark, sf, "lineitem").withColumn("returned", F.col("l_returnflag") == "R")
    lines = lines.withColumn("year", F.year("l_shipdate")).withColumn("returned", F.col("returned").cast("int"))
    plan = Plan(trees=2, depth=1, rate=0.5, positive_weight=2.0, logistic=True)
    out = boosted_cells(lines, "year", "returned", plan)
    return out.select("x", "n", F.round(vector_to_array("probability")[1], 4).alias("chance"))


ONE_TREE = {"n_estimators": 1, "max_depth": 25, "min_samples_leaf": 1, "bootstrap": False}


@query("""SELECT c_nationkey, round(avg(c_acctbal), 4) AS prediction FROM customer GROUP BY 1""")
def forest_group_means(spark, sf):
    """One deep regression tree on a feature of few values answers with their means."""
    rows = table(spark, sf, "customer").select("c_nationkey", "c_acctbal")
    models = training.fit_regressors(rows, ["c_nationkey"], "c_acctbal", Settings(regressors={"random_forest": ONE_TREE}))
    out = training.score(rows, models, "c_acctbal", keep=["c_nationkey"])
    return out.groupBy("c_nationkey").agg(F.round(F.max("prediction"), 4).alias("prediction"))


@query("""WITH base AS (SELECT c_nationkey, CAST(c_acctbal > 6000 AS INT) AS y FROM customer),
w AS (SELECT count(*) / (2.0 * sum(y)) AS up, count(*) / (2.0 * sum(1 - y)) AS down FROM base)
SELECT c_nationkey, CAST(max(up) * sum(y) > max(down) * sum(1 - y) AS DOUBLE) AS prediction
FROM base, w GROUP BY 1""")
def forest_group_majority(spark, sf):
    """One deep classification tree answers with the balanced majority of its values."""
    rows = table(spark, sf, "customer").select("c_nationkey", (F.col("c_acctbal") > 6000).cast("int").alias("rich"))
    models = training.fit_classifiers(rows, ["c_nationkey"], "rich", Settings(classifiers={"random_forest": ONE_TREE}))
    out = training.score(rows, models, "rich", keep=["c_nationkey"])
    return out.groupBy("c_nationkey").agg(F.max("prediction").alias("prediction"))


def survey_model(spark, sf):
    cut = sinks.table_cut(spark)
    raw = cut(carriers.extract(spark, sf), "extract")
    raw = raw.where(
        (F.col("Class") == FULL.target_class) & (F.col("Question") == FULL.target_question)
    )
    return pipeline.model_table(pipeline.clean_stage(raw, FULL, cut), FULL, cut)


@query()
def regression_models(spark, sf):
    """All six regressors on the survey panel, validation and test metrics."""
    model = survey_model(spark, sf)
    train, _, _ = targets.temporal_split(model.table, FULL)
    models = training.fit_regressors(train, model.feature_names, "Data_Value", FULL)
    split = targets.split_name(F.col("YearStart"), FULL)
    return evaluation.evaluate(models, model.table, "Data_Value", split, "regression")


@query()
def classification_models(spark, sf):
    """All four classifiers for the early-warning label of the sparse panel."""
    cut = sinks.table_cut(spark)
    names = ["YearStart", "Data_Value", "lag_1"]
    rows = cut(warned(spark, sf).select(*names, "early_warning"), "labelled")
    rows = cut(panel.impute_medians(rows, ["lag_1"]), "imputed")
    train = rows.where(F.col("YearStart") <= TRAIN_MAX)
    models = training.fit_classifiers(train, names, "early_warning", FULL)
    split = targets.split_name(F.col("YearStart"), FULL)
    return evaluation.evaluate(models, rows, "early_warning", split, "classification", cut)


@query()
def group_cross_validation(spark, sf):
    """Five folds that keep locations whole: mean r2 and mae of five regressors, f1 and auc of
    three classifiers; the forests are left out (README, Open)."""
    model = survey_model(spark, sf)
    settings = FULL.override(regressors={"random_forest": None}, classifiers={"random_forest": None})
    parts = []
    for track, label in (("regression", "Data_Value"), ("classification", model.target)):
        _, mean = evaluation.group_cv(model.table, model.feature_names, label, "LocationDesc", track, settings)
        parts.append(mean.select(F.lit(track).alias("track"), "model", "metric", "mean"))
    return reduce(DataFrame.unionByName, parts)


@query()
def feature_importances(spark, sf):
    """Gain importances, coefficients and permutation importances (ten repeats) of a linear and
    two boosted models on the survey panel."""
    model = survey_model(spark, sf)
    train, val, _ = targets.temporal_split(model.table, FULL)
    chosen = {k: FULL.regressors[k] for k in ("ridge", "gradient_boosting", "xgboost")}
    settings = Settings(regressors=chosen)
    models = training.fit_regressors(train, model.feature_names, "Data_Value", settings)
    return explain.importances(models, val, "Data_Value", pipeline.KEYS, "regression", settings)


@query()
def sequence_forecast(spark, sf):
    """A unit's next value from its last three, linear and boosted."""
    rows = lagged(spark, sf).select("unit", "YearStart", "Data_Value", "n")
    _, pred = sequence.forecast(
        rows, ["Data_Value", "n"], settings=SETTINGS, unit=["unit"],
        regressors={"ridge": {"alpha": 1.0}, "gradient_boosting": FULL.regressors["gradient_boosting"]},
        cut=sinks.table_cut(spark),
    )
    return sequence.evaluate(pred)


@query(f"""WITH {SPARSE_SQL},
windows AS (SELECT "YearStart" AS target_year, "Data_Value" / 1000.0 AS y,
  lag("Data_Value") OVER (PARTITION BY unit ORDER BY "YearStart") / 1000.0 AS x FROM sparse),
named AS (SELECT *, CASE WHEN target_year <= {TRAIN_MAX} THEN 'train'
  WHEN target_year <= {SETTINGS.val_max_year} THEN 'val' ELSE 'test' END AS split
  FROM windows WHERE x IS NOT NULL),
line AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM named WHERE split = 'train'),
e AS (SELECT split, avg(abs(y - a - b * x)) AS mae, avg((y - a - b * x) * (y - a - b * x)) AS mse,
  var_pop(y) AS v FROM named, line WHERE split <> 'train' GROUP BY 1)
SELECT 'linear_regression' AS model, split, metric, round(value, 4) AS value FROM (
  SELECT split, 'mae' AS metric, mae AS value FROM e
  UNION ALL SELECT split, 'mse', mse FROM e
  UNION ALL SELECT split, 'rmse', sqrt(mse) FROM e
  UNION ALL SELECT split, 'r2', 1 - mse / v FROM e)""")
def sequence_line(spark, sf):
    """Next observed value from the last one: windows of length one and a straight line."""
    rows = carriers.sparse(spark, sf).withColumn("Data_Value", F.col("Data_Value") / 1000.0)
    _, pred = sequence.forecast(
        rows, ["Data_Value"], settings=SETTINGS.override(seq_length=1), unit=["unit"],
        regressors={"linear_regression": {}}, cut=sinks.table_cut(spark),
    )
    return sequence.evaluate(pred).withColumn("value", F.round("value", 4))


@query()
def panel_analysis(spark, sf):
    """All stages on the survey extract with eight models in full size, importances, sequences
    and five-fold cross-validation; the forests are left out (README, Open)."""
    settings = FULL.override(regressors={"random_forest": None}, classifiers={"random_forest": None})
    result = pipeline.run(spark, carriers.extract(spark, sf), settings=settings, cv=True)
    parts = [
        result.metrics,
        result.sequence_metrics.select(
            F.lit("sequence").alias("track"), "model", "split", "metric", "value"
        ),
        *(
            mean.select(F.lit(track).alias("track"), "model", F.lit("folds").alias("split"), "metric", F.col("mean").alias("value"))
            for track, mean in result.cross_validation.items()
        ),
    ]
    return reduce(DataFrame.unionByName, parts)
