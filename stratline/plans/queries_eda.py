"""Exploration, metrics and hypothesis-test queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from stratline.functions.lookups import EDUCATION_RANK, INCOME_RANK
from stratline.models import training
from stratline.operators import eda, metrics, ordering, stats, targets
from stratline.plans import carriers
from stratline.plans.carriers import LABELLED_SQL, SETTINGS, SPARSE_SQL, table
from stratline.plans.queries_ingest import PREPARED_SQL, prepared, prepared_table
from stratline.plans.queries_panel import LAGGED_SQL, SPLIT_SQL, lagged
from stratline.plans.registry import query


def rounded(df, *names):
    """Sums of doubles depend on the order of the rows in the last digits."""
    return df.withColumns({c: F.round(c, 6) for c in names})


def _round_sql(*names):
    return ", ".join(f"round({c}, 6) AS {c}" for c in names)


# --- group summaries -----------------------------------------------------------------


@query(f"""WITH {PREPARED_SQL}, m AS (SELECT "LocationDesc", avg("Data_Value") AS mean FROM prepared
WHERE "YearStart" = (SELECT max("YearStart") FROM prepared) GROUP BY 1)
SELECT "LocationDesc", round(mean, 6) AS mean FROM m WHERE mean IS NOT NULL
ORDER BY m.mean DESC, "LocationDesc" LIMIT 15""")
def top_locations_latest_year(spark, sf):
    latest = eda.latest_year(prepared_table(spark, sf))
    means = eda.group_mean(latest, ["LocationDesc"], "Data_Value")
    return rounded(eda.top_k(means, "mean", 15, tie="LocationDesc"), "mean")


@query(f"""WITH {SPARSE_SQL} SELECT unit, round(avg("Data_Value"), 6) AS mean FROM sparse GROUP BY 1""")
def group_means(spark, sf):
    return rounded(eda.group_mean(carriers.sparse(spark, sf), ["unit"], "Data_Value"), "mean")


@query(f"""WITH {PREPARED_SQL} SELECT "YearStart", "Income", round(avg("Data_Value"), 6) AS mean
FROM prepared WHERE "Income" IS NOT NULL GROUP BY 1, 2""")
def income_trend(spark, sf):
    return rounded(eda.group_mean(prepared(spark, sf), ["YearStart", "Income"], "Data_Value"), "mean")


@query(f"""WITH {SPARSE_SQL}, m AS (SELECT "YearStart", avg("Data_Value") AS mean,
  stddev_samp("Data_Value") AS std FROM sparse GROUP BY 1)
SELECT "YearStart", round(mean, 6) AS mean, round(std, 6) AS std,
  round(mean - std, 6) AS band_low, round(mean + std, 6) AS band_high FROM m""")
def yearly_band(spark, sf):
    band = eda.mean_band(carriers.sparse(spark, sf), "YearStart", "Data_Value")
    return rounded(band, "mean", "std", "band_low", "band_high")


@query(f"""WITH {PREPARED_SQL}, m AS (
  SELECT stratum_category, avg("Data_Value") AS mean FROM prepared GROUP BY 1)
SELECT stratum_category, round(mean, 6) AS mean,
  round((SELECT avg(mean) FROM m), 6) AS mean_of_means FROM m""")
def stratum_means(spark, sf):
    out = eda.mean_of_group_means(prepared_table(spark, sf), "stratum_category", "Data_Value")
    return rounded(out, "mean", "mean_of_means")


@query("""SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25""")
def top_orders(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return eda.top_k(orders, "o_totalprice", 25, tie="o_orderkey")


@query("""SELECT count(l_extendedprice) AS count, round(avg(l_extendedprice), 6) AS mean,
  round(stddev_samp(l_extendedprice), 6) AS std, min(l_extendedprice) AS min,
  round(quantile_cont(l_extendedprice, 0.25), 6) AS q25,
  round(quantile_cont(l_extendedprice, 0.5), 6) AS q50,
  round(quantile_cont(l_extendedprice, 0.75), 6) AS q75, max(l_extendedprice) AS max FROM lineitem""")
def describe_prices(spark, sf):
    out = eda.describe(table(spark, sf, "lineitem"), "l_extendedprice")
    return rounded(out, "mean", "std", "q25", "q50", "q75")


def _histogram_sql(tab, value, bins):
    return f"""WITH span AS (SELECT min({value}) AS lo, max({value}) AS hi,
    (max({value}) - min({value})) / {bins} AS w FROM {tab}),
  counted AS (SELECT CAST(least(floor(({value} - lo) / w), {bins - 1}) AS INTEGER) AS bin,
    count(*) AS n FROM {tab}, span WHERE {value} IS NOT NULL GROUP BY 1)
  SELECT CAST(b.bin AS INTEGER) AS bin, round(lo + b.bin * w, 6) AS bin_low,
    round(lo + (b.bin + 1) * w, 6) AS bin_high, coalesce(c.n, 0) AS n
  FROM generate_series(0, {bins - 1}) AS b(bin) CROSS JOIN span LEFT JOIN counted c ON c.bin = b.bin"""


@query(_histogram_sql("lineitem", "l_extendedprice", 30))
def histogram_30(spark, sf):
    out = eda.histogram(table(spark, sf, "lineitem"), "l_extendedprice", 30)
    return rounded(out, "bin_low", "bin_high")


@query(_histogram_sql("events", "value", 45))
def histogram_45(spark, sf):
    return rounded(eda.histogram(table(spark, sf, "events"), "value", 45), "bin_low", "bin_high")


BOX_SQL = """
quarters AS (SELECT event_type, count(value) AS n, quantile_cont(value, 0.25) AS q25,
  quantile_cont(value, 0.5) AS q50, quantile_cont(value, 0.75) AS q75
  FROM events WHERE event_type IS NOT NULL GROUP BY 1),
fenced AS (SELECT e.event_id, e.event_type, value, q.* EXCLUDE (event_type),
  value >= q25 - 1.5 * (q75 - q25) AND value <= q75 + 1.5 * (q75 - q25) AS inside
  FROM events e JOIN quarters q ON e.event_type = q.event_type)"""


@query(f"""WITH {BOX_SQL} SELECT event_type, max(n) AS n, round(max(q25), 6) AS q25,
  round(max(q50), 6) AS q50, round(max(q75), 6) AS q75,
  least(min(value) FILTER (WHERE inside), max(q25)) AS whisker_low,
  greatest(max(value) FILTER (WHERE inside), max(q75)) AS whisker_high,
  count(*) FILTER (WHERE NOT inside) AS n_outliers FROM fenced GROUP BY 1""")
def box_plot(spark, sf):
    out = eda.box_plot(table(spark, sf, "events"), "event_type", "value")
    return rounded(out, "q25", "q50", "q75")


@query(f"WITH {BOX_SQL} SELECT event_id, event_type, value FROM fenced WHERE NOT inside")
def box_outliers(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    return eda.box_outliers(events, "event_type", "value")


@query(f"""WITH {SPARSE_SQL}, fits AS (
  SELECT unit, count("Data_Value") AS n_years, regr_slope("Data_Value", "YearStart") AS slope,
    avg("YearStart") AS my, avg("Data_Value") AS mv FROM sparse GROUP BY 1
  HAVING count(DISTINCT "YearStart") > 1)
SELECT unit, n_years, round(slope, 4) AS slope, round(mv + slope * (2005 - my), 4) AS projected
FROM fits ORDER BY mv + slope * (2005 - my) DESC, unit LIMIT 10""")
def hotspots(spark, sf):
    out = eda.hotspots(carriers.sparse(spark, sf), ["unit"], "Data_Value", target_year=2005)
    return out.withColumns({c: F.round(c, 4) for c in ("slope", "projected")})


# --- ranks and class balance ----------------------------------------------------------


@query("""WITH c AS (SELECT value, count(*) AS n FROM events WHERE value IS NOT NULL GROUP BY 1)
SELECT value, n, sum(n) OVER (ORDER BY value) - n + CAST(n + 1 AS DOUBLE) / 2 AS avg_rank FROM c""")
def average_tie_ranks(spark, sf):
    return ordering.average_ranks(table(spark, sf, "events"), "value")


@query("""WITH n AS (SELECT quality AS y, count(*) AS n_class FROM labels GROUP BY 1)
SELECT doc_id, quality AS y,
  CAST((SELECT count(*) FROM labels) AS DOUBLE) / (2 * n_class) AS weight
FROM labels JOIN n ON quality = y""")
def balanced_class_weights(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("y"))
    return training.balanced_weights(labels, "y")


# --- metrics --------------------------------------------------------------------------

LAST_VALUE_SQL = f"""{LAGGED_SQL},
guess AS (SELECT {SPLIT_SQL} AS split, "Data_Value" AS y, lag_1 AS prediction FROM lagged
  WHERE lag_1 IS NOT NULL)"""


def last_value_forecast(spark, sf):
    """The previous year's value as a forecast of this year's."""
    return (
        lagged(spark, sf)
        .where(F.col("lag_1").isNotNull())
        .select(
            targets.split_name(F.col("YearStart"), SETTINGS).alias("split"),
            F.col("Data_Value").alias("y"),
            F.col("lag_1").alias("prediction"),
        )
    )


@query(f"""WITH {LAST_VALUE_SQL}, s AS (SELECT split, count(*) AS n, avg(abs(y - prediction)) AS mae,
  avg((y - prediction) * (y - prediction)) AS mse, var_pop(y) AS v FROM guess GROUP BY 1)
SELECT split, n, round(mae, 4) AS mae, round(mse / 1e6, 4) AS mse, round(sqrt(mse), 4) AS rmse,
  CASE WHEN n > 1 THEN round(1 - mse / nullif(v, 0), 6) END AS r2 FROM s""")
def regression_metrics(spark, sf):
    out = metrics.regression(last_value_forecast(spark, sf), ["split"])
    return out.select(
        "split", "n", F.round("mae", 4).alias("mae"), F.round(F.col("mse") / 1e6, 4).alias("mse"),
        F.round("rmse", 4).alias("rmse"), F.round("r2", 6).alias("r2"),
    )


@query(f"""WITH {LAST_VALUE_SQL} SELECT y AS actual, prediction AS predicted FROM guess
WHERE split = 'test'""")
def actual_vs_predicted(spark, sf):
    pred = last_value_forecast(spark, sf).where(F.col("split") == "test")
    return pred.select(F.col("y").alias("actual"), F.col("prediction").alias("predicted"))


COUNTS_SQL = f"""{LABELLED_SQL},
k AS (SELECT lang, count(*) FILTER (WHERE y = 1 AND prediction = 1) AS tp,
  count(*) FILTER (WHERE y = 0 AND prediction = 1) AS fp,
  count(*) FILTER (WHERE y = 1 AND prediction = 0) AS fn,
  count(*) FILTER (WHERE y = 0 AND prediction = 0) AS tn FROM labelled GROUP BY 1)"""
SCORES_SQL = f"""{COUNTS_SQL},
scores AS (SELECT lang, tp + fp + fn + tn AS n,
  coalesce(CAST(tp + tn AS DOUBLE) / nullif(tp + fp + fn + tn, 0), 0) AS accuracy,
  coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0) AS precision,
  coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0) AS recall,
  coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0) AS f1,
  coalesce((coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0) * (tp + fn)
    + coalesce(CAST(2 * tn AS DOUBLE) / nullif(2 * tn + fp + fn, 0), 0) * (tn + fp))
    / nullif(tp + fp + fn + tn, 0), 0) AS weighted_f1 FROM k)"""


@query(f"""WITH {SCORES_SQL} SELECT lang, n,
  {_round_sql('accuracy', 'precision', 'recall', 'f1', 'weighted_f1')} FROM scores""")
def classification_metrics(spark, sf):
    out = metrics.classification(carriers.labelled_documents(spark, sf), ["lang"])
    return rounded(out, "accuracy", "precision", "recall", "f1", "weighted_f1")


_GRID = " UNION ALL ".join(
    f"SELECT lang, {a} AS actual, {p} AS predicted, {c} AS n FROM k"
    for a, p, c in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))
)


@query(f"WITH {COUNTS_SQL} {_GRID}")
def confusion_matrix(spark, sf):
    return metrics.confusion_matrix(carriers.labelled_documents(spark, sf), ["lang"])


STEPS_SQL = f"""{LABELLED_SQL},
cells AS (SELECT lang, score, count(*) FILTER (WHERE y = 1) AS pos,
  count(*) FILTER (WHERE y = 0) AS neg FROM labelled GROUP BY 1, 2),
steps AS (SELECT *, CAST(sum(pos) OVER w AS DOUBLE) AS tp, CAST(sum(neg) OVER w AS DOUBLE) AS fp,
  sum(pos) OVER (PARTITION BY lang) AS p, sum(neg) OVER (PARTITION BY lang) AS q
  FROM cells WINDOW w AS (PARTITION BY lang ORDER BY score DESC))"""


@query(f"""WITH {STEPS_SQL}
SELECT lang, score AS threshold, fp / nullif(q, 0) AS fpr, tp / nullif(p, 0) AS tpr FROM steps
UNION ALL SELECT DISTINCT lang, CAST('infinity' AS DOUBLE), CAST(0 AS DOUBLE) / nullif(q, 0),
  CAST(0 AS DOUBLE) / nullif(p, 0) FROM steps""")
def roc_points(spark, sf):
    return metrics.roc_points(carriers.labelled_documents(spark, sf), ["lang"])


@query(f"""WITH {STEPS_SQL} SELECT lang,
  round(sum(neg * (tp - pos + CAST(pos AS DOUBLE) / 2)) / nullif(CAST(max(p) AS DOUBLE) * max(q), 0), 6)
  AS roc_auc FROM steps GROUP BY 1""")
def roc_auc(spark, sf):
    out = metrics.roc_auc(carriers.labelled_documents(spark, sf), ["lang"])
    return rounded(out, "roc_auc")


_BOARD = ["all_accuracy", "all_f1", "all_recall"]


@query(f"""WITH {SCORES_SQL}, wide AS (SELECT lang AS model, accuracy AS all_accuracy, f1 AS all_f1,
  recall AS all_recall FROM scores)
SELECT model, {_round_sql(*_BOARD)},
  {', '.join(f'{c} = (SELECT max({c}) FROM wide) AS best_{c}' for c in _BOARD)} FROM wide""")
def leaderboard(spark, sf):
    wide = metrics.classification(carriers.labelled_documents(spark, sf), ["lang"])
    long = metrics.to_long(wide, ["lang"], metrics.CLASSIFICATION).select(
        F.col("lang").alias("model"), F.lit("all").alias("split"), "metric", "value"
    )
    return rounded(eda.leaderboard(long, _BOARD, sort_by="all_f1"), *_BOARD)


# --- hypothesis tests -----------------------------------------------------------------

MOMENTS_SQL = """
g AS (SELECT event_type AS grp, count(value) AS n, avg(value) AS mean,
  var_pop(value) * count(value) AS ss FROM events WHERE event_type IS NOT NULL GROUP BY 1),
w AS (SELECT sum(n) AS total, sum(ss) AS ssw, count(*) AS k, sum(n * mean) / sum(n) AS grand FROM g)"""


@query(f"""WITH {MOMENTS_SQL}
SELECT round((sum(n * (mean - grand) * (mean - grand)) / (max(k) - 1))
    / (max(ssw) / (max(total) - max(k))), 6) AS f_stat,
  CAST(max(k) - 1 AS BIGINT) AS df_between, CAST(max(total) - max(k) AS BIGINT) AS df_within
FROM g, w""")
def anova(spark, sf):
    out = stats.anova(table(spark, sf, "events"), "event_type", "value")
    return rounded(out, "f_stat").select("f_stat", "df_between", "df_within")


@query(f"""WITH {MOMENTS_SQL}
SELECT a.grp AS group1, b.grp AS group2, round(b.mean - a.mean, 6) AS meandiff,
  round(sqrt(ssw / (total - k) / 2 * (CAST(1 AS DOUBLE) / a.n + CAST(1 AS DOUBLE) / b.n)), 6) AS std_err,
  CAST(k AS BIGINT) AS k, CAST(total - k AS BIGINT) AS df_within
FROM g a JOIN g b ON a.grp < b.grp, w""")
def tukey_contrasts(spark, sf):
    out = stats.tukey_contrasts(table(spark, sf, "events"), "event_type", "value")
    return rounded(out, "meandiff", "std_err")


@query("""WITH s AS (SELECT count(value) FILTER (WHERE event_type = 'click') AS n1,
  count(value) FILTER (WHERE event_type = 'view') AS n2,
  avg(value) FILTER (WHERE event_type = 'click') AS mean1,
  avg(value) FILTER (WHERE event_type = 'view') AS mean2,
  var_samp(value) FILTER (WHERE event_type = 'click') AS v1,
  var_samp(value) FILTER (WHERE event_type = 'view') AS v2 FROM events)
SELECT n1, n2, round(mean1, 6) AS mean1, round(mean2, 6) AS mean2,
  round((mean1 - mean2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2)
    * (CAST(1 AS DOUBLE) / n1 + CAST(1 AS DOUBLE) / n2)), 6) AS t_stat FROM s""")
def t_test(spark, sf):
    out = stats.t_test(table(spark, sf, "events"), "event_type", "value", "click", "view")
    return rounded(out, "mean1", "mean2", "t_stat").select("n1", "n2", "mean1", "mean2", "t_stat")


def _spearman_sql(category, levels):
    arms = " ".join(f"WHEN '{k}' THEN {v}" for k, v in levels.items())
    return f"""WITH {PREPARED_SQL},
    rows_ AS (SELECT * FROM (SELECT CASE stratum_value {arms} END AS x, "Data_Value" AS y
      FROM prepared WHERE stratum_category = '{category}') WHERE x IS NOT NULL),
    ranked AS (SELECT rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx,
      rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry FROM rows_)
    SELECT count(*) AS n, CASE WHEN NOT isnan(corr(rx, ry)) THEN round(corr(rx, ry), 6) END AS rho
    FROM ranked"""


def _spearman(spark, sf, category, levels):
    rows = stats.ranked_stratum(prepared_table(spark, sf), category, levels, "level")
    return rounded(stats.spearman(rows, "level", "Data_Value"), "rho").select("n", "rho")


@query(_spearman_sql("Income", INCOME_RANK))
def spearman_income(spark, sf):
    return _spearman(spark, sf, "Income", INCOME_RANK)


@query(_spearman_sql("Education", EDUCATION_RANK))
def spearman_education(spark, sf):
    return _spearman(spark, sf, "Education", EDUCATION_RANK)


@query("""WITH r AS (
  SELECT rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0 AS rx,
    rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0
    AS ry FROM lineitem)
SELECT count(*) AS n, round(corr(rx, ry), 6) AS rho FROM r""")
def spearman_line_items(spark, sf):
    out = stats.spearman(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice")
    return rounded(out, "rho").select("n", "rho")


@query()
def statistical_impact(spark, sf):
    """All tests on the survey panel, with their p-values, as (test, measure, value)."""

    def long(name, df):
        numbers = [c for c, kind in df.dtypes if kind in ("double", "bigint", "boolean")]
        names = [c for c, kind in df.dtypes if kind == "string"]
        label = F.concat_ws(" - ", F.lit(name), *names)
        pairs = F.array(
            *[
                F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value"))
                for c in numbers
            ]
        )
        return df.select(label.alias("test"), F.explode(pairs).alias("p")).select("test", "p.*")

    tests = stats.impact(prepared_table(spark, sf))
    return reduce(lambda a, b: a.unionByName(b), [long(n, d) for n, d in tests.items()])
