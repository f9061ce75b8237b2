import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stratline.functions import distributions as dist
from stratline.functions.lookups import EDUCATION_RANK, INCOME_RANK, REGION_OF
from stratline.operators import eda, metrics, ordering, stats


# --- tail probabilities against published values -----------------------------------------


@pytest.mark.parametrize("k, df, q", [(3, 10, 3.877), (3, 20, 3.578), (6, 19072, 4.030), (3, 2, 8.331), (10, 60, 4.646)])
def test_studentized_range_table(k, df, q):
    assert dist.studentized_range_quantile(0.95, k, df) == pytest.approx(q, abs=2e-3)
    assert dist.studentized_range_tail(q, k, df) == pytest.approx(0.05, abs=2e-4)


def test_two_groups_agree_with_t():
    # The range of two means is |t| * sqrt(2).
    for t, df in ((0.5, 7), (2.0, 30), (3.5, 1000)):
        assert dist.studentized_range_tail(t * math.sqrt(2), 2, df) == pytest.approx(
            dist.t_two_sided(t, df), rel=1e-5
        )


def test_far_tails():
    assert dist.f_tail(23.762036269946176, 5, 19072) == pytest.approx(6.680070329123682e-24, rel=1e-9)
    assert dist.t_two_sided(2.228138852, 10) == pytest.approx(0.05, abs=1e-9)
    assert 0 < dist.correlation_p(-0.5198, 3000) < 1e-200
    assert dist.correlation_p(1.0, 10) == 0 and math.isnan(dist.correlation_p(0.5, 2))
    assert dist.f_tail(0.0, 2, 5) == 1.0 and dist.f_tail(math.inf, 2, 5) == 0.0


def test_published_pairwise_limits():
    # Half width over the critical value is the standard error, for pairs of equal size.
    half = (1.3281 - 0.3310) / 2
    q = 0.8295 / (half / dist.studentized_range_quantile(0.95, 6, 19072))
    assert dist.studentized_range_tail(q, 6, 19072) < 5e-5
    half = (0.588 - -0.3281) / 2
    q = 0.13 / (half / dist.studentized_range_quantile(0.95, 6, 19072))
    assert dist.studentized_range_tail(q, 6, 19072) == pytest.approx(0.9661, abs=2e-3)


# --- tests ---------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def survey(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(600):
        cat = ["Sex", "Income", "Education", "Total"][i % 4]
        level = {
            "Sex": ["Male", "Female"],
            "Income": [*INCOME_RANK, "Data not reported"],
            "Education": [*EDUCATION_RANK, "Data not reported"],
            "Total": ["Total"],
        }[cat]
        pick = int(rng.integers(len(level)))
        rows.append((cat, level[pick], round(30 - 1.2 * pick + float(rng.normal(0, 3)), 1)))
    pdf = pd.DataFrame(rows, columns=["stratum_category", "stratum_value", "Data_Value"])
    return pdf, spark.createDataFrame(pdf)


def test_anova(survey):
    pdf, df = survey
    groups = [g["Data_Value"].to_numpy() for _, g in pdf.groupby("stratum_category")]
    grand = pdf["Data_Value"].mean()
    ssb = sum(len(g) * (g.mean() - grand) ** 2 for g in groups)
    ssw = sum(((g - g.mean()) ** 2).sum() for g in groups)
    got = stats.anova(df, "stratum_category", "Data_Value").first()
    assert got["f_stat"] == pytest.approx((ssb / 3) / (ssw / 596), rel=1e-9)
    assert got["p_value"] == pytest.approx(dist.f_tail(got["f_stat"], 3, 596))
    assert got["significant"] == (got["p_value"] < 0.05)


def test_tukey(survey):
    pdf, df = survey
    got = stats.tukey_hsd(df, "stratum_category", "Data_Value").toPandas()
    means = pdf.groupby("stratum_category")["Data_Value"].mean()
    assert len(got) == 6 and (got.group1 < got.group2).all()
    for r in got.itertuples():
        assert r.meandiff == pytest.approx(means[r.group2] - means[r.group1])
        assert r.lower < r.meandiff < r.upper
        assert r.reject == (r.p_adj < 0.05) == (not r.lower <= 0 <= r.upper)


def test_impact_runs_what_applies(survey):
    pdf, df = survey
    tests = stats.impact(df)
    assert set(tests) == {
        "anova_stratum", "tukey_stratum", "ttest_gender", "income_correlation", "education_correlation",
    }
    income = pdf[(pdf.stratum_category == "Income") & pdf.stratum_value.isin(list(INCOME_RANK))]
    x = income.stratum_value.map(INCOME_RANK)
    expected = x.rank().corr(income["Data_Value"].rank())
    got = tests["income_correlation"].first()
    assert got["rho"] == pytest.approx(expected, abs=1e-12) and got["n"] == len(income)
    assert got["p_value"] == pytest.approx(dist.correlation_p(expected, len(income)), rel=1e-6)
    male = pdf[pdf.stratum_value == "Male"]["Data_Value"]
    female = pdf[pdf.stratum_value == "Female"]["Data_Value"]
    n1, n2 = len(male), len(female)
    pooled = ((n1 - 1) * male.var() + (n2 - 1) * female.var()) / (n1 + n2 - 2)
    t = (male.mean() - female.mean()) / math.sqrt(pooled * (1 / n1 + 1 / n2))
    got = tests["ttest_gender"].first()
    assert (got["t_stat"], got["mean1"]) == pytest.approx((t, male.mean()))
    assert set(stats.impact(df.where("stratum_category = 'Total'"))) == {"anova_stratum", "tukey_stratum"}


@pytest.mark.parametrize("slices", [64, 3])
def test_spearman_with_ties_and_slices(spark, monkeypatch, slices):
    monkeypatch.setattr(ordering, "SLICES", slices)
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({"x": rng.integers(0, 5, 200), "y": rng.integers(0, 30, 200) / 2.0})
    got = stats.spearman(spark.createDataFrame(pdf), "x", "y").first()
    assert got["rho"] == pytest.approx(pdf.x.rank().corr(pdf.y.rank()), abs=1e-12)


# --- metrics -------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame({"y": rng.integers(0, 2, 150), "score": rng.integers(0, 12, 150) / 11.0})
    pdf["prediction"] = (pdf.score > 0.5).astype(int)
    return pdf, spark.createDataFrame(pdf)


@pytest.mark.parametrize("slices", [64, 3])
def test_auc_counts_ties_as_half(scored, monkeypatch, slices):
    monkeypatch.setattr(ordering, "SLICES", slices)
    pdf, df = scored
    pos, neg = pdf[pdf.y == 1].score.to_numpy(), pdf[pdf.y == 0].score.to_numpy()
    pairs = pos[:, None] - neg[None, :]
    expected = ((pairs > 0) + 0.5 * (pairs == 0)).mean()
    assert metrics.roc_auc(df).first()["roc_auc"] == pytest.approx(expected, abs=1e-12)
    curve = metrics.roc_points(df).toPandas().sort_values("threshold", ascending=False)
    assert len(curve) == pdf.score.nunique() + 1
    assert tuple(curve.iloc[0][["threshold", "fpr", "tpr"]]) == (math.inf, 0.0, 0.0)
    trapezoids = (curve.fpr.diff() * (curve.tpr + curve.tpr.shift()) / 2).sum()
    assert trapezoids == pytest.approx(expected, abs=1e-12)
    assert (curve.tpr.iloc[-1], curve.fpr.iloc[-1]) == (1.0, 1.0)
    first = pdf[pdf.score == pdf.score.max()]
    assert curve.tpr.iloc[1] == pytest.approx((first.y == 1).sum() / len(pos))


def test_classification_counts(scored):
    pdf, df = scored
    tp = ((pdf.y == 1) & (pdf.prediction == 1)).sum()
    got = metrics.classification(df).first()
    assert got["precision"] == pytest.approx(tp / pdf.prediction.sum())
    assert got["recall"] == pytest.approx(tp / pdf.y.sum())
    assert got["f1"] == pytest.approx(2 * tp / (pdf.prediction.sum() + pdf.y.sum()))
    assert got["accuracy"] == pytest.approx((pdf.y == pdf.prediction).mean())
    cells = {(r["actual"], r["predicted"]): r["n"] for r in metrics.confusion_matrix(df).collect()}
    assert cells[(1, 1)] == tp and sum(cells.values()) == 150 and len(cells) == 4


def test_one_class_and_zero_division(spark):
    df = spark.createDataFrame([(0, 0.2, 0), (0, 0.4, 0), (None, 0.9, 1)], "y int, score double, prediction int")
    got = metrics.classification(df).first()
    assert (got["n"], got["accuracy"], got["precision"], got["recall"], got["f1"]) == (2, 1.0, 0, 0, 0)
    assert got["weighted_f1"] == 1.0
    assert metrics.roc_auc(df).first()["roc_auc"] is None
    assert metrics.roc_auc(df, one_class=0.5).first()["roc_auc"] == 0.5
    cells = {(r["actual"], r["predicted"]): r["n"] for r in metrics.confusion_matrix(df).collect()}
    assert cells == {(0, 0): 2, (0, 1): 0, (1, 0): 0, (1, 1): 0}


def test_regression_metrics(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"y": rng.normal(0, 3, 50)})
    pdf["prediction"] = pdf.y + rng.normal(0, 1, 50)
    got = metrics.regression(spark.createDataFrame(pdf)).first()
    error = pdf.y - pdf.prediction
    assert got["mae"] == pytest.approx(error.abs().mean())
    assert got["rmse"] == pytest.approx(math.sqrt((error**2).mean()))
    assert got["r2"] == pytest.approx(1 - (error**2).sum() / ((pdf.y - pdf.y.mean()) ** 2).sum())
    constant = spark.createDataFrame([(1.0, 2.0), (1.0, 1.0)], "y double, prediction double")
    assert metrics.regression(constant).first()["r2"] == 0.0
    assert metrics.regression(constant.where("prediction = 1")).first()["r2"] is None
    exact = constant.selectExpr("y", "y as prediction")
    assert metrics.regression(exact).first()["r2"] == 1.0


# --- exploration ---------------------------------------------------------------------------


def test_describe_and_histogram_equal_numpy(spark):
    values = np.random.default_rng(9).normal(30, 5, 500).round(2)
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    got = eda.describe(df, "v").first().asDict()
    expected = pd.Series(values).describe()
    assert [got[c] for c in ("count", "mean", "std", "min", "q25", "q50", "q75", "max")] == pytest.approx(
        [expected[c] for c in ("count", "mean", "std", "min", "25%", "50%", "75%", "max")]
    )
    bins = eda.histogram(df, "v", 30).orderBy("bin").toPandas()
    assert bins["n"].sum() == 500 and len(bins) == 30
    assert np.abs(bins["n"].to_numpy() - np.histogram(values, 30)[0]).sum() <= 2
    same = eda.histogram(spark.createDataFrame([(1.0,), (1.0,)], "v double"), "v", 3).orderBy("bin")
    assert [r["n"] for r in same.collect()] == [2, 0, 0]


def test_box_plot(spark):
    rows = [("a", float(v)) for v in (1, 2, 3, 4, 5, 100)] + [("b", 7.0), (None, 1.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: r for r in eda.box_plot(df, "g", "v").collect()}
    assert set(got) == {"a", "b"}
    assert (got["a"]["whisker_low"], got["a"]["whisker_high"], got["a"]["n_outliers"]) == (1.0, 5.0, 1)
    assert got["b"]["q25"] == got["b"]["whisker_high"] == 7.0
    assert [r["v"] for r in eda.box_outliers(df, "g", "v").collect()] == [100.0]


def test_means_and_leaderboard(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 10.0), (None, 99.0), ("c", None)], "k string, v double")
    assert {r["k"]: r["mean"] for r in eda.group_mean(df, ["k"], "v").collect()} == {"a": 2.0, "b": 10.0}
    assert {r["mean_of_means"] for r in eda.mean_of_group_means(df, "k", "v").collect()} == {6.0}
    long = spark.createDataFrame(
        [("m1", "val", "r2", 0.7), ("m2", "val", "r2", 0.9), ("m1", "test", "r2", 0.6), ("m2", "test", "r2", 0.5)],
        "model string, split string, metric string, value double",
    )
    board = eda.leaderboard(long, ["val_r2", "test_r2"], "test_r2").collect()
    assert [r["model"] for r in board] == ["m1", "m2"]
    assert [(r["best_val_r2"], r["best_test_r2"]) for r in board] == [(False, True), (True, False)]


def test_text_search_and_profiles(spark):
    df = spark.createDataFrame([("Obese", None), (None, "x"), ("y", "OBESITY")], "a string, b string")
    assert df.where(eda.any_text_matches(df, "obes")).count() == 2
    few = {r["column_name"]: r for r in eda.low_cardinality(df, limit=3).collect()}
    assert few["a"]["first_values"] == ["Obese", "y"] and few["b"]["n_distinct"] == 2


def test_hotspots(spark):
    rows = [("up", y, 10.0 + 2 * (y - 2015)) for y in range(2015, 2020)]
    rows += [("flat", y, 15.0) for y in range(2015, 2020)] + [("once", 2015, 99.0)]
    df = spark.createDataFrame(rows, "u string, YearStart int, v double")
    got = eda.hotspots(df, ["u"], "v").collect()
    assert [(r["u"], round(r["projected"], 6)) for r in got] == [("up", 34.0), ("flat", 15.0)]


def test_regions_cover_all_states():
    assert len(REGION_OF) == 57 and REGION_OF["DC"] == "South" and REGION_OF["US"] == "National"


def test_latest_year(spark):
    df = spark.createDataFrame([(2015,), (2017,), (2017,), (None,)], "YearStart int")
    assert eda.latest_year(df).count() == 2
    assert eda.top_k(df.select(F.col("YearStart").alias("y"), F.col("YearStart").alias("t")), "y", 1, "t").first()["y"] == 2017
