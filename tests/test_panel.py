import logging

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stratline.operators import encode, ordering, panel, quality, targets
from stratline.settings import UNIT_KEY, Settings

BOUNDS = Settings(min_stratum_rows=2, early_warning_min_pairs=2)


@pytest.fixture
def sample(spark):
    none = None
    return spark.createDataFrame(
        [
            ("2015", "OH", "12.5", "11.0", "14.0", "Income", "$15,000 - $24,999", "$15,000 - $24,999", "Male"),
            ("2016", "OH", "13.7", "12.1", "15.2", " Income ", "$35,000 - $49,999", "$35,000 - $49,999", "Female"),
            ("2017", "UT", "N/A", none, none, "Age(years)", "18-24", none, none),
            ("2018", "UT", "21.4", "20.0", "22.9", "Age(years)", "  55-64 ", none, none),
            ("2019", "ME", "44.1", "42.3", "45.8", none, none, none, none),
            ("2020", "ME", "45.0", "43.1", "47.2", "Total", "Total", none, none),
        ],
        "YearStart string, LocationAbbr string, Data_Value string, Low_Confidence_Limit string,"
        "High_Confidence_Limit string, StratificationCategory1 string, Stratification1 string,"
        "Income string, Gender string",
    )


@pytest.fixture
def two_states(spark):
    rows = [
        (s, y, "Total", "Total", "Total", "Total", 20.0 + 3.0 * (y - 2014) + (6.0 if s == "OR" else 0.0), 45.0, 40.0)
        for s in ("GA", "OR")
        for y in range(2014, 2019)
    ]
    return spark.createDataFrame(
        rows,
        "LocationAbbr string, YearStart int, StratificationCategory1 string, Stratification1 string,"
        "stratum_category string, stratum_value string, Data_Value double, High_Confidence_Limit double,"
        "Low_Confidence_Limit double",
    )


# --- cleaning ---------------------------------------------------------------------------


def test_numbers_are_coerced(sample):
    out = encode.coerce_numbers(sample)
    kinds = dict(out.dtypes)
    assert kinds["Data_Value"] == "double" and kinds["YearStart"] == "int"
    assert out.where("YearStart = 2017").first()["Data_Value"] is None


def test_strata_are_trimmed_and_defaulted(sample, spark):
    out = {r["YearStart"]: r for r in encode.standard_strata(sample).collect()}
    assert out["2016"]["stratum_category"] == "Income"
    assert out["2018"]["stratum_value"] == "55-64"
    assert out["2019"]["stratum_category"] == out["2019"]["stratum_value"] == "Total"
    bare = encode.standard_strata(spark.createDataFrame([(2018,)], "YearStart int")).first()
    assert bare["stratum_category"] == bare["stratum_value"] == "Total"


def test_clean_encodes(sample):
    out = encode.clean(sample, Settings(min_stratum_rows=1)).toPandas().set_index("YearStart")
    assert len(out) == 5
    assert out["LocationAbbr_enc"].to_dict() == {2015: 1, 2016: 1, 2018: 2, 2019: 0, 2020: 0}
    assert out.loc[2015, "region"] == "Midwest" and out.loc[2020, "region"] == "Northeast"
    assert out.loc[2015, "income_enc"] < out.loc[2016, "income_enc"]
    assert out.loc[2015, "gender_enc"] == 0 and out.loc[2016, "gender_enc"] == 1
    assert out["income_enc"].isna().sum() == 3


def test_rare_values_collapse(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)] + [("c",)] * 2 + [(None,)], "v string")
    out = encode.collapse_rare(df, "v", min_rows=2).groupBy("v").count().collect()
    assert {r["v"]: r["count"] for r in out} == {"a": 3, "Other": 1, "c": 2, None: 1}


@pytest.mark.parametrize("share", [1000, 2])
def test_label_encoding_often_and_seldom(spark, share):
    df = spark.createDataFrame([("b", "x"), ("a", None), (None, "x"), ("c", "w"), ("b", "w")], "p string, q string")
    out = encode.label_encode(df, ["p", "q", "absent"], share=share).toPandas()
    codes = {(r.p, r.q): (r.p_enc, r.q_enc) for r in out.astype(object).where(out.notna(), None).itertuples()}
    assert codes == {
        ("b", "x"): (1, 1), ("a", None): (0, None), (None, "x"): (None, 1), ("c", "w"): (2, 0), ("b", "w"): (1, 0),
    }


# --- features ---------------------------------------------------------------------------


def test_year_scale(two_states):
    out = panel.year_scale(two_states).toPandas()
    assert out["year_normalized"].min() == 0 and out["year_normalized"].max() == 1
    pa = out[out.LocationAbbr == "GA"].sort_values("YearStart")["year_normalized"]
    assert (pa.diff().dropna() > 0).all()
    one = panel.year_scale(two_states.where("YearStart = 2015")).first()
    assert one["year_normalized"] == 0


def test_ci_width(two_states):
    assert {r[0] for r in panel.ci_width(two_states).select("ci_width").collect()} == {5.0}
    assert panel.ci_width(two_states.drop("Low_Confidence_Limit")).first()["ci_width"] is None


@pytest.mark.parametrize("unique", [True, False])
def test_lags(two_states, unique):
    out = panel.lag_features(two_states, Settings(), unique).toPandas().set_index(["LocationAbbr", "YearStart"])
    assert np.isnan(out.loc[("GA", 2014), "lag_1"]) and np.isnan(out.loc[("OR", 2014), "lag_1"])
    assert out.loc[("GA", 2015), "lag_1"] == 20.0
    assert out.loc[("GA", 2016), "lag_2"] == 20.0
    assert out.loc[("GA", 2015), "rolling_mean_3"] == 20.0
    assert out.loc[("GA", 2016), "rolling_mean_3"] == 21.5
    assert out.loc[("GA", 2016), "trend_1yr"] == 3.0
    assert np.isnan(out.loc[("GA", 2015), "trend_1yr"])


def test_lag_features_without_a_key(spark):
    out = panel.lag_features(spark.createDataFrame([(2018, 1.0)], "YearStart int, Data_Value double")).first()
    assert out["lag_1"] is None and out["rolling_mean_3"] is None and out["trend_1yr"] is None


GAPS = "u string, YearStart int, Data_Value double, flag int"


@pytest.mark.parametrize("unique", [True, False])
def test_lag_is_by_calendar_and_lead_by_observation(spark, unique):
    df = spark.createDataFrame([("a", 2014, 1.0, 0), ("a", 2015, 2.0, 0), ("a", 2017, 3.0, 1)], GAPS)
    lag = {r["YearStart"]: r["lag_1"] for r in panel.calendar_lags(df, ["u"], [1], unique=unique).collect()}
    assert lag == {2014: None, 2015: 1.0, 2017: None}
    out = targets.early_warning(df, ["u"], "flag", unique=unique).collect()
    assert {r["YearStart"]: r["early_warning"] for r in out} == {2014: 0, 2015: 1, 2017: None}


@pytest.mark.parametrize("unique", [True, False])
def test_null_key_parts(spark, unique):
    df = spark.createDataFrame([(None, 2014, 1.0, 0), (None, 2015, 2.0, 1), ("a", None, 5.0, 0)], GAPS)
    for lagged in (panel.calendar_lags(df, ["u"], [1], unique=unique), panel.lag_join(df, ["u"], [1])):
        got = {(r["u"], r["YearStart"]): r["lag_1"] for r in lagged.collect()}
        assert got == {(None, 2014): None, (None, 2015): 1.0, ("a", None): None}
    out = targets.early_warning(df.where("u is null"), ["u"], "flag", unique=unique).collect()
    assert {r["early_warning"] for r in out} == {None}


def test_copies_of_a_key(spark):
    df = spark.createDataFrame([("a", 2014, 1.0, 0), ("a", 2014, 2.0, 0), ("a", 2015, 9.0, 1)], GAPS)
    once = panel.calendar_lags(df, ["u"], [1]).where("YearStart = 2015").collect()
    assert [r["lag_1"] for r in once] == [1.0]
    fanned = panel.lag_join(df, ["u"], [1])
    assert sorted(r["lag_1"] for r in fanned.where("YearStart = 2015").collect()) == [1.0, 2.0]
    size = panel.fan_out_rows(df, ["u"], [1]).agg(F.sum("n_fanned")).first()[0]
    assert size == fanned.count() == 4
    assert not panel.is_unique(df, ["u", "YearStart"]) and panel.is_unique(df, ["Data_Value"])


@pytest.mark.parametrize("slices", [64, 4])
def test_early_warning_with_a_hot_unit_equals_shift(spark, monkeypatch, slices):
    monkeypatch.setattr(ordering, "SLICES", slices)
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"u": np.where(rng.random(120) < 0.6, "hot", "b"), "YearStart": rng.integers(2010, 2014, 120)})
    pdf["Data_Value"] = rng.permutation(120).astype(float)
    pdf["flag"] = (pdf["Data_Value"] > 70).astype(int)
    got = targets.early_warning(spark.createDataFrame(pdf), ["u"], "flag", tie=["Data_Value"]).toPandas()
    ordered = pdf.sort_values(["u", "YearStart", "Data_Value"])
    nxt = ordered.groupby("u")["flag"].shift(-1)
    expected = nxt.where(ordered["flag"] == 0)
    expected.index = ordered["Data_Value"]
    own = got.set_index("Data_Value")["early_warning"].astype(float)
    pd.testing.assert_series_equal(own.sort_index(), expected.sort_index(), check_names=False)


def test_imputation(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, None, None), (3, 4.0, None), (4, 9.0, None)], "a int, b double, c double")
    out = panel.impute_medians(df)
    assert out.where("a = 2").first()["b"] == 4.0
    assert {k for _, k in out.dtypes} == {"double"}
    assert out.where("c is not null").count() == 0
    train = panel.impute_medians(df, ["b"], fit=df.where("a < 3"))
    assert train.where("a = 2").first()["b"] == 1.0


def test_feature_columns_leave_out_identifiers(spark):
    df = spark.createDataFrame(
        [], "YearStart int, LocationAbbr string, stratum_category string, stratum_value string,"
        "lag_1 double, rolling_mean_3 double, region_enc int, Data_Value double",
    )
    assert panel.feature_columns(df, ["Data_Value"]) == ["lag_1", "rolling_mean_3", "region_enc"]


def test_sequences(spark):
    rows = [("u", y, float(v), None if y == 2011 else 1.0) for v, y in enumerate([2010, 2011, 2013, 2014, 2015])]
    rows += [("short", y, 1.0, 1.0) for y in (2010, 2011, 2012)] + [(None, y, 1.0, 1.0) for y in range(2000, 2009)]
    df = spark.createDataFrame(rows, "u string, YearStart int, Data_Value double, x double")
    out = panel.sequences(df, ["Data_Value", "x"], length=3, unit=["u"]).orderBy("target_year").collect()
    assert [(r["u"], r["target_year"], r["target"]) for r in out] == [("u", 2014, 3.0), ("u", 2015, 4.0)]
    assert out[0]["features"] == [[0.0, 1.0], [1.0, None], [2.0, 1.0]]


# --- targets ----------------------------------------------------------------------------


def test_threshold_sees_training_rows_only(two_states):
    train = F.col("YearStart") <= 2017
    out, meta = targets.build(two_states, train, BOUNDS, unique=True)
    assert meta.high_risk_threshold == pytest.approx(29.75)
    assert meta.early_warning_built and meta.n_total_rows == 10
    assert {r[0] for r in out.select("high_risk_obesity").distinct().collect()} == {0, 1}
    assert meta.n_high_risk == out.agg(F.sum("high_risk_obesity")).first()[0]
    record = meta.as_frame(two_states.sparkSession)
    assert set(record.columns) == {
        "high_risk_threshold", "high_risk_percentile", "early_warning_built", "n_total_rows", "n_high_risk",
    }


@pytest.mark.parametrize("unique", [True, False])
def test_early_warning_needs_enough_pairs(two_states, unique):
    train = F.col("YearStart") <= 2017
    out, meta = targets.build(two_states, train, BOUNDS, unique)
    got = {(r["LocationAbbr"], r["YearStart"]): r["early_warning"] for r in out.collect()}
    assert got[("GA", 2014)] == 0 and got[("GA", 2017)] == 1 and got[("GA", 2018)] is None
    assert targets.choose(meta, BOUNDS) == "early_warning"
    few = BOUNDS.override(early_warning_min_pairs=9999)
    out, meta = targets.build(two_states, train, few, unique)
    assert "early_warning" not in out.columns and not meta.early_warning_built
    assert targets.choose(meta, few) == "high_risk_obesity"
    forced = BOUNDS.override(classification_target="high_risk_obesity")
    assert targets.choose(meta, forced) == "high_risk_obesity"
    wanted = few.override(classification_target="early_warning")
    assert targets.choose(meta, wanted) == "high_risk_obesity"


def test_a_missing_value_is_not_high_risk(spark):
    df = spark.createDataFrame([(None,), (5.0,)], "Data_Value double")
    assert [r[1] for r in targets.flag_high_risk(df, F.lit(4.0)).collect()] == [0, 1]


def test_missing_value_column_raises(spark):
    with pytest.raises(ValueError):
        targets.build(spark.range(1))


def test_temporal_split(sample, caplog):
    df = encode.coerce_numbers(sample)
    parts = targets.temporal_split(df)
    years = [{r["YearStart"] for r in p.collect()} for p in parts]
    assert years == [{2015, 2016, 2017}, {2018, 2019}, {2020}]
    with caplog.at_level(logging.WARNING):
        _, _, test = targets.temporal_split(df, Settings(test_min_year=2099))
    assert test.count() == 0 and "empty" in caplog.text


def test_split_rules_differ_between_rows_and_sequences(spark):
    df = spark.createDataFrame([(2017,), (2018,), (2020,), (2021,), (None,)], "y int")
    gap = Settings(val_min_year=2019, val_max_year=2020, test_min_year=2022)
    got = df.select("y", targets.split_name(F.col("y"), gap), targets.sequence_split_name(F.col("y"), gap)).collect()
    assert [tuple(r) for r in got] == [
        (2017, "train", "train"), (2018, None, "val"), (2020, "val", "val"), (2021, None, "test"), (None, None, None),
    ]


def test_join_targets_keeps_both_sides_of_one_unit(spark):
    schema = "YearStart int, LocationAbbr string, StratificationCategory1 string, Stratification1 string"
    left = spark.createDataFrame([(2015, "a", "c", "u1", 3.0), (2015, "a", "c", "u2", 1.0)], f"{schema}, x double")
    right = spark.createDataFrame([(2015, "a", "c", "u2", 1.0), (2015, "a", "c", "u1", 8.0)], f"{schema}, y double")
    out = targets.join_targets(left, right).collect()
    assert [(r["Stratification1"], r["x"], r["y"]) for r in out] == [("u1", 3.0, 8.0)]
    with pytest.raises(ValueError):
        targets.join_targets(left, right.drop("Stratification1"))


@pytest.mark.parametrize("slices", [64, 8])
def test_a_hot_unit_and_year_is_cut(spark, monkeypatch, slices):
    monkeypatch.setattr(ordering, "SLICES", slices)
    rows = [("GA", 2015 + (k % 20 == 0), "Pennsylvania", float(k), k % 2) for k in range(2000)]
    df = spark.createDataFrame(rows, "LocationAbbr string, YearStart int, LocationDesc string, v double, high_risk_obesity int")
    out = targets.early_warning(df, ["LocationAbbr"])
    assert out.columns == [*df.columns, "early_warning"]
    got = {r["v"]: r["early_warning"] for r in out.collect()}
    hashed = df.withColumn("h", F.xxhash64("LocationDesc", "v", "high_risk_obesity")).orderBy("YearStart", "h").collect()
    for row, after in zip(hashed, [*hashed[1:], None]):
        expected = after["high_risk_obesity"] if after and not row["high_risk_obesity"] else None
        assert got[row["v"]] == expected
    hashes = df.withColumn("h", F.xxhash64("LocationDesc", "v", "high_risk_obesity"))
    largest = ordering.sliced(hashes, "h").groupBy("YearStart", "__slice").count().agg(F.max("count")).first()[0]
    assert largest <= 8 * 2000 / slices


def test_join_targets_keeps_one_row_per_key(spark):
    left = spark.createDataFrame([(2015, "a", 3.0), (2015, "a", 1.0), (2016, None, 2.0)], "YearStart int, LocationAbbr string, x double")
    right = spark.createDataFrame([(2015, "a", 7.0), (2015, "a", 8.0), (2016, None, 9.0), (2017, "a", 1.0)], "YearStart int, LocationAbbr string, y double")
    out = targets.join_targets(left, right)
    assert sorted((r["YearStart"], r["LocationAbbr"] or "", r["x"], r["y"]) for r in out.collect()) == [
        (2015, "a", 1.0, 7.0), (2016, "", 2.0, 9.0),
    ]


# --- quality ----------------------------------------------------------------------------


def test_raw_report(sample):
    got = {(r["check"], r["item"]): (r["value"], r["passed"]) for r in quality.check_raw(sample).collect()}
    assert got[("required_columns", None)][1]
    assert got[("data_value_numeric", None)] == (1.0, False)
    assert got[("year_range", "min")] == (2015.0, True)
    assert got[("duplicates", None)] == (0.0, True)
    assert got[("missingness", "Income")] == (4.0, True)


def test_raw_report_on_bad_input(spark):
    df = spark.createDataFrame([("x", "150"), ("x", "150"), (None, "-1")], "YearStart string, Data_Value string")
    checks = quality.check_raw(df)
    got = {(r["check"], r["item"]): (r["value"], r["passed"]) for r in checks.collect()}
    assert got[("required_columns", "LocationAbbr")] == (0.0, False)
    assert got[("data_value_range", None)] == (3.0, False)
    assert got[("year_range", "min")] == (None, False)
    assert got[("duplicates", None)] == (1.0, False)
    assert ("duplicates", None) in quality.enforce(checks)
    with pytest.raises(ValueError):
        quality.enforce(checks, strict=True)


def test_feature_report(spark):
    df = spark.createDataFrame([(1.0, "t"), (float("inf"), None)], "a double, b string")
    got = {(r["check"], r["item"]): (r["value"], r["passed"]) for r in quality.check_features(df, ["a", "z"]).collect()}
    assert got[("no_infinities", None)] == (1.0, False)
    assert got[("all_numeric", "b")][1] is False
    assert got[("null_total", None)] == (1.0, None)
    assert got[("expected_features", "z")][1] is False
    with pytest.raises(ValueError):
        quality.enforce(quality.check_features(df.where("a < 0")))
