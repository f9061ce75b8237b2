import pytest
from pyspark.sql import functions as F

from stratline.plans import pipeline
from stratline.settings import TARGET_CLASS, TARGET_QUESTION, Settings
from stratline.sources import ingest, sinks

STATES = ["AL", "AK", "CT", "IL", "TX", "PR"]
GROUPS = [("Total", "Total"), ("Sex", "Male"), ("Sex", "Female"), ("Income", "Less than $15,000")]
HEADER = (
    "YearStart,LocationAbbr,LocationDesc,Class,Question,Data_Value,Low_Confidence_Limit,"
    "High_Confidence_Limit ,Sample_Size,Sex,Income,StratificationCategory1,Stratification1\n"
)


@pytest.fixture(scope="module")
def csv(tmp_path_factory):
    lines = []
    for i, state in enumerate(STATES):
        for j, (cat, val) in enumerate(GROUPS):
            for year in range(2011, 2025):
                v = 25 + i + 2 * j + 0.4 * (year - 2011) + ((i * 7 + j * 3 + year) % 5) * 0.3
                text = "~" if (state, year) == ("PR", 2017) else f"{v:.1f}"
                cells = [
                    str(year), state, f"State {i}", TARGET_CLASS, TARGET_QUESTION, text,
                    f"{v - 2:.1f}", f"{v + 2 + j:.1f}", "500",
                    val if cat == "Sex" else "", f'"{val}"' if cat == "Income" else "", cat, f'"{val}"',
                ]
                lines.append(",".join(cells))
    lines.append(lines[0])
    lines.append(lines[1].replace(TARGET_CLASS, "Other class"))
    path = tmp_path_factory.mktemp("raw") / "survey.csv"
    path.write_text(HEADER + "\n".join(lines) + "\n")
    return str(path)


SETTINGS = Settings(early_warning_min_pairs=20, permutation_repeats=2, cv_folds=3).override(
    regressors={
        "lasso": None, "xgboost": None, "gradient_boosting": None,
        "random_forest": {"n_estimators": 5, "max_depth": 4},
    },
    classifiers={"xgboost": None, "gradient_boosting": None, "random_forest": None},
)


@pytest.fixture(scope="module")
def result(spark, csv, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("out"))
    return folder, pipeline.run(spark, csv, folder, SETTINGS, cv=True)


def test_tables(result):
    _, out = result
    assert out.interim.count() == 6 * 4 * 14 - 4
    table = out.model.table
    assert table.count() == out.interim.count()
    assert "education_enc" not in out.model.feature_names
    assert out.model.target == "early_warning"
    gap = table.where("LocationAbbr = 'PR' and YearStart in (2016, 2018)").groupBy("YearStart")
    labelled = {r["YearStart"]: r["n"] for r in gap.agg(F.count("early_warning").alias("n")).collect()}
    assert labelled[2016] >= 0
    checks = {(r["check"], r["item"]): r["value"] for r in out.quality.collect()}
    assert checks[("data_value_numeric", None)] == 4 and checks[("duplicates", None)] == 1


def test_metrics_and_importances(result, spark):
    folder, out = result
    found = sinks.metrics_dict(sinks.read_metrics(spark, f"{folder}/metrics").where("track = 'regression'"))
    assert set(found) == {"linear_regression", "ridge", "random_forest"}
    assert set(found["ridge"]) == {f"{s}_{m}" for s in ("val", "test") for m in ("mae", "mse", "rmse", "r2")}
    assert found["linear_regression"]["val_r2"] > 0.8
    tracks = {(r["track"], r["model"]) for r in out.metrics.select("track", "model").distinct().collect()}
    assert ("classification", "logistic_regression") in tracks
    kinds = {r["kind"] for r in out.importances.select("kind").distinct().collect()}
    assert kinds == {"tree", "coefficient", "permutation"}
    assert out.importances.where("rank = 1").count() >= 4
    assert {r["metric"] for r in out.cross_validation["regression"].collect()} == {"mae", "r2"}
    assert out.sequence_metrics.where("metric = 'r2' and split = 'test'").first()["value"] > 0.5


def test_saved_models_and_tests_on_the_interim_table(result, spark):
    folder, out = result
    model = sinks.load_model(f"{folder}/models", "regression", "ridge")
    assert model.transform(out.model.table).where("prediction is null").count() == 0
    tests = pipeline.impact(spark, f"{folder}/tables/interim.parquet")
    assert {"anova_stratum", "ttest_gender", "income_correlation"} <= set(tests)
    assert tests["anova_stratum"].first()["f_stat"] > 0
    with pytest.raises(FileNotFoundError):
        ingest.read_table(spark, f"{folder}/tables/none.parquet")


def test_single_track_and_bad_arguments(spark, csv):
    few = SETTINGS.override(early_warning_min_pairs=10**6, run_permutation=False)
    out = pipeline.run(spark, csv, settings=few, track="classification")
    assert out.model.target == "high_risk_obesity" and set(out.fitted) == {"classification"}
    assert out.sequence_metrics is None
    with pytest.raises(ValueError):
        pipeline.run(spark, csv, track="nope")
    with pytest.raises(ValueError):
        pipeline.run(spark, csv, settings=SETTINGS.override(target_class="absent"))


def test_copies_of_a_unit_year_give_one_row_each(spark, csv):
    raw = ingest.read_raw(spark, csv)
    twice = raw.unionByName(raw.where("LocationAbbr = 'AL'").withColumn("Sample_Size", F.lit("7")))
    cut = sinks.table_cut(spark)
    clean = pipeline.clean_stage(
        ingest.select_indicator(twice, TARGET_CLASS, TARGET_QUESTION), SETTINGS, cut
    )
    model = pipeline.model_table(clean, SETTINGS, cut)
    assert model.table.count() == 6 * 4 * 14 - 4
    assert model.metadata.n_total_rows == model.table.count() + 4 * 14
