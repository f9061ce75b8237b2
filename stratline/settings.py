"""Parameters of a panel job, as one immutable record."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, replace

# Column names, indicator texts and defaults of the survey extract.
KEEP_COLUMNS = (
    "YearStart",
    "LocationAbbr",
    "LocationDesc",
    "Class",
    "Topic",
    "Question",
    "Data_Value",
    "Low_Confidence_Limit",
    "High_Confidence_Limit",
    "Sample_Size",
    "Total",
    "Age(years)",
    "Education",
    "Sex",
    "Income",
    "Race/Ethnicity",
    "StratificationCategory1",
    "Stratification1",
    "Data_Value_Type",
    "GeoLocation",
)
TARGET_CLASS = "Obesity / Weight Status"
TARGET_QUESTION = "Percent of adults aged 18 years and older who have obesity"
UNIT_KEY = ("LocationAbbr", "StratificationCategory1", "Stratification1")

# Model names and their hyperparameters.
REGRESSORS = {
    "linear_regression": {},
    "ridge": {"alpha": 1.0},
    "lasso": {"alpha": 0.1},
    "random_forest": {"n_estimators": 200, "max_depth": 10, "min_samples_leaf": 4},
    "gradient_boosting": {"n_estimators": 200, "max_depth": 4, "learning_rate": 0.05},
    "xgboost": {"n_estimators": 200, "max_depth": 4, "learning_rate": 0.05, "subsample": 0.8},
}
CLASSIFIERS = {
    "logistic_regression": {"C": 1.0, "max_iter": 1000},
    "random_forest": {"n_estimators": 200, "max_depth": 10, "min_samples_leaf": 4},
    "gradient_boosting": {"n_estimators": 200, "max_depth": 4, "learning_rate": 0.05},
    "xgboost": {
        "n_estimators": 200,
        "max_depth": 4,
        "learning_rate": 0.05,
        "subsample": 0.8,
        "scale_pos_weight": 1,
    },
}


@dataclass(frozen=True)
class Settings:
    keep_columns: tuple[str, ...] = KEEP_COLUMNS
    target_class: str = TARGET_CLASS
    target_question: str = TARGET_QUESTION
    min_stratum_rows: int = 5

    unit_key: tuple[str, ...] = UNIT_KEY
    lag_years: tuple[int, ...] = (1, 2)
    rolling_window: int = 3
    add_region: bool = True
    # "all" imputes and scales over every row; "train" fits on training rows only.
    fit_on: str = "all"

    high_risk_percentile: float = 75
    high_risk_col: str = "high_risk_obesity"
    early_warning_col: str = "early_warning"
    early_warning_min_pairs: int = 500
    classification_target: str = "auto"

    train_max_year: int = 2017
    val_min_year: int = 2018
    val_max_year: int = 2019
    test_min_year: int = 2020
    random_state: int = 42

    cv_folds: int = 5
    cv_group_col: str = "LocationDesc"

    regressors: dict[str, dict] = field(default_factory=lambda: dict(REGRESSORS))
    classifiers: dict[str, dict] = field(default_factory=lambda: dict(CLASSIFIERS))

    seq_length: int = 3
    run_sequences: bool = True

    top_n_features: int = 20
    run_permutation: bool = True
    permutation_repeats: int = 10
    save_models: bool = True
    # Models of a track that are fitted at the same time.
    parallel_fits: int = 4

    def override(self, **changes) -> "Settings":
        """A copy with some fields replaced; dict fields are merged, and a model
        mapped to None is switched off."""
        merged = {}
        for name, value in changes.items():
            current = getattr(self, name)
            if isinstance(current, dict):
                value = {k: v for k, v in {**current, **value}.items() if v is not None}
            merged[name] = value
        unknown = set(merged) - {f.name for f in fields(self)}
        if unknown:
            raise ValueError(f"unknown settings: {sorted(unknown)}")
        return replace(self, **merged)
