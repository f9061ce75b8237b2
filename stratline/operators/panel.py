"""Panel features: year scale, calendar lags, trend, precision, imputation, sequences.

A panel row is (unit, year, value). Operators that look at other years of a unit come in
two forms. With unique=True the caller vouches that (unit, year) identifies a row, as it
does after an aggregation or keep_first; a unit then holds at most one row per year and a
window on the unit key is small whatever the size of the table. Without it a unit, or
even one of its years, may hold any number of rows, and the work goes through one cell
per (unit, year) so that a hot unit is reduced before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from stratline.operators.encode import Cut, no_cut
from stratline.operators.ordering import attach, quantiles
from stratline.operators.rows import numeric_columns, scalar
from stratline.settings import Settings

IDENTIFIERS = ["YearStart", "LocationAbbr", "stratum_category", "stratum_value"]

# The model features, in order.
FEATURES = [
    "YearStart",
    "year_normalized",
    "LocationAbbr_enc",
    "region_enc",
    "stratum_category_enc",
    "stratum_value_enc",
    "income_enc",
    "education_enc",
    "gender_enc",
    "lag_1",
    "lag_2",
    "rolling_mean_3",
    "trend_1yr",
    "ci_width",
]


def is_unique(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether every key occurs once (one action, reduced before its shuffle)."""
    copies = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return copies.where(F.col("n") > 1).isEmpty()


def no_value() -> Column:
    return F.lit(None).cast("double")


def year_scale(df: DataFrame, fit: DataFrame | None = None, year: str = "YearStart") -> DataFrame:
    """(year - first) / max(last - first, 1) over all rows, or over those of `fit`."""
    span = scalar(fit or df, F.min(year).alias("lo"), F.max(year).alias("hi"))
    scaled = (F.col(year) - F.col("__span.lo")) / F.greatest(
        F.col("__span.hi") - F.col("__span.lo"), F.lit(1)
    )
    return df.withColumn("__span", span).withColumn("year_normalized", scaled).drop("__span")


def ci_width(df: DataFrame) -> DataFrame:
    """Width of the confidence interval, NULL where the limits are not known."""
    limits = {"High_Confidence_Limit", "Low_Confidence_Limit"}
    width = (
        F.col("High_Confidence_Limit") - F.col("Low_Confidence_Limit")
        if limits <= set(df.columns)
        else no_value()
    )
    return df.withColumn("ci_width", width)


def calendar_lags(
    df: DataFrame,
    unit: Sequence[str],
    lags: Sequence[int] = (1, 2),
    year: str = "YearStart",
    value: str = "Data_Value",
    tie: Sequence[str] = (),
    unique: bool = False,
) -> DataFrame:
    """lag_L: value of the same unit exactly L years earlier, NULL when not observed.

    A unit key part that is NULL counts as a value of its own. All lags share one shuffle
    on the unit. Where a (unit, year) has several rows the lag is taken from the first in
    the order `tie`, `value` (without `tie`, the smallest value); rows are neither added nor
    lost. Rows without a year get no lag.
    """
    unit = list(unit)
    known = F.col(year).isNotNull()
    if unique:
        years = Window.partitionBy(*unit).orderBy(year)
        return df.withColumns(
            {f"lag_{n}": F.when(known, F.max(value).over(years.rangeBetween(-n, -n))) for n in lags}
        )
    order = [c for c in tie if c != value]
    # A plain minimum is a hash aggregate, a minimum of structs is a sorting one.
    first = F.min(F.struct(*order, F.col(value).alias("__v")))["__v"] if order else F.min(value)
    cells = df.where(known).groupBy(*unit, year).agg(first.alias("__v"))
    years = Window.partitionBy(*unit).orderBy(year)
    cells = cells.select(
        *unit, year, *[F.max("__v").over(years.rangeBetween(-n, -n)).alias(f"lag_{n}") for n in lags]
    )
    return attach(df, cells, [*unit, year])


def lag_join(
    df: DataFrame,
    unit: Sequence[str],
    lags: Sequence[int] = (1, 2),
    year: str = "YearStart",
    value: str = "Data_Value",
) -> DataFrame:
    """The lags as left joins on (unit, year + L), where copies of a key fan out.

    Meant for keys with few copies: the output has one row for every match, see
    fan_out_rows for its size. NULL key parts match each other.
    """
    out = df
    for n in lags:
        past = df.where(F.col(year).isNotNull()).select(
            *[F.col(k).alias(f"__{k}") for k in unit],
            (F.col(year) + n).alias("__year"),
            F.col(value).alias(f"lag_{n}"),
        )
        on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in unit]
        on.append(F.col(year) == F.col("__year"))
        out = out.join(past, reduce(lambda a, b: a & b, on), "left").drop(
            "__year", *[f"__{k}" for k in unit]
        )
    return out


def fan_out_rows(
    df: DataFrame, unit: Sequence[str], lags: Sequence[int] = (1, 2), year: str = "YearStart"
) -> DataFrame:
    """Rows that lag_join would return for each (unit, year), from counts alone."""
    unit = list(unit)
    cells = df.groupBy(*unit, year).agg(F.count(F.lit(1)).alias("n_rows"))
    years = Window.partitionBy(*unit).orderBy(year)
    known = F.col(year).isNotNull()
    size = F.col("n_rows")
    for n in lags:
        matches = F.when(known, F.max("n_rows").over(years.rangeBetween(-n, -n)))
        size = size * F.greatest(F.coalesce(matches, F.lit(1)), F.lit(1))
    return cells.withColumn("n_fanned", size)


def lag_summary(
    df: DataFrame, lags: Sequence[int] = (1, 2), rolling_window: int = 3
) -> DataFrame:
    """rolling_mean_W and trend_1yr from the lag columns.

    The rolling mean is the mean of the lags that are present (with lags 1 and 2, two
    years at most); the window length only names the column. The trend needs both lags.
    """
    names = [f"lag_{n}" for n in lags if f"lag_{n}" in df.columns]
    mean, trend = no_value(), no_value()
    if names:
        total = reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0.0)) for c in names])
        present = reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in names])
        mean = F.try_divide(total, F.nullif(present, F.lit(0)))
    if {"lag_1", "lag_2"} <= set(df.columns):
        trend = F.col("lag_1") - F.col("lag_2")
    return df.withColumns({f"rolling_mean_{rolling_window}": mean, "trend_1yr": trend})


def lag_features(df: DataFrame, settings: Settings = Settings(), unique: bool = False) -> DataFrame:
    """Lags, rolling mean and trend on the configured unit key, as far as it is present."""
    unit = [k for k in settings.unit_key if k in df.columns]
    if not unit:
        empty = {f"lag_{n}": no_value() for n in settings.lag_years}
        empty |= {f"rolling_mean_{settings.rolling_window}": no_value(), "trend_1yr": no_value()}
        return df.withColumns(empty)
    lagged = calendar_lags(df, unit, settings.lag_years, unique=unique)
    return lag_summary(lagged, settings.lag_years, settings.rolling_window)


def feature_table(df: DataFrame) -> DataFrame:
    """Identifiers, then the feature columns, as far as they exist."""
    names = list(dict.fromkeys([*IDENTIFIERS, *FEATURES]))
    return df.select(*[c for c in names if c in df.columns])


def feature_columns(df: DataFrame, targets: Sequence[str] = ()) -> list[str]:
    """Names that go into a model: everything but identifiers and targets."""
    skip = {*IDENTIFIERS, *targets}
    return [c for c in df.columns if c not in skip]


def medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact median of each column as rows (column_name, n, median).

    All columns share one pass: values are stacked with their column name and reduced to
    distinct (column, value) counts before the shuffle.
    """
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("double").alias("value"))
            for c in columns
        ]
    )
    long = df.select(F.explode(pairs).alias("p")).select("p.*").where(F.col("value").isNotNull())
    return quantiles(long, "value", {"median": 0.5}, by=["column_name"], few_groups=True)


def fit_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """{column: exact median}; a column without any value is missing from it.

    One number per column comes back to the driver, as from the fit of any imputer.
    """
    if not columns:
        return {}
    return {row["column_name"]: row["median"] for row in medians(df, columns).collect()}


def fill(df: DataFrame, values: dict[str, float]) -> DataFrame:
    """Missing numbers replaced; the columns become DOUBLE, an INT year stays INT."""
    kinds = dict(df.dtypes)
    filled = {
        c: F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(v).cast("double"))
        for c, v in values.items()
    }
    if kinds.get("YearStart") == "int" and "YearStart" in filled:
        filled["YearStart"] = filled["YearStart"].cast("int")
    return df.withColumns(filled) if filled else df


def impute_medians(
    df: DataFrame, columns: Sequence[str] | None = None, fit: DataFrame | None = None
) -> DataFrame:
    """Missing numbers become the median of their column over all rows (or over `fit`).

    A column without any value stays NULL.
    """
    columns = list(columns) if columns is not None else numeric_columns(df)
    known = fit_medians(fit or df, columns)
    return fill(df, {c: known.get(c) for c in columns})


def features(
    df: DataFrame,
    settings: Settings = Settings(),
    unique: bool | None = None,
    impute: bool = True,
    cut: Cut = no_cut,
) -> DataFrame:
    """The feature table of a cleaned panel; checks whether units are unique if not told."""
    if unique is None:
        unit = [k for k in settings.unit_key if k in df.columns]
        unique = bool(unit) and is_unique(df, [*unit, "YearStart"])
    train = F.col("YearStart") <= settings.train_max_year
    on_train = settings.fit_on == "train"
    out = year_scale(df, df.where(train) if on_train else None)
    out = lag_features(ci_width(out), settings, unique)
    table = cut(feature_table(out), "features_raw")
    if not impute:
        return table
    return impute_medians(table, fit=table.where(train) if on_train else None)


def sequences(
    df: DataFrame,
    feature_names: Sequence[str],
    target: str = "Data_Value",
    length: int = 3,
    unit: Sequence[str] = ("LocationDesc", "stratum_category", "stratum_value"),
    year: str = "YearStart",
) -> DataFrame:
    """Rolling windows of a panel that is unique on (unit, year).

    Each row with at least `length` observed predecessors gives one window: the features
    of those predecessors in time order, and the row's own year and value as target.
    Units with a NULL key part are left out. Windows count rows, so they may span a gap.
    """
    unit = list(unit)
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in unit])
    past = Window.partitionBy(*unit).orderBy(year).rowsBetween(-length, -1)
    # collect_list skips NULL elements, never a struct around them.
    vector = F.struct(F.array(*[F.col(f"`{c}`").cast("double") for c in feature_names]).alias("v"))
    return (
        df.where(known)
        .withColumn("__w", F.collect_list(vector).over(past))
        .where(F.size("__w") == length)
        .select(
            *unit,
            F.col(year).alias("target_year"),
            F.col("__w.v").alias("features"),
            F.col(target).cast("double").alias("target"),
        )
    )
