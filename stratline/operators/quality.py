"""Data-quality checks as a long table (check, item, value, passed).

`passed` is NULL for rows that only report a number.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType

from stratline.functions.parsing import to_double
from stratline.operators.rows import duplicate_count, null_profile, numeric_columns, text_columns

# Required columns, and columns filled for one stratum kind only.
REQUIRED = ["YearStart", "LocationAbbr", "Data_Value", "StratificationCategory1", "Stratification1"]
SPARSE = ["Total", "Age(years)", "Education", "Sex", "Income", "Race/Ethnicity", "Gender"]
MAX_NULL_PCT, MAX_NULL_PCT_SPARSE = 80, 50
FIRST_YEAR, LAST_YEAR = 2000, 2030
LOW_VALUE, HIGH_VALUE = 0, 100

# Checks that stop a strict run.
STRICT = {"required_columns", "data_value_range", "non_empty", "all_numeric", "no_infinities",
          "expected_features"}


def result(check: str, item: Column, value: Column, passed: Column) -> Column:
    return F.struct(
        F.lit(check).alias("check"),
        item.cast("string").alias("item"),
        value.cast("double").alias("value"),
        passed.cast("boolean").alias("passed"),
    )


def value_counts_check(df: DataFrame) -> DataFrame:
    """One row: unparseable, out-of-range and total values, first and last year."""
    columns = [F.count(F.lit(1)).alias("n_rows")]
    if "Data_Value" in df.columns:
        number = to_double(df, "Data_Value")
        bad = F.col("Data_Value").isNotNull() & number.isNull()
        if isinstance(df.schema["Data_Value"].dataType, (DoubleType, FloatType)):
            bad = F.lit(False)
        columns += [
            F.count_if(bad).alias("n_unparseable"),
            F.count_if((number < LOW_VALUE) | (number > HIGH_VALUE)).alias("n_out_of_range"),
        ]
    if "YearStart" in df.columns:
        year = to_double(df, "YearStart")
        columns += [F.min(year).alias("year_min"), F.max(year).alias("year_max")]
    return df.agg(*columns)


def missingness(df: DataFrame) -> DataFrame:
    """Null profile of the columns with gaps, and whether the share is a concern.

    `flagged` marks over 80 % missing, `expected` marks structurally sparse columns over 50 %.
    """
    sparse = F.col("column_name").isin(SPARSE)
    return (
        null_profile(df)
        .where(F.col("null_count") > 0)
        .withColumn("flagged", ~sparse & (F.col("null_pct") > MAX_NULL_PCT))
        .withColumn("expected", sparse & (F.col("null_pct") > MAX_NULL_PCT_SPARSE))
    )


def check_raw(df: DataFrame) -> DataFrame:
    """Required columns, parseable values, missingness, year and value range, duplicates."""
    spark = df.sparkSession
    none = F.lit(None)
    missing = [c for c in REQUIRED if c not in df.columns]
    rows = [result("required_columns", F.lit(c), F.lit(0), F.lit(False)) for c in missing]
    rows = rows or [result("required_columns", none, F.lit(len(REQUIRED)), F.lit(True))]
    if "Data_Value" in df.columns:
        rows += [
            result("data_value_numeric", none, F.col("n_unparseable"), F.col("n_unparseable") == 0),
            result(
                "data_value_range", none, F.col("n_out_of_range"), F.col("n_out_of_range") == 0
            ),
        ]
    if "YearStart" in df.columns:
        # A column without any year fails instead of raising.
        inside = F.coalesce(
            (F.col("year_min") >= FIRST_YEAR) & (F.col("year_max") <= LAST_YEAR), F.lit(False)
        )
        rows += [
            result("year_range", F.lit("min"), F.col("year_min"), inside),
            result("year_range", F.lit("max"), F.col("year_max"), inside),
        ]
    facts = value_counts_check(df).select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    gaps = missingness(df).select(
        result(
            "missingness",
            F.col("column_name"),
            F.col("null_count"),
            ~F.col("flagged"),
        ).alias("r")
    )
    copies = duplicate_count(df).select(
        result("duplicates", none, F.col("n_duplicates"), F.col("n_duplicates") == 0).alias("r")
    )
    return facts.unionByName(gaps.select("r.*")).unionByName(copies.select("r.*"))


def feature_counts(df: DataFrame) -> DataFrame:
    """One row: rows, infinite values and missing values of a feature matrix."""

    def total(terms):
        return reduce(lambda a, b: a + b, terms, F.lit(0).cast("bigint"))

    kinds = {f.name: f.dataType for f in df.schema.fields}
    real = [c for c in numeric_columns(df) if isinstance(kinds[c], (DoubleType, FloatType))]
    infinite = [
        F.count_if(F.abs(F.col(f"`{c}`")) == F.lit(float("inf"))) for c in real
    ]
    missing = [F.count_if(F.col(f"`{c}`").isNull()) for c in df.columns]
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        total(infinite).alias("n_infinite"),
        total(missing).alias("n_null"),
    )


def check_features(df: DataFrame, expected: Sequence[str] | None = None) -> DataFrame:
    """Non-empty, all numeric, no infinities, null total, expected columns."""
    none = F.lit(None)
    texts = text_columns(df)
    rows = [
        result("non_empty", none, F.col("n_rows"), F.col("n_rows") > 0),
        result("n_features", none, F.lit(len(df.columns)), none),
        result("no_infinities", none, F.col("n_infinite"), F.col("n_infinite") == 0),
        result("null_total", none, F.col("n_null"), none),
    ]
    rows += [result("all_numeric", F.lit(c), F.lit(0), F.lit(False)) for c in texts]
    if not texts:
        rows.append(result("all_numeric", none, F.lit(len(df.columns)), F.lit(True)))
    if expected:
        absent = [c for c in expected if c not in df.columns]
        rows += [result("expected_features", F.lit(c), F.lit(0), F.lit(False)) for c in absent]
        if not absent:
            rows.append(result("expected_features", none, F.lit(len(expected)), F.lit(True)))
    return feature_counts(df).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def enforce(checks: DataFrame, strict: bool = False) -> list[tuple[str, str | None]]:
    """Failed (check, item) pairs. An empty feature matrix always raises ValueError, other
    strict checks raise only on request."""
    failed = [
        (row["check"], row["item"])
        for row in checks.where(~F.col("passed")).orderBy("check", "item").collect()
    ]
    stop = [f for f in failed if f[0] == "non_empty" or (strict and f[0] in STRICT)]
    if stop:
        raise ValueError(f"data-quality checks failed: {stop}")
    return failed
