"""Lenient text-to-value parsing, expressed as Spark columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType

# The texts pandas reads as missing by default.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Plain decimal or exponent notation and the infinities. Spark's own cast also takes
# Java suffixes ("1.0d"), which are text here.
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$|^(?i)[+-]?inf(inity)?$"


def strip(col: Column) -> Column:
    """Remove leading and trailing whitespace of any kind, not only blanks."""
    return F.regexp_replace(col, r"(?U)^\s+|\s+$", "")


def na_to_null(col: Column) -> Column:
    return F.when(~col.isin(NA_TOKENS), col)


def nan_to_null(col: Column) -> Column:
    """NaN compares above every number in Spark, so missing is NULL everywhere."""
    return F.when(~F.isnan(col), col)


def to_double(df: DataFrame, name: str) -> Column:
    """Numeric value of a column of any type; whatever is not a number is NULL."""
    col = df[name]
    kind = df.schema[name].dataType
    if isinstance(kind, StringType):
        text = strip(col)
        return F.when(text.rlike(NUMBER), text).try_cast("double")
    if isinstance(kind, (DoubleType, FloatType)):
        return nan_to_null(col.cast("double"))
    return col.try_cast("double")


def to_year(df: DataFrame, name: str) -> Column:
    """Whole-number value as INT; fractions and texts are NULL."""
    number = to_double(df, name)
    return F.when(number == F.floor(number), number).try_cast("int")
