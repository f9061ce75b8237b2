"""Whole-row operators: duplicates, null profile, projection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [name for name, kind in df.dtypes if kind == "string"]


def project_present(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The named columns that exist, in the order of the list."""
    return df.select(*[f"`{c}`" for c in names if c in df.columns])


def value_columns(df: DataFrame) -> list[str]:
    """Columns that look like the measured value."""
    return [c for c in df.columns if c.lower() in ("data_value", "datavalue", "value")]


def distinct_rows(df: DataFrame) -> DataFrame:
    """Rows without exact copies; a missing cell equals a missing cell."""
    return df.dropDuplicates()


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the smallest in `order`, then in all other columns.

    A DataFrame has no row order, so "first" needs a total order. It is an aggregate and
    not a row_number window: copies of a hot key are reduced before the shuffle.
    """
    keys = list(keys)
    rest = [c for c in order if c not in keys]
    rest += [c for c in df.columns if c not in keys and c not in rest]
    if not rest:
        return df.dropDuplicates(keys)
    picked = df.groupBy(*[f"`{k}`" for k in keys]).agg(
        F.min(F.struct(*[F.col(f"`{c}`") for c in rest])).alias("__row")
    )
    return picked.select(
        *[
            F.col(f"`{c}`") if c in keys else F.col("__row").getField(c).alias(c)
            for c in df.columns
        ]
    )


def duplicate_count(df: DataFrame) -> DataFrame:
    """One row: rows, distinct rows and surplus copies."""
    copies = df.groupBy(*[f"`{c}`" for c in df.columns]).agg(F.count(F.lit(1)).alias("__n"))
    return copies.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("n_distinct"),
    ).withColumn("n_duplicates", F.col("n_rows") - F.col("n_distinct"))


def unpivot_counts(counts: DataFrame, names: Sequence[str], label: str) -> DataFrame:
    """One-row counts with columns `names` to rows (label, value), and `n_rows` kept."""
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias(label), F.col(f"`{c}`").alias("value"))
            for c in names
        ]
    )
    return counts.select("n_rows", F.explode(pairs).alias("__p")).select("__p.*", "n_rows")


def null_profile(df: DataFrame) -> DataFrame:
    """Per column: null_count, n_rows, null_fraction and null_pct with one decimal."""
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns],
    )
    fraction = F.try_divide(F.col("null_count"), F.col("n_rows"))
    return (
        unpivot_counts(counts, df.columns, "column_name")
        .withColumnRenamed("value", "null_count")
        .withColumn("null_fraction", fraction)
        .withColumn("null_pct", F.round(fraction * 100, 1))
    )


def count_by(df: DataFrame, key: str) -> DataFrame:
    """Rows per non-null value."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def scalar(df: DataFrame, *aggregates: Column) -> Column:
    """A one-row aggregate as a scalar subquery; read its fields by alias."""
    return df.agg(F.struct(*aggregates).alias("__s")).scalar()
