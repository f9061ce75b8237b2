"""Cleaning a raw extract and encoding its categories."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from stratline.functions import lookups
from stratline.functions.parsing import strip, to_double, to_year
from stratline.operators.ordering import attach, hold_small, running_totals
from stratline.operators.rows import count_by, distinct_rows
from stratline.settings import Settings

# Stages read a table several times. A job passes a function that writes the table and
# reads it back, so that it is computed once and its lineage is cut.
Cut = Callable[[DataFrame, str], DataFrame]


def no_cut(df: DataFrame, name: str) -> DataFrame:
    return df


NUMBERS = ["Data_Value", "Low_Confidence_Limit", "High_Confidence_Limit", "Sample_Size"]
ENCODED = ["stratum_category", "stratum_value", "region", "LocationAbbr"]


def coerce_numbers(df: DataFrame) -> DataFrame:
    """Measures to DOUBLE and the year to INT; what does not parse is NULL."""
    parsed = {c: to_double(df, c) for c in NUMBERS if c in df.columns}
    if "YearStart" in df.columns:
        parsed["YearStart"] = to_year(df, "YearStart")
    return df.withColumns(parsed)


def standard_strata(df: DataFrame) -> DataFrame:
    """Trimmed stratum_category and stratum_value, "Total" where missing or absent."""

    def clean(name):
        if name not in df.columns:
            return F.lit("Total")
        return F.coalesce(strip(F.col(name)), F.lit("Total"))

    return df.withColumns(
        {
            "stratum_category": clean("StratificationCategory1"),
            "stratum_value": clean("Stratification1"),
        }
    )


def collapse_rare(
    df: DataFrame, column: str, min_rows: int = 5, other: str = "Other"
) -> DataFrame:
    """Values with fewer than `min_rows` rows become `other`."""
    rare = count_by(df, column).where(F.col("n") < min_rows).select(column, F.lit(True).alias("__r"))
    return (
        attach(df, hold_small(rare), [column])
        .withColumn(column, F.when(F.col("__r"), F.lit(other)).otherwise(F.col(column)))
        .drop("__r")
    )


def category_cells(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Known categories of all columns as (column_name, category, n), in one pass."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("category")) for c in columns]
    )
    each = df.select(F.explode(pairs).alias("p")).select("p.*").where(F.col("category").isNotNull())
    return each.groupBy("column_name", "category").agg(F.count(F.lit(1)).alias("n"))


def category_index(cells: DataFrame) -> DataFrame:
    """Dictionary (column_name, category, code, n): 0-based position in sorted order, rows."""
    ones = cells.withColumn("one", F.lit(1))
    ranked = running_totals(ones, "category", ["one"], by=["column_name"], few_groups=True)
    return ranked.select("column_name", "category", F.col("one_before").cast("int").alias("code"), "n")


def label_encode(
    df: DataFrame, columns: Sequence[str], cut: Cut = no_cut, share: int = 1000
) -> DataFrame:
    """Adds <column>_enc for each present column; NULL stays NULL.

    Categories that hold more than 1 / share of a column's rows, fewer than `share` for each
    column, are looked up by broadcast. The rest are joined; rows that have nothing to find
    there are dealt out evenly, so that no category and no NULL fills a task.
    """
    columns = [c for c in columns if c in df.columns]
    if not columns:
        return df
    codes = cut(category_index(category_cells(df, columns)), "codes")
    totals = codes.groupBy("column_name").agg(F.sum("n").alias("rows"))  # one row a column
    codes = codes.join(F.broadcast(totals), "column_name")
    out = df
    for c in columns:
        own = codes.where(F.col("column_name") == c)
        often = F.col("n") * share > F.col("rows")
        heavy = own.where(often).select(F.col("category").alias("__a"), F.col("code").alias("__x"))
        light = own.where(~often).select(
            F.col("category").alias("__b"), F.col("code").alias("__y"), F.lit(0).cast("bigint").alias("__z")
        )
        out = out.join(F.broadcast(heavy), out[c] == heavy["__a"], "left")
        left = F.when(F.col("__x").isNull(), F.col(c))
        out = out.withColumn("__left", left).withColumn(
            "__salt", F.when(left.isNull(), F.monotonically_increasing_id()).otherwise(0)
        )
        out = out.join(light, (out["__left"] == light["__b"]) & (out["__salt"] == light["__z"]), "left")
        out = out.withColumn(f"{c}_enc", F.coalesce("__x", "__y"))
        out = out.drop("__a", "__x", "__b", "__y", "__z", "__left", "__salt")
    return out


def ordinals(df: DataFrame) -> DataFrame:
    """income_enc, education_enc and gender_enc from fixed level lists.

    Texts are compared as they are, untrimmed; an unknown text is NULL.
    """
    sex = next((c for c in ("Sex", "Gender") if c in df.columns), None)
    tables = {
        "income_enc": ("Income", lookups.INCOME_CODE),
        "education_enc": ("Education", lookups.EDUCATION_CODE),
        "gender_enc": (sex, lookups.SEX_CODE),
    }
    return df.withColumns(
        {
            name: lookups.lookup(F.col(source), table)
            for name, (source, table) in tables.items()
            if source in df.columns
        }
    )


def add_region(df: DataFrame) -> DataFrame:
    return df.withColumn("region", lookups.region_of(F.col("LocationAbbr")))


def encode(df: DataFrame, settings: Settings = Settings(), cut: Cut = no_cut) -> DataFrame:
    """Rare strata collapsed, categories and ordinals coded."""
    if "stratum_value" in df.columns:
        df = collapse_rare(df, "stratum_value", settings.min_stratum_rows)
    return ordinals(label_encode(df, ENCODED, cut))


def prepare(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Typed, de-duplicated rows with a value, standard strata and region."""
    out = coerce_numbers(df).na.drop(subset=["Data_Value"])
    out = standard_strata(distinct_rows(out))
    if settings.add_region and "LocationAbbr" in out.columns:
        out = add_region(out)
    return out


def clean(df: DataFrame, settings: Settings = Settings(), cut: Cut = no_cut) -> DataFrame:
    """The whole cleaning stage: prepare, then encode."""
    return encode(cut(prepare(df, settings), "prepared"), settings, cut)
