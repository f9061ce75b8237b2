"""Hypothesis tests: the data is reduced by Spark, the tail probability of a test is
worked out on its few result rows."""

from __future__ import annotations

import sys

import pandas as pd
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

from stratline.functions import distributions as dist
from stratline.functions.lookups import EDUCATION_RANK, INCOME_RANK, lookup
from stratline.operators.ordering import SMALL_ROWS, average_ranks
from stratline.operators.rows import scalar

ALPHA = 0.05

# Workers get the helper functions themselves, so they need no copy of this package.
register_pickle_by_value(dist)
register_pickle_by_value(sys.modules[__name__])


@pandas_udf(DoubleType())
def f_p_value(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return pd.Series([dist.f_tail(*args) for args in zip(f, d1, d2)])


@pandas_udf(DoubleType())
def t_p_value(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([dist.t_two_sided(*args) for args in zip(t, df)])


@pandas_udf(DoubleType())
def rho_p_value(rho: pd.Series, n: pd.Series) -> pd.Series:
    return pd.Series([dist.correlation_p(*args) for args in zip(rho, n)])


@pandas_udf(DoubleType())
def range_p_value(q: pd.Series, k: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([dist.studentized_range_tail(a, int(b), c) for a, b, c in zip(q, k, df)])


@pandas_udf(DoubleType())
def range_critical(p: pd.Series, k: pd.Series, df: pd.Series) -> pd.Series:
    # All rows of a table share one critical value.
    known = {args: dist.studentized_range_quantile(*args) for args in set(zip(p, k.astype(int), df))}
    return pd.Series([known[args] for args in zip(p, k.astype(int), df)])


def group_moments(df: DataFrame, group: str, value: str) -> DataFrame:
    """n, mean and sum of squared deviations per known group."""
    return (
        df.where(F.col(group).isNotNull() & F.col(value).isNotNull())
        .groupBy(F.col(group).alias("grp"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(value).alias("mean"),
            (F.var_pop(value) * F.count(F.lit(1))).alias("ss"),
        )
    )


def anova(df: DataFrame, group: str, value: str) -> DataFrame:
    """One-way analysis of variance: f_stat, degrees of freedom, p_value, significant."""
    moments = group_moments(df, group, value)
    total = scalar(moments, (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("m"))["m"]
    sums = moments.agg(
        F.sum(F.col("n") * (F.col("mean") - total) * (F.col("mean") - total)).alias("ssb"),
        F.sum("ss").alias("ssw"),
        (F.count(F.lit(1)) - 1).alias("df_between"),
        (F.sum("n") - F.count(F.lit(1))).alias("df_within"),
    )
    f = F.try_divide(
        F.try_divide("ssb", "df_between"), F.try_divide("ssw", "df_within")
    )
    return (
        sums.select(f.alias("f_stat"), "df_between", "df_within")
        .withColumn("p_value", f_p_value("f_stat", "df_between", "df_within"))
        .withColumn("significant", F.col("p_value") < ALPHA)
    )


def group_pairs(moments: DataFrame) -> DataFrame:
    """Every pair of groups in name order, from the one-row-per-group moments.

    The groups are the levels of a factor; a pairwise table over them is the result asked
    for, so they fit in one row, and no join is needed.
    """
    whole = moments.agg(
        F.array_sort(F.collect_list(F.struct("grp", "n", "mean"))).alias("g"),
        F.sum("n").alias("n_all"),
        F.sum("ss").alias("ssw"),
        F.count(F.lit(1)).alias("k"),
    )
    first = whole.select("*", F.posexplode("g").alias("i", "a"))
    later = F.slice("g", F.col("i") + 2, F.size("g"))
    return first.select("n_all", "ssw", "k", "a", F.explode(later).alias("b"))


def tukey_contrasts(df: DataFrame, group: str, value: str) -> DataFrame:
    """group1, group2, meandiff (second minus first) and its Tukey-Kramer standard error."""
    mse = F.col("ssw") / (F.col("n_all") - F.col("k"))
    return group_pairs(group_moments(df, group, value)).select(
        F.col("a.grp").alias("group1"),
        F.col("b.grp").alias("group2"),
        (F.col("b.mean") - F.col("a.mean")).alias("meandiff"),
        F.sqrt(mse / 2 * (1 / F.col("a.n") + 1 / F.col("b.n"))).alias("std_err"),
        "k",
        (F.col("n_all") - F.col("k")).alias("df_within"),
    )


def tukey_hsd(df: DataFrame, group: str, value: str, alpha: float = ALPHA) -> DataFrame:
    """All pairwise differences with adjusted p-value, confidence limits and decision."""
    contrasts = tukey_contrasts(df, group, value)
    q = F.abs("meandiff") / F.col("std_err")
    half = F.col("critical") * F.col("std_err")
    return (
        contrasts.withColumn("p_adj", range_p_value(q, "k", "df_within"))
        .withColumn("critical", range_critical(F.lit(1.0 - alpha), "k", "df_within"))
        .select(
            "group1", "group2", "meandiff", "p_adj",
            (F.col("meandiff") - half).alias("lower"),
            (F.col("meandiff") + half).alias("upper"),
            (F.abs("meandiff") > half).alias("reject"),
        )
    )


def t_test(df: DataFrame, group: str, value: str, first: str, second: str) -> DataFrame:
    """Two-sample t with pooled variance: t_stat, p_value, significant and both means."""

    def of(level: str, what) -> Column:
        return what(F.when(F.col(group) == level, F.col(value)))

    sums = df.agg(
        of(first, F.count).alias("n1"), of(second, F.count).alias("n2"),
        of(first, F.avg).alias("mean1"), of(second, F.avg).alias("mean2"),
        of(first, F.var_samp).alias("v1"), of(second, F.var_samp).alias("v2"),
    )
    dof = F.col("n1") + F.col("n2") - 2
    pooled = F.try_divide(
        (F.col("n1") - 1) * F.col("v1") + (F.col("n2") - 1) * F.col("v2"), dof
    )
    spread = F.sqrt(pooled * (F.try_divide(F.lit(1), "n1") + F.try_divide(F.lit(1), "n2")))
    return (
        sums.withColumn("t_stat", F.try_divide(F.col("mean1") - F.col("mean2"), spread))
        .withColumn("p_value", t_p_value("t_stat", dof))
        .select(
            "n1", "n2", "mean1", "mean2", "t_stat", "p_value",
            (F.col("p_value") < ALPHA).alias("significant"),
        )
    )


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """Rank correlation over rows with both values: n, rho, p_value, significant.

    Rows are reduced to distinct (x, y) pairs with counts, ranks are computed on distinct
    values, and the correlation is a weighted sum around the known mean rank (n + 1) / 2.
    """
    both = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(
        F.col(x).alias("x"), F.col(y).alias("y")
    )
    # One pass tells the number of rows and which rank table is small enough to broadcast.
    facts = both.agg(
        F.count(F.lit(1)).alias("n"),
        F.approx_count_distinct("x").alias("x"),
        F.approx_count_distinct("y").alias("y"),
    ).first()
    ranks = {}
    for axis in ("x", "y"):
        table = average_ranks(both, axis)
        table = table.select(axis, F.col("avg_rank").alias(f"r_{axis}"))
        ranks[axis] = F.broadcast(table) if facts[axis] <= SMALL_ROWS else table
    middle = F.lit((facts["n"] + 1) / 2)
    dx, dy, w = F.col("r_x") - middle, F.col("r_y") - middle, F.col("w")
    sums = (
        both.groupBy("x", "y")
        .agg(F.count(F.lit(1)).alias("w"))
        .join(ranks["x"], "x")
        .join(ranks["y"], "y")
        .agg(
            F.coalesce(F.sum(w), F.lit(0)).alias("n"),
            F.sum(w * dx * dy).alias("xy"),
            F.sum(w * dx * dx).alias("xx"),
            F.sum(w * dy * dy).alias("yy"),
        )
    )
    rho = F.try_divide(F.col("xy"), F.sqrt(F.col("xx")) * F.sqrt(F.col("yy")))
    return (
        sums.select("n", rho.alias("rho"))
        .withColumn("p_value", rho_p_value("rho", "n"))
        .withColumn("significant", F.col("p_value") < ALPHA)
    )


def ranked_stratum(df: DataFrame, category: str, table: dict, name: str) -> DataFrame:
    """Rows of one stratum category whose value has a level in the table."""
    rows = df.where(F.col("stratum_category") == category)
    return rows.withColumn(name, lookup(F.col("stratum_value"), table)).where(
        F.col(name).isNotNull()
    )


def impact(df: DataFrame, value: str = "Data_Value") -> dict[str, DataFrame]:
    """The tests that apply to a cleaned panel, by name.

    The t-test and the rank correlations run only for strata that occur.
    """
    known = {
        row[0]
        for row in df.select("stratum_category")
        .where(F.col("stratum_category").isin("Sex", "Income", "Education"))
        .distinct()
        .collect()
    }
    out = {
        "anova_stratum": anova(df, "stratum_category", value),
        "tukey_stratum": tukey_hsd(df, "stratum_category", value),
    }
    if "Sex" in known:
        sex = df.where(F.col("stratum_category") == "Sex")
        out["ttest_gender"] = t_test(sex, "stratum_value", value, "Male", "Female")
    if "Income" in known:
        rows = ranked_stratum(df, "Income", INCOME_RANK, "level")
        out["income_correlation"] = spearman(rows, "level", value)
    if "Education" in known:
        rows = ranked_stratum(df, "Education", EDUCATION_RANK, "level")
        out["education_correlation"] = spearman(rows, "level", value)
    return out
