"""Exploratory tables: summaries, trends, distributions, top lists."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from stratline.operators.ordering import attach, hold_small, quantiles
from stratline.operators.rows import scalar, text_columns

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def group_mean(df: DataFrame, keys: Sequence[str], value: str, name: str = "mean") -> DataFrame:
    """Mean per group over rows whose keys are all known; groups without a mean are left out."""
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return df.where(known).groupBy(*keys).agg(F.avg(value).alias(name)).where(F.col(name).isNotNull())


def mean_band(df: DataFrame, key: str, value: str) -> DataFrame:
    """Mean, sample standard deviation and the mean ± sd band per group."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"))
        .withColumn("band_low", F.col("mean") - F.col("std"))
        .withColumn("band_high", F.col("mean") + F.col("std"))
    )


def mean_of_group_means(df: DataFrame, key: str, value: str) -> DataFrame:
    """Group means and the mean of those means as a reference line."""
    means = group_mean(df, [key], value)
    line = scalar(means, F.avg("mean").alias("m"))["m"]
    return means.withColumn("mean_of_means", line)


def latest_year(df: DataFrame, year: str = "YearStart") -> DataFrame:
    return df.where(F.col(year) == scalar(df, F.max(year).alias("y"))["y"])


def top_k(df: DataFrame, value: str, k: int, tie: str, descending: bool = True) -> DataFrame:
    """The k largest (or smallest) rows in a total order."""
    order = F.col(value).desc() if descending else F.col(value).asc()
    return df.orderBy(order, F.col(tie)).limit(k)


def describe(df: DataFrame, value: str) -> DataFrame:
    """count, mean, std, min, exact quartiles and max, in one row."""
    quarter = scalar(
        quantiles(df, value, QUARTILES), *[F.max(q).alias(q) for q in QUARTILES]
    )
    summary = df.agg(
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    ).withColumn("__q", quarter)
    return summary.select("count", "mean", "std", "min", *[f"__q.{q}" for q in QUARTILES], "max")


def histogram(df: DataFrame, value: str, bins: int = 30) -> DataFrame:
    """Equal-width bins over [min, max], the last one closed; empty bins are listed."""
    span = scalar(df, F.min(value).alias("lo"), F.max(value).alias("hi"))
    width = (F.col("__s.hi") - F.col("__s.lo")) / bins
    # When all values are equal there is no width, and bin 0 takes them all.
    index = F.coalesce(F.floor(F.try_divide(F.col(value) - F.col("__s.lo"), width)), F.lit(0))
    counted = (
        df.where(F.col(value).isNotNull())
        .select(value, span.alias("__s"))
        .select(F.least(index, F.lit(bins - 1)).cast("int").alias("bin"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    low, step = F.col("__s.lo"), (F.col("__s.hi") - F.col("__s.lo")) / bins
    edges = (
        df.sparkSession.range(bins)
        .select(F.col("id").cast("int").alias("bin"), span.alias("__s"))
        .select(
            "bin",
            (low + F.col("bin") * step).alias("bin_low"),
            (low + (F.col("bin") + 1) * step).alias("bin_high"),
        )
    )
    return edges.join(counted, "bin", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def box_plot(df: DataFrame, group: str, value: str) -> DataFrame:
    """Per group: quartiles, whiskers at the outermost values within 1.5 IQR, outlier count."""
    rows = df.where(F.col(group).isNotNull())
    quarter = quantiles(rows, value, QUARTILES, by=[group]).drop("n")
    fenced = attach(rows.select(group, value), hold_small(quarter), [group])
    reach = 1.5 * (F.col("q75") - F.col("q25"))
    inside = (F.col(value) >= F.col("q25") - reach) & (F.col(value) <= F.col("q75") + reach)
    return fenced.groupBy(group).agg(
        F.count(value).alias("n"),
        *[F.max(q).alias(q) for q in QUARTILES],
        # A whisker never ends inside the box.
        F.least(F.min(F.when(inside, F.col(value))), F.max("q25")).alias("whisker_low"),
        F.greatest(F.max(F.when(inside, F.col(value))), F.max("q75")).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"),
    ).where(F.col("n") > 0)


def box_outliers(df: DataFrame, group: str, value: str) -> DataFrame:
    """The rows beyond the whiskers."""
    rows = df.where(F.col(group).isNotNull())
    quarter = quantiles(rows, value, QUARTILES, by=[group]).drop("n")
    reach = 1.5 * (F.col("q75") - F.col("q25"))
    outside = (F.col(value) < F.col("q25") - reach) | (F.col(value) > F.col("q75") + reach)
    return attach(rows, hold_small(quarter), [group]).where(outside).drop(*QUARTILES)


def any_text_matches(df: DataFrame, pattern: str, columns: Sequence[str] | None = None) -> Column:
    """True where some text column matches the pattern, ignoring case; NULL never does."""
    names = text_columns(df) if columns is None else columns
    hits = [F.coalesce(F.col(f"`{c}`").rlike(f"(?i){pattern}"), F.lit(False)) for c in names]
    return reduce(lambda a, b: a | b, hits, F.lit(False))


def text_contains(col: Column, part: str) -> Column:
    return F.coalesce(F.lower(col).contains(part.lower()), F.lit(False))


def low_cardinality(
    df: DataFrame, columns: Sequence[str] | None = None, limit: int = 50, show: int = 10
) -> DataFrame:
    """Text columns with more than one and fewer than `limit` distinct values, and the
    first `show` of those values in sorted order."""
    names = text_columns(df) if columns is None else list(columns)
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("value")) for c in names]
    )
    cells = (
        df.select(F.explode(pairs).alias("p"))
        .select("p.*")
        .where(F.col("value").isNotNull())
        .distinct()
    )
    few = hold_small(
        cells.groupBy("column_name")
        .agg(F.count(F.lit(1)).alias("n_distinct"))
        .where((F.col("n_distinct") > 1) & (F.col("n_distinct") < limit))
    )
    # Fewer than `limit` values are left for each column that is collected.
    return (
        cells.join(few, "column_name")
        .groupBy("column_name", "n_distinct")
        .agg(F.array_sort(F.collect_list("value")).alias("all"))
        .select("column_name", "n_distinct", F.slice("all", 1, show).alias("first_values"))
    )


def column_shape(df: DataFrame) -> DataFrame:
    """Rows and columns of a table."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns))
    )


def leaderboard(metrics: DataFrame, columns: Sequence[str], sort_by: str) -> DataFrame:
    """Models by measure, best first, with a flag on the best value of each column.

    `metrics` is long (model, split, metric, value); columns are named split_metric.
    """
    wide = (
        metrics.withColumn("m", F.concat_ws("_", "split", "metric"))
        .groupBy("model")
        .pivot("m", list(columns))
        .agg(F.max("value"))
    )
    best = scalar(wide, *[F.max(c).alias(c) for c in columns])
    flags = [(F.col(c) == F.col(f"__b.{c}")).alias(f"best_{c}") for c in columns]
    return wide.withColumn("__b", best).select("model", *columns, *flags).orderBy(F.col(sort_by).desc_nulls_last(), "model")


def hotspots(
    df: DataFrame,
    unit: Sequence[str],
    value: str,
    year: str = "YearStart",
    target_year: int = 2027,
    k: int = 10,
) -> DataFrame:
    """The k units with the highest projected value.

    Our own rule, a straight line fitted to each unit's years, since only the resulting
    table is published. Units with fewer than two distinct years have no line.
    """
    fits = df.groupBy(*unit).agg(
        F.regr_slope(value, F.col(year)).alias("slope"),
        F.avg(F.when(F.col(value).isNotNull(), F.col(year))).alias("__year"),
        F.avg(F.when(F.col(year).isNotNull(), F.col(value))).alias("__value"),
        F.count(F.when(F.col(year).isNotNull(), F.col(value))).alias("n_years"),
    )
    projected = F.col("__value") + F.col("slope") * (F.lit(target_year) - F.col("__year"))
    return (
        fits.where(F.col("slope").isNotNull())
        .select(*unit, "n_years", "slope", projected.alias("projected"))
        .orderBy(F.col("projected").desc(), *unit)
        .limit(k)
    )
