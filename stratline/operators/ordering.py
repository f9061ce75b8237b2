"""Exact order statistics without a global window, one way for every size.

Running totals, ranks and "next row" need rows in order. Rows are first collapsed to
distinct values, and the value axis is cut at the values with the smallest hashes: a uniform
draw of distinct values whose number follows the parallelism of the session. A window runs
inside a slice; slice totals are added up over groups of slices and then over the groups, so
no window sees more than a slice or FAN totals of a group. Any cut points give the same
result.

Quantiles order next to nothing: a mergeable sketch brackets every wanted position, one pass
counts the rows left of each bracket and its distinct values, and only those are ordered.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

# Slices of the value axis: SLICES if set, else four for each shuffle partition, 64 at least.
SLICES: int | None = None
# Slice totals that are added up in one window.
FAN = 256
# Rows a table may have to be fetched and broadcast.
SMALL_ROWS = 20_000
# Rank error of the quantile sketch, the half width of a bracket (both as a share of the
# rows), and the rows below which a bracket holds the whole group.
SKETCH, REACH, WHOLE = 1e-4, 1e-3, 2000


def hold_small(df: DataFrame, limit: int | None = None) -> DataFrame:
    """`df` as a broadcast local table if it has at most `limit` rows, else `df` itself.

    For tables that are expected to be small but have no proven bound, such as one row
    per group. Fetching one row more than the limit is the check.
    """
    limit = SMALL_ROWS if limit is None else limit
    head = df.limit(limit + 1).collect()
    if len(head) > limit:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(head, df.schema))


def slices(df: DataFrame) -> int:
    return SLICES or max(64, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def cut_points(df: DataFrame, key: str) -> Column:
    """Ascending values that cut `key` into slices, as one array.

    The values with the smallest hashes: each partition keeps that many, and neither the
    order of the rows nor how they are dealt out changes the choice.
    """
    known = df.select(F.col(key).alias("key")).where("key is not null")
    drawn = known.withColumn("draw", F.xxhash64("key")).orderBy("draw", "key").limit(slices(df) - 1)
    return drawn.agg(F.array_sort(F.collect_set("key"))).scalar()


def slice_of(key: Column, points: Column, most: int) -> Column:
    """Number of the at most `most` points at or below `key`, by binary search."""
    steps = [1 << b for b in reversed(range(most.bit_length()))]
    size = F.size(points)
    # A null key never passes the comparison and lands in slice 0.
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda pos, step: F.when(
            (pos + step <= size) & (F.get(points, pos + step - 1) <= key), pos + step
        ).otherwise(pos),
    )


def sliced(df: DataFrame, key: str, points: Sequence | None = None) -> DataFrame:
    """Adds __slice, the slice of `key`; by given points or those of cut_points."""
    if points is None:
        found, most = cut_points(df, key), slices(df)
    else:
        found, most = F.array(*[F.lit(p) for p in points]), len(points)
        if not points:
            return df.withColumn("__slice", F.lit(0))
    held = df.withColumn("__points", found)
    return held.withColumn("__slice", slice_of(F.col(key), F.col("__points"), most)).drop("__points")


def totals_ahead(
    sums: DataFrame, by: Sequence[str], totals: Sequence[str], descending: bool
) -> DataFrame:
    """Slice totals (by, __slice, totals) to (by, __slice, __<t>_ahead, <t>_all).

    Windows over at most FAN slices, and over the totals of those.
    """
    order = F.col("__slice").desc() if descending else F.col("__slice").asc()
    part = F.floor(F.col("__slice") / FAN).cast("int")
    split = sums.withColumn("__part", part)
    inside = Window.partitionBy(*by, "__part").orderBy(order)
    ahead = inside.rowsBetween(Window.unboundedPreceding, -1)
    inner = split.select(
        *by, "__slice", "__part",
        *[F.coalesce(F.sum(t).over(ahead), F.lit(0)).alias(f"__{t}_ahead") for t in totals],
    )
    parts = split.groupBy(*by, "__part").agg(*[F.sum(t).alias(t) for t in totals])
    group = Window.partitionBy(*by)
    order = F.col("__part").desc() if descending else F.col("__part").asc()
    before = group.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        *by, "__part",
        *[F.coalesce(F.sum(t).over(before), F.lit(0)).alias(f"__{t}_base") for t in totals],
        *[F.sum(t).over(group).alias(f"{t}_all") for t in totals],
    )
    both = attach(inner, parts, [*by, "__part"])
    whole = {f"__{t}_ahead": F.col(f"__{t}_ahead") + F.col(f"__{t}_base") for t in totals}
    return both.withColumns(whole).drop("__part", *[f"__{t}_base" for t in totals])


def attach(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Null-safe left join on equally named keys; the right side is unique on them."""
    other = right.select(
        *[F.col(k).alias(f"__{k}") for k in keys], *[c for c in right.columns if c not in keys]
    )
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return left.join(other, on, "left").drop(*[f"__{k}" for k in keys])


def running_totals(
    cells: DataFrame,
    key: str,
    totals: Sequence[str],
    by: Sequence[str] = (),
    descending: bool = False,
    points: Sequence | None = None,
    few_groups: bool = False,
) -> DataFrame:
    """Running sums along `key` within each `by` group of a table that is unique on them.

    For every column t in `totals` this adds t_before (rows strictly ahead), t_upto
    (this row included) and t_all (the whole group). A null key comes first. `few_groups`
    says that the number of groups does not grow with the data (columns, models), so that
    slice totals are small.
    """
    by = list(by)
    rows = sliced(cells, key, points)
    sums = rows.groupBy(*by, "__slice").agg(*[F.sum(t).alias(t) for t in totals])
    offsets = totals_ahead(sums, by, totals, descending)
    if not by or few_groups:
        offsets = F.broadcast(offsets)  # at most one row for each slice and group
    order = F.col(key).desc() if descending else F.col(key).asc()
    upto = (
        Window.partitionBy(*by, "__slice").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    )
    out = attach(rows, offsets, [*by, "__slice"])
    for t in totals:
        out = out.withColumn(f"{t}_upto", F.col(f"__{t}_ahead") + F.sum(t).over(upto))
        out = out.withColumn(f"{t}_before", F.col(f"{t}_upto") - F.col(t))
    return out.drop("__slice", *[f"__{t}_ahead" for t in totals])


def value_cells(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Distinct non-null values with their number of rows `n`."""
    return (
        df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    )


def brackets(df: DataFrame, value: str, probs: Mapping[str, float], by: Sequence[str]) -> DataFrame:
    """(by, n, lo_i, hi_i): values between which the i-th wanted positions of a group lie.

    One pass with a sketch per group. The sketch is off by less than SKETCH of the rows, a
    bracket reaches REACH to both sides, and from WHOLE rows on that is more than the one
    row by which positions are rounded."""
    shares = [max(0.0, p - REACH) for p in probs.values()] + [min(1.0, p + REACH) for p in probs.values()]
    grid = F.array(*[F.lit(float(q)) for q in shares])
    sketch = F.percentile_approx(value, grid, F.lit(int(1 / SKETCH))).alias("q")
    found = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.min(value).alias("min"), F.max(value).alias("max"), sketch
    )
    bounds = []
    for i, p in enumerate(probs.values()):
        low = F.when((F.col("n") < WHOLE) | F.lit(p <= REACH), F.col("min")).otherwise(F.get("q", F.lit(i)))
        high = F.when((F.col("n") < WHOLE) | F.lit(p >= 1 - REACH), F.col("max"))
        bounds += [low.alias(f"lo_{i}"), high.otherwise(F.get("q", F.lit(len(probs) + i))).alias(f"hi_{i}")]
    return found.select(*by, "n", *bounds)


def bracket_cells(
    df: DataFrame, value: str, probs: Mapping[str, float], by: Sequence[str], few_groups: bool
) -> DataFrame:
    """(by, n, i, v, c): the distinct values inside the i-th bracket with their rows; the
    rows left of it count under a null."""
    bounds = brackets(df, value, probs, by)
    if not by:
        row = bounds.select(F.struct(*bounds.columns).alias("b")).scalar()
        rows = df.select(F.col(value).alias("v"), row.alias("b"))
    else:
        held = F.broadcast(bounds) if few_groups else hold_small(bounds)
        fields = [c for c in bounds.columns if c not in by]
        rows = attach(df.select(*by, F.col(value).alias("v")), held, by)
        rows = rows.select(*by, "v", F.struct(*fields).alias("b"))
    # Partial aggregation collapses what is left of a bracket to one row a task.
    hits = [
        F.when(
            F.col("v") <= F.col(f"b.hi_{i}"),
            F.struct(F.lit(i).alias("i"), F.when(F.col("v") >= F.col(f"b.lo_{i}"), F.col("v")).alias("v")),
        )
        for i in range(len(probs))
    ]
    inside = F.explode(F.filter(F.array(*hits), lambda h: h.isNotNull())).alias("h")
    each = rows.select(*by, F.col("b.n").alias("n"), inside).select(*by, "n", "h.i", "h.v")
    return each.groupBy(*by, "n", "i", "v").agg(F.count(F.lit(1)).alias("c"))


def quantiles(
    df: DataFrame,
    value: str,
    probs: Mapping[str, float],
    by: Sequence[str] = (),
    few_groups: bool = False,
) -> DataFrame:
    """Exact linearly interpolated quantiles per group: columns `by`, n and one per name."""
    by = list(by)
    known = df.where(F.col(value).isNotNull())
    cells = bracket_cells(known, value, probs, by, few_groups)
    ranked = running_totals(cells, "v", ["c"], [*by, "n", "i"], few_groups=few_groups or not by)
    picks, out = [], [*by, "n"]
    for i, (name, p) in enumerate(probs.items()):
        at = F.lit(float(p)) * (F.col("n") - 1)
        for side, index in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            hit = (F.col("i") == i) & (F.col("c_before") <= index) & (index < F.col("c_upto"))
            picks.append(F.max(F.when(hit, F.col("v"))).alias(f"__{name}_{side}"))
        lo, hi = F.col(f"__{name}_lo"), F.col(f"__{name}_hi")
        out.append((lo + (hi - lo) * (at - F.floor(at))).alias(name))
    found = ranked.groupBy(*by, "n").agg(*picks)
    if not by:  # one row, also without any value
        found = found.agg(F.coalesce(F.max("n"), F.lit(0)).alias("n"), *[F.max(c).alias(c) for c in found.columns if c != "n"])
    return found.select(*out)


def average_ranks(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Distinct values with their count n and the mean rank of their ties."""
    ranked = running_totals(value_cells(df, value, by), value, ["n"], by)
    return ranked.select(
        *by, value, "n", (F.col("n_before") + (F.col("n") + 1) / 2).alias("avg_rank")
    )


def next_in_order(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str,
    unique: bool = False,
) -> DataFrame:
    """Adds `name`: `value` of the following row of the group in the given order.

    With `unique` the caller vouches that (by, order[0]) identifies a row, so a group is
    as small as the range of order[0] and one window does. Otherwise a group may be of
    any size: it is cut by order[0] and by slices of order[1], and the last row of each
    piece takes the first row of the next piece.
    """
    if unique:
        return df.withColumn(name, F.lead(value).over(Window.partitionBy(*by).orderBy(*order)))
    first, rest = order[0], list(order[1:]) or [value]
    # Slices by the first parts of the order, as one of them alone may never change.
    pieces = sliced(df.withColumn("__order", F.struct(*rest[:3])), "__order").drop("__order")
    keys = [*by, first, "__slice"]
    inside = Window.partitionBy(*keys).orderBy(*rest)
    heads = pieces.groupBy(*keys).agg(F.min(F.struct(*rest, F.col(value).alias("__v"))).alias("__h"))
    following = Window.partitionBy(*by).orderBy(first, "__slice")
    heads = heads.select(*keys, F.lead(F.struct("__h.__v")).over(following).alias("__following"))
    marked = pieces.withColumn("__in", F.lead(F.struct(F.col(value).alias("__v"))).over(inside))
    # A struct keeps "the next row holds NULL" apart from "there is no next row".
    return (
        attach(marked, heads, keys)
        .withColumn(name, F.coalesce("__in", "__following")["__v"])
        .drop("__slice", "__in", "__following")
    )
