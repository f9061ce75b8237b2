"""Model quality as aggregates over predictions (y, prediction, score)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from stratline.operators.ordering import running_totals

REGRESSION = ["mae", "mse", "rmse", "r2"]
CLASSIFICATION = ["accuracy", "precision", "recall", "f1"]


def regression(
    pred: DataFrame, by: Sequence[str] = (), y: str = "y", prediction: str = "prediction"
) -> DataFrame:
    """n, mae, mse, rmse and r2 per group, over rows with a known y.

    The total sum of squares is taken around the group's own mean. When y is constant, r2
    is 1 for exact predictions and 0 otherwise; of a single row it is NULL.
    """
    error = F.col(y) - F.col(prediction)
    sums = (
        pred.where(F.col(y).isNotNull())
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(F.abs(error)).alias("mae"),
            F.avg(error * error).alias("mse"),
            F.var_pop(y).alias("__var"),
        )
    )
    r2 = (
        F.when(F.col("n") < 2, None)
        .when(F.col("__var") > 0, 1 - F.try_divide("mse", "__var"))
        .otherwise((F.col("mse") == 0).cast("double"))
    )
    return sums.select(
        *by, "n", "mae", "mse", F.sqrt("mse").alias("rmse"), r2.cast("double").alias("r2")
    )


def _counts(y, p):
    return {
        "tp": F.count_if((y == 1) & (p == 1)),
        "fp": F.count_if((y == 0) & (p == 1)),
        "fn": F.count_if((y == 1) & (p == 0)),
        "tn": F.count_if((y == 0) & (p == 0)),
    }


def confusion_counts(
    pred: DataFrame, by: Sequence[str] = (), y: str = "y", prediction: str = "prediction"
) -> DataFrame:
    counts = _counts(F.col(y), F.col(prediction))
    return (
        pred.where(F.col(y).isNotNull())
        .groupBy(*by)
        .agg(*[c.alias(name) for name, c in counts.items()])
    )


def _ratio(top, bottom):
    """Division that is 0 where there is nothing to divide by."""
    return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))


def classification(
    pred: DataFrame, by: Sequence[str] = (), y: str = "y", prediction: str = "prediction"
) -> DataFrame:
    """accuracy, precision, recall, f1 of the positive class and support-weighted f1."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    f1 = _ratio(2 * tp, 2 * tp + fp + fn)
    f1_negative = _ratio(2 * tn, 2 * tn + fp + fn)
    n = tp + fp + fn + tn
    return confusion_counts(pred, by, y, prediction).select(
        *by,
        n.alias("n"),
        _ratio(tp + tn, n).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        f1.alias("f1"),
        _ratio(f1 * (tp + fn) + f1_negative * (tn + fp), n).alias("weighted_f1"),
    )


def confusion_matrix(
    pred: DataFrame, by: Sequence[str] = (), y: str = "y", prediction: str = "prediction"
) -> DataFrame:
    """Four rows (actual, predicted, n) per group, cells with zero included."""
    cells = F.array(
        *[
            F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(c).alias("n"))
            for a, p, c in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))
        ]
    )
    counts = confusion_counts(pred, by, y, prediction)
    return counts.select(*by, F.explode(cells).alias("c")).select(*by, "c.*")


def _score_steps(
    pred: DataFrame, by: Sequence[str], y: str, score: str, few_groups: bool
) -> DataFrame:
    known = pred.where(F.col(y).isNotNull() & F.col(score).isNotNull())
    cells = known.groupBy(*by, score).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) == 0).alias("neg")
    )
    return running_totals(
        cells, score, ["pos", "neg"], by, descending=True, few_groups=few_groups
    )


def roc_points(
    pred: DataFrame, by: Sequence[str] = (), y: str = "y", score: str = "score",
    few_groups: bool = False,
) -> DataFrame:
    """The curve from its origin (threshold infinity), one point per distinct score: share
    of negatives and positives at or above it."""

    def point(threshold, neg, pos):
        return F.struct(
            threshold.cast("double").alias("threshold"),
            F.try_divide(neg, F.col("neg_all")).alias("fpr"),
            F.try_divide(pos, F.col("pos_all")).alias("tpr"),
        )

    here = point(F.col(score), F.col("neg_upto"), F.col("pos_upto"))
    origin = point(F.lit(float("inf")), F.lit(0), F.lit(0))
    highest = F.col("pos_before") + F.col("neg_before") == 0
    points = F.when(highest, F.array(origin, here)).otherwise(F.array(here))
    steps = _score_steps(pred, by, y, score, few_groups)
    return steps.select(*by, F.explode(points).alias("p")).select(*by, "p.*")


def roc_auc(
    pred: DataFrame, by: Sequence[str] = (), y: str = "y", score: str = "score",
    one_class: float | None = None, few_groups: bool = False,
) -> DataFrame:
    """Tie-aware area under the ROC curve; `one_class` where only one class occurs.

    `few_groups`: the groups are models, splits or folds, see running_totals.
    """
    area = F.sum(F.col("neg") * (F.col("pos_before") + F.col("pos") / 2))
    auc = F.try_divide(area, F.max("pos_all") * F.max("neg_all").cast("double"))
    return (
        _score_steps(pred, by, y, score, few_groups)
        .groupBy(*by)
        .agg(F.coalesce(auc, F.lit(one_class).cast("double")).alias("roc_auc"))
    )


def to_long(wide: DataFrame, by: Sequence[str], names: Sequence[str]) -> DataFrame:
    """One row per group and measure: (by, metric, value)."""
    pairs = F.array(
        *[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in names]
    )
    return wide.select(*by, F.explode(pairs).alias("p")).select(*by, "p.*")
