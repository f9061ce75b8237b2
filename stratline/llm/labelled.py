"""What both text classifiers share: a bounded training sample and a hashed vocabulary.

A classifier is fitted on a bounded sample of labelled rows: for each class the max_docs
rows with the smallest hash of the doc_id. The bound is a parameter; everything is
scored. Weights of a row stand for the labelled rows of its class that were not drawn.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stratline.llm import texts

Features = Callable[[texts.Block], tuple[np.ndarray, np.ndarray]]
"""Block -> hash of each feature, and the row it belongs to (rows in order)."""


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves the held-out remainder; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(True))


def sample(docs: DataFrame, labels: DataFrame, label: str, parts: int, part: int, max_docs: int) -> DataFrame:
    """(text, label, weight, fold) of at most max_docs labelled rows of each class.

    Only rows that are not held out are looked at. A document with several labels counts
    once, with the larger one; documents without a usable label are left out.
    """
    marks = (
        labels.select(F.col("doc_id").cast("bigint").alias("id"), F.col(label).cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & ~held_out(F.col("id"), parts, part))
        .groupBy("id")
        .agg(F.max("label").alias("label"))
    )
    ids = docs.select(F.col("doc_id").cast("bigint").alias("id")).where("id is not null")
    known = ids.join(marks, "id").distinct().withColumn("draw", F.xxhash64("id"))  # no texts yet
    drawn = None
    for value in (0, 1):
        some = known.where(F.col("label") == value).orderBy("draw", "id").limit(max_docs)
        drawn = some if drawn is None else drawn.unionByName(some)
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    # At most 2 * max_docs ids are sent to the texts; of several texts of an id one is used.
    drawn = rows.join(F.broadcast(drawn), "id").dropDuplicates(["id"])
    totals = marks.groupBy("label").agg(F.count("*").alias("n"))
    return (
        drawn.withColumn("fold", F.pmod("draw", F.lit(5)).cast("int"))
        .join(F.broadcast(totals), "label")  # two rows
        .select("text", "label", "fold", F.col("n").cast("double").alias("n"))
    )


def distinct_features(block: texts.Block, features: Features) -> tuple[np.ndarray, np.ndarray]:
    """Features of a block, each once for a row; rows in order."""
    h, row = features(block)
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return h[fresh], row[fresh]


def class_counts(rows: DataFrame, features: Features) -> DataFrame:
    """(feature, n0, n1): in how many rows of each class a feature occurs."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column(1).to_numpy(zero_copy_only=False)
            for block in texts.blocks(batch.column(0)):
                h, row = distinct_features(block, features)
                y = label[block.first_row : block.first_row + block.rows][row]
                key, inverse = np.unique(h, return_inverse=True)
                n = [np.bincount(inverse, y == v, len(key)).astype(np.int64) for v in (0, 1)]
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), *map(pa.array, n)], names=["feature", "n0", "n1"])

    counted = rows.select("text", "label").mapInArrow(run, "feature bigint, n0 bigint, n1 bigint")
    return counted.groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def telling(counts: DataFrame, sizes: tuple[int, int], min_docs: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The features that separate the classes best, at most `most` of them.

    Returns their hashes and their log-count ratio (smoothed by one row of each class)."""
    p = (F.col("n1") + 1) / (sizes[1] + 2)
    q = (F.col("n0") + 1) / (sizes[0] + 2)
    ratio = F.log(p / q)
    # Signed root of the likelihood ratio, up to constants: ratio times the root of the count.
    strength = F.abs(ratio) * F.sqrt(F.col("n0") + F.col("n1"))
    best = (
        counts.where(F.col("n0") + F.col("n1") >= min_docs)
        .select("feature", ratio.alias("ratio"), strength.alias("strength"))
        .orderBy(F.desc("strength"), "feature")
        .limit(most)
        .collect()  # at most `most` rows, a parameter
    )
    return np.array([r.feature for r in best], np.int64).view(np.uint64), np.array([r.ratio for r in best], float)


def sizes_of(rows: DataFrame) -> tuple[int, int]:
    found = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    return found.get(0, 0), found.get(1, 0)


def platt(margin: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """a, b of the probability 1 / (1 + exp(-(a * margin + b))), by Newton's method."""
    a, b = 1.0, 0.0
    x = np.stack([margin, np.ones_like(margin)], 1)
    total = weight.sum()
    up, down = (weight[y == 1].sum() + total * 1e-3), (weight[y == 0].sum() + total * 1e-3)
    target = np.where(y == 1, 1 - 1e-3 * total / (up + total * 1e-3), 1e-3 * total / (down + total * 1e-3))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        grad = x.T @ (weight * (p - target)) + 1e-6 * total * np.array([a, 0])
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-6 * total * np.eye(2)
        step = np.linalg.solve(hess, grad)
        step *= min(1, 4 / (np.abs(step).max() + 1e-12))
        a, b = a - step[0], b - step[1]
    return float(a), float(b)
