"""Second-order histogram boosting whose passes over the rows are Spark aggregates.

Features are cut into bins at approximate quantiles. Rows that no sum can tell apart (same
bins, fold and draw, and label, or under squared loss its mean) become one with a count, and
are packed into written blocks. Every level of a tree is one aggregate: the sums of gradient
and hessian for each (node, feature, bin), over cached arrays, as a pass of its own query
would cost more than the sums. What reaches the driver does not depend on the
number of rows; it picks the split of each node by gain G_l^2 / (H_l + l2) + G_r^2 / (H_r + l2)
- G^2 / (H + l2) and the leaf value -G / (H + l2), times the rate. Ensembles that are fitted
together (models, or the folds of a cross-validation) grow in step, so a level of all of them
is one pass; the margins are carried on by each finished tree. Rows that one task holds
(250 000) have nothing to add up between tasks: there every ensemble grows in a task.

Rows are drawn for a tree by a hash of their values and the number of the tree: the draw
depends on nothing else, and copies of a row are drawn together. Nulls lie below all values.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import (
    HasFeaturesCol,
    HasPredictionCol,
    HasProbabilityCol,
    HasRawPredictionCol,
)
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession, functions as F

from stratline.models.trees import Ensemble, Plan, Tree, can_split, split

Cut = Callable[[DataFrame, str], DataFrame]

# Trees after which the margins of all rows are written anew; between them they are cached.
REFRESH = 16
# Different rows that one task grows its ensemble on: some 20 MB, and twice that in sums.
BLOCK_ROWS = 250_000
# Rows of a block; the arrays of a pass over it stay in the processor's cache.
PASS_ROWS = 10_000
# Sums of all partitions that a pass sends to the driver, at most.
SENT_BYTES = 16 << 20
KEPT = StorageLevel.MEMORY_AND_DISK
BLOCK_COLUMNS = ["bins", "y", "draw", "fold", "n", "margins"]
BLOCK_SCHEMA = ", ".join(f"{c} binary" for c in BLOCK_COLUMNS)


# --- bins -------------------------------------------------------------------------------


def cut_points(rows: DataFrame, features: Sequence[str], bins: int) -> list[list[float]]:
    """Ascending values that cut each feature into at most `bins` bins; value v is in bin
    number of cuts below v. One pass, with a sketch of bounded size for each feature."""
    grid = F.array(*[F.lit(i / bins) for i in range(bins)])
    picked = rows.agg(*[F.percentile_approx(f"`{c}`", grid, F.lit(100 * bins)).alias(f"c{i}") for i, c in enumerate(features)])
    found = picked.first()
    return [sorted(set(found[i] or [])) for i in range(len(features))]


def binned(x: np.ndarray, cuts: Sequence[Sequence[float]]) -> np.ndarray:
    """Rows x features of bins; NaN lies below all."""
    out = np.zeros(x.shape, np.uint8)
    for k, points in enumerate(cuts):
        v = x[:, k]
        out[:, k] = np.where(np.isnan(v), 0, np.searchsorted(np.asarray(points, float), v, "left"))
    return out


def merged(rows: DataFrame, features: Sequence[str], label: str, fold: str | None, cuts, plans: Sequence[Plan]) -> DataFrame:
    """(bins, y, draw, fold, n): rows that all sums of all plans take as one, and their number.

    Under squared loss only the mean label of rows with equal bins counts; under logistic
    loss the label itself does. Where a plan draws rows, those of different draws stay apart."""
    width = len(features)
    values = [F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float("nan"))) for c in features]
    y = F.col(label).cast("double")
    draw = F.xxhash64(*values, y) if any(p.subsample < 1 for p in plans) else F.lit(0).cast("bigint")
    flat = rows.select(
        F.array(*values).alias("x"), y.alias("y"), draw.alias("draw"),
        (F.col(fold) if fold else F.lit(0)).cast("int").alias("fold"),
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                bins = binned(x, cuts).tobytes()
                ends = np.arange(0, len(bins) + 1, width, dtype=np.int32)
                column = pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(ends), pa.py_buffer(bins)])
                yield pa.RecordBatch.from_arrays([column, *batch.columns[1:]], names=["bins", "y", "draw", "fold"])

    each = flat.mapInArrow(run, "bins binary, y double, draw bigint, fold int")
    keys = ["bins", "draw", "fold"]
    if any(p.logistic for p in plans):
        return each.groupBy(*keys, "y").agg(F.count("*").alias("n")).select("bins", "y", "draw", "fold", "n")
    return each.groupBy(*keys).agg(F.avg("y").alias("y"), F.count("*").alias("n")).select("bins", "y", "draw", "fold", "n")


def packed(rows: DataFrame, ensembles: int) -> DataFrame:
    """Blocks of merged rows: bins, labels, draws, folds, numbers and the margins of every ensemble."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(k, PASS_ROWS) for b in batches for k in range(0, b.num_rows, PASS_ROWS)):
            parts = [
                b"".join(batch.column(0).to_pylist()),
                *(batch.column(k).to_numpy(zero_copy_only=False).tobytes() for k in (1, 2)),
                batch.column(3).to_numpy(zero_copy_only=False).astype(np.int32).tobytes(),
                batch.column(4).to_numpy(zero_copy_only=False).astype(float).tobytes(),
                np.zeros((ensembles, batch.num_rows)).tobytes(),
            ]
            yield pa.RecordBatch.from_arrays([pa.array([p], pa.binary()) for p in parts], names=BLOCK_COLUMNS)

    return rows.mapInArrow(run, BLOCK_SCHEMA)


@dataclass
class Block:
    bins: np.ndarray
    y: np.ndarray
    draw: np.ndarray
    fold: np.ndarray
    n: np.ndarray
    margins: np.ndarray


def unpacked(row: Mapping, width: int) -> Block:
    y = np.frombuffer(row["y"], float)
    return Block(
        np.frombuffer(row["bins"], np.uint8).reshape(-1, width), y, np.frombuffer(row["draw"], np.uint64),
        np.frombuffer(row["fold"], np.int32), np.frombuffer(row["n"], float),
        np.frombuffer(row["margins"], float).reshape(-1, len(y)),
    )


def dealt(blocks: DataFrame, width: int) -> RDD:
    """The blocks as arrays, dealt out to all cores; a pass over them plans no query."""
    parts = blocks.sparkSession.sparkContext.defaultParallelism
    return blocks.repartition(parts).rdd.map(lambda row: unpacked(row.asDict(), width))


def written(blocks: RDD, cut: Cut, spark: SparkSession, name: str, width: int) -> RDD:
    """The blocks read back from a table of their own."""
    rows = blocks.map(lambda b: tuple(getattr(b, c).tobytes() for c in BLOCK_COLUMNS))
    return dealt(cut(spark.createDataFrame(rows, BLOCK_SCHEMA, verifySchema=False), name), width)


# --- passes -----------------------------------------------------------------------------


def drawn(draw: np.ndarray, plan: Plan, tree: int) -> np.ndarray:
    """Whether a row takes part in a tree: its hash, stirred by seed and tree, is low enough."""
    if plan.subsample >= 1:
        return np.ones(len(draw), bool)
    h = draw + np.uint64((plan.seed * 1_000_003 + tree + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return (h >> np.uint64(11)).astype(float) * 2.0**-53 < plan.subsample


def slopes(y: np.ndarray, margin: np.ndarray, plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and hessian of the loss of every row."""
    if not plan.logistic:
        return margin - y, np.ones(len(y))
    p = 1 / (1 + np.exp(-margin))
    weight = np.where(y > 0, plan.positive_weight, 1.0)
    return weight * (p - y), weight * p * (1 - p)


def add_sums(total, block: Block, base: np.ndarray, margin: np.ndarray, e: Ensemble, number: int, level: int, width: int, bins: int):
    """Add a block's gradient and hessian sums to total[2, nodes * width * bins]. base is the
    place of each (feature, row) within the sums of a node; the last tree of the ensemble,
    with this number, is the one that grows."""
    nodes = 2**level
    at = e.trees[-1].nodes(block.bins, level)
    used = (at >= nodes - 1) & drawn(block.draw, e.plan, number)
    if e.plan.without_fold is not None:
        used &= block.fold != e.plan.without_fold
    rows = slice(None) if used.all() else np.flatnonzero(used)
    weights = [w * block.n[rows] for w in slopes(block.y[rows], margin[rows], e.plan)]
    place = (at[rows] - (nodes - 1)) * (width * bins)
    for column in base:
        cell = place + column[rows]
        for out, w in zip(total, weights):
            out += np.bincount(cell, w, nodes * width * bins)


def places(block: Block, width: int, bins: int) -> np.ndarray:
    return np.ascontiguousarray((np.arange(width) * bins + block.bins).T)


def level_sums(blocks: RDD, ensembles: Sequence[Ensemble | None], number: int, level: int, width: int, bins: int):
    """(gradient, hessian) as arrays [ensemble, node of the level, feature, bin], zero for
    ensembles that rest.

    The last tree of each ensemble, with this number, is the one that grows; the margins of
    those before are in the blocks. Where the sums of all partitions are large they are
    added up in two steps."""
    shape = (len(ensembles), 2**level, width, bins)
    part = 2**level * width * bins
    growing = [e and Ensemble(e.plan, e.start, e.trees[-1:]) for e in ensembles]

    def run(some: Iterable[Block]) -> Iterator[np.ndarray]:
        total = np.zeros((2, len(growing) * part))
        for block in some:
            base = places(block, width, bins)
            for k, e in enumerate(growing):
                if e is not None:
                    add_sums(total[:, k * part : (k + 1) * part], block, base, e.start + block.margins[k], e, number, level, width, bins)
        yield total

    large = blocks.getNumPartitions() * 2 * len(growing) * part * 8 > SENT_BYTES
    out = blocks.mapPartitions(run).treeReduce(np.add, 2 if large else 1)
    return out[0].reshape(shape), out[1].reshape(shape)


def refreshed(blocks: RDD, ensembles: Sequence[Ensemble], number: int) -> RDD:
    """Blocks whose margins hold the tree of this number too."""
    last = [Ensemble(e.plan, 0.0, e.trees[number : number + 1]) for e in ensembles]

    def run(block: Block) -> Block:
        return replace(block, margins=np.stack([block.margins[k] + e.margins(block.bins) for k, e in enumerate(last)]))

    return blocks.map(run)


def starts(rows: DataFrame, label: str, fold: str | None, plans: Sequence[Plan]) -> list[float]:
    """Mean label (its log odds under logistic loss) of the rows each plan learns from."""
    by = F.col(fold) if fold else F.lit(0)
    found = rows.groupBy(by.alias("fold")).agg(F.sum(label).alias("s"), F.count(label).alias("n")).collect()
    out = []
    for plan in plans:
        some = [r for r in found if plan.without_fold is None or r["fold"] != plan.without_fold]
        n, s = sum(r["n"] for r in some), sum(float(r["s"] or 0) for r in some)
        if plan.logistic:
            up, down = plan.positive_weight * s + 1e-12, n - s + 1e-12
            out.append(float(np.clip(np.log(up / down), -20, 20)))
        else:
            out.append(s / n if n else 0.0)
    return out


def in_step(ensembles: Sequence[Ensemble], sums: Callable, grown: Callable[[int], None]) -> None:
    """Grow all trees of all ensembles. sums(open, level) gives the sums of a level for the
    ensembles that grow; grown(number) hears of every finished tree."""
    for number in range(max(e.plan.trees for e in ensembles)):
        for e in ensembles:
            if e.plan.trees > number:
                e.trees.append(Tree.stump(e.plan.depth))
        for level in range(max(e.plan.depth for e in ensembles)):
            open_ = [
                e if e.plan.trees > number and level < e.plan.depth and can_split(e.trees[-1], level) else None
                for e in ensembles
            ]
            if not any(open_):
                break
            g, h = sums(open_, level)
            for k, e in enumerate(open_):
                if e is not None:
                    split(e.trees[-1], level, g[k], h[k], e.plan)
        grown(number)


def grow(
    rows: DataFrame, features: Sequence[str], label: str, plans: Sequence[Plan], cut: Cut, bins: int = 64, fold: str | None = None
) -> tuple[list[list[float]], list[Ensemble]]:
    """Cut points, and an ensemble for every plan."""
    if bins > 256:
        raise ValueError("at most 256 bins")
    width = len(features)
    cuts = cut_points(rows, features, bins - 1)
    ensembles = [Ensemble(p, s) for p, s in zip(plans, starts(rows, label, fold, plans))]
    blocks = cut(packed(merged(rows, features, label, fold, cuts, plans), len(plans)), "blocks-0")
    if (blocks.agg(F.sum(F.octet_length("n"))).first()[0] or 0) // 8 <= BLOCK_ROWS:
        return cuts, grown_in_tasks(blocks, ensembles, width, bins)
    held, stale, tree = dealt(blocks, width).persist(KEPT), None, 0

    def sums(open_: Sequence[Ensemble | None], level: int):
        nonlocal stale
        found = level_sums(held, open_, tree, level, width, bins)
        if stale is not None:  # the pass has filled what replaces it
            stale.unpersist()
            stale = None
        return found

    def grown(number: int) -> None:
        nonlocal held, stale, tree
        fresh = refreshed(held, ensembles, number)
        if (number + 1) % REFRESH == 0:
            fresh = written(fresh, cut, rows.sparkSession, f"blocks-{number + 1}", width)
        if stale is not None:  # no level of this tree was looked at
            stale.unpersist()
        held, stale, tree = fresh.persist(KEPT), held, number + 1

    try:
        in_step(ensembles, sums, grown)
    finally:
        held.unpersist()
        if stale is not None:
            stale.unpersist()
    return cuts, ensembles


def grown_in_tasks(blocks: DataFrame, ensembles: Sequence[Ensemble], width: int, bins: int) -> list[Ensemble]:
    """The same trees where all rows are one block: its sums are the sums, so each ensemble
    grows within one task, and ensembles side by side."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        e = ensembles[key[0].as_py()]
        parts = [unpacked(row, width) for row in table.to_pylist()]
        names = BLOCK_COLUMNS[:-1]
        block = Block(*(np.concatenate([getattr(p, n) for p in parts]) for n in names), np.zeros((0, 0)))
        base, margin = places(block, width, bins), np.full(len(block.y), e.start)

        def sums(open_: Sequence[Ensemble | None], level: int):
            total = np.zeros((2, 2**level * width * bins))
            add_sums(total, block, base, margin, e, len(e.trees) - 1, level, width, bins)
            return total.reshape(2, 1, 2**level, width, bins)

        def grown(number: int) -> None:
            tree = e.trees[-1]
            margin[:] += tree.value[tree.nodes(block.bins, e.plan.depth)]

        in_step([e], sums, grown)
        return pa.table({"e": [key[0].as_py()], "trees": [trees_text(e)]})

    numbers = F.explode(F.sequence(F.lit(0), F.lit(len(ensembles) - 1)))
    each = blocks.select("*", numbers.alias("e")).repartition(len(ensembles), "e")
    for r in each.groupBy("e").applyInArrow(run, "e bigint, trees string").collect():
        ensembles[r["e"]].trees.extend(trees_of(r["trees"]))
    for e in ensembles:  # of no rows at all
        e.trees.extend(Tree.stump(e.plan.depth) for _ in range(e.plan.trees - len(e.trees)))
    return list(ensembles)


def trees_text(e: Ensemble) -> str:
    return json.dumps([[t.feature.tolist(), t.bin.tolist(), t.value.tolist(), t.gain.tolist()] for t in e.trees])


def trees_of(text: str) -> list[Tree]:
    return [Tree(np.array(f, int), np.array(b, int), np.array(v), np.array(g)) for f, b, v, g in json.loads(text)]


# --- Spark ML stages --------------------------------------------------------------------


class _Boosted(Model, HasFeaturesCol, HasPredictionCol, DefaultParamsWritable, DefaultParamsReadable):
    """An ensemble and its cut points, kept as text in a parameter so that it can be saved."""

    content = Param(Params._dummy(), "content", "cut points and trees", TypeConverters.toString)

    def __init__(self, cuts=None, ensemble: Ensemble | None = None, **columns):
        super().__init__()
        if ensemble is not None:
            kept = {"cuts": cuts, "start": ensemble.start, "depth": ensemble.plan.depth, "trees": trees_text(ensemble)}
            self._set(content=json.dumps(kept))
        self._set(**columns)

    def ensemble(self) -> tuple[list[list[float]], Ensemble]:
        kept = json.loads(self.getOrDefault(self.content))
        return kept["cuts"], Ensemble(Plan(depth=kept["depth"]), kept["start"], trees_of(kept["trees"]))

    @property
    def featureImportances(self) -> DenseVector:
        """Gain by feature, as a share of every tree's, averaged over the trees."""
        cuts, ensemble = self.ensemble()
        out = np.zeros(len(cuts))
        for tree in ensemble.trees:
            used = tree.feature >= 0
            if used.any():
                out += np.bincount(tree.feature[used], tree.gain[used] / tree.gain[used].sum(), len(cuts))
        return DenseVector(out / max(out.sum(), 1e-300))

    def margin(self, df: DataFrame):
        cuts, ensemble = self.ensemble()

        def predict(x: pd.Series) -> pd.Series:
            bins = binned(np.stack(x.to_numpy()).astype(float), cuts) if len(x) else np.zeros((0, len(cuts)), np.uint8)
            return pd.Series(ensemble.start + ensemble.margins(bins))

        return F.pandas_udf(predict, "double")(vector_to_array(F.col(self.getFeaturesCol())))


class BoostedRegression(_Boosted):
    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.getPredictionCol(), self.margin(df))


class BoostedClassification(_Boosted, HasProbabilityCol, HasRawPredictionCol):
    def _transform(self, df: DataFrame) -> DataFrame:
        name = self.getRawPredictionCol()
        df = df.withColumn(name, self.margin(df))
        raw, p = F.col(name), 1 / (1 + F.exp(-F.col(name)))
        return df.withColumns(
            {
                self.getProbabilityCol(): array_to_vector(F.array(1 - p, p)),
                self.getPredictionCol(): (p > 0.5).cast("double"),
                name: array_to_vector(F.array(-raw, raw)),
            }
        )
