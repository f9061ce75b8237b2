"""Quality by naive Bayes support vectors.

Indicators of word and shape n-grams are scaled by their class log-count ratio, and a linear
hinge-loss model is fitted on the scaled unit vectors by dual coordinate descent. Margins
become probabilities by a sigmoid fitted on a fold that the descent did not see. Documents
are scored where they are read: no shuffle.

Null and empty texts have no n-gram and score by the bias. Repeated rows score alike. With
no labelled rows of both classes every score is 0.5. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stratline.llm import labelled, texts

PARTS, HELD_OUT = 4, 2
THRESHOLD = 0.7
LETTERS, SIGNS = 1, 2
KINDS = np.where(texts.ALNUM == 1, LETTERS, np.where(texts.SPACE == 1, SIGNS, 0)).astype(np.uint8)
KINDS[48:58] = 3
UPPER = np.zeros(256, bool)
UPPER[65:91] = True


@dataclass(frozen=True)
class Training:
    max_docs: int = 5000  # of each class
    min_docs: int = 4
    features: int = 32_768
    cost: float = 1.0
    passes: int = 20
    seed: int = 7


def features(block: texts.Block) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of word 1- and 2-grams and of shape 1- to 3-grams, with their rows.

    The shape of a token is its sign run itself, or how a word is written (capitals, first
    capital, digits) and whether it repeats the word before."""
    tokens = block.runs(KINDS)
    row = tokens.row()
    word = block.hashes(fold=True).spans(tokens.start, tokens.end)
    capitals = block.sums(UPPER[block.data])
    upper = capitals[tokens.end] - capitals[tokens.start]
    size = tokens.end - tokens.start
    first = UPPER[block.data[tokens.start]]
    shape = np.select([tokens.kind == 3, (upper * 2 > size) & (size > 1), first], [1, 2, 3], 4)
    again = np.zeros(len(tokens), bool)
    again[1:] = (word[1:] == word[:-1]) & (row[1:] == row[:-1])
    shape = texts.mix((shape + 8 * again).astype(np.uint64))
    shape = np.where(tokens.kind == SIGNS, word, shape)
    out = []
    for salt, (hashes, sizes) in enumerate(((word, (1, 2)), (shape, (1, 2, 3)))):
        for n in sizes:
            at, gram = texts.grams(hashes, row, n)
            out.append((texts.salted(gram, salt), row[at]))
    return np.concatenate([h for h, _ in out]), np.concatenate([r for _, r in out])


def vectors(block: texts.Block, vocabulary: texts.Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Vocabulary positions of the distinct n-grams of each row, and the rows, in order."""
    h, row = features(block)
    at = vocabulary.find(h)
    used = at >= 0
    key = np.unique(row[used].astype(np.int64) << 32 | at[used])
    return (key & 0xFFFFFFFF).astype(np.int64), key >> 32


@dataclass
class Model:
    hashes: np.ndarray
    ratios: np.ndarray
    weights: np.ndarray  # of the scaled unit vectors; the last one is the bias
    slope: float
    shift: float

    def __post_init__(self):
        self.vocabulary = texts.Vocabulary(self.hashes)

    def margins(self, block: texts.Block) -> np.ndarray:
        at, row = vectors(block, self.vocabulary)
        norm = np.sqrt(np.bincount(row, self.ratios[at] ** 2, block.rows))
        raw = np.bincount(row, self.ratios[at] * self.weights[at], block.rows)
        return raw / np.maximum(norm, 1e-12) + self.weights[-1]

    def scores(self, block: texts.Block) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(block) + self.shift, -30, 30)))


def descend(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, cost: np.ndarray, size: int, plan: Training) -> np.ndarray:
    """Dual coordinate descent for the hinge loss: one dual variable at a time, in random
    order, each kept between 0 and its row's cost."""
    w = np.zeros(size + 1)
    dual = np.zeros(len(rows))
    square = np.array([v @ v + 1 for _, v in rows])
    sign = np.where(y == 1, 1.0, -1.0)
    draw = np.random.default_rng(plan.seed)
    for _ in range(plan.passes):
        moved = 0.0
        for k in draw.permutation(len(rows)):
            at, v = rows[k]
            gradient = sign[k] * (w[at] @ v + w[-1]) - 1
            new = min(max(dual[k] - gradient / square[k], 0.0), cost[k])
            step = (new - dual[k]) * sign[k]
            if step:
                dual[k] = new
                w[at] += step * v
                w[-1] += step
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, plan: Training = Training()) -> Model:
    """Train on a bounded sample of the labelled documents that are not held out."""
    rows = labelled.sample(docs, labels, "quality", PARTS, HELD_OUT, plan.max_docs).persist()
    sizes = labelled.sizes_of(rows)
    if not min(sizes):
        rows.unpersist()
        return Model(np.zeros(0, np.uint64), np.zeros(0), np.zeros(1), 0.0, 0.0)
    hashes, ratios = labelled.telling(labelled.class_counts(rows, features), sizes, plan.min_docs, plan.features)
    known = rows.sparkSession.sparkContext.broadcast((hashes, ratios))

    def shrink(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = texts.Vocabulary(known.value[0])
        for batch in batches:
            for block in texts.blocks(batch.column(0)):
                at, row = vectors(block, vocabulary)
                cuts = np.searchsorted(row, np.arange(block.rows + 1)).astype(np.int32)
                part = slice(block.first_row, block.first_row + block.rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(pa.array(batch.column(k).to_numpy(zero_copy_only=False)[part]) for k in (1, 2, 3)),
                        pa.ListArray.from_arrays(pa.array(cuts), pa.array(at.astype(np.int32))),
                    ],
                    names=["label", "fold", "n", "features"],
                )

    def learn(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio = known.value[1]
        vecs, y, fold, count = [], [], [], []
        for batch in batches:
            y += batch.column(0).to_pylist()
            fold += batch.column(1).to_pylist()
            count += batch.column(2).to_pylist()
            for x in batch.column(3):
                at = np.asarray(x.values, np.int64)
                v = ratio[at]
                vecs.append((at, v / max(np.sqrt(v @ v), 1e-12)))
        y, fold, count = np.array(y), np.array(fold), np.array(count)
        weight = count / np.where(y == 1, sizes[1], sizes[0])
        seen = np.flatnonzero(fold > 0)
        if len(set(y[seen])) < 2:
            seen = np.arange(len(y))
        even = plan.cost * len(y) / (2 * np.where(y == 1, sizes[1], sizes[0]))  # classes weigh alike
        w = descend([vecs[k] for k in seen], y[seen], even[seen], len(ratio), plan)
        test = np.flatnonzero(fold == 0)
        if len(set(y[test])) < 2:
            test = np.arange(len(y))
        margin = np.array([w[vecs[k][0]] @ vecs[k][1] + w[-1] for k in test])
        a, b = labelled.platt(margin, y[test], weight[test])
        yield pa.RecordBatch.from_arrays([pa.array([w.tolist()]), pa.array([a]), pa.array([b])], names=["w", "a", "b"])

    shrunk = rows.mapInArrow(shrink, "label int, fold int, n double, features array<int>")
    fitted = shrunk.coalesce(1).mapInArrow(learn, "w array<double>, a double, b double").first()  # a bounded sample
    rows.unpersist()
    return Model(hashes, ratios, np.array(fitted.w), fitted.a, fitted.b)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted of every whole text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in texts.blocks(texts.column(batch, "text")):
                p = sent.value.scores(block)
                rows = batch.slice(block.first_row, block.rows)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(2), pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32))],
                    names=["doc_id", "held_out", "score", "predicted"],
                )

    rows = docs.select(
        F.col("doc_id").cast("bigint"), F.col("text").cast("string"), labelled.held_out(F.col("doc_id"), PARTS, HELD_OUT).alias("held_out")
    )
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int")
