"""Toxicity by multiple-instance learning: a document is toxic if any sentence is.

Each sentence gets a probability from a linear model on its words and word beginnings; the
document's probability is their noisy-or. Only documents are labelled, so the sentence
model is trained through the noisy-or by gradient ascent, and afterwards points at the
sentences that offend. Documents are scored where they are read: no shuffle.

Null and empty texts have no sentence and score as the empty product (close to 0). Repeated
rows score alike. With no labelled rows of both classes everything scores the prior of the
model, close to 0. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from stratline.llm import labelled, texts

PARTS, HELD_OUT = 5, 0
THRESHOLD = 0.5
PREFIXES = (4, 5, 6)
ENDS = np.zeros(256, bool)
ENDS[list(b".!?\n")] = True
BACKGROUND = -9.0  # where the bias begins: log-odds of a sentence with no telling feature


@dataclass(frozen=True)
class Training:
    max_docs: int = 5000  # of each class
    min_docs: int = 4
    features: int = 32_768
    steps: int = 300
    rate: float = 0.15
    penalty: float = 1e-5


def sentences(block: texts.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, texts.Tokens]:
    """Feature hashes, their sentence (numbered over the block) and row, and the words."""
    words = block.runs(texts.ALNUM)
    hashes = block.hashes(fold=True)
    row = words.row()
    sentence = block.sums(ENDS[block.data])[words.start] + row
    size = words.end - words.start
    found = [texts.salted(hashes.spans(words.start, words.end), 0)]
    token = [np.arange(len(words))]
    for n in PREFIXES:
        long = np.flatnonzero(size > n)
        found.append(texts.salted(hashes.spans(words.start[long], words.start[long] + n), n))
        token.append(long)
    token = np.concatenate(token)
    order = np.argsort(token, kind="stable")
    token = token[order]
    return np.concatenate(found)[order], sentence[token], row[token], words


def features(block: texts.Block) -> tuple[np.ndarray, np.ndarray]:
    h, _, row, _ = sentences(block)
    return h, row


@dataclass
class Model:
    hashes: np.ndarray
    weights: np.ndarray
    bias: float

    def __post_init__(self):
        self.vocabulary = texts.Vocabulary(self.hashes)

    def sentence_scores(self, block: texts.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Log-odds, row, first and last byte of every sentence with a word."""
        h, sentence, _, words = sentences(block)
        at = self.vocabulary.find(h)
        used = at >= 0
        number = block.sums(ENDS[block.data])[words.start] + words.row()
        which, first, inverse = np.unique(number, return_index=True, return_inverse=True)
        last = np.zeros(len(which), np.int64)
        last[inverse] = words.end
        slot = np.searchsorted(which, sentence[used])
        odds = self.bias + np.bincount(slot, self.weights[at[used]], len(which))
        return odds, words.row()[first], words.start[first], last

    def scores(self, block: texts.Block) -> np.ndarray:
        odds, row, _, _ = self.sentence_scores(block)
        return -np.expm1(-np.bincount(row, np.logaddexp(0, odds), block.rows))


def noisy_or_fit(docs: list[tuple[int, float, np.ndarray, np.ndarray]], size: int, plan: Training) -> tuple[np.ndarray, float]:
    """Weights and bias from (label, weight, features, their sentence numbers) of documents.

    Adam on the weighted log-likelihood of the noisy-or."""
    at, slot, owner, n = [], [], [], 0
    for d, (_, _, feats, number) in enumerate(docs):
        which, inverse = np.unique(number, return_inverse=True)
        at.append(feats)
        slot.append(inverse + n)
        owner.append(np.full(len(which), d))
        n += len(which)
    at, slot, owner = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (at, slot, owner))
    y = np.array([d[0] for d in docs], float)
    weight = np.array([d[1] for d in docs], float)
    weight /= max(weight.sum(), 1e-12)
    w, b = np.zeros(size), BACKGROUND
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, plan.steps + 1):
        odds = b + np.bincount(slot, w[at], n)
        total = np.maximum(np.bincount(owner, np.logaddexp(0, odds), len(docs)), 1e-12)
        pull = weight * np.where(y == 1, 1 / np.expm1(np.minimum(total, 50)), -1)
        toward = pull[owner] / (1 + np.exp(-np.clip(odds, -40, 40)))
        grad = np.append(np.bincount(at, toward[slot], size) - plan.penalty * w, toward.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        move = plan.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
        w, b = w + move[:-1], b + move[-1]
    return w, float(b)


def fit(docs: DataFrame, labels: DataFrame, plan: Training = Training()) -> Model:
    """Train on a bounded sample of the labelled documents that are not held out."""
    rows = labelled.sample(docs, labels, "toxic", PARTS, HELD_OUT, plan.max_docs).persist()
    sizes = labelled.sizes_of(rows)
    if not min(sizes):
        rows.unpersist()
        return Model(np.zeros(0, np.uint64), np.zeros(0), BACKGROUND)
    hashes, _ = labelled.telling(labelled.class_counts(rows, features), sizes, plan.min_docs, plan.features)
    known = rows.sparkSession.sparkContext.broadcast(hashes)

    def shrink(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = texts.Vocabulary(known.value)
        for batch in batches:
            for block in texts.blocks(batch.column(0)):
                h, sentence, row, _ = sentences(block)
                at = vocabulary.find(h)
                used = at >= 0
                cuts = np.searchsorted(row[used], np.arange(block.rows + 1)).astype(np.int32)
                part = slice(block.first_row, block.first_row + block.rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(pa.array(batch.column(k).to_numpy(zero_copy_only=False)[part]) for k in (1, 2)),
                        pa.ListArray.from_arrays(pa.array(cuts), pa.array(at[used].astype(np.int32))),
                        pa.ListArray.from_arrays(pa.array(cuts), pa.array(sentence[used].astype(np.int32))),
                    ],
                    names=["label", "n", "features", "sentences"],
                )

    def learn(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drawn = []
        for batch in batches:
            label, n, feats, number = batch.columns
            drawn += [
                (y, count / sizes[y], np.asarray(f, np.int64), np.asarray(s, np.int64))
                for y, count, f, s in zip(label.to_pylist(), n.to_pylist(), (x.values for x in feats), (x.values for x in number))
            ]
        w, b = noisy_or_fit(drawn, len(known.value), plan)
        yield pa.RecordBatch.from_arrays([pa.array([w.tolist()]), pa.array([b])], names=["w", "b"])

    shrunk = rows.select("text", "label", "n").mapInArrow(shrink, "label int, n double, features array<int>, sentences array<int>")
    fitted = shrunk.coalesce(1).mapInArrow(learn, "w array<double>, b double").first()  # a bounded sample
    rows.unpersist()
    return Model(hashes, np.array(fitted.w), fitted.b)


def worst_sentences(block: texts.Block, odds: np.ndarray, row: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Per row: sentences at the threshold, start and end (code points) and score of the
    worst one, the first in a tie, and whether there is any sentence."""
    order = np.lexsort((-np.arange(len(odds)), odds, row))
    last = np.flatnonzero(np.append(row[order][1:] != row[order][:-1], True)) if len(row) else np.zeros(0, np.int64)
    pick = order[last]
    points = block.sums((block.data & 0xC0) != 0x80)
    out = {name: np.zeros(block.rows, kind) for name, kind in (("start", np.int64), ("end", np.int64), ("score", float), ("any", bool))}
    own = row[pick]
    out["start"][own] = points[start[pick]] - points[block.bounds[own]]
    out["end"][own] = points[end[pick]] - points[block.bounds[own]]
    out["score"][own], out["any"][own] = 1 / (1 + np.exp(-odds[pick])), True
    count = np.bincount(row, 1 / (1 + np.exp(-odds)) >= THRESHOLD, block.rows).astype(np.int64)
    return count, out


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted of every whole text, and where it offends: number
    of sentences that reach the threshold by themselves, place and score of the worst one
    (null without a sentence)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names = ["doc_id", "held_out", "score", "predicted", "n_offending", "worst_start", "worst_end", "worst_score"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in texts.blocks(texts.column(batch, "text")):
                odds, row, start, end = sent.value.sentence_scores(block)
                p = -np.expm1(-np.bincount(row, np.logaddexp(0, odds), block.rows))
                count, worst = worst_sentences(block, odds, row, start, end)
                rows = batch.slice(block.first_row, block.rows)
                places = [pa.array(worst[c], mask=~worst["any"]) for c in ("start", "end", "score")]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(2), pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32)), pa.array(count), *places],
                    names=names,
                )

    rows = docs.select(
        F.col("doc_id").cast("bigint"), F.col("text").cast("string"), labelled.held_out(F.col("doc_id"), PARTS, HELD_OUT).alias("held_out")
    )
    schema = "doc_id bigint, held_out boolean, score double, predicted int, n_offending bigint, worst_start bigint, worst_end bigint, worst_score double"
    return rows.mapInArrow(run, schema)


def offending(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The sentences that reach the threshold by themselves: doc_id, sentence, score."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in texts.blocks(texts.column(batch, "text")):
                odds, row, start, end = sent.value.sentence_scores(block)
                p = 1 / (1 + np.exp(-odds))
                hit = np.flatnonzero(p >= threshold)
                said = [block.data[start[k] : end[k]].tobytes().decode() for k in hit]
                ids = batch.column(0).take(pa.array(block.first_row + row[hit]))
                yield pa.RecordBatch.from_arrays([ids, pa.array(said, pa.string()), pa.array(p[hit])], names=["doc_id", "sentence", "score"])

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id bigint, sentence string, score double")


def reject(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that are not predicted toxic, all columns as they are."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = pc.cast(texts.column(batch, "text"), pa.string())
            bad = [sent.value.scores(block) >= THRESHOLD for block in texts.blocks(text)]
            yield batch.filter(pa.array(~np.concatenate(bad))) if bad else batch

    return docs.mapInArrow(run, docs.schema)
