"""Quality rules on repetition: characters inside duplicated n-grams and lines.

Rolling hashes of the words give the hash of every n-gram in one pass for each length; the
share of a text's characters that lie in n-grams (or lines) seen twice decides. Texts are
handled where they are read: no shuffle.

Null and empty texts have no words: all counts 0, base_failed and not kept. Repeated rows
are judged alike, one by one. Other columns of the input are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stratline.llm import texts

# Published limits of repetition rules.
TOP_GRAM_LIMITS = {2: 0.20, 3: 0.18, 4: 0.16}
COVERED_LIMITS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}

SCHEMA = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, base_failed boolean, kept boolean, dup_line_share double, "
    "dup_line_char_share double, top_gram_share double, covered_share double"
)
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class Limits:
    min_words: int = 50
    max_dup_lines: float = 0.30
    max_dup_line_chars: float = 0.20
    # A text shorter than this is not judged by its most frequent short n-gram: in few
    # words any two that recur reach the limit.
    top_gram_words: int = 100


def repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key how often it occurs, and whether it occurred before."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    group = np.cumsum(fresh) - 1
    times, again = np.empty(len(keys), np.int64), np.empty(len(keys), bool)
    times[order] = np.bincount(group)[group] if len(keys) else 0
    again[order] = ~fresh
    return times, again


def covered_words(at: np.ndarray, twice: np.ndarray, n: int, words: int) -> np.ndarray:
    """Words inside any of the marked n-grams."""
    edge = np.zeros(words + 1, np.int64)
    np.add.at(edge, at[twice], 1)
    np.add.at(edge, at[twice] + n, -1)
    return np.cumsum(edge[:-1]) > 0


def measure(block: texts.Block, limits: Limits) -> dict[str, np.ndarray]:
    rows = block.rows
    lead = (block.data & 0xC0) != 0x80
    in_word = texts.SPACE[block.data] != 0
    chars = block.sums(lead & in_word)
    words = block.runs(texts.SPACE)
    hashes = block.hashes()
    row, word = words.row(), hashes.spans(words.start, words.end)
    length = chars[words.end] - chars[words.start]
    total = np.maximum(1, np.diff(chars[block.bounds]))

    lines = block.lines()
    line_row = lines.row()
    any_word = chars[lines.end] > chars[lines.start]
    line_row, line = line_row[any_word], hashes.spans(lines.start, lines.end)[any_word]
    line_chars = (chars[lines.end] - chars[lines.start])[any_word]
    _, again = repeated(texts.mix(line + texts.mix(line_row.astype(np.uint64))))
    dup_lines = np.bincount(line_row[again], minlength=rows)
    dup_chars = np.bincount(line_row[again], line_chars[again], minlength=rows)
    n_lines = np.maximum(1, np.bincount(line_row, minlength=rows))

    seed = texts.mix(row.astype(np.uint64) + np.uint64(7))
    top, over, worst = np.zeros(rows), np.zeros(rows, bool), np.zeros(rows)
    repeat_words = np.zeros(rows, np.int64)
    could = np.ones(len(words), bool)  # an n-gram recurs only where its first n - 1 words do
    for n in range(2, max(COVERED_LIMITS) + 1):
        at, gram = texts.grams(word, row, n)
        used = could[at]
        at, gram = at[used], gram[used]
        times, _ = repeated(texts.mix(gram + seed[at]))
        could = np.zeros(len(words), bool)
        could[at[times > 1]] = True
        if n == 3:
            inside = covered_words(at, times > 1, 3, len(words))
            repeat_words = np.bincount(row[inside], minlength=rows)
        if n in TOP_GRAM_LIMITS:
            sums = np.concatenate(([0], np.cumsum(length)))
            mass = np.where(times > 1, times * (sums[at + n] - sums[at]), 0)
            most = np.zeros(rows)
            np.maximum.at(most, row[at], mass / total[row[at]])
            top = np.maximum(top, most / TOP_GRAM_LIMITS[n])
        if n in COVERED_LIMITS:
            inside = covered_words(at, times > 1, n, len(words))
            share = np.bincount(row[inside], length[inside], minlength=rows) / total
            worst = np.maximum(worst, share)
            over |= share > COVERED_LIMITS[n]
    n_words = words.counts
    failed = (n_words < limits.min_words) | (100 * repeat_words > 50 * n_words)
    line_share, line_char_share = dup_lines / n_lines, dup_chars / total
    bad = over | (line_share > limits.max_dup_lines) | (line_char_share > limits.max_dup_line_chars)
    bad |= (top > 1) & (n_words >= limits.top_gram_words)
    return {
        "n_words": n_words,
        "word_chars": np.diff(chars[block.bounds]),
        "n_symbols": block.per_row(SYMBOLS[block.data]),
        "n_dup_lines": dup_lines,
        "n_repeat_words": repeat_words,
        "base_failed": failed,
        "kept": ~failed & ~bad,
        "dup_line_share": line_share,
        "dup_line_char_share": line_char_share,
        "top_gram_share": top,
        "covered_share": worst,
    }


def judge(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One row for each document: its counts, shares and whether it is kept."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for block in texts.blocks(texts.column(batch, "text")):
                found = measure(block, limits)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(block.first_row, block.rows), *(pa.array(v) for v in found.values())],
                    names=["doc_id", *found],
                )

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, SCHEMA)
