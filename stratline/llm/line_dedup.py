"""Line deduplication by content-defined chunks of lines.

A rolling hash over the hashes of the last `window` lines decides after which lines a chunk
ends, and lines of many words are chunks of their own; both depend on the lines' content
alone, so an inserted line moves no boundary beyond its neighbourhood. Chunks that occur
again anywhere are compared byte by byte with their first occurrence, in the order of
(doc_id, text hash, line). Neighbouring repeats are joined, over lines without words too
(which go with the passage around them) and up to the line where a passage ends within a
chunk (see edges), and a joined passage is removed
if it has at least two lines with words and `min_words` words, or one line of
`min_line_words`; shorter ones, such as a license line, stay. The first occurrence stays.

Null texts stay null and have no lines; empty texts stay empty. Repeated rows (same id and
text) are one document: they keep and lose the same lines. Rows with a null id come last in
the order. All columns stay; n_chars, if there is one, is set to the new length where a
text has changed.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stratline.llm import sieve, texts
from stratline.sources import sinks


@dataclass(frozen=True)
class Chunks:
    window: int = 1  # lines in the rolling hash
    mask: int = 1  # a chunk ends where the rolling hash has these bits 0
    own_words: int = 10  # a line of so many words is a chunk of its own
    most_lines: int = 64  # so that a chunk of tiny lines stays bounded
    min_words: int = 30
    min_line_words: int = 50


# Of a chunk, as chunk() and as the tables name them.
COUNTS = ("first_line", "lines", "words", "worded", "words_before", "worded_before")
FIELDS = ("line", "lines", "words", "worded", "words_before", "worded_before")


@dataclass
class Lines:
    """The lines of a block, what the rolling hash says of them, and totals before each line."""

    lines: texts.Tokens
    row: np.ndarray
    place: np.ndarray  # in its text
    hashes: texts.Hashes
    line: np.ndarray  # hash
    n_words: np.ndarray
    cut_after: np.ndarray
    own: np.ndarray
    sums: np.ndarray  # words
    worded: np.ndarray  # lines with words

    def fields(self, start: np.ndarray, stop: np.ndarray) -> dict[str, np.ndarray]:
        """COUNTS of ranges of lines, and their rows."""
        head = self.lines.first[self.row[start]]
        return {
            "row": self.row[start],
            "first_line": self.place[start],
            "lines": stop - start,
            "words": self.sums[stop] - self.sums[start],
            "worded": self.worded[stop] - self.worded[start],
            "words_before": self.sums[start] - self.sums[head],
            "worded_before": self.worded[start] - self.worded[head],
        }


def lines_of(block: texts.Block, plan: Chunks) -> Lines:
    lines = block.lines()
    row = lines.row()
    hashes = block.hashes()
    line = hashes.spans(lines.start, lines.end)
    words = block.runs(texts.SPACE)
    n_words = np.diff(np.searchsorted(words.start, np.append(lines.start, len(block.data))))
    place = np.arange(len(lines)) - lines.first[row]
    rolled = line.copy()
    for k in range(1, plan.window):
        rolled[k:] = rolled[k:] + np.where(place[k:] >= k, line[:-k], 0).astype(np.uint64) * texts.U((2 * k + 1) ** 9)
    cut_after = (texts.mix(rolled) & texts.U(plan.mask)) == 0
    sums = np.concatenate(([0], np.cumsum(n_words)))
    worded = np.concatenate(([0], np.cumsum(n_words > 0)))
    return Lines(lines, row, place, hashes, line, n_words, cut_after, n_words >= plan.own_words, sums, worded)


def chunk(block: texts.Block, plan: Chunks, read: Lines | None = None) -> dict[str, np.ndarray]:
    """Row, COUNTS and hash of every chunk."""
    read = read or lines_of(block, plan)
    lines, line, cut_after, own = read.lines, read.line, read.cut_after, read.own
    cut = np.ones(len(lines) + 1, bool)  # a chunk begins here
    cut[1:-1] = cut_after[:-1] | own[:-1] | own[1:]
    # A line that the hash picks is a chunk of its own too.
    cut[:-1] |= cut_after
    cut[lines.first] = True
    starts = np.flatnonzero(cut)[:-1]
    run = np.repeat(starts, np.diff(np.append(starts, len(lines))))
    cut[:-1] |= (np.arange(len(lines)) - run) % plan.most_lines == 0
    starts = np.flatnonzero(cut)
    start, stop = starts[:-1], starts[1:]
    once = read.hashes.spans(lines.start[start], lines.end[stop - 1])
    mixed = np.zeros(len(lines) + 1, np.uint64)
    np.cumsum(texts.salted(line, 5) * (2 * (np.arange(len(lines)) - run) + 1).astype(np.uint64), out=mixed[1:])
    return read.fields(start, stop) | {"hash": texts.mix(once ^ texts.mix(mixed[stop] - mixed[start]))}


def edges(read: Lines, plan: Chunks) -> dict[str, np.ndarray]:
    """Row, COUNTS and hash of the ranges by which a passage can end within a chunk.

    A chunk of several short lines may lie half in a repeated passage. Lines of many words
    and lines that the hash picks are alone in every text; the others, here loose lines,
    lie between them. So each line that is alone gives the loose lines next to it, one more
    at a time up to `min_words` words, with its own hash in theirs; and where loose lines
    alone have so many words, the shortest such range from and up to each of them counts.
    Lines without words are passed over."""
    at = np.flatnonzero(read.n_words > 0)
    row, total = read.row[at], read.sums[at]
    total = np.append(total, read.sums[-1])  # words before each line with words
    loose = ~(read.own | read.cut_after)[at]
    begins = np.ones(len(at), bool)
    begins[1:] = (row[1:] != row[:-1]) | ~loose[1:] | ~loose[:-1]
    run = np.cumsum(begins)
    found: list[tuple[np.ndarray, ...]] = []  # first and last line of a range, and salt
    for way in (1, -1):
        alone = np.flatnonzero(~loose)
        here = alone
        while len(alone):
            here = here + way
            inside = (here >= 0) & (here < len(at))
            alone, here = alone[inside], here[inside]
            inside = loose[here] & (row[here] == row[alone])
            alone, here = alone[inside], here[inside]
            near = alone + way
            low, high = np.minimum(near, here), np.maximum(near, here)
            found.append((low, high, texts.salted(read.line[at[alone]], 2 + way)))
            more = total[high + 1] - total[low] < plan.min_words
            alone, here = alone[more], here[more]
    each = np.flatnonzero(loose)
    high = np.maximum(np.searchsorted(total, total[each] + plan.min_words) - 1, each + 1)
    low = np.minimum(np.searchsorted(total, total[each + 1] - plan.min_words, "right") - 1, each - 1)
    for low, high in ((each, high), (low, each)):
        inside = (low >= 0) & (high < len(at))
        low, high = low[inside], high[inside]
        inside = run[low] == run[high]
        low, high = low[inside], high[inside]
        found.append((low, high, np.full(len(low), 7, np.uint64)))
    low, high, salt = (np.concatenate(x) for x in zip(*found))
    start, stop = at[low], at[high] + 1
    hashes = read.hashes.spans(read.lines.start[start], read.lines.end[stop - 1])
    return read.fields(start, stop) | {"hash": texts.mix(hashes ^ texts.mix(salt + texts.STEP))}


def tables(docs: DataFrame, plan: Chunks) -> DataFrame:
    """One row for each document: its key, its chunks that have a word and their edges."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in texts.blocks(texts.column(batch, "text")):
                read = lines_of(block, plan)
                found, more = chunk(block, plan, read), edges(read, plan)
                found = {name: np.concatenate((found[name], more[name])) for name in found}
                used = np.argsort(found["row"], kind="stable")
                used = used[found["words"][used] > 0]
                cuts = np.searchsorted(found["row"][used], np.arange(block.rows + 1)).astype(np.int32)
                parts = [
                    pa.array(found[name][used].astype(np.int32)) for name in COUNTS
                ] + [pa.array(found["hash"][used].view(np.int64))]
                structs = pa.StructArray.from_arrays(parts, names=[*FIELDS, "hash"])
                part = batch.slice(block.first_row, block.rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.ListArray.from_arrays(pa.array(cuts), structs)], names=["id", "key", "chunks"]
                )

    fields = ", ".join(f"{name}: int" for name in FIELDS)
    schema = f"id bigint, key bigint, chunks array<struct<{fields}, hash: bigint>>"
    return docs.select("id", "text", "key").mapInArrow(run, schema)


def keyed(docs: DataFrame) -> DataFrame:
    """id, text and a hash of the text, which together name a document."""
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("bigint").alias("id"), text.alias("text"), F.xxhash64(text).alias("key"))


def repeats(docs: DataFrame, plan: Chunks, cut) -> DataFrame:
    """id, key and FIELDS of chunks equal to an earlier one."""
    chunks = cut(tables(keyed(docs), plan), "chunks")
    each = chunks.select("id", "key", F.explode("chunks").alias("c")).select("id", "key", "c.*")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "key", "line")
    # Repeated rows name the same document: a chunk repeats only if its places differ.
    firsts = each.groupBy("hash").agg(F.min(order).alias("head"), F.max(order).alias("tail")).where("head <> tail")
    firsts = cut(firsts.select("hash", F.struct("head.id", "head.key", "head.line").alias("head")), "firsts")
    places = cut(each.join(firsts, "hash"), "places")
    # The bytes of every place, from one join with the texts. A chunk's first place is
    # asked for once; a document's list of places is as long as the document.
    is_head = F.struct("id", "key", "line").eqNullSafe(F.col("head")).alias("is_head")
    wanted = places.select("id", "key", F.struct(*FIELDS, "hash", is_head).alias("w"))
    wanted = wanted.groupBy("id", "key").agg(F.collect_set("w").alias("wanted"))
    wanted = cut(wanted, "wanted")
    may = sieve.Sieve(wanted, "key")
    texts_of = join_key(keyed(docs).where(may.column(F.col("key"))), wanted, "inner")
    bodies = texts_of.dropDuplicates(["id", "key"]).select("id", "key", F.split("text", "\n").alias("parts"), F.explode("wanted").alias("w"))
    body = F.array_join(F.slice("parts", F.col("w.line") + 1, F.col("w.lines")), "\n").alias("body")
    bodies = cut(bodies.select("id", "key", "w.*", body), "bodies")
    heads = bodies.where("is_head").select("hash", F.col("body").alias("head_body"))
    same = bodies.where("not is_head").join(heads, "hash").where(F.col("body") == F.col("head_body"))
    return same.select("id", "key", *FIELDS)


def join_key(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on (id, key); the key of the text is never null, the id may be."""
    right = right.withColumnsRenamed({"id": "id_", "key": "key_"})
    return left.join(right, left["id"].eqNullSafe(right["id_"]) & (left["key"] == right["key_"]), how).drop("id_", "key_")


def removals(docs: DataFrame, plan: Chunks = Chunks(), cut=None) -> DataFrame:
    """(id, key, gone): for documents that lose lines, the ranges (line, lines) that go."""
    cut = cut or sinks.table_cut(docs.sparkSession)
    found = repeats(docs, plan, cut).groupBy("id", "key").agg(F.collect_set(F.struct(*FIELDS)).alias("found"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [joined(x.as_py(), plan) for x in batch.column(2)]
            gone = pa.array(out, pa.list_(pa.struct([("line", pa.int32()), ("lines", pa.int32())])))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), gone], names=["id", "key", "gone"])

    gone = found.mapInArrow(run, "id bigint, key bigint, gone array<struct<line: int, lines: int>>")
    return cut(gone.where(F.size("gone") > 0), "removals")


def joined(found: list[dict], plan: Chunks) -> list[dict]:
    """Join neighbouring repeats of one document and keep the passages that are long enough.

    Repeats that overlap or have no word between them are neighbours, however many blank
    lines part them."""
    out, passage = [], None
    for c in sorted(found, key=lambda c: c["line"]) + [None]:
        if passage and (c is None or c["words_before"] > passage["words_before"] + passage["words"]):
            multi = passage["worded"] >= 2 and passage["words"] >= plan.min_words
            if multi or passage["words"] >= plan.min_line_words:
                out.append({"line": passage["line"], "lines": passage["lines"]})
            passage = None
        if c and passage:
            for size, start in (("lines", "line"), ("words", "words_before"), ("worded", "worded_before")):
                passage[size] = max(passage[size], c[start] + c[size] - passage[start])
        elif c:
            passage = dict(c)
    return out


def deduplicate(docs: DataFrame, plan: Chunks = Chunks()) -> DataFrame:
    """The documents without their repeated passages, same columns."""
    gone = removals(docs, plan)
    may = sieve.Sieve(gone, "key")
    names = {n: f"_{k}_{n}" for k, n in enumerate(("id", "key", "gone"))}
    gone = gone.withColumnsRenamed(names)
    text = F.col("text").cast("string")
    key = F.xxhash64(text)
    # Texts that surely lose nothing stay where they are.
    touched = docs.where(may.column(key))
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col(names["id"])) & (key == F.col(names["key"]))
    both = touched.join(gone, same, "left")
    going = F.col(names["gone"])
    left = F.filter(
        F.split(text, "\n"),
        lambda _, i: ~F.exists(going, lambda g: (i >= g["line"]) & (i < g["line"] + g["lines"])),
    )
    both = both.withColumn("text", F.when(going.isNull(), F.col("text")).otherwise(F.array_join(left, "\n")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        both = both.withColumn("n_chars", F.when(going.isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return both.select(*docs.columns).unionAll(docs.where(~may.column(key)))
