"""Token ids packed into rows of one length, as binary matrices.

Texts are encoded, closed by an end id and cut into pieces of at most `length` ids; no id is
lost. Within a block of about `block_tokens` ids the pieces go, longest first, into the row
with the least room that still holds them; a segment tree over the rooms finds it. A block
is written as one matrix (.npy, rows x length) into the shared folder, with the cumulative
lengths of the segments of each row; positions start again at every segment.

Blocks are taken from the input as it is partitioned: no shuffle, and a task holds one block
at a time. File names are unique to a task's attempt and only files in the returned list
count, so a lost task leaves nothing that is read. Null and empty texts are one piece, the
end id. Repeated rows are packed each by itself; null ids stay null in the segments. An
empty table gives no rows and no files.
"""

from __future__ import annotations

import hashlib
import io
import posixpath
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stratline.llm import bpe, files, texts
from stratline.sources import sinks

SCHEMA = (
    "matrix string, row int, n_tokens int, cu_seqlens array<int>, position_resets array<int>, "
    "doc_ids array<bigint>, pieces array<int>, ids_sha256 string"
)


@dataclass(frozen=True)
class Packing:
    length: int = 2048
    end_id: int = 49407
    pad_id: int = 0
    block_tokens: int = 1 << 21


class Rooms:
    """Segment tree over the sizes of free room: the least room that is large enough."""

    def __init__(self, length: int):
        self.size = 1 << length.bit_length()
        self.count = [0] * (2 * self.size)  # rows with room of a size, summed up the tree
        self.rows: dict[int, list[int]] = {}

    def add(self, room: int, row: int) -> None:
        self.rows.setdefault(room, []).append(row)
        at = room + self.size
        while at:
            self.count[at] += 1
            at >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """Remove and return (room, row) of the row with the least room of at least `least`."""
        at, count = least + self.size, self.count
        while not count[at]:
            while at & 1:  # a right child: the next room is further up
                at >>= 1
            if not at:
                return None
            at += 1
        while at < self.size:
            at = 2 * at if count[2 * at] else 2 * at + 1
        room = at - self.size
        row = self.rows[room].pop()
        while at:
            count[at] -= 1
            at >>= 1
        return room, row


def best_fit(sizes: list[int], length: int) -> list[list[int]]:
    """Rows of piece numbers by best fit decreasing; ties in the order of the pieces."""
    rooms, rows = Rooms(length), []
    for piece in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        size = sizes[piece]
        found = rooms.take(size)
        room, row = found or (length, len(rows))
        if not found:
            rows.append([])
        rows[row].append(piece)
        if room > size:
            rooms.add(room - size, row)
    return rows


def pack_block(docs: list[tuple[int | None, np.ndarray]], plan: Packing, folder: str) -> pa.RecordBatch:
    """Pack a block of (doc_id, ids), write its matrix, and list its rows."""
    pieces = [
        (doc, k, ids[at : at + plan.length])
        for doc, ids in docs
        for k, at in enumerate(range(0, len(ids), plan.length))
    ]
    rows = best_fit([len(ids) for _, _, ids in pieces], plan.length)
    widest = max(plan.end_id, plan.pad_id, max((int(ids.max()) for _, _, ids in pieces), default=0))
    matrix = np.full((len(rows), plan.length), plan.pad_id, np.uint16 if widest < 1 << 16 else np.int32)
    name = f"{uuid.uuid4().hex}.npy"
    out: dict[str, list] = {f: [] for f in ("n_tokens", "cu_seqlens", "position_resets", "doc_ids", "pieces", "ids_sha256")}
    for r, row in enumerate(rows):
        ends = np.cumsum([len(pieces[k][2]) for k in row])
        matrix[r, : ends[-1]] = np.concatenate([pieces[k][2] for k in row])
        cumulative = [0, *ends.tolist()]
        out["n_tokens"].append(int(ends[-1]))
        out["cu_seqlens"].append(cumulative)
        out["position_resets"].append(cumulative[:-1])
        out["doc_ids"].append([pieces[k][0] for k in row])
        out["pieces"].append([pieces[k][1] for k in row])
        out["ids_sha256"].append(hashlib.sha256(matrix[r, : ends[-1]].astype("<i4").tobytes()).hexdigest())
    content = io.BytesIO()
    np.save(content, matrix)
    files.put(posixpath.join(folder, name), content.getvalue())
    kinds = [pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.string()]
    return pa.RecordBatch.from_arrays(
        [pa.array([name] * len(rows), pa.string()), pa.array(np.arange(len(rows), dtype=np.int32))]
        + [pa.array(v, kind) for v, kind in zip(out.values(), kinds)],
        names=["matrix", "row", *out],
    )


def pack(docs: DataFrame, vocabulary_path: str, plan: Packing = Packing(), folder: str | None = None) -> DataFrame:
    """Encode and pack all texts; the rows that were written, read back from their list.

    matrix is the file's name below the folder (column `folder`)."""
    spark = docs.sparkSession
    folder = folder or f"{sinks.table_folder(spark)}/packed"
    content = spark.sparkContext.broadcast(bpe.vocabulary(vocabulary_path))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe.tokenizer(content.value)
        block, size = [], 0
        for batch in batches:
            ids_of = coder.arrays(texts.column(batch, "text").to_pylist(), 1 << 22)
            for doc, ids in zip(batch.column(0).to_pylist(), ids_of):
                block.append((doc, np.append(ids, np.int32(plan.end_id))))
                size += len(ids) + 1
                if size >= plan.block_tokens:
                    yield pack_block(block, plan, folder)
                    block, size = [], 0
        if block:
            yield pack_block(block, plan, folder)

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, SCHEMA)
    return sinks.write_table(rows, f"{folder}/_rows").withColumn("folder", F.lit(folder))


def matrix(folder: str, name: str) -> np.ndarray:
    return np.load(io.BytesIO(files.get(posixpath.join(folder, name))))


def positions(cu_seqlens: Iterable[int]) -> np.ndarray:
    """Position of every id of a row within its segment."""
    cuts = np.asarray(list(cu_seqlens))
    return np.arange(cuts[-1]) - np.repeat(cuts[:-1], np.diff(cuts))
