"""Tokens, lines and hashes of whole Arrow text columns, a block of bytes at a time.

All functions work on the UTF-8 bytes of several texts laid end to end, so the cost for
each text is a few array operations shared with its neighbours, and memory is bounded by
the block (or by one text, where that is longer).
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20
U = np.uint64

# What a worker holds from one task to the next: the encoder with its words. Tasks that cut
# texts into blocks belong to another stage and free it.
kept: dict[str, object] = {}

SPACE = np.ones(256, np.uint8)  # class 1: all but space, tab and line ends
SPACE[[0x20, *range(0x09, 0x0E)]] = 0

ALNUM = np.zeros(256, np.uint8)  # class 1: letters and digits, and all bytes beyond ASCII
ALNUM[128:] = 1
for first, last in ("az", "AZ", "09"):
    ALNUM[ord(first) : ord(last) + 1] = 1

# Scripts without spaces between words: Thai, Lao, Myanmar, Khmer and their neighbours, kana
# and bopomofo, Han, Yi, and the planes of further Han.
UNSPACED = (
    *((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19DF), (0x1A20, 0x1AAF), (0x1B00, 0x1B7F)),
    *((0x3005, 0x3007), (0x3021, 0x312F), (0x31A0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0xA4CF), (0xA980, 0xA9FF)),
    *((0xAA60, 0xAADF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x1B000, 0x1B16F), (0x20000, 0x3FFFF)),
)
JOINERS = (0xAD, 0x200C, 0x200D)  # format characters within a word


@cache
def character_kinds() -> np.ndarray:
    """By code point: 0 parts words, 1 belongs to a word, 2 is a letter of a script without spaces."""
    kinds = np.ones(0x110000, np.uint8)
    for code in range(128, 0x20000):
        kind = unicodedata.category(chr(code))
        kinds[code] = kind[0] in "LMN" or kind in ("Cn", "Co") or code in JOINERS
    for first, last in UNSPACED:
        kinds[first : last + 1] *= 2
    return kinds


ROOT = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
STEP = U(0xD1342543DE82EF95)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every bit depends on all bits."""
    h = h ^ (h >> U(30))
    h = h * U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U(27))
    h = h * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def byte_values(fold: bool) -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=U) * STEP)
    if fold:
        values[65:91] = values[97:123]
    return values


VALUES = {False: byte_values(False), True: byte_values(True)}
_powers: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]


def powers(n: int) -> list[np.ndarray]:
    """Powers of ROOT and of its inverse, at least n of each."""
    if len(_powers[0]) < n:
        size = max(n, BLOCK_BYTES + 1)
        for k, base in enumerate((ROOT, pow(ROOT, -1, 1 << 64))):
            steps = np.full(size, base, U)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=U)
    return _powers


@dataclass
class Block:
    """Some texts end to end: text i of the block is data[bounds[i]:bounds[i + 1]]."""

    first_row: int
    data: np.ndarray
    bounds: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.bounds) - 1

    def sums(self, flags: np.ndarray) -> np.ndarray:
        """Running total with a leading zero."""
        out = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=out[1:])
        return out

    def per_row(self, flags: np.ndarray) -> np.ndarray:
        return np.diff(self.sums(flags)[self.bounds])

    def hashes(self, fold: bool = False) -> "Hashes":
        n = len(self.data)
        prefix = np.zeros(n + 1, U)
        if n:
            np.cumsum(VALUES[fold][self.data] * powers(n + 1)[0][:n], out=prefix[1:])
        return Hashes(prefix)

    def runs(self, classes: np.ndarray) -> "Tokens":
        """Maximal runs of bytes of one class, but for class 0, within each text."""
        n = len(self.data)
        if not n:
            none = np.zeros(0, np.int64)
            return Tokens(none, none, np.zeros(0, np.uint8), np.zeros(self.rows + 1, np.int64))
        kind = classes[self.data]
        edge = np.ones(n + 1, bool)
        np.not_equal(kind[1:], kind[:-1], out=edge[1:-1])
        edge[self.bounds] = True
        cuts = np.flatnonzero(edge)
        start, end = cuts[:-1], cuts[1:]
        kind = kind[start]
        used = kind != 0
        start, end = start[used], end[used]
        return Tokens(start, end, kind[used], np.searchsorted(start, self.bounds))

    def units(self) -> "Tokens":
        """Words (kind 1), and single letters of scripts without spaces (kind 2). Letters and
        digits make words; punctuation and signs of any script part them."""
        lead = np.flatnonzero(self.data >= 0xC0)
        if not len(lead):
            return self.runs(ALNUM)
        n = len(self.data)
        first = self.data[lead].astype(np.int64)
        size = 2 + (first >= 0xE0) + (first >= 0xF0)
        code = first & (0x7F >> size)
        for k in range(1, 4):
            more = np.where(size > k, self.data[np.minimum(lead + k, n - 1)].astype(np.int64) & 0x3F, 0)
            code = np.where(size > k, code << 6 | more, code)
        kinds = character_kinds()[np.minimum(code, 0x10FFFF)]
        odd = kinds != 1
        lead, size, kinds = lead[odd], size[odd], kinds[odd]
        kind = ALNUM[self.data]
        for k in range(4):
            within = (size > k) & (lead + k < n)
            kind[lead[within] + k] = kinds[within]
        edge = np.ones(n + 1, bool)
        np.not_equal(kind[1:], kind[:-1], out=edge[1:-1])
        edge[self.bounds] = True
        edge[lead] = True
        cuts = np.flatnonzero(edge)
        start, end = cuts[:-1], cuts[1:]
        kind = kind[start]
        used = kind != 0
        start, end = start[used], end[used]
        return Tokens(start, end, kind[used], np.searchsorted(start, self.bounds))

    def lines(self) -> "Tokens":
        """Parts between line feeds; the feed is not part of a line. Every text has a line."""
        breaks = np.flatnonzero(self.data == 10)
        row = np.searchsorted(self.bounds, breaks, "right") - 1
        count = np.bincount(row, minlength=self.rows) + 1
        first = np.concatenate(([0], np.cumsum(count)))
        start = np.empty(first[-1], np.int64)
        inner = np.ones(first[-1], bool)
        inner[first[:-1]] = False
        start[first[:-1]], start[inner] = self.bounds[:-1], breaks + 1
        end = np.empty(first[-1], np.int64)
        final = np.zeros(first[-1], bool)
        final[first[1:] - 1] = True
        end[final], end[~final] = self.bounds[1:], breaks
        return Tokens(start, end, np.ones(len(start), np.uint8), first)


@dataclass
class Tokens:
    """start and end in the block, class, and the first token of each row (with an end mark)."""

    start: np.ndarray
    end: np.ndarray
    kind: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


@dataclass
class Hashes:
    """Rolling hash of a block: the hash of any span in constant time."""

    prefix: np.ndarray

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        inverse = powers(len(self.prefix))[1]
        raw = (self.prefix[end] - self.prefix[start]) * inverse[start]
        return mix(raw + (end - start).astype(U) * STEP)


def grams(hashes: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first token and hash of every run of n tokens within a row."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U)
    rolled = hashes[:count].copy()
    for k in range(1, n):
        rolled = rolled * STEP + hashes[k : k + count]
    at = np.flatnonzero(row[:count] == row[n - 1 :])
    return at, mix(rolled[at] + U(n))


def salted(hashes: np.ndarray, salt: int) -> np.ndarray:
    return mix(hashes ^ mix(np.array([salt + 1], U) * STEP))


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A text column with nulls as empty texts."""
    return pc.fill_null(batch.column(batch.schema.get_field_index(name)), "")


def values(column: pa.Array, rows: int = 256) -> Iterator[str]:
    """The texts as strings of Python, made only a few rows at a time."""
    for at in range(0, len(column), rows):
        yield from column.slice(at, rows).to_pylist()


def blocks(texts: pa.Array, size: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut a text column into blocks of about size bytes, of whole texts."""
    kept.clear()
    wide = pa.types.is_large_string(texts.type)
    bounds = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32) if len(texts) else np.zeros(1, np.int64)
    bounds = bounds[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + size, "right")) - 1)
        yield Block(at, data[bounds[at] : bounds[to]], bounds[at : to + 1] - bounds[at])
        at = to


class Vocabulary:
    """Exact look-up of 64-bit hashes in an open table: position in the list, or -1."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.asarray(hashes, U)
        bits = max(10, int(4 * len(self.hashes)).bit_length())
        self.mask = U((1 << bits) - 1)
        self.table = np.full(1 << bits, -1, np.int32)
        waiting = np.arange(len(self.hashes))
        slot = self.hashes & self.mask
        self.probes = 0
        while len(waiting):
            self.probes += 1
            free = self.table[slot[waiting]] < 0
            self.table[slot[waiting[free]]] = waiting[free]
            waiting = waiting[self.table[slot[waiting]] != waiting]
            slot[waiting] = (slot[waiting] + U(1)) & self.mask

    def find(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(hashes), -1, np.int32)
        if not len(self.hashes) or not len(hashes):
            return out
        open_, slot = np.arange(len(hashes)), hashes & self.mask
        for _ in range(self.probes):
            got = self.table[slot]
            there = got >= 0
            open_, slot, got = open_[there], slot[there], got[there]
            same = self.hashes[got] == hashes[open_]
            out[open_[same]] = got[same]
            open_, slot = open_[~same], (slot[~same] + U(1)) & self.mask
        return out
