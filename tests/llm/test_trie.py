"""The conversation trie against a plain one."""

import hashlib
import random
import zlib
from collections import defaultdict
from dataclasses import replace

import pytest

from stratline.llm import trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, n bigint, a string, least string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows):
    original = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            mark = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            original[c].append((t is not None, t or 0, mark, role, text))
    for v in original.values():
        v.sort()
    members, ends = defaultdict(set), defaultdict(set)
    for c, own in original.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        path = tuple(x[3:] for x in original.get(base, [])[:h] + own[h:])
        for d in range(len(path) + 1):
            members[path[:d]].add(c)
        ends[path].add(c)
    children = defaultdict(set)
    for path in members:
        if path:
            children[path[:-1]].add(path)
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, who in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += (len(who) - 1) * len(path[-1][1]) if path else 0
    out = []
    for path, who in members.items():
        digest = hashlib.sha256(",".join(map(str, sorted(ends[path]))).encode()).hexdigest()
        up = min(members[path[:-1]]) if path else None
        out.append((min(who), len(path), up, len(who), len(children[path]), leaves[path], saved[path], digest))
    return sorted(out, key=str)


def found(spark, rows, shape=trie.Shape(), parts=4):
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA).repartition(parts)
    return sorted((tuple(r[c] for c in COLUMNS) for r in trie.prefix_trie(df, shape).collect()), key=str)


def conversations(rng, n, longest, texts):
    rows = []
    for c in rng.sample(range(-150, 950), n):
        rows += [(c, t, rng.choice(["user", "assistant"]), rng.choice(texts)) for t in range(rng.randint(1, longest))]
    return rows


@pytest.mark.parametrize("block", [1, 3, 4])
def test_equals_plain_trie(spark, block):
    rng = random.Random(block)
    rows = conversations(rng, 120, 9, ["a", "bb", "", "é" * 7])
    assert found(spark, rows, trie.Shape(block=block)) == plain(rows)


def test_odd_rows(spark):
    rng = random.Random(5)
    rows = conversations(rng, 40, 12, ["yes", "no"])
    rows += rng.sample(rows, 60)  # repeated rows
    rows += [(7, None, None, None), (7, None, "user", None), (None, 1, "user", "x"), (-3, None, None, "t" * 100_000), (8, 1, "a", "bc"), (9, 1, "ab", "c")]
    assert found(spark, rows) == plain(rows)


def test_long_conversations_in_slices(spark):
    # Digests over more than one level of slices, two long copies, all turns of one number.
    rows = [(c, None if c < 900 else t, "user", str(t % 7)) for c in (100, 101, 900, 901) for t in range(90)]
    rows += [(c, 1, "user", "same") for c in range(300, 400)]
    shape = replace(trie.Shape(), block=2, fan=4, share=5)
    assert found(spark, rows, shape, 7) == plain(rows)


def test_ends_in_several_ranges(spark):
    rows = [(c * 100, 0, "user", "same") for c in range(300)]
    assert found(spark, rows) == plain(rows)


def test_empty(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, 1, "a", "b")]) == []
