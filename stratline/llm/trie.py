"""Prefix trie of conversations by digests of fixed-length blocks of turns.

Texts never move: a turn is the SHA-256 of its role and text and its length. The digest of
a prefix is the exclusive or of 128-bit hashes of (turn, position), so the prefixes of a
conversation of any length are running totals that can be taken in slices. Conversations
are first grouped by their successive blocks of `block` turns: what is counted and moved
after that is one row for each different block behind each different prefix (a variant).
Only where a prefix has several variants do turn boundaries inside the block matter; there
the variants, not the conversations, are cut into turns and grouped again. Where a prefix
has one variant its turns are nodes as they stand.

Everything about subtrees follows from who owns a node, its smallest member. A member is
owner from some depth on to its end. So the nodes of a subtree that are counted once each
are, for all its members but the owner, what lies above their own depth (the text they
share with a smaller member), and its leaves are the members that own a childless end:
both are plain sums over members, with no walk over the trie.

Hot groups: a long conversation is numbered in slices of a range sort and its digests in
slices of blocks; shared prefixes are pre-aggregated; look-ups of a prefix with very many
variants or children go through a broadcast of the keys that hold more than a thousandth
of all rows, of which there are fewer than a thousand. The conversations that end at one
node are joined in id ranges, and a task that digests them streams through these.

Turns of one conversation are in order of `turn`, nulls first, equal ones by their digest;
repeated rows are repeated turns. Null roles and texts are empty. Rows without a conv_id
are left out. An empty table has no node. Texts may be of any length; other columns are
not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from stratline.sources import sinks

Cut = Callable[[DataFrame, str], DataFrame]
KEY = ("depth", "a", "b")
VARIANT = ("k", "pa", "pb", "qa", "qb", "m")


@dataclass(frozen=True)
class Shape:
    block: int = 4  # turns of a block
    fan: int = 1024  # blocks of a slice
    share: int = 1000  # a key with more than this part of all rows is looked up by broadcast
    family: int = 100  # conversations that take their first turns from one
    heads: int = 6  # they take fewer than this


def marked(conversations: DataFrame) -> DataFrame:
    """(conv, turn, mark, size): digest of a turn's role and text, code points of its text."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    content = F.concat(F.length(empty("role")).cast("string"), F.lit(":"), empty("role"), empty("text"))
    return conversations.select(
        F.col("conv_id").cast("bigint").alias("conv"),
        F.col("turn").cast("bigint").alias("turn"),
        F.unhex(F.sha2(content, 256)).alias("mark"),
        F.length(empty("text")).cast("bigint").alias("size"),
    ).where("conv is not null")


def sliced(turns: DataFrame, cut: Cut) -> tuple[DataFrame, DataFrame]:
    """The turns in range-sorted slices, and (conv, slice, ahead, own): the turns in earlier
    slices and in all. A conversation of any length is dealt out over slices."""
    dealt = turns.withColumn("copy", F.monotonically_increasing_id()).repartitionByRange("conv", "turn", "mark", "copy")
    rows = cut(dealt.withColumn("slice", F.spark_partition_id()), "slices")
    counts = rows.groupBy("conv", "slice").agg(F.count("*").alias("n"))
    whole = Window.partitionBy("conv")  # one row for each slice
    before = whole.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead")
    return rows, counts.select("conv", "slice", ahead, F.sum("n").over(whole).alias("own"))


def numbered(rows: DataFrame, offsets: DataFrame) -> DataFrame:
    inside = Window.partitionBy("conv", "slice").orderBy("turn", "mark", "copy")
    return rows.join(offsets, ["conv", "slice"]).withColumn("place", F.col("ahead") + F.row_number().over(inside))


def rebuilt(conversations: DataFrame, shape: Shape, cut: Cut) -> tuple[DataFrame, DataFrame]:
    """(conv, place, mark, size) of every conversation with its first h turns replaced by
    those of its family's first, and (conv, length)."""
    rows, offsets = sliced(marked(conversations), cut)
    base = F.col("conv") - F.col("conv") % shape.family
    firsts = numbered(rows.where(F.col("conv") == base), offsets).where(F.col("place") < shape.heads)
    firsts = firsts.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("place", "mark", "size"))).alias("firsts"))
    convs = offsets.groupBy("conv").agg(F.max("own").alias("own"))
    convs = convs.withColumn("base", base).withColumn("h", F.crc32(F.col("conv").cast("string").cast("binary")) % shape.heads)
    convs = convs.join(firsts.withColumnRenamed("conv", "base"), "base", "left")
    taken = F.least(F.coalesce(F.size("firsts"), F.lit(0)).cast("bigint"), F.col("h"))
    convs = convs.withColumn("taken", F.when(F.col("firsts").isNull(), F.lit(0).cast("bigint")).otherwise(taken))
    length = F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))
    convs = cut(convs.select("conv", "h", "taken", "firsts", length.alias("length")), "convs")
    own = numbered(rows, offsets.join(convs.select("conv", "h", "taken"), "conv")).where("place > h")
    own = own.select("conv", (F.col("place") - F.col("h") + F.col("taken")).alias("place"), "mark", "size")
    head = convs.where("taken > 0").select("conv", F.explode(F.slice("firsts", 1, F.col("taken").cast("int"))).alias("t"))
    return head.select("conv", "t.*").unionByName(own), convs.select("conv", "length")


def totals_before(df: DataFrame, fan: int, top: int) -> DataFrame:
    """Adds pa, pb, before: what a, b (exclusive or) and size (sum) come to over the blocks of
    a conversation ahead of block k. Slices of `fan` blocks, their totals by the same rule."""

    def ahead(group) -> list[Column]:
        rows = group.orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
        found = {"pa": F.bit_xor("a"), "pb": F.bit_xor("b"), "before": F.sum("size")}
        return [F.coalesce(c.over(rows), F.lit(0).cast("bigint")).alias(name) for name, c in found.items()]

    if top < fan:
        return df.select("*", *ahead(Window.partitionBy("conv")))
    part = F.floor(F.col("k") / fan).cast("bigint")
    df = df.withColumn("part", part)
    sums = df.groupBy("conv", "part").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"), F.sum("size").alias("size"))
    offsets = totals_before(sums.withColumnRenamed("part", "k"), fan, top // fan)
    offsets = offsets.select("conv", F.col("k").alias("part"), *(F.col(c).alias(f"_{c}") for c in ("pa", "pb", "before")))
    inner = df.select("*", *ahead(Window.partitionBy("conv", "part"))).join(offsets, ["conv", "part"])
    both = {"pa": F.col("pa").bitwiseXOR(F.col("_pa")), "pb": F.col("pb").bitwiseXOR(F.col("_pb")), "before": F.col("before") + F.col("_before")}
    return inner.withColumns(both).drop("part", "_pa", "_pb", "_before")


def blocks(turns: DataFrame, convs: DataFrame, shape: Shape, cut: Cut) -> DataFrame:
    """(conv, k, turns, m, pa, pb, before, qa, qb, size): every conversation in blocks, the
    digests of the prefix ahead of each and through it. The last block of a conversation is
    shorter than `block` turns, and empty where the length is a multiple."""
    word = lambda salt: F.xxhash64(F.lit(salt), "mark", "place")
    turn = F.struct("place", word(1).alias("a"), word(2).alias("b"), "size")
    k = F.floor((F.col("place") - 1) / shape.block).cast("bigint")
    each = turns.select("conv", k.alias("k"), turn.alias("t"))
    full = each.groupBy("conv", "k").agg(
        F.sort_array(F.collect_list("t")).alias("turns"), F.bit_xor("t.a").alias("a"), F.bit_xor("t.b").alias("b"), F.sum("t.size").alias("size")
    )
    zero = F.lit(0).cast("bigint")
    empty = convs.where(F.col("length") % shape.block == 0).select(
        "conv", F.floor(F.col("length") / shape.block).cast("bigint").alias("k"),
        F.array().cast("array<struct<place:bigint,a:bigint,b:bigint,size:bigint>>").alias("turns"),
        zero.alias("a"), zero.alias("b"), zero.alias("size"),
    )
    longest = convs.agg(F.max("length")).first()[0] or 0
    rows = totals_before(full.unionByName(empty), shape.fan, longest // shape.block)
    through = {"qa": F.col("pa").bitwiseXOR(F.col("a")), "qb": F.col("pb").bitwiseXOR(F.col("b")), "m": F.size("turns")}
    return cut(rows.withColumns(through).drop("a", "b"), "blocks")


def looked_up(left: DataFrame, right: DataFrame, keys: list[str], weight: str, share: int) -> DataFrame:
    """Inner join with a table that is unique on the keys and says how many left rows have
    each. Keys with more than 1 / share of them, fewer than `share`, are broadcast."""
    total = right.agg(F.sum(weight)).first()[0] or 0
    heavy = right.where(F.col(weight) * share > total)
    light = right.where(F.col(weight) * share <= total)
    rest = left.join(F.broadcast(heavy.select(*keys)), keys, "left_anti").join(light, keys)
    return left.join(F.broadcast(heavy), keys).unionByName(rest)


def turn_nodes(variants: DataFrame, *carried: str) -> DataFrame:
    """A row for each turn of each variant: its prefix digest, that of the turn before (ua,
    ub), code points of its text (size) and of the whole prefix (tokens)."""
    start = F.struct(F.col("pa").alias("a"), F.col("pb").alias("b"), F.col("before").alias("tokens"))
    node = "struct<depth:bigint,a:bigint,b:bigint,ua:bigint,ub:bigint,size:bigint,tokens:bigint>"
    state = F.struct(start.alias("at"), F.array().cast(f"array<{node}>").alias("nodes"))

    def step(acc: Column, t: Column) -> Column:
        a, b = acc["at"]["a"].bitwiseXOR(t["a"]), acc["at"]["b"].bitwiseXOR(t["b"])
        tokens = acc["at"]["tokens"] + t["size"]
        here = F.struct(
            t["place"].alias("depth"), a.alias("a"), b.alias("b"), acc["at"]["a"].alias("ua"), acc["at"]["b"].alias("ub"), t["size"].alias("size"), tokens.alias("tokens")
        )
        at = F.struct(a.alias("a"), b.alias("b"), tokens.alias("tokens"))
        return F.struct(at.alias("at"), F.concat(acc["nodes"], F.array(here)).alias("nodes"))

    walked = F.aggregate("turns", state, step)["nodes"]
    return variants.select(*carried, F.explode(walked).alias("t")).select(*carried, "t.*")


def variants(rows: DataFrame, shape: Shape, cut: Cut) -> DataFrame:
    """Different blocks behind each different prefix: their number of conversations, the
    smallest, and whether siblings diverge there."""
    found = rows.groupBy(*VARIANT).agg(
        F.count("*").alias("n"), F.min("conv").alias("least"), F.first("turns").alias("turns"), F.first("before").alias("before")
    )
    found = cut(found, "variants")
    prefix = ["k", "pa", "pb"]
    siblings = cut(found.groupBy(*prefix).agg(F.count("*").alias("siblings")), "siblings")
    both = looked_up(found, siblings, prefix, "siblings", shape.share).where("m > 0")
    return cut(both.withColumn("diverge", F.col("siblings") > 1).drop("siblings"), "diverging")


def nodes(found: DataFrame, rows: DataFrame) -> DataFrame:
    """(depth, a, b, ua, ub, size, tokens, n, least, children) of every node."""
    carried = ("n", "least")
    names = [*KEY, "ua", "ub", "size", "tokens", *carried]
    straight = turn_nodes(found.where("not diverge"), *carried).select(*names)
    refined = turn_nodes(found.where("diverge"), *carried).groupBy(*KEY).agg(
        *(F.max(c).alias(c) for c in ("ua", "ub", "size", "tokens")), F.sum("n").alias("n"), F.min("least").alias("least")
    )
    zero = F.lit(0).cast("bigint")
    top = rows.where("k = 0").agg(F.count("*").alias("n"), F.min("conv").alias("least")).where("n > 0")
    root = top.select(*(zero.alias(c) for c in KEY), *(F.lit(None).cast("bigint").alias(c) for c in ("ua", "ub")), zero.alias("size"), zero.alias("tokens"), *carried)
    every = straight.unionByName(refined.select(*names)).unionByName(root)
    return every


def with_children(every: DataFrame) -> DataFrame:
    """Adds `children`: a node and the marks its children leave on it meet in one group."""
    values = [c for c in every.columns if c not in KEY]
    none = [F.lit(None).cast("bigint").alias(c) for c in values]
    marks = every.where("depth > 0").select((F.col("depth") - 1).alias("depth"), F.col("ua").alias("a"), F.col("ub").alias("b"), *none, F.lit(1).cast("bigint").alias("children"))
    both = every.withColumn("children", F.lit(0).cast("bigint")).unionByName(marks)
    return both.groupBy(*KEY).agg(*(F.max(c).alias(c) for c in values), F.sum("children").alias("children"))


def subtree_sums(found: DataFrame, rows: DataFrame, every: DataFrame, ends: DataFrame, shape: Shape, cut: Cut) -> DataFrame:
    """(depth, a, b, shared, leaves): over the members of each node but its owner, the text
    above their own depth; over all members, the leaves they own."""
    owners = every.groupBy("least").agg(
        F.min("depth").alias("own"), F.min(F.col("tokens") - F.col("size")).alias("above"), F.max((F.col("children") == 0).cast("bigint")).alias("leaf")
    )
    members = ends.join(owners.withColumnRenamed("least", "conv"), "conv", "left").select(
        "conv",
        "depth",
        F.coalesce("own", F.col("depth") + 1).alias("own"),
        F.coalesce("above", "tokens").alias("above"),
        F.coalesce("leaf", F.lit(0)).alias("leaf"),
    )
    members = cut(members, "members")
    part = F.floor(F.col("k") / shape.fan).cast("bigint")
    parts = F.sequence(F.lit(0).cast("bigint"), F.floor(F.col("depth") / (shape.block * shape.fan)).cast("bigint"))
    by_part = members.select("conv", F.explode(parts).alias("part"), "own", "above", "leaf")
    later = F.col("own") > F.col("k") * shape.block + F.col("m")
    sums = (
        rows.where("m > 0").select("conv", part.alias("part"), *VARIANT).join(by_part, ["conv", "part"]).groupBy(*VARIANT).agg(
            F.coalesce(F.sum(F.when(later, F.col("above"))), F.lit(0)).alias("later"),
            # At most one member of a variant becomes owner within the block or before it.
            F.max(F.when(~later, F.col("own"))).alias("own"),
            F.max(F.when(~later, F.col("above"))).alias("above"),
            F.sum("leaf").alias("leaf"),
        )
    )
    carried = ("later", "own", "above", "leaf")
    shared = F.col("later") + F.when(F.col("own") > F.col("depth"), F.col("above")).otherwise(0)
    names = [*KEY, "shared", "leaf"]
    both = found.join(sums, list(VARIANT))
    straight = turn_nodes(both.where("not diverge"), *carried).withColumn("shared", shared).select(*names)
    refined = turn_nodes(both.where("diverge"), *carried).withColumn("shared", shared)
    refined = refined.groupBy(*KEY).agg(F.sum("shared").alias("shared"), F.sum("leaf").alias("leaf"))
    zero = F.lit(0).cast("bigint")
    root = members.agg(F.coalesce(F.sum("above"), zero).alias("shared"), F.coalesce(F.sum("leaf"), zero).alias("leaf"))
    root = root.select(*(zero.alias(c) for c in KEY), "shared", "leaf")
    return straight.unionByName(refined.select(*names)).unionByName(root).withColumnRenamed("leaf", "leaves")


def end_digests(ends: DataFrame, cut: Cut, bits: int = 12) -> DataFrame:
    """(depth, a, b, ends_sha256) of nodes at which conversations end. Ids are joined in
    ranges of 4096; where there are several ranges, a task streams through them in order."""
    text = F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",")
    ranges = cut(ends.groupBy(*KEY, F.shiftright("conv", bits).alias("range")).agg(text.alias("ids")), "ends")
    counted = ranges.groupBy(*KEY).agg(F.count("*").alias("ranges"), F.max("ids").alias("ids"))
    counted = cut(counted.withColumn("ids", F.when(F.col("ranges") == 1, F.col("ids"))), "end-nodes")
    one = counted.where("ranges = 1").select(*KEY, F.sha2("ids", 256).alias("ends_sha256"))
    many = looked_up(ranges, counted.where("ranges > 1").select(*KEY, "ranges"), list(KEY), "ranges", 1000)
    many = many.repartition(*KEY).sortWithinPartitions(*KEY, "range").select(*KEY, "ids")
    return one.unionByName(many.mapInArrow(streamed, "depth bigint, a bigint, b bigint, ends_sha256 string"))


def streamed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the comma-joined ids of runs of rows with one key."""
    names = [*KEY, "ends_sha256"]
    key, digest = None, None
    for batch in batches:
        done = []
        for *at, ids in zip(*(batch.column(k).to_pylist() for k in range(4))):
            if at == key:
                digest.update(b"," + ids.encode())
                continue
            if key is not None:
                done.append((*key, digest.hexdigest()))
            key, digest = at, hashlib.sha256(ids.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=names)
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([c]) for c in (*key, digest.hexdigest())], names=names)


def prefix_trie(conversations: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """One row for each node of the trie of the rebuilt conversations."""
    cut = sinks.table_cut(conversations.sparkSession)
    turns, convs = rebuilt(conversations, shape, cut)
    rows = blocks(turns, convs, shape, cut)
    ends = rows.where(F.col("m") < shape.block).select(
        "conv", (F.col("k") * shape.block + F.col("m")).alias("depth"), F.col("qa").alias("a"), F.col("qb").alias("b"), (F.col("before") + F.col("size")).alias("tokens")
    )
    found = variants(rows, shape, cut)
    every = cut(with_children(nodes(found, rows)), "nodes")
    sums = subtree_sums(found, rows, every, ends, shape, cut)
    whole = every.join(sums, list(KEY)).join(end_digests(ends, cut), list(KEY), "left")
    parents = every.where("children > 0").select(
        (F.col("depth") + 1).alias("depth"), F.col("a").alias("ua"), F.col("b").alias("ub"), F.col("least").alias("parent"), F.col("children").alias("weight")
    )
    whole = cut(whole, "whole")
    below = looked_up(whole.where("depth > 0"), parents, ["depth", "ua", "ub"], "weight", shape.share)
    root = whole.where("depth = 0").withColumn("parent", F.lit(None).cast("bigint"))
    # Text that a member shares with a smaller one, from the node on.
    saved = F.col("shared") - (F.col("n") - 1) * (F.col("tokens") - F.col("size"))
    return below.drop("weight").unionByName(root).select(
        F.col("least").alias("conv_id"),
        "depth",
        F.col("parent").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        saved.alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
