"""Near duplicates by DartMinHash signatures, banded joining and exact verification.

A text is the set of its five-word shingles, or a multiset with counts as weights. Darts
are thrown at the plane of (weight, time): every element has its own stream of darts in
each of the weight regions [0, 1), [1, 2), [2, 4), ..., at a rate of one dart for each unit of
weight and time, and a dart counts for a text if it lies below the element's weight. Each
dart names a coordinate; the earliest dart of a coordinate is its signature value. Streams
depend on the element alone, so two texts agree on a coordinate with their (weighted)
Jaccard similarity. Time runs until every coordinate of a text is hit, which takes about
k log k darts whatever the length of the text.

Equal bands make candidates. Every bucket has a pivot, the member that shares most buckets;
pivot and members are compared exactly. What is left are pairs of members that are not both
linked to the pivot, and no bucket is expanded into them. A member is described by how it
differs from the pivot: shingles it has beside it and shingles of it that it misses. With a
and m of these for x, b and k for y, P shingles of the pivot and S differences in common,
x and y share P - m - k + S shingles of P + a + b - S; so similarity t asks for
S >= (m + k + t (a + b) - (1 - t) P) / (1 + t). A member x that is not linked to the pivot has
m + t a > (1 - t) P, so S > (k + t b) / (1 + t) of the k + b differences of y. Members meet only
on differences. Members of one class are not compared, so pivots whose members are all
linked to it, or of one class, are done. The members of another pivot lie in one task if
there are at most `members` of them with `differences` in all, and what each two have in
common is counted there. With more, they meet through a shuffle, on the differences they
have beside the pivot first, and each needs to show only so many that fewer than that stay
hidden. So no pair of a bucket is lost, and members that differ from the pivot in their own
ways never meet. Differences at which members of several classes meet are buckets again,
with pivots of their own; after `turns` of these, members of different classes that still
meet and whose counts allow it are compared in pairs.

Texts with the same words are one class from the start (null and empty texts, which have
no words, form one class too); only one of them goes on. Texts of fewer than five words
have one shingle, all their words. Rows with a null id take part; a class is named by its
smallest id (null if it has none). Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StructType

from stratline.llm import graph, sieve, texts
from stratline.llm.trie import looked_up
from stratline.sources import sinks


@dataclass(frozen=True)
class Darts:
    shingle: int = 5
    similarity: float = 0.8
    bands: int = 26
    band_rows: int = 5
    weighted: bool = False  # count how often a shingle occurs
    turns: int = 1  # of pivots, before what is left is compared in pairs
    members: int = 4096  # of a pivot, compared in one task
    differences: int = 1 << 18  # from the pivot, of all its members; 2 MB

    @property
    def coordinates(self) -> int:
        return self.bands * self.band_rows


def shingles(block: texts.Block, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes and their counts, in row order, with their rows, and a hash of
    each row's whole word sequence."""
    words = block.runs(texts.SPACE)
    row, hashes = words.row(), block.hashes().spans(words.start, words.end)
    at, gram = texts.grams(hashes, row, size)
    places = np.arange(len(words)) - words.first[row]
    mixed = texts.mix(hashes + texts.mix(places.astype(np.uint64)))
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(mixed, out=sums[1:])
    whole = texts.mix(sums[words.first[1:]] - sums[words.first[:-1]] + words.counts.astype(np.uint64))
    short = np.flatnonzero((words.counts > 0) & (words.counts < size))
    key = np.concatenate([gram, whole[short]])
    owner = np.concatenate([row[at], short])
    order = np.lexsort((key, owner))
    key, owner = key[order], owner[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
    cuts = np.flatnonzero(fresh)
    return key[cuts], np.diff(np.append(cuts, len(key))), owner[cuts], whole


def uniform(h: np.ndarray) -> np.ndarray:
    return ((h >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53


def signatures(key: np.ndarray, weight: np.ndarray, row: np.ndarray, rows: int, k: int) -> np.ndarray:
    """rows x k signature values; rows without an element are left 0.

    Streams of darts are walked in step: one dart of every stream that is still within its
    text's time at once. Texts with coordinates that no dart has hit get twice the time."""
    best = np.full(rows * k, np.inf)
    value = np.zeros(rows * k, np.uint64)
    mass = np.bincount(row, weight, rows)
    limit = (k * np.log(k) + 2 * k) / np.maximum(mass, 1e-12)
    element, low, high, width = [np.arange(len(key))], [np.zeros(len(key))], [np.ones(len(key))], []
    top = 1.0
    while len(heavy := np.flatnonzero(weight > top)):
        element.append(heavy)
        low.append(np.full(len(heavy), top))
        high.append(np.full(len(heavy), 2 * top))
        top *= 2
    element, low, high = (np.concatenate(x) for x in (element, low, high))
    width = high - low
    seed = texts.mix(key[element] ^ texts.mix(high.astype(np.uint64)))
    time, count = np.zeros(len(element)), np.zeros(len(element), np.uint64)
    todo = np.arange(len(element))
    while len(todo):
        live = todo
        while len(live):
            count[live] += np.uint64(1)
            dart = texts.mix(seed[live] + count[live] * texts.STEP)
            time[live] -= np.log(uniform(dart)) / width[live]
            inside = time[live] <= limit[row[element[live]]]
            late, live, dart = live[~inside], live[inside], dart[inside]
            count[late] -= np.uint64(1)  # thrown again if the time is doubled
            time[late] += np.log(uniform(texts.mix(seed[late] + (count[late] + np.uint64(1)) * texts.STEP))) / width[late]
            spot = texts.mix(dart)
            below = low[live] + width[live] * uniform(texts.mix(spot)) < weight[element[live]]
            hit, dart, spot = live[below], dart[below], spot[below]
            cell = row[element[hit]] * k + (spot % np.uint64(k)).astype(np.int64)
            np.minimum.at(best, cell, time[hit])
            first = best[cell] == time[hit]
            value[cell[first]] = dart[first]
        empty = np.isinf(best).reshape(rows, k).any(1) & (mass > 0)
        todo = np.flatnonzero(empty[row[element]])
        limit = np.where(empty, 2 * limit, limit)
    return value.reshape(rows, k)


def band_keys(values: np.ndarray, darts: Darts) -> np.ndarray:
    parts = values.reshape(len(values), darts.bands, darts.band_rows)
    out = np.zeros(parts.shape[:2], np.uint64)
    for r in range(darts.band_rows):
        out = texts.mix(out * texts.STEP + parts[:, :, r])
    return texts.mix(out + np.arange(darts.bands, dtype=np.uint64) * texts.STEP)


def sketch(docs: DataFrame, darts: Darts) -> DataFrame:
    """(id, key, whole, second, bands): hashes of the text and of its words, the band keys.

    The hash of the words has two independent halves."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in texts.blocks(texts.column(batch, "text")):
                key, count, row, whole = shingles(block, darts.shingle)
                weight = count.astype(float) if darts.weighted else np.ones(len(count))
                keys = band_keys(signatures(key, weight, row, block.rows, darts.coordinates), darts)
                n = np.bincount(row, minlength=block.rows)
                keys = keys[n > 0]
                cuts = np.concatenate(([0], np.cumsum(np.where(n > 0, darts.bands, 0)))).astype(np.int32)
                second = second_half(key, count, row, block.rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(block.first_row, block.rows),
                        batch.column(2).slice(block.first_row, block.rows),
                        pa.array(whole.view(np.int64)),
                        pa.array(second.view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(cuts), pa.array(keys.reshape(-1).view(np.int64))),
                    ],
                    names=["id", "key", "whole", "second", "bands"],
                )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("id"), F.col("text").cast("string").alias("text"), text_key().alias("key"))
    return rows.mapInArrow(run, "id bigint, key bigint, whole bigint, second bigint, bands array<bigint>")


def text_key() -> Column:
    """A hash of the text that needs no Python; never null."""
    return F.xxhash64(F.col("text").cast("string"))


def shingle_sets(rows: DataFrame, darts: Darts) -> DataFrame:
    """(node, items, counts): sorted shingle hashes of (node, text) rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in texts.blocks(texts.column(batch, "text")):
                key, count, row, _ = shingles(block, darts.shingle)
                cuts = np.searchsorted(row, np.arange(block.rows + 1)).astype(np.int32)
                part = batch.slice(block.first_row, block.rows)
                packed = pa.array([key[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())
                counts = pa.array([count[a:b].astype(np.int32).tobytes() if darts.weighted else b"" for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), packed, counts], names=["node", "items", "counts"])

    return rows.select("node", "text").mapInArrow(run, "node bigint, items binary, counts binary")


def similarity(a: bytes, b: bytes, counts_a: bytes, counts_b: bytes) -> float:
    """Jaccard similarity of two sorted sets, weighted if there are counts."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    _, at, to = np.intersect1d(x, y, True, True)
    if not counts_a:
        return len(at) / max(1, len(x) + len(y) - len(at))
    m, n = np.frombuffer(counts_a, np.int32), np.frombuffer(counts_b, np.int32)
    common = np.minimum(m[at], n[to]).sum()
    return float(common / max(1, m.sum() + n.sum() - common))


def verified(pairs: DataFrame, sets: DataFrame, darts: Darts) -> DataFrame:
    """(a, b, linked) of candidate pairs by the exact similarity of their shingles."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [batch.column(k).to_pylist() for k in range(2, 6)]
            found = [similarity(*x) >= darts.similarity for x in zip(*cols)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.bool_())], names=["a", "b", "linked"])

    left = sets.select(F.col("node").alias("a"), F.col("items").alias("x"), F.col("counts").alias("cx"))
    right = sets.select(F.col("node").alias("b"), F.col("items").alias("y"), F.col("counts").alias("cy"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y", "cx", "cy")
    return both.mapInArrow(run, "a bigint, b bigint, linked boolean")


SHARE = 1000  # keys with more than this part of all rows are looked up by broadcast


def differences(pairs: DataFrame, sets: DataFrame, darts: Darts) -> DataFrame:
    """(pivot, node, linked, p, extra, missing, token) of every pivot and member: whether they
    are similar, the numbers of shingles of the pivot, of those beside it and of those missed,
    and these differences, the ones beside it first, each kind in the order of its hashes."""
    t = darts.similarity

    def compared(items: bytes, counts: bytes, of: bytes, of_counts: bytes) -> tuple:
        x, p = whole_set(items, counts), whole_set(of, of_counts)
        extra, missing = np.setdiff1d(x, p, True), np.setdiff1d(p, x, True)
        a, m = len(extra), len(missing)
        linked = (len(x) - a) / max(1, len(p) + a) >= t
        # The last bit tells the kinds apart.
        token = np.concatenate([extra << np.uint64(1), missing << np.uint64(1) | np.uint64(1)]).view(np.int64)
        return linked, len(p), a, m, token

    names = ["pivot", "node", "linked", "p", "extra", "missing", "token"]
    kinds = [pa.bool_(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int64())]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(at, 500) for at in range(0, whole.num_rows, 500)):
                found = [compared(*x) for x in zip(*(batch.column(k).to_pylist() for k in range(2, 6)))]
                cols = [pa.array(c, kind) for c, kind in zip(zip(*found), kinds)]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *cols], names=names)

    left = sets.select("node", F.col("items").alias("x"), F.col("counts").alias("cx"))
    right = sets.select(F.col("node").alias("pivot"), F.col("items").alias("y"), F.col("counts").alias("cy"))
    both = pairs.join(left, "node").join(right, "pivot").select("pivot", "node", "x", "cx", "y", "cy")
    schema = "pivot bigint, node bigint, linked boolean, p int, extra int, missing int, token array<bigint>"
    return both.mapInArrow(run, schema)


def whole_set(items: bytes, counts: bytes) -> np.ndarray:
    """The shingles of a text; with counts, one element for each time a shingle occurs."""
    x = np.frombuffer(items, np.uint64)
    if not counts:
        return x
    n = np.frombuffer(counts, np.int32)
    time = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return np.unique(texts.mix(np.repeat(x, n) + time.astype(np.uint64) * texts.STEP))


def open_stars(found: DataFrame, labels: DataFrame, darts: Darts, cut, name: str) -> tuple[DataFrame, DataFrame]:
    """What differences() says of the members, and their classes (label), of pivots that have
    members of several classes and one that is not linked: first of pivots whose members are
    compared in one task, then of the others, with the least m + t a of any member (least) and
    of one that is not linked (least_own)."""
    known = found.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    known = cut(known.withColumn("far", F.col("missing") + darts.similarity * F.col("extra")), f"{name}-known")
    sizes = known.groupBy("pivot").agg(
        F.min("label").alias("low"),
        F.max("label").alias("high"),
        F.count("*").alias("n"),
        F.sum(F.col("extra").cast("bigint") + F.col("missing")).alias("differences"),
        F.min("far").alias("least"),
        F.min(F.when(~F.col("linked"), F.col("far"))).alias("least_own"),
    )
    one_task = (F.col("n") <= darts.members) & (F.col("differences") <= darts.differences)
    sizes = sizes.where("least_own is not null and low <> high").select("pivot", "n", "least", "least_own", one_task.alias("one_task"))
    members = cut(looked_up(known, cut(sizes, f"{name}-stars"), ["pivot"], "n", SHARE).drop("n"), f"{name}-members")
    return members.where("one_task"), members.where("not one_task")


def within(members: DataFrame, darts: Darts) -> DataFrame:
    """(a, b): similar members of different classes, one of them not linked to their pivot."""
    t = darts.similarity

    def run(star: pa.Table) -> pa.Table:
        node, label, linked, p, extra, missing = (
            star[c].to_numpy().astype(kind) for c, kind in (("node", int), ("label", int), ("linked", bool), ("p", int), ("extra", int), ("missing", int))
        )
        n, sizes = len(node), extra + missing
        cuts = np.concatenate(([0], np.cumsum(sizes)))
        _, number, count = np.unique(pc.list_flatten(star["token"]).to_numpy(), return_inverse=True, return_counts=True)
        has = np.repeat(np.arange(n), sizes)[np.argsort(number, kind="stable")]  # members with each difference
        first = np.cumsum(count) - count
        a, b = [node[:0]], [node[:0]]
        for x in np.flatnonzero(~linked):
            own = number[cuts[x] : cuts[x + 1]]
            ends = np.cumsum(count[own])
            at = np.repeat(first[own] - ends + count[own], count[own]) + np.arange(ends[-1])
            common = np.bincount(has[at], minlength=n)
            similar = (p - missing[x] - missing + common) / np.maximum(1, p + extra[x] + extra - common) >= t
            y = np.flatnonzero(similar & (label != label[x]) & (linked | (np.arange(n) > x)))
            a.append(np.minimum(node[x], node[y]))
            b.append(np.maximum(node[x], node[y]))
        return pa.table({"a": np.concatenate(a), "b": np.concatenate(b)})

    used = members.select("pivot", "node", "label", "linked", "p", "extra", "missing", "token")
    return used.groupBy("pivot").applyInArrow(run, "a bigint, b bigint")


def open_buckets(known: DataFrame, darts: Darts, cut, name: str) -> DataFrame:
    """(band, node, own, and what open_stars() says of it): members by the differences they
    can meet on, for differences with an own one and members of several classes."""
    t = darts.similarity
    total = F.col("extra") + F.col("missing")
    room = F.col("far") - (1 - t) * F.col("p")
    # Hidden differences are fewer than any link needs: to a member that is not linked, and for
    # one that is not linked (own) to any member.
    least = F.greatest(F.floor(F.col("far") / (1 + t) + 1e-9) + 1, F.ceil((room + F.col("least_own")) / (1 + t) - 1e-9))
    least_own = F.greatest(F.lit(1), F.ceil(room - 1e-9), F.ceil((room + F.col("least")) / (1 + t) - 1e-9))
    facts = ["pivot", "node", "label", "p", "extra", "missing"]

    def shown(rows: DataFrame, least: Column, own: bool) -> DataFrame:
        size = F.greatest(F.lit(0), total - least + 1).cast("int")
        each = rows.select(*facts, (total - size).alias("hidden"), F.explode(F.slice("token", F.lit(1), size)).alias("token"))
        return each.withColumn("own", F.lit(own))

    # A shown difference that is also an own one counts as own.
    each = shown(known, least, False).unionByName(shown(known.where("not linked"), least_own, True))
    each = cut(each.withColumn("band", F.xxhash64("pivot", "token")).drop("token"), f"{name}-tokens")
    sizes = each.groupBy("band").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.max("own").alias("any"), F.count("*").alias("n")
    )
    sizes = cut(sizes.where("any and low <> high").select("band", "n"), f"{name}-open")
    return cut(looked_up(each, sizes, ["band"], "n", SHARE).drop("n"), f"{name}-buckets")


def meetings(buckets: DataFrame, darts: Darts) -> DataFrame:
    """(a, b): members of different classes that meet on differences and may be similar.

    Common differences up to the last one that either list shows are all met on; of those
    behind it there are no more than that list hides."""
    t = darts.similarity
    x = buckets.where("own").select(
        "band", "pivot", "p", *(F.col(c).alias(n) for c, n in (("node", "x"), ("label", "lx"), ("extra", "a"), ("missing", "m"), ("hidden", "hx")))
    )
    y = buckets.where("not own").select(
        "band", *(F.col(c).alias(n) for c, n in (("node", "y"), ("label", "ly"), ("extra", "b"), ("missing", "k"), ("hidden", "hy")))
    )
    need = (F.col("m") + F.col("k") + t * (F.col("a") + F.col("b")) - (1 - t) * F.col("p")) / (1 + t) - 1e-9
    possible = F.least("m", "k") + F.least("a", "b") >= need
    met = x.join(y, "band").where((F.col("lx") != F.col("ly")) & possible)
    counted = met.groupBy("pivot", "x", "y").agg(F.count("*").alias("n"), F.max(need - F.greatest("hx", "hy")).alias("need"))
    some = counted.where("n >= need")
    return some.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def stars(buckets: DataFrame, rank: DataFrame, cut, name: str) -> DataFrame:
    """(pivot, node): each bucket's pivot, the own member in most buckets, and its others."""
    ranked_own = buckets.where("own").select("band", "node").join(rank, "node")
    pivots = ranked_own.groupBy("band").agg(F.max(F.struct("rank", "node")).getField("node").alias("pivot"))
    sizes = buckets.groupBy("band").agg(F.count("*").alias("n"))
    heads = cut(pivots.join(sizes, "band"), f"{name}-pivots")
    pairs = looked_up(buckets.select("band", "node"), heads, ["band"], "n", SHARE)
    return pairs.where("node <> pivot").select("pivot", "node").distinct()


def classes(docs: DataFrame, darts: Darts = Darts()) -> DataFrame:
    """(id, key, whole, second, class_id, first, alone): one row for each row of docs.

    class_id is the smallest id of the row's class; first marks the texts (whole, second)
    of that smallest id, so that one text of a class has it; alone says that the class has
    no other row."""
    spark = docs.sparkSession
    cut = sinks.table_cut(spark)
    rows = cut(sketch(docs, darts), "sketches")
    # One node for each different sequence of words, numbered by a hash of its two hashes.
    nodes = rows.groupBy("whole", "second").agg(F.min("id").alias("least"), F.first("bands").alias("bands"), F.count("*").alias("copies"))
    nodes = cut(nodes.withColumn("node", F.xxhash64("whole", "second")), "nodes")
    keys = nodes.select("node", F.explode("bands").alias("band"))
    shared = keys.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select("band")
    members = cut(ranked(keys.join(shared, "band")), "members")
    used = members.select("node").distinct().join(nodes.select("node", "whole", "second"), "node")
    text_rows = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    wanted = sieve.Sieve(used, "whole")
    whole_of = node_texts(text_rows, darts, wanted).join(used, ["whole", "second"]).dropDuplicates(["node"]).select("node", "text")
    sets = cut(shingle_sets(whole_of, darts), "sets")
    rank = members.groupBy("node").agg(F.max("rank.rank").alias("rank"))
    buckets, links = members.select("band", "node", F.lit(True).alias("own")), []
    for turn in range(darts.turns):
        pairs = stars(buckets, rank, cut, f"turn-{turn}")
        found = cut(differences(pairs, sets, darts), f"differences-{turn}")
        links.append(found.where("linked").select(F.col("pivot").alias("a"), F.col("node").alias("b")))
        labels = graph.components(reduce(DataFrame.unionByName, links), cut, f"labels-{turn}")
        small, large = open_stars(found, labels, darts, cut, f"turn-{turn}")
        links.append(cut(within(small, darts), f"within-{turn}"))
        buckets = open_buckets(large, darts, cut, f"turn-{turn}")
    others = cut(verified(meetings(buckets, darts), sets, darts), "verified")
    links.append(others.where("linked").select("a", "b"))
    labels = graph.components(reduce(DataFrame.unionByName, links), cut, "labels")
    named = nodes.select("node", "whole", "second", "least", "copies").join(labels, "node", "left")
    named = cut(named.withColumn("label", F.coalesce("label", "node")), "named")
    # A class may hold a third of all nodes: its smallest id is found by an aggregate.
    least = named.groupBy("label").agg(
        F.min(F.struct(F.col("least").isNull().alias("none"), "least", "node")).alias("head"), F.count("*").alias("n"), F.sum("copies").alias("rows")
    )
    heads = looked_up(named, cut(least, "least"), ["label"], "n", SHARE).select(
        "whole", "second", F.col("head.least").alias("class_id"), (F.col("head.node") == F.col("node")).alias("first"), (F.col("rows") == 1).alias("alone")
    )
    return rows.select("id", "key", "whole", "second").join(cut(heads, "heads"), ["whole", "second"])


def ranked(keys: DataFrame) -> DataFrame:
    """Members of buckets with a rank: how many members their buckets have, all together.

    A text with many variants agrees with each of them more often than they agree with one
    another, so it has the largest rank among them, and one comparison with it joins them."""
    sizes = keys.groupBy("band").agg(F.count("*").alias("n"))
    rank = keys.join(sizes, "band").groupBy("node").agg(F.sum("n").alias("rank"))
    return keys.join(rank, "node").select("band", "node", F.struct("rank", "node").alias("rank"))


def node_texts(rows: DataFrame, darts: Darts, wanted: sieve.Sieve) -> DataFrame:
    """(whole, second, text) of the rows that may be wanted."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in texts.blocks(batch.column(0)):
                whole, second = identity(block, darts)
                used = pa.array(wanted.has(whole))
                part = batch.column(0).slice(block.first_row, block.rows)
                found = pa.RecordBatch.from_arrays([pa.array(whole), pa.array(second), part], names=["whole", "second", "text"])
                yield found.filter(used)

    return rows.mapInArrow(run, "whole bigint, second bigint, text string")


def identity(block: texts.Block, darts: Darts) -> tuple[np.ndarray, np.ndarray]:
    key, count, row, whole = shingles(block, darts.shingle)
    return whole.view(np.int64), second_half(key, count, row, block.rows).view(np.int64)


def second_half(key: np.ndarray, count: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """A second hash of a text, from its shingles."""
    out = np.zeros(rows, np.uint64)
    np.add.at(out, row, texts.salted(key, 99) * count.astype(np.uint64))
    return out


def keep_one(docs: DataFrame, darts: Darts = Darts()) -> DataFrame:
    """One document of each class: the one with the smallest id. All columns stay.

    Rows that are surely alone in their class stay where they are."""
    spark = docs.sparkSession
    cut = sinks.table_cut(spark)
    names = {c: f"_{k}_{c}" for k, c in enumerate(("id", "whole", "second", "key"))}
    key = names.pop("key")
    stays = (F.col("first") & F.col("id").eqNullSafe(F.col("class_id"))).alias("_stays")
    shared = classes(docs, darts).where("not alone")
    shared = cut(shared.select("key", *(F.col(c).alias(n) for c, n in names.items()), stays), "shared")
    may = sieve.Sieve(shared, "key")
    shared = shared.drop("key").distinct()
    columns = docs.columns

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Sifted here: a step of Python before this one would take a second worker for each task.
            used = may.has(batch.column(len(columns)).to_numpy(zero_copy_only=False))
            batch = batch.select(range(len(columns))).filter(pa.array(used))
            for block in texts.blocks(texts.column(batch, "text")):
                whole, second = identity(block, darts)
                part = batch.slice(block.first_row, block.rows)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(whole), pa.array(second)], names=[*columns, names["whole"], names["second"]])

    keyed = docs.select("*", text_key().alias(key)).mapInArrow(run, with_keys(docs, names))
    keyed = keyed.withColumn(names["id"], F.col("doc_id").cast("bigint"))
    same = [keyed[n].eqNullSafe(shared[n]) for n in names.values()]
    kept = keyed.join(shared, same[0] & same[1] & same[2], "left")
    kept = kept.where(shared["_stays"].isNull() | shared["_stays"]).select(*(keyed[c] for c in (*columns, *names.values())))
    # Repeated rows share id and words; one of them stays.
    kept = kept.dropDuplicates(list(names.values())).select(*columns)
    return kept.unionAll(docs.where(~may.column(text_key())))


def with_keys(docs: DataFrame, names: dict[str, str]) -> StructType:
    """The columns of docs and the two halves of the hash of the words, by their names."""
    schema = StructType(list(docs.schema.fields))
    for c in ("whole", "second"):
        schema = schema.add(names[c], LongType())
    return schema
