"""Personal data by boosted candidates, in DataFrame functions only.

Four base kinds are found by their patterns and checks (Luhn, octets, digits). Two
generators of high recall propose further spans, which may overlap the base ones and each
other: anything like an address with an at sign, also written out or spaced, and any run of
digits in groups. A candidate is described by its format (digits, groups, separators, how
varied its digits are) and its context (what stands around it, words before it), never by
what the base checks look at beyond that. Candidates that a base span meets are the
positive examples, all others the negative ones. Boosted trees are grown on the counts of
each different feature vector, so all candidates of the corpus take part; every level of a
tree is one aggregate. On documents of a fold that the trees have not seen, each kind of
candidate gets the lowest threshold from which on its precision holds; a kind that never
reaches it adds nothing. Candidates above their threshold that meet no base span are added
under the name of their kind, the best of those that overlap.

Positions come from running totals over the matches of a text, so a text with very many
matches costs no more than its matches. Patterns are possessive and anchored at run
starts, so long runs of one character are read once and need no stack.

Null and empty texts have no spans: counts 0, digest of the empty string. Texts are whole,
whatever their length. Repeated rows and null ids are reported each by itself; ties between
overlapping candidates go to the first. An empty table gives an empty result; without
examples nothing is added. Other columns are not looked at.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from stratline.models.trees import Plan, Tree, can_split, split
from stratline.sources import sinks

# The base kinds and their patterns, in forms that read a run once.
LOCAL = r"[A-Za-z0-9._%+-]"
EMAIL = rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
OCTET = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
KINDS = ("email", "ip", "card", "phone", "email_like", "ip_like", "card_like", "phone_like")
BASE = 4
# Generators: addresses, also spelt out; digits in groups.
ADDRESS = rf"(?:(?<!{LOCAL})|\G){LOCAL}++\x20?(?:@|[(\[]at[)\]])\x20?[A-Za-z0-9-]++(?:(?:\.|\x20?[(\[]dot[)\]]\x20?)[A-Za-z0-9-]++)*+"
NUMBER = r"[+(]{0,2}[0-9](?:[\x20().:/-]{0,2}[0-9])++"
# Words before a value, as (a part of) lower-case words.
HINTS = (
    r"mail|contact|write|correo|courriel",
    r"\btel|phone|call|\bfax|mobil",
    r"card|visa|credit|payment|karte|tarjeta",
    r"\bip\b|host|server|addr",
    r"order|invoice|version|\bid\b|token|key|secret|hash|[=\"']\s*$",
)
FEATURES = (
    "kind", "length", "digits", "groups", "first_group", "last_group", "separators", "variety", "valid", "left", "right",
    *(f"hint{k}" for k in range(len(HINTS))),
)
BINS = 32


@dataclass(frozen=True)
class Boost:
    trees: int = 12
    depth: int = 3
    rate: float = 0.3
    folds: int = 5  # of the documents, by hash; the first sets the thresholds
    precision: float = 0.75
    examples: int = 20  # positives above a threshold, at least
    context: int = 32  # characters looked at on the left


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def matches(text: Column, pattern: str) -> tuple[Column, Column]:
    """What lies between the matches of a pattern (one part more than matches), and these."""
    return F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def checked(kind: int, value: Column) -> Column:
    """Whether a match of a base pattern passes its check."""
    n = F.length(digits(value))
    if kind == 1:
        return value.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == 2:
        return n.between(12, 19) & F.coalesce(F.call_function("luhn_check", F.when(n.between(12, 19), digits(value))), F.lit(False))
    return n.between(9, 15) if kind == 3 else F.lit(True)


def side(text: Column, last: bool) -> Column:
    """Class of the character next to a match: 0 none, 1 space, 2 letter, 3 digit, 4 other."""
    c = F.right(text, F.lit(1)) if last else F.left(text, F.lit(1))
    return F.when(F.length(c) == 0, 0).when(c.rlike(r"^\s"), 1).when(c.rlike(r"^\p{L}"), 2).when(c.rlike("^[0-9]"), 3).otherwise(4)


def features(gap: Column, value: Column, after: Column, address: bool, plan: Boost) -> Column:
    """Bins of the features of a candidate, in the order of FEATURES."""
    if address:
        value = F.regexp_replace(F.regexp_replace(value, r"\x20?[(\[]at[)\]]\x20?", "@"), r"\x20?[(\[]dot[)\]]\x20?", ".")
    else:
        value = F.regexp_replace(value, r"^[(]?\+[0-9]{1,3}[\x20.-](?=.{7})", "")
    d, n = digits(value), F.length(value)
    groups = F.split(F.regexp_replace(value, r"^[^0-9]+", ""), r"[@.]" if address else "[^0-9]+", -1)
    dotted = value.rlike(r"^[0-9]+(?:\.[0-9]+){3}$")
    long = F.length(d).between(12, 19)
    kind = F.lit(4) if address else F.when(dotted, 5).when(long, 6).otherwise(7)
    valid = F.lit(2) if address else F.when(dotted, checked(1, value).cast("int")).when(long, checked(2, value).cast("int")).otherwise(2)
    left = F.lower(F.right(gap, F.lit(plan.context)))
    parts = [
        kind,
        n,
        F.length(d),
        F.size(groups),
        F.length(F.get(groups, F.lit(0))),
        F.length(F.element_at(groups, -1)),
        F.length(F.regexp_replace(value, "[A-Za-z0-9]", "")),
        reduce(lambda a, b: a + b, (d.contains(str(k)).cast("int") for k in range(10))),
        valid,
        side(gap, True),
        side(after, False),
        *(left.rlike(h).cast("int") for h in HINTS),
    ]
    return F.array(*(F.least(p.cast("int"), F.lit(BINS - 1)) for p in parts))


def scanned(docs: DataFrame, plan: Boost) -> DataFrame:
    """(row, id, found): matches of every text as (kind or generator, number, characters
    since the match before, length, check passed, features). No text is kept."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.select(F.monotonically_increasing_id().alias("row"), "id", "text")
    none = F.array().cast("array<struct<source:int,number:int,gap:int,length:int,used:boolean,x:array<int>>>")
    out = []
    for k, pattern in enumerate((EMAIL, IP, CARD, PHONE, ADDRESS, NUMBER)):
        gaps, found = matches(F.col("text"), pattern)
        after = F.slice(gaps, 2, F.greatest(F.size(gaps), F.lit(1)))
        whole = F.arrays_zip(gaps.alias("gap"), found.alias("value"), after.alias("after"))
        # The last gap has no match behind it; matches that fail still move what follows.
        out.append(F.when(F.size(found) > 0, F.transform(F.slice(whole, 1, F.size(found)), described(k, plan))).otherwise(none))
    return rows.select("row", "id", F.concat(*out).alias("found"))


def described(k: int, plan: Boost):
    """What is kept of a match of pattern k."""

    def of(part: Column, number: Column) -> Column:
        value = part["value"]
        if k < BASE:
            used, x = checked(k, value), F.lit(None).cast("array<int>")
        else:
            used = F.lit(True) if k == BASE else F.length(digits(value)) >= 7
            x = F.when(used, features(part["gap"], value, part["after"], k == BASE, plan))
        return F.struct(
            F.lit(k).alias("source"), number.alias("number"), F.length(part["gap"]).alias("gap"), F.length(value).alias("length"),
            used.alias("used"), x.alias("x"),
        )

    return of


def placed(rows: DataFrame) -> DataFrame:
    """(row, id, source, start, stop, x) of the matches in use."""
    each = rows.where(F.size("found") > 0).select("row", "id", F.inline("found"))
    order = Window.partitionBy("row", "source").orderBy("number").rowsBetween(Window.unboundedPreceding, 0)
    stop = F.sum(F.col("gap") + F.col("length")).over(order)
    return each.withColumn("stop", stop).where("used").select("row", "id", "source", (F.col("stop") - F.col("length")).alias("start"), "stop", "x")


def judged(spans: DataFrame) -> DataFrame:
    """Adds `met`: whether a base span overlaps this one."""
    base = F.col("source") < BASE
    by_start = Window.partitionBy("row").orderBy("start")
    behind = F.max(F.when(base, F.col("stop"))).over(by_start.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    ahead = F.min(F.when(base, F.col("start"))).over(by_start.rangeBetween(Window.currentRow, Window.unboundedFollowing))
    return spans.withColumn("met", F.coalesce(behind > F.col("start"), F.lit(False)) | F.coalesce(ahead < F.col("stop"), F.lit(False)))


def margin(x: Column, start: float, trees: list[Tree], depth: int) -> Column:
    """The sum of the trees for a feature vector: a walk in a constant table of trees."""
    out = F.lit(float(start))
    if not trees:
        return out
    # One constant, as text: an expression for each number would cost more than the pass.
    rows = [{"f": t.feature.tolist(), "b": t.bin.tolist(), "v": [float(v) for v in t.value]} for t in map(settled, trees)]
    table = F.from_json(F.lit(json.dumps(rows)), "array<struct<f:array<int>,b:array<int>,v:array<double>>>")

    def walk(total: Column, tree: Column) -> Column:
        at = F.lit(0)
        for _ in range(depth):
            right = F.get(x, F.get(tree["f"], at)) > F.get(tree["b"], at)
            at = 2 * at + 1 + F.when(right, 1).otherwise(0)
        return total + F.get(tree["v"], at)

    return F.aggregate(table, out, walk)


def settled(tree: Tree) -> Tree:
    """The tree with every leaf's value handed down to the last level."""
    out = Tree(tree.feature.copy(), tree.bin.copy(), tree.value.copy(), tree.gain)
    for node in range(len(out.feature) // 2):
        if out.feature[node] < 0:
            out.feature[node], out.bin[node] = 0, 1 << 30
            for child in (2 * node + 1, 2 * node + 2):
                out.value[child], out.feature[child] = out.value[node], -1
    return out


@dataclass(frozen=True)
class Model:
    start: float
    trees: tuple[Tree, ...]
    thresholds: dict[int, float]  # by kind of candidate


def fit(candidates: DataFrame, plan: Boost, cut) -> Model:
    """Trees on the counts of every feature vector, thresholds on the fold left out."""
    held = F.pmod(F.xxhash64("id"), F.lit(plan.folds)) == 0
    counts = candidates.groupBy("x").agg(
        *(F.sum((where & (F.col("met") == met)).cast("bigint")).alias(name) for name, where, met in
          (("up", ~held, True), ("down", ~held, False), ("held_up", held, True), ("held_down", held, False)))
    )
    cells = cut(counts, "cells").persist()
    try:
        total = cells.agg(F.sum("up").alias("up"), F.sum("down").alias("down")).first()
        up, down = total["up"] or 0, total["down"] or 0
        if not up or not down:
            return Model(0.0, (), {})
        start, trees = float(np.log(up / down)), []
        shape = Plan(trees=plan.trees, depth=plan.depth, rate=plan.rate, logistic=True)
        for _ in range(plan.trees):
            tree = Tree.stump(plan.depth)
            for level in range(plan.depth):
                if can_split(tree, level):
                    split(tree, level, *level_sums(cells, start, trees, tree, level, plan.depth), shape)
            trees.append(tree)
        return Model(start, tuple(trees), thresholds(cells, start, trees, plan))
    finally:
        cells.unpersist()


def level_sums(cells: DataFrame, start: float, trees: list[Tree], growing: Tree, level: int, depth: int):
    """Sums of gradient and hessian by (node of the level, feature, bin): one aggregate."""
    x, first = F.col("x"), 2**level - 1
    p = 1 / (1 + F.exp(-margin(x, start, trees, depth)))
    feature, border = (F.from_json(F.lit(json.dumps(v.tolist())), "array<int>") for v in (growing.feature, growing.bin))
    at = F.lit(0)
    for _ in range(level):
        split_on = F.get(feature, at)
        right = F.get(x, F.greatest(split_on, F.lit(0))) > F.get(border, at)
        at = F.when(split_on < 0, at).otherwise(2 * at + 1 + F.when(right, 1).otherwise(0))
    n = F.col("up") + F.col("down")
    rows = cells.where("up + down > 0").select("x", at.alias("at"), (n * p - F.col("up")).alias("g"), (n * p * (1 - p)).alias("h"))
    rows = rows.where(F.col("at") >= first).select("at", "g", "h", F.posexplode("x").alias("f", "bin"))
    found = rows.groupBy("at", "f", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect()
    out = np.zeros((2, 2**level, len(FEATURES), BINS))
    for r in found:  # nodes x features x bins at most
        out[:, r["at"] - first, r["f"], max(r["bin"], 0)] = r["g"], r["h"]
    return out


def thresholds(cells: DataFrame, start: float, trees: list[Tree], plan: Boost) -> dict[int, float]:
    """For each kind the lowest margin (in steps of 0.05) from which on the held-out
    precision holds, if enough positives lie above it."""
    score = F.floor(margin(F.col("x"), start, trees, plan.depth) * 20) / 20
    steps = cells.groupBy(F.get("x", F.lit(0)).alias("kind"), score.alias("score")).agg(F.sum("held_up").alias("up"), F.sum("held_down").alias("down"))
    above = Window.partitionBy("kind").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    up, down = F.sum("up").over(above), F.sum("down").over(above)
    good = steps.withColumns({"all_up": up, "all_down": down}).where(
        (F.col("all_up") >= plan.precision * (F.col("all_up") + F.col("all_down"))) & (F.col("all_up") >= plan.examples)
    )
    return {r["kind"]: float(r["score"]) for r in good.groupBy("kind").agg(F.min("score").alias("score")).collect()}


def added(candidates: DataFrame, model: Model, plan: Boost) -> DataFrame:
    """(row, id, start, kind, stop) of the candidates above their threshold that no base span
    meets; of a run of overlapping ones the one with the highest margin, then the first."""
    out = candidates.where("not met").withColumn("kind", F.get("x", F.lit(0)))
    passed = F.lit(False)
    score = margin(F.col("x"), model.start, list(model.trees), plan.depth)
    for kind, least in sorted(model.thresholds.items()):
        passed = passed | ((F.col("kind") == kind) & (F.col("score") >= least))
    out = out.withColumn("score", score).where(passed)
    order = Window.partitionBy("row").orderBy("start", "stop", "kind")
    before = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(F.col("start") < before, 0).otherwise(1)
    out = out.withColumn("fresh", fresh).withColumn("run", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    best = F.min(F.struct(-F.col("score"), "start", "stop", "kind")).alias("best")
    return out.groupBy("row", "run").agg(F.first("id").alias("id"), best).select("row", "id", "best.start", "best.kind", "best.stop")


def listed(found: Column) -> Column:
    """kind:start:end by start, then kind as listed, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    parts = F.transform(found, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string")))
    return F.array_join(parts, ",")


def find(docs: DataFrame, plan: Boost = Boost()) -> DataFrame:
    """One row for each document: counts and digest of the base spans, and all spans."""
    cut = sinks.table_cut(docs.sparkSession)
    rows = cut(scanned(docs, plan), "scanned")
    spans = cut(judged(placed(rows)), "spans")
    candidates = spans.where(F.col("source") >= BASE)
    model = fit(candidates, plan, cut)
    base = spans.where(F.col("source") < BASE).select("row", "id", "start", F.col("source").alias("kind"), "stop")
    every = base.unionByName(added(candidates, model, plan))
    span = F.struct(F.col("start").cast("bigint").alias("start"), F.col("kind").cast("int").alias("kind"), F.col("stop").cast("bigint").alias("stop"))
    none = F.lit(None).cast("struct<start:bigint,kind:int,stop:bigint>")
    # Every row leaves a mark, so that rows without spans stay; nulls are not collected.
    marks = rows.select("row", "id", none.alias("span"))
    whole = every.select("row", "id", span.alias("span")).unionByName(marks)
    out = whole.groupBy("row").agg(F.max("id").alias("id"), F.sort_array(F.collect_list("span")).alias("found"))
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("bigint")
    return out.select(
        F.col("id").alias("doc_id"),
        *(count(k).alias(f"n_{name}") for k, name in enumerate(KINDS[:BASE])),
        F.sha2(listed(F.filter("found", lambda s: s["kind"] < BASE)), 256).alias("base_sha256"),
        listed(F.col("found")).alias("spans"),
    )
