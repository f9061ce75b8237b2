"""Secret scans with ownership frequency, in DataFrame functions only.

Every text is scanned for three base kinds and two more: tokens with a vendor's own prefix,
and long mixed strings. The values found are counted over the corpus by distinct
repositories and owners, after one pre-aggregation by (value, owner, repository), so a
value in a third of all rows is no large group. A value is a widely copied example if it
stands in more repositories and belongs to more owners than a few, or than a share of all
that the corpus has, and no owner holds most of its rows; every other value is specific to
its owners and looks live. Spans of the base kinds are always reported; vendor tokens and
mixed strings only where the value looks live.

Null and empty texts have no spans: counts 0, empty lists. Repeated rows are reported each
by itself and count once for their owner. Null owners and repositories count as one
owner or repository with an empty name. Other columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from stratline.sources import sinks

# The base patterns.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"  # a maximal run of 18 or more characters
HEX = r"[0-9a-f]{16,}"
VENDOR = (
    r"gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{35,}|[sr]k_live_[A-Za-z0-9]{16,}"
    r"|eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}|-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"
)
MIXED = r"[A-Za-z0-9+/_-]{24,}"
KINDS = ("assign", "access", "hex", "vendor", "mixed")
BASE = KINDS[:3]
SPREAD = ("n_owners", "n_repos", "n_rows")


@dataclass(frozen=True)
class Ownership:
    few: int = 2  # up to so many owners or repositories a value is owner-specific
    share: float = 1e-4  # or up to this part of all owners, or of all repositories
    most: float = 0.9  # an owner with this part of a value's rows makes it specific
    min_distinct: int = 12  # distinct characters of a mixed string


def spans(text: Column, pattern: str, kind: int, group: int = 0, least: int = 0) -> Column:
    """Matches of a pattern, leftmost and not overlapping: struct of start, end (code
    points), kind and value; the value is the group's text, of at least `least` characters.

    What lies between the matches and the matches themselves are walked together; their
    lengths add up to the places."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    parts = F.arrays_zip(between.alias("gap"), found.alias("match"), values.alias("value"))
    none = F.array().cast("array<struct<start:int,stop:int,kind:int,value:string>>")
    start = F.struct(F.lit(0).alias("at"), none.alias("spans"))

    def step(state: Column, part: Column) -> Column:
        begin = state["at"] + F.length(part["gap"])
        end = begin + F.length(part["match"])
        span = F.struct(begin.alias("start"), end.alias("stop"), F.lit(kind).alias("kind"), part["value"].alias("value"))
        return F.when(part["match"].isNull(), state).otherwise(
            F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))
        )

    walked = F.aggregate(parts, start, step)["spans"]
    kept = F.filter(walked, lambda s: F.length(s["value"]) >= least) if least else walked
    return F.when(F.size(found) > 0, kept).otherwise(none)


def scanned(docs: DataFrame, owner: str, repository: str, plan: Ownership) -> DataFrame:
    """(row, id, owner, repo, found): the spans of every text, values as SHA-256."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("id"), name(owner).alias("owner"), name(repository).alias("repo"), name("text").alias("text")
    )
    text = F.col("text")
    mixed = F.filter(
        spans(text, MIXED, 4),
        lambda s: s["value"].rlike("[0-9]")
        & s["value"].rlike("[A-Z]")
        & s["value"].rlike("[a-z]")
        & (F.size(F.array_distinct(F.split(s["value"], ""))) > plan.min_distinct),
    )
    found = F.concat(spans(text, ASSIGN, 0, group=2, least=12), spans(text, ACCESS, 1), spans(text, HEX, 2), spans(text, VENDOR, 3), mixed)
    hashed = F.transform(
        found, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["stop"].alias("stop"), F.sha2(s["value"], 256).alias("value"))
    )
    return rows.select(F.monotonically_increasing_id().alias("row"), "id", "owner", "repo", hashed.alias("found"))


def listed(found: Column) -> Column:
    """kind:start:end by start, then kind as listed, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    parts = F.transform(
        F.array_sort(found), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))
    )
    return F.array_join(parts, ",")


def ownership(found: DataFrame) -> DataFrame:
    """(value, n_owners, n_repos, n_rows, top_rows) of every value found; top_rows are those
    of the owner with the most."""
    each = found.select("owner", "repo", F.explode("found.value").alias("value"))
    once = each.groupBy("value", "owner", "repo").agg(F.count("*").alias("n"))
    owners = once.groupBy("value", "owner").agg(F.count("*").alias("repos"), F.sum("n").alias("n"))
    return owners.groupBy("value").agg(
        F.count("*").alias("n_owners"), F.sum("repos").alias("n_repos"), F.sum("n").alias("n_rows"), F.max("n").alias("top_rows")
    )


def widely_copied(found: DataFrame, plan: Ownership) -> Column:
    """Whether a value of ownership() is an example: many owners and many repositories, as
    the corpus goes, and not the matter of one owner."""
    names = found.groupBy("owner", "repo").agg(F.lit(1).alias("one"))
    owners = names.select("owner").distinct().agg(F.count("*")).scalar()
    repos = names.agg(F.count("*")).scalar()
    many = [F.col(n) > F.greatest(F.lit(plan.few), total * plan.share) for n, total in (("n_owners", owners), ("n_repos", repos))]
    return many[0] & many[1] & (F.col("top_rows") < plan.most * F.col("n_rows"))


def scan(docs: DataFrame, owner: str = "source", repository: str = "lang", plan: Ownership = Ownership()) -> DataFrame:
    """One row for each document: counts and digest of the base spans, all spans, how many
    of them are owner-specific (live) or widely copied (examples), and the largest numbers
    of owners, repositories and rows among its values (null without any).

    A repository is the pair of owner and repository column."""
    cut = sinks.table_cut(docs.sparkSession)
    rows = cut(scanned(docs, owner, repository, plan), "scanned")  # no texts any more
    counts = ownership(rows).withColumn("copied", widely_copied(rows, plan))
    each = rows.where(F.size("found") > 0).select("row", "id", F.explode("found").alias("s"))
    each = each.withColumn("value", F.col("s.value")).join(counts, "value")
    live = ~F.col("copied")
    used = live | (F.col("s.kind") < len(BASE))
    span = F.struct(F.col("s.start").alias("start"), F.col("s.kind").alias("kind"), F.col("s.stop").alias("stop"))
    kept = each.groupBy("row").agg(
        F.first("id").alias("id"), F.collect_list(F.when(used, span)).alias("found"), F.sum(live.cast("bigint")).alias("n_live"), F.sum((~live).cast("bigint")).alias("n_example"),
        *(F.max(c).alias(f"most_{c[2:]}") for c in SPREAD),
    )
    # Rows without any value have empty lists.
    empty = rows.join(kept.select("row"), "row", "left_anti").select(
        "id", F.array().cast("array<struct<start:int,kind:int,stop:int>>").alias("found"), F.lit(0).cast("bigint").alias("n_live"), F.lit(0).cast("bigint").alias("n_example"),
        *(F.lit(None).cast("bigint").alias(f"most_{c[2:]}") for c in SPREAD),
    )
    out = kept.drop("row").unionByName(empty)
    base = F.filter("found", lambda s: s["kind"] < len(BASE))
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("bigint")
    return out.select(
        F.col("id").alias("doc_id"),
        *(count(k).alias(f"n_{name}") for k, name in enumerate(BASE)),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("found")).alias("spans"),
        "n_live",
        "n_example",
        *(f"most_{c[2:]}" for c in SPREAD),
    )
