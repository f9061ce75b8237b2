"""One registered query for each operator, on the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from stratline.llm import (
    bpe,
    decontaminate,
    line_dedup,
    near_dup,
    packing,
    pii,
    quality,
    repetition,
    secrets,
    toxicity,
    trie,
    warc,
    whitening,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
VOCABULARY = str(public_tokenizers.path("word_bpe_49k.json"))


def query(run):
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages"))


@query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


@query
def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@query
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), VOCABULARY)


@query
def op6_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dup.classes(table(spark, sf_dir, "documents"))
    return found.selectExpr("id as doc_id", "class_id")


@query
def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op8_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.judge(table(spark, sf_dir, "documents"))


@query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), VOCABULARY)


@query
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.deduplicate(table(spark, sf_dir, "documents"))


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query
def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


@query
def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


# CRC-32 of the decimal id, byte by byte and bit by bit.
_CRC = """xor(4294967295, list_reduce(
  list_prepend(4294967295, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda s: CAST(ord(s) AS BIGINT))),
  lambda acc, byte: list_reduce([xor(acc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda x, y: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))))"""

SQL["op12_trie"] = f"""WITH turns AS (
  SELECT conv_id AS c, turn, length(coalesce(text, '')) AS size,
    sha256(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS mark
  FROM conversations WHERE conv_id IS NOT NULL),
placed AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, mark) AS p FROM turns),
sizes AS (SELECT c, count(*) AS n FROM turns GROUP BY c),
convs AS (SELECT s.c, s.c - s.c % 100 AS base, {_CRC} % 6 AS h FROM sizes s),
taken AS (SELECT v.*, least(h, coalesce(b.n, 0)) AS m FROM convs v LEFT JOIN sizes b ON b.c = v.base),
rebuilt AS (
  SELECT v.c, p.p AS d, p.mark, p.size FROM taken v JOIN placed p ON p.c = v.base AND p.p <= v.h
  UNION ALL SELECT v.c, p.p - v.h + v.m, p.mark, p.size FROM taken v JOIN placed p ON p.c = v.c AND p.p > v.h),
keyed AS (SELECT c, d, size, md5(string_agg(mark, '') OVER (PARTITION BY c ORDER BY d)) AS key FROM rebuilt),
paths AS (
  SELECT c, d, size, key, coalesce(lag(key) OVER (PARTITION BY c ORDER BY d), '') AS up FROM keyed
  UNION ALL SELECT c, 0, 0, '', NULL FROM convs),
nodes AS (SELECT key, min(d) AS d, min(up) AS up, min(size) AS size, min(c) AS owner, count(*) AS n FROM paths GROUP BY key),
children AS (SELECT up AS key, count(*) AS n_children FROM nodes WHERE up IS NOT NULL GROUP BY up),
sums AS (
  SELECT a.key, sum((v.n - 1) * v.size) AS saved, count(*) FILTER (WHERE v.key NOT IN (SELECT key FROM children)) AS leaves
  FROM nodes v JOIN paths a ON a.c = v.owner AND a.d <= v.d GROUP BY a.key),
ends AS (
  SELECT key, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS digest
  FROM (SELECT c, max_by(key, d) AS key FROM paths GROUP BY c) GROUP BY key)
SELECT v.owner AS conv_id, CAST(v.d AS BIGINT) AS depth, u.owner AS parent_conv_id, CAST(v.n AS BIGINT) AS n_convs,
  CAST(coalesce(n_children, 0) AS BIGINT) AS n_children, CAST(leaves AS BIGINT) AS n_leaves,
  CAST(saved AS BIGINT) AS saved_tokens, coalesce(digest, sha256('')) AS ends_sha256
FROM nodes v LEFT JOIN nodes u ON u.key = v.up LEFT JOIN children k ON k.key = v.key
JOIN sums s ON s.key = v.key LEFT JOIN ends e ON e.key = v.key"""
