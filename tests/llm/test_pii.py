"""Personal data: base spans against plain Python, what the method adds by planted cases."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratline.llm import pii, queries
from stratline.models.trees import Ensemble, Plan, Tree

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, id bigint, kind string, found string"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def passes(kind, value):
    number = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 12 <= len(number) <= 19 and luhn(number)
    return kind != "phone" or 9 <= len(number) <= 15


def plain(text, patterns=PATTERNS):
    spans = []
    for k, (kind, pattern) in enumerate(patterns.items()):
        spans += [(m.start(), k, m.end(), kind) for m in re.finditer(pattern, text or "") if passes(kind, m.group())]
    return sorted(spans)


def digest(spans):
    return hashlib.sha256(",".join(f"{kind}:{a}:{b}" for a, _, b, kind in spans).encode()).hexdigest()


def frame(spark, texts):
    return spark.createDataFrame([(i, t, 5, "x", "y") for i, t in texts], DOCS)


def check_base(rows, texts, patterns=PATTERNS):
    by_id = dict(texts)
    for r in rows:
        spans = plain(by_id[r.doc_id], patterns)
        assert r.base_sha256 == digest(spans), by_id[r.doc_id][:300]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[1] == k for s in spans) for k in range(4)]
        assert {f"{s[3]}:{s[0]}:{s[2]}" for s in spans} <= set(r.spans.split(","))


def test_base_spans_equal_plain_python(spark):
    rng = random.Random(4)
    parts = ["a", "b@", "@", ".", "c.de", "-", "+", "1", "23", "456", "4111 1111 1111 1111", "(", ")", " ", "é", "😀", "\n", "_x@y.z", "255.", "256.", "0012.", "%", "a@b.c"]
    texts = [(k, "".join(rng.choices(parts, k=rng.randint(0, 40)))) for k in range(1500)]
    texts += [(2000, None), (2001, ""), (2002, "x@" * 5), (2003, "1.2.3.4.5.6.7.8.9"), (2004, "a@b.co_d@e.fr"), (2005, "+1 (555) 123-4567, +44 20 7946 0958 12345")]
    rows = pii.find(frame(spark, texts).repartition(6), pii.Boost(trees=2)).collect()
    assert len(rows) == len(texts)
    check_base(rows, texts)


def test_long_runs(spark):
    texts = [(1, "a" * 200_000), (2, "1" * 200_000), (3, "1 " * 100_000), (4, ("me" * 100_000) + "@x.de"), (5, "1." * 100_000), (6, "+1 " * 50_000), (7, "a@" * 50_000)]
    # The base pattern itself would take hours on these in Python; runs start nowhere else here.
    quick = PATTERNS | {"email": r"(?<![A-Za-z0-9._%+-])" + PATTERNS["email"], "ip": r"(?<![0-9])" + PATTERNS["ip"]}
    check_base(pii.find(frame(spark, texts), pii.Boost(trees=1)).collect(), texts, quick)


def test_repeated_null_and_empty(spark):
    texts = [(1, "m@x.de"), (1, "m@x.de"), (None, "m@x.de"), (2, None)]
    rows = pii.find(frame(spark, texts)).collect()
    assert sorted((r.doc_id or 0, r.n_email) for r in rows) == [(0, 1), (1, 1), (1, 1), (2, 0)]
    assert pii.find(frame(spark, [])).count() == 0


def phone_texts(n, plus=0.8):
    rng, texts, planted = random.Random(9), [], {}
    for k in range(n):
        number = f"({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"
        words = [" ".join(rng.choices(["ta", "re", "on", "wi"], k=6)) for _ in range(2)]
        if k % 3 == 0:
            texts.append((k, f"{words[0]} sum {rng.randint(10**7, 10**9)} {words[1]} order {rng.randint(10**6, 10**9)}"))
        elif rng.random() < plus:
            texts.append((k, f"{words[0]} phone +1 {number} {words[1]}"))
        else:
            planted[k] = len(words[0]) + 7
            texts.append((k, f"{words[0]} phone {number} {words[1]}"))
    return texts, planted


def test_method_adds_what_looks_like_the_base(spark):
    texts, planted = phone_texts(1200)
    rows = {r.doc_id: r for r in pii.find(frame(spark, texts)).collect()}
    check_base(rows.values(), texts)
    caught = sum(f"phone_like:{at}" in rows[k].spans for k, at in planted.items())
    assert caught >= 0.9 * len(planted)
    assert not any("like" in r.spans for k, r in rows.items() if k % 3 == 0)


def test_no_added_spans_without_thresholds(spark, monkeypatch):
    texts, _ = phone_texts(300)
    monkeypatch.setattr(pii, "thresholds", lambda *args: {})
    assert not any("like" in r.spans for r in pii.find(frame(spark, texts)).collect())


def test_margin_equals_walk_of_trees(spark):
    rng = np.random.default_rng(2)
    trees = []
    for _ in range(5):
        t = Tree.stump(3)
        for node in range(7):
            if node == 0 or t.feature[(node - 1) // 2] >= 0:
                t.feature[node], t.bin[node] = rng.integers(-1 if node else 0, 4), rng.integers(0, 6)
        t.value[:] = rng.normal(size=15)
        trees.append(t)
    x = rng.integers(0, 8, (200, 4))
    df = spark.createDataFrame([(int(k), [int(v) for v in row]) for k, row in enumerate(x)], "k int, x array<int>")
    got = {r.k: r.m for r in df.select("k", pii.margin(F.col("x"), 0.5, trees, 3).alias("m")).collect()}
    expected = 0.5 + Ensemble(Plan(depth=3), 0.0, trees).margins(x)
    assert [got[k] for k in range(200)] == pytest.approx(list(expected))


def test_query(spark):
    rows = queries.QUERIES["op11_pii"](spark, SF).collect()
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert len(rows) == len(texts)
    check_base(rows, texts)
