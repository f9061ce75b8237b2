"""Token kernel, repetition rules, secrets and token digests against plain Python."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from stratline.llm import bpe, queries, repetition, secrets, texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_words string, row string"
LONG = " ".join(f"w{k % 977}x{k}" for k in range(30_000))
CASES = [
    (1, None, "en", "a", "x", "y"),
    (2, "", "en", "a", "x", "y"),
    (3, " \t\n ", "en", "a", "x", "y"),
    (None, "no id here", None, None, None, None),
    (4, "one two three one two three one two three", "en", "a", "x", "y"),
    (4, "one two three one two three one two three", "en", "a", "x", "y"),
    (5, "line of words\nline of words\n\n \nline  of words\r\nx", "en", "a", "x", "y"),
    (6, "é ß Ünï code 日本語 #*$%&|<>", "en", "a", "x", "y"),
    (7, LONG, "en", "a", "x", "y"),
    (8, " ".join(["same"] * 80), "en", "a", "x", "y"),
]


def frame(spark, rows=CASES):
    return spark.createDataFrame(rows, SCHEMA)


def test_blocks_keep_whole_texts():
    column = pa.array(["ab", None, "", "c" * 50, "d"]).fill_null("")
    found = list(texts.blocks(column, 10))
    assert [(b.first_row, b.rows) for b in found] == [(0, 3), (3, 1), (4, 1)]
    assert bytes(found[1].data) == b"c" * 50


def test_span_hashes_do_not_depend_on_place():
    block = next(texts.blocks(pa.array(["the cat", "a cat the", ""])))
    words = block.runs(texts.SPACE)
    h = block.hashes().spans(words.start, words.end)
    assert h[0] == h[4] and h[1] == h[3] and len(set(h)) == 3
    assert list(words.counts) == [2, 3, 0]


def test_vocabulary_finds_exactly():
    h = texts.mix(np.arange(1, 5000, dtype=np.uint64))
    known = texts.Vocabulary(h[::2])
    assert (known.find(h[::2]) == np.arange(len(h[::2]))).all()
    assert (known.find(h[1::2]) == -1).all()
    assert len(texts.Vocabulary(h[:0]).find(h)) == len(h)


def counted(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = Counter(zip(words, words[1:], words[2:]))
    inside = {j for k, g in enumerate(zip(words, words[1:], words[2:])) if grams[g] > 1 for j in (k, k + 1, k + 2)}
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(inside)


def test_base_counts_equal_plain_counts(spark):
    rows = repetition.judge(frame(spark)).collect()
    assert len(rows) == len(CASES)
    key = lambda r: tuple(str(x) for x in r)
    got = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows]
    assert sorted(got, key=key) == sorted(((c[0], *counted(c[1])) for c in CASES), key=key)
    for r in rows:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert {r.doc_id: r.kept for r in rows}[7]


def test_coverage_counts_characters_in_repeated_grams():
    rng = random.Random(5)
    text = " ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(400))
    words = WORD.findall(text)
    worst = 0
    for n in range(5, 11):
        grams = Counter(tuple(words[k : k + n]) for k in range(len(words) - n + 1))
        inside = {j for k in range(len(words) - n + 1) if grams[tuple(words[k : k + n])] > 1 for j in range(k, k + n)}
        worst = max(worst, sum(len(words[j]) for j in inside) / sum(map(len, words)))
    found = repetition.measure(next(texts.blocks(pa.array([text]))), repetition.Limits())
    assert found["covered_share"][0] == pytest.approx(worst)


def plain_secrets(text):
    assign = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    found = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found)


SECRETS = [
    (1, "token = secret: abcdefghijklmnop", "en", "a"),
    (2, "😀 PassWord:'abc123def456' x token=secret=abcdefghijklmnop", "en", "a"),
    (3, "AKIAAKIAAKIAAKIA1 AKIA12345678901234 deadbeefdeadbeef deadbeefdeadbee", "en", "b"),
    (4, None, None, None),
    (5, "api_key=abcdefabcdefabcdef0 apikey \"= ghp_" + "a1B2" * 10, "en", "b"),
    (6, "ghp_" + "Zz9Yy8Xx7W" * 4, "en", "c"),
    (7, "ghp_" + "Qq9Yy8Xx7W" * 4, "en", "c"),
    (8, "ghp_" + "Qq9Yy8Xx7W" * 4, "en", "d"),
    (9, "ghp_" + "Qq9Yy8Xx7W" * 4, "de", "e"),
    (9, "ghp_" + "Qq9Yy8Xx7W" * 4, "de", "e"),
    (10, "", "en", "a"),
]


def test_secret_spans_and_ownership(spark):
    docs = spark.createDataFrame(SECRETS, "doc_id bigint, text string, lang string, source string")
    rows = secrets.scan(docs).collect()
    assert len(rows) == len(SECRETS)
    by_id = {r.doc_id: r for r in rows}
    for doc, text, *_ in SECRETS:
        base = plain_secrets(text or "")
        said = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in base)
        r = by_id[doc]
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest(), doc
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == j for _, k, _ in base) for j in range(3))
        assert set(said.split(",")) - {""} <= set(r.spans.split(","))
    # One owner: live. Three owners (c, d, e): a copied example, not reported as a span.
    assert "vendor:0:44" in by_id[6].spans and by_id[6].n_live > 0
    assert "vendor" not in by_id[7].spans and "vendor" not in by_id[9].spans


def brute_ownership(rows, plan):
    """value -> whether it is widely copied, from (owner, repository, values) rows."""
    seen, owners, repos = {}, {o for o, _, _ in rows}, {(o, r) for o, r, _ in rows}
    for o, r, values in rows:
        for v in values:
            seen.setdefault(v, []).append((o, r))
    few_owners, few_repos = (max(plan.few, plan.share * len(x)) for x in (owners, repos))
    out = {}
    for v, at in seen.items():
        top = max(sum(o == own for o, _ in at) for own in {o for o, _ in at})
        out[v] = len({o for o, _ in at}) > few_owners and len(set(at)) > few_repos and top < plan.most * len(at)
    return out


@pytest.mark.parametrize("share", [1e-4, 0.4])
def test_ownership_equals_brute_force(spark, share):
    rng = random.Random(3)
    values = ["ghp_" + "".join(rng.choices("abcXYZ0189", k=36)) for _ in range(12)]
    rows = []
    for k in range(400):
        v = min(int(rng.expovariate(0.35)), 11)
        # The first value is nearly always with one owner, though some others have it too.
        owner = "o0" if v == 0 and rng.random() < 0.97 else f"o{rng.randint(0, 2 + v)}"
        rows.append((k, values[v], f"r{rng.randint(0, 2)}", owner))
    plan = secrets.Ownership(share=share)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    copied = brute_ownership([(o, r, [v]) for _, v, r, o in rows], plan)
    assert set(copied.values()) == {True, False} and not copied[values[0]]
    for r in secrets.scan(docs, plan=plan).collect():
        assert ("vendor" in r.spans) == (not copied[rows[r.doc_id][1]])
        assert r.most_owners == len({o for _, v, _, o in rows if v == rows[r.doc_id][1]})


def test_secrets_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, lang string, source string")
    assert secrets.scan(docs).count() == 0


tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def coders():
    return bpe.Tokenizer(bpe.vocabulary(queries.VOCABULARY)), tokenizers.Tokenizer.from_file(queries.VOCABULARY)


PARTS = [
    "a", "e", "th", "in", "g", " ", "é", "Σ", "ΑΣ", "İ", "日", "́", "1", "²", "Ⅷ", "!!", "...", "'s", "'LL", "\n", "\x1c",
    "　", "<|endoftext|>", "<|startoftext|>", "<|", "aaaa", "\x00", "🙂", "ing", "tion", "ﬁ", "א",
]


def test_encoding_equals_the_library(coders):
    own, other = coders
    rng = random.Random(3)
    some = ["".join(rng.choices(PARTS, k=rng.randint(0, 40))) for _ in range(1500)]
    some += ["".join(rng.choices("aeinstrhlo", k=rng.randint(60, 900))) for _ in range(60)]
    some += ["a" * 5000, "ab" * 3000, "haha" * 2000, "!" * 3000, "", "   "]
    for text, ids in zip(some, own.encode_all(some, 5000)):
        expected = other.encode(text, add_special_tokens=False).ids
        assert ids == expected, text[:80]
        assert "".join(own.decode(ids)) == other.decode(expected, skip_special_tokens=False)


def test_pending_tokens_stay_bounded(coders):
    own, _ = coders
    encoder = bpe.Encoder(own.merges)
    rng, most = random.Random(1), 0
    for symbol in rng.choices("aeinstrhlo", k=20_000):
        list(encoder.feed(symbol))
        most = max(most, len(encoder.symbols))
    assert most <= 2 * encoder.flush


def test_lanes_equal_the_single_transducer(coders):
    own, _ = coders
    rng = random.Random(2)
    words = ["".join(rng.choices("thesandingor", k=rng.randint(1, 40))) for _ in range(400)]
    single = bpe.Encoder(own.merges)
    for word, ids in zip(words, own.lanes.encode([w.encode() for w in words])):
        assert ids == [*single.feed(word[:-1]), *single.finish(word[-1])]


def test_digests_of_odd_rows(spark, coders):
    _, other = coders
    rows = bpe.digests(frame(spark, CASES[:8]), queries.VOCABULARY).collect()
    expected = []
    for doc, text, *_ in CASES[:8]:
        ids = other.encode(text or "", add_special_tokens=False).ids
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        expected.append((doc, len(ids), sha(" ".join(map(str, ids))), sha(other.decode(ids, skip_special_tokens=False))))
    assert sorted(map(tuple, rows), key=str) == sorted(expected, key=str)


def test_words_are_numbered_once_in_arrays(coders):
    own, _ = coders
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdeéßж19'#") for _ in range(rng.randint(1, 9))) for _ in range(400)]
    gaps = [" ", "\n", "\x1c", "\x85", " ", "  ", "　", "<|endoftext|>"]
    some = ["", " ", "Σ" * 70, *("".join(rng.choice(words) + rng.choice(gaps) for _ in range(30)) for _ in range(60))]
    small = bpe.Tokenizer(bpe.vocabulary(queries.VOCABULARY), cached_words=40)  # both generations of the cache
    for text, ids in zip(some, small.arrays(some, 300)):
        assert ids.dtype == np.int32 and ids.tolist() == own.encode(text)
    alone = [own.merges.following(state, symbol) for state in ("", "th", "zz") for symbol in "aq"]
    states = ["", *sorted(own.merges.starts)]
    number = [states.index(s) for s in ("", "th", "zz") if s in states]
    moved = own.lanes.move(np.repeat(number, 2), np.tile(np.frombuffer(b"aq", np.uint8), len(number)))
    assert [states[k] for k in moved] == [a for a, s in zip(alone, np.repeat(["", "th", "zz"], 2)) if s in states]
