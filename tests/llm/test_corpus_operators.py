"""Archives, classifiers, near duplicates, decontamination, packing, line dedup, pipeline."""

import base64
import gzip
import hashlib
import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stratline.llm import bpe, decontaminate, labelled, line_dedup, near_dup, packing, quality, queries, texts, toxicity, warc

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, id string, label string, key string"


def docs_frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", "y", "z") for i, t in rows], DOCS)


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 8))) for _ in range(n))


# --- archives


PAGES = [(1, "http://a", "same"), (2, "http://b", "same"), (3, None, None), (4, "http://c\r\nX: y", ""), (None, None, "same"), (5, "u", "é" * 9000)]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*r, "clash") for r in PAGES], "page_id bigint, url string, html string, payload string")


def test_archive_round_trip(spark, pages):
    rows = warc.archive(pages).collect()
    first = {"same": 1, "": 3, "é" * 9000: 5}
    expected = []
    for page, _, html in PAGES:
        body = html or ""
        again = first[body] != page
        sha = base64.b32encode(hashlib.sha1(body.encode()).digest()).decode()
        expected.append((page, len(body.encode()), sha, "revisit" if again else "response", first[body] if again else None))
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert {r.page_id: r.target_uri for r in rows}[4] == "http://c X: y"


def test_archive_filters_and_payloads(spark, pages, tmp_path):
    folder = str(tmp_path / "w")
    warc.register(spark)
    warc.records(pages, min_revisit_bytes=1).write.format("warc").mode("append").save(folder)
    read = spark.read.format("warc").load(folder)
    assert read.where("record_type = 'revisit'").count() == 2
    row = read.where("page_id = 5").collect()[0]
    assert bytes(row.payload).decode() == "é" * 9000
    bare = spark.read.format("warc").option("payload", "false").load(folder).where("page_id in (4, 5)").collect()
    assert sorted((r.page_id, r.payload_bytes, r.payload) for r in bare) == [(4, 0, None), (5, 18_000, None)]


def test_archives_of_others(spark, tmp_path):
    """Members without a length, and archives without compression."""
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\nhello"
    record = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: u\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(body), body)
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\n"
    pack = lambda x: (c := zlib.compressobj(9, zlib.DEFLATED, 31)).compress(x) + c.flush()
    (tmp_path / "a.warc.gz").write_bytes(pack(info) + pack(record) + pack(record))
    (tmp_path / "b.warc").write_bytes(info + record)
    warc.register(spark)
    read = spark.read.format("warc").load(str(tmp_path))
    assert sorted(r.record_type for r in read.collect()) == ["response"] * 3 + ["warcinfo"] * 2
    assert [bytes(r.payload) for r in read.where("record_type = 'response'").collect()] == [b"hello"] * 3


def test_empty_archive(spark, pages):
    assert warc.archive(pages.limit(0)).count() == 0


# --- classifiers


def test_held_out_rows_are_never_drawn(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = docs.join(labels.where(labelled.held_out(F.col("doc_id"), 5, 0)), "doc_id").select("text")
    drawn = labelled.sample(docs, labels.where(labelled.held_out(F.col("doc_id"), 5, 0)), "toxic", 5, 0, 100)
    assert rows.count() > 0 and drawn.count() == 0


@pytest.fixture(scope="module")
def marked(spark):
    """Toxic documents hold one bad sentence; bad quality is shouting."""
    rng = random.Random(4)
    common = [words(rng, 1) for _ in range(400)]
    rows, labels = [], []
    for k in range(900):
        said = [" ".join(rng.choices(common, k=8)).capitalize() + "." for _ in range(rng.randint(1, 12))]
        toxic, good = int(k % 4 == 0), int(k % 3 != 0)
        if toxic:
            said.insert(rng.randint(0, len(said)), rng.choice(["You utter grimbag today.", "What a snorlaff this is.", f"Some fribl{words(rng, 1)} here."]))
        text = " ".join(said)
        rows.append((k, text if good else text.upper().replace(" ", "!! ")))
        labels.append((k, good, toxic))
    rows += [(5000, None), (5001, ""), (None, "no id"), (5002, rows[1][1] * 400)]
    return docs_frame(spark, rows), spark.createDataFrame(labels + labels[:20], "doc_id bigint, quality int, toxic int")


@pytest.mark.parametrize("module, label", [(toxicity, "toxic"), (quality, "quality")])
def test_held_out_accuracy(spark, marked, module, label):
    docs, labels = marked
    model = module.fit(docs, labels)
    rows = module.score(docs, model)
    found = rows.collect()
    assert len(found) == 904 and all(0 <= r.score <= 1 for r in found)
    assert all(r.predicted == int(r.score >= module.THRESHOLD) for r in found)
    truth = {r.doc_id: r[label] for r in labels.collect()}
    tests = [r for r in found if r.held_out and r.doc_id in truth]
    assert len(tests) > 100
    assert sum(r.predicted == truth[r.doc_id] for r in tests) / len(tests) > 0.97


def test_offending_sentences_are_found(spark, marked):
    docs, labels = marked
    model = toxicity.fit(docs, labels)
    said = [r.sentence for r in toxicity.offending(docs, model).collect()]
    bad = [s for s in said if any(x in s.lower() for x in ("grimbag", "snorlaff", "fribl"))]
    assert len(bad) > 180 and len(bad) / len(said) > 0.95
    text_of = {r.doc_id: r.text for r in docs.collect()}
    scored = [r for r in toxicity.score(docs, model).collect() if r.doc_id is not None and r.doc_id < 900 and r.n_offending]
    worst = [text_of[r.doc_id][r.worst_start : r.worst_end].lower() for r in scored]
    assert len(worst) > 180 and sum(any(x in s for x in ("grimbag", "snorlaff", "fribl")) for s in worst) / len(worst) > 0.95
    assert all(s in {x.lower() for x in said} for s in worst)
    left = toxicity.reject(docs, model)
    assert left.columns == docs.columns and 600 < left.count() < 720


@pytest.mark.parametrize("module", [toxicity, quality])
def test_no_labels_and_no_rows(spark, marked, module):
    docs, labels = marked
    model = module.fit(docs, labels.limit(0))
    assert module.score(docs.limit(5), model).count() == 5
    assert module.score(docs.limit(0), model).count() == 0


def test_appended_archives_are_read_together(spark, pages, tmp_path):
    folder = str(tmp_path / "w")
    warc.register(spark)
    rows = warc.records(pages, min_revisit_bytes=1)
    for part in ("page_id <= 2", "page_id > 2"):
        rows.where(part).write.format("warc").mode("append").save(folder)
    read = spark.read.format("warc").load(folder)
    assert sorted(r.page_id for r in read.collect()) == [1, 2, 3, 4, 5]
    rows.where("page_id = 5").write.format("warc").mode("overwrite").save(folder)
    assert [r.page_id for r in spark.read.format("warc").load(folder).collect()] == [5]


@pytest.mark.parametrize("size", [10, 20_000, 60_000])
@pytest.mark.parametrize("head", [b"HTTP/1.1 200 OK\r\nX: " + b"y" * 9000 + b"\r\n\r\n", b"HTTP/1.1 200 OK\r\n\r\n", b""])
def test_payload_bytes_without_payload(spark, tmp_path, size, head):
    """Archives of other writers, whose HTTP header does not tell the length."""
    block = head + b"z" * size
    start = b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: %d\r\n\r\n" % len(block)
    for name, pack in (("a.warc", bytes), ("b.warc.gz", gzip.compress)):
        (tmp_path / name).write_bytes(pack(start + block + b"\r\n\r\n"))
    warc.register(spark)
    for payload in ("true", "false"):
        rows = spark.read.format("warc").option("payload", payload).load(str(tmp_path)).collect()
        assert [r.payload_bytes for r in rows] == [size, size]


# --- near duplicates


def classes_by_force(rows, threshold=0.8):
    sets, parent = {}, {}
    for i, text in rows:
        w = (text or "").split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or {tuple(w)}
        parent[i] = i

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(sets, 2):
        if len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {i: root(i) for i in sets}


def test_classes_equal_brute_force(spark):
    rng = random.Random(9)
    rows = []
    for group in range(14):
        base = words(rng, rng.randint(40, 300)).split()
        for copy in range(rng.choice([1, 1, 3, 12])):
            other = list(base)
            for _ in range(rng.randint(0, len(base) // 60)):
                other[rng.randrange(len(other))] = words(rng, 1)
            rows.append((len(rows), " ".join(other)))
    rows += [(900, None), (901, ""), (902, " \n"), (903, "a b"), (904, "a  b"), (905, rows[0][1])]
    docs = docs_frame(spark, rows)
    got = {r.id: r.class_id for r in near_dup.classes(docs).collect()}
    assert got == classes_by_force(rows)
    kept = near_dup.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(got.values()))


@pytest.mark.parametrize("turns", [1, 2])
def test_family_of_copies_of_copies_equals_brute_force(spark, turns):
    """Many members are near the limit or only like some of their kin; some are cut short."""
    rng = random.Random(21)
    family = [words(rng, 90).split()]
    while len(family) < 160:
        other = list(rng.choice(family))
        for _ in range(rng.randint(1, 3)):
            other[rng.randrange(len(other))] = words(rng, 1)
        if rng.random() < 0.15:
            other = other[: rng.randint(len(other) * 2 // 3, len(other))]
        if rng.random() < 0.1:
            other += words(rng, rng.randint(1, 12)).split()
        family.append(other)
    rows = [(k, " ".join(x)) for k, x in enumerate(family)]
    got = {r.id: r.class_id for r in near_dup.classes(docs_frame(spark, rows), near_dup.Darts(turns=turns)).collect()}
    expected = classes_by_force(rows)
    assert len(set(expected.values())) > 3
    assert got == expected


def test_chain_of_near_copies_is_one_class(spark):
    """Neighbours are alike, ends are not; and repeated rows and null ids take part."""
    rng = random.Random(3)
    base = words(rng, 200).split()
    rows = []
    for k in range(12):
        base = list(base)
        base[12 * k : 12 * k + 8] = words(rng, 8).split()
        rows.append((k, " ".join(base)))
    docs = docs_frame(spark, rows + [rows[3], (None, rows[5][1])])
    found = near_dup.classes(docs).collect()
    assert len(found) == 14 and {r.class_id for r in found} == {0}
    assert near_dup.keep_one(docs).count() == 1


def recorded(monkeypatch) -> dict[str, int]:
    """Rows of each table that near_dup writes, by name."""
    rows, table_cut = {}, near_dup.sinks.table_cut

    def counting(spark):
        cut = table_cut(spark)

        def write(df, name):
            table = cut(df, name)
            rows[name] = table.count()
            return table

        return write

    monkeypatch.setattr(near_dup.sinks, "table_cut", counting)
    return rows


def family(rng, members: int) -> list[tuple[int, str]]:
    """Copies of copies, near the limit of similarity."""
    found = [words(rng, 90).split()]
    while len(found) < members:
        other = list(rng.choice(found))
        for _ in range(rng.randint(1, 3)):
            other[rng.randrange(len(other))] = words(rng, 1)
        found.append(other)
    return [(k, " ".join(x)) for k, x in enumerate(found)]


@pytest.mark.parametrize("limit", [{}, {"members": 3}, {"differences": 0}])
def test_few_members_of_a_pivot_are_not_dealt_out_by_difference(spark, monkeypatch, limit):
    rows = family(random.Random(33), 70)
    written = recorded(monkeypatch)
    got = {r.id: r.class_id for r in near_dup.classes(docs_frame(spark, rows), near_dup.Darts(**limit)).collect()}
    assert got == classes_by_force(rows) and len(set(got.values())) > 3
    assert (written["turn-0-tokens"] == 0) == (limit == {})


def test_texts_that_differ_from_one_pivot_only_do_not_meet(spark, monkeypatch):
    """Pivots with linked members alone, or with one member, have nothing to compare further."""
    rng = random.Random(35)
    rows = []
    for _ in range(20):
        base = words(rng, 60).split()
        rows += [(len(rows), " ".join(base)), (len(rows) + 1, " ".join([*base[:-12], *words(rng, 12).split()]))]
    written = recorded(monkeypatch)
    got = {r.id: r.class_id for r in near_dup.classes(docs_frame(spark, rows), near_dup.Darts(members=0)).collect()}
    assert got == classes_by_force(rows) and len(set(got.values())) > 20
    assert written["differences-0"] and not written["turn-0-tokens"]


def test_documents_alone_in_their_class_stay_where_they_are(spark, monkeypatch):
    rng = random.Random(34)
    rows = [(k, words(rng, 50)) for k in range(40)] + [(None, words(rng, 50)), (None, None), (77, "")]
    docs = docs_frame(spark, [*rows, rows[5], (50, rows[5][1]), (51, rows[6][1]), rows[40]])
    written = recorded(monkeypatch)
    kept = sorted(((r.doc_id, r.text) for r in near_dup.keep_one(docs).collect()), key=str)
    assert kept == sorted([*rows[:41], rows[42]], key=str)
    assert written["shared"] == 3 + 2 + 2 + 2


def test_tasks_on_blocks_free_the_words_of_the_encoder():
    coder = bpe.tokenizer(bpe.vocabulary(queries.VOCABULARY))
    assert bpe.tokenizer(bpe.vocabulary(queries.VOCABULARY)) is coder
    list(texts.blocks(pa.array(["a b"])))
    assert bpe.tokenizer(bpe.vocabulary(queries.VOCABULARY)) is not coder


def test_signatures_agree_with_similarity():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 62, 300).astype(np.uint64)
    other = base.copy()
    other[:60] = rng.integers(0, 1 << 62, 60)
    key, row = np.concatenate([base, other]), np.repeat([0, 1], 300)
    plain = near_dup.signatures(key, np.ones(600), row, 2, 4000)
    assert (plain[0] == plain[1]).mean() == pytest.approx(240 / 360, abs=0.03)
    weight = np.concatenate([np.full(300, 3.0), np.full(300, 1.5)])
    heavy = near_dup.signatures(key, weight, row, 2, 4000)
    assert (heavy[0] == heavy[1]).mean() == pytest.approx(240 * 1.5 / (900 + 450 - 360), abs=0.03)


def test_one_step_of_python_in_a_task_that_keeps_documents(spark):
    """Two in a row take two workers for each task, which stay and hold memory."""
    docs = docs_frame(spark, [(k, f"a b c d e f g {k % 3}") for k in range(9)])
    plan = near_dup.keep_one(docs)._jdf.queryExecution().sparkPlan().treeString().splitlines()
    depth, steps = [len(line) - len(line.lstrip(" :+-")) for line in plan], 0
    for k, line in enumerate(plan):
        if "MapInArrow" in line:
            steps += 1
            below = itertools.takewhile(lambda j: depth[j] > depth[k], range(k + 1, len(plan)))
            assert not [plan[j] for j in below if "EvalPython" in plan[j]]
    assert steps


def test_stages_send_whole_texts_in_small_batches(spark):
    import corpus_pipeline

    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    for given, expected in (("10000", "1024"), ("0", "1024"), ("7", "7")):
        spark.conf.set(setting, given)
        for _, stage in corpus_pipeline.STAGES[-1:]:
            out = stage(spark, docs_frame(spark, [(k, f"w {k}") for k in range(30)]), SF)
            assert spark.conf.get(setting) == expected and out.count() == 30
    spark.conf.unset(setting)


def test_digests_hold_few_texts_and_words(monkeypatch):
    made = []

    class Column:
        def __init__(self, rows):
            self.rows = rows

        def __len__(self):
            return len(self.rows)

        def slice(self, at, rows):
            return Column(self.rows[at : at + rows])

        def to_pylist(self):
            made.append(len(self.rows))
            return self.rows

    some = [str(k) for k in range(1000)]
    given = texts.values(Column(some), rows=300)
    assert next(given) == "0" and made == [300]
    assert [*given] == some[1:] and max(made) <= 300

    monkeypatch.setattr(texts, "kept", {})
    content = bpe.vocabulary(queries.VOCABULARY)
    few = bpe.tokenizer(content, cached_words=2)
    assert few.cached_words == 2 and bpe.tokenizer(content, cached_words=2) is few and len(texts.kept) == 1
    rng = random.Random(3)
    rows = [words(rng, 5) for _ in range(20)]
    assert [*few.encode_all(iter(rows), 10)] == [*bpe.Tokenizer(content).encode_all(rows)]


def test_no_near_duplicates_in_an_empty_table(spark):
    empty = docs_frame(spark, [(1, "x")]).limit(0)
    assert near_dup.classes(empty).count() == 0 and near_dup.keep_one(empty).count() == 0


# --- decontamination


def test_leaks_are_found(spark):
    rng = random.Random(6)
    filler = [words(rng, 1) for _ in range(60)]
    items = [(k, " ".join(rng.choices(filler, k=10)) + " " + words(rng, rng.randint(12, 60))) for k in range(30)]
    rows, planted = [], set()
    for k in range(200):
        text = " ".join(rng.choices(filler, k=rng.randint(20, 300))) + " " + words(rng, 40)
        if k % 5 == 0:
            item = rng.randrange(30)
            said = items[item][1].split()
            if k % 10 == 0:  # a paraphrase: a word in eight is another one
                said = [words(rng, 1) if j % 8 == 3 else w for j, w in enumerate(said)]
            at = rng.randint(0, len(text) // 2)
            text = text[:at] + " " + " ".join(said).upper() + ". " + text[at:]
            planted.add((k, item))
        rows.append((k, text))
    rows += [(500, None), (501, "")]
    docs = docs_frame(spark, rows)
    bench = spark.createDataFrame(items + [(77, None), (78, "too short")], "item_id bigint, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, bench).collect()}
    assert len(found & planted) >= 0.95 * len(planted)
    assert not found - planted
    left = decontaminate.clean(docs, bench)
    assert left.columns == docs.columns and left.count() == 202 - len({d for d, _ in found})
    assert decontaminate.leaks(docs.limit(0), bench).count() == 0
    assert decontaminate.leaks(docs, bench.limit(0)).count() == 0


def test_short_copies_among_rarer_benchmark_words(spark):
    rng = random.Random(16)
    usual = [words(rng, 1) for _ in range(40)]
    short = [(k, " ".join(rng.sample(usual, k=12))) for k in range(6)]
    rare = [words(rng, 40) for _ in range(30)]
    rows = [(k, " ".join(rng.choices(usual, k=15)) + " " + words(rng, 100)) for k in range(200)]
    for k, said in short:
        noise = [rng.choice(text.split()) for text in rng.choices(rare, k=120)]
        rows.append((300 + k, " ".join([*noise[:60], said, *noise[60:]])))
    bench = spark.createDataFrame(short + [(50 + k, t) for k, t in enumerate(rare)], "item_id bigint, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs_frame(spark, rows), bench).collect()}
    assert {(300 + k, k) for k, _ in short} <= found


def test_scripts_without_spaces_and_short_items(spark):
    rng = random.Random(19)
    han = lambda n: "".join(chr(rng.randint(0x4E00, 0x5200)) for _ in range(n))
    thai = lambda n: "".join(chr(rng.randint(0x0E01, 0x0E2E)) for _ in range(n))
    items = {1: han(70), 2: thai(60), 3: f"「{han(12)}」、{han(15)}。", 4: han(5), 5: "Short “Zebra” item", 6: "café — naïve “crème” brûlée, über große straße señor"}
    rows = [(k, " ".join(rng.choice((han, thai))(rng.randint(5, 80)) + "。" for _ in range(4)) + " " + words(rng, 40)) for k in range(100)]
    for k, said in items.items():
        rows.append((200 + k, f"{han(60)}{said}{han(40)} {words(rng, 30)}" if k < 5 else f"{words(rng, 30)}“{said}”—{words(rng, 30)}"))
    rows += [(300, "short item zebra"), (301, "a shorter zebra item"), (302, "Short: zebra; ITEM!")]
    bench = spark.createDataFrame([*items.items(), (7, "。、“”"), (8, "")], "item_id bigint, text string")
    docs = docs_frame(spark, rows)
    found = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, bench).collect()}
    assert found == {(200 + k, k) for k in items} | {(302, 5)}
    alone = decontaminate.leaks(docs, bench.where("item_id in (4, 5)")).collect()
    assert {(r.doc_id, r.item_id) for r in alone} == {(204, 4), (205, 5), (302, 5)}


def test_common_subsequence():
    rng = random.Random(1)
    for _ in range(50):
        a, b = (rng.choices(range(6), k=rng.randint(0, 30)) for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, j in itertools.product(range(len(a)), range(len(b))):
            table[i + 1][j + 1] = table[i][j] + 1 if a[i] == b[j] else max(table[i][j + 1], table[i + 1][j])
        assert decontaminate.common(a, b) == table[-1][-1]


# --- packing


def test_packing_is_lossless(spark):
    rng = random.Random(8)
    rows = [(k, words(rng, rng.randint(0, 900))) for k in range(60)] + [(70, None), (None, "null id"), (71, "")]
    plan = packing.Packing(length=256, block_tokens=20_000)
    out = packing.pack(docs_frame(spark, rows).repartition(3), queries.VOCABULARY, plan).collect()
    tokenizers = pytest.importorskip("tokenizers")
    coder = tokenizers.Tokenizer.from_file(queries.VOCABULARY)
    found = {}
    for r in out:
        row = packing.matrix(r.folder, r.matrix)[r.row]
        assert len(row) == 256 and r.cu_seqlens[-1] == r.n_tokens <= 256
        where = packing.positions(r.cu_seqlens)
        assert [k for k, p in enumerate(where) if p == 0] == r.position_resets
        for k, (doc, piece) in enumerate(zip(r.doc_ids, r.pieces)):
            found[doc, piece] = row[r.cu_seqlens[k] : r.cu_seqlens[k + 1]].tolist()
    for doc, text in rows:
        joined = [x for k in sorted(p for d, p in found if d == doc) for x in found[doc, k]]
        assert joined == coder.encode(text or "", add_special_tokens=False).ids + [plan.end_id]


def test_best_fit_decreasing_equals_a_plain_search():
    rng = random.Random(2)
    for _ in range(20):
        sizes = [rng.randint(1, 100) for _ in range(150)]
        left, expected = [], []
        for k in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
            fit = [room for room in left if room >= sizes[k]]
            if fit:
                left[left.index(min(fit))] -= sizes[k]
            else:
                left.append(100 - sizes[k])
        rows = packing.best_fit(sizes, 100)
        assert sorted(100 - sum(sizes[k] for k in row) for row in rows) == sorted(left)
        assert sorted(k for row in rows for k in row) == list(range(150))
    assert packing.best_fit([], 10) == expected


def test_packing_an_empty_table(spark):
    assert packing.pack(docs_frame(spark, [(1, "x")]).limit(0), queries.VOCABULARY).count() == 0


# --- line dedup


def test_repeated_passages_go_and_the_rest_stays(spark):
    rng = random.Random(7)
    shared = "\n".join(words(rng, 13) for _ in range(5))
    single = words(rng, 60)
    licence = "All rights reserved under the usual license of this place."
    rows = []
    for k in range(40):
        own = [words(rng, rng.randint(3, 15)) for _ in range(8)]
        if k % 4 == 0:
            own.insert(rng.randint(1, 7), shared)
        if k % 5 == 0:
            own.insert(rng.randint(1, 7), single)
        rows.append((k, "\n".join([*own, licence])))
    rows += [(90, None), (91, ""), rows[8], (None, rows[1][1])]
    docs = docs_frame(spark, rows)
    out = line_dedup.deduplicate(docs)
    assert out.columns == docs.columns
    got = [(r.doc_id, r.text, r.n_chars) for r in out.collect()]
    assert len(got) == len(rows)
    texts_of = dict((i, t) for i, t, _ in got)
    assert texts_of[0] == rows[0][1]
    for k, text in rows[1:40]:
        left = "\n".join(x for x in text.split("\n") if x not in shared.split("\n") and x != single)
        assert texts_of[k] == left
    assert texts_of[90] is None and texts_of[91] == "" and texts_of[None] == ""
    assert all(n == len(t) for _, t, n in got if t is not None)
    assert line_dedup.deduplicate(docs.limit(0)).count() == 0


def test_blank_lines_part_no_passage(spark):
    rng = random.Random(17)
    shared = "\n\n".join([words(rng, 30), words(rng, 30) + "\n \t", words(rng, 30), words(rng, 30)])
    own = [(words(rng, 12), words(rng, 12)) for _ in range(4)]
    docs = docs_frame(spark, [(k, f"{a}\n\n{shared}\n\n{b}") for k, (a, b) in enumerate(own)])
    got = {r.doc_id: r.text for r in line_dedup.deduplicate(docs).collect()}
    assert shared in got[0]
    for k, (a, b) in enumerate(own[1:], 1):
        assert got[k].split() == [*a.split(), *b.split()]


def test_short_lines_at_the_edges_of_a_passage(spark):
    """Passages with short lines at an edge or throughout, always between short lines."""
    rng = random.Random(18)
    shapes = [(45, 8), (8, 45), (9,) * 6, (6, 25, 7), (4,) * 20, (9,) * 4]
    rows, wanted, k = [], {}, 0
    for shape in shapes * 8:
        shared = [words(rng, n) for n in shape]
        for copy in range(3):
            around = [words(rng, rng.randint(2, 6)) for _ in range(4)]
            rows.append((k, "\n".join([*around[:2], *shared, *around[2:]])))
            wanted[k] = "\n".join(around if copy else [*around[:2], *shared, *around[2:]])
            k += 1
    got = {r.doc_id: r.text for r in line_dedup.deduplicate(docs_frame(spark, rows)).collect()}
    assert got == wanted


def test_chunks_are_shift_resistant():
    rng = random.Random(1)
    lines = [words(rng, rng.randint(1, 14)) for _ in range(300)]
    cut = lambda some: set(line_dedup.chunk(next(texts.blocks(__import__("pyarrow").array(["\n".join(some)]))), line_dedup.Chunks())["hash"])
    before, after = cut(lines), cut(lines[:150] + ["a new line"] + lines[150:])
    assert len(before - after) <= 2


# --- pipeline


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "near_dedup", "decontamination", "bpe"]
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 100
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == counts[-1]


def test_pipeline_equals_brute_force(spark, tmp_path):
    """Nulls, repeated rows and columns with clashing names, against plain Python."""
    import corpus_pipeline

    tokenizers = pytest.importorskip("tokenizers")
    rng = random.Random(17)
    exam = [words(rng, 25) for _ in range(4)]
    texts_ = [words(rng, rng.randint(30, 45)) for _ in range(14)]
    near = texts_[0].split()
    near[-1] = "changed"
    leaked = f"{words(rng, 10)} {exam[2]} {words(rng, 10)}"
    rows = [(10 + k, t) for k, t in enumerate(texts_)]
    rows += [(40, " ".join(near)), (41, leaked), (42, None), (43, ""), (44, "few words"), (44, "few words"), (None, words(rng, 33))]
    folder = str(tmp_path)
    columns = "doc_id bigint, text string, lang string, source string, n_chars bigint, id string, label int, whole bigint, band string"
    docs = spark.createDataFrame([(i, t, "en", "s", None, "x", 1, 2, "b") for i, t in rows], columns)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(enumerate(exam)), "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    groups = classes_by_force([(k, t) for k, (_, t) in enumerate(rows)])
    stay = [rows[k] for k in sorted(set(groups.values())) if not any(e in (rows[k][1] or "") for e in exam)]
    library = tokenizers.Tokenizer.from_file(queries.VOCABULARY)
    library.no_truncation()
    library.no_padding()
    expected = []
    for i, t in stay:
        ids = library.encode(t or "", add_special_tokens=False).ids
        expected.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()))
    got = [(r.doc_id, r.n_tokens, r.ids_sha256) for r in corpus_pipeline.run(spark, folder).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_pipeline_of_an_empty_table(spark, tmp_path):
    import corpus_pipeline

    docs_frame(spark, [(1, "x")]).limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "some words")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_windows_that_cannot_hold_a_passage_are_not_compared(monkeypatch):
    item = " ".join(f"w{k}" for k in range(30))
    plan = decontaminate.Search()
    index = decontaminate.pieces_of([(1, item)], plan)
    index.idf = np.ones(len(index.terms))
    index.basis = np.eye(len(index.terms), dtype=np.float32)
    index.latent = np.stack([index.basis[p].sum(0) for p in index.pieces])
    index.latent /= np.linalg.norm(index.latent, axis=1, keepdims=True)
    # Three words of the item again and again, in each stride as often as the item has them.
    few = " ".join(" ".join([*(f"w{k}" for k in range(s, s + 4)), *(f"x{s}y{k}" for k in range(12))]) for s in (0, 1, 0, 1, 0, 1))
    asked, plain = [], decontaminate.common_with
    monkeypatch.setattr(decontaminate, "common_with", lambda *x: asked.append(x) or plain(*x))
    (block,) = texts.blocks(pa.array([few, "a b c " + item + " d e f"]))
    found = decontaminate.matches(block, index, plan)
    assert [(row, piece, share) for row, piece, _, share, *_ in found] == [(1, 0, 1.0)]
    assert asked and all(len(set(here)) >= 17 for _, size, here in asked if size == 30)
