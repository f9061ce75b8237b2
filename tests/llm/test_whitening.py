"""Whitening against plain whole-number arithmetic and a library eigensolver."""

import math
from fractions import Fraction

import numpy as np
import pytest

from stratline.llm import queries, whitening

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id bigint, embedding array<float>, n bigint, component string"


def expected(rows, components=8):
    """id -> (deviation, scores), and the shares, in exact numbers up to the eigenvectors."""
    x = [[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for _, v in rows]
    n, dim = len(x), len(x[0])
    s = [sum(r[j] for r in x) for j in range(dim)]
    v = np.array([[float(Fraction(sum((n * r[i] - s[i]) * (n * r[j] - s[j]) for r in x), n**3)) for j in range(dim)] for i in range(dim)])
    e, q = np.linalg.eigh(v)
    e, q = e[::-1], q[:, ::-1]
    z = (np.array(x) - np.array([float(Fraction(t, n)) for t in s])) @ q[:, :components] / np.sqrt(e[:components])
    dev = [sum((n * a - t) ** 2 for a, t in zip(r, s)) for r in x]
    return dev, z, e[:components] / np.trace(v)


def test_equals_plain_arithmetic(spark):
    rng = np.random.default_rng(3)
    rows = [(k, [float(c) for c in rng.normal(0, 0.2 + np.arange(12) / 5)]) for k in range(200)]
    odd = [(900, None), (901, []), (902, [float("nan")] * 12), (903, [None] + [0.5] * 11), (904, [float("inf")] * 12), (905, [1.0] * 11)]
    df = spark.createDataFrame([(i, v, 7, "x") for i, v in rows + odd], SCHEMA)
    got = whitening.whiten(df.repartition(5)).collect()
    dev, z, share = expected(rows)
    assert len(got) == 200 * 8 and {r.n for r in got} == {200}
    for r in got:
        assert r.deviation == dev[r.vec_id]
        assert abs(abs(r.whitened) - abs(z[r.vec_id, r.component - 1])) < 1e-8
        assert abs(r.explained / share[r.component - 1] - 1) < 1e-9
        assert r.identity_error < 1e-9
    # One sign for all rows of a component.
    for k in range(8):
        signs = {round(r.whitened / z[r.vec_id, k]) for r in got if r.component == k + 1 and abs(z[r.vec_id, k]) > 0.1}
        assert signs in ({1}, {-1})


def test_defined_results(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert whitening.whiten(empty).count() == 0
    same = spark.createDataFrame([(1, [0.5, 0.25], 0, ""), (1, [0.5, 0.25], 0, ""), (None, [0.5, 0.25], 0, "")], SCHEMA)
    got = whitening.whiten(same).collect()
    assert len(got) == 6
    assert {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in got} == {(3, 0, None, None, None)}
    line = spark.createDataFrame([(k, [float(k), 2.0 * k, 1e30], 0, "") for k in range(5)], SCHEMA)
    got = {(r.vec_id, r.component): r for r in whitening.whiten(line).collect()}
    assert got[0, 2].whitened is None and abs(got[0, 1].whitened) == pytest.approx(math.sqrt(2))
    assert got[0, 1].explained == pytest.approx(1)
    far = spark.createDataFrame([(1, [3e9], 0, ""), (2, [-3e9], 0, "")], SCHEMA)
    assert {r.deviation for r in whitening.whiten(far).collect()} == {None}


def test_products_are_exact():
    rng = np.random.default_rng(0)
    for top in (1 << 10, 1 << 30, 1 << 46):
        y = rng.integers(-top, top, (70, 3))
        plain = [[sum(int(a) * int(b) for a, b in zip(y[:, i], y[:, j])) for j in range(3)] for i in range(3)]
        assert whitening.products(y).tolist() == plain


@pytest.mark.parametrize("gap", [1e-4, 1e-8, 1e-12, 1e-16, 0.0])
def test_clusters(gap):
    rng = np.random.default_rng(1)
    q = np.linalg.qr(rng.normal(size=(20, 20)))[0].astype(whitening.WIDE)
    q = q @ (3 * np.eye(20, dtype=whitening.WIDE) - q.T @ q) / 2
    values = np.concatenate([np.arange(20, 10, -1), 5 + gap * np.arange(5), [1, 1, 0, 0, 0]]).astype(whitening.WIDE)
    a = q @ np.diag(values) @ q.T
    e, x = whitening.refined((a + a.T) / 2)
    assert np.abs(x.T @ x - np.eye(20)).max() < 1e-17
    assert np.abs(a @ x - x * e).max() < 2e-17
    # Single precision alone is far off, and without the sub-solves close values stay mixed.
    single = np.linalg.eigh(a.astype(np.float32))[1].astype(whitening.WIDE)
    assert np.abs(a @ single - single * np.diag(single.T @ a @ single)).max() > 1e-7
    if gap in (1e-8, 1e-12):
        order = np.argsort(-values)
        turned = np.abs(q[:, order].T @ x)
        assert np.abs(turned[10:15, 10:15] - np.eye(5)).max() < 1e-17 / gap


def test_refinement_depends_on_sub_solves(monkeypatch):
    monkeypatch.setattr(whitening, "solved_clusters", lambda a, x, values, parts: x)
    rng = np.random.default_rng(1)
    q = np.linalg.qr(rng.normal(size=(8, 8)))[0].astype(whitening.WIDE)
    values = np.array([9, 8, 7, 5, 5 + 1e-9, 5 + 2e-9, 2, 1], whitening.WIDE)
    a = q @ np.diag(values) @ q.T
    e, x = whitening.refined((a + a.T) / 2)
    assert np.abs(a @ x - x * e).max() > 1e-12


def test_query(spark):
    got = queries.QUERIES["op13_whitening"](spark, SF).collect()
    assert max(r.identity_error for r in got) < 1e-4
    assert len(got) % 8 == 0 and {r.component for r in got} == set(range(1, 9))
