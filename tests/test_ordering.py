import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from stratline.operators import ordering


@pytest.fixture(params=[64, 5], ids=["many slices", "few slices"])
def slices(request, monkeypatch):
    monkeypatch.setattr(ordering, "SLICES", request.param)
    monkeypatch.setattr(ordering, "FAN", 4)


def frame(spark, seed=0, n=300):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame(
        {
            "g": rng.choice(["hot", "hot", "hot", "a", "b"], n),
            "v": rng.choice([1.5, 2.0, 2.5, *rng.normal(0, 5, 60)], n),
            "id": range(n),
        }
    )
    return pdf, spark.createDataFrame(pdf)


@pytest.mark.parametrize("p", [0.0, 0.1, 0.25, 0.5, 0.75, 1.0])
def test_quantiles_equal_numpy(spark, slices, p):
    pdf, df = frame(spark)
    got = ordering.quantiles(df, "v", {"q": p}, by=["g"]).toPandas().set_index("g")["q"]
    expected = pdf.groupby("g")["v"].apply(lambda x: np.percentile(x, 100 * p))
    assert got.sort_index().to_numpy() == pytest.approx(expected.sort_index().to_numpy(), abs=1e-12)


def test_average_ranks_equal_pandas(spark, slices):
    pdf, df = frame(spark)
    got = ordering.average_ranks(df, "v").toPandas().set_index("v")["avg_rank"]
    expected = pd.Series(pdf["v"].rank().to_numpy(), index=pdf["v"]).groupby(level=0).first()
    assert got.sort_index().to_numpy() == pytest.approx(expected.sort_index().to_numpy())


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals(spark, slices, descending):
    pdf, df = frame(spark)
    cells = ordering.value_cells(df, "v", ["g"])
    got = ordering.running_totals(cells, "v", ["n"], ["g"], descending).toPandas()
    for g, part in got.groupby("g"):
        part = part.sort_values("v", ascending=not descending)
        assert list(part["n_upto"]) == list(part["n"].cumsum())
        assert list(part["n_before"]) == list(part["n"].cumsum() - part["n"])
        assert set(part["n_all"]) == {(pdf["g"] == g).sum()}


def test_text_keys_can_be_sliced(spark, slices):
    words = [f"w{i:03d}" for i in range(50)]
    df = spark.createDataFrame([(w, 1) for w in words], "w string, one int")
    got = ordering.running_totals(df, "w", ["one"]).orderBy("w").toPandas()
    assert list(got["one_before"]) == list(range(50))


def test_next_in_order_equals_shift(spark, slices):
    pdf, df = frame(spark)
    pdf["year"] = pdf["id"] % 4
    pdf.loc[pdf["id"] % 9 == 0, "v"] = None
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "g string, v double, id long, year long")
    got = ordering.next_in_order(df, ["g"], ["year", "id"], "v", "nxt").toPandas().set_index("id")
    ordered = pdf.sort_values(["g", "year", "id"])
    expected = ordered.groupby("g")["v"].shift(-1)
    expected.index = ordered["id"]
    pd.testing.assert_series_equal(
        got["nxt"].sort_index().astype(float), expected.sort_index().astype(float), check_names=False
    )


def test_slice_of_counts_points_at_or_below(spark):
    points = [2, 3, 5, 8, 13]
    df = spark.range(0, 16).select("id", ordering.slice_of(F.col("id"), F.array(*map(F.lit, points)), 9).alias("s"))
    for row in df.collect():
        assert row["s"] == sum(p <= row["id"] for p in points)


@settings(max_examples=12, deadline=None)
@given(st.lists(st.one_of(st.integers(-3, 3), st.floats(-1e6, 1e6)), min_size=1, max_size=40))
def test_median_property(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = ordering.quantiles(df, "v", {"m": 0.5}).first()["m"]
    assert got == pytest.approx(float(np.median(values)), rel=1e-12, abs=1e-9)


def test_operators_on_many_slices_agree_with_one(spark, monkeypatch):
    """Everything built on ordered slices, with groups and NULLs."""
    from stratline.operators import eda, encode, metrics, panel, targets

    rng = np.random.default_rng(12)
    pdf = pd.DataFrame(
        {
            "g": rng.choice(["x", "y", "z", None], 250, p=[0.6, 0.2, 0.1, 0.1]),
            "v": rng.choice([*rng.normal(0, 3, 40), np.nan], 250).round(3),
            "w": rng.integers(0, 9, 250).astype(float),
            "y": rng.integers(0, 2, 250),
        }
    )
    plain = pdf.astype(object).where(pdf.notna(), None)
    df = spark.createDataFrame(plain, "g string, v double, w double, y int")
    jobs = {
        "medians": lambda: panel.medians(df, ["v", "w", "y"]),
        "threshold": lambda: targets.threshold(df, 90, value="v"),
        "box": lambda: eda.box_plot(df, "g", "v"),
        "outliers": lambda: eda.box_outliers(df, "g", "v"),
        "describe": lambda: eda.describe(df, "v"),
        "codes": lambda: encode.label_encode(df, ["g"], share=2),
        "roc": lambda: metrics.roc_points(df, ["g"], score="v", few_groups=True),
        "auc": lambda: metrics.roc_auc(df, ["g"], score="v"),
    }

    def results():
        return {name: sorted(map(repr, job().collect())) for name, job in jobs.items()}

    many = results()
    monkeypatch.setattr(ordering, "SLICES", 3)
    monkeypatch.setattr(ordering, "FAN", 1)
    assert results() == many
    # Too many groups to fetch: brackets are joined the general way.
    monkeypatch.setattr(ordering, "SMALL_ROWS", 1)
    assert results() == many


@pytest.mark.parametrize("kind", ["unique", "tied", "hot"])
def test_brackets_hold_few_values(spark, kind):
    """Above WHOLE rows only a sliver is ordered, and the answer stays exact."""
    n = 200_000
    rng = np.random.default_rng(1)
    v = {"unique": rng.normal(size=n), "tied": rng.integers(0, 50, n).astype(float), "hot": np.where(rng.random(n) < 0.4, 7.0, rng.normal(6, 3, n))}[kind]
    df = spark.createDataFrame(pd.DataFrame({"v": v}))
    probs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9371, "e": 1.0}
    cells = ordering.bracket_cells(df, "v", probs, [], False).where("v is not null")
    sizes = {r["i"]: r["count"] for r in cells.groupBy("i").count().collect()}
    print(kind, "values ordered of", n, sizes)
    assert set(sizes) == set(range(5)) and max(sizes.values()) <= 0.003 * n
    got = ordering.quantiles(df, "v", probs).first()
    assert [got[c] for c in probs] == pytest.approx(list(np.percentile(v, [100 * p for p in probs.values()])), abs=1e-12)


@pytest.mark.parametrize("n", [1, 2, 1999, 2000, 2001, 5000])
def test_quantiles_around_the_width_of_a_bracket(spark, n):
    v = np.random.default_rng(n).permutation(n).astype(float)
    df = spark.createDataFrame(pd.DataFrame({"v": v})).repartition(8)
    probs = {f"p{k}": p for k, p in enumerate([0.0, 0.0004, 0.1, 0.333, 0.5, 0.9, 0.9995, 1.0])}
    got = ordering.quantiles(df, "v", probs).first()
    assert [got[c] for c in probs] == pytest.approx(list(np.percentile(v, [100 * p for p in probs.values()])), abs=1e-9)
