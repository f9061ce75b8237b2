import csv
import random

import pytest
from pyspark.sql import functions as F

from stratline.functions import parsing
from stratline.operators import rows
from stratline.settings import Settings
from stratline.sources import ingest, sinks

CSV = """YearStart,LocationAbbr,High_Confidence_Limit ,Class,Question,Data_Value,Extra
2015,PA,33.0,C,Q,30.5,x
2016,NA,N/A,C,Q," 31,2",y
2017,NY,,C,other,,"a ""quoted"" cell"
"""


def write(path, text):
    path.write_text(text)
    return str(path)


def test_header_is_trimmed_and_tokens_become_null(spark, tmp_path):
    df = ingest.read_csv(spark, write(tmp_path / "a.csv", CSV))
    assert "High_Confidence_Limit" in df.columns
    assert {kind for _, kind in df.dtypes} == {"string"}
    got = df.orderBy("YearStart").collect()
    assert [r["LocationAbbr"] for r in got] == ["PA", None, "NY"]
    assert [r["High_Confidence_Limit"] for r in got] == ["33.0", None, None]
    assert got[2]["Extra"] == 'a "quoted" cell'


def test_cells_with_line_breaks_are_found_and_read(spark, tmp_path):
    path = write(tmp_path / "b.csv", 'a,b\n1,"two\nlines"\n2,plain\n')
    assert not ingest.quoted_splits(ingest.text_lines(spark, path)).isEmpty()
    got = {r["a"]: r["b"] for r in ingest.read_csv(spark, path).collect()}
    assert got == {"1": "two\nlines", "2": "plain"}


def test_lenient_projection_keeps_configured_order(spark, tmp_path):
    path = write(tmp_path / "a.csv", CSV)
    df = ingest.read_raw(spark, path, ["Data_Value", "nope", "YearStart"])
    assert df.columns == ["Data_Value", "YearStart"]


def test_missing_input_raises(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        ingest.read_raw(spark, str(tmp_path / "none.csv"))
    with pytest.raises(FileNotFoundError):
        ingest.read_table(spark, str(tmp_path / "none.parquet"))


def test_indicator_filter(spark, tmp_path):
    df = ingest.read_csv(spark, write(tmp_path / "a.csv", CSV))
    assert ingest.filter_indicator(df, "C", "Q").count() == 2
    assert ingest.filter_indicator(df.drop("Question"), "C", "Q").count() == 3
    with pytest.raises(ValueError):
        ingest.filter_indicator(df, "C", "absent")


def test_load_summary_tolerates_absent_columns(spark):
    df = spark.createDataFrame([("2015", "PA"), ("x", "NY"), ("2017", "PA")], "YearStart string, LocationDesc string")
    assert ingest.load_summary(df).first().asDict() == {
        "year_min": 2015, "year_max": 2017, "n_locations": 2,
    }
    assert ingest.load_summary(df.select(F.lit(1).alias("z"))).first().asDict() == {
        "year_min": None, "year_max": None, "n_locations": None,
    }


@pytest.mark.parametrize(
    "text, number",
    [
        ("30.5", 30.5), (" 3.5\t", 3.5), (" 7", 7.0), ("-1e3", -1000.0), (".5", 0.5), ("5.", 5.0),
        ("1,234", None), ("1.0d", None), ("NA", None), ("", None), ("0x10", None), ("1_000", None),
        ("inf", float("inf")), ("-Infinity", float("-inf")), ("NaN", None), (None, None),
    ],
)
def test_numeric_parsing(spark, text, number):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(parsing.to_double(df, "t")).first()[0] == number


def test_nan_becomes_null_and_years_are_whole(spark):
    df = spark.createDataFrame([(float("nan"),), (2015.0,), (2015.5,)], "y double")
    assert [r[0] for r in df.select(parsing.to_double(df, "y")).collect()] == [None, 2015.0, 2015.5]
    assert [r[0] for r in df.select(parsing.to_year(df, "y")).collect()] == [None, 2015, None]


def test_sinks_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(2015, "PA", 1.5), (2016, "NY", None)], "YearStart int, l string, v double")
    back = sinks.write_table(df, str(tmp_path / "t.parquet"))
    assert back.dtypes == df.dtypes and back.exceptAll(df).isEmpty()
    parts = sinks.write_table(df, str(tmp_path / "p.parquet"), partition_by="YearStart")
    assert parts.where("YearStart = 2016").count() == 1
    sinks.write_csv(df, str(tmp_path / "t.csv"))
    assert ingest.read_csv(spark, str(tmp_path / "t.csv")).count() == 2
    metrics = spark.createDataFrame(
        [("regression", "ridge", "val", "r2", 0.5)], sinks.METRICS_SCHEMA
    )
    sinks.write_metrics(metrics, str(tmp_path / "m"))
    assert sinks.metrics_dict(sinks.read_metrics(spark, str(tmp_path / "m"))) == {"ridge": {"val_r2": 0.5}}


class Conf(dict):
    get = dict.get


class Session:
    """A session as far as checkpoint_dir looks at it."""

    def __init__(self, spark, master, **conf):
        self.conf = Conf(conf)
        self.sparkContext = type(
            "Context", (), {"master": master, "_jsc": spark.sparkContext._jsc, "setCheckpointDir": print}
        )


def test_the_cluster_checkpoint_folder_is_respected(spark):
    named = Session(spark, "yarn", **{"spark.checkpoint.dir": "hdfs://shared/x"})
    sinks.checkpoint_dir(spark)
    assert sinks.checkpoint_dir(named) == "hdfs://shared/x"
    assert sinks.checkpoint_dir(Session(spark, "local[2]")).endswith("stratline-checkpoints")
    with pytest.raises(RuntimeError):
        sinks.checkpoint_dir(Session(spark, "yarn"))


def test_value_columns():
    class Frame:
        columns = ["Data_Value", "value", "x", "DATAVALUE"]

    assert rows.value_columns(Frame) == ["Data_Value", "value", "DATAVALUE"]


def test_duplicates_and_keep_first(spark):
    df = spark.createDataFrame(
        [("a", 1, None), ("a", 1, None), ("a", 2, 5.0), (None, 3, float("nan")), (None, 3, float("nan"))],
        "k string, o int, v double",
    )
    assert rows.distinct_rows(df).count() == 3
    assert rows.duplicate_count(df).first().asDict() == {"n_rows": 5, "n_distinct": 3, "n_duplicates": 2}
    first = {r["k"]: (r["o"], r["v"]) for r in rows.keep_first(df, ["k"], ["o"]).collect()}
    assert first["a"] == (1, None) and first[None][0] == 3


def test_settings_override():
    s = Settings().override(train_max_year=1999, regressors={"lasso": None, "ridge": {"alpha": 9.0}})
    assert s.train_max_year == 1999 and "lasso" not in s.regressors
    assert s.regressors["ridge"] == {"alpha": 9.0}
    with pytest.raises((ValueError, AttributeError)):
        Settings().override(nope=1)


@pytest.fixture
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda n: spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize("split", [37, 150, 4000])
@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_cells_that_span_lines_and_splits(spark, tmp_path, small_splits, split, ending):
    draw = random.Random(split)
    cells = ["a", "", "x,y", 'he said "no"', "two\nlines", "\n\n", '"\n"', "long " * 30, "N/A", "é\n,\"b\""]
    for name in ("a", "b"):
        with open(tmp_path / f"{name}.csv", "w", newline="") as file:
            out = csv.writer(file, lineterminator=ending)
            out.writerow(["id", "first ", "second"])
            out.writerows([f"{name}{k}", draw.choice(cells), draw.choice(cells)] for k in range(120))
    expected = {}
    for name in ("a", "b"):
        with open(tmp_path / f"{name}.csv", newline="") as file:
            for row in list(csv.reader(file))[1:]:
                expected[row[0]] = tuple(None if c in ("", "N/A") else c for c in row[1:])
    small_splits(split)
    lines = ingest.text_lines(spark, str(tmp_path))
    assert lines.rdd.getNumPartitions() > (20 if split == 37 else 1)
    got = {r["id"]: (r["first"], r["second"]) for r in ingest.read_csv(spark, str(tmp_path)).collect()}
    assert got == expected


def test_splits_without_such_cells_are_left_alone(spark, tmp_path):
    path = write(tmp_path / "a.csv", CSV)
    assert ingest.quoted_splits(ingest.text_lines(spark, path)).isEmpty()
    assert ingest.read_csv(spark, path).count() == 3
