"""Reading a raw survey extract and narrowing it to one indicator."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from stratline.functions.parsing import na_to_null, to_double
from stratline.operators.rows import project_present
from stratline.settings import Settings

log = logging.getLogger(__name__)


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, file, block): the lines of all files with the split they start in."""
    lines = spark.read.text(path, lineSep="\n")
    return lines.select(
        F.regexp_replace("value", "\r$", "").alias("value"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def quoted_splits(lines: DataFrame) -> DataFrame:
    """(file, block, inside) of the splits that start within a quoted cell or hold one that
    spans lines. One pass counts quotes; their parity is added up over the splits of a file."""
    odd = (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2
    splits = lines.groupBy("file", "block").agg(F.sum(odd).alias("odd"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1
    splits = splits.withColumn("inside", inside).where((F.col("odd") > 0) | F.col("inside"))
    return splits.select("file", "block", "inside")


PIECES = "file string, block bigint, place int, kind string, value string"


def joined_lines(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of whole splits, in order, to records. What belongs to a record of an earlier
    split ("on") or goes on in the next one ("open") is a piece with a kind of its own."""
    split, inside, parts, kind = None, False, [], "whole"
    out: list[tuple] = []

    def close(kind: str) -> None:
        # Pieces that go on come before the piece that stays open in the same split.
        out.append((*split, int(kind == "open"), kind, "\n".join(parts)))
        parts.clear()

    for batch in batches:
        for value, file, block, starts_inside in zip(*(c.to_pylist() for c in batch.columns)):
            if (file, block) != split:
                if parts:
                    close("open" if kind == "whole" else "on")
                split, inside = (file, block), starts_inside
                kind = "on" if inside else "whole"
            parts.append(value)
            inside ^= value.count('"') % 2 == 1
            if not inside:
                close(kind)
                kind = "whole"
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], schema=ARROW_PIECES)
            out = []
    if parts:
        close("open" if kind == "whole" else "on")
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], schema=ARROW_PIECES)


ARROW_PIECES = pa.schema(
    [("file", pa.string()), ("block", pa.int64()), ("place", pa.int32()), ("kind", pa.string()), ("value", pa.string())]
)


def records(lines: DataFrame, quoted: DataFrame) -> DataFrame:
    """The records of all files as (value), each split read by a task of its own.

    Splits without a cell that spans lines are taken as they are. `quoted` has at most one
    short row for each split."""
    some = F.broadcast(quoted)
    plain = lines.join(some.select("file", "block"), ["file", "block"], "left_anti").select("value")
    rest = lines.join(some, ["file", "block"]).select("value", "file", "block", "inside")
    pieces = rest.mapInArrow(joined_lines, PIECES)
    whole = pieces.where("kind = 'whole'").select("value")
    # At most two pieces for each split: an open one and all that go on with it.
    order = Window.partitionBy("file").orderBy("block", "place")
    number = F.sum(F.when(F.col("kind") == "open", 1).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, 0))
    cut = pieces.where("kind <> 'whole'").withColumn("number", number)
    parts = F.sort_array(F.collect_list(F.struct("block", "place", "value")))
    across = cut.groupBy("file", "number").agg(F.array_join(F.transform(parts, lambda p: p["value"]), "\n").alias("value"))
    return plain.unionByName(whole).unionByName(across.select("value"))


def read_csv(spark: SparkSession, path: str, multi_line: bool | None = None) -> DataFrame:
    """All columns as text, header names trimmed, missing-value tokens as NULL.

    Where quoted cells span lines, records are put together from the lines of each split, so
    a file is still read by many tasks; a line equal to the header is a header. Unless the
    caller says that no cell does, one pass over the text finds the splits concerned.
    """
    lines = text_lines(spark, path)
    quoted = None if multi_line is False else quoted_splits(lines)
    options = {"quote": '"', "escape": '"'}
    if quoted is None or quoted.isEmpty():
        raw = spark.read.csv(path, header=True, inferSchema=False, **options)
        found = raw.columns
    else:
        header = lines.first()["value"]
        found = spark.read.csv(path, header=True, inferSchema=False, **options).columns
        schema = ", ".join(f"`_{k}` string" for k in range(len(found)))
        kept = records(lines, quoted).where((F.trim("value") != "") & (F.col("value") != header))
        raw = kept.select(F.from_csv("value", schema, options).alias("r")).select("r.*")
    names = [c.strip() for c in found]
    raw = raw.toDF(*names)
    return raw.select(*[na_to_null(F.col(f"`{c}`")).alias(c) for c in names])


def read_raw(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    multi_line: bool | None = None,
) -> DataFrame:
    """The configured columns of a CSV or parquet extract; absent ones are skipped.

    A missing path raises FileNotFoundError.
    """
    columns = Settings().keep_columns if columns is None else columns
    try:
        if path.rstrip("/").endswith(".parquet"):
            df = spark.read.parquet(path)
            df = df.toDF(*[c.strip() for c in df.columns])
        else:
            df = read_csv(spark, path, multi_line)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(f"raw data not found: {path}") from error
        raise
    absent = sorted(set(columns) - set(df.columns))
    if absent:
        log.warning("columns not in the input, skipped: %s", absent)
    return project_present(df, columns) if columns else df


def select_indicator(df: DataFrame, cls: str, question: str) -> DataFrame:
    """Rows of one indicator; a condition on an absent column is skipped."""
    for name, wanted in (("Class", cls), ("Question", question)):
        if name in df.columns:
            df = df.where(F.col(name) == wanted)
    return df


def filter_indicator(df: DataFrame, cls: str, question: str) -> DataFrame:
    """select_indicator that raises ValueError when nothing is left (one short action)."""
    out = select_indicator(df, cls, question)
    if out.isEmpty():
        raise ValueError(f"no rows with Class={cls!r} and Question={question!r}")
    return out


def load_summary(df: DataFrame) -> DataFrame:
    """One row: year_min, year_max and n_locations, NULL where the column is absent."""
    nothing = F.lit(None)
    place = next((c for c in ("LocationAbbr", "LocationDesc") if c in df.columns), None)
    low = high = nothing.cast("int")
    if "YearStart" in df.columns:
        year = to_double(df, "YearStart")
        low, high = F.min(year).cast("int"), F.max(year).cast("int")
    return df.agg(
        low.alias("year_min"),
        high.alias("year_max"),
        (F.count_distinct(place) if place else F.max(nothing.cast("bigint"))).alias("n_locations"),
    )


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table written by an earlier stage; FileNotFoundError when there is none."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(f"table not found: {path}") from error
        raise

