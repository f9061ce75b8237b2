"""Writing stage tables, metrics and fitted models."""

from __future__ import annotations

import json
import os
import tempfile
import uuid
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

METRICS_SCHEMA = "track string, model string, split string, metric string, value double"


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in spark.checkpoint.dir.

    Only a local session may do without: it gets a folder of its own.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not path:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        path = os.path.join(tempfile.gettempdir(), "stratline-checkpoints")
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(path)
    return path


def write_table(df: DataFrame, path: str, partition_by: str | None = None) -> DataFrame:
    """Write parquet and return the table read back, with its lineage cut."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    # The schema is known, so no job has to look for it in the files.
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table_folder(spark: SparkSession) -> str:
    """A new folder for stage tables below the cluster's checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/stages-{uuid.uuid4().hex}"


def table_cut(spark: SparkSession, folder: str | None = None) -> Callable[[DataFrame, str], DataFrame]:
    """A function (df, name) that writes df to a table of its own and reads it back.

    They are written stages, so a lost executor costs no recomputation of what came before.
    """
    base = folder or table_folder(spark)
    return lambda df, name: write_table(df, f"{base.rstrip('/')}/{name}.parquet")


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header and no index; one file for each partition."""
    df.write.mode("overwrite").csv(path, header=True, escape='"')


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Long metrics (track, model, split, metric, value) as JSON lines."""
    metrics.write.mode("overwrite").json(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRICS_SCHEMA).json(path)


def metrics_dict(metrics: DataFrame) -> dict[str, dict[str, float]]:
    """{model: {split_metric: value}}; metrics hold one row per model and measure."""
    out: dict[str, dict[str, float]] = {}
    for row in metrics.select("model", "split", "metric", "value").collect():
        out.setdefault(row.model, {})[f"{row.split}_{row.metric}"] = row.value
    return out


def metrics_json(metrics: DataFrame) -> str:
    return json.dumps(metrics_dict(metrics), indent=2, sort_keys=True)


def save_model(model: PipelineModel, folder: str, track: str, name: str) -> str:
    path = f"{folder.rstrip('/')}/{track}/{name}"
    model.write().overwrite().save(path)
    return path


def load_model(folder: str, track: str, name: str) -> PipelineModel:
    return PipelineModel.load(f"{folder.rstrip('/')}/{track}/{name}")


def importances_dict(importances: DataFrame) -> dict[str, dict[str, float]]:
    rows = importances.orderBy("model", F.col("rank")).collect()
    out: dict[str, dict[str, float]] = {}
    for row in rows:
        out.setdefault(row.model, {})[row.feature] = row.importance
    return out
