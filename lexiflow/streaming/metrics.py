"""Structured Streaming form of the run-metric log (SNK-2) and of the running
best checkpoint (TOP-1, k = 1).

The reference logs named scalars as training proceeds and keeps the best
epoch as each validation result arrives.  Here the log is an append-only
parquet folder (``runs.append_metrics`` writes it in batch); a stream over
that folder keeps, per run, the best epoch seen so far — a streaming
aggregate (``max_by``/``min_by``) whose state is one row per run.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiflow.operators.runs import append_batch
from lexiflow.session import ensure_checkpoint_dir

METRIC_SCHEMA = T.StructType(
    [
        T.StructField("epoch", T.IntegerType(), True),
        T.StructField("metric", T.StringType(), True),
        T.StructField("value", T.DoubleType(), True),
        T.StructField("run", T.StringType(), True),
        T.StructField("version", T.IntegerType(), True),
    ]
)


def read_metric_stream(spark: SparkSession, path: str, schema: T.StructType = METRIC_SCHEMA, max_files: int | None = None) -> DataFrame:
    """Streaming DataFrame over an append-only metric-log folder."""
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


def running_best(stream: DataFrame, metric: str, mode: str = "max", run_col: str = "run", epoch_col: str = "epoch", value_col: str = "value") -> DataFrame:
    """Per run, the best (epoch, value) so far; ties keep the earliest epoch."""
    x = stream.where((F.col("metric") == F.lit(metric)) & F.col(value_col).isNotNull() & ~F.isnan(value_col))
    if mode == "max":
        best = F.max_by(F.struct(epoch_col, value_col), F.struct(F.col(value_col), -F.col(epoch_col)))
    elif mode == "min":
        best = F.min_by(F.struct(epoch_col, value_col), F.struct(F.col(value_col), F.col(epoch_col)))
    else:
        raise ValueError("mode must be 'max' or 'min'")
    g = x.groupBy(run_col).agg(best.alias("_b"))
    return g.select(run_col, F.col("_b")[epoch_col].alias(epoch_col), F.col("_b")[value_col].alias(value_col))


def start_versioned_log(stream: DataFrame, path: str, run: str, version: int, name: str = "versioned_log", trigger_once: bool = False):
    """Streaming SNK-2 through ``runs.append_batch``: every micro-batch is a partition of its own id, so a
    batch that Spark runs again after a failure replaces its rows instead of adding them twice."""
    ckpt = os.path.join(ensure_checkpoint_dir(stream.sparkSession), name)
    w = stream.writeStream.option("checkpointLocation", ckpt).foreachBatch(lambda df, i: append_batch(df, path, run, version, i))
    return (w.trigger(availableNow=True) if trigger_once else w).start()


def start_metric_log(stream: DataFrame, path: str, name: str = "metric_log", trigger_once: bool = False):
    """Streaming SNK-2: append incoming metric rows to ``path`` (partitioned by
    run), with the query checkpoint under the session's shared checkpoint dir."""
    ckpt = os.path.join(ensure_checkpoint_dir(stream.sparkSession), name)
    w = stream.writeStream.format("parquet").option("checkpointLocation", ckpt).outputMode("append")
    parts = [c for c in ("run", "version") if c in stream.columns]
    if parts:
        w = w.partitionBy(*parts)
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start(path)
