"""Run analytics: metric log sink, best checkpoint, model comparison, name/value
pairing and unit scaling (SNK-2, TOP-1, AGG-15, PRJ-12, PRJ-13).

The metric log is a long table ``(run, epoch, metric, value)``.  Best-epoch
selection is an aggregate (``max_by``/``min_by``, map-side combined) for
k = 1; for k > 1 a two-level top-k (per run and salt bucket, then per run)
keeps a hot run from landing in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TOPK_SALT_BUCKETS = 64


def append_metrics(df: DataFrame, path: str, run: str | None = None, version: int | None = None) -> None:
    """SNK-2: append long metric rows under ``path``, partitioned by run and version."""
    out = df
    if run is not None:
        out = out.withColumn("run", F.lit(run))
    if version is not None:
        out = out.withColumn("version", F.lit(int(version)))
    parts = [c for c in ("run", "version") if c in out.columns]
    out.write.mode("append").partitionBy(*parts).parquet(path)


def claim_version(spark: SparkSession, path: str, run: str) -> int:
    """SNK-2: the next free version of a run's log, claimed by a marker file that only one writer can create.

    Markers lie under ``path/_versions`` (names with an underscore are no data).  Creation
    without overwriting is atomic on the cluster's file systems; a local folder is asked
    for an exclusive file directly."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_versions/run={quote(run, safe='')}")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(folder)
    version = max([int(f.getPath().getName()) for f in fs.listStatus(folder) if f.getPath().getName().isdigit()], default=-1) + 1
    while True:
        marker = jvm.org.apache.hadoop.fs.Path(folder, str(version))
        try:
            if fs.getScheme() == "file":
                plain = spark.sparkContext._gateway.new_array(jvm.java.nio.file.attribute.FileAttribute, 0)
                jvm.java.nio.file.Files.createDirectory(jvm.java.io.File(fs.makeQualified(marker).toUri().getPath()).toPath(), plain)
            else:
                fs.create(marker, False).close()
            return version
        except Py4JJavaError as e:  # another writer was faster
            if "AlreadyExists" not in e.java_exception.getClass().getName():
                raise
            version += 1


def append_batch(df: DataFrame, path: str, run: str, version: int, batch_id: int) -> None:
    """SNK-2, idempotent: append one batch of long metric rows; the same batch id again replaces its own
    rows, so a retried batch adds nothing.  Each batch is a partition of the log."""
    out = df.withColumn("run", F.lit(run)).withColumn("version", F.lit(int(version))).withColumn("batch", F.lit(int(batch_id)))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run", "version", "batch").parquet(path)


def read_log(spark: SparkSession, path: str, schema: str = "epoch int, metric string, value double") -> DataFrame:
    """The rows of a metric log with run, version and batch."""
    return spark.read.schema(f"{schema}, run string, version int, batch long").parquet(path)


def best_checkpoint(
    df: DataFrame,
    metric: str,
    mode: str = "max",
    k: int = 1,
    run_col: str = "run",
    epoch_col: str = "epoch",
    value_col: str = "value",
    metric_col: str = "metric",
) -> DataFrame:
    """TOP-1: the ``k`` best epochs per run by ``metric`` (``max`` for a score,
    ``min`` for a loss).  Ties go to the earliest epoch; null and NaN values (a diverged run) never win.
    Output: run, rank (1 = best), epoch, value."""
    if mode not in ("max", "min"):
        raise ValueError("mode must be 'max' or 'min'")
    x = df.where((F.col(metric_col) == F.lit(metric)) & F.col(value_col).isNotNull() & ~F.isnan(value_col))
    x = x.select(run_col, epoch_col, value_col)
    if k == 1:
        # order key: better value first, then the earlier epoch
        if mode == "max":
            best = F.max_by(F.struct(epoch_col, value_col), F.struct(F.col(value_col), -F.col(epoch_col)))
        else:
            best = F.min_by(F.struct(epoch_col, value_col), F.struct(F.col(value_col), F.col(epoch_col)))
        g = x.groupBy(run_col).agg(best.alias("_b"))
        return g.select(run_col, F.lit(1).alias("rank"), F.col("_b")[epoch_col].alias(epoch_col), F.col("_b")[value_col].alias(value_col))
    order = [F.col(value_col).desc() if mode == "max" else F.col(value_col).asc(), F.col(epoch_col).asc()]
    salt = F.pmod(F.xxhash64(epoch_col), F.lit(TOPK_SALT_BUCKETS))
    w1 = Window.partitionBy(run_col, "_salt").orderBy(*order)
    cand = x.withColumn("_salt", salt).withColumn("_r", F.row_number().over(w1)).where(F.col("_r") <= k)
    w2 = Window.partitionBy(run_col).orderBy(*order)  # at most k × buckets rows per run
    top = cand.withColumn("rank", F.row_number().over(w2)).where(F.col("rank") <= k)
    return top.select(run_col, "rank", epoch_col, value_col)


def compare_runs(
    df: DataFrame,
    metrics: Sequence[str],
    run_col: str = "run",
    metric_col: str = "metric",
    value_col: str = "value",
    best: str | None = None,
    mode: str = "max",
    examples: Sequence[str] = (),
    totals: Mapping[str, Column] | None = None,
    epoch_col: str = "epoch",
) -> DataFrame:
    """AGG-15: one row per run (model) with one column per metric (its best,
    i.e. maximum, value) — one grouping with a condition per listed metric, so no
    extra pass finds the metric names.

    ``best`` names the metric that chooses a run's checkpoint (``mode`` as in TOP-1, the
    earliest epoch of equal values; null and NaN never win): its epoch, as best_epoch, and
    the columns ``examples`` of its row (an input and what the model made of it) stand
    beside the metrics, carried by the aggregate itself, not joined back.  Equal epochs
    are decided by the examples' own order.  ``totals`` adds aggregates of the run's rows
    (parameters, seconds)."""
    if mode not in ("max", "min"):
        raise ValueError("mode must be 'max' or 'min'")
    aggs = [F.max(F.when(F.col(metric_col) == m, F.col(value_col))).alias(m) for m in metrics]
    if best is not None:
        value = F.col(value_col)
        fits = (F.col(metric_col) == best) & value.isNotNull() & ~F.isnan(value.cast("double"))
        place = F.struct((-value if mode == "max" else value).alias("v"), F.col(epoch_col), *examples)
        aggs.append(F.min(F.when(fits, place)).alias("_best"))
    aggs += [c.alias(name) for name, c in (totals or {}).items()]
    out = df.groupBy(run_col).agg(*aggs)
    if best is None:
        return out
    kept = [F.col(f"_best.{epoch_col}").alias("best_epoch"), *[F.col(f"_best.{c}").alias(c) for c in examples]]
    return out.select(run_col, *metrics, *kept, *(totals or {}))


def scale_units(df: DataFrame, factors: Mapping[str, tuple[str, float]]) -> DataFrame:
    """PRJ-13: new columns ``out = col × factor`` (seconds→minutes 1/60,
    counts→millions 1e-6, fraction→percent 100)."""
    out = df
    for new, (c, f) in factors.items():
        out = out.withColumn(new, F.col(c) * F.lit(float(f)))
    return out


def join_name_values(df: DataFrame, names: str, values: str, keep: Sequence[str] = (), name_col: str = "name", value_col: str = "value") -> DataFrame:
    """PRJ-12: pair a list of names with a list of values, shortest list wins
    (``dict(zip(names, values))``), as long rows."""
    n = F.least(F.size(names), F.size(values))
    z = F.arrays_zip(F.slice(names, 1, n).alias(name_col), F.slice(values, 1, n).alias(value_col))
    return df.select(*keep, F.inline(z))


def metric_long(wide: DataFrame, metrics: Sequence[str], keep: Sequence[str] = ("run",)) -> DataFrame:
    """Wide metric row -> long (name, value) rows, via PRJ-12."""
    x = wide.select(*keep, F.array(*[F.lit(m) for m in metrics]).alias("_names"),
                    F.array(*[F.col(m).cast("double") for m in metrics]).alias("_values"))
    return join_name_values(x, "_names", "_values", keep=keep, name_col="metric", value_col="value")
