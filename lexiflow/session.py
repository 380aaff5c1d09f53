"""Session helpers: a local session for tests/bench and checkpoint-dir handling."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "lexiflow") -> SparkSession:
    """A local session for tests and the bench (UI off, AQE on, UTC, ANSI default)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # local runs move only a few MB per shuffle; without this AQE would merge
        # them into 1-2 tasks before CPU-heavy steps (explode, LCS).  Irrelevant
        # at cluster scale, where partitions are far above this size.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a shared (HDFS/object-store) folder and is
    used as is; a cluster session without it is an error.  Only a local
    session (tests, bench) without the setting gets a fresh scratch folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext, the conf carries the folder
        sc = None
    current = (sc.getCheckpointDir() if sc is not None else None) or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if sc is not None and not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    master = spark.conf.get("spark.master", "") or (sc.master if sc is not None else "")
    if not master.startswith("local"):
        # a machine-local folder is not shared by the executors of a cluster
        raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder (HDFS/object store) for checkpoints")
    path = tempfile.mkdtemp(prefix="lexiflow-ckpt-", dir=os.environ.get("LEXIFLOW_SCRATCH", "/tmp"))
    if sc is not None:
        sc.setCheckpointDir(path)
    else:
        spark.conf.set("spark.checkpoint.dir", path)
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at ``path``, in whatever store Spark reads it from."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def materialize(df, name: str = "stage"):
    """Cut lineage: write ``df`` as parquet into the shared checkpoint folder
    (``spark.checkpoint.dir``) and read it back.  Used where a costly
    upstream (encoding) would otherwise be recomputed by several passes;
    the files survive executor loss, unlike cached blocks."""
    import uuid

    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/lexiflow-{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``lexiflow`` importable in the Python workers (Arrow UDFs,
    mapInPandas) wherever the driver runs from: the package is zipped once and
    added with ``addPyFile`` (``addArtifacts`` on Spark Connect), which Spark
    distributes to every executor."""
    import zipfile

    try:
        key = spark.sparkContext.applicationId
    except Exception:  # Spark Connect
        key = getattr(spark, "session_id", "connect")
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="lexiflow-pkg-"), "lexiflow.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    try:
        spark.sparkContext.addPyFile(out)
    except Exception as classic_error:
        if "already registered" in str(classic_error):
            pass  # shipped earlier in this application (e.g. after a module reload)
        else:
            try:
                spark.addArtifacts(out, pyfile=True)
            except Exception as connect_error:
                if "already" not in str(connect_error):
                    raise
    _SHIPPED.add(key)
