"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import time

import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from lexiflow.session import ensure_checkpoint_dir, ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str | Column) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def cut(df: DataFrame, few: bool = False) -> DataFrame:
    """Cut the lineage by a reliable checkpoint in the shared folder (survives lost executors).

    ``few``: in two files a core at most, for the small tables of a loop (ids, no texts),
    which otherwise write a file for every shuffle partition each time."""
    ensure_checkpoint_dir(df.sparkSession)
    return (df.coalesce(2 * df.sparkSession.sparkContext.defaultParallelism) if few else df).checkpoint()


#: The share of the time that sweeps take at most, and when the next one is due (by ``time.monotonic``).
SWEEP_SHARE, _next_sweep = 1 / 32, 0.0


def sweep(spark: SparkSession) -> None:
    """Let go of the files of finished steps, and of what the driver keeps of them.

    Spark deletes shuffle files and checkpoints once the driver's collector finds that nothing
    refers to them, which on a driver with little to do can take longer than a loop of many
    steps; such a loop asks for it before each step.  A collector that is at work too often takes
    more heap from the system instead of collecting again, so a call soon after a sweep, for the
    time it took, does nothing.  What plans, their code and threads have freed outside the heap
    stays with the C library, and adds up from step to step, until it is asked to give it back."""
    global _next_sweep
    gc.collect()
    begun = time.monotonic()
    if begun < _next_sweep:
        return
    spark.sparkContext._jvm.System.gc()
    _trim_driver(spark)
    ended = time.monotonic()
    _next_sweep = ended + (ended - begun) * (1 / SWEEP_SHARE - 1)


def _trim_driver(spark: SparkSession) -> bool:
    """Let the driver's JVM return freed memory outside its heap; False where the JVM has no such command."""
    gateway, jvm = spark.sparkContext._gateway, spark.sparkContext._jvm

    def array(kind, *values):
        out = gateway.new_array(kind, len(values))
        for i, value in enumerate(values):
            out[i] = value
        return out

    try:
        server = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
        commands = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")
        # the server's own class isn't public, so the method is taken from its interface
        kinds = [jvm.java.lang.Class.forName(x) for x in ("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")]
        invoke = jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethod("invoke", array(jvm.java.lang.Class, *kinds))
        invoke.invoke(server, array(jvm.java.lang.Object, commands, "systemTrimNativeHeap", None, None))
    except Py4JError:
        return False
    return True


try:
    _trim = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):  # another C library
    _trim = None


def give_back() -> None:
    """Return what a batch has freed to the system: Python workers live on from stage to stage, and what
    their allocators keep adds up beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


#: Rows and bytes of long values (texts, sequences) that a Python worker gets together.
_BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}


def small_batches(spark: SparkSession) -> None:
    """From now on the session hands Python workers few rows at once: for applications over long texts."""
    for name, value in _BATCH.items():
        spark.conf.set(name, value)


def cut_in_batches(df: DataFrame, few: bool = False) -> DataFrame:
    """``cut``, with few rows at once for the Python workers of this pass: bounds their memory."""
    spark = df.sparkSession
    before = {name: spark.conf.get(name, None) for name in _BATCH}
    small_batches(spark)
    try:
        return cut(df, few)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


#: Bits of a sieve; it is broadcast as at most ``SIEVE_BITS`` / 64 rows, whatever the number of keys.
SIEVE_BITS = 1 << 24


def sift(df: DataFrame, col: str, keys: DataFrame, key_col: str) -> DataFrame:
    """``df`` without most of the rows whose ``col`` isn't among the ``key_col`` of ``keys``.

    A set of hashed bits of bounded size is broadcast in place of the keys: no row that
    belongs is lost, a share of the others (keys / ``SIEVE_BITS``) passes.  For use in front
    of a join on the column, which then moves little more than it needs.  Null is a key like others.
    """
    bit = F.pmod(F.xxhash64(F.col(key_col)), F.lit(SIEVE_BITS))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), (bit % 64).cast("int"))
    words = keys.select(F.floor(bit / 64).cast("int").alias("_word"), one.alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    own = F.pmod(F.xxhash64(F.col(col)), F.lit(SIEVE_BITS))
    marked = df.withColumn("_word", F.floor(own / 64).cast("int")).withColumn("_at", (own % 64).cast("int"))
    held = marked.join(F.broadcast(words), "_word")
    return held.where(F.call_function("shiftright", F.col("_bits"), F.col("_at")).bitwiseAND(F.lit(1)) == 1).select(*df.columns)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or a variant of it that no column of ``df`` has (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    name = wanted
    while name.lower() in taken:
        name = f"_{name}"
    return name


def bounded_sample(df: DataFrame, n: int, *by: Column) -> list[Row]:
    """``n`` rows of ``df`` (all, if fewer), those of the smallest hashes of ``by``.

    The n-th smallest hash is found first, so that tasks send hashes and not rows:
    the rows that then come to the driver are ``n``, but for repeated ones at the bound.
    """
    hashed = df.withColumn(free_name(df, "_h"), F.xxhash64(*by))
    h = hashed.columns[-1]
    bound = hashed.select(h).orderBy(h).limit(n).agg(F.max(h)).first()[0]
    if bound is None:
        return []
    return hashed.where(F.col(h) <= bound).orderBy(h).limit(n).drop(h).collect()
