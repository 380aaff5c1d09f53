"""Record tables: read, pick a split, keep an encoded dataset (SRC-2, SRC-3, SNK-1)."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiflow.session import path_exists

RECORD_SCHEMA = T.StructType(
    [
        T.StructField("split", T.StringType(), False),
        T.StructField("row_id", T.LongType(), False),
        T.StructField("document", T.StringType(), False),
        T.StructField("summary", T.StringType(), False),
    ]
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (``{sf_dir}/{name}.parquet``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_records(spark: SparkSession, path: str, schema: T.StructType = RECORD_SCHEMA, fmt: str = "parquet") -> DataFrame:
    """SRC-2: document/summary records with an explicit schema (no inference).

    Null text is an error at ingest (the reference has no null handling);
    empty strings are legal.
    """
    df = spark.read.schema(schema).format(fmt).load(path)
    text_cols = [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]
    bad = F.lit(False)
    for c in text_cols:
        bad = bad | F.col(c).isNull()
    return df.where(F.when(bad, F.raise_error(F.lit("null text in record"))).otherwise(F.lit(True)))


def read_split(df: DataFrame, name: str, col: str = "split") -> DataFrame:
    """SRC-3: pick one split.  On a table written ``partitionBy('split')`` this
    is a partition filter, so only that split's files are read."""
    return df.where(F.col(col) == F.lit(name))


def write_encoded(df: DataFrame, path: str, partition_col: str | None = "split", mode: str = "overwrite") -> None:
    """SNK-1: keep a converted dataset so later runs skip the conversion."""
    w = df.write.mode(mode)
    if partition_col and partition_col in df.columns:
        w = w.partitionBy(partition_col)
    w.parquet(path)


# --- a kept set that is used again -------------------------------------------------

def files_fingerprint(spark: SparkSession, paths: Sequence[str]) -> str:
    """A digest of the names, lengths and times of all files under ``paths``; their contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths)).select("path", "length", "modificationTime")
    got = files.agg(F.count("*"), F.sum("length"), F.bit_xor(F.xxhash64("path", "length", "modificationTime"))).first()
    return "/".join(map(str, got))


def rows_fingerprint(df: DataFrame) -> str:
    """A digest of the rows of ``df``, whatever their order (a vocabulary, say); only sums reach the driver."""
    h = F.xxhash64(*df.columns)
    got = df.agg(F.count("*"), F.bit_xor(h), F.sum(F.shiftright(h, 16).cast("decimal(38,0)"))).first()
    return "/".join(map(str, [*df.dtypes, *got]))


def keep_encoded(
    spark: SparkSession,
    path: str,
    make: Callable[[], DataFrame],
    inputs: Sequence[str],
    tables: Sequence[DataFrame] = (),
    options: Mapping[str, object] | None = None,
    partition_col: str | None = "split",
) -> tuple[DataFrame, bool]:
    """SNK-1 with reuse: the set that ``make()`` converts, and whether it was found under ``path``.

    A set lies in a folder named by the fingerprint of its input files, of the rows of
    ``tables`` (vocabulary) and of ``options``; any change of these is another folder.  Its
    manifest is written after the data: a folder without one (a run that broke off) is
    converted anew.  ``make`` isn't called when the set is found."""
    said = {"files": files_fingerprint(spark, inputs), "tables": [rows_fingerprint(t) for t in tables], "options": {k: str(v) for k, v in (options or {}).items()}}
    key = hashlib.sha256(json.dumps(said, sort_keys=True).encode()).hexdigest()[:32]
    data, manifest = f"{path.rstrip('/')}/{key}/data", f"{path.rstrip('/')}/{key}/manifest"
    if path_exists(spark, manifest) and not spark.read.parquet(manifest).where(F.col("key") == key).isEmpty():
        return spark.read.parquet(data), True
    write_encoded(make(), data, partition_col)
    spark.createDataFrame([(key, json.dumps(said, sort_keys=True))], "key string, made_of string").coalesce(1).write.mode("overwrite").parquet(manifest)
    return spark.read.parquet(data), False
