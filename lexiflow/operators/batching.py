"""Ordering, sharding, batching and padding (WIN-1..4, SET-2, CHK-3, AGG-14, TOP-2).

Positions come from ``row_index`` (range-partitioned two-pass index), never
from a global single-partition window.  The shuffle order is an md5 of
``seed:key`` — stable under any partitioning and reproducible in SQL — with
the key as tie-breaker, so every row has a unique sort key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiflow.operators.ordering import md5_bucket, row_index
from lexiflow.session import shuffle_partitions
from lexiflow.sources.fixtures import SEED


def shuffle_key(key: str, seed: int = SEED):
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def shuffle_rows(
    df: DataFrame,
    key: str = "row_id",
    seed: int = SEED,
    group_cols: Sequence[str] = ("split",),
    splits: Sequence[str] | None = None,
    out: str = "pos",
) -> DataFrame:
    """WIN-3: 0-based position of each row inside its split in shuffled order.

    ``splits`` lists the shuffled splits (translation: train only;
    summarisation off the distributed path: every split, the default); other
    splits keep key order.
    """
    o = shuffle_key(key, seed)
    nb = 4 * shuffle_partitions(df.sparkSession)
    if splits is not None and "split" in df.columns:
        o = F.when(F.col("split").isin(list(splits)), o)
    tmp = df.withColumn("_ord", o)
    few = list(group_cols) == ["split"]  # train / validation / test: a fixed enumeration
    # rows of unshuffled splits have no md5: their buckets are quantile ranges of the key
    return row_index(tmp, ["_ord", key], group_cols=group_cols, name=out, bucket=md5_bucket(F.col("_ord"), nb), num_buckets=nb,
                     enumerated_groups=few, range_col=key if splits is not None else None).drop("_ord")


def assign_batches(df: DataFrame, batch_size: int, pos_col: str = "pos", out: str = "batch_id") -> DataFrame:
    """WIN-1: consecutive groups of ``batch_size`` positions; the last may be short."""
    return df.withColumn(out, F.floor(F.col(pos_col) / F.lit(batch_size)).cast("long"))


def shard_rows(df: DataFrame, world: int, pos_col: str = "pos", group_cols: Sequence[str] = ("split",)) -> DataFrame:
    """WIN-4 + SET-2: distributed-sampler sharding.  The ordered list is
    extended to a multiple of ``world`` by repeating rows from its head (as
    many times as needed when rows < world); position p goes to rank
    p mod world at local position p div world.  Adds ``rank``, ``local_pos``
    and ``copy`` (0 for the original row)."""
    group_cols = list(group_cols)
    if group_cols:
        sizes = df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("_n"))  # one row per group
        x = df.join(sizes, on=group_cols, how="inner")
    else:
        x = df.withColumn("_n", df.agg(F.count(F.lit(1))).scalar())
    total = F.ceil(F.col("_n") / F.lit(world)) * F.lit(world)
    last_copy = F.floor((total - F.lit(1) - F.col(pos_col)) / F.col("_n"))
    x = x.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), last_copy.cast("long"))))
    p = F.col(pos_col) + F.col("copy") * F.col("_n")
    return x.withColumn("rank", F.pmod(p, F.lit(world)).cast("int")).withColumn(
        "local_pos", F.floor(p / F.lit(world)).cast("long")
    ).drop("_n")


def pad_batch(df: DataFrame, cols: Mapping[str, int | Column], batch_cols: Sequence[str] = ("split", "batch_id"), suffix: str = "") -> DataFrame:
    """WIN-2: right-pad each array column to the longest row of its batch with
    its own pad value (ids: pad id, a number or a column; masks: 0), each column separately."""
    w = Window.partitionBy(*batch_cols)
    out = df
    for c, pad in cols.items():
        m = F.max(F.size(c)).over(w)
        out = out.withColumn(c + suffix, F.concat(F.col(c), F.array_repeat(pad if isinstance(pad, Column) else F.lit(int(pad)), m - F.size(c))))
    return out


def infer_pad_id(df: DataFrame, col: str = "input_ids", batch_cols: Sequence[str] = ("split", "batch_id"), pos_col: str = "pos") -> DataFrame:
    """CHK-3: the last input id of the first row of each batch decides the pad
    id: 2 -> 1, 1 -> 0, anything else fails."""
    first = df.groupBy(*batch_cols).agg(F.min_by(F.element_at(col, -1), F.col(pos_col)).alias("_last"))
    return first.select(*batch_cols, pad_of_last(F.col("_last")).alias("pad_id"))


def pad_of_last(last: Column) -> Column:
    told = F.raise_error(F.concat(F.lit("cannot infer pad id from last id "), F.coalesce(last.cast("string"), F.lit("null"))))
    return F.when(last == 2, F.lit(1)).when(last == 1, F.lit(0)).otherwise(told.cast("int"))


def with_pad_id(df: DataFrame, col: str = "input_ids", batch_cols: Sequence[str] = ("split", "batch_id"), pos_col: str = "pos", out: str = "pad_id") -> DataFrame:
    """CHK-3 beside the rows: ``infer_pad_id`` of each row's batch as a column, without a join."""
    first = F.min_by(F.element_at(col, -1), F.col(pos_col)).over(Window.partitionBy(*batch_cols))
    return df.withColumn(out, pad_of_last(first))


def batch_volume(df: DataFrame, cols: Sequence[str], batch_cols: Sequence[str] = ("split", "batch_id")) -> DataFrame:
    """AGG-14: per batch and column, elements of the padded matrix
    (rows × longest row) and the share of them that is padding.  A column holds
    the arrays, or their lengths alone: no more needs to move to its batch."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for c in cols:
        n = F.size(c) if isinstance(df.schema[c].dataType, T.ArrayType) else F.col(c)
        aggs += [F.max(n).alias(f"_m_{c}"), F.sum(n).alias(f"_s_{c}")]
    g = df.groupBy(*batch_cols).agg(*aggs)
    sel = [*batch_cols, "n_rows"]
    for c in cols:
        vol = (F.col("n_rows") * F.col(f"_m_{c}")).cast("long")
        sel.append(vol.alias(f"{c}_volume"))
        sel.append(F.try_divide((vol - F.col(f"_s_{c}")).cast("double"), vol.cast("double")).alias(f"{c}_pad_share"))
    return g.select(*sel)


def limit_batches(df: DataFrame, n: int, batch_col: str = "batch_id") -> DataFrame:
    """TOP-2: only the first ``n`` batches (sanity-check evaluation)."""
    return df.where(F.col(batch_col) < F.lit(n))
