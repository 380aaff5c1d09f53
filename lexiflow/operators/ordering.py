"""Positions without a single-task window.

``row_number() over (partition by g order by k)`` puts every row of a group in
one task; a group that holds a third of the data (the ``train`` split, a hot
run) then lands on one executor.  ``row_index`` gives the same 0-based
positions while cutting groups into buckets of equal depth:

1. group sizes are counted (map-side combined); a group is *hot* when it
   holds more than total ÷ partitions rows — so there are at most
   ``partitions`` hot groups, a proven bound;
2. rows of hot groups get a bucket that never decreases along the order: the
   leading bits of an md5 order key, which is uniform, or the place of a numeric
   key between quantiles of its group (``percentile_approx``, a mergeable
   summary), found by binary search.  A group gets buckets in proportion to its
   size, ``buckets`` for all rows together; the rest of the rows get bucket 0;
3. ``row_number`` runs per (group, bucket), so a hot group spreads over
   many tasks and a small group stays whole;
4. rows per (hot group, bucket) are counted and prefix-summed over the bucket
   order — at most buckets + partitions rows — and broadcast back as offsets.

Quantiles follow the keys, so one outlier doesn't crowd the others into a bucket.
Everything is a deterministic expression of the rows: other quantiles would move
the bounds of the buckets but no position, and a lost executor's tasks recompute
the same.  The order columns must be unique inside a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiflow.session import ensure_checkpoint_dir, shuffle_partitions

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)

#: Rank error of the quantiles, in buckets: 1 / SHARPNESS.
SHARPNESS = 20


def md5_bucket(hex_col, buckets: int) -> Column:
    """Bucket of a hex md5 string from its first 8 hex digits (uniform, monotone)."""
    top = F.conv(F.substring(hex_col, 1, 8), 16, 10).cast("long")
    return F.floor(top.cast("double") * F.lit(float(buckets)) / F.lit(4294967296.0)).cast("int")


def equi_depth_bounds(col, buckets: int) -> Column:
    """Aggregate: the buckets − 1 inner bounds of ``buckets`` equally filled ranges of a numeric column."""
    grid = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    return F.percentile_approx(col, grid, SHARPNESS * buckets)


def bounds_below(bounds, value, buckets: int) -> Column:
    """How many of the ascending ``bounds`` (fewer than ``buckets``) are below ``value``: binary search;
    0 for a null value or no bounds."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(buckets.bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, s: F.when(F.get(bounds, at + s - 1) < value, at + s).otherwise(at))


def _with_groups(df: DataFrame, table: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """``df`` with the columns of the small ``table`` of its group (null where there is none; null keys match)."""
    named = table.select(*[F.col(c).alias(f"_g_{c}") if c in group_cols else F.col(c) for c in table.columns])
    on = F.lit(True)
    for c in group_cols:
        on = on & df[c].eqNullSafe(named[f"_g_{c}"])
    return df.join(F.broadcast(named), on, "left").drop(*[f"_g_{c}" for c in group_cols])


def row_index(
    df: DataFrame,
    order_cols: Sequence,
    group_cols: Sequence[str] = (),
    name: str = "pos",
    bucket: Column | None = None,
    num_buckets: int | None = None,
    num_partitions: int | None = None,
    enumerated_groups: bool = False,
    range_col: str | None = None,
) -> DataFrame:
    """Add ``name``: 0-based position of each row inside its ``group_cols`` group
    in ``order_cols`` order (ascending, nulls first).

    ``bucket`` is a uniform bucket below ``num_buckets`` that never decreases along
    that order within a group.  Where it is null or not given, the place of the numeric
    column ``range_col`` (the first order column, if numeric) between its quantiles is
    taken; without either a group is one bucket.

    ``enumerated_groups=True`` declares that the groups are a small fixed
    enumeration (dataset splits): every group is bucketed and the hot-group pass
    is skipped."""
    group_cols = list(group_cols)
    order = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    parts = num_partitions or shuffle_partitions(df.sparkSession)
    nb = num_buckets or 4 * parts
    first = order_cols[0]
    if range_col is None and bucket is None and isinstance(first, str) and isinstance(df.schema[first].dataType, _NUMERIC):
        range_col = first
    summary = [F.count(F.lit(1)).alias("_size")]
    if range_col is not None and nb > 1:
        summary.append(equi_depth_bounds(range_col, nb).alias("_bounds"))

    if not group_cols:
        stats = df.agg(F.struct(*summary).alias("s")).scalar()  # one scalar subquery
        x = df.withColumn("_s", stats).select(*df.columns, "_s.*").withColumn("_total", F.col("_size"))
    else:
        if enumerated_groups:
            few = df.groupBy(*group_cols).agg(*summary)
            total = few.agg(F.sum("_size")).scalar()
        else:
            sizes = df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("_size"))
            total = sizes.agg(F.sum("_size")).scalar()
            few = sizes.where(F.col("_size") > total / F.lit(float(parts)))  # at most `parts` groups can be hot
            if len(summary) > 1:  # the quantiles of the hot groups' rows only
                hot = _with_groups(df, few, group_cols).where(F.col("_size").isNotNull())
                few = hot.groupBy(*group_cols).agg(*summary)
        x = _with_groups(df, few.withColumn("_total", total), group_cols)
    fine = F.lit(None).cast("int") if bucket is None else bucket
    if len(summary) > 1:
        fine = F.coalesce(fine, bounds_below(F.col("_bounds"), F.col(range_col), nb))
    own = F.ceil(F.col("_size") * nb / F.col("_total"))  # the group's buckets, in proportion to its size
    b = F.when(F.col("_size").isNotNull(), F.floor(F.coalesce(fine, F.lit(0)) * own / nb)).otherwise(F.lit(0)).cast("int")
    x = x.withColumn("_b", b).drop("_bounds", "_total")

    w = Window.partitionBy(*group_cols, "_b").orderBy(*order)
    ranked = x.withColumn("_r", F.row_number().over(w) - F.lit(1))
    counts = x.where(F.col("_size").isNotNull()).groupBy(*group_cols, "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group_cols).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*group_cols, "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    # offsets: at most buckets + hot groups rows
    joined = _with_groups(ranked, offsets, [*group_cols, "_b"])
    pos = F.col("_r") + F.coalesce(F.col("_off"), F.lit(0))
    return joined.select(*df.columns, pos.cast("long").alias(name))


def sorted_index(df: DataFrame, order: Sequence[Column], name: str = "pos") -> DataFrame:
    """Add ``name``: 0-based position in the total order ``order`` (unique keys).

    A range-partitioned sort, written once to the shared checkpoint folder with
    each row's partition and place in it; the partitions' row counts, prefix-summed
    (one row per partition), are the offsets.  Equal-width assumptions about the
    keys are not needed: the range bounds follow their distribution."""
    ensure_checkpoint_dir(df.sparkSession)
    place = F.monotonically_increasing_id()  # partition number in the upper 31 bits, place in the lower 33
    x = df.orderBy(*order).withColumn("_m", place).checkpoint(eager=True)
    x = x.withColumn("_p", F.shiftright("_m", 33)).withColumn("_r", F.col("_m").bitwiseAND(F.lit((1 << 33) - 1)))
    counts = x.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # over one row per partition
    offsets = counts.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    out = x.join(F.broadcast(offsets), on="_p")
    return out.withColumn(name, (F.col("_r") + F.col("_off")).cast("long")).drop("_m", "_p", "_r", "_off")
