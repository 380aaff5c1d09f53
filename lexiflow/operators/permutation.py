"""Epoch orders without a sort (WIN-3/4, SET-2): a keyed permutation of row numbers.

Rows are numbered once (``number_rows``).  Each epoch's order is then a pseudo-random
permutation of 0 … n−1, evaluated from a row's number alone: a Feistel network over
pairs (i div b, i mod b) with a·b ≥ n permutes 0 … a·b−1, and a value beyond n−1 walks
on along its cycle until it is back inside (fewer than a values are outside, so this
is rare and ends).  The permutation has an inverse, hence both

* ``epoch_row(position)`` -- which row an epoch has at a position, and
* ``epoch_position(row)`` -- where a row stands in an epoch

are column expressions: no sort, shuffle or state per epoch, another order for every
epoch, and a rank's shard is a filter on the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiflow.operators.ordering import _with_groups, row_index
from lexiflow.sources.fixtures import SEED

ROUNDS = 4


def _draw(key: Column, turn: int, value: Column) -> Column:
    """60 pseudo-random bits of (key, round, value)."""
    text = F.concat(key, F.lit(f":{turn}:"), value.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def _sides(n: Column) -> tuple[Column, Column]:
    a = F.ceil(F.sqrt(n.cast("double"))).cast("long")
    return a, F.floor((n + a - 1) / a).cast("long")


def _div(x: Column, y: Column) -> Column:
    return ((x - x % y) / y).cast("long")


def _network(x: Column, a: Column, b: Column, key: Column, inverse: bool) -> Column:
    """The permutation of 0 … a·b−1, or its inverse."""
    sign = -1 if inverse else 1

    def round_(turn: int):
        def one(pair: Column) -> Column:
            left, right = pair["l"], pair["r"]
            if turn % 2:
                left = F.pmod(left + sign * (_draw(key, turn, right) % a), a)
            else:
                right = F.pmod(right + sign * (_draw(key, turn, left) % b), b)
            return F.struct(left.alias("l"), right.alias("r"))

        return one

    # one lambda a round: each evaluates the pair before it once
    pair = F.array(F.struct(_div(x, b).alias("l"), (x % b).alias("r")))
    for turn in reversed(range(ROUNDS)) if inverse else range(ROUNDS):
        pair = F.transform(pair, round_(turn))
    return F.transform(pair, lambda p: p["l"] * b + p["r"])[0]


def _permuted(x: Column, n: Column, key: Column, inverse: bool) -> Column:
    a, b = _sides(n)

    def walk(y: Column) -> Column:  # at most as many steps as there are values outside
        outside = F.sequence(F.lit(1).cast("long"), F.greatest(a * b - n, F.lit(1)))
        on = F.aggregate(outside, y, lambda z, _: F.when(z < n, z).otherwise(_network(z, a, b, key, inverse)))
        return F.when(y < n, y).otherwise(on)

    return F.transform(F.array(_network(x, a, b, key, inverse)), walk)[0]


def _key(epoch, seed: int) -> Column:
    epoch = epoch if isinstance(epoch, Column) else F.lit(int(epoch))
    return F.concat(F.lit(f"{seed}:"), epoch.cast("string"))


def epoch_row(position: Column, n: Column, epoch, seed: int = SEED) -> Column:
    """The row number that the epoch has at ``position`` of 0 … n−1."""
    return _permuted(position.cast("long"), n.cast("long"), _key(epoch, seed), False)


def epoch_position(row: Column, n: Column, epoch, seed: int = SEED) -> Column:
    """The position in the epoch of row ``row`` of 0 … n−1: the inverse of ``epoch_row``."""
    return _permuted(row.cast("long"), n.cast("long"), _key(epoch, seed), True)


def number_rows(df: DataFrame, order_cols: Sequence[str], group_cols: Sequence[str] = ("split",), name: str = "row_no") -> DataFrame:
    """Number the rows of each group once, in key order; all epochs start from these numbers."""
    return row_index(df, list(order_cols), group_cols=group_cols, name=name, enumerated_groups=list(group_cols) == ["split"])


def epoch_shards(
    df: DataFrame,
    epoch,
    world: int,
    rank: int | None = None,
    group_cols: Sequence[str] = ("split",),
    row_col: str = "row_no",
    sizes: DataFrame | None = None,
    shuffled: Column | None = None,
    seed: int = SEED,
) -> DataFrame:
    """WIN-3 + WIN-4 + SET-2 for one epoch of numbered rows: adds ``pos`` (place in the epoch's order),
    ``copy``, ``rank`` and ``local_pos``.

    The order is the keyed permutation where ``shuffled`` holds (everywhere by default), else
    the row numbers.  As in a distributed sampler the order is extended to a multiple of
    ``world`` by rows from its head (``copy`` above 0), position p goes to rank p mod world.
    With ``rank`` only that rank's rows are returned: a filter of the scan, before anything
    is moved.  ``sizes`` (group, n) saves counting the groups anew in each epoch; groups
    are few (splits)."""
    group_cols = list(group_cols)
    if sizes is None:
        sizes = df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("n"))
    x = _with_groups(df, sizes.select(*group_cols, F.col("n").cast("long").alias("_n")), group_cols)
    n, row = F.col("_n"), F.col(row_col).cast("long")
    place = epoch_position(row, n, epoch, seed)
    if shuffled is not None:
        place = F.when(shuffled, place).otherwise(row)
    x = x.withColumn("pos", place)
    total = F.ceil(n / F.lit(world)) * F.lit(world)
    last = F.floor((total - 1 - F.col("pos")) / n).cast("long")
    x = x.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    p = F.col("pos") + F.col("copy") * n
    x = x.withColumn("rank", F.pmod(p, F.lit(world)).cast("int")).withColumn("local_pos", F.floor(p / F.lit(world)).cast("long"))
    return (x if rank is None else x.where(F.col("rank") == rank)).drop("_n")
