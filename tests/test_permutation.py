"""Keyed permutations: bijection, inverse, plain twin, and shards equal to a sampler's."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from lexiflow.operators import permutation as pm
from tests import plain


def plain_row(i, n, key):
    a = math.ceil(math.sqrt(n))
    b = (n + a - 1) // a
    draw = lambda turn, v: int(hashlib.md5(f"{key}:{turn}:{v}".encode()).hexdigest()[:15], 16)

    def network(x):
        left, right = divmod(x, b)
        for turn in range(pm.ROUNDS):
            if turn % 2:
                left = (left + draw(turn, right)) % a
            else:
                right = (right + draw(turn, left)) % b
        return left * b + right

    x = network(i)
    while x >= n:
        x = network(x)
    return x


@pytest.mark.parametrize("n", [1, 2, 3, 5, 10, 17, 101, 1000, 4097])
def test_permutation_and_inverse(spark, n):
    df = spark.range(n).select("id", pm.epoch_row(F.col("id"), F.lit(n), 3, 7).alias("row"))
    rows = df.withColumn("back", pm.epoch_position(F.col("row"), F.lit(n), 3, 7)).collect()
    assert sorted(r.row for r in rows) == list(range(n))
    assert all(r.back == r.id for r in rows)
    assert all(r.row == plain_row(r.id, n, "7:3") for r in rows[:200])


def test_epochs_differ_and_look_random(spark):
    n = 2000
    df = spark.range(n).select(*[pm.epoch_row(F.col("id"), F.lit(n), e).alias(f"e{e}") for e in (0, 1)])
    rows = df.collect()
    assert sum(r.e0 == r.e1 for r in rows) < 20  # one is expected
    moves = [abs(r.e0 - i) for i, r in enumerate(rows)]
    assert 0.28 * n < sum(moves) / n < 0.39 * n  # a random permutation moves a row by n / 3 on average
    rises = sum(rows[i].e0 < rows[i + 1].e0 for i in range(n - 1))
    assert 0.45 * n < rises < 0.55 * n


@pytest.mark.parametrize("n,world", [(8, 4), (10, 4), (3, 4), (1, 5), (7, 3)])
def test_shards_are_those_of_a_sampler(spark, n, world):
    df = spark.range(n).select(F.lit(None).cast("string").alias("split"), F.col("id").alias("row_no"))  # a null group is one
    got = pm.epoch_shards(df, 2, world).collect()
    order = [plain_row(p, n, f"{pm.SEED}:2") for p in range(n)]
    for rank in range(world):
        mine = [r.row_no for r in sorted((r for r in got if r["rank"] == rank), key=lambda r: r.local_pos)]
        assert mine == [order[p] for p in plain.sampler_indices(n, world, rank)]
        own = pm.epoch_shards(df, 2, world, rank=rank, sizes=df.groupBy("split").agg(F.count("*").alias("n")))
        assert sorted(r.row_no for r in own.collect()) == sorted(mine)


def test_only_shuffled_groups_are_permuted(spark):
    df = spark.range(40).select(F.when(F.col("id") < 30, F.lit("train")).otherwise(F.lit("test")).alias("split"), (F.col("id") * 3).alias("k"))
    got = pm.epoch_shards(pm.number_rows(df, ["k"]), 0, 2, shuffled=F.col("split") == "train").where("copy = 0").collect()
    test = sorted((r.pos, r.k) for r in got if r.split == "test")
    assert [k for _, k in test] == sorted(k for _, k in test)
    train = sorted((r.pos, r.k) for r in got if r.split == "train")
    assert [p for p, _ in train] == list(range(30)) and [k for _, k in train] != sorted(k for _, k in train)


def test_an_epoch_needs_no_exchange(spark):
    df = spark.range(100).select(F.lit("train").alias("split"), F.col("id").alias("row_no"))
    sizes = spark.createDataFrame([("train", 100)], "split string, n long")
    plan = pm.epoch_shards(df, 1, 4, rank=2, sizes=sizes)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "rangepartitioning" not in plan and "Sort" not in plan
