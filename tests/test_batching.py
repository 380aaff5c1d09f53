import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lexiflow.operators import batching as bt
from lexiflow.operators.ordering import bounds_below, equi_depth_bounds, row_index
from lexiflow.plans.catalog import QUERIES
from tests import plain
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_row_index_equals_window(spark, parts):
    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 7 < 5, F.lit("hot")).otherwise(F.concat(F.lit("g"), (F.col("id") % 3).cast("string"))).alias("g"),
        ((F.col("id") * 7919) % 3001).alias("k"),
    ).repartition(parts)
    got = row_index(df, ["k"], group_cols=["g"], name="pos", num_buckets=8)
    exp = df.withColumn("pos", F.row_number().over(Window.partitionBy("g").orderBy("k")) - 1)
    assert sorted(map(tuple, got.select("g", "k", "pos").collect())) == sorted(map(tuple, exp.select("g", "k", "pos").collect()))


def test_an_outlier_leaves_no_crowded_bucket(spark):
    keys = spark.range(0, 4000).select(F.when(F.col("id") == 0, F.lit(10**15)).otherwise(F.col("id") ** 2).cast("long").alias("k"))
    b = F.array(*map(F.lit, keys.agg(equi_depth_bounds("k", 16)).first()[0]))
    sizes = [r["count"] for r in keys.select(bounds_below(b, F.col("k"), 16).alias("bucket")).groupBy("bucket").count().collect()]
    assert len(sizes) == 16 and max(sizes) <= 2 * 4000 / 16
    got = {r.k: r.pos for r in row_index(keys, ["k"], num_buckets=16).collect()}
    assert got == {k: i for i, k in enumerate(sorted(got))}


def test_row_index_with_null_groups_and_keys(spark):
    rows = [(None, i if i else None) for i in range(300)] + [("a", i) for i in range(7)]
    df = spark.createDataFrame(rows, "g string, k int")
    got = sorted((r.g or "", r.k or -1, r.pos) for r in row_index(df, ["k"], group_cols=["g"], num_partitions=3).collect())
    assert got == sorted([("", i or -1, i) for i in range(300)] + [("a", i or -1, i) for i in range(7)])


def test_shuffle_is_partition_independent(spark):
    base = spark.range(0, 500).select(F.col("id").alias("row_id"), F.lit("train").alias("split"))
    a = {r.row_id: r.pos for r in bt.shuffle_rows(base.repartition(1)).collect()}
    b = {r.row_id: r.pos for r in bt.shuffle_rows(base.repartition(13)).collect()}
    assert a == b and sorted(a.values()) == list(range(500))


@pytest.mark.parametrize("n,world", [(8, 4), (10, 4), (3, 4), (1, 5), (7, 3)])
def test_shard_rows_matches_sampler(spark, n, world):
    df = spark.range(0, n).select(F.lit("s").alias("split"), F.col("id").alias("pos"))
    got = bt.shard_rows(df, world).collect()
    for rank in range(world):
        mine = [r.pos for r in sorted((r for r in got if r.rank == rank), key=lambda r: r.local_pos)]
        assert mine == plain.sampler_indices(n, world, rank)


def test_pad_batch_each_column_separately(spark):
    df = spark.createDataFrame(
        [(0, [5, 6, 2], [1, 1, 1]), (0, [5, 2], [1, 1]), (1, [7, 2], [1, 1])], "batch_id long, ids array<int>, m array<int>"
    ).withColumn("split", F.lit("s"))
    got = sorted((r.batch_id, list(r.ids), list(r.m)) for r in bt.pad_batch(df, {"ids": 1, "m": 0}).collect())
    assert got == [(0, [5, 2, 1], [1, 1, 0]), (0, [5, 6, 2], [1, 1, 1]), (1, [7, 2], [1, 1])]


def test_infer_pad_id(spark):
    ok = spark.createDataFrame([("s", 0, 0, [0, 5, 2]), ("s", 0, 1, [0, 9]), ("s", 1, 4, [5, 1])], "split string, batch_id long, pos long, input_ids array<int>")
    got = {r.batch_id: r.pad_id for r in bt.infer_pad_id(ok).collect()}
    assert got == {0: 1, 1: 0}
    bad = spark.createDataFrame([("s", 0, 0, [0, 7])], "split string, batch_id long, pos long, input_ids array<int>")
    with pytest.raises(Exception, match="cannot infer pad id"):
        bt.infer_pad_id(bad).collect()


def test_batches_volume_and_limit(spark):
    df = spark.range(0, 10).select(F.lit("s").alias("split"), F.col("id").alias("pos"), F.array_repeat(F.lit(1), (F.col("id") % 3 + 1).cast("int")).alias("ids"))
    b = bt.assign_batches(df, 4)
    assert sorted({r.batch_id for r in b.collect()}) == [0, 1, 2]
    v = {r.batch_id: r for r in bt.batch_volume(b, ["ids"]).collect()}
    assert v[2].n_rows == 2 and v[0].ids_volume == 4 * 3
    assert sorted(r.pos for r in bt.limit_batches(b, 1).collect()) == [0, 1, 2, 3]


def test_pad_batch_equal_lengths_unchanged(spark):
    df = spark.createDataFrame([(0, [5, 6, 2]), (0, [7, 8, 2])], "batch_id long, ids array<int>").withColumn("split", F.lit("s"))
    got = sorted(list(r.ids) for r in bt.pad_batch(df, {"ids": 1}).collect())
    assert got == [[5, 6, 2], [7, 8, 2]]


def test_row_index_enumerated_groups(spark):
    df = spark.range(0, 2000).select(F.when(F.col("id") % 10 == 0, "test").otherwise("train").alias("split"),
                                     ((F.col("id") * 7919) % 2003).alias("k"))
    got = row_index(df, ["k"], group_cols=["split"], enumerated_groups=True, num_buckets=8)
    exp = df.withColumn("pos", F.row_number().over(Window.partitionBy("split").orderBy("k")) - 1)
    assert sorted(map(tuple, got.select("split", "k", "pos").collect())) == sorted(map(tuple, exp.collect()))


def test_batch_volume_takes_lengths_for_arrays(spark):
    rows = [("a", 0, [1, 2, 3], [9]), ("a", 0, [4], [9, 9]), ("a", 1, [], [5]), ("b", 0, [7, 7], [8])]
    df = spark.createDataFrame(rows, "split string, batch_id long, x array<int>, y array<int>")
    lengths = df.select("split", "batch_id", F.size("x").alias("x"), F.size("y").alias("y"))
    got, exp = bt.batch_volume(lengths, ["x", "y"]), bt.batch_volume(df, ["x", "y"])
    assert got.schema == exp.schema and sorted(map(str, got.collect())) == sorted(map(str, exp.collect()))


@pytest.mark.parametrize(("query", "most"), [("batch_volume", 0), ("pad_id_inferred", 1)])
def test_only_what_a_batch_is_judged_by_is_shuffled(spark, monkeypatch, query, most):
    """Elements of a row's arrays that move to its batch."""
    shuffle, seen = bt.shuffle_rows, []

    def counted(df, **options):
        arrays = [F.size(c) for c, kind in df.dtypes if kind.startswith("array")]
        seen.append(df.agg(F.max(sum(arrays, F.lit(0)))).first()[0])
        return shuffle(df, **options)

    monkeypatch.setattr(bt, "shuffle_rows", counted)
    assert QUERIES[query](spark, SF_SMALL).count() > 0
    assert seen == [most]
