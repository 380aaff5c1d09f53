from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from lexiflow.operators import runs as rn


def _log(spark, rows):
    return spark.createDataFrame(rows, "run string, epoch int, metric string, value double")


ROWS = [
    ("a", 0, "bleu", 10.0), ("a", 1, "bleu", 12.0), ("a", 2, "bleu", 12.0), ("a", 3, "bleu", None),
    ("a", 0, "loss", 2.0), ("a", 1, "loss", 1.5), ("a", 2, "loss", 1.5),
    ("b", 0, "bleu", 5.0),
]


def test_best_checkpoint_ties_nulls_modes(spark):
    mx = {r.run: (r.epoch, r.value) for r in rn.best_checkpoint(_log(spark, ROWS), "bleu", "max").collect()}
    assert mx == {"a": (1, 12.0), "b": (0, 5.0)}  # tie -> earliest epoch, null never wins
    mn = {r.run: (r.epoch, r.value) for r in rn.best_checkpoint(_log(spark, ROWS), "loss", "min").collect()}
    assert mn == {"a": (1, 1.5)}


def test_best_checkpoint_top_k(spark):
    got = sorted((r.run, r.rank, r.epoch) for r in rn.best_checkpoint(_log(spark, ROWS), "bleu", "max", k=5).collect())
    assert got == [("a", 1, 1), ("a", 2, 2), ("a", 3, 0), ("b", 1, 0)]  # k larger than the epochs


def test_hot_run_topk_matches_sort(spark):
    big = spark.range(0, 5000).select(F.lit("hot").alias("run"), F.col("id").cast("int").alias("epoch"), F.lit("m").alias("metric"),
                                      ((F.col("id") * 37) % 101).cast("double").alias("value"))
    got = [(r.epoch, r.value) for r in rn.best_checkpoint(big, "m", "max", k=4).orderBy("rank").collect()]
    rows = sorted(((r.epoch, r.value) for r in big.collect()), key=lambda x: (-x[1], x[0]))[:4]
    assert got == rows


def test_compare_and_long(spark):
    w = rn.compare_runs(_log(spark, ROWS), ["bleu", "loss", "missing"])
    got = {r.run: (r.bleu, r.loss, r.missing) for r in w.collect()}
    assert got == {"a": (12.0, 2.0, None), "b": (5.0, None, None)}
    s = rn.scale_units(w, {"bleu_pct": ("bleu", 100.0)}).where("run = 'a'").first()
    assert s.bleu_pct == pytest.approx(1200.0)
    long = rn.metric_long(w, ["bleu", "loss"]).collect()
    assert len(long) == 4


def test_join_name_values_shortest_wins(spark):
    df = spark.createDataFrame([(["vloss", "vaccuracy", "BLEU"], [0.5, 0.9])], "names array<string>, vals array<double>")
    got = [(r.name, r.value) for r in rn.join_name_values(df, "names", "vals").collect()]
    assert got == [("vloss", 0.5), ("vaccuracy", 0.9)]


def test_append_metrics_roundtrip(spark, tmp_path):
    path = str(tmp_path / "log")
    rn.append_metrics(_log(spark, ROWS).drop("run"), path, run="r1", version=0)
    rn.append_metrics(_log(spark, ROWS[:2]).drop("run"), path, run="r1", version=1)
    back = spark.read.parquet(path)
    assert back.count() == len(ROWS) + 2
    assert {r.version for r in back.select("version").distinct().collect()} == {0, 1}


@pytest.mark.parametrize("mode,want", [("max", 30.0), ("min", 10.0)])
@pytest.mark.parametrize("k", [1, 2])
def test_nan_never_wins(spark, mode, want, k):
    rows = [(1, 0, "m", 10.0), (1, 1, "m", float("nan")), (1, 2, "m", 30.0), (1, 3, "m", None), (2, 0, "m", float("nan"))]
    df = spark.createDataFrame(rows, "run long, epoch int, metric string, value double")
    best = {(r.run, r["rank"]): r.value for r in rn.best_checkpoint(df, "m", mode=mode, k=k).collect()}
    assert best[1, 1] == want and len(best) == k


def test_compare_with_the_best_checkpoints_example(spark):
    rows = [("a", 0, "bleu", 1.0, "one"), ("a", 1, "bleu", 3.0, "two"), ("a", 2, "bleu", 3.0, "three"), ("a", 2, "loss", 9.0, "no"),
            ("a", 3, "bleu", float("nan"), "nan"), ("a", 4, "bleu", None, "null"), ("b", 0, "loss", 1.0, "x"), ("a", 1, "bleu", 3.0, "tie")]
    df = spark.createDataFrame(rows, "run string, epoch int, metric string, value double, text string")
    got = {r.run: (r.loss, r.best_epoch, r.text, r.n) for r in rn.compare_runs(df, ["loss"], best="bleu", examples=["text"], totals={"n": F.count("*")}).collect()}
    assert got == {"a": (9.0, 1, "tie", 7), "b": (1.0, None, None, 1)}  # equal values: earliest epoch, then the smaller example
    low = {r.run: (r.best_epoch, r.text) for r in rn.compare_runs(df, [], best="bleu", mode="min", examples=["text"]).collect()}
    assert low == {"a": (0, "one"), "b": (None, None)}


def test_versions_are_claimed_once_and_batches_replace_themselves(spark, tmp_path):
    path = str(tmp_path / "log")
    with ThreadPoolExecutor(8) as pool:
        claimed = list(pool.map(lambda _: rn.claim_version(spark, path, "r/1"), range(16)))
    assert sorted(claimed) == list(range(16))
    assert rn.claim_version(spark, path, "other") == 0
    rows = _log(spark, ROWS).drop("run")
    for version, batch, n in ((0, 0, 3), (0, 1, 2), (0, 1, 2), (1, 0, 5), (0, 0, 3)):
        rn.append_batch(rows.limit(n), path, "r/1", version, batch)
    log = rn.read_log(spark, path)
    assert {(r.version, r.batch): r["count"] for r in log.groupBy("version", "batch").count().collect()} == {(0, 0): 3, (0, 1): 2, (1, 0): 5}
    assert {r.run for r in log.collect()} == {"r/1"}
