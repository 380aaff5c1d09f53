import numpy as np
import pytest
from pyspark.sql import functions as F

from lexiflow.operators import infer, runs
from lexiflow.plans import jobs
from lexiflow.streaming import metrics as sm


def test_stub_generate(spark):
    df = spark.createDataFrame([([0, 4, 3, 9, 2, 1], [1, 1, 1, 1, 1, 0])], "input_ids array<int>, attention_mask array<int>")
    g = infer.generate_batches(df, infer.stub_model(last_id=9), max_len=4, start_id=0).first()
    assert list(g.generated_ids) == [0, 5, 4, 2]  # 4->5, unknown dropped, 9 wraps to 4, cut at max_len


@pytest.mark.parametrize("batch_size,buffer", [(1, 1), (3, 10), (8, 40), (100, 10_000)])
def test_the_model_sees_padded_matrices(spark, batch_size, buffer):
    rows = [(i, [4 + (i * k) % 5 for k in range(i % 13)]) for i in range(60)] + [(99, None)]
    df = spark.createDataFrame(rows, "row_id long, input_ids array<int>").repartition(2)

    def make():
        def model(ids, masks, start_id, max_len):
            assert ids.shape == masks.shape and ids.dtype == np.int64 and 1 <= len(ids) <= batch_size
            lengths = masks.sum(1)
            assert ids.shape[1] == lengths.max(initial=0)  # padded to the longest, not further
            assert (ids[masks == 0] == 1).all() and all((m[:n] == 1).all() for m, n in zip(masks, lengths))
            return [[start_id, *row[:n][::-1].tolist(), len(ids)][:max_len] for row, n in zip(ids, lengths)]

        return model

    got = {r.row_id: r.generated_ids[:-1] for r in infer.generate_batches(df, make, mask_col=None, batch_size=batch_size, buffer_tokens=buffer, start_id=7).collect()}
    assert got == {i: [7, *(ids or [])[::-1]] for i, ids in rows}


def test_length_buckets_bound_the_matrix():
    lengths = np.array([5, 0, 700, 3, 3, 9, 400, 400])
    found = infer.length_buckets(lengths, batch_size=4, cells=800)
    assert sorted(i for b in found for i in b) == list(range(8))
    assert all(len(b) <= 4 and (len(b) == 1 or len(b) * lengths[b].max() <= 800) for b in found)
    assert found[0].tolist() == [1, 3, 4, 0]  # neighbours in length share a matrix
    assert infer.length_buckets(np.zeros(0, int), 4) == []


def test_infer_text_one_row(spark):
    vocab = spark.createDataFrame([("a", 4), ("b", 5), ("c", 6)], "token string, id int")
    df = spark.createDataFrame([(0, "  a b c z ")], "row_id long, text string")
    out = jobs.infer_text(df, "text", vocab, infer.stub_model(6), strip=True, max_len=10).first()
    assert out.text == "b c a"


def test_running_best_stream_equals_batch(spark, tmp_path):
    log = str(tmp_path / "log")
    rows = [(e, "bleu", float(v)) for e, v in enumerate([3, 9, 9, 4, 11, 2])]
    half = spark.createDataFrame(rows[:3], "epoch int, metric string, value double")
    runs.append_metrics(half, log, run="r", version=0)
    stream = sm.read_metric_stream(spark, log)
    q = sm.running_best(stream, "bleu", "max").writeStream.outputMode("complete").format("memory").queryName("best_bleu").start()
    try:
        q.processAllAvailable()
        assert [(r.epoch, r.value) for r in spark.sql("select * from best_bleu").collect()] == [(1, 9.0)]
        runs.append_metrics(spark.createDataFrame(rows[3:], "epoch int, metric string, value double"), log, run="r", version=0)
        q.processAllAvailable()
        got = [(r.epoch, r.value) for r in spark.sql("select * from best_bleu").collect()]
    finally:
        q.stop()
    full = spark.createDataFrame([("r",) + r for r in rows], "run string, epoch int, metric string, value double")
    exp = [(r.epoch, r.value) for r in runs.best_checkpoint(full, "bleu", "max").collect()]
    assert got == exp == [(4, 11.0)]


def test_streaming_metric_log_sink(spark, tmp_path):
    src = str(tmp_path / "incoming")
    out = str(tmp_path / "log")
    rows = spark.createDataFrame([(0, "bleu", 1.0, "r", 0), (1, "bleu", 2.0, "r", 0)], sm.METRIC_SCHEMA)
    rows.write.parquet(src)
    q = sm.start_metric_log(sm.read_metric_stream(spark, src), out, name=f"log-{tmp_path.name}", trigger_once=True)
    q.awaitTermination(120)
    back = spark.read.parquet(out)
    assert sorted((r.epoch, r.value) for r in back.collect()) == [(0, 1.0), (1, 2.0)]
    assert "run" in back.columns


def test_running_best_min_mode(spark, tmp_path):
    log = str(tmp_path / "loss_log")
    rows = spark.createDataFrame([(0, "loss", 2.0), (1, "loss", 1.0), (2, "loss", 1.0), (3, "loss", None)],
                                 "epoch int, metric string, value double")
    runs.append_metrics(rows, log, run="r", version=0)
    q = sm.running_best(sm.read_metric_stream(spark, log), "loss", "min").writeStream.outputMode("complete") \
        .format("memory").queryName("best_loss").start()
    try:
        q.processAllAvailable()
        got = [(r.epoch, r.value) for r in spark.sql("select * from best_loss").collect()]
    finally:
        q.stop()
    assert got == [(1, 1.0)]  # tie keeps the earlier epoch; null never wins


def test_stream_log_adds_a_retried_batch_once(spark, tmp_path):
    log, source = str(tmp_path / "log"), str(tmp_path / "source")
    rows = [(e, "bleu", float(e)) for e in range(6)]
    spark.createDataFrame(rows[:4], "epoch int, metric string, value double").write.parquet(source)
    stream = spark.readStream.schema("epoch int, metric string, value double").parquet(source)

    def run(name):
        q = sm.start_versioned_log(stream, log, "r", 0, name=name, trigger_once=True)
        assert q.awaitTermination(60)

    name = f"ckpt-{tmp_path.name}"
    run(name)
    spark.createDataFrame(rows[4:], "epoch int, metric string, value double").write.mode("append").parquet(source)
    run(name)
    assert sorted(r.epoch for r in runs.read_log(spark, log).collect()) == [0, 1, 2, 3, 4, 5]
    run(name + "-lost")  # the progress was lost: batch 0 comes again, with all rows, and replaces the first one
    assert [(r.batch, r["count"]) for r in runs.read_log(spark, log).groupBy("batch").count().orderBy("batch").collect()] == [(0, 6), (1, 2)]
