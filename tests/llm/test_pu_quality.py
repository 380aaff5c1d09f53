"""Operator 6: held-out accuracy, the risk's non-negative bracket, and edge cases."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from lexiflow.llm import pu_quality as Q
from lexiflow.llm.queries import op6_pu_quality
from tests.conftest import SF_MID

SF_LARGE = "/root/testdata/sf0.1"


def test_held_out_accuracy_and_fold(spark):
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()}
    rows = op6_pu_quality(spark, SF_MID).collect()
    assert len(rows) == spark.read.parquet(f"{SF_MID}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for r in rows if r.held_out and r.doc_id in quality]
    assert np.mean([r.predicted == quality[r.doc_id] for r in held]) >= 0.97


def test_good_documents_stay(spark):
    """Measured where a per cent is several documents: sf0.01 has 99 good held-out ones, of which 99 % would be all."""
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_LARGE}/labels.parquet").collect()}
    good = [r.predicted for r in op6_pu_quality(spark, SF_LARGE).collect() if r.held_out and quality.get(r.doc_id) == 1]
    assert len(good) >= 1000 and np.mean(good) >= 0.99


def test_held_out_labels_are_never_read(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    flipped = labels.withColumn("quality", F.when(Q.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted((r.doc_id, round(r.score, 9)) for r in Q.score_quality(docs, x).collect()) for x in (labels, flipped))
    assert a == b


def small(spark):
    good = [(i, f"This is a plain sentence number {i}. It goes on, quietly, to its end.", "a") for i in range(60)]
    junk = [(100 + i, "BUY!! NOW!! " * 30 + "%%% ### $$$", "b") for i in range(15)]
    odd = [(200, None, None), (201, "", "c"), (202, "  \n ", "c"), (203, "word " * 50000, "c"), (None, "no id here. Just text.", None), (3, good[3][1], "again")]
    docs = spark.createDataFrame(good + junk + odd, "doc_id long, text string, f string")
    labels = spark.createDataFrame([(i, 1) for i in range(40)] + [(100 + i, 0) for i in range(8)] + [(None, 1), (3, 1), (999, 0)], "doc_id long, quality int")
    return docs, labels


def test_edges_and_filter(spark):
    docs, labels = small(spark)
    rows = Q.score_quality(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert sum(r.doc_id == 3 for r in rows) == 2
    kept = Q.keep_good(docs, labels)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert set(range(60)) <= ids and not ids & set(range(100, 115))


def test_no_positives_no_negatives_no_rows(spark):
    docs, labels = small(spark)
    assert {r.score for r in Q.score_quality(docs, labels.limit(0)).collect()} == {0.5}
    assert all(0 <= r.score <= 1 for r in Q.score_quality(docs, labels.where("quality = 1")).collect())
    assert Q.score_quality(docs.limit(0), labels).count() == 0 and Q.keep_good(docs.limit(0), labels).count() == 0


def test_bracket_stays_non_negative(spark):
    docs, labels = small(spark)
    rows = Q._labelled(docs, labels, "doc_id", "text").select("f", "good")
    model = Q.fit(rows)
    got = rows.collect()
    x = model.design(np.array([r.f for r in got])) @ model.weights
    good = np.array([r.good == 1 for r in got])
    assert np.logaddexp(0, x).mean() - model.prior * np.logaddexp(0, x[good]).mean() >= -1e-9
    assert abs(model.prior - good.sum() / (good.sum() + sum(r.good == 0 for r in got))) < 1e-9
