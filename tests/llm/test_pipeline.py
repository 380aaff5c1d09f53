"""The pipeline: each stage on its own input, the whole run, and tables with odd rows."""

import corpus_pipeline as P
import sentencepiece
from pyspark.sql import functions as F

from lexiflow.llm import credentials, decontaminate, order_minhash
from lexiflow.llm.queries import PIECE_MODEL
from tests.conftest import SF_SMALL


def test_stages_take_effect_and_keep_columns(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in P.STAGES] == ["quality", "near_duplicates", "decontamination", "secrets", "encoding"]
    left = {}
    for name, stage in P.STAGES:
        out = stage(spark, docs, SF_SMALL).persist()
        left[name] = out.count()
        if name != "encoding":
            assert out.columns == columns
        if name == "near_duplicates":
            classes = {r.doc_id: r.class_id for r in order_minhash.near_duplicates(docs).collect()}
            assert {r.doc_id for r in out.collect()} == set(classes.values())
        if name == "decontamination":
            gone = {r.doc_id for r in decontaminate.leaks(docs, spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")).collect()}
            assert {r.doc_id for r in docs.collect()} - {r.doc_id for r in out.collect()} == gone
        if name == "secrets":
            assert out.count() == docs.count()
            assert credentials.find_secrets(out).where(F.size("spans") > 0).count() == 0
            assert out.where("n_chars != length(text)").count() == docs.where("n_chars != length(text)").count()
        docs = out
    assert left["quality"] > left["near_duplicates"] >= left["decontamination"] == left["secrets"] == left["encoding"] > 0


def test_run(spark):
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    rows = P.run(spark, SF_SMALL).collect()
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    assert rows and len({r.doc_id for r in rows}) == len(rows)
    plain = [r for r in rows if not credentials.strong_parts(text[r.doc_id])]
    assert plain and all(list(r.ids) == lib.encode(text[r.doc_id], add_bos=True, add_eos=True) for r in plain)


def test_odd_rows_and_empty_tables(spark):
    rows = [
        (1, None, None, None, None, "e"), (2, "", "en", "s", 0, "e"), (None, "some words without an id, here.", None, "s", 3, None),
        (3, "long " * 40000, "en", "s", 1, "e"), (4, "Plain words stand here. They go on.", "en", "s", 1, "e"), (4, "Plain words stand here. They go on.", "en", "s", 1, "e"),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, spans string"
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for name, stage in P.STAGES:
            out = stage(spark, docs, SF_SMALL)
            assert name == "encoding" or out.columns == docs.columns
            assert out.count() <= docs.count()
