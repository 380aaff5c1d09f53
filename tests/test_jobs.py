import math

import pytest
from pyspark.sql import functions as F

from lexiflow.operators import overlap
from lexiflow.plans import jobs
from lexiflow.sources import fixtures as fx
from tests import plain
from tests.conftest import SF_SMALL


def test_prepare_corpus_sharded_and_written(spark, tmp_path):
    pairs = fx.pairs(spark, SF_SMALL)
    vocab = fx.vocab(spark, SF_SMALL)
    out = str(tmp_path / "prepared")
    world, batch = 2, 4
    df = jobs.prepare_corpus(pairs, vocab, max_src=170, max_tgt=170, batch_size=batch, world=world, out_path=out)
    rows = df.collect()
    kept = {}
    for r in rows:
        kept.setdefault(r.split, set()).add(r.line_no)
    for split, ids in kept.items():
        per_rank = {}
        for r in rows:
            if r.split == split:
                per_rank[r.rank] = per_rank.get(r.rank, 0) + 1
        assert set(per_rank.values()) == {math.ceil(len(ids) / world)}  # every rank gets the same count
    widths = {}
    for r in rows:
        key = (r.split, r.rank, r.batch_id)
        widths.setdefault(key, set()).add((len(r.src_ids), len(r.src_mask), len(r.tgt_ids), len(r.tgt_mask)))
    for key, w in widths.items():
        assert len(w) == 1, key  # padded to one width per batch and column
        (s, sm, t, tm), = w
        assert s == sm and t == tm
    back = spark.read.parquet(out)
    assert back.count() == len(rows)
    assert back.where(F.col("split") == "train").count() == sum(1 for r in rows if r.split == "train")


def test_translation_from_files_on(spark, tmp_path):
    for split, n in (("train", 5), ("test", 2)):
        for side, mark in (("en", "a"), ("es", "b")):
            (tmp_path / f"{split}.{side}").write_text("".join(f" {mark} {'c ' * i}\n" for i in range(n)))
    vocab = spark.createDataFrame([("a", 4), ("b", 5), ("c", 6)], "token string, id int")
    prefixes = {s: str(tmp_path / s) for s in ("train", "test")}
    out = jobs.prepare_translation(spark, prefixes, "en", "es", vocab, max_src=6, max_tgt=6, batch_size=2, specials={"tgt_ids": ((), (2, 99))})
    rows = {(r.split, r.line_no): r for r in out.collect()}
    assert sorted(rows) == [("test", 0), ("test", 1), ("train", 0), ("train", 1), ("train", 2), ("train", 3)]  # both sides within 6 ids
    for (split, line), r in rows.items():
        n = line + 1
        assert [i for i, m in zip(r.src_ids, r.src_mask) if m] == [0, 4, *[6] * line, 2]
        assert [i for i, m in zip(r.tgt_ids, r.tgt_mask) if m] == [5, *[6] * line, 2, 99]
        mates = [x for (s, _), x in rows.items() if s == split and x.batch_id == r.batch_id]
        assert len(r.src_ids) == max(sum(x.src_mask) for x in mates) and set(r.src_ids[n + 2 :]) <= {1}
    (tmp_path / "test.es").write_text("b\n")
    with pytest.raises(Exception, match="not aligned"):
        jobs.prepare_translation(spark, prefixes, "en", "es", vocab).collect()


@pytest.mark.parametrize("bos,eos,pad", [(0, 2, 1), (None, 1, 0)])
def test_summaries_of_two_families(spark, bos, eos, pad):
    vocab = spark.createDataFrame([(f"w{i}", 10 + i) for i in range(9)], "token string, id int")
    rows = [("train", i, " ".join(f"w{k}" for k in range(i)), "w1 w2 w3 w4 w5") for i in range(9)]
    df = spark.createDataFrame(rows, "split string, row_id long, document string, summary string")
    out = jobs.prepare_summaries(df, vocab, max_in=6, max_out=4, batch_size=4, bos_id=bos, eos_id=eos).collect()
    first = [] if bos is None else [bos]
    for r in out:
        body = [10 + k for k in range(r.row_id)][: 6 - 1 - len(first)]
        ids = [*first, *body, eos]
        width = max(len([*first, *range(x.row_id)][: 6 - 1]) + 1 for x in out if x.batch_id == r.batch_id)
        assert r.pad_id == pad and r.input_ids == ids + [pad] * (width - len(ids))
        assert r.output_ids == ([pad] if bos is None else []) + [*first, *[11, 12, 13][: 3 - len(first)], eos]
    assert sorted(len([x for x in out if x.batch_id == b]) for b in {x.batch_id for x in out}) == [1, 4, 4]


def test_rouge_l_of_the_longest_documents(spark):
    pairs = fx.doc_pairs(spark, SF_SMALL)
    longest = pairs.orderBy(F.desc(F.length("pred") + F.length("ref"))).limit(6).collect()
    got = {r.pair_id: r.rougeL for r in overlap.rouge_l(pairs, id_cols=["pair_id"]).collect()}
    for r in longest:
        assert got[r.pair_id] == pytest.approx(plain.rouge_l(r.ref, r.pred), abs=1e-9)


def test_summary_texts_move_once_to_their_scores(spark):
    """Decoded texts are spread over the tasks already: only the grouping of their n-gram counts moves them."""
    vocab = spark.createDataFrame([(f"w{i}", 4 + i) for i in range(9)], "token string, id int")
    rows = [("train", i, " ".join(f"w{k % 9}" for k in range(i + 2)), " ".join(f"w{(k + i) % 9}" for k in range(6))) for i in range(9)]
    df = spark.createDataFrame(rows, "split string, row_id long, document string, summary string")
    scores = spark.createDataFrame([(0, 0, 0, 0, [0.1, 0.9], 1)], "batch_id long, example long, pos int, rank int, scores array<double>, label int")
    out = jobs.evaluate_summaries(df, vocab, jobs.stub_factory(vocab), scores)
    assert "RepartitionByExpression" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert [r.split for r in out.collect()] == ["train"]
    texts = df.select("row_id", F.col("document").alias("pred"), F.col("summary").alias("ref"))
    got, want = ({r.row_id: r for r in overlap.rouge_pair_scores(texts, id_cols=["row_id"], dealt=d).collect()} for d in (True, False))
    assert got == want and len(got) == 9
