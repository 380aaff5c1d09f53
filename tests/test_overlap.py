import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexiflow.functions import lcs
from lexiflow.operators import overlap as ov
from lexiflow.sources import fixtures as fx
from tests import plain
from tests.conftest import SF_SMALL


def _bleu(spark, pairs):
    df = spark.createDataFrame([(i, h, r) for i, (h, r) in enumerate(pairs)], "pair_id long, pred string, ref string")
    return ov.corpus_bleu(df).first()


@pytest.mark.parametrize(
    "pairs",
    [
        [("the cat sat on the mat", "the cat sat on the mat")],
        [("a b c d", "e f g h")],
        [("a b", "a b")],
        [("a b c d e", "a b c x e")],
        [("the cat", "the cat sat on the mat today")],
        [("the cat sat on the mat today and more words here", "the cat sat")],
        [("Hello, world. 3.14 is pi!", "Hello world, 3.14 is pi.")],
        [("", "something"), ("x y z w", "x y z w")],
    ],
)
def test_bleu_edge_cases(spark, pairs):
    got = _bleu(spark, pairs)
    score, m, t, sl, rl = plain.corpus_bleu([h for h, _ in pairs], [r for _, r in pairs])
    assert [got[f"m{n}"] for n in range(1, 5)] == m
    assert [got[f"t{n}"] for n in range(1, 5)] == t
    assert (got.sys_len, got.ref_len) == (sl, rl)
    assert got.bleu == pytest.approx(round(score, 6), abs=1e-6)


def test_bleu_identical_is_100(spark):
    assert _bleu(spark, [("one two three four five", "one two three four five")]).bleu == pytest.approx(100.0)


def test_bleu_on_conversations_matches_plain(spark):
    p = fx.pairs(spark, SF_SMALL).collect()
    got = ov.corpus_bleu(fx.pairs(spark, SF_SMALL), pred="src", ref="tgt", id_cols=["line_no"]).first()
    score, m, t, sl, rl = plain.corpus_bleu([r.src for r in p], [r.tgt for r in p])
    assert [got[f"m{n}"] for n in range(1, 5)] == m and got.sys_len == sl and got.ref_len == rl
    assert got.bleu == pytest.approx(round(score, 6), abs=1e-6)


def test_lcs_helpers_against_dp():
    rng = random.Random(3)
    for _ in range(400):
        a = [rng.choice("abcde") for _ in range(rng.randint(0, 30))]
        b = [rng.choice("abcde") for _ in range(rng.randint(0, 30))]
        assert lcs.lcs_len(a, b) == (plain.lcs_table(a, b)[-1][-1] if a and b else 0)
        assert lcs.lcs_indices(a, b) == (plain._lcs_ind(a, b) if a and b else [])


def _texts(rng, n):
    words = ["the", "cat", "sat", "on", "mat", "dog", "ran", "Äpfel", "über", "42"]
    out = []
    for _ in range(n):
        lines = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 8))) for _ in range(rng.randint(1, 4))]
        out.append("\n".join(lines))
    return out


def test_rouge_pair_scores_against_plain(spark):
    rng = random.Random(11)
    preds, refs = _texts(rng, 120), _texts(rng, 120)
    preds += ["", "same text", "x"]
    refs += ["not empty", "same text", ""]
    df = spark.createDataFrame([(i, p, r) for i, (p, r) in enumerate(zip(preds, refs))], "pair_id long, pred string, ref string")
    got = {r.pair_id: r for r in ov.rouge_all(df).collect()}
    for i, (p, r) in enumerate(zip(preds, refs)):
        g = got[i]
        assert g.rouge1 == pytest.approx(plain.rouge_n(r, p, 1), abs=1e-9)
        assert g.rouge2 == pytest.approx(plain.rouge_n(r, p, 2), abs=1e-9)
        assert g.rougeL == pytest.approx(plain.rouge_l(r, p), abs=1e-9)
        assert g.rougeLsum == pytest.approx(plain.rouge_lsum(r, p), abs=1e-9), (p, r)


def test_rouge_on_conversations_whole_texts(spark):
    p = fx.pairs(spark, SF_SMALL)
    rows = {r.line_no: r for r in p.collect()}
    got = ov.rouge_all(p, pred="src", ref="tgt", id_cols=["line_no"]).collect()
    assert len(got) == len(rows)
    for g in got:
        r = rows[g.line_no]
        assert g.rouge1 == pytest.approx(plain.rouge_n(r.tgt, r.src, 1), abs=1e-9)
        assert g.rougeL == pytest.approx(plain.rouge_l(r.tgt, r.src), abs=1e-9)
        assert g.rougeLsum == pytest.approx(plain.rouge_lsum(r.tgt, r.src), abs=1e-9)


def test_rouge_l_docs_against_dp(spark):
    d = fx.doc_pairs(spark, SF_SMALL)
    rows = {r.pair_id: r for r in d.collect()}
    got = ov.rouge_l(d, id_cols=["pair_id"]).collect()
    for g in got:
        r = rows[g.pair_id]
        a, b = plain.rouge_tok(r.ref), plain.rouge_tok(r.pred)
        if len(a) * len(b) > 600_000:  # the same table, a row at a time
            codes = {w: i for i, w in enumerate(set(a) | set(b))}
            x, y = (np.array([codes[w] for w in t]) for t in (a, b))
            row = np.zeros(len(y) + 1, int)
            for w in x:
                row[1:] = np.maximum.accumulate(np.maximum(row[1:], np.where(y == w, row[:-1] + 1, 0)))
            p, q = row[-1] / len(b), row[-1] / len(a)
            want = 2 * p * q / (p + q) if p + q else 0.0
        else:
            want = plain.rouge_l(r.ref, r.pred)
        assert g.rougeL == pytest.approx(want, abs=1e-9)
    assert len(got) == len(rows) > 50


def test_rouge_epoch_mean_of_means(spark):
    df = spark.createDataFrame(
        [(0, 0, 1.0), (1, 0, 0.0), (2, 0, 0.5), (3, 1, 0.0)], "pair_id long, batch_id long, rouge1 double"
    )
    got = ov.rouge_epoch(df, cols=["rouge1"]).first().rouge1
    assert got == pytest.approx((0.5 + 0.0) / 2)  # short last batch weighs as much


def test_bleu_plan_single_pair_shuffle(spark):
    df = spark.createDataFrame([(1, "a b", "a b")], "pair_id long, pred string, ref string")
    plan = ov.bleu_stats(df)._jdf.queryExecution().executedPlan().toString()
    # one exchange on the pair id, one to the single final partition, no join
    assert "SortMergeJoin" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_hashed_grams_equal_exact(spark):
    p = fx.pairs(spark, SF_SMALL)
    exact = ov.corpus_bleu(p, pred="src", ref="tgt", id_cols=["line_no"]).first()
    hashed = ov.corpus_bleu(p, pred="src", ref="tgt", id_cols=["line_no"], hashed=True).first()
    assert tuple(exact) == tuple(hashed)
    d = fx.doc_pairs(spark, SF_SMALL)
    e = sorted(map(tuple, ov.rouge_pair_scores(d, id_cols=["pair_id"], kinds=["rouge1", "rouge2"]).collect()))
    h = sorted(map(tuple, ov.rouge_pair_scores(d, id_cols=["pair_id"], kinds=["rouge1", "rouge2"], hashed=True).collect()))
    assert e == h


def test_grams_never_become_rows(spark):
    df = spark.createDataFrame([(1, "a b", "a b")], "pair_id long, pred string, ref string")
    for out in (ov.rouge_n(df), ov.corpus_bleu(df), ov.rouge_all(df)):
        assert "Generate" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_rows_of_one_id_count_together(spark):
    """The lines of an id that comes twice make one multiset of grams (none spans two lines); null texts have none."""
    rows = [(1, "a b a", "b a"), (1, "a", "a b"), (2, None, "x"), (3, "", None), (None, "c d", "c d"), (None, "c", None)]
    df = spark.createDataFrame(rows, "pair_id long, pred string, ref string")
    got = {r.pair_id: (r.rouge1, r.rouge2) for r in ov.rouge_n(df).collect()}
    assert got == {1: (3 / 4, 1.0), 2: (0.0, 0.0), 3: (0.0, 0.0), None: (4 / 5, 1.0)}
    b = ov.bleu_stats(df).first()
    assert (b.m1, b.m2, b.t1, b.t2, b.sys_len, b.ref_len) == (5, 3, 7, 3, 7, 7)
    only_empty = df.where("pair_id = 3").withColumn("split", F.lit("test"))
    assert ov.corpus_bleu(only_empty, by=["split"]).count() == 0 and ov.corpus_bleu(only_empty).first().bleu == 0.0
