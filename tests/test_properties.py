"""Randomised comparisons with plain Python, and invariance of results under
re-partitioning and with AQE on/off (SURVEY §5 items 3 and 4)."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexiflow.operators import overlap as ov
from lexiflow.operators.ordering import row_index
from lexiflow.sources import fixtures as fx
from tests import plain
from tests.conftest import SF_SMALL

WORDS = ["the", "cat", "sat", "on", "mat", "a", "3.5", "x-ray", "end.", "Über", "dog,", "it's"]
text = st.lists(st.sampled_from(WORDS + ["\n"]), max_size=25).map(" ".join)
corpus = st.lists(st.tuples(text, text), min_size=1, max_size=12)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(pairs=corpus)
def test_bleu_random_corpora(spark, pairs):
    df = spark.createDataFrame([(i, h, r) for i, (h, r) in enumerate(pairs)], "pair_id long, pred string, ref string")
    got = ov.corpus_bleu(df).first()
    score, m, t, sl, rl = plain.corpus_bleu([h for h, _ in pairs], [r for _, r in pairs])
    assert [got[f"m{n}"] for n in range(1, 5)] == m and [got[f"t{n}"] for n in range(1, 5)] == t
    assert (got.sys_len, got.ref_len) == (sl, rl)
    assert got.bleu == pytest.approx(round(score, 6), abs=1e-6)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(pairs=corpus)
def test_rouge_random_pairs(spark, pairs):
    df = spark.createDataFrame([(i, h, r) for i, (h, r) in enumerate(pairs)], "pair_id long, pred string, ref string")
    got = {r.pair_id: r for r in ov.rouge_all(df).collect()}
    for i, (p, r) in enumerate(pairs):
        assert got[i].rouge1 == pytest.approx(plain.rouge_n(r, p, 1), abs=1e-9)
        assert got[i].rouge2 == pytest.approx(plain.rouge_n(r, p, 2), abs=1e-9)
        assert got[i].rougeL == pytest.approx(plain.rouge_l(r, p), abs=1e-9)
        assert got[i].rougeLsum == pytest.approx(plain.rouge_lsum(r, p), abs=1e-9)


@pytest.mark.parametrize("aqe", ["true", "false"])
def test_results_invariant_to_partitioning(spark, aqe):
    spark.conf.set("spark.sql.adaptive.enabled", aqe)
    try:
        base = fx.pairs(spark, SF_SMALL)
        results = []
        for parts in (1, 4, 16):
            p = base.repartition(parts)
            bleu = tuple(ov.corpus_bleu(p, pred="src", ref="tgt", id_cols=["line_no"]).first())
            rouge = sorted(tuple(r) for r in ov.rouge_n(p, pred="src", ref="tgt", id_cols=["line_no"]).collect())
            pos = sorted(tuple(r) for r in row_index(p, ["line_no"], group_cols=["split"], num_partitions=parts).select("line_no", "pos").collect())
            results.append((bleu, rouge, pos))
        assert results[0] == results[1] == results[2]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
