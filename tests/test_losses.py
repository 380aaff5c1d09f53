import math

import numpy as np
import pytest
from pyspark.sql import Observation

from lexiflow.operators import losses as ls


def _df(spark, rows):
    return spark.createDataFrame(rows, "batch_id long, rank int, scores array<double>, label int")


def _np_ls(rows, eps, ignore):
    nll = smooth = 0.0
    cnt = 0
    v = len(rows[0][2])
    for _, _, s, lab in rows:
        s = np.array(s)
        lp = s - (s.max() + np.log(np.exp(s - s.max()).sum()))
        if ignore is not None and lab == ignore:
            continue
        nll += -lp[lab]
        smooth += -lp.sum()
        cnt += 1
    if cnt == 0:
        return None, None
    return (1 - eps) * nll / cnt + eps / v * smooth / cnt, nll / cnt


ROWS = [(0, 0, [1.0, 2.0, 0.5], 1), (0, 0, [0.1, 0.2, 3.0], 2), (0, 0, [2.0, 2.0, 1.0], 0), (1, 1, [0.0, 0.0, 0.0], 1)]


@pytest.mark.parametrize("eps", [0.0, 0.1, 1.0])
@pytest.mark.parametrize("ignore", [None, 1])
def test_label_smoothed_matches_numpy(spark, eps, ignore):
    got = {r.batch_id: r for r in ls.label_smoothed_nll(_df(spark, ROWS), eps, ignore=ignore).collect()}
    for b in (0, 1):
        loss, nll = _np_ls([r for r in ROWS if r[0] == b], eps, ignore)
        if loss is None:
            assert got[b].loss is None and got[b].nll_loss is None  # every label ignored
        else:
            assert got[b].loss == pytest.approx(loss) and got[b].nll_loss == pytest.approx(nll)


def test_cross_entropy_equals_eps_zero(spark):
    ce = {r.batch_id: r.loss for r in ls.cross_entropy(_df(spark, ROWS), ignore=1).collect()}
    sm = {r.batch_id: r.loss for r in ls.label_smoothed_nll(_df(spark, ROWS), 0.0, ignore=1).collect()}
    assert ce[0] == pytest.approx(sm[0]) and ce[1] is None


def test_accuracy_counts_padding_and_first_argmax(spark):
    acc = {r.batch_id: r.accuracy for r in ls.token_accuracy(_df(spark, ROWS)).collect()}
    # batch 0: argmax [1, 2, 0 (tie -> first)] vs labels [1, 2, 0]
    assert acc[0] == pytest.approx(1.0) and acc[1] == pytest.approx(0.0)
    masked = {r.batch_id: r.accuracy for r in ls.token_accuracy(_df(spark, ROWS), ignore=1).collect()}
    assert masked[0] == pytest.approx(1.0) and masked[1] is None


def test_log_softmax_and_gather(spark):
    r = ls.log_softmax(_df(spark, ROWS[:1])).first()
    s = np.array(ROWS[0][2])
    assert r.lse == pytest.approx(math.log(np.exp(s).sum()))
    assert r.lp_label == pytest.approx(s[1] - r.lse)


def test_check_width(spark):
    ok = ls.check_width(_df(spark, ROWS), 3)
    assert ok.count() == 4
    with pytest.raises(Exception, match="score width"):
        ls.check_width(_df(spark, ROWS), 5).collect()


def test_mean_of_batches_and_ranks(spark):
    per = spark.createDataFrame([(0, 0, 1.0), (1, 0, 3.0), (2, 1, 10.0)], "batch_id long, rank int, loss double")
    assert ls.mean_of_batches(per, ["loss"]).first().loss == pytest.approx(14 / 3)
    assert ls.mean_of_batches(per, ["loss"], rank_col="rank").first().loss == pytest.approx((2.0 + 10.0) / 2)
    rows = spark.createDataFrame([(0, 1.0), (0, 0.0), (0, 1.0), (1, 0.0)], "batch_id long, loss double")
    assert ls.mean_of_batches(rows, ["loss"]).first().loss == pytest.approx((2 / 3 + 0) / 2)  # short last batch
    assert ls.mean_of_batches(rows, ["loss"], weighted=True).first().loss == pytest.approx(0.5)


def test_rank_mean_with_an_empty_rank(spark):
    # world of 3 ranks, rank 2 produced no batch: the mean runs over the ranks that report
    per = spark.createDataFrame([(0, 0, 1.0), (1, 1, 3.0)], "batch_id long, rank int, loss double")
    assert ls.mean_of_batches(per, ["loss"], rank_col="rank").first().loss == pytest.approx(2.0)


def test_width_report_and_observation(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (0, [1.0]), (1, [3.0, 4.0])], "batch_id int, scores array<double>")
    got = {r.batch_id: tuple(r)[1:] for r in ls.width_report(df, 2).collect()}
    assert got == {0: (2, 1, 1, 2), 1: (1, 0, 2, 2)}
    seen = Observation()
    assert ls.observe_width(df, 2, seen).count() == 3
    assert seen.get == {"n_rows": 3, "n_wrong": 1}
