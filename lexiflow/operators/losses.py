"""Class-score operators and the loss / accuracy aggregates (PRJ-9..11, FLT-2,
AGG-3..7, CHK-2).

Scores stay one array per (example, position) row; per-class work is done by
higher-order array functions inside the row, so the data is never widened to
one row per class.  All sums are per position first, then reduced with
ordinary (map-side combined) aggregates grouped by batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lexiflow.functions.text import col_


# --- per-row expressions -----------------------------------------------------

def argmax_expr(scores) -> Column:
    """PRJ-9: 0-based index of the largest score; ties give the first index."""
    s = col_(scores)
    return (F.array_position(s, F.array_max(s)) - F.lit(1)).cast("int")


def logsumexp_expr(scores) -> Column:
    s = col_(scores)
    m = F.array_max(s)
    return m + F.log(F.aggregate(s, F.lit(0.0), lambda acc, v: acc + F.exp(v - m)))


def log_softmax_expr(scores) -> Column:
    """PRJ-10: log-probabilities over classes."""
    lse = logsumexp_expr(scores)
    return F.transform(col_(scores), lambda v: v - lse)


def gather_expr(values, label) -> Column:
    """PRJ-11: value at the label index (an out-of-range label raises under ANSI)."""
    return F.element_at(col_(values), col_(label) + F.lit(1))


def argmax_class(df: DataFrame, scores: str = "scores", out: str = "pred") -> DataFrame:
    return df.withColumn(out, argmax_expr(scores))


def log_softmax(df: DataFrame, scores: str = "scores", label: str = "label") -> DataFrame:
    """Adds ``lse`` (log-sum-exp) and ``lp_label`` = log p(label)."""
    return df.withColumn("lse", logsumexp_expr(scores)).withColumn(
        "lp_label", gather_expr(scores, label) - F.col("lse")
    )


def width_report(df: DataFrame, vocab_size: int, by: Sequence[str] = ("batch_id",), scores: str = "scores") -> DataFrame:
    """CHK-2 as a table: per batch its rows, those whose scores aren't ``vocab_size`` wide, and the extreme widths."""
    width = F.size(scores)
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), F.count(F.when(width != vocab_size, 1)).alias("n_wrong"),
                               F.min(width).alias("least_width"), F.max(width).alias("greatest_width"))


def observe_width(df: DataFrame, vocab_size: int, observation: Observation, scores: str = "scores") -> DataFrame:
    """CHK-2 in the pass that uses the rows: all of them go on, ``observation`` counts n_rows and n_wrong."""
    return df.observe(observation, F.count(F.lit(1)).alias("n_rows"), F.count(F.when(F.size(scores) != vocab_size, 1)).alias("n_wrong"))


def check_width(df: DataFrame, vocab_size: int, scores: str = "scores") -> DataFrame:
    """CHK-2: fail when a score row is not as wide as the vocabulary."""
    bad = F.size(scores) != F.lit(vocab_size)
    err = F.raise_error(F.lit(f"score width differs from vocabulary size {vocab_size}"))
    # a predicate, so the optimizer cannot prune the check away
    return df.where(F.when(bad, err).otherwise(F.lit(True)))


def drop_ignored(df: DataFrame, ignore: int | None, label: str = "label") -> DataFrame:
    """FLT-2: remove positions whose label is the ignored (pad) id."""
    return df if ignore is None else df.where(F.col(label) != F.lit(ignore))


# --- aggregates ----------------------------------------------------------------

def _keep(label: str, ignore: int | None) -> Column:
    return F.lit(True) if ignore is None else (F.col(label) != F.lit(ignore))


def token_accuracy(df: DataFrame, by: Sequence[str] = ("batch_id",), ignore: int | None = None, scores: str = "scores", label: str = "label") -> DataFrame:
    """AGG-3: share of positions whose argmax equals the label.  By default
    padding counts in numerator and divisor, as in the reference."""
    hit = (argmax_expr(scores) == F.col(label)).cast("double")
    keep = _keep(label, ignore)
    return df.groupBy(*by).agg(
        F.try_divide(F.sum(F.when(keep, hit)), F.count(F.when(keep, F.lit(1))).cast("double")).alias("accuracy")
    )


def cross_entropy(df: DataFrame, by: Sequence[str] = ("batch_id",), ignore: int | None = 1, scores: str = "scores", label: str = "label") -> DataFrame:
    """AGG-4: mean of −log p(label) over kept positions; null when none is kept."""
    keep = _keep(label, ignore)
    nll = logsumexp_expr(scores) - gather_expr(scores, label)
    return df.groupBy(*by).agg(
        F.try_divide(F.sum(F.when(keep, nll)), F.count(F.when(keep, F.lit(1))).cast("double")).alias("loss")
    )


def label_smoothed_nll(df: DataFrame, epsilon: float, by: Sequence[str] = ("batch_id",), ignore: int | None = 1, scores: str = "scores", label: str = "label") -> DataFrame:
    """AGG-5: (1−ε)·NLL + (ε/V)·S with NLL = Σ −log p(label) / count and
    S = Σ_positions Σ_classes −log p / count; count = kept positions (all
    positions when ``ignore`` is None).  Returns ``loss`` and ``nll_loss``."""
    keep = _keep(label, ignore)
    lse = logsumexp_expr(scores)
    nll = lse - gather_expr(scores, label)
    width = F.size(scores)
    smooth = width.cast("double") * lse - F.aggregate(scores, F.lit(0.0), lambda a, v: a + v)
    g = df.groupBy(*by).agg(
        F.sum(F.when(keep, nll)).alias("_nll"),
        F.sum(F.when(keep, smooth)).alias("_smooth"),
        F.count(F.when(keep, F.lit(1))).cast("double").alias("_cnt"),
        F.max(width).alias("_v"),
    )
    nll_loss = F.try_divide(F.col("_nll"), F.col("_cnt"))
    smooth_loss = F.try_divide(F.col("_smooth"), F.col("_cnt"))
    loss = (F.lit(1.0 - epsilon) * nll_loss) + F.try_divide(F.lit(float(epsilon)), F.col("_v").cast("double")) * smooth_loss
    return g.select(*by, loss.alias("loss"), nll_loss.alias("nll_loss"))


def batch_loss(df: DataFrame, epsilon: float = 0.0, by: Sequence[str] = ("batch_id",), ignore: int | None = 1, scores: str = "scores", label: str = "label") -> DataFrame:
    """The reference's forward loss: plain cross-entropy when ε = 0, label
    smoothing otherwise (column ``loss``)."""
    if epsilon == 0:
        return cross_entropy(df, by, ignore, scores, label)
    return label_smoothed_nll(df, epsilon, by, ignore, scores, label).drop("nll_loss")


def batch_loss_and_accuracy(df: DataFrame, epsilon: float = 0.0, by: Sequence[str] = ("batch_id",), ignore: int | None = 1, scores: str = "scores", label: str = "label") -> DataFrame:
    """``batch_loss`` and ``token_accuracy`` (over all positions) from one grouping of the scores.

    Rows of different widths in a batch fail (CHK-2 within the batch; the width itself
    is checked by ``check_width`` where the vocabulary's is known)."""
    keep = _keep(label, ignore)
    lse = logsumexp_expr(scores)
    width = F.size(scores)
    smooth = width.cast("double") * lse - F.aggregate(scores, F.lit(0.0), lambda a, v: a + v)
    g = df.groupBy(*by).agg(
        F.sum(F.when(keep, lse - gather_expr(scores, label))).alias("_nll"),
        F.sum(F.when(keep, smooth)).alias("_smooth"),
        F.count(F.when(keep, F.lit(1))).cast("double").alias("_cnt"),
        F.when(F.min(width) == F.max(width), F.max(width)).otherwise(F.raise_error(F.lit("score widths differ in a batch")).cast("int")).cast("double").alias("_v"),
        F.avg((argmax_expr(scores) == F.col(label)).cast("double")).alias("accuracy"),
    )
    loss = F.when(F.col("_v").isNotNull(), F.try_divide(F.col("_nll"), F.col("_cnt")))
    if epsilon:
        loss = F.lit(1.0 - epsilon) * loss + F.try_divide(F.lit(float(epsilon)), F.col("_v")) * F.try_divide(F.col("_smooth"), F.col("_cnt"))
    return g.select(*by, loss.alias("loss"), "accuracy")


def mean_of_batches(per_batch: DataFrame, cols: Sequence[str], batch_col: str = "batch_id", by: Sequence[str] = (), rank_col: str | None = None, weighted: bool = False) -> DataFrame:
    """AGG-6 / AGG-7: unweighted mean of per-batch values (a short last batch
    weighs as much as a full one).  Rows may be finer than batches (e.g. one
    per pair): they are averaged per batch first.  With ``rank_col`` the batch
    means are averaged per rank and the rank means averaged (sum ÷ ranks).
    ``weighted=True`` gives the plain row mean instead."""
    cols = list(cols)
    if weighted:
        return per_batch.groupBy(*by).agg(*[F.avg(c).alias(c) for c in cols])
    keys = [*by] + ([rank_col] if rank_col else []) + [batch_col]
    b = per_batch.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in cols])
    if rank_col:
        b = b.groupBy(*by, rank_col).agg(*[F.avg(c).alias(c) for c in cols])
    return b.groupBy(*by).agg(*[F.avg(c).alias(c) for c in cols])
