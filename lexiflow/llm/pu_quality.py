"""Quality classifier by positive-unlabelled learning (operator 6).

Trusted positives (rows labelled good) and unlabelled web text (every text) train
a linear score on text features.  With class prior p the risk of a score f under
the logistic loss l is

    p E_P[l(f)]  +  max(0, E_U[l(-f)] - p E_P[l(-f)]),

the non-negative form of the unbiased positive-unlabelled risk: the bracket
estimates the risk on negatives, which can't be below zero.  While it is positive
the logistic loss makes the risk convex (l(f) - l(-f) = -f), so Newton steps fit
it; a step is shortened until the bracket is not negative, and the fit ends where
no step is left.  All expectations are sums over all rows, gathered by Spark jobs;
the driver holds one vector and one matrix of feature size.

The prior is estimated from the trusted rows themselves: the share of good ones
among the rows that reviewers marked, labels being given irrespective of the
text.  Without rejected rows it falls back to the smallest ratio of unlabelled to
positive density over the deciles of a first score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiflow.llm.common import cut, free_name, give_back, text_or_empty

FEATURES = [
    "log_words", "mean_word", "distinct_words", "top_word", "repeated_neighbours", "upper_words",
    "title_words", "symbols", "noise_marks", "bars", "bangs", "digits", "full_stops", "commas", "log_line",
    "distinct_lines", "short_words", "long_words", "letters",
]
_SYMBOL = re.compile(r"[^\w\s.,]")
_NOISE = re.compile(r"[%*#&$@~^_=<>\\]")
_DIGIT = re.compile(r"\d")
#: Newton steps at most, ridge on the weights, parts of a step that are tried.
STEPS, RIDGE, PARTS = 25, 1e-3, (1.0, 0.5, 0.25, 0.125, 0.0625)
#: Standardised features are held to this many deviations.
CLIP = 6.0


def text_features(text: str) -> list[float]:
    """The features of a whole text, ratios and logarithms; zeros for a text without words."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    chars = len(text)
    lines = [x for x in text.split("\n") if x]
    counts = Counter(words)
    lengths = [len(w) for w in words]
    symbols = len(_SYMBOL.findall(text))
    return [
        math.log1p(n),
        min(sum(lengths) / n, 40.0),
        len(counts) / n,
        max(counts.values()) / n,
        sum(a == b for a, b in zip(words, words[1:])) / max(n - 1, 1),
        sum(map(str.isupper, words)) / n,
        sum(map(str.istitle, words)) / n,
        symbols / chars,
        len(_NOISE.findall(text)) / n,
        text.count("|") / n,
        text.count("!") / n,
        len(_DIGIT.findall(text)) / chars,
        text.count(".") / n,
        text.count(",") / n,
        math.log1p(n / max(len(lines), 1)),
        len(set(lines)) / max(len(lines), 1),
        sum(x <= 3 for x in lengths) / n,
        sum(x >= 15 for x in lengths) / n,
        (chars - symbols - text.count(" ")) / chars,
    ]


def _features(text: Column) -> Column:
    @F.arrow_udf("array<double>")
    def run(texts: pa.Array) -> pa.Array:
        out = pa.array([text_features(t.as_py()) for t in texts], pa.list_(pa.float64()))
        give_back()
        return out

    return run(text_or_empty(text))


@dataclass
class Model:
    """Standardisation and weights; without trusted positives every text scores 0.5."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float

    def design(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -CLIP, CLIP)
        return np.hstack([np.ones((len(z), 1)), z, z * z])

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.design(x) @ self.weights, -500, 500)))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))


def _sums(rows: DataFrame, of: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all rows (f, positive) of a vector function of blocks of rows."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = of(_matrix(batch.column("f")), batch.column("positive").to_numpy(zero_copy_only=False))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total, pa.float64())], names=["i", "v"])

    found = rows.mapInArrow(partial, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    return np.array([r.v for r in sorted(found, key=lambda r: r.i)])


def _newton(rows: DataFrame, model: Model) -> None:
    """Fit the weights to the non-negative risk; ``rows`` are (f, positive)."""
    size = 1 + 2 * len(FEATURES)

    def positives(x: np.ndarray, positive: np.ndarray) -> np.ndarray:
        return np.concatenate(([len(x), positive.sum()], model.design(x[positive]).sum(0)))

    head = _sums(rows, positives)
    n, n_pos = head[0], head[1]
    mean_pos = head[2:] / n_pos
    model.weights = np.zeros(size)
    for _ in range(STEPS):

        def curvature(x: np.ndarray, _: np.ndarray) -> np.ndarray:
            d = model.design(x)
            q = 1.0 / (1.0 + np.exp(-np.clip(d @ model.weights, -500, 500)))
            return np.concatenate((d.T @ q, ((d.T * (q * (1 - q))) @ d).ravel()))

        got = _sums(rows, curvature)
        slope = got[:size] / n - model.prior * mean_pos + RIDGE * model.weights
        step = np.linalg.solve(got[size:].reshape(size, size) / n + RIDGE * np.eye(size), slope)
        trials = [model.weights - part * step for part in PARTS]

        def bracket(x: np.ndarray, positive: np.ndarray) -> np.ndarray:
            lost = [np.logaddexp(0, model.design(x) @ w) for w in trials]
            return np.array([v for z in lost for v in (z.sum(), z[positive].sum())])

        risk = _sums(rows, bracket).reshape(-1, 2)
        fine = [w for w, (u, p) in zip(trials, risk) if u / n - model.prior * p / n_pos >= 0]
        if not fine:
            break
        moved, model.weights = np.abs(model.weights - fine[0]).max(), fine[0]
        if moved < 1e-3:
            break


def fit(rows: DataFrame, prior: float | None = None) -> Model:
    """``rows`` are (f, good): features of every text, and 1 or 0 where it is labelled, else null."""
    marked = rows.select("f", F.coalesce(F.col("good") == 1, F.lit(False)).alias("positive"))
    k = len(FEATURES)
    got = _sums(marked, lambda x, p: np.concatenate(([len(x), p.sum()], x.sum(0), (x * x).sum(0))))
    if not len(got) or not got[1]:
        return Model(np.zeros(k), np.ones(k), np.zeros(1 + 2 * k), 0.5)
    mean = got[2 : 2 + k] / got[0]
    scale = np.sqrt(np.maximum(got[2 + k :] / got[0] - mean**2, 0))
    model = Model(mean, np.where(scale > 1e-9, scale, 1.0), np.zeros(1 + 2 * k), 0.5)
    if prior is None:
        bad = rows.where("good = 0").count()
        prior = got[1] / (got[1] + bad) if bad else _prior_by_density(marked, model)
    model.prior = float(min(max(prior, 0.01), 0.99))
    _newton(marked, model)
    return model


def _prior_by_density(rows: DataFrame, model: Model) -> float:
    """The smallest ratio of unlabelled to positive rows above a score, over cuts of a first score."""
    _newton(rows, model)
    cuts = np.linspace(0, 1, 41)[:-1]
    got = _sums(rows, lambda x, p: np.concatenate([[(s >= c).sum() for c in cuts] for s in (model.score(x), model.score(x)[p])]).astype(float))
    every, good = got[: len(cuts)], got[len(cuts) :]
    solid = good >= 0.1 * good[0]
    return float(np.min((every / every[0])[solid] / (good / good[0])[solid]))


def _score(features: Column, model: Model) -> Column:
    @F.arrow_udf("double")
    def run(f: pa.Array) -> pa.Array:
        return pa.array(model.score(_matrix(f)) if len(f) else [], pa.float64())

    return run(features)


def held_out(id_col: str) -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(3)) == 1


def _labelled(df: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, f, held_out, good): ``good`` is null where the row may not be learnt from."""
    marks = labels.where(~held_out("doc_id")).groupBy(F.col("doc_id").alias("id")).agg((F.avg("quality") >= 0.5).cast("int").alias("good"))
    rows = df.select(F.col(id_col).alias("id"), _features(F.col(text_col)).alias("f"), held_out(id_col).alias("held_out"))
    return cut(rows.join(marks, "id", "left"))


def score_quality(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", prior: float | None = None) -> DataFrame:
    """One row (id, held_out, score, predicted) per row of ``df``.

    ``labels`` (doc_id, quality) is read only where crc32(id) mod 3 is not 1; several
    labels of a document count by their mean.  Null and empty texts have zero
    features and a score like any other; repeated rows repeat; an empty table gives
    no rows; a null id has no label.  Without any trusted positive all scores are 0.5.
    """
    rows = _labelled(df, labels, id_col, text_col)
    model = fit(rows.select("f", "good"), prior)
    scored = rows.select(F.col("id").alias(id_col), "held_out", _score(F.col("f"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` whose text scores 0.5 or more, with the columns of ``df``."""
    model = fit(_labelled(df, labels, id_col, text_col).select("f", "good"))
    return df.where(_score(_features(F.col(text_col)), model) >= 0.5)
