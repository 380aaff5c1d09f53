"""Text-overlap metrics: corpus BLEU, ROUGE-1/2/L/Lsum and their epoch means.

Plan shape (BLEU and ROUGE-N): the pair rows are hash-partitioned once on the
pair id; one grouping by the id — already clustered by that partitioning, so no
second exchange — brings the token lines of both sides together, and an Arrow
UDF counts their n-grams, an id at a time: a text moves once, its n-grams never
become rows.  The clipped matches are a few integers per id (ROUGE), summed per
group (BLEU).  Only integer statistics travel; the "collect every sentence on
one process" step of the reference disappears.

ROUGE-L / Lsum need a longest common subsequence per pair; that runs in an
Arrow-batched pandas UDF (``lexiflow.functions.lcs``) on the token arrays.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiflow.functions import lcs
from lexiflow.functions.text import col_, rouge_sentences, rouge_tokens, tokenize_13a

BLEU_MAX_ORDER = 4


def _gram_tallies(hyps: Column, refs: Column, max_n: int, hashed: bool) -> Column:
    """Struct of m{n}, ch{n}, cr{n} for n up to ``max_n``: clipped matches and totals of the n-grams
    of two arrays of texts, whose tokens are parted by single spaces; no gram spans two texts."""
    names = [f"{c}{n}" for n in range(1, max_n + 1) for c in ("m", "ch", "cr")]

    def grams(tokens: list[list[str]], n: int) -> Counter:
        out: Counter = Counter()
        for t in tokens:
            found = t if n == 1 else zip(*(t[k:] for k in range(n)))
            out.update(map(hash, found) if hashed else found)
        return out

    @F.arrow_udf(T.StructType([T.StructField(c, T.LongType()) for c in names]))
    def run(hyp_texts: pa.Array, ref_texts: pa.Array) -> pa.Array:
        out: dict[str, list[int]] = {c: [] for c in names}
        for pair in zip(hyp_texts, ref_texts):
            hyp, ref = ([t.split(" ") for t in texts.as_py() if t] for texts in pair)
            for n in range(1, max_n + 1):
                h, r = grams(hyp, n), grams(ref, n)
                small, large = (h, r) if len(h) < len(r) else (r, h)
                out[f"m{n}"].append(sum(min(c, large[g]) for g, c in small.items() if g in large))
                out[f"ch{n}"].append(h.total())
                out[f"cr{n}"].append(r.total())
        return pa.StructArray.from_arrays([pa.array(out[c], pa.int64()) for c in names], names=names)

    return run(hyps, refs)


def gram_counts(
    df: DataFrame,
    id_cols: Sequence[str],
    hyp: Column,
    ref: Column,
    max_n: int,
    carry: Sequence[str] = (),
    sentinel: bool = False,
    hashed: bool = False,
    dealt: bool = False,
) -> DataFrame:
    """Per id, for every n up to ``max_n``: ``m{n}`` clipped matches, ``ch{n}`` hypothesis and
    ``cr{n}`` reference n-grams (``hashed``: grams keyed by a 64-bit hash).

    JN-4: the multiset intersection needs no join — rows of the same id meet in one
    grouping, which collects their token lines, and an Arrow UDF counts the grams of an id
    at a time, so no gram becomes a row.  ``carry`` columns (constant per id, e.g. per-pair
    scores computed before) ride along as grouping keys, so nothing needs a join back.
    ``sentinel`` keeps ids without any token.  ``dealt``: the rows are hash-partitioned on
    the id already.
    """
    part = df if dealt else df.repartition(*[F.col(c) for c in id_cols])
    sel = part.select(*carry, *id_cols, F.array_join(hyp, " ").alias("_hyp"), F.array_join(ref, " ").alias("_ref"))
    keys = [c for c in sel.columns if c not in ("_hyp", "_ref")]
    grouped = sel.groupBy(*keys).agg(F.collect_list("_hyp").alias("_hyp"), F.collect_list("_ref").alias("_ref"))
    counts = grouped.select(*keys, _gram_tallies(F.col("_hyp"), F.col("_ref"), max_n, hashed).alias("_n")).select(*keys, "_n.*")
    return counts if sentinel else counts.where(F.col("ch1") + F.col("cr1") > 0)


def _nz(c: Column) -> Column:
    return F.coalesce(c, F.lit(0)).cast("long")


def bleu_stats(df: DataFrame, pred: str = "pred", ref: str = "ref", id_cols: Sequence[str] = ("pair_id",), by: Sequence[str] = (), hashed: bool = False) -> DataFrame:
    """Corpus statistics: matches m1..m4, totals t1..t4, sys_len, ref_len (per ``by`` group)."""
    counts = gram_counts(df, id_cols, tokenize_13a(col_(pred)), tokenize_13a(col_(ref)), BLEU_MAX_ORDER, carry=by, hashed=hashed)
    orders = range(1, BLEU_MAX_ORDER + 1)
    aggs = [_nz(F.sum(f"m{n}")).alias(f"m{n}") for n in orders]
    aggs += [_nz(F.sum(f"ch{n}")).alias(f"t{n}") for n in orders]
    aggs += [_nz(F.sum("ch1")).alias("sys_len"), _nz(F.sum("cr1")).alias("ref_len")]
    return counts.groupBy(*by).agg(*aggs)


def bleu_score(m: list[Column], t: list[Column], sys_len: Column, ref_len: Column) -> Column:
    """Closed-form corpus BLEU from integer statistics (exponential smoothing).

    p_n = 100·m_n/t_n; an order with no match uses 100/(2^k·t_n) for the k-th
    such order; any empty order or no match at all gives 0; brevity penalty
    exp(1 − ref/sys) when the system side is shorter.
    """
    k = F.lit(0)
    logs = []
    for mn, tn in zip(m, t):
        k = k + F.when(mn == 0, F.lit(1)).otherwise(F.lit(0))
        p = F.when(mn > 0, F.try_divide(F.lit(100.0) * mn, tn)).otherwise(
            F.try_divide(F.lit(100.0), F.pow(F.lit(2.0), k) * tn)
        )
        logs.append(F.log(p))
    degenerate = reduce(lambda a, b: a | b, [tn == 0 for tn in t]) | reduce(lambda a, b: a & b, [mn == 0 for mn in m])
    bp = F.when(sys_len >= ref_len, F.lit(1.0)).when(
        sys_len > 0, F.exp(F.lit(1.0) - F.try_divide(ref_len.cast("double"), sys_len))
    ).otherwise(F.lit(0.0))
    geo = F.exp(reduce(lambda a, b: a + b, logs) / F.lit(float(len(m))))
    return F.when(degenerate, F.lit(0.0)).otherwise(bp * geo)


def corpus_bleu(df: DataFrame, pred: str = "pred", ref: str = "ref", id_cols: Sequence[str] = ("pair_id",), by: Sequence[str] = (), digits: int = 6, hashed: bool = False) -> DataFrame:
    """AGG-8: one row per ``by`` group (one row overall by default) with
    ``bleu`` and its integer statistics.  One reference per prediction."""
    st = bleu_stats(df, pred, ref, id_cols, by, hashed)
    m = [F.col(f"m{n}") for n in range(1, BLEU_MAX_ORDER + 1)]
    t = [F.col(f"t{n}") for n in range(1, BLEU_MAX_ORDER + 1)]
    score = bleu_score(m, t, F.col("sys_len"), F.col("ref_len"))
    return st.select(*by, F.round(score, digits).alias("bleu"), *m, *t, "sys_len", "ref_len")


# ---------------------------------------------------------------------------
# ROUGE
# ---------------------------------------------------------------------------


def _f(m: Column, p: Column, r: Column) -> Column:
    """F-measure of an overlap count: 2m/(|pred|+|ref|), 0 when m = 0."""
    return F.when(m > 0, F.lit(2.0) * m / (p + r)).otherwise(F.lit(0.0))


def rouge_pair_scores(
    df: DataFrame,
    pred: str = "pred",
    ref: str = "ref",
    id_cols: Sequence[str] = ("pair_id",),
    carry: Sequence[str] = (),
    kinds: Sequence[str] = ("rouge1", "rouge2", "rougeL", "rougeLsum"),
    hashed: bool = False,
    dealt: bool = False,
) -> DataFrame:
    """Per pair, the requested ROUGE F-measures in one linear pass: the rows are
    hash-partitioned on the id once, which spreads the LCS work (Arrow UDF) over
    all tasks however the input was split; the LCS-based scores ride as grouping
    keys through the grouping of the n-gram counts, which that partitioning serves too if there are
    none — nothing is joined back and the input is read once.  ``dealt``: the rows are spread over the
    tasks already, so their texts move only to that grouping."""
    kinds = list(kinds)
    orders = sorted(int(k[len("rouge"):]) for k in kinds if k[len("rouge"):].isdigit())
    pt, rt = rouge_tokens(col_(pred)), rouge_tokens(col_(ref))
    x = df.select(*carry, *id_cols, *dict.fromkeys(c for c in (pred, ref) if c not in id_cols))
    x = x if dealt else x.repartition(*[F.col(c) for c in id_cols])
    x = x.select(*carry, *id_cols, pt.alias("_p"), rt.alias("_r"), col_(pred).alias("_pt"), col_(ref).alias("_rt"))
    lcs_cols = []
    if "rougeL" in kinds:
        lcs_cols.append(_f(lcs.lcs_length(F.col("_p"), F.col("_r")), F.size("_p"), F.size("_r")).alias("rougeL"))
    if "rougeLsum" in kinds:
        ps = F.transform(rouge_sentences(F.col("_pt")), lambda s: rouge_tokens(s))
        rs = F.transform(rouge_sentences(F.col("_rt")), lambda s: rouge_tokens(s))
        x = x.withColumn("_ps", ps).withColumn("_rs", rs)
        lcs_cols.append(
            _f(lcs.summary_lcs_hits(F.col("_rs"), F.col("_ps")),
               F.aggregate("_ps", F.lit(0), lambda a, s: a + F.size(s)),
               F.aggregate("_rs", F.lit(0), lambda a, s: a + F.size(s))).alias("rougeLsum")
        )
    x = x.select(*carry, *id_cols, "_p", "_r", *lcs_cols)
    lcs_names = [c for c in ("rougeL", "rougeLsum") if c in kinds]
    if not orders:
        return x.select(*carry, *id_cols, *lcs_names)
    counts = gram_counts(x, id_cols, F.col("_p"), F.col("_r"), max(orders), carry=[*carry, *lcs_names], sentinel=True, hashed=hashed, dealt=True)
    out = counts.select(*carry, *lcs_names, *id_cols, *[_f(F.col(f"m{n}"), F.col(f"ch{n}"), F.col(f"cr{n}")).alias(f"rouge{n}") for n in orders])
    return out.select(*carry, *id_cols, *[k for k in kinds])


def rouge_n(df: DataFrame, pred: str = "pred", ref: str = "ref", id_cols: Sequence[str] = ("pair_id",), orders: Sequence[int] = (1, 2), carry: Sequence[str] = ()) -> DataFrame:
    """AGG-9: per pair, ROUGE-n F-measure for each n in ``orders`` (columns ``rouge{n}``)."""
    return rouge_pair_scores(df, pred, ref, id_cols, carry, [f"rouge{n}" for n in orders])


def rouge_l(df: DataFrame, pred: str = "pred", ref: str = "ref", id_cols: Sequence[str] = ("pair_id",), carry: Sequence[str] = ()) -> DataFrame:
    """AGG-10: per pair, ROUGE-L F-measure from the token LCS (bit-parallel, Arrow UDF)."""
    return rouge_pair_scores(df, pred, ref, id_cols, carry, ["rougeL"])


def rouge_lsum(df: DataFrame, pred: str = "pred", ref: str = "ref", id_cols: Sequence[str] = ("pair_id",), carry: Sequence[str] = ()) -> DataFrame:
    """AGG-11: per pair, summary-level ROUGE-L: texts split on newlines, union
    LCS of each reference sentence against all prediction sentences, with
    per-token clipping (Arrow UDF)."""
    return rouge_pair_scores(df, pred, ref, id_cols, carry, ["rougeLsum"])


def rouge_all(df: DataFrame, pred: str = "pred", ref: str = "ref", id_cols: Sequence[str] = ("pair_id",), carry: Sequence[str] = ()) -> DataFrame:
    """Per pair: rouge1, rouge2, rougeL, rougeLsum (the validation-step scores)."""
    return rouge_pair_scores(df, pred, ref, id_cols, carry)


ROUGE_COLS = ("rouge1", "rouge2", "rougeL", "rougeLsum")


def rouge_epoch(per_pair: DataFrame, batch_col: str = "batch_id", cols: Sequence[str] = ROUGE_COLS, by: Sequence[str] = (), rank_col: str | None = None) -> DataFrame:
    """AGG-12: mean of each ROUGE inside a batch, then the unweighted mean of
    the batch means (and of rank means when ``rank_col`` is given)."""
    from lexiflow.operators.losses import mean_of_batches

    return mean_of_batches(per_pair, list(cols), batch_col=batch_col, by=by, rank_col=rank_col)


def average_rouge(epoch: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """AGG-13: (rouge1 + rouge2 + rougeL) / 3 — Lsum left out, as in the reference."""
    return epoch.select(*by, *[c for c in epoch.columns if c not in by],
                        ((F.col("rouge1") + F.col("rouge2") + F.col("rougeL")) / F.lit(3.0)).alias("average_rouge"))


def concat_outputs(*frames: DataFrame) -> DataFrame:
    """SET-1: bag union of result sets (duplicates kept)."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def pair_predictions(refs: DataFrame, preds: DataFrame, keys: Sequence[str] = ("split", "row_id")) -> DataFrame:
    """JN-2: reference text with the prediction of the same example (equi inner join)."""
    return refs.join(preds, on=list(keys), how="inner")
