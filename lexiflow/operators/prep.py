"""Corpus preparation: strip, encode, truncate, start/pad prefix, masks, shift,
length filter, side pairing and alignment check, decode, dataset size
(PRJ-1..8, FLT-1, FLT-3, JN-1, JN-3, CHK-1, AGG-1, AGG-2).

Encoding and decoding look all elements of a row's token (id) arrays up in the
vocabulary by ``lookup.resolve``: frequent ones in a head inside the row's
partition, the rest by an equi-join, at any vocabulary size.  Several
columns go in the same pass.  (A map literal would avoid the join, but Spark
looks up map keys by linear scan, O(vocabulary) per token.)
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lexiflow.functions.text import col_, split_ws, strip_text as strip_expr
from lexiflow.operators.lookup import resolve
from lexiflow.sources.fixtures import BOS_ID, EOS_ID, PAD_ID, SPECIAL_IDS, UNK_ID

def _ids_literal(ids: Sequence[int]) -> Column:
    return F.array(*[F.lit(int(i)) for i in ids]).cast("array<int>")


# --- PRJ-1 ---------------------------------------------------------------------

def strip_text(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """PRJ-1: Python-style ``strip()`` of each column (Unicode whitespace)."""
    return df.select(*[strip_expr(c).alias(c) if c in cols else F.col(c) for c in df.columns])


# --- PRJ-2 / JN-3 ------------------------------------------------------------------

def encode(
    df: DataFrame,
    cols: Mapping[str, str],
    vocab: DataFrame,
    key_cols: Sequence[str] = ("row_id",),
    carry: Sequence[str] = (),
    prefix_ids: Sequence[int] = (BOS_ID,),
    suffix_ids: Sequence[int] = (EOS_ID,),
    unk_id: int = UNK_ID,
    strip: bool = False,
    max_lens: Mapping[str, int] | None = None,
    drop_over: Mapping[str, int] | None = None,
    specials: Mapping[str, tuple[Sequence[int], Sequence[int]]] | None = None,
    head: int | None = None,
) -> DataFrame:
    """PRJ-2: text columns -> ``array<int>`` id columns (``cols``: text -> ids name).

    Whitespace tokens are looked up in ``vocab(token, id)``; unknown tokens
    get ``unk_id``; ``prefix_ids``/``suffix_ids`` wrap the body (begin/end ids
    or a language code); ``specials`` {ids column: (prefix, suffix)} gives a side its
    own.  Returns ``key_cols + carry + ids`` columns.  A null text counts as empty.  The
    vocabulary may have any size: see ``lookup.resolve``, whose ``head`` this is.

    The encoded length is the token count plus the special ids, known before
    any lookup, so both limits act before it:

    * ``max_lens`` {ids column: limit} — PRJ-3 truncation: only the first
      limit − specials tokens are looked up and collected (same result as
      truncating the full array; a huge text never becomes a huge list);
    * ``drop_over`` {ids column: limit} — FLT-1: rows whose encoded length
      exceeds the limit are dropped before the explode.
    """
    keys, wanted, items = list(key_cols), list(carry), list(cols.items())
    wraps = {out: (specials or {}).get(out, (prefix_ids, suffix_ids)) for _, out in items}
    # a row number keeps the length filter above what checks the rows: pushed into an outer join it would take
    # lines without a partner away before they are told of
    x = df.withColumn("_row", F.monotonically_increasing_id()) if drop_over else df
    x = x.select(*keys, *wanted, *(["_row"] if drop_over else []), *[split_ws(strip_expr(c) if strip else F.col(c)).alias(out) for c, out in items])
    for _, out in items:
        n_special = sum(map(len, wraps[out]))
        if drop_over and out in drop_over:
            x = x.where((F.size(out) + F.lit(n_special) <= F.lit(drop_over[out])) & (F.col("_row") >= 0))
        if max_lens and out in max_lens:
            x = x.withColumn(out, F.slice(out, 1, max(max_lens[out] - n_special, 0)))
    g = resolve(x, [*keys, *wanted], [out for _, out in items], vocab, "token", "id", missing=unk_id, head=head)
    outs = [F.concat(_ids_literal(wraps[out][0]), F.col(out).cast("array<int>"), _ids_literal(wraps[out][1])).alias(out) for _, out in items]
    return g.select(*keys, *wanted, *outs)


# --- PRJ-3 / PRJ-4 -------------------------------------------------------------------

def truncate_expr(ids, max_len: int, n_prefix: int = 1, n_suffix: int = 1) -> Column:
    """Cut an encoded array (prefix + body + suffix) to ``max_len`` ids in total;
    the special ids are kept, the body is cut (never below zero ids)."""
    c = col_(ids)
    body_len = F.greatest(F.size(c) - F.lit(n_prefix + n_suffix), F.lit(0))
    keep = F.least(body_len, F.greatest(F.lit(max_len - n_prefix - n_suffix), F.lit(0)))
    head = F.slice(c, 1, n_prefix) if n_prefix else _ids_literal([])
    tail = F.slice(c, -n_suffix, n_suffix) if n_suffix else _ids_literal([])
    body = F.slice(c, F.lit(n_prefix + 1), keep)
    return F.concat(head, body, tail)


def truncate_ids(df: DataFrame, col: str, max_len: int, n_prefix: int = 1, n_suffix: int = 1, out: str | None = None) -> DataFrame:
    """PRJ-3: encode with truncation (the limit includes the special ids)."""
    return df.withColumn(out or col, truncate_expr(col, max_len, n_prefix, n_suffix))


def prepend_start(df: DataFrame, col: str, bos_id: int | None, pad_id: int = PAD_ID, out: str | None = None) -> DataFrame:
    """PRJ-4: when the tokenizer has no begin id, put the pad id in front of the
    target — after truncation, so the length may reach max + 1."""
    if bos_id is not None:
        return df if out is None else df.withColumn(out, F.col(col))
    return df.withColumn(out or col, F.concat(_ids_literal([pad_id]), F.col(col)))


# --- PRJ-5 / PRJ-6 / PRJ-7 --------------------------------------------------------------

def mask_from_length_expr(ids) -> Column:
    return F.array_repeat(F.lit(1), F.size(col_(ids)))


def mask_from_pad_expr(ids, pad_id: int = PAD_ID, as_bool: bool = False) -> Column:
    if as_bool:
        return F.transform(col_(ids), lambda x: x != F.lit(pad_id))
    return F.transform(col_(ids), lambda x: (x != F.lit(pad_id)).cast("int"))


def mask_from_length(df: DataFrame, col: str, out: str) -> DataFrame:
    """PRJ-5: one 1 per id."""
    return df.withColumn(out, mask_from_length_expr(col))


def mask_from_pad(df: DataFrame, col: str, out: str, pad_id: int = PAD_ID, as_bool: bool = False) -> DataFrame:
    """PRJ-6: 1 where id != pad (int for the encoder, boolean for the decoder)."""
    return df.withColumn(out, mask_from_pad_expr(col, pad_id, as_bool))


def shift_targets(df: DataFrame, col: str, decoder_col: str = "decoder_ids", label_col: str = "labels") -> DataFrame:
    """PRJ-7: decoder input = all but the last id, labels = all but the first.
    Apply to padded rows (the reference shifts the padded batch)."""
    n = F.size(col)
    m = F.greatest(n - F.lit(1), F.lit(0))
    return df.withColumn(decoder_col, F.slice(col, 1, m)).withColumn(label_col, F.slice(col, 2, m))


# --- FLT-1 ---------------------------------------------------------------------

def filter_by_length(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """FLT-1: keep a row only if every id column is within its limit (inclusive; drop, never cut)."""
    cond = F.lit(True)
    for c, lim in limits.items():
        cond = cond & (F.size(c) <= F.lit(lim))
    return df.where(cond)


# --- JN-1 / CHK-1 ---------------------------------------------------------------

def pair_aligned(
    src: DataFrame,
    tgt: DataFrame,
    keys: Sequence[str] = ("split", "line_no"),
    src_col: str = "src",
    tgt_col: str = "tgt",
    observation: Observation | None = None,
) -> DataFrame:
    """JN-1 + CHK-1 in one pass: every line paired by ``keys``; a line that only one side has is a fault.

    Without ``observation`` the query fails at the first such line, in the join that pairs
    the lines: nothing is scanned twice.  With one the lines without a partner go, and the
    observation counts, as the pairs are used: n_src, n_tgt, only_src, only_tgt and
    first_bad, the smallest last key among them (read them from it after an action)."""
    keys = list(keys)
    left = src.select(*keys, src_col, F.lit(True).alias("_s"))
    right = tgt.select(*keys, tgt_col, F.lit(True).alias("_t"))
    both = left.join(right, on=keys, how="full_outer")
    lone = F.col("_s").isNull() | F.col("_t").isNull()
    if observation is None:
        names = F.concat_ws(", ", *[F.concat(F.lit(f"{k} "), F.coalesce(F.col(k).cast("string"), F.lit("null"))) for k in keys])
        told = F.raise_error(F.concat(F.lit("sides not aligned: only the "), F.when(F.col("_s").isNull(), F.lit("target")).otherwise(F.lit("source")), F.lit(" has "), names))
        both = both.where(F.when(lone, told).otherwise(F.lit(True)))
    else:
        both = both.observe(
            observation, F.count("_s").alias("n_src"), F.count("_t").alias("n_tgt"), F.count(F.when(F.col("_t").isNull(), 1)).alias("only_src"),
            F.count(F.when(F.col("_s").isNull(), 1)).alias("only_tgt"), F.min(F.when(lone, F.col(keys[-1]))).alias("first_bad"),
        ).where(~lone)
    return both.select(*keys, src_col, tgt_col)


def alignment_report(src: DataFrame, tgt: DataFrame, keys: Sequence[str] = ("split", "line_no")) -> DataFrame:
    """CHK-1 as a table: per group (all keys but the last) n_src, n_tgt, only_src, only_tgt, first_bad.

    Both sides go through one grouping (no join), so a line that a side has twice is counted twice."""
    keys = list(keys)
    marked = src.select(*keys, F.lit(1).alias("_s"), F.lit(0).alias("_t")).unionByName(tgt.select(*keys, F.lit(0).alias("_s"), F.lit(1).alias("_t")))
    lines = marked.groupBy(*keys).agg(F.sum("_s").alias("_s"), F.sum("_t").alias("_t"))
    return lines.groupBy(*keys[:-1]).agg(
        F.sum("_s").alias("n_src"), F.sum("_t").alias("n_tgt"), F.sum(F.greatest(F.col("_s") - F.col("_t"), F.lit(0))).alias("only_src"),
        F.sum(F.greatest(F.col("_t") - F.col("_s"), F.lit(0))).alias("only_tgt"), F.min(F.when(F.col("_s") != F.col("_t"), F.col(keys[-1]))).alias("first_bad"),
    )


def check_aligned(src: DataFrame, tgt: DataFrame, keys: Sequence[str] = ("split", "line_no")) -> DataFrame:
    """CHK-1: one report row per split (n_src, n_tgt, first_bad, aligned); the
    ``aligned`` column raises when the two sides do not have the same lines
    (lazy: evaluating it fails)."""
    keys = list(keys)
    group = [k for k in keys if k != "line_no"]
    s = src.select(*keys, F.lit(1).alias("_s"))
    t = tgt.select(*keys, F.lit(1).alias("_t"))
    j = s.join(t, on=keys, how="full_outer")
    rep = j.groupBy(*group).agg(
        F.count("_s").alias("n_src"),
        F.count("_t").alias("n_tgt"),
        F.min(F.when(F.col("_s").isNull() | F.col("_t").isNull(), F.col("line_no"))).alias("first_bad"),
    )
    msg = F.concat(F.lit("sides not aligned: "), F.col("n_src").cast("string"), F.lit(" vs "),
                   F.col("n_tgt").cast("string"), F.lit(" lines, first bad line "), F.col("first_bad").cast("string"))
    return rep.withColumn("aligned", F.when(F.col("first_bad").isNotNull(), F.raise_error(msg)).otherwise(F.lit(True)))


def pair_sides(src: DataFrame, tgt: DataFrame, keys: Sequence[str] = ("split", "line_no"), src_col: str = "src", tgt_col: str = "tgt") -> DataFrame:
    """JN-1: source line i with target line i (equi inner join on split and line number)."""
    return src.select(*keys, src_col).join(tgt.select(*keys, tgt_col), on=list(keys), how="inner")


# --- PRJ-8 / FLT-3 ----------------------------------------------------------------

def decode_columns(
    df: DataFrame,
    cols: Mapping[str, str],
    vocab: DataFrame,
    key_cols: Sequence[str] = ("row_id",),
    carry: Sequence[str] = (),
    specials: Sequence[int] = SPECIAL_IDS,
    head: int | None = None,
) -> DataFrame:
    """PRJ-8: id columns -> text columns (``cols``: ids -> text name), special
    ids skipped (FLT-3), tokens joined by a space.  One pass for all columns;
    every input row yields a row (empty text when nothing is left)."""
    keys, wanted, items = list(key_cols), list(carry), list(cols.items())

    def without_specials(c):
        out = F.col(c)
        for sp in specials:
            out = F.array_remove(out, int(sp))
        return out

    x = df.select(*keys, *wanted, *[without_specials(c).alias(out) for c, out in items])
    g = resolve(x, [*keys, *wanted], [out for _, out in items], vocab, "id", "token", head=head)
    return g.select(*keys, *wanted, *[F.array_join(out, " ").alias(out) for _, out in items])


def decode(
    df: DataFrame,
    col: str,
    vocab: DataFrame,
    key_cols: Sequence[str] = ("row_id",),
    out: str = "text",
    specials: Sequence[int] = SPECIAL_IDS,
    carry: Sequence[str] = (),
) -> DataFrame:
    """PRJ-8 for one column."""
    return decode_columns(df, {col: out}, vocab, key_cols, carry, specials)


# --- AGG-1 / AGG-2 ----------------------------------------------------------------

def dataset_size(df: DataFrame, splits: Sequence[str] | None = None, split_col: str = "split") -> DataFrame:
    """AGG-1: rows per split, or one total over the listed splits."""
    if splits is None:
        return df.groupBy(split_col).agg(F.count(F.lit(1)).alias("n_rows"))
    return df.agg(F.count(F.when(F.col(split_col).isin(list(splits)), F.lit(1))).alias("n_rows"))


def run_steps_expr(size, epochs: float = 1, devices: int = 1, accum: int = 1, batch_size: int = 1) -> Column:
    """AGG-2: size × epochs ÷ devices ÷ accumulation ÷ batch, true division, in that order."""
    return col_(size).cast("double") * F.lit(float(epochs)) / F.lit(float(devices)) / F.lit(float(accum)) / F.lit(float(batch_size))
