"""Longest common subsequence helpers for ROUGE-L and ROUGE-Lsum.

Spark has no LCS built-in and a nested ``aggregate`` over two arrays is
interpreted row by row, so these run as Arrow-batched pandas UDFs: Spark
partitions the pairs, each task gets column batches, and per pair the work is
a bit-parallel LCS (Allison–Dix / Hyyrö 2004) on Python integers, one word
operation per 64 tokens.  The plain-Python dynamic programme in the tests is
the brute-force check.
"""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import LongType


def _match_masks(b) -> dict:
    masks: dict = {}
    for j, tok in enumerate(b):
        masks[tok] = masks.get(tok, 0) | (1 << j)
    return masks


def lcs_len(a, b) -> int:
    """Length of the LCS of two token sequences."""
    if len(a) == 0 or len(b) == 0:
        return 0
    if len(a) > len(b):  # loop over the shorter side, bits over the longer
        a, b = b, a
    masks = _match_masks(b)
    full = (1 << len(b)) - 1
    v = full
    for tok in a:
        m = masks.get(tok)
        if m is None:
            continue
        u = v & m
        v = ((v + u) | (v - u)) & full
    return len(b) - v.bit_count()


def lcs_indices(r, c, masks: dict | None = None) -> list[int]:
    """Indices into ``r`` of one LCS of ``r`` and ``c`` (``masks``: the match masks of
    ``c``), backtracking from the end: a match is taken, else move left in ``c`` when that
    keeps a strictly longer prefix LCS, else move up in ``r`` (the scorer's tie rule)."""
    nr, nc = len(r), len(c)
    if nr == 0 or nc == 0:
        return []
    masks = _match_masks(c) if masks is None else masks
    full = (1 << nc) - 1
    rows = [full]  # rows[i]: bit j set <=> T(i, j+1) == T(i, j)
    v = full
    for tok in r:
        m = masks.get(tok)
        if m is not None:
            u = v & m
            v = ((v + u) | (v - u)) & full
        rows.append(v)

    def t(i: int, j: int) -> int:  # LCS length of r[:i], c[:j]
        return (~rows[i] & ((1 << j) - 1)).bit_count()

    out: list[int] = []
    i, j = nr, nc
    while i > 0 and j > 0:
        if r[i - 1] == c[j - 1]:
            out.append(i - 1)
            i -= 1
            j -= 1
        elif t(i, j - 1) > t(i - 1, j):
            j -= 1
        else:
            i -= 1
    out.reverse()
    return out


def summary_hits(ref_sents, pred_sents) -> int:
    """Clipped union-LCS hit count of summary-level ROUGE-L."""
    ref_sents = [list(s) for s in ref_sents]
    pred_sents = [list(s) for s in pred_sents]
    if not ref_sents or not pred_sents:
        return 0
    if not sum(map(len, ref_sents)) or not sum(map(len, pred_sents)):
        return 0
    cnt_r = Counter(t for s in ref_sents for t in s)
    cnt_c = Counter(t for s in pred_sents for t in s)
    hits = 0
    pred_masks = [_match_masks(c) for c in pred_sents]  # once, not for each reference sentence
    for r in ref_sents:
        union: set[int] = set()
        rset = set(r)
        for c, masks in zip(pred_sents, pred_masks):
            if rset.isdisjoint(masks):
                continue
            union.update(lcs_indices(r, c, masks))
        for i in sorted(union):
            tok = r[i]
            if cnt_c[tok] > 0 and cnt_r[tok] > 0:
                hits += 1
                cnt_c[tok] -= 1
                cnt_r[tok] -= 1
    return hits


def _seq(x):
    return [] if x is None else x


@pandas_udf(LongType())
def lcs_length(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([lcs_len(_seq(x), _seq(y)) for x, y in zip(a, b)], dtype="int64")


@pandas_udf(LongType())
def summary_lcs_hits(ref_sents: pd.Series, pred_sents: pd.Series) -> pd.Series:
    return pd.Series([summary_hits(_seq(r), _seq(p)) for r, p in zip(ref_sents, pred_sents)], dtype="int64")
