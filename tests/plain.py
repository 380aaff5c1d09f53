"""Plain-Python versions of the metrics, written from their public definitions,
used as brute-force oracles in the tests."""

from __future__ import annotations

import math
import re
from collections import Counter

_R1 = re.compile(r"([\{-\~\[-\` -\&\(-\+\:-\@\/])")
_R2 = re.compile(r"([^0-9])([\.,])")
_R3 = re.compile(r"([\.,])([^0-9])")
_R4 = re.compile(r"([0-9])(-)")


def tok13a(line: str) -> list[str]:
    line = line.rstrip()
    line = line.replace("<skipped>", "").replace("-\n", "").replace("\n", " ")
    if "&" in line:
        line = line.replace("&quot;", '"').replace("&amp;", "&").replace("&lt;", "<").replace("&gt;", ">")
    line = f" {line} "
    line = _R1.sub(r" \1 ", line)
    line = _R2.sub(r"\1 \2 ", line)
    line = _R3.sub(r" \1 \2", line)
    line = _R4.sub(r"\1 \2 ", line)
    return line.split()


def ngrams(toks, n):
    return Counter(tuple(toks[i:i + n]) for i in range(len(toks) - n + 1))


def corpus_bleu(hyps: list[str], refs: list[str]):
    m = [0] * 4
    t = [0] * 4
    sys_len = ref_len = 0
    for h, r in zip(hyps, refs):
        ht, rt = tok13a(h), tok13a(r)
        sys_len += len(ht)
        ref_len += len(rt)
        for n in range(1, 5):
            hc, rc = ngrams(ht, n), ngrams(rt, n)
            m[n - 1] += sum(min(c, rc[g]) for g, c in hc.items())
            t[n - 1] += max(len(ht) - n + 1, 0)
    if sys_len < ref_len:
        bp = math.exp(1 - ref_len / sys_len) if sys_len > 0 else 0.0
    else:
        bp = 1.0
    if not any(m):
        return 0.0, m, t, sys_len, ref_len
    prec = [0.0] * 4
    smooth = 1.0
    for n in range(4):
        if t[n] == 0:
            break
        if m[n] == 0:
            smooth *= 2
            prec[n] = 100.0 / (smooth * t[n])
        else:
            prec[n] = 100.0 * m[n] / t[n]
    logs = [math.log(p) if p > 0 else -9999999999 for p in prec]
    return bp * math.exp(sum(logs) / 4), m, t, sys_len, ref_len


def rouge_tok(text: str) -> list[str]:
    text = re.sub(r"[^a-z0-9]+", " ", text.lower())
    return [x for x in text.split() if re.match(r"^[a-z0-9]+$", x)]


def f1(m, p, r):
    if p == 0 or r == 0:
        return 0.0
    prec, rec = m / p, m / r
    return 0.0 if prec + rec == 0 else 2 * prec * rec / (prec + rec)


def rouge_n(ref: str, pred: str, n: int) -> float:
    rt, pt = ngrams(rouge_tok(ref), n), ngrams(rouge_tok(pred), n)
    m = sum(min(c, rt[g]) for g, c in pt.items())
    return f1(m, sum(pt.values()), sum(rt.values()))


def lcs_table(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            t[i][j] = t[i - 1][j - 1] + 1 if a[i - 1] == b[j - 1] else max(t[i - 1][j], t[i][j - 1])
    return t


def rouge_l(ref: str, pred: str) -> float:
    r, p = rouge_tok(ref), rouge_tok(pred)
    if not r or not p:
        return 0.0
    lcs = lcs_table(r, p)[-1][-1]
    return f1(lcs, len(p), len(r))


def _lcs_ind(r, c):
    t = lcs_table(r, c)
    i, j, out = len(r), len(c), []
    while i > 0 and j > 0:
        if r[i - 1] == c[j - 1]:
            out.insert(0, i - 1)
            i -= 1
            j -= 1
        elif t[i][j - 1] > t[i - 1][j]:
            j -= 1
        else:
            i -= 1
    return out


def rouge_lsum(ref: str, pred: str) -> float:
    rs = [rouge_tok(s) for s in ref.split("\n") if len(s)]
    ps = [rouge_tok(s) for s in pred.split("\n") if len(s)]
    if not rs or not ps:
        return 0.0
    m, n = sum(map(len, rs)), sum(map(len, ps))
    if not m or not n:
        return 0.0
    cr, cc = Counter(x for s in rs for x in s), Counter(x for s in ps for x in s)
    hits = 0
    for r in rs:
        union = sorted(set().union(*[_lcs_ind(r, c) for c in ps]))
        for i in union:
            tok = r[i]
            if cc[tok] > 0 and cr[tok] > 0:
                hits += 1
                cc[tok] -= 1
                cr[tok] -= 1
    return f1(hits, n, m)


def sampler_indices(n: int, world: int, rank: int) -> list[int]:
    """Distributed-sampler index list (no shuffle, no drop_last)."""
    idx = list(range(n))
    total = math.ceil(n / world) * world
    pad = total - n
    if pad <= len(idx):
        idx += idx[:pad]
    else:
        idx += (idx * math.ceil(pad / len(idx)))[:pad]
    return idx[rank:total:world]
