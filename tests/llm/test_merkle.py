"""Operator 13: the tree, proofs and tampering against hashlib."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from lexiflow.llm import merkle as M
from lexiflow.llm.queries import op13_merkle
from tests.conftest import SF_MID

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    values = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return h("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def climb(nodes, proofs):
    """The last node over ``nodes``; proofs[i] gets the (left, right) of node i on the way."""
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        for i, k in enumerate(at):
            run = nodes[k // 3 * 3 : k // 3 * 3 + 3]
            proofs[i].append(("".join(run[: k % 3]), "".join(run[k % 3 + 1 :])))
        nodes = [h("".join(nodes[i : i + 3])) for i in range(0, len(nodes), 3)]
        at = [k // 3 for k in at]
    return nodes[0]


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    subroots, found = [], []
    for name in names:
        held = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        proofs = [[] for _ in held]
        subroots.append(climb([leaf(*r) for r in held], proofs))
        found.append(list(zip(held, proofs)))
    tops = [[] for _ in names]
    root = climb(subroots, tops)
    out = []
    for subroot, held, top in zip(subroots, found, tops):
        for r, proof in held:
            text = r[1]
            if text is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            node = leaf(r[0], text, *r[2:])
            for left, right in proof + top:
                node = h(left + node + right)
            out.append((r[0], leaf(*r), subroot, root, h("".join(a + b for a, b in proof + top)), node, node == root))
    return sorted(out, key=str)


def got(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("g", "node", "pos", "id", "top")})
    return sorted(map(tuple, M.verify(M.manifest(df.repartition(5), altered={"text": M.without_newlines()})).collect()), key=str)


def test_query_equals_hashlib(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    found = sorted(map(tuple, op13_merkle(spark, SF_MID).collect()), key=str)
    assert found == brute(rows)
    assert {r[-1] for r in found} == {True, False}


@pytest.mark.parametrize("levels", [1, 2])
def test_tiers_of_blocks(spark, monkeypatch, levels):
    monkeypatch.setattr(M, "LEVELS", levels)
    monkeypatch.setattr(M, "SPAN", 3**levels)
    random.seed(1)
    sizes = {None: 1, "": 2, "a": 3, "b": 4, "é": 9, "z": 10, "hot": 200, "y": 28}
    rows = [(random.randint(-50, 10**6), random.choice(["x\ny", "", None, "plain", "\n\n"]), "en", s, n) for s, k in sizes.items() for n in range(k)]
    assert got(spark, rows) == brute(rows)


def test_odd_rows(spark):
    same = (5, "a\nb", "en", "s", 3)
    rows = [same, same, same, (5, "other", "en", "s", 3), (None, None, None, None, None), (None, "n\nn", None, "s", 3), (-7, "é\n" * 40_000, "fr", "s", 80_000), (1, "", "", "", 0)]
    assert got(spark, rows) == brute(rows)
    assert got(spark, rows[:1]) == brute(rows[:1])


def test_empty_table(spark):
    assert M.verify(M.manifest(spark.createDataFrame([], SCHEMA))).count() == 0
