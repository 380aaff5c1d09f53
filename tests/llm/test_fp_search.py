"""Operator 11: ranked search against a score of every document, and that trees prune."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexiflow.llm import fp_search as S
from lexiflow.llm.queries import op11_fp_search
from tests.conftest import SF_MID

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}
DOC, ITEM = "doc_id bigint, text string", "item_id bigint, text string"


def brute(docs, items, top=10):
    """Every document scored for every item; docs (id, text), items (id, text)."""
    split = lambda t: TERM.findall(t.translate(LOWER)) if t else []
    held = [(i, split(t)) for i, t in docs]
    n_docs, total = sum(bool(t) for _, t in held), sum(len(t) for _, t in held)
    df: dict = {}
    for _, t in held:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    wanted: dict = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(split(t))
    out = []
    for item, ts in wanted.items():
        found = []
        for i, t in held:
            m = 10 + 90 * len(t) * n_docs // total if total else 0
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * (1000000000 * t.count(x) // (1000 * t.count(x) + 8 * m)) for x in ts if x in t)
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(item, k, None if none else i, -s) for k, (s, none, i) in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=str)


def got(df):
    return sorted([(r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()], key=str)


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_MID}/benchmark.parquet").collect()]
    assert got(op11_fp_search(spark, SF_MID)) == brute(docs, items)


ODD = [(1, None), (2, ""), (3, "..., !"), (4, "Tea, tea & TEA"), (4, "Tea, tea & TEA"), (9, "tea tea tea"), (8, "tea tea tea"), (7, "Ünï code x tea"), (None, "tea coffee"), (6, "tea " * 50_000 + "milk")]


@pytest.mark.parametrize("block", [1, 2_000_000])
def test_odd_rows_and_ties(spark, monkeypatch, block):
    monkeypatch.setattr(S, "BLOCK_CHARS", block)  # one item a block, or all together
    items = [(1, "tea"), (1, "milk"), (2, None), (3, "- -"), (None, "coffee TEA"), (5, "ÜNÏ ünï Ünï"), (6, "unknown")]
    docs = spark.createDataFrame(ODD, DOC).withColumns({"item": F.lit(1), "id": F.lit("x"), "score": F.lit(0), "K": F.lit(2)})
    assert got(S.rank_documents(docs, spark.createDataFrame(items, ITEM).withColumn("rank", F.lit(9)))) == brute(ODD, items)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame(ODD, DOC), spark.createDataFrame([(1, "tea")], ITEM)
    assert S.rank_documents(docs.limit(0), items).count() == 0
    assert S.rank_documents(docs, items.limit(0)).count() == 0
    assert S.rank_documents(docs.where("doc_id < 4"), items).count() == 0


def test_many_trees_and_copies(spark, monkeypatch):
    monkeypatch.setattr(S, "TREE_CELLS", 64)  # 64 documents a tree
    random.seed(3)
    docs = [(i, " ".join(random.choices("abcdefghij", k=random.randint(1, 12)))) for i in range(900)] + [(1000 + i, "a b c d") for i in range(600)]
    items = [(i, " ".join(random.sample("abcdefghijk", 4))) for i in range(12)]
    assert got(S.rank_documents(spark.createDataFrame(docs, DOC).repartition(7), spark.createDataFrame(items, ITEM))) == brute(docs, items)


def test_trees_share_paths_and_prune():
    random.seed(5)
    vectors, ms = [], []
    for _ in range(3000):
        t = np.array(sorted(random.sample(range(40), random.randint(1, 6))))
        vectors.append((t, np.array([random.randint(1, 4) for _ in t])))
        ms.append(random.randint(20, 400))
    tree = S.Tree(vectors, ms, list(range(3000)))
    assert sorted(i for ids in tree.ids for i in ids) == list(range(3000))
    weights = np.arange(40, 0, -1) * 100
    for item in (np.array([0, 5]), np.array([3]), np.array([1, 2, 30, 39])):
        best: list = []
        seen = tree.search(item, weights[item], best)
        score = [sum(int(weights[t]) * (10**9 * int(f) // (1000 * int(f) + 8 * m)) for t, f in zip(*v) if t in item) for v, m in zip(vectors, ms)]
        assert best == sorted((-s, False, i) for i, s in enumerate(score) if s)[:10]
        assert seen < 0.5 * len(tree.entry)  # bounds leave out most of the tree
    assert S.Tree([], [], []).search(np.array([1]), np.array([1]), []) == 0
