"""Operator 3: recall against brute force, and that what is returned is exact."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexiflow.llm import multi_index as M
from lexiflow.llm.queries import op3_multi_index
from tests.conftest import SF_MID


def brute(ids, x, q, k):
    score = M.inner(x, x[q])
    order = [i for i in np.lexsort((ids, -score)) if ids[i] != ids[q]][:k]
    return [(int(ids[i]), float(score[i])) for i in order]


def results(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def test_query_recall_and_exact_scores(spark):
    rows = spark.read.parquet(f"{SF_MID}/embeddings.parquet").orderBy("vec_id").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    got = results(op3_multi_index(spark, SF_MID))
    assert sorted(got) == [i for i in ids.tolist() if i % 20 == 0]
    hits = 0
    for q, found in got.items():
        want = brute(ids, x, int(np.searchsorted(ids, q)), 20)
        hits += len({i for i, _ in want} & {i for i, _ in found})
        assert len(found) == 20 and found == sorted(found, key=lambda f: (-f[1], f[0]))
        score = dict(zip(ids.tolist(), M.inner(x, x[int(np.searchsorted(ids, q))])))
        assert all(s == score[i] for i, s in found)
    assert hits >= 0.9 * 20 * len(got)


def test_probing_retrieves_every_code_within_the_radius():
    random = np.random.default_rng(2)
    for parts in (1, 3, 4):
        codes = random.integers(0, 1 << 16, (400, parts), dtype=np.uint16)
        codes[50:90] = codes[:40] ^ (1 << random.integers(0, 16, (40, parts))).astype(np.uint16)
        index = M.SubstringIndex(codes)
        for radius in (0, 1, 2, 5, 9, 17, 24, 16 * parts):
            for q in codes[:12]:
                far = np.array([sum(bin(int(a) ^ int(b)).count("1") for a, b in zip(c, q)) for c in codes])
                assert index.within(q, radius).tolist() == np.flatnonzero(far <= radius).tolist()


def test_norms_ties_bad_vectors_and_clashing_columns(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK_ROWS", 30)
    monkeypatch.setattr(M, "GROUP_ROWS", 5)
    random = np.random.default_rng(3)
    x = random.normal(size=(120, 6)) * random.uniform(0.5, 3, (120, 1))
    x[40:100] = x[40]  # a hot vector
    rows = [(i, v.tolist(), "e") for i, v in enumerate(x)]
    rows += [(200, None, "e"), (201, [0.0] * 6, "e"), (202, [1.0, None, 0.0, 0.0, 0.0, 0.0], "e"), (203, [math.nan] + [1.0] * 5, "e"), (204, [math.inf] + [1.0] * 5, "e")]
    rows += [(205, [1.0, 2.0], "e"), (206, [], "e"), (None, [1.0] * 6, "e"), (3, x[3].tolist(), "other")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, v string")
    got = results(M.nearest(df, F.col("vec_id") % 10 == 0))
    assert sorted(got) == list(range(0, 120, 10))
    ids = np.arange(120)
    hits = 0
    for q, found in got.items():
        want = brute(ids, x, q, 20)
        hits += len(set(want) & set(found))
        assert len(found) == 20
    assert hits >= 0.9 * 20 * len(got)
    assert got[50] == brute(ids, x, 50, 20)  # ties of the hot vector go to the smaller ids


@pytest.mark.parametrize("n", [0, 1, 2, 5])
def test_small_tables(spark, n):
    df = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(n)], "vec_id long, embedding array<double>")
    got = results(M.nearest(df, F.col("vec_id") % 2 == 0))
    assert {q: len(v) for q, v in got.items()} == {q: n - 1 for q in range(0, n, 2) if n > 1}


def test_the_longest_rows_are_found_though_no_sample_holds_them(spark, monkeypatch):
    sample = M.bounded_sample
    monkeypatch.setattr(M, "bounded_sample", lambda df, n, *by: sample(df.where("vec_id < 600"), n, *by))
    random = np.random.default_rng(5)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    centre = unit(random.normal(size=(1, 32)))
    x = unit(centre + 0.03 * random.normal(size=(600, 32)))  # near each other
    away = random.normal(size=(10, 32))
    away = unit(away - away @ centre.T * centre)
    far = 10 * unit(0.3 * centre + math.sqrt(1 - 0.09) * away)  # cosine 0.3, ten times as long: the best of all
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([x, far]))]
    got = results(M.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") < 20))
    hits = sum(len({i for i, _ in found} & set(range(600, 610))) for found in got.values())
    assert len(got) == 20 and hits == 200  # exact, they need no code
