"""Nearest neighbours by multi-index hashing of learned binary codes (operator 3).

Vectors of equal length get the codes of ``ROTATIONS`` learned rotations (iterative
quantisation: a rotation that brings the rotated sample close to its own signs;
each starts from another random one), one bit per dimension and rotation.  Vectors
are first lifted by one dimension to a common length, so that a small angle means
a large inner product.  A code is split into 16-bit substrings, each of which is
indexed: by the pigeonhole principle a code within Hamming radius r of the query
agrees with it up to floor(r / m) bits on one of the m substrings (up to one bit
less on all but the first r mod m + 1), so probing these substrings retrieves every
code within the radius.  What is retrieved and truly within it is reranked by the
inner product of the original vectors in double precision.

The radius is learned on the sample: the Hamming distance within which the asked
share of true neighbours lies.  A query that finds fewer than k rows is asked
again without a radius, so all get k, or all candidates there are.  Rows longer than
any of the sample (about one of ``SAMPLE_ROWS``) can't be lifted, so their angle says
little: they are reranked for every query, whatever their code.

Index rows are dealt to blocks, queries to groups; each (block, group) is one
bounded task that builds the substring tables of its block and keeps k rows per
query.  Both sides are split, so neither has to fit anywhere as a whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lexiflow.llm.common import bounded_sample, cut

#: The codes are learned on so many rows (a bounded sample by hash order), and its radius on so many queries of it.
SAMPLE_ROWS, SAMPLE_QUERIES = 10_000, 500
#: Learned rotations, iterations for each, share of true neighbours within the radius (before the exact rerank).
ROTATIONS, ITERATIONS, SHARE = 4, 20, 0.98
#: Rows of an index block and of a query group: what one task holds.
BLOCK_ROWS, GROUP_ROWS = 16_384, 4_096
#: Neighbours of a query.
K = 20

_BITS = np.array([bin(i).count("1") for i in range(1 << 16)], np.uint8)


class Codes:
    """The lift, the rotations and the radius, learned on a sample."""

    def __init__(self, sample: np.ndarray, k: int = K, seed: int = 7):
        random = np.random.default_rng(seed)
        self.norm = float(np.linalg.norm(sample, axis=1).max()) if len(sample) else 1.0
        lifted = self.lift(sample)
        width = lifted.shape[1]
        spread = lifted.T @ lifted / max(len(lifted), 1)
        _, axes = np.linalg.eigh(spread)
        rotations = []
        for _ in range(ROTATIONS):
            turn = np.linalg.qr(random.normal(size=(width, width)))[0]
            rotated = lifted @ axes
            for _ in range(ITERATIONS):
                left, _, right = np.linalg.svd(np.where(rotated @ turn >= 0, 1.0, -1.0).T @ rotated)
                turn = (left @ right).T
            rotations.append(axes @ turn)
        self.turns = np.hstack(rotations)
        extra = -self.turns.shape[1] % 16  # whole substrings
        self.turns = np.hstack([self.turns, random.normal(size=(width, extra))])
        self.parts = self.turns.shape[1] // 16
        self.radius = self._radius(sample, k, random)

    def lift(self, x: np.ndarray) -> np.ndarray:
        """Index vectors with a last component that gives all the same length (longer ones than in the sample get 0, and are reranked anyway)."""
        rest = np.sqrt(np.maximum(self.norm**2 - (x * x).sum(1), 0))
        return np.hstack([x, rest[:, None]])

    def encode(self, x: np.ndarray, query: bool) -> np.ndarray:
        lifted = np.hstack([x, np.zeros((len(x), 1))]) if query else self.lift(x)
        bits = np.packbits(lifted @ self.turns >= 0, axis=1)
        return np.ascontiguousarray(bits).view(np.uint16).reshape(len(x), self.parts)

    def _radius(self, sample: np.ndarray, k: int, random: np.random.Generator) -> int:
        if len(sample) < 2:
            return self.parts * 16
        asked = random.choice(len(sample), min(SAMPLE_QUERIES, len(sample)), replace=False)
        near = sample[asked] @ sample.T
        near[np.arange(len(asked)), asked] = -np.inf
        k = min(k, len(sample) - 1)
        best = np.argpartition(-near, k - 1, axis=1)[:, :k]
        mine, theirs = self.encode(sample[asked], True), self.encode(sample, False)
        far = np.concatenate([_BITS[mine[i] ^ theirs[best[i]]].sum(1, dtype=np.int64) for i in range(len(asked))])
        return int(np.quantile(far, SHARE, method="higher"))


class SubstringIndex:
    """One table per substring: rows ordered by its value, with the place where each value begins."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.tables = []
        for part in codes.T:
            order = np.argsort(part, kind="stable").astype(np.int32)
            values, begin = np.unique(part[order], return_index=True)
            self.tables.append((order, values, np.append(begin, len(part))))

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """The rows whose code is within ``radius`` of ``code``."""
        parts = len(self.tables)
        least, more = divmod(radius, parts)
        hit = np.zeros(len(self.codes), bool)
        for j, (order, values, begin) in enumerate(self.tables):
            limit = least if j <= more else least - 1
            if limit < 0:
                continue
            for v in np.flatnonzero(_BITS[values ^ code[j]] <= limit) if limit < 4 else ():
                hit[order[begin[v] : begin[v + 1]]] = True
            if limit >= 4:  # most of the values are probed: take them together
                probed = _BITS[values ^ code[j]] <= limit
                hit[order[np.repeat(probed, np.diff(begin))]] = True
                if hit.all():
                    break
        rows = np.flatnonzero(hit)
        return rows[_BITS[self.codes[rows] ^ code].sum(1, dtype=np.int64) <= radius]


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.array(vectors.to_list(), dtype=np.float64).reshape(len(vectors), -1)


_FOUND = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("vec_id", T.LongType()), T.StructField("score", T.DoubleType()), T.StructField("near", T.LongType())])


def _searcher(codes: Codes, k: int, radius: int | None) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    def search(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(rows):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": [], "near": []})
        rows = rows.sort_values("vec_id", kind="stable")
        x, ids = _matrix(rows["v"]), rows["vec_id"].to_numpy()
        asked, q = queries["vec_id"].to_numpy(), _matrix(queries["v"])
        index = SubstringIndex(codes.encode(x, False)) if radius is not None else None
        own = codes.encode(q, True)
        long = np.flatnonzero(np.linalg.norm(x, axis=1) > codes.norm)
        out: list[tuple[np.ndarray, ...]] = []
        for i in range(len(q)):
            at = index.within(own[i], radius) if index else np.arange(len(x))
            at = at[ids[at] != asked[i]]
            near = len(at)
            if index and len(long):
                at = np.union1d(at, long[ids[long] != asked[i]])
            score = inner(x[at], q[i])
            if len(at) > k:  # keep all ties of the k-th, then the smaller ids
                at_least = np.partition(score, len(score) - k)[len(score) - k]
                chosen = np.flatnonzero(score >= at_least)
                at, score = at[chosen], score[chosen]
            order = np.lexsort((ids[at], -score))[:k]
            # the rows within the radius are counted on the first
            out.append((np.full(len(order), asked[i]), ids[at][order], score[order], np.where(np.arange(len(order)) == 0, near, 0)))
        return pd.DataFrame({name: np.concatenate([o[c] for o in out]) for c, name in enumerate(("query_id", "vec_id", "score", "near"))})

    return search


def inner(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products whose value does not depend on which rows are taken together."""
    total = np.zeros(len(x))
    for j in range(x.shape[1]):
        total += x[:, j] * q[j]
    return total


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    near = F.sum("near").over(Window.partitionBy("query_id"))
    return found.withColumn("near", near).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search(queries: DataFrame, rows: DataFrame, n_queries: int, n_rows: int, codes: Codes, k: int, radius: int | None) -> DataFrame:
    blocks, groups = -(-max(n_rows, 1) // BLOCK_ROWS), -(-max(n_queries, 1) // GROUP_ROWS)
    cell = lambda own, n, other, m, first: (
        F.explode(F.transform(F.sequence(F.lit(0), F.lit(m - 1)), lambda o: (F.pmod(F.xxhash64(own), F.lit(n)) * m + o if first else o * n + F.pmod(F.xxhash64(own), F.lit(n)))))
    )
    left = queries.select("vec_id", "v", cell("vec_id", groups, None, blocks, True).alias("cell"))
    right = rows.select("vec_id", "v", cell("vec_id", blocks, None, groups, False).alias("cell"))
    # as many partitions as cells: each task holds one block and one group
    left, right = (d.repartition(blocks * groups, "cell").groupBy("cell") for d in (left, right))
    return _best(left.cogroup(right).applyInPandas(_searcher(codes, k, radius), _FOUND), k)


def nearest(df: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found rows of each query row of ``df``.

    Largest inner product first, ties to the smaller id; a query is not its own
    neighbour (rows that share its id are its own).  Vectors that are null, empty,
    zero, hold null or non-finite components, or have another length than most of
    the sample's take no part, neither do null ids; of rows that repeat an id and a
    vector one counts.  With fewer than ``k`` candidates all are returned.  An empty
    table or one without queries gives no rows.
    """
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    fine = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(fine)
    widths = rows.groupBy(F.size("v").alias("w")).count().orderBy(F.desc("count"), "w").limit(1).collect()
    if not widths:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = cut(rows.where(F.size("v") == widths[0].w).dropDuplicates())
    sample = np.array([r.v for r in bounded_sample(rows.select("vec_id", "v"), SAMPLE_ROWS, F.col("vec_id"), F.col("v"))])
    codes = Codes(sample, k)
    queries = rows.where("asks").select("vec_id", "v")
    n_rows, n_queries = rows.count(), queries.count()
    found = cut(_search(queries, rows.select("vec_id", "v"), n_queries, n_rows, codes, k, codes.radius))
    many = found.where(F.col("near") >= k).select("query_id").distinct()
    short = queries.join(many, queries.vec_id == many.query_id, "left_anti")
    short = cut(short)
    n_short = short.count()
    if n_short:
        again = cut(_search(short, rows.select("vec_id", "v"), n_short, n_rows, codes, k, None))
        found = found.join(short.select(F.col("vec_id").alias("query_id")).distinct(), "query_id", "left_anti").unionByName(again)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
