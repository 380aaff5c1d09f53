"""Ranked lexical search in document FP-trees (operator 11).

The terms of the items restrict every document to a short vector (term, tf).  The terms of
a vector stand by falling document frequency, so documents that share their frequent
terms share a path of a trie (an FP-tree of documents).  Each node keeps the largest tf
of every term and the smallest ``m`` below it; a score rises with tf and falls with m, so
these bound all scores of its subtree.  For every item a depth-first search visits the
children of the best bound first and leaves out what can't reach the ten best so far.

A task builds one tree after another over its own documents and keeps each item's best
from tree to tree, so later trees are cut sooner, and hands on ten rows an item.  Items
are searched in blocks whose text is bounded; every block meets all documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexiflow.llm.common import cut

TOP = 10
#: Characters of items that are searched together (bounds what is shipped to the tasks).
BLOCK_CHARS = 2_000_000
#: Documents of a tree at most, and (node, term) cells of its table of bounds at most.
TREE_DOCS, TREE_CELLS = 4096, 16_000_000
#: Groups into which an item's found rows are dealt before the last ranking.
SHARES = 32

#: Bytes that end a term become spaces; A-Z become lower case.  Bytes of other characters are term bytes.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """The terms of a text: runs of ASCII letters and digits and of all characters beyond ASCII; A-Z lower case."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def length_term(n: int, docs: int, total: int) -> int:
    return 100 - 90 + (90 * n * docs) // total


class Tree:
    """The FP-tree of documents given as ``terms`` (ranks by frequency, ascending in each), ``tfs``, ``ms``, ``ids``.

    Nodes are numbered so that the children of a node follow each other.  Unbranched paths
    are one node.  Below the node of a path stand its entries: documents of equal vector
    and m, as a list of ascending ids (null last).
    """

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], ms: list[int], ids: list):
        entries: dict[tuple, list] = {}
        for (t, f), m, i in zip(vectors, ms, ids):
            # big-endian bytes compare like the sequences of ranks
            entries.setdefault((t.astype(">u4").tobytes(), f.tobytes(), m), []).append(i)
        keys = sorted(entries)
        self.ids = [sorted(entries[k], key=lambda i: (i is None, 0 if i is None else i)) for k in keys]
        paths = [np.frombuffer(k[0], ">u4") for k in keys]
        self.columns = np.unique(np.concatenate(paths)) if paths else np.zeros(0, np.uint32)
        # nodes are (entry, children); open ones are on the stack with their depth
        stack: list[tuple[int, list]] = [(0, [])]
        for e, path in enumerate(paths):
            if e:
                both = min(len(path), len(paths[e - 1]))
                differ = np.flatnonzero(path[:both] != paths[e - 1][:both])
                shared = int(differ[0]) if len(differ) else both
                while stack[-1][0] > shared:
                    node = (-1, stack.pop()[1])
                    if stack[-1][0] < shared:  # the path branches within an edge
                        stack.append((shared, [node]))
                    else:
                        stack[-1][1].append(node)
            if len(path) > stack[-1][0]:
                stack.append((len(path), []))
            stack[-1][1].append((e, []))
        while len(stack) > 1:
            node = (-1, stack.pop()[1])
            stack[-1][1].append(node)
        nodes, self.child, self.entry = [(-1, stack[0][1])], [], []
        for entry, below in nodes:  # grows while it is read: breadth first
            while len(below) == 1:  # an unbranched path
                entry, below = below[0]
            self.child.append((len(nodes), len(nodes) + len(below)))
            self.entry.append(entry)
            nodes += below
        self._fill(paths, [np.frombuffer(k[1], np.int64) for k in keys], [k[2] for k in keys])

    def _fill(self, paths: list, tfs: list, ms: list) -> None:
        self.tf = np.zeros((len(self.child), len(self.columns)), np.int32)
        self.m = np.zeros(len(self.child), np.int64)
        for v in range(len(self.child) - 1, -1, -1):
            e, (low, high) = self.entry[v], self.child[v]
            if e >= 0:
                self.tf[v, np.searchsorted(self.columns, paths[e])] = tfs[e]
                self.m[v] = ms[e]
            elif high > low:
                self.tf[v], self.m[v] = self.tf[low:high].max(0), self.m[low:high].min()

    def search(self, item: np.ndarray, weights: np.ndarray, best: list[tuple]) -> int:
        """Puts the documents of largest scores into ``best`` ((-score, id is null, id), ascending, ``TOP``
        at most) for an item of ``item`` terms (ranks); returns the number of nodes whose bound was taken."""
        at = np.searchsorted(self.columns, item)
        here = at < len(self.columns)
        here[here] = self.columns[at[here]] == item[here]
        at, weights = at[here], weights[here]
        if not len(at) or not self.ids:
            return 0
        seen, stack = 1, [(math.inf, 0)]
        while stack:
            bound, v = stack.pop()
            # documents of equal score and a smaller id still go before the last one
            if bound <= 0 or len(best) == TOP and -best[-1][0] > bound:
                continue
            e, (low, high) = self.entry[v], self.child[v]
            if e >= 0:
                if math.isinf(bound):
                    bound = int(self._bounds(slice(v, v + 1), at, weights)[0])
                for i in self.ids[e][:TOP] if bound > 0 else ():
                    found = (-bound, i is None, i if i is not None else 0)
                    if len(best) < TOP or found < best[-1]:
                        best.append(found)
                        best.sort()
                        del best[TOP:]
                continue
            bounds = self._bounds(slice(low, high), at, weights)
            seen += high - low
            least = -best[-1][0] if len(best) == TOP else 1
            good = np.flatnonzero(bounds >= max(least, 1))
            for k in good[np.argsort(bounds[good], kind="stable")]:  # the best is taken from the stack first
                stack.append((int(bounds[k]), low + int(k)))
        return seen

    def _bounds(self, nodes: slice, at: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The score that tf maxima and m minima allow; of an entry, its score."""
        tf = self.tf[nodes][:, at].astype(np.int64)
        return (weights * ((1_000_000_000 * tf) // (1000 * tf + 8 * self.m[nodes, None]))).sum(1)


def _vectors(text: Column, wanted: dict[bytes, int]) -> Column:
    """Struct (n, terms, tfs): number of all terms of a text, and its wanted ones with their tf."""

    @F.arrow_udf("struct<n: bigint, terms: array<int>, tfs: array<int>>")
    def run(texts: pa.Array) -> pa.Array:
        sizes, held, times = [], [], []
        for t in texts:
            found = terms(t.as_py())
            counts = Counter(filter(wanted.__contains__, found))
            sizes.append(len(found))
            held.append([wanted[w] for w in counts])
            times.append(list(counts.values()))
        lists = pa.list_(pa.int32())
        return pa.StructArray.from_arrays([pa.array(sizes, pa.int64()), pa.array(held, lists), pa.array(times, lists)], names=["n", "terms", "tfs"])

    return run(text)


def _searcher(items: list[tuple[np.ndarray, np.ndarray]], rank: np.ndarray, docs: int, total: int):
    """Function for mapInArrow over (id, n, terms, tfs): the best of its documents for every item, (k, id, score)."""
    tree_docs = max(64, min(TREE_DOCS, TREE_CELLS // max(2 * len(rank), 1)))

    def trees(batches, kinds: list) -> Iterator[Tree]:
        vectors, ms, ids = [], [], []
        for batch in batches:
            kinds.append(batch["id"].type)
            for i, n, held, tfs in zip(*[batch[c] for c in ("id", "n", "terms", "tfs")]):
                ranks = rank[held.values.to_numpy()]
                order = np.argsort(ranks)
                vectors.append((ranks[order], tfs.values.to_numpy()[order].astype(np.int64)))
                ms.append(length_term(n.as_py(), docs, total))
                ids.append(i.as_py())
                if len(ids) == tree_docs:
                    yield Tree(vectors, ms, ids)
                    vectors, ms, ids = [], [], []
        if ids:
            yield Tree(vectors, ms, ids)

    def run(batches):
        best: list[list] = [[] for _ in items]
        kinds: list[pa.DataType] = []
        for tree in trees(batches, kinds):
            for found, (item, weights) in zip(best, items):
                tree.search(item, weights, found)
        rows = [(k, None if none else i, -score) for k, found in enumerate(best) for score, none, i in found]
        if rows:
            k, ids, scores = zip(*rows)
            yield pa.record_batch([pa.array(k, pa.int32()), pa.array(ids, kinds[0]), pa.array(scores, pa.int64())], ["k", "id", "score"])

    return run


def _blocks(items: DataFrame) -> Iterator[list]:
    """Lists of (item, terms) with at most ``BLOCK_CHARS`` bytes of terms (or a single item); rows of one id are one item."""
    block: list = []
    size = 0
    for r in items.orderBy("item").toLocalIterator():
        found = set(terms(r["text"]))
        if block and r["item"] == block[-1][0]:
            block[-1][1].update(found)
        elif block and size + sum(map(len, found)) > BLOCK_CHARS:
            yield block
            block, size = [(r["item"], found)], 0
        else:
            block.append((r["item"], found))
        size += sum(map(len, found))
    if block:
        yield block


def _search_block(docs: DataFrame, block: list) -> DataFrame | None:
    """(k, id, score): the best rows of every task for the k-th item of the block; None if there can't be any."""
    wanted = {t: k for k, t in enumerate(sorted(set().union(*[held for _, held in block])))}
    rows = cut(docs.select("id", _vectors(F.col("text"), wanted).alias("v")).select("id", "v.*"))
    count, total = rows.where("n > 0").agg(F.count("*"), F.sum("n")).first()
    if not count or not wanted:
        return None
    df = np.zeros(len(wanted), np.int64)  # of the block's terms: bounded like the block
    for r in rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect():
        df[r["term"]] = r["df"]
    rank = np.empty(len(df), np.int64)
    rank[np.argsort(-df, kind="stable")] = np.arange(len(df))
    weights = np.array([weight(count, int(f)) for f in df], np.int64)
    items = []
    for _, held in block:
        at = np.array(sorted(wanted[t] for t in held), np.int64)
        order = np.argsort(rank[at])
        items.append((rank[at][order], weights[at][order]))
    schema = f"k int, id {docs.schema['id'].dataType.simpleString()}, score bigint"
    return cut(rows.where(F.size("terms") > 0).mapInArrow(_searcher(items, rank, count, total), schema))


def rank_documents(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item, rank, id, score): the ``TOP`` rows of ``docs`` with the highest scores above 0 of every item.

    Equal scores go by ascending id, null last; repeated rows rank one by one.  Rows of
    ``items`` with one id (null too) are one item with the terms of all.  Null and empty
    texts, and those without terms, are found by nothing and find nothing; an empty table
    gives no rows.  Whole texts count, however long; columns that aren't named are not read.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    items = items.select(F.col(item_col).alias("item"), F.col(item_text).alias("text"))
    name, key = (x.simpleString() for x in (items.schema["item"].dataType, docs.schema["id"].dataType))
    found = spark.createDataFrame([], f"item {name}, id {key}, score bigint")
    for block in _blocks(items):
        best = _search_block(docs, block)
        if best is not None:
            names = spark.createDataFrame([(k, i) for k, (i, _) in enumerate(block)], f"k int, item {name}")
            found = found.unionByName(best.join(F.broadcast(names), "k").select("item", "id", "score"))
    order = [F.desc("score"), F.asc_nulls_last("id")]
    # ten rows of every task: ranked within shares first, then the shares' ten best
    share = Window.partitionBy("item", F.pmod(F.xxhash64("id"), F.lit(SHARES))).orderBy(*order)
    few = found.withColumn("rank", F.row_number().over(share)).where(F.col("rank") <= TOP)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= TOP)
    return ranked.select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")


_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
#: DuckDB twin: every document's score for every item.
ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS terms FROM documents WHERE text IS NOT NULL),
g AS (SELECT count(*) AS big_n, sum(len(terms)) AS big_l FROM d WHERE len(terms) > 0),
x AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d) GROUP BY r, term),
f AS (SELECT term, count(*) AS df FROM x GROUP BY term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * df + 1))) AS BIGINT) AS w FROM f, g),
q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
m AS (SELECT r, doc_id, 100 - 90 + CAST((90 * len(terms)::HUGEINT * big_n) // big_l AS BIGINT) AS m FROM d, g),
s AS (SELECT q.item_id, m.r, m.doc_id, CAST(sum(w.w * ((1000000000 * x.tf) // (1000 * x.tf + 8 * m.m))) AS BIGINT) AS score
  FROM q JOIN w ON w.term = q.term JOIN x ON x.term = q.term JOIN m ON m.r = x.r GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0) WHERE rank <= {TOP}"""
