"""Merkle manifest of a table by concatenated-level strings (operator 13).

Every row becomes a leaf: the SHA-256 of its fields, each with its length.  Within a
group (source) the leaves are ordered and every three consecutive nodes become one,
until a single one, the group's subroot, remains; the subroots give the root likewise.

An aligned block of ``SPAN`` consecutive nodes keeps each of its levels as *one string*
of 64-character digests.  A parent is the hash of a fixed-width substring (the run of
its children), and a node's siblings are what flanks its own 64 characters in that
substring.  The tops of the blocks are the nodes of the next tier, and so on, so each
tier has ``SPAN`` times fewer rows; what lies above a block is joined to the block, once
for all its rows.  Rows are placed by a range-partitioned sort (equal shares whatever
the keys), so neither a hot source nor a repeated row lands in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexiflow.llm.common import cut

#: Children of a node; levels of a block; nodes of a block; characters of a digest.
FANOUT, LEVELS, DIGEST = 3, 6, 64
SPAN = FANOUT**LEVELS
RUN = FANOUT * DIGEST


def _h(text: Column) -> Column:
    return F.sha2(text, 256)


def record_hash(values: Sequence[Column]) -> Column:
    """H of the values in order: ``-`` for null, else UTF-8 byte count, ``:`` and the value."""
    texts = [v.cast("string") for v in values]
    return _h(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))


def _placed(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with ``pos``, their place in their group ``g`` in the order given, and ``n``, the group's size.

    ``order`` must tell rows apart up to exchangeable ones."""
    rows = cut(rows.orderBy("g", *order).withColumn("at", F.monotonically_increasing_id()))
    rows = rows.withColumn("part", F.shiftright("at", 33))
    runs = rows.groupBy("g", "part").agg(F.count("*").alias("rows"), F.min("at").alias("first"))
    group = Window.partitionBy("g")  # one row for each partition that the group touches
    before = F.coalesce(F.sum("rows").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select("g", "part", "first", before.alias("before"), F.sum("rows").over(group).alias("n"))
    return rows.join(runs, ["g", "part"]).withColumn("pos", F.col("before") + F.col("at") - F.col("first")).drop("at", "part", "first", "before")


def _parents(level: Column) -> Column:
    """The next level of a level string: one digest for each run of ``FANOUT``."""
    runs = F.sequence(F.lit(0), F.ceil(F.length(level) / RUN).cast("int") - 1)
    return F.array_join(F.transform(runs, lambda i: _h(F.substr(level, i * RUN + 1, F.lit(RUN)))), "")


def _blocks(nodes: DataFrame, carried: Sequence[str]) -> DataFrame:
    """(g, n, block, members, levels): the level strings of each block, its top the last.

    A block of a larger group always climbs ``LEVELS`` levels, a lone one until one node remains."""
    block = F.floor(F.col("pos") / SPAN).cast("long").alias("block")
    found = nodes.groupBy("g", "n", block).agg(F.sort_array(F.collect_list(F.struct("pos", "node", *carried))).alias("members"))
    leaves = F.array_join(F.col("members.node"), "")

    def climb(levels: Column, _: Column) -> Column:
        top = F.element_at(levels, -1)
        return F.when((F.col("n") > SPAN) | (F.length(top) > DIGEST), F.concat(levels, F.array(_parents(top)))).otherwise(levels)

    return cut(found.withColumn("levels", F.aggregate(F.sequence(F.lit(1), F.lit(LEVELS)), F.array(leaves), climb)))


def _flanks(levels: Column, pos: Column) -> Column:
    """For each level below the top, what stands left and right of the node's own digest in its run."""
    width = F.array(*[F.lit(FANOUT**i) for i in range(LEVELS + 1)])

    def at(level: Column, i: Column) -> Column:
        node = F.floor(pos % SPAN / F.element_at(width, i + 1)).cast("int")
        run = F.substr(level, F.floor(node / FANOUT).cast("int") * RUN + 1, F.lit(RUN))
        own = node % FANOUT * DIGEST
        return F.struct(F.substr(run, F.lit(1), own).alias("left"), F.substr(run, own + DIGEST + 1, F.lit(RUN)).alias("right"))

    return F.transform(F.slice(levels, 1, F.size(levels) - 1), at)


def _climbed(nodes: DataFrame, carried: Sequence[str]) -> DataFrame:
    """The blocks of ``nodes`` (g, pos, n, node, *carried) with ``top``, the last node of their group,
    and ``above``, the flanks from the block to it."""
    blocks = _blocks(nodes, carried)
    own_top = F.element_at("levels", -1)
    nothing = F.array().cast("array<struct<left: string, right: string>>")
    if blocks.where(F.col("n") > SPAN).isEmpty():
        return blocks.withColumn("top", own_top).withColumn("above", nothing)
    tier = blocks.select("g", F.col("block").alias("pos"), F.ceil(F.col("n") / SPAN).cast("long").alias("n"), own_top.alias("node"))
    upper = _members(_climbed(tier, [])).select("g", F.col("pos").alias("block"), "top", F.col("path").alias("above"))
    return blocks.join(upper, ["g", "block"])


def _members(blocks: DataFrame) -> DataFrame:
    """One row for each node of the blocks, with the ``path`` of flanks from it to the top."""
    rows = blocks.select("g", "top", "levels", "above", F.explode("members").alias("m")).select("g", "top", "levels", "above", "m.*")
    return rows.withColumn("path", F.concat(_flanks(F.col("levels"), F.col("pos")), "above")).drop("levels", "above")


def fold(leaf: Column, path: Column) -> Column:
    """The digest at the end of ``path`` (flanks from leaf to root) for this leaf."""
    return F.aggregate(path, leaf, lambda h, s: _h(F.concat(s["left"], h, s["right"])))


def manifest(
    df: DataFrame,
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    id_col: str = "doc_id",
    group_col: str = "source",
    altered: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row (id, leaf, now, subroot, root, path) per row of ``df``.

    ``path`` lists the flanks (left, right) from the leaf over the subroot to the root;
    ``now`` is the leaf of the row with the ``altered`` fields put in place of its own.
    Order: ids ascend within a group, null first, equal ids by leaf (equal rows are
    exchangeable); groups ascend bytewise, the null group first, apart from an empty name.
    A lone leaf is its subroot, a lone subroot the root, and their path has no flanks.
    Null and empty texts are told apart by the leaf, very long ones are hashed whole,
    columns that aren't named don't count, and an empty table gives no rows.
    """
    altered = altered or {}
    group = F.col(group_col).cast("string")
    g = F.coalesce(F.concat(F.lit("1"), group), F.lit("0"))  # one key, in the order of the groups
    leaf = record_hash([F.col(c) for c in fields])
    now = record_hash([altered.get(c, F.col(c)) for c in fields]) if altered else leaf
    # `tie` spreads repeated rows over the ranges of the sort
    leaves = cut(df.select(g.alias("g"), F.col(id_col).alias("id"), leaf.alias("node"), now.alias("now"), F.monotonically_increasing_id().alias("tie")))
    blocks = _climbed(_placed(leaves, "id", "node", "tie").drop("tie"), ["id", "now"])
    subroots = blocks.select("g", "top").distinct().select(F.lit("").alias("g"), F.col("g").alias("of"), F.col("top").alias("node"))
    roots = _members(_climbed(_placed(subroots, "of"), ["of"]))
    roots = roots.select(F.col("of").alias("g"), F.col("top").alias("root"), F.col("path").alias("rest"))
    rows = _members(blocks.join(roots, "g").withColumn("above", F.concat("above", "rest")).withColumn("top", F.struct("top", "root")).drop("rest"))
    return rows.select(F.col("id").alias(id_col), F.col("node").alias("leaf"), "now", F.col("top.top").alias("subroot"), F.col("top.root").alias("root"), "path")


def verify(rows: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The digests of a manifest's rows: proof_sha256 (H of all flanks), folded_root (from ``now``), verified."""
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    folded = rows.withColumn("proof_sha256", _h(siblings)).withColumn("folded_root", fold(F.col("now"), F.col("path")))
    return folded.select(id_col, "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def without_newlines(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The tampered text: line feeds go where 2 divides the crc32 of the decimal id (a null id is left alone)."""
    even = F.crc32(F.col(id_col).cast("string")) % 2 == 0
    return F.when(even, F.replace(F.col(text_col), F.lit("\n"), F.lit(""))).otherwise(F.col(text_col))


_FIELD = "coalesce(strlen({0}) || ':' || {0}, '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(f"CAST({c} AS VARCHAR)") for c in ("doc_id", "source", "lang", "n_chars")) + " || " + _FIELD.format("{0}") + ")"
#: crc32 as a fold over the bits: a code point is put in, eight times -1 shifts.
_CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
  lambda c: list_concat([ord(c)::BIGINT], [-1, -1, -1, -1, -1, -1, -1, -1]::BIGINT[])))),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384::BIGINT) ELSE a // 2 END), 4294967295::BIGINT)"""


def _tree_sql(nodes: str) -> str:
    """Recursive CTE body: (lvl, g, idx, node, more) of all levels over ``nodes`` (g, idx, node)."""
    return f"""SELECT 0 AS lvl, g, idx, node, count(*) OVER (PARTITION BY g) > 1 AS more FROM {nodes}
  UNION ALL
  SELECT lvl, g, idx, node, count(*) OVER (PARTITION BY g) > 1 FROM (
    SELECT lvl + 1 AS lvl, g, idx // {FANOUT} AS idx, sha256(string_agg(node, '' ORDER BY idx)) AS node FROM {{0}} WHERE more GROUP BY lvl, g, idx // {FANOUT})"""


def _runs_sql(tree: str) -> str:
    return f"SELECT lvl, g, idx // {FANOUT} AS run, list(node ORDER BY idx) AS nodes FROM {tree} WHERE more GROUP BY lvl, g, idx // {FANOUT}"


def _step_sql(walk: str, runs: str) -> str:
    left = f"array_to_string(r.nodes[1:w.at % {FANOUT}], '')"
    right = f"array_to_string(r.nodes[w.at % {FANOUT} + 2:{FANOUT}], '')"
    return f"""SELECT w.id, w.lvl + 1 AS lvl, w.g, w.at // {FANOUT} AS at, sha256({left} || w.h || {right}) AS h, w.proof || {left} || {right} AS proof
  FROM {walk} w JOIN {runs} r ON r.lvl = w.lvl AND r.g = w.g AND r.run = w.at // {FANOUT}"""


#: DuckDB twin: the tree level by level, and every row's way to the root.
ORACLE = f"""
WITH RECURSIVE l AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce('1' || source, '0') AS g, {_LEAF.format('text')} AS leaf,
         {_LEAF.format("(CASE WHEN " + _CRC + " % 2 = 0 THEN replace(text, chr(10), '') ELSE text END)")} AS now
  FROM documents),
p AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM l),
n0 AS (SELECT g, idx, leaf AS node FROM p),
t AS ({_tree_sql('n0').format('t')}),
r AS ({_runs_sql('t')}),
n1 AS (SELECT '' AS g, g AS of, row_number() OVER (ORDER BY g) - 1 AS idx, node FROM t WHERE NOT more),
t1 AS ({_tree_sql('n1').format('t1')}),
r1 AS ({_runs_sql('t1')}),
w AS (SELECT id, 0 AS lvl, g, idx AS at, now AS h, '' AS proof FROM p
  UNION ALL {_step_sql('w', 'r')}),
s AS (SELECT w.id, 0 AS lvl, n1.g, n1.idx AS at, w.h, w.proof FROM (SELECT id, arg_max(g, lvl) AS g, arg_max(h, lvl) AS h, arg_max(proof, lvl) AS proof FROM w GROUP BY id) w
  JOIN n1 ON n1.of = w.g
  UNION ALL {_step_sql('s', 'r1')}),
e AS (SELECT id, arg_max(h, lvl) AS h, arg_max(proof, lvl) AS proof FROM s GROUP BY id)
SELECT p.doc_id, p.leaf, n1.node AS subroot, root.node AS root, sha256(e.proof) AS proof_sha256, e.h AS folded_root, e.h = root.node AS verified
FROM p JOIN e ON e.id = p.id JOIN n1 ON n1.of = p.g, (SELECT node FROM t1 WHERE NOT more) root"""
