"""Token lookup at any vocabulary size (JN-3) by a heavy-hitter split.

Rows bring arrays of tokens, one array a side; every token has to meet its entry of a
table that may be too large to broadcast, and a few tokens make up much of any text.
No occurrence becomes a row of its own: arrays stay whole, Arrow looks their elements up.

1. *Head.*  A table of at most ``WHOLE`` rows is the head itself.  Of a larger one
   ``approx_top_k`` (a mergeable frequent-items sketch) finds the most frequent
   tokens of the rows, at most ``HEAD``.  The head, with its table entries (or the
   knowledge that there is none), goes to the tasks, and an Arrow UDF resolves the bulk
   of the occurrences in place.
2. *Tail.*  The rows are dealt by hash to blocks, and the different rare tokens of each
   row meet the table in an ordinary equi-join, with the block they are wanted in.  The
   sketch leaves no token there that has more than about ``n / HEAD`` occurrences, so no
   task is hot.
3. Each block's rows meet the block's entries, which fill the gaps.  Rows of words go
   there with what the head knows in place of the words; rows of ids, which are
   smaller than their words, go as they are and meet the head there.

A larger table has the rows written once, as the sketch and both sides of step 3 read
them.  The result doesn't depend on what the head holds; with a whole table in it no tail
is left, the steps 2 and 3 fall away and nothing is written or shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiflow.session import materialize

#: Rows of a table that is broadcast whole; tokens in the head of a larger one; items that the sketch tracks.
WHOLE, HEAD, TRACKED = 1_000_000, 200_000, 400_000
#: Blocks of rows that meet their rare entries together, at least; rows of the table for each block.
BLOCKS, BLOCK_ENTRIES = 1024, 8192


def heavy_items(tokens: DataFrame, col: str, head: int | None = None, tracked: int | None = None) -> DataFrame:
    """(col): at most ``head`` values of ``col``, the most frequent by the sketch's estimate.

    Every value with more than about n / ``tracked`` of the n occurrences is tracked.  With
    ``head`` 0 there are none."""
    head = HEAD if head is None else head
    if head <= 0:
        return tokens.select(col).where(F.lit(False))
    tracked = max(TRACKED if tracked is None else tracked, head)
    top = tokens.where(F.col(col).isNotNull()).agg(F.call_function("approx_top_k", F.col(col), F.lit(head), F.lit(tracked)).alias("_top"))
    return top.select(F.explode("_top.item").alias(col))


def resolve(
    rows: DataFrame,
    keys: Sequence[str],
    tokens: Sequence[str],
    table: DataFrame,
    by: str,
    value: str,
    missing: object = None,
    head: int | None = None,
    tracked: int | None = None,
) -> DataFrame:
    """Look up every element of the array columns ``tokens`` (one per side) in ``table`` (by -> value).

    ``by`` values are unique.  Returns ``keys`` and, under the names of ``tokens``, the
    arrays of the found values in order.  Elements without an entry become ``missing``, or
    go if that is None.  A null array counts as empty, a null element as one without an entry.
    ``head`` sets the bound of the head, for tables broadcast whole too."""
    keys, tokens = list(keys), list(tokens)
    token_type, kind = rows.schema[tokens[0]].dataType.elementType, table.schema[value].dataType
    entries = table.select(F.col(by).try_cast(token_type).alias("_tok"), F.col(value).alias("_val")).where(F.col("_tok").isNotNull())
    n = table.count()
    found = [T.ArrayType(kind)] * len(tokens)
    if n <= (WHOLE if head is None else head):
        got = rows.select(*keys, _look_up(entries.toArrow(), found, missing)(*tokens).alias("_got"))
        return got.select(*keys, *[F.col(f"_got.c{i}").alias(c) for i, c in enumerate(tokens)])

    block = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(max(BLOCKS, n // BLOCK_ENTRIES))).cast("int")
    kept = materialize(rows.select(*keys, *tokens, block.alias("_block")), "lookup")
    each = F.concat(*[F.coalesce(F.col(c), F.array().cast(rows.schema[c].dataType)) for c in tokens])
    heavy = heavy_items(kept.select(F.explode(each).alias("_tok")), "_tok", head, tracked).toArrow()  # the sketch runs once
    named = rows.sparkSession.createDataFrame(heavy.select(["_tok"]), T.StructType([T.StructField("_tok", token_type)]))
    hot = entries.join(F.broadcast(named), "_tok").toArrow()  # the table is only read through, not shuffled
    known = pa.table({"_tok": heavy["_tok"], "_val": _one(hot["_val"]).take(pc.index_in(heavy["_tok"], value_set=_one(hot["_tok"])))})

    rare = kept.select(F.col("_block").alias("_home"), F.explode(F.array_distinct(each)).alias("_tok")).where(F.col("_tok").isNotNull())
    late = rare.join(F.broadcast(named), "_tok", "left_anti").join(entries, "_tok").select("_home", "_tok", "_val")
    out = T.StructType([*[T.StructField(k, rows.schema[k].dataType) for k in keys], *[T.StructField(c, t) for c, t in zip(tokens, found)]])
    words = isinstance(token_type, T.StringType)
    if words:
        split = _look_up(known, [t for f in found for t in (f, T.ArrayType(token_type))], missing, tail=True)(*tokens)
        kept = kept.select(*keys, "_block", split.alias("_got")).select(*keys, "_block", *[F.col(f"_got.c{i}").alias(f"_c{i}") for i in range(2 * len(tokens))])
    fill = _fill(keys, tokens, None if words else known, missing)
    return kept.groupBy("_block").cogroup(late.groupBy("_home")).applyInArrow(fill, out)


def _arrow_list(values: pa.Array, lengths: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), values)


def _lists(col: pa.Array | pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """The elements of all lists one after the other, and the length of each list (null: 0)."""
    col = _one(col)
    return col.flatten(), pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _one(col: pa.Array | pa.ChunkedArray) -> pa.Array:
    return col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col


def _counts(marked: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """How many elements of each list are marked."""
    before = np.concatenate([[0], np.cumsum(marked)])
    ends = np.cumsum(lengths)
    return before[ends] - before[ends - lengths]


def _finished(values: pa.Array, lengths: np.ndarray, missing: object) -> pa.Array:
    """Lists of the values, those without an entry as ``missing`` or dropped."""
    if missing is not None:
        return _arrow_list(pc.fill_null(values, pa.scalar(missing, values.type)), lengths)
    kept = values.is_valid()
    return _arrow_list(values.filter(kept), _counts(kept.to_numpy(zero_copy_only=False), lengths))


def _look_up(head: pa.Table, types: Sequence[T.DataType], missing: object, tail: bool = False):
    """Arrow UDF: a struct of the values of each column's tokens.  With ``tail`` each column gives two
    fields: the values, null without an entry, and for each null the token, if it isn't in the head."""
    heads, values = _one(head["_tok"]), _one(head["_val"])
    schema = T.StructType([T.StructField(f"c{i}", t) for i, t in enumerate(types)])

    @F.arrow_udf(schema)
    def run(*columns: pa.Array) -> pa.Array:
        out = []
        for col in columns:
            flat, lengths = _lists(col)
            at = pc.index_in(flat, value_set=heads.cast(flat.type), skip_nulls=True)
            got = values.take(at)
            if not tail:
                out.append(_finished(got, lengths, missing))
                continue
            gaps = got.is_null()
            unknown = pc.if_else(at.is_null(), flat, pa.scalar(None, flat.type)).filter(gaps)
            out += [_arrow_list(got, lengths), _arrow_list(unknown, _counts(gaps.to_numpy(zero_copy_only=False), lengths))]
        return pa.StructArray.from_arrays(out, names=schema.names)

    return run


def _fill(keys: list[str], tokens: list[str], head: pa.Table | None, missing: object):
    """Function of a block's rows and the entries of its rare tokens: the rows with all values.

    The rows bring their tokens, which meet ``head`` and entries, or without a ``head`` the two
    fields that ``_look_up`` makes of them."""

    def run(rows: pa.Table, late: pa.Table) -> pa.Table:
        out = [rows[k] for k in keys]
        for i, c in enumerate(tokens):
            values, lengths = _lists(rows[c if head is not None else f"_c{2 * i}"])
            unknown = values if head is not None else _lists(rows[f"_c{2 * i + 1}"])[0]
            known = [t for t in (head, late) if t is not None and t.num_rows]
            if known:
                by = pa.concat_arrays([_one(t["_tok"]).cast(unknown.type) for t in known])
                got = pa.concat_arrays([_one(t["_val"]).cast(known[0]["_val"].type) for t in known])
                got = got.take(pc.index_in(unknown, value_set=by, skip_nulls=True))
                values = got if head is not None else pc.replace_with_mask(values, values.is_null(), got.cast(values.type))
            elif head is not None:
                values = pa.nulls(len(values), head["_val"].type)
            out.append(_finished(values, lengths, missing))
        return pa.table(out, names=[*keys, *tokens])

    return run
