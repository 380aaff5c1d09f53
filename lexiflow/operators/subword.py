"""Subword encoding and decoding by a table of scored pieces (PRJ-2, PRJ-8), with
special ids and language codes of each side's own.

``encode_pieces`` splits a text at white space, puts the space mark in front of each
word and takes each word's best path through the lattice of pieces
(``functions.lattice``), in an Arrow UDF: rows stay where they are, nothing is
shuffled.  The piece table is a tokenizer's published vocabulary: its size doesn't
follow the data, is checked against ``MAX_PIECES`` and it is shipped to the tasks.
``decode_pieces`` is the plain lookup of the ids, joined, with marks turned to spaces.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiflow.functions.lattice import SPACE, PieceLattice
from lexiflow.functions.text import PY_WHITESPACE
from lexiflow.operators.lookup import resolve
from lexiflow.operators.prep import _ids_literal
from lexiflow.sources.fixtures import BOS_ID, EOS_ID, SPECIAL_IDS, UNK_ID

MAX_PIECES = 1_000_000
#: Characters of different words whose ids a task keeps at hand.
MEMORY_CHARS = 4_000_000


def side_ids(mode: str = "plain", code: int | None = None, bos_id: int | None = BOS_ID, eos_id: int = EOS_ID) -> tuple[list[int], list[int]]:
    """(prefix, suffix) of a side: ``plain`` [bos] … eos, ``suffix_code`` … eos code (both sides of an
    older multilingual model), ``prefix_code`` code … eos (newer ones)."""
    if mode == "plain":
        return ([] if bos_id is None else [bos_id]), [eos_id]
    if code is None:
        raise ValueError(f"mode {mode} needs a language code")
    if mode == "suffix_code":
        return [], [eos_id, code]
    if mode == "prefix_code":
        return [code], [eos_id]
    raise ValueError(f"unknown mode {mode}")


def piece_ids(text: Column, pieces: Sequence[tuple[str, int, float]], unk_id: int = UNK_ID) -> Column:
    """Column of piece ids (no special ids) of a text; a null text has none."""

    @F.arrow_udf("array<int>")
    def run(texts: pa.Array) -> pa.Array:
        lattice = PieceLattice(pieces, unk_id)
        memory: dict[str, list[int]] = {}
        kept = 0
        out = []
        for text in texts:
            ids: list[int] = []
            for word in (text.as_py() or "").split():
                if word not in memory:
                    if kept > MEMORY_CHARS:
                        memory.clear()
                        kept = 0
                    memory[word] = lattice.best_path(SPACE + word)
                    kept += len(word)
                ids += memory[word]
            out.append(ids)
        return pa.array(out, pa.list_(pa.int32()))

    return run(text)


def load_pieces(pieces: DataFrame) -> list[tuple[str, int, float]]:
    """The rows of a piece table (piece, id, score) in a fixed order; more than ``MAX_PIECES`` are an error,
    and so is a piece with the space mark inside (it would cross words)."""
    rows = [tuple(r) for r in pieces.select("piece", "id", F.col("score").cast("double")).limit(MAX_PIECES + 1).toLocalIterator()]
    if len(rows) > MAX_PIECES:
        raise ValueError(f"a piece table has at most {MAX_PIECES} pieces")
    if any(SPACE in p[1:] for p, _, _ in rows):
        raise ValueError("pieces that span words are not supported")
    return sorted(rows)


def encode_pieces(
    df: DataFrame,
    cols: Mapping[str, str],
    pieces: DataFrame,
    specials: Mapping[str, tuple[Sequence[int], Sequence[int]]] | None = None,
    max_lens: Mapping[str, int] | None = None,
    drop_over: Mapping[str, int] | None = None,
    unk_id: int = UNK_ID,
) -> DataFrame:
    """PRJ-2: ``df`` with id columns (``cols``: text -> ids name) by best paths over ``pieces`` (piece, id, score).

    ``specials`` {ids column: (prefix, suffix)} (see ``side_ids``) wraps each side in its own
    ids, by default those of the plain mode.  ``max_lens`` truncates the body so that the
    whole fits (PRJ-3), ``drop_over`` drops rows with a longer side (FLT-1).  Null and empty
    texts have only special ids."""
    table = load_pieces(pieces)
    out = df
    for text, ids in cols.items():
        prefix, suffix = (specials or {}).get(ids, side_ids())
        out = out.withColumn(ids, piece_ids(F.col(text), table, unk_id))
        n_special = len(prefix) + len(suffix)
        if drop_over and ids in drop_over:
            out = out.where(F.size(ids) + F.lit(n_special) <= F.lit(drop_over[ids]))
        if max_lens and ids in max_lens:
            out = out.withColumn(ids, F.slice(ids, 1, max(max_lens[ids] - n_special, 0)))
        out = out.withColumn(ids, F.concat(_ids_literal(prefix), ids, _ids_literal(suffix)))
    return out


def decode_pieces(
    df: DataFrame,
    cols: Mapping[str, str],
    pieces: DataFrame,
    key_cols: Sequence[str] = ("row_id",),
    carry: Sequence[str] = (),
    specials: Sequence[int] = SPECIAL_IDS,
    head: int | None = None,
) -> DataFrame:
    """PRJ-8: id columns -> text columns (``cols``: ids -> text name): special (FLT-3) and unknown ids are
    skipped, pieces are joined, space marks become spaces, and the text is stripped."""
    keys = [*key_cols, *carry]
    kept = [F.filter(c, lambda i: ~i.isin([int(s) for s in specials])).alias(out) for c, out in cols.items()]
    g = resolve(df.select(*keys, *kept), keys, list(cols.values()), pieces, "id", "piece", head=head)
    texts = [F.trim(F.replace(F.array_join(out, ""), F.lit(SPACE), F.lit(" ")), F.lit(PY_WHITESPACE)).alias(out) for out in cols.values()]
    return g.select(*key_cols, *carry, *texts)
