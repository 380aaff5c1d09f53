"""Batch inference (UDF-1, UDF-2).

``generate_batches`` applies a caller-supplied model to encoded rows with
``mapInPandas``: the model factory runs once per task (not per row) and the model
sees *padded matrices* of ids and masks, ``batch_size`` rows each.  A task holds back
rows up to a bound of tokens, across Arrow batches, and forms the matrices from rows
of similar length, so little of them is padding.  Nothing here imports a
deep-learning library; the factory decides.

``stub_model`` is the deterministic stand-in used by tests and the query
catalogue: every non-special input id is replaced by the next vocabulary id
(wrapping at the end), behind a start id and before the end id, stopping at
``max_len`` — a table lookup that SQL can repeat.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lexiflow.sources.fixtures import EOS_ID, FIRST_TOKEN_ID, PAD_ID, SPECIAL_IDS

# model(ids: matrix, masks: matrix of the same shape, start_id, max_len) -> one list of ids per row
Model = Callable[[np.ndarray, np.ndarray, int, int], list]

#: Rows of a matrix; ids that a task holds back to form matrices of; cells of a matrix of several rows.
BATCH_SIZE, BUFFER_TOKENS, MATRIX_CELLS = 8, 200_000, 1_000_000


def stub_model(last_id: int, first_id: int = FIRST_TOKEN_ID, specials: Sequence[int] = SPECIAL_IDS, eos_id: int = EOS_ID) -> Callable[[], Model]:
    """Factory of the stand-in generator (a lookup table built once per task)."""

    def make() -> Model:
        table = np.arange(last_id + 1, dtype=np.int64) + 1
        table[last_id] = first_id
        table[: first_id] = np.arange(first_id)  # specials map to themselves
        special = np.array(sorted(specials), dtype=np.int64)

        def generate(ids_batch, masks_batch, start_id, max_len):
            out = []
            for ids, mask in zip(ids_batch, masks_batch):
                ids = ids[mask != 0]
                body = ids[~np.isin(ids, special)]
                body = np.where(body > last_id, first_id, body)
                nxt = table[body][: max(max_len - 2, 0)]
                out.append([int(start_id), *nxt.tolist(), int(eos_id)][:max_len])
            return out

        return generate

    return make


def length_buckets(lengths: np.ndarray, batch_size: int, cells: int = MATRIX_CELLS) -> list[np.ndarray]:
    """Row numbers in batches of at most ``batch_size`` rows of neighbouring lengths, whose padded
    matrix has at most ``cells`` cells unless it is a single row."""
    out: list[list[int]] = []
    for i in np.argsort(lengths, kind="stable"):
        if not out or len(out[-1]) == batch_size or (len(out[-1]) + 1) * int(lengths[i]) > cells:
            out.append([])
        out[-1].append(int(i))
    return [np.array(b) for b in out]


def padded_matrix(rows: Sequence[np.ndarray], pad: int) -> np.ndarray:
    """The rows, right-padded to the longest."""
    out = np.full((len(rows), max(map(len, rows), default=0)), pad, dtype=np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def _ids(values) -> np.ndarray:
    return np.zeros(0, np.int64) if values is None else np.asarray(values, dtype=np.int64)


def generate_batches(
    df: DataFrame,
    make_model: Callable[[], Model],
    ids_col: str = "input_ids",
    mask_col: str | None = "attention_mask",
    out: str = "generated_ids",
    max_len: int = 256,
    start_id: int = 0,
    batch_size: int = BATCH_SIZE,
    pad_id: int = PAD_ID,
    buffer_tokens: int = BUFFER_TOKENS,
) -> DataFrame:
    """UDF-1: add ``out`` (array<int>) generated from each row's ids, greedy and
    deterministic, at most ``max_len`` ids.

    The model gets int64 matrices: ids padded with ``pad_id``, masks (all 1 without
    ``mask_col``) padded with 0.  A task holds ``buffer_tokens`` ids and one more Arrow
    batch at most.  Which rows share a matrix follows from these bounds, the rows
    returned do not, as long as the model treats the rows of a matrix one by one.  Null
    ids count as none."""
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(T.IntegerType()), True)])

    def run(batches):
        model = make_model()

        def generated(frames: list[pd.DataFrame]) -> pd.DataFrame:
            pdf = pd.concat(frames, ignore_index=True) if len(frames) > 1 else frames[0].reset_index(drop=True)
            ids = [_ids(v) for v in pdf[ids_col]]
            masks = [_ids(v) for v in pdf[mask_col]] if mask_col else [np.ones(len(v), np.int64) for v in ids]
            found: list = [None] * len(ids)
            for at in length_buckets(np.array([len(v) for v in ids]), batch_size):
                texts = model(padded_matrix([ids[i] for i in at], pad_id), padded_matrix([masks[i] for i in at], 0), start_id, max_len)
                for i, text in zip(at, texts):
                    found[i] = text
            return pdf.assign(**{out: pd.Series(found, index=pdf.index, dtype=object)})

        held, tokens = [], 0
        for pdf in batches:
            held.append(pdf)
            tokens += sum(0 if v is None else len(v) for v in pdf[ids_col])
            if tokens >= buffer_tokens:
                yield generated(held)
                held, tokens = [], 0
        if held:
            yield generated(held)

    return df.mapInPandas(run, schema)
