"""Piece encoding by a prefix table, and decoding (operator 5).

A byte-pair model with scored pieces merges greedily: best score first, leftmost
on ties.  Merges never cross the token borders of the final result, hence

* every run of neighbouring tokens of an encoding is the encoding of its own text;
* a token sequence is an encoding exactly if all its neighbouring pairs are, i.e.
  if merging the text of each pair alone gives that pair back (*compatible*).

So the encoding of every prefix ends in one unique token: among the pieces that
end at a position (the matches of an Aho-Corasick automaton over all pieces), the
one compatible with the last token of the prefix before it.  One pass fills the
table of last tokens; the ids are then recovered backwards from the end.

Characters without a piece stand for themselves and leave as byte pieces.  Spark
partitions the texts; each Python worker loads the model once, cuts texts into
units (a run of spaces and what follows it) whose borders no piece spans, and
fills the tables of new units in sorted order, so that a unit goes on from the
table of the prefix it shares with the one before.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections import deque
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiflow.llm.common import give_back, text_or_empty

SPACE = "▁"
#: Text units and token pairs that a worker remembers (then it starts afresh), and
#: characters whose new units it encodes together: they bound its memory, not the results.
UNIT_MEMORY = 80_000
PAIR_MEMORY = 200_000
CHUNK_CHARS = 1_000_000


class PrefixTable:
    """The model's pieces, their automaton and the pair tests of one Python worker."""

    def __init__(self, model_file: str):
        sp = self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        size = sp.get_piece_size()
        pieces = {i: sp.id_to_piece(i) for i in range(size)}
        self.byte_ids = [0] * 256
        self.ids: dict[str, int] = {}
        self.score: dict[str, float] = {}
        for i, piece in pieces.items():
            if sp.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.ids[piece] = i
                self.score[piece] = sp.get_score(i)
        if not any(self.byte_ids):
            raise ValueError("the model has no byte pieces: characters without a piece can't be encoded")
        self.begin, self.end = sp.bos_id(), sp.eos_id()
        self._build_automaton()
        self.unit_pattern = self._unit_pattern()
        self.units: dict[str, bytes] = {}
        merged = self.merged

        class Pairs(dict):
            def __missing__(self, pair: tuple[str, str]) -> bool:
                if len(self) >= PAIR_MEMORY:
                    self.clear()
                fits = self[pair] = merged(*pair)
                return fits

        self.pairs = Pairs()

    def _unit_pattern(self) -> re.Pattern:
        """Units whose borders no piece spans: before a run of spaces, around newlines, after a run of letters."""
        if any(SPACE in piece.lstrip(SPACE) for piece in self.ids):
            return re.compile(r"(?s).+")
        letters = {ch for piece in self.ids for ch in piece if ch.isalpha()}
        borders = {pair for piece in self.ids for pair in zip(piece, piece[1:])}
        while spanned := {a for a, b in borders if a in letters and b not in letters}:
            letters -= spanned
        run = "".join(map(re.escape, sorted(letters)))
        newline = "" if any("\n" in piece for piece in self.ids) else r"\n"
        return re.compile(rf"{SPACE}*[{run}]+|{SPACE}*[^{run}{SPACE}{newline}]+[{run}]*|{SPACE}+|\n")

    def _build_automaton(self) -> None:
        """Aho-Corasick states of all pieces: goto, fail, and the pieces that end in a state, longest first."""
        self.goto: list[dict[str, int]] = [{}]
        self.out: list[tuple[str, ...]] = [()]
        self.fail = [0]
        for piece in self.ids:
            state = 0
            for ch in piece:
                known = self.goto[state].get(ch)
                if known is None:
                    known = self.goto[state][ch] = len(self.goto)
                    self.goto.append({})
                    self.out.append(())
                    self.fail.append(0)
                state = known
            self.out[state] = (piece,)
        todo = deque(self.goto[0].values())
        while todo:
            state = todo.popleft()
            for ch, child in self.goto[state].items():
                todo.append(child)
                self.fail[child] = self.step(self.fail[state], ch)
                self.out[child] += self.out[self.fail[child]]

    def step(self, state: int, ch: str) -> int:
        goto, fail = self.goto, self.fail
        while (known := goto[state].get(ch)) is None and state:
            state = fail[state]
        return known or 0

    def merged(self, left: str, right: str) -> bool:
        """Whether merging the text of two tokens alone gives these two tokens back
        (with an empty left one: whether the right one's text gives that one token)."""
        symbols, border = [*left, *right], len(left)
        score, low = self.score.get, float("-inf")
        scores = [score(a + b, low) for a, b in zip(symbols, symbols[1:])]
        while scores and (best := max(scores)) > low:
            at = scores.index(best)
            start = sum(map(len, symbols[:at]))
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            if start < border < start + len(symbols[at]):
                return False
            del scores[at]
            if at:
                scores[at - 1] = score(symbols[at - 1] + symbols[at], low)
            if at < len(scores):
                scores[at] = score(symbols[at] + symbols[at + 1], low)
        return len(symbols) == (2 if left else 1)

    def encode_units(self, units: Iterable[str]) -> Iterable[tuple[str, bytes]]:
        """The ids of each unit: the table of last tokens, then the walk back from the end."""
        goto, out, pairs, known, step = self.goto, self.out, self.pairs, self.ids.get, self.step
        before, states, last = "", [0], [""]  # last[i]: last token of the encoding of unit[:i]
        for unit in sorted(units):
            shared, most = 0, min(len(before), len(unit))
            while shared < most and before[shared] == unit[shared]:
                shared += 1
            del states[shared + 1 :], last[shared + 1 :]
            state, before = states[shared], unit
            for i in range(shared, len(unit)):
                ch = unit[i]
                state = goto[state].get(ch) or step(state, ch)
                states.append(state)
                for piece in out[state]:
                    if pairs[last[i + 1 - len(piece)], piece]:
                        last.append(piece)
                        break
                else:  # no piece fits: the character stands for itself
                    last.append(ch)
            ids: list[int] = []
            at = len(unit)
            while at:
                token = last[at]
                at -= len(token)
                if (i := known(token)) is not None:
                    ids.append(i)
                else:
                    ids.extend(self.byte_ids[b] for b in reversed(token.encode("utf-8")))
            ids.reverse()
            yield unit, array("I", ids).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids (32 bit each) of texts without begin and end; no text, no ids."""
        cut = [self.unit_pattern.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        if len(self.units) >= UNIT_MEMORY:
            self.units.clear()
        new: set[str] = set()
        for units in cut:
            new.update(units)
        self.units.update(self.encode_units(new.difference(self.units)))
        return [b"".join(map(self.units.__getitem__, units)) for units in cut]


_TABLES: dict[str, PrefixTable] = {}


def prefix_table(model_file: str) -> PrefixTable:
    if model_file not in _TABLES:
        _TABLES[model_file] = PrefixTable(model_file)
    return _TABLES[model_file]


FIELDS = {
    "ids": pa.list_(pa.int32()),
    "n_tokens": pa.int64(),
    "ids_sha256": pa.string(),
    "decoded": pa.string(),
    "decoded_sha256": pa.string(),
}
_DDL = {"ids": "array<int>", "n_tokens": "bigint", "ids_sha256": "string", "decoded": "string", "decoded_sha256": "string"}


def encode_decode(text: Column, model_file: str, emit: Iterable[str] = ("ids", "decoded"), begin: bool = True, end: bool = True) -> Column:
    """Struct column with the fields named in ``emit`` (see ``FIELDS``).

    ``ids`` has the begin and end ids if asked for; ``decoded`` is the model's
    decode(ids).  A null or empty text has no ids of its own and decodes to "".
    ``model_file`` must be readable on every executor (it is part of an
    installed package, or shipped with ``addFile``).
    """
    fields = list(emit)

    def encoded(model: PrefixTable, texts: pa.Array) -> Iterable[bytes]:
        chunk: list[str] = []
        chars = 0
        for value in texts:
            chunk.append(value.as_py() or "")
            chars += len(chunk[-1])
            if chars >= CHUNK_CHARS:
                yield from model.encode(chunk)
                chunk, chars = [], 0
        yield from model.encode(chunk)

    @F.arrow_udf(f"struct<{', '.join(f'{f}: {_DDL[f]}' for f in fields)}>")
    def run(texts: pa.Array) -> pa.Array:
        model = prefix_table(model_file)
        head = np.array([model.begin] if begin else [], dtype="<u4").tobytes()
        tail = np.array([model.end] if end else [], dtype="<u4").tobytes()
        out: dict[str, list] = {f: [] for f in fields}
        for body in encoded(model, texts):
            ids = np.frombuffer(head + body + tail, dtype=np.uint32)
            if "ids" in out:
                out["ids"].append(ids.astype(np.int32))
            if "n_tokens" in out:
                out["n_tokens"].append(len(ids))
            if "ids_sha256" in out:
                out["ids_sha256"].append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
            if "decoded" in out or "decoded_sha256" in out:
                decoded = model.library.decode(ids.tolist())
                if "decoded" in out:
                    out["decoded"].append(decoded)
                if "decoded_sha256" in out:
                    out["decoded_sha256"].append(hashlib.sha256(decoded.encode("utf-8")).hexdigest())
        done = pa.StructArray.from_arrays([pa.array(out[f], type=FIELDS[f]) for f in fields], names=fields)
        del out
        give_back()
        return done

    return run(text_or_empty(text))


def tokenize(df: DataFrame, model_file: str, text_col: str = "text", id_cols: Iterable[str] = ("doc_id",), emit: Iterable[str] = ("ids", "decoded")) -> DataFrame:
    """One row per input row: ``id_cols`` and the fields of ``emit``.

    No shuffle: rows stay where the scan put them.  Repeated rows give repeated
    results; null and empty texts give begin and end ids only; columns other than
    ``id_cols`` and the text are neither read nor returned.
    """
    kept = [F.col(c) for c in id_cols]
    return df.select(*kept, encode_decode(F.col(text_col), model_file, emit).alias("_enc")).select(*kept, "_enc.*")
