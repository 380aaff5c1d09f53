"""Subword segmentation of a word: best path through the lattice of scored pieces.

A piece table gives each piece an id and a score (a log probability).  The pieces that
match somewhere in a word are the edges of a lattice over its character positions; the
segmentation is the path of the largest score sum (Viterbi).  Matches are found by
walking a trie from each position.  A character that no single piece covers may be
crossed by an unknown edge, at a penalty below every score; neighbouring unknown
characters give one unknown id.  Of equal sums the one with the longest last piece wins.
"""

from __future__ import annotations

from collections.abc import Iterable

#: Stands for the white space in front of a word (a fixed value of published piece tables).
SPACE = "▁"
#: How far below the lowest score an unknown character is.
UNKNOWN_PENALTY = 10.0


class PieceLattice:
    """The trie of a piece table (piece, id, score); pieces are unique."""

    def __init__(self, pieces: Iterable[tuple[str, int, float]], unk_id: int):
        # a node of the trie is a prefix; its value is the entry of the piece that ends there
        self.trie: dict[str, tuple[int, float] | None] = {}
        self.unk_id = unk_id
        lowest = 0.0
        for piece, i, score in pieces:
            for end in range(1, len(piece)):
                self.trie.setdefault(piece[:end], None)
            self.trie[piece] = (i, float(score))
            lowest = min(lowest, float(score))
        self.unknown = lowest - UNKNOWN_PENALTY

    def edges(self, word: str, start: int) -> list[tuple[int, int, float]]:
        """(end, id, score) of the edges that leave ``start``."""
        out, single = [], False
        for end in range(start + 1, len(word) + 1):
            part = word[start:end]
            if part not in self.trie:
                break
            if (entry := self.trie[part]) is not None:
                out.append((end, *entry))
                single = single or end == start + 1
        if not single:
            out.append((start + 1, self.unk_id, self.unknown))
        return out

    def best_path(self, word: str) -> list[int]:
        """Ids of the best segmentation of ``word``."""
        best: list[tuple[float, int, int] | None] = [None] * (len(word) + 1)  # (sum, start of the last edge, its id)
        best[0] = (0.0, -1, -1)
        for start in range(len(word)):  # unknown edges make every position reachable
            so_far = best[start][0]
            for end, i, score in self.edges(word, start):
                if best[end] is None or so_far + score > best[end][0]:
                    best[end] = (so_far + score, start, i)
        ids: list[int] = []
        at = len(word)
        while at:
            _, start, i = best[at]
            if not (i == self.unk_id and ids and ids[-1] == i):
                ids.append(i)
            at = start
        return ids[::-1]
