"""Benchmark decontamination by template canonicalisation (operator 4).

Numbers, names and units become typed placeholders, every other word its lower
case; eight neighbouring template tokens with enough plain words among them are a
window.  Windows of documents meet windows of benchmark items by hash.  Hits of
one document and item on one diagonal (document position minus item position)
are an alignment.  One that holds enough words unchanged (windows of equal values) is
a copy, whatever its other slots say.  In any other that covers enough words the
slots are compared: most names and most units must map one to one, and different
numbers may not become equal.  So verbatim copies, also slightly edited ones, and
re-parameterised questions (other numbers, names, units) are found, while texts
that merely share a pattern with contradicting values are not.

The benchmark side of the join is broadcast only in blocks of ``BLOCK_TOKENS``
tokens: its size is counted first, and a larger benchmark takes one pass over the
documents for each block.  The documents are never shuffled.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiflow.llm.common import cut, give_back, text_or_empty

#: Words in a window, plain words it needs, words an alignment must cover (all of a shorter item).
WINDOW, PLAIN, COVER = 8, 4, 13
#: Names or numbers in a row that are one slot, tokens that the parts of one copy may be shifted against each other.
RUN, SHIFT = 3, 8
#: Shorter items are found whole only.
EDITED = 6
#: Template tokens of the benchmark that are broadcast at once.
BLOCK_TOKENS = 2_000_000
#: Documents' characters that a worker matches together, surfaces that it remembers (bound its memory).
CHUNK_CHARS, SURFACES = 1_000_000, 200_000

#: Words that stand for a number, and units of measure.
NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen "
    "twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split()
)
UNITS = frozenset(
    "mm cm m km meter meters metre metres kilometer kilometers inch inches foot feet yard yards mile miles mg g kg gram grams kilogram "
    "kilograms ounce ounces pound pounds ton tons ml l liter liters litre litres gallon gallons second seconds minute minutes hour hours "
    "day days week weeks month months year years cent cents dollar dollars euro euros percent degree degrees mph kph".split()
)
_TOKEN = re.compile(r"\d+(?:[.,]\d+)*|\w+|[.!?\n]")
PLAIN_WORD, NUMBER, UNIT, TITLE, MARK = range(5)
_PLACE = np.array([0, 0x9D5A31C7E0F2B485, 0x52C8E61BD07F394B, 0xE71B40A95D3C862F], np.uint64)  # of number, unit, name
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


_MULT = _mix(np.arange(1, 65, dtype=_U) * _U(0x9E3779B97F4A7C15)) | _U(1)


class _Surfaces(dict):
    """Code of each surface form; by code its kind and the hash of its lower case."""

    def __init__(self):
        super().__init__()
        self.kinds, self.hashes = [], []

    def __missing__(self, token: str) -> int:
        lower = token.lower()
        if token in ".!?\n":
            kind = MARK
        elif token[0].isdigit() or lower in NUMBER_WORDS:
            kind = NUMBER
        elif lower in UNITS:
            kind = UNIT
        else:
            kind = TITLE if len(token) > 1 and token.istitle() else PLAIN_WORD
        code = self[token] = len(self.kinds)
        self.kinds.append(kind)
        self.hashes.append(xxhash.xxh3_64_intdigest(lower))
        return code


def templates(texts: list[str], surfaces: _Surfaces) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per token of all texts in order: value hash, template hash, slot type (0: none); and tokens per text.

    A capitalised word is a name unless it opens a text or a sentence.
    """
    lists = [_TOKEN.findall(t) for t in texts]
    codes = np.array([surfaces[t] for tokens in lists for t in tokens], np.int64)
    sizes = np.array([len(x) for x in lists], np.int64)
    if not len(codes):
        return np.zeros(0, _U), np.zeros(0, _U), np.zeros(0, np.int8), sizes
    kinds = np.array(surfaces.kinds, np.int8)[codes]
    values = np.array(surfaces.hashes, _U)[codes]
    opens = np.concatenate(([True], kinds[:-1] == MARK))
    starts = (np.cumsum(sizes) - sizes)[sizes > 0]
    opens[starts] = True
    slot = np.where(kinds == TITLE, np.where(opens, 0, 3), np.where((kinds == NUMBER) | (kinds == UNIT), kinds, 0)).astype(np.int8)
    word = kinds != MARK
    owner = np.repeat(np.arange(len(sizes)), sizes)[word]
    values, slot = values[word], slot[word]
    return values, np.where(slot > 0, _PLACE[slot], values), slot, np.bincount(owner, minlength=len(sizes))


def windows(template: np.ndarray, slot: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the window that starts at each token, and whether it lies in one text and has plain words enough."""
    n = len(template)
    if n < width:
        return np.zeros(0, _U), np.zeros(0, bool)
    total, done, power, step = None, 0, template, 1  # by doubling: sums of 1, 2, 4, 8 neighbours
    while True:
        if width & step:
            part = power[done : done + n - width + 1]
            total = part if total is None else total + part * _MULT[8 + done]
            done += step
        if done == width:
            break
        power = power[:-step] + power[step:] * _MULT[step]
        step *= 2
    plain = np.concatenate(([0], np.cumsum(slot == 0)))
    owner = np.repeat(np.arange(len(counts)), counts)
    return _mix(total + _U(width)), (owner[: n - width + 1] == owner[width - 1 :]) & (plain[width:] - plain[:-width] >= min(PLAIN, (width + 1) // 2))


def collapse(values: np.ndarray, slot: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First token and length of each token or run of two to ``RUN`` names or numbers (longer ones are lists and
    stay apart), and pieces per text."""
    if not len(slot):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), counts
    owner = np.repeat(np.arange(len(counts)), counts)
    same = (slot[1:] == slot[:-1]) & ((slot[1:] == NUMBER) | (slot[1:] == TITLE)) & (owner[1:] == owner[:-1])
    head = np.concatenate(([True], ~same))
    begin = np.flatnonzero(head)
    run = np.diff(begin, append=len(slot))
    at = np.flatnonzero(head | np.repeat(run > RUN, run))
    return at, np.diff(at, append=len(slot)), np.bincount(owner[at], minlength=len(counts))


class Pieces:
    """Texts as pieces (``collapse``) or as single tokens: first token, length, value, template and slot of each piece."""

    def __init__(self, values, template, slot, counts, collapsed: bool):
        self.tokens = np.cumsum(counts) - counts
        if collapsed:
            self.at, self.size, self.counts = collapse(values, slot, counts)
            place = np.arange(len(values)) - np.repeat(self.at, self.size)
            self.values = np.add.reduceat(values * _MULT[np.minimum(place, RUN)], self.at) if len(values) else values
        else:
            self.at, self.size, self.counts, self.values = np.arange(len(values)), np.ones(len(values), np.int64), counts, values
        self.template, self.slot = template[self.at], slot[self.at]
        self.first = np.cumsum(self.counts) - self.counts
        self.owner = np.repeat(np.arange(len(counts)), self.counts)


def unchanged(same: np.ndarray, width: int) -> np.ndarray:
    """Whether each word stands in a run of at least ``width`` neighbours with equal values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], same.astype(np.int8), [0]))))
    kept = np.zeros(len(same) + 1, np.int8)
    long = edges[1::2] - edges[::2] >= width
    kept[edges[::2][long]] = 1
    kept[edges[1::2][long]] = -1
    return np.cumsum(kept)[:-1] > 0


def slots_agree(its: np.ndarray, mine: np.ndarray, kind: np.ndarray) -> bool:
    """Whether the values of an item and of a document at their common slots belong together.

    More than half of the names, and of the units, must be the most frequent partners
    of each other.  A number may become several, but different ones may not become one.
    """
    for k in (NUMBER, UNIT, TITLE):
        count = Counter(zip(its[kind == k].tolist(), mine[kind == k].tolist()))
        if k == NUMBER:
            if len({b for _, b in count}) < len(count):
                return False
            continue
        to, back = {}, {}
        for (a, b), n in sorted(count.items()):
            to[a] = max(to.get(a, (0, b)), (n, b))
            back[b] = max(back.get(b, (0, a)), (n, a))
        mutual = sum(n for (a, b), n in count.items() if to[a][1] == b and back[b][1] == a)
        if count and 2 * mutual <= sum(count.values()):
            return False
    return True


def lookup(table: tuple[np.ndarray, ...], own: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Position, item and place in it for each good window that the table holds."""
    hashes, items, places, seen = table
    at = np.flatnonzero(good & seen[(own >> _U(44)).astype(np.int64)])
    low, high = (np.searchsorted(hashes, own[at], side) for side in ("left", "right"))
    times = high - low
    entry = np.repeat(low, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    return np.repeat(at, times), items[entry], places[entry]


class Benchmark:
    """A block of items: their tokens, and their windows by width, sorted by hash."""

    def __init__(self, items: list[tuple[object, str]]):
        self.ids = [i for i, _ in items]
        self.values, self.template, self.slot, self.counts = templates([t for _, t in items], _Surfaces())
        self.first = np.cumsum(self.counts) - self.counts
        owner = np.repeat(np.arange(len(items)), self.counts)
        self.tables, self.exact = {}, {}
        no_slot = np.zeros(len(self.slot), np.int8)
        for width in sorted({min(WINDOW, int(c)) for c in self.counts if c >= 3}):
            self.tables[width] = self._table(owner, width, *windows(self.template, self.slot, self.counts, width))
            self.exact[width] = self._table(owner, width, *windows(self.values, no_slot, self.counts, width))
        parts = (self.values, self.template, self.slot, self.counts)
        self.single, self.pieces, self.loose = Pieces(*parts, False), Pieces(*parts, True), {}
        p = self.pieces
        half = np.where(p.counts < EDITED, p.counts, np.minimum((p.counts + 1) // 2, WINDOW))  # one insertion leaves a half whole
        for width in sorted({int(c) for c in half if c >= 3}):
            self.loose[width] = self._table(p.owner, width, *windows(p.template, p.slot, p.counts, width), p, half)

    def _table(self, owner: np.ndarray, width: int, hashes: np.ndarray, good: np.ndarray, of=None, widths=None) -> tuple[np.ndarray, ...]:
        of, widths = of or self, np.minimum(self.counts, WINDOW) if widths is None else widths
        at = np.flatnonzero(good)
        at = at[widths[owner[at]] == width]  # short items: one window, all of them
        order = np.argsort(hashes[at], kind="stable")
        seen = np.zeros(1 << 20, bool)
        seen[(hashes[at] >> _U(44)).astype(np.int64)] = True
        return hashes[at][order], owner[at][order], (at - of.first[owner[at]])[order], seen

    def matches(self, texts: list[str], surfaces: _Surfaces) -> list[list[dict]]:
        """The alignments of each text that cover enough words, best diagonal of each item.

        Windows of equal values count too where windows of templates are not enough: they
        need no plain words, and a word may be a name here and open a sentence there.  What no
        single diagonal decides is judged by chains over neighbouring ones (``_chains``).
        """
        values, template, slot, counts = templates(texts, surfaces)
        first = np.cumsum(counts) - counts
        owner = np.repeat(np.arange(len(counts)), counts)
        no_slot = np.zeros(len(slot), np.int8)
        single, pieces = (Pieces(values, template, slot, counts, c) for c in (False, True))
        best: dict[tuple[int, int], dict] = {}
        segments: list[np.ndarray] = []
        found: list[list[dict]] = [[] for _ in texts]
        for width, table in self.tables.items():
            hits = lookup(table, *windows(template, slot, counts, width))
            copies = lookup(self.exact[width], *windows(values, no_slot, counts, width))
            segments.append(self._segments(0, single, width, *map(np.concatenate, zip(hits, copies))))
            for at, item, place in (hits, tuple(map(np.concatenate, zip(hits, copies)))) if len(copies[0]) else (hits,):
                for key, row in self._alignments(width, values, slot, first, owner[at], at, item, place).items():
                    if not best.get(key, row)["consistent"]:
                        best[key] = row
                    best.setdefault(key, row)
        for width, table in self.loose.items():
            segments.append(self._segments(1, pieces, width, *lookup(table, *windows(pieces.template, pieces.slot, pieces.counts, width))))
        if segments:
            for key, row in self._chains(np.concatenate(segments), (single, pieces), best).items():
                best[key] = row
        for (d, _), row in sorted(best.items()):
            found[d].append(row)
        return found

    def _alignments(self, width, values, slot, first, doc, at, item, place) -> dict[tuple[int, int], dict]:
        """The best alignment of each text and item among the diagonals of these hits that cover enough words."""
        best: dict[tuple[int, int], dict] = {}
        if not len(at):
            return best
        diagonal = at - first[doc] - place
        order = np.lexsort((place, diagonal, item, doc))
        doc, item, place, diagonal = doc[order], item[order], place[order], diagonal[order]
        new = np.concatenate(([True], (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (diagonal[1:] != diagonal[:-1])))
        begin = np.flatnonzero(new)
        gain = np.where(new, width, np.minimum(np.diff(place, prepend=0), width))
        cover = np.add.reduceat(gain, begin)
        last = np.concatenate((begin[1:], [len(new)])) - 1
        enough = cover >= np.minimum(COVER, self.counts[item[begin]])
        for g in np.flatnonzero(enough):
            h, d, i = begin[g], int(doc[begin[g]]), int(item[begin[g]])
            span = np.arange(place[h], place[last[g]] + width)
            mine, its = first[d] + diagonal[h] + span, self.first[i] + span
            slots = (self.slot[its] > 0) & (self.slot[its] == slot[mine])
            a, b = self.values[its], values[mine]
            copy = unchanged(a == b, width).sum() >= min(COVER, self.counts[i])
            row = {
                "item_id": self.ids[i], "words": int(cover[g]), "slots": int(slots.sum()),
                "changed": len({(x, y) for x, y in zip(a[slots].tolist(), b[slots].tolist()) if x != y}),
                "consistent": copy or slots_agree(a[slots], b[slots], slot[mine][slots]),
            }
            old = best.get((d, i))
            if old is None or (row["consistent"], row["words"]) > (old["consistent"], old["words"]):
                best[d, i] = row
        return best

    def _segments(self, kind: int, own: Pieces, width: int, at, item, place) -> np.ndarray:
        """Hits without a gap on one diagonal, joined: text, item, kind, first piece in the texts and in the items, pieces,
        and from the start of the text or item the first token and the token after the last, in the text and in the item."""
        if not len(at):
            return np.zeros((0, 10), np.int64)
        its = (self.single, self.pieces)[kind]
        doc = own.owner[at]
        start = its.first[item] + place
        order = np.lexsort((start, at - start, item, doc))
        doc, item, at, start = doc[order], item[order], at[order], start[order]
        far = np.diff(start) > width
        new = np.concatenate(([True], (np.diff(doc) != 0) | (np.diff(item) != 0) | (np.diff(at - start) != 0) | far))
        begin = np.flatnonzero(new)
        last = np.concatenate((begin[1:], [len(new)])) - 1
        doc, item, at, n, start = doc[begin], item[begin], at[begin], start[last] - start[begin] + width, start[begin]
        spans = [t for s, side, text in ((at, own, doc), (start, its, item)) for t in (side.at[s] - side.tokens[text], side.at[s + n - 1] + side.size[s + n - 1] - side.tokens[text])]
        return np.stack([doc, item, np.full(len(doc), kind), at, start, n, *spans], axis=1)

    def _chains(self, seg: np.ndarray, own: tuple[Pieces, Pieces], best: dict) -> dict[tuple[int, int], dict]:
        """For texts and items without a consistent alignment the chain of segments that covers most words, if enough."""
        out = {}
        if not len(seg):
            return out
        seg = seg[np.lexsort((seg[:, 8], seg[:, 1], seg[:, 0]))]
        new = np.concatenate(([True], (np.diff(seg[:, 0]) != 0) | (np.diff(seg[:, 1]) != 0)))
        begin = np.flatnonzero(new)
        far = (np.cumsum(new) - 1) * (int(self.counts.max()) + 1)  # words covered by any segment bound those of a chain
        reach = np.maximum.accumulate(seg[:, 9] + far)
        before = np.concatenate(([0], reach[:-1]))
        cover = np.add.reduceat(np.maximum(0, seg[:, 9] + far - np.maximum(before, seg[:, 8] + far)), begin)
        need = np.minimum(COVER, self.counts[seg[begin, 1]])
        short = (self.pieces.counts < 2 * WINDOW) & (self.pieces.counts >= EDITED)
        for g in np.flatnonzero((cover >= need) | short[seg[begin, 1]]):
            key = int(seg[begin[g], 0]), int(seg[begin[g], 1])
            if not best.get(key, {"consistent": False})["consistent"]:
                part = seg[begin[g] : begin[g + 1] if g + 1 < len(begin) else len(seg)].tolist()
                row = self._chain(part, own, int(need[g])) if cover[g] >= need[g] else None
                if not row and short[key[1]]:
                    row = next(filter(None, (self._stretch(x, own) for x in part if x[2])), None)
                if row:
                    out[key] = row
        return out

    def _chain(self, segments: list[list[int]], own: tuple[Pieces, Pieces], need: int) -> dict | None:
        """The first consistent chain of enough words, those of most words first: a segment may follow one that starts before
        it in text and item and ends within ``SHIFT`` diagonals of it."""
        ends: dict[int, list[int]] = {}  # segments by the diagonal of their end
        cover, back = [], []
        for k, (_, _, _, _, _, _, p, pe, q, qe) in enumerate(segments):
            top, prev = qe - q, -1
            for diagonal in range(p - q - SHIFT, p - q + SHIFT + 1):
                for j in ends.get(diagonal, ()):
                    jp, jpe, jq, jqe = segments[j][6:]
                    gain = qe - q - max(0, jqe - q, jpe - p)
                    if jp < p and jq < q and gain > 0 and cover[j] + gain > top:
                        top, prev = cover[j] + gain, j
            cover.append(top)
            back.append(prev)
            ends.setdefault(pe - qe, []).append(k)
        seen: set[int] = set()
        for k in sorted(range(len(segments)), key=lambda k: -cover[k]):
            if cover[k] < need:
                return None
            if k in seen:
                continue
            words, chain = cover[k], []
            while k >= 0:
                seen.add(k)
                chain.append(segments[k])
                k = back[k]
            row = self._judge([(x[2], np.arange(x[4], x[4] + x[5]), np.arange(x[3], x[3] + x[5])) for x in chain[::-1]], own, chain[0][1], words, need)
            if row["consistent"]:
                return row
        return None

    def _stretch(self, segment: list[int], own: tuple[Pieces, Pieces]) -> dict | None:
        """A short item around one of its halves: all its pieces in order, with one inserted for every four of them at most,
        or one inside left out."""
        d, i, _, at, start, n = segment[:6]
        its, mine = self.pieces, own[1]
        low, count = int(its.first[i]), int(its.counts[i])
        begin, x, y, inserted, missing = int(mine.first[d]), list(range(start, start + n)), list(range(at, at + n)), 0, []
        for step, k, j, end, stop in ((1, start + n, at + n, low + count, begin + int(mine.counts[d])), (-1, start - 1, at - 1, low - 1, begin - 1)):
            for k in range(k, end, step):
                places = range(j, stop, step)[: count // 4 - inserted + 1]
                skip = next((s for s, place in enumerate(places) if its.template[k] == mine.template[place]), None)
                if skip is None:
                    missing.append(k)
                    if len(missing) > 1 or inserted or k in (low, low + count - 1):
                        return None
                    continue
                x.append(k), y.append(places[skip])
                inserted, j = inserted + skip, places[skip] + step
        if missing and (inserted or count < WINDOW):
            return None
        x, y = np.sort(x), np.sort(y)
        words = int(its.size[x].sum())
        row = self._judge([(1, x, y)], own, i, words, words)
        return row if row["consistent"] else None

    def _judge(self, chain: list[tuple[int, np.ndarray, np.ndarray]], own: tuple[Pieces, Pieces], i: int, words: int, need: int) -> dict:
        """The row of the aligned pieces (kind, those of the item, those of the text) of a chain."""
        a, b, kinds, done = [], [], [], -1
        copied = np.zeros(int(self.counts[i]) + 1, bool)
        for kind, x, y in chain:
            its, mine = (self.single, self.pieces)[kind], own[kind]
            place = its.at[x] - its.tokens[i]
            same = its.values[x] == mine.values[y]
            spots = np.repeat(place - np.cumsum(its.size[x]) + its.size[x], its.size[x]) + np.arange(its.size[x].sum())
            copied[spots[unchanged(np.repeat(same, its.size[x]), min(WINDOW, need))]] = True
            slots = (place > done) & (its.slot[x] > 0) & (its.slot[x] == mine.slot[y])
            a.append(its.values[x][slots]), b.append(mine.values[y][slots]), kinds.append(its.slot[x][slots])
            done = max(done, int(place[-1] + its.size[x[-1]] - 1))
        a, b, kinds = np.concatenate(a), np.concatenate(b), np.concatenate(kinds)
        return {
            "item_id": self.ids[i], "words": int(words), "slots": len(a),
            "changed": len({(x, y) for x, y in zip(a.tolist(), b.tolist()) if x != y}),
            "consistent": bool(copied.sum() >= need or slots_agree(a, b, kinds)),
        }


def _blocks(items: DataFrame, item_col: str, text_col: str) -> Iterator[tuple[list[tuple[object, str]], bool]]:
    """Blocks of (id, text), and whether it is the only one."""
    rows = items.select(F.col(item_col).alias("id"), text_or_empty(text_col).alias("text")).where("text != ''").distinct()
    tokens = rows.agg(F.sum(F.length("text")) / 2).first()[0] or 0  # a token takes two characters at least
    n = int(tokens // BLOCK_TOKENS) + 1
    for k in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k)
        yield [(r.id, r.text) for r in part.orderBy("id", "text").collect()], n == 1


def matchers(items: DataFrame, item_col: str = "item_id", item_text_col: str = "text") -> Iterator[tuple[Callable[[Column], Column], Callable[[DataFrame], DataFrame]]]:
    """For each block of the benchmark a function from a text column to the array of its hits
    (item_id, words covered, slots, slots changed, consistent), and what is done to a table made with it:
    of several blocks one is in the workers at a time, its result is written before the next."""
    kind = items.schema[item_col].dataType.simpleString()
    fields = f"array<struct<item_id: {kind}, words: int, slots: int, changed: int, consistent: boolean>>"
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
    hit = pa.list_(pa.struct([("item_id", arrow), ("words", pa.int32()), ("slots", pa.int32()), ("changed", pa.int32()), ("consistent", pa.bool_())]))

    def matcher(shared) -> Callable[[Column], Column]:
        @F.arrow_udf(fields)
        def run(texts: pa.Array) -> pa.Array:
            bench, surfaces, out, chunk, chars = shared.value, _Surfaces(), [], [], 0
            for value in texts:
                chunk.append(value.as_py())
                chars += len(chunk[-1])
                if chars >= CHUNK_CHARS:
                    out += bench.matches(chunk, surfaces)
                    chunk, chars = [], 0
                    surfaces = surfaces if len(surfaces) < SURFACES else _Surfaces()
            out += bench.matches(chunk, surfaces)
            del surfaces, chunk
            give_back()
            return pa.array(out, hit)

        return lambda text: run(text_or_empty(text))

    sc = items.sparkSession.sparkContext
    for block, alone in _blocks(items, item_col, item_text_col):
        shared = sc.broadcast(Benchmark(block))
        yield matcher(shared), (lambda df: df) if alone else cut
        if not alone:
            shared.unpersist()


def leaks(df: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (id, item_id, words, slots, changed) for each document and item with a
    consistent alignment of at least 13 words, or of all words of a shorter item.

    Null and empty texts hold nothing; items of fewer than three words can't be told
    from chance and match nothing; repeated documents repeat; equal items of other
    ids match each on its own; an empty table on either side gives no rows.
    """
    found = [
        done(df.select(F.col(id_col), hits(F.col(text_col)).alias("_hits")).select(F.col(id_col), F.inline("_hits")).where("consistent").drop("consistent"))
        for hits, done in matchers(items)
    ]
    return reduce(DataFrame.unionByName, found)


def drop_leaking(df: DataFrame, items: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` without a consistent alignment; columns as before.

    Null and empty texts hold nothing and stay, repeated rows stay or go together, whole
    texts count however long, an empty benchmark lets everything stay.
    """
    for hits, done in matchers(items):
        df = done(df.where(~F.exists(hits(F.col(text_col)), lambda h: h["consistent"])))
    return df
