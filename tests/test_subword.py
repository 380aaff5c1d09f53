"""Best paths against all segmentations, per-side special ids, and round trips."""

import itertools
import random

import pytest

from lexiflow.functions.lattice import SPACE, UNKNOWN_PENALTY, PieceLattice
from lexiflow.operators import subword as sw
from lexiflow.sources.fixtures import UNK_ID

PIECES = [(SPACE, 10, -4.0), (SPACE + "a", 11, -2.0), ("a", 12, -3.0), ("b", 13, -3.0), ("ab", 14, -5.0), ("ba", 15, -2.5), (SPACE + "ab", 16, -4.5), ("bab", 17, -6.0), ("é", 18, -7.0)]


def every_path(word, pieces):
    """(score, ids, reversed piece lengths) of every segmentation, unknown characters included."""
    table = {p: (i, s) for p, i, s in pieces}
    unknown = min(s for _, _, s in pieces) - UNKNOWN_PENALTY
    for cuts in itertools.product([False, True], repeat=max(len(word) - 1, 0)):
        bounds = [0, *[k + 1 for k, c in enumerate(cuts) if c], len(word)]
        parts = [word[a:b] for a, b in zip(bounds, bounds[1:])]
        if all(p in table or len(p) == 1 for p in parts):
            total = 0.0
            for p in parts:
                total += table[p][1] if p in table else unknown
            ids = [table[p][0] if p in table else UNK_ID for p in parts]
            merged = [i for k, i in enumerate(ids) if not (i == UNK_ID and k and ids[k - 1] == UNK_ID)]
            yield total, merged, [len(p) for p in reversed(parts)]


@pytest.mark.parametrize("seed", range(5))
def test_best_path_equals_brute_force(seed):
    random.seed(seed)
    pieces = list(PIECES) + [("".join(random.choices("abcé", k=k)), 100 + 10 * k + j, -random.randint(1, 12) / 2) for k in (2, 3, 4) for j in range(4)]
    pieces = list({p: (p, i, s) for p, i, s in pieces}.values())
    lattice = PieceLattice(pieces, UNK_ID)
    for _ in range(80):
        word = SPACE + "".join(random.choices("abcéz", k=random.randint(0, 9)))
        score, ids, _ = max(every_path(word, pieces), key=lambda x: (x[0], x[2]))
        assert lattice.best_path(word) == ids, word


def test_two_code_modes_and_plain(spark):
    pieces = spark.createDataFrame(PIECES, "piece string, id int, score double")
    df = spark.createDataFrame([(1, " a  ab\n", "ba"), (2, None, ""), (3, "zz z", "ébab")], "row_id long, s string, t string")
    body = {1: ([11, 16], [10, 15]), 2: ([], []), 3: ([10, 3, 10, 3], [10, 18, 13, 12, 13])}
    lattice = PieceLattice(PIECES, UNK_ID)
    body = {k: ([i for w in (s or "").split() for i in lattice.best_path(SPACE + w)], [i for w in t.split() for i in lattice.best_path(SPACE + w)]) for k, s, t in df.collect()}
    for mode, wrap in (("suffix_code", lambda ids, code: [*ids, 2, code]), ("prefix_code", lambda ids, code: [code, *ids, 2]), ("plain", lambda ids, code: [0, *ids, 2])):
        specials = {"s_ids": sw.side_ids(mode, 250004), "t_ids": sw.side_ids(mode, 250005)}
        got = sw.encode_pieces(df, {"s": "s_ids", "t": "t_ids"}, pieces, specials).collect()
        assert {r.row_id: (r.s_ids, r.t_ids) for r in got} == {k: (wrap(a, 250004), wrap(b, 250005)) for k, (a, b) in body.items()}
    assert sw.side_ids("plain", bos_id=None) == ([], [2])
    with pytest.raises(ValueError):
        sw.side_ids("suffix_code")


def test_limits_count_the_special_ids(spark):
    pieces = spark.createDataFrame(PIECES, "piece string, id int, score double")
    df = spark.createDataFrame([(1, "a a a a"), (2, "a")], "row_id long, s string")
    got = sw.encode_pieces(df, {"s": "ids"}, pieces, {"ids": ([], [2, 9])}, max_lens={"ids": 4}).collect()
    assert {r.row_id: r.ids for r in got} == {1: [11, 11, 2, 9], 2: [11, 2, 9]}
    assert [r.row_id for r in sw.encode_pieces(df, {"s": "ids"}, pieces, {"ids": ([], [2, 9])}, drop_over={"ids": 4}).collect()] == [2]


@pytest.mark.parametrize("head", [0, 2, 1000])
def test_round_trip(spark, head):
    pieces = spark.createDataFrame(PIECES, "piece string, id int, score double")
    texts = ["a ab bab", "", "ba  ba\tab", "baba éa"]
    df = spark.createDataFrame(list(enumerate(texts)), "row_id long, s string")
    enc = sw.encode_pieces(df, {"s": "ids"}, pieces)
    got = {r.row_id: r.text for r in sw.decode_pieces(enc, {"ids": "text"}, pieces, head=head).collect()}
    assert got == {k: " ".join(t.split()) for k, t in enumerate(texts)}


def test_bad_tables(spark, monkeypatch):
    df = spark.createDataFrame([(1, "a")], "row_id long, s string")
    with pytest.raises(ValueError, match="span"):
        sw.encode_pieces(df, {"s": "ids"}, spark.createDataFrame([("a" + SPACE, 5, -1.0)], "piece string, id int, score double"))
    monkeypatch.setattr(sw, "MAX_PIECES", 2)
    with pytest.raises(ValueError, match="at most"):
        sw.encode_pieces(df, {"s": "ids"}, spark.createDataFrame(PIECES, "piece string, id int, score double"))
