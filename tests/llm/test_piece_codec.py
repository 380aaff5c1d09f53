"""Operator 5: ids and texts against the library itself."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from lexiflow.llm import prefix_bpe
from lexiflow.llm.queries import PIECE_MODEL, op5_piece_codec
from tests.conftest import SF_SMALL

LIB = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
EDGE = [None, "", " ", "  a  b ", "a\tb", "é①ﬁ", "a▁b", "<s>x</s>", "\0x", "a​b", "😀x🤖🧬 𓀀", "\n\n a\n", "a" * 3000, " " * 300, "².x", "x² y."]


def ids_of(texts):
    return [np.frombuffer(b, dtype=np.uint32).tolist() for b in prefix_bpe.prefix_table(PIECE_MODEL).encode(texts)]


def test_units_of_mixed_characters_equal_the_library():
    rng = random.Random(5)
    chars = "abcdeilnorst  \n.,éüßAB01▁=-(){}\t①あ的ि़²"
    texts = ["".join(rng.choice(chars) for _ in range(rng.randint(0, 30))) for _ in range(5000)]
    assert ids_of(texts) == LIB.encode(texts)


def test_memory_limits_do_not_change_ids(monkeypatch):
    monkeypatch.setattr(prefix_bpe, "UNIT_MEMORY", 5)
    monkeypatch.setattr(prefix_bpe, "PAIR_MEMORY", 7)
    table = prefix_bpe.PrefixTable(PIECE_MODEL)
    texts = ["some words of a text, more words of it", "and another one, more of it"] * 3
    got = [np.frombuffer(table.encode([t])[0], dtype=np.uint32).tolist() for t in texts]
    assert got == LIB.encode(texts)


def test_edges_through_spark(spark):
    df = spark.createDataFrame([(i, t, "n", 1) for i, t in enumerate(EDGE)] * 2, "doc_id long, text string, ids string, n_tokens int")
    got = prefix_bpe.tokenize(df, PIECE_MODEL, emit=("ids", "n_tokens", "ids_sha256", "decoded", "decoded_sha256")).collect()
    assert len(got) == 2 * len(EDGE)
    for r in got:
        want = LIB.encode(EDGE[r.doc_id] or "", add_bos=True, add_eos=True)
        assert r.ids == want and r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(np.array(want, dtype="<u4").tobytes()).hexdigest()
        assert r.decoded == LIB.decode(want)
        assert r.decoded_sha256 == hashlib.sha256(r.decoded.encode()).hexdigest()


def test_empty_table(spark):
    assert prefix_bpe.tokenize(spark.createDataFrame([], "doc_id long, text string"), PIECE_MODEL).count() == 0


@pytest.mark.parametrize("name", ["documents"])
def test_query_equals_the_library(spark, name):
    got = {r.doc_id: r for r in op5_piece_codec(spark, SF_SMALL).collect()}
    for r in spark.read.parquet(f"{SF_SMALL}/{name}.parquet").collect():
        ids = LIB.encode(r.text or "", add_bos=True, add_eos=True)
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256(LIB.decode(ids).encode()).hexdigest()
