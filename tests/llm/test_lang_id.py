"""Operator 12: against a plain twin of counts and backoff, and held-out accuracy."""

import math
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexiflow.llm import lang_id as L
from lexiflow.llm.queries import op12_word_backoff
from tests.conftest import SF_MID

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def plain_words(text):
    out, word = [], ""
    for c in text.lower() + " ":
        if c.isalpha():
            word += c
        elif word:
            out.append(word)
            word = ""
    return out


def brute(rows):
    """Score and language of each row by plain dictionaries (texts without combining marks)."""
    learnt = [(t, lang) for i, t, lang in rows if None not in (i, t, lang) and zlib.crc32(str(i).encode()) % 4 != 2]
    langs = sorted({lang for _, lang in learnt})
    counts = {n: {x: Counter() for x in langs} for n in range(L.LONGEST + 1)}
    for text, lang in learnt:
        for w in plain_words(text):
            counts[0][lang][w] += 1
            for n in range(1, L.LONGEST + 1):
                counts[n][lang].update(f"^{w}$"[i : i + n] for i in range(len(w) + 3 - n))
    kinds = {n: max((len(c) for c in by.values()), default=0) for n, by in counts.items()}

    def logs(n, item):
        if sum(c[item] for c in counts[n].values()) < L.LEAST:
            return None
        return [math.log((counts[n][x][item] + L.SMOOTH) / (sum(counts[n][x].values()) + L.SMOOTH * (kinds[n] + 1))) for x in langs]

    out = []
    for _, text, _ in rows:
        found = plain_words(text or "")
        if not found or not langs:
            out.append(("und", 0.0))
            continue
        total = [math.log(sum(x == lang for _, lang in learnt) / len(learnt)) for x in langs]
        for w in found:
            got = logs(0, w)
            for n in range(L.LONGEST, 0, -1):
                if got is None:
                    known = [k for i in range(len(w) + 3 - n) if (k := logs(n, f"^{w}$"[i : i + n])) is not None]
                    if known:
                        got = [sum(k) / len(known) for k in zip(*known)]
            if got is not None:
                total = [a + b for a, b in zip(total, got)]
        top = max(total)
        out.append((langs[total.index(top)], 1 / sum(math.exp(x - top) for x in total)))
    return out


ROWS = [
    (i, t, lang)
    for i, (t, lang) in enumerate(
        [("the cat and the dog", "en"), ("der Hund und die Katze", "de"), ("le chat et le chien", "fr"), ("the house THE House", "en"), ("das Haus, die Mäuse", "de")] * 6
        + [("chatting doggone hausen", None), ("zzz", None), ("123 --", "en"), (None, "en"), ("", "fr"), ("qqq日本", None), ("Maus maus the", "de"), ("thecat " * 20_000, None)]
    )
] + [(None, "the the der", "de"), (3, "the cat and the dog", "en"), (3, "the cat and the dog", "en")]


def test_equals_plain_twin(spark):
    df = spark.createDataFrame([(i, t, lang, "s", 1) for i, t, lang in ROWS], SCHEMA).withColumns({"item": F.lit(1), "p": F.lit(2), "score": F.lit(3), "at": F.monotonically_increasing_id()})
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.held_out, r.lang_pred, round(r.score, 6)) for r in L.identify(df.repartition(4)).collect())
    want = sorted((i if i is not None else -1, i is not None and zlib.crc32(str(i).encode()) % 4 == 2, lang, round(score, 6)) for (i, _, _), (lang, score) in zip(ROWS, brute(ROWS)))
    assert got == want


def test_held_out_accuracy(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()}
    rows = op12_word_backoff(spark, SF_MID).collect()
    assert len(rows) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and docs[r.doc_id].lang]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) >= 0.99 * len(held)


def test_labels_of_held_out_rows_and_columns_are_not_read(spark):
    df = spark.read.parquet(f"{SF_MID}/documents.parquet")
    wrong = F.when(L.held_out("doc_id"), F.lit("xx")).otherwise(F.col("lang"))
    one, two = (sorted(map(tuple, L.identify(d).collect())) for d in (df, df.withColumn("lang", wrong).withColumn("source", F.lit("other"))))
    assert one == two


def test_small_model_falls_back_to_grams(spark, monkeypatch):
    monkeypatch.setattr(L, "CELLS", 400)  # a hundred words, a hundred n-grams
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()}
    held = [r for r in op12_word_backoff(spark, SF_MID).collect() if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id] for r in held) >= 0.95 * len(held)


@pytest.mark.parametrize("rows", [[], [(1, "nothing to learn from", None, "s", 1), (2, None, "en", "s", 1)]])
def test_nothing_to_learn(spark, rows):
    got = L.identify(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)] * len(rows)
