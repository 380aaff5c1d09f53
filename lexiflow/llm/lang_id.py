"""Language identification by words first, then shorter and shorter n-grams (operator 12).

Training counts words and character n-grams per language over *all* labelled texts.
A document is scored word by word: a known word gives each language its smoothed log
frequency of that word; an unseen one falls back to its character n-grams (with word
bounds), longest first: the longest length at which the model knows any of them decides,
by the mean of their log frequencies.  A word without any known n-gram says nothing.
The sum over the words and the log share of each language's documents decide.

The model keeps the most frequent words and n-grams, as many as fit ``CELLS`` (word or
n-gram, language) numbers each, and is shipped to the tasks; that bounds its size, not
the rows: rarer words are exactly the case for the n-grams.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiflow.llm.common import cut

#: Longest n-gram; numbers that the words and that the n-grams of a model may hold; smoothing count.
LONGEST, CELLS, SMOOTH = 5, 400_000, 0.5
#: Fewest training occurrences of a known word or n-gram: what occurs once is as good as unseen.
LEAST = 2
#: Different words or n-grams that a task counts before it hands the counts on (bounds its memory).
COUNTED = 300_000
UNKNOWN = "und"

_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")


def words(text: str) -> list[str]:
    """Runs of letters (with their marks), lower case."""
    return _WORD.findall(text.lower())


def grams(word: str, n: int) -> list[str]:
    """The n-grams of a word between its bounds; shorter words than n give none."""
    bounded = f"^{word}$"
    return [bounded[i : i + n] for i in range(len(bounded) - n + 1)]


def held_out(id_col: str) -> Column:
    """Whether crc32 of the id as text is 2 modulo 4 (false for a null id, which isn't learnt from either)."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(4)) == 2, F.lit(False))


_COUNTS = "n int, lang string, item string, times bigint"


def _rows(found: dict[tuple[int, str], Counter]) -> Iterator[pa.RecordBatch]:
    for (n, lang), counts in found.items():
        columns = [pa.repeat(pa.scalar(n, pa.int32()), len(counts)), pa.repeat(pa.scalar(lang, pa.string()), len(counts))]
        yield pa.record_batch([*columns, pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["n", "lang", "item", "times"])
    found.clear()


def _count_words(batches):
    """Counts of the words (n = 0) of texts by language, handed on whenever there are many."""
    found: dict[tuple[int, str], Counter] = defaultdict(Counter)
    for batch in batches:
        for text, lang in zip(batch["text"], batch["lang"].to_pylist()):
            found[0, lang].update(words(text.as_py()))
            if sum(map(len, found.values())) > COUNTED:
                yield from _rows(found)
    yield from _rows(found)


def _count_grams(langs: list[str]):
    """Counts of the n-grams (n = 1 ...) of counted words (item, times by language): each as often as its word."""

    def run(batches):
        found: dict[tuple[int, str], Counter] = defaultdict(Counter)
        for batch in batches:
            items = batch["item"].to_pylist()
            for k, lang in enumerate(langs):
                times = batch[f"t{k}"].to_numpy()
                once = [items[i] for i in np.flatnonzero(times == 1)]
                often = [(items[i], int(times[i])) for i in np.flatnonzero(times > 1)]
                for n in range(1, LONGEST + 1):
                    counts = found[n, lang]
                    counts.update([g for w in once for g in grams(w, n)])
                    for w, t in often:
                        for g in grams(w, n):
                            counts[g] += t
            if sum(map(len, found.values())) > COUNTED:
                yield from _rows(found)
        yield from _rows(found)

    return run


@dataclass
class Model:
    """``langs`` in order, the log shares of their documents; for each n (0: words) the row of every known
    item in ``logs``, the log frequencies by language."""

    langs: list[str]
    share: np.ndarray
    rows: list[dict[str, int]]
    logs: np.ndarray

    def backoff(self, word: str) -> list[int]:
        """The rows of the longest known n-grams of an unseen word; their mean counts."""
        for n in range(LONGEST, 0, -1):
            table = self.rows[n]
            if known := [table[g] for g in grams(word, n) if g in table]:
                return known
        return []

    def predict(self, text: str | None, memory: dict) -> tuple[str, float]:
        """Language and score; ``memory`` keeps the rows of unseen words."""
        counts = Counter(words(text)) if text else None
        if not counts or not self.langs:
            return UNKNOWN, 0.0
        known, at, times = self.rows[0], [], []
        for word, k in counts.items():
            if (row := known.get(word)) is not None:
                at.append(row)
                times.append(k)
                continue
            if (rows := memory.get(word)) is None:
                rows = memory[word] = self.backoff(word)
            at += rows
            times += [k / len(rows)] * len(rows) if rows else ()
        total = self.share + np.array(times, float) @ self.logs[at] if at else self.share
        best = int(np.argmax(total))  # ties: the language that is first in order
        return self.langs[best], float(1 / np.exp(total - total[best]).sum())


def fit(rows: DataFrame) -> Model:
    """A model from (text, lang), both not null.  Counts cover all rows; the model's size is bounded."""
    known = rows.where("text is not null and lang is not null")
    docs = dict(known.groupBy("lang").agg(F.count("*")).collect())  # one row a language
    if not docs:
        return Model([], np.zeros(0), [{}] * (LONGEST + 1), np.zeros((0, 0)))
    langs = sorted(docs)
    share = np.log(np.array([docs[x] for x in langs], float) / sum(docs.values()))
    names = [f"t{k}" for k in range(len(langs))]
    by_lang = [F.coalesce(F.sum(F.when(F.col("lang") == x, F.col("times"))), F.lit(0)).alias(t) for x, t in zip(langs, names)]
    per_word = cut(known.mapInArrow(_count_words, _COUNTS).groupBy("n", "item").agg(*by_lang))
    per_gram = cut(per_word.mapInArrow(_count_grams(langs), _COUNTS).groupBy("n", "item").agg(*by_lang))
    model, logs = Model(langs, share, [{} for _ in range(LONGEST + 1)], np.zeros((0, len(langs)))), []
    for counts in (per_word, per_gram):
        sums = [x for t in names for x in (F.sum(t), F.sum((F.col(t) > 0).cast("int")))]
        totals = {r[0]: np.array(r[1:], float).reshape(-1, 2) for r in counts.groupBy("n").agg(*sums).collect()}
        every = sum(map(F.col, names))
        kept = counts.withColumn("all", every).where(F.col("all") >= LEAST).orderBy(F.desc("all"), "n", "item").limit(max(CELLS // len(langs), 1)).toArrow()
        n_of, times = kept["n"].to_numpy(), np.stack([kept[t].to_numpy() for t in names], 1)
        for n, total in totals.items():
            at = np.flatnonzero(n_of == n)
            first = sum(map(len, logs))
            model.rows[n] = {x: first + i for i, x in enumerate(kept["item"].take(pa.array(at)).to_pylist())}
            logs.append(np.log((times[at] + SMOOTH) / (total[:, 0] + SMOOTH * (total[:, 1].max() + 1))))
    model.logs = np.concatenate([model.logs, *logs])
    return model


#: Words whose scores a task keeps at hand.
MEMORY = 100_000


def _predict(text: Column, model: Model) -> Column:
    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def run(texts: pa.Array) -> pa.Array:
        memory: dict = {}
        found = []
        for t in texts:
            found.append(model.predict(t.as_py(), memory))
            if len(memory) > MEMORY:
                memory.clear()
        langs, scores = zip(*found) if found else ((), ())
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["lang_pred", "score"])

    return run(text)


def identify(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", model: Model | None = None) -> DataFrame:
    """One row (id, held_out, lang_pred, score) per row of ``df``.

    Unless a ``model`` is given, one is learnt from the rows of ``df`` that have a text, a
    language and an id that isn't held out.  A null or empty text, or one without a letter,
    is ``und`` with score 0, and so is every text if there is nothing to learn from.  The
    score is the language's posterior share, and equal ones go to the first name.  A text of
    which the model knows nothing gets the most frequent language.  Whole texts count,
    however long; repeated rows repeat; columns that aren't named are not read.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), held_out(id_col).alias("held_out"))
    if model is None:
        model = fit(rows.where(~F.col("held_out") & F.col("id").isNotNull()).select("text", "lang"))
    scored = rows.select("id", "held_out", _predict(F.col("text"), model).alias("p"))
    return scored.select(F.col("id").alias(id_col), "held_out", "p.lang_pred", "p.score")
