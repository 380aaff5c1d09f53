"""Operator 4: against a plain version over all window pairs."""

import re

from lexiflow.llm import decontaminate as D
from lexiflow.llm.queries import op4_templates
from tests.conftest import SF_SMALL

QUESTION = "Tom has 12 apples and gives 5 apples to Mary before he walks 3 km home, so how many apples are left in the basket at noon?"


def plain_tokens(text):
    out, opens = [], True
    for t in re.findall(r"\d+(?:[.,]\d+)*|\w+|[.!?\n]", text or ""):
        if t in ".!?\n":
            opens = True
            continue
        low = t.lower()
        if t[0].isdigit() or low in D.NUMBER_WORDS:
            out.append((low, "<number>"))
        elif low in D.UNITS:
            out.append((low, "<unit>"))
        elif len(t) > 1 and t.istitle() and not opens:
            out.append((low, "<name>"))
        else:
            out.append((low, low))
        opens = False
    return out


def plain(doc, item):
    """Words covered by the best consistent diagonal, or None."""
    a, b = plain_tokens(doc), plain_tokens(item)
    w = min(8, len(b))
    if w < 3:
        return None
    best = None
    for d in range(-len(b), len(a)):
        hits = []
        for j in range(len(b) - w + 1):
            i = j + d
            if 0 <= i <= len(a) - w and all(a[i + k][1] == b[j + k][1] for k in range(w)):
                if sum(b[j + k][0] == b[j + k][1] for k in range(w)) >= min(4, (w + 1) // 2):
                    hits.append(j)
        cover = {j + k for j in hits for k in range(w)}
        if hits and len(cover) >= min(13, len(b)):
            span = range(min(hits), max(hits) + w)
            pairs = {(b[j][0], a[j + d][0]) for j in span if b[j][0] != b[j][1] and b[j][1] == a[j + d][1]}
            if len({x for x, _ in pairs}) == len(pairs) == len({y for _, y in pairs}):
                best = max(best or 0, len(cover))
    return best


def docs():
    pad = "Some other words stand here, quite a few of them indeed. "
    other = QUESTION.replace("Tom", "Ann").replace("12", "40").replace("5", "7").replace("3 km", "9 miles").replace("Mary", "Bob")
    clash = QUESTION.replace("how many apples", "how many pears").replace("12 apples", "12 Apples")
    return [
        None, "", pad, pad + QUESTION, pad + QUESTION.upper(), other + pad, "x " * 30000 + QUESTION, QUESTION[:40], clash,
        "Alice sees 4 and 4 and then 9 with Carl in the old house by the sea at dusk.", pad + "\n" + other + "\n" + QUESTION, "short one here",
    ]


ITEMS = [
    (1, QUESTION), (2, "Alice sees 1 and 2 and then 3 with Dora in the old house by the sea at dusk."), (3, None), (4, ""), (5, "two words"),
    (6, "short one here"), (7, QUESTION), (1, QUESTION),
]


def test_against_the_plain_version(spark):
    df = spark.createDataFrame([(i, t, "e") for i, t in enumerate(docs())] * 2, "doc_id long, text string, hits string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.words) for r in D.leaks(df, items).collect())
    want = sorted((i, k, plain(t, q)) for i, t in enumerate(docs()) for k, q in dict(ITEMS).items() if q and plain(t, q)) * 2
    assert got == sorted(want)
    found = {(i, k) for i, k, _ in got}
    assert {(3, 1), (5, 1), (6, 1), (10, 1), (11, 6)} <= found  # verbatim, re-parameterised, deep in a long text, a short item
    assert (9, 2) not in found and not {i for i, _ in found} & {0, 1, 2, 7}  # contradicting slots, clean texts


def test_blocks_of_the_benchmark_change_nothing(spark, monkeypatch):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(docs())], "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    whole = sorted(map(tuple, D.leaks(df, items).collect()))
    kept = sorted(r.doc_id for r in D.drop_leaking(df, items).collect())
    monkeypatch.setattr(D, "BLOCK_TOKENS", 20)
    monkeypatch.setattr(D, "CHUNK_CHARS", 100)
    monkeypatch.setattr(D, "SURFACES", 5)
    assert sorted(map(tuple, D.leaks(df, items).collect())) == whole
    assert sorted(r.doc_id for r in D.drop_leaking(df, items).collect()) == kept
    assert set(kept) == set(range(len(docs()))) - {r[0] for r in whole}


def test_empty_tables(spark):
    df = spark.createDataFrame([(1, QUESTION)], "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert D.leaks(df, items.limit(0)).count() == 0 and D.leaks(df.limit(0), items).count() == 0
    assert D.drop_leaking(df, items.limit(0)).count() == 1


def test_query_finds_all_verbatim_items(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()
    got = {(r.doc_id, r.item_id) for r in op4_templates(spark, SF_SMALL).collect()}
    verbatim = {(r.doc_id, i.item_id) for r in rows for i in items if i.text in (r.text or "")}
    assert verbatim and verbatim <= got
    text, item = {r.doc_id: r.text for r in rows}, {i.item_id: i.text for i in items}
    assert all(plain(text[d], item[i]) for d, i in got)


def found(spark, texts, items):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {(r.doc_id, r.item_id) for r in D.leaks(df, spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()}


def test_a_changed_value_does_not_hide_a_copy(spark):
    item = (
        "the farmer put 5 sacks of corn on the cart and then drove along the river until he met Mary at the mill where the old miller weighed "
        "all 6 bags and paid for 5 sacks while Mary wrote the sum into a long green book that lay open on the heavy table"
    )
    once = item.replace("paid for 5", "paid for 8")  # a value that occurs twice, changed in one place
    other = item.replace("paid for 5", "paid for 6")  # it equals another value of the item
    name = item.replace("while Mary", "while Paul")
    pad = "quite another text stands here, and then "
    assert found(spark, [pad + once, pad + other, pad + name, pad], [item]) == {(0, 0), (1, 0), (2, 0)}


def test_one_number_may_become_several(spark):
    item = "the boy has 5 red apples and the girl has 5 green pears so who of them has more fruit in the end"
    assert found(spark, [item.replace("5 red", "4 red").replace("5 green", "7 green")], [item]) == {(0, 0)}


def test_items_of_few_plain_words_are_found_verbatim(spark):
    items = [
        "12 kg 5 m 30 km 7 seconds 18 hours 4 days 25 percent 9 miles",
        "the towns are Paris London Rome Madrid Vienna Berlin Oslo",
        "Paris is the capital of which country in Europe today",  # its first word is a name elsewhere
        "3 4 5",
    ]
    texts = [f"we note {t} and go on" for t in items]
    texts += ["we note 13 kg 6 m 31 km 8 seconds 19 hours 5 days 26 percent 8 miles and go on", "we note 3 5 5 and go on"]
    assert found(spark, texts, items) == {(i, i) for i in range(4)}


def test_inserted_and_deleted_words_do_not_hide_an_item(spark):
    long = "the boy who lived by the river had never seen a ship until his uncle took him down to the harbour one morning in the spring"
    words, nine = long.split(), "which of these birds can fly the very farthest"
    names = "when our friend Mary had paid 25 coins for the bread she asked Paul to carry it up the hill"
    items = [long, nine, names]
    texts = [
        " ".join(words[:12] + ["really"] + words[12:24]),
        " ".join(words[:9] + ["really"] + words[9:18] + ["so"] + words[18:]),
        " ".join(words[:12] + words[13:]),
        nine.replace("birds", "big birds"),
        nine.replace("these ", ""),
        names.replace("Mary", "Anna Maria").replace("25", "twenty five").replace("Paul", "Peter John"),
        "which of these birds has blue wings and can not fly the very long way",
        " ".join(words[:7] + ["quite", "other", "words", "stand", "between"] * 3 + words[9:16]),
    ]
    pad = "we read it there and then we wrote: "
    assert found(spark, [pad + t + " and so on" for t in texts], items) == {(0, 0), (1, 0), (2, 0), (3, 1), (4, 1), (5, 2)}
