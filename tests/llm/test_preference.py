"""Operator 7: against a plain version."""

import json

from lexiflow.llm import preference as P
from lexiflow.llm.queries import op7_preference
from tests.conftest import SF_SMALL


def safe(t):
    return t.replace("<|", "<\\|")


def plain(chosen, rejected):
    k = 0
    while k < min(len(chosen), len(rejected)) and chosen[k] == rejected[k]:
        k += 1

    def side(turns):
        text, spans = "", []
        for role, said in turns:
            text += f"<|{safe(role)}|>\n"
            start = len(text)
            text += safe(said) + "<|end|>\n"
            if role == "assistant":
                spans.append(f"{start}:{len(text)}")
        return text, ",".join(spans)

    return (k, side(chosen[:k])[0], *side(chosen[k:]), *side(rejected[k:]))


def derived(rows):
    chats = {}
    for conv, turn, role, text in rows:
        chats.setdefault(conv, []).append((turn, role or "", text or ""))
    chats = {c: [(r, t) for _, r, t in sorted(v, key=lambda x: (x[0] is not None, x))] for c, v in chats.items()}
    out = {}
    for c, turns in chats.items():
        at = max((i for i, t in enumerate(turns) if t[0] == "assistant"), default=None)
        if at is None:
            out[c] = plain(turns, turns)
            continue
        other = chats.get(c + 1) if c is not None else None
        reply = [t for t in other or [] if t[0] == "assistant"][-1:]
        out[c] = plain(turns, turns[:at] + reply)
    return out


def fields(r):
    return (r.prompt_turns, r.prompt, r.chosen, r.chosen_spans, r.rejected, r.rejected_spans)


ROWS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "hello <|end|> there"), (1, 2, "user", "bye"),
    (2, 0, "system", "s"), (2, 1, "user", "é😀"), (2, 2, "assistant", "x" * 20000), (3, 0, "user", "alone"),
    (5, 0, "assistant", "same"), (6, 0, "assistant", "same"), (7, 0, "user", None), (7, 1, None, "t"), (7, 1, None, "t"),
    (7, 2, "assistant", ""), (8, None, "assistant", "r"), (8, 0, "user", "u"), (None, 0, "user", "lost"), (None, 1, "assistant", "a"),
]


def test_pairs_from_turns(spark):
    turns = spark.createDataFrame(ROWS, "conv_id long, turn int, role string, text string")
    got = {r.conv_id: fields(r) for r in P.format_pairs(P.swapped_replies(P.conversations(turns))).collect()}
    assert got == derived(ROWS)


def test_given_pairs_with_clashing_columns(spark):
    cases = [
        ([("user", "a"), ("assistant", "b")], [("user", "a"), ("assistant", "c")]), ([("user", "a")], [("user", "a"), ("assistant", "c")]),
        ([], []), (None, [("assistant", "c")]), ([("user", "x")], [("user", "y")]), ([("user", "x")] * 2, [("user", "x")] * 2),
    ]
    schema = "pair_id int, _a string, _k string, prompt string, chosen array<struct<role:string,text:string>>, rejected array<struct<role:string,text:string>>"
    got = P.format_pairs(spark.createDataFrame([(i, "e", None, "p", *c) for i, c in enumerate(cases)], schema))
    assert got.columns == ["pair_id", "_a", "_k", "prompt_turns", "prompt", "chosen", "chosen_spans", "rejected", "rejected_spans"]
    for r in got.collect():
        assert fields(r) == plain(*[c or [] for c in cases[r.pair_id]])


def test_empty_table(spark):
    turns = spark.createDataFrame([], "conv_id long, turn int, role string, text string")
    assert P.format_pairs(P.swapped_replies(P.conversations(turns))).count() == 0


def test_spans_cut_out_assistant_text(spark):
    for r in op7_preference(spark, SF_SMALL).collect():
        for text, spans in ((r.chosen, r.chosen_spans), (r.rejected, r.rejected_spans)):
            for s in filter(None, spans.split(",")):
                a, b = map(int, s.split(":"))
                assert text[:a].endswith("<|assistant|>\n") and text[a:b].endswith("<|end|>\n"), json.dumps(s)


def test_query_against_the_plain_version_and_native(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    df = op7_preference(spark, SF_SMALL)
    assert {r.conv_id: fields(r) for r in df.collect()} == derived(rows)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))
