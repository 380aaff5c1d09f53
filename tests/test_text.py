import random

from pyspark.sql import functions as F

from lexiflow.functions.text import PY_WHITESPACE, rouge_tokens, split_ws, strip_text, tokenize_13a
from tests import plain


def test_whitespace_set_matches_python(spark):
    rows = [(i, f"a{chr(i)}b") for i in range(1, 0x3001) if not 0xD800 <= i <= 0xDFFF]
    df = spark.createDataFrame(rows, "i int, s string")
    got = {r.i: r.n for r in df.select("i", F.size(split_ws("s")).alias("n")).collect()}
    for i, n in got.items():
        assert n == (2 if chr(i).isspace() else 1), hex(i)
    assert set(PY_WHITESPACE) == {chr(i) for i in range(0x3001) if chr(i).isspace()}


def test_strip_like_python(spark):
    samples = ["  a b  ", "\t\n x　", "\x1cq\x1f", "", "   ", " y ", "no-strip"]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = [r[0] for r in df.select(strip_text("s")).collect()]
    assert got == [s.strip() for s in samples]


def test_split_like_python(spark):
    samples = ["", " ", "a", " a  b\nc\r\nd ", "x　y\x0bz", " lead"]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = [list(r[0]) for r in df.select(split_ws("s")).collect()]
    assert got == [s.split() for s in samples]


def test_13a_tokens_match_plain_python(spark):
    rng = random.Random(7)
    alphabet = list("abcXYZ019 .,-'\"&;<>{}[]()!?:/\\@#$%^*+=|~`_\n") + ["&amp;", "&quot;", "&lt;", "<skipped>", "é", "ß"]
    samples = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    samples += ["Hello, world.", "3.14 and 2,000 items", "well-known 1-2 x", "end -\nline", "a&amp;lt;b", "  trailing  \n"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(samples)], "i int, s string")
    got = {r.i: list(r.t) for r in df.select("i", tokenize_13a("s").alias("t")).collect()}
    for i, s in enumerate(samples):
        assert got[i] == plain.tok13a(s), repr(s)


def test_rouge_tokens(spark):
    samples = ["Hello, World! 42x", "Ünïcode wörds split", "a\nb", "", "___"]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = [list(r[0]) for r in df.select(rouge_tokens("s")).collect()]
    assert got == [plain.rouge_tok(s) for s in samples]
