"""Column-level text helpers: whitespace, stripping and tokenisers.

All helpers return ``pyspark.sql.Column`` expressions built from built-in
functions, so they run inside the JVM (whole-stage codegen where Spark has it).
The regular expressions are written so that Java's regex engine (Spark) and
RE2 (DuckDB, used as the oracle) read them the same way: character classes use
``\\x{..}`` escapes only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------
# Whitespace as Python's ``str.strip()`` / ``str.split()`` see it: every code
# point for which ``str.isspace()`` is true (derived by rule, not listed).
PY_WHITESPACE: str = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def _class(chars: str) -> str:
    return "[" + "".join("\\x{%X}" % ord(c) for c in chars) + "]"


WS_CLASS: str = _class(PY_WHITESPACE)
WS_RUN: str = WS_CLASS + "+"  # RE2 / DuckDB form
# Java form of the same set: Unicode White_Space (``(?U)\s``) plus the four
# information separators U+001C..U+001F that Python also counts as space.
# Java tests the property directly, ~3x faster than a 29-entry class.
WS_RUN_JAVA: str = r"(?U)[\s\x{1C}-\x{1F}]+"

# 13a tokeniser of the corpus-BLEU metric (Post 2018, "mteval-v13a").
# The four replacement rules in their order of application.
#   1. each of  { | } ~  [ \ ] ^ _ `  space ! " # $ % &  ( ) * +  : ; < = > ? @  /
#      is surrounded by spaces;
#   2. period or comma preceded by a non-digit is split off;
#   3. period or comma followed by a non-digit is split off;
#   4. dash preceded by a digit is split off.
BLEU_13A_RULES: list[tuple[str, str]] = [
    (r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", " $1 "),
    (r"([^0-9])([.,])", "$1 $2 "),
    (r"([.,])([^0-9])", " $1 $2"),
    (r"([0-9])(-)", "$1 $2 "),
]
# The pre-processing of a 13a line, in order.
BLEU_13A_REPLACE: list[tuple[str, str]] = [
    ("<skipped>", ""),
    ("-\n", ""),
    ("\n", " "),
    ("&quot;", '"'),
    ("&amp;", "&"),
    ("&lt;", "<"),
    ("&gt;", ">"),
]
# ROUGE tokens (Lin 2004 scorer defaults, no stemming): lower-case, then every
# maximal run of ASCII letters/digits is a token.
ROUGE_TOKEN = "[a-z0-9]+"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_text(c) -> Column:
    """Python ``str.strip()``: remove leading/trailing whitespace (Unicode-aware)."""
    return F.trim(col_(c), F.lit(PY_WHITESPACE))


def rstrip_text(c) -> Column:
    return F.rtrim(col_(c), F.lit(PY_WHITESPACE))


def split_ws(c) -> Column:
    """Python ``str.split()``: whitespace runs separate tokens, no empty tokens."""
    # array_remove is a native expression (a filter lambda would be interpreted per element)
    return F.array_remove(F.split(col_(c), WS_RUN_JAVA), "")


def tokenize_13a(c) -> Column:
    """array<string> of 13a tokens of a line (case kept)."""
    s = rstrip_text(c)
    for old, new in BLEU_13A_REPLACE:
        s = F.replace(s, F.lit(old), F.lit(new))
    s = F.concat(F.lit(" "), s, F.lit(" "))
    for pattern, repl in BLEU_13A_RULES:
        s = F.regexp_replace(s, pattern, repl)
    return split_ws(s)


def rouge_tokens(c) -> Column:
    """array<string> of ROUGE tokens (lower-cased ``[a-z0-9]+`` runs)."""
    return F.regexp_extract_all(F.lower(col_(c)), F.lit(ROUGE_TOKEN), 0)


def rouge_sentences(c) -> Column:
    """Newline-separated sentences of a text, empty strings removed (ROUGE-Lsum)."""
    return F.array_remove(F.split(col_(c), "\n"), "")
