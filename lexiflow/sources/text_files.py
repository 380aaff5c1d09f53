"""Line-aligned parallel text files (SRC-1, with CHK-1 and JN-1).

The reference pairs line i of ``<prefix>.<src>`` with line i of
``<prefix>.<tgt>``.  Spark rows carry no position, so each file is numbered
separately by (file path, byte offset of the scanned block, order inside the
block): a folder or glob of part files counts through its files by name, however
Spark packs them into partitions.  Blank lines are kept, so the two sides stay
aligned; LF, CR and CRLF all end a line.

``write_lines`` writes such files from a table; line ends inside a text are escaped,
so that one row is one line.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lexiflow.functions.text import col_
from lexiflow.operators.ordering import sorted_index
from lexiflow.operators.prep import pair_aligned

#: Characters that are escaped within a line, and the letters that stand for them behind a backslash.
ESCAPES = (("\\", "b"), ("\n", "n"), ("\r", "r"))


def escape_line(text) -> Column:
    """One line for a text: backslash, LF and CR become a backslash and a letter; null becomes empty."""
    out = F.coalesce(col_(text), F.lit(""))
    for char, letter in ESCAPES:  # the backslash first
        out = F.replace(out, F.lit(char), F.lit("\\" + letter))
    return out


def unescape_line(line) -> Column:
    """The text of an escaped line."""
    out = col_(line)
    for char, letter in reversed(ESCAPES):  # the backslash last: until then none stands alone
        out = F.replace(out, F.lit("\\" + letter), F.lit(char))
    return out


def write_lines(df: DataFrame, col: str, order: Sequence[str | Column], path: str) -> None:
    """Write column ``col`` as escaped lines in ``order`` (part files in name order, one after the other)."""
    df.orderBy(*order).select(escape_line(col).alias("value")).write.mode("overwrite").text(path)


def read_lines(spark: SparkSession, path: str, col: str = "text", escaped: bool = False) -> DataFrame:
    """(line_no, text) of a text file, or of the files of a folder or glob by name;
    0-based line numbers.  ``escaped`` undoes the escapes of ``write_lines``."""
    raw = spark.read.text(path).select(
        (unescape_line("value") if escaped else F.col("value")).alias(col),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_mid"),  # ascends inside a block
    )
    return sorted_index(raw, [F.col("_file"), F.col("_block"), F.col("_mid")], name="line_no").select("line_no", col)


def read_parallel(
    spark: SparkSession, prefix: str, src: str, tgt: str, split: str, check: bool = True, escaped: bool = False, observation: Observation | None = None
) -> DataFrame:
    """SRC-1: (split, line_no, src, tgt) from ``{prefix}.{src}`` and ``{prefix}.{tgt}``.

    With ``check`` (default) the query fails when the two files do not have the same
    lines, in the join that pairs them (before any length filter, as in the reference).
    Without it, lines beyond the shorter file go; ``observation`` counts them."""
    s = read_lines(spark, f"{prefix}.{src}", "src", escaped).withColumn("split", F.lit(split))
    t = read_lines(spark, f"{prefix}.{tgt}", "tgt", escaped).withColumn("split", F.lit(split))
    return pair_aligned(s, t, observation=None if check else observation or Observation())
