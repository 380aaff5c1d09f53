"""Stand-in datasets built from the driver tables.

Each builder reads whole tables and derives its rows with DataFrame
operators, so its work grows with the data.  The SQL twins used by the
oracle live in ``lexiflow.plans.oracle``.

* ``records``       documents -> (split, row_id, document, summary)
* ``pairs``         conversations: user turn + following assistant turn
                    -> (split, line_no, src, tgt)
* ``doc_pairs``     consecutive documents (doc i predicts doc i+1)
                    -> (split, pair_id, pred, ref)
* ``vocab``         all whitespace tokens of the documents by frequency -> (token, id)
* ``scores``        embeddings as class scores -> (batch_id, example, pos, rank, scores, label)
* ``run_metrics``   events as a metric log -> (run, epoch, metric, value)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiflow.functions.lattice import SPACE
from lexiflow.functions.text import split_ws
from lexiflow.operators.ordering import row_index, sorted_index
from lexiflow.sources.tables import table

# Special ids of the stand-in vocabulary.
BOS_ID, PAD_ID, EOS_ID, UNK_ID = 0, 1, 2, 3
SPECIAL_IDS = (BOS_ID, PAD_ID, EOS_ID, UNK_ID)
FIRST_TOKEN_ID = 4
SCORE_BATCH = 8
SCORE_RANKS = 4
SEED = 1234
TURNS = 1 << 20  # line keys leave room for so many turns of a conversation; more are an error


def split_of(id_col) -> F.Column:
    """test for id % 10 = 0, validation for 1, train otherwise (assignment, not a filter)."""
    r = F.pmod(F.col(id_col), F.lit(10))
    return F.when(r == 0, F.lit("test")).when(r == 1, F.lit("validation")).otherwise(F.lit("train"))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the whole text of the next one as its summary (empty for the last)."""
    docs = table(spark, sf_dir, "documents")
    nxt = docs.select((F.col("doc_id") - 1).alias("doc_id"), F.col("text").alias("summary"))
    return docs.select("doc_id", "text").join(nxt, on="doc_id", how="left").select(
        split_of("doc_id").alias("split"),
        F.col("doc_id").alias("row_id"),
        F.col("text").alias("document"),
        F.coalesce("summary", F.lit("")).alias("summary"),
    )


def line_key(conv_id: str, turn: Column | str) -> Column:
    """The number of a conversation's turn among all lines: unique, in (conversation, turn) order."""
    turn = F.col(turn) if isinstance(turn, str) else turn
    fits = (turn >= 0) & (turn < TURNS)
    told = F.raise_error(F.concat(F.lit("no line key for turn "), turn.cast("string")))
    return F.col(conv_id) * F.lit(TURNS).cast("long") + F.when(fits, turn.cast("long")).otherwise(told)


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turn t joined to the assistant turn t+1 of the same conversation.

    Joining on (conv_id, turn) hashes both columns, so one very long
    conversation is still spread over many tasks.
    """
    conv = table(spark, sf_dir, "conversations")
    user = conv.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("src"))
    bot = conv.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("tgt")
    )
    joined = user.join(bot, on=["conv_id", "turn"], how="inner")
    return joined.select(
        split_of("conv_id").alias("split"),
        line_key("conv_id", "turn").alias("line_no"),
        "src",
        "tgt",
    )


def sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The two line tables that ``pairs`` pairs: every user turn (split, line_no, src), and every assistant
    turn (split, line_no, tgt) under the number of the turn before it.  Turns without a partner are in them."""
    conv = table(spark, sf_dir, "conversations")
    user, bot = conv.where(F.col("role") == "user"), conv.where((F.col("role") == "assistant") & (F.col("turn") > 0))
    src = user.select(split_of("conv_id").alias("split"), line_key("conv_id", "turn").alias("line_no"), F.col("text").alias("src"))
    tgt = bot.select(split_of("conv_id").alias("split"), line_key("conv_id", F.col("turn") - 1).alias("line_no"), F.col("text").alias("tgt"))
    return src, tgt


def pieces(spark: SparkSession, sf_dir: str, longest: int = 4) -> DataFrame:
    """Stand-in piece table (piece, id, score): every substring of up to ``longest`` characters of the benchmark's
    words (behind the space mark) that doesn't span it, most frequent first; the score is a whole number of
    thousandths of the log share.  Real tables are a tokenizer's published vocabulary."""
    words = table(spark, sf_dir, "benchmark").select(F.explode(split_ws("text")).alias("w")).select(F.concat(F.lit(SPACE), "w").alias("w"))
    starts = words.select("w", F.explode(F.sequence(F.lit(1), F.length("w"))).alias("i"))
    parts = starts.select("w", "i", F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), F.length("w") - F.col("i") + 1))).alias("k"))
    counts = parts.groupBy(F.substr("w", "i", "k").alias("piece")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    ranked = sorted_index(counts.withColumn("total", total), [F.col("n").desc(), F.col("piece").asc()], name="pos")
    score = F.floor(F.log(F.col("n") / F.col("total")) * 1000).cast("double")
    return ranked.select("piece", (F.col("pos") + F.lit(FIRST_TOKEN_ID)).cast("int").alias("id"), score.alias("score"))


def doc_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole document i as the prediction for whole document i+1."""
    docs = table(spark, sf_dir, "documents")
    a = docs.select(F.col("doc_id").alias("pair_id"), F.col("text").alias("pred"))
    b = docs.select((F.col("doc_id") - 1).alias("pair_id"), F.col("text").alias("ref"))
    return a.join(b, on="pair_id", how="inner").select(split_of("pair_id").alias("split"), "pair_id", "pred", "ref")


def vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whitespace token of the documents (count desc, token asc in binary
    order) with ids from FIRST_TOKEN_ID on.  The count is a map-side combined
    aggregate; the ids are positions of a range-partitioned sort, written once to
    the shared checkpoint folder, so a job that encodes, generates and decodes
    reads them instead of counting the documents again."""
    docs = table(spark, sf_dir, "documents")
    counts = docs.select(F.explode(split_ws("text")).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    ranked = sorted_index(counts, [F.col("n").desc(), F.col("token").asc()], name="pos")
    return ranked.select("token", (F.col("pos") + F.lit(FIRST_TOKEN_ID)).cast("int").alias("id"))


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = table(spark, sf_dir, "embeddings")
    batch = F.floor(F.col("vec_id") / SCORE_BATCH).cast("long")
    return emb.select(
        batch.alias("batch_id"),
        F.col("vec_id").alias("example"),
        F.pmod(F.col("vec_id"), F.lit(SCORE_BATCH)).cast("int").alias("pos"),
        F.pmod(batch, F.lit(SCORE_RANKS)).cast("int").alias("rank"),
        F.transform("embedding", lambda x: x.cast("double")).alias("scores"),
        F.col("label").cast("int").alias("label"),
    )


def run_metrics(spark: SparkSession, sf_dir: str, examples: bool = False) -> DataFrame:
    """(run, epoch, metric, value), with ``examples`` also props: run = user_id, metric = event_type, epoch = 0-based order of event_id
    inside (run, metric) — positions from the skew-safe ``row_index``."""
    ev = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run"), F.col("event_type").alias("metric"), "event_id", "value", "props"
    )
    out = row_index(ev, ["event_id"], group_cols=["run", "metric"], name="epoch")
    return out.select("run", F.col("epoch").cast("int").alias("epoch"), "metric", "value", *(["props"] if examples else []))
