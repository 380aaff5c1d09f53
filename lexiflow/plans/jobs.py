"""Composed jobs (UDF-2, JOB-1..3): the reference's dataset + loader + evaluation
passes as lazy DataFrame plans.

* ``prepare_corpus``       raw pairs -> padded, batched (and optionally sharded) rows, written as parquet
* ``infer_text``           texts -> encode -> mask -> generate -> decode (any number of rows)
* ``evaluate_translation`` losses + generation + decode + corpus BLEU -> one metric row
* ``evaluate_summaries``   losses + generation + decode + ROUGE -> one metric row per split
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiflow.operators import batching as bt
from lexiflow.operators import infer
from lexiflow.operators import losses as ls
from lexiflow.operators import overlap as ov
from lexiflow.operators import prep, subword
from lexiflow.sources import fixtures as fx
from lexiflow.session import materialize
from lexiflow.sources.tables import write_encoded
from lexiflow.sources.text_files import read_parallel


def stub_factory(vocab: DataFrame) -> Callable[[], infer.Model]:
    """Stand-in model factory over a vocabulary (its last id is one scalar)."""
    last_id = vocab.agg(F.max("id")).first()[0]
    return infer.stub_model(int(last_id))


def infer_text(
    df: DataFrame,
    text_col: str,
    vocab: DataFrame,
    make_model: Callable[[], infer.Model],
    key_cols: Sequence[str] = ("row_id",),
    carry: Sequence[str] = (),
    max_input: int | None = None,
    max_len: int = 256,
    start_id: int = fx.BOS_ID,
    strip: bool = False,
) -> DataFrame:
    """UDF-2: strip (translation) or truncate (summarisation) -> encode -> mask ->
    generate -> decode.  Returns key, carry, ``text``."""
    e = prep.encode(df, {text_col: "input_ids"}, vocab, key_cols=key_cols, carry=carry, strip=strip,
                    max_lens={"input_ids": max_input} if max_input is not None else None)
    if max_input is not None:
        e = prep.truncate_ids(e, "input_ids", max_input)
    e = prep.mask_from_length(e, "input_ids", "attention_mask")
    g = infer.generate_batches(e, make_model, "input_ids", "attention_mask", "generated_ids", max_len=max_len, start_id=start_id)
    return prep.decode(g, "generated_ids", vocab, key_cols=key_cols, out="text", carry=carry)


def _loss_means(scores: DataFrame, epsilon: float, ignore: int | None, rank_col: str | None = None) -> DataFrame:
    by = ["batch_id"] + ([rank_col] if rank_col else [])
    per_batch = ls.batch_loss_and_accuracy(scores, epsilon, by=by, ignore=ignore)
    return ls.mean_of_batches(per_batch, ["loss", "accuracy"], rank_col=rank_col)


def evaluate_translation(
    pairs: DataFrame,
    vocab: DataFrame,
    make_model: Callable[[], infer.Model],
    scores: DataFrame,
    max_src: int = 170,
    max_tgt: int = 170,
    epsilon: float = 0.1,
    ignore: int | None = fx.PAD_ID,
    start_id: int = fx.BOS_ID,
    rank_col: str | None = None,
) -> DataFrame:
    """JOB-1: one metric row — corpus BLEU (with statistics) of generated against
    decoded reference ids, and the epoch loss/accuracy means of the class scores.
    BLEU is global, not rank-local (decision Q6)."""
    limits = {"src_ids": max_src, "tgt_ids": max_tgt}
    e = prep.encode(pairs, {"src": "src_ids", "tgt": "tgt_ids"}, vocab, key_cols=["line_no"], carry=["split"], strip=True, drop_over=limits)
    kept = prep.filter_by_length(e, limits)
    kept = prep.mask_from_length(kept, "src_ids", "src_mask")
    g = infer.generate_batches(kept, make_model, "src_ids", "src_mask", "gen_ids", max_len=max_tgt, start_id=start_id)
    text = prep.decode_columns(g, {"gen_ids": "pred", "tgt_ids": "ref"}, vocab, key_cols=["split", "line_no"])
    bleu = ov.corpus_bleu(text, pred="pred", ref="ref", id_cols=["split", "line_no"])
    means = _loss_means(scores, epsilon, ignore, rank_col)
    return bleu.select(
        "*",
        F.round(means.select("loss").scalar(), 6).alias("vloss"),
        F.round(means.select("accuracy").scalar(), 6).alias("vaccuracy"),
    )


def evaluate_summaries(
    records: DataFrame,
    vocab: DataFrame,
    make_model: Callable[[], infer.Model],
    scores: DataFrame,
    max_in: int = 512,
    max_out: int = 256,
    batch_size: int = 4,
    epsilon: float = 0.0,
    ignore: int | None = fx.PAD_ID,
    start_id: int = fx.BOS_ID,
    kinds: Sequence[str] = ov.ROUGE_COLS,
) -> DataFrame:
    """JOB-2: per split — ROUGE-1/2/L/Lsum (``kinds``) as means of batch means
    (batches in the shuffled loader order), average ROUGE, and the epoch loss
    of the class scores.  References are the decoded truncated summaries."""
    e = prep.encode(records, {"document": "input_ids", "summary": "output_ids"}, vocab, key_cols=["row_id"], carry=["split"], max_lens={"input_ids": max_in, "output_ids": max_out})
    e = prep.truncate_ids(e, "input_ids", max_in)
    e = prep.truncate_ids(e, "output_ids", max_out)
    e = materialize(e, "encoded")  # SNK-1: encode once; the position passes read the files
    e = bt.assign_batches(bt.shuffle_rows(e, key="row_id", group_cols=["split"]), batch_size)
    e = prep.mask_from_pad(e, "input_ids", "attention_mask")
    g = infer.generate_batches(e, make_model, "input_ids", "attention_mask", "gen_ids", max_len=max_out, start_id=start_id)
    text = prep.decode_columns(g, {"gen_ids": "pred", "output_ids": "ref"}, vocab, key_cols=["row_id"], carry=["split", "batch_id"])
    kinds = list(kinds)
    per_pair = ov.rouge_pair_scores(text, pred="pred", ref="ref", id_cols=["row_id"], carry=["split", "batch_id"], kinds=kinds, dealt=True)
    epoch = ov.average_rouge(ov.rouge_epoch(per_pair, cols=kinds, by=["split"]), by=["split"])
    means = _loss_means(scores, epsilon, ignore)
    cols = [*kinds, "average_rouge"]
    return epoch.select("split", *[F.round(c, 6).alias(c) for c in cols], F.round(means.select("loss").scalar(), 6).alias("vloss"))


def prepare_translation(
    spark: SparkSession,
    prefixes: Mapping[str, str],
    src: str,
    tgt: str,
    vocab: DataFrame,
    escaped: bool = False,
    **options,
) -> DataFrame:
    """JOB-3 from the files on: ``prefixes`` {split: path prefix} names the line files of each split
    (``<prefix>.<src>`` and ``<prefix>.<tgt>``), whose lines must match (CHK-1, before any filter);
    then ``prepare_corpus`` with ``options``."""
    pairs = reduce(DataFrame.unionByName, [read_parallel(spark, p, src, tgt, split, escaped=escaped) for split, p in prefixes.items()])
    return prepare_corpus(pairs, vocab, key_cols=["split", "line_no"], **options)


def prepare_summaries(
    records: DataFrame,
    vocab: DataFrame,
    max_in: int = 512,
    max_out: int = 256,
    batch_size: int = 4,
    bos_id: int | None = fx.BOS_ID,
    eos_id: int = fx.EOS_ID,
    shuffle_splits: Sequence[str] | None = None,
    world: int | None = None,
    seed: int = fx.SEED,
    out_path: str | None = None,
) -> DataFrame:
    """JOB-3, summarisation: records (split, row_id, document, summary) -> encode both sides truncated to
    their limits (PRJ-3) -> a start pad in front of the target where the tokenizer has no begin id
    (PRJ-4, after truncation) -> shuffle (every split by default) -> (shards) -> batches -> ids padded
    with the pad id of the tokenizer's family, told from each batch's last input id (CHK-3)."""
    e = prep.encode(records, {"document": "input_ids", "summary": "output_ids"}, vocab, key_cols=["row_id"], carry=["split"],
                    prefix_ids=() if bos_id is None else (bos_id,), suffix_ids=(eos_id,), max_lens={"input_ids": max_in, "output_ids": max_out})
    if bos_id is None:
        e = e.withColumn("output_ids", F.concat(F.array(bt.pad_of_last(F.element_at("output_ids", -1))), "output_ids"))
    e = materialize(e, "encoded")  # SNK-1: encode once; the position passes read the files
    e = bt.shuffle_rows(e, key="row_id", seed=seed, group_cols=["split"], splits=list(shuffle_splits) if shuffle_splits is not None else None)
    batch_cols, pos = ["split", "batch_id"], "pos"
    if world:
        e, batch_cols, pos = bt.shard_rows(e, world), ["split", "rank", "batch_id"], "local_pos"
    e = bt.with_pad_id(bt.assign_batches(e, batch_size, pos_col=pos), "input_ids", batch_cols, pos)
    e = bt.pad_batch(e, {"input_ids": F.col("pad_id"), "output_ids": F.col("pad_id")}, batch_cols=batch_cols)
    if out_path is not None:
        write_encoded(e, out_path)
    return e


def prepare_corpus(
    pairs: DataFrame,
    vocab: DataFrame,
    max_src: int = 170,
    max_tgt: int = 170,
    batch_size: int = 8,
    shuffle_splits: Sequence[str] | None = ("train",),
    world: int | None = None,
    pad_id: int = fx.PAD_ID,
    seed: int = fx.SEED,
    out_path: str | None = None,
    key_cols: Sequence[str] = ("line_no",),
    specials: Mapping[str, tuple[Sequence[int], Sequence[int]]] | None = None,
    pieces: DataFrame | None = None,
) -> DataFrame:
    """JOB-3: pairs (split, line_no, src, tgt) -> strip -> encode -> length filter ->
    shuffle -> (shard over ``world`` ranks) -> batches -> ids padded with the pad
    id, masks with 0.  With ``out_path`` the result is also written (SNK-1).  ``specials``
    gives each side special ids of its own (``subword.side_ids``); with ``pieces`` the
    encoding is that of a piece table in place of ``vocab``."""
    limits, cols = {"src_ids": max_src, "tgt_ids": max_tgt}, {"src": "src_ids", "tgt": "tgt_ids"}
    if pieces is not None:
        e = subword.encode_pieces(pairs, cols, pieces, specials, drop_over=limits).select("line_no", "split", "src_ids", "tgt_ids")
    else:
        e = prep.encode(pairs, cols, vocab, key_cols=key_cols, carry=[c for c in ("line_no", "split") if c not in key_cols], strip=True, drop_over=limits, specials=specials)
    e = prep.filter_by_length(e, limits)
    e = materialize(e, "encoded")  # SNK-1: encode once; the position passes read the files
    e = bt.shuffle_rows(e, key="line_no", seed=seed, group_cols=["split"], splits=list(shuffle_splits) if shuffle_splits is not None else None)
    batch_cols = ["split", "batch_id"]
    if world:
        e = bt.shard_rows(e, world)
        e = bt.assign_batches(e, batch_size, pos_col="local_pos")
        batch_cols = ["split", "rank", "batch_id"]
    else:
        e = bt.assign_batches(e, batch_size)
    e = prep.mask_from_length(e, "src_ids", "src_mask")
    e = prep.mask_from_length(e, "tgt_ids", "tgt_mask")
    e = bt.pad_batch(e, {"src_ids": pad_id, "src_mask": 0, "tgt_ids": pad_id, "tgt_mask": 0}, batch_cols=batch_cols)
    if out_path is not None:
        write_encoded(e, out_path)
    return e
