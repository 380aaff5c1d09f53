"""Query catalogue: one Spark builder and (where SQL can say it) one DuckDB twin per query.

Every builder takes ``(spark, sf_dir)``, reads the whole driver tables and
returns a DataFrame; arrays are emitted as space-joined strings and metrics
rounded to 6 decimals so both engines print the same values.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lexiflow.functions.lattice import SPACE
from lexiflow.operators import batching as bt
from lexiflow.operators import losses as ls
from lexiflow.operators import overlap as ov
from lexiflow.operators import permutation as pm
from lexiflow.operators import prep, subword
from lexiflow.operators import runs as rn
from lexiflow.operators.ordering import row_index
from lexiflow.plans import jobs
from lexiflow.plans import oracle as o
from lexiflow.session import ensure_checkpoint_dir, materialize
from lexiflow.sources import fixtures as fx
from lexiflow.sources.tables import keep_encoded, read_records, read_split, write_encoded
from lexiflow.sources.text_files import read_parallel, write_lines

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def ids_str(c) -> Column:
    return F.array_join((F.col(c) if isinstance(c, str) else c).cast("array<string>"), " ")


def r6(c) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def n_(c) -> Column:
    return F.size(c).cast("long")


#: Language codes of the two sides, one code mode each
PIECE_SIDES = {"src_ids": subword.side_ids("suffix_code", 250004), "tgt_ids": subword.side_ids("prefix_code", 250005)}

# Run configurations (fixed values of the two reference runs)
SUM_MAX_IN, SUM_MAX_OUT, SUM_BATCH = 512, 256, 4       # summarisation
TR_MAX_SRC, TR_MAX_TGT, TR_BATCH = 170, 170, 8        # translation
SMOOTHING = 0.1
WORLD = 4


# =============================================================================
# Spark-side building blocks
# =============================================================================

def encoded_records(spark, sf_dir, truncate: bool = True, vocab: DataFrame | None = None, materialized: bool = False) -> DataFrame:
    """records -> (row_id, split, input_ids, output_ids).  ``materialized`` writes
    the encoded table once (SNK-1) before position passes read it several times."""
    r = fx.records(spark, sf_dir)
    v = vocab if vocab is not None else fx.vocab(spark, sf_dir)
    limits = {"input_ids": SUM_MAX_IN, "output_ids": SUM_MAX_OUT} if truncate else None
    e = prep.encode(r, {"document": "input_ids", "summary": "output_ids"}, v, key_cols=["row_id"], carry=["split"], max_lens=limits)
    if truncate:  # PRJ-3 (already applied inside encode; idempotent here)
        e = prep.truncate_ids(e, "input_ids", SUM_MAX_IN)
        e = prep.truncate_ids(e, "output_ids", SUM_MAX_OUT)
    return materialize(e, "encoded") if materialized else e


def summarisation_batches(spark, sf_dir) -> DataFrame:
    e = encoded_records(spark, sf_dir, materialized=True)
    e = bt.shuffle_rows(e, key="row_id", group_cols=["split"])
    e = bt.assign_batches(e, SUM_BATCH)
    e = prep.mask_from_length(e, "input_ids", "input_mask")
    return bt.pad_batch(e, {"input_ids": fx.PAD_ID, "output_ids": fx.PAD_ID, "input_mask": 0})


def encoded_pairs(spark, sf_dir) -> DataFrame:
    p = fx.pairs(spark, sf_dir)
    v = fx.vocab(spark, sf_dir)
    return prep.encode(p, {"src": "src_ids", "tgt": "tgt_ids"}, v, key_cols=["line_no"], carry=["split"], strip=True,
                       drop_over={"src_ids": TR_MAX_SRC, "tgt_ids": TR_MAX_TGT})


def pair_rank_order(spark, sf_dir) -> DataFrame:
    """Pairs in line order with a batch of 4 (evaluation order, no shuffle)."""
    p = fx.pairs(spark, sf_dir)
    p = row_index(p, ["line_no"], group_cols=[], name="pos")
    return bt.assign_batches(p, SUM_BATCH)


# =============================================================================
# SQL-side building blocks
# =============================================================================

ENC_RECORDS = o.encode_sql(o.RECORDS, "row_id", ["split"], {"document": "input_ids", "summary": "output_ids"})
ENC_RECORDS_T = f"""SELECT row_id, split, {o.truncate_sql('input_ids', SUM_MAX_IN)} AS input_ids,
       {o.truncate_sql('output_ids', SUM_MAX_OUT)} AS output_ids FROM {ENC_RECORDS}"""
SHUFFLED = f"""SELECT *, row_number() OVER (PARTITION BY split ORDER BY md5('{fx.SEED}:' || CAST(row_id AS VARCHAR)), row_id) - 1 AS pos
FROM ({ENC_RECORDS_T})"""
BATCHED = f"""SELECT *, pos // {SUM_BATCH} AS batch_id, list_transform(input_ids, lambda x: 1) AS input_mask FROM ({SHUFFLED})"""
PADDED = f"""SELECT split, row_id, pos, batch_id,
  list_resize(input_ids, max(len(input_ids)) OVER (PARTITION BY split, batch_id), {fx.PAD_ID}) AS input_ids,
  list_resize(output_ids, max(len(output_ids)) OVER (PARTITION BY split, batch_id), {fx.PAD_ID}) AS output_ids,
  list_resize(input_mask, max(len(input_mask)) OVER (PARTITION BY split, batch_id), 0) AS input_mask
FROM ({BATCHED})"""
ENC_PAIRS = o.encode_sql(o.PAIRS, "line_no", ["split"], {"src": "src_ids", "tgt": "tgt_ids"}, strip_text=True)


# =============================================================================
# Sources, projections, filters (SRC-2/3, AGG-1/2, PRJ-1..8, FLT-1, JN-1)
# =============================================================================

@register("read_split_counts", f"""
SELECT split, n_rows, round(CAST(n_rows AS DOUBLE) * 1.0 / 1.0 / 1.0 / {SUM_BATCH}.0, 6) AS run_steps FROM (
  SELECT split, count(*) AS n_rows FROM ({o.RECORDS}) GROUP BY split
  UNION ALL
  SELECT 'train+validation' AS split, count(*) FILTER (WHERE split IN ('train', 'validation')) AS n_rows FROM ({o.RECORDS}))""")
def q_read_split_counts(spark, sf_dir):
    """AGG-1/2: rows per split, and the train+validation size that sizes the run
    (SRC-2/3 reading and split pruning are checked in pytest)."""
    r = fx.records(spark, sf_dir)
    per = prep.dataset_size(r)
    both = prep.dataset_size(r, splits=["train", "validation"]).select(F.lit("train+validation").alias("split"), "n_rows")
    out = per.unionByName(both)
    return out.select("split", "n_rows", r6(prep.run_steps_expr("n_rows", 1, 1, 1, SUM_BATCH)).alias("run_steps"))


_PAD_WS = "\t \n　\x1c"


@register("strip_text", f"""
SELECT row_id, CAST(length(s) AS BIGINT) AS n_chars, md5(s) AS text_md5, CAST(s = document AS BOOLEAN) AS unchanged
FROM (SELECT row_id, document, {o.strip(f"({o.q(_PAD_WS)} || document || {o.q(_PAD_WS[::-1])})")} AS s FROM ({o.RECORDS}))""")
def q_strip_text(spark, sf_dir):
    """PRJ-1: documents wrapped in Unicode whitespace, then stripped."""
    r = fx.records(spark, sf_dir)
    w = r.select("row_id", "document", F.concat(F.lit(_PAD_WS), "document", F.lit(_PAD_WS[::-1])).alias("padded"))
    s = prep.strip_text(w, ["padded"])
    return s.select("row_id", F.length("padded").cast("long").alias("n_chars"), F.md5("padded").alias("text_md5"),
                    (F.col("padded") == F.col("document")).alias("unchanged"))


@register("pair_sides", f"""
SELECT u.split, u.line_no, u.src, a.tgt FROM ({o.SRC_SIDE}) u JOIN ({o.TGT_SIDE}) a ON a.split = u.split AND a.line_no = u.line_no""")
def q_pair_sides(spark, sf_dir):
    """JN-1: source lines and target lines keyed by (split, line_no), paired by an equi join
    (lines without a partner are counted in ``alignment_report``)."""
    return prep.pair_sides(*fx.sides(spark, sf_dir))


@register("alignment_report", f"""
SELECT split, CAST(sum(s) AS BIGINT) AS n_src, CAST(sum(t) AS BIGINT) AS n_tgt, CAST(sum(greatest(s - t, 0)) AS BIGINT) AS only_src,
       CAST(sum(greatest(t - s, 0)) AS BIGINT) AS only_tgt, min(CASE WHEN s <> t THEN line_no END) AS first_bad
FROM (SELECT split, line_no, count(src) AS s, count(tgt) AS t FROM (
        SELECT split, line_no, 1 AS src, NULL AS tgt FROM ({o.SRC_SIDE}) UNION ALL SELECT split, line_no, NULL, 1 FROM ({o.TGT_SIDE}))
      GROUP BY ALL) GROUP BY split""")
def q_alignment_report(spark, sf_dir):
    """CHK-1: per split, lines of either side and those without a partner (user turns without an answer)."""
    return prep.alignment_report(*fx.sides(spark, sf_dir))


@register("pair_aligned", f"""
SELECT u.split, u.line_no, md5(u.src) AS src_md5, md5(a.tgt) AS tgt_md5,
       (SELECT count(*) FROM ({o.SRC_SIDE})) AS n_src, (SELECT count(*) FROM ({o.TGT_SIDE})) AS n_tgt
FROM ({o.SRC_SIDE}) u JOIN ({o.TGT_SIDE}) a ON a.split = u.split AND a.line_no = u.line_no""")
def q_pair_aligned(spark, sf_dir):
    """JN-1 + CHK-1 in one pass: the pairs are written, and what ``observe`` counted in that pass stands beside them."""
    seen = Observation()
    pairs = prep.pair_aligned(*fx.sides(spark, sf_dir), observation=seen)
    kept = materialize(pairs.select("split", "line_no", F.md5("src").alias("src_md5"), F.md5("tgt").alias("tgt_md5")), "aligned")
    return kept.withColumns({c: F.lit(seen.get[c]).cast("long") for c in ("n_src", "n_tgt")})


@register("width_report", f"""
SELECT batch_id, count(*) AS n_rows, count(*) FILTER (WHERE len(scores) <> 32) AS n_wrong,
       CAST(min(len(scores)) AS INTEGER) AS least_width, CAST(max(len(scores)) AS INTEGER) AS greatest_width FROM ({o.SCORES}) GROUP BY batch_id""")
def q_width_report(spark, sf_dir):
    """CHK-2: per batch, score rows that are not as wide as a vocabulary of 32."""
    return ls.width_report(fx.scores(spark, sf_dir), 32)


def _folder(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/lexiflow-{name}-{uuid.uuid4().hex}"


@register("line_files", f"SELECT row_number() OVER (ORDER BY line_no) - 1 AS line_no, src, tgt FROM ({o.PAIRS})")
def q_line_files(spark, sf_dir):
    """SRC-1: pairs written as two line files (line ends escaped) and read back by position."""
    p, folder = fx.pairs(spark, sf_dir), _folder(spark, "lines")
    for side in ("src", "tgt"):
        write_lines(p, side, ["line_no"], f"{folder}/all.{side}")
    return read_parallel(spark, f"{folder}/all", "src", "tgt", "all", escaped=True).select("line_no", "src", "tgt")


@register("kept_records", f"SELECT split, row_id, md5(document) AS document_md5, md5(summary) AS summary_md5 FROM ({o.RECORDS})")
def q_kept_records(spark, sf_dir):
    """SRC-2: records written by split and read back with their schema."""
    folder = _folder(spark, "records")
    write_encoded(fx.records(spark, sf_dir), folder)
    return read_records(spark, folder).select("split", "row_id", F.md5("document").alias("document_md5"), F.md5("summary").alias("summary_md5"))


@register("test_split", f"SELECT row_id, CAST(length(document) AS BIGINT) AS n_chars FROM ({o.RECORDS}) WHERE split = 'test'")
def q_test_split(spark, sf_dir):
    """SRC-3: one split of the written records; only its files are read."""
    folder = _folder(spark, "records")
    write_encoded(fx.records(spark, sf_dir), folder)
    return read_split(read_records(spark, folder), "test").select("row_id", F.length("document").cast("long").alias("n_chars"))


@register("kept_encoded", f"SELECT row_id, split, {o.ids_str('input_ids')} AS input_ids, TRUE AS reused FROM ({ENC_RECORDS_T})")
def q_kept_encoded(spark, sf_dir):
    """SNK-1: the encoded set is kept under the fingerprint of its inputs; asked for again, it is read and not converted."""
    vocab, folder = fx.vocab(spark, sf_dir), _folder(spark, "kept")

    def ask():
        return keep_encoded(spark, folder, lambda: encoded_records(spark, sf_dir, vocab=vocab), [f"{sf_dir}/documents.parquet"], [vocab], {"max_in": SUM_MAX_IN, "max_out": SUM_MAX_OUT})

    ask()
    kept, found = ask()
    return kept.select("row_id", "split", ids_str("input_ids").alias("input_ids"), F.lit(found).alias("reused"))


@register("encode_pieces", f"""
SELECT p.split, p.line_no, {o.ids_str(f"list_concat(s.ids, [{fx.EOS_ID}, 250004]::INTEGER[])")} AS src_ids,
       {o.ids_str(f"list_concat([250005]::INTEGER[], t.ids, [{fx.EOS_ID}]::INTEGER[])")} AS tgt_ids
FROM ({o.PAIRS}) p JOIN {o.piece_lists(o.PAIRS, 'line_no', 'src')} s ON s.line_no = p.line_no
  JOIN {o.piece_lists(o.PAIRS, 'line_no', 'tgt')} t ON t.line_no = p.line_no""")
def q_encode_pieces(spark, sf_dir):
    """PRJ-2 with subword pieces: best paths over a scored piece table, the source with its language code behind
    the end id, the target with its code in front."""
    e = subword.encode_pieces(fx.pairs(spark, sf_dir), {"src": "src_ids", "tgt": "tgt_ids"}, fx.pieces(spark, sf_dir), PIECE_SIDES)
    return e.select("split", "line_no", ids_str("src_ids").alias("src_ids"), ids_str("tgt_ids").alias("tgt_ids"))


@register("decode_pieces", f"""
SELECT s.line_no, trim(replace(coalesce(string_agg(pc.piece, '' ORDER BY s.at), ''), {o.q(SPACE)}, ' '), {o.WS}) AS text
FROM (SELECT line_no, unnest(CASE WHEN len(ids) = 0 THEN [NULL] ELSE ids END) AS id, unnest(generate_series(1, greatest(len(ids), 1))) AS at
      FROM {o.piece_lists(o.PAIRS, 'line_no', 'tgt')}) s
LEFT JOIN ({o.PIECES}) pc ON pc.id = s.id GROUP BY s.line_no""")
def q_decode_pieces(spark, sf_dir):
    """PRJ-8 with subword pieces: encoded targets back to text, special, code and unknown ids skipped."""
    pieces = fx.pieces(spark, sf_dir)
    e = subword.encode_pieces(fx.pairs(spark, sf_dir), {"tgt": "tgt_ids"}, pieces, PIECE_SIDES)
    return subword.decode_pieces(e, {"tgt_ids": "text"}, pieces, key_cols=["line_no"], specials=[*fx.SPECIAL_IDS, 250004, 250005])


@register("encode_ids", f"""
SELECT row_id, split, len(input_ids) AS n_input, {o.ids_str('input_ids')} AS input_ids,
       len(output_ids) AS n_output, {o.ids_str('output_ids')} AS output_ids FROM {ENC_RECORDS}""")
def q_encode_ids(spark, sf_dir):
    """PRJ-2 + JN-3: whole documents and summaries to id arrays (begin/end ids, unknown id)."""
    e = encoded_records(spark, sf_dir, truncate=False)
    return e.select("row_id", "split", n_("input_ids").alias("n_input"), ids_str("input_ids").alias("input_ids"),
                    n_("output_ids").alias("n_output"), ids_str("output_ids").alias("output_ids"))


@register("truncate_ids", f"""
SELECT row_id, split, len(input_ids) AS n_input, {o.ids_str('input_ids')} AS input_ids,
       len(output_ids) AS n_output, {o.ids_str('output_ids')} AS output_ids FROM ({ENC_RECORDS_T})""")
def q_truncate_ids(spark, sf_dir):
    """PRJ-3: encoding with truncation to 512 / 256 ids (special ids included)."""
    e = encoded_records(spark, sf_dir, truncate=True)
    return e.select("row_id", "split", n_("input_ids").alias("n_input"), ids_str("input_ids").alias("input_ids"),
                    n_("output_ids").alias("n_output"), ids_str("output_ids").alias("output_ids"))


_ENC_NO_BOS = o.encode_sql(o.RECORDS, "row_id", ["split"], {"summary": "output_ids"}, prefix=())


@register("prepend_start", f"""
SELECT row_id, split, len(ids) AS n_output, {o.ids_str('ids')} AS output_ids FROM (
  SELECT row_id, split, list_concat([{fx.PAD_ID}]::INTEGER[], {o.truncate_sql('output_ids', SUM_MAX_OUT, 0, 1)}) AS ids FROM {_ENC_NO_BOS})""")
def q_prepend_start(spark, sf_dir):
    """PRJ-4: a tokenizer without a begin id: truncate, then put the pad id in front (length may be max + 1)."""
    r = fx.records(spark, sf_dir)
    v = fx.vocab(spark, sf_dir)
    e = prep.encode(r, {"summary": "output_ids"}, v, key_cols=["row_id"], carry=["split"], prefix_ids=(),
                    max_lens={"output_ids": SUM_MAX_OUT})
    e = prep.truncate_ids(e, "output_ids", SUM_MAX_OUT, n_prefix=0, n_suffix=1)
    e = prep.prepend_start(e, "output_ids", bos_id=None, pad_id=fx.PAD_ID)
    return e.select("row_id", "split", n_("output_ids").alias("n_output"), ids_str("output_ids").alias("output_ids"))


@register("length_filter", f"""
SELECT split, line_no, len(src_ids) AS n_src, len(tgt_ids) AS n_tgt FROM {ENC_PAIRS}
WHERE len(src_ids) <= {TR_MAX_SRC} AND len(tgt_ids) <= {TR_MAX_TGT}""")
def q_length_filter(spark, sf_dir):
    """FLT-1: keep a pair only if both encoded sides are within 170 ids (inclusive)."""
    e = encoded_pairs(spark, sf_dir)
    e = prep.filter_by_length(e, {"src_ids": TR_MAX_SRC, "tgt_ids": TR_MAX_TGT})
    return e.select("split", "line_no", n_("src_ids").alias("n_src"), n_("tgt_ids").alias("n_tgt"))


@register("masks", f"""
SELECT split, row_id, {o.ids_str('input_mask')} AS input_mask,
  {o.ids_str(f"list_transform(input_ids, lambda x: CASE WHEN x <> {fx.PAD_ID} THEN 1 ELSE 0 END)")} AS input_pad_mask,
  {o.ids_str(f"list_transform(output_ids[1:len(output_ids) - 1], lambda x: CASE WHEN x <> {fx.PAD_ID} THEN 'true' ELSE 'false' END)")} AS decoder_mask
FROM ({PADDED})""")
def q_masks(spark, sf_dir):
    """PRJ-5/6: mask from length (padded with 0), mask from the pad id (int), decoder mask (boolean)."""
    b = summarisation_batches(spark, sf_dir)
    b = prep.mask_from_pad(b, "input_ids", "input_pad_mask")
    b = prep.shift_targets(b, "output_ids")
    b = prep.mask_from_pad(b, "decoder_ids", "decoder_mask", as_bool=True)
    return b.select("split", "row_id", ids_str("input_mask").alias("input_mask"), ids_str("input_pad_mask").alias("input_pad_mask"),
                    ids_str("decoder_mask").alias("decoder_mask"))


@register("shift_targets", f"""
SELECT split, row_id, {o.ids_str('output_ids[1:len(output_ids) - 1]')} AS decoder_ids,
       {o.ids_str('output_ids[2:len(output_ids)]')} AS labels FROM ({PADDED})""")
def q_shift_targets(spark, sf_dir):
    """PRJ-7: decoder input and labels from the padded target rows."""
    b = prep.shift_targets(summarisation_batches(spark, sf_dir), "output_ids")
    return b.select("split", "row_id", ids_str("decoder_ids").alias("decoder_ids"), ids_str("labels").alias("labels"))


@register("decode_text", f"""
SELECT row_id, split, text FROM {o.decode_sql(ENC_RECORDS, 'row_id', 'output_ids', 'text', ('split',))}""")
def q_decode_text(spark, sf_dir):
    """PRJ-8 + FLT-3: encoded summaries back to text, special and unknown ids skipped."""
    v = fx.vocab(spark, sf_dir)
    e = encoded_records(spark, sf_dir, truncate=False, vocab=v)
    return prep.decode(e, "output_ids", v, key_cols=["row_id"], out="text", carry=["split"])


# =============================================================================
# Ordering, batching (WIN-1..4, SET-2, CHK-3, AGG-14, TOP-2)
# =============================================================================

@register("shuffle_order", f"SELECT split, row_id, pos FROM ({SHUFFLED})")
def q_shuffle_order(spark, sf_dir):
    """WIN-3: seeded shuffle of every split (md5 order), as positions inside the split."""
    r = fx.records(spark, sf_dir)
    return bt.shuffle_rows(r, key="row_id", group_cols=["split"]).select("split", "row_id", "pos")


_PAIR_POS = f"""SELECT split, line_no, row_number() OVER (PARTITION BY split ORDER BY
    CASE WHEN split = 'train' THEN md5('{fx.SEED}:' || CAST(line_no AS VARCHAR)) END NULLS FIRST, line_no) - 1 AS pos
FROM ({o.PAIRS})"""


@register("batches", f"SELECT split, line_no, pos, pos // {TR_BATCH} AS batch_id FROM ({_PAIR_POS})")
def q_batches(spark, sf_dir):
    """WIN-1: translation loader order — train shuffled, other splits in line order — in batches of 8."""
    p = fx.pairs(spark, sf_dir)
    p = bt.shuffle_rows(p, key="line_no", group_cols=["split"], splits=["train"])
    return bt.assign_batches(p, TR_BATCH).select("split", "line_no", "pos", "batch_id")


@register("rank_shards", f"""
SELECT split, line_no, copy, CAST((pos + copy * n) % {WORLD} AS INTEGER) AS rank, (pos + copy * n) // {WORLD} AS local_pos
FROM (SELECT *, unnest(generate_series(0, (CAST(ceil(n / {WORLD}.0) AS BIGINT) * {WORLD} - 1 - pos) // n)) AS copy
      FROM (SELECT *, count(*) OVER (PARTITION BY split) AS n FROM ({_PAIR_POS})))""")
def q_rank_shards(spark, sf_dir):
    """WIN-4 + SET-2: distributed-sampler shards over 4 ranks, head rows repeated to even out."""
    p = fx.pairs(spark, sf_dir)
    p = bt.shuffle_rows(p, key="line_no", group_cols=["split"], splits=["train"])
    s = bt.shard_rows(p, WORLD)
    return s.select("split", "line_no", "copy", "rank", "local_pos")


_EPOCHS = (0, 1)


def _draw_sql(turn: int, value: str) -> str:
    return f"CAST('0x' || substr(md5('{fx.SEED}:' || epoch || ':{turn}:' || {value}), 1, 15) AS BIGINT)"


def _network_sql(rel: str) -> str:
    """One step of the keyed permutation on x, over (split, epoch, p, n, a, b, x)."""
    x0 = f"SELECT split, epoch, p, n, a, b, x // b AS l, x % b AS r FROM ({rel})"
    x1 = f"SELECT * REPLACE ((r + {_draw_sql(0, 'l')} % b) % b AS r) FROM ({x0})"
    x2 = f"SELECT * REPLACE ((l + {_draw_sql(1, 'r')} % a) % a AS l) FROM ({x1})"
    x3 = f"SELECT * REPLACE ((r + {_draw_sql(2, 'l')} % b) % b AS r) FROM ({x2})"
    x4 = f"SELECT * REPLACE ((l + {_draw_sql(3, 'r')} % a) % a AS l) FROM ({x3})"
    return f"SELECT split, epoch, p, n, a, b, l * b + r AS x FROM ({x4})"


_ROW_NO = f"SELECT split, line_no, row_number() OVER (PARTITION BY split ORDER BY line_no) - 1 AS row_no FROM ({o.PAIRS})"


@register("epoch_shards", f"""
WITH RECURSIVE rn AS ({_ROW_NO}), sz AS (SELECT split, count(*) AS n FROM rn GROUP BY split),
ab AS (SELECT split, n, CAST(ceil(sqrt(n::DOUBLE)) AS BIGINT) AS a FROM sz),
ps AS (SELECT rn.split, epoch, rn.row_no AS p, n, a, (n + a - 1) // a AS b, rn.row_no AS x
       FROM rn JOIN ab ON ab.split = rn.split, (SELECT unnest({list(_EPOCHS)}) AS epoch)),
walk AS ({_network_sql('SELECT * FROM ps')} UNION ALL {_network_sql('SELECT * FROM walk WHERE x >= n')}),
ord AS (SELECT split, epoch, n, p AS pos, CASE WHEN split = 'train' THEN x ELSE p END AS row_no FROM walk WHERE x < n),
cp AS (SELECT *, unnest(generate_series(0, (CAST(ceil(n / {WORLD}.0) AS BIGINT) * {WORLD} - 1 - pos) // n)) AS copy FROM ord)
SELECT CAST(epoch AS INTEGER) AS epoch, cp.split, rn.line_no, copy, CAST((pos + copy * n) % {WORLD} AS INTEGER) AS rank, (pos + copy * n) // {WORLD} AS local_pos
FROM cp JOIN rn ON rn.split = cp.split AND rn.row_no = cp.row_no""")
def q_epoch_shards(spark, sf_dir):
    """WIN-3/4 + SET-2 without a sort per epoch: keyed permutations of numbered rows, two epochs over 4 ranks (train shuffled)."""
    rows = materialize(pm.number_rows(fx.pairs(spark, sf_dir).select("split", "line_no"), ["line_no"]), "numbered")
    sizes = rows.groupBy("split").agg(F.count(F.lit(1)).alias("n"))
    every = rows.withColumn("epoch", F.explode(F.array(*map(F.lit, _EPOCHS))))
    s = pm.epoch_shards(every, F.col("epoch"), WORLD, sizes=sizes, shuffled=F.col("split") == "train")
    return s.select("epoch", "split", "line_no", "copy", "rank", "local_pos")


@register("padded_batches", f"""
SELECT split, row_id, batch_id, {o.ids_str('input_ids')} AS input_ids, {o.ids_str('output_ids')} AS output_ids,
       {o.ids_str('input_mask')} AS input_mask FROM ({PADDED})""")
def q_padded_batches(spark, sf_dir):
    """WIN-2: ids padded with the pad id and masks with 0 to the longest row of each batch."""
    b = summarisation_batches(spark, sf_dir)
    return b.select("split", "row_id", "batch_id", ids_str("input_ids").alias("input_ids"),
                    ids_str("output_ids").alias("output_ids"), ids_str("input_mask").alias("input_mask"))


@register("pad_id_inferred", f"""
SELECT split, batch_id, CAST(CASE WHEN last_id = 2 THEN 1 WHEN last_id = 1 THEN 0 END AS INTEGER) AS pad_id
FROM (SELECT split, batch_id, arg_min(input_ids[len(input_ids)], pos) AS last_id FROM ({BATCHED}) GROUP BY split, batch_id)""")
def q_pad_id_inferred(spark, sf_dir):
    """CHK-3: pad id guessed from the last id of each batch's first row (before padding)."""
    e = encoded_records(spark, sf_dir).select("row_id", "split", F.slice("input_ids", -1, 1).alias("input_ids"))  # what the guess looks at
    e = materialize(e, "encoded")
    e = bt.assign_batches(bt.shuffle_rows(e, key="row_id", group_cols=["split"]), SUM_BATCH)
    return bt.infer_pad_id(e, "input_ids")


@register("batch_volume", f"""
SELECT split, batch_id, count(*) AS n_rows,
  count(*) * max(len(input_ids)) AS input_ids_volume,
  round(1.0 - sum(len(input_ids)) / (count(*) * max(len(input_ids)))::DOUBLE, 6) AS input_ids_pad_share,
  count(*) * max(len(output_ids)) AS output_ids_volume,
  round(1.0 - sum(len(output_ids)) / (count(*) * max(len(output_ids)))::DOUBLE, 6) AS output_ids_pad_share
FROM ({BATCHED}) GROUP BY split, batch_id""")
def q_batch_volume(spark, sf_dir):
    """AGG-14: padded elements per batch and column, and the padding share."""
    e = encoded_records(spark, sf_dir).select("row_id", "split", *[F.size(c).alias(c) for c in ("input_ids", "output_ids")])  # lengths are enough
    e = materialize(e, "encoded")
    e = bt.assign_batches(bt.shuffle_rows(e, key="row_id", group_cols=["split"]), SUM_BATCH)
    v = bt.batch_volume(e, ["input_ids", "output_ids"])
    return v.select("split", "batch_id", "n_rows", "input_ids_volume", r6("input_ids_pad_share").alias("input_ids_pad_share"),
                    "output_ids_volume", r6("output_ids_pad_share").alias("output_ids_pad_share"))


@register("first_batches", f"SELECT split, row_id, batch_id FROM ({BATCHED}) WHERE batch_id < 2")
def q_first_batches(spark, sf_dir):
    """TOP-2: the two sanity-check batches of each split."""
    e = bt.assign_batches(bt.shuffle_rows(fx.records(spark, sf_dir), key="row_id", group_cols=["split"]), SUM_BATCH)
    return bt.limit_batches(e, 2).select("split", "row_id", "batch_id")


# =============================================================================
# Scores and losses (PRJ-9..11, FLT-2, AGG-3..7)
# =============================================================================

_LSE = "(list_max(scores) + ln(list_sum(list_transform(scores, lambda v: exp(v - list_max(scores))))))"
_SC = f"SELECT *, {_LSE} AS lse FROM ({o.SCORES})"


@register("argmax_class", f"""
SELECT example, CAST(list_position(scores, list_max(scores)) - 1 AS INTEGER) AS pred, label FROM ({o.SCORES})""")
def q_argmax_class(spark, sf_dir):
    """PRJ-9: predicted class per position (first index on ties)."""
    return ls.argmax_class(fx.scores(spark, sf_dir)).select("example", "pred", "label")


@register("log_softmax_label", f"""
SELECT example, round(lse, 6) AS lse, round(scores[label + 1] - lse, 6) AS lp_label,
       round(list_sum(list_transform(scores, lambda v: exp(v - lse))), 6) AS prob_sum FROM ({_SC})""")
def q_log_softmax_label(spark, sf_dir):
    """PRJ-10/11: log-sum-exp, log p(label), and the probabilities summing to one."""
    s = ls.log_softmax(fx.scores(spark, sf_dir))
    lp = ls.log_softmax_expr("scores")
    return s.select("example", r6("lse").alias("lse"), r6("lp_label").alias("lp_label"),
                    r6(F.aggregate(lp, F.lit(0.0), lambda a, v: a + F.exp(v))).alias("prob_sum"))


@register("token_accuracy", f"""
SELECT batch_id, round(avg(CAST(list_position(scores, list_max(scores)) - 1 = label AS DOUBLE)), 6) AS accuracy
FROM ({o.SCORES}) GROUP BY batch_id""")
def q_token_accuracy(spark, sf_dir):
    """AGG-3: per-batch accuracy, padding positions counted."""
    a = ls.token_accuracy(fx.scores(spark, sf_dir))
    return a.select("batch_id", r6("accuracy").alias("accuracy"))


@register("cross_entropy", f"""
SELECT batch_id, round(sum(lse - scores[label + 1]) FILTER (WHERE label <> {fx.PAD_ID}) / count(*) FILTER (WHERE label <> {fx.PAD_ID}), 6) AS loss
FROM ({_SC}) GROUP BY batch_id""")
def q_cross_entropy(spark, sf_dir):
    """AGG-4 + FLT-2: per-batch cross-entropy, positions labelled with the pad id ignored."""
    c = ls.cross_entropy(fx.scores(spark, sf_dir), ignore=fx.PAD_ID)
    return c.select("batch_id", r6("loss").alias("loss"))


_LS = f"""SELECT batch_id, rank,
  sum(lse - scores[label + 1]) FILTER (WHERE label <> {fx.PAD_ID}) / count(*) FILTER (WHERE label <> {fx.PAD_ID}) AS nll,
  sum(len(scores) * lse - list_sum(scores)) FILTER (WHERE label <> {fx.PAD_ID}) / count(*) FILTER (WHERE label <> {fx.PAD_ID}) AS smooth,
  max(len(scores)) AS v, avg(CAST(list_position(scores, list_max(scores)) - 1 = label AS DOUBLE)) AS accuracy
FROM ({_SC}) GROUP BY batch_id, rank"""
_LS_LOSS = f"SELECT batch_id, rank, (1.0 - {SMOOTHING}) * nll + ({SMOOTHING} / v) * smooth AS loss, nll AS nll_loss, accuracy FROM ({_LS})"


@register("label_smoothed", f"SELECT batch_id, round(loss, 6) AS loss, round(nll_loss, 6) AS nll_loss FROM ({_LS_LOSS})")
def q_label_smoothed(spark, sf_dir):
    """AGG-5: label-smoothed loss (ε = 0.1) and its NLL part per batch."""
    s = ls.label_smoothed_nll(fx.scores(spark, sf_dir), SMOOTHING, ignore=fx.PAD_ID)
    return s.select("batch_id", r6("loss").alias("loss"), r6("nll_loss").alias("nll_loss"))


def _batch_table(spark, sf_dir) -> DataFrame:
    s = fx.scores(spark, sf_dir)
    return ls.batch_loss_and_accuracy(s, SMOOTHING, by=["batch_id", "rank"], ignore=fx.PAD_ID)


@register("batch_mean_loss", f"""
SELECT round(avg(loss), 6) AS vloss, round(avg(accuracy), 6) AS vaccuracy, count(*) AS n_batches FROM ({_LS_LOSS})""")
def q_batch_mean_loss(spark, sf_dir):
    """AGG-6: epoch loss/accuracy as the unweighted mean of batch values."""
    b = _batch_table(spark, sf_dir)
    m = ls.mean_of_batches(b, ["loss", "accuracy"])
    n = b.agg(F.count(F.lit(1)).alias("n_batches"))
    return m.select(r6("loss").alias("vloss"), r6("accuracy").alias("vaccuracy"), n.scalar().alias("n_batches"))


@register("rank_mean_loss", f"""
SELECT round(avg(loss), 6) AS vloss, round(avg(accuracy), 6) AS vaccuracy
FROM (SELECT rank, avg(loss) AS loss, avg(accuracy) AS accuracy FROM ({_LS_LOSS}) GROUP BY rank)""")
def q_rank_mean_loss(spark, sf_dir):
    """AGG-7: per-rank batch means, then the mean over ranks (sum ÷ world)."""
    m = ls.mean_of_batches(_batch_table(spark, sf_dir), ["loss", "accuracy"], rank_col="rank")
    return m.select(r6("loss").alias("vloss"), r6("accuracy").alias("vaccuracy"))


# =============================================================================
# Overlap metrics (AGG-8..13, JN-2, JN-4, SET-1)
# =============================================================================

@register("corpus_bleu", o.bleu_sql(o.PAIRS, "line_no", "src", "tgt"))
def q_corpus_bleu(spark, sf_dir):
    """AGG-8 + JN-4: corpus BLEU of user turns (prediction) against the next assistant turn (reference)."""
    p = fx.pairs(spark, sf_dir)
    return ov.corpus_bleu(p, pred="src", ref="tgt", id_cols=["line_no"])


@register("bleu_by_split", o.bleu_sql(o.PAIRS, "line_no", "src", "tgt", by="split"))
def q_bleu_by_split(spark, sf_dir):
    """AGG-8 grouped: one corpus BLEU per split."""
    p = fx.pairs(spark, sf_dir)
    return ov.corpus_bleu(p, pred="src", ref="tgt", id_cols=["line_no"], by=["split"])


@register("rouge_n", f"SELECT line_no, round(rouge1, 6) AS rouge1, round(rouge2, 6) AS rouge2 FROM {o.rouge_n_sql(o.PAIRS, 'line_no', 'src', 'tgt')}")
def q_rouge_n(spark, sf_dir):
    """AGG-9: ROUGE-1 and ROUGE-2 F per conversation pair (whole turns)."""
    r = ov.rouge_n(fx.pairs(spark, sf_dir), pred="src", ref="tgt", id_cols=["line_no"])
    return r.select("line_no", r6("rouge1").alias("rouge1"), r6("rouge2").alias("rouge2"))


@register("rouge1", f"SELECT line_no, round(rouge1, 6) AS rouge1 FROM {o.rouge_n_sql(o.PAIRS, 'line_no', 'src', 'tgt', (1,))}")
def q_rouge1(spark, sf_dir):
    """AGG-9, n = 1: ROUGE-1 F per conversation pair."""
    r = ov.rouge_n(fx.pairs(spark, sf_dir), pred="src", ref="tgt", id_cols=["line_no"], orders=(1,))
    return r.select("line_no", r6("rouge1").alias("rouge1"))


@register("rouge2", f"SELECT line_no, round(rouge2, 6) AS rouge2 FROM {o.rouge_n_sql(o.PAIRS, 'line_no', 'src', 'tgt', (2,))}")
def q_rouge2(spark, sf_dir):
    """AGG-9, n = 2: ROUGE-2 F per conversation pair."""
    r = ov.rouge_n(fx.pairs(spark, sf_dir), pred="src", ref="tgt", id_cols=["line_no"], orders=(2,))
    return r.select("line_no", r6("rouge2").alias("rouge2"))


@register("rouge_n_docs", f"SELECT pair_id, round(rouge1, 6) AS rouge1, round(rouge2, 6) AS rouge2 FROM {o.rouge_n_sql(o.DOC_PAIRS, 'pair_id', 'pred', 'ref')}")
def q_rouge_n_docs(spark, sf_dir):
    """AGG-9 on whole documents: document i scored against document i+1."""
    r = ov.rouge_n(fx.doc_pairs(spark, sf_dir), id_cols=["pair_id"])
    return r.select("pair_id", r6("rouge1").alias("rouge1"), r6("rouge2").alias("rouge2"))


_LCS_PAIRS = o.lcs_sql(f"SELECT line_no, src, tgt FROM ({o.PAIRS})", "line_no", o.rouge_tok("src"), o.rouge_tok("tgt"))


@register("rouge_l", f"SELECT line_no, round({o.f_measure('lcs', 'na', 'nb')}, 6) AS rougeL FROM {_LCS_PAIRS}")
def q_rouge_l(spark, sf_dir):
    """AGG-10: ROUGE-L F per conversation pair (bit-parallel LCS in an Arrow UDF)."""
    r = ov.rouge_l(fx.pairs(spark, sf_dir), pred="src", ref="tgt", id_cols=["line_no"])
    return r.select("line_no", r6("rougeL").alias("rougeL"))


@register("rouge_l_docs")
def q_rouge_l_docs(spark, sf_dir):
    """AGG-10 on whole documents (no SQL twin: a DP table per document pair is
    too slow in SQL; pytest checks it against a plain dynamic programme)."""
    r = ov.rouge_l(fx.doc_pairs(spark, sf_dir), id_cols=["pair_id"])
    return r.select("pair_id", r6("rougeL").alias("rougeL"))


_LSUM = o.lsum_sql(o.PAIRS, "line_no", "src", "tgt")


@register("rouge_lsum", f"SELECT line_no, round(rougeLsum, 6) AS rougeLsum FROM {_LSUM}")
def q_rouge_lsum(spark, sf_dir):
    """AGG-11: summary-level ROUGE-L (newline sentences, union LCS) per pair; pytest-checked."""
    r = ov.rouge_lsum(fx.pairs(spark, sf_dir), pred="src", ref="tgt", id_cols=["line_no"])
    return r.select("line_no", r6("rougeLsum").alias("rougeLsum"))


@register("rouge_epoch", f"""
WITH b AS (SELECT line_no, (row_number() OVER (ORDER BY line_no) - 1) // {SUM_BATCH} AS batch_id FROM ({o.PAIRS})),
s AS (SELECT b.batch_id, r.rouge1, r.rouge2, {o.f_measure('l.lcs', 'l.na', 'l.nb')} AS rougeL, u.rougeLsum
      FROM b JOIN {o.rouge_n_sql(o.PAIRS, "line_no", "src", "tgt")} r ON r.line_no = b.line_no JOIN {_LCS_PAIRS} l ON l.line_no = b.line_no JOIN {_LSUM} u ON u.line_no = b.line_no)
SELECT round(avg(rouge1), 6) AS rouge1, round(avg(rouge2), 6) AS rouge2, round(avg(rougeL), 6) AS rougeL, round(avg(rougeLsum), 6) AS rougeLsum
FROM (SELECT batch_id, avg(rouge1) AS rouge1, avg(rouge2) AS rouge2, avg(rougeL) AS rougeL, avg(rougeLsum) AS rougeLsum FROM s GROUP BY batch_id)""")
def q_rouge_epoch(spark, sf_dir):
    """AGG-12: batch means (4 pairs per batch, line order) of the four ROUGE scores, then their mean
    (``average_rouge`` has the Lsum-free means)."""
    p = pair_rank_order(spark, sf_dir)
    per = ov.rouge_all(p, pred="src", ref="tgt", id_cols=["line_no"], carry=["batch_id"])
    e = ov.rouge_epoch(per)
    return e.select(*[r6(c).alias(c) for c in ov.ROUGE_COLS])


_R12 = o.rouge_n_sql(o.PAIRS, "line_no", "src", "tgt")
_AVG_ROUGE = f"""
WITH b AS (SELECT line_no, (row_number() OVER (ORDER BY line_no) - 1) // {SUM_BATCH} AS batch_id FROM ({o.PAIRS})),
s AS (SELECT b.batch_id, r.rouge1, r.rouge2, {o.f_measure('l.lcs', 'l.na', 'l.nb')} AS rougeL
      FROM b JOIN {_R12} r ON r.line_no = b.line_no JOIN {_LCS_PAIRS} l ON l.line_no = b.line_no),
m AS (SELECT avg(rouge1) AS rouge1, avg(rouge2) AS rouge2, avg(rougeL) AS rougeL
      FROM (SELECT batch_id, avg(rouge1) AS rouge1, avg(rouge2) AS rouge2, avg(rougeL) AS rougeL FROM s GROUP BY batch_id))
SELECT round(rouge1, 6) AS rouge1, round(rouge2, 6) AS rouge2, round(rougeL, 6) AS rougeL,
       round((rouge1 + rouge2 + rougeL) / 3.0, 6) AS average_rouge FROM m"""


@register("average_rouge", _AVG_ROUGE)
def q_average_rouge(spark, sf_dir):
    """AGG-13: (ROUGE-1 + ROUGE-2 + ROUGE-L) / 3 of the epoch means (Lsum left out)."""
    p = pair_rank_order(spark, sf_dir)
    per = ov.rouge_pair_scores(p, pred="src", ref="tgt", id_cols=["line_no"], carry=["batch_id"], kinds=["rouge1", "rouge2", "rougeL"])
    e = ov.rouge_epoch(per, cols=["rouge1", "rouge2", "rougeL"])
    a = ov.average_rouge(e)
    return a.select(*[r6(c).alias(c) for c in ("rouge1", "rouge2", "rougeL", "average_rouge")])


@register("concat_outputs", f"SELECT split, line_no, tgt AS ref, src AS pred FROM ({o.PAIRS})")
def q_concat_outputs(spark, sf_dir):
    """SET-1 + JN-2: references paired with predictions by split and id, all splits in one table."""
    p = fx.pairs(spark, sf_dir)
    refs, preds = p.select("split", "line_no", F.col("tgt").alias("ref")), p.select("split", "line_no", F.col("src").alias("pred"))
    return ov.pair_predictions(refs, preds, keys=["split", "line_no"])  # the split is a key: one join for all


# =============================================================================
# Run analytics (TOP-1, AGG-15, PRJ-12, PRJ-13)
# =============================================================================

METRICS = ["click", "error", "purchase", "signup", "view"]


def _best_sql(metric: str, mode: str, k: int) -> str:
    order = "value DESC" if mode == "max" else "value ASC"
    return f"""
SELECT run, CAST(rk AS INTEGER) AS rank, epoch, value FROM (
  SELECT run, epoch, value, row_number() OVER (PARTITION BY run ORDER BY {order}, epoch) AS rk
  FROM ({o.RUN_METRICS}) WHERE metric = '{metric}' AND value IS NOT NULL AND NOT isnan(value)) WHERE rk <= {k}"""


@register("best_checkpoint_max", _best_sql("purchase", "max", 1))
def q_best_checkpoint_max(spark, sf_dir):
    """TOP-1, mode max (a score such as BLEU): best epoch per run, earliest on ties."""
    return rn.best_checkpoint(fx.run_metrics(spark, sf_dir), "purchase", "max")


@register("best_checkpoint_min", _best_sql("error", "min", 1))
def q_best_checkpoint_min(spark, sf_dir):
    """TOP-1, mode min (a loss)."""
    return rn.best_checkpoint(fx.run_metrics(spark, sf_dir), "error", "min")


@register("best_checkpoint_top3", _best_sql("click", "max", 3))
def q_best_checkpoint_top3(spark, sf_dir):
    """TOP-1 with k = 3 (two-level top-k)."""
    return rn.best_checkpoint(fx.run_metrics(spark, sf_dir), "click", "max", k=3)


_PIVOT = ", ".join(f"max(value) FILTER (WHERE metric = '{m}') AS {m}" for m in METRICS)
_COMPARE = f"""SELECT run, {_PIVOT} FROM ({o.RUN_METRICS}) GROUP BY run"""


@register("compare_runs", f"""
SELECT run, {', '.join(METRICS)}, view * (CAST(1 AS DOUBLE) / 60) AS view_minutes, click * CAST(1e-6 AS DOUBLE) AS click_millions,
       purchase * CAST(100 AS DOUBLE) AS purchase_pct FROM ({_COMPARE})""")
def q_compare_runs(spark, sf_dir):
    """AGG-15 + PRJ-13: one row per run, one column per metric, plus unit-scaled columns."""
    w = rn.compare_runs(fx.run_metrics(spark, sf_dir), METRICS)
    w = rn.scale_units(w, {"view_minutes": ("view", 1 / 60), "click_millions": ("click", 1e-6), "purchase_pct": ("purchase", 100.0)})
    return w.select("run", *METRICS, "view_minutes", "click_millions", "purchase_pct")  # exact IEEE products, no rounding


_EXAMPLES = f"SELECT *, row_number() OVER (PARTITION BY run ORDER BY value DESC, epoch, props) AS rk FROM ({o.RUN_METRICS}) WHERE metric = 'purchase' AND value IS NOT NULL AND NOT isnan(value)"


@register("compare_examples", f"""
SELECT c.run, c.purchase, c.error, e.epoch AS best_epoch, e.props, c.n_rows
FROM (SELECT run, max(value) FILTER (WHERE metric = 'purchase') AS purchase, max(value) FILTER (WHERE metric = 'error') AS error, count(*) AS n_rows
      FROM ({o.RUN_METRICS}) GROUP BY run) c LEFT JOIN (SELECT * FROM ({_EXAMPLES}) WHERE rk = 1) e ON e.run = c.run""")
def q_compare_examples(spark, sf_dir):
    """AGG-15 with the best checkpoint's epoch and example text, and totals of the run, in one grouping."""
    return rn.compare_runs(fx.run_metrics(spark, sf_dir, examples=True), ["purchase", "error"], best="purchase", examples=["props"], totals={"n_rows": F.count(F.lit(1))})


@register("metric_log", f"SELECT run AS user_id, epoch, metric, value, CAST(0 AS INTEGER) AS version, CAST(epoch % 2 AS BIGINT) AS batch FROM ({o.RUN_METRICS})")
def q_metric_log(spark, sf_dir):
    """SNK-2: the metric log appended in two batches under a claimed version, one of them twice (a retry), and read back."""
    rows, folder = fx.run_metrics(spark, sf_dir).withColumnRenamed("run", "user_id"), _folder(spark, "log")
    version = rn.claim_version(spark, folder, "events")
    for batch in (0, 1, 1):
        rn.append_batch(rows.where(F.col("epoch") % 2 == batch), folder, "events", version, batch)
    log = rn.read_log(spark, folder, "user_id long, epoch int, metric string, value double")
    return log.select("user_id", "epoch", "metric", "value", "version", "batch")


@register("metric_long", f"""
SELECT run, metric, value FROM (
  SELECT run, unnest(['click', 'error', 'purchase', 'signup', 'view']) AS metric,
         unnest([{', '.join(METRICS)}]) AS value FROM ({_COMPARE}))""")
def q_metric_long(spark, sf_dir):
    """PRJ-12: the wide comparison row back to (name, value) rows, shortest list wins."""
    w = rn.compare_runs(fx.run_metrics(spark, sf_dir), METRICS)
    return rn.metric_long(w, METRICS)


# =============================================================================
# Inference and jobs (UDF-1/2, JOB-1..3)
# =============================================================================

_LAST_ID = f"(SELECT max(id) AS last_id FROM ({o.VOCAB}))"


def _stub_text_sql(rel_with_ids: str, key: str, ids_col: str, max_len: int, carry=()) -> str:
    """SQL of the stub generator + decode: non-special ids -> next vocabulary id, first max_len-2 kept."""
    succ = f"list_transform(list_filter({ids_col}, lambda i: NOT list_contains({o.int_list(fx.SPECIAL_IDS)}, i))[1:{max_len - 2}], lambda i: CASE WHEN i >= lv.last_id THEN {fx.FIRST_TOKEN_ID} ELSE i + 1 END)"
    carry_sel = "".join(f"r.{c}, " for c in carry)
    gen = f"SELECT r.{key}, {carry_sel}list_concat([0]::INTEGER[], {succ}, [{fx.EOS_ID}]::INTEGER[]) AS gen FROM ({rel_with_ids}) r, {_LAST_ID} lv"
    return o.decode_sql(gen, key, "gen", "text", tuple(carry))


@register("infer_text", f"SELECT row_id, split, text FROM {_stub_text_sql(ENC_RECORDS_T, 'row_id', 'input_ids', SUM_MAX_OUT, ('split',))}")
def q_infer_text(spark, sf_dir):
    """UDF-2: truncate/encode -> mask -> stub generate (mapInPandas) -> decode, for every document."""
    v = fx.vocab(spark, sf_dir)
    r = fx.records(spark, sf_dir).select("row_id", "split", "document")
    return jobs.infer_text(r, "document", v, jobs.stub_factory(v), key_cols=["row_id"], carry=["split"],
                           max_input=SUM_MAX_IN, max_len=SUM_MAX_OUT).select("row_id", "split", "text")


_TR_KEPT = f"SELECT * FROM {ENC_PAIRS} WHERE len(src_ids) <= {TR_MAX_SRC} AND len(tgt_ids) <= {TR_MAX_TGT}"
_TR_TEXT = f"""SELECT g.line_no, g.split, g.text AS pred, r.text AS ref
FROM {_stub_text_sql(_TR_KEPT, 'line_no', 'src_ids', TR_MAX_TGT, ('split',))} g
JOIN {o.decode_sql(_TR_KEPT, 'line_no', 'tgt_ids', 'text')} r ON r.line_no = g.line_no"""


@register("evaluate_translation", f"""
SELECT b.*, l.vloss, l.vaccuracy FROM ({o.bleu_sql(_TR_TEXT, 'line_no', 'pred', 'ref')}) b,
  (SELECT round(avg(loss), 6) AS vloss, round(avg(accuracy), 6) AS vaccuracy FROM ({_LS_LOSS})) l""")
def q_evaluate_translation(spark, sf_dir):
    """JOB-1: translation evaluation — filtered pairs, stub generation, decoded references and
    predictions, corpus BLEU, with loss/accuracy means from the fixed class scores."""
    v = fx.vocab(spark, sf_dir)
    return jobs.evaluate_translation(fx.pairs(spark, sf_dir), v, jobs.stub_factory(v), fx.scores(spark, sf_dir),
                                     max_src=TR_MAX_SRC, max_tgt=TR_MAX_TGT, epsilon=SMOOTHING)


_SUM_BASE = f"SELECT row_id, split, pos // {SUM_BATCH} AS batch_id, input_ids, output_ids FROM ({SHUFFLED})"
_SUM_TEXT = f"""SELECT p.row_id, p.split, p.batch_id, p.text AS pred, r.text AS ref
FROM {_stub_text_sql(_SUM_BASE, 'row_id', 'input_ids', SUM_MAX_OUT, ('split', 'batch_id'))} p
JOIN {o.decode_sql(_SUM_BASE, 'row_id', 'output_ids', 'text')} r ON r.row_id = p.row_id"""
_SUM_LCS = o.lcs_sql(f"SELECT row_id, pred, ref FROM ({_SUM_TEXT})", "row_id", o.rouge_tok("pred"), o.rouge_tok("ref"))
_CE_BATCH = f"""SELECT batch_id, sum(lse - scores[label + 1]) FILTER (WHERE label <> {fx.PAD_ID})
  / count(*) FILTER (WHERE label <> {fx.PAD_ID}) AS loss FROM ({_SC}) GROUP BY batch_id"""
_EVAL_SUM_CORE = f"""
WITH t AS ({_SUM_TEXT}),
s AS (SELECT t.split, t.batch_id, r.rouge1, r.rouge2, {o.f_measure('l.lcs', 'l.na', 'l.nb')} AS rougeL
      FROM t JOIN {o.rouge_n_sql(_SUM_TEXT, 'row_id', 'pred', 'ref')} r ON r.row_id = t.row_id
             JOIN {_SUM_LCS} l ON l.row_id = t.row_id),
b AS (SELECT split, batch_id, avg(rouge1) AS r1, avg(rouge2) AS r2, avg(rougeL) AS rl FROM s GROUP BY split, batch_id),
e AS (SELECT split, avg(r1) AS rouge1, avg(r2) AS rouge2, avg(rl) AS rougeL FROM b GROUP BY split),
v AS (SELECT avg(loss) AS vloss FROM ({_CE_BATCH}))
SELECT split, round(rouge1, 6) AS rouge1, round(rouge2, 6) AS rouge2, round(rougeL, 6) AS rougeL,
       round((rouge1 + rouge2 + rougeL) / 3.0, 6) AS average_rouge, round(vloss, 6) AS vloss FROM e, v"""


# a decoded text is one sentence, and the union of one common subsequence is itself: Lsum equals L
_EVAL_SUM = f"SELECT split, rouge1, rouge2, rougeL, rougeL AS rougeLsum, average_rouge, vloss FROM ({_EVAL_SUM_CORE})"


@register("evaluate_summaries", _EVAL_SUM)
def q_evaluate_summaries(spark, sf_dir):
    """JOB-2: summarisation evaluation — truncated documents, stub generation, four ROUGE
    scores per pair against the decoded summaries, batch means, average ROUGE, loss.
    (Decoded texts have no line ends, so their summary-level score is that of one sentence.)"""
    v = fx.vocab(spark, sf_dir)
    return jobs.evaluate_summaries(fx.records(spark, sf_dir), v, jobs.stub_factory(v), fx.scores(spark, sf_dir),
                                   max_in=SUM_MAX_IN, max_out=SUM_MAX_OUT, batch_size=SUM_BATCH)


@register("evaluate_summaries_core", _EVAL_SUM_CORE)
def q_evaluate_summaries_core(spark, sf_dir):
    """JOB-2 without ROUGE-Lsum, so SQL can repeat every step: truncated documents,
    shuffled batches of 4, stub generation, decoded references, ROUGE-1/2/L
    batch means per split, average ROUGE and the epoch cross-entropy."""
    v = fx.vocab(spark, sf_dir)
    return jobs.evaluate_summaries(fx.records(spark, sf_dir), v, jobs.stub_factory(v), fx.scores(spark, sf_dir),
                                   max_in=SUM_MAX_IN, max_out=SUM_MAX_OUT, batch_size=SUM_BATCH,
                                   kinds=("rouge1", "rouge2", "rougeL"))


_PREP = f"""
WITH k AS ({_TR_KEPT}),
s AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY
        CASE WHEN split = 'train' THEN md5('{fx.SEED}:' || CAST(line_no AS VARCHAR)) END NULLS FIRST, line_no) - 1 AS pos FROM k),
b AS (SELECT *, pos // {TR_BATCH} AS batch_id FROM s)
SELECT split, batch_id, line_no,
  {o.ids_str(f"list_resize(src_ids, max(len(src_ids)) OVER (PARTITION BY split, batch_id), {fx.PAD_ID})")} AS src_ids,
  {o.ids_str("list_resize(list_transform(src_ids, lambda x: 1), max(len(src_ids)) OVER (PARTITION BY split, batch_id), 0)")} AS src_mask,
  {o.ids_str(f"list_resize(tgt_ids, max(len(tgt_ids)) OVER (PARTITION BY split, batch_id), {fx.PAD_ID})")} AS tgt_ids,
  {o.ids_str("list_resize(list_transform(tgt_ids, lambda x: 1), max(len(tgt_ids)) OVER (PARTITION BY split, batch_id), 0)")} AS tgt_mask
FROM b"""


@register("prepare_corpus", _PREP)
def q_prepare_corpus(spark, sf_dir):
    """JOB-3: raw pairs -> strip -> encode -> length filter -> shuffle (train) -> batches of 8 -> padded ids and masks."""
    out = jobs.prepare_corpus(fx.pairs(spark, sf_dir), fx.vocab(spark, sf_dir), max_src=TR_MAX_SRC, max_tgt=TR_MAX_TGT,
                              batch_size=TR_BATCH, shuffle_splits=["train"])
    return out.select("split", "batch_id", "line_no", *[ids_str(c).alias(c) for c in ("src_ids", "src_mask", "tgt_ids", "tgt_mask")])



_P_EOS, _P_PAD = 1, 0  # a family without begin id: end id 1, pad id 0
_ENC_P = o.encode_sql(o.RECORDS, "row_id", ["split"], {"document": "input_ids", "summary": "output_ids"}, prefix=(), suffix=(_P_EOS,))
_PREP_SUM = f"""
WITH e AS (SELECT row_id, split, {o.truncate_sql('input_ids', SUM_MAX_IN, 0, 1)} AS input_ids,
                  list_concat([{_P_PAD}]::INTEGER[], {o.truncate_sql('output_ids', SUM_MAX_OUT, 0, 1)}) AS output_ids FROM {_ENC_P}),
s AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY md5('{fx.SEED}:' || CAST(row_id AS VARCHAR)), row_id) - 1 AS pos FROM e),
b AS (SELECT *, pos // {SUM_BATCH} AS batch_id FROM s)
SELECT split, row_id, batch_id, CAST({_P_PAD} AS INTEGER) AS pad_id,
  {o.ids_str(f"list_resize(input_ids, max(len(input_ids)) OVER (PARTITION BY split, batch_id), {_P_PAD})")} AS input_ids,
  {o.ids_str(f"list_resize(output_ids, max(len(output_ids)) OVER (PARTITION BY split, batch_id), {_P_PAD})")} AS output_ids
FROM b"""


@register("prepare_summaries", _PREP_SUM)
def q_prepare_summaries(spark, sf_dir):
    """JOB-3, summarisation, for a tokenizer family without begin id: truncate -> start pad -> shuffle ->
    batches of 4 -> padded with the pad id told from the ids."""
    out = jobs.prepare_summaries(fx.records(spark, sf_dir), fx.vocab(spark, sf_dir), max_in=SUM_MAX_IN, max_out=SUM_MAX_OUT,
                                 batch_size=SUM_BATCH, bos_id=None, eos_id=_P_EOS)
    return out.select("split", "row_id", "batch_id", "pad_id", *[ids_str(c).alias(c) for c in ("input_ids", "output_ids")])
