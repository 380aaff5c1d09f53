"""The registered queries of this subpackage and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiflow.llm import credentials, decontaminate, dom_extract, feistel, fp_search, lang_id, merkle, multi_index, order_minhash, prefix_bpe, preference, pu_quality, warc_zstd
from lexiflow.llm.common import table

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
#: The queries' key; a caller of the operator passes a secret of their own.
PSEUDONYM_KEY = "query key"


def op1_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_credentials(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return credentials.digest(credentials.find_secrets(docs))


def op3_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op4_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return prefix_bpe.tokenize(docs, PIECE_MODEL, emit=("n_tokens", "ids_sha256", "decoded_sha256"))


def op6_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pu_quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = preference.conversations(table(spark, sf_dir, "conversations"))
    return preference.format_pairs(preference.swapped_replies(chats))


def op8_dom_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return dom_extract.extract(pages).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op9_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc_zstd.round_trip(spark, table(spark, sf_dir, "pages"), payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_feistel(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return feistel.pseudonymise(docs, PSEUDONYM_KEY)


def op11_fp_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fp_search.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_word_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_id.identify(table(spark, sf_dir, "documents"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return merkle.verify(merkle.manifest(docs, altered={"text": merkle.without_newlines()}))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_order_minhash": op1_order_minhash,
    "op2_credentials": op2_credentials,
    "op3_multi_index": op3_multi_index,
    "op4_templates": op4_templates,
    "op5_piece_codec": op5_piece_codec,
    "op6_pu_quality": op6_pu_quality,
    "op7_preference": op7_preference,
    "op8_dom_trees": op8_dom_trees,
    "op9_warc_zstd": op9_warc_zstd,
    "op10_feistel": op10_feistel,
    "op11_fp_search": op11_fp_search,
    "op12_word_backoff": op12_word_backoff,
    "op13_merkle": op13_merkle,
}

ORACLE: dict[str, str] = {
    "op7_preference": preference.ORACLE,
    "op9_warc_zstd": warc_zstd.ORACLE,
    "op11_fp_search": fp_search.ORACLE,
    "op13_merkle": merkle.ORACLE,
}
