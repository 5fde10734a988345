"""The registered queries of the package: each applies one operator, with production
parameters, to its whole table, and derives the columns its contract names."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from vitrina.llm.byte_cnn import held_out, score_quality, train
from vitrina.llm.conversation_repair import damaged, repair_summaries
from vitrina.llm.decontam import contaminated
from vitrina.llm.line_rules import line_first_rules
from vitrina.llm.near_dups import near_duplicates
from vitrina.llm.oracle import ORACLE  # noqa: F401 - registered with the queries
from vitrina.llm.packing import pack, token_pieces
from vitrina.llm.page_diff import extract_pages
from vitrina.llm.quote_links import reply_ordered
from vitrina.llm.records import record_digest, write_records
from vitrina.llm.secret_links import linked_secrets, span_digest
from vitrina.llm.ship import ship_package
from vitrina.llm.token_alignment import align_tokens
from vitrina.llm.token_counts import prefix_token_counts
from vitrina.llm.url_trees import UrlTrees, filter_urls, seed_labels
from vitrina.session import scratch_path

# The contract's URL rules.
URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
BYTE_BPE, WORD_BPE, PIECE_BPE = "byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_edit_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op2_binary_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "records")
    write_records(_table(spark, sf_dir, "documents"), path, public_tokenizers.path(BYTE_BPE), end_id=0)
    return record_digest(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32", "shard", "offset")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = token_pieces(_table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE), 4096, end_id=1)
    return pack(pieces, 4096).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op5_page_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(_table(spark, sf_dir, "pages"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = prefix_token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), budgets=(512,))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"),
                         F.col("chars_in_512").alias("chars_in_limit"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_first_rules(_table(spark, sf_dir, "documents"), with_text=False)


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return filter_urls(pages, UrlTrees(seed_labels(pages)), URL_RULES)


def op9_quote_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reply_ordered(_table(spark, sf_dir, "conversations"))


def op10_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = score_quality(docs, train(docs, _table(spark, sf_dir, "labels")))
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op11_secret_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_digest(linked_secrets(_table(spark, sf_dir, "documents")))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_summaries(damaged(_table(spark, sf_dir, "conversations")))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE),
                        public_tokenizers.path(PIECE_BPE))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_edit_decontamination": op1_edit_decontamination,
    "op2_binary_records": op2_binary_records,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_quality_rules": op4_quality_rules,
    "op5_page_difference": op5_page_difference,
    "op6_token_counts": op6_token_counts,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_url_filter": op8_url_filter,
    "op9_quote_links": op9_quote_links,
    "op10_byte_cnn": op10_byte_cnn,
    "op11_secret_links": op11_secret_links,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_token_alignment": op13_token_alignment,
}
