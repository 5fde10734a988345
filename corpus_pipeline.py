"""Corpus pipeline over the table documents: STAGES in order, each written before the next.

Every stage reads all rows its predecessor kept and returns the columns of documents, except
the last, which returns the packing (one row for each piece of a document).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from vitrina.llm.byte_cnn import score_quality, train
from vitrina.llm.decontam import decontaminate
from vitrina.llm.line_rules import line_first_rules
from vitrina.llm.near_dups import without_near_duplicates
from vitrina.llm.packing import pack, token_pieces
from vitrina.llm.ship import ship_package
from vitrina.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the line rules, without their failing lines.

    The other columns pass under names of their own, so none of them clashes with a count of the rules;
    ``n_chars``, where there is one, counts the text that is left."""
    ship_package(spark)
    others = {f"__k{i}": c for i, c in enumerate(docs.columns) if c != "text"}
    src = docs.select("text", *(F.col(f"`{c}`").alias(k) for k, c in others.items()))
    kept = line_first_rules(src, keep=tuple(others)).filter("kept")
    values = {c: F.col(k) for k, c in others.items()} | {"text": F.col("clean_text")}
    if "n_chars" in values:
        values["n_chars"] = F.length("clean_text").cast(docs.schema["n_chars"].dataType)
    return kept.select(*(values[c].alias(c) for c in docs.columns))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network gives 0.3 and more; it learns from the labelled documents of the table."""
    ship_package(spark)
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(table, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score_quality(docs, model, keep=tuple(docs.columns), score_col="__score", text_col="text")
    return scored.filter("__score >= 0.3").drop("__score")


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is linked by five-word shingle sets of similarity 0.8."""
    ship_package(spark)
    return without_near_duplicates(docs, words=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    ship_package(spark)
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences of 4096 tokens."""
    ship_package(spark)
    pieces = token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), 4096, end_id=1)
    return pack(pieces, 4096)


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("minhash_near_dedup", minhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

# The classifier, the signatures and the packing have no SQL form: see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
