"""From raw documents to packed training sequences, in five stages.

All stages take null ids, texts, languages and sources, empty and very long texts, repeated rows, empty tables and columns beside those
of documents, whatever their names; all but the last return the columns that they get. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm import jaccard_join, mixing, packing, quality, secret_scan
from granary.llm.common import Scratch, documents
from granary.llm.queries import WORD_TOKENIZER, tokenizer

#: SQL has no language model, compressor or tokenizer.
ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. Null, empty and short texts go; repeated rows are judged alike, and all stay or go."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8), that with the least id. Of repeated rows one
    stays; texts without a word have no copies and stay."""
    return jaccard_join.keep_one(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with each secret replaced by a mark; n_chars follows. Null texts stay null."""
    return secret_scan.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once, or up to three times. Null sources are one source; texts without a
    word are never taken."""
    return mixing.mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces, each with its ids' digest and its place in a sequence. A null or empty text is one piece of one id."""
    return packing.pack(docs, tokenizer(WORD_TOKENIZER), with_ids=False)


STAGES = [("quality rules", good_quality), ("near duplicates", near_duplicates), ("secret scan", without_secrets), ("source mix", source_mix), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over all documents, each written and read again."""
    scratch, docs = Scratch(spark), documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), f"stage{k}")
        if k:
            scratch.drop(f"stage{k - 1}")
    return docs
