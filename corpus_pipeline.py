"""The corpus pipeline: each stage works on all rows that the one before it kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from paylens.llm import exact_dedup, jaccard_join, mixing, quality_rules, sentencepiece_codec
from paylens.operators.sizes import shared_folder


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that pass the base rules and the certified cutoffs; labels come from the labels table."""
    return quality_rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of equal texts, the row with the largest id stays."""
    return exact_dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group chained by links (five words, similarity 0.8 or more), the row with the smallest id stays."""
    return jaccard_join.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows as often as the source mix takes them; a row cut by the end of a pass comes with the words taken."""
    return mixing.mixed_rows(docs, mixing.mix(docs))


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, parity and round_trip of every row."""
    return sentencepiece_codec.encode(docs, sentencepiece_codec.load())


STAGES = [("quality rules", apply_rules), ("exact dedup", drop_copies), ("n-gram Jaccard join", drop_near_copies),
          ("source mix", mix_sources), ("SentencePiece encoding", encode_texts)]
ORACLE_SQL = None  # neither the similarity join nor sub-word encoding has SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet in the shared folder and read again by the next."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for place, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{place}")
        docs = spark.read.parquet(f"{folder}/{place}")
    return docs
