"""The corpus pipeline over `documents`: toxicity, line dedup, near duplicates, secrets, packing.

Each stage takes the documents that its predecessor kept and returns the same columns; the last
returns packed pieces. Stages are parted by Parquet tables in the shared folder.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lexweave.llm import line_dedup, packing, secrets, toxicity
from lexweave.llm.common import hidden, write_table
from lexweave.llm.ngram_jaccard import one_of_each

#: The stages and the order are no SQL: the first learns a model, the last runs a tokenizer.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model of op8 doesn't call toxic."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    plain, back = hidden(docs, "held_out", "score", "predicted")
    return toxicity.toxicity_scores(plain, model).where("predicted = 0").select(*back)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each line of a class only where it first occurs."""
    return line_dedup.dedup_lines(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones, that with the smallest doc_id; of repeated rows one. Documents without words stay."""
    return one_of_each(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret replaced by a mark."""
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens, placed in sequences."""
    return packing.pack(packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_lines), ("near_copies", drop_near_copies), ("secrets", mask_secrets), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces after all stages."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = write_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
