"""Corpus preparation: STAGES over ``documents``, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from touchline.llm.common import staged
from touchline.llm.decontam import clean_documents
from touchline.llm.exact import deduplicated
from touchline.llm.packing import pack_documents
from touchline.llm.registry import tokenizer_path
from touchline.llm.simhash import without_near_copies
from touchline.llm.toxicity import without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the smallest id stays."""
    return deduplicated(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near copies (five-word shingles, similarity 0.8 or more), the document with the smallest id stays."""
    return without_near_copies(docs, words=5, similarity=0.8)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item go."""
    return clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents' pieces, placed in sequences of 2048 tokens."""
    return pack_documents(docs, tokenizer_path("word_bpe_49k.json"), capacity=2048, end_id=0, keep_ids=False)


STAGES = [
    ("toxicity", toxicity),
    ("exact dedup", exact),
    ("SimHash near-dedup", near),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", packing),
]

#: The stages use a learned score, approximate sketches and a tokenizer: SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; every stage but the last is written to the shared folder and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged(docs, f"stage-{name.replace(' ', '-')}")
    return docs
