"""The corpus pipeline: filter, deduplicate, decontaminate and pack ``documents``.

Each stage takes (spark, docs, sf_dir) and returns the documents that it keeps, with their columns; the last returns the
packed token pieces. ``run`` writes each stage's result to the shared folder and reads it again for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spanledger.llm import decontam, exact_dedup, packing, simhash, toxicity
from spanledger.llm.queries import table, tokenizer_path, toxicity_model
from spanledger.llm.shipping import ship
from spanledger.sources.scratch import durable


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents that score at or above the threshold go."""
    ship(spark)
    return toxicity.drop_toxic(docs, toxicity_model(spark, docs, sf_dir))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: of equal texts the smallest doc_id stays."""
    ship(spark)
    return exact_dedup.keep_first(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: of linked fingerprints the smallest doc_id stays."""
    ship(spark)
    return simhash.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents that contain a benchmark item go."""
    return decontam.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: token pieces in sequences."""
    ship(spark)
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", without_toxic),
    ("exact dedup", without_copies),
    ("near dedup", without_near_copies),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
