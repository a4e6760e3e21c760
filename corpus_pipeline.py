"""From raw documents to packed sequences: five stages, each over all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm import decontamination, neardup, packing, quality, toxicity
from shelfwise.llm.common import table
from shelfwise.session import delete_path, job_scratch, scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents predicted toxic (score of 0.7 or more) go. Learnt from a sample of the labelled ones."""
    sample = toxicity.training_sample(docs, table(spark, sf_dir, "labels"), None, toxicity.SAMPLE, "doc_id", "text")
    return toxicity.drop_toxic(docs, toxicity.learn_model(sample), threshold=0.7)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents that fail a rule of the production policy go. One projection, no join."""
    return quality.keep_passing(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: of linked documents the one with the smallest id stays; shingles of five words, similarity 0.8."""
    return neardup.drop_copies(docs, size=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents with 1 word in 20 or more inside benchmark windows of 13 words go."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"), window=13)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: pieces of all remaining documents in sequences of at most 1024 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), size=1024, end_id=2)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", drop_low_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: SQL can't express trained scores, tokenizers or packing; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is a Parquet table in the shared folder that the next stage reads.

    What a stage put beside its result is deleted when the result is written, and the result when the next one is; the
    last one stays.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        with job_scratch(spark):
            found = stage(spark, docs, sf_dir)
            found.write.parquet(path)
        if before:
            delete_path(spark, before)
        docs, before = spark.read.schema(found.schema).parquet(path), path
    return docs
