"""A corpus pipeline of five stages over ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
stored and read again as the next one's ``docs``. All but the last return the
columns they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martloom.llm import stages
from martloom.llm.common import stored

STAGES = [
    ("language_id", stages.language_id),
    ("simhash_near_dedup", stages.simhash_near_dedup),
    ("decontamination", stages.decontamination),
    ("pii_pseudonyms", stages.pii_pseudonyms),
    ("byte_bpe", stages.byte_bpe),
]

# Language profiles, BK-trees and byte-pair merges are not SQL;
# tests/llm/test_pipeline.py checks run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
