"""Corpus pipeline: quality rules, line dedup, near-dedup, mixing, packing.

Each stage is written as Parquet to the shared folder and read again, so a
lost executor costs at most the stage that was running. The result stays there
until the application ends.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from granary.llm.queries import STAGES
from granary.runtime import stage

__all__ = ["ORACLE_SQL", "STAGES", "run"]

#: Fingerprint links, the seeded mix and the packing cannot be put in SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
