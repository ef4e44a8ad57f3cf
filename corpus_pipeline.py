"""The corpus pipeline: documents through language ID, dedup, decontamination, mixing and sharding."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from revue.conf import materialize
from revue.llm import stages

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = list(stages.STAGES)

#: Language ID, near-dedup and decontamination have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES to ``documents``; each stage's rows are written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
