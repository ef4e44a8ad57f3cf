"""Stages of the corpus pipeline; each takes (spark, docs, sf_dir) and returns a DataFrame.

All return whole rows: the columns of ``docs``, and the last one shard, slot and copy as well. Extra
columns pass through, an empty table gives an empty result, and texts of any length are read whole. Near-dedup drops
rows by doc_id, which names a document; rows with a null doc_id are kept there. Null and empty texts have no language and
go in the first stage. Repeated rows and ties are treated alike, so a rerun gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revue.llm import decontaminate, langid, mixing, near_dedup, sharding
from revue.llm.queries import MIX_CYCLE, MIX_EPOCHS, MIX_SHARE, SHARDS, language_model, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language the classifier rejects (no letter, or far from every language it knows)."""
    return langid.identified(docs, language_model(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document (the smallest id) of each class of near-duplicates."""
    dropped = near_dedup.near_dedup(docs).where(~F.col("kept")).select(F.col("doc_id").alias("dropped_id"))
    return docs.join(dropped, docs["doc_id"] == dropped["dropped_id"], "left_anti")


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold an item of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or more."""
    return mixing.mixed_rows(docs, MIX_CYCLE, MIX_SHARE, MIX_EPOCHS)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole rows, every copy with its shard, slot and number among the copies of its document."""
    return sharding.place(docs, SHARDS)


STAGES = [("language-id", language), ("near-dedup", near_duplicates), ("decontamination", benchmark),
          ("mixing", mixture), ("sharding", shard)]
