"""Exact dedup by a tree merge of sorted digest runs.

Every row falls into one of ``runs`` runs (a hash of its id, so a rerun of a lost
task deals it out again in the same way). A run holds, per digest, the best row and
a count. In each round ``fan_in`` neighbouring runs are merged (``log2(fan_in)``
binomial rounds at once): Spark sorts and merges the runs by (run, digest), each
range of digests in a task of its own. After the last round one run is left, spread
over all tasks by digest. The answer then goes down the same tree: level by level,
each run learns the final row of its digests. So neither the merge nor the way back
ever brings more than ``fan_in`` rows of a digest, or one run's rows, together, even
when a third of all rows are copies of one text.

Merging is verified: the key is the SHA-256 of the normalised text together with its
length and an independent 64-bit hash, so a collision of one never joins two texts.
Only digests move; texts stay where they were read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revue.conf import materialize

#: Fixed value: the characters that normalisation deletes (space, tab to carriage return).
BLANK_CLASS = r"[\x20\x09-\x0D]"
FAN_IN = 8
KEY = ["sha", "n_norm", "check"]


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANK_CLASS + "+", "")


def digest_rows(df: DataFrame, id_col: str, text_col: str, runs: int) -> DataFrame:
    """One row per document: id, run, verified digest key, length of the original text."""
    base = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    norm = base.select("id", F.length("t").cast("long").alias("n_chars"), normalised(F.col("t")).alias("t"))
    return norm.select("id", "n_chars", F.sha2(F.col("t"), 256).alias("sha"),
                       F.length("t").alias("n_norm"), F.xxhash64("t").alias("check"),
                       F.pmod(F.xxhash64("id", F.lit("run")), F.lit(runs)).cast("int").alias("run"))


def _best() -> Column:
    """Most code points first, then smallest id; a null id comes last."""
    return F.min(F.struct((-F.col("n_chars")).alias("neg"), F.col("id").isNull().alias("no_id"),
                          F.col("id").alias("id"))).alias("best")


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                runs: int | None = None, fan_in: int = FAN_IN) -> DataFrame:
    """Return id, keep_id, group_size, kept, text_sha256: one row per input row.

    Texts are equal when equal after deleting white space; of equal texts the one with
    the most code points, then the smallest id, is kept. Null text counts as empty, so
    null, empty and blank texts form one group. A null id is kept only if its group
    has no other id of the same length. Rows that repeat an id and text are counted
    each and all flagged alike. An empty table gives an empty result. Other columns of
    ``df`` are not read, so their names cannot clash. ``runs`` defaults to the number of shuffle
    partitions, rounded up to a power of ``fan_in``.
    """
    spark = df.sparkSession
    width = runs or int(spark.conf.get("spark.sql.shuffle.partitions"))
    levels = max(1, math.ceil(math.log(max(2, width), fan_in) - 1e-9))
    docs = materialize(digest_rows(df, id_col, text_col, fan_in ** levels), "dedup-digests")
    merged = [docs.groupBy("run", *KEY).agg(_best(), F.count(F.lit(1)).alias("n"))]
    for _ in range(levels):
        merged.append(merged[-1].withColumn("run", F.expr(f"run div {fan_in}").cast("int"))
                      .groupBy("run", *KEY).agg(F.min("best").alias("best"), F.sum("n").alias("n")))
    final = merged.pop()
    for level in reversed(merged):
        here = level.select("run", *KEY, F.expr(f"run div {fan_in}").cast("int").alias("up"))
        above = final.select(F.col("run").alias("up"), *KEY, "best", "n")
        final = here.join(above, ["up", *KEY]).drop("up")
    return (docs.join(final.select("run", *KEY, "best", "n"), ["run", *KEY])
            .select(F.col("id").alias(id_col), F.col("best.id").alias("keep_id"),
                    F.col("n").alias("group_size"), F.col("id").eqNullSafe(F.col("best.id")).alias("kept"),
                    F.col("sha").alias("text_sha256")))
