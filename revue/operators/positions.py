"""Dense positions in a global sort order without a single-task window.

``row_number() over (order by ...)`` without a partition runs in one task, and a
window partitioned by a hot key does too. Here the rows are range-partitioned
on the sort key (balanced by sampling; the key has a unique suffix, so even a
hot key value spreads over several partitions), sorted within partitions and
checkpointed. Within a partition ``monotonically_increasing_id`` numbers rows
consecutively in that order, and numbering a filtered branch counts only the
rows that pass; per-partition totals (one row per partition, a bounded
broadcast) turn local counts into global ones. Everything stays in the JVM:
no Python worker, no extra shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revue.conf import checkpointed, materialize

PID = "__pid"


def running_sum(df: DataFrame, order: list[str | Column], flag: str, out: str,
                partitions: int | None = None) -> DataFrame:
    """Add ``out`` = number of rows with ``flag`` = 1 strictly before each row in ``order``.

    ``flag`` must be 0 or 1 and ``order`` a total order (unique keys). For a
    flag-1 row the count is its index among flag-1 rows of its partition; for a
    flag-0 row it is its index among all rows minus its index among flag-0 rows.
    """
    spark = df.sparkSession
    n = partitions or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # Materialised so that every branch below reads identical partitions in identical order.
    s = checkpointed(df.repartitionByRange(n, *order).sortWithinPartitions(*order))
    base = F.shiftleft(F.col(PID).cast("long"), 33)
    s = s.withColumn(PID, F.spark_partition_id()).withColumn("__all", F.monotonically_increasing_id())
    ones = (s.where(F.col(flag) == 1).withColumn("__k", F.monotonically_increasing_id())
             .withColumn("__local", F.col("__k") - base))
    zeros = (s.where(F.col(flag) != 1).withColumn("__k", F.monotonically_increasing_id())
              .withColumn("__local", F.col("__all") - F.col("__k")))
    # Every non-empty partition needs an offset, including those without flag-1 rows.
    totals = s.groupBy(PID).agg(F.sum(F.col(flag).cast("long")).alias("__tot"))
    offsets = totals.select(
        PID, F.coalesce(F.sum("__tot").over(Window.orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)),
                        F.lit(0)).alias("__off"))
    # One row per partition at most: bounded by the partition count, safe to broadcast.
    both = ones.unionByName(zeros)
    return (both.join(F.broadcast(offsets), PID)
                .withColumn(out, F.col("__off") + F.col("__local"))
                .drop("__off", "__local", "__k", "__all", PID))


def dense_index(df: DataFrame, order: list[str | Column], out: str = "index",
                partitions: int | None = None) -> DataFrame:
    """0-based position of every row in ``order`` (a distributed zipWithIndex)."""
    return running_sum(df.withColumn("__one", F.lit(1)), order, "__one", out, partitions).drop("__one")


def rank_in_key(df: DataFrame, keys: list[str], order: list[Column], out: str = "rank",
                partitions: int | None = None) -> DataFrame:
    """Add ``out`` = 1, 2, ... within each key in ``order``, as ``row_number`` does, with a hot key spread over many tasks.

    Rows are range-partitioned by key and order, so a key with a third of all rows fills a third of the
    partitions; a window then counts within (partition, key), and what earlier partitions hold of the key is added.
    Only the last key of a partition can go on in the next one, so those counts are at most two a partition: a
    bounded broadcast. Nulls are a key of their own. Rows that ``order`` does not tell apart are ranked in
    any order; they are dealt out by arrival, so they spread, too.
    """
    spark = df.sparkSession
    n = partitions or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    arrived = df.withColumn("__arrival", F.monotonically_increasing_id())
    s = materialize(arrived.repartitionByRange(n, *keys, *order, "__arrival").withColumn(PID, F.spark_partition_id()), "ranked-by-key")
    key = F.struct(*keys)
    last = s.groupBy(PID).agg(F.max(key).alias("__k")).select("__k").distinct()  # one row a partition
    edges = s.select(PID, key.alias("__k")).join(F.broadcast(last), "__k", "left_semi")
    earlier = Window.partitionBy("__k").orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (edges.groupBy(PID, "__k").agg(F.count(F.lit(1)).alias("__n"))
               .select(F.col(PID).alias("__p"), "__k", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__off")).where("__off > 0"))
    counted = s.withColumn("__row", F.row_number().over(Window.partitionBy(PID, *keys).orderBy(*order)))
    return (counted.join(F.broadcast(offsets), (F.col(PID) == F.col("__p")) & (key == F.col("__k")), "left")
            .withColumn(out, (F.col("__row") + F.coalesce("__off", F.lit(0))).cast("long"))
            .drop("__row", "__off", "__k", "__p", "__arrival", PID))
