"""Running totals over a seeded order, without putting one key into one task.

Rows carry a fixed-width hex key ``order_key`` (an md5) whose first three digits are
the row's slice: 4,096 slices a group. Totals per (group, slice) are summed over
the slices of a group (at most 4,096 rows), and only rows of one slice are ordered
together, so a group that holds a third of all rows is spread over 4,096 windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE_DIGITS = 3


def seeded_key(id_col: str, seed: str) -> Column:
    """md5 of the id as text and the seed; a null id counts as empty text."""
    return F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":" + seed)).cast("binary"))


def running_total(df: DataFrame, group: list[str], value: str, ties: list[str]) -> DataFrame:
    """Add ``_before`` (sum of ``value`` of earlier rows of the group) and ``_whole`` (group sum).

    The order within a group is (``_key``, ties). Rows equal in all of these are
    interchangeable. Group columns may be null; nulls form one group.
    """
    sliced = df.withColumn("_slice", F.substring("_key", 1, SLICE_DIGITS))
    by_slice = Window.partitionBy(*group).orderBy("_slice")
    sums = (sliced.groupBy(*group, "_slice").agg(F.sum(value).alias("_sum"))
            .withColumn("_upto", F.sum("_sum").over(by_slice))
            .withColumn("_whole", F.sum("_sum").over(Window.partitionBy(*group)))
            .select(*[F.col(g).alias(f"_s_{g}") for g in group], F.col("_slice").alias("_s_slice"),
                    (F.col("_upto") - F.col("_sum")).alias("_earlier"), "_whole"))
    on = F.col("_slice") == F.col("_s_slice")
    for g in group:
        on = on & F.col(g).eqNullSafe(F.col(f"_s_{g}"))
    within = (Window.partitionBy(*group, "_slice").orderBy("_key", *ties)
              .rowsBetween(Window.unboundedPreceding, 0))
    return (sliced.join(sums, on)
            .withColumn("_before", F.col("_earlier") + F.sum(value).over(within) - F.col(value))
            .drop("_slice", "_s_slice", "_earlier", *[f"_s_{g}" for g in group]))


def lowest(df: DataFrame, group: list[str], id_col: str, seed: str, most: int) -> DataFrame:
    """Of each group the rows with the ``most`` smallest hashed ids; only about twice as many are ranked.

    The hash is uniform, so the smallest ones are looked for in the lowest 2 * most / n + 20 / n share of
    its range. ``df`` needs distinct ids in a group; null ids are left out.
    """
    hashed = df.where(F.col(id_col).isNotNull()).withColumn("_h", F.xxhash64(F.col(id_col), F.lit(seed)))
    sizes = hashed.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    sizes = sizes.select(*[F.col(g).alias(f"_g_{g}") for g in group], "_n")
    on = F.lit(True)
    for g in group:
        on = on & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    share = (F.col("_h").cast("double") / 2.0 ** 64 + 0.5) * F.col("_n") <= 2 * most + 20
    order = Window.partitionBy(*group).orderBy("_h", id_col)
    return (hashed.join(sizes, on).where(share).withColumn("_nth", F.row_number().over(order))
            .where(F.col("_nth") <= most).drop("_h", "_n", "_nth", *[f"_g_{g}" for g in group]))
