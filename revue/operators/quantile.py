"""Exact quantiles by distributed selection: count ranges, keep the one that holds the rank, refine."""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 4096


def exact_quantile(df: DataFrame, column: str, q: float, bins: int = BINS) -> float | None:
    """The smallest value of ``column`` with at least a share ``q`` of the values at or below it; None without values.

    Nulls and NaN are no values. Each pass counts the values between two bounds in ``bins`` equal ranges, with map-side
    sums, and goes on with the extreme values of the range that holds the rank; at most ``bins`` rows a pass
    reach the driver. A pass narrows the bounds ``bins``-fold, so evenly spread prices take two or three. It reads
    ``column`` alone: pass a stored table.
    """
    x = F.col(column).cast("double")
    values = df.select(x.alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    whole = values.agg(F.count("x").alias("n"), F.min("x").alias("low"), F.max("x").alias("high")).first()
    if not whole["n"]:
        return None
    rank = max(1, math.ceil(Fraction(str(q)) * whole["n"]))  # 1-based, among the values within the bounds
    low, high = whole["low"], whole["high"]
    while low < high:
        # halves first: high - low can overflow
        place = (F.col("x") / 2 - low / 2) / (high / 2 - low / 2) * bins
        rows = (values.where(F.col("x").between(low, high))
                .groupBy(F.least(F.floor(place), F.lit(bins - 1)).alias("bin"))
                .agg(F.count("x").alias("n"), F.min("x").alias("low"), F.max("x").alias("high")).collect())
        for row in sorted(rows, key=lambda r: r["low"]):
            if rank <= row["n"]:
                if (row["low"], row["high"]) == (low, high):  # bounds that no division of doubles tells apart
                    return _walk(values, low, high, rank)
                low, high = row["low"], row["high"]
                break
            rank -= row["n"]
    return low


def _walk(values: DataFrame, low: float, high: float, rank: int) -> float:
    """The value of a rank between two bounds that lie a few representable numbers apart."""
    counts = values.where(F.col("x").between(low, high)).groupBy("x").agg(F.count("x").alias("n")).orderBy("x").collect()
    for row in counts:
        if rank <= row["n"]:
            return row["x"]
        rank -= row["n"]
    return high
