"""Top-k helpers that stay distributed.

``per_key`` uses ``row_number`` / ``rank`` with a ``<= k`` filter; Spark turns that
into a partial ``WindowGroupLimit`` before the shuffle, so a hot key ships at most
k rows per map task; with ``k`` None all rows are ranked. ``global_`` is ``orderBy + limit`` (TakeOrderedAndProject:
per-task top-k, one small merge).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def per_key(df: DataFrame, keys: list[str], order: list[Column], k: int | None,
            ties: str = "row_number", rank_col: str = "rank") -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    fn = {"row_number": F.row_number(), "rank": F.rank(), "dense_rank": F.dense_rank()}[ties]
    ranked = df.withColumn(rank_col, fn.over(w))
    return ranked if k is None else ranked.where(F.col(rank_col) <= k)


def global_(df: DataFrame, order: list[Column], k: int, rank_col: str | None = "rank") -> DataFrame:
    top = df.orderBy(*order).limit(k)
    if rank_col:
        # k rows only: a single-partition window over the limited result is bounded.
        top = top.withColumn(rank_col, F.row_number().over(Window.orderBy(*order)))
    return top
