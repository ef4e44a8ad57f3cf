"""Exact quantiles: equal to a sort, for few and many distinct values and awkward ranges."""

import math
import random
from fractions import Fraction

import duckdb
import pytest
from pyspark.sql import functions as F

from revue.operators.quantile import exact_quantile


def plain(values, q):
    own = sorted(v for v in values if v is not None and not math.isnan(v))
    return own[max(1, math.ceil(Fraction(str(q)) * len(own))) - 1] if own else None


@pytest.mark.parametrize("bins", [2, 7, 4096])
@pytest.mark.parametrize("name,values", [
    ("few", [1.0, 2.0, 2.0, None, 3.0, float("nan")]), ("one", [5.0] * 9), ("none", [None, float("nan")]),
    ("signs", [-3.5, 0.0, -0.0, 7.25, -3.5, 1e-300]), ("wide", [1e-308, 1.0, 1e308, -1e308, 2.0]),
    ("neighbours", [1.0, math.nextafter(1.0, 2), math.nextafter(math.nextafter(1.0, 2), 2)] * 3),
    ("random", [random.Random(1).uniform(0, 50) for _ in range(301)])])
def test_equals_a_sort(spark, name, values, bins):
    df = spark.createDataFrame([(v,) for v in values], "price double").repartition(3)
    for q in (0.5, 0.0, 0.1, 0.999, 1.0) if name != "wide" else (0.5,):
        assert exact_quantile(df, "price", q, bins) == plain(values, q)


def test_a_million_distinct_prices(spark):
    df = spark.range(1_000_001).select((F.sqrt(F.col("id").cast("double")) * 3.7 + F.pmod(F.col("id") * 7919, F.lit(1000)) / 10).alias("price"))
    assert exact_quantile(df, "price", 0.5) == sorted(r[0] for r in df.collect())[500_000]


def test_equals_duckdb(spark):
    path = "/root/testdata/sf0.1/part.parquet"
    want = duckdb.sql(f"select quantile_disc(p_retailprice, 0.5) from '{path}'").fetchall()[0][0]
    assert exact_quantile(spark.read.parquet(path), "p_retailprice", 0.5) == float(want)
