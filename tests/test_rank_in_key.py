"""Ranks within a key from one range-partitioned order: brute force, hot keys over many tasks, nulls, ties."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from revue.operators import stats as S
from revue.operators.positions import rank_in_key


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(1)
    out = [(rng.choice(["a", "hot", "hot", "hot", None, "z"] + [f"k{i}" for i in range(40)]), i, rng.randrange(50)) for i in range(4000)]
    out += [("hot", i, i % 50) for i in range(4000, 8000)]
    return spark.createDataFrame(out, "k string, id int, v int").repartition(7)


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_equals_row_number(rows, partitions):
    order = [F.desc("v"), F.asc("id")]
    want = rows.withColumn("rank", F.row_number().over(Window.partitionBy("k").orderBy(*order)).cast("long"))
    got = rank_in_key(rows, ["k"], order, partitions=partitions)
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_two_keys_and_no_rows(rows):
    order = [F.asc("id")]
    two = rows.withColumn("half", F.col("id") % 2)
    want = two.withColumn("rank", F.row_number().over(Window.partitionBy("k", "half").orderBy(*order)).cast("long"))
    got = rank_in_key(two, ["k", "half"], order, partitions=9)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert rank_in_key(rows.where("id < 0"), ["k"], order).count() == 0


def test_rows_that_are_all_alike_spread(spark):
    df = spark.range(6000).select(F.lit("u").alias("k"), F.lit(1).alias("v")).repartition(5)
    got = rank_in_key(df, ["k"], [F.asc("v")], partitions=12)
    assert sorted(r["rank"] for r in got.collect()) == list(range(1, 6001))


def test_a_hot_user_spreads_over_the_tasks(spark):
    """A user with half of the rows: no task of the window gets more than a few partitions' worth."""
    df = spark.range(40_000).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("u"), F.col("id") % 300)).alias("user_id"),
        F.concat(F.lit("p"), F.col("id")).alias("product_id"), F.lit("t").alias("title"), F.lit(4.0).alias("rating"),
        F.lit(1).alias("helpful_votes"), F.lit("s").alias("review_summary"), (F.col("id") % 997).alias("review_time"))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = S.user_history(df)
        sizes = [r["n"] for r in got.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert sum(sizes) == 40_000 and max(sizes) < 20_000 * 0.8 and len(sizes) >= partitions - 3
        hot = [r["rn"] for r in got.where("user_id = 'hot'").orderBy("rn").collect()]
        assert hot == list(range(1, 20_001))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_history_order(spark):
    df = spark.createDataFrame([("u", "p1", "t", 5.0, 1, "s", 86400), ("u", "p2", "t", 4.0, None, "s", 2 * 86400), ("v", "p1", "t", 1.0, 0, None, None)],
                               "user_id string, product_id string, title string, rating double, helpful_votes int, review_summary string, review_time long")
    got = {(r["user_id"], r["rn"]): (r["product_id"], r["date"]) for r in S.user_history(df).collect()}
    assert got == {("u", 1): ("p2", "03/01/1970"), ("u", 2): ("p1", "02/01/1970"), ("v", 1): ("p1", "N/A")}
