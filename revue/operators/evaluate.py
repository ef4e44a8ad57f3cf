"""Splits and error metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revue.fixed import SEED
from revue.operators.als import hash_bucket, hash_split_flag


def hash_split(df: DataFrame, train_pct: int = 80) -> tuple[DataFrame, DataFrame]:
    """Deterministic (train, test) split on md5(user_id#product_id); stable under repartition."""
    flag = hash_split_flag(train_pct=train_pct)
    return df.where(flag), df.where(~flag)


def random_split(df: DataFrame, weights: list[float], seed: int = SEED) -> list[DataFrame]:
    """Spark's Bernoulli split (as the reference); depends on partitioning."""
    return df.randomSplit(weights, seed)


def error_metrics(pred: DataFrame, label: str = "rating", prediction: str = "prediction") -> DataFrame:
    """One row: rmse, mae, n over rows with a non-null prediction (single partial-aggregate pass)."""
    p = pred.where(F.col(prediction).isNotNull())
    err = F.col(label) - F.col(prediction)
    return p.agg(F.sqrt(F.avg(err * err)).alias("rmse"), F.avg(F.abs(err)).alias("mae"),
                 F.count(F.lit(1)).alias("n"))


def product_mean_predictions(train: DataFrame, test: DataFrame) -> DataFrame:
    """Baseline predictor: the product's mean training rating (unknown products dropped)."""
    means = train.groupBy("product_id").agg(F.avg("rating").alias("prediction"))
    return test.join(means, "product_id")


def residuals(pred: DataFrame) -> DataFrame:
    return pred.withColumn("residual", F.col("rating") - F.col("prediction"))


def sample_reviews(df: DataFrame, fraction: float, seed: int = SEED) -> DataFrame:
    """Sample of about ``fraction`` of the rows: those whose md5 bucket of (user_id, product_id, seed) is low.

    The caller names the fraction; the draw does not depend on the number of rows or on partitioning.
    """
    key = F.concat_ws("#", "user_id", "product_id", F.lit(str(seed)))
    bucket = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long") % 10_000
    return df.where(bucket < int(fraction * 10_000))


def three_way_split(df: DataFrame, train_pct: int = 60, valid_pct: int = 20) -> list[DataFrame]:
    """Deterministic (train, validation, test) on md5(user_id#product_id); stable under repartition."""
    bucket = hash_bucket()
    return [df.where(bucket < train_pct), df.where((bucket >= train_pct) & (bucket < train_pct + valid_pct)),
            df.where(bucket >= train_pct + valid_pct)]
