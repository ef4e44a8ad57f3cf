"""Cleaning: raw review strings -> typed fact table, product catalogs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revue.fixed import MEDIAN_QUANTILE, MIN_PRODUCT_REVIEWS, MIN_USER_REVIEWS
from revue.functions.parse import parse_helpfulness, parse_price, parse_rating
from revue.operators.quantile import exact_quantile

KEEP = ["user_id", "product_id", "title", "user_name", "review_time", "review_summary", "review_text"]
CLEAN_COLUMNS = KEEP + ["price", "rating", "helpful_votes"]


def parse_reviews(raw: DataFrame, fraction_scale: float = 1.0) -> DataFrame:
    """Typed columns from the raw strings (narrow projection, no shuffle)."""
    keep = [c for c in KEEP if c in raw.columns]
    return raw.select(
        *keep,
        parse_price("raw_price").alias("price"),
        parse_rating("raw_rating", fraction_scale).alias("rating"),
        parse_helpfulness("helpfulness").alias("helpful_votes"),
    )


def median_price(reviews: DataFrame) -> DataFrame:
    """One row: the median of the non-null prices (the lower middle one), 0.0 when there is none; exact."""
    return reviews.sparkSession.createDataFrame([(_median(reviews),)], "median_price double")


def _median(reviews: DataFrame) -> float:
    found = exact_quantile(reviews, "price", MEDIAN_QUANTILE)
    return 0.0 if found is None else found


def valid_ratings(df: DataFrame) -> DataFrame:
    """Dashboard load: rating as float (widened back to double), drop null / NaN rating and null keys."""
    r = F.col("rating").cast("float").cast("double")
    return (df.withColumn("rating", r)
              .where(~F.isnan("rating") & F.col("rating").isNotNull())
              .dropna(subset=["product_id", "user_id", "rating"]))


def clean_reviews(parsed: DataFrame, min_user_reviews: int = MIN_USER_REVIEWS,
                  min_product_reviews: int = MIN_PRODUCT_REVIEWS,
                  fill_price: bool = True, materialize: bool = True, base_path: str | None = None) -> DataFrame:
    """Null drop, median price fill, activity filter (counts taken once, after the null drop).

    The null-dropped table feeds four readers (median, user counts, product
    counts, the filtered output); with ``materialize`` the rows are written once (Parquet,
    shared scratch folder, at ``base_path`` if the caller means to delete it after use)
    instead of re-running the scan and joins behind it for each reader. Nulls are dropped from the written
    rows: a filter ahead of the write would be pushed into the joins, where every mention of the rating is its whole
    parsing expression once more. The median is selected from
    it in two or three passes over the price column. The activity filter is two left-semi joins against grouped key sets:
    map-side partial counts, and AQE may broadcast the key sets or split skewed
    fact partitions.
    """
    d = parsed
    if materialize:
        # Parquet rather than checkpoint(): at scale this is the whole fact table, and
        # three of its four readers need only key / price columns (column pruning).
        from revue.conf import scratch_path, write
        path = base_path or scratch_path(d.sparkSession, "clean-input")
        d = d.sparkSession.read.parquet(write(d, path))
    d = d.dropna(subset=["user_id", "product_id", "rating"])
    if fill_price:
        d = d.withColumn("price", F.coalesce(F.col("price"), F.lit(_median(d))))
    users = (d.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
              .where(F.col("n") >= min_user_reviews).select("user_id"))
    products = (d.groupBy("product_id").agg(F.count(F.lit(1)).alias("n"))
                 .where(F.col("n") >= min_product_reviews).select("product_id"))
    out = d.join(users, "user_id", "left_semi").join(products, "product_id", "left_semi")
    return out.select(*[c for c in CLEAN_COLUMNS if c in out.columns])


def product_catalog(clean: DataFrame) -> DataFrame:
    """Distinct (product_id, title, price) triples, as the reference stores them."""
    return clean.select("product_id", "title", "price").distinct()


def catalog_lookup(clean: DataFrame) -> DataFrame:
    """One row per product for joins that must not multiply rows: its most-reviewed
    (title, price), then the lowest price, then the smallest title.

    Partial counts per (product, title, price), then a per-product top-1 (a partial
    WindowGroupLimit runs before the shuffle).
    """
    from revue.operators import topk
    triples = clean.groupBy("product_id", "title", "price").agg(F.count(F.lit(1)).alias("n"))
    best = topk.per_key(triples, ["product_id"],
                        [F.desc("n"), F.asc_nulls_last("price"), F.asc_nulls_last("title")], 1, rank_col="r")
    return best.select("product_id", "title", "price")
