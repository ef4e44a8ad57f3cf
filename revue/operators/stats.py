"""Review statistics: popularity rankings, per-user / per-product stats and lists,
global metrics, distributions, histograms, table profile and label search.

The dashboard computed these for one selected user or product; here every
operator is grouped by its key for the whole population (one plan, one pass),
and a caller narrows it with a semi join on the keys it wants.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revue.fixed import POPULAR_MIN_REVIEWS, TOP_K
from revue.functions.parse import epoch_to_date, label
from revue.operators import topk
from revue.operators.positions import rank_in_key

AVG_DIGITS = 6


def _avg(col: str = "rating") -> F.Column:
    return F.round(F.avg(col), AVG_DIGITS)


def product_ratings(reviews: DataFrame) -> DataFrame:
    """(product_id, title) -> review_count, avg_rating. Partial aggregation per task."""
    return reviews.groupBy("product_id", "title").agg(
        F.count("rating").alias("review_count"), _avg().alias("avg_rating"))


def popular_products(reviews: DataFrame, min_count: int = POPULAR_MIN_REVIEWS, k: int = TOP_K) -> DataFrame:
    """Best average rating among products with at least ``min_count`` reviews (ties by id)."""
    agg = product_ratings(reviews).where(F.col("review_count") >= min_count)
    return topk.global_(agg, [F.desc("avg_rating"), "product_id", "title"], k)


def top_products(reviews: DataFrame, k: int = TOP_K) -> DataFrame:
    """Best average rating, no minimum review count."""
    return popular_products(reviews, min_count=0, k=k)


def similar_by_rating(reviews: DataFrame, k: int = TOP_K) -> DataFrame:
    """The dashboard's "similar products": the best-rated (product, title) rows of products other than the selected one.

    Answer for every product at once, without pairing products: one without a row in the
    global top k gets that top k (``excluded_id`` null); one with a row there gets the top k of
    the rows of other products. A product has at most k rows that matter, so the best 2k of
    the rows cut to k a product are enough, whatever the data size.
    """
    order = [F.desc("avg_rating"), "product_id", "title"]
    capped = topk.per_key(product_ratings(reviews), ["product_id"], order, k, rank_col="own").drop("own")
    top = topk.global_(capped, order, 2 * k, rank_col="pos")
    general = top.where(F.col("pos") <= k).select(
        F.lit(None).cast("string").alias("excluded_id"), "product_id", "title",
        "review_count", "avg_rating", F.col("pos").alias("rank"))
    # At most k products x 2k rows, a constant.
    ex = top.where(F.col("pos") <= k).select(F.col("product_id").alias("excluded_id")).distinct()
    others = F.broadcast(ex).join(top, F.col("excluded_id") != F.col("product_id"))
    special = topk.per_key(others, ["excluded_id"], ["pos"], k)
    return general.unionByName(special.select("excluded_id", "product_id", "title", "review_count", "avg_rating", "rank"))


def _key_stats(reviews: DataFrame, key: str) -> DataFrame:
    return reviews.groupBy(key).agg(
        F.count("rating").alias("total_reviews"),
        _avg().alias("avg_rating"),
        F.max("review_time").alias("last_review_time"),
    ).withColumn("last_review_date", epoch_to_date("last_review_time"))


def user_stats(reviews: DataFrame) -> DataFrame:
    """Per user: number of reviews, average rating, last review time and date."""
    return _key_stats(reviews, "user_id")


def product_stats(reviews: DataFrame) -> DataFrame:
    """Per product: number of reviews, average rating, last review time and date."""
    return _key_stats(reviews, "product_id")


def _latest(reviews: DataFrame, key: str, cols: list[str], limit: int | None) -> DataFrame:
    # Ordering by every output column makes the kept multiset deterministic.
    order = [F.desc("review_time")] + [F.asc_nulls_last(c) for c in cols if c != "review_time"]
    rows = reviews.select(key, *[c for c in cols if c != key])
    if limit is None:  # all rows of a hot key: spread over the tasks
        out = rank_in_key(rows, [key], order, "rn").withColumn("rn", F.col("rn").cast("int"))
    else:  # at most ``limit`` rows a key and map task reach the window
        out = topk.per_key(rows, [key], order, limit, rank_col="rn")
    return out.withColumn("date", epoch_to_date("review_time"))


HISTORY_COLS = ["product_id", "title", "rating", "helpful_votes", "review_summary", "review_time"]
DETAIL_COLS = ["user_name", "rating", "helpful_votes", "review_summary", "review_text", "review_time"]


def user_history(reviews: DataFrame, limit: int | None = None) -> DataFrame:
    """Each user's reviews, newest first (at most ``limit`` if given), with a date column."""
    return _latest(reviews, "user_id", HISTORY_COLS, limit)


def product_reviews(reviews: DataFrame, limit: int | None = None) -> DataFrame:
    """Each product's reviews, newest first (at most ``limit`` if given), with a date column."""
    return _latest(reviews, "product_id", DETAIL_COLS, limit)


#: What the dashboard lists: the helpfulness as it was given, not the parsed number of votes.
DASHBOARD_COLS = ["product_id", "title", "rating", "helpfulness", "review_summary", "review_time"]


def dashboard_history(rows: DataFrame, limit: int | None = None) -> DataFrame:
    """As ``user_history``, for the rows of the dashboard's file."""
    return _latest(rows, "user_id", DASHBOARD_COLS, limit)


def rating_cards(reviews: DataFrame, key: str) -> DataFrame:
    """Per user or product the three texts of its card: number of reviews, average "4.2/5" to one place, last date."""
    return _key_stats(reviews, key).select(
        key, F.col("total_reviews").cast("string").alias("reviews"),
        F.coalesce(F.concat(F.format_number("avg_rating", 1), F.lit("/5")), F.lit("N/A")).alias("average"),
        F.col("last_review_date").alias("last_review"))


def global_metrics(reviews: DataFrame) -> DataFrame:
    """Distinct users, distinct products, number of ratings (one row)."""
    return reviews.agg(
        F.count_distinct("user_id").alias("users"),
        F.count_distinct("product_id").alias("products"),
        F.count(F.lit(1)).alias("ratings"),
    )


def rating_distribution(reviews: DataFrame, stars: int = 5) -> DataFrame:
    """Counts for the star values 1..stars, zeros kept; other values (0.8, 4.5) are not counted."""
    spark = reviews.sparkSession
    scale = spark.range(1, stars + 1).select(F.col("id").cast("int").alias("rating"))
    counts = reviews.groupBy("rating").agg(F.count(F.lit(1)).alias("count"))
    return (scale.join(counts, scale.rating == counts.rating, "left")
                 .select(scale.rating, F.coalesce(counts["count"], F.lit(0)).cast("long").alias("count"))
                 .orderBy("rating"))


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width histogram over [min, max] of the non-null values, every bin listed.

    min / max enter as one scalar subquery; the counting is a partial aggregation.
    """
    x = F.col(column)
    vals = df.select(x.cast("double").alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    # One scalar subquery (a struct) for both ends: a single extra pass over the input.
    rng = vals.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi"))).scalar()
    lo, hi = rng.getField("lo"), rng.getField("hi")
    width = (hi - lo) / F.lit(float(bins))
    b = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("x") - lo) / width), F.lit(bins - 1))).cast("int")
    counts = vals.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    spark = df.sparkSession
    edges = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (edges.join(counts, "bin", "left")
                 .select("bin",
                         F.round(lo + F.col("bin") * width, 6).alias("lower"),
                         F.round(lo + (F.col("bin") + 1) * width, 6).alias("upper"),
                         F.coalesce("count", F.lit(0)).cast("long").alias("count"))
                 .orderBy("bin"))


def profile_columns(df: DataFrame) -> DataFrame:
    """Per column: name, Spark type, row count, null count -- one aggregation pass."""
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for c in df.columns:
        aggs.append(F.sum(F.col(f"`{c}`").isNull().cast("long")).alias(f"n_{len(aggs)}"))
    wide = df.agg(*aggs)
    types = dict(df.dtypes)
    per_column = [F.struct(F.lit(c).alias("column_name"), F.lit(types[c]).alias("data_type"),
                           F.col(f"n_{i + 1}").alias("null_count")) for i, c in enumerate(df.columns)]
    return wide.select(F.col("__rows").alias("row_count"), F.inline(F.array(*per_column))).select(
        "column_name", "data_type", F.col("row_count").cast("long"), F.col("null_count").cast("long"))


def search_labels(df: DataFrame, key: str, name: str, term: str, regex: bool = False) -> DataFrame:
    """Distinct (key, name, 'name (key)') whose label contains ``term``, case ignored.

    ``regex=True`` treats the term as a Java regex (the dashboard used pandas'
    regex default); a null name never matches.
    """
    lab = label(name, key)
    pred = lab.rlike("(?i)" + term) if regex else F.lower(lab).contains(term.lower())
    return df.select(key, name).distinct().withColumn("label", lab).where(pred)


def review_dates(reviews: DataFrame) -> DataFrame:
    """Distinct review times with their date text."""
    return reviews.select("review_time").distinct().withColumn("date", epoch_to_date("review_time"))


def known_users(reviews: DataFrame, candidates: DataFrame) -> DataFrame:
    """Candidates that have at least one review (left semi join)."""
    return candidates.join(reviews.select("user_id"), "user_id", "left_semi")


__all__ = [n for n in dir() if not n.startswith("_") and n not in ("DataFrame", "F", "topk",
                                                                       "annotations", "epoch_to_date", "label")]
