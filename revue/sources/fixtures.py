"""Review records derived from the driver's TPC-H-like tables.

One line item is one review: user = order customer, product = part, title =
part name, time = ship date. Raw price / score / helpfulness strings carry the
malformed shapes the cleaning step must handle (currency signs, 'unknown',
'1.2.3', 'a/0', 'bad', 'n/a'). The rules are plain functions of the keys, so the
derived table grows with the input tables and an SQL oracle can rebuild it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RAW_COLUMNS = ["user_id", "product_id", "title", "user_name", "raw_price", "raw_rating",
               "helpfulness", "review_time", "review_summary", "review_text"]

# Column names of the original review CSV (fixed values of the source format).
CSV_NAMES = {
    "user_id": "review/userId",
    "product_id": "product/productId",
    "title": "product/title",
    "raw_price": "product/price",
    "raw_rating": "review/score",
    "helpfulness": "review/helpfulness",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw review strings, one row per line item (all string columns but review_time)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag",
        "l_linestatus", "l_shipdate")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    pt = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_name")

    # lineitem x orders is a large-large join at any real scale: say so (sort-merge,
    # which spills, rather than an in-memory hash build) instead of letting a small
    # sample broadcast it, which would also pin the parse / clean pipeline to the
    # scan's tasks. Customers are joined to the orders, which are several times fewer than the line items.
    named = od.join(cu, od.o_custkey == cu.c_custkey)
    j = (li.join(named.hint("merge"), li.l_orderkey == named.o_orderkey)
           .join(pt, li.l_partkey == pt.p_partkey))

    pk, ok = F.col("l_partkey"), F.col("l_orderkey")
    price_txt = F.col("p_retailprice").cast("string")
    stars = (F.lit(1) + (F.col("o_custkey") + F.lit(2) * pk) % 5).cast("string")
    parts = F.when(ok % 3 == 0, F.lit(5)).when(ok % 3 == 1, F.lit(3)).otherwise(F.lit(7))
    share = F.concat((F.lit(1) + (F.col("o_custkey") + F.lit(2) * pk) % parts).cast("string"), F.lit("/"),
                     parts.cast("string"))
    epoch = F.expr("cast(timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', "
                   "cast(l_shipdate as timestamp_ntz)) as bigint)")
    return j.select(
        F.concat(F.lit("U"), F.col("o_custkey").cast("string")).alias("user_id"),
        F.concat(F.lit("P"), pk.cast("string")).alias("product_id"),
        F.col("p_name").alias("title"),
        F.col("c_name").alias("user_name"),
        F.when(pk % 11 == 0, F.lit("unknown"))
         .when(pk % 11 == 1, F.lit(""))
         .when(pk % 11 == 2, F.lit(None).cast("string"))
         .when(pk % 11 == 3, F.concat(F.lit("$"), price_txt))
         .when(pk % 11 == 4, F.lit("1.2.3"))
         .otherwise(price_txt).alias("raw_price"),
        F.when(ok % 101 == 0, F.lit("bad"))
         .when(ok % 103 == 0, F.concat(stars, F.lit("/0")))
         .when(F.col("l_linenumber") == 7, share)
         .otherwise(F.concat(stars, F.lit(".0"))).alias("raw_rating"),
        F.when(F.col("l_linenumber") == 6, F.lit("n/a"))
         .otherwise(F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit("/50")))
         .alias("helpfulness"),
        epoch.alias("review_time"),
        F.concat(F.col("l_returnflag"), F.col("l_linestatus")).alias("review_summary"),
        F.col("o_orderpriority").alias("review_text"),
    )


def raw_csv_frame(raw: DataFrame) -> DataFrame:
    """The raw table under the review CSV's own column names (all strings)."""
    return raw.select(*[F.col(k).cast("string").alias(v) for k, v in CSV_NAMES.items()])
