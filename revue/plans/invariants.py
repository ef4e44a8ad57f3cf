"""Queries with SQL beside those whose values depend on a model's initial factors.

Each one reads the whole result of its companion and states what must hold of it: which keys it has, how many rows,
that ranks run from 1 with falling scores, and that no row breaks the rule the result was made by.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revue.conf import run_once, scratch_path
from revue.operators import als as ALS
from revue.operators import clean as C
from revue.operators import recommend as R
from revue.operators import stats as S
from revue.plans import batch
from revue.plans import catalog as Q
from revue.plans import oracle as O
from revue.sources import io

TRAIN = f", tr as (select * from clean where {Q.SPLIT}), items as (select count(distinct product_id) as n from tr)"


def _lists(recs: DataFrame, key: str, extra: dict | None = None) -> DataFrame:
    """Per key the number of rows and whether ranks run from 1 with falling scores; ``extra`` are more aggregates."""
    earlier = Window.partitionBy(key).orderBy("rank")
    step = ((F.row_number().over(earlier) == F.col("rank"))
            & F.coalesce(F.lag("score").over(earlier) >= F.col("score"), F.lit(True)))
    more = [c.alias(n) for n, c in (extra or {}).items()]
    return (recs.withColumn("step", step).groupBy(key)
            .agg(F.count(F.lit(1)).alias("n_recs"), F.every("step").alias("ordered"), *more))


@Q.query("als_unseen_check", O.with_clean(TRAIN + """
 select user_id, least(max(items.n) - count(distinct product_id), 10) as n_recs, true as ordered, 0::bigint as seen
 from tr, items group by user_id having max(items.n) > count(distinct product_id)"""))
def als_unseen_check(spark, sf):
    """The lists without products already rated: the best ten of the others, however many were left out."""
    _, idx, train, _, model = Q._als_setup(spark, sf)
    own = train.select("user_id", "product_id").distinct().withColumn("hit", F.lit(1).cast("long"))
    recs = ALS.recommend_users(model, idx, 10, seen=own).join(own, ["user_id", "product_id"], "left")
    return _lists(recs, "user_id", {"seen": F.coalesce(F.sum("hit"), F.lit(0).cast("long"))})


@Q.query("als_item_rank_check", O.with_clean(TRAIN + """, users as (select count(distinct user_id) as n from tr)
 select product_id, least(users.n, 10) as n_recs, true as ordered from (select distinct product_id from tr) p, users"""))
def als_item_rank_check(spark, sf):
    return _lists(Q.q_als_item_recs(spark, sf), "product_id")


@Q.query("als_best_check", O.with_clean(Q.KNOWN_PAIRS + " select count(*) as n, 0::bigint as better from known"))
def als_best_check(spark, sf):
    """Of all known test pairs, those that score higher than the user's tenth product but are not listed: none."""
    _, _, _, test, model = Q._als_setup(spark, sf)
    recs = Q.q_als_user_recs(spark, sf)
    tenth = recs.groupBy("user_id").agg(F.min("score").alias("least"))
    listed = recs.select("user_id", "product_id", F.lit(True).alias("listed"))
    better = (F.col("prediction") > F.col("least") + 1e-5) & F.col("listed").isNull()
    return (ALS.predict(model, test).join(tenth, "user_id").join(listed, ["user_id", "product_id"], "left")
            .agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce(better, F.lit(False)).cast("long")).alias("better")))


@Q.query("als_subset_check", O.with_clean(TRAIN + """
 select user_id, least(max(items.n), 10) as n_recs, true as ordered, true as titled
 from tr, items where user_id like '%7' group by user_id"""))
def als_subset_check(spark, sf):
    recs = Q.q_als_subset_recs(spark, sf)
    return _lists(recs, "user_id", {"titled": F.every(F.col("title").isNotNull() & F.col("price").isNotNull())})


@Q.query("als_metrics_check", O.with_clean(Q.KNOWN_PAIRS + """
 select 'served' as setting, count(*) as n, true as sane from known union all select 'batch', count(*), true from known"""))
def als_metrics_check(spark, sf):
    """Both settings measure every known test pair; the served one errs less than the ratings vary."""
    _, _, _, test, _ = Q._als_setup(spark, sf)
    spread = test.agg(F.stddev("rating")).scalar()
    sane = (F.col("mae") <= F.col("rmse")) & (F.col("mae") > 0)
    served = Q.q_als_metrics(spark, sf).select(F.lit("served").alias("setting"), "n", (sane & (F.col("rmse") < spread)).alias("sane"))
    return served.union(Q.q_als_metrics_batch(spark, sf).select(F.lit("batch"), "n", sane))


@Q.query("als_tuning_check", O.with_clean("""
, b as (select user_id, product_id, cast(concat('0x', substr(md5(concat(user_id, '#', product_id)), 1, 8)) as bigint) % 100 as b from clean)
 select count(*) as n_test, true as in_grid, true as sane from b where b >= 80
 and user_id in (select user_id from b where b < 60) and product_id in (select product_id from b where b < 60)"""))
def als_tuning_check(spark, sf):
    """The stored best model measures every known pair of the test part."""
    grid = ALS.FULL_GRID
    in_grid = F.col("rank").isin(grid["rank"]) & F.col("reg_param").isin(grid["regParam"]) & F.col("max_iter").isin(grid["maxIter"])
    return Q.q_als_tuning(spark, sf).select("n_test", in_grid.alias("in_grid"), (F.col("test_mae") <= F.col("test_rmse")).alias("sane"))


@Q.query("dashboard_check", O.with_clean("""
 select user_id, least((select count(distinct product_id) from clean), 10) as n_recs, true as ordered, true as titled
 from clean group by user_id"""))
def dashboard_check(spark, sf):
    return _lists(Q.q_dashboard_recs(spark, sf), "user_id", {"titled": F.every(F.col("title").isNotNull())})


@Q.query("hybrid_check", O.with_clean(TRAIN + """
 select user_id, least(max(items.n), 10) as n_recs, true as ordered, 0::bigint as wrong from tr, items group by user_id"""))
def hybrid_check(spark, sf):
    """Per user of the model: ten rows; content scores are those of the content list, in full, and blend as they should."""
    _, _, train, _, _ = Q._als_setup(spark, sf)
    content = R.normalise_by_user_max(Q.content_top(spark, sf, 20), "total_score", "expected")
    recs = Q.q_hybrid_recs(spark, sf).join(content.select("user_id", "product_id", "expected"), ["user_id", "product_id"], "left")
    right = ((F.abs(F.col("content_score") - F.coalesce("expected", F.lit(0.0))) < 1e-9) & F.col("als_score").isin(0.0, 1.0)
             & (F.abs(F.col("hybrid_score") - 0.7 * F.col("als_score") - 0.3 * F.col("content_score")) < 1e-8))
    recs = recs.withColumn("score", F.col("hybrid_score")).join(train.select("user_id").distinct(), "user_id", "left_semi")
    return _lists(recs, "user_id", {"wrong": F.sum((~right).cast("long"))})


@Q.query("lsh_check", O.with_clean(Q.SIM_CTES + """, listed as (select distinct p1 from sim where sim > 0.1)
 select count(*) as products, 0::bigint as wrong, true as recalled from listed"""))
def lsh_check(spark, sf):
    """The LSH lists against the exact ones: listed products, rows that are in no exact list, recall of at least 0.9.

    Lists of both sides are compared as class rows, each counted as the product pairs it stands for: groups of copies have as many
    pairs as the square of their products, and all pairs of a row have one similarity.
    """
    exact = Q.class_pairs(spark, sf).select("product1", "class_id", F.col("similarity").alias("exact"), F.col("pairs").alias("n_exact"))
    near = Q.lsh_class_pairs(spark, sf).select("product1", "class_id", "similarity", "pairs")
    both = exact.join(near, ["product1", "class_id"], "full")
    cut = exact.groupBy("product1").agg(F.min("exact").alias("least"))
    # an LSH row outside of the exact list must be below its last similarity: LSH missed a better one
    odd = F.coalesce(F.abs(F.col("exact") - F.col("similarity")) > 1e-6, F.col("exact").isNull() & (F.col("similarity") > F.col("least") + 1e-6))
    pairs = F.coalesce("n_exact", "pairs")
    return both.join(cut, "product1").agg(
        F.count_distinct("product1").alias("products"), F.sum(F.when(odd, pairs).otherwise(0)).alias("wrong"),
        (F.sum(F.when(F.col("exact").isNotNull() & F.col("similarity").isNotNull(), pairs).otherwise(0))
         >= 0.9 * F.sum("n_exact")).alias("recalled"))


# ---------------------------------------------------------------- unknown users, stored models

FOLD = f"""{TRAIN}, known as (select distinct user_id from tr),
 asked as (select distinct user_id from raw),
 newer as (select distinct user_id from parsed where rating is not null and user_id not in (select user_id from known)
           and product_id in (select product_id from tr)),
 pop as (select count(*) as n from (select 1 from ({Q.PR}) p where review_count >= 10 limit 10) q)"""


def _with_fold_in(spark, sf) -> DataFrame:
    c, idx, _, _, model = Q._als_setup(spark, sf)
    everyone = Q.raw(spark, sf).select("user_id").distinct()
    known = model.userFactors.join(idx.users, F.col("id") == F.col("user_index")).select("user_id")
    trained = ALS.LoadedIndex(idx.users.join(known, "user_id", "left_semi"), idx.items)
    ratings = C.parse_reviews(Q.raw(spark, sf), Q.FRACTION_SCALE).select("user_id", "product_id", "rating")
    personal = ALS.recommend_users(model, trained, 10).withColumn("source", F.lit("personal"))
    folded = ALS.recommend_new_users(model, trained, ratings, 10).withColumn("source", F.lit("folded in"))
    return R.with_fallback(everyone, personal.unionByName(folded), S.popular_products(c), 10)


@Q.query("recs_with_fold_in")
def recs_with_fold_in(spark, sf):
    """Every user: the model's list, a folded-in one for users it was not trained on who rated something, else the popular one."""
    return _with_fold_in(spark, sf)


@Q.query("fold_in_check", O.with_clean(FOLD + """
 select user_id, case when user_id in (select user_id from known) then 'personal'
                      when user_id in (select user_id from newer) then 'folded in' else 'popular' end as source,
        case when user_id in (select user_id from known) or user_id in (select user_id from newer)
             then least(items.n, 10) else pop.n end as n_recs, true as ordered
 from asked, items, pop"""))
def fold_in_check(spark, sf):
    return _lists(_with_fold_in(spark, sf), "user_id", {"source": F.first("source")})


@Q.query("als_stored_check", O.with_clean("""
 select user_id, least((select count(distinct product_id) from clean), 10) as n_recs, true as ordered, 0::bigint as differ
 from clean group by user_id"""))
def als_stored_check(spark, sf):
    """Trained on all reviews, stored with both indices, loaded and served: the lists of the model that was stored."""
    folder = scratch_path(spark, "stored-model")
    reviews = Q._ratings(spark, sf)
    paths = batch.train_and_save_models(spark, reviews, folder)
    index = ALS.LoadedIndex(spark.read.parquet(paths[batch.USERS]), spark.read.parquet(paths[batch.ITEMS]))
    stored = ALS.recommend_users(ALS.load(paths[batch.MODEL]), index, 10)
    fresh = ALS.recommend_users(ALS.load(paths[batch.MODEL]), ALS.Indexed(reviews), 10)
    other = fresh.select("user_id", "product_id", F.col("rank").alias("again"))
    rows = stored.join(other, ["user_id", "product_id"], "left")
    return _lists(rows, "user_id", {"differ": F.sum((~F.col("rank").eqNullSafe(F.col("again"))).cast("long"))})


#: Reviews before this second make the first index of ``index_extended``.
FIRST_INDEX_UNTIL = 705_000_000


@Q.query("index_extended", O.with_clean(f"""
, old as (select product_id, count(*) as n from clean where review_time < {FIRST_INDEX_UNTIL} group by 1),
 new as (select product_id, count(*) as n from clean where product_id not in (select product_id from old) group by 1)
 select product_id, cast(row_number() over (order by n desc, product_id) - 1 as int) as item_index, n as frequency from old union all
 select product_id, cast((select count(*) from old) + row_number() over (order by n desc, product_id) - 1 as int), n from new"""))
def index_extended(spark, sf):
    """An index stored early, then extended by later reviews: old numbers stay, new ones follow."""
    c = Q.clean(spark, sf).select("product_id", "review_time")
    path = io.write_parquet(ALS.index_keys(c.where(F.col("review_time") < FIRST_INDEX_UNTIL), "product_id", "item_index"),
                            scratch_path(spark, "first-index"))
    return ALS.extend_index(spark.read.parquet(path), c, "product_id", "item_index")


# ---------------------------------------------------------------- the dashboard's file and texts

DASHBOARD = """, dash as (select user_id, user_name, product_id, title, cast(try_cast(raw_rating as float) as double) as rating, helpfulness,
  review_summary, review_text, review_time from raw
 where try_cast(raw_rating as float) is not null and product_id is not null and user_id is not null)"""


def dashboard_file(spark, sf) -> DataFrame:
    """The reviews written as the dashboard's nine-column CSV and read by its reader."""
    names = [c.split()[0] for c in io.DASHBOARD_CSV.split(", ")]
    rows = Q.raw(spark, sf).withColumnRenamed("raw_rating", "rating").select(*names)
    return io.read_dashboard_csv(spark, io.write_csv(rows, scratch_path(spark, "dashboard-csv")))


@Q.query("dashboard_csv", O.with_parsed(DASHBOARD + " select * from dash"))
def dashboard_csv(spark, sf):
    return dashboard_file(spark, sf)


def _history_order() -> str:
    return ", ".join(["review_time desc"] + [f"{c} asc nulls last" for c in S.DASHBOARD_COLS if c != "review_time"])


@Q.query("dashboard_history", O.with_parsed(DASHBOARD + f"""
 select user_id, {', '.join(S.DASHBOARD_COLS)}, {O.date_expr('review_time')} as date,
  cast(row_number() over (partition by user_id order by {_history_order()}) as int) as rn from dash"""))
def dashboard_history(spark, sf):
    """Whole histories with the helpfulness as it was written."""
    return S.dashboard_history(dashboard_file(spark, sf))


def _cards_sql(key: str) -> str:
    return O.with_clean(f"""select {key}, count(rating)::varchar as reviews,
 case when avg(rating) is null then 'N/A' else printf('%.1f', round(avg(rating), 6)) || '/5' end as average,
 {O.date_expr('max(review_time)')} as last_review from clean group by 1""")


@Q.query("user_cards", _cards_sql("user_id"))
def user_cards(spark, sf):
    return S.rating_cards(Q.clean(spark, sf), "user_id")


@Q.query("product_cards", _cards_sql("product_id"))
def product_cards(spark, sf):
    return S.rating_cards(Q.clean(spark, sf), "product_id")


EXPORTS = {
    "user_history": lambda spark, sf: Q.q_user_history(spark, sf),
    "product_reviews": lambda spark, sf: Q.q_product_reviews(spark, sf),
    "content_recs": lambda spark, sf: Q.q_content_recs(spark, sf),
    "similar_items_top": lambda spark, sf: Q.q_similar_items_top(spark, sf),
    "rating_distribution": lambda spark, sf: Q.q_rating_distribution(spark, sf),
    "top_products": lambda spark, sf: Q.q_top_products(spark, sf),
}


def _exports_sql() -> str:
    counts = {
        "user_history": "select count(*) from clean", "product_reviews": "select count(*) from clean",
        "content_recs": "select count(*) from crk where rank <= 10", "similar_items_top": "select count(*) from simitems",
        "rating_distribution": "select 5", "top_products": "select count(*) from (select 1 from clean group by product_id, title limit 10) t"}
    return O.with_clean(Q.CONTENT_CTES + " union all ".join(
        f" select '{name}' as report, ({sql})::bigint as rows, 0::bigint as changed" for name, sql in counts.items()))


@Q.query("export_reports", _exports_sql())
def export_reports(spark, sf):
    """Every report of the dashboard exported as CSV and read back: rows, and rows that came back changed.

    The files are gzipped and stay; the shuffle files of a report go when its rows have been compared.
    """
    out = None
    for name, report in EXPORTS.items():
        df = report(spark, sf)
        back = io.export_table(spark, df, scratch_path(spark, f"export-{name}"), compression="gzip")
        with run_once(spark):
            changed = df.exceptAll(back).count()
        row = back.agg(F.lit(name).alias("report"), F.count(F.lit(1)).alias("rows"), F.lit(changed).cast("long").alias("changed"))
        out = row if out is None else out.union(row)
    return out
