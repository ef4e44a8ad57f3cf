"""Query catalogue: name -> (spark, sf_dir) -> DataFrame, plus the DuckDB oracle text.

Every query reads the driver tables of ``sf_dir`` (through the review fixture) and
processes them whole. Queries without an oracle depend on a random draw or a
model initialisation and are checked on rows only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revue.fixed import FRACTION_SCALE, HISTOGRAM_BINS, SAMPLE_FRACTION
from revue.operators import clean as C
from revue.operators import stats as S
from revue.plans import oracle as O
from revue.sources import fixtures, io

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------- shared frames

def raw(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.raw_reviews(spark, sf)


def parsed(spark: SparkSession, sf: str) -> DataFrame:
    return C.parse_reviews(raw(spark, sf))


FACT_TABLES = ["lineitem", "orders", "part", "customer"]


def clean(spark: SparkSession, sf: str, min_user: int = 5, min_product: int = 10) -> DataFrame:
    """Cleaned reviews: a stage table, built once per session and input."""
    from revue.plans.stages import shared
    return shared(spark, sf, FACT_TABLES, "clean", (min_user, min_product),
                  lambda: _cleaned(spark, parsed(spark, sf), min_user, min_product), table=False)


def _cleaned(spark: SparkSession, rows: DataFrame, *limits: int) -> DataFrame:
    """The cleaned table, written; the parsed copy behind it is deleted once it has been read."""
    from revue.conf import materialize, remove, scratch_path
    base = scratch_path(spark, "clean-input")
    out = materialize(C.clean_reviews(rows, *limits, base_path=base), "clean")
    remove(spark, base)
    return out


RAW_COLS = ", ".join(fixtures.RAW_COLUMNS)
CLEAN_COLS = ", ".join(C.CLEAN_COLUMNS)

# ---------------------------------------------------------------- sources / sinks


@query("scan_reviews", O.with_parsed(f"select {RAW_COLS} from raw"))
def q_scan_reviews(spark, sf):
    return raw(spark, sf)


@query("csv_round_trip", O.with_parsed(
    "select user_id, product_id, title, raw_price, raw_rating, helpfulness from raw"))
def q_csv_round_trip(spark, sf):
    back = io.csv_round_trip(spark, fixtures.raw_csv_frame(raw(spark, sf)))
    return io.raw_from_csv(back)


@query("parquet_round_trip", O.with_clean(f"select {CLEAN_COLS} from clean"))
def q_parquet_round_trip(spark, sf):
    return io.parquet_round_trip(spark, clean(spark, sf))


@query("load_guard", O.with_clean(f"select {CLEAN_COLS} from clean"))
def q_load_guard(spark, sf):
    from revue.conf import scratch_path
    c = clean(spark, sf)
    paths = {"reviews": io.write_parquet(c, scratch_path(spark, "reviews")),
             "catalog": io.write_parquet(C.product_catalog(c), scratch_path(spark, "catalog"))}
    tables = io.checked_load(spark, paths, {"reviews": C.CLEAN_COLUMNS,
                                            "catalog": ["product_id", "title", "price"]})
    return tables["reviews"]


@query("export_sample", O.with_clean(f"select {CLEAN_COLS} from clean"))
def q_export_sample(spark, sf):
    """The whole cleaned table through its CSV export."""
    from revue.conf import scratch_path
    return io.export_table(spark, clean(spark, sf), scratch_path(spark, "export"))


# ---------------------------------------------------------------- cleaning


@query("clean_reviews", O.with_clean(f"select {CLEAN_COLS} from clean"))
def q_clean_reviews(spark, sf):
    return clean(spark, sf)


@query("active_popular", O.with_clean(f"select {CLEAN_COLS} from clean", 40, 30))
def q_active_popular(spark, sf):
    return clean(spark, sf, 40, 30)


@query("product_catalog", O.with_clean("select distinct product_id, title, price from clean"))
def q_product_catalog(spark, sf):
    return C.product_catalog(clean(spark, sf))


@query("median_price_fill", O.with_parsed(
    "select coalesce(quantile_disc(price, 0.5), 0.0) as median_price from parsed "
    "where rating is not null and user_id is not null and product_id is not null and price is not null"))
def q_median_price_fill(spark, sf):
    from revue.conf import materialize
    prices = parsed(spark, sf).dropna(subset=["user_id", "product_id", "rating"]).select("price")
    return C.median_price(materialize(prices, "prices"))


@query("parse_price", O.with_parsed("select distinct raw_price, price from parsed"))
def q_parse_price(spark, sf):
    r = raw(spark, sf)
    return r.select("raw_price", C.parse_price("raw_price").alias("price")).distinct()


@query("parse_rating", O.with_parsed("select distinct raw_rating, rating from parsed"))
def q_parse_rating(spark, sf):
    r = raw(spark, sf)
    return r.select("raw_rating", C.parse_rating("raw_rating").alias("rating")).distinct()


@query("parse_helpfulness", O.with_parsed("select distinct helpfulness, helpful_votes from parsed"))
def q_parse_helpfulness(spark, sf):
    r = raw(spark, sf)
    return r.select("helpfulness", C.parse_helpfulness("helpfulness").alias("helpful_votes")).distinct()


@query("valid_ratings", O.with_parsed(
    "select user_id, product_id, cast(cast(rating as float) as double) as rating from parsed "
    "where rating is not null and not isnan(rating) and user_id is not null and product_id is not null"))
def q_valid_ratings(spark, sf):
    return C.valid_ratings(parsed(spark, sf)).select("user_id", "product_id", "rating")


# ---------------------------------------------------------------- statistics

PR = "select product_id, title, count(rating) as review_count, round(avg(rating), 6) as avg_rating from clean group by 1, 2"


@query("popular_products", O.with_clean(
    f"select *, cast(row_number() over (order by avg_rating desc, product_id, title) as int) as rank from ({PR}) p "
    "where review_count >= 10 order by avg_rating desc, product_id, title limit 10"))
def q_popular_products(spark, sf):
    return S.popular_products(clean(spark, sf))


@query("top_products", O.with_clean(
    f"select *, cast(row_number() over (order by avg_rating desc, product_id, title) as int) as rank from ({PR}) p "
    "order by avg_rating desc, product_id, title limit 10"))
def q_top_products(spark, sf):
    return S.top_products(clean(spark, sf))


@query("similar_by_rating", O.with_clean(f""", pr as ({PR}),
 best as (select * from pr order by avg_rating desc, product_id, title limit 10),
 e as (select cast(null as varchar) as excluded_id union all select distinct product_id from best),
 a as (select excluded_id, pr.*, cast(row_number() over (partition by excluded_id
        order by avg_rating desc, product_id, title) as int) as rank
       from e join pr on excluded_id is null or product_id <> excluded_id)
select * from a where rank <= 10"""))
def q_similar_by_rating(spark, sf):
    return S.similar_by_rating(clean(spark, sf))


def _stats_sql(key: str) -> str:
    return O.with_clean(
        f"select {key}, count(rating) as total_reviews, round(avg(rating), 6) as avg_rating, "
        f"max(review_time) as last_review_time, {O.date_expr('max(review_time)')} as last_review_date "
        f"from clean group by 1")


@query("user_stats", _stats_sql("user_id"))
def q_user_stats(spark, sf):
    return S.user_stats(clean(spark, sf))


@query("product_stats", _stats_sql("product_id"))
def q_product_stats(spark, sf):
    return S.product_stats(clean(spark, sf))


def _latest_sql(key: str, cols: list[str]) -> str:
    order = ", ".join(["review_time desc"] + [f"{c} asc nulls last" for c in cols if c != "review_time"])
    sel = ", ".join(cols)
    return O.with_clean(
        f"select {key}, {sel}, cast(rn as int) as rn, {O.date_expr('review_time')} as date from ("
        f"select {key}, {sel}, row_number() over (partition by {key} order by {order}) as rn from clean) q")


@query("user_history", _latest_sql("user_id", S.HISTORY_COLS))
def q_user_history(spark, sf):
    return S.user_history(clean(spark, sf))


@query("product_reviews", _latest_sql("product_id", S.DETAIL_COLS))
def q_product_reviews(spark, sf):
    return S.product_reviews(clean(spark, sf))


@query("global_metrics", O.with_clean(
    "select count(distinct user_id) as users, count(distinct product_id) as products, "
    "count(*) as ratings from clean"))
def q_global_metrics(spark, sf):
    return S.global_metrics(clean(spark, sf))


@query("rating_distribution", O.with_clean(
    "select s.rating, coalesce(c.cnt, 0) as count from (select cast(range as int) as rating from range(1, 6)) s "
    "left join (select rating, count(*) as cnt from clean group by 1) c on s.rating = c.rating order by 1"))
def q_rating_distribution(spark, sf):
    return S.rating_distribution(clean(spark, sf))


def _hist_sql(expr: str, bins: int) -> str:
    return O.with_parsed(f""", v as (select cast({expr} as double) as x from raw),
 vv as (select x from v where x is not null and not isnan(x)),
 r as (select min(x) as lo, max(x) as hi, (max(x) - min(x)) / {bins}.0 as w from vv),
 c as (select case when r.w = 0 then 0 else cast(least(floor((x - r.lo) / r.w), {bins - 1}) as int) end as bin,
       count(*) as cnt from vv cross join r group by 1)
select cast(e.range as int) as bin, round(r.lo + e.range * r.w, 6) as lower, round(r.lo + (e.range + 1) * r.w, 6) as upper,
  coalesce(c.cnt, 0) as count
from range(0, {bins}) e cross join r left join c on c.bin = e.range order by 1""")


@query("histogram_price", _hist_sql("try_cast(raw_price as double)", HISTOGRAM_BINS["price"]))
def q_histogram_price(spark, sf):
    r = raw(spark, sf).select(F.col("raw_price").try_cast("double").alias("p"))
    return S.histogram(r, "p", HISTOGRAM_BINS["price"])


HV = ("coalesce(case when regexp_full_match(helpfulness, '[0-9]+/[0-9]+') "
      "then try_cast(split_part(helpfulness, '/', 1) as int) end, 0)")


@query("histogram_votes", _hist_sql(HV, HISTOGRAM_BINS["helpful_votes"]))
def q_histogram_votes(spark, sf):
    r = raw(spark, sf).select(F.coalesce(C.parse_helpfulness("helpfulness"), F.lit(0)).alias("v"))
    return S.histogram(r, "v", HISTOGRAM_BINS["helpful_votes"])


@query("rating_frequency", O.with_parsed("select raw_rating, count(*) as count from raw group by 1"))
def q_rating_frequency(spark, sf):
    return raw(spark, sf).groupBy("raw_rating").agg(F.count(F.lit(1)).alias("count"))


def _profile_sql() -> str:
    types = {"user_id": "string", "product_id": "string", "title": "string", "user_name": "string",
             "review_time": "bigint", "review_summary": "string", "review_text": "string",
             "price": "double", "rating": "double", "helpful_votes": "int"}
    parts = [f"select '{c}' as column_name, '{t}' as data_type, count(*) as row_count, "
             f"count(*) - count({c}) as null_count from clean" for c, t in types.items()]
    return O.with_clean(" union all ".join(parts))


@query("profile_columns", _profile_sql())
def q_profile_columns(spark, sf):
    return S.profile_columns(clean(spark, sf))


USER_TERM, PRODUCT_TERM = "#000000", "red "


@query("search_users", O.with_clean(
    "select user_id, user_name, label from (select distinct user_id, user_name, "
    "concat(user_name, ' (', user_id, ')') as label from clean) q "
    f"where contains(lower(label), '{USER_TERM.lower()}')"))
def q_search_users(spark, sf):
    return S.search_labels(clean(spark, sf), "user_id", "user_name", USER_TERM)


@query("search_products", O.with_clean(
    "select product_id, title, label from (select distinct product_id, title, "
    "concat(title, ' (', product_id, ')') as label from clean) q "
    f"where contains(lower(label), '{PRODUCT_TERM.lower()}')"))
def q_search_products(spark, sf):
    return S.search_labels(clean(spark, sf), "product_id", "title", PRODUCT_TERM)


@query("review_dates", O.with_clean(
    f"select review_time, {O.date_expr('review_time')} as date from (select distinct review_time from clean) q"))
def q_review_dates(spark, sf):
    return S.review_dates(clean(spark, sf))


@query("known_users", O.with_clean(
    "select distinct user_id from raw where user_id in (select user_id from clean)"))
def q_known_users(spark, sf):
    cands = raw(spark, sf).select("user_id").distinct()
    return S.known_users(clean(spark, sf), cands)


# ---------------------------------------------------------------- features and similarity

from revue.operators import features as FT  # noqa: E402
from revue.operators import similarity as SIM  # noqa: E402

CATALOG_CTE = (", catalog as (select product_id, title, price from (select product_id, title, price, "
               "row_number() over (partition by product_id order by n desc, price asc nulls last, "
               "title asc nulls last) as r from (select product_id, title, price, count(*) as n from clean "
               "group by 1, 2, 3) t) q where r = 1)")

SIM_CTES = CATALOG_CTE + """,
 n as (select count(*) as nd from catalog), s as (select min(price) as lo, max(price) as hi from catalog),
 c as (select product_id, title, (price - lo) / (hi - lo) as sp from catalog cross join s),
 wt as (select product_id, w, count(*) as tf from (select product_id, unnest(string_split(title, ' ')) as w from c) q group by 1, 2),
 dfq as (select w, count(*) as dfc from wt group by 1 having count(*) >= 2),
 v as (select product_id, wt.w, tf * ln((nd + 1.0) / (dfc + 1.0)) as x from wt join dfq on wt.w = dfq.w cross join n),
 nr as (select product_id, sum(x * x) as n2 from v group by 1),
 dot as (select a.product_id as p1, b.product_id as p2, sum(a.x * b.x) as ab from v a join v b
         on a.w = b.w and a.product_id < b.product_id group by 1, 2),
 sim as (select p1, p2, abs(c1.sp - c2.sp) as dp, c2.sp < c1.sp or (c2.sp = c1.sp and p2 < p1) as lft,
   round(1 - sqrt(greatest(0.0, x1.n2 + x2.n2 - 2 * ab + (c1.sp - c2.sp) * (c1.sp - c2.sp))), 6) as sim
  from dot join nr x1 on p1 = x1.product_id join nr x2 on p2 = x2.product_id
  join c c1 on p1 = c1.product_id join c c2 on p2 = c2.product_id)"""

SIMTOP_CTE = SIM_CTES + """,
 rn as (select *, row_number() over (partition by p1 order by sim desc, dp, lft,
   case when not lft then p2 end asc nulls last, case when lft then p2 end desc nulls last) as rn from sim where sim > 0.1),
 simitems as (select p1 as product1, p2 as product2, sim as similarity, rn from rn where rn <= 10)"""

SIMITEMS_CTE = SIM_CTES + """,
 rk as (select *, rank() over (partition by p1 order by sim desc) as rk from sim where sim > 0.1),
 simitems as (select p1 as product1, p2 as product2, sim as similarity, rk from rk where rk <= 10)"""


def catalog(spark, sf):
    return C.catalog_lookup(clean(spark, sf))


@query("clean_titles", O.with_clean(CATALOG_CTE + " select product_id, title, price, "
                                    "regexp_replace(lower(coalesce(title, '')), '[^a-zA-Z0-9\\s]', '', 'g') as cleaned_title "
                                    "from catalog where length(regexp_replace(lower(coalesce(title, '')), "
                                    "'[^a-zA-Z0-9\\s]', '', 'g')) > 0"))
def q_clean_titles(spark, sf):
    return FT.clean_titles(catalog(spark, sf))


@query("title_terms", O.with_clean(SIM_CTES + " select product_id, w as term, tf from wt"))
def q_title_terms(spark, sf):
    f = FT.TitleFeatures(catalog(spark, sf))
    per_title = f.terms.select("cleaned_title", "term", "tf")
    return (f.docs.select("product_id", "cleaned_title").join(per_title, "cleaned_title")
            .select("product_id", "term", F.col("tf").cast("long").alias("tf")))


@query("term_frequency", O.with_clean(
    SIM_CTES + " select w as term, count(*) as doc_freq, cast(sum(tf) as bigint) as total_count from wt group by 1"))
def q_term_frequency(spark, sf):
    return FT.term_frequency(FT.TitleFeatures(catalog(spark, sf)).terms)


@query("tfidf_weights", O.with_clean(SIM_CTES + " select product_id, w as term, round(x, 9) as weight from v"))
def q_tfidf_weights(spark, sf):
    f = FT.TitleFeatures(catalog(spark, sf))
    return f.product_weights().select("product_id", "term", F.round("weight", 9).alias("weight"))


@query("scaled_price", O.with_clean(SIM_CTES + " select product_id, round(sp, 9) as scaled_price from c"))
def q_scaled_price(spark, sf):
    d = FT.scaled_price(catalog(spark, sf))
    return d.select("product_id", F.round("scaled_price", 9).alias("scaled_price"))


@query("similar_items", O.with_clean(
    SIMITEMS_CTE + " select product1, product2, similarity, cast(rk as int) as rank from simitems"))
def q_similar_items(spark, sf):
    return sims(spark, sf)


@query("similar_items_top", O.with_clean(
    SIMTOP_CTE + " select product1, product2, similarity, cast(rn as int) as rank from simitems"))
def q_similar_items_top(spark, sf):
    return sims(spark, sf, "row_number")


@query("lsh_similar_items")
def q_lsh_similar_items(spark, sf):
    return SIM.lsh_similar_items(catalog(spark, sf))


MEMBERS_CTE = """,
 cl as (select product_id, string_agg(w || ':' || tf, ' ' order by w) as cls from wt where w in (select w from dfq) group by 1),
 mem as (select c.product_id, min(c.product_id) over (partition by coalesce(cls, ''), sp) as class_id
  from c left join cl on c.product_id = cl.product_id)"""


@query("similar_classes", O.with_clean(SIMITEMS_CTE + MEMBERS_CTE + """
 select distinct product1, class_id, similarity, cast(rk as int) as rank from simitems join mem on product2 = product_id"""))
def q_similar_classes(spark, sf):
    """The lists of ``similar_items`` with one row per class of copies."""
    return class_rows(spark, sf)


@query("similar_members", O.with_clean(SIM_CTES + MEMBERS_CTE + " select class_id, product_id from mem"))
def q_similar_members(spark, sf):
    return _sim_index(spark, sf).members()


@query("similar_classes_expanded", O.with_clean(
    SIMITEMS_CTE + " select product1, product2, similarity, cast(rk as int) as rank from simitems"))
def q_similar_classes_expanded(spark, sf):
    """Product pairs from the class rows: the rows of ``similar_items``."""
    return SIM.expand(class_rows(spark, sf), _sim_index(spark, sf).members())


# ---------------------------------------------------------------- recommendations

from revue.operators import als as ALS  # noqa: E402
from revue.operators import evaluate as EV  # noqa: E402
from revue.operators import recommend as R  # noqa: E402

CONTENT_CTES = SIMTOP_CTE + """,
 seen as (select distinct user_id, product_id from clean),
 cand as (select l.user_id, s.product2 as product_id,
   round(sum(s.similarity * ((l.rating - 3.0::double) / 2.0::double)), 9) as total_score
  from clean l join simitems s on l.product_id = s.product1
  where not exists (select 1 from seen k where k.user_id = l.user_id and k.product_id = s.product2) group by 1, 2),
 cr as (select user_id, product_id, total_score from cand),
 crk as (select *, cast(row_number() over (partition by user_id order by total_score desc, product_id) as int) as rank from cr)"""


def _sim_index(spark, sf):
    """Features, classes and positions: one similarity index per session."""
    from revue.plans.stages import shared
    return shared(spark, sf, FACT_TABLES, "simindex", (0.1,),
                  lambda: SIM.SimilarityIndex(catalog(spark, sf)), table=False)


def sims(spark, sf, ties: str = "rank"):
    """The similar-item table. Recommendations use "row_number", k rows a product: a stage table.

    With "rank" a group of copies has all its pairs, so these are made of the class rows as they are read, and never stored.
    """
    from revue.plans.stages import shared
    if ties == "rank":
        return SIM.expand(class_rows(spark, sf), _sim_index(spark, sf).members())
    return shared(spark, sf, FACT_TABLES, "simitems", (ties,), lambda: _sim_index(spark, sf).top_k(ties=ties))


def class_rows(spark, sf):
    """The similar-item table with rank ties as links from products to classes of copies: a stage table."""
    from revue.plans.stages import shared
    return shared(spark, sf, FACT_TABLES, "simclasses", (),
                  lambda: _sim_index(spark, sf).class_rows(top=sims(spark, sf, "row_number")))


def class_pairs(spark, sf):
    """The class rows with the number of product pairs that each stands for."""
    return SIM.counted(class_rows(spark, sf), _sim_index(spark, sf).members())


def lsh_class_pairs(spark, sf):
    """The same of the LSH lists."""
    from revue.conf import materialize
    index = SIM.lsh_index(catalog(spark, sf))
    return SIM.counted(materialize(index.class_rows(), "lsh-classes"), index.members())


def content_top(spark, sf, n: int = 20):
    """Top-n content recommendations per user (n = 2 x 10, what the hybrid pulls): a stage table."""
    from revue.plans.stages import shared
    return shared(spark, sf, FACT_TABLES, "content-top", (n,),
                  lambda: R.content_recommendations(clean(spark, sf), sims(spark, sf, "row_number"), n))


def content_recs(spark, sf, n: int = 10):
    return content_top(spark, sf, max(n, 20)).where(F.col("rank") <= n)


@query("content_recs", O.with_clean(
    CONTENT_CTES + " select user_id, product_id, total_score, rank from crk where rank <= 10"))
def q_content_recs(spark, sf):
    return content_recs(spark, sf, 10)


@query("unseen_candidates", O.with_clean(CONTENT_CTES + " select user_id, product_id, total_score from cr"))
def q_unseen_candidates(spark, sf):
    return R.content_candidates(clean(spark, sf), sims(spark, sf, "row_number"))


@query("recs_with_catalog", O.with_clean(
    CONTENT_CTES + " select crk.user_id, crk.product_id, catalog.title, catalog.price, crk.total_score, crk.rank "
    "from crk join catalog on crk.product_id = catalog.product_id where rank <= 10"))
def q_recs_with_catalog(spark, sf):
    c = clean(spark, sf)
    recs = content_recs(spark, sf, 10)
    return R.attach_catalog(recs, C.catalog_lookup(c)).select(
        "user_id", "product_id", "title", "price", "total_score", "rank")


@query("join_small_dim", O.with_clean(
    CONTENT_CTES + " select crk.user_id, crk.product_id, catalog.title, catalog.price, crk.total_score, crk.rank "
    "from crk join catalog on crk.product_id = catalog.product_id where rank <= 10"))
def q_join_small_dim(spark, sf):
    """A small dimension joined without a hint: the byte threshold and AQE choose the strategy."""
    dim = C.catalog_lookup(clean(spark, sf))
    return content_recs(spark, sf, 10).join(dim, "product_id").select(
        "user_id", "product_id", "title", "price", "total_score", "rank")


@query("normalised_scores", O.with_clean(
    CONTENT_CTES + ", top as (select * from crk where rank <= 20) "
    "select user_id, product_id, total_score, rank, round(total_score / case when max(total_score) over "
    "(partition by user_id) is null or max(total_score) over (partition by user_id) = 0 then 1.0 "
    "else max(total_score) over (partition by user_id) end, 9) as content_score from top"))
def q_normalised_scores(spark, sf):
    recs = content_top(spark, sf, 20)
    out = R.normalise_by_user_max(recs, "total_score", "content_score")
    return out.withColumn("content_score", F.round("content_score", 9))


def latest_similars(reviews, simitems, m: int):
    """Stand-in ranked leg: items similar to each user's most recently reviewed product."""
    from revue.operators import topk
    last = topk.per_key(reviews.select("user_id", "product_id", "review_time"), ["user_id"],
                        [F.desc("review_time"), "product_id"], 1, rank_col="r")
    j = last.join(simitems, last.product_id == simitems.product1).select(
        "user_id", F.col("product2").alias("product_id"), F.col("similarity").alias("score"))
    return topk.per_key(j, ["user_id"], [F.desc("score"), "product_id"], m, rank_col="rank")


@query("blend_scores", O.with_clean(CONTENT_CTES + """,
 last as (select user_id, product_id from (select user_id, product_id, row_number() over
   (partition by user_id order by review_time desc, product_id) as r from clean) q where r = 1),
 ls as (select last.user_id, s.product2 as product_id, s.similarity as score from last join simitems s on last.product_id = s.product1),
 al as (select user_id, product_id from (select *, row_number() over (partition by user_id order by score desc, product_id) as r from ls) q where r <= 20),
 cl as (select user_id, product_id, total_score / case when max(total_score) over (partition by user_id) is null
   or max(total_score) over (partition by user_id) = 0 then 1.0 else max(total_score) over (partition by user_id) end as content_score
   from crk where rank <= 20),
 b as (select coalesce(al.user_id, cl.user_id) as user_id, coalesce(al.product_id, cl.product_id) as product_id,
   cast(case when al.user_id is null then 0.0 else 1.0 end as double) as als_score,
   coalesce(cl.content_score, 0.0) as content_score
   from al full outer join cl on al.user_id = cl.user_id and al.product_id = cl.product_id),
 bs as (select *, round(als_score * 0.7 + content_score * 0.3, 9) as hybrid_score from b),
 br as (select *, cast(row_number() over (partition by user_id order by hybrid_score desc, product_id) as int) as rank from bs)
select user_id, product_id, als_score, round(content_score, 9) as content_score, hybrid_score, rank from br where rank <= 10"""))
def q_blend_scores(spark, sf):
    c = clean(spark, sf)
    s = sims(spark, sf, "row_number")
    als_leg = latest_similars(c, s, 20)
    content_leg = content_top(spark, sf, 20)
    out = R.blend_scores(als_leg, content_leg, 10)
    return out.select("user_id", "product_id", "als_score", F.round("content_score", 9).alias("content_score"),
                      "hybrid_score", "rank")


# ---------------------------------------------------------------- index, split, evaluation


def _index_sql(key: str, out: str) -> str:
    return O.with_clean(
        f"select {key}, cast(row_number() over (order by frequency desc, {key}) - 1 as int) as {out}, frequency "
        f"from (select {key}, count(*) as frequency from clean group by 1) q")


@query("string_index", _index_sql("product_id", "item_index"))
def q_string_index(spark, sf):
    return ALS.index_keys(clean(spark, sf), "product_id", "item_index")


@query("index_lookup", O.with_clean(
    "select i.user_index, i.user_id, n.user_name from (select user_id, cast(row_number() over "
    "(order by frequency desc, user_id) - 1 as int) as user_index from (select user_id, count(*) as frequency "
    "from clean group by 1) q) i left join (select distinct user_id, user_name from clean) n on i.user_id = n.user_id"))
def q_index_lookup(spark, sf):
    c = clean(spark, sf)
    idx = ALS.index_keys(c, "user_id", "user_index")
    names = c.select("user_id", "user_name").distinct()
    return idx.join(names, "user_id", "left").select("user_index", "user_id", "user_name")


SPLIT = "cast(concat('0x', substr(md5(concat(user_id, '#', product_id)), 1, 8)) as bigint) % 100 < 80"


@query("hash_split", O.with_clean(
    f"select case when {SPLIT} then 'train' else 'test' end as split, count(*) as rows from clean group by 1"))
def q_hash_split(spark, sf):
    train, test = EV.hash_split(clean(spark, sf))
    return (train.agg(F.count(F.lit(1)).alias("rows")).withColumn("split", F.lit("train"))
            .unionByName(test.agg(F.count(F.lit(1)).alias("rows")).withColumn("split", F.lit("test")))
            .select("split", "rows"))


MEAN_PRED = f"""
, tr as (select * from clean where {SPLIT}), te as (select * from clean where not ({SPLIT})),
 pm as (select product_id, avg(rating) as prediction from tr group by 1),
 pr as (select te.rating, pm.prediction from te join pm on te.product_id = pm.product_id)"""


@query("rating_errors", O.with_clean(MEAN_PRED + """
select round(sqrt(avg((rating - prediction) * (rating - prediction))), 9) as rmse,
 round(avg(abs(rating - prediction)), 9) as mae, count(*) as n from pr"""))
def q_rating_errors(spark, sf):
    train, test = EV.hash_split(clean(spark, sf))
    m = EV.error_metrics(EV.product_mean_predictions(train, test))
    return m.select(F.round("rmse", 9).alias("rmse"), F.round("mae", 9).alias("mae"), "n")


@query("residual_histogram", O.with_clean(MEAN_PRED + """,
 vv as (select round(rating - prediction, 9) as x from pr),
 r as (select min(x) as lo, max(x) as hi, (max(x) - min(x)) / 50.0 as w from vv),
 c as (select case when r.w = 0 then 0 else cast(least(floor((x - r.lo) / r.w), 49) as int) end as bin,
       count(*) as cnt from vv cross join r group by 1)
select cast(e.range as int) as bin, round(r.lo + e.range * r.w, 6) as lower, round(r.lo + (e.range + 1) * r.w, 6) as upper,
  coalesce(c.cnt, 0) as count
from range(0, 50) e cross join r left join c on c.bin = e.range order by 1"""))
def q_residual_histogram(spark, sf):
    train, test = EV.hash_split(clean(spark, sf))
    res = EV.residuals(EV.product_mean_predictions(train, test))
    return S.histogram(res.select(F.round("residual", 9).alias("residual")), "residual",
                       HISTOGRAM_BINS["residual"])


@query("sample_reviews", O.with_clean(
    f"select {CLEAN_COLS} from clean where cast(concat('0x', substr(md5(concat(user_id, '#', product_id, '#42')), 1, 8)) "
    "as bigint) % 10000 < 5000"))
def q_sample_reviews(spark, sf):
    return EV.sample_reviews(clean(spark, sf), SAMPLE_FRACTION)


# ---------------------------------------------------------------- ALS


def _ratings(spark, sf):
    """Cleaned reviews for the served model: 'a/b' counts as a share of five stars."""
    from revue.plans.stages import shared
    return shared(spark, sf, FACT_TABLES, "ratings", (FRACTION_SCALE,),
                  lambda: _cleaned(spark, C.parse_reviews(raw(spark, sf), FRACTION_SCALE).select(
                      "user_id", "product_id", "rating", "price")).select("user_id", "product_id", "rating"), table=False)


def _als_setup(spark, sf, params=None):
    """Indexed ratings, md5 split and an ALS fit: a stage shared by the ALS queries.

    By default the served model: one rating scale, regularised; ``ALS.BATCH`` is the weaker named setting.
    """
    from revue.plans.stages import materialize, shared
    params = params or ALS.DASHBOARD

    def build():
        c = clean(spark, sf)
        idx = ALS.Indexed(_ratings(spark, sf))
        # The index tables already read from a checkpoint; the joined ratings feed every fit.
        idx.ratings = materialize(idx.ratings, "indexed-ratings")
        train, test = EV.hash_split(idx.ratings)
        model = ALS.fit(train.select("user_index", "item_index", "rating"), **params)
        return c, idx, train, test, model
    return shared(spark, sf, FACT_TABLES, "als", tuple(sorted(params.items())), build, table=False)


KNOWN_PAIRS = f"""
, tr as (select * from clean where {SPLIT}), te as (select * from clean where not ({SPLIT})),
 known as (select user_id, product_id from te where user_id in (select user_id from tr)
           and product_id in (select product_id from tr))"""


@query("als_prediction_keys", O.with_clean(KNOWN_PAIRS + " select user_id, product_id, count(*) as n from known group by 1, 2"))
def q_als_prediction_keys(spark, sf):
    """Every test pair whose user and product the model knows gets a finite prediction, no other."""
    return q_als_predictions(spark, sf).groupBy("user_id", "product_id").agg(F.count("prediction").alias("n"))


@query("als_rank_check", O.with_clean(f""", tr as (select * from clean where {SPLIT}),
 items as (select count(distinct product_id) as n from tr)
 select user_id, least(items.n, 10) as n_recs, true as ordered from (select distinct user_id from tr) u, items"""))
def q_als_rank_check(spark, sf):
    """Per known user: the number of recommendations, and whether ranks run from 1 with falling scores."""
    from pyspark.sql import Window
    _, idx, _, _, model = _als_setup(spark, sf)
    earlier = Window.partitionBy("user_id").orderBy("rank")
    recs = ALS.recommend_users(model, idx, 10)
    step = ((F.row_number().over(earlier) == F.col("rank"))
            & F.coalesce(F.lag("score").over(earlier) >= F.col("score"), F.lit(True)))
    return (recs.withColumn("step", step).groupBy("user_id")
            .agg(F.count(F.lit(1)).alias("n_recs"), F.every("step").alias("ordered")))


@query("als_predictions")
def q_als_predictions(spark, sf):
    _, _, _, test, model = _als_setup(spark, sf)
    return ALS.predict(model, test).select("user_id", "product_id", "rating", "prediction")


@query("als_metrics")
def q_als_metrics(spark, sf):
    _, _, _, test, model = _als_setup(spark, sf)
    return EV.error_metrics(ALS.predict(model, test))


@query("als_metrics_batch")
def q_als_metrics_batch(spark, sf):
    """The batch job's setting (rank 10, 5 iterations, reg 0.01) on the same ratings."""
    _, _, _, test, model = _als_setup(spark, sf, ALS.BATCH)
    return EV.error_metrics(ALS.predict(model, test))


@query("als_user_recs")
def q_als_user_recs(spark, sf):
    _, idx, _, _, model = _als_setup(spark, sf)
    return ALS.recommend_users(model, idx, 10)


@query("als_item_recs")
def q_als_item_recs(spark, sf):
    _, idx, _, _, model = _als_setup(spark, sf)
    return ALS.recommend_items(model, idx, 10)


@query("als_subset_recs")
def q_als_subset_recs(spark, sf):
    """Recommendations with title and price for a given set of users, known and unknown ones."""
    c, idx, _, _, model = _als_setup(spark, sf)
    asked = raw(spark, sf).select("user_id").where(F.col("user_id").endswith("7")).distinct()
    recs = ALS.recommend_users(model, idx, 10, users=asked)
    return R.attach_catalog(recs, C.catalog_lookup(c)).select("user_id", "product_id", "title", "price", "score", "rank")


@query("als_save_load", O.with_clean(KNOWN_PAIRS + " select count(*) as n, 0::bigint as mismatches from known"))
def q_als_save_load(spark, sf):
    """A saved and reloaded model predicts as the fitted one: pairs and differing predictions."""
    from revue.conf import scratch_path
    _, idx, _, test, model = _als_setup(spark, sf)
    back = ALS.load(ALS.save(model, scratch_path(spark, "als-model")))
    key = ["user_index", "item_index"]
    old = ALS.predict(model, test).groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.max("prediction").alias("p"))
    new = ALS.predict(back, test).groupBy(*key).agg(F.max("prediction").alias("q"))
    return old.join(new, key, "full").agg(
        F.sum("n").alias("n"), F.sum((~F.col("p").eqNullSafe(F.col("q"))).cast("long")).alias("mismatches"))


def _grid(spark, sf):
    """The grid search over materialised ratings: a stage shared by its queries."""
    from revue.plans.stages import shared

    def build():
        _, _, train, valid, _ = _als_setup(spark, sf)
        return ALS.grid_search(train.select("user_index", "item_index", "rating"), valid, ALS.FULL_GRID)
    return shared(spark, sf, FACT_TABLES, "als-grid", (), build)


@query("als_grid")
def q_als_grid(spark, sf):
    return _grid(spark, sf)


@query("als_grid_settings", O.with_clean(KNOWN_PAIRS + """,
 g as (select cast(unnest([10, 50, 100]) as int) as rank), h as (select unnest([0.01, 0.1, 1.0])::double as reg_param),
 i as (select cast(unnest([5, 10]) as int) as max_iter)
 select rank, reg_param, max_iter, (select count(*) from known) as n_valid, null::varchar as error from g, h, i"""))
def q_als_grid_settings(spark, sf):
    return _grid(spark, sf).select("rank", "reg_param", "max_iter", "n_valid", "error")


@query("hybrid_recs")
def q_hybrid_recs(spark, sf):
    c, idx, _, _, model = _als_setup(spark, sf)
    lookup = C.catalog_lookup(c)
    als_leg = ALS.recommend_users(model, idx, 20)
    content_leg = content_top(spark, sf, 20)
    out = R.blend_scores(als_leg, content_leg, 10)
    return R.attach_catalog(out, lookup).select("user_id", "product_id", "title", "price", "als_score",
                                                 "content_score", "hybrid_score", "rank")


@query("recs_or_popular")
def q_recs_or_popular(spark, sf):
    c, idx, _, _, model = _als_setup(spark, sf)
    everyone = raw(spark, sf).select("user_id").distinct()
    personal = ALS.recommend_users(model, idx, 10, users=everyone)
    return R.with_fallback(everyone, personal, S.popular_products(c), 10)


@query("random_split", O.with_clean(
    "select case when b < 60 then 'train' when b < 80 then 'validation' else 'test' end as split, count(*) as rows from "
    "(select cast(concat('0x', substr(md5(concat(user_id, '#', product_id)), 1, 8)) as bigint) % 100 as b from clean) q group by 1"))
def q_random_split(spark, sf):
    out = None
    for n, p in zip(["train", "validation", "test"], EV.three_way_split(clean(spark, sf)), strict=True):
        one = p.agg(F.count(F.lit(1)).alias("rows")).withColumn("split", F.lit(n))
        out = one if out is None else out.unionByName(one)
    return out.select("split", "rows").where("rows > 0")


@query("dashboard_recs")
def q_dashboard_recs(spark, sf):
    """The dashboard's ALS flow: all valid ratings, dashboard setting, 10 recommendations
    per user mapped back to id and title, score to 2 places."""
    c = C.valid_ratings(clean(spark, sf))
    from revue.conf import materialize
    idx = ALS.Indexed(c.select("user_id", "product_id", "rating"))
    model = ALS.fit(materialize(idx.ratings.select("user_index", "item_index", "rating"), "indexed-ratings"), **ALS.DASHBOARD)
    recs = ALS.recommend_users(model, idx, 10)
    titles = C.catalog_lookup(c).select("product_id", "title")
    return (recs.join(titles, "product_id", "left")
                .select("user_id", "product_id", "title", F.round("score", 2).alias("score"), "rank"))


@query("als_tuning")
def q_als_tuning(spark, sf):
    """The tuning script: 60/20/20 split, grid on validation, the best model stored, reloaded and measured on test."""
    from revue.conf import scratch_path
    _, idx, _, _, _ = _als_setup(spark, sf)
    from revue.plans.stages import shared

    def build():
        train, valid, test = (p.select("user_index", "item_index", "rating") for p in EV.three_way_split(idx.ratings))
        return ALS.tune(train, valid, test, ALS.FULL_GRID, save_path=scratch_path(spark, "best-als"))
    return shared(spark, sf, FACT_TABLES, "als-tuning", (), build)


@query("popular_fallback", O.with_clean(f""", pop as (
 select product_id, avg_rating as score, cast(row_number() over (order by avg_rating desc, product_id, title) as int) as rank
 from ({PR}) p where review_count >= 10 order by avg_rating desc, product_id, title limit 10)
 select u.user_id, pop.product_id, score, rank, 'popular' as source
 from (select distinct user_id from raw where user_id not in (select user_id from clean where {SPLIT})) u, pop"""))
def q_popular_fallback(spark, sf):
    """The rows that ``recs_or_popular`` gives to users the model does not know."""
    return q_recs_or_popular(spark, sf).where("source = 'popular'")


@query("similar_items_nested", O.with_clean(SIMTOP_CTE + " select product1, product2, similarity from simitems"))
def q_similar_items_nested(spark, sf):
    """The stored form, one array per product, written, read and exploded."""
    from revue.conf import scratch_path
    path = io.write_parquet(SIM.nest_similar(sims(spark, sf, "row_number")), scratch_path(spark, "nested"))
    return SIM.flatten_similar(io.read_parquet(spark, path))


@query("search_products_regex", O.with_clean(
    "select product_id, title, label from (select distinct product_id, title, "
    "concat(title, ' (', product_id, ')') as label from clean) q where regexp_matches(label, '(?i)re[dg] .*\\(P1')"))
def q_search_products_regex(spark, sf):
    return S.search_labels(clean(spark, sf), "product_id", "title", r"re[dg] .*\(P1", regex=True)


from revue.plans import invariants  # noqa: E402, F401  registers the companions of queries whose values no SQL can give
