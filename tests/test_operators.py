"""Operator semantics on hand-made rows (FIXTURES section 3) and properties."""

import pytest
from pyspark.sql import functions as F

from revue.operators import clean as C
from revue.operators import evaluate as EV
from revue.operators import features as FT
from revue.operators import recommend as R
from revue.operators import stats as S
from revue.operators import topk
from revue.operators.positions import dense_index
from revue.sources import io

PARSED = ("user_id string, product_id string, title string, user_name string, review_time bigint, "
          "review_summary string, review_text string, price double, rating double, helpful_votes int")


def parsed_rows(spark, rows):
    full = [(u, p, "t " + p, "n" + u, 1, "s", "x", price, r, 1) for u, p, price, r in rows]
    return spark.createDataFrame(full, PARSED)


def test_median_lower_middle_and_empty(spark):
    df = parsed_rows(spark, [("u", "a", 1.0, 4.0), ("u", "b", 2.0, 4.0), ("u", "c", 3.0, 4.0),
                             ("u", "d", 4.0, 4.0)])
    assert C.median_price(df).first()[0] == 2.0
    none = parsed_rows(spark, [("u", "a", None, 4.0)])
    assert C.median_price(none).first()[0] == 0.0


def test_clean_fills_and_filters(spark):
    rows = [("u1", "a", None, 4.0), ("u1", "b", 10.0, 5.0), ("u1", "b", 30.0, 1.0), ("u2", "a", 20.0, None)]
    out = C.clean_reviews(parsed_rows(spark, rows), 1, 1).orderBy("product_id", "price").collect()
    # median over rows that survive the null drop: {10, 30} -> lower middle 10
    assert [(r.product_id, r.price) for r in out] == [("a", 10.0), ("b", 10.0), ("b", 30.0)]
    # activity counts are taken after the null drop: u2 has no valid rating
    assert C.clean_reviews(parsed_rows(spark, rows), 2, 1).select("user_id").distinct().count() == 1


def test_valid_ratings_drops_nan(spark):
    df = spark.createDataFrame([("u", "p", float("nan")), ("u", "p", 4.0), ("u", None, 3.0)],
                               "user_id string, product_id string, rating double")
    assert [r.rating for r in C.valid_ratings(df).collect()] == [4.0]


def test_minmax_constant_is_half(spark):
    df = spark.createDataFrame([("a", 5.0), ("b", 5.0)], "product_id string, price double")
    assert {r.scaled_price for r in FT.scaled_price(df).collect()} == {0.5}


def test_rating_distribution_zero_and_nonint(spark):
    df = parsed_rows(spark, [("u", "a", 1.0, 0.8), ("u", "b", 1.0, 4.5), ("u", "c", 1.0, 5.0),
                             ("u", "d", 1.0, 5.0)])
    got = [(r.rating, r["count"]) for r in S.rating_distribution(df).collect()]
    assert got == [(1, 0), (2, 0), (3, 0), (4, 0), (5, 2)]


def test_search_is_literal_and_null_safe(spark):
    df = spark.createDataFrame([("U1", "Ann (B)"), ("U2", None), ("U3", "bob")], "user_id string, user_name string")
    assert [r.user_id for r in S.search_labels(df, "user_id", "user_name", "(b").collect()] == ["U1"]
    assert {r.user_id for r in S.search_labels(df, "user_id", "user_name", "B").collect()} == {"U1", "U3"}
    assert [r.user_id for r in S.search_labels(df, "user_id", "user_name", "^bob", regex=True).collect()] == ["U3"]


def test_rank_ties_kept_vs_row_number(spark):
    df = spark.createDataFrame([("k", f"i{i:02d}", 1.0) for i in range(12)], "key string, item string, s double")
    assert topk.per_key(df, ["key"], [F.desc("s")], 10, ties="rank").count() == 12
    assert topk.per_key(df, ["key"], [F.desc("s"), "item"], 10).count() == 10


def test_dense_index_is_global_and_contiguous(spark):
    df = spark.range(0, 5000, numPartitions=7).select((F.col("id") * 7919 % 5000).alias("v"))
    out = dense_index(df, ["v"], "ix", partitions=5).orderBy("v").collect()
    assert [r.ix for r in out] == list(range(5000))
    assert [r.v for r in out] == list(range(5000))


def test_hash_split_stable_and_complete(spark):
    rows = [(f"U{i}", f"P{j}", 4.0) for i in range(40) for j in range(25)]
    df = spark.createDataFrame(rows, "user_id string, product_id string, rating double")
    a, b = EV.hash_split(df)
    a2, _ = EV.hash_split(df.repartition(13))
    assert a.count() + b.count() == df.count()
    assert a.join(b, ["user_id", "product_id"]).count() == 0
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, a2.collect()))


def test_content_candidates_exclude_seen_products(spark):
    reviews = spark.createDataFrame(
        [("u", "a", 5.0), ("u", "b", 1.0), ("u", "b", 1.0), ("v", "a", 4.0)],
        "user_id string, product_id string, rating double")
    sims = spark.createDataFrame([("a", "b", 0.5), ("a", "c", 0.9), ("b", "c", 0.2)],
                                 "product1 string, product2 string, similarity double")
    got = {(r.user_id, r.product_id): r.total_score for r in R.content_candidates(reviews, sims).collect()}
    # u rated b twice: b never recommended to u; c = 0.9*1 + 0.2*(-1) twice
    assert got == {("u", "c"): pytest.approx(0.9 - 0.4), ("v", "b"): pytest.approx(0.25),
                   ("v", "c"): pytest.approx(0.45)}


def test_blend_cases(spark):
    als = spark.createDataFrame([("u", "a"), ("u", "b"), ("w", "z")], "user_id string, product_id string")
    content = spark.createDataFrame([("u", "b", 2.0), ("u", "c", 1.0), ("x", "q", -2.0), ("x", "r", -1.0)],
                                    "user_id string, product_id string, total_score double")
    got = {(r.user_id, r.product_id): r.hybrid_score for r in R.blend_scores(als, content, 10).collect()}
    assert got[("u", "b")] == pytest.approx(0.7 + 0.3)       # both legs
    assert got[("u", "a")] == pytest.approx(0.7)             # ALS only
    assert got[("u", "c")] == pytest.approx(0.15)            # content only, normalised by max 2.0
    assert got[("w", "z")] == pytest.approx(0.7)
    # content max <= 0: reference divides by the (negative) max, flipping signs
    assert got[("x", "q")] == pytest.approx(0.6) and got[("x", "r")] == pytest.approx(0.3)
    guarded = {(r.user_id, r.product_id): r.hybrid_score
               for r in R.blend_scores(als, content, 10, guard_nonpositive=True).collect()}
    assert guarded[("x", "q")] == pytest.approx(-0.6)


def test_blend_keys_ignore_null_title(spark):
    als = spark.createDataFrame([("u", "a")], "user_id string, product_id string")
    content = spark.createDataFrame([("u", "a", 1.0)], "user_id string, product_id string, total_score double")
    cat = spark.createDataFrame([("a", None, None)], "product_id string, title string, price double")
    out = R.attach_catalog(R.blend_scores(als, content, 10), cat)
    assert out.count() == 1


def test_fallback_for_unknown_users(spark):
    users = spark.createDataFrame([("u",), ("new",)], "user_id string")
    personal = spark.createDataFrame([("u", "a", 4.5, 1)], "user_id string, product_id string, score double, rank int")
    popular = spark.createDataFrame([("p1", 5.0, 1), ("p2", 4.0, 2)], "product_id string, avg_rating double, rank int")
    got = sorted((r.user_id, r.product_id, r.source) for r in R.with_fallback(users, personal, popular).collect())
    assert got == [("new", "p1", "popular"), ("new", "p2", "popular"), ("u", "a", "personal")]


def test_similar_by_rating_excludes_self(spark):
    rows = [("u", f"p{i}", 1.0, float(1 + i % 5)) for i in range(15)]
    df = parsed_rows(spark, rows)
    out = S.similar_by_rating(df, k=3)
    top = [r.product_id for r in out.where(F.col("excluded_id").isNull()).orderBy("rank").collect()]
    assert len(top) == 3
    ex = out.where(F.col("excluded_id") == top[0]).orderBy("rank").collect()
    assert [r.product_id for r in ex] == top[1:] + [ex[-1].product_id] and top[0] not in [r.product_id for r in ex]


def test_required_columns(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError, match="table lacks b"):
        io.require_columns(df, ["a", "b"])


def test_histogram_all_bins(spark):
    df = spark.createDataFrame([(float(x),) for x in [0, 1, 2, 10]], "x double")
    got = [(r.bin, r["count"]) for r in S.histogram(df, "x", 5).collect()]
    assert got == [(0, 2), (1, 1), (2, 0), (3, 0), (4, 1)]   # numpy bins: [0,2) [2,4) ... [8,10]


def test_profile_columns(spark):
    df = spark.createDataFrame([(1, None), (None, "a")], "a int, b string")
    got = {r.column_name: (r.data_type, r.row_count, r.null_count) for r in S.profile_columns(df).collect()}
    assert got == {"a": ("int", 2, 1), "b": ("string", 2, 1)}


def test_running_sum_mixed_flags_across_partitions(spark):
    from revue.operators.positions import running_sum
    # long runs of flag-0 rows make some range partitions hold no flag-1 row at all
    rows = [(i, 1 if (400 <= i < 420 or i == 2999) else 0) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, f int")
    got = {r.k: r.c for r in running_sum(df, ["k"], "f", "c", partitions=9).collect()}
    acc, want = 0, {}
    for k, f in rows:
        want[k] = acc
        acc += f
    assert got == want


def test_catalog_lookup_prefers_most_reviewed_triple(spark):
    df = parsed_rows(spark, [("u1", "a", 5.0, 4.0), ("u2", "a", 5.0, 4.0), ("u3", "a", 3.0, 4.0),
                             ("u1", "b", 2.0, 4.0), ("u2", "b", 1.0, 4.0)])
    got = {r.product_id: r.price for r in C.catalog_lookup(df).collect()}
    assert got == {"a": 5.0, "b": 1.0}      # a: most reviewed; b: tie -> lowest price
