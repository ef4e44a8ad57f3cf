"""Exact top-n by inner product: brute force, MLlib's own lists, left-out pairs, hot users."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from revue.operators import als as ALS
from revue.operators import inner_product as IP
from revue.plans import catalog as Q

SF = "/root/testdata/sf0.001"


def frame(spark, vectors, first=0):
    return spark.createDataFrame([(first + i, v.tolist()) for i, v in enumerate(vectors)], "id int, features array<float>")


def plain(queries, points, n, left_out=frozenset(), first=0):
    out = []
    for q, u in enumerate(queries.astype(np.float64)):
        scores = (points.astype(np.float64) @ u).astype(np.float32)
        order = sorted((p for p in range(len(points)) if (q, p + first) not in left_out), key=lambda p: (-scores[p], p))[:n]
        out += [(q, p + first, float(scores[p]), k) for k, p in enumerate(order, 1)]
    return out


def got(df):
    return sorted((tuple(r) for r in df.select("query", "point", "score", "rank").collect()), key=lambda r: (r[0], r[3]))


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(4)
    points = (rng.normal(size=(700, 6)) * rng.lognormal(0, 1, (700, 1))).astype(np.float32)
    points[600:650] = points[:50]  # ties
    points[650] = 0
    return rng.normal(size=(90, 6)).astype(np.float32), points


@pytest.mark.parametrize("limits", [{}, {"round_bytes": 3000}, {"round_bytes": 3000, "block": 16}])
@pytest.mark.parametrize("kind", ["signed", "nonnegative"])
def test_equals_brute_force(spark, vectors, limits, kind):
    queries, points = vectors if kind == "signed" else map(np.abs, vectors)
    assert got(IP.top_n(frame(spark, queries), frame(spark, points, 5), 7, **limits)) == plain(queries, points, 7, first=5)


@pytest.mark.parametrize("limits", [{}, {"round_bytes": 3000, "block": 16}])
def test_left_out_pairs(spark, vectors, limits):
    queries, points = vectors
    rng = np.random.default_rng(5)
    left_out = {(int(q), int(p)) for q, p in zip(rng.integers(0, 90, 4000), rng.integers(0, 700, 4000), strict=True)}
    left_out |= {(3, p) for p in range(700)} | {(4, p) for p in range(695)} | {(999, 1), (1, 9999)}
    pairs = spark.createDataFrame(sorted(left_out) * 2, "query int, point int")
    assert got(IP.top_n(frame(spark, queries), frame(spark, points), 7, pairs, **limits)) == plain(queries, points, 7, left_out)


def test_few_or_no_points_and_queries(spark, vectors):
    queries, points = vectors
    assert got(IP.top_n(frame(spark, queries[:3]), frame(spark, points[:4]), 10)) == plain(queries[:3], points[:4], 10)
    none = spark.createDataFrame([], "id int, features array<float>")
    assert IP.top_n(none, frame(spark, points), 3).count() == 0
    assert IP.top_n(frame(spark, queries), none, 3).count() == 0


def test_most_queries_stop_early(vectors):
    queries, points = vectors
    order = np.argsort(-np.sqrt((points ** 2).sum(axis=1)), kind="stable")
    met = 0

    class Counting(np.ndarray):
        def __matmul__(self, other):
            nonlocal met
            met += self.shape[0] * (other.shape[1] if other.ndim > 1 else 0)
            return np.asarray(self) @ np.asarray(other)

    p = IP.Points(order, points[order].astype(np.float64), None, 3, 32)
    tops, found = np.full((90, 3), -np.inf, np.float32), np.zeros((90, 3), np.int64)
    IP.search(p, queries.astype(np.float64).view(Counting), tops, found, np.zeros(0, int), np.zeros(0, int))
    assert met < 0.5 * 90 * 700


@pytest.fixture(scope="module")
def model(spark):
    _, idx, train, _, model = Q._als_setup(spark, SF)
    return idx, train, model


def test_equals_mllib_lists(spark, model):
    idx, _, m = model
    for mine, theirs, key in ((ALS.recommend_users(m, idx, 10), m.recommendForAllUsers(10), "user"),
                              (ALS.recommend_items(m, idx, 10), m.recommendForAllItems(10), "item")):
        ids = {"user": idx.users.withColumnRenamed("user_id", "k"), "item": idx.items.withColumnRenamed("product_id", "k")}[key]
        theirs = {r["k"]: [x["rating"] for x in r["recommendations"]] for r in theirs.join(ids, f"{key}_index").collect()}
        lists = {}
        for r in mine.orderBy("rank").collect():
            lists.setdefault(r[0], []).append(r["score"])
        assert lists.keys() == theirs.keys()
        for k, scores in lists.items():
            assert scores == pytest.approx(theirs[k], rel=1e-5, abs=1e-6)


def test_no_join_of_users_and_items(spark, model):
    idx, train, m = model
    recs = ALS.recommend_users(m, idx, 10, seen=train)
    plan = recs._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_seen_products_are_left_out_exactly(spark, model):
    idx, train, m = model
    recs = ALS.recommend_users(m, idx, 10, seen=train)
    assert recs.join(train, ["user_id", "product_id"], "left_semi").count() == 0
    every = ALS.recommend_users(m, idx, idx.items.count()).join(train, ["user_id", "product_id"], "left_anti")
    want = sorted((r["user_id"], float(r["score"])) for r in every.collect())
    best = {}
    for user, score in want:
        best.setdefault(user, []).append(score)
    mine = {}
    for r in recs.orderBy("rank").collect():
        mine.setdefault(r["user_id"], []).append(r["score"])
    assert mine == {u: sorted(s, reverse=True)[:10] for u, s in best.items()}


def test_a_user_with_a_third_of_the_rows(spark, model):
    idx, train, m = model
    user = train.select("user_id").orderBy("user_id").first()[0]
    hot = train.select(F.lit(user).alias("user_id"), "product_id")
    recs = ALS.recommend_users(m, idx, 10, seen=train.select("user_id", "product_id").union(hot), round_bytes=2000)
    left = idx.items.count() - train.select("product_id").distinct().count()
    assert recs.where(F.col("user_id") == user).count() == min(10, left)


def test_rounds_write_only_what_reaches_the_lists(spark, monkeypatch):
    """Equal norms end no search early: the lists of all queries were written in each of the twelve rounds."""
    rng = np.random.default_rng(6)
    vectors = np.abs(rng.normal(size=(1500, 4)))
    vectors = (vectors / np.linalg.norm(vectors, axis=1)[:, None]).astype(np.float32)
    queries, points = vectors[:300], vectors[300:]
    written, write = [], IP.materialize

    def counted(df, name):
        out = write(df, name)
        if name == "top-n-round":
            written.append(out.select(F.sum(F.size("points"))).first()[0] or 0)
        return out
    monkeypatch.setattr(IP, "materialize", counted)
    best = IP.top_n(frame(spark, queries), frame(spark, points), 5, round_bytes=2800)
    assert got(best) == plain(queries, points, 5)
    assert len(written) > 8 and sum(written) < 3 * 5 * 300


def test_queries_of_few_bytes_are_dealt_out(spark):
    rng = np.random.default_rng(7)
    near, _ = IP._near(frame(spark, rng.normal(size=(400, 3)).astype(np.float32)))
    files = [f for f in near.inputFiles() if f.endswith(".parquet")]
    assert near.count() == 400 and len(files) > 4


def test_no_queries_and_several_rounds(spark, vectors):
    none = spark.createDataFrame([], "id int, features array<float>")
    assert IP.top_n(none, frame(spark, vectors[1]), 3, round_bytes=3000).count() == 0
