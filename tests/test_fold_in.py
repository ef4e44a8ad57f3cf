"""Factors of unknown users: a numpy solve, hot users, and the serving path around it."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from revue.operators import als as ALS
from revue.operators import fold_in as FI
from revue.plans import catalog as Q

SF = "/root/testdata/sf0.001"


def plain(rows, factors, reg):
    """Unconstrained solution and, by trying every support, the nonnegative one."""
    q = np.array([factors[i] for i, _ in rows])
    r = np.array([x for _, x in rows])
    a, b = q.T @ q + reg * len(rows) * np.eye(q.shape[1]), q.T @ r
    best = None
    for mask in range(1 << len(b)):
        on = [j for j in range(len(b)) if mask >> j & 1]
        x = np.zeros(len(b))
        if on:
            x[on] = np.linalg.solve(a[np.ix_(on, on)], b[on])
        value = x @ a @ x / 2 - b @ x
        if (x >= 0).all() and (best is None or value < best[0]):
            best = value, x
    return np.linalg.solve(a, b), best[1]


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(3)
    factors = {i: rng.normal(size=4).astype(np.float32) for i in range(30)}
    ratings = [(f"u{u}", int(i), float(rng.integers(1, 6))) for u in range(25) for i in rng.integers(0, 34, 1 + u)]
    return factors, ratings + [("hot", k % 30, float(k % 5)) for k in range(3000)] + [("none", 99, 3.0)]


@pytest.mark.parametrize("nonnegative", [False, True])
def test_equals_numpy(spark, table, nonnegative):
    factors, ratings = table
    items = spark.createDataFrame([(i, v.tolist()) for i, v in factors.items()], "id int, features array<float>")
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # users cross batches
    try:
        rows = spark.createDataFrame(ratings, "user string, item int, rating double").repartition(5)
        got = {r["id"]: r["features"] for r in FI.fold_in(rows, items, 4, 0.1, nonnegative).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    by_user = {}
    for u, i, x in ratings:
        if i in factors:
            by_user.setdefault(u, []).append((i, x))
    assert got.keys() == by_user.keys() and "none" not in got
    for u, own in by_user.items():
        assert got[u] == pytest.approx(plain(own, {i: v.astype(float) for i, v in factors.items()}, 0.1)[nonnegative], abs=1e-5)


def test_a_user_held_back_gets_recommendations(spark):
    """Folded in with the ratings that the model was trained on, a known user's scores are close to the model's."""
    _, idx, train, _, model = Q._als_setup(spark, SF)
    own = train.select("user_id", "product_id", "rating")
    renamed = own.withColumn("user_id", F.concat(F.lit("new-"), "user_id"))
    new = ALS.recommend_new_users(model, idx, renamed, 5)
    assert new.select("user_id").distinct().count() == own.select("user_id").distinct().count()
    assert ALS.recommend_new_users(model, idx, own, 5).count() == 0  # the model knows them
    known = ALS.recommend_users(model, idx, 1).select(F.concat(F.lit("new-"), "user_id").alias("user_id"), F.col("score").alias("known"))
    gap = new.where("rank = 1").join(known, "user_id").select(F.avg(F.abs(F.col("score") - F.col("known")) / F.col("known"))).first()[0]
    assert gap < 0.25
    seen = ALS.recommend_new_users(model, idx, renamed, 5, seen=renamed)
    assert seen.join(renamed, ["user_id", "product_id"], "left_semi").count() == 0
