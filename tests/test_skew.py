"""A user and a product that each hold a third of all reviews: results stay exact."""

import duckdb
import pandas as pd
from pyspark.sql import functions as F

from revue.operators import clean as C
from revue.operators import recommend as R
from revue.operators import stats as S


def skewed(spark, n=3000):
    rows = []
    for i in range(n):
        if i % 3 == 0:
            u, p = "HOTU", f"P{i % 97}"
        elif i % 3 == 1:
            u, p = f"U{i % 211}", "HOTP"
        else:
            u, p = f"U{i % 211}", f"P{i % 97}"
        rows.append((u, p, f"title {i % 7}", "n", i, "s", "t", float(i % 13), float(1 + i % 5), i % 4))
    schema = ("user_id string, product_id string, title string, user_name string, review_time bigint, "
              "review_summary string, review_text string, price double, rating double, helpful_votes int")
    return spark.createDataFrame(rows, schema).repartition(6), pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])


def test_hot_keys_exact(spark):
    df, pdf = skewed(spark)
    con = duckdb.connect()
    con.register("r", pdf)
    clean = C.clean_reviews(df, 5, 10)
    assert clean.count() == con.execute(
        "select count(*) from r where user_id in (select user_id from r group by 1 having count(*) >= 5) "
        "and product_id in (select product_id from r group by 1 having count(*) >= 10)").fetchone()[0]
    hist = S.user_history(clean, limit=50)
    assert hist.where(F.col("user_id") == "HOTU").count() == 50
    got = {r.user_id: (r.total_reviews, r.avg_rating) for r in S.user_stats(clean).collect()}
    want = {u: (n, round(a, 6)) for u, n, a in con.execute(
        "select user_id, count(*), avg(rating) from r where user_id in (select user_id from r group by 1 having count(*) >= 5) "
        "and product_id in (select product_id from r group by 1 having count(*) >= 10) group by 1").fetchall()}
    assert got == want
    sims = spark.createDataFrame([("HOTP", f"P{j}", 0.5) for j in range(20)] + [(f"P{j}", "HOTP", 0.9) for j in range(20)],
                                 "product1 string, product2 string, similarity double")
    recs = R.content_recommendations(clean, sims, 5)
    per_user = recs.groupBy("user_id").count()
    assert per_user.where(F.col("count") > 5).count() == 0
    seen = clean.select("user_id", "product_id")
    assert recs.join(seen, ["user_id", "product_id"]).count() == 0


def test_candidates_of_heavy_users_are_those_of_any(spark, monkeypatch):
    clean = skewed(spark)[0].select("user_id", "product_id", "rating")
    sims = spark.createDataFrame([(f"P{i}", f"P{(i * 7 + j * 5) % 120}", 0.1 * j) for i in range(97) for j in range(1, 6)],
                                 "product1 string, product2 string, similarity double")

    def rows(frame):
        return sorted(tuple(r) for r in frame.collect())
    every, best = (rows(make(clean, sims)) for make in (R.content_candidates, R.content_recommendations))
    monkeypatch.setattr(R, "HEAVY_USER", 20)
    assert rows(R.content_candidates(clean, sims)) == every and rows(R.content_recommendations(clean, sims)) == best
    monkeypatch.setattr(R, "HEAVY_USER", 0)
    assert rows(R.content_recommendations(clean, sims)) == best
    assert {u for u, *_ in best} > {"HOTU"}


def test_candidates_are_not_shuffled(spark):
    """Reviews go to their user's task with the lists; what is made of them there stays there up to the top ten."""
    clean = skewed(spark)[0].select("user_id", "product_id", "rating")
    sims = spark.createDataFrame([("HOTP", "P1", 0.5), ("P1", "P2", 0.5)], "product1 string, product2 string, similarity double")
    plan = R.content_recommendations(clean, sims)._jdf.queryExecution().executedPlan().toString()
    assert "Generate inline" in plan and "Exchange" not in plan[:plan.index("Generate inline")]
