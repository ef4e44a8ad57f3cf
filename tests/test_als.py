"""ALS: index, quality and the recommendation properties."""

from pyspark.sql import functions as F

from revue.operators import als as ALS
from revue.operators import evaluate as EV
from revue.plans import catalog as Q

SF = "/root/testdata/sf0.001"


def test_index_matches_string_indexer(spark):
    from pyspark.ml.feature import StringIndexer
    c = Q.clean(spark, SF)
    mine = {r.product_id: r.item_index for r in ALS.index_keys(c, "product_id", "item_index").collect()}
    model = StringIndexer(inputCol="product_id", outputCol="ix").fit(c)
    theirs = {lab: i for i, lab in enumerate(model.labels)}
    assert mine == theirs


def test_als_learns_and_recommends(spark):
    # sf0.01: at sf0.001 the batch setting (reg 0.01) overfits the few ratings per user
    c = Q.clean(spark, "/root/testdata/sf0.01")
    idx = ALS.Indexed(c)
    train, test = EV.hash_split(idx.ratings)
    # dashboard setting (reg 0.1); the batch one (reg 0.01) overfits the mixed-scale ratings
    model = ALS.fit(train.select("user_index", "item_index", "rating"), **ALS.DASHBOARD)
    m = EV.error_metrics(ALS.predict(model, test)).first()
    sd = test.agg(F.stddev("rating")).first()[0]
    assert m["n"] > 0 and m["rmse"] < sd
    recs = ALS.recommend_users(model, idx, 5)
    per_user = recs.groupBy("user_id").count()
    assert per_user.where(F.col("count") > 5).count() == 0
    assert per_user.count() == idx.users.count()
    asked = spark.createDataFrame([("nobody",)], "user_id string").unionByName(c.select("user_id").limit(3))
    sub = ALS.recommend_users(model, idx, 5, users=asked)
    assert sub.where(F.col("user_id") == "nobody").count() == 0 and sub.count() > 0


def test_extended_index_keeps_its_numbers(spark):
    rows = [("u1", "a"), ("u2", "a"), ("u1", "b"), ("u3", "c"), ("u3", "d"), ("u4", "d"), ("u5", "d")]
    df = spark.createDataFrame(rows, "user_id string, product_id string")
    old = ALS.index_keys(df.limit(0).union(df.where("product_id in ('a', 'b')")), "product_id", "ix")
    got = {r.product_id: (r.ix, r.frequency) for r in ALS.extend_index(old, df, "product_id", "ix").collect()}
    assert got == {"a": (0, 2), "b": (1, 1), "d": (2, 3), "c": (3, 1)}
    assert ALS.extend_index(old.limit(0), df, "product_id", "ix").where("ix = 0").first()["product_id"] == "d"
    assert ALS.extend_index(old, df.limit(0), "product_id", "ix").count() == 2


def test_grid_side_by_side_equals_the_sequence(spark):
    _, idx, train, test, _ = Q._als_setup(spark, SF)
    train = train.select("user_index", "item_index", "rating")
    grid = {"rank": [2, 3], "regParam": [0.1, -1.0], "maxIter": [2]}
    one, many = ([tuple(r)[:5] for r in ALS.grid_search(train, test, grid, side_by_side=n).collect()] for n in (1, 3))
    assert [r[:3] for r in one] == [r[:3] for r in many] and len(one) == 4
    assert all((a[3] is None) == (b[3] is None) and (a[3] is None or abs(a[3] - b[3]) < 1e-6) for a, b in zip(one, many, strict=True))
    assert [r[3] is None for r in one] == [False, True, False, True]  # a failing setting is a row with its error
