"""How often steps run, and what they read: findings of round 3."""

from pyspark.sql import functions as F

from revue.operators import clean as C
from revue.sources import fixtures


def test_ratings_are_parsed_once_a_row(spark):
    """The null drop must not bring a second evaluation of the rating (as a filter pushed below the parsing does)."""
    calls = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def parse(text):
        calls.add(1)
        return None if text == "bad" else float(text)
    rows = [("u", "a", 1.0, "4"), ("u", "b", 2.0, "bad"), ("v", "a", 3.0, "5")]
    raw = spark.createDataFrame(rows, "user_id string, product_id string, price double, text string")
    out = C.clean_reviews(raw.select("user_id", "product_id", "price", parse("text").alias("rating")), 1, 1)
    assert sorted(tuple(r) for r in out.select("user_id", "product_id", "rating").collect()) == [("u", "a", 4.0), ("v", "a", 5.0)]
    assert calls.value == len(rows)


def test_customers_are_joined_to_orders(spark):
    """Customers meet the orders, not the several times as many line items."""
    plan = fixtures.raw_reviews(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join Inner" in line]
    depth = {key: next(line.index("Join") for line in joins if key in line) for key in ("c_custkey", "l_orderkey", "p_partkey")}
    assert depth["c_custkey"] > depth["l_orderkey"] > depth["p_partkey"]


def test_lsh_lists_are_those_of_the_bucket_join(spark, monkeypatch):
    """Pairs that share a bucket, without MLlib's join of all pairs of a bucket."""
    from pyspark.ml.feature import BucketedRandomProjectionLSH, BucketedRandomProjectionLSHModel
    from revue.functions.scoring import similarity_from_sq_distance
    from revue.operators import similarity as SIM
    from revue.operators import topk
    from revue.operators.features import TitleFeatures
    words = ["red", "blue", "mat", "lamp"]
    rows = [(f"P{i:03d}", f"{words[i % 4]} {words[i // 4 % 3]}", float(i * 37 % 50)) for i in range(48)]
    cat = spark.createDataFrame(rows, "product_id string, title string, price double")
    points = SIM.lsh_points(TitleFeatures(cat, materialize=True))
    hashing = BucketedRandomProjectionLSH(inputCol="point", outputCol="buckets", bucketLength=0.25, numHashTables=1, seed=42).fit(points)
    near = hashing.approxSimilarityJoin(points, points, 0.6, distCol="apart").select(
        F.col("datasetA.pid").alias("product1"), F.col("datasetB.pid").alias("product2"),
        similarity_from_sq_distance(F.col("apart") * F.col("apart")).alias("similarity"))
    want = topk.per_key(near.where("product1 < product2 and similarity > 0.4"), ["product1"], [F.desc("similarity")], 3, ties="rank")

    def refuse(*_, **__):
        raise AssertionError("joins all pairs of a bucket")
    monkeypatch.setattr(BucketedRandomProjectionLSHModel, "approxSimilarityJoin", refuse)
    got = SIM.lsh_similar_items(cat, k=3, bucket_length=0.25, num_tables=1, max_distance=0.6)
    lists = [sorted((r.product1, r.product2, round(r.similarity, 5), r["rank"]) for r in df.collect()) for df in (want, got)]
    assert lists[0] == lists[1]
    every = SIM.similar_items(cat, k=3, min_similarity=0.4).count()
    assert 0 < len(lists[0]) != every  # the buckets do leave out some


def test_factor_blocks_follow_cores_and_ratings(spark, monkeypatch):
    """More shuffle partitions must not send every factor to more blocks; more ratings than a block holds do."""
    from pyspark.ml import recommendation
    from revue.operators import als as ALS
    asked = []
    monkeypatch.setattr(recommendation.ALS, "fit", lambda self, _: asked.append((self.getNumUserBlocks(), self.getNumItemBlocks())))
    ratings = spark.range(100).selectExpr("int(id % 10) as user_index", "int(id % 7) as item_index", "3.0D as rating")
    cores, before = spark.sparkContext.defaultParallelism, spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        ALS.fit(ratings)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    monkeypatch.setattr(ALS, "BLOCK_RATINGS", 3)
    ALS.fit(ratings)
    ALS.fit(ratings, blocks=5)
    assert asked == [(cores, cores), (34, 34), (5, 5)]


def test_blocks_of_many_ratings_leave_memory_to_other_tasks(spark, monkeypatch):
    """Four tasks of 15 million ratings each need most of a heap of 6 GB."""
    from pyspark.ml import recommendation
    from revue.operators import als as ALS
    asked = []
    monkeypatch.setattr(recommendation.ALS, "fit", lambda self, _: asked.append(self.getNumUserBlocks()))
    ALS.fit(spark.range(216_000_000))
    assert asked == [27]


def test_links_are_joined_to_components_once(spark, monkeypatch):
    """The second round of components is of those that new pairs name, not of all links again."""
    from revue.llm import near_dedup as N
    given, find = [], N.connected_components

    def spy(links):
        given.append(links.count())
        return find(links)
    monkeypatch.setattr(N, "connected_components", spy)
    words = [f"w{k}" for k in range(80)]
    texts = [(k, " ".join([*words[:70 + k % 3], f"x{k}", *words[73:]])) for k in range(12)] + [(50, "alone in the table of texts")]
    got = dict(N.near_dedup(spark.createDataFrame(texts, "doc_id long, text string")).select("doc_id", "class_id").collect())
    assert got == {**{k: 0 for k in range(12)}, 50: 50}
    assert given[0] > 0 and given[1] == 0


def test_merged_components_take_the_smallest_label(spark):
    from revue.llm.near_dedup import _merged
    labelled = spark.createDataFrame([(1, 1), (2, 1), (3, 3), (4, 3), (5, 5), (6, 6)], "node long, comp long")
    more = spark.createDataFrame([(2, 4), (4, 5)], "a long, b long")
    assert dict(_merged(labelled, more).select("node", "comp").collect()) == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 6: 6}


def test_lsh_lists_are_checked_without_making_their_pairs(spark, monkeypatch):
    from revue.operators import similarity as SIM
    from revue.plans import invariants

    def refuse(*_):
        raise AssertionError("expands classes into product pairs")
    monkeypatch.setattr(SIM, "expand", refuse)
    got = invariants.lsh_check(spark, "/root/testdata/sf0.001").first()
    assert got.products > 0 and got.wrong == 0 and got.recalled


def test_personal_lists_are_made_once(spark):
    """The fallback must not run the search behind the personal lists a second time."""
    from revue.operators import recommend as R
    made = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def score(x):
        made.add(1)
        return x
    personal = spark.createDataFrame([("u", "a", 4.5, 1), ("w", "b", 3.5, 1)], "user_id string, product_id string, s double, rank int")
    personal = personal.select("user_id", "product_id", score("s").alias("score"), "rank", F.lit("folded in").alias("source"))
    popular = spark.createDataFrame([("p1", 5.0, 1), ("p2", 4.0, 2)], "product_id string, avg_rating double, rank int")
    users = spark.createDataFrame([("u",), ("new",), ("u",), ("w",)], "user_id string")
    got = sorted(tuple(r) for r in R.with_fallback(users, personal, popular).collect())
    assert got == [("new", "p1", 5.0, 1, "popular"), ("new", "p2", 4.0, 2, "popular"), ("u", "a", 4.5, 1, "folded in"),
                   ("w", "b", 3.5, 1, "folded in")]
    assert made.value == 2
    assert R.with_fallback(users, personal, popular.limit(0)).count() == 2


def test_new_ratings_are_parsed_once_a_row(spark):
    """Folding in reads the ratings once, though the search reads the factors twice."""
    from revue.operators import als as ALS
    from revue.plans import catalog as Q
    _, idx, _, _, model = Q._als_setup(spark, "/root/testdata/sf0.001")
    calls = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def parse(text):
        calls.add(1)
        return None if text == "bad" else float(text)
    items = [r.product_id for r in idx.items.orderBy("item_index").limit(6).collect()]
    rows = [(user, item, text) for user, text in (("new", "4"), ("other", "2"), ("none", "bad")) for item in items]
    ratings = spark.createDataFrame(rows, "user_id string, product_id string, text string")
    got = ALS.recommend_new_users(model, idx, ratings.select("user_id", "product_id", parse("text").alias("rating")), 3)
    assert sorted(r.user_id for r in got.collect()) == ["new"] * 3 + ["other"] * 3
    assert calls.value == len(rows)
