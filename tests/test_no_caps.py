"""No default cuts rows: data above every bound that an earlier version had; and the wrong answers it gave."""

import pytest
from pyspark.sql import functions as F

from revue import conf
from revue.functions.parse import epoch_to_date, parse_helpfulness
from revue.operators import evaluate as EV
from revue.operators import features as FT
from revue.operators import recommend as R
from revue.operators import similarity as SIM
from revue.operators import stats as S
from revue.plans import catalog as Q
from revue.sources import io

SF = "/root/testdata/sf0.01"


def test_sample_does_not_depend_on_the_number_of_rows(spark):
    for n in (90_000, 130_000):
        df = spark.range(n).select(F.concat(F.lit("U"), "id").alias("user_id"), F.lit("P1").alias("product_id"))
        assert EV.sample_reviews(df, 1.0).count() == n
        assert EV.sample_reviews(df, 0.5).count() == pytest.approx(n / 2, rel=0.02)


def test_vocabulary_keeps_every_term(spark):
    words = [f"w{k}" for k in range(1500)]
    rows = [(f"P{d}{k}", f"{w} common", 1.0) for k, w in enumerate(words) for d in "ab"]
    feats = FT.TitleFeatures(spark.createDataFrame(rows, "product_id string, title string, price double"))
    assert feats.vocab.count() == 1501
    docs = FT.TitleFeatures(spark.createDataFrame(rows, "product_id string, title string, price double"), vocab_size=10)
    assert docs.vocab.count() == 10


def test_lsh_points_keep_every_term(spark):
    # 270,000 terms, each in two products: more than CountVectorizer's default of 262,144.
    df = spark.range(540).select(
        F.concat(F.lit("P"), "id").alias("product_id"), F.col("id").cast("double").alias("price"),
        F.expr("array_join(transform(sequence(0, 999), k -> concat('w', (id div 2) * 1000 + k)), ' ')").alias("title"))
    points = [r.point for r in SIM.lsh_points(FT.TitleFeatures(df, materialize=True)).collect()]
    assert len(points) == 540 and {len(p) for p in points} == {270_001}
    assert {len(p.indices) for p in points} == {1001}
    assert len({int(i) for p in points for i in p.indices}) == 270_001


def test_lsh_points_have_the_weights_of_the_title_terms(spark):
    rows = [("A", "red gear", 1.0), ("B", "red gear gear", 2.0), ("C", "the", 3.0), ("D", "blue gear", None)]
    feats = FT.TitleFeatures(spark.createDataFrame(rows, "product_id string, title string, price double"), materialize=True)
    weights = {}
    for r in feats.product_weights().collect():
        weights.setdefault(r.product_id, {})[r.term] = r.weight
    got = {r.pid: r.point for r in SIM.lsh_points(feats).collect()}
    terms = sorted({t for w in weights.values() for t in w})
    assert set(got) == {"A", "B", "C"} and terms == ["gear", "red"]
    for pid, price in (("A", 0.0), ("B", 0.5), ("C", 1.0)):
        assert got[pid].toArray().tolist() == pytest.approx([price, *(weights.get(pid, {}).get(t, 0.0) for t in terms)])


def test_histories_hold_all_reviews(spark):
    df = spark.range(1500).select(F.lit("U1").alias("user_id"), F.lit("P1").alias("product_id"), F.lit("t").alias("title"),
                                  F.lit("n").alias("user_name"), F.lit(4.0).alias("rating"), F.lit(1).alias("helpful_votes"),
                                  F.lit("s").alias("review_summary"), F.lit("x").alias("review_text"),
                                  F.col("id").alias("review_time"))
    assert S.user_history(df).count() == 1500 and S.product_reviews(df).count() == 1500
    assert S.user_history(df, 1000).count() == 1000


def test_export_is_whole_and_values_survive(spark, tmp_path):
    rows = [(" 7/9", "a\nb", 0.1), ("7/9 ", 'say "hi", ok', 1 / 3), ("", None, None), (None, "\\", 2.0), ("x,y", "'", -0.0)]
    df = spark.createDataFrame(rows, "helpfulness string, title string, price double")
    back = io.export_table(spark, df, str(tmp_path / "a"))
    assert sorted(map(repr, map(tuple, back.collect()))) == sorted(map(repr, rows))
    assert [r[0] for r in back.where("title like 'a%' or title like 'say%'").select(parse_helpfulness("helpfulness")).collect()] == [None, None]
    many = spark.range(25_000).selectExpr("id", "cast(id as string) as s")
    assert io.export_table(spark, many, str(tmp_path / "b")).count() == 25_000
    assert io.export_table(spark, many, str(tmp_path / "c"), n=10, order_by=["id"]).count() == 10


def test_more_than_twenty_content_recommendations(spark):
    sf = "/root/testdata/sf0.001"
    few, many = Q.content_recs(spark, sf, 20), Q.content_recs(spark, sf, 40)
    assert many.where("rank <= 20").count() == few.count()
    assert many.where("rank > 20").count() > 0


def test_similar_rows_are_bounded(spark):
    products = Q.catalog(spark, SF).count()
    assert Q.sims(spark, SF, "row_number").count() <= 10 * products


def test_similar_by_rating_excludes_whole_products(spark):
    rows = [("A", "t1", 5.0), ("A", "t2", 4.9), ("B", "b", 4.8), ("C", "c", 4.7), ("E", "e", 4.6)]
    df = spark.createDataFrame(rows, "product_id string, title string, rating double")
    got = S.similar_by_rating(df, 3)
    assert [(r.product_id, r["rank"]) for r in got.where("excluded_id = 'A'").orderBy("rank").collect()] == [
        ("B", 1), ("C", 2), ("E", 3)]
    assert [(r.product_id, r.title) for r in got.where("excluded_id = 'B'").orderBy("rank").collect()] == [
        ("A", "t1"), ("A", "t2"), ("C", "c")]
    assert got.where("excluded_id is null").count() == 3


def test_content_score_is_not_rounded_to_tenths(spark):
    reviews = spark.createDataFrame([("U", "P1", 1 / 3)], "user_id string, product_id string, rating double")
    sims = spark.createDataFrame([("P1", "P2", 1.0)], "product1 string, product2 string, similarity double")
    assert R.content_candidates(reviews, sims).first().total_score == pytest.approx(-4 / 3, abs=1e-9)


@pytest.mark.parametrize(("seconds", "text"), [(1362873600, "10/03/2013"), (0, "N/A"), (None, "N/A"), (10 ** 16, "N/A"),
                                               (1362873600000, "N/A"), (253402300799, "31/12/9999"), (253402300800, "N/A"),
                                               (-1, "31/12/1969"), (-62135596801, "N/A")])
def test_epoch_to_date(spark, seconds, text):
    df = spark.createDataFrame([(seconds,)], "t long")
    assert df.select(epoch_to_date("t")).first()[0] == text


def test_served_als_beats_the_product_mean(spark):
    got = Q.QUERIES["als_metrics"](spark, SF).first()
    _, _, train, test, _ = Q._als_setup(spark, SF)
    mean = EV.error_metrics(EV.product_mean_predictions(train.select("product_id", "rating"),
                                                        test.select("product_id", "rating"))).first()
    assert got["n"] > 0 and got["rmse"] < mean["rmse"]


def test_failing_grid_settings_are_told(spark):
    from revue.operators import als as ALS
    df = spark.createDataFrame([(k % 4, k % 5, float(k % 3)) for k in range(40)], "user_index int, item_index int, rating double")
    got = {r["rank"]: r for r in ALS.grid_search(df, df, {"rank": [0, 2], "regParam": [0.1], "maxIter": [1]}).collect()}
    assert got[2].error is None and got[2].n_valid == 40
    assert got[0].error and got[0].rmse is None


def test_a_cluster_must_name_its_shared_folder(spark, monkeypatch):
    class Session:
        class conf:
            get = staticmethod(lambda *_: None)

        class sparkContext:
            master = "spark://host:7077"
    with pytest.raises(ValueError, match="checkpoint.dir"):
        conf.scratch_root(Session)
