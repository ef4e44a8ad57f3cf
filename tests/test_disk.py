"""Shuffle files that no later step reads must not stay on disk (findings of round 4)."""

import time

from pyspark.sql import functions as F

from revue.conf import checkpointed, materialize


def shuffles(spark):
    """Shuffles with files on disk."""
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [files.apply(i).getName() for i in range(files.length())]
    return {name.split("_")[1] for name in names if name.startswith("shuffle_") and name.endswith(".data")}


def left(spark, before, at_most):
    """New shuffles on disk, once no more than ``at_most`` are left: deleting goes on in the background."""
    for _ in range(50):
        new = shuffles(spark) - before
        if len(new) <= at_most:
            break
        time.sleep(0.1)
    return len(new)


def test_written_tables_leave_no_shuffle_files(spark):
    rows = spark.range(5000).select("id", (F.col("id") % 70).alias("k")).groupBy("k").agg(F.sum("id").alias("s")).repartition(5, "s")
    before = shuffles(spark)
    for keep in (lambda df: materialize(df, "kept"), checkpointed):
        assert keep(rows).agg(F.sum("s")).collect()[0][0] == sum(range(5000))
    # the last sums are planned by the caller, whose own plans keep their files
    assert left(spark, before, 2) <= 2


def test_a_fit_keeps_the_factors_of_few_iterations(spark):
    from revue.operators import als as ALS
    ratings = spark.range(4000).selectExpr("int(id % 61) as user_index", "int(id % 97) as item_index", "double(id % 5) as rating")
    ratings = materialize(ratings, "ratings")
    before = shuffles(spark)
    model = ALS.fit(ratings, rank=3, maxIter=9, regParam=0.1, blocks=3)
    assert model.userFactors.count() == 61
    assert left(spark, before, 9) <= 9  # each iteration has two, blocks of ratings and their counts a few more


def test_pairs_of_copies_are_not_stored(spark, monkeypatch):
    from revue.plans import catalog as Q
    from revue.plans import stages
    sf, written, write = "/root/testdata/sf0.01", {}, stages.materialize

    def spy(df, name):
        out = write(df, name)
        written[name] = written.get(name, 0) + out.count()
        return out
    monkeypatch.setattr(stages, "materialize", spy)
    monkeypatch.setattr(stages, "_MEMO", {})
    pairs = Q.q_similar_items(spark, sf).count()
    assert pairs > written["simitems"] > 0 and "simclasses" in written
    assert max(written.values()) < pairs


def test_ranked_rows_lie_on_disk_in_columns(spark):
    """A checkpoint holds uncompressed rows: three times the bytes for a table of reviews."""
    from revue.operators.positions import rank_in_key
    rows = spark.range(300).select((F.col("id") % 7).alias("k"), "id")
    ranked = rank_in_key(rows, ["k"], [F.desc("id")])
    assert [f for f in ranked.inputFiles() if f.endswith(".parquet")]
    assert sorted(r["rank"] for r in ranked.where("k = 3").collect()) == list(range(1, 44))


def test_compressed_exports_read_back_as_they_were(spark, tmp_path):
    from revue.sources import io
    rows = [("a\nb", 0.1), ('say "hi", ok', None), ("", 1 / 3), (None, -0.0)]
    back = io.export_table(spark, spark.createDataFrame(rows, "title string, price double"), str(tmp_path / "a"), compression="gzip")
    assert sorted(map(repr, map(tuple, back.collect()))) == sorted(map(repr, rows))
    assert back.inputFiles() and all(f.endswith(".csv.gz") for f in back.inputFiles())


def test_compared_exports_leave_few_shuffle_files(spark, monkeypatch):
    from revue.plans import invariants
    reports = {f"r{k}": lambda s, _: s.range(200).select("id", (F.col("id") % 5).alias("k")) for k in range(6)}
    monkeypatch.setattr(invariants, "EXPORTS", reports)
    before = shuffles(spark)
    got = invariants.export_reports(spark, "/root/testdata/sf0.001").collect()
    assert sorted(tuple(r) for r in got) == [(f"r{k}", 200, 0) for k in range(6)]
    assert left(spark, before, 6) <= 6  # those of the six counts at the end, planned by the caller
