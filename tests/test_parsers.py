"""Edge rows for every parser (FIXTURES section 3)."""

from pyspark.sql import functions as F

from revue.functions import (epoch_to_date, label, normalise_title, parse_helpfulness, parse_price,
                             parse_rating, tokenize)


def run(spark, expr_fn, values, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {dtype}")
    return [r[0] for r in df.select(expr_fn(F.col("v"))).collect()]


def test_price(spark):
    vals = [None, "", "unknown", "$12.50", "1,299.00", "1.2.3", "N/A", ".", "900.0"]
    assert run(spark, parse_price, vals) == [None, None, None, 12.5, 1299.0, None, None, None, 900.0]


def test_rating(spark):
    vals = ["4", "4/5", "3/0", "3/0.0", "/5", "4/", "bad", "-1", None, "4.0", "5/5"]
    got = run(spark, parse_rating, vals)
    assert got[:10] == [4.0, 0.8, None, None, None, None, None, None, None, 4.0]
    assert got[10] == 1.0
    assert run(spark, lambda c: parse_rating(c, fraction_scale=5.0), ["4/5"]) == [4.0]


def test_helpfulness(spark):
    vals = ["7/9", "0/0", "n/a", "7", " 7/9", None, "99999999999/1"]
    assert run(spark, parse_helpfulness, vals) == [7, 0, None, None, None, None, None]


def test_epoch(spark):
    assert run(spark, epoch_to_date, [1362873600, 0, None], "bigint") == ["10/03/2013", "N/A", "N/A"]


def test_title(spark):
    assert run(spark, normalise_title, [None, "Été!", "***", "  ", "Red Widget-2"]) == \
        ["", "t", "", "  ", "red widget2"]


def test_tokenize_like_java_split(spark):
    got = run(spark, tokenize, ["a b", " a", "a  b", "a b  ", "  ", "A\tB"])
    assert got == [["a", "b"], ["", "a"], ["a", "", "b"], ["a", "b"], [], ["a", "b"]]


def test_label(spark):
    df = spark.createDataFrame([("Ann (x)", "U1"), (None, "U2")], "n string, k string")
    assert [r[0] for r in df.select(label("n", "k")).collect()] == ["Ann (x) (U1)", None]
