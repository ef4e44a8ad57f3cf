"""Exact dedup, sharding, mixing, URL filter: against SQL, brute force and the messy table."""

import datetime as dt
import hashlib
import re
import zlib

import pytest

from revue.llm import exact_dedup, mixing, sharding, url_filter
from tests.llm.conftest import LONG, ORACLE, QUERIES, SMALL, oracle, rows_of


def key(row):
    return [(x is None, str(x)) for x in row]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    df = QUERIES[name](spark, SMALL)
    columns, want = oracle(name)
    assert sorted(df.columns) == sorted(columns)
    got = [tuple(r[c] for c in columns) for r in df.collect()]
    assert sorted(got, key=key) == sorted(want, key=key)


@pytest.mark.parametrize(("runs", "fan_in"), [(2, 2), (64, 8), (27, 3)])
def test_dedup_brute_force(spark, small, runs, fan_in):
    groups = {}
    for r in small.collect():
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", r.text or ""), []).append((-len(r.text or ""), r.doc_id))
    want = sorted((i, min(g)[1], len(g), i == min(g)[1], hashlib.sha256(t.encode()).hexdigest())
                  for t, g in groups.items() for _, i in g)
    got = exact_dedup.exact_dedup(small, runs=runs, fan_in=fan_in)
    assert rows_of(got, *got.columns) == want


def test_dedup_messy(messy, empty):
    got = rows_of(exact_dedup.exact_dedup(messy), "doc_id", "keep_id", "group_size", "kept")
    # 2 has more code points than 1 and 3; " \n" more than null and ""; repeated rows are flagged alike.
    assert got == [(1, 2, 3, False), (2, 2, 3, True), (3, 2, 3, False), (4, 6, 3, False), (5, 6, 3, False),
                   (6, 6, 3, True), (7, 7, 2, True), (7, 7, 2, True), (8, 8, 1, True), (9, 9, 2, True), (9, 9, 2, True),
                   (None, None, 1, True)]
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_hot_group_is_whole(spark):
    df = spark.range(5000).selectExpr("id as doc_id", "if(id % 3 = 0, 'same', cast(id as string)) as text")
    got = exact_dedup.exact_dedup(df, runs=64)
    assert got.where("keep_id = 0").count() == 1667 and got.count() == 5000
    assert got.where("keep_id = 0 and group_size <> 1667").count() == 0


def test_shards_follow_the_mixture(spark):
    df = spark.range(3200).selectExpr("id as doc_id", "'x' as text",
                                      "if(id % 3 = 0, 'hot', concat('s', id % 4)) as source")
    got = sharding.interleave(df, 16).toPandas()
    sizes = got.groupby("shard").size()
    assert len(sizes) == 16 and sizes.max() - sizes.min() <= 1
    per = got.groupby(["source", "shard"]).size().unstack()
    assert ((per.max(axis=1) - per.min(axis=1)) <= 2).all()
    assert all(sorted(g["slot"]) == list(range(len(g))) for _, g in got.groupby("shard"))


def test_shards_messy(messy, empty, spark, tmp_path):
    got = sharding.interleave(messy, 5)
    assert sorted(r["size"] for r in got.collect()) == sorted([6, 7, 4, 1, 1, 3, 18, len(LONG) + 1, len(LONG) + 1, 8, 9, 9])
    assert {r["text_crc32"] for r in got.where("doc_id = 9").collect()} == {zlib.crc32("é à ü".encode())}
    assert sorted(r["count"] for r in got.groupBy("shard").count().collect()) == [2, 2, 2, 3, 3]
    assert sharding.interleave(empty, 5).count() == 0
    assert sharding.interleave(messy, 100).select("shard").distinct().count() == 12
    one = messy.where("doc_id < 7")
    sharding.write_shards(one, str(tmp_path / "out"), 3)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert rows_of(back, "doc_id", "text") == rows_of(one, "doc_id", "text")


def fill(sources, weights, share, epochs):
    """Iterative water-filling: clamp what overflows, redistribute by weight until nothing does."""
    budget = sum(sources.values()) * share
    target, free = {}, [s for s in sources if weights[s] > 0]
    while free:
        level = (budget - sum(target.values())) / sum(weights[s] for s in free)
        over = [s for s in free if level * weights[s] > sources[s] * epochs]
        if not over:
            return target | {s: level * weights[s] for s in free} | {s: 0.0 for s in sources if weights[s] == 0}
        for s in over:
            target[s] = sources[s] * epochs
            free.remove(s)
    return target | {s: 0.0 for s in sources if weights[s] == 0}


@pytest.mark.parametrize(("sizes", "weights", "share", "epochs"), [
    ({"a": 10, "b": 100, "c": 1000}, {"a": 5.0, "b": 2.0, "c": 1.0}, 1.5, 2.0),
    ({"a": 10, "b": 100, "c": 1000}, {"a": 1.0, "b": 0.0, "c": 1.0}, 0.5, 1.0),
    ({"a": 10, "b": 10}, {"a": 1.0, "b": 3.0}, 5.0, 2.0),
    ({"a": 0, "b": 7, "c": 7}, {"a": 9.0, "b": 1.0, "c": 1.0}, 1.0, 1.5)])
def test_water_fill(spark, sizes, weights, share, epochs):
    df = spark.createDataFrame([(s, n, weights[s]) for s, n in sizes.items()], "src string, source_size long, weight double")
    got = {r.src: r.target for r in mixing.water_fill(df, share, epochs).collect()}
    assert got == pytest.approx(fill(sizes, weights, share, epochs))


def test_mix_takes_near_targets_and_rows_agree(spark, small):
    plan = mixing.mix(small, [5.0, 2.0, 1.0], 1.5, 2.0).toPandas()
    for _, g in plan.groupby("source"):
        assert abs(g["taken"].sum() - g["target"].iloc[0]) <= g["size"].max() / 2 + 1e-6
    assert (plan["taken"] <= 2 * plan["size"]).all() and plan["taken"].sum() > 0
    words = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in small.collect()}
    assert dict(zip(plan["doc_id"], plan["size"], strict=True)) == words
    rows = mixing.mixed_rows(small, [5.0, 2.0, 1.0], 1.5, 2.0)
    assert rows.columns == small.columns
    count = {r.doc_id: r["count"] for r in rows.groupBy("doc_id").count().collect()}
    assert count == {d: n for d, n in zip(plan["doc_id"], plan["reps"], strict=True) if n}


def test_mix_messy(messy, empty):
    got = mixing.mix(messy, [1.0], 1.0, 1.0)
    assert sorted(r["size"] for r in got.collect()) == [0, 0, 0, 1, 2, 3, 3, 3, 3, 5, 24000, 24000]
    assert all(r["taken"] == r["size"] for r in got.collect())
    whole = mixing.mixed_rows(messy, [1.0], 2.0, 2.0)
    assert whole.columns == messy.columns and whole.count() == 24  # every row twice
    assert mixing.mix(empty, [1.0]).count() == 0 and mixing.mixed_rows(empty, [1.0]).count() == 0


def test_intervals(spark):
    d = dt.date
    events = spark.createDataFrame([
        ("A.x", "spam", "add", d(2024, 1, 1)), ("a.x", "spam", "remove", d(2024, 2, 1)),
        ("a.x", "spam", "add", d(2024, 3, 1)), ("a.x", "spam", "add", d(2024, 4, 1)),
        ("b.x", "spam", "remove", d(2024, 1, 1)), ("b.x", "spam", "add", d(2024, 1, 5)), ("b.x", "spam", "remove", d(2024, 1, 5)),
        ("c.x", "spam", "add", None), (None, "spam", "add", d(2024, 1, 1)), ("d.x", "spam", "drop", d(2024, 1, 1))],
        "entry string, category string, action string, event_date date")
    assert rows_of(url_filter.intervals(events), "entry", "valid_from", "valid_to") == [
        ("a.x", d(2024, 1, 1), d(2024, 2, 1)), ("a.x", d(2024, 3, 1), None)]


def test_url_filter_cases(spark):
    d = dt.date
    events = spark.createDataFrame([
        ("bad.org", "spam", "add", d(2024, 1, 10)), ("bad.org", "spam", "remove", d(2024, 2, 1)),
        ("ok.bad.org", "allow", "add", d(2024, 1, 1)), ("site.com/a", "adult", "add", d(2024, 1, 1)),
        ("site.com/a", "allow", "add", d(2024, 3, 1))], "entry string, category string, action string, event_date date")
    urls = [("http://BAD.org/x", d(2024, 1, 10), "block"), ("http://bad.org./x", d(2024, 1, 9), "allow"),
            ("http://u:p@www.bad.org:80/x", d(2024, 1, 31), "block"), ("http://bad.org", d(2024, 2, 1), "allow"),
            ("http://ok.bad.org/", d(2024, 1, 15), "allow"), ("http://notbad.org/", d(2024, 1, 15), "allow"),
            ("https://site.com/a/b?q", d(2024, 1, 15), "block"), ("https://site.com/ab", d(2024, 1, 15), "allow"),
            ("https://site.com/a", d(2024, 3, 1), "allow"), (None, d(2024, 1, 15), "allow"), ("http://bad.org", None, "allow"),
            ("no url", d(2024, 1, 15), "allow"), ("", d(2024, 1, 15), "allow"), ("http://bad.org/" + "p/" * 300, d(2024, 1, 15), "block")]
    captures = spark.createDataFrame([(*u, "x", "y") for u in urls + urls[:1]],
                                     "url string, fetched_on date, want string, m string, entry string")
    got = url_filter.url_filter(captures, events)
    assert got.count() == len(urls) + 1 and got.where("decision <> want").count() == 0
    assert got.columns == ["url", "fetched_on", "want", "m", "host", "entry", "category", "valid_from", "decision"]
    assert url_filter.url_filter(captures, events.limit(0)).where("decision = 'block'").count() == 0
    assert url_filter.url_filter(captures.limit(0), events).count() == 0


def test_long_paths_and_hosts_are_looked_up_fast(spark):
    import time
    deep = "https://a.b.example.org/" + "/".join(f"s{k}" for k in range(100_000))
    urls = [deep, deep.replace("/s1/", "/x/"), "http://example.org" + "/" * 100_000 + "en/x", "http://[2001:DB8::1]:80/en",
            "http://" + "w." * 20_000 + "example.org/s0/s1", "http://example.org"]
    captures = spark.createDataFrame([(u, "2024-05-05") for u in urls], "url string, fetched_on string")
    lists = [("example.org/s0/s1", "spam"), ("example.org/en", "adult"), ("[2001:db8::1]", "spam"), ("b.example.org/s0", "allow")]
    events = spark.createDataFrame([(e, c, "add", "2024-01-01") for e, c in lists], "entry string, category string, action string, event_date string")
    began = time.time()
    got = {r["url"]: (r["host"][-15:], r["entry"], r["decision"]) for r in url_filter.url_filter(captures, events).collect()}
    assert time.time() - began < 60
    assert [got[u] for u in urls] == [
        ("a.b.example.org", "example.org/s0/s1", "block"), ("a.b.example.org", "b.example.org/s0", "allow"),
        ("example.org", "example.org/en", "block"), ("[2001:db8::1]", "[2001:db8::1]", "block"),
        (("w." * 20_000 + "example.org")[-15:], "example.org/s0/s1", "block"), ("example.org", None, "allow")]
