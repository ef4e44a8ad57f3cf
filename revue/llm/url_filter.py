"""Temporal list join: URL captures against dated filter lists, as of the fetch date.

List events (entry, category, action, event_date) become validity intervals
[valid_from, valid_to): an ``add`` opens one, the next event of the same entry and
category closes it. A capture is evaluated against the entries whose interval holds
its fetch date. An entry is a host ("bad.example.org"), which covers its subdomains,
or a host with a path prefix ("bad.example.org/en"), which covers whole path segments.

A URL is looked up by its host suffixes with as many labels, and its path prefixes with as many segments, as some
listed entry has, so a URL of a hundred thousand segments has no more keys than a short one.

Hot hosts: captures are first reduced to distinct (URL, date), their lookup keys to
distinct (key, date), and only those meet the intervals. The decisions, which are few,
are replicated over ``salts`` and joined back to salted rows, so a host with a third of
all captures is spread over many tasks. No table is broadcast by hand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revue.conf import materialize

SALTS = 16
#: What a capture's decision is called.
ALLOW, BLOCK = "allow", "block"


def intervals(events: DataFrame) -> DataFrame:
    """Validity intervals of list entries: entry, category, valid_from, valid_to (null: still open).

    Events with a null entry, category, action or date are ignored, as are actions other than
    ``add`` and ``remove``. Of several events of one entry, category and day the
    removal wins (the interval is empty). A second ``add`` without removal continues
    the entry. Entries are compared in lower case.
    """
    day = (events.select(F.lower(F.btrim("entry")).alias("entry"), "category", "action",
                         F.col("event_date").cast("date").alias("event_date"))
           .where(F.col("entry").isNotNull() & F.col("category").isNotNull() & F.col("event_date").isNotNull()
                  & F.col("action").isin("add", "remove"))
           .groupBy("entry", "category", "event_date").agg(F.max("action").alias("action")))
    line = Window.partitionBy("entry", "category").orderBy("event_date")
    changes = (day.withColumn("was", F.lag("action").over(line))
               .where((F.col("action") == "add") & F.coalesce(F.col("was") != "add", F.lit(True))
                      | (F.col("action") == "remove") & (F.col("was") == "add")))
    return (changes.withColumn("valid_to", F.lead("event_date").over(line))
            .where(F.col("action") == "add")
            .select("entry", "category", F.col("event_date").alias("valid_from"), "valid_to"))


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and trailing dots; null if the URL has none. An IPv6 address keeps its brackets."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:\[]+)", 1))
    host = F.rtrim(host, F.lit("."))
    return F.when(host != "", host)


def path_of(url: Column) -> Column:
    """Lower-case path without query, fragment and slashes at its ends."""
    return F.lower(F.btrim(F.regexp_extract(url, r"^[^/?#]*//[^/?#]*([^?#]*)", 1), F.lit("/")))


def entry_shapes(entries: DataFrame) -> tuple[list[int], list[int]]:
    """The numbers of host labels and of path segments that entries have."""
    parts = F.split("entry", "/")
    found = entries.agg(F.array_sort(F.collect_set(F.size(F.split(parts[0], r"\.")))).alias("labels"),
                        F.array_sort(F.collect_set(F.size(parts) - 1)).alias("segments")).first()
    return found["labels"], found["segments"]


def lookup_keys(host: Column, path: Column, shapes: tuple[list[int], list[int]]) -> Column:
    """All entries of these shapes that would cover the URL: host suffixes with path prefixes."""
    labels, segments = F.split(host, r"\."), F.split(path, "/+")
    counts = [F.array(*map(F.lit, some)).cast("array<int>") for some in shapes]
    depth = F.when(path == "", 0).otherwise(F.size(segments))
    hosts = F.transform(F.filter(counts[0], lambda k: k <= F.size(labels)),
                        lambda k: F.array_join(F.slice(labels, F.size(labels) - k + 1, k), "."))
    prefixes = F.transform(F.filter(counts[1], lambda n: n <= depth),
                           lambda n: F.array_join(F.concat(F.array(F.lit("")), F.slice(segments, 1, n)), "/"))
    return F.array_distinct(F.flatten(F.transform(hosts, lambda h: F.transform(prefixes, lambda p: F.concat(h, p)))))


def url_filter(captures: DataFrame, events: DataFrame, url_col: str = "url", date_col: str = "fetched_on",
               salts: int = SALTS) -> DataFrame:
    """Add host, entry, category, valid_from, decision to ``captures`` (one row each, repeats kept).

    Of the entries active at fetch time the most specific (longest) decides, ``allow``
    before others, then the latest ``valid_from``, then the category by code point. Decision: ``allow`` if none is
    active, if the URL is null or has no host, or if the date is null. The five added
    names replace columns of the same name; all other columns pass through.
    """
    added = ["host", "entry", "category", "valid_from", "decision"]
    keep = captures.drop(*[c for c in captures.columns if c.lower() in added])
    asked = (captures.select(F.col(url_col).alias("q_url"), F.col(date_col).cast("date").alias("q_date"))
             .where(F.col("q_url").isNotNull() & F.col("q_date").isNotNull()).distinct()
             .withColumn("q_host", host_of(F.col("q_url"))).where(F.col("q_host").isNotNull()))
    spans = materialize(intervals(events), "url-intervals")
    # dealt out evenly: what is left of a shuffle of few bytes would be one task
    spread = asked.repartition(int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    keyed = materialize(spread.select("q_url", "q_date", F.explode(lookup_keys(
        F.col("q_host"), path_of(F.col("q_url")), entry_shapes(spans))).alias("entry")), "url-keys")
    active = F.col("q_date") >= F.col("valid_from")
    active = active & (F.col("valid_to").isNull() | (F.col("q_date") < F.col("valid_to")))
    order = F.struct((F.col("category") == ALLOW).alias("a"), F.col("valid_from").alias("b"))
    found = (keyed.select("entry", "q_date").distinct().join(spans, "entry").where(active)
             .groupBy("entry", "q_date").agg(F.max(order).alias("top"),
                                             F.min(F.struct((F.col("category") != ALLOW).alias("a"),
                                                            F.date_diff(F.lit("9999-12-31").cast("date"), "valid_from").alias("b"),
                                                            F.col("category").alias("c"))).alias("best"))
             .select("entry", "q_date", F.col("best.c").alias("category"), F.col("top.b").alias("valid_from")))
    salted = found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    specific = F.max(F.struct(F.length("entry").alias("len"), "entry", "category", "valid_from")).alias("m")
    decided = (keyed.withColumn("salt", F.pmod(F.xxhash64("q_url"), F.lit(salts)).cast("int"))
               .join(salted, ["entry", "q_date", "salt"]).groupBy("q_url", "q_date").agg(specific))
    m = decided["m"]
    return (keep.join(decided, keep[url_col].eqNullSafe(decided["q_url"])
                      & keep[date_col].cast("date").eqNullSafe(decided["q_date"]), "left")
            .select(*[keep[c] for c in keep.columns], host_of(keep[url_col]).alias("host"),
                    m["entry"].alias("entry"), m["category"].alias("category"), m["valid_from"].alias("valid_from"),
                    F.when(F.coalesce(m["category"], F.lit(ALLOW)) == ALLOW, ALLOW).otherwise(BLOCK).alias("decision")))
