"""Connected components of a link table, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revue.conf import materialize

SALTS = 64


def lookup(rows: DataFrame, key: str, other: str, values: DataFrame, value_key: str) -> DataFrame:
    """``rows`` with the columns of ``values`` (one row per ``value_key``) where ``key`` equals it; an inner join.

    A hot key's rows are dealt out by (key, a salt of column ``other``); the value is copied once for each
    pair of these that occurs, at most ``SALTS`` times.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(other), F.lit(SALTS)).cast("int"))
    asked = salted.select(F.col(key).alias("_key"), "_salt").distinct()
    copies = asked.join(values, asked["_key"] == values[value_key]).drop(value_key)
    found = salted.withColumnsRenamed({key: "_own", "_salt": "_own_salt"})
    return (found.join(copies, (F.col("_own") == F.col("_key")) & (F.col("_own_salt") == F.col("_salt")))
            .withColumnRenamed("_own", key).drop("_key", "_salt", "_own_salt"))


def connected_components(links: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``links`` (a, b); comp is the smallest node of the component.

    Each round gives a node the smallest label among itself and its neighbours, then
    the label of that label, so chains shorten by more than half a round. Every round is
    written to the shared folder, which also cuts the lineage. Only a count of changed labels
    reaches the driver. A node with many neighbours and a label of many nodes are looked up by salt.
    """
    both = materialize(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct(), "links")
    labels = materialize(both.groupBy(F.col("a").alias("node"))
                         .agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("comp")), "labels")
    while True:
        near = lookup(both, "b", "a", labels, "node").groupBy("a").agg(F.min("comp").alias("low"))
        step = (labels.join(near, labels["node"] == near["a"])
                .select("node", F.col("comp").alias("was"), F.least("comp", "low").alias("comp")))
        # a label is a node of its component, so every label is found
        jumped = (lookup(step, "comp", "node", step.select(F.col("node").alias("up"), F.col("comp").alias("top")), "up")
                  .select("node", "was", F.least("comp", "top").alias("comp")))
        jumped = materialize(jumped, "labels")
        labels = jumped.select("node", "comp")
        if not jumped.where("comp <> was").limit(1).count():
            return labels
