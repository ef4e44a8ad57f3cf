"""Mixing sources to target weights by capped water-filling.

A budget of words is poured over the sources in proportion to their weights; a source
is clamped at ``max_epochs`` times its size, and what it cannot take is poured over the
others by weight until none overflows. The level at which this ends is found at once:
with sources in the order of cap / weight, the clamped ones are a prefix, and the level
is (budget - their caps) / (weight of the others) at the first source that stays below.

Each source is then repeated whole as often as its target allows, and once more for a
seeded part of its rows: rows in the order of a seeded hash, as long as the middle of
the row lies below the rest of the target. The words taken miss the target by half a
document at most. The running totals are dealt over 4,096 slices a source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revue.conf import materialize
from revue.llm.prefix import running_total, seeded_key

#: Fixed value: white space of the word count (space, tab to carriage return).
BLANKS = " \t\n\x0b\f\r"
#: So many of the largest sources are broadcast (a name and a few numbers each); any other has less than this share of the rows.
LARGE_SOURCES = 10_000


def word_count(text: Column) -> Column:
    """Number of runs of characters other than space and tab to carriage return; null: 0."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.length(F.regexp_replace(trimmed, r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", "x")).cast("long")


def water_fill(sources: DataFrame, share: float, max_epochs: float) -> DataFrame:
    """Add ``target`` to (src, source_size, weight): one row per source, null source allowed.

    The budget is ``share`` times the sum of all sizes. Sources without words or
    weight get 0. The table has one row per source name, not per document.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    s = sources.withColumn("cap", cap).withColumn(
        "ratio", F.when(F.col("weight") > 0, F.col("cap") / F.col("weight")))
    line = Window.orderBy(F.col("ratio").asc_nulls_last(), F.col("src").asc_nulls_last())
    everything = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = (s.withColumn("spare", F.sum("source_size").over(everything) * F.lit(float(share))
                      - (F.sum("cap").over(line.rowsBetween(Window.unboundedPreceding, 0)) - F.col("cap")))
         .withColumn("open", F.sum("weight").over(line.rowsBetween(0, Window.unboundedFollowing)))
         .withColumn("level", F.when(F.col("ratio").isNotNull(), F.col("spare") / F.col("open")))
         .withColumn("nth", F.row_number().over(line))
         .withColumn("free", F.col("ratio") > F.col("level")))
    s = (s.withColumn("first_free", F.min(F.when(F.col("free"), F.col("nth"))).over(everything))
         .withColumn("water", F.max(F.when(F.col("nth") == F.col("first_free"), F.col("level"))).over(everything)))
    target = (F.when(F.col("ratio").isNull(), F.lit(0.0))
              .when(F.col("nth") >= F.col("first_free"), F.col("weight") * F.col("water"))
              .otherwise(F.col("cap")))
    return s.select("src", "source_size", "weight", target.alias("target"))


def rank_weights(sizes: DataFrame, cycle: list[float]) -> DataFrame:
    """Add ``weight``: the cycle repeated over the sources by code point, null last."""
    nth = F.row_number().over(Window.orderBy(F.col("src").asc_nulls_last())) - 1
    weights = F.array(*[F.lit(float(w)) for w in cycle])
    return sizes.withColumn("weight", F.element_at(weights, (F.pmod(nth, F.lit(len(cycle))) + 1).cast("int")))


def sized_rows(df: DataFrame, seed: str, id_col: str, source_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).alias("id"), F.col(source_col).alias("src"),
                     word_count(F.col(text_col)).alias("size"), seeded_key(id_col, seed).alias("_key"))


def _planned(df: DataFrame, weights: DataFrame | list[float], share: float, max_epochs: float, seed: str,
             id_col: str, source_col: str, text_col: str) -> DataFrame:
    """id, src, size, _key, source_size, target, whole, extra of every row."""
    rows = materialize(sized_rows(df, seed, id_col, source_col, text_col), "mix-sizes")
    totals = running_total(rows, ["src"], "size", ["id", "size"])
    sizes = rows.groupBy("src").agg(F.sum("size").alias("source_size"))
    if isinstance(weights, list):
        weighed = rank_weights(sizes, weights)
    else:
        w = weights.select(F.col("src").alias("w_src"), F.col("weight").cast("double"))
        weighed = (sizes.join(w, F.col("src").eqNullSafe(F.col("w_src")), "left").drop("w_src")
                   .withColumn("weight", F.coalesce("weight", F.lit(0.0))))
    goals = water_fill(weighed, share, max_epochs).select(F.col("src").alias("g_src"), "source_size", "target")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.col("target") - F.col("whole") * F.col("source_size")
    return (totals.join(goals, F.col("src").eqNullSafe(F.col("g_src"))).withColumn("whole", whole.cast("long"))
            .withColumn("extra", (rest > 0) & (2 * F.col("_before") + F.col("size") <= 2 * rest)))


def mix(df: DataFrame, weights: DataFrame | list[float], share: float = 1.0, max_epochs: float = 2.0,
        seed: str = "mix", id_col: str = "doc_id", source_col: str = "source",
        text_col: str = "text") -> DataFrame:
    """Return id, source, size, source_size, target, reps, taken: one row per input row.

    ``weights`` is a table (src, weight) with one row per source (a source without a row
    has weight 0), or a list of weights that is repeated over the sources by code point.
    ``reps`` is how often the mix takes the row, ``taken`` = reps * size. Null text has 0
    words, null sources form one source, a null id counts as an empty id in the seeded
    order; rows that repeat an id, size and source are interchangeable. Empty table: empty
    result. ``reps`` never exceeds ``max_epochs`` rounded up.
    """
    reps = F.col("whole") + F.col("extra").cast("long")
    return (_planned(df, weights, share, max_epochs, seed, id_col, source_col, text_col)
            .select(F.col("id").alias(id_col), F.col("src").alias(source_col), "size", "source_size", "target",
                    reps.alias("reps"), (reps * F.col("size")).alias("taken")))


def mixed_rows(df: DataFrame, weights: DataFrame | list[float], share: float = 1.0, max_epochs: float = 2.0,
               seed: str = "mix", id_col: str = "doc_id", source_col: str = "source",
               text_col: str = "text") -> DataFrame:
    """The rows of ``df``, whole, each as often as ``mix`` takes it.

    The extra rows of a source are those up to a last one in its seeded order, so one row per source
    (whole repetitions, last extra row) decides. The ``LARGE_SOURCES`` largest sources are broadcast, and their
    texts are not shuffled; rows of the others, each a tiny part of all, are joined by source. Rows that repeat an
    id, size and source are taken alike.
    """
    at = F.struct(F.col("_key").alias("k"), F.col("id").alias("i"), F.col("size").alias("s"))
    cuts = materialize(_planned(df, weights, share, max_epochs, seed, id_col, source_col, text_col)
                       .groupBy("src").agg(F.max("whole").alias("c_whole"), F.max(F.when(F.col("extra"), at)).alias("c_last"),
                                           F.count(F.lit(1)).alias("rows")), "mix-cuts").withColumnRenamed("src", "c_src")
    order = [F.desc("rows"), F.col("c_src").asc_nulls_last()]
    large = cuts.orderBy(*order).limit(LARGE_SOURCES).drop("rows")
    here = F.struct(seeded_key(id_col, seed).alias("k"), F.col(id_col).alias("i"), word_count(F.col(text_col)).alias("s"))
    names = [F.col(c) for c in df.columns]
    wide = df.select(F.struct(*names).alias("row"), F.col(source_col).alias("r_src"), here.alias("here"))
    same = F.col("r_src").eqNullSafe(F.col("c_src"))
    found = wide.join(F.broadcast(large), same)
    small = cuts.orderBy(*order).offset(LARGE_SOURCES).drop("rows")
    if not small.isEmpty():  # else there is nothing to join
        found = found.union(wide.join(small, same))
    times = F.col("c_whole") + F.coalesce(F.col("here") <= F.col("c_last"), F.lit(False)).cast("long")
    return (found.withColumn("times", times.cast("int"))
            .where("times > 0").select("row", F.explode(F.array_repeat(F.lit(0), F.col("times"))).alias("copy"))
            .select("row.*"))
