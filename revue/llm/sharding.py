"""Sharding by proportional stratified interleaving.

Rows of each source are shuffled by a seeded hash and ranked; a row's fractional rank
is (rank - phase) / rows of the source, the phase in (0, 1) being a hash of the source
(so that sources of one row don't all fall on the middle). Sorted by fractional rank,
any stretch of the table holds every source in proportion; cutting it into equal
stretches gives shards that match the mixture and differ by one row at most.

Ranks and positions are running totals over 4,096 slices (see ``prefix``), so a source
with a third of all rows is ranked in parallel and nothing is sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revue.conf import materialize
from revue.llm.prefix import running_total, seeded_key

SLICES = 4096


def _phase(source: Column, seed: str) -> Column:
    digits = F.substring(F.md5(F.concat(F.coalesce(source, F.lit("")), F.lit(":" + seed)).cast("binary")), 1, 3)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / 4096.0


def interleave(df: DataFrame, shards: int, seed: str = "shard", id_col: str = "doc_id",
               source_col: str = "source", text_col: str = "text") -> DataFrame:
    """Return id, source, size, text_crc32, shard, slot: one row per input row.

    ``size`` is the UTF-8 length of the text plus 1; a null text counts as empty. Rows
    without a source form a source of their own. Rows equal in id, source and text are
    interchangeable; a null id counts as an empty id. An empty table gives an empty result. Shards beyond
    the number of rows stay empty. Only the four digest columns are shuffled.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(F.col(id_col).alias("id"), F.col(source_col).alias("src"),
                     (F.octet_length(text) + 1).cast("long").alias("size"),
                     F.crc32(text.cast("binary")).alias("text_crc32"), seeded_key(id_col, seed).alias("_key"),
                     F.lit(1).cast("long").alias("_one"))
    rows = materialize(rows, "shard-digests")
    ranked = running_total(rows, ["src"], "_one", ["id", "size", "text_crc32"])
    placed = ranked.withColumn("frac", (F.col("_before") + 1 - _phase(F.col("src"), seed)) / F.col("_whole"))
    placed = placed.drop("_before", "_whole").withColumn(
        "cut", F.least(F.lit(SLICES - 1), F.floor(F.col("frac") * SLICES)).cast("int"))
    upto = Window.orderBy("cut")
    cuts = (placed.groupBy("cut").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("first", F.sum("n").over(upto) - F.col("n"))
            .withColumn("total", F.sum("n").over(upto.rowsBetween(Window.unboundedPreceding,
                                                                  Window.unboundedFollowing))))
    in_cut = Window.partitionBy("cut").orderBy("frac", F.col("src").asc_nulls_last(), "_key", "id",
                                               "size", "text_crc32")
    # At most SLICES rows on the right: a proven bound for the broadcast.
    at = (placed.join(F.broadcast(cuts.select("cut", "first", "total")), "cut")
          .withColumn("pos", F.col("first") + F.row_number().over(in_cut) - 1)
          .withColumn("shard", F.expr(f"pos * {shards} div total")))
    return at.select(F.col("id").alias(id_col), F.col("src").alias(source_col), "size", "text_crc32",
                     F.col("shard").cast("int").alias("shard"),
                     F.expr(f"pos - (shard * total + {shards - 1}) div {shards}").alias("slot"))


def place(df: DataFrame, shards: int, seed: str = "shard", id_col: str = "doc_id",
          source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The rows of ``df``, whole, with shard, slot and copy (1, 2, ... among rows equal in id, source and text).

    Such rows, as mixing makes them, get different slots; rows with a null id, source or text are placed like
    any other. Columns of ``df`` named shard, slot or copy are replaced. Texts are shuffled once. An empty
    table gives an empty result.
    """
    def named(name: str) -> Column:  # never null, so that one hash partitioning serves the join and the window
        return F.concat(F.when(F.col(name).isNull(), F.lit("0")).otherwise("1"), F.coalesce(F.col(name).cast("string"), F.lit("")))

    key = ["_i", "_s", "_n", "_c"]
    plan = interleave(df, shards, seed, id_col, source_col, text_col)
    places = (plan.select(named(id_col).alias("_i"), named(source_col).alias("_s"), F.col("size").alias("_n"),
                          F.col("text_crc32").alias("_c"), F.struct("shard", "slot").alias("p"))
              .groupBy(*key).agg(F.sort_array(F.collect_list("p")).alias("_places")))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in ("shard", "slot", "copy")]).alias("_row"),
                     named(id_col).alias("_i"), named(source_col).alias("_s"),
                     (F.octet_length(text) + 1).cast("long").alias("_n"), F.crc32(text.cast("binary")).alias("_c"))
    nth = F.row_number().over(Window.partitionBy(*key).orderBy(F.xxhash64("_row")))
    return (rows.join(places.hint("merge"), key).withColumn("copy", nth)
            .withColumn("_place", F.element_at("_places", F.col("copy")))
            .select("_row.*", F.col("_place.shard").alias("shard"), F.col("_place.slot").alias("slot"), "copy"))


def write_shards(df: DataFrame, path: str, shards: int, seed: str = "shard", id_col: str = "doc_id",
                 source_col: str = "source", text_col: str = "text", piece: int = 100_000) -> None:
    """Write whole rows of ``df`` as ``path/shard=N/``, in files of ``piece`` slots, each ordered by slot.

    All rows are written, repeated ones and those with null ids too. Columns named shard, slot and copy are replaced.
    """
    rows = place(df, shards, seed, id_col, source_col, text_col).withColumn("_piece", F.expr(f"slot div {piece}"))
    (rows.repartition("shard", "_piece").sortWithinPartitions("shard", "slot").drop("_piece")
     .write.partitionBy("shard").parquet(path))
