"""Near-duplicate documents by Order MinHash, verified by banded alignment.

Similarity: texts are sequences of five-word shingles (lower case, punctuation left
out); the similarity of two is 1 - edit distance / longer length, and texts are linked
from 0.8 on. (With edits that keep the order this takes in all pairs whose shingle sets
have a Jaccard similarity of 0.8, and goes down to about 0.67.)

Order MinHash: each of 32 hash functions picks the three smallest occurrence-labelled
shingles of a text and keeps them in text order; the hash of the triple is a key.
Two texts whose shingle sets have Jaccard similarity J share a given key with a
probability of about J^3, so a pair at 0.67 is missed with (1 - 0.3)^32, about 1 in 10^5.

Texts with the same words are one node. Texts that share a key are a bucket. No pairs are made
of a bucket; all links within it are found in two steps:

1. Its hub (the node that shares most keys with others, usually the text the others were
   copied from) is aligned with every other node: a star.
2. Two nodes x, y of one hub that are still in different components are aligned only if a bound on
   their common labelled shingles allows a link, which needs 0.8 of the longer one in common:
   a. They share a new shingle (one that the hub lacks) among the first 0.2 |y| + 1 new ones of each, by
      hash: a node with more new ones than that cannot be linked without.
   b. Or they share none; then all they have in common the hub has too, so both have at least 0.8
      of their shingles from the hub. Only nodes that are not linked to the hub look for such partners.
   In both cases each node has a mark of 4,096 bits: every shingle turns one bit over. Bits in which two marks
   differ are at most the shingles that only one of them has, which bounds what they have in common, closely
   unless the two differ in thousands.
   A copy that was changed too much to be linked to its hub has too many new shingles for b,
   so it meets only texts with the same changes.

Texts leave the documents only for nodes that share a key with another.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revue.conf import materialize
from revue.llm import textops as T
from revue.llm.components import connected_components, lookup

WORDS, SKETCHES, PICKS, SIMILARITY = 5, 32, 3, 0.8
MARK_WORDS, SALTS = 64, 64
_TOP = np.uint32(0xFFFFFFFF)


def order_minhash(values: np.ndarray, begin: np.ndarray, sketches: int = SKETCHES, picks: int = PICKS) -> np.ndarray:
    """Keys (texts x sketches): hash of the ``picks`` smallest labelled shingles in text order. No empty text."""
    texts, size = len(begin) - 1, np.diff(begin)
    out = np.empty((texts, sketches), T.U)
    factors = T.mix(np.arange(1, 2 * sketches + 1, dtype=T.U) * T.U(0xD6E8FEB86659FD93)) | T.U(1)
    for m in range(sketches):
        v = ((values * factors[2 * m] + factors[2 * m + 1]) >> T.U(32)).astype(np.uint32)
        where = np.empty((texts, picks), np.int64)
        for p in range(picks):
            low = np.minimum.reduceat(v, begin[:-1])
            hit = np.flatnonzero(v == np.repeat(low, size))
            where[:, p] = hit[np.searchsorted(hit, begin[:-1])]
            v[where[:, p]] = _TOP
        where.sort(axis=1)
        key = np.full(texts, m + 1, T.U)
        for p in range(picks):
            key = T.mix(key * T.U(0x9E3779B97F4A7C15) + values[where[:, p]])
        out[:, m] = key
    return out


def _sketch_batches(words: int, sketches: int, picks: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in T.blocks(batch.column(1)):
                starts, ends, first = T.word_spans(data, offsets)
                hashes = T.word_hashes(data, starts, ends)
                count = np.diff(first)
                place = (np.arange(len(hashes)) - np.repeat(first[:-1], count)).astype(T.U)
                full = np.flatnonzero(count)
                c1, c2 = np.zeros((2, len(count)), T.U)
                if len(full):
                    c1[full] = np.add.reduceat(T.mix(hashes + place * T.U(0xA24BAED4963EE407)), first[full])
                    c2[full] = np.add.reduceat(T.mix(hashes ^ T.mix(place + T.U(77))), first[full])
                    values, begin, _ = T.shingles(hashes, first, words)
                    begin = np.concatenate([begin[full], begin[-1:]])
                    keys = order_minhash(T.labelled(values, begin), begin, sketches, picks)
                else:
                    keys = np.zeros((0, sketches), T.U)
                ends_at = np.zeros(len(count) + 1, np.int64)
                ends_at[1:] = np.cumsum((count > 0) * sketches)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, end - row), pa.array(c1.view(np.int64)), pa.array(c2.view(np.int64)),
                     pa.array(count.astype(np.int64)), T.lists(keys.ravel(), ends_at)], ["id", "c1", "c2", "n", "keys"])
    return run


def _shingle_batches(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in T.blocks(batch.column(1)):
                starts, ends, first = T.word_spans(data, offsets)
                values, begin, _ = T.shingles(T.word_hashes(data, starts, ends), first, words)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, end - row), T.lists(values, begin)], ["id", "seq"])
    return run


def aligned_distance(pairs: list[tuple[np.ndarray, np.ndarray]], band: int) -> np.ndarray:
    """Edit distance of each pair, exact up to ``band`` and larger than it otherwise.

    Only cells within ``band`` of the diagonal are computed, row by row for all pairs that are not done.
    """
    order = np.argsort([len(a) for a, _ in pairs], kind="stable")
    n = np.array([len(pairs[p][0]) for p in order])
    m = np.array([len(pairs[p][1]) for p in order])
    width, far = 2 * band + 1, np.int32(1 << 28)
    a_pad = np.zeros((len(pairs), n.max() + 1), T.U)
    b_pad = np.zeros((len(pairs), max(n.max(), m.max()) + width + 1), T.U)
    for k, p in enumerate(order):
        a_pad[k, :n[k]] = pairs[p][0]
        b_pad[k, band:band + m[k]] = pairs[p][1]
    column = np.arange(width, dtype=np.int32)
    dist = np.where(column >= band, column - band, far).astype(np.int32) + np.zeros((len(pairs), 1), np.int32)
    out = np.full(len(pairs), far)
    corner = m - n + band
    inside = (corner >= 0) & (corner < width)
    low = 0  # pairs before it are done
    for i in range(n.max() + 1):
        if i:
            step = dist + (a_pad[low:, i - 1:i] != b_pad[low:, i - 1:i - 1 + width])
            if i <= band:  # column j = 0 is reached from above only
                step[:, :band - i + 1] = far
            np.minimum(step[:, :-1], dist[:, 1:] + 1, out=step[:, :-1])
            step -= column
            np.minimum.accumulate(step, axis=1, out=step)
            step += column
            dist = step
        end = low
        while end < len(n) and n[end] == i:
            if inside[end]:
                out[order[end]] = dist[end - low, corner[end]]
            end += 1
        dist, low = dist[end - low:], end
    return out


def _chunks(open_: list, length, room: int, cells: int = 2_000_000) -> Iterator[list]:
    """Stretches of a list sorted by ``length``, of at most ``room`` entries and ``cells`` padded cells (one at least)."""
    part: list = []
    for x in open_:
        if part and (len(part) >= room or (len(part) + 1) * length(x) > cells):
            yield part
            part = []
        part.append(x)
    if part:
        yield part


def alike(pairs: list[tuple[np.ndarray, np.ndarray]], common: np.ndarray, similarity: float) -> np.ndarray:
    """Whether 1 - edit distance / longer length reaches ``similarity``, for each pair of sequences.

    ``common`` holds the number of labelled shingles that the two have in common.
    """
    out, open_ = np.zeros(len(pairs), bool), []
    for p, (a, b) in enumerate(pairs):
        longer = max(len(a), len(b))
        limit = int((1 - similarity) * longer + 1e-9)
        if longer - common[p] <= limit:  # every edit costs at least one common shingle
            open_.append((p, limit))
    open_.sort(key=lambda x: max(map(len, pairs[x[0]])))
    band = 16
    while open_:
        later = []
        for some in _chunks(open_, lambda x: max(map(len, pairs[x[0]])), max(1, 60_000 // (2 * band + 1))):
            for (p, limit), d in zip(some, aligned_distance([pairs[p] for p, _ in some], band), strict=True):
                if d <= band:
                    out[p] = d <= limit
                elif limit > band:
                    later.append((p, limit))
        open_, band = later, min(4 * band, max((x[1] for x in later), default=0))
    return out


def _columns(part: pa.RecordBatch, names: tuple[str, str]) -> list[tuple[list[np.ndarray], list[np.ndarray]]]:
    """The sequences of two list columns, as they are and labelled and sorted."""
    out = []
    for name in names:
        col = part.column(name)
        begin = col.offsets.to_numpy()
        flat = np.asarray(col.values).view(T.U)[begin[0]:begin[-1]]
        own = begin - begin[0]
        labels = T.labelled(flat, own)
        cuts = list(zip(own[:-1], own[1:], strict=True))
        out.append(([flat[s:e] for s, e in cuts], [np.sort(labels[s:e]) for s, e in cuts]))
    return out


def _marks(sets: list[np.ndarray]) -> pa.Array:
    """For each set its mark: 64 words in which every element turns over the bit that its hash names."""
    out = np.zeros((len(sets), MARK_WORDS), T.U)
    for mark, elements in zip(out, sets, strict=True):
        np.bitwise_xor.at(mark, (elements >> T.U(58)).astype(np.int64), T.U(1) << (elements >> T.U(52) & T.U(63)))
    return T.lists(out.ravel(), np.arange(len(sets) + 1) * MARK_WORDS)


def _star_batches(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(0, batch.num_rows, 500):
                part = batch.slice(row, 500)
                (hubs, hub_sets), (nodes, node_sets) = _columns(part, ("seq_a", "seq_b"))
                news = [~np.isin(b, a, assume_unique=True) for a, b in zip(hub_sets, node_sets, strict=True)]
                common = np.array([len(b) - x.sum() for b, x in zip(node_sets, news, strict=True)], dtype=np.int64)
                most = [len(b) - int(np.ceil(similarity * len(b) - 1e-9)) + 1 for b in node_sets]
                new = [b[x][:k] for b, x, k in zip(node_sets, news, most, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("a"), part.column("b"), pa.array(alike(list(zip(hubs, nodes, strict=True)), common, similarity)),
                     pa.array([len(b) for b in nodes], pa.int64()), pa.array(common), _marks(node_sets),
                     T.lists(np.concatenate([np.zeros(0, T.U), *new]), np.concatenate([[0], np.cumsum([len(x) for x in new])]))],
                    ["a", "b", "linked", "n", "common", "mark", "new"])
    return run


def _pair_batches(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(0, batch.num_rows, 500):
                part = batch.slice(row, 500)
                (left, left_sets), (right, right_sets) = _columns(part, ("seq_a", "seq_b"))
                common = np.array([len(np.intersect1d(a, b, assume_unique=True))
                                   for a, b in zip(left_sets, right_sets, strict=True)])
                ok = pa.array(alike(list(zip(left, right, strict=True)), common, similarity))
                yield pa.RecordBatch.from_arrays([part.column("a").filter(ok), part.column("b").filter(ok)], ["a", "b"])
    return run


def _across(tested: DataFrame, comps: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of nodes of one hub in different components whose bounds allow a link (step 2)."""
    nodes = materialize(tested.join(comps.withColumnRenamed("node", "b"), "b", "left")
                        .select(F.col("a").alias("hub"), F.col("b").alias("node"), F.coalesce("comp", "b").alias("comp"),
                                "linked", "n", "common", "mark", "new"), "omh-nodes-of-hubs")

    def side(df: DataFrame, k: str, *names: str) -> DataFrame:
        return df.select("hub", *names, *[F.col(c).alias(c + k) for c in ("node", "comp", "n", "mark")])

    need = F.lit(similarity) * F.greatest("nx", "ny") - F.lit(1e-9)
    differ = F.aggregate(F.zip_with("markx", "marky", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda t, k: t + k)
    fits = ((F.col("compx") != F.col("compy")) & (F.least("nx", "ny") >= need)
            & (F.col("nx") + F.col("ny") - differ >= 2 * need))

    new = nodes.select("*", F.explode("new").alias("s")).drop("new")
    split = new.groupBy("hub", "s").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi")
    open_ = new.join(split.select("hub", "s"), ["hub", "s"])
    by_new = (side(open_, "x", "s").join(side(open_, "y", "s"), ["hub", "s"])
              .where((F.col("nodex") < F.col("nodey")) & fits).select("nodex", "nodey"))

    whole = nodes.where(F.col("common") >= F.lit(similarity) * F.col("n") - F.lit(1e-9)).drop("new")
    salted = whole.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
    apart = whole.where(~F.col("linked")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    by_kept = (side(apart, "x", "salt").join(side(salted, "y", "salt"), ["hub", "salt"]).where(fits).select("nodex", "nodey"))
    pairs = by_new.union(by_kept)
    return pairs.select(F.least("nodex", "nodey").alias("a"), F.greatest("nodex", "nodey").alias("b")).distinct()


def _merged(labelled: DataFrame, more: DataFrame) -> DataFrame:
    """``labelled`` (node, comp, ...) with the components that the pairs ``more`` (a, b) of nodes link made one.

    Only components that a pair names are joined again, not the links within them. The pairs are looked up by salt, and a
    component that changes has its new label once a salt, as it may have many nodes.
    """
    names = materialize(labelled, "omh-labelled")
    at = names.select("node", "comp")
    ends = lookup(materialize(more, "omh-more"), "a", "b", at.withColumnRenamed("comp", "x"), "node")
    ends = lookup(ends, "b", "a", at.withColumnRenamed("comp", "y"), "node")
    joined = connected_components(ends.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
    changed = (joined.where("comp <> node").select(F.col("node").alias("comp"), F.col("comp").alias("_top"))
               .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    salted = names.withColumn("_salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
    return (salted.join(changed, ["comp", "_salt"], "left").withColumn("comp", F.coalesce("_top", "comp"))
            .drop("_top", "_salt"))


def near_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
               similarity: float = SIMILARITY, sketches: int = SKETCHES, picks: int = PICKS) -> DataFrame:
    """Return id, class_id, kept: one row per input row.

    ``class_id`` is the smallest id of the connected component of links, ``kept`` is
    set for that id. A text without words (null, empty, punctuation only) is alone in its class.
    A row with a null id has a null class and is kept. Ids name documents: repeated rows of an id get the same class and
    flag; one with several texts is compared by the greatest of them. Texts of any length are whole; two near ones of n words
    that differ in d cost n * d steps in one task. An empty table gives an empty result. Other columns of ``df`` are not read.
    """
    spark = df.sparkSession
    kind = df.schema[id_col].dataType.simpleString()
    texts = df.select(F.col(id_col).alias("id"), F.lower(F.coalesce(F.col(text_col), F.lit(""))).alias("t"))
    docs = materialize(texts.mapInArrow(_sketch_batches(words, sketches, picks),
                                        f"id {kind}, c1 long, c2 long, n long, keys array<long>"), "omh")
    content = ["c1", "c2", "n"]
    named = docs.where("id is not null and n > 0")
    nodes = materialize(named.groupBy(*content).agg(F.min(F.struct("id", "keys")).alias("m"))
                        .select(*content, F.col("m.id").alias("node"), F.col("m.keys").alias("keys")), "omh-nodes")
    keyed = nodes.select("node", F.explode("keys").alias("key"))
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = materialize(keyed.join(sizes, "key"), "omh-buckets")
    central = shared.groupBy("node").agg(F.sum("size").alias("weight"))
    weighed = shared.join(central, "node")
    hubs = weighed.groupBy("key").agg(F.min(F.struct((-F.col("weight")).alias("w"), "node")).alias("h"))
    stars = (shared.join(hubs.select("key", F.col("h.node").alias("a")), "key").where("a <> node")
             .select("a", F.col("node").alias("b")).distinct())
    seqs = materialize(texts.join(central.select(F.col("node").alias("id")), "id", "left_semi")
                       .groupBy("id").agg(F.max("t").alias("t")).mapInArrow(_shingle_batches(words), f"id {kind}, seq array<long>"), "omh-sequences")

    def with_sequences(pairs: DataFrame) -> DataFrame:
        """Both sequences of each pair. A hub has as many rows as copies, so they are dealt out by a salt as well."""
        pairs = lookup(pairs, "a", "b", seqs.select("id", F.col("seq").alias("seq_a")), "id")
        return pairs.join(seqs.select(F.col("id").alias("b"), F.col("seq").alias("seq_b")), "b").select("a", "b", "seq_a", "seq_b")

    tested = materialize(with_sequences(stars).mapInArrow(
        _star_batches(similarity),
        f"a {kind}, b {kind}, linked boolean, n long, common long, mark array<long>, new array<long>"), "omh-stars")
    links = tested.where("linked").select("a", "b")
    comps = connected_components(links)
    across = _across(tested, comps, similarity)
    more = with_sequences(across).mapInArrow(_pair_batches(similarity), f"a {kind}, b {kind}")
    classes = _merged(nodes.select(*content, "node").join(comps, "node", "left")
                      .withColumn("comp", F.coalesce("comp", "node")), more).select(*content, F.col("comp").alias("class"))
    return (docs.select("id", *content).join(classes, content, "left")
            .withColumn("class_id", F.when(F.col("n") > 0, F.col("class")).otherwise(F.col("id")))
            .select(F.col("id").alias(id_col), "class_id",
                    F.coalesce(F.col("id") == F.col("class_id"), F.lit(True)).alias("kept")))
