"""Collocations by vertical partitioning: suffix subtrees of bounded size, one per group of word prefixes.

The corpus is a forest of pieces (stretches of words between punctuation). Its suffix tree, cut
off at ``words`` words, is never built whole:

1. Words are counted per language, exactly. A (language, word) gets a 64-bit symbol; a seed is taken only if no two
   words share one (checked over all words), so symbols are identities from there on.
2. Vertical partitioning: the prefixes of one word fall into 4,096 slices by symbol. Neighbouring slices
   are packed into groups of at most ``GROUP`` suffixes; a slice above that is extended to prefixes of two
   words, dealt to as many groups as it needs. The partition is 4,096 numbers whatever the corpus.
3. Each task turns its texts into depth-truncated suffixes, equal ones counted already, and sends them
   to their group. Prefixes that cannot reach ``least`` occurrences end early: a suffix stops before a rare
   word (a Bloom filter of the common words, at most 16 MB, says which; a false positive costs room, not results).
4. Each group sorts its suffixes: that is its subtree, leaves in order. Leaf totals are summed, and the counts of
   inner nodes are the sums of their leaves. Groups do not need each other.

Scores, containment and the best of each language are joins and windows over the nodes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revue.conf import materialize
from revue.llm import bloom
from revue.llm import textops as T

LEAST, CONTAINED_PERCENT, TOP = 10, 50, 2000
BLOCK, WINDOW, GROUP, SLICE_BITS, SALTS = 4 << 20, 1 << 19, 1 << 19, 12, 32
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)
_CUTS = np.isin(np.arange(256), [*b".,;:!?", *range(0x0A, 0x0E)])
_IN_WORD = ~_CUTS & ~np.isin(np.arange(256), [0x20, 0x09])


class Block:
    """The words of some texts: ``symbol`` number of each, whether it ``opens`` a piece, and the distinct symbols."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, langs: pa.Array, seed: int):
        data = _LOWER[data]
        inside = _IN_WORD[data]
        starts, ends, first = T.spans(inside, offsets)
        piece = np.cumsum(_CUTS[data], dtype=np.int64)[starts] if len(starts) else np.zeros(0, np.int64)
        self.opens = np.ones(len(starts), bool)
        self.opens[1:] = piece[1:] != piece[:-1]
        self.opens[first[:-1][np.diff(first) > 0]] = True
        bounds = np.concatenate([[0], np.cumsum(ends - starts)])
        words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds.astype(np.int64).tobytes()),
                                                 pa.py_buffer(data[inside].tobytes())).dictionary_encode()
        lang = langs.dictionary_encode()
        names = max(1, len(words.dictionary))
        both = (np.repeat(lang.indices.to_numpy().astype(np.int64), np.diff(first)) * names
                + words.indices.to_numpy().astype(np.int64))
        pair, self.symbol = np.unique(both, return_inverse=True)
        self.lang, self.word = lang.dictionary.take(pa.array(pair // names)), words.dictionary.take(pa.array(pair % names))
        hashes = [T.word_hashes(*_stretches(x.dictionary)) for x in (lang, words)]
        self.hashes = T.mix(hashes[1][pair % names] + T.mix(hashes[0][pair // names] + T.U(seed)))


def _stretches(strings: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data, offsets = T.buffers(strings)
    return data, offsets[:-1], offsets[1:]


def _blocks(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[Block]:
    for batch in batches:
        for row, end, data, offsets in T.blocks(batch.column(1), BLOCK):
            yield Block(data, offsets, batch.column(0).slice(row, end - row), seed)


def _word_batches(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, seed):
            count = np.bincount(block.symbol, minlength=len(block.hashes)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [block.lang.cast(pa.string()), block.word.cast(pa.string()), pa.array(block.hashes.view(np.int64)), pa.array(count)],
                ["lang", "word", "h", "n"])
    return run


def count_words(texts: DataFrame) -> tuple[DataFrame, int]:
    """(lang, word, h, n) of a table (lang, t), written, and the seed of the symbols ``h``, distinct and not 0."""
    seed = 0
    while True:
        words = materialize(texts.mapInArrow(_word_batches(seed), "lang string, word string, h long, n long")
                            .groupBy("lang", "word", "h").agg(F.sum("n").alias("n")), "phrase-words")
        twice = words.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where("c > 1 or h = 0")
        if not twice.limit(1).count():
            return words, seed
        seed += 1


def partition(sizes: dict[int, int], room: int = GROUP) -> tuple[np.ndarray, np.ndarray, int]:
    """First group and number of groups of every slice, and the number of all groups.

    ``sizes`` holds the suffixes of each slice. Slices share a group while they fit; one above ``room`` has its own.
    """
    first, parts = np.zeros(1 << SLICE_BITS, np.int64), np.ones(1 << SLICE_BITS, np.int64)
    group, filled = 0, 0
    for s in range(1 << SLICE_BITS):
        size = sizes.get(s, 0)
        if filled and filled + size > room:
            group, filled = group + 1, 0
        first[s], parts[s] = group, max(1, -(-size // room))
        if parts[s] > 1:
            group, filled = group + int(parts[s]), 0
        else:
            filled += size
    return first, parts, group + 1


def _suffix_batches(seed: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters, first, parts = shared.value
        for block in _blocks(batches, seed):
            common = np.zeros(len(block.hashes), bool)
            common[filters.find(0, block.hashes)] = True
            for begin in range(0, len(block.symbol), WINDOW):
                yield from _suffixes(block, common, begin, min(begin + WINDOW, len(block.symbol)), first, parts)
    return run


def _suffixes(block: Block, common: np.ndarray, begin: int, end: int, first: np.ndarray, parts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Suffixes of three words (the third 0 if there is none or it is rare) that start in a window, one row a group."""
    some, own = np.unique(block.symbol[begin:end + 2], return_inverse=True)
    goes_on = common[some][own] & ~block.opens[begin:end + 2]  # common and of the piece of the word before
    start = np.flatnonzero(common[some][own[:end - begin]])
    start = start[start + 1 < len(own)]
    start = start[goes_on[start + 1]]
    own, goes_on = np.append(own, 0), np.append(goes_on, False)
    third = np.where(goes_on[start + 2], own[start + 2] + 1, 0)
    size = len(some)
    leaf, count = np.unique((own[start] * size + own[start + 1]) * (size + 1) + third, return_counts=True)
    two, third = np.divmod(leaf, size + 1)
    hashes = block.hashes[some]
    h1, h2 = hashes[two // size], hashes[two % size]
    h3 = np.concatenate([np.zeros(1, T.U), hashes])[third]
    part = (h1 >> T.U(64 - SLICE_BITS)).astype(np.int64)
    group = first[part] + (T.mix(h2) % parts[part].astype(T.U)).astype(np.int64)
    if not len(leaf):
        return
    order = np.argsort(group, kind="stable")
    cuts = np.flatnonzero(np.diff(group[order], prepend=-1))
    for at, to in zip(cuts, np.append(cuts[1:], len(order)), strict=True):
        rows = order[at:to]
        leaves = b"".join(x[rows].tobytes() for x in (h1, h2, h3, count.astype(np.uint32)))
        yield pa.RecordBatch.from_arrays([pa.array([group[rows[0]]], pa.int32()), pa.array([leaves], pa.binary())], ["g", "leaves"])


def _subtree(least: int):
    def run(table: pa.Table) -> pa.Table:
        """Nodes of depth two and three of a group's subtree that ``least`` suffixes or more lie below."""
        parts = []
        for blob in table["leaves"]:
            raw = blob.as_buffer()
            m = raw.size // 28
            parts.append([np.frombuffer(raw, np.int64, m, 8 * m * k) for k in range(3)]
                         + [np.frombuffer(raw, np.uint32, m, 24 * m).astype(np.int64)])
        h1, h2, h3, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        del parts
        order = np.lexsort((h3, h2, h1))
        h1, h2, h3, n = h1[order], h2[order], h3[order], n[order]
        new_two = np.append(True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]))
        leaf = np.flatnonzero(np.append(True, new_two[1:] | (h3[1:] != h3[:-1])))
        total = np.add.reduceat(n, leaf)
        inner = np.flatnonzero(new_two[leaf])
        below = np.add.reduceat(total, inner)
        deep = (total >= least) & (h3[leaf] != 0)
        rows = np.concatenate([leaf[inner][below >= least], leaf[deep]])
        third = np.concatenate([np.zeros(int((below >= least).sum()), np.int64), h3[leaf[deep]]])
        return pa.table({"h1": h1[rows], "h2": h2[rows], "h3": third,
                         "a": np.concatenate([below[below >= least], total[deep]])})
    return run


def phrase_counts(texts: DataFrame, words: DataFrame, seed: int, least: int = LEAST, room: int = GROUP) -> DataFrame:
    """(h1, h2, h3, a) of all phrases of two (h3 = 0) and three words with ``a >= least`` occurrences."""
    spark = texts.sparkSession
    common = words.where(F.col("n") >= least)
    sizes = (common.groupBy(F.shiftrightunsigned("h", 64 - SLICE_BITS).cast("int").alias("s"))
             .agg(F.sum("n").alias("size"), F.count(F.lit(1)).alias("words")).collect())
    first, parts, groups = partition({r["s"]: r["size"] for r in sizes}, room)
    known = min(sum(r["words"] for r in sizes), bloom.PER_PASS)
    filters = bloom.build(common.select(F.lit(0).alias("shard"), F.col("h").alias("key")), {0: known})
    shared = spark.sparkContext.broadcast((filters, first, parts))
    return (texts.mapInArrow(_suffix_batches(seed, shared), "g int, leaves binary")
            .repartition(groups, "g").groupBy("g").applyInArrow(_subtree(least), "h1 long, h2 long, h3 long, a long"))


def collocations(df: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST,
                 contained_percent: int = CONTAINED_PERCENT, top: int = TOP, room: int = GROUP) -> DataFrame:
    """Return lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of two or three words of each language.

    A-Z is lower-cased; null texts hold no word; a null language is ``und``. Repeated rows count again, texts
    of any length are whole, and an empty table gives an empty result. Ties are ordered by count, then by the phrase's
    bytes, so ranks are unique. Other columns of ``df`` are not read. Scores are exact
    up to counts of 10^16; beyond that the 38 digits of a decimal overflow, which is an error.
    """
    texts = df.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("t"))
    words, seed = count_words(texts)
    nodes = materialize(phrase_counts(texts, words, seed, least, room), "phrase-nodes")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    twos, threes = nodes.where("h3 = 0").drop("h3"), nodes.where("h3 <> 0")

    def word(k: int) -> DataFrame:
        return words.where(F.col("n") >= least).select(F.col("h").alias(f"h{k}"), F.col("word").alias(f"w{k}"),
                                                       F.col("n").alias(f"n{k}"), *(["lang"] if k == 1 else []))

    def two(i: int, j: int) -> DataFrame:
        return twos.select(F.col("h1").alias(f"h{i}"), F.col("h2").alias(f"h{j}"), F.col("a").alias(f"f{i}{j}"))

    def score(left: str, right: str):
        return F.expr(f"(cast(a as decimal(38, 0)) * a * 1000000) div (cast({left} as decimal(38, 0)) * {right})")

    inside = (threes.select("a", F.explode(F.array(F.struct("h1", "h2"), F.struct(F.col("h2").alias("h1"), F.col("h3").alias("h2")))).alias("p"))
              .groupBy("p.h1", "p.h2").agg(F.max("a").alias("longer")))
    pairs = (twos.join(inside, ["h1", "h2"], "left").where(F.coalesce(F.col("longer") * 100 < F.col("a") * contained_percent, F.lit(True)))
             .join(word(1), "h1").join(word(2), "h2")
             .select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", F.col("n1").alias("l"), F.col("n2").alias("r"),
                     score("n1", "n2").alias("score")))
    cut = F.when(score("n1", "f23") <= score("f12", "n3"), F.struct(F.col("n1").alias("l"), F.col("f23").alias("r"), score("n1", "f23").alias("score"))
                 ).otherwise(F.struct(F.col("f12").alias("l"), F.col("n3").alias("r"), score("f12", "n3").alias("score")))
    triples = (threes.join(two(1, 2), ["h1", "h2"]).join(two(2, 3), ["h2", "h3"])
               .join(word(1), "h1").join(word(2), "h2").join(word(3), "h3")
               .select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", cut.alias("cut"))
               .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = (pairs.union(triples).withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
              .withColumn("nth", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*best))).where(F.col("nth") <= top))
    ranked = (salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long"))
              .where(F.col("rank") <= top))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
