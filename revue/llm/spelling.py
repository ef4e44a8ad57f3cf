"""Spelling variants: words one edit apart, found by probing edits against Bloom filters.

1. Every text is cut into words on its bytes, a hashed rule alters some (``ALTERED``), and equal words
   are counted before and after the shuffle.
2. The vocabulary goes into Bloom filters, one for each word length, which are broadcast. They
   have a bounded size (``bloom.PER_PASS`` words at once); a larger vocabulary takes several passes over itself.
3. Each word probes its neighbourhood: all replacements by a later letter against the filter
   of its own length, and all deletions against the filter of the next shorter one. (The pair is then found from
   its longer or earlier word, so insertions and the other replacements need no probe.)
   Edits are hashed by a polynomial, a few operations each, whatever the word's length.
4. Only edits that a filter accepts are spelt out and shuffled, to a join with the vocabulary. It removes
   false positives, so the links are exact.

A word's form is its most frequent near word if that is at least ``RATIO`` times as frequent. A chain of
forms multiplies the count by ``RATIO`` each step, so counts of 64 bits allow at most 19
steps and five doublings reach its root.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revue.conf import materialize
from revue.llm import bloom
from revue.llm import textops as T

LEAST_LENGTH, LEAST_COUNT, RATIO, ALTERED = 7, 2, 10, 31
DOUBLINGS = 5
#: Letters that a word can hold: a to z and U+00C0 to U+00FF.
LETTERS = np.array([*range(97, 123), *range(0xC0, 0x100)], dtype=np.uint32)
BLOCK, CELLS = 8 << 20, 400_000
_BASE = T.U(0x9E3779B97F4A7C15)
_INVERSE = T.U(pow(int(_BASE), -1, 1 << 64))
_VALUE = np.zeros(256, T.U)
_VALUE[LETTERS] = T.mix(LETTERS.astype(T.U) + T.U(1)) | T.U(1)
_ASCII = np.array([65 <= b <= 90 or 97 <= b <= 122 for b in range(256)])
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, table >> 1 ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def crc_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> np.ndarray:
    """crc32 of each stretch of bytes, continued from the crc32 ``before`` it."""
    state = before ^ np.uint32(0xFFFFFFFF)
    active = np.argsort(starts - ends, kind="stable")  # longest first
    size = (ends - starts)[active]
    for k in range(min(int(size[0]), 64) if len(size) else 0):
        active = active[:np.searchsorted(-size, -k, "left")]
        state[active] = _CRC[(state[active] ^ data[starts[active] + k]) & np.uint32(255)] ^ state[active] >> np.uint32(8)
    for w in np.flatnonzero(ends - starts > 64):
        state[w] = zlib.crc32(data[starts[w] + 64:ends[w]].tobytes(), int(state[w]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    return state ^ np.uint32(0xFFFFFFFF)


def words_of(data: np.ndarray, offsets: np.ndarray, prefixes: list[bytes], least: int, altered: int) -> pa.Array:
    """The words of texts (bytes, offsets), lower-cased and altered, that have ``least`` letters or more.

    A run whose crc32 (``<id>:<run>``) is divisible by ``altered`` loses a letter; 0 alters none.
    """
    two = data == 0xC3
    inside = _ASCII[data] | two
    inside[1:] |= two[:-1]
    starts, ends, first = T.spans(inside, offsets)
    data = _LOWER[data]
    heads = np.flatnonzero(inside & ((data & 0xC0) != 0x80))
    head = np.searchsorted(heads, starts)
    size = np.diff(np.append(head, len(heads)))
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    long_ = size >= least
    starts, ends, head, size, text = starts[long_], ends[long_], head[long_], size[long_], text[long_]
    cut = np.zeros(len(data), bool)
    if altered:
        before = np.array([zlib.crc32(p) for p in prefixes], dtype=np.uint32)
        crc = crc_of(data, starts, ends, before[text]) if len(starts) else np.zeros(0, np.uint32)
        hit = np.flatnonzero(crc % np.uint32(altered) == 0)
        at = heads[head[hit] + crc[hit].astype(np.int64) % size[hit]]
        cut[at] = True
        cut[at[data[at] == 0xC3] + 1] = True
        size[hit] -= 1
    kept = size >= least
    edge = np.zeros(len(data) + 1, np.int8)
    edge[starts[kept]] += 1
    edge[ends[kept]] -= 1
    inside = np.cumsum(edge[:-1], dtype=np.int8).astype(bool) & ~cut
    upto = np.concatenate([[0], np.cumsum(inside)])
    bounds = np.append(upto[starts[kept]], upto[-1]).astype(np.int32)
    return pa.StringArray.from_buffers(int(kept.sum()), pa.py_buffer(bounds.tobytes()), pa.py_buffer(data[inside].tobytes()))


def _count_batches(least: int, altered: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).fill_null("")
            for row, end, data, offsets in T.blocks(batch.column(1), BLOCK):
                prefixes = [f"{i}:".encode() for i in ids.slice(row, end - row).to_pylist()]
                counted = pc.value_counts(words_of(data, offsets, prefixes, least, altered))
                yield pa.RecordBatch.from_arrays([counted.field(0), counted.field(1)], ["word", "n"])
    return run


def vocabulary(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH,
               least_count: int = LEAST_COUNT, altered: int = ALTERED) -> DataFrame:
    """(word, n) of the words with at least ``least_length`` letters that occur ``least_count`` times or more."""
    words = (df.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("t"))
             .mapInArrow(_count_batches(least_length, altered), "word string, n long"))
    return words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _matrix(words: list[str], size: int) -> np.ndarray:
    return np.array(words, dtype=f"<U{size}").view(np.uint32).reshape(len(words), size)


def _hashes(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and the terms of each word's polynomial, whose sum is the word's hash."""
    power = np.concatenate([np.ones(1, T.U), np.full(max(0, letters.shape[1] - 1), _BASE)]).cumprod(dtype=T.U)
    return power, _VALUE[letters] * power


def _by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    """(length, row numbers) in stretches of bounded size."""
    size = np.array([len(w) for w in words], dtype=np.int64)
    for length in np.unique(size).tolist():
        rows = np.flatnonzero(size == length)
        step = max(1, CELLS // len(LETTERS) // length) if length > 64 else 4096
        for k in range(0, len(rows), step):
            yield length, rows[k:k + step]


def _key_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = batch.column(0).to_pylist()
        key, size = np.zeros(len(words), T.U), np.zeros(len(words), np.int32)
        for length, rows in _by_length(words):
            key[rows] = _hashes(_matrix([words[r] for r in rows], length))[1].sum(axis=1, dtype=T.U)
            size[rows] = length
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(size), pa.array(key.view(np.int64))],
                                         ["word", "n", "shard", "key"])


def _edits(letters: np.ndarray, filters: bloom.Filters) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row of each accepted edit, its letters) for words of one length."""
    count, length = letters.shape
    power, terms = _hashes(letters)
    upto = np.zeros((count, length + 1), T.U)
    np.cumsum(terms, axis=1, dtype=T.U, out=upto[:, 1:])
    whole = upto[:, -1:]
    fewer = upto[:, :-1] + (whole - upto[:, 1:]) * _INVERSE
    row, place = np.divmod(filters.find(length - 1, fewer.ravel()), length)
    last = (place == length - 1) | (letters[row, place] != letters[row, np.minimum(place + 1, length - 1)])
    row, place = row[last], place[last]  # of equal letters in a row only the last is deleted
    left = np.delete(np.arange(length), 0) - (np.arange(length - 1) < place[:, None])
    yield row, letters[row[:, None], left]
    step = max(1, CELLS // (count * len(LETTERS)))
    for i in range(0, length, step):
        some = power[i:i + step]
        near = (whole - terms[:, i:i + step])[:, :, None] + some[:, None] * _VALUE[LETTERS]
        at = filters.find(length, near.ravel())
        at, letter = np.divmod(at, len(LETTERS))
        row, place = np.divmod(at, len(some))
        later = LETTERS[letter] > letters[row, i + place]
        row, place, letter = row[later], i + place[later], letter[later]
        edited = letters[row]
        edited[np.arange(len(row)), place] = LETTERS[letter]
        yield row, edited


def _probe_batches(filters):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0).to_pylist()
            for length, rows in _by_length(words):
                letters = _matrix([words[r] for r in rows], length)
                for row, edited in _edits(letters, filters.value):
                    if len(row):
                        near = np.ascontiguousarray(edited).view(f"<U{edited.shape[1]}").ravel()
                        yield pa.RecordBatch.from_arrays(
                            [batch.column(0).take(pa.array(rows[row])), batch.column(1).take(pa.array(rows[row])),
                             pa.array(near, pa.string())], ["word", "n", "near"])
    return run


def near_words(words: DataFrame, per_pass: int = bloom.PER_PASS) -> DataFrame:
    """Pairs (word, n, near, near_n) of a written vocabulary (word, n) that are one edit apart, each once."""
    spark = words.sparkSession
    keyed = materialize(words.mapInArrow(_key_batches, "word string, n long, shard int, key long"), "spelling-keys")
    total = keyed.count()
    passes = max(1, -(-total // per_pass))
    spread = keyed.select("word", "n").repartition(max(total // 20_000, spark.sparkContext.defaultParallelism))
    found = None
    for k in range(passes):
        part = keyed.where(F.pmod(F.xxhash64("word"), F.lit(passes)) == k)
        sizes = {r["shard"]: r["count"] for r in part.groupBy("shard").count().collect()}
        filters = spark.sparkContext.broadcast(bloom.build(part, sizes))
        edits = spread.mapInArrow(_probe_batches(filters), "word string, n long, near string")
        found = edits if found is None else found.union(edits)
    if passes > 1:  # a false positive of one pass can be a word of another
        found = found.distinct()
    return found.join(keyed.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")


def spelling_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH,
                    least_count: int = LEAST_COUNT, ratio: int = RATIO, altered: int = ALTERED,
                    per_pass: int = bloom.PER_PASS) -> DataFrame:
    """Return word, form, root, n, n_near, form_n: one row per word of the vocabulary.

    Words are runs of A-Z, a-z and U+00C0 to U+00FF; only A-Z is lower-cased. Null and empty texts hold no word, a
    null id counts as empty text, and repeated rows count again. Of near words with
    equal counts the first in code-point order is the form. Words of any length are whole; an empty table
    gives an empty result. Other columns of ``df`` are not read. ``ratio`` must be 10 or more (see the module's text).
    """
    if ratio < 10:
        raise ValueError("ratio must be at least 10: it bounds the chains of forms")
    words = materialize(vocabulary(df, id_col, text_col, least_length, least_count, altered), "spelling-words")
    pairs = near_words(words, per_pass)
    side = lambda word, near, n: F.struct(F.col(word).alias("word"), F.col(near).alias("near"), F.col(n).alias("near_n"))
    both = pairs.select(F.explode(F.array(side("word", "near", "near_n"), side("near", "word", "n"))).alias("p")).select("p.*")
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                    F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    close = F.col("best.less") <= -F.lit(ratio) * F.col("n")
    linked = materialize(
        words.join(best, "word", "left")
        .select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(close, F.col("best.near")).alias("form"),
                F.when(close, -F.col("best.less")).alias("form_n")), "spelling-forms")
    hops = linked.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(DOUBLINGS):
        up = hops.select(F.col("word").alias("root"), F.col("root").alias("top"))
        hops = materialize(hops.join(up, "root", "left").select("word", F.coalesce("top", "root").alias("root")), "spelling-roots")
    return (linked.join(hops, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
