"""Words, shingles and their hashes, computed on whole Arrow string buffers with numpy.

A word is a run of ASCII letters, digits and bytes of non-ASCII characters; other
ASCII characters separate words. Callers lower-case texts in Spark first. A text
with fewer than ``k`` words has one shingle, of all its words; one without words has none.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

U = np.uint64
_P1, _P2, _P3 = U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)
WORD_BYTE = np.array([48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])
_MASK = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=U)
BLOCK_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> U(30))) * _P2
    x = (x ^ (x >> U(27))) * _P3
    return x ^ (x >> U(31))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (from 0) of a string array; nulls are empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if not len(texts) or texts.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES, rows: int | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of stretches of about ``limit`` bytes, of at most ``rows`` texts; a longer text is one alone."""
    data, offsets = buffers(texts)
    row = 0
    while row < len(offsets) - 1:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        end = min(end, row + rows) if rows else end
        yield row, end, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


def word_spans(data: np.ndarray, offsets: np.ndarray,
               word_byte: np.ndarray = WORD_BYTE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the first word of each text (with the end)."""
    return spans(word_byte[data], offsets)


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every run of bytes that are ``inside``, and the first run of each text (with the end)."""
    cut = np.zeros(len(inside) + 1, bool)
    cut[offsets] = True
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1] | cut[1:-1]
    ends[:-1] &= ~inside[1:] | cut[1:-1]
    at = np.flatnonzero(starts)
    return at, np.flatnonzero(ends) + 1, np.searchsorted(at, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, eight bytes a step."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, dtype="<u8", buffer=padded, strides=(1,))
    size = ends - starts
    out = mix(size.astype(U) * _P1 + _P2)
    active, k = np.arange(len(starts)), 0
    while len(active):
        part = eight[starts[active] + k] & _MASK[np.minimum(size[active] - k, 8)]
        out[active] = mix((out[active] ^ part) * _P1)
        k += 8
        active = active[size[active] > k]
    return out


def shingles(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of ``k`` successive words; first shingle of each text (with the end); each one's first word."""
    count = np.diff(first)
    n = np.where(count >= k, count - k + 1, (count > 0).astype(np.int64))
    begin = np.concatenate([[0], np.cumsum(n)])
    at = np.arange(begin[-1]) - np.repeat(begin[:-1] - first[:-1], n)
    padded = np.concatenate([words, np.zeros(k, U)])
    left = np.repeat(first[1:], n) - at
    out = np.zeros(len(at), U)
    for j in range(k):
        w = padded[at + j]
        if (count < k).any():
            w = np.where(left > j, w, U(0))
        out = mix(out * _P1 + w)
    return out, begin, at


def labelled(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Values made distinct within each text: the n-th occurrence is hashed with its number n."""
    text = np.repeat(np.arange(len(begin) - 1), np.diff(begin)).astype(U)
    own = mix(values + text * _P1)
    order = np.sort(own)
    twice = np.unique(order[1:][order[1:] == order[:-1]])
    if not len(twice):
        return values
    rows = np.flatnonzero(np.isin(own, twice))
    by = rows[np.argsort(own[rows], kind="stable")]
    new = np.concatenate([[True], own[by][1:] != own[by][:-1]])
    run = np.arange(len(by)) - np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))
    out = values.copy()
    out[by] = np.where(run > 0, mix(values[by] + run.astype(U) * _P2), values[by])
    return out


class Numbers:
    """Numbers 64-bit hashes 0, 1, 2, ... in the order in which they are added.

    Two sorted arrays, the smaller one merged into the larger as it grows.
    """

    def __init__(self):
        self.parts = [(np.zeros(0, U), np.zeros(0, np.int64))] * 2
        self.size = 0

    def find(self, asked: np.ndarray) -> np.ndarray:
        """Number of each hash, -1 if it has none."""
        out = np.full(len(asked), -1)
        for known, number in self.parts:
            if len(known):
                at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
                out = np.where(known[at] == asked, number[at], out)
        return out

    def add(self, hashes: np.ndarray) -> np.ndarray:
        """Number distinct new hashes."""
        new = self.size + np.arange(len(hashes))
        self.size += len(hashes)
        large, small = self.parts
        small = self._merge(small, (hashes, new))
        if len(small[0]) > 50_000 + len(large[0]) // 4:
            large, small = self._merge(large, small), (np.zeros(0, U), np.zeros(0, np.int64))
        self.parts = [large, small]
        return new

    @staticmethod
    def _merge(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        known = np.concatenate([a[0], b[0]])
        order = np.argsort(known, kind="stable")
        return known[order], np.concatenate([a[1], b[1]])[order]


def row_filter(df: DataFrame, extra: dict[str, Column], decide) -> DataFrame:
    """Rows of ``df`` for which ``decide(extra arrays)`` holds, unshuffled; ``extra`` columns are added for it only.

    ``decide`` runs per Arrow batch, gets the extra arrays in order and returns a boolean array of its length.
    """
    names = [f"_x{k}_{uuid.uuid4().hex[:8]}" for k in range(len(extra))]
    width = len(df.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = decide([batch.column(width + k) for k in range(len(names))])
            yield batch.select(list(range(width))).filter(pa.array(keep))
    wide = df.select("*", *[c.alias(n) for n, c in zip(names, extra.values(), strict=True)])
    return wide.mapInArrow(run, df.schema)


def lists(values: np.ndarray, begin: np.ndarray) -> pa.Array:
    """An Arrow list<int64> array of stretches of ``values``."""
    return pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(values.view(np.int64)))
