"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact check.

An item of L words is looked for in every window of L successive words of a document (a
shorter document is one window). Similarity of window and item: weighted Dice of their
five-word shingles, 2 * common weight / sum of both, a shingle weighing the letters of
its words; from 0.8 on the document is contaminated. A window can only reach that if it holds a
shingle of an item of its length, so windows without one are passed over unread.

The others get a 64-bit SimHash of their words (weighted by letters), from running sums of
the bits. Fingerprints within ``RADIUS`` bits of an item's are found by multi-index hashing: the 64
bits are cut into RADIUS + 1 blocks, so two fingerprints that differ in RADIUS bits at most agree in one
block, and the items of each block value are listed. An item found for a document in this way is then compared
exactly with every window that shares enough weight with it, and its best window is returned.

The radius decides what is found: of items cut off at an end or with words replaced, at a similarity from 0.8
on, it loses a few in a thousand (README); exact ones differ in no bit. ``exhaustive=True`` compares every
item that shares enough weight, at any distance.

Documents are not shuffled. Items are taken to the tasks in blocks of at most
``block_words`` words, a stated bound; a longer benchmark is searched block by block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revue.llm import textops as T

WORDS, SIMILARITY, RADIUS, BLOCK_WORDS = 5, 0.8, 18, 1_000_000
_BITS = np.arange(64, dtype=T.U)
_SEEN = 1 << 20


def signed_bits(words: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Running sums (words + 1) x 64 of +weight or -weight by the bits of each word's hash."""
    bits = ((T.mix(words)[:, None] >> _BITS) & T.U(1)).astype(np.int32) * 2 - 1
    out = np.zeros((len(words) + 1, 64), np.int32)
    np.cumsum(bits * weights[:, None].astype(np.int32), axis=0, out=out[1:])
    return out


def fingerprints(sums: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """SimHash of the windows of ``length`` words that begin at ``starts``."""
    total = sums[np.minimum(starts + length, len(sums) - 1)] - sums[starts]
    return ((total > 0).astype(T.U) << _BITS).sum(axis=1, dtype=T.U)


class HammingIndex:
    """Finds all of a set of fingerprints within ``radius`` bits of a query, by ``radius`` + 1 blocks."""

    def __init__(self, prints: np.ndarray, radius: int):
        self.prints, self.radius = prints, radius
        edges = np.linspace(0, 64, min(64, radius + 1) + 1).round().astype(int)
        self.blocks = []
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            part = self._part(prints, low, high)
            order = np.argsort(part, kind="stable")
            self.blocks.append((low, high, order, part[order]))

    @staticmethod
    def _part(prints: np.ndarray, low: int, high: int) -> np.ndarray:
        width = high - low
        return (prints >> T.U(low)) & (T.U(0xFFFFFFFFFFFFFFFF) >> T.U(64 - width))

    def search(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query number, print number) of every pair within the radius."""
        found = []
        for low, high, order, values in self.blocks:
            part = self._part(queries, low, high)
            first = np.searchsorted(values, part, "left")
            count = np.searchsorted(values, part, "right") - first
            q = np.repeat(np.arange(len(queries)), count)
            at = np.arange(len(q)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
            i = order[at]
            near = np.bitwise_count(queries[q] ^ self.prints[i]) <= self.radius
            found.append(q[near] * len(self.prints) + i[near])
        both = np.unique(np.concatenate(found))
        return both // len(self.prints), both % len(self.prints)


def dice(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Weighted Dice similarity of two shingle multisets; equal shingles weigh the same."""
    a_one, a_n = np.unique(a, return_counts=True)
    b_one, b_first, b_n = np.unique(b, return_index=True, return_counts=True)
    _, x, y = np.intersect1d(a_one, b_one, assume_unique=True, return_indices=True)
    common = (np.minimum(a_n[x], b_n[y]) * wb[b_first[y]]).sum()
    return float(2 * common / (wa.sum() + wb.sum()))


def shingle_weights(sizes: np.ndarray, at: np.ndarray, first: np.ndarray, begin: np.ndarray, k: int) -> np.ndarray:
    """Letters (bytes) of the words of each shingle."""
    sums = np.concatenate([[0], np.cumsum(sizes)])
    return sums[np.minimum(at + k, np.repeat(first[1:], np.diff(begin)))] - sums[at]


class ItemIndex:
    """A block of benchmark items, by shingle and by length."""

    def __init__(self, texts: list[str], words: int, similarity: float, radius: int, exhaustive: bool = False):
        self.words, self.similarity, self.exhaustive = words, similarity, exhaustive
        data, offsets = T.buffers(pa.array(texts, pa.large_string()))
        starts, ends, first = T.word_spans(data, offsets)
        hashes, sizes = T.word_hashes(data, starts, ends), ends - starts
        self.length = np.diff(first)
        by_k: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        self.shingles: list[np.ndarray] = []
        self.weights: list[np.ndarray] = []
        self.by_length: dict[int, tuple[np.ndarray, HammingIndex]] = {}
        # For each item length: sorted (shingle, item), a shingle of an item once; the least weight of an item.
        self.holders: dict[int, tuple[np.ndarray, np.ndarray, int]] = {}
        prints = np.zeros(len(texts), T.U)
        for i, n in enumerate(self.length):
            own, k = slice(first[i], first[i + 1]), min(words, int(n))
            span = np.array([0, n])
            if n:
                s, begin, at = T.shingles(hashes[own], span, k)
                self.shingles.append(s)
                self.weights.append(shingle_weights(sizes[own], at, span, begin, k))
                prints[i] = fingerprints(signed_bits(hashes[own], sizes[own]), np.array([0]), int(n))[0]
                by_k.setdefault(k, []).append((s, np.full(len(s), n)))
            else:
                self.shingles.append(np.zeros(0, T.U))
                self.weights.append(np.zeros(0, np.int64))
        self.total = np.array([w.sum() for w in self.weights], np.int64)
        for n in np.unique(self.length[self.length > 0]):
            items = np.flatnonzero(self.length == n)
            self.by_length[int(n)] = items, HammingIndex(prints[items], radius)
            own = [np.unique(self.shingles[i]) for i in items]
            s, i = np.concatenate(own), np.repeat(items, [len(o) for o in own])
            order = np.argsort(s, kind="stable")
            self.holders[int(n)] = s[order], i[order], int(self.total[items].min())
        # For each shingle size: sorted distinct (shingle, item length), and a table of low bits.
        self.hits = {}
        for k, parts in by_k.items():
            pairs = np.unique(np.rec.fromarrays([np.concatenate([p[0] for p in parts]),
                                                 np.concatenate([p[1] for p in parts])], names="s,n"))
            seen = np.zeros(_SEEN, bool)
            seen[pairs.s & T.U(_SEEN - 1)] = True
            self.hits[k] = np.ascontiguousarray(pairs.s), np.ascontiguousarray(pairs.n), seen

    def search(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, float]]:
        """(text, item, first word, similarity): the best window of every contaminating item of every text."""
        starts, ends, first = T.word_spans(data, offsets)
        hashes, sizes = T.word_hashes(data, starts, ends), ends - starts
        best: dict[tuple[int, int], tuple[float, int]] = {}
        for k, (known, length, seen) in self.hits.items():
            s, begin, at = T.shingles(hashes, first, k)
            rows = np.flatnonzero(seen[s & T.U(_SEEN - 1)])
            low, high = np.searchsorted(known, s[rows], "left"), np.searchsorted(known, s[rows], "right")
            rows, low, high = rows[high > low], low[high > low], high[high > low]
            if not len(rows):
                continue
            weights = shingle_weights(sizes, at, first, begin, k)
            text = np.searchsorted(begin, rows, "right") - 1
            for t in np.unique(text):
                mine = text == t
                count = (high - low)[mine]
                place = np.repeat(rows[mine] - begin[t], count)
                pick = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low[mine], count)
                words, own = slice(first[t], first[t + 1]), slice(begin[t], begin[t + 1])
                for n in np.unique(length[pick]):
                    self._windows(t, int(n), k, place[length[pick] == n], hashes[words], sizes[words], s[own],
                                  weights[own], best)
        return [(t, i, start, sim) for (t, i), (sim, start) in best.items()]

    def _windows(self, t, n, k, hit, hashes, sizes, shingles, weights, best) -> None:
        last = max(0, len(hashes) - n)
        reach = np.zeros(last + 2, np.int32)  # windows that begin at hit - (n - k) .. hit
        np.add.at(reach, np.clip(hit - (n - k), 0, last), 1)
        np.add.at(reach, np.clip(hit, 0, last) + 1, -1)
        begins = np.flatnonzero(np.cumsum(reach[:-1]) > 0)
        items, index = self.by_length[n]
        near: set[int] = set()
        for run in np.split(begins, np.flatnonzero(np.diff(begins) > n) + 1):
            for part in np.array_split(run, -(-len(run) // 20_000)) if not self.exhaustive else ():
                low, high = part[0], min(len(hashes), part[-1] + n)
                prints = fingerprints(signed_bits(hashes[low:high], sizes[low:high]), part - low, n)
                near.update(np.unique(items[index.search(prints)[1]]).tolist())
        if near or self.exhaustive:
            self._compare(t, n, begins, hit, max(1, n - k + 1), shingles, weights, best, None if self.exhaustive else near)

    def _check(self, t, item, start, size, shingles, weights, best) -> None:
        own = slice(start, start + size)
        sim = dice(shingles[own], weights[own], self.shingles[item], self.weights[item])
        if sim >= self.similarity - 1e-12:
            best[t, item] = max(best.get((t, item), (-1.0, 0)), (sim, -start))

    def _compare(self, t, n, begins, hit, size, shingles, weights, best, near: set[int] | None) -> None:
        """Best window of each item in ``near`` (all if None) among those whose shared shingles weigh enough.

        ``hit`` are the places of shingles of items of ``n`` words.
        """
        known, holder, least = self.holders[n]
        sums = np.concatenate([[0], np.cumsum(weights)])
        stops = np.minimum(begins + size, len(shingles))
        whole = sums[stops] - sums[begins]

        def shared(places: np.ndarray) -> np.ndarray:
            """Weight of the shingles of each window at ascending ``places``: the common weight at most."""
            upto = np.concatenate([[0], np.cumsum(weights[places])])
            return upto[np.searchsorted(places, stops)] - upto[np.searchsorted(places, begins)]

        may = 2 * shared(hit) >= (self.similarity - 1e-9) * (whole + least)
        begins, stops, whole = begins[may], stops[may], whole[may]
        if not len(begins):
            return
        # Places within a window that may reach it, and the items that hold their shingles.
        inside = np.searchsorted(begins, hit, "right") > np.searchsorted(stops, hit, "right")
        hit = hit[inside]
        low = np.searchsorted(known, shingles[hit], "left")
        count = np.searchsorted(known, shingles[hit], "right") - low
        place = np.repeat(hit, count)
        item = holder[np.arange(len(place)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)]
        # The common weight is that of the window at most, so it must be this share of the item's weight.
        share = self.similarity / (2 - self.similarity) - 1e-9
        enough = np.bincount(item, weights[place], len(self.total)) >= share * self.total
        order = np.flatnonzero(enough[item])
        order = order[np.argsort(item[order], kind="stable")]
        ones, first = np.unique(item[order], return_index=True)
        for i, own in zip(ones, np.split(place[order], first[1:]), strict=True):
            if near is not None and int(i) not in near:
                continue
            reach = 2 * np.minimum(shared(own), self.total[i]) / (whole + self.total[i])
            for w in np.argsort(-reach, kind="stable"):
                if reach[w] < max(self.similarity, best.get((t, int(i)), (0.0, 0))[0]) - 1e-9:
                    break
                self._check(t, int(i), int(begins[w]), size, shingles, weights, best)


def _match_batches(texts: list[str], words: int, similarity: float, radius: int, exhaustive: bool):
    made: list[ItemIndex] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not made:
            made.append(ItemIndex(texts, words, similarity, radius, exhaustive))
        for batch in batches:
            for row, _, data, offsets in T.blocks(batch.column(1)):
                found = made[0].search(data, offsets)
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array([row + f[0] for f in found])),
                         pa.array([int(f[1]) for f in found], pa.int64()), pa.array([-f[2] for f in found], pa.int64()),
                         pa.array([int(made[0].length[f[1]]) for f in found], pa.int64()),
                         pa.array([f[3] for f in found], pa.float64())],
                        ["id", "number", "first_word", "n_words", "similarity"])
    return run


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_words: int) -> Iterator[list[tuple[object, str]]]:
    """Items (id, lower-case text) in blocks of at most ``block_words`` words, read partition by partition."""
    rows = items.where(F.col(text_col).isNotNull()).select(F.col(id_col), F.lower(text_col))
    block: list[tuple[object, str]] = []
    size = 0
    for i, text in rows.toLocalIterator():
        # Words are separated, so half of the characters bound their number.
        n = len(text) // 2 + 1
        if block and size + n > block_words:
            yield block
            block, size = [], 0
        block.append((i, text))
        size += n
    if block:
        yield block


def contaminated(df: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_id_col: str = "item_id", item_text_col: str = "text", words: int = WORDS,
                 similarity: float = SIMILARITY, radius: int = RADIUS, block_words: int = BLOCK_WORDS,
                 exhaustive: bool = False) -> DataFrame:
    """Return id, item_id, first_word, n_words, similarity: the best window of each (document, item) found.

    The earliest window wins a tie. Ids can be of any type. An item of fewer than ``words`` words is one shingle of its own length. Null,
    empty and word-free texts and items match nothing. Repeated rows of a document are listed each, repeated
    items too; a null id is returned as null. Without documents or items the result is empty. Other columns are
    not read.
    """
    spark = df.sparkSession
    texts = df.select(F.col(id_col).alias("id"), F.lower(F.coalesce(F.col(text_col), F.lit(""))).alias("t"))
    kinds = [df.schema[id_col].dataType.simpleString(), items.schema[item_id_col].dataType.simpleString()]
    ddl = f"id {kinds[0]}, number long, first_word long, n_words long, similarity double"
    out = spark.createDataFrame([], ddl.replace("number long", f"item {kinds[1]}"))
    for n, block in enumerate(item_blocks(items, item_id_col, item_text_col, block_words)):
        found = texts.mapInArrow(_match_batches([t for _, t in block], words, similarity, radius, exhaustive), ddl)
        names = spark.createDataFrame([(k, i) for k, (i, _) in enumerate(block)], f"number long, item {kinds[1]}")
        # a name per item of the block: bounded by block_words
        found = found.join(F.broadcast(names), "number").select("id", "item", "first_word", "n_words", "similarity")
        out = found if n == 0 else out.union(found)
    return out.select(F.col("id").alias(id_col), F.col("item").alias(item_id_col), "first_word", "n_words", "similarity")


def clean(df: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
          item_text_col: str = "text", words: int = WORDS, similarity: float = SIMILARITY, radius: int = RADIUS,
          block_words: int = BLOCK_WORDS, exhaustive: bool = False) -> DataFrame:
    """The rows of ``df``, whole, that hold no item; nothing is shuffled. Cases as for ``contaminated``."""
    def without(block: list[tuple[object, str]]):
        made: list[ItemIndex] = []

        def decide(extra: list[pa.Array]) -> np.ndarray:
            if not made:
                made.append(ItemIndex([t for _, t in block], words, similarity, radius, exhaustive))
            keep = np.ones(len(extra[0]), bool)
            for row, _, data, offsets in T.blocks(extra[0]):
                keep[[row + f[0] for f in made[0].search(data, offsets)]] = False
            return keep
        return decide

    for block in item_blocks(items, item_id_col, item_text_col, block_words):
        df = T.row_filter(df, {"text": F.lower(F.coalesce(F.col(text_col), F.lit("")))}, without(block))
    return df
