"""Token-ID files: frequency-ranked ids in a byte-aligned code with separate control bytes.

Encoding. A byte-level BPE never merges across pre-tokens, so a text's ids are those of its pre-tokens in
a row. Pre-tokens of a block of texts are found with numpy on the UTF-8 bytes, and only ones
not seen before go to the tokenizers library; a bounded table keeps the ids of the others. That
holds for texts of ASCII and Latin characters, whose classes are settled; any other text goes to
the library whole. So does a text that holds an added token of the tokenizer file (``<|endoftext|>``),
which the library gives the token's own id.

Files. Ids are ranked by their frequency in all documents, so common ones have small ranks.
A rank takes 1 to 4 bytes; its length minus 1 goes into two bits of a control byte, four ranks to a byte.
All control bytes of a document come first, then all data bytes; both are packed with zstd.
Decoding looks each control byte up in a table of 256 rows of four lengths and gathers the data bytes.

A folder holds ``ranks/`` (rank, id) and ``files/``: Parquet files, each with the rows
(shard, row, id, n_tokens, code) of a range of document ids, ascending. Spark writes them,
so lost executors and remote stores are its commit protocol's business.
"""

from __future__ import annotations

import itertools
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revue.conf import materialize
from revue.llm import textops as T

BLOCK, KNOWN_MOST = 2 << 20, 1_000_000
#: Character classes of the byte-level pre-tokenizer.
LETTER, NUMBER, OTHER, SPACE = 0, 1, 2, 3
#: What follows an apostrophe in a contraction.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
_SPACES = {9, 10, 11, 12, 13, 32}
_SETTLED = np.array([c in _SPACES or 0x20 <= c < 0x7F or 0xA1 <= c < 0x250 for c in range(0x800)])
_CLASS = np.array([SPACE if c in _SPACES else {"L": LETTER, "N": NUMBER}.get(unicodedata.category(chr(c))[0], OTHER)
                   for c in range(0x800)], np.uint8)


def characters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class of each byte's character, whether it continues one, and whether its class is not settled."""
    code = data.astype(np.uint16)
    tail = (data & 0xC0) == 0x80
    lead = (data >= 0xC0) & (data < 0xE0)
    following = np.append(code[1:], np.uint16(0))
    code = np.where(lead, ((code & 0x1F) << 6) | (following & 0x3F), code)
    odd = ~tail & ~_SETTLED[np.minimum(code, 0x7FF)] | (data >= 0xE0)
    cls = _CLASS[np.minimum(code, 0x7FF)]
    at = np.flatnonzero(tail)
    cls[at] = cls[np.maximum(at, 1) - 1]  # only two-byte characters matter
    return cls, tail, odd


def pretoken_starts(data: np.ndarray, offsets: np.ndarray, cls: np.ndarray, tail: np.ndarray) -> np.ndarray:
    """First bytes of the pre-tokens of texts of settled characters; pre-tokens tile the texts."""
    n = len(data)
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    before = np.concatenate([[255], cls[:-1]]).astype(np.uint8)
    before[cut[:n]] = 255
    after = np.concatenate([cls[1:], [255]]).astype(np.uint8)
    after[cut[1:]] = 255
    blank_before = np.concatenate([[False], data[:-1] == 32]) & (before != 255)
    space = cls == SPACE
    start = np.where(space, (before != SPACE) | (after != SPACE) & (after != 255), (before != cls) & ~blank_before) & ~tail
    quote = np.flatnonzero((data == 39) & (before != OTHER) & ~blank_before & (after == LETTER))
    padded = np.concatenate([data, np.zeros(3, np.uint8)])
    stop = np.concatenate([cut, np.ones(3, bool)])
    for end in CONTRACTIONS:
        hit = quote
        for k, letter in enumerate(end):
            hit = hit[(padded[hit + 1 + k] == ord(letter)) & ~stop[hit + 1 + k]]
        start[hit + 1] = False
        rest = hit + 1 + len(end)
        rest = rest[(rest < n)]
        rest = rest[~cut[rest]]
        start[rest] = True
    return np.flatnonzero(start)


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it is a visible
    Latin-1 character, else the next free one from U+0100 on, in the order of the bytes."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(0x100 + k) for k, b in enumerate(hidden)}


class Encoder:
    """Ids of texts by a byte-level BPE tokenizer file; remembers at most ``most`` pre-tokens.

    With ``added``, as the token files have it, ids are those of the library as it is. Without, the names of special
    tokens in a text are plain characters (the library's ``encode_special_tokens``).
    """

    def __init__(self, path: str, most: int = KNOWN_MOST, added: bool = False):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()
                      if added or not t.special]
        self.model, self.letters, self.most = self.tokenizer.model, byte_letters(), most
        self._forget()

    def _forget(self) -> None:
        self.numbers, self.size = T.Numbers(), 0
        self.flat, self.begin = np.zeros(1 << 16, np.uint32), np.zeros(1 << 12, np.int64)

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _holds_added(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Whether each text holds an added token; one that a token across its end begins in may count too."""
        out, raw = np.zeros(len(offsets) - 1, bool), data.tobytes()
        for token in self.added:
            at = raw.find(token)
            while at >= 0:
                k = int(np.searchsorted(offsets, at, "right")) - 1
                out[k] = True
                at = raw.find(token, max(at + 1, int(offsets[k + 1]) - len(token) + 1))
        return out

    def _add(self, hashes: np.ndarray, pretokens: list[bytes]) -> np.ndarray:
        """Number new pre-tokens, whose ids the library's BPE model gives one by one."""
        text, tokenize = b"".join(pretokens).decode("latin-1").translate(self.letters), self.model.tokenize
        cuts = [0, *itertools.accumulate(map(len, pretokens))]
        ids = [[t.id for t in tokenize(text[a:b])] for a, b in itertools.pairwise(cuts)]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((i for one in ids for i in one), np.uint32, int(sizes.sum()))
        while self.size + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(len(self.flat), np.uint32)])
        while self.numbers.size + len(ids) + 1 > len(self.begin):
            self.begin = np.concatenate([self.begin, np.zeros(len(self.begin), np.int64)])
        self.flat[self.size:self.size + len(flat)] = flat
        new = self.numbers.add(hashes)
        self.begin[new + 1] = self.size + np.cumsum(sizes)
        self.size += len(flat)
        return new

    def block(self, data: np.ndarray, offsets: np.ndarray, cls: np.ndarray, tail: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts of a block of settled characters, and the first id of each text (with the end)."""
        starts = pretoken_starts(data, offsets, cls, tail)
        ends = np.append(starts[1:], len(data))
        hashes = T.word_hashes(data, starts, ends)
        one, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        if self.numbers.size + len(one) > self.most:
            self._forget()
        at = self.numbers.find(one)
        missing = np.flatnonzero(at < 0)
        if len(missing):
            raw = data.tobytes()
            at[missing] = self._add(one[missing], [raw[starts[f]:ends[f]] for f in first[missing]])
        at = at[which]
        sizes = self.begin[at + 1] - self.begin[at]
        to = np.cumsum(sizes)
        total = int(to[-1]) if len(to) else 0
        ids = self.flat[np.arange(total) + np.repeat(self.begin[at] - (to - sizes), sizes)]
        return ids, np.concatenate([[0], to])[np.searchsorted(starts, offsets)]

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text in order; null counts as empty."""
        for _, _, data, offsets in T.blocks(texts, BLOCK):
            cls, tail, odd = characters(data)
            run = np.concatenate([[0], np.cumsum(odd)])
            plain = (run[offsets[1:]] == run[offsets[:-1]]) & ~self._holds_added(data, offsets)
            if plain.all():
                ids, first = self.block(data, offsets, cls, tail)
                yield from (ids[a:b] for a, b in zip(first[:-1], first[1:], strict=True))
                continue
            for k, ok in enumerate(plain):
                own = slice(offsets[k], offsets[k + 1])
                part = data[own]
                if ok:
                    yield self.block(part, np.array([0, len(part)]), cls[own], tail[own])[0]
                else:
                    yield self._whole(part.tobytes().decode())


_LENGTHS = np.array([[(c >> (2 * k) & 3) + 1 for k in range(4)] for c in range(256)], np.int64)
PIECE = 1 << 20


def pack(ranks: np.ndarray) -> bytes:
    """Control bytes, then data bytes."""
    ranks = ranks.astype(np.uint32)
    size = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    quads = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    quads[:len(ranks)] = size - 1
    control = quads.reshape(-1, 4) @ np.array([1, 4, 16, 64], np.uint8)
    end = np.cumsum(size, dtype=np.int64)
    data = np.empty(int(end[-1]) if len(end) else 0, np.uint8)
    begin = end - size
    data[begin] = ranks & np.uint32(0xFF)
    for k in (1, 2, 3):
        long = np.flatnonzero(size > k)
        if not len(long):
            break
        data[begin[long] + k] = (ranks[long] >> np.uint32(8 * k)) & np.uint32(0xFF)
    return control.astype(np.uint8).tobytes() + data.tobytes()


def unpack(code: bytes, n: int) -> Iterator[np.ndarray]:
    """The ``n`` ranks, in pieces of at most ``PIECE``."""
    raw = np.frombuffer(code, np.uint8)
    quads = -(-n // 4)
    at = quads
    for low in range(0, n, PIECE):
        high = min(n, low + PIECE)
        size = _LENGTHS[raw[low // 4:-(-high // 4)]].ravel()[:high - low]
        begin = at + np.cumsum(size) - size
        out = raw[begin].astype(np.uint32)
        for k in (1, 2, 3):
            long = np.flatnonzero(size > k)
            if len(long):
                out[long] |= raw[begin[long] + k].astype(np.uint32) << np.uint32(8 * k)
        at += int(size.sum())
        yield out


_ENCODERS: dict[str, Encoder] = {}


def _encode_batches(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _ENCODERS:  # a worker keeps it from task to task
            _ENCODERS[path] = Encoder(path, added=True)
        encoder = _ENCODERS[path]
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            texts = batch.column(1)
            for low in range(0, batch.num_rows, 1000):
                sizes, codes = [], []
                for ids in encoder.encode(texts.slice(low, 1000)):
                    ids = np.append(ids, np.uint32(end_id))
                    sizes.append(len(ids))
                    codes.append(packer.compress(np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, 1000), pa.array(sizes, pa.int64()),
                                                  pa.array(codes, pa.binary())], ["id", "n", "code"])
    return run


def _plain(code: bytes, n: int) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(code, max_output_size=4 * n)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, n).T).view("<u4").ravel()


def _frequency_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    count = np.zeros(1, np.int64)
    for batch in batches:
        for low in range(0, batch.num_rows, 1000):
            part = batch.slice(low, 1000)
            more = np.bincount(np.concatenate([_plain(code.as_py(), n) for n, code in zip(
                part.column(0).to_pylist(), part.column(1), strict=True)]))
            if len(more) > len(count):
                count, more = more, count
            count[:len(more)] += more
    ids = np.flatnonzero(count)
    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(count[ids])], ["token", "n"])


def _pack_batches(by_frequency: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = np.zeros(int(by_frequency.max(initial=0)) + 1, np.uint32)
        rank[by_frequency] = np.arange(len(by_frequency), dtype=np.uint32)
        packer, row = zstandard.ZstdCompressor(level=1), 0
        for batch in batches:
            codes = [packer.compress(pack(rank[_plain(code.as_py(), n)]))
                     for n, code in zip(batch.column(2).to_pylist(), batch.column(3), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.arange(row, row + len(codes))), batch.column(1), batch.column(2),
                 pa.array(codes, pa.binary())], ["shard", "row", "id", "n_tokens", "code"])
            row += len(codes)
    return run


def write_token_files(df: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                      end_id: int = 0) -> None:
    """Encode every text as the library does, append ``end_id``, and write ``path/ranks`` and ``path/files``, ascending by id.

    ``tokenizer`` is the file of a byte-level BPE tokenizer, found there on every host. Null counts as
    empty text: one id, the end. Null ids come first; repeated ids stay side by side. An
    empty table gives folders without rows. A document's code is one Parquet value (2 GB at most).
    """
    kind = df.schema[id_col].dataType.simpleString()
    coded = materialize(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
                        .mapInArrow(_encode_batches(tokenizer, end_id), f"id {kind}, n long, code binary"), "token-codes")
    # At most one row per id of the vocabulary.
    count = (coded.select("n", "code").mapInArrow(_frequency_batches, "token long, n long").groupBy("token")
             .agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "token").collect())
    by_frequency = np.array([r["token"] for r in count], np.int64)
    spark = df.sparkSession
    spark.createDataFrame([(k, int(t)) for k, t in enumerate(by_frequency)], "rank long, id long").coalesce(1).write.parquet(
        f"{path}/ranks")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (coded.repartitionByRange(parts, "id").sortWithinPartitions("id", "n", "code")
     .select(F.spark_partition_id().alias("shard"), "id", "n", "code")
     .mapInArrow(_pack_batches(by_frequency), f"shard int, row long, id {kind}, n_tokens long, code binary")
     .write.option("compression", "uncompressed").parquet(f"{path}/files"))


def _ranks(spark: SparkSession, path: str) -> np.ndarray:
    return np.array([r["id"] for r in spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()], np.uint32)


def _decoded(code: bytes, n: int, by_frequency: np.ndarray) -> Iterator[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(code, max_output_size=5 * n + 8)
    return (by_frequency[piece] for piece in unpack(raw, n))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """shard, row, id, ids (array<long>) of every document of the files."""
    by_frequency = _ranks(spark, path)
    files = spark.read.parquet(f"{path}/files")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [np.concatenate([*_decoded(code.as_py(), n, by_frequency)]).astype(np.int64)
                   for n, code in zip(batch.column(3).to_pylist(), batch.column(4), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(ids, pa.list_(pa.int64()))],
                                             ["shard", "row", "id", "ids"])
    kind = files.schema["id"].dataType.simpleString()
    return files.select("shard", "row", "id", "n_tokens", "code").mapInArrow(
        run, f"shard int, row long, id {kind}, ids array<long>")


def digests(spark: SparkSession, path: str) -> DataFrame:
    """id, start, n_tokens, ids_crc32 of every document, decoded from the files of ``write_token_files``."""
    by_frequency = _ranks(spark, path)
    files = spark.read.parquet(f"{path}/files")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, crcs = [], []
            for n, code in zip(batch.column(3).to_pylist(), batch.column(4), strict=True):
                crc = size = 0
                for piece in _decoded(code.as_py(), n, by_frequency):
                    crc, size = zlib.crc32(piece.astype("<u4").tobytes(), crc), size + len(piece)
                sizes.append(size)
                crcs.append(crc)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sizes, pa.int64()), pa.array(crcs, pa.int64())],
                                             ["shard", "row", "id", "n_tokens", "ids_crc32"])
    kind = files.schema["id"].dataType.simpleString()
    read = materialize(files.select("shard", "row", "id", "n_tokens", "code").mapInArrow(
        run, f"shard int, row long, id {kind}, n_tokens long, ids_crc32 long"), "token-digests")
    upto = Window.orderBy("shard")  # one row per file
    shards = (read.groupBy("shard").agg(F.sum("n_tokens").alias("sum"))
              .withColumn("first", F.sum("sum").over(upto) - F.col("sum")).select("shard", "first"))
    within = Window.partitionBy("shard").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    return (read.join(shards, "shard")
            .withColumn("start", F.col("first") + F.sum("n_tokens").over(within) - F.col("n_tokens"))
            .select("id", "start", "n_tokens", "ids_crc32"))
