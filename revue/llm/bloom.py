"""Split-block Bloom filters, built by Spark and tested with numpy.

A filter is an array of 256-bit blocks of eight 32-bit lanes; a key sets one bit in each lane of
one block. Filters are built slice by slice on the executors. A caller bounds the
size: ``BITS`` a key for at most ``PER_PASS`` keys, so at most 16 MB reach the driver and each worker at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from revue.llm import textops as T

BITS, PER_PASS, SLICE = 16, 8_000_000, 1 << 14
_LANES = np.arange(8, dtype=T.U) * T.U(5)


def _place(keys: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block of each key and the mixed key whose low 40 bits are its bits in the lanes."""
    mixed = T.mix(keys)
    return ((mixed >> T.U(32)) * T.U(blocks) >> T.U(32)).astype(np.int64), mixed


def blocks_for(keys: int) -> int:
    return max(1, -(-keys * BITS // 256))


class Filters:
    """Filters by shard: ``parts[shard]`` is an array (blocks, 8) of 32-bit lanes."""

    def __init__(self, parts: dict[int, np.ndarray]):
        self.parts = parts

    def find(self, shard: int, keys: np.ndarray) -> np.ndarray:
        """Positions of the keys that the filter of ``shard`` may hold (all that it holds are among them)."""
        lanes = self.parts.get(shard)
        if lanes is None:
            return np.zeros(0, np.int64)
        block, mixed = _place(keys, len(lanes))
        at = None
        for lane in range(8):
            bit = (mixed >> _LANES[lane] & T.U(31)).astype(np.uint32)
            hit = np.flatnonzero(lanes[block, lane] >> bit & np.uint32(1))
            at = hit if at is None else at[hit]
            block, mixed = block[hit], mixed[hit]
        return at


def build(keys: DataFrame, sizes: dict[int, int]) -> Filters:
    """Filters of ``keys`` (shard int, key long); ``sizes`` holds the number of keys of each shard."""
    blocks = {shard: blocks_for(n) for shard, n in sizes.items()}

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard = batch.column(0).to_numpy(zero_copy_only=False)
            of = np.array([blocks[s] for s in shard.tolist()], dtype=np.uint64) if len(shard) else np.zeros(0, np.uint64)
            mixed = T.mix(batch.column(1).to_numpy(zero_copy_only=False).view(T.U))
            block = ((mixed >> T.U(32)) * of >> T.U(32)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array((block // SLICE).astype(np.int32)), pa.array((block % SLICE).astype(np.int32)),
                 pa.array(mixed.view(np.int64))], ["shard", "slice", "block", "mixed"])

    def sliced(key: tuple, table: pa.Table) -> pa.Table:
        shard, part = key[0].as_py(), key[1].as_py()
        lanes = np.zeros((min(SLICE, blocks[shard] - part * SLICE), 8), np.uint32)
        block = table["block"].to_numpy()
        mixed = table["mixed"].to_numpy().view(T.U)
        for lane in range(8):
            bit = np.uint32(1) << (mixed >> _LANES[lane] & T.U(31)).astype(np.uint32)
            np.bitwise_or.at(lanes[:, lane], block, bit)
        return pa.table({"shard": pa.array([shard], pa.int32()), "slice": pa.array([part], pa.int32()),
                         "lanes": pa.array([lanes.tobytes()], pa.binary())})

    rows = (keys.select("shard", "key").mapInArrow(placed, "shard int, slice int, block int, mixed long")
            .groupBy("shard", "slice").applyInArrow(sliced, "shard int, slice int, lanes binary").collect())
    parts = {shard: np.zeros((n, 8), np.uint32) for shard, n in blocks.items()}
    for row in rows:
        own = np.frombuffer(row["lanes"], np.uint32).reshape(-1, 8)
        parts[row["shard"]][row["slice"] * SLICE:row["slice"] * SLICE + len(own)] = own
    return Filters(parts)
