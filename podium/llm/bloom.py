"""Blocked Bloom filters of bounded size over 64-bit hashes, in shards of 512-bit blocks.

Built in Spark (each task sets its bits, a shuffle ors the blocks), probed in numpy. ``Shards``
says which blocks belong to which shard; the whole filter takes at most the bytes it is given
(one block per shard aside), however many keys it holds: then fewer bits fall to a key and more
probes pass. No key is ever missed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILTER_BYTES, BITS_PER_KEY, HASHES = 32 << 20, 16, 6
_WORDS = [f"b{i}" for i in range(8)]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shards:
    """Where the blocks of each shard lie: ``first`` block and number of ``blocks``."""

    def __init__(self, counts: dict[int, int], filter_bytes: int = FILTER_BYTES):
        bits = min(BITS_PER_KEY, 8 * filter_bytes / max(1, sum(counts.values())))
        self.blocks = np.zeros(1 + max(counts, default=0), np.uint64)
        for shard, n in counts.items():
            self.blocks[shard] = max(1, int(n * bits / 512))
        self.first = np.concatenate([[0], np.cumsum(self.blocks)[:-1]]).astype(np.int64)
        self.total = int(self.blocks.sum())

    def place(self, hashes: np.ndarray, shard: int) -> tuple[np.ndarray, np.ndarray]:
        """Block of each hash, and the bits from which its places in the block come."""
        x = mix(hashes + np.uint64(shard))
        block = ((x >> np.uint64(32)) * self.blocks[shard]) >> np.uint64(32)
        return self.first[shard] + block.astype(np.int64), mix(x)


def _bit(y: np.ndarray, j: int) -> np.ndarray:
    return (y >> np.uint64(9 * j)) & np.uint64(511)


def filled(shards: Shards, hashes):
    """Arrow function: the blocks that a batch's keys set. ``hashes(batch)`` yields (shard, hashes)."""
    def run(batches):
        for batch in batches:
            blocks, bits = [], []
            for shard, values in hashes(batch):
                block, y = shards.place(values, shard)
                for j in range(HASHES):
                    blocks.append(block)
                    bits.append(_bit(y, j))
            if not blocks:
                continue
            block, bit = np.concatenate(blocks), np.concatenate(bits)
            own, at = np.unique(block, return_inverse=True)
            table = np.zeros((len(own), 8), np.uint64)
            np.bitwise_or.at(table, (at, (bit >> np.uint64(6)).astype(np.int64)),
                             np.uint64(1) << (bit & np.uint64(63)))
            yield pa.RecordBatch.from_pydict(
                {"block": own} | {n: table[:, i].view(np.int64) for i, n in enumerate(_WORDS)})
    return run


filled.schema = ", ".join(["block long", *(f"{n} long" for n in _WORDS)])


def filters(rows: DataFrame, shards: Shards) -> np.ndarray:
    """The filter from the blocks that the tasks set; its rows are bounded by ``shards.total``."""
    rows = rows.groupBy("block").agg(*[F.expr(f"bit_or({n})").alias(n) for n in _WORDS]).toPandas()
    table = np.zeros((max(1, shards.total), 8), np.uint64)
    table[rows["block"].to_numpy(np.int64)] = rows[_WORDS].to_numpy(np.int64).view(np.uint64)
    return table


def probe(shards: Shards, table: np.ndarray, hashes: np.ndarray, shard: int) -> np.ndarray:
    """Positions of the hashes that a shard's filter passes."""
    if shard >= len(shards.blocks) or not shards.blocks[shard]:
        return np.zeros(0, np.int64)
    block, y = shards.place(hashes, shard)
    left = np.arange(len(hashes))
    for j in range(HASHES):
        bit = _bit(y[left], j)
        hit = (table[block[left], (bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1)
        left = left[hit.astype(bool)]
    return left
