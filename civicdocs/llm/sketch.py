"""A count-min sketch of which keys occur twice, built from partitions and merged block by block.

DEPTH rows of WIDTH counters, which stop at 2, count 64-bit keys. A task sends,
for each block of cells, the cells it hit once and those it hit more often; a
block's cells are added in one place, and what is left of the merged sketch is a
bit a cell: hit at least twice. Counters are never too low, so no key that
occurs twice is missed. The size is fixed: DEPTH * WIDTH / 8 bytes are sent to
the tasks, whatever the input. Far more keys than cells fill it, and then it
keeps back little, with the same result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .text_hash import mix64

DEPTH = 2
WIDTH = 1 << 26
BLOCK = 1 << 20  # cells that are added together
FLUSH = 1 << 20  # keys that a task holds before it sends their cells
PARTIAL = "block int, once binary, more binary"


def cells(keys: np.ndarray, row: int) -> np.ndarray:
    return (mix64(keys + np.uint64((row + 1) * 0xA0761D6478BD642F & 0xFFFFFFFFFFFFFFFF)) % np.uint64(WIDTH)).astype(np.int64) + row * WIDTH


def partial(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """A partition's sketch: (block, cells hit once, cells hit more often) of every block that was hit."""
    hit = np.sort(np.concatenate([cells(keys, r) for r in range(DEPTH)]))
    first = np.flatnonzero(np.concatenate([[True], hit[1:] != hit[:-1]])) if len(hit) else np.zeros(0, np.int64)
    hit, often = hit[first], np.diff(np.append(first, len(hit))) > 1
    blocks = hit // BLOCK
    starts = np.flatnonzero(np.concatenate([[True], blocks[1:] != blocks[:-1]])) if len(hit) else np.zeros(0, np.int64)
    for a, b in zip(starts, np.append(starts[1:], len(hit)), strict=True):
        inside = (hit[a:b] % BLOCK).astype(np.uint32)
        yield int(blocks[a]), inside[~often[a:b]], inside[often[a:b]]


def add(counters: np.ndarray, once: np.ndarray, more: np.ndarray) -> None:
    """Add a partition's cells to a block's counters."""
    counters[once] = np.minimum(counters[once] + 1, 2)
    counters[more] = 2


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks come one after the other."""
    block, counters = None, np.zeros(BLOCK, np.uint8)

    def done():
        bits = np.packbits(counters >= 2, bitorder="little")
        n = int(bits.any())  # a block without such a cell says nothing
        return pa.record_batch({"block": pa.array([block] * n, pa.int32()), "bits": pa.array([bits.tobytes()] * n, pa.binary())})

    for batch in batches:
        for b, once, more in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if b != block:
                if block is not None:
                    yield done()
                block, counters = b, np.zeros(BLOCK, np.uint8)
            add(counters, np.frombuffer(once, np.uint32), np.frombuffer(more, np.uint32))
    if block is not None:
        yield done()


def twice(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the merged sketch estimates each key to occur twice or more."""
    out = np.ones(len(keys), bool)
    for r in range(DEPTH):
        at = cells(keys, r)
        out &= (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
    return out


def repeated_keys(rows: DataFrame, keys_of: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]]) -> np.ndarray:
    """First pass: a bit for every cell of the merged sketch. ``keys_of`` turns a task's batches of ``rows`` into arrays of keys."""

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def sent():
            parts = list(partial(np.concatenate(held)))
            return pa.record_batch({
                "block": pa.array([p[0] for p in parts], pa.int32()), "once": pa.array([p[1].tobytes() for p in parts], pa.binary()),
                "more": pa.array([p[2].tobytes() for p in parts], pa.binary()),
            })

        for keys in keys_of(batches):
            held.append(keys)
            size += len(keys)
            if size >= FLUSH:
                yield sent()
                held, size = [], 0
        if size:
            yield sent()

    merged = rows.mapInArrow(sketched, PARTIAL).repartition("block").sortWithinPartitions("block").mapInArrow(_merged, "block int, bits binary")
    table, bits = merged.toArrow(), np.zeros(DEPTH * WIDTH // 8, np.uint8)  # no more reaches the driver
    for block, part in zip(table["block"].to_pylist(), table["bits"].to_pylist(), strict=True):
        bits[block * BLOCK // 8 : (block + 1) * BLOCK // 8] = np.frombuffer(part, np.uint8)
    return bits
