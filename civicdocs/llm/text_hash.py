"""Vectorised hashing of words and windows inside tasks.

Texts are joined into one byte buffer per chunk. A word's hash mixes its bytes
eight at a time, for all words at once; no Python loop runs over words or bytes,
but for very long words. A window's hash is a polynomial of the codes of its
words, or of all its eight-byte pieces, taken from prefix sums.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

PART_ROWS = 512  # rows of an Arrow batch that are taken apart at a time
CHUNK = 1 << 20  # bytes of text that are hashed together; a longer text is a chunk of its own
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: spreads every input bit over all output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values; sorting beats the hashing of numpy.unique here."""
    x = np.sort(x)
    return x[np.concatenate([np.ones(min(1, len(x)), bool), x[1:] != x[:-1]])]


EIGHT = np.arange(8)
#: How much of eight bytes a word of so many bytes fills.
_FILLED = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
LONG_WORD = 256  # bytes; longer ones are hashed one by one


def byte_codes(buffer: np.ndarray) -> np.ndarray:
    """For every place of a byte string a 64-bit number of the eight bytes that begin there; beyond the end stand zeros."""
    out = np.concatenate([buffer, np.zeros(7, np.uint8)]).astype(np.uint64)
    for span in (1, 2, 4):
        out = out[:-span] | out[span:] << np.uint64(8 * span)
    return mix64(out + np.uint64(0x632BE59BD9B4E019))


def word_codes(buffer: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit number of the bytes of each word."""
    padded, size = np.concatenate([buffer, np.zeros(8, np.uint8)]), end - start
    out = size.astype(np.uint64) * np.uint64(0x632BE59BD9B4E019)
    at, more = 0, np.arange(len(start))
    while len(more) and at < LONG_WORD:
        eight = padded[start[more, None] + (at + EIGHT)].view("<u8").ravel()
        out[more] = mix64(out[more] + (eight & _FILLED[np.minimum(size[more] - at, 8)]) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(at))
        at += 8
        more = more[size[more] > at]
    for i in more.tolist():
        out[i] = np.frombuffer(hashlib.blake2b(buffer[start[i] : end[i]].tobytes(), digest_size=8).digest(), np.uint64)[0]
    return out


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i for i below n."""
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, factor in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, factor, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def prefix_hash(codes: np.ndarray) -> np.ndarray:
    """Prefix sums of codes[i] * base**i, one longer than codes; see window_hash."""
    out = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * powers(len(codes))[0], out=out[1:])
    return out


def window_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of codes[start:end], equal for equal content wherever it stands."""
    return mix64((prefix[end] - prefix[start]) * powers(len(prefix))[1][start] + (end - start).astype(np.uint64))


def all_hashes(prefix: np.ndarray, length: int) -> np.ndarray:
    """window_hash of every window of so many codes."""
    n = len(prefix) - length
    return mix64((prefix[length:] - prefix[:n]) * powers(len(prefix))[1][:n] + np.uint64(length))


def give_back() -> None:
    """Freed memory goes back to the system; a worker that waits for its next task would keep it beside the executor's own."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's; elsewhere nothing is done
    if trim is not None:
        trim(0)


def parts(batches: Iterable[pa.RecordBatch], rows: int = PART_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches by so many rows at a time, so that no more texts than these are Python objects at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    give_back()


def chunks(texts: Iterable[bytes], limit: int = CHUNK) -> Iterator[tuple[int, list[bytes]]]:
    """(number of the first text, texts) of about ``limit`` bytes."""
    held, size, first = [], 0, 0
    for i, t in enumerate(texts):
        if held and size + len(t) > limit:
            yield first, held
            held, size, first = [], 0, i
        held.append(t)
        size += len(t) + 1
    if held:
        yield first, held


def hash_words(texts: list[bytes], is_break: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text number, first byte, end byte in the joined buffer) of every word. is_break: for each byte value whether it parts words."""
    buffer = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    inside = ~is_break[buffer]
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    start, end = edge[::2], edge[1::2]
    hashes = word_codes(buffer, start, end)
    offsets = np.cumsum([0] + [len(t) + 1 for t in texts])
    return hashes, np.searchsorted(offsets, start, side="right") - 1, start, end
