"""Windows that also stand earlier in the corpus: what the two substring operators share.

A window is ``width`` consecutive units (words or bytes) of one text. Its anchor
is the leftmost of its k-unit pieces with the least hash. Neighbouring windows
that share an anchor form a segment. Equal windows have equal anchors at equal
distance, so that only segments with equal anchor hash need to be compared:

1. A count-min sketch of the anchors of all segments is built from all
   partitions and merged. A window is estimated to stand as often as its anchor;
   what is estimated to stand once stands nowhere else.
2. ``scanner`` reads the texts again and sends the other segments on by anchor.
   What repeats within a task's share is marked there, and only its first copy
   goes on. Anchors with very many different segments are announced as hot and
   leave this path with all their segments.
3. ``grouper`` reads the segments in order of anchor and content, without
   holding more than one anchor's. Of equal segments all but the first are
   marked. Anchors with several different segments need a closer look, since
   these may share windows at their borders.
4. The caller compares those segments window by window and adds marks.

A mark (row, start, count) says that the windows from start on stand earlier
too, "earlier" meaning smaller doc, or the same and smaller start. Marks find
back to their text by doc and row, the hash of the text: rows alike in both lose
the same. Rows of one doc are one document, but rows of null doc_id are one each,
behind all others; they get written numbers as row, and stand in their order.
The texts are read several times, and must be the same each time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored
from .sketch import repeated_keys, twice
from .text_hash import all_hashes, byte_codes, chunks, hash_words, mix64, prefix_hash, window_hash

FLUSH = 1 << 20  # segments that a task holds before it sends them on
SLICE = 1 << 22  # windows of one text that are worked on together
HOT = 256  # different segments of one anchor in one task's share that make it hot
MANY = 1 << 12  # different segments of one anchor in all that make it hot
CROWD = 1 << 16  # rows of one anchor that are held; with more it is hot
SPACE = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])
PLAIN, MARK, NEED, HOT_NEED = 0, 1, 2, 3
KEY = ["nul", "doc", "row"]
SEGMENT = np.dtype([("anchor", "<i8"), ("content", "<i8"), ("nul", "?"), ("doc", "<i8"), ("row", "<i8"), ("start", "<i4"), ("count", "<i4")])
SENT = "kind int, deal long, anchor long, content long, nul boolean, doc long, row long, start int, count int"
FOUND = "kind int, nul boolean, doc long, row long, start int, count int, anchor long"


@dataclass(frozen=True)
class Windows:
    """What a unit is, the widths of windows and of the pieces that can be anchors, and how many units one code is made of."""

    words: bool
    width: int
    piece: int
    gram: int

    def hashes(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return window_hash(prefix, start, end - (self.gram - 1))


WORDS = Windows(words=True, width=20, piece=6, gram=1)
BYTES = Windows(words=False, width=100, piece=32, gram=8)


def units(texts: list[bytes], by: Windows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, text number of each unit, first unit of each text and the end)."""
    if by.words:
        codes, owner, _, _ = hash_words(texts, SPACE)
        return codes, owner, np.searchsorted(owner, np.arange(len(texts) + 1))
    codes = byte_codes(np.frombuffer(b"".join(texts), np.uint8))
    first = np.cumsum([0] + [len(t) for t in texts])
    return codes, np.repeat(np.arange(len(texts)), np.diff(first)), first


def _least_before(values: np.ndarray, span: int) -> np.ndarray:
    """Minimum of values[i : i + span] for every i at which that fits, by doubling."""
    out, have = values, 1
    while have < span:
        step = min(have, span - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def segments(texts: list[bytes], docs: np.ndarray, nul: np.ndarray, rows: np.ndarray, by: Windows) -> Iterator[np.ndarray]:
    """The segments of all windows of some texts, a slice of windows at a time; a border between slices parts a segment in two."""
    codes, owner, first = units(texts, by)
    for at in range(0, len(codes) - by.width + 1, SLICE):
        upto = min(at + SLICE + by.width - 1, len(codes))
        yield _segments(codes[at:upto], owner[at:upto], first - at, docs, nul, rows, by)


def _segments(codes: np.ndarray, owner: np.ndarray, first: np.ndarray, docs: np.ndarray, nul: np.ndarray, rows: np.ndarray, by: Windows) -> np.ndarray:
    n = len(codes)
    prefix = prefix_hash(codes)
    pieces = all_hashes(prefix, by.piece - by.gram + 1)[: n - by.piece + 1]
    at = np.arange(len(pieces))
    low = np.uint64((1 << 26) - 1)
    ranked = (pieces & ~low) | at.astype(np.uint64)  # equal hashes: the leftmost
    anchor = (_least_before(ranked, by.width - by.piece + 1) & low).astype(np.int64)
    whole = owner[: n - by.width + 1] == owner[by.width - 1 :]
    new = np.ones(len(anchor), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1 : len(anchor)] != owner[: len(anchor) - 1]) | ~whole[:-1]
    start = np.flatnonzero(new & whole)
    ends = np.flatnonzero(np.append(new[1:] | ~whole[1:], True) & whole) + 1
    out = np.zeros(len(start), SEGMENT)
    out["anchor"] = pieces[anchor[start]].view(np.int64)
    out["content"] = (by.hashes(prefix, start, ends - 1 + by.width) + (anchor[start] - start).astype(np.uint64)).view(np.int64)
    out["doc"], out["nul"], out["row"] = docs[owner[start]], nul[owner[start]], rows[owner[start]]
    out["start"] = start - first[owner[start]]
    out["count"] = ends - start
    return out


def document(s: np.ndarray) -> np.ndarray:
    """What tells apart the documents of one doc: the row where doc_id is null, else nothing."""
    return np.where(s["nul"], s["row"], 0)


def _runs(s: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of ordered segments: which begin an anchor, which begin a content, and which are at the place of their content's first copy.

    Announcements (count 0) are contents of their own. The last are repeated
    rows of a document, which don't count as earlier.
    """
    anchor = np.ones(len(s), bool)
    anchor[1:] = s["anchor"][1:] != s["anchor"][:-1]
    content = anchor.copy()
    content[1:] |= (s["content"][1:] != s["content"][:-1]) | ((s["count"][1:] > 0) != (s["count"][:-1] > 0))
    lead = np.flatnonzero(content)[np.cumsum(content) - 1]
    part = document(s)
    same = (s["nul"] == s["nul"][lead]) & (s["doc"] == s["doc"][lead]) & (part == part[lead]) & (s["start"] == s["start"][lead])
    return anchor, content, same


def sent(kind: int, s: np.ndarray, deal: np.ndarray) -> pa.RecordBatch:
    columns = {"kind": pa.array(np.full(len(s), kind, np.int32)), "deal": pa.array(deal)}
    return pa.record_batch(columns | {k: pa.array(np.ascontiguousarray(s[k])) for k in ("anchor", "content", "nul", "doc", "row", "start", "count")})


def combined(s: np.ndarray) -> Iterator[pa.RecordBatch]:
    """What a task sends of its segments: marks for what repeats among them, the segments of hot anchors, and of all others one of each content."""
    s = s[np.lexsort((s["row"], s["start"], document(s), s["doc"], s["nul"], s["content"], s["anchor"]))]
    anchor, content, same = _runs(s)
    again = ~content & ~same
    number = np.cumsum(anchor) - 1
    crowd = np.bincount(number[content], minlength=number[-1] + 1 if len(number) else 0) >= HOT
    hot = crowd[number] if len(s) else np.zeros(0, bool)
    announced = s[anchor & hot].copy()
    announced["count"] = 0
    plain = np.concatenate([s[~again & ~hot], announced])
    by_row = lambda x: mix64((x["row"] ^ x["doc"]).view(np.uint64) * np.uint64(3) + x["start"].astype(np.uint64)).view(np.int64)
    for kind, rows, deal in ((MARK, s[again], by_row), (HOT_NEED, s[~again & hot], by_row), (PLAIN, plain, lambda x: np.ascontiguousarray(x["anchor"]))):
        if len(rows):
            yield sent(kind, rows, deal(rows))


def _columns(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """doc (0 for null), whether it is null, and row: the KEY."""
    return batch.column("doc").to_numpy(), batch.column("nul").to_numpy(zero_copy_only=False), batch.column("row").to_numpy()


def _all_segments(batches: Iterator[pa.RecordBatch], by: Windows) -> Iterator[np.ndarray]:
    for batch in batches:
        docs, nul, rows = _columns(batch)
        for first, texts in chunks(t or b"" for t in batch.column("text").to_pylist()):
            part = slice(first, first + len(texts))
            yield from segments(texts, docs[part], nul[part], rows[part], by)


def scanner(by: Windows, repeated: Callable[[np.ndarray], np.ndarray]) -> Callable:
    """For mapInArrow over (nul, doc, row, text): the segments whose anchors ``repeated`` lets pass."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for s in _all_segments(batches, by):
            held.append(s[repeated(np.ascontiguousarray(s["anchor"]).view(np.uint64))])
            size += len(held[-1])
            if size >= FLUSH:
                yield from combined(np.concatenate(held))
                held, size = [], 0
        if size:
            yield from combined(np.concatenate(held))

    return scan


def _found(kind: int, s: np.ndarray) -> pa.RecordBatch:
    columns = {"kind": pa.array(np.full(len(s), kind, np.int32))}
    return pa.record_batch(columns | {k: pa.array(np.ascontiguousarray(s[k])) for k in ("nul", "doc", "row", "start", "count", "anchor")})


def _judge(s: np.ndarray, crowd: bool, resumed: bool) -> Iterator[pa.RecordBatch]:
    """Marks and needs of whole anchors. The first may be a ``crowd``, and be ``resumed``: then its first row is a copy of an earlier one."""
    anchor, content, same = _runs(s)
    real = s["count"] > 0
    again = ~content & ~same & real
    number = np.cumsum(anchor) - 1
    several = np.bincount(number[content & real], minlength=number[-1] + 1)
    hot = (np.bincount(number[~real], minlength=len(several)) > 0) | (several > MANY)
    hot[0] |= crowd
    lead = real & ~again
    lead[0] &= not resumed
    for kind, rows in ((MARK, again), (NEED, lead & (several[number] > 1) & ~hot[number]), (HOT_NEED, lead & hot[number])):
        if rows.any():
            yield _found(kind, s[rows])


def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over SENT rows in order: marks, and segments that need a closer look."""
    held, crowd = np.zeros(0, SEGMENT), False
    for batch in batches:
        kind = batch.column("kind").to_numpy()
        s = np.zeros(len(kind), SEGMENT)
        for k in SEGMENT.names:
            s[k] = batch.column(k).to_numpy(zero_copy_only=False)
        for k in (MARK, HOT_NEED):
            if (kind == k).any():
                yield _found(k, s[kind == k])
        rows = np.concatenate([held, s[kind == PLAIN]])
        if not len(rows):
            continue
        last = np.searchsorted(rows["anchor"], rows["anchor"][-1])
        if last:
            yield from _judge(rows[:last], crowd, crowd)
            rows, crowd = rows[last:], False
        if len(rows) > CROWD:
            yield from _judge(rows, True, crowd)
            begins = np.flatnonzero(_runs(rows)[1])[-1]
            rows, crowd = rows[begins : begins + 1], True
        held = rows
    if len(held):
        yield from _judge(held, crowd, crowd)


def grouped(dealt: DataFrame) -> DataFrame:
    """SENT rows -> FOUND rows."""
    part = F.when(F.col("nul"), F.col("row")).otherwise(0)
    in_order = dealt.repartition("deal").sortWithinPartitions("kind", "anchor", F.col("count") > 0, "content", "nul", "doc", part, "start", "row")
    return in_order.mapInArrow(group, FOUND)


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> (nul, doc, row, text binary). Rows without a doc_id are written, so that they keep their numbers."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    known = rows.filter("doc_id is not null").withColumn("row", F.xxhash64("text"))
    nameless = stored(rows.filter("doc_id is null").withColumn("row", F.monotonically_increasing_id()))
    return known.unionByName(nameless).select(F.col("doc_id").isNull().alias("nul"), F.coalesce("doc_id", F.lit(0).cast("long")).alias("doc"), F.coalesce("row", F.lit(0).cast("long")).alias("row"), "text")


def sketched(docs: DataFrame, by: Windows) -> np.ndarray:
    """The merged sketch of the anchors of all segments."""
    return repeated_keys(docs, lambda batches: (np.ascontiguousarray(s["anchor"]).view(np.uint64) for s in _all_segments(batches, by)))


def find_segments(docs: DataFrame, by: Windows) -> DataFrame:
    """(nul, doc, row, text) -> FOUND rows of kinds MARK, NEED and HOT_NEED, stored."""
    sketch = docs.sparkSession.sparkContext.broadcast(sketched(docs, by))
    return stored(grouped(docs.mapInArrow(scanner(by, lambda keys: twice(sketch.value, keys)), SENT)))


def per_row(rows: DataFrame, name: str, *fields: str) -> DataFrame:
    return rows.groupBy(*KEY).agg(F.collect_list(F.struct(*fields)).alias(name))


def doc_id() -> Column:
    """Back from the key."""
    return F.when(~F.col("nul"), F.col("doc")).alias("doc_id")


def covered(n: int, starts: np.ndarray, counts: np.ndarray, width: int) -> np.ndarray:
    """Which of n units lie in a marked window."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, np.minimum(starts, n), 1)
    np.add.at(edge, np.minimum(starts + counts - 1 + width, n), -1)
    return np.cumsum(edge[:n]) > 0
