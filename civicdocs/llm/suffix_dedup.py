"""Remove repeated strings of 100 bytes with sharded suffix arrays.

Segments whose anchor has different surroundings elsewhere are dealt to shards
with their bytes. A shard cuts them to the runs of windows whose hash repeats
there, takes one of equal runs, builds the suffix array of these by induced
sorting and the permuted common prefixes with it; suffixes that agree with
their neighbour in 100 bytes are equal windows, and so are those of equal runs. All but the first
place are marked. Segments that are equal as a whole were marked before, and
those of very common anchors come window by window.

Defined results: a null text is empty; texts under 100 bytes lose nothing; rows
of null doc_id come after all others and are documents of their own; rows that
repeat a doc_id are one document: what stands at the same place in both stays in
both, and each loses only what it holds itself; an empty table gives an empty result; other
columns are not read. A removal may cut a UTF-8 character, so kept is binary.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .repeats import BYTES, HOT_NEED, KEY, MARK, NEED, Windows, covered, doc_id, find_segments, keyed, per_row
from .suffix_array import permuted_common_prefixes, suffix_array
from .text_hash import byte_codes, mix64, prefix_hash

ARRAY_BYTES = 1 << 20  # segments of whole anchors are sorted together up to about so many bytes
SENT = "deal long, group long, nul boolean, doc long, row long, start int, count int, body binary"
MARKS = "nul boolean, doc long, row long, start int, count int"


def segment_sender(by: Windows):
    """For mapInArrow over (nul, doc, row, text, need): the bytes of needed segments; those of hot anchors as single windows, one of each content."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("need")
            keys = list(zip(*(batch.column(k).to_pylist() for k in KEY), strict=True))
            out: list[tuple] = []  # group, nul, doc, row, start, count, body
            again: list[tuple] = []  # the same of what is marked here
            seen: dict[bytes, tuple] = {}
            for key, text, need in zip(keys, batch.column("text").to_pylist(), lists, strict=True):
                text, need = text or b"", need.values
                kinds, starts, counts, anchors = (need.field(k).to_pylist() for k in ("kind", "start", "count", "anchor"))
                prefix = prefix_hash(byte_codes(np.frombuffer(text, np.uint8))) if HOT_NEED in kinds else None
                for kind, s, c, a in zip(kinds, starts, counts, anchors, strict=True):
                    if kind == NEED:
                        out.append((a, *key, s, c, text[s : s + c - 1 + by.width]))
                        continue
                    at = np.arange(s, s + c)
                    for p, h in zip(at.tolist(), by.hashes(prefix, at, at + by.width).view(np.int64).tolist(), strict=True):
                        window = text[p : p + by.width]
                        first, place = seen.get(window), (key[0], key[1], key[2] if key[0] else 0, p)
                        if first is not None and place > first:
                            again.append((None, *key, p, 1, None))
                        else:
                            seen[window] = place
                            out.append((h, *key, p, 1, window))
            group, nul, doc, row, start, count, body = zip(*out, *again, strict=True) if out else ((),) * 7
            scattered = mix64(np.arange(len(again), dtype=np.uint64)).view(np.int64)
            yield pa.record_batch({
                "deal": pa.array(np.concatenate([np.array(group[: len(out)], np.int64), scattered])), "group": pa.array(group, pa.int64()), "nul": pa.array(nul, pa.bool_()),
                "doc": pa.array(doc, pa.int64()), "row": pa.array(row, pa.int64()), "start": pa.array(start, pa.int32()), "count": pa.array(count, pa.int32()), "body": pa.array(body, pa.binary()),
            })

    return send


def repeated_runs(bodies: list[bytes], counts: np.ndarray, by: Windows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, first window, windows) of the runs of windows whose hash another window of these segments has. No other window is equal to any."""
    lengths = np.array([len(b) for b in bodies])
    first = np.cumsum(lengths) - lengths
    window = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    at = np.repeat(first, counts) + window
    hashes = by.hashes(prefix_hash(byte_codes(np.frombuffer(b"".join(bodies), np.uint8))), at, at + by.width)
    order = np.argsort(hashes)
    equal = hashes[order[1:]] == hashes[order[:-1]]
    twice = np.zeros(len(at), bool)
    twice[order[1:][equal]] = twice[order[:-1][equal]] = True
    begins = twice & ((window == 0) | ~np.concatenate([[False], twice[:-1]]))
    run = np.cumsum(begins)[twice] - 1
    begins = np.flatnonzero(begins)
    return np.repeat(np.arange(len(bodies)), counts)[begins], window[begins], np.bincount(run, minlength=len(begins))


def window_classes(bodies: list[bytes], counts: np.ndarray, width: int) -> np.ndarray:
    """The number of its class of equal windows for every window of these segments, one segment after the other. Of equal segments the array holds one."""
    number: dict[bytes, int] = {}
    same = np.array([number.setdefault(b, len(number)) for b in bodies])
    sizes = np.zeros(len(number), np.int64)
    sizes[same] = counts
    text_classes = _sorted_classes(list(number), sizes, width)
    begin = np.cumsum(sizes) - sizes
    return text_classes[np.repeat(begin[same] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())]


def _sorted_classes(bodies: list[bytes], counts: np.ndarray, width: int) -> np.ndarray:
    """Window classes from the suffix array of the segments."""
    lengths = np.array([len(b) + 1 for b in bodies])
    first = np.cumsum(lengths) - lengths
    raw = np.frombuffer(b"\0".join(bodies) + b"\0", np.uint8)
    letters = raw.astype(np.int64) + 2
    letters[first + lengths - 1] = 1  # parts segments
    text = np.append(letters, 0)
    order = suffix_array(text)
    at = np.repeat(first - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    valid = np.zeros(len(text), bool)
    valid[at] = True
    order = order[valid[order]]
    # Windows hold no parting letter, so bytes decide.
    common = permuted_common_prefixes(np.append(raw, 0), order, width)
    joined = np.zeros(len(order), bool)
    joined[1:] = common[order[1:]] >= width
    classes = np.zeros(len(text), np.int64)
    classes[order] = np.cumsum(~joined)
    return classes[at]


def _marks(nul: np.ndarray, doc: np.ndarray, row: np.ndarray, start: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch({
        "nul": pa.array(nul.astype(bool)), "doc": pa.array(doc), "row": pa.array(row), "start": pa.array(start.astype(np.int32)), "count": pa.array(np.ones(len(row), np.int32)),
    })


def _array_marks(by: Windows):
    """For mapInArrow over SENT rows in order of their groups; rows without a body are marks already."""

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None
        for batch in batches:
            marked_there = batch.filter(batch.column("body").is_null())
            if marked_there.num_rows:
                yield _marks(*(marked_there.column(k).to_numpy(zero_copy_only=False) for k in (*KEY, "start")))
            left = batch.filter(batch.column("body").is_valid())
            for row in zip(*(left.column(k).to_pylist() for k in ("group", *KEY, "start", "count", "body")), strict=True):
                if size >= ARRAY_BYTES and row[0] != last:
                    yield _mark(held, by)
                    held, size = [], 0
                held.append(row)
                size += len(row[6])
                last = row[0]
        if held:
            yield _mark(held, by)

    return marks


def _mark(rows: list[tuple], by: Windows) -> pa.RecordBatch:
    """Marks for the windows of some groups of segments; groups never match each other, as their anchors differ."""
    nul, doc, row, start, count = (np.array([r[i] for r in rows], np.int64) for i in range(1, 6))
    of, begin, count = repeated_runs([r[6] for r in rows], count, by)
    number = window_classes([rows[i][6][b : b + n - 1 + by.width] for i, b, n in zip(of.tolist(), begin.tolist(), count.tolist(), strict=True)], count, by.width) if len(of) else of
    window = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - begin, count)
    of = np.repeat(of, count)
    nul, doc, row, start = nul[of], doc[of], row[of], start[of] + window
    places = np.stack([nul, doc, np.where(nul, row, 0), start])  # as in repeats.combined
    order = np.lexsort((*places[::-1], number))
    places, number = places[:, order], number[order]
    new = np.ones(len(order), bool)
    new[1:] = number[1:] != number[:-1]
    lead = np.flatnonzero(new)[np.cumsum(new) - 1]
    later = order[(places != places[:, lead]).any(axis=0)]
    return _marks(nul[later], doc[later], row[later], start[later])


def _removed(batches: Iterator[pa.RecordBatch], width: int, digest: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        size, gone, spans, kept = [], [], [], []
        for text, marks in zip(batch.column("text").to_pylist(), batch.column("marks"), strict=True):
            text = text or b""
            n = runs = 0
            if marks.is_valid:
                m = marks.values
                drop = covered(len(text), m.field("start").to_numpy().astype(np.int64), m.field("count").to_numpy(), width)
                n, runs = int(drop.sum()), int(np.count_nonzero(np.diff(drop.astype(np.int8), prepend=0) == 1))
                left = np.frombuffer(text, np.uint8)[~drop].tobytes()
            else:
                left = text
            size.append(len(text))
            gone.append(n)
            spans.append(runs)
            kept.append(hashlib.sha256(left).hexdigest() if digest else left)
        yield pa.record_batch({
            "doc_id": batch.column("doc_id"), "n_bytes": pa.array(size, pa.int64()), "n_removed": pa.array(gone, pa.int64()), "n_spans": pa.array(spans, pa.int64()),
            ("kept_sha256" if digest else "kept"): pa.array(kept, pa.string() if digest else pa.binary()),
        })


def marked(docs: DataFrame, by: Windows = BYTES) -> DataFrame:
    """(doc_id, nul, doc, row, text) -> (doc_id, text, marks): marks is null where nothing repeats."""
    found = find_segments(docs, by)
    need = per_row(found.filter(F.col("kind").isin(NEED, HOT_NEED)), "need", "kind", "start", "count", "anchor")
    sent = docs.join(need, KEY).select(*KEY, "text", "need").mapInArrow(segment_sender(by), SENT)
    singles = sent.repartition("deal").sortWithinPartitions("group").mapInArrow(_array_marks(by), MARKS)
    marks = per_row(found.filter(F.col("kind") == MARK).select(*KEY, "start", "count").unionAll(singles), "marks", "start", "count")
    return docs.join(marks, KEY, "left").select(doc_id(), "text", "marks")


def remove_repeats(docs: DataFrame, by: Windows = BYTES, digest: bool = False) -> DataFrame:
    """(doc_id, text) -> doc_id, n_bytes, n_removed, n_spans and kept (binary) or kept_sha256."""
    last = "kept_sha256 string" if digest else "kept binary"
    return marked(keyed(docs), by).mapInArrow(lambda it: _removed(it, by.width, digest), f"doc_id long, n_bytes long, n_removed long, n_spans long, {last}")


def op10_query(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), digest=True)
