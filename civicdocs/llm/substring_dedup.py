"""Remove repeated 20-word passages, behind a count-min prefilter.

In a first pass every partition counts the anchors of its windows in a sketch of
its own, and the sketches are merged block by block. An anchor is counted at
least as often as any of its windows, so a window whose estimate is below 2
stands nowhere else; in the second pass only the others leave their task. Those
are grouped exactly: first whole segments, then, where an anchor has several
different segments, their single windows by hash.

Defined results: null and wordless texts have no words; texts under 20 words
lose nothing; rows of null doc_id come after all others and are documents of their
own; rows that repeat a doc_id are one document: what stands at the same place
in both stays in both, and each loses only what it holds itself; an empty table gives an
empty result; a very long text is worked off in slices, but must fit a task with
its words; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .repeats import HOT_NEED, KEY, MARK, NEED, SEGMENT, SENT, WORDS, Windows, _columns, combined, covered, doc_id, find_segments, grouped, keyed, per_row, units
from .text_hash import chunks, prefix_hash


def window_sender(by: Windows):
    """For mapInArrow over (nul, doc, row, text, need): single windows of the needed segments, combined within the task's batch.

    A window goes by its hash, with the anchor beside it, as a segment of one window.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (docs, nul, rows), lists = _columns(batch), batch.column("need")
            ends, flat = lists.offsets.to_numpy() - lists.offsets[0].as_py(), lists.flatten()
            start, count, anchor = (flat.field(k).to_numpy() for k in ("start", "count", "anchor"))
            out = []
            for first, texts in chunks(t or b"" for t in batch.column("text").to_pylist()):
                codes, _, begins = units(texts, by)
                prefix = prefix_hash(codes)
                a, b = ends[first], ends[first + len(texts)]
                of = np.repeat(np.arange(len(texts)), np.diff(ends[first : first + len(texts) + 1]))
                n = count[a:b].astype(np.int64)
                pos = np.repeat(start[a:b] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                of = np.repeat(of, n)
                at = pos + begins[of]
                w = np.zeros(len(at), SEGMENT)
                w["anchor"] = by.hashes(prefix, at, at + by.width).view(np.int64)
                w["content"] = np.repeat(anchor[a:b], n)
                w["doc"], w["nul"], w["row"], w["start"], w["count"] = docs[first + of], nul[first + of], rows[first + of], pos, 1
                out.append(w)
            if out:
                yield from combined(np.concatenate(out))

    return send


def _removed(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words, gone, kept = [], [], []
        for text, marks in zip(batch.column("text").to_pylist(), batch.column("marks"), strict=True):
            ws = (text or b"").split()
            n = 0
            if marks.is_valid:
                m = marks.values
                drop = covered(len(ws), m.field("start").to_numpy().astype(np.int64), m.field("count").to_numpy(), width)
                n = int(drop.sum())
                ws_kept = compress(ws, ~drop)
            words.append(len(ws))
            gone.append(n)
            kept.append(b" ".join(ws_kept if n else ws))
        yield pa.record_batch({"doc_id": batch.column("doc_id"), "n_words": pa.array(words, pa.int64()), "n_removed": pa.array(gone, pa.int64()), "kept": pa.array(kept, pa.large_binary()).cast(pa.binary())})


def _digested(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in it:
        digests = [hashlib.sha256(k).hexdigest() for k in b.column("kept").to_pylist()]
        yield pa.record_batch({"doc_id": b.column("doc_id"), "n_words": b.column("n_words"), "n_removed": b.column("n_removed"), "kept_sha256": pa.array(digests)})


def marked(docs: DataFrame, by: Windows = WORDS) -> DataFrame:
    """(doc_id, nul, doc, row, text) -> (doc_id, text, marks): marks is null where nothing repeats."""
    found = find_segments(docs, by)
    need = per_row(found.filter(F.col("kind").isin(NEED, HOT_NEED)), "need", "start", "count", "anchor")
    closer = docs.join(need, KEY).select(*KEY, "text", "need").mapInArrow(window_sender(by), SENT)
    marks = found.unionAll(grouped(closer)).filter(F.col("kind") == MARK)
    return docs.join(per_row(marks, "marks", "start", "count"), KEY, "left").select(doc_id(), "text", "marks")


def remove_repeats(docs: DataFrame, by: Windows = WORDS, digest: bool = False) -> DataFrame:
    """(doc_id, text) -> doc_id, n_words, n_removed and kept (binary: the words left, parted by one space) or kept_sha256."""
    rows = marked(keyed(docs), by)
    if digest:
        return rows.mapInArrow(lambda it: _digested(_removed(it, by.width)), "doc_id long, n_words long, n_removed long, kept_sha256 string")
    return rows.mapInArrow(lambda it: _removed(it, by.width), "doc_id long, n_words long, n_removed long, kept binary")


def op9_query(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), digest=True)
