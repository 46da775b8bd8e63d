"""Near-duplicate groups of SimHash fingerprints by segment popcounts.

A fingerprint is mapped to the bit counts of short segments, two bits each, 16
to a half. Every differing bit changes one count by one or, where two of them
meet in a segment, none or two, so that the Manhattan distance of two such
vectors is never above the number of differing bits. Of two fingerprints with at
most 3 differing bits one half has at most one, and there the vectors are at most
1 apart. Each half is therefore range-joined on the unit grid of its counts: a
fingerprint is at home in the cell of its own vector and, if the counts' total is
odd, visits the cells at distance 1, 24 on average. Vectors at distance 1 meet
where the even one is at home. A cell is no half: the two orders of a segment's
single bit fall together, so that half of 16 segments give a cell 2^8 halves.
Inside a cell pairs whose whole vectors are further apart than the radius, by
Manhattan distance, are passed over; the others are compared exactly, and only a
spanning forest of the links leaves the task. Cells are streamed in order; one
with more than CELL_BLOCK members is put aside and compared in pairs of blocks.
Components of the links are the groups.

Defined results: null, empty and wordless texts have fingerprint zero and link
like any other; a text of one or two words is one shingle; equal fingerprints
always share a component; very long texts count whole; a repeated doc_id keeps its rows, and they share the
component where their fingerprints do; a null doc_id never names a component
unless nothing else is in it; an empty table gives an empty result; other
columns are carried by ``keep_one`` and never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, stored
from .components import connected_components
from .text_hash import mix64, parts

SHINGLE = 3
SEED = 42
RADIUS = 3
CELL_BLOCK = 1 << 14  # a cell with more fingerprints is compared in pairs of blocks of about this size


def fingerprint(text: bytes) -> int:
    """A bit is set if it is in more than half of the hashes of the shingles."""
    words = text.lower().split()  # for bytes: A-Z, and space with \\t\\n\\v\\f\\r
    if not words:
        return 0
    if len(words) < SHINGLE:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    hashes = np.fromiter((digest(join(t), SEED) for t in zip(words, words[1:], words[2:], strict=False)), np.uint64, len(words) - 2)
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 4096):
        bits = np.unpackbits(hashes[i : i + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in parts(batches):
        prints = np.array([fingerprint(t or b"") for t in batch.column("text").to_pylist()], np.uint64)
        yield pa.record_batch({"doc_id": batch.column("doc_id"), "fp": pa.array(prints.view(np.int64))})


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> (doc_id, fp): 64 bits in a signed long."""
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(_fingerprints, "doc_id long, fp long")


def segment_counts(half: np.ndarray) -> np.ndarray:
    """32-bit halves -> the counts of their 16 two-bit segments, packed in two bits each."""
    pairs = np.uint64(0x55555555)
    return (half & pairs) + ((half >> np.uint64(1)) & pairs)


def neighbours(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of counts -> (number of the vector, a vector of counts at Manhattan distance 1) for all of these."""
    at = np.arange(0, 32, 2, dtype=np.uint64)
    count = (counts[:, None] >> at) & np.uint64(3)
    step = np.uint64(1) << at
    more, less = np.nonzero(count < 2), np.nonzero(count > 0)
    return np.concatenate([more[0], less[0]]), np.concatenate([counts[more[0]] + step[more[1]], counts[less[0]] - step[less[1]]])


def cells(half: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """32-bit halves -> (number in half, cell, whether at home) for every cell of the grid in which they stand."""
    counts = segment_counts(half)
    own, odd = np.arange(len(half)), np.flatnonzero(np.bitwise_count(half) % 2 == 1)
    who, reached = neighbours(counts[odd])
    return np.concatenate([own, odd[who]]), np.concatenate([counts, reached]), np.arange(len(own) + len(who)) < len(own)


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            ids = batch.column("id").to_numpy()[at : at + 4096]
            prints = batch.column("fp").to_numpy()[at : at + 4096]
            for side in (0, 1):
                who, where, home = cells((prints.view(np.uint64) >> np.uint64(32 * side)) & np.uint64(0xFFFFFFFF))
                cell = mix64(where << np.uint64(1) | np.uint64(side)).view(np.int64)
                yield pa.record_batch({"cell": pa.array(cell), "home": pa.array(home), "id": pa.array(ids[who]), "fp": pa.array(prints[who])})


def _forest(ids: np.ndarray, prints: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links among the given fingerprints."""
    root = np.arange(len(ids))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    edges = []
    counts = unary_counts(prints)
    for i in range(len(ids) - 1):
        may = np.flatnonzero(np.bitwise_count(counts[i + 1 :] ^ counts[i]) <= RADIUS) + i + 1  # a Manhattan distance, never above the number of differing bits
        near = may[np.bitwise_count(prints[may] ^ prints[i]) <= RADIUS]
        for j in near.tolist():
            a, b = find(i), find(j)
            if a != b:
                root[b] = a
                edges.append((i, j))
    return [(int(ids[i]), int(ids[j])) for i, j in edges]


def unary_counts(prints: np.ndarray) -> np.ndarray:
    """The counts of all 32 two-bit segments, each as so many set bits: the bits in which two of these differ are the Manhattan distance of the vectors."""
    pairs, one = np.uint64(0x5555555555555555), np.uint64(1)
    low, high = prints & pairs, (prints >> one) & pairs
    return (low | high) | (low & high) << one


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("members")
        ends, flat = lists.offsets.to_numpy(), lists.values
        ids, prints = flat.field("id").to_numpy(), flat.field("fp").to_numpy().view(np.uint64)
        edges = [e for a, b in zip(ends[:-1], ends[1:], strict=True) for e in _forest(ids[a:b], prints[a:b])]
        yield pa.record_batch({"src": pa.array([e[0] for e in edges], pa.int64()), "dst": pa.array([e[1] for e in edges], pa.int64())})


def _in_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links inside the cells, which come one after the other. Members of cells beyond CELL_BLOCK are passed on as they are."""
    held, crowd = None, None

    def crowded(cell, home, ids, prints):
        nothing = pa.nulls(len(ids), pa.int64())
        return pa.record_batch({"src": nothing, "dst": nothing, "cell": pa.array(cell), "home": pa.array(home), "id": pa.array(ids), "fp": pa.array(prints)})

    def linked(edges):
        n = len(edges)
        return pa.record_batch({
            "src": pa.array([e[0] for e in edges], pa.int64()), "dst": pa.array([e[1] for e in edges], pa.int64()), "cell": pa.nulls(n, pa.int64()),
            "home": pa.nulls(n, pa.bool_()), "id": pa.nulls(n, pa.int64()), "fp": pa.nulls(n, pa.int64()),
        })

    def worked_off(rows, whole):
        """What follows from the rows of the cells in ``rows``; the last of them goes on unless ``whole``: (batches, rows held)."""
        nonlocal crowd
        cell, home, ids, prints = rows
        starts = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])) if len(cell) else np.zeros(0, np.int64)
        ends = np.append(starts[1:], len(cell))
        if len(starts) == 0:
            return [], rows
        met = (ends - starts > 1) & np.logical_or.reduceat(home, starts)
        last = len(starts) - (0 if whole else 1)
        large = (ends - starts > CELL_BLOCK) | (cell[starts] == crowd if crowd is not None else np.zeros(len(starts), bool))
        out, edges = [], []
        for i in np.flatnonzero(large).tolist():
            out.append(crowded(*(x[starts[i] : ends[i]] for x in rows)))
        for i in np.flatnonzero(met & ~large)[: np.searchsorted(np.flatnonzero(met & ~large), last)].tolist():
            edges += _forest(ids[starts[i] : ends[i]], prints[starts[i] : ends[i]].view(np.uint64))
        if edges:
            out.append(linked(edges))
        crowd = cell[-1] if large[-1] else None
        keep = slice(starts[-1], None) if last < len(starts) and not large[-1] else slice(len(cell), None)
        return out, [x[keep] for x in rows]

    for batch in batches:
        rows = [batch.column(k).to_numpy(zero_copy_only=False) for k in ("cell", "home", "id", "fp")]
        if held is not None:
            rows = [np.concatenate(x) for x in zip(held, rows, strict=True)]
        out, held = worked_off(rows, False)
        yield from out
    if held is not None and len(held[0]):
        yield from worked_off(held, True)[0]


def links(points: DataFrame) -> DataFrame:
    """Distinct fingerprints (id, fp) -> (src, dst): links that join all of each group."""
    placed = points.mapInArrow(_cells, "cell long, home boolean, id long, fp long")
    dealt = placed.repartition("cell").sortWithinPartitions("cell")
    seen = stored(dealt.mapInArrow(_in_cells, "src long, dst long, cell long, home boolean, id long, fp long"))
    members = seen.filter("cell is not null").select("cell", "home", "id", "fp")
    sizes = members.groupBy("cell").agg(F.count("*").alias("n"), F.max("home").alias("met")).filter("met").drop("met")
    crowded = members.drop("home").join(sizes, "cell").withColumn("blocks", F.ceil(F.col("n") / CELL_BLOCK).cast("int"))
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    # A member meets every block once: pair (low, high) of block numbers, its own being one of them.
    pair = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least(o, block).alias("low"), F.greatest(o, block).alias("high")))
    met = crowded.select("cell", "id", "fp", F.explode(pair).alias("p"))
    groups = met.groupBy("cell", "p").agg(F.collect_list(F.struct("id", "fp")).alias("members"))
    return seen.filter("src is not null").select("src", "dst").unionAll(groups.select("members").mapInArrow(_links, "src long, dst long"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> doc_id, fp, component_id: the smallest doc_id of all that can be reached over links."""
    prints = cut(fingerprints(docs))
    points = prints.groupBy("fp").agg(F.min("doc_id").alias("id")).filter("id is not null")
    of_id = connected_components(links(points))
    named = points.join(of_id, points["id"] == of_id["node"], "left").select(F.col("fp").alias("of_fp"), F.coalesce("component", "id").alias("component_id"))
    return prints.join(named, prints["fp"] == named["of_fp"], "left").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents without all but the first row of each group's smallest doc_id; rows of null doc_id stay.

    Who goes is decided on ids and written; the texts are shuffled only where the
    table of those ids is too large to be sent. Repeated ids alone need a window.
    """
    ids = near_duplicates(docs).filter("doc_id is not null").groupBy("doc_id")
    told = stored(ids.agg(F.max(F.col("doc_id") == F.col("component_id")).alias("own"), F.count("*").alias("n")).filter("not own or n > 1"))
    gone, several = (stored(told.filter(c).select("doc_id")) for c in ("not own", "own and n > 1"))
    kept = docs.join(gone, "doc_id", "left_anti").select(*[docs[f"`{c}`"] for c in docs.columns])
    once = kept.join(several, "doc_id", "left_anti").select(*[kept[f"`{c}`"] for c in docs.columns])
    repeated = kept.join(several, "doc_id", "left_semi").select(*[kept[f"`{c}`"] for c in docs.columns])
    first = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"))
    return once.unionByName(repeated.withColumn("__row", F.row_number().over(first)).filter("__row = 1").drop("__row"))


def op4_query(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
