"""Exact top-k inner products by no-random-access aggregation over sorted lists.

Candidates are dealt to groups once, and a group's to blocks. In a block every
component has its list of vectors, sorted by value when the group arrives. All
queries, in packed rows, pass each group. Lists are read in step from both ends,
positive components of a query from the upper one, negative from the lower: a
sixteenth first, then twice as much, up to half, then an eighth more each time. From
what was read so far follows a lower bound of every vector (what is not read
counts as the list's other end) and an upper bound (as the value at the reading
position). A vector whose upper bound is below the bar is out. The bar is the
k-th best exact score of a few rows of the block or the k-th best lower bound
or, once k scores are resolved, their least, which goes
along from block to block. A query stops reading when no more than a sixteenth
of the block, or k vectors, can still qualify; their scores are resolved exactly.
It doesn't begin where the heads of a block's lists together stay below its bar.
The k best of all groups are the answer.

Defined results: vectors that are null or hold null or non-finite components
take no part, neither as query nor as candidate; missing trailing components
count as zero; ties go to the smaller id; a repeated id is a separate candidate,
but never one of its own query; an empty table gives an empty result; further
columns are not read. Scores must fit 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCALE = 256
BLOCK = 1024  # candidates whose lists are read together
GROUP = 4  # blocks that a query passes with one bar
QUERY_BLOCK = 256
STEPS = 16  # the first part of a list that is read
SEEDS = 64  # rows of a block that give a first bar
CANDIDATES, QUERIES = 0, 1


def quantised(embedding: Column) -> Column:
    """floor(256 x) of every component; null when the vector takes no part."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.when(embedding.isNotNull() & ~bad, F.transform(embedding, lambda x: F.floor(x.cast("double") * SCALE).cast("long")))


def _matrix(rows) -> tuple[np.ndarray, np.ndarray]:
    ids = rows.field("id").to_numpy(zero_copy_only=False).astype(np.int64)
    lists = rows.field("v")
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(ids), int(lengths.max(initial=0))), np.int64)
    row = np.repeat(np.arange(len(ids)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return ids, out


Found = tuple[np.ndarray, np.ndarray]  # ids and exact scores, best first


class SortedLists:
    """One block of candidates: for each component the values in ascending order, and whose they are."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.values = ids[order], values[order]
        self.whose = np.argsort(self.values, axis=0, kind="stable").T
        self.lists = np.take_along_axis(self.values.T, self.whose, axis=1).astype(np.float64)
        self.read = 0  # entries that were read, of all lists together: each counts once, from whichever end

    def search(self, query_ids: np.ndarray, queries: np.ndarray, found: list[Found], k: int) -> list[Found]:
        """The k best of what was found and of this block, for each query.

        The order of a list is the same for all queries, so they share the
        reading: from the upper ends for positive components, from the lower ends
        for negative ones. Tables hold what was read; queries that have stopped
        leave the test. A block whose list heads can't reach a query's bar isn't read for it.
        """
        n, dims = self.values.shape
        width = min(dims, queries.shape[1])
        lists, whose, component = self.lists[:width], self.whose[:width], np.arange(width)[:, None]
        q = queries[:, :width].astype(np.float64).T
        weights = np.concatenate([np.maximum(q, 0), np.minimum(q, 0)])
        slack = 1e-12 * (np.abs(q).T @ np.maximum(np.abs(lists[:, 0]), np.abs(lists[:, -1])))  # of sums in doubles
        fresh = np.array([len(s) < k for _, s in found])
        bars = np.where(fresh, self._sampled(query_ids, queries[:, :width], k), [float(s[-1]) if len(s) else -np.inf for _, s in found])
        upper, lower = np.full((n, width), -np.inf), np.full((n, width), np.inf)
        few, step = max(k, n // STEPS), -(-n // STEPS)
        before, at, out = 0, min(n, step), list(found)
        open_ = np.flatnonzero(np.concatenate([lists[:, -1], lists[:, 0]]) @ weights >= bars - slack)
        while len(open_):
            self.read += width * (min(n, 2 * at) - min(n, 2 * before))
            top, bottom = slice(n - at, n - before), slice(before, at)
            upper[whose[:, top], component], lower[whose[:, bottom], component] = lists[:, top], lists[:, bottom]
            own = self.ids[:, None] == query_ids[open_]
            high = np.concatenate([np.maximum(upper, lists[:, n - at]), np.minimum(lower, lists[:, at - 1])], axis=1) @ weights[:, open_]
            if n > k and fresh[open_].any():
                new = open_[fresh[open_]]
                least = np.concatenate([np.where(np.isinf(upper), lists[:, 0], upper), np.where(np.isinf(lower), lists[:, -1], lower)], axis=1)
                low = np.where(self.ids[:, None] == query_ids[new], -np.inf, least @ weights[:, new])
                bars[new] = np.maximum(bars[new], np.partition(low, n - k, axis=0)[n - k] - slack[new])
            may = (high >= bars[open_] - slack[open_]) & ~own
            done = (may.sum(axis=0) <= few) | (at == n)
            for i in np.flatnonzero(done).tolist():
                who = open_[i]
                live = np.flatnonzero(may[:, i])
                ids = np.concatenate([found[who][0], self.ids[live]])
                scores = np.concatenate([found[who][1], self.values[live, :width] @ queries[who, :width]])
                first = np.lexsort((ids, -scores))[:k]
                out[who] = ids[first], scores[first]
            open_, before, at = open_[~done], at, min(n, 2 * at if 2 * at <= n // 2 else at + n // 8 + 1)
        return out

    def _sampled(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> np.ndarray:
        """A first bar for each query: the k-th best exact score of a few rows of the block."""
        some = np.unique(np.linspace(0, len(self.ids) - 1, SEEDS).astype(np.int64)) if len(self.ids) else np.zeros(0, np.int64)
        if len(some) <= k + 1:
            return np.full(len(query_ids), -np.inf)
        scores = (queries @ self.values[some, : queries.shape[1]].T).astype(np.float64)
        scores[query_ids[:, None] == self.ids[some]] = -np.inf
        return np.partition(scores, len(some) - k, axis=1)[:, len(some) - k]


def best_of_group(blocks: list[SortedLists], query_ids: np.ndarray, queries: np.ndarray, k: int) -> list[Found]:
    """The k best of several blocks for each query, the bars going along."""
    found: list[Found] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(query_ids)
    for b in blocks:
        found = b.search(query_ids, queries, found, k)
    return found


def by_length(ids: np.ndarray, values: np.ndarray, block: int) -> list[SortedLists]:
    """Blocks of a group's candidates, the longest vectors first: they set the bar that the heads of later blocks have to reach."""
    order = np.argsort(-(values.astype(np.float64) ** 2).sum(axis=1), kind="stable")
    return [SortedLists(ids[order[i : i + block]], values[order[i : i + block]]) for i in range(0, len(ids), block)]


def _joined(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    width = max(v.shape[1] for _, v in parts)
    return np.concatenate([i for i, _ in parts]), np.concatenate([np.pad(v, ((0, 0), (0, width - v.shape[1]))) for _, v in parts])


def _search(batches: Iterator[pa.RecordBatch], k: int, block: int) -> Iterator[pa.RecordBatch]:
    """Rows (g, kind, rows) sorted by g and kind: the candidates of a group, then its queries."""
    group, arrived, blocks = None, [], []
    for batch in batches:
        for i in range(batch.num_rows):
            g, kind = batch.column("g")[i].as_py(), batch.column("kind")[i].as_py()
            ids, values = _matrix(batch.column("rows")[i].values)
            if g != group:
                group, arrived, blocks = g, [], []
            if kind == CANDIDATES:
                arrived.append((ids, values))
                continue
            if arrived:
                blocks, arrived = by_length(*_joined(arrived), block), []
            found = best_of_group(blocks, ids, values, k)
            yield pa.record_batch({
                "query_id": pa.array(np.repeat(ids, [len(f[0]) for f in found])), "vec_id": pa.array(np.concatenate([f[0] for f in found])),
                "score": pa.array(np.concatenate([f[1] for f in found])),
            })


def _packed(vectors: DataFrame, size: int) -> DataFrame:
    """(id, v) -> (b, rows): packed rows of about ``size`` vectors."""
    blocks = max(1, -(-vectors.count() // size))
    dealt = vectors.select(F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("b"), F.struct("id", "v").alias("r"))
    return dealt.groupBy("b").agg(F.collect_list("r").alias("rows"))


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 5, block: int = BLOCK, query_block: int = QUERY_BLOCK, group: int = GROUP) -> DataFrame:
    """(id, v array<long>) twice -> query_id, rank, vec_id, score. Candidates move once, to their group; every group is sent all packed queries."""
    groups = max(1, -(-candidates.count() // (block * group)))
    c = _packed(candidates, block).select(F.pmod(F.col("b"), F.lit(groups)).cast("int").alias("g"), F.lit(CANDIDATES).alias("kind"), "rows")
    q = _packed(queries, query_block).select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"), F.lit(QUERIES).alias("kind"), "rows")
    met = c.unionByName(q).repartitionByRange(groups, "g").sortWithinPartitions("g", "kind")
    found = met.mapInArrow(lambda it: _search(it, k, block), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op3_query(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("id"), quantised(F.col("embedding")).alias("v"))
    rows = rows.filter(F.col("v").isNotNull() & F.col("id").isNotNull())
    return top_k(rows, rows.filter(F.col("id") % 50 == 0))


OP3_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
