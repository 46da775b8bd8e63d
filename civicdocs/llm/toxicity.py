"""Toxicity scores from an FTRL-proximal logistic regression over hashed n-grams.

Features are single words, word pairs and pairs that skip one or two words,
hashed to BITS bits and taken once per text. Shards of a bounded, hash-chosen
sample of the labelled documents are learnt in parallel, each by FTRL-proximal
with per-coordinate rates; their weights are averaged. The L1 penalty leaves few
of them, and those are what the scoring tasks receive.

Defined results: null and wordless texts get the score of the bias alone; a
document that is labelled twice counts twice; labels that are null are not
learnt; without any label every score is the bias of an empty model, 0.5, and
nothing is predicted toxic; repeated rows score alike; an empty table gives an
empty result; very long texts count whole; of the input only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text_hash import chunks, distinct, give_back, hash_words, mix64, parts

BITS = 22
MAX_SAMPLE = 48_000  # labelled documents that are learnt at most, chosen by hash
SHARD_DOCS = 10_000  # of which so many are learnt in one task
MIN_DOCS = 4  # a feature counts from so many documents of a shard
EPOCHS = 5
GRAM_CHUNK = 1 << 18  # bytes of text whose features are made at a time; these take many times as much
ALPHA, BETA, L1, L2 = 1.0, 1.0, 15.0, 0.01
POSITIVE_WEIGHT = 5.0  # of a toxic example's gradient; they are few
THRESHOLD = 0.7

#: Everything but letters, digits and bytes above ASCII parts words.
_BREAK = np.array([not (chr(b).isalnum() or b >= 128) if b < 128 else False for b in range(256)])


def grams(texts: list[bytes]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, number of texts, feature numbers, their texts) of chunk after chunk; features of a text may repeat."""
    for first, held in chunks((t.lower() for t in texts), GRAM_CHUNK):
        words, owner, _, _ = hash_words(held, _BREAK)
        found, owners = [words], [owner]
        for gap in (1, 2, 3):
            n = max(0, len(words) - gap)
            same = owner[len(words) - n :] == owner[:n]
            left, right = words[:n][same], words[len(words) - n :][same]
            found.append(mix64(left * np.uint64(3) + right * np.uint64(0x9E3779B97F4A7C15) + np.uint64(gap)))
            owners.append(owner[:n][same])
        index = (np.concatenate(found) >> np.uint64(64 - BITS)).astype(np.int64)
        index[index == 0] = 1
        yield first, len(held), index, np.concatenate(owners)


def features(texts: list[bytes]) -> Iterator[np.ndarray]:
    """Distinct feature numbers of each text; 0 is the bias."""
    for _, n, index, owner in grams(texts):
        key = distinct(owner.astype(np.int64) << BITS | index)
        ends = np.searchsorted(key, np.arange(n + 1, dtype=np.int64) << BITS)
        for a, b in zip(ends[:-1], ends[1:], strict=True):
            yield np.concatenate([[0], key[a:b] & ((1 << BITS) - 1)]).astype(np.int32)


def ftrl(examples: list[tuple[np.ndarray, int]], epochs: int = EPOCHS, min_docs: int = MIN_DOCS) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and weights that FTRL-proximal leaves after passing over the examples, which it renumbers in place."""
    docs = np.zeros(1 << BITS, np.int32)
    for f, _ in examples:
        docs[f] += 1
    used = np.flatnonzero(docs >= min_docs)
    for i, (f, y) in enumerate(examples):
        examples[i] = (np.searchsorted(used, f[docs[f] >= min_docs]).astype(np.int32), y)
    del docs
    z, n = np.zeros(len(used)), np.zeros(len(used))

    def weights(f):
        zf = z[f]
        return np.where(np.abs(zf) <= L1, 0.0, -(zf - np.sign(zf) * L1) / ((BETA + np.sqrt(n[f])) / ALPHA + L2))

    for _ in range(epochs):
        for f, y in examples:
            w = weights(f)
            g = (1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - y) * (POSITIVE_WEIGHT if y else 1.0)
            step = (np.sqrt(n[f] + g * g) - np.sqrt(n[f])) / ALPHA
            z[f] += g - step * w
            n[f] += g * g
    w = weights(np.arange(len(used)))
    return used[w != 0], w[w != 0]


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weights of every shard in this partition; shards come one after the other."""

    def learnt(examples):
        f, w = ftrl(examples)
        return pa.record_batch({"feature": pa.array(f, pa.int64()), "weight": pa.array(w, pa.float64())})

    held: list[tuple[np.ndarray, int]] = []
    last = batch = texts = None
    for batch in parts(batches):
        texts = [t or b"" for t in batch.column("text").to_pylist()]
        for shard, f, label in zip(batch.column("shard").to_pylist(), features(texts), batch.column("label").to_pylist(), strict=True):
            if shard != last and held:
                yield learnt(held)
                held = []
            last = shard
            held.append((f, label))
    del batch, texts  # their memory isn't needed while the last shard is learnt
    if held:
        yield learnt(held)
    del held
    give_back()


def train(docs: DataFrame, labels: DataFrame, max_sample: int = MAX_SAMPLE, shard_docs: int = SHARD_DOCS) -> tuple[np.ndarray, np.ndarray]:
    """(doc_id, text) and (doc_id, label 0/1) -> feature numbers and averaged weights, all that aren't zero: fewer than 2**BITS, about 50 MB at most."""
    sample = labels.filter(F.col("label").isNotNull()).orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(max_sample)
    shards = max(1, -(-sample.count() // shard_docs))
    shard = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(shards)).cast("int")
    chosen = docs.select("doc_id", F.col("text").cast("binary").alias("text")).join(F.broadcast(sample), "doc_id")
    dealt = chosen.select(shard.alias("shard"), F.xxhash64("doc_id", F.lit(11)).alias("order"), "text", F.col("label").cast("int").alias("label"))
    # so many partitions that shards rarely meet in one
    learnt = dealt.repartition(16 * shards, "shard").sortWithinPartitions("shard", "order", "label").mapInArrow(_learn, "feature long, weight double")
    mean = learnt.groupBy("feature").agg((F.sum("weight") / shards).alias("weight"))
    table = mean.toArrow()
    return table["feature"].to_numpy(), table["weight"].to_numpy()


def _scorer(docs: DataFrame, model: tuple[np.ndarray, np.ndarray]):
    weights = docs.sparkSession.sparkContext.broadcast(model)

    def scores(batches: Iterator[pa.RecordBatch], keep_under: float | None = None) -> Iterator[pa.RecordBatch]:
        dense = np.zeros(1 << BITS, np.float32)
        dense[weights.value[0]] = weights.value[1]
        for batch in parts(batches):
            sums = np.full(batch.num_rows, float(dense[0]))
            texts = [t.encode() if isinstance(t, str) else t or b"" for t in batch.column("text").to_pylist()]
            for first, n, index, owner in grams(texts):
                told = dense[index] != 0  # few weights aren't zero; only theirs are counted once a text
                key = distinct(owner[told].astype(np.int64) << BITS | index[told])
                sums[first : first + n] += np.bincount(key >> BITS, dense[key & ((1 << BITS) - 1)], n)
            scored = 1 / (1 + np.exp(-np.clip(sums, -35, 35)))
            if keep_under is None:
                yield pa.record_batch({"doc_id": batch.column("doc_id"), "score": pa.array(scored, pa.float64())})
            else:
                yield batch.filter(pa.array(scored < keep_under))

    return scores


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(doc_id, text) -> doc_id, score."""
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(_scorer(docs, model), "doc_id long, score double")


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, with all their columns, whose score is below the threshold."""
    known = labels.filter(~held_out(F.col("doc_id"))).select("doc_id", F.col("toxic").alias("label"))
    scores = _scorer(docs, train(docs, known))
    return docs.mapInArrow(lambda it: scores(it, threshold), docs.schema)


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, text) and (doc_id, toxic) -> doc_id, held_out, score, predicted; learns only from rows that aren't held out."""
    known = labels.filter(~held_out(F.col("doc_id"))).select("doc_id", F.col("toxic").alias("label"))
    scored = score(docs, train(docs, known))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op1_query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic"))
