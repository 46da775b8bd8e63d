"""What the tasks of the pipeline's stages take and keep in a Python worker, which waits beside the executor's heap for its next task."""

import multiprocessing
import re
import sys
import tracemalloc
from pathlib import Path
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from civicdocs.llm import simhash, toxicity
from civicdocs.operators.numbering import global_index


def batch_of(n, words, seed=5, below=1 << 40, **more):
    rng = np.random.default_rng(seed)
    texts = [b" ".join(b"w%d" % x for x in row) for row in rng.integers(0, below, (n, words)).tolist()]
    return pa.record_batch({"doc_id": pa.array(range(n), pa.int64()), "text": pa.array(texts, pa.binary())} | {k: pa.array(v, pa.int32()) for k, v in more.items()})


def scorer():
    model = np.arange(0, 1 << toxicity.BITS, 97), np.full(len(range(0, 1 << toxicity.BITS, 97)), 0.01)
    docs = SimpleNamespace(sparkSession=SimpleNamespace(sparkContext=SimpleNamespace(broadcast=lambda m: SimpleNamespace(value=m))))
    return toxicity._scorer(docs, model)


def peak_mb(task, batch):
    """The most that Python and numpy held at a time while the task went over the batch, and its rows."""
    tracemalloc.start()
    out = pa.Table.from_batches(task(iter([batch])))
    most = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    return most, out


@pytest.mark.parametrize(("name", "limit"), [("score", 55), ("fingerprint", 5)])
def test_a_batch_is_taken_apart_by_parts(name, limit):
    task = {"score": scorer(), "fingerprint": simhash._fingerprints}[name]
    batch = batch_of(*{"score": (9000, 200), "fingerprint": (4000, 200)}[name])
    most, out = peak_mb(task, batch)
    assert most < limit
    each = pa.Table.from_batches([b for i in range(0, 1500, 7) for b in task(iter([batch.slice(i, 7)]))])  # parts end elsewhere
    assert each.equals(out.slice(0, each.num_rows)) and each.num_rows == 1505 and out["doc_id"].to_pylist() == list(range(batch.num_rows))


def kept_mb():
    """What a process holds more than before when it has learnt two shards, one after the other."""

    def mb():
        return sum(map(int, re.findall(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text()))) / 1024

    batches = [batch_of(4000, 300, below=3000, shard=[i] * 4000, label=[0, 1] * 2000) for i in range(2)]
    before = mb()
    for learnt in toxicity._learn(iter(batches)):
        assert learnt.num_rows > 1000
    return mb() - before


@pytest.mark.skipif(not sys.platform.startswith("linux"), reason="reads /proc")
def test_learning_keeps_no_memory():
    with multiprocessing.get_context("spawn").Pool(1) as fresh:  # a process as fresh as a worker
        assert fresh.apply(kept_mb) < 15


def test_numbering_starts_no_python_worker(spark):
    numbered = global_index(spark.range(100).withColumnRenamed("id", "k"), F.desc("k"), partitions=3)
    assert "ExistingRDD" not in numbered._jdf.queryExecution().executedPlan().toString()
    assert [(r.k, r.rn) for r in numbered.orderBy("rn").collect()] == [(99 - i, i + 1) for i in range(100)]
