"""The shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder that the session names.

    Where it names none, a temporary folder serves a session on one machine, as
    in tests; on a cluster nobody else would see that folder, so it is an error.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not (sc.master.startswith("local[") or sc.master == "local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-ckpt-"))
    return sc.getCheckpointDir()


@contextmanager
def shuffles_freed(spark: SparkSession, **more: str) -> Iterator[None]:
    """In the block, the shuffle files of a write go when it ends, not when the driver happens to collect its garbage; ``more`` settings of spark.sql.execution."""
    settings = {_FREED: "true"} | {f"spark.sql.execution.{k}": v for k, v in more.items()}
    before = {k: spark.conf.get(k, "false") for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _written(df: DataFrame, path: str, compression: str | None, *more: DataFrame, **settings: str) -> DataFrame:
    with shuffles_freed(df.sparkSession, **settings):
        for part in (df, *more):
            part.write.mode("append").parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored(df: DataFrame, name: str = "stored", compression: str | None = None) -> DataFrame:
    """Write to the shared folder as Parquet and read back: used twice, computed once, and safe from lost executors."""
    return _written(df, f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}", compression)


@contextmanager
def passing(df: DataFrame, name: str = "passing", compression: str | None = None, *more: DataFrame, **settings: str) -> Iterator[DataFrame]:
    """Like ``stored`` for as long as the block lasts: then the files go. ``more`` tables of the same columns are written to it one after the other."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    try:
        yield _written(df, path, compression, *more, **settings)
    finally:
        root = spark._jvm.org.apache.hadoop.fs.Path(path)
        root.getFileSystem(spark._jsc.hadoopConfiguration()).delete(root, True)
