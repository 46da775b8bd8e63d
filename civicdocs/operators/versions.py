"""A stored table that takes batches of changes in any order of arrival.

Rows hold the sequence number of the change that made them, and deleted ids stay
as tombstones, so that an older change that comes later changes nothing. Rows
lie in hash buckets of their id. A batch rewrites the buckets it touches, in a
folder of the new version; all others keep their files. A version is a small
table that names the folder of each bucket; it is written last, so that readers
see a batch whole or not at all, and earlier versions stay readable:

    path/schema             an empty table of the stored columns
    path/data/v=3/bucket=7  rows of a bucket as version 3 wrote them
    path/versions/v=3       the folder of every bucket as of version 3

Defined results: of several changes of an id the one of the greatest seq counts,
null below all; at the same seq a deletion wins, then the greater payload, so
that repeated and mixed batches give one state. A null id is an id like any
other. A change without an op is a save. An empty batch makes no version. There is one writer at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicdocs.sources.storage import stored

BUCKETS = 64


def _bucket(id_: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(id_), F.lit(buckets)).cast("int")


def _put(rows: DataFrame, path: str, version: int, held: dict[int, int], touched: list[int], buckets: int) -> int:
    """Write the rows (with bucket) of the touched buckets, then the version."""
    rows.write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/data/v={version}")
    named = sorted((held | dict.fromkeys(touched, version)).items())
    table = rows.sparkSession.createDataFrame([(b, v, buckets) for b, v in named], "bucket int, written int, buckets int")
    table.coalesce(1).write.parquet(f"{path}/versions/v={version}")
    return version


def create(base: DataFrame, path: str, id_: str = "id", seq: Column | None = None, buckets: int = BUCKETS) -> int:
    """Store a table of distinct ids as version 0. ``seq`` is the sequence number its rows have; its type is that of the changes to come."""
    rest = [c for c in base.columns if c != id_]
    seq = F.lit(None).cast("long") if seq is None else seq
    rows = base.select(id_, seq.alias("seq"), F.lit(False).alias("deleted"), F.struct(*rest).alias("payload"))
    rows.limit(0).write.parquet(f"{path}/schema")
    dealt = stored(rows.withColumn("bucket", _bucket(id_, buckets)).repartition("bucket"), "base")
    there = [r[0] for r in dealt.select("bucket").distinct().collect()]  # a row for each bucket
    return _put(dealt, path, 0, {}, there, buckets)


def _version(spark: SparkSession, path: str, version: int | None = None) -> tuple[int, dict[int, int], int]:
    """(number, folder of each bucket, number of buckets) of the last or the given version."""
    rows = spark.read.schema("bucket int, written int, buckets int, v int").parquet(f"{path}/versions")
    if version is None:
        version = rows.agg(F.max("v")).first()[0]
    named = rows.filter(F.col("v") == F.lit(version)).collect() if version is not None else []  # a row for each bucket
    return version or 0, {r["bucket"]: r["written"] for r in named}, named[0]["buckets"] if named else BUCKETS


def _rows(spark: SparkSession, path: str, held: dict[int, int], buckets: list[int]) -> DataFrame:
    schema = spark.read.parquet(f"{path}/schema").schema
    folders = [f"{path}/data/v={held[b]}/bucket={b}" for b in buckets if b in held]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read(spark: SparkSession, path: str, version: int | None = None, deleted: bool = False) -> DataFrame:
    """The table as of the last or a given version; with seq and deletions if ``deleted``."""
    _, held, _ = _version(spark, path, version)
    rows = _rows(spark, path, held, sorted(held))
    if deleted:
        return rows.select(rows.columns[0], "seq", "deleted", "payload.*")
    return rows.filter("not deleted").select(rows.columns[0], "payload.*")


def merge(changes: DataFrame, path: str, id_: str = "id") -> int:
    """Apply (id, seq, op, payload) as a new version, and return its number; ``payload`` is a struct of the other columns.

    Changes are combined by id before they move. Stored rows of the touched
    buckets and the changes meet once, dealt by bucket, and are written as they lie.
    """
    spark = changes.sparkSession
    version, held, buckets = _version(spark, path)
    schema = spark.read.parquet(f"{path}/schema").schema
    deleted = F.coalesce("op", F.lit("save")) == "delete"
    state = F.struct(F.col("seq").cast(schema["seq"].dataType).alias("seq"), deleted.alias("deleted"), F.col("payload").cast(schema["payload"].dataType).alias("payload"))
    last = changes.groupBy(id_).agg(F.max(state).alias("r")).select(id_, "r.*").withColumn("bucket", _bucket(id_, buckets))
    last = stored(last, "changes")
    touched = [r[0] for r in last.select("bucket").distinct().collect()]  # a row for each bucket at most
    if not touched:
        return version
    old = _rows(spark, path, held, touched).withColumn("bucket", _bucket(id_, buckets))
    both = old.unionByName(last).repartition("bucket")
    merged = both.groupBy("bucket", id_).agg(F.max(F.struct("seq", "deleted", "payload")).alias("r")).select(id_, "r.*", "bucket")
    return _put(merged, path, version + 1, held, touched, buckets)
