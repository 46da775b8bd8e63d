"""Writers in the collection's layout."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


FILE_BYTES = 128 << 20
_ADVISED = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def write_manifest(manifest: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> None:
    """Parquet by commission and volume directory; an entry without a volume lies under ``-``.

    Entries are dealt by directory and dealt anew by size when it is known:
    small directories share a task, a large one is split into files of about ``file_bytes`` before compression.
    """
    spark = manifest.sparkSession
    before = spark.conf.get(_ADVISED)
    spark.conf.set(_ADVISED, str(file_bytes))
    try:
        dealt = manifest.withColumn("volume_dir", F.coalesce("volume_dir", F.lit("-"))).hint("rebalance", "commission_dir", "volume_dir")
        dealt.write.partitionBy("commission_dir", "volume_dir").mode("overwrite").parquet(path)
    finally:
        spark.conf.set(_ADVISED, before)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The written manifest; a filter on the directories reads only theirs."""
    return spark.read.parquet(path).withColumn("volume_dir", F.nullif("volume_dir", F.lit("-")))


def write_json_arrays(df: DataFrame, path: str, by: str) -> None:
    """One top-level JSON array for each value of ``by``, as the exports have them; a value's rows must fit one file."""
    rest = [c for c in df.columns if c != by]
    arrays = df.groupBy(by).agg(F.to_json(F.collect_list(F.struct(*rest))).alias("value"))
    arrays.write.partitionBy(by).text(path)


def name_files(spark: SparkSession, path: str, names: Mapping[str, str]) -> None:
    """Give the one file of each partition folder its name in the exports; other folders keep theirs. A step of the driver for each file, as an export has few."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for folder in files.listStatus(root):
        name = names.get(folder.getPath().getName())
        for part in files.listStatus(folder.getPath()) if name and folder.isDirectory() else ():
            if part.getPath().getName().startswith("part-"):
                files.rename(part.getPath(), spark._jvm.org.apache.hadoop.fs.Path(folder.getPath(), name))
