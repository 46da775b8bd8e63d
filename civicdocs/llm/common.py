"""Small helpers that the training-data operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicdocs.sources.storage import shared_dir as ensure_checkpoint_dir
from civicdocs.sources.storage import stored

__all__ = ["ascii_lower", "cut", "ensure_checkpoint_dir", "shuffle_partitions", "stored"]

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: Words of the whitespace contracts: runs of anything but space and \t\n\v\f\r.
SPACE_WORD = r"[^\x20\x09-\x0D]+"


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z and nothing else. Pure ASCII texts take the fast path of lower()."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def cut(df: DataFrame) -> DataFrame:
    """Materialise in the shared checkpoint folder, so that the lineage ends here and lost executors cost nothing."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
