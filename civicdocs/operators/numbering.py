"""Global row numbers and pages without a single-task sort."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from civicdocs.sources.storage import stored

LOW = (1 << 33) - 1


def global_index(df: DataFrame, *order: Column, name: str = "rn", partitions: int | None = None) -> DataFrame:
    """Number rows from 1 in the given order, whose last key must be unique.

    Rows are range-partitioned and sorted in their partitions; the id that Spark
    gives them holds partition and position. The numbered parts are written once
    to the shared folder, so that both passes see the same partitions; the counts
    of partitions, a row for each, are summed up and joined back by broadcast.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id())
    kept = stored(placed, "numbered")
    part = F.shiftright("__at", 33).alias("__part")
    sizes = sorted((r["__part"], r["n"]) for r in kept.groupBy(part).agg(F.count("*").alias("n")).collect())  # one row for each partition
    offsets, total = [], 0
    for p, size in sizes:
        offsets.append((p, total))
        total += size
    if not offsets:
        return kept.withColumn(name, F.lit(None).cast("long")).drop("__at")
    # an Arrow table, as rows of Python would start Python workers on the executors
    table = df.sparkSession.createDataFrame(pa.table({"__part": pa.array([p for p, _ in offsets], pa.int64()), "__offset": pa.array([n for _, n in offsets], pa.int64())}))
    numbered = kept.withColumn("__part", part).join(F.broadcast(table), "__part")
    return numbered.withColumn(name, F.col("__offset") + F.col("__at").bitwiseAND(F.lit(LOW)) + 1).drop("__at", "__part", "__offset")


def with_page(df: DataFrame, size: int, rn: str = "rn") -> DataFrame:
    """The page, from 0, on which a numbered row stands."""
    return df.withColumn("page", F.floor((F.col(rn) - 1) / size).cast("long"))


def page_envelopes(rows: DataFrame, size: int) -> DataFrame:
    """One row for each page with the counts and marks of its envelope: all of it follows from the number of rows."""
    total = rows.count()
    pages = -(-total // size)
    page = F.col("id").alias("page")
    return rows.sparkSession.range(pages).select(
        page, F.least(F.lit(size).cast("long"), F.lit(total) - F.col("id") * size).cast("long").alias("number_of_elements"), F.lit(total).cast("long").alias("total_elements"),
        F.lit(pages).cast("long").alias("total_pages"), (F.col("id") * size).alias("offset"), (F.col("id") == 0).alias("first"), (F.col("id") == pages - 1).alias("last"),
        (F.col("id") > 0).alias("has_prev"), (F.col("id") < pages - 1).alias("has_next"),
    )


def write_pages(df: DataFrame, path: str, size: int, *order: tuple[str, bool], pages_per_block: int = 1000) -> None:
    """Store a table for reading any of its pages: ``order`` are (column, ascending) pairs, of which the last column is unique and none is null.

    The rows, numbered, lie in folders of so many whole pages each, in order. An
    index has the first key of each page and the folder it is in.
    """
    keys = [F.col(c).asc() if up else F.col(c).desc() for c, up in order]
    block = F.floor((F.col("rn") - 1) / (size * pages_per_block)).cast("int")
    numbered = with_page(global_index(df, *keys), size).withColumn("block", block)
    numbered.limit(0).write.parquet(f"{path}/schema")
    numbered.write.partitionBy("block").parquet(f"{path}/rows")
    firsts = numbered.filter((F.col("rn") - 1) % size == 0).select("page", "block", *[c for c, _ in order])
    firsts.repartitionByRange("page").sortWithinPartitions("page").write.parquet(f"{path}/index")


def seek_page(spark: SparkSession, path: str, page: int, *order: tuple[str, bool]) -> DataFrame:
    """A page, from 1, of a table stored by ``write_pages``; no rows beyond the last.

    Two rows of the index tell the page's first key and the next one's. The
    folder and the range of the first key column reach the scan, so that only
    files that overlap the page are read; nothing is sorted or skipped.
    """
    index = spark.read.parquet(f"{path}/index")
    ends = index.filter(F.col("page").isin(page - 1, page)).orderBy("page").collect()  # two rows at most
    rows = spark.read.schema(spark.read.parquet(f"{path}/schema").schema).parquet(f"{path}/rows")
    if not ends or ends[0]["page"] != page - 1:
        return rows.filter("false").drop("block")
    kinds = {f.name: f.dataType for f in index.schema}

    def at_or_after(row: Row) -> Column:
        """Whether a row stands at or after the key in the order."""
        out = F.lit(True)
        for c, up in reversed(order):
            key = F.lit(row[c]).cast(kinds[c])
            out = (F.col(c) > key if up else F.col(c) < key) | ((F.col(c) == key) & out)
        return out

    first, up = order[0]
    edge = lambda row: F.lit(row[first]).cast(kinds[first])
    held = rows.filter((F.col("block") == ends[0]["block"]) & (F.col(first) >= edge(ends[0]) if up else F.col(first) <= edge(ends[0])) & at_or_after(ends[0]))
    if len(ends) == 2:
        held = held.filter((F.col(first) <= edge(ends[1]) if up else F.col(first) >= edge(ends[1])) & ~at_or_after(ends[1]))
    return held.drop("block")


def page_slice(df: DataFrame, page: int, size: int, *order: Column) -> DataFrame:
    """One page, from 1, of a table that isn't stored: a top-k of all rows up to it. For deep pages see ``write_pages``."""
    ordered = df.orderBy(*order)
    return ordered.limit(size) if page == 1 else ordered.offset((page - 1) * size).limit(size)
