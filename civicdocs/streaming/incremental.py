"""The harvest and the changes as streams: new export files arrive, what is archived is skipped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from civicdocs.operators import versions
from civicdocs.operators.manifest import first_in_listing, listed_manifest, pending
from civicdocs.sources.listing import export_files, listed_chapters
from civicdocs.sources.storage import passing


def incremental_harvest(spark: SparkSession, source: str, books: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append new manifest entries of arriving chapter and volume files to ``target``.

    Both kinds of file come through one stream; a commission is taken from the
    file's name, else from inside. Commissions with volumes are harvested from
    their volume files, all others from their chapter files. Of several entries that want a
    path, what is there already stays; in a batch the first of the listing goes.
    A batch that is run again after a failure adds nothing twice.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        chapters = listed_chapters(batch)
        entries = first_in_listing(listed_manifest(books, chapters))
        try:
            entries = pending(entries, batch.sparkSession.read.parquet(target))
        except Exception as e:  # the first batch finds no table
            if "PATH_NOT_FOUND" not in str(e):
                raise
        with passing(entries, "harvested", "zstd") as held:
            held.write.mode("append").parquet(target)

    return export_files(spark, source, stream=True).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_changes(changes: DataFrame, path: str, checkpoint: str, id_: str = "id") -> StreamingQuery:
    """Merge batches of (id, seq, op, payload) into the versioned table at ``path``; late changes and repeated batches do no harm."""

    def write(batch: DataFrame, epoch: int) -> None:
        versions.merge(batch, path, id_)

    return changes.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
