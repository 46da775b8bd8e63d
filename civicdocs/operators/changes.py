"""Serial numbers for appended rows, validation, and batches of changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicdocs.functions.text import has_any_authority, required_violations, truthy


def max_serials(rows: DataFrame, parent: str) -> DataFrame:
    """Highest serial under each parent, and the one that comes next."""
    return rows.groupBy(parent).agg(F.max("serial").alias("max_serial")).withColumn("next_serial", F.coalesce("max_serial", F.lit(0)) + 1)


def next_serials(new: DataFrame, existing: DataFrame, parent: str, *arrival: str) -> DataFrame:
    """New rows numbered on from the highest serial of their parent, in order of arrival."""
    rn = F.row_number().over(Window.partitionBy(parent).orderBy(*arrival))
    top = existing.groupBy(parent).agg(F.max("serial").alias("__top"))
    return new.withColumn("__rn", rn).join(top, parent, "left").withColumn("serial", (F.coalesce("__top", F.lit(0)) + F.col("__rn")).cast("long")).drop("__rn", "__top")


def latest_by_id(rows: DataFrame, id_: str, *seq: str) -> DataFrame:
    """The last state of each id. Aggregates before the shuffle, unlike a window."""
    return rows.groupBy(id_).agg(F.max_by(F.struct(*rows.columns), F.struct(*seq)).alias("r")).select("r.*")


def apply_changes(base: DataFrame, changes: DataFrame, id_: str = "id") -> DataFrame:
    """(id, seq, op, payload) over a table: the last change of an id wins; deletes remove, saves and updates replace or add.

    The same batch twice gives the same table. ``payload`` is a struct of the
    base's columns but the id. A change without an op is a save.
    """
    last = latest_by_id(changes, id_, "seq")
    kept = base.join(last.select(id_), id_, "left_anti")
    return kept.unionByName(last.filter(F.coalesce("op", F.lit("save")) != "delete").select(id_, "payload.*").select(*base.columns))


def stamp_parent(rows: DataFrame, batches: DataFrame, batch: str, parent: str) -> DataFrame:
    """Every row of a batch gets the parent of the batch."""
    return rows.drop(parent).join(batches.select(batch, parent), batch)


def zip_attachments(batch: DataFrame) -> DataFrame:
    """(id, objects array<struct<..., hasImage>>, files array<string>) -> a row for each object with the file at its position, if it wants an image."""
    rows = batch.select("id", "files", F.posexplode("objects").alias("pos", "o"))
    return rows.select("id", "pos", "o.*", F.when(truthy("o.hasImage"), F.get("files", F.col("pos"))).alias("fileName"))


def remove_at(batch: DataFrame, array: str, position: Column) -> DataFrame:
    """The array without the element at a position from 0; a position outside, or none, changes nothing."""
    return batch.withColumn(array, F.filter(F.col(array), lambda x, i: ~i.eqNullSafe(position)))


def validate(rows: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with the names of broken rules)."""
    checked = rows.withColumn("violations", required_violations(rules))
    return checked.filter(F.size("violations") == 0).drop("violations"), checked.filter(F.size("violations") > 0)


def authorized(rows: DataFrame, needed: str, authenticated: Column, held: Column) -> DataFrame:
    """Rows for which the identity holds one of the needed authorities."""
    return rows.filter(has_any_authority(authenticated, held, F.col(needed)))
