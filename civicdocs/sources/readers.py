"""Readers of the collection's JSON exports, label bundles and attachments.

Files that are missing or can't be parsed don't stop a read: with
``corrupt=True`` their text comes along in ``_corrupt`` for ``split_bad``.
A file may be compressed by gzip; then its name ends in ``.json.gz``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from .schemas import BOOK, CHAPTER, PAGE, VOLUME
from .storage import stored

OWNER = r"-(\d+)\.json(\.gz)?$"
EXPORTS = "*.json{,.gz}"


def _json(spark: SparkSession, paths: str | list[str], schema: StructType, corrupt: bool, glob: str | None = None) -> DataFrame:
    full = StructType(list(schema.fields)).add("_corrupt", StringType()) if corrupt else schema
    reader = spark.read.schema(full).option("multiLine", True).option("mode", "PERMISSIVE").option("ignoreMissingFiles", True).option("recursiveFileLookup", True)
    if corrupt:
        reader = reader.option("columnNameOfCorruptRecord", "_corrupt")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.json(paths)


def read_books(spark: SparkSession, path: str | list[str], corrupt: bool = False) -> DataFrame:
    """A top-level array of commissions, one row for each."""
    return _json(spark, path, BOOK, corrupt)


def _owned(df: DataFrame) -> DataFrame:
    """With book_id: from the file's name, else from the embedded commission, of which only the id is kept."""
    named = F.nullif(F.regexp_extract("_metadata.file_name", OWNER, 1), F.lit("")).cast("long")
    return df.withColumn("book_id", F.coalesce(named, F.col("book.id"))).drop("book")


def read_chapters(spark: SparkSession, path: str | list[str], corrupt: bool = False) -> DataFrame:
    """Chapter trees, a file for each commission: chapters-commission-<id>.json, or any other name with the commission inside."""
    return _owned(_json(spark, path, CHAPTER, corrupt, EXPORTS))


def read_volumes(spark: SparkSession, path: str | list[str], corrupt: bool = False) -> DataFrame:
    """Volume lists, a file for each commission, without their chapters."""
    return read_volume_trees(spark, path, corrupt).drop("chapters")


def read_volume_trees(spark: SparkSession, path: str | list[str], corrupt: bool = False) -> DataFrame:
    """Volumes with nested chapters. Both file names in use count, volumes-commission-<id> and volume-wise-commission-<id>; others in the folder are not read."""
    return _owned(_json(spark, path, VOLUME, corrupt, "{volumes,volume-wise}-commission-" + EXPORTS))


def read_notice_pages(spark: SparkSession, path: str | list[str], corrupt: bool = False) -> DataFrame:
    return _json(spark, path, PAGE, corrupt)


def read_notices(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The notices of all pages, with the number of their page."""
    return read_notice_pages(spark, path).select("number", F.inline("content"))


def split_bad(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, texts of the bad ones) of a read with corrupt=True."""
    return df.filter("_corrupt is null").drop("_corrupt"), df.filter("_corrupt is not null").select("_corrupt")


_REPEATED = "spark.sql.variant.allowDuplicateKeys"


def flatten_json(bundles: DataFrame) -> DataFrame:
    """(lang, text) -> (lang, path array, key, value): all leaves at any depth.

    Texts are parsed once, as variants, and opened a level at a time until only
    leaves are left; each level is written before the next. Of a repeated key the
    last counts; a key that holds a dot stays one element of ``path``; an array's
    elements count from 0. A text that isn't JSON, or is a bare value, has no leaves, nor has an empty object.
    """
    spark = bundles.sparkSession
    before = spark.conf.get(_REPEATED)
    spark.conf.set(_REPEATED, "true")  # holds while the texts are parsed, below
    try:
        level = stored(bundles.select("lang", F.array().cast("array<string>").alias("path"), F.try_parse_json("text").alias("v")).filter("v is not null"), "labels")
    finally:
        spark.conf.set(_REPEATED, before)
    nested, leaves = F.schema_of_variant("v").rlike("^(OBJECT|ARRAY)"), None
    while True:
        found = level.filter(~nested & (F.size("path") > 0)).select("lang", "path", F.array_join("path", ".").alias("key"), F.variant_get("v", "$", "string").alias("value"))
        leaves = found if leaves is None else leaves.unionAll(found)
        deeper = level.filter(nested)
        if deeper.isEmpty():
            return leaves
        opened = deeper.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()), how="inner")
        level = stored(opened.select("lang", F.array_append(deeper["path"], F.coalesce("key", F.col("pos").cast("string"))).alias("path"), F.col("value").alias("v")), "labels")


def read_labels(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Label bundles, one file for each language in a folder of its name."""
    texts = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    lang = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    return flatten_json(texts.select(F.url_decode(F.regexp_replace(lang, "^lang=", "")).alias("lang"), F.col("value").alias("text")))


def list_attachments(spark: SparkSession, path: str, glob: str = "*.pdf") -> DataFrame:
    """path, length and modificationTime of the files; their content isn't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return files.select("path", "length", "modificationTime", F.element_at(F.split("path", "/"), -1).alias("file_name"))
