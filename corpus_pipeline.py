"""A cleaning pipeline for training text: five operators in a row.

Every stage takes what its predecessor kept, as (spark, docs, sf_dir), and
returns the columns of ``documents``; the last adds ``mix_copy``.

Defined results: an empty table stays empty through all stages. A null or empty
text is clean, has no benchmark words and no secrets, and is left out by the
mixture where it isn't always taken; as a near duplicate it links to the others without words. Rows of null doc_id
are never near duplicates of each other, and are judged each by its own text
elsewhere. Of rows that repeat a doc_id the first by hash of the text stays.
Without labels nothing is toxic, without benchmark items nothing is
contaminated. Very long texts go through whole. Other columns of ``docs`` are dropped.
"""

from __future__ import annotations

import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import civicdocs
from civicdocs.llm.common import ensure_checkpoint_dir
from civicdocs.llm.decontaminate import remove_contaminated
from civicdocs.llm.mixing import mix_documents
from civicdocs.llm.secret_scan import mask_secrets
from civicdocs.llm.simhash import keep_one
from civicdocs.llm.toxicity import drop_toxic

# Functions of the package travel to the executors by value: these need no copy of it.
cloudpickle.register_pickle_by_value(civicdocs)

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model calls toxic go; labels that aren't held out teach it."""
    return drop_toxic(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash group the document of the smallest id stays."""
    return keep_one(docs.select(*COLUMNS))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages beyond the ratio go."""
    return remove_contaminated(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in place; n_chars follows the text."""
    masked = mask_secrets(docs.select(*COLUMNS))
    return masked.withColumn("n_chars", F.length("text").cast("long"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out so that sources come near their weights."""
    return mix_documents(docs.select(*COLUMNS))


STAGES = [("toxicity", toxicity), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("secrets", secrets), ("mixture", mixture)]

#: The classifier's and the Markov models' weights are no SQL; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared checkpoint folder and read again."""
    ensure_checkpoint_dir(spark)
    base = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{base}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
