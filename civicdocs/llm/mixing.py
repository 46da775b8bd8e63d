"""Mix sources to target weights by fractional repetition.

Tokens are summed per source, and weights become target sizes by sharing again
what is above a source's ceiling until nothing is. Target / size is the
repetition rate; every document is emitted floor(rate) times, plus once more
when a draw seeded by its id falls below the fraction. Of DRAWS seeds each
source takes the one whose total comes nearest to its target: all of them are
summed in one pass. Only the table of sources is joined back.

Defined results: null text has size 0; a null source is a source of its own and
comes last; a source of size 0 has target 0 and is never taken; repeated rows
are separate documents that share their draw when they share doc_id; an empty
table gives an empty result; very long texts count whole; columns of the input
other than doc_id, text and source are carried by ``mix_documents`` and never read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicdocs.operators.numbering import global_index

from .common import SPACE_WORD, stored

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
SEED = "mix-1"
DRAWS = 64
RANGE = 1 << 52  # draws are whole numbers below this
TURN = 2783480154209297  # seed j turns the first draw by j times this


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(source, source_size) -> (source, source_size, target).

    Weights repeat over the sources in code point order. A target is
    min(max_repeat * size, level * weight); the level rises, as sources reach
    their ceilings, until all targets sum to all sizes. A round is one aggregate.
    """
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]), ((F.col("rn") - 1) % len(weights) + 1).cast("int"))
    ranked = global_index(sizes, F.asc_nulls_last("source")).withColumn("w", w.cast("long")).withColumn("ceiling", F.lit(max_repeat).cast("long") * F.col("source_size"))
    full = lambda level, c: F.sum(F.when(F.col("ceiling") / F.col("w") < level, F.col(c)))
    whole = ranked.agg(F.sum("source_size").alias("size"), F.sum("w").alias("w")).first()
    level, before = 0.0, None
    while whole["w"] and level != before:
        at = ranked.agg(full(level, "ceiling").alias("ceiling"), full(level, "w").alias("w")).first()
        before, level = level, max(level, (whole["size"] - (at["ceiling"] or 0)) / max(1, whole["w"] - (at["w"] or 0)))
    target = F.least(F.col("ceiling").cast("double"), F.lit(level) * F.col("w"))
    return ranked.select("source", "source_size", target.alias("target"))


def draw(doc_id: Column, seed: str = SEED) -> Column:
    """A whole number below RANGE that depends on the id and the seed only."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")


def turned(first_draw: Column, j: Column | int) -> Column:
    """The draw of the j-th seed."""
    return (first_draw + j * F.lit(TURN)).bitwiseAND(F.lit(RANGE - 1))


def fraction(rate: Column) -> Column:
    return (rate - F.floor(rate)) * RANGE


def copies(first_draw: Column, j: Column | int, rate: Column) -> Column:
    """floor(rate), and one more if the j-th draw is below the fraction."""
    return F.floor(rate).cast("long") + (turned(first_draw, j) < fraction(rate)).cast("long")


def chosen_draws(sized: DataFrame, targets: DataFrame, seed: str = SEED, draws: int = DRAWS) -> DataFrame:
    """(doc_id, source, size) and the sources' targets -> these with rate and pick: the seed whose taken words come nearest, the first of equals."""
    rated = targets.withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))).withColumnRenamed("source", "of_source")
    joined = sized.select("source", "size", draw(F.col("doc_id"), seed).alias("draw")).join(rated, F.col("source").eqNullSafe(F.col("of_source")))
    taken = [F.sum(F.col("size") * copies(F.col("draw"), j, F.col("rate"))) for j in range(draws)]
    summed = joined.groupBy("of_source").agg(F.first("target").alias("target"), F.array(*taken).alias("taken"))
    totals = summed.select("of_source", "target", F.posexplode("taken").alias("j", "taken"))
    picks = totals.groupBy(F.col("of_source").alias("drawn")).agg(F.min(F.struct(F.abs(F.col("taken") - F.col("target")).alias("off"), "j")).alias("near"))
    told = rated.join(picks, F.col("of_source").eqNullSafe(F.col("drawn")), "left")
    return stored(told.select("of_source", "source_size", "target", "rate", F.coalesce("near.j", F.lit(0)).alias("pick")))


def word_count() -> Column:
    return F.coalesce(F.regexp_count("text", F.lit(SPACE_WORD)), F.lit(0)).cast("long")


def repetition(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeat: int = MAX_REPEAT, seed: str = SEED, keep: Sequence[str] | None = None
) -> DataFrame:
    """One row per document: the columns to keep (all, if not said) under ``doc``, with size, source_size, target, rate and copies beside.

    Targets and chosen seeds are tables in the shared folder, so that Spark knows
    their size when it chooses the join.
    """
    carried = F.struct(*[F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)]).alias("doc")
    sized = docs.select(carried, "source", "doc_id", word_count().alias("size"))
    # Words are counted once if few columns are kept, else once more with the whole rows.
    light = stored(sized if keep is not None else docs.select("source", "doc_id", word_count().alias("size")))
    if keep is not None:
        sized = light
    per_source = light.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = chosen_draws(light, stored(source_targets(per_source, weights, max_repeat)), seed)
    return (
        sized.join(targets, F.col("source").eqNullSafe(F.col("of_source")), "left")
        .withColumn("copies", copies(draw(F.col("doc_id"), seed), F.col("pick"), F.col("rate")))
        .select("doc", "size", "source_size", "target", "rate", "copies")
    )


def mix_documents(docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeat: int = MAX_REPEAT, seed: str = SEED) -> DataFrame:
    """The mixture itself: every document as often as it was drawn, numbered by mix_copy from 1."""
    taken = repetition(docs, weights, max_repeat, seed).filter(F.col("copies") > 0)
    out = taken.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("mix_copy"))
    keep = [c for c in docs.columns if c != "mix_copy"]
    return out.select(*[F.col(f"doc.`{c}`").alias(c) for c in keep], "mix_copy")


def op8_query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    r = repetition(docs, keep=["doc_id"])
    return r.select("doc.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, source, COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), r AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rn FROM s
), w AS (
  SELECT *, ([5, 2, 1])[((rn - 1) % 3 + 1)::INT]::BIGINT AS w, 3 * source_size AS ceiling FROM r
), h AS (
  SELECT *, ceiling::DOUBLE / w::DOUBLE AS hits_at FROM w
), f AS (
  SELECT *, row_number() OVER o AS k,
    ((sum(source_size) OVER ()) - COALESCE(sum(ceiling) OVER (ORDER BY hits_at, rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT::DOUBLE
    / ((sum(w) OVER ()) - COALESCE(sum(w) OVER (ORDER BY hits_at, rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT::DOUBLE AS level
  FROM h WINDOW o AS (ORDER BY hits_at, rn)
), l AS (
  SELECT arg_min(level, k) AS final FROM f WHERE level <= hits_at
), t AS (
  SELECT source, source_size, least(ceiling::DOUBLE, COALESCE((SELECT final FROM l), 0) * w) AS target FROM f
), x AS (
  SELECT d.doc_id, d.source, d.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
    ('0x' || substr(md5('mix-1:' || COALESCE(d.doc_id::VARCHAR, '')), 1, 13))::BIGINT AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), j AS (
  SELECT source, j, abs(sum(size * (floor(rate)::BIGINT + ((u + j * 2783480154209297) % 4503599627370496 < (rate - floor(rate)) * 4503599627370496)::BIGINT)) - any_value(target)) AS off
  FROM x, range(64) r(j) GROUP BY source, j
), p AS (
  SELECT source, arg_min(j, (off, j)) AS pick FROM j GROUP BY source
), y AS (
  SELECT x.*, (u + pick * 2783480154209297) % 4503599627370496 < (rate - floor(rate)) * 4503599627370496 AS once_more FROM x JOIN p ON x.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target, (size * (floor(rate)::BIGINT + once_more::BIGINT))::BIGINT AS taken FROM y
"""
