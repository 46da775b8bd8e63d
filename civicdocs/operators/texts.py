"""Section texts, search, summaries and labels."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import ahocorasick
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicdocs.functions.text import LANGUAGES, attachment_url, contains_key, line_breaks, localized, nz, usable_pdf
from civicdocs.operators.numbering import global_index
from civicdocs.sources.storage import stored


def assemble_sections(paragraphs: DataFrame, header: bool = True) -> DataFrame:
    """(section_id, serial, id, header, indexChar, content, hasImage, fileName) -> section_id, body, n_paragraphs.

    Paragraphs by serial, then id; each is its header, index mark, text with
    marked line breaks and image address, whatever of these it has.
    """
    parts = [nz("header")] if header else []
    image = F.when(usable_pdf("hasImage", "fileName"), attachment_url("fileName"))
    piece = F.concat_ws("|", *parts, nz("indexChar"), nz(line_breaks("content")), image)
    rows = F.array_sort(F.collect_list(F.struct(F.coalesce("serial", F.lit(0)).alias("serial"), "id", piece.alias("piece"))))
    return paragraphs.groupBy("section_id").agg(F.array_join(F.transform(rows, lambda p: p["piece"]), "\n").alias("body"), F.count("*").alias("n_paragraphs"))


def oversized_sections(assembled: DataFrame, limit: int) -> DataFrame:
    return assembled.filter(F.length("body") > limit)


def section_body_lookup(wanted: DataFrame, bodies: DataFrame) -> DataFrame:
    """Wanted section ids with their body, and whether there is one."""
    return wanted.join(bodies.withColumn("__there", F.lit(True)), "section_id", "left").withColumn("found", F.coalesce("__there", F.lit(False))).drop("__there")


def search(rows: DataFrame, key: str, *fields: str) -> DataFrame:
    """Rows of which a field holds the key: one literal, case-folded pass over the texts."""
    return rows.filter(contains_key(key, *fields))


def search_many(rows: DataFrame, keys: list[str], *fields: str) -> DataFrame:
    """All (row, key) hits of a few keys, found in one pass without leaving the JVM; for many see ``search_keys``."""
    hits = F.filter(F.array(*[F.when(contains_key(k, *fields), F.lit(k)) for k in keys]), lambda k: k.isNotNull())
    return rows.withColumn("key", F.explode(hits))


#: Bytes of keys that go into one automaton.
KEY_BYTES = 16 << 20


def _finder(shared: Broadcast) -> Callable[[Iterator[pd.Series]], Iterator[pd.Series]]:
    """Texts -> numbers of the keys in them. The automaton is built once a task."""

    def find(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = ahocorasick.Automaton()
        for key, numbers in shared.value:
            automaton.add_word(key, numbers)
        automaton.make_automaton()
        for series in texts:
            yield pd.Series([None if t is None else sorted({n for _, numbers in automaton.iter(t) for n in numbers}) for t in series])

    return find


def search_keys(rows: DataFrame, keys: DataFrame, *fields: str, block_bytes: int = KEY_BYTES) -> DataFrame:
    """All (row, key) hits of the distinct values of ``key`` in a DataFrame, whatever their number: the rows with ``key``.

    An Aho-Corasick automaton of all keys reads each text once, so that the cost
    follows the texts and the hits, not the keys. The keys are sent to the tasks
    in blocks of ``block_bytes``; a set of keys beyond that takes one pass over the texts for
    each block. Keys are literal and meet a field whatever the case; an empty or null key fits every row.
    """
    spark = rows.sparkSession
    known = stored(keys.select("key", F.lower("key").alias("__low")).distinct(), "keys")
    block = F.floor(F.sum(F.octet_length("__low")).over(Window.partitionBy("__part").orderBy("__low", "key")) / block_bytes)
    some = known.filter("__low <> ''")
    parts = max(1, -(-(some.agg(F.sum(F.octet_length("__low"))).first()[0] or 0) // block_bytes))
    dealt = stored(some.withColumn("__part", F.pmod(F.xxhash64("__low"), F.lit(parts)).cast("int")).withColumn("__block", block), "keys")
    found = rows.join(F.broadcast(known.filter("key is null or key = ''").select("key")))  # two keys at most
    for part, b in sorted(tuple(r) for r in dealt.select("__part", "__block").distinct().collect()):  # a row for each block
        held = [(r["__low"], r["key"]) for r in dealt.filter((F.col("__part") == part) & (F.col("__block") == b)).collect()]  # block_bytes at most
        names = [key for _, key in held]
        numbers: dict[str, list[int]] = {}
        for n, (low, _) in enumerate(held):
            numbers.setdefault(low, []).append(n)
        find = F.pandas_udf(_finder(spark.sparkContext.broadcast(list(numbers.items()))), "array<int>")
        hits = F.array_distinct(F.flatten(F.array(*[F.coalesce(find(F.lower(f)), F.array().cast("array<int>")) for f in fields])))
        table = F.broadcast(spark.createDataFrame(list(enumerate(names)), "__n int, key string"))
        found = found.unionByName(rows.withColumn("__n", F.explode(hits)).join(table, "__n").drop("__n"))
    return found


def lookup_many(rows: DataFrame, ids: DataFrame, id_: str = "id") -> DataFrame:
    return rows.join(ids.select(id_).distinct(), id_, "left_semi")


def lookup_one(rows: DataFrame, wanted: int | str, id_: str = "id") -> DataFrame:
    """At most one row; the id may come as text."""
    return rows.filter(F.col(id_) == F.lit(wanted).cast("long")).limit(1)


def summary_rows(books: DataFrame, lang: str = "bn") -> DataFrame:
    """Commissions in order, numbered by ranges, with their summaries' addresses."""
    shown = books.select("id", F.coalesce("serial", F.lit(0)).alias("serial"), "name", "nameBangla", "summaryFileName", "summaryEn")
    return global_index(shown, F.col("serial"), F.col("id")).select("rn", "id", localized(lang, "nameBangla", "name").alias("name"), attachment_url("summaryFileName").alias("summary_bn"), attachment_url("summaryEn").alias("summary_en"))


def summary_coverage(books: DataFrame) -> DataFrame:
    """How many commissions have a summary in either language, in both and in none."""
    bn, en = nz("summaryFileName").isNotNull(), nz("summaryEn").isNotNull()
    return books.agg(F.count("*").alias("commissions"), F.count_if(bn).alias("with_bn"), F.count_if(en).alias("with_en"), F.count_if(bn & en).alias("with_both"), F.count_if(~bn & ~en).alias("with_none"))


def label_lookup(wanted: DataFrame, labels: DataFrame) -> DataFrame:
    """(lang, key, default) -> with value: the label, else the default, else empty."""
    return wanted.join(labels.select("lang", "key", nz("value").alias("__value")), ["lang", "key"], "left").withColumn("value", F.coalesce("__value", "default", F.lit(""))).drop("__value")


def label_parity(labels: DataFrame, one: str = "bn", other: str = "en") -> DataFrame:
    """Keys of two languages: in which they are, and whether their texts agree."""
    return label_parities(labels, [(one, other)]).select("key", "status")


def label_parities(labels: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """The parity of several pairs of languages in one pass: pair (``bn-en``), key, status. A key is gathered once, with its text in each language."""
    langs = sorted({lang for pair in pairs for lang in pair})
    sides = [F.max(F.when(F.col("lang") == lang, F.struct("value"))).alias(f"v{i}") for i, lang in enumerate(langs)]
    wide = labels.filter(F.col("lang").isin(langs)).groupBy("key").agg(*sides)

    def status(one: str, other: str) -> Column:
        a, b = (F.col(f"v{langs.index(lang)}") for lang in (one, other))
        told = F.when(b.isNull(), f"{one}-only").when(a.isNull(), f"{other}-only").when(a["value"].eqNullSafe(b["value"]), "same").otherwise("different")
        return F.when(a.isNotNull() | b.isNotNull(), F.struct(F.lit(f"{one}-{other}").alias("pair"), told.alias("status")))

    return wide.select("key", F.explode(F.array(*[status(*p) for p in pairs])).alias("s")).filter("s is not null").select("s.pair", "key", "s.status")


def language_names(rows: DataFrame) -> DataFrame:
    """With the language's own name; null for a code that isn't known. The 22 names are joined by broadcast."""
    names = rows.sparkSession.createDataFrame(list(LANGUAGES.items()), "lang string, language string")
    return rows.join(F.broadcast(names), "lang", "left")
