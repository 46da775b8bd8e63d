"""Spelling variants: words one edit apart, by asymmetric chunks, and the form that each goes back to.

Of two words one edit apart the shorter (of equal ones, either) is cut into two
disjoint chunks that cover it, a prefix and a suffix. The other gives its positional grams
of the same sizes. The edit spoils one chunk at most, so the other stands in the
longer word unchanged: a prefix at shift zero, a suffix at the shift of the
lengths' difference, which is one at most; other grams can't meet a chunk and are
not made. What lies outside the preserved chunk holds the one edit, so it is cut
in the same way once more, and words meet on a chunk together with a chunk of the
rest. That leaves a quarter of a word free, and no group grows as large as all
words of a common beginning or ending. Words that meet are verified by their edit distance.

Defined results: null and empty texts have no words, very long ones count whole; a
null doc_id is written as an empty text; repeated rows count each time; words of
one text may repeat; ties of n go to the word that is smaller by code points; an
empty table gives an empty result; other columns are never read. n counts in 64 bits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, stored

LETTERS = r"[A-Za-zÀ-ÿ]"
MIN_LENGTH = 7
MIN_COUNT = 2
RATIO = 10  # a form is at least so many times as frequent
SLIP = 31  # one in so many words of a document loses a code point


def slipped(doc_id: Column, run: Column) -> Column:
    """The run, or in one of SLIP cases, told by a hash of document and run, the run without one code point."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.char_length(run)).cast("int")
    return F.when(h % SLIP == 0, F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2))).otherwise(run)


def vocabulary(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(doc_id, text) -> word, n: the words long and frequent enough. Shorter runs can't become one, so they aren't taken out of the texts."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(f"{LETTERS}{{{min_length},}}"), F.lit(0))).alias("run"))
    words = runs.select(slipped(F.col("doc_id"), F.col("run")).alias("word")).filter(F.char_length("word") >= min_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count)


def _halves(c: Column, size: Column, longer: int) -> list[tuple[Column, Column, Column]]:
    """(chunk, what is left, the shorter word's share of what is left) for the prefix and the suffix of a word of ``size`` code points; ``c`` has ``longer`` more."""
    q = F.floor(size / 2).cast("int")
    head, tail = F.substr(c, F.lit(1), q), F.substr(c, q + 1)
    if not longer:
        return [(head, tail, size - q), (tail, head, q)]
    return [(head, tail, size - q), (F.substr(c, q + longer + 1), F.substr(c, F.lit(1), q + longer), q)]


def chunk_keys(word: Column, longer: int = 0) -> Column:
    """The keys by which a word meets others: chunk and a chunk of the rest, of a word that is ``longer`` code points shorter."""
    size = F.char_length(word) - longer
    keys = []
    for i, (chunk, rest, left) in enumerate(_halves(word, size, longer)):
        for j, (part, _, _) in enumerate(_halves(rest, left, longer)):
            keys.append(F.xxhash64(size, F.lit(2 * i + j), chunk, part))
    return F.array(*keys)


def near_words(words: DataFrame) -> DataFrame:
    """(word, n), words distinct -> (a, a_n, b, b_n): every pair that exactly one inserted, deleted or replaced code point parts, once."""
    chunks = words.select(F.col("word").alias("a"), F.col("n").alias("a_n"), F.explode(chunk_keys(F.col("word"))).alias("key"))
    grams = [words.select(F.col("word").alias("b"), F.col("n").alias("b_n"), F.lit(longer).alias("longer"), F.explode(chunk_keys(F.col("word"), longer)).alias("key")) for longer in (0, 1)]
    met = chunks.join(grams[0].unionAll(grams[1]), "key")
    may = met.filter((F.col("longer") == 1) & (F.char_length("b") == F.char_length("a") + 1) | (F.col("longer") == 0) & (F.char_length("b") == F.char_length("a")) & (F.col("a") < F.col("b")))
    return may.filter(F.levenshtein("a", "b", 1) == 1).select("a", "a_n", "b", "b_n").distinct()


def group_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, n), words distinct -> word, form, root, n, n_near, form_n.

    Forms grow in frequency from step to step, so that a chain is as long as the
    logarithm of the largest n at most; roots are found by doubling steps.
    """
    pairs = near_words(words)
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")).unionAll(pairs.select("b", "a", "a_n"))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best"))
    known = words.join(best, "word", "left").withColumn("near_n", -F.col("best.minus"))
    has = F.col("near_n") >= ratio * F.col("n")
    told = stored(known.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has, F.col("best.near")).alias("form"), F.when(has, F.col("near_n")).alias("form_n")))
    steps = stored(told.filter("form is not null").select("word", F.col("form").alias("root")))
    while True:
        on = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        steps = stored(steps.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        if steps.filter("moved").isEmpty():
            break
    return told.join(steps.drop("moved"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_query(spark, sf_dir: str) -> DataFrame:
    words = stored(vocabulary(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")))
    return group_variants(words)
