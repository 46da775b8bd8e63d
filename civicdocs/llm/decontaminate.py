"""Benchmark decontamination with a broadcast hash set of normalised n-grams.

Test items become windows of n words. Two hash sets go to every task, as bitmaps
whose size follows the number of windows: of the word pairs that begin some
window, and of the windows themselves. They are built in Spark and reach the
scan as the values of scalar subqueries. Training texts are
read once, whatever the number of windows: a text is cut into words, positions
whose pair is in the first set are spelled out, and those in the second set are
written with the row's number and word count to the shared folder, without the
text. There they are joined with the real windows; Spark chooses how by the
tables' sizes.

Defined results: null or wordless texts have no words and no hits; items
without words have no windows; an item of fewer than n words is one window; a
null item_id counts under the empty string; repeated document rows are judged
one by one; empty tables give empty results or no hits; very long texts are read
whole; other columns are carried by ``remove_contaminated`` and never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, stored

N = 13
#: Buckets of a hash set for each window, and at most: a bit each, so that 8 MB are sent of either set whatever the items. Beyond 4 million windows
#: they fill by and by; more is then spelled out and joined, with the same result.
PER_WINDOW, MAX_BUCKETS = 16, 1 << 26
#: 20 hit words in 400 make a document contaminated: hits * RATIO >= words.
RATIO = 20
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BREAK), "")


def benchmark_windows(items: DataFrame, n: int = N) -> DataFrame:
    """(item_id, text) -> distinct (item_id as string, win, len, lead, hash). The lead is the hash of the first two words, of the only one in windows of one word."""
    cut = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), words_of(F.col("text")).alias("w"))
    cut = cut.filter(F.size("w") > 0).withColumn("len", F.least(F.size("w"), F.lit(n)))
    at = cut.select("item_id", "len", F.explode(F.expr("transform(sequence(1, size(w) - len + 1), i -> slice(w, i, len))")).alias("ws"))
    lead = F.when(F.col("len") > 1, F.xxhash64(F.col("ws")[0], F.get("ws", F.lit(1)))).otherwise(F.xxhash64(F.col("ws")[0]))
    win = F.array_join("ws", " ")
    return at.select("item_id", win.alias("win"), "len", lead.alias("lead"), F.xxhash64(win).alias("hash")).distinct()


def buckets_for(n_windows: int) -> int:
    """A power of two with at least PER_WINDOW buckets a window, so that one in PER_WINDOW is filled at most, up to MAX_BUCKETS."""
    return min(MAX_BUCKETS, max(1 << 10, 1 << (PER_WINDOW * n_windows - 1).bit_length()))


def bitmap(hashes: DataFrame, buckets: int) -> DataFrame:
    """(h) -> one row with one array of longs, a bit for each bucket that some hash falls in. No more than the bitmap itself meets in one task."""
    longs = max(1, buckets // 64)
    bit = F.col("h").bitwiseAND(F.lit(buckets - 1))
    filled = hashes.groupBy(F.shiftright(bit, 6).alias("at")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(h & {min(buckets, 64) - 1} as int))")).alias("bits"))
    every = hashes.sparkSession.range(longs).join(filled, F.col("id") == F.col("at"), "left").select("id", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    in_order = lambda key, value: F.transform(F.array_sort(F.collect_list(F.struct(key, value))), lambda x: x[value])
    parts = every.groupBy(F.floor(F.col("id") / 1024).alias("part")).agg(in_order("id", "bits").alias("longs"))
    return parts.agg(F.flatten(in_order("part", "longs")).alias("bitmap"))


PAIRS, SINGLES = "__pairs", "__singles"  # places, from 1, of the words that may begin a window of several words, of one word
LEADS, HASHES = "__leads", "__hashes"  # the bitmaps


def _in(bits: str, buckets: int, h: str) -> str:
    return f"getbit({bits}[cast(shiftright({h} & {buckets - 1}L, 6) as int)], cast({h} & {min(buckets, 64) - 1}L as int)) = 1"


def _starts(lengths: list[int], buckets: int) -> dict[str, Column]:
    """Of the array w of words the places whose word, or word and the next, is in the bitmap of leads."""
    out = {}
    if 1 in lengths:
        out[SINGLES] = F.expr(f"filter(if(size(w) > 0, sequence(1, size(w)), array()), i -> {_in(LEADS, buckets, 'xxhash64(w[i - 1])')})")
    if any(n > 1 for n in lengths):
        out[PAIRS] = F.expr(f"filter(if(size(w) > 1, sequence(1, size(w) - 1), array()), i -> {_in(LEADS, buckets, 'xxhash64(w[i - 1], w[i])')})")
    return out


def _candidates(lengths: list[int], buckets: int) -> Column:
    """All windows of the array w that may be among these: array<struct<s, n, t>>."""
    found = ["cast(array() as array<struct<s:int,n:int,t:string>>)"]
    for n in lengths:
        begun = f"filter({PAIRS if n > 1 else SINGLES}, i -> i + {n - 1} <= size(w))"
        spelled = f"transform({begun}, i -> named_struct('s', i, 'n', {n}, 't', array_join(slice(w, i, {n}), ' ')))"
        found.append(f"filter({spelled}, x -> {_in(HASHES, buckets, 'xxhash64(x.t)')})")
    return F.expr(f"concat({', '.join(found)})")


def find_contamination(docs: DataFrame, items: DataFrame, n: int = N, buckets: int | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, text) -> row_id, doc_id, n_words, spans array<struct<s, n>> (hit windows: first word from 1, words), item_ids array, n_hit; and the columns to keep."""
    windows = stored(benchmark_windows(items, n))
    rows = docs.select("doc_id", *keep, words_of(F.col("text")).alias("w"))
    told = windows.agg(F.count("*").alias("n"), F.array_sort(F.collect_set("len")).alias("lengths")).first()
    buckets = buckets or buckets_for(told["n"])
    rows = rows.withColumns({k: bitmap(windows.select(F.col(c).alias("h")), buckets).scalar() for k, c in ((LEADS, "lead"), (HASHES, "hash"))})
    rows = rows.withColumns(_starts(told["lengths"], buckets))
    light = rows.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", *keep, F.size("w").cast("long").alias("n_words"), _candidates(told["lengths"], buckets).alias("may"))
    light = stored(light)  # row numbers are written, so that they hold
    may = light.select("row_id", F.explode("may").alias("h")).select("row_id", F.struct("h.s", "h.n").alias("span"), F.col("h.t").alias("win"))
    hits = may.join(windows.select("win", "item_id"), "win").groupBy("row_id")
    found = hits.agg(F.array_sort(F.collect_set("span")).alias("spans"), F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    covered = F.expr(
        "aggregate(spans, named_struct('c', 0L, 'upto', 0), (a, x) -> named_struct("
        "'c', a.c + greatest(x.s + x.n - 1 - greatest(x.s - 1, a.upto), 0), 'upto', greatest(a.upto, x.s + x.n - 1)), a -> a.c)"
    )
    whole = light.drop("may").join(found, "row_id", "left")
    spans, ids = F.coalesce("spans", F.array().cast("array<struct<s:int,n:int>>")), F.coalesce("item_ids", F.array().cast("array<string>"))
    return whole.withColumns({"spans": spans, "item_ids": ids}).withColumn("n_hit", covered)


def contaminated(n_hit: Column, n_words: Column, ratio: int = RATIO) -> Column:
    return (n_hit > 0) & (ratio * n_hit >= n_words)


def remove_contaminated(docs: DataFrame, items: DataFrame, mode: str = "documents", n: int = N, ratio: int = RATIO) -> DataFrame:
    """Drop contaminated documents, or (mode "spans") cut every hit word with the break after it out of all texts.

    A verdict follows from the text alone, and is matched back by doc_id and the text's hash: rows of one doc_id, or of none, are judged each by its own text.
    What is matched has no texts, and is written first, so that Spark can send it instead of shuffling the documents where it is small enough.
    """
    keyed = docs.withColumn("__hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    found = find_contamination(keyed, items, n, keep=("__hash",)).withColumnsRenamed({"doc_id": "of_doc", "__hash": "of_text"})
    own = lambda of: keyed["doc_id"].eqNullSafe(of["of_doc"]) & (keyed["__hash"] == of["of_text"])
    if mode == "documents":
        bad = stored(found.filter(contaminated(F.col("n_hit"), F.col("n_words"), ratio)).select("of_doc", "of_text").distinct())
        return keyed.join(bad, own(bad), "left_anti").drop("__hash")
    if mode != "spans":
        raise ValueError(f"mode is documents or spans, not {mode!r}")
    hit = stored(found.filter(F.col("n_hit") > 0).groupBy("of_doc", "of_text").agg(F.any_value("spans").alias("cut_spans")))
    text = F.expr(
        "array_join(concat(slice(gaps, 1, 1), transform(sequence(1, size(ws)), i -> "
        "if(exists(cut_spans, x -> i between x.s and x.s + x.n - 1), '', concat(ws[i - 1], gaps[i])))), '')"
    )
    both = keyed.join(hit, own(hit), "left")
    parts = both.withColumn("ws", F.regexp_extract_all("text", F.lit(RAW_WORD), F.lit(0))).withColumn("gaps", F.split("text", RAW_WORD, -1))
    cleaned = F.when(F.col("cut_spans").isNull(), F.col("text")).otherwise(text)
    return parts.select(*[cleaned.alias("text") if c == "text" else keyed[f"`{c}`"] for c in docs.columns])


def op5_query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


OP5_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT COALESCE(item_id::VARCHAR, '') AS item_id,
    regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, unnest(list_transform(range(1, len(w) - least(len(w), 13) + 2), lambda i: array_to_string(w[i:i + least(len(w), 13) - 1], ' '))) AS t
  FROM b WHERE len(w) > 0
), lens AS (SELECT DISTINCT n FROM bw
), dw AS (
  SELECT r, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: {'s': i, 't': array_to_string(w[i:i + n - 1], ' ')})) AS x FROM d, lens WHERE len(w) >= n
), h AS (
  SELECT DISTINCT dw.r, x.s AS s, dw.n AS n, bw.item_id FROM dw JOIN bw ON bw.n = dw.n AND bw.t = dw.x.t
), p AS (
  SELECT r, count(DISTINCT pos) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS pos FROM h) GROUP BY r
), i AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT r, item_id FROM h) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, COALESCE(n_hit, 0)::BIGINT AS n_hit, COALESCE(n_items, 0)::BIGINT AS n_items,
  sha256(COALESCE(ids, '')) AS items_sha256, COALESCE(n_hit, 0) > 0 AND 20 * COALESCE(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN p USING (r) LEFT JOIN i USING (r)
"""
