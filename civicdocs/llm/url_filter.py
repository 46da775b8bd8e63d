"""Judge urls by host and path rules, else by naive Bayes over segmented names.

Rules are matched natively on the parsed host and path. For the rest, host
labels and path pieces are split into words by a unigram Viterbi whose word
counts come from the visible texts of the pages, each without its own host's
names (all words; a name is sent those that occur in it), and a multinomial
naive Bayes that was trained on the urls with a rule compares block with allow.

Defined results: a null url or one without ``://`` has empty host and path and
is judged by the class priors alone; without any url under a rule everything
else is allowed; repeated rows are judged alike; an empty table gives an empty
result; further columns are not read; a very long url is one row, and the
segmentation of a run of letters takes time in proportion to its length, as
words have MAX_WORD_LENGTH letters at most.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LOWER, UPPER, stored

#: (verdict, host, path prefix)
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
MAX_SENT = 100_000  # weights of so many runs of letters are sent to the executors, more are joined
MAX_WORD_LENGTH = 24


def parse_url(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, both null when none does."""
    rule = verdict = F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def visible(html: Column) -> Column:
    """What a reader sees of a page, in lower case: without scripts, styles, comments, tags and entities, and without names that hold dots, such as hosts."""
    bare = F.regexp_replace(F.lower(html), r"(?s)<(?:(script|style)\b.*?</\1\s*>|!--.*?-->|[^>]*+>)|&[a-z0-9#]++;", " ")
    return F.regexp_replace(bare, r"(?<![a-z0-9-])[a-z0-9-]++(?:\.[a-z0-9-]++)+", " ")


def word_counts(texts: DataFrame, column: str, host: Column | None = None) -> DataFrame:
    """(w, count) of all words of the visible texts, on each page without those that its own host is made of."""
    own = F.array().cast("array<string>") if host is None else F.split(host, "[^a-z]+")
    words = texts.select(own.alias("own"), F.explode(F.split(visible(F.col(column)), "[^a-z]+")).alias("w"))
    return words.filter(F.length("w").between(2, MAX_WORD_LENGTH) & ~F.array_contains("own", F.col("w"))).groupBy("w").count()


def segment(name: str, costs: dict[str, float], worst: float | None = None) -> list[str]:
    """Cheapest split of a name into known words; an unknown piece pays more per letter than any known one.

    ``worst`` is the cost of the rarest word, where ``costs`` has only the words that can occur in the name.
    """
    worst = max(costs.values(), default=10.0) if worst is None else worst
    best, cut = [0.0], [0]
    for end in range(1, len(name) + 1):
        choice = (math.inf, 0)
        for start in range(max(0, end - MAX_WORD_LENGTH), end):
            piece = name[start:end]
            cost = costs.get(piece, worst + 2.5 * (end - start))
            choice = min(choice, (best[start] + cost, start))
        best.append(choice[0])
        cut.append(choice[1])
    out, end = [], len(name)
    while end:
        out.append(name[cut[end] : end])
        end = cut[end]
    return out[::-1]


def url_runs(host: Column, path: Column) -> Column:
    """Runs of letters or digits, marked by where they stand; a run of digits becomes up to six #."""

    def runs(text: Column, mark: str) -> Column:
        found = F.regexp_extract_all(F.lower(text), F.lit("[a-z]+|[0-9]+"), F.lit(0))
        return F.transform(found, lambda r: F.concat(F.lit(mark), F.when(r.rlike("^[0-9]"), F.repeat(F.lit("#"), F.least(F.length(r), F.lit(6)))).otherwise(r)))

    return F.concat(runs(host, "h:"), runs(path, "p:"))


def segmented(runs: DataFrame, counts: DataFrame) -> DataFrame:
    """(run) and all word counts -> (run, pieces). A run is sent the counts of its own substrings, which are all that its segmentation reads."""
    told = counts.agg(F.sum("count").alias("total"), F.min("count").alias("least")).first()
    total = told["total"] or 1
    worst = math.log(total / told["least"]) if told["least"] else 10.0
    starts = runs.filter((F.length("run") > 1) & ~F.col("run").startswith("#")).select("run", F.explode(F.expr("sequence(1, length(run) - 1)")).alias("at"))
    within = F.expr(f"transform(sequence(2, least({MAX_WORD_LENGTH}, length(run) - at + 1)), n -> substr(run, at, n))")
    known = starts.select("run", F.explode(within).alias("w")).distinct().join(counts, "w").groupBy("run").agg(F.collect_list(F.struct("w", "count")).alias("known"))

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def pieces(names: pd.Series, words: pd.Series, times: pd.Series) -> pd.Series:
        out = []
        for name, ws, ns in zip(names, words, times, strict=True):
            costs = {} if ws is None else {w: math.log(total / n) for w, n in zip(ws, ns, strict=True)}
            out.append([name] if name.startswith("#") else segment(name, costs, worst))
        return pd.Series(out, dtype="object")

    return runs.join(known, "run", "left").select("run", pieces("run", F.col("known.w"), F.col("known.count")).alias("pieces"))


def run_weights(uses: DataFrame, pieces: DataFrame) -> DataFrame:
    """(key, run, b, a): how often a marked run stands in blocked and allowed urls -> (key, weight): the log odds of block against allow of its tokens."""
    tokens = uses.join(pieces, "run").select("key", "b", "a", F.posexplode("pieces").alias("at", "piece"))
    tokens = tokens.select("key", "at", "b", "a", F.concat(F.substr("key", F.lit(1), F.lit(2)), "piece").alias("token"))
    table = stored(tokens.groupBy("token").agg(F.sum("b").alias("b"), F.sum("a").alias("a")).filter("b + a > 0"))
    told = table.agg(F.sum("b").alias("b"), F.sum("a").alias("a"), F.count("*").alias("n")).first()
    n_b, n_a = ((told[k] or 0) + told["n"] for k in "ba")
    weight = F.log((F.col("b") + 1) / F.lit(float(n_b))) - F.log((F.col("a") + 1) / F.lit(float(n_a)))
    weighed = tokens.select("key", "at", "token").join(table.select("token", weight.alias("w")), "token")
    return weighed.groupBy("key").agg(in_order("at", "w").alias("weight"))


def in_order(at: str, value: str) -> Column:
    """A group's sum, always added up in the same order."""
    parts = F.array_sort(F.collect_list(F.struct(at, value)))
    return F.aggregate(parts, F.lit(0.0), lambda acc, x: acc + F.coalesce(x[value], F.lit(0.0)))


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, text_column: str = "html") -> DataFrame:
    """(page_id, url, text_column) -> page_id, host, path, rule, verdict, block_log_odds."""
    host, path = parse_url(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, by_rule = rule_of(F.col("host"), F.col("path"), rules)
    ruled = parsed.withColumn("rule", rule).withColumn("by_rule", by_rule)
    count = {r["by_rule"]: r["count"] for r in ruled.groupBy("by_rule").count().collect()}
    odds = math.log((count.get("block", 0) + 1) / (count.get("allow", 0) + 1)) if count.keys() - {None} else -1.0
    said = lambda v: F.sum((F.coalesce("by_rule", F.lit("")) == v).cast("long"))
    uses = ruled.select("by_rule", F.explode(url_runs(F.col("host"), F.col("path"))).alias("key")).groupBy("key").agg(said("block").alias("b"), said("allow").alias("a"))
    uses = stored(uses.withColumn("run", F.expr("substr(key, 3)")))
    pieces = stored(segmented(uses.select("run").distinct(), stored(word_counts(pages, text_column, parse_url(F.col("url"))[0]))))
    weights = run_weights(uses, pieces)
    if uses.count() <= MAX_SENT:
        weights = F.broadcast(weights)
    rows = ruled.withColumn("row_id", F.monotonically_increasing_id()).select("*", F.posexplode_outer(url_runs(F.col("host"), F.col("path"))).alias("at", "key"))
    summed = rows.join(weights, "key", "left").groupBy("row_id", "page_id", "host", "path", "rule", "by_rule").agg(in_order("at", "weight").alias("sum"))
    scored = summed.withColumn("block_log_odds", F.lit(odds) + F.col("sum"))
    method = F.when(F.col("block_log_odds") > 0, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select("page_id", "host", "path", "rule", F.coalesce("by_rule", method).alias("verdict"), "block_log_odds")


def op2_query(spark, sf_dir: str) -> DataFrame:
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
