"""Find secrets by patterns and by the character statistics of random strings.

Three patterns find secrets of a known form. Two character Markov models, one
of the values that the patterns find and one of the ordinary words around them,
are trained on a sample of documents; a token of LONG characters or more outside
all pattern spans, with a letter and a digit in it, is a secret too when the
log-likelihood ratio of the models says random. The ordinary model also learns the words in
capitals, with a capital, and between the signs that join names (FORMS), and runs of one sign.
Spans count code points and exclude their end.

Every pattern runs over a text once for the matches, for their values and for
what lies between; spans and masked texts are folded from these in chunks, so that
the work follows the length of a text and the number of its matches.

Defined results: a null text is empty; without a single pattern hit in the
sample the random model is uniform; equal rows get equal spans; an empty table
gives an empty result; very long texts are searched whole; other columns
are carried by ``mask_secrets``. Tokens under LONG characters are not judged by
the models, nor are those of letters or of digits alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: kind -> (pattern, group that must be long enough, its least length), in the order of ties
KINDS = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""", 2, 8),
    "access": (r"(AKIA[A-Z0-9]{12,})", 1, 16),
    "hex": (r"([0-9a-f]{32,})", 1, 32),
}
LONG = 16  # characters of a token that is judged by the models
TOKEN = rf"([A-Za-z0-9+/_=-]{{{LONG},}})"
WORD = r"[A-Za-z0-9_]{5,}"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-."
SIGNS = "+/_=-."
SYMBOLS = len(ALPHABET) + 1
SAMPLE_DOCS = 4_000  # about so many documents train the models
CHUNK = 256  # matches of a text that are put together at a time
MIN_LLR = 16.0  # a token is random when the models' log-likelihood ratio is above this


def _folded(items: Column, state: Column, begin, step, out: str) -> Column:
    """A fold over an array, by CHUNK items at a time so that no long list is copied for each of them: (state, out) after each chunk.

    ``begin(state, chunk)`` gives what is carried inside a chunk, a struct with
    ``state``; ``step(carried, item)`` gives (carried's fields, an array of pieces).
    """

    def inner(chunk, before):
        first = F.struct(begin(before, chunk).alias("c"), F.array().cast(out).alias("out"))

        def one(acc, x):
            carried, pieces = step(acc["c"], x)
            return F.struct(carried.alias("c"), F.concat(acc["out"], pieces).alias("out"))

        return F.aggregate(chunk, first, one, lambda acc: F.struct(acc["c"]["state"].alias("state"), acc["out"].alias("out")))

    last = lambda parts: F.coalesce(F.get(parts, F.size(parts) - 1)["state"], state)
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / CHUNK).cast("int")), lambda k: F.slice(items, k * CHUNK + 1, CHUNK))
    chunks = F.when(F.size(items) > 0, chunks).otherwise(F.array())
    none = F.array().cast(f"array<struct<state:int,out:{out}>>")
    parts = F.aggregate(chunks, none, lambda parts, chunk: F.concat(parts, F.array(inner(chunk, last(parts)))))
    return parts


SPAN = "struct<start:int,rank:int,end:int,kind:string,value:string>"


def _pieces(text: Column, pattern: str, group: int, may: Column) -> Column:
    """Matches in order with what lies before each and, where it is a group of its own, the value; null where ``may`` tells cheaply that a text has none."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(1)).alias("m")
    value = [] if group == 1 else [F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("v")]
    return F.when(may & text.rlike(pattern), F.arrays_zip(whole, F.split(text, pattern, -1).alias("g"), *value))


def _spans(pieces: Column, group: int, least: int, kind: str, rank: int) -> Column:
    """The spans of pieces whose value is long enough; positions are sums of the lengths of matches and of what lies between."""

    def step(acc, p):
        start, value = acc["state"] + F.length(p["g"]), p["m" if group == 1 else "v"]
        end = start + F.length(F.coalesce(p["m"], F.lit("")))
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"), value.alias("value"))
        return F.struct(end.alias("state")), F.when(F.coalesce(F.length(value) >= least, F.lit(False)), F.array(span)).otherwise(F.array().cast(f"array<{SPAN}>"))

    parts = _folded(pieces, F.lit(0), lambda before, chunk: F.struct(before.alias("state")), step, f"array<{SPAN}>")
    return F.coalesce(F.flatten(F.transform(parts, lambda part: part["out"])), F.array().cast(f"array<{SPAN}>"))


def with_base(docs: DataFrame, text: str = "t") -> DataFrame:
    """With ``base``: spans of the patterns by start, then kind. A literal part of the pattern, or for hex a long token, is looked for first."""
    t = F.col(text)
    low = F.lower(t)
    may = {"assign": low.contains("passw") | low.contains("secret") | low.contains("token") | low.contains("api"), "access": t.contains("AKIA"), "hex": t.rlike(TOKEN)}
    found = docs.select("*", *[_pieces(t, p, g, may[k]).alias(f"__{k}") for k, (p, g, _) in KINDS.items()])
    spans = F.concat(*[_spans(F.col(f"__{k}"), g, n, k, i) for i, (k, (_, g, n)) in enumerate(KINDS.items())])
    return found.withColumn("base", F.array_sort(spans)).drop(*[f"__{k}" for k in KINDS])


def _forms(word: Column) -> Column:
    """Ordinary spellings of a word: as it is, in capitals, joined to others by signs or by case, and with numbers, whose digits follow from a hash of the word."""
    upper, capital = F.upper(word), F.concat(F.upper(F.left(word, F.lit(1))), F.substr(word, F.lit(2)))
    h = F.crc32(word.cast("binary"))
    small, large, two = (h % 100).cast("string"), F.pmod(F.shiftright(h, 7), F.lit(2100)).cast("string"), F.lpad(F.pmod(F.shiftright(h, 18), F.lit(60)).cast("string"), 2, "0")
    cased = F.concat(capital, F.upper(F.left(word, F.lit(1))))
    joined = [F.concat(F.lit(sign), w, F.lit(sign), n, F.lit(sign), two, F.lit(sign)) for sign, n in (("_", large), ("-", large), ("/", large)) for w in (word, upper)]
    return F.array(word, upper, cased, F.concat(word, small), F.concat(capital, small, F.upper(F.left(word, F.lit(1)))), *joined)


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> list[float]:
    """Log-likelihood ratios, random against ordinary, of all character pairs: a list by code1 * SYMBOLS + code2.

    Words and values are counted before they are taken apart, each once for every text it is in.
    """
    every = max(1, docs.count() // sample_docs)
    text = F.coalesce("text", F.lit(""))
    sample = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0).select(text.alias("t"))
    words = F.array_distinct(F.regexp_extract_all("t", F.lit(WORD), F.lit(0)))
    sample = with_base(sample).select("base.value", F.array_except(words, F.col("base.value")).alias("words"))
    each = sample.select(F.explode(F.concat(
        F.transform("value", lambda v: F.struct(v.alias("v"), F.lit(1).alias("label"))), F.transform("words", lambda v: F.struct(v.alias("v"), F.lit(0).alias("label")))
    )).alias("x")).groupBy("x.v", "x.label").agg(F.count("*").alias("n"))
    each = each.filter((F.length("v") > 1) & ((F.col("label") == 1) | (F.length("v") < LONG)))  # longer words are what will be judged
    forms = each.select("label", "n", F.explode(F.when(F.col("label") == 1, F.array("v")).otherwise(_forms(F.col("v")))).alias("v"))
    pairs = forms.select("label", "n", F.explode(F.transform(F.sequence(F.lit(1), F.length("v") - 1), lambda i: F.substr("v", i, F.lit(2)))).alias("pair"))
    count = [[0] * (SYMBOLS * SYMBOLS) for _ in range(2)]
    for r in pairs.groupBy("label", "pair").agg(F.sum("n").alias("n")).collect():  # at most 2 * SYMBOLS^2 rows
        one, two = (ALPHABET.find(c) + 1 for c in r["pair"])
        count[r["label"]][one * SYMBOLS + two] += r["n"]
    for sign in SIGNS:  # runs of a sign are ordinary
        code = ALPHABET.index(sign) + 1
        count[0][code * SYMBOLS + code] += sum(count[0]) // 100 + 1
    chance = [_conditional(c) for c in count]
    return [math.log(chance[1][i]) - math.log(chance[0][i]) for i in range(SYMBOLS * SYMBOLS)]


def _conditional(count: list[int], prior: float = 5.0) -> list[float]:
    """P(second | first) of all pairs, drawn towards P(second) where the first is rare."""
    total = sum(count) + SYMBOLS
    single = [(sum(count[b::SYMBOLS]) + 1) / total for b in range(SYMBOLS)]
    rows = [sum(count[a * SYMBOLS : (a + 1) * SYMBOLS]) for a in range(SYMBOLS)]
    return [(count[a * SYMBOLS + b] + prior * single[b]) / (rows[a] + prior) for a in range(SYMBOLS) for b in range(SYMBOLS)]


def random_spans(tokens: Column, base: Column, table: list[float], min_llr: float = MIN_LLR) -> Column:
    """Those of the tokens outside all base spans, with a letter and a digit, that look random."""
    ratios = F.lit(table)

    def llr(v: Column) -> Column:
        codes = F.transform(F.split(v, ""), lambda c: F.instr(F.lit(ALPHABET), c))
        step = lambda acc, c: F.struct(c.alias("last"), (acc["sum"] + F.when(acc["last"] < 0, 0.0).otherwise(F.get(ratios, acc["last"] * SYMBOLS + c))).alias("sum"))
        return F.aggregate(codes, F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum")), step)["sum"]

    mixed = lambda v: v.rlike("[0-9]") & v.rlike("[A-Za-z]")
    random = F.filter(tokens, lambda s: mixed(s["value"]) & (llr(s["value"]) > min_llr))
    return F.filter(random, lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))


def scan(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, min_llr: float = MIN_LLR) -> DataFrame:
    """All columns of the input under ``doc``, with base and spans: array<struct<start, rank, end, kind, value>>."""
    table = train(docs.select("doc_id", "text"), sample_docs)
    t = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.coalesce("text", F.lit("")).alias("t"))
    t = with_base(t).withColumn("tokens", _pieces(F.col("t"), TOKEN, 1, F.lit(True))).withColumn("tokens", _spans(F.col("tokens"), 1, LONG, "model", len(KINDS)))
    return t.withColumn("added", random_spans(F.col("tokens"), F.col("base"), table, min_llr)).select(
        "doc", "t", "base", F.when(F.size("added") == 0, F.col("base")).otherwise(F.array_sort(F.concat("base", "added"))).alias("spans")
    )


def told(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def mask_secrets(docs: DataFrame, mask: str = "[SECRET]", **options) -> DataFrame:
    """The documents with every span's text replaced; spans that overlap are replaced once. A null text stays null."""

    def begin(before, chunk):  # only the text from the last chunk's end to this one's
        end = F.greatest(before, F.array_max(F.transform(chunk, lambda s: s["end"])))
        return F.struct(before.alias("state"), before.alias("from"), F.substr(F.col("t"), before + 1, end - before).alias("part"))

    def step(acc, s):
        at = acc["state"]
        kept = F.when(s["start"] > at, F.substr(acc["part"], at - acc["from"] + 1, s["start"] - at)).otherwise(F.lit(""))
        fresh = (s["start"] >= at) | (at == 0)
        after = F.struct(F.greatest(at, s["end"]).alias("state"), acc["from"].alias("from"), acc["part"].alias("part"))
        return after, F.array(kept, F.when(fresh, F.lit(mask)).otherwise(F.lit("")))

    found = scan(docs, **options)
    done = found.withColumn("parts", _folded(F.col("spans"), F.lit(0), begin, step, "array<string>"))
    end = F.coalesce(F.get("parts", F.size("parts") - 1)["state"], F.lit(0))
    masked = F.concat(F.array_join(F.flatten(F.transform("parts", lambda p: p["out"])), ""), F.substr(F.col("t"), end + 1))
    text = F.when(F.size("spans") == 0, F.col("doc.text")).otherwise(masked)
    return done.select(*[text.alias("text") if c == "text" else F.col(f"doc.`{c}`").alias(c) for c in docs.columns])


def op7_query(spark, sf_dir: str) -> DataFrame:
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    n = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select(F.col("doc.doc_id").alias("doc_id"), n("assign"), n("access"), n("hex"), F.sha2(told(F.col("base")), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"))
