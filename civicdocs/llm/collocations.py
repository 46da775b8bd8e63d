"""Phrases of two and three words that stand together more often than their parts let expect.

Counting is done in a HAT-trie: each task numbers the words it meets, and every
place of a text adds one to the path of its word and the next two (one where a
piece of text ends) in a shallow trie over word numbers: language, first word,
then a hash container of what follows. First words of few entries share a container;
one that grows beyond BURST entries becomes a trie node by the second word, with containers of its own.
When the trie exceeds BUDGET entries, whole subtrees of a first word, the largest
first, leave as runs: their paths in order, cut up by prefix partition (a hash of
language, first and second word), each part one row of a path a line and the counts.
There are as many partitions as the texts need for one of them to be small, PART_BYTES each;
the task that a partition is dealt to merges its runs one partition at a time.
A pair's paths are in one partition, so that the counts of pairs are sums over them. Single words are
counted beside the trie and leave in the same form. Only counts that reach the least one leave a partition.

A candidate is scored by its worst cut, a * a / (l * r) in decimals of 38 digits.

Defined results: null and empty texts have no words; a null lang is ``und``;
doc_id is not read, so that repeated rows count each time; a very long text is
counted whole; an empty table gives an empty result; other columns are never
read. Counts are exact below 2^63, scores while 10^6 a^2 and l r stay below 10^38.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions, stored
from .text_hash import mix64, word_codes

MIN_COUNT = 10
INSIDE_PERCENT = 50  # a candidate goes if a longer one that holds it has this share of its count
TOP = 2000
BURST = 8192  # entries of a container before it is split by the next word
BUDGET = 300_000  # entries of a task's trie, and words besides, before subtrees leave
PART_BYTES = 8 << 20  # of text, whose paths make one prefix partition
OWN = 64  # entries of a first word before it has a container of its own
LOOK = 50_000  # places at least between two looks at the sizes
WORD = (1 << 21) - 1  # numbers stay below, as the words are within the budget and a look

#: A-Z in lower case, and what ends a piece as a line feed.
_TABLE = bytes(10 if b in b".,;:!?\n\v\f\r" else b + 32 if 65 <= b <= 90 else b for b in range(256))
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))

Run = tuple[str, int, np.ndarray, pa.Array, np.ndarray]  # language, words of a path, partitions, paths, counts


class Numbers(dict):
    """Words by number; a new one gets the next. 0 stands for the end of a piece."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self) + 1
        return n


class Node(dict):
    """A trie node: word number -> container (counts by what follows) or node."""

    def __missing__(self, word: int) -> defaultdict:
        self[word] = child = defaultdict(int)
        return child


class HatTrie:
    """Counts of (language, first, second, third word), and of single words.

    New paths enter one container that first words share, a language each; when
    the trie is looked at, those of first words with OWN entries go down to containers of their own.
    """

    def __init__(self, parts: int = 1, budget: int = BUDGET, burst: int = BURST, own: int = OWN, look: int = LOOK):
        self.parts, self.budget, self.burst, self.own, self.look = parts, budget, burst, own, look
        self.numbers, self.tops, self.shared, self.singles, self.bursts, self.next = Numbers(), {}, {}, {}, 0, budget

    def add(self, lang: str, text: bytes) -> Iterator[Run]:
        """Count every place of a text; gives the runs that leave meanwhile."""
        if lang not in self.tops:
            self.tops[lang], self.shared[lang], self.singles[lang] = {}, Counter(), Counter()
        a: list[int] = []
        for piece in text.translate(_TABLE).split(b"\n"):
            a += map(self.numbers.__getitem__, piece.split())
            a.append(0)
            if len(a) > self.look:
                yield from self._place(lang, a)
                a = []
        yield from self._place(lang, a)

    def _place(self, lang: str, a: list[int]) -> Iterator[Run]:
        """Add the paths of whole pieces, each with a 0 at its end, to the shared container."""
        self.singles[lang].update(a)
        n = np.array([*a, 0], np.int64)
        key = n[:-2] << 42 | n[1:-1] << 21 | n[2:]
        self.shared[lang].update(key[(n[:-2] > 0) & (n[1:-1] > 0)].tolist())
        self.next -= len(a)
        if self.next < 0:
            yield from self.spill()

    def entries(self) -> int:
        return sum(t[0] for t in self.sizes()) + sum(map(len, self.shared.values()))

    def sizes(self) -> list[tuple[int, str, int]]:
        """(entries, language, first word) of the subtrees; containers that have grown are split on the way."""
        out = []
        for lang, top in self.tops.items():
            for x, child in top.items():
                if type(child) is not Node and len(child) > self.burst:
                    node = Node()
                    for key, n in child.items():
                        node[key >> 21][key & WORD] = n
                    top[x] = child = node
                    self.bursts += 1
                out.append((sum(map(len, child.values())) if type(child) is Node else len(child), lang, x))
        return out

    def _part_off(self) -> None:
        """Paths of first words that have entries enough, or a container already, go down from the shared containers to their own."""
        for lang, shared in self.shared.items():
            key, n, top = np.fromiter(shared, np.int64, len(shared)), np.fromiter(shared.values(), np.int64, len(shared)), self.tops[lang]
            words, entries = np.unique(key >> 42, return_counts=True)
            down = np.isin(key >> 42, np.concatenate([words[entries >= self.own], np.fromiter(top, np.int64, len(top))]))
            moved, counts = key[down], n[down]
            order = np.argsort(moved >> 42, kind="stable")
            moved, counts = moved[order], counts[order]
            starts = np.flatnonzero(np.diff(moved >> 42, prepend=-1))
            for i, j in zip(starts.tolist(), [*starts[1:].tolist(), len(moved)], strict=False):
                x, rest = int(moved[i]) >> 42, moved[i:j] & (1 << 42) - 1
                child = top.get(x)
                if child is None:
                    top[x] = child = Counter()
                if type(child) is Node:
                    for k, c in zip(rest.tolist(), counts[i:j].tolist(), strict=True):
                        child[k >> 21][k & WORD] += c
                    continue
                child.update(rest.tolist())  # one each
                more = counts[i:j] > 1
                for k, c in zip(rest[more].tolist(), counts[i:j][more].tolist(), strict=True):
                    child[k] += c - 1
            self.shared[lang] = Counter(dict(zip(key[~down].tolist(), n[~down].tolist(), strict=True)))

    def spill(self, whole: bool = False) -> Iterator[Run]:
        """What has to leave: the largest subtrees, then the shared containers, until half of the budget is free; all if ``whole``."""
        self._part_off()
        trees = self.sizes()
        size = sum(t[0] for t in trees) + sum(map(len, self.shared.values()))
        if size <= self.budget and len(self.numbers) <= self.budget and not whole:
            self.next = max(self.look, self.budget - size)
            return
        whole = whole or len(self.numbers) > self.budget  # numbers are given anew: nothing may stay behind
        trees.sort(key=lambda t: -t[0])
        left: dict[str, tuple[list, list]] = {lang: ([], []) for lang in self.tops}
        for n, lang, x in trees:
            if not whole and size <= self.budget // 2:
                break
            keys, counts = left[lang]
            child = self.tops[lang].pop(x)
            if type(child) is Node:
                for y, c in child.items():
                    keys += [x << 42 | y << 21 | z for z in c]
                    counts += c.values()
            else:
                keys += [x << 42 | k for k in child]
                counts += child.values()
            size -= n
        for lang, shared in self.shared.items():
            if whole or size > self.budget // 2:
                keys, counts = left[lang]
                keys += shared
                counts += shared.values()
                size -= len(shared)
                shared.clear()
        self.next = max(self.look, self.budget - size)
        words = pa.array([b"", *self.numbers], pa.binary())
        rank = np.empty(len(words), np.int64)
        rank[pc.sort_indices(words).to_numpy()] = np.arange(len(words))
        codes = self._codes(words)
        for lang, (keys, counts) in left.items():
            key, n = np.array(keys, np.int64), np.array(counts, np.int64)
            x, y, z = key >> 42, key >> 21 & WORD, key & WORD
            part = self._part(lang, codes[x], codes[y])
            order = np.lexsort((rank[x] << 42 | rank[y] << 21 | rank[z], part))
            yield lang, 3, part[order], pc.binary_join_element_wise(*(words.take(pa.array(i[order])) for i in (x, y, z)), b" "), n[order]
        if whole:
            for lang, single in self.singles.items():
                single.pop(0, None)
                x, n = np.array([*single.keys()], np.int64), np.array([*single.values()], np.int64)
                part = self._part(lang, codes[x], np.zeros(len(x), np.uint64))
                order = np.lexsort((rank[x], part))
                yield lang, 1, part[order], words.take(pa.array(x[order])), n[order]
                single.clear()
            self.numbers = Numbers()

    def _codes(self, words: pa.Array) -> np.ndarray:
        ends = np.frombuffer(words.buffers()[1], np.int32)[: len(words) + 1].astype(np.int64)
        return word_codes(np.frombuffer(words.buffers()[2] or b"", np.uint8), ends[:-1], ends[1:])

    def _part(self, lang: str, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        own = self._codes(pa.array([lang.encode()], pa.binary()))
        return (mix64(one * _MIX[0] + two * _MIX[1] + own * _MIX[2]) % np.uint64(self.parts)).astype(np.int64)


def _rows(runs: Iterator[Run]) -> Iterator[pa.RecordBatch]:
    """Runs as rows (part, lang, words, paths, n), one for each partition that a run meets: a path a line, counts as 64-bit numbers."""
    for lang, words, part, paths, n in runs:
        if not len(part):
            continue
        lines = pc.binary_join_element_wise(paths, b"", b"\n")
        ends = np.frombuffer(lines.buffers()[1], np.int32)[lines.offset : lines.offset + len(lines) + 1]
        text, counts = lines.buffers()[2].to_pybytes(), n.astype("<i8").tobytes()
        starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        stops = [*starts[1:].tolist(), len(part)]
        held = [(text[ends[a] : ends[b]], counts[8 * a : 8 * b]) for a, b in zip(starts.tolist(), stops, strict=True)]
        yield pa.record_batch({
            "part": pa.array(part[starts]), "lang": pa.array([lang] * len(starts)), "words": pa.array([words] * len(starts), pa.int32()),
            "paths": pa.array([h[0] for h in held], pa.binary()), "n": pa.array([h[1] for h in held], pa.binary()),
        })


def _counted(batches: Iterator[pa.RecordBatch], parts: int, limits: dict[str, int]) -> Iterator[pa.RecordBatch]:
    trie = HatTrie(parts, **limits)
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
            yield from _rows(trie.add(lang, text.as_py() or b""))
    yield from _rows(trie.spill(whole=True))


def _merged(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Runs, those of a partition together -> (lang, words, phrase, n) of what reaches ``least``; of all words of a language as the phrase of 0 words."""

    def summed(lang: str, words: int, runs: list[tuple[bytes, bytes]]) -> Iterator[pa.RecordBatch]:
        buffer = b"".join(r[0] for r in runs)
        ends = np.concatenate([[0], np.flatnonzero(np.frombuffer(buffer, np.uint8) == 10) + 1])
        paths = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(buffer)])
        counts = pa.array(np.frombuffer(b"".join(r[1] for r in runs), "<i8"))
        whole = pa.table({"phrase": paths, "n": counts}).group_by("phrase").aggregate([("n", "sum")])
        found = [(words, whole.filter(pc.greater_equal(whole["n_sum"], least)))]
        if words == 1:
            total = pa.table({"phrase": pa.array([b"\n"], pa.large_binary()), "n_sum": pa.array([pc.sum(counts).as_py()], pa.int64())})
            found.append((0, total))
        else:
            pairs = pc.list_element(pc.split_pattern(whole["phrase"], b" ", max_splits=1, reverse=True), 0)
            pairs = pa.table({"phrase": pairs, "n": whole["n_sum"]}).group_by("phrase").aggregate([("n", "sum")])
            found.append((2, pairs.filter(pc.greater_equal(pairs["n_sum"], least))))
        for k, table in found:
            phrases = [p.removesuffix(b"\n") for p in table["phrase"].to_pylist()]
            keep = [i for i, p in enumerate(phrases) if k != 3 or not p.endswith(b" ")]  # a piece's last pair has no third word
            yield pa.record_batch({
                "lang": pa.array([lang] * len(keep), pa.string()), "words": pa.array([k] * len(keep), pa.int32()),
                "phrase": pa.array([phrases[i] for i in keep], pa.string()), "n": table["n_sum"].combine_chunks().take(pa.array(keep, pa.int64())),
            })

    at, held = None, []
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("part", "lang", "words")]
        for key, paths, n in zip(zip(*columns, strict=True), batch.column("paths"), batch.column("n"), strict=True):
            if key != at and held:
                yield from summed(at[1], at[2], held)
                held = []
            at = key
            held.append((paths.as_py(), n.as_py()))
    if held:
        yield from summed(at[1], at[2], held)


def phrase_counts(docs: DataFrame, least: int = MIN_COUNT, part_bytes: int = PART_BYTES, **limits: int) -> DataFrame:
    """(lang, text) -> lang, words, phrase, n: phrases of 1 to 3 words that occur so often at least, and all words of the language as the phrase of 0 words."""
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(4 * shuffle_partitions(docs.sparkSession), -(-size // part_bytes))
    runs = texts.mapInArrow(lambda it: _counted(it, parts, limits), "part long, lang string, words int, paths binary, n binary")
    dealt = runs.repartition("part").sortWithinPartitions("part", "lang", "words")
    counts = stored(dealt.mapInArrow(lambda it: _merged(it, least), "lang string, words int, phrase string, n long"), "phrases")
    totals = counts.filter("words = 0").groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n"))
    return counts.filter("words > 0").unionAll(totals)


def _wide(c: str):
    return F.col(c).cast("decimal(38,0)")


def collocations(docs: DataFrame, least: int = MIN_COUNT, inside_percent: int = INSIDE_PERCENT, top: int = TOP, **limits: int) -> DataFrame:
    """(lang, text) -> lang, rank, phrase, a, l, r, n, score: the best phrases of each language."""
    counts = phrase_counts(docs, least, **limits)
    candidates = counts.filter("words > 1").select("lang", "words", "phrase", F.col("n").alias("a"))
    k = F.col("k")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).withColumns({
        "first": F.when(k == 1, F.substring_index("phrase", " ", 1)).otherwise(F.substring_index("phrase", " ", 2)),
        "rest": F.when(F.col("words") - k == 1, F.substring_index("phrase", " ", -1)).otherwise(F.substring_index("phrase", " ", -2)),
    })
    known = counts.filter("words between 1 and 2")
    both = cuts.join(known.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang", "first"])
    both = both.join(known.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"])
    scored = both.withColumn("product", _wide("a") * _wide("a") * F.lit(1_000_000).cast("decimal(38,0)")).withColumn("parts", _wide("l") * _wide("r"))
    scored = scored.withColumn("score", F.expr("product div parts"))
    worst = scored.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    held = candidates.filter("words = 3").select("lang", "a", F.explode(F.array(F.substring_index("phrase", " ", 2), F.substring_index("phrase", " ", -2))).alias("phrase"))
    held = held.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = worst.join(held, ["lang", "phrase"], "left").filter(~F.coalesce(100 * F.col("longer") >= inside_percent * F.col("a"), F.lit(False)))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score").withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    totals = counts.filter("words = 0").select("lang", "n")
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_query(spark, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "text"))


OP12_SQL = r"""
WITH w AS (
  SELECT lang, doc, piece, generate_subscripts(ws, 1) AS i, unnest(ws) AS w FROM (
    SELECT lang, doc, generate_subscripts(ps, 1) AS piece, regexp_extract_all(unnest(ps), '[^\x20\x09]+') AS ws FROM (
      SELECT COALESCE(lang, 'und') AS lang, row_number() OVER () AS doc,
        regexp_split_to_array(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS ps FROM documents))
), g AS (
  SELECT lang, w AS w1, lead(w) OVER p AS w2, lead(w, 2) OVER p AS w3 FROM w WINDOW p AS (PARTITION BY doc, piece ORDER BY i)
), f1 AS (SELECT lang, w1 AS phrase, count(*) AS n FROM g GROUP BY ALL),
f2 AS (SELECT lang, w1, w2, w1 || ' ' || w2 AS phrase, count(*) AS n FROM g WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
f3 AS (SELECT lang, w1, w2, w3, w1 || ' ' || w2 || ' ' || w3 AS phrase, count(*) AS n FROM g WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
t AS (SELECT lang, sum(n)::BIGINT AS n FROM f1 GROUP BY 1),
cut AS (
  SELECT f2.lang, f2.phrase, f2.n AS a, 1 AS k, x.n AS l, y.n AS r FROM f2 JOIN f1 x ON x.lang = f2.lang AND x.phrase = w1 JOIN f1 y ON y.lang = f2.lang AND y.phrase = w2
  UNION ALL SELECT f3.lang, f3.phrase, f3.n, 1, x.n, y.n FROM f3 JOIN f1 x ON x.lang = f3.lang AND x.phrase = f3.w1 JOIN f2 y ON y.lang = f3.lang AND y.phrase = f3.w2 || ' ' || f3.w3
  UNION ALL SELECT f3.lang, f3.phrase, f3.n, 2, x.n, y.n FROM f3 JOIN f2 x ON x.lang = f3.lang AND x.phrase = f3.w1 || ' ' || f3.w2 JOIN f1 y ON y.lang = f3.lang AND y.phrase = f3.w3
), s AS (
  SELECT *, ((1000000::HUGEINT * a * a) // (l::HUGEINT * r))::BIGINT AS score FROM cut
), worst AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
held AS (
  SELECT lang, phrase, max(n) AS longer FROM (SELECT lang, w1 || ' ' || w2 AS phrase, n FROM f3 UNION ALL SELECT lang, w2 || ' ' || w3, n FROM f3) GROUP BY ALL
), r AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score
  FROM worst LEFT JOIN held USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM r JOIN t USING (lang) WHERE rank <= 2000
"""
