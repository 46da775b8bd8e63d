"""MinHash groups, collocations and spelling variants against plain Python."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from civicdocs.llm import collocations, minhash, spelling

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", "a", None) for i, t in rows], DOCS)


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) > 2 else {tuple(w)} if w else set()


def plain_near(rows):
    """{doc_id: (set size, component)} by comparing all pairs."""
    sets, root = {i: shingles(t) for i, t in rows}, {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in sets.items():
        for j, b in sets.items():
            if i < j and a and b and 100 * len(a & b) >= 85 * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def changed(rnd, words, n):
    out = list(words)
    for _ in range(n):
        out[rnd.randrange(len(out))] = f"v{rnd.randrange(10**6)}"
    return out


@pytest.mark.parametrize("crowd", [4, 512])
def test_minhash_groups(spark, crowd):
    """Copies, chains and a family around the threshold; small crowds send regions to greater depths and to blocks."""
    rnd = random.Random(4)
    rows, base = [], [f"w{rnd.randrange(900)}" for _ in range(120)]
    rows += [(i, " ".join(changed(rnd, base, rnd.randrange(6)))) for i in range(60)]
    for k in range(20):
        other = [f"u{k}x{rnd.randrange(500)}" for _ in range(rnd.randint(3, 150))]
        rows += [(100 + 5 * k + j, " ".join(changed(rnd, other, j))) for j in range(4)]
    rows += [(300, "Only TWO"), (301, "only two"), (302, "one"), (303, None), (304, ""), (305, " \n"), (306, "é É word"), (307, "É é word"), (308, rows[0][1].upper())]
    rnd.shuffle(rows)
    docs = documents(spark, rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs, crowd=crowd).collect()}
    assert got == plain_near(rows)
    assert len({c for i, (_, c) in got.items() if i < 60}) < 20 and got[301][1] == 300 and got[304] == (0, 304)


def test_minhash_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(7, text), (7, "other words stand here now"), (5, "other words stand here now"), (None, text), (None, "nobody else has this text"), (9, None)]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n long, component_id string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(7, 28, 7), (7, 3, 5), (5, 3, 5), (None, 28, 7), (None, 3, None), (9, 0, 9)], key=str)
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_signatures_estimate_similarity():
    rnd = random.Random(1)
    a = [f"w{rnd.randrange(10**6)}" for _ in range(400)]
    b = a[:40] + [f"v{i}" for i in range(20)] + a[60:]
    hashes, ends = minhash.shingle_sets([" ".join(x).encode() for x in (a, b)] + [b""])
    sig = minhash.signatures(hashes, ends)
    true = len(shingles(" ".join(a)) & shingles(" ".join(b))) / len(shingles(" ".join(a)) | shingles(" ".join(b)))
    assert abs(float((sig[0] == sig[1]).mean()) - true) < 0.1 and not sig[2].any() and ends[1] == ends[2]


def plain_collocations(rows, least, top):
    """{(lang, rank, phrase, a, l, r, n, score)}"""
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = (text or "").translate({i: i + 32 for i in range(65, 91)})
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            w = re.findall("[^ \t]+", piece)
            totals[lang] += len(w)
            counts.update((lang, tuple(w[i : i + k])) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    frequent = {p: a for p, a in counts.items() if len(p[1]) > 1 and a >= least}
    out = []
    for (lang, p), a in frequent.items():
        longer = max([b for (x, q), b in frequent.items() if x == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(2))], default=0)
        if 100 * longer >= 50 * a:
            continue
        score, _, l, r = min((10**6 * a * a // (counts[lang, p[:k]] * counts[lang, p[k:]]), k, counts[lang, p[:k]], counts[lang, p[k:]]) for k in range(1, len(p)))
        out.append((lang, -score, -a, " ".join(p), l, r))
    out.sort(key=lambda x: (x[0], x[1], x[2], x[3].encode()))
    ranks: Counter = Counter()
    return {(lang, ranks.update([lang]) or ranks[lang], p, -a, l, r, totals[lang], -s) for lang, s, a, p, l, r in out if ranks[lang] < top}


@pytest.mark.parametrize("limits", [{}, {"budget": 60, "burst": 3, "own": 2, "look": 7, "part_bytes": 300}])
def test_collocations(spark, limits):
    """With a tiny budget containers burst and subtrees leave all the time; the counts stay."""
    rnd = random.Random(2)
    words = ["New", "york", "city", "of", "the", "Été", "x\x01", "a-b", "of\x02"]
    texts = [("en", "new York city " * 200 + "x" * 5000), (None, "of the " * 40), ("und", "of the,of the"), ("fr", None), ("fr", ""), ("de", " \t ")]
    texts += [(rnd.choice(["en", "fr", None]), "".join(rnd.choice(words) + rnd.choice([" ", " ", " ", "\t", "  ", ". ", "\n", ","]) for _ in range(rnd.randrange(400)))) for _ in range(60)]
    docs = spark.createDataFrame([(t, lang, 1, "p") for lang, t in texts], "text string, lang string, n int, phrase string").repartition(5)
    got = {tuple(r) for r in collocations.collocations(docs, least=10, top=25, **limits).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()}
    assert got == plain_collocations(texts, 10, 25) and len(got) > 40
    assert collocations.collocations(docs.limit(0)).count() == 0


def test_hat_trie_bursts_and_spills():
    trie = collocations.HatTrie(parts=5, budget=50, burst=4, own=2, look=10)
    runs = [r for text in (b"a b c d e f g. a c e. a d f. a e g", b"a f b a g b", b"a h i " * 30) for r in trie.add("en", text)]
    assert trie.entries() == 21 and trie.bursts and not runs
    many = b" ".join(b"w%d" % i for i in range(40)) + b"."
    runs += list(trie.add("en", many + many))
    assert runs and trie.entries() <= 50 + 10  # LOOK places at most stand above the budget
    runs += list(trie.spill(whole=True))
    assert not trie.entries() and not trie.numbers
    total, parts = Counter(), {}
    for _, words, part, paths, counts in runs:
        assert (np.diff(part) >= 0).all()
        for p, path, n in zip(part.tolist(), paths.to_pylist(), counts.tolist(), strict=True):
            total[words, path] += n
            assert parts.setdefault((words, b" ".join(path.split(b" ")[:2])), p) == p
        for p in set(part.tolist()):
            own = [path.split(b" ") for path, q in zip(paths.to_pylist(), part.tolist(), strict=True) if q == p]
            assert own == sorted(own)
    assert total[3, b"a h i"] == 30 and total[3, b"w38 w39 "] == 2 and total[1, b"a"] == 36
    assert sum(n for (w, _), n in total.items() if w == 3) == 6 + 2 + 2 + 2 + 5 + 89 + 78 and sum(n for (w, _), n in total.items() if w == 1) == 16 + 6 + 90 + 80


def test_scores_beyond_64_bits(spark):
    a = 3 * 10**12
    row = spark.createDataFrame([(a, a + 1, a + 2)], "a long, l long, r long")
    product = collocations._wide("a") * collocations._wide("a") * F.lit(1_000_000).cast("decimal(38,0)")
    got = row.withColumn("product", product).withColumn("parts", collocations._wide("l") * collocations._wide("r")).select(F.expr("product div parts").alias("s")).first().s
    assert got == 10**6 * a * a // ((a + 1) * (a + 2))


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def plain_variants(counts):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {w: min(v, key=lambda x: (-counts[x], x)) for w, v in near.items() if v}
    form = {w: f for w, f in form.items() if counts[f] >= 10 * counts[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n, len(near[w]), counts[form[w]] if w in form else None) for w, n in counts.items()}


def test_spelling_variants(spark):
    rnd = random.Random(6)
    words = {"aaaaaaa": 3, "aaaaaaaa": 40, "aaaaaaaaa": 700, "colonias": 5, "colonies": 60, "coloniés": 60, "xcolonies": 2, "colonie": 1000, "ölmühle": 9}
    for k in range(40):
        base = "".join(rnd.choice("abcé") for _ in range(rnd.randint(7, 12)))
        words[base] = rnd.randint(2, 3000)
        for _ in range(8):
            i, c = rnd.randrange(len(base)), rnd.choice("abcé")
            other = rnd.choice([base[:i] + base[i + 1 :], base[:i] + c + base[i:], base[:i] + c + base[i + 1 :]])
            words.setdefault(other, rnd.randint(2, 200))
    got = spelling.group_variants(spark.createDataFrame(list(words.items()), "word string, n long"))
    assert {tuple(r) for r in got.select("word", "form", "root", "n", "n_near", "form_n").collect()} == plain_variants(words)
    assert spelling.group_variants(spark.createDataFrame([], "word string, n long")).count() == 0


def test_words_of_documents(spark):
    rnd = random.Random(3)
    texts = [(i, " ".join(rnd.choice(["Government", "governments", "ÉCONOMIE", "économie", "x1abcdefg2", "naïvetés", "short", "a×bcdefgh÷ijklmno"]) for _ in range(60))) for i in range(50)] + [(None, "Government government"), (60, None), (61, ""), (5, "governments")]
    want: Counter = Counter()
    for i, t in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            want[run] += 1
    docs = spark.createDataFrame([(i, t, "w", 1) for i, t in texts], "doc_id long, text string, word string, n long")
    assert {r.word: r.n for r in spelling.vocabulary(docs).collect()} == {w: n for w, n in want.items() if len(w) >= 7 and n >= 2}


def test_a_word_meets_few_others(spark):
    """The second chunk keeps words of one beginning apart: the keys' groups stay far below the number of such words."""
    rnd = np.random.default_rng(5)
    words = sorted({"tion" + "".join(rnd.choice(list("abcdefghijklmnop"), 4)) for _ in range(2000)})
    keys = spark.createDataFrame([(w,) for w in words], "word string").select(F.explode(spelling.chunk_keys(F.col("word"))).alias("k"))
    assert keys.groupBy("k").count().agg(F.max("count")).first()[0] < len(words) / 5
