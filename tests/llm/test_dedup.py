"""Top-k, SimHash groups, substring and suffix dedup and the pipeline against plain Python."""

import hashlib
import importlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from civicdocs.llm import components, repeats, simhash, sketch, substring_dedup, suffix_array, suffix_dedup, topk

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", "a", None) for i, t in rows], DOCS)


def plain_top_k(vectors, k):
    live = {i: np.floor(256 * np.array(v, float)).astype(int) for i, v in vectors if v is not None and None not in v and np.isfinite(np.array(v, float)).all()}
    out = set()
    for q in (i for i in live if i % 50 == 0):
        scores = sorted(((-int(live[q] @ live[c]), c) for c in live if c != q))[:k]
        out |= {(q, r + 1, c, -s) for r, (s, c) in enumerate(scores)}
    return out


@pytest.mark.parametrize("block", [7, 4096])
def test_top_k(spark, block):
    rng = np.random.default_rng(1)
    vectors = [(i, [float(x) for x in rng.normal(0, 0.2, 16).astype(np.float32)]) for i in range(300)]
    vectors += [(i, vectors[5][1]) for i in range(400, 500)] + [(501, None), (502, [float("nan")] * 16), (503, [None] * 16), (550, [float("inf")] * 16), (600, [0.0] * 16)]
    rows = spark.createDataFrame(vectors, "id long, embedding array<float>").select("id", topk.quantised(F.col("embedding")).alias("v")).filter("v is not null")
    got = topk.top_k(rows, rows.filter("id % 50 = 0"), block=block, query_block=5, group=2)
    assert {tuple(r) for r in got.collect()} == plain_top_k(vectors, 5)


@pytest.mark.parametrize("data", ["few strong components", "long and short vectors", "any"])
def test_lists_are_read_in_part(data):
    """Bounds leave the rest of the lists unread where the data allow it, and the answer whole: strong components decide early, and blocks of short vectors aren't begun."""
    rng = np.random.default_rng(8)
    values = rng.integers(-200, 200, (4096, 16))
    if data == "few strong components":
        values = (rng.normal(0, 200, (4096, 16)) * 0.6 ** np.arange(16)).astype(np.int64)
    elif data == "long and short vectors":
        values = (rng.normal(0, 60, (4096, 16)) * 0.002 ** (np.arange(4096) % 4)[:, None]).astype(np.int64)
    blocks = topk.by_length(np.arange(4096), values, 1024)
    asked = np.arange(40) * 100
    for i, (ids, scores) in zip(asked.tolist(), topk.best_of_group(blocks, asked, values[asked], 5), strict=True):
        whole = sorted((-int(s), j) for j, s in enumerate(values @ values[i]) if j != i)[:5]
        assert [(-int(s), int(j)) for j, s in zip(ids, scores, strict=True)] == whole
    every = 1024 * 16  # entries of a block, each counted once
    assert all(b.read <= every for b in blocks)
    if data == "few strong components":
        assert all(b.read <= every // 2 for b in blocks[1:])
    if data == "long and short vectors":
        assert sum(b.read for b in blocks[2:]) == 0


def test_top_k_few_rows(spark):
    rows = spark.createDataFrame([(0, [1, 2]), (1, [3, 4]), (2, [1])], "id long, v array<long>")
    assert {tuple(r) for r in topk.top_k(rows, rows.filter("id = 0")).collect()} == {(0, 1, 1, 11), (0, 2, 2, 1)}
    assert topk.top_k(rows.limit(0), rows.limit(0)).count() == 0


def plain_print(text):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_groups(prints):
    """{number: smallest number in its component} by comparing all pairs."""
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in prints:
        for j in prints:
            if i < j and (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in prints}


def near_copies():
    rng = np.random.default_rng(2)
    vocabulary = [f"word{i}" for i in range(300)]
    rows = []
    for base in range(30):
        words = list(rng.choice(vocabulary, 400))
        for _ in range(4):
            rows.append((len(rows), " ".join(words)))
            words[int(rng.integers(400))] = "changed"
    odd = [None, "", "  \t ", "one", "One", "one two", "Same Text here again", "Same Text here again", "long " * 50_000, "É é"]
    return rows + [(1000 + i, t) for i, t in enumerate(odd)]


def test_simhash_groups(spark):
    rows = near_copies()
    docs = documents(spark, rows).withColumn("fp", F.lit("clash"))
    got = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    prints = {i: plain_print(t) for i, t in rows}
    assert {i: r.fp % (1 << 64) for i, r in got.items()} == prints
    want = plain_groups(prints)
    assert {i: r.component_id for i, r in got.items()} == want
    assert len(set(want.values())) < len(rows) - 30
    kept = simhash.keep_one(docs.unionByName(docs.filter("doc_id = 0")).unionByName(documents(spark, [(None, "null id")]).withColumn("fp", F.lit("x"))))
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted([*map(str, set(want.values())), "None"])
    assert kept.columns == docs.columns
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("block", [8, 1024])
def test_links_of_a_crowd(spark, monkeypatch, block):
    """Many fingerprints within a few bits, and chains that only hang together by steps of up to three bits."""
    monkeypatch.setattr(simhash, "CELL_BLOCK", block)
    rng = np.random.default_rng(4)
    center = int(rng.integers(0, 1 << 63))
    prints = {i: center ^ sum(1 << int(b) for b in rng.choice(64, int(rng.integers(0, 5)), replace=False)) for i in range(150)}
    prints = {i: p for p, i in {p: i for i, p in prints.items()}.items()}
    at = int(rng.integers(0, 1 << 63))
    for i in range(1000, 1040):
        prints[i] = at
        for b in rng.choice(64, 3, replace=False):
            at ^= 1 << int(b)
    points = spark.createDataFrame([(i, int(np.uint64(p).view(np.int64))) for i, p in prints.items()], "id long, fp long")
    got = {r.node: r.component for r in components.connected_components(simhash.links(points)).collect()}
    assert {i: got.get(i, i) for i in prints} == plain_groups(prints)


def test_popcount_grid():
    """Halves within a bit meet in a cell where one is at home; a cell is wider than a half; the bound spares comparisons and loses none."""
    rng = np.random.default_rng(8)
    halves = rng.integers(0, 1 << 32, 3000, dtype=np.uint64)
    halves = np.unique(np.concatenate([halves, halves ^ (np.uint64(1) << rng.integers(0, 32, 3000).astype(np.uint64)), [0, (1 << 32) - 1]]).astype(np.uint64))
    who, where, home = simhash.cells(halves)
    counts = np.array([[bin(int(h) >> 2 * s & 3).count("1") for s in range(16)] for h in halves])
    assert ((simhash.segment_counts(halves)[:, None] >> np.arange(0, 32, 2, dtype=np.uint64) & np.uint64(3)) == counts).all()
    met: dict[int, list] = {}
    for i, c, h in zip(who.tolist(), where.tolist(), home.tolist(), strict=True):
        met.setdefault(c, []).append((i, h))
    meet = {(min(i, j), max(i, j)) for m in met.values() for i, h in m if h for j, _ in m if i != j}
    apart = np.abs(counts[:, None, :].astype(np.int8) - counts[None].astype(np.int8)).sum(axis=2)
    assert meet == {(i, j) for i, j in zip(*np.nonzero(apart <= 1), strict=True) if i < j}
    bits = np.bitwise_count(halves[:, None] ^ halves[None])
    assert {(i, j) for i, j in zip(*np.nonzero(bits <= 1), strict=True) if i < j} <= meet
    # all halves of four segments: 81 cells of up to 16 halves
    small = np.arange(256, dtype=np.uint64)
    sizes = np.unique(simhash.segment_counts(small), return_counts=True)[1]
    assert len(sizes) == 81 and sizes.max() == 16
    # the bound on whole vectors of fingerprints that share a cell, as the other halves are random
    prints = rng.integers(0, 1 << 32, 2000, dtype=np.uint64) << np.uint64(32)
    prints = np.unique(np.concatenate([prints, prints ^ (np.uint64(7) << np.uint64(40))]))
    vectors = simhash.unary_counts(prints)
    wide = np.bitwise_count(vectors[:, None] ^ vectors[None])
    of_segments = np.array([[bin(int(p) >> 2 * s & 3).count("1") for s in range(32)] for p in prints], np.int8)
    assert (wide[:50] == np.abs(of_segments[:50, None] - of_segments[None]).sum(axis=2)).all()
    exact = np.bitwise_count(prints[:, None] ^ prints[None])
    assert (wide <= exact).all()
    pairs, left, links = len(prints) * (len(prints) - 1) // 2, np.triu(wide <= simhash.RADIUS, 1).sum(), np.triu(exact <= simhash.RADIUS, 1).sum()
    assert links >= 2000 and left - links < pairs / 1000


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(200, 200), (300, 301), (301, 300)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(chain, "src long, dst long")).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, **{i: 100 for i in range(101, 160)}, 301: 300}
    assert components.connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def repeated_texts():
    rng = np.random.default_rng(7)
    words = [f"w{i}é" if i % 9 == 0 else f"w{i}" for i in range(50)]
    passage = [" ".join(rng.choice(words, 60)) for _ in range(4)]
    rows = []
    for i in range(60):
        parts = [" ".join(rng.choice(words, int(rng.integers(0, 60)))) for _ in range(3)]
        rows.append((i * 7 % 61, f"{parts[0]} {passage[i % 4][i % 5 * 9:]}\n{parts[1]} {passage[(i + 1) % 4] if i % 3 == 0 else ''} {parts[2]}"))
    rows += [(100, rows[3][1]), (101, rows[3][1]), (102, None), (103, ""), (104, "loop me " * 400), (105, "x" * 150), (106, "a" * 100), (107, " ".join(words[:19])), (108, " ".join(words[:19]))]
    rows += [(109, rows[5][1].upper()), (None, rows[6][1]), (110, "\t ".join(passage[0].split())), (111, passage[0] + "\x0b"), (112, "😀" * 200)]
    return rows


def order(i):
    return (1 << 63) - 1 if i is None else i


def plain_words_left(rows, width):
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: order(r[0])):
        w = (t or "").encode().split()
        gone = set()
        for s in range(len(w) - width + 1):
            key = tuple(w[s : s + width])
            gone |= set(range(s, s + width)) if key in seen else set()
            seen.add(key)
        out[i] = (len(w), len(gone), hashlib.sha256(b" ".join(x for p, x in enumerate(w) if p not in gone)).hexdigest())
    return out


def plain_bytes_left(rows, width):
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: order(r[0])):
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for s in range(len(b) - width + 1):
            if b[s : s + width] in seen:
                gone[s : s + width] = True
            seen.add(b[s : s + width])
        spans = int((gone[1:] < gone[:-1]).sum())
        out[i] = (len(b), int(gone.sum()), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest())
    return out


@pytest.mark.parametrize("hot", [2, 256])
def test_substring_dedup(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    rows = repeated_texts()
    docs = documents(spark, rows).repartition(5).withColumn("doc", F.lit("clash"))
    got = {r.doc_id: tuple(r)[1:] for r in substring_dedup.remove_repeats(docs, digest=True).collect()}
    assert got == plain_words_left(rows, 20)
    assert substring_dedup.remove_repeats(docs.limit(0)).count() == 0


@pytest.mark.parametrize("hot", [2, 256])
def test_suffix_dedup(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "ARRAY_BYTES", 3000)
    rows = repeated_texts()
    docs = documents(spark, rows).repartition(5).withColumn("doc", F.lit("clash"))
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.remove_repeats(docs, digest=True).collect()}
    assert got == plain_bytes_left(rows, 100)
    assert suffix_dedup.remove_repeats(docs.limit(0)).count() == 0


def test_repeated_rows_keep_their_text(spark):
    text = " ".join(f"w{i}" for i in range(40))
    docs = documents(spark, [(1, text), (1, text), (2, "other " * 3)])
    assert {(r.doc_id, r.n_removed) for r in substring_dedup.remove_repeats(docs).collect()} == {(1, 0), (2, 0)}
    assert {(r.doc_id, r.n_removed) for r in suffix_dedup.remove_repeats(docs).collect()} == {(1, 0), (2, 0)}


@pytest.mark.parametrize("hot", [2, 256])
def test_rows_of_one_id_lose_only_their_own_repeats(spark, monkeypatch, hot):
    """Null is no document: its rows are one each. Rows that repeat an id keep what another row's marks would cut."""
    monkeypatch.setattr(repeats, "HOT", hot)
    text = lambda c, n=40: " ".join(f"{c}{i:04}{c}" for i in range(n))
    known = text("k")
    rows = [(1, known), (1, known), (2, f"{text('a')} {known}"), (2, text("b", 80)), (None, f"{text('c')} {known}"), (None, text("d", 80)), (None, text("e")), (None, text("e")), (3, text("d", 80))]
    docs = documents(spark, rows).repartition(3)
    want = sorted([(1, known), (1, known), (2, text("a")), (2, text("b", 80)), (None, text("c")), (None, ""), (None, text("e")), (None, ""), (3, text("d", 80))], key=str)
    got = lambda module: sorted(((r.doc_id, bytes(r.kept).decode().strip()) for r in module.remove_repeats(docs).collect()), key=str)
    assert got(substring_dedup) == want
    assert got(suffix_dedup) == want


def test_count_min_never_underestimates(spark):
    """Sketches of partitions, merged, let every key pass that occurs twice, even if the cells are very few."""
    rng = np.random.default_rng(9)
    a, b = (rng.integers(0, 3000, 3000).astype(np.uint64) for _ in range(2))
    keys, counts = np.unique(np.concatenate([a, b]), return_counts=True)
    blocks = {}
    for part in (a, b):
        for block, once, more in sketch.partial(part):
            sketch.add(blocks.setdefault(block, np.zeros(sketch.BLOCK, np.uint8)), once, more)
    bits = np.zeros(sketch.DEPTH * sketch.WIDTH // 8, np.uint8)
    for block, counters in blocks.items():
        bits[block * sketch.BLOCK // 8 : (block + 1) * sketch.BLOCK // 8] = np.packbits(counters >= 2, bitorder="little")
    assert sketch.twice(bits, keys)[counts > 1].all() and sketch.twice(bits, keys)[counts == 1].mean() < 0.01
    rows = spark.createDataFrame([(int(k),) for k in np.concatenate([a, b])], "k long").repartition(3)
    got = sketch.repeated_keys(rows, lambda batches: (x.column("k").to_numpy().view(np.uint64) for x in batches))
    assert (got == bits).all()


def test_the_sketch_keeps_windows_back(spark):
    """Fewer segments leave the map with it than without, and nothing is lost: the others stand nowhere else."""
    rows = repeated_texts() + [(500 + i, " ".join(f"u{i}x{j}" for j in range(200))) for i in range(20)]
    docs = repeats.keyed(documents(spark, rows))
    bits = repeats.sketched(docs, repeats.WORDS)
    count = lambda passes: docs.mapInArrow(repeats.scanner(repeats.WORDS, passes), repeats.SENT).count()
    assert count(lambda keys: sketch.twice(bits, keys)) < 0.7 * count(lambda keys: np.ones(len(keys), bool))


def test_long_words_that_differ(spark):
    """Words of 1,024 bytes that a polynomial modulo 2**64 can't tell apart, in texts that repeat nothing."""
    bit = [bin(i).count("1") % 2 for i in range(1024)]
    one, other = "".join("ab"[b] for b in bit), "".join("ba"[b] for b in bit)
    head, tail = (" ".join(f"{c}{i}" for i in range(13)) for c in "ht")
    docs = documents(spark, [(1, f"{head} {one} {tail}"), (2, f"{head} {other} {tail}"), ((1 << 63) - 1, f"{head} {one} {tail}")])
    assert {r.doc_id: r.n_removed for r in substring_dedup.remove_repeats(docs).collect()} == {1: 0, 2: 0, (1 << 63) - 1: 27}


def test_slices_of_a_very_long_text(spark, monkeypatch):
    monkeypatch.setattr(repeats, "SLICE", 50)
    monkeypatch.setattr(repeats, "CROWD", 8)
    rows = [(1, " ".join(f"w{i % 70}" for i in range(700))), (2, " ".join(f"w{i % 70}" for i in range(5, 60))), (3, "ab" * 400)]
    docs = documents(spark, rows)
    assert {r.doc_id: tuple(r)[1:] for r in substring_dedup.remove_repeats(docs, digest=True).collect()} == plain_words_left(rows, 20)
    assert {r.doc_id: tuple(r)[1:] for r in suffix_dedup.remove_repeats(docs, digest=True).collect()} == plain_bytes_left(rows, 100)


def test_suffix_array_of_a_real_shard(spark):
    """A megabyte of text, whose strings of names have tens of thousands of letters: each suffix below the next one."""
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect() if r.text]
    raw = "\n".join(texts).encode()[: 1 << 20]
    s = np.append(np.frombuffer(raw, np.uint8).astype(np.int64) + 1, 0)
    sa = suffix_array.suffix_array(s)
    assert (np.sort(sa) == np.arange(len(s))).all()
    rank = np.empty(len(s), np.int64)
    rank[sa] = np.arange(len(s))
    a, b = sa[1:-1], sa[2:]
    assert (s[sa[:-1]] <= s[sa[1:]]).all() and (rank[a + 1] < rank[b + 1])[s[a] == s[b]].all()


@pytest.mark.parametrize("letters", [1, 2, 4, 3000])
def test_suffix_array(letters):
    rng = np.random.default_rng(letters)
    for n in (1, 2, 3, 10, 50, 700):
        for times in (1, 3):
            s = np.append(np.tile(rng.integers(1, letters + 1, n), times), 0)
            sa = suffix_array.suffix_array(s)
            assert sa.tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())
            if letters < 200:
                common = suffix_array.permuted_common_prefixes(s.astype(np.uint8), sa, 100)
                for a, b in zip(sa[:-1], sa[1:]):
                    same = 0
                    while same < 100 and max(a, b) + same < len(s) and s[a + same] == s[b + same]:
                        same += 1
                    assert common[b] == same


def test_pipeline(spark, tmp_path):
    """On a small corpus the stages decide as their plain counterparts do."""
    import corpus_pipeline
    from tests.llm.test_filters import BENCH, CLEAN, plain_contamination

    rng = np.random.default_rng(11)
    rows, labels = [], []
    for i in range(300):
        words = list(rng.choice(CLEAN, 40)) + [f"n{i}x{j}" for j in range(30)]
        if i % 5 == 0:
            words[3] = words[20] = "nastyword"
        if i % 7 == 1:
            words[5:5] = BENCH[0][1].split()[:20]
        if i % 11 == 2:
            words.insert(9, f"password={'ab12' * 3}{i}")
        rows.append((i, " ".join(words), "en", f"s{i % 3}", 1))
        labels.append((i, 0, int(i % 5 == 0)))
    rows += [(1000 + i, rows[i][1], "en", "s1", 1) for i in range(0, 60)] + [(2000, None, None, None, None)]
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(BENCH[:2], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    left = {}
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        left[name] = {r.doc_id: r.text for r in docs.collect()}
        assert name == "mixture" or docs.columns == DOCS.replace(" long", "").replace(" string", "").split(", ")
    texts = {r[0]: r[1] for r in rows}
    assert {i for i in texts if "nastyword" not in (texts[i] or "")} == set(left["toxicity"])
    assert set(left["near_dedup"]) == set(plain_groups({i: plain_print(texts[i]) for i in left["toxicity"]}).values())
    bad = {r[0] for r in plain_contamination([(i, texts[i]) for i in left["near_dedup"]], BENCH[:2]) if r[2] and 20 * r[2] >= r[1]}
    assert set(left["decontaminate"]) == set(left["near_dedup"]) - bad and bad
    assert all("password=" not in (t or "") for t in left["secrets"].values()) and any("[SECRET]" in (t or "") for t in left["secrets"].values())
    assert set(left["mixture"]) <= set(left["secrets"])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == docs.count()


def test_pipeline_of_odd_tables(spark, tmp_path):
    """No documents; then no labels and no benchmark items, with nulls, repeated rows and a very long text."""
    import corpus_pipeline

    rows = [(1, "a few words of the report", "en", "a", 1), (1, "a few words of the report", "en", "a", 1), (2, None, "en", None, None), (3, "", None, "a", 0), (4, "long word " * 60_000, "en", "b", 1), (None, "no id here at all", "en", "b", 1), (None, "no id here at all", "en", "b", 1)]
    labels, items = "doc_id long, quality int, toxic int", "item_id long, text string"
    for name, docs in (("none", []), ("odd", rows)):
        at = tmp_path / name
        spark.createDataFrame(docs, DOCS).withColumn("extra", F.lit(1)).write.parquet(str(at / "documents.parquet"))
        spark.createDataFrame([], labels).write.parquet(str(at / "labels.parquet"))
        spark.createDataFrame([], items).write.parquet(str(at / "benchmark.parquet"))
        stages, left = dict(corpus_pipeline.STAGES), spark.read.parquet(str(at / "documents.parquet"))
        for stage in ("toxicity", "near_dedup", "decontaminate", "secrets"):
            left = stages[stage](spark, left, str(at))
            assert left.columns == list(corpus_pipeline.COLUMNS)
        # 2 and 3 have no words and link; 1 stands once; rows without an id stay
        assert sorted((str(r.doc_id) for r in left.collect())) == ([] if name == "none" else ["1", "2", "4", "None", "None"])
        assert {r.doc_id for r in corpus_pipeline.run(spark, str(at)).collect()} <= {r[0] for r in docs}


def test_driver_names():
    entry = importlib.import_module("__spark_entry__")
    assert {int(k[2:].split("_")[0]) for k in entry.queries() if k.startswith("op")} == set(range(1, 11)) and "pipeline" in entry.queries()
