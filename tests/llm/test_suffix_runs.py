"""What of op10's segments reaches the suffix arrays, and that the classes of windows are right."""

import random

import numpy as np

from civicdocs.llm import suffix_dedup
from civicdocs.llm.repeats import BYTES, Windows

SMALL = Windows(words=False, width=12, piece=9, gram=8)


def segments(rnd, n):
    common = ["".join(rnd.choices("ab", k=40)) for _ in range(6)]
    rows = []
    for i in range(n):
        c, a = rnd.choice(common), rnd.randrange(20)
        body = ("".join(rnd.choices("abc", k=rnd.randrange(20))) + c[a : a + rnd.randrange(15, 30)] + "".join(rnd.choices("abc", k=rnd.randrange(20)))).encode()
        if len(body) >= SMALL.width:
            rows.append((0, False, i % 17, i, 5 * i, len(body) - SMALL.width + 1, body))
    return rows


def test_marks_equal_brute_force():
    rnd = random.Random(8)
    for n in (1, 2, 40, 300):
        rows = segments(rnd, n) or [(0, False, 1, 0, 0, 1, b"a" * SMALL.width)]
        first, want = {}, []
        places = sorted((r[2], r[4] + w, r[3], r[6][w : w + SMALL.width]) for r in rows for w in range(r[5]))
        for doc, start, row, window in places:
            place = first.setdefault(window, (doc, start))
            if place != (doc, start):
                want.append((doc, row, start))
        got = suffix_dedup._mark(rows, SMALL)
        assert sorted(zip(*(got.column(k).to_pylist() for k in ("doc", "row", "start")), strict=True)) == sorted(want)


def test_arrays_hold_each_run_once(monkeypatch):
    """Two hundred documents share a passage of 300 bytes between texts of their own: the array holds about one."""
    rnd = random.Random(2)
    letters = "abcdefghijklmnopqrstuvwxyz "
    passage, own = "".join(rnd.choices(letters, k=300)).encode(), lambda: "".join(rnd.choices(letters, k=59)).encode()
    rows = [(0, False, i, i, 0, 321, own() + bytes([i + 30]) + passage + bytes([i + 30]) + own()) for i in range(200)]
    lengths = []
    monkeypatch.setattr(suffix_dedup, "suffix_array", lambda s, f=suffix_dedup.suffix_array: (lengths.append(len(s)), f(s))[1])
    got = suffix_dedup._mark(rows, BYTES)
    assert got.num_rows == 199 * 201 and sorted(set(got.column("start").to_pylist())) == list(range(60, 261))
    assert sum(lengths) < 400 and np.unique(got.column("doc").to_numpy()).tolist() == list(range(1, 200))
