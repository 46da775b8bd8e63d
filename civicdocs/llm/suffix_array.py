"""Suffix arrays by induced sorting, in numpy.

Every suffix is L (larger than the next one) or S (smaller). The leftmost S
suffixes of their runs (LMS) part the string; sorting the LMS substrings by one
induction, naming them, and sorting the string of names recursively sorts the
LMS suffixes, from which a second induction derives all others. An induction
goes through the buckets of the alphabet, and through as many of them at once as
induce nothing into each other: few at the first level, where buckets are large,
hundreds in strings of names. So its work is linear, in few numpy steps.
"""

from __future__ import annotations

import numpy as np

from .text_hash import mix64, prefix_hash, window_hash

MOST_BUCKETS = 4096  # that are tried at once


def classify(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(is S, LMS positions). s ends in a unique least letter."""
    n = len(s)
    step = np.sign(np.diff(s.astype(np.int64)))
    # Equal neighbours take the type of the next place where the letter changes.
    change = np.where(step != 0, np.arange(n - 1), n)
    nearest = np.minimum.accumulate(change[::-1])[::-1]
    is_s = np.ones(n, bool)
    is_s[:-1] = step[np.minimum(nearest, n - 2)] > 0
    lms = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    return is_s, lms


def _deal(sa: np.ndarray, at: np.ndarray, who: np.ndarray, letters: np.ndarray, forward: bool) -> None:
    """Append positions to their letters' buckets in the given order: from the heads up, or from the tails down."""
    order = np.argsort(letters.astype(np.uint16) if len(at) <= 1 << 16 else letters, kind="stable")
    letters = letters[order]
    first = np.flatnonzero(np.concatenate([[True], letters[1:] != letters[:-1]]))
    size = np.diff(np.append(first, len(letters)))
    rank = np.arange(len(letters)) - np.repeat(first, size)
    sa[at[letters] + rank if forward else at[letters] - rank] = who[order]
    at[letters[first]] += size if forward else -size


def induce(s: np.ndarray, is_s: np.ndarray, lms: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All suffixes in the order that follows from the order of the LMS positions."""
    n = len(s)
    begin = np.concatenate([[0], np.cumsum(size)])
    filled = np.flatnonzero(size)
    sa = np.full(n, -1, np.int64)
    seeds = np.bincount(s[lms], minlength=len(size))
    sa[np.repeat(begin[1:] - np.cumsum(seeds), seeds) + np.arange(len(lms))] = lms  # at the ends of their buckets
    head = begin[:-1].copy()

    def own_larger(c: int) -> None:
        """The L suffixes that bucket c induces, some into itself."""
        source, done = [], begin[c]
        while done < head[c]:
            part = sa[done : head[c]]
            done = head[c]
            before = part[part > 0] - 1
            before = before[~is_s[before]]
            own = before[s[before] == c]
            sa[head[c] : head[c] + len(own)] = own
            head[c] += len(own)
            source.append(before[s[before] != c])
        last = sa[begin[c + 1] - seeds[c] : begin[c + 1]]
        found = np.concatenate([*source, last[last > 0] - 1])
        if len(found):
            _deal(sa, head, found, s[found], True)

    k, width = 0, 1
    while k < len(filled):  # L suffixes, smallest first: each is found through the suffix behind it
        c, upto = filled[k], min(k + width, len(filled))
        part = sa[begin[c] : begin[filled[upto - 1] + 1]]
        at = np.flatnonzero(part > 0)
        at = at[~is_s[part[at] - 1]]
        found = part[at] - 1
        letters = s[found]
        inside = letters[letters <= filled[upto - 1]]
        if len(inside) and inside.min() == c:
            own_larger(c)
            k, width = k + 1, 1
            continue
        if len(inside):  # go as far as the first bucket that is not complete
            upto = np.searchsorted(filled, inside.min())
            reach = at < begin[filled[upto]] - begin[c]
            found, letters = found[reach], letters[reach]
        if len(found):
            _deal(sa, head, found, letters, True)
        k, width = upto, min(2 * (upto - k), MOST_BUCKETS)

    sa[np.arange(n) >= np.repeat(head, size)] = -1
    tail = begin[1:] - 1

    def own_smaller(c: int) -> None:
        """The S suffixes that bucket c induces, some into itself."""
        source, done = [], begin[c + 1] - 1
        while done > tail[c]:
            part = sa[tail[c] + 1 : done + 1][::-1]
            done = tail[c]
            before = part[part > 0] - 1
            before = before[is_s[before]]
            own = before[s[before] == c]
            sa[tail[c] - len(own) + 1 : tail[c] + 1] = own[::-1]
            tail[c] -= len(own)
            source.append(before[s[before] != c])
        large = sa[begin[c] : head[c]][::-1]
        before = large[large > 0] - 1
        found = np.concatenate([*source, before[is_s[before]]])
        if len(found):
            _deal(sa, tail, found, s[found], False)

    k, width = len(filled) - 1, 1
    while k >= 0:  # S suffixes, largest first
        c, down = filled[k], max(k - width + 1, 0)
        end = begin[c + 1]
        part = sa[begin[filled[down]] : end][::-1]
        at = np.flatnonzero(part > 0)
        at = at[is_s[part[at] - 1]]
        found = part[at] - 1
        letters = s[found]
        inside = letters[letters >= filled[down]]
        if len(inside) and inside.max() == c:
            own_smaller(c)
            k, width = k - 1, 1
            continue
        if len(inside):
            down = np.searchsorted(filled, inside.max()) + 1
            reach = at < end - begin[filled[down]]
            found, letters = found[reach], letters[reach]
        if len(found):
            _deal(sa, tail, found, letters, False)
        k, width = down - 1, min(2 * (k - down + 1), MOST_BUCKETS)
    sa[0] = n - 1
    return sa


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Suffix order of a string of small numbers that ends in a unique 0."""
    size = np.bincount(s)
    is_s, lms = classify(s)
    if len(lms) < 2:
        return induce(s, is_s, lms, size)
    in_letters = lms[np.argsort(s[lms], kind="stable")]
    rough = induce(s, is_s, in_letters, size)
    mark = np.zeros(len(s), bool)
    mark[lms] = True
    by_substring = rough[mark[rough]]
    # Equal LMS substrings share a name; each reaches to the next LMS position.
    end = np.full(len(s), len(s), np.int64)
    end[lms[:-1]] = lms[1:] + 1
    prefix = prefix_hash(mix64(s.astype(np.uint64) + np.uint64(1)))
    print_of = window_hash(prefix, by_substring, np.minimum(end[by_substring], len(s)))
    fresh = np.ones(len(lms), bool)
    fresh[1:] = print_of[1:] != print_of[:-1]
    name = np.zeros(len(s), np.int64)
    name[by_substring] = np.cumsum(fresh) - 1
    names = name[lms]
    order = np.argsort(names) if fresh.all() else np.lexsort((ranks_of_equals(names), names))
    return induce(s, is_s, lms[order], size)


def ranks_of_equals(names: np.ndarray) -> np.ndarray:
    """For each place of a string of names a number that orders the suffixes that begin with the same name.

    A name that occurs once decides any comparison that comes to it. So of
    such names in a row only the first can be met, and the recursion goes into
    the string without the others.
    """
    once = (np.bincount(names) == 1)[names]
    keep = ~once
    keep[1:] |= ~once[:-1]
    keep[-1] = True
    left = names[keep]
    there = np.zeros(left.max() + 1, np.int64)
    there[left] = 1
    order = suffix_array((np.cumsum(there) - 1)[left])
    rank = np.zeros(len(left), np.int64)
    rank[order] = np.arange(len(left))
    out = np.zeros(len(names), np.int64)
    out[keep] = rank
    return out


def permuted_common_prefixes(codes: np.ndarray, sa: np.ndarray, most: int) -> np.ndarray:
    """For each position of a byte string its common prefix, up to ``most``, with the suffix before it in the array.

    Text order makes neighbours' values nearly equal, so that eight bytes at a
    time are compared only where all before them agreed.
    """
    n = len(codes)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    padded = np.concatenate([codes, np.zeros(most + 8, np.uint8)])
    eight = np.zeros(n + most + 1, np.uint64)
    for i in range(8):
        eight |= padded[i : i + n + most + 1].astype(np.uint64) << np.uint64(8 * i)
    out = np.zeros(n, np.int64)
    at = np.flatnonzero(before >= 0)
    for done in range(0, most, 8):
        differ = eight[at + done] ^ eight[before[at] + done]
        same = differ == 0
        low = differ[~same]
        out[at[~same]] = done + np.bitwise_count((low & (~low + np.uint64(1))) - np.uint64(1)) // 8
        at = at[same]
    out[at] = most
    return np.minimum(out, most)
