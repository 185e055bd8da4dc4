"""Suffix arrays by induced sorting, and permuted common prefixes, in numpy.

``suffix_array`` classifies suffixes (smaller or larger than the next one),
sorts the leftmost-smaller substrings by one induced pass, names them, sorts
the string of names recursively, and induces the whole order from it.  Each
induced pass goes over the buckets of first symbols; all suffixes of a bucket
that are known induce their predecessors in one vector step.  Names are many,
so a string of names is written as one of two digits a name, whose buckets are
few again; where that would not be shorter, it is passed element by element.
"""

from __future__ import annotations

import numpy as np

FEW = 6                     # suffixes that are placed one by one
VECTOR_SYMBOLS = 1024       # alphabets up to which buckets are vector steps


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Positions of ``text`` in the order of their suffixes; ``text`` holds
    non-negative integers, and its end is smaller than any."""
    text = np.asarray(text, np.int64)
    n = len(text)
    if n < 2:
        return np.arange(n)
    size = int(text.max()) + 1
    smaller = _smaller(text)
    left = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1      # leftmost-smaller positions
    induce = _induce_vector if size <= VECTOR_SYMBOLS else _induce_scalar
    if not len(left):
        return induce(text, smaller, size, left)
    order = induce(text, smaller, size, left)
    is_left = np.zeros(n, bool)
    is_left[left] = True
    by_substring = order[is_left[order]]
    names, kinds = _names(text, left, by_substring)
    by_suffix = by_substring if kinds == len(left) else left[_name_order(names, kinds, n)]
    return induce(text, smaller, size, by_suffix)


def _name_order(names: np.ndarray, kinds: int, n: int) -> np.ndarray:
    """Suffix order of a string of names out of a text of ``n`` symbols."""
    base = int(np.ceil(np.sqrt(kinds)))
    if kinds <= VECTOR_SYMBOLS or base > VECTOR_SYMBOLS or 2 * len(names) > 0.8 * n:
        return suffix_array(names)
    order = suffix_array(np.stack([names // base, names % base], axis=1).ravel())
    return order[order % 2 == 0] // 2


def _smaller(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next; the last is larger than
    the end."""
    n = len(text)
    out = np.zeros(n, bool)
    differs = np.flatnonzero(text[:-1] != text[1:])
    if len(differs):
        # a run of equal symbols is as its last member is
        rises = text[differs] < text[differs + 1]
        out[:differs[-1] + 1] = np.repeat(rises, np.diff(differs, prepend=-1))
    return out


def _names(text: np.ndarray, left: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, int]:
    """Ranks of the leftmost-smaller substrings, in text order, and how many
    there are; equal ones share a name."""
    n, m = len(text), len(left)
    ends = np.r_[left[1:] + 1, n]
    place = np.zeros(n, np.int32)
    place[left] = np.arange(m)
    rank_of = place[order]
    start, size = order, (ends - left)[rank_of]
    same = np.zeros(m, bool)
    pair = np.flatnonzero((size[1:] == size[:-1]) & (rank_of[1:] != m - 1) & (rank_of[:-1] != m - 1)) + 1
    alive, d = pair, 0
    while len(alive):
        alive = alive[text[start[alive] + d] == text[start[alive - 1] + d]]
        d += 1
        done = size[alive] == d
        same[alive[done]] = True
        alive = alive[~done]
    names = np.empty(m, np.int64)
    names[rank_of] = np.cumsum(~same) - 1
    return names, int((~same).sum())


def _induce_vector(text: np.ndarray, smaller: np.ndarray, size: int, seeds: np.ndarray) -> np.ndarray:
    n = len(text)
    count = np.bincount(text, minlength=size)
    end = np.cumsum(count)
    begin = end - count
    order = np.full(n, -1, np.int64)
    narrow = text.astype(np.int16 if size <= 1 << 15 else np.int64)
    seed_symbol = narrow[seeds]
    by_symbol = np.argsort(seed_symbol, kind="stable")
    seeds, seed_count = seeds[by_symbol], np.bincount(seed_symbol, minlength=size)
    seed_end = np.cumsum(seed_count)

    head, steps = begin.copy(), np.arange(n)

    def put_front(at: np.ndarray) -> None:
        if len(at) <= FEW:
            for x, c in zip(at.tolist(), narrow[at].tolist(), strict=True):
                order[head[c]] = x
                head[c] += 1
            return
        symbol = narrow[at]
        by = symbol.argsort(kind="stable")
        symbol = symbol[by]
        lens = np.bincount(symbol, minlength=size)
        order[(head - lens.cumsum() + lens)[symbol] + steps[:len(at)]] = at[by]
        head[:] += lens

    # the last suffix is larger than the empty one: it comes first in its bucket
    put_front(np.array([n - 1]))
    present = np.flatnonzero(count)
    for c in present.tolist():
        done = int(begin[c])
        while done < head[c]:
            stop = int(head[c])
            before = order[done:stop] - 1
            done = stop
            before = before[before >= 0]
            before = before[~smaller[before]]
            if len(before):
                put_front(before)
        some = seeds[seed_end[c] - seed_count[c]:seed_end[c]] - 1
        if len(some):
            put_front(some[~smaller[some]])

    tail = end.copy()
    for c in present[::-1].tolist():
        done = int(end[c])
        # smaller suffixes of the bucket, from its end
        while done > tail[c]:
            stop = int(tail[c])
            _put_back(order, narrow, tail, smaller, order[stop:done][::-1], steps)
            done = stop
        larger = order[begin[c]:head[c]][::-1]
        if len(larger):
            _put_back(order, narrow, tail, smaller, larger, steps)
    return order


def _put_back(order: np.ndarray, narrow: np.ndarray, tail: np.ndarray, smaller: np.ndarray, at: np.ndarray,
              steps: np.ndarray) -> None:
    """Predecessors that are smaller go to the ends of their buckets, in turn."""
    before = at - 1
    before = before[before >= 0]
    before = before[smaller[before]]
    if len(before) <= FEW:
        for x, c in zip(before.tolist(), narrow[before].tolist(), strict=True):
            tail[c] -= 1
            order[tail[c]] = x
        return
    symbol = narrow[before]
    by = symbol.argsort(kind="stable")
    symbol = symbol[by]
    lens = np.bincount(symbol, minlength=len(tail))
    order[(tail - 1 + lens.cumsum() - lens)[symbol] - steps[:len(before)]] = before[by]
    tail[:] -= lens


def _induce_scalar(text: np.ndarray, smaller: np.ndarray, size: int, seeds: np.ndarray) -> np.ndarray:
    n = len(text)
    count = np.bincount(text, minlength=size)
    ends = np.cumsum(count)
    begins = ends - count
    t, larger = text.tolist(), (~smaller).tolist()
    order = [-1] * n
    # seeds stand at the ends of their buckets, in the given order
    symbol = text[seeds]
    by = np.argsort(symbol, kind="stable")
    symbol, placed = symbol[by], seeds[by]
    place = ends[symbol] - (np.searchsorted(symbol, symbol, side="right") - np.arange(len(symbol)))
    for p, s in zip(place.tolist(), placed.tolist(), strict=True):
        order[p] = s
    head = begins.tolist()
    order[head[t[n - 1]]] = n - 1
    head[t[n - 1]] += 1
    for i in range(n):
        j = order[i] - 1
        if j >= 0 and larger[j]:
            c = t[j]
            h = head[c]
            order[h] = j
            head[c] = h + 1
    tail = ends.tolist()
    for i in range(n - 1, -1, -1):
        j = order[i] - 1
        if j >= 0 and not larger[j]:
            c = t[j]
            h = tail[c] - 1
            order[h] = j
            tail[c] = h
    return np.array(order, np.int64)


def common_prefixes(text: np.ndarray, order: np.ndarray, starts: np.ndarray, most: int) -> np.ndarray:
    """Permuted common prefixes: for every position, how many symbols (up to
    ``most``) its suffix shares with the one before it in ``order``.

    Positions are passed in text order, since a prefix is at most one shorter
    than that of the position before; the stretches that begin at ``starts``
    go side by side.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    out = np.zeros(n, np.int32)
    padded = np.r_[text, np.full(most + 1, -1, text.dtype)]
    padded[n:] -= np.arange(most + 1, dtype=text.dtype) % 2     # the end equals nothing
    ends = np.r_[starts[1:], n]
    by = np.argsort(starts - ends, kind="stable")               # longest first
    starts, lens = starts[by], (ends - starts)[by]
    have = np.zeros(len(starts), np.int64)
    live = len(starts)
    for step in range(int(lens.max(initial=0))):
        live = int(np.searchsorted(-lens[:live], -step, side="left"))
        at = starts[:live] + step
        other = before[at]
        h = np.maximum(have[:live] - 1, 0)
        h[other < 0] = 0
        go = np.flatnonzero((other >= 0) & (h < most))
        while len(go):
            same = padded[at[go] + h[go]] == padded[other[go] + h[go]]
            go = go[same]
            h[go] += 1
            go = go[h[go] < most]
        out[at] = h
        have[:live] = h
    return out
