"""Texts as sequences of coded units between spaces, in Arrow and numpy."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: White space by any of the libraries' notions of it.
WHITE = r"\s\x1c-\x1f\x85\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
ODD = f" ([{WHITE}]|$)"
#: A space that something other than white space follows.
CUT = regex.compile(r" (?=[^\s\x1c-\x1f\x85])")


@dataclass
class Units:
    """Row i of the texts is the units ``codes[offsets[i]:offsets[i + 1]]``;
    joined, they are the text."""

    units: list[str]
    codes: np.ndarray
    offsets: np.ndarray


def cut_text(text: str) -> list[str]:
    """``text`` cut before each space that something but white space follows."""
    first, *rest = CUT.split(text)
    return [first, *[" " + p for p in rest]]


def coded_units(texts: list[str]) -> Units:
    """Cut all texts and number their distinct units.

    Where every space of a text is followed by something else than white
    space, the cut is a plain split; other texts are cut one by one."""
    column = pa.array(texts, pa.large_string())
    odd = np.flatnonzero(pc.match_substring_regex(column, ODD).to_numpy(zero_copy_only=False))
    apart = [cut_text(texts[i]) for i in odd.tolist()]
    if len(odd):
        usual = np.ones(len(texts), bool)
        usual[odd] = False
        column = pc.if_else(pa.array(usual), column, "")
    words = pc.split_pattern(column, " ")
    offsets = words.offsets.to_numpy().astype(np.int64)
    flat = words.flatten().dictionary_encode()
    units = [" " + w for w in flat.dictionary.to_pylist()]
    codes = flat.indices.to_numpy().astype(np.int64)
    # the first unit of a text has no space before it
    heads = offsets[:-1]
    first = [units[c][1:] for c in codes[heads].tolist()]
    codes[heads] = len(units) + np.arange(len(first))
    units += first
    if len(odd):
        known: dict[str, int] = {}
        more = [np.array([known.setdefault(u, len(units) + len(known)) for u in us], np.int64) for us in apart]
        units += known
        pieces, at = [], 0
        for i, m in zip(odd.tolist(), more, strict=True):
            pieces += [codes[at:offsets[i]], m]
            at = offsets[i + 1]
        codes = np.concatenate([*pieces, codes[at:]])
        sizes = np.diff(offsets)
        sizes[odd] = [len(m) for m in more]
        offsets = np.r_[0, np.cumsum(sizes)]
    return Units(units, codes, offsets)


class Rows:
    """Growing rows of varying length in one flat array."""

    def __init__(self, kind: type):
        self.flat, self.used = np.zeros(1 << 12, kind), 0
        self.starts, self.lens = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, flat: np.ndarray, lens: np.ndarray) -> None:
        need = self.used + len(flat)
        if need > len(self.flat):
            grown = np.zeros(max(need, 2 * len(self.flat)), self.flat.dtype)
            grown[:self.used] = self.flat[:self.used]
            self.flat = grown
        self.flat[self.used:need] = flat
        self.starts = np.concatenate([self.starts, self.used + np.cumsum(lens) - lens])
        self.lens = np.concatenate([self.lens, lens])
        self.used = need

    def gather(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The given rows one after another, and where each begins (with the end)."""
        size = self.lens[rows]
        ends = np.cumsum(size)
        at = np.repeat(self.starts[rows] - ends + size, size)
        at += np.arange(len(at))
        return self.flat[at], np.r_[0, ends]


#: Words to their values: flat arrays and the lengths, one pair a kind of value.
Encode = Callable[[list[str]], list[tuple[np.ndarray, np.ndarray]]]


class Store:
    """Values of strings, in the order in which they became known."""

    def __init__(self, kinds: list[type]):
        self.number: dict[str, int] = {}
        self.rows = [Rows(k) for k in kinds]

    def find(self, keys: Iterable[str], n: int) -> np.ndarray:
        return np.fromiter(map(self.number.get, keys, repeat(-1)), np.int64, n)

    def add(self, keys: list[str], values: list[tuple[np.ndarray, np.ndarray]]) -> None:
        self.number.update(zip(keys, range(len(self.number), len(self.number) + len(keys)), strict=True))
        for r, v in zip(self.rows, values, strict=True):
            r.add(*v)


class UnitCoder:
    """Values of whole texts, put together from those of their units, and
    these from those of their pre-tokens (matches of ``pattern``, which must
    take letters, with the space before them, as one); each is worked out
    once, while the caches hold ``most`` of it."""

    def __init__(self, pattern: str, encode: Encode, kinds: list[type], most: int):
        self.split, self.encode, self.kinds, self.most = regex.compile(pattern).findall, encode, kinds, most
        self.units, self.words = Store(kinds), Store(kinds)

    def learn(self, units: list[str]) -> None:
        split = self.split
        cut = [[u] if u[1:].isalpha() and (u[0] == " " or u[0].isalpha()) else split(u) for u in units]
        size = np.fromiter(map(len, cut), np.int64, len(cut))
        flat = pa.array(chain.from_iterable(cut), pa.large_string()).dictionary_encode()
        words = flat.dictionary.to_pylist()
        if len(self.words.number) > self.most:
            self.words = Store(self.kinds)
        at = self.words.find(words, len(words))
        new = np.flatnonzero(at < 0)
        if len(new):
            at[new] = len(self.words.number) + np.arange(len(new))
            some = [words[i] for i in new.tolist()]
            self.words.add(some, self.encode(some))
        at = at[flat.indices.to_numpy()]
        ends = np.r_[0, np.cumsum(size)]
        values = []
        for r in self.words.rows:
            got, starts = r.gather(at)
            values.append((got, np.diff(starts[ends])))
        self.units.add(units, values)

    def __call__(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each kind of value: those of all texts in one array, and where
        each text's begin (with the end)."""
        got = coded_units(texts)
        at = self.units.find(got.units, len(got.units))
        new = np.flatnonzero(at < 0)
        if len(self.units.number) + len(new) > self.most:
            self.units = Store(self.kinds)
            new = np.arange(len(at))
        if len(new):
            some = [got.units[i] for i in new.tolist()]
            self.learn(list(dict.fromkeys(some)))
            at[new] = self.units.find(some, len(some))
        rows = at[got.codes]
        out = []
        for r in self.units.rows:
            flat, starts = r.gather(rows)
            out.append((flat, starts[got.offsets]))
        return out
