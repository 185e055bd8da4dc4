"""Token counts: rank-synchronous merging of ragged numpy arrays.

Every text is cut into pre-tokens as the vocabulary file's own normalizer and
split rule say; the pre-tokens of a batch are held as one flat array of symbol
ids with row boundaries, and all rows advance together: in each round every
row finds its lowest-rank adjacent pair and replaces that pair wherever it
occurs in the row (leftmost first, no overlap).  What remains when no row has
a mergeable pair is counted.

The work is one pass over the documents inside their input partitions (no
shuffle).  A text is first cut at plain spaces: neither the normalizer nor the
split rule of a "white space dropped" vocabulary reaches across one, so the
units between spaces are counted once per worker and reused.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from stopcast.llm.common import worker_state

SCHEMA = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"
CACHE_UNITS = 400_000          # units kept by a worker; the cache is emptied beyond
CHUNK_SYMBOLS = 2_000_000      # symbols merged at once


def _byte_chars() -> list[str]:
    """Byte value -> character of byte-level vocabularies: printable bytes
    stand for themselves, the others for the characters from U+0100 on."""
    keep = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in keep else chr(next(spare)) for b in range(256)]


class RaggedBPE:
    """Merge table of a BPE vocabulary file and its rank-synchronous merger."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"] or pre[0]["behavior"] != "Removed" or not pre[0]["invert"]:
            raise ValueError(f"{path}: not a vocabulary with dropped white space and lower case")
        self.split = regex.compile(pre[0]["pattern"]["Regex"])
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True))))
        vocab = model["vocab"]
        end = model["end_of_word_suffix"] or ""
        chars = _byte_chars()
        self.inner = np.array([vocab[c] for c in chars], np.int64)
        self.last = np.array([vocab[c + end] for c in chars], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        key = left << 32 | right
        order = np.argsort(key, kind="stable")
        self.key, self.rank, self.made_by_rank = key[order], order, made
        self.none = len(pairs)

    def ranks(self, pair: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.key, pair)
        at[at == len(self.key)] = 0
        return np.where(self.key[at] == pair, self.rank[at], self.none)

    def count(self, words: list[bytes]) -> np.ndarray:
        """Symbols left of each (non-empty) word."""
        out = np.zeros(len(words), np.int64)
        lens = np.fromiter(map(len, words), np.int64, len(words))
        cut = np.flatnonzero(np.diff(np.cumsum(lens) // CHUNK_SYMBOLS)) + 1
        for a, b in zip([0, *cut], [*cut, len(words)], strict=True):
            if b > a:
                out[a:b] = self._count(words[a:b], lens[a:b])
        return out

    def _count(self, words: list[bytes], lens: np.ndarray) -> np.ndarray:
        raw = np.frombuffer(b"".join(words), np.uint8)
        sym = self.inner[raw]
        ends = np.cumsum(lens)
        sym[ends - 1] = self.last[raw[ends - 1]]
        ids = np.arange(len(words))
        left = np.zeros(len(words), np.int64)
        row = np.repeat(np.arange(len(words)), lens)
        while len(sym):
            rank = np.full(len(sym), self.none)
            same = row[1:] == row[:-1]
            rank[:-1][same] = self.ranks(sym[:-1][same] << 32 | sym[1:][same])
            start = np.flatnonzero(np.r_[True, ~same])
            low = np.minimum.reduceat(rank, start)
            n = np.diff(np.r_[start, len(sym)])
            live = low < self.none
            left[ids[~live]] = n[~live]
            hit = (rank == np.repeat(low, n)) & (rank < self.none)
            at = np.flatnonzero(hit)
            if not len(at):
                break
            # a run of overlapping hits (aaaa) merges its 1st, 3rd, 5th ... pair
            head = np.r_[True, np.diff(at) > 1]
            nth = np.arange(len(at)) - np.maximum.accumulate(np.where(head, np.arange(len(at)), 0))
            at = at[nth % 2 == 0]
            sym[at] = self.made_by_rank[rank[at]]
            keep = np.repeat(live, n)
            keep[at + 1] = False
            renumber = np.cumsum(live) - 1
            sym, row, ids = sym[keep], renumber[row[keep]], ids[live]
        return left

    def pieces(self, unit: str) -> tuple[list[bytes], int]:
        """Pre-tokens of a unit, and the special tokens in it."""
        found, special = [], 0
        for k, part in enumerate(self.special.split(unit)):
            special += k > 0
            # character by character, as the library lowers (no final sigma)
            text = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
            found += [p.encode() for p in self.split.findall(text)]
        return found, special


class Counter:
    """Token counts of whole texts, with caches of units and pre-tokens."""

    def __init__(self, path: str):
        self.bpe = RaggedBPE(path)
        self.units: dict[str, int] = {}

    def learn(self, units: set[str]) -> None:
        cut = {u: self.bpe.pieces(u) for u in units}
        words = list({p for ps, _ in cut.values() for p in ps})
        n = dict(zip(words, self.bpe.count(words).tolist(), strict=True))
        self.units.update((u, sum(map(n.__getitem__, ps)) + s) for u, (ps, s) in cut.items())

    def __call__(self, texts: list[str]) -> list[int]:
        cut = [t.split(" ") for t in texts]
        new = set().union(*cut).difference(self.units)
        if len(self.units) + len(new) > CACHE_UNITS:
            self.units.clear()
            new = set().union(*cut)
        self.learn(new)
        return [sum(map(self.units.__getitem__, c)) for c in cut]


def text_groups(texts: list[str], most: int = 8_000_000) -> Iterator[slice]:
    """Slices of a batch that hold about ``most`` characters, or one text."""
    a = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield slice(a, i)
            a, size = i, 0
        size += len(t)
    if a < len(texts):
        yield slice(a, len(texts))


def batch_groups(batch: pa.RecordBatch, text: int, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch that hold about ``most`` bytes of text, or one row."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    a = 0
    while a < len(size):
        b = max(a + 1, int(np.searchsorted(size, (size[a - 1] if a else 0) + most, side="right")))
        yield batch.slice(a, b - a)
        a = b


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 2048,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of ``docs``.

    ``vocabulary`` is the path of a tokenizer file that every executor can
    open (installed with the environment).  Only the two named columns are
    read; others are ignored whatever their names.  A null text counts as
    empty (0 bytes, 0 tokens); repeated rows give repeated results; a null id
    stays null; an empty table gives an empty result.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = worker_state(("token_counts", vocabulary), lambda: Counter(vocabulary))
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            n: list[int] = []
            for s in text_groups(texts):
                n += counter(texts[s])
            size = [len(t.encode()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(size, pa.int64()), pa.array(n, pa.int64()),
                 pa.array([x > limit for x in n], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].cast("string").alias("text")) \
        .mapInArrow(run, SCHEMA)
