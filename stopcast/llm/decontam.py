"""Benchmark decontamination by a BM25 index with block-max WAND.

The test items are the indexed side: an inverted index of their words, each
posting with its BM25 weight as a share of its item's own total, and the
largest weight in every BLOCK of item numbers.  Every document is cut into
overlapping passages twice as long as the longest item, so that an item that
stands in a text lies within one of them, and every passage is a query: all
items whose share reaches ``threshold`` are retrieved.  The block maxima bound
a passage's share in bulk; a passage that some block may lift to the threshold
walks the posting lists with WAND pivots, skipping blocks that cannot.  What
is retrieved is verified by word shingles of the question and words of the
answer.

Documents are map-only work.  The index is broadcast behind a check of the
items' size; beyond it, the items are cut into parts that are scanned in turn,
with document frequencies, mean and largest length of all items, so that scores
do not depend on the number of parts.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopcast.llm.common import give_back, stored, worker_state
from stopcast.llm.token_counts import batch_groups, text_groups

INDEX_BYTES = 4 << 20       # text of the items in one broadcast index, which takes some 25 bytes a byte in a worker
BLOCK = 4                   # items of a block
K1, B = 1.2, 0.75
THRESHOLD = 0.5             # share of an item's own BM25 total
SHINGLE, SIMILARITY = 5, 0.8
GROUP_BYTES = 1_000_000     # bytes of texts that a filtering task looks at together
CACHE_WORDS = 500_000
EDGES = re.compile(r"^[\W_]+|[\W_]+$")


def normal(word: str) -> str:
    return EDGES.sub("", word)


def words_of(text: str) -> list[str]:
    """Lower-case words without punctuation at their ends."""
    return [w for w in map(normal, text.lower().split()) if w]


def shingles(words: list[str]) -> set[tuple[str, ...]]:
    """Runs of SHINGLE words; the whole, if fewer."""
    return {tuple(words[i:i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))} if words else set()


@dataclass(frozen=True)
class Statistics:
    """What weights and passages of all items depend on: items, words an item, words of
    the longest, and in how many items each word (of a part) stands."""
    items: int
    mean: float
    longest: int
    df: dict[str, int]

    @classmethod
    def of(cls, items: list[tuple[int, list[str], list[str]]]) -> Statistics:
        lens = [len(q) + len(a) for _, q, a in items]
        return cls(len(items), sum(lens) / len(lens) if lens else 1.0, max(lens, default=1),
                   Counter(w for _, q, a in items for w in {*q, *a}))


class Index:
    """Inverted index of (item id, question words, answer words); ``known``: the
    statistics of all items, where these are a part of them."""

    def __init__(self, items: list[tuple[int, list[str], list[str]]], known: Statistics | None = None):
        items = [x for x in items if x[1] or x[2]]
        self.ids = [i for i, _, _ in items]
        self.questions, self.answers = [q for _, q, _ in items], [a for _, _, a in items]
        both = [q + a for _, q, a in items]
        lens = [len(w) for w in both]
        known = known or Statistics.of(items)
        df, mean, self.longest = known.df, known.mean, known.longest
        self.terms = {w: i for i, w in enumerate(sorted({w for ws in both for w in ws}))}
        weights = []
        for ws, n in zip(both, lens, strict=True):
            w = {t: math.log(1 + (known.items - df[t] + 0.5) / (df[t] + 0.5)) * c * (K1 + 1) / (c + K1 * (1 - B + B * n / mean))
                 for t, c in Counter(ws).items()}
            total = sum(w.values())
            weights.append({self.terms[t]: x / total for t, x in w.items()})
        self.postings: list[tuple[list[int], list[float]]] = [([], []) for _ in self.terms]
        for item, w in enumerate(weights):
            for t, x in w.items():
                self.postings[t][0].append(item)
                self.postings[t][1].append(x)
        self.most = [max(x) for _, x in self.postings]
        self.blocks = -(-len(items) // BLOCK)
        self.block_most: list[dict[int, float]] = []
        self.block_from: list[dict[int, tuple[int, int]]] = []      # block -> stretch of the posting list
        for at, x in self.postings:
            top: dict[int, float] = {}
            stretch: dict[int, tuple[int, int]] = {}
            for k, (i, v) in enumerate(zip(at, x, strict=True)):
                b = i // BLOCK
                top[b] = max(top.get(b, 0.0), v)
                stretch[b] = (stretch.get(b, (k,))[0], k + 1)
            self.block_most.append(top)
            self.block_from.append(stretch)
        self.first = np.cumsum([0, *map(len, self.block_most)])
        self.flat_block = np.array([b for t in self.block_most for b in t], np.int64)
        self.flat_most = np.array([v for t in self.block_most for v in t.values()])
        self.stride = max(SHINGLE, math.ceil(1.25 * self.longest))
        self.name = uuid.uuid4().hex

    def numbers(self, tokens: list[str]) -> np.ndarray:
        """Term of each raw token: -1 none, -2 no word at all."""
        cache = worker_state(("decontam", self.name), dict)
        new = set(tokens).difference(cache)
        if len(cache) + len(new) > CACHE_WORDS:
            cache.clear()
            new = set(tokens)
        for t in new:
            w = normal(t)
            cache[t] = self.terms.get(w, -1) if w else -2
        return np.fromiter(map(cache.__getitem__, tokens), np.int64, len(tokens))

    def search(self, terms: list[int], threshold: float, blocks: list[int] | None = None) -> list[tuple[int, float]]:
        """Items (of ``blocks``, if given) whose weights for ``terms`` add up
        to ``threshold``, by block-max WAND over the terms' posting lists."""
        if blocks is None:
            return self._wand([[*self.postings[t], 0, self.most[t], self.block_most[t]] for t in terms], threshold)
        found = []
        for b in blocks:
            lists = []
            for t in terms:
                if stretch := self.block_from[t].get(b):
                    items, weights = self.postings[t]
                    lists.append([items[stretch[0]:stretch[1]], weights[stretch[0]:stretch[1]], 0, self.block_most[t][b],
                                  self.block_most[t]])
            found += self._wand(lists, threshold)
        return found

    def _wand(self, lists: list[list], threshold: float) -> list[tuple[int, float]]:
        found = []
        while lists:
            lists.sort(key=lambda x: x[0][x[2]])
            bound, pivot = 0.0, -1
            for i, x in enumerate(lists):
                bound += x[3]
                if bound >= threshold:
                    pivot = i
                    break
            if pivot < 0:
                break
            item = lists[pivot][0][lists[pivot][2]]
            while pivot + 1 < len(lists) and lists[pivot + 1][0][lists[pivot + 1][2]] == item:
                pivot += 1
            block = item // BLOCK
            if sum(x[4].get(block, 0.0) for x in lists[:pivot + 1]) < threshold:
                # lists after the pivot may begin in this block: stop before them
                to = (block + 1) * BLOCK
                if pivot + 1 < len(lists):
                    to = min(to, max(item + 1, lists[pivot + 1][0][lists[pivot + 1][2]]))
            elif lists[0][0][lists[0][2]] == item:
                score = sum(x[1][x[2]] for x in lists[:pivot + 1])
                if score >= threshold:
                    found.append((item, score))
                to = item + 1
            else:
                to = item
            for x in lists[:pivot + 1]:
                while x[2] < len(x[0]) and x[0][x[2]] < to:
                    x[2] += 1
            lists = [x for x in lists if x[2] < len(x[0])]
        return found

    def candidates(self, texts: list[list[str]], threshold: float) -> Iterator[tuple[int, int, list[int], list[int]]]:
        """(text, first word, terms, blocks) of the passages that the maxima of
        some blocks allow to reach the threshold."""
        numbers = [self.numbers(t) for t in texts]
        numbers = [n[n > -2] for n in numbers]
        cuts = [max(1, -(-len(n) // self.stride)) for n in numbers]
        base = np.cumsum([0, *cuts])
        term = np.concatenate(numbers) if numbers else np.zeros(0, np.int64)
        chunk = np.concatenate([np.arange(len(n)) // self.stride + b for n, b in zip(numbers, base, strict=False)]) \
            if numbers else np.zeros(0, np.int64)
        inner = np.ones(int(base[-1]), bool)
        inner[base[:-1]] = False            # chunks that continue a text
        known = term >= 0
        term, chunk = term[known], chunk[known]
        width = max(1, len(self.terms))
        again = inner[chunk]                # a passage is a chunk and the next
        pair = np.unique(np.concatenate([chunk * width + term, (chunk[again] - 1) * width + term[again]]))
        passage, term = pair // width, pair % width
        n = self.first[term + 1] - self.first[term]
        step = max(1, 4_000_000 // max(1, self.blocks))
        owner = np.repeat(np.arange(len(texts)), cuts)
        for a in range(0, int(base[-1]), step):
            lo, hi = np.searchsorted(passage, [a, a + step])
            size = n[lo:hi]
            at = np.repeat(self.first[term[lo:hi]] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
            key = np.repeat(passage[lo:hi] - a, size) * self.blocks + self.flat_block[at]
            count = min(step, int(base[-1]) - a)
            bound = np.bincount(key, self.flat_most[at], count * self.blocks).reshape(count, -1)
            row, block = np.nonzero(bound >= threshold - 1e-9)
            which, start = np.unique(row, return_index=True)
            low, high = np.searchsorted(passage, [which + a, which + a + 1])
            stop = np.r_[start, len(row)][1:]
            for p, i, j, b, e in zip((which + a).tolist(), start.tolist(), stop.tolist(), low.tolist(), high.tolist(),
                                     strict=True):
                yield int(owner[p]), int(p - base[owner[p]]) * self.stride, term[b:e].tolist(), block[i:j].tolist()

    def verify(self, words: list[str], at: int, item: int) -> tuple[float, float, bool]:
        """Shares of the question's shingles and of the answer's words in the
        passage at ``at`` and its neighbourhood, and whether both suffice:
        SIMILARITY each, where one answer word may always differ."""
        some = words[max(0, at - self.longest):at + 2 * self.stride + self.longest]
        asked, answer = shingles(self.questions[item]), Counter(self.answers[item])
        short = len(self.questions[item])
        here = shingles(some) if short >= SHINGLE else {tuple(some[i:i + short]) for i in range(len(some) - short + 1)}
        q = len(asked & here) / len(asked) if asked else 1.0
        have, n = (answer & Counter(some)).total(), answer.total()
        a = have / n if n else 1.0
        return q, a, q >= SIMILARITY and n - have <= max(1.0 if n > 1 else 0.0, (1 - SIMILARITY) * n)

    def hits(self, texts: list[str], threshold: float) -> list[dict[int, tuple[float, float, float, int]]]:
        """For each text: item -> (score, question share, answer share, word)."""
        out: list[dict[int, tuple[float, float, float, int]]] = [{} for _ in texts]
        if not self.ids:
            return out
        raw = [t.lower().split() for t in texts]
        words: dict[int, list[str]] = {}
        for text, at, terms, blocks in self.candidates(raw, threshold):
            for item, score in self.search(terms, threshold, blocks):
                if text not in words:
                    words[text] = [w for w in map(normal, raw[text]) if w]
                q, a, both = self.verify(words[text], at, item)
                if both and score > out[text].get(item, (0.0,))[0]:
                    out[text][item] = (score, q, a, at)
        return out


def split_item(text: str) -> tuple[list[str], list[str]]:
    """Question and answer of an item without fields for them: the last
    quarter of its words counts as the answer."""
    words = words_of(text)
    cut = len(words) - len(words) // 4
    return words[:cut], words[cut:]


def indexes(items: DataFrame, id_col: str = "item_id", text_col: str = "text", question_col: str | None = None,
            answer_col: str | None = None) -> list[Index]:
    """Indexes of the items, each of at most about INDEX_BYTES of text.

    Rows without id or words are left out and repeated rows count once; an
    empty table gives no index.
    """
    text = [c for c in (question_col, answer_col) if c] or [text_col]
    rows = items.select(items[id_col].cast("bigint").alias("id"),
                        *[F.coalesce(items[c].cast("string"), F.lit("")).alias(f"t{i}") for i, c in enumerate(text)]) \
        .where("id is not null").distinct()
    size = F.lit(0)
    for i in range(len(text)):
        size = size + F.octet_length(f"t{i}")
    total = rows.agg(F.sum(size)).first()[0] or 0
    parts = max(1, math.ceil(total / INDEX_BYTES))

    def split(r) -> tuple[int, list[str], list[str]]:
        if not question_col and not answer_col:
            return (r[0], *split_item(r[1]))
        return r[0], words_of(r[1]), words_of(r[2]) if len(r) > 2 else []

    if parts == 1:
        index = Index([split(r) for r in sorted(tuple(r) for r in rows.collect())])
        return [index] if index.ids else []

    # the statistics of all items, once, in Spark: weights and passages are then alike in every number of parts
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, word, longest = [], [], []
            for p, *r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                _, q, a = split(r)
                for w in {*q, *a}:
                    part.append(p)
                    word.append(w)
                    longest.append(0)
                if q or a:          # one row an item without a word: its length
                    part.append(p)
                    word.append(None)
                    longest.append(len(q) + len(a))
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(word, pa.string()), pa.array(longest, pa.int64())],
                                             names=["part", "word", "words"])

    rows = stored(rows.select(F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("part"), "*"), "items")
    words = stored(rows.mapInArrow(cut, "part int, word string, words bigint"), "item-words")
    n, mean, longest = words.where("word is null").agg(F.count("*"), F.avg("words"), F.max("words")).first()
    df = stored(words.where("word is not null").groupBy("word").agg(F.count("*").alias("df")), "item-df")
    out = []
    for p in range(parts):
        own = words.where((F.col("part") == p) & F.col("word").isNotNull()).select("word").distinct()
        known = Statistics(n, mean or 1.0, longest or 1, {r["word"]: r["df"] for r in own.join(df, "word").collect()})
        some = sorted(tuple(r)[1:] for r in rows.where(F.col("part") == p).collect())
        out.append(Index([split(r) for r in some], known))
    return [x for x in out if x.ids]


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id",
                 text_col: str = "text", **columns: str) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap, at_word): the
    test items that stand in each document, each with its best passage.

    Only the two named columns of ``docs`` are read (see ``indexes`` for the
    items').  Null and empty texts have no hits; repeated rows give repeated
    rows; a null doc_id stays null; without documents or items the result is
    empty.
    """
    rows = docs.select(docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    out = None
    schema = ("doc_id bigint, item_id bigint, score double, question_overlap double, answer_overlap double, "
              "at_word bigint")
    for index in indexes(items, **columns):
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = sent.value
            for batch in batches:
                ids, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
                found: list[tuple] = []
                for s in text_groups(texts, 4_000_000):
                    for doc, hits in zip(ids[s], index.hits(texts[s], threshold), strict=True):
                        found += [(doc, index.ids[i], *h) for i, h in sorted(hits.items())]
                columns = list(zip(*found, strict=True)) or [()] * 6
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                                 names=["doc_id", "item_id", "score", "question_overlap", "answer_overlap", "at_word"])

        part = rows.mapInArrow(run, schema)
        out = part if out is None else out.union(part)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def without_contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, text_col: str = "text",
                         **columns: str) -> DataFrame:
    """Rows of ``docs``, all columns, in which no test item stands."""
    at = docs.columns.index(text_col)
    for i, index in enumerate(indexes(items, **columns)):
        if i:       # one index at a time: a chain of them would share the workers' memory
            docs = stored(docs, "kept")
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep: list[bool] = []
                for part in batch_groups(batch.select([at]), 0, GROUP_BYTES):
                    keep += [not h for h in sent.value.hits([t or "" for t in part.column(0).to_pylist()], threshold)]
                yield batch.filter(pa.array(keep, pa.bool_()))
                give_back()

        docs = docs.mapInArrow(run, docs.schema)
    return docs
