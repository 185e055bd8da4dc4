"""SimHash near-duplicates with BK-trees.

A document's fingerprint is the bitwise majority of the XXH64 values (seed 42)
of its word shingles.  Fingerprints within ``radius`` bits link, and documents
that links join form a class.

The search is sharded so that no tree grows with the corpus: a fingerprint is
cut into ``radius + EQUAL`` blocks of bits, and two fingerprints within the
radius agree on at least EQUAL of them, so each pair meets in the shard of
some choice of EQUAL blocks and their value.  A shard's fingerprints form a
BK-tree, whose children are keyed by their Hamming distance to the parent, and
each looks up its neighbours by following only the edges within the radius.
All trees together grow with the corpus, so they are not broadcast whole: each
goes to the one task whose fingerprints can match in it.  Shards of more than
HOT fingerprints are cut again by blocks of the bits they don't share.

Equal fingerprints are one node from the start.  A shard passes on at most one
link a fingerprint (to the smallest one that its links reach), which keeps the
classes exact without listing the pairs of a group.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from stopcast.llm.common import components, no_state, stored

EQUAL = 2       # blocks that a shard's fingerprints share
HOT = 2000      # fingerprints of a shard above which it is cut again


def shingle_hashes(text: str, words: int) -> np.ndarray:
    """XXH64 of every run of ``words`` words (of all words, if fewer)."""
    tokens = text.encode().lower().split()      # A-Z; space and U+0009 to U+000D
    if not tokens:
        return np.zeros(0, np.uint64)
    flat = b" ".join(tokens)
    if len(tokens) <= words:
        return np.array([xxh64_intdigest(flat, 42)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.r_[0, ends[:-words] + 1].tolist()
    return np.array([xxh64_intdigest(flat[a:b], 42) for a, b in zip(starts, ends[words - 1:].tolist(), strict=True)],
                    np.uint64)


def majority(hashes: np.ndarray) -> int:
    """Bits set in over half the values; zero for none."""
    ones = np.zeros(64, np.int64)
    for a in range(0, len(hashes), 1 << 16):
        part = hashes[a:a + (1 << 16)].astype("<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0]) if len(hashes) else 0


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, print bigint): one row per document, in its own partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        no_state()
        for batch in batches:
            got = np.array([majority(shingle_hashes(t, words)) if t else 0 for t in batch.column(1).to_pylist()],
                           np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got.view(np.int64))], names=["doc_id", "print"])

    return docs.select(docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].cast("string").alias("text")) \
        .mapInArrow(run, "doc_id bigint, print bigint")


def blocks(bits: list[int], parts: int) -> list[int]:
    """Masks that deal the given bit positions to ``parts`` blocks."""
    cut = [round(i * len(bits) / parts) for i in range(parts + 1)]
    return [sum(1 << b for b in bits[i:j]) for i, j in zip(cut, cut[1:], strict=False)]


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


class BKTree:
    """Integers by Hamming distance; children keyed by distance to the parent."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        self.values.append(value)
        self.children.append({})
        at, new = 0, len(self.values) - 1
        while at != new:
            at = self.children[at].setdefault((self.values[at] ^ value).bit_count(), new)

    def within(self, value: int, radius: int) -> list[int]:
        """Nodes at most ``radius`` from ``value``."""
        found, todo = [], [0] if self.values else []
        while todo:
            at = todo.pop()
            d = (self.values[at] ^ value).bit_count()
            if d <= radius:
                found.append(at)
            todo += [c for e, c in self.children[at].items() if d - radius <= e <= d + radius]
        return found


def shard_links(values: list[int], nodes: list[int], radius: int) -> list[tuple[int, int]]:
    """A link from every node to the smallest that the shard's links reach."""
    root = list(range(len(values)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    tree = BKTree()
    for i, v in enumerate(values):
        for j in tree.within(v, radius):
            a, b = find(i), find(j)
            if a != b:
                low, high = (a, b) if nodes[a] < nodes[b] else (b, a)
                root[high] = low
        tree.add(v)
    return [(nodes[i], nodes[find(i)]) for i in range(len(values)) if find(i) != i]


def links(prints: DataFrame, radius: int = 3) -> DataFrame:
    """(a, b): links that join all fingerprints within ``radius`` bits.

    ``prints``: (print, node), one row per distinct fingerprint.
    """
    first = blocks(list(range(64)), radius + EQUAL)
    masks = [sum(c) for c in combinations(first, EQUAL)]
    keyed = prints.select("print", "node", F.explode(F.array(*[
        F.struct(F.lit(i).alias("cut"), F.col("print").bitwiseAND(F.lit(signed(m))).alias("value"))
        for i, m in enumerate(masks)])).alias("shard")).select("print", "node", "shard.cut", "shard.value")
    hot = keyed.groupBy("cut", "value").count().where(F.col("count") > HOT).select("cut", "value")
    light = keyed.join(hot, ["cut", "value"], "left_anti").select(F.xxhash64("cut", "value").alias("shard"), "print", "node")
    again = []
    for i, m in enumerate(masks):
        rest = blocks([b for b in range(64) if not m >> b & 1], radius + EQUAL)
        again.append(F.when(F.col("cut") == i, F.array(*[
            F.xxhash64(F.lit(j), "cut", "value", F.col("print").bitwiseAND(F.lit(signed(sum(c)))))
            for j, c in enumerate(combinations(rest, EQUAL))])))
    heavy = keyed.join(hot, ["cut", "value"]).select(F.explode(F.coalesce(*again)).alias("shard"), "print", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, values, nodes = None, [], []

        def flush() -> list[tuple[int, int]]:
            return shard_links(values, nodes, radius) if len(values) > 1 else []

        for batch in batches:
            found = []
            for s, v, n in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if s != last:
                    found += flush()
                    last, values, nodes = s, [], []
                values.append(v & 0xFFFFFFFFFFFFFFFF)
                nodes.append(n)
            yield pair_batch(found)
        yield pair_batch(flush())

    return light.union(heavy).repartition("shard").sortWithinPartitions("shard").mapInArrow(run, "a bigint, b bigint")


def pair_batch(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*pairs, strict=True) if pairs else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 3,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    component_id is the smallest doc_id that links reach, itself included.
    Only the two named columns are read.  Null and wordless texts have the
    fingerprint zero, which links like any other; repeated rows give repeated
    results; a row without an id gets the class that rows with ids have at its
    fingerprint (null if none) and links nothing itself; an empty table gives
    an empty result.
    """
    prints = stored(fingerprints(docs, words, id_col, text_col), "fingerprints")
    nodes = stored(prints.where("doc_id is not null").groupBy("print").agg(F.min("doc_id").alias("node")), "nodes")
    roots = components(stored(links(nodes, radius), "links"))
    classes = nodes.join(roots, "node", "left").select("print", F.coalesce("root", "node").alias("component_id"))
    return prints.join(classes, "print", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, words: int = 3, radius: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs``, all columns, one of each class: that with the smallest
    id (rows without an id last, equal ids as they are read).

    Every row takes part, with or without an id, and repeated rows are copies
    like others.  Rows are numbered and written once: how a scan is cut depends on
    the cores at hand, so numbers given anew in every job could differ.
    """
    row = "row of the table"
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    classes = near_duplicates(rows, words, radius, row, text_col).select(F.col("doc_id").alias(row), "component_id")
    order = F.struct(F.col(id_col).isNull(), F.col(id_col), F.col(row))
    kept = classes.join(rows.select(id_col, row), row).groupBy("component_id").agg(F.min(order).alias("first")) \
        .select(F.col("first").getField(row).alias(row))
    # one plan at every size: the kept rows grow with the corpus, so they are never broadcast
    return rows.join(stored(kept, "kept").hint("merge"), row, "left_semi").drop(row)
