"""Exact substring deduplication by sharded suffix arrays.

A byte goes if it lies in a string of WIDTH bytes that also starts earlier in
the corpus.  Two equal strings must meet in one shard, so the strings (windows)
of a text are dealt by content: a window's anchor is the run of ANCHOR bytes in
it with the smallest hash, equal windows have equal anchors, and neighbouring
windows with one anchor form a segment of at most 168 bytes.  Anchors that
occur once in the corpus end the matter for their windows.  Equal segments are
one row from the start (the copy that comes first stands for them).  Segments
that share an anchor without being equal go to the anchor's shard, where a
suffix array by induced sorting brings equal windows together and the permuted
common prefixes tell where they end.

An anchor of more than HOT segments (a common line between differing text) has
no shard: its windows are segments of their own, dealt by the hash of all their
bytes, so that no task gets more than the equal ones, once a file.

Texts are written once, as compressed files of about FILE_BYTES in the shared
folder, and are read from there by the tasks that need their bytes; shuffles
carry hashes, places and the segments of shared anchors.  All stages are deal
by hash of anchor or by file; a passage that a third of all documents share is
one row a file before it is shuffled.
"""

from __future__ import annotations

import hashlib
import math
import posixpath
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopcast.llm.common import shared_folder, stored
from stopcast.llm.suffix_array import common_prefixes, suffix_array

WIDTH, ANCHOR = 100, 32
FILE_BYTES = 12_000_000     # text of a file
FLAT = 1 << 18              # bytes hashed at once
SORTED = 4_000_000          # symbols of one suffix array
HOT = 20_000                # segments of an anchor beyond which its windows are dealt singly
PLACE = 24                  # bits of a position in the comparison of anchors
MIX = np.uint64(0xBF58476D1CE4E5B9)
STEP = np.uint64(0x9E3779B97F4A7C15)

SEGMENT = np.dtype([("hash", "<u8"), ("digest", "<u8"), ("id_null", "?"), ("doc_id", "<i8"), ("row", "<i8"), ("doc", "<u4"),
                    ("start", "<u4"), ("size", "<u2")])
SPAN = np.dtype([("doc", "<u4"), ("start", "<u4"), ("end", "<u4")])


def pack(*arrays: np.ndarray, level: int = 1) -> bytes:
    raw = b"".join(len(a.tobytes()).to_bytes(8, "little") + a.tobytes() for a in arrays)
    return zstandard.ZstdCompressor(level=level).compress(raw)


def unpack(blob: bytes, *kinds) -> list[np.ndarray]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(blob), 0, []
    for k in kinds:
        n = int.from_bytes(raw[at:at + 8], "little")
        out.append(np.frombuffer(raw, k, n // np.dtype(k).itemsize, at + 8))
        at += 8 + n
    return out


# ------------------------------------------------------------ text files

class TextFile:
    """The whole texts of some documents, one after another."""

    def __init__(self, text: bytes, ends: np.ndarray, id_null: np.ndarray, doc_id: np.ndarray, row: np.ndarray):
        self.text, self.ends, self.id_null, self.doc_id, self.row = text, ends, id_null, doc_id, row
        self.starts = np.r_[0, ends[:-1]].astype(np.int64)

    def save(self, system: pafs.FileSystem, path: str) -> None:
        with system.open_output_stream(path, compression=None) as f:
            f.write(pack(np.frombuffer(self.text, np.uint8), self.ends, self.id_null, self.doc_id, self.row))

    @classmethod
    def load(cls, system: pafs.FileSystem, path: str) -> TextFile:
        with system.open_input_file(path) as f:
            text, *rest = unpack(f.read(), np.uint8, "<i8", "?", "<i8", "<i8")
        return cls(text.tobytes(), *rest)

    def segments(self, hot: np.ndarray | None = None) -> np.ndarray:
        """All segments, in text order; those of ``hot`` (sorted) anchors a window each."""
        flat = np.frombuffer(self.text, np.uint8)
        found = []
        doc, n = 0, len(self.ends)
        while doc < n:
            last = doc + 1
            while last < n and self.ends[last] - self.starts[doc] <= FLAT:
                last += 1
            a, b = int(self.starts[doc]), int(self.ends[last - 1])
            for at in range(a, max(a + 1, b - WIDTH + 1), FLAT):      # more than one only in a text longer than FLAT
                to = min(b, at + FLAT + WIDTH - 1)
                found.append(self._segments(flat[at:to], at, doc, last, hot))
            doc = last
        return np.concatenate(found) if found else np.zeros(0, SEGMENT)

    def _segments(self, flat: np.ndarray, at: int, first: int, last: int, hot: np.ndarray | None) -> np.ndarray:
        if len(flat) < WIDTH:
            return np.zeros(0, SEGMENT)
        grams = gram_hashes(flat)
        anchors = scramble(grams[ANCHOR])
        low = np.uint64((1 << PLACE) - 1)
        best = sliding_min(anchors & ~low | np.arange(len(anchors), dtype=np.uint64), WIDTH - ANCHOR + 1)
        anchor = (best & low).astype(np.int64)
        # windows that lie in one document
        turn = np.zeros(len(flat) + 1, np.int8)
        starts = np.maximum(self.starts[first:last] - at, 0)
        ends = np.minimum(self.ends[first:last] - at, len(flat))
        big = ends - starts >= WIDTH
        np.add.at(turn, starts[big], 1)
        np.add.at(turn, ends[big] - WIDTH + 1, -1)
        place = np.flatnonzero(np.cumsum(turn[:len(anchor)], dtype=np.int8))
        if not len(place):
            return np.zeros(0, SEGMENT)
        anchor = anchor[place]
        turn = np.r_[True, (anchor[1:] != anchor[:-1]) | (place[1:] != place[:-1] + 1)]
        new = np.flatnonzero(turn if hot is None else turn | among(anchors[anchor], hot))
        a = place[new]
        b = place[np.r_[new[1:], len(place)] - 1] + WIDTH
        out = np.zeros(len(a), SEGMENT)
        out["hash"], out["size"] = anchors[anchor[new]], b - a
        wide = grams[64]
        digest = scramble(wide[a]) * STEP + wide[a + (b - a - 64) // 2]
        out["digest"] = scramble(scramble(digest) * STEP + wide[b - 64]) + out["size"]
        doc = np.searchsorted(self.ends, a + at, side="right")
        out["doc"], out["start"] = doc, a + at - self.starts[doc]
        out["id_null"], out["doc_id"], out["row"] = self.id_null[doc], self.doc_id[doc], self.row[doc]
        return out


def scramble(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(31)) * MIX
    return h ^ h >> np.uint64(29)


def among(value: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in a sorted array."""
    if not len(known):
        return np.zeros(len(value), bool)
    return known[np.minimum(np.searchsorted(known, value), len(known) - 1)] == value


def spread(s: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """Segments with the single windows of hot anchors keyed by all their bytes."""
    mine = among(s["hash"], hot)
    s["hash"][mine] = scramble(scramble(s["digest"][mine]) * STEP + s["hash"][mine])
    return s


def gram_hashes(flat: np.ndarray) -> dict[int, np.ndarray]:
    """Polynomial hashes of the runs of 32 and 64 bytes from every position,
    by doubling; runs over the end hold zeros there."""
    h, base, n, out = flat.astype(np.uint64) + np.uint64(1), int(STEP), 1, {}
    while n < 64:
        after = np.zeros_like(h)
        after[:-n] = h[n:]
        h = h * np.uint64(base) + after
        base, n = base * base % (1 << 64), 2 * n
        if n >= 32:
            out[n] = h
    return out


def sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    n = 1
    while 2 * n <= width:
        a = np.minimum(a[:-n], a[n:])
        n *= 2
    return np.minimum(a[:len(a) - (width - n)], a[width - n:]) if n < width else a


# ------------------------------------------------------------ steps

def by_key(s: np.ndarray) -> np.ndarray:
    """Order of segments by anchor, content, and place in the corpus."""
    return np.lexsort((s["start"], s["row"], s["doc_id"], s["id_null"], s["digest"], s["hash"]))


def merged(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Spans with overlapping and touching ones joined, by document."""
    if not len(doc):
        return np.zeros(0, SPAN)
    key = doc.astype(np.int64) << 32
    by = np.argsort(key | start.astype(np.int64), kind="stable")
    first, last = (key + start.astype(np.int64))[by], (key + end.astype(np.int64))[by]
    reach = np.maximum.accumulate(last)
    new = np.flatnonzero(np.r_[True, (first[1:] > reach[:-1]) | (doc[by][1:] != doc[by][:-1])])
    out = np.zeros(len(new), SPAN)
    low = (1 << 32) - 1
    out["doc"], out["start"] = doc[by][new], first[new] & low
    out["end"] = reach[np.r_[new[1:], len(by)] - 1] & low
    return out


def shared_hashes(blobs: list[bytes], most: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per file, its anchors that occur again, in it or in another one, and
    which of them have more than ``most`` segments."""
    got = [unpack(b, "<u8", "<i8") for b in blobs]
    value = np.concatenate([h for h, _ in got])
    n = np.concatenate([m for _, m in got])
    owner = np.repeat(np.arange(len(got)), [len(h) for h, _ in got])
    by = np.argsort(value, kind="stable")
    value, n, owner = value[by], n[by], owner[by]
    first = np.flatnonzero(np.r_[True, value[1:] != value[:-1]][:len(value)])
    total = np.repeat(np.add.reduceat(n, first), np.diff(np.r_[first, len(n)])) if len(n) else n
    again = np.flatnonzero(total > 1)
    of_file = dict(dealt(owner[again]))
    none = np.zeros(0, np.int64)
    return [(value[mine], total[mine] > most) for i in range(len(got)) for mine in [again[of_file.get(i, none)]]]


def dealt(key: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(key, its rows in order) for every key: one sort, however many keys there are."""
    by = np.argsort(key, kind="stable")
    cut = np.flatnonzero(key[by][1:] != key[by][:-1]) + 1
    return [(int(key[rows[0]]), rows) for rows in np.split(by, cut)] if len(by) else []


def firsts(s: np.ndarray) -> np.ndarray:
    """Of ``s`` in key order: whether a row is the first with its content."""
    return np.r_[True, (s["hash"][1:] != s["hash"][:-1]) | (s["digest"][1:] != s["digest"][:-1])] if len(s) else \
        np.zeros(0, bool)


def repeated_windows(s: np.ndarray, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Of distinct segments: (segment, offset) of each window that also starts
    earlier in one of them, by a suffix array over them all."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.cumsum(sizes + 1) - (sizes + 1)
    raw = np.frombuffer(b"\x00".join(texts) + b"\x00", np.uint8).astype(np.int64) + 1
    raw[starts + sizes] = 0
    order = suffix_array(raw)
    prefix = common_prefixes(raw, order, starts, WIDTH)
    segment = np.repeat(np.arange(len(texts)), sizes + 1)
    offset = np.arange(len(raw)) - starts[segment]
    group = np.cumsum(prefix[order] < WIDTH)        # positions whose first WIDTH symbols agree
    whole = offset[order] + WIDTH <= sizes[segment[order]]
    at, group = order[whole], group[whole]
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    _, rank = np.unique(np.rec.fromarrays([s["id_null"], s["doc_id"], s["row"]]), return_inverse=True)
    key = rank[segment[at]] << 32 | s["start"][segment[at]].astype(np.int64) + offset[at]
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    least = np.repeat(np.minimum.reduceat(key, first), np.diff(np.r_[first, len(key)]))
    later = at[key > least]
    return segment[later], offset[later]


def shard_spans(s: np.ndarray, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, start, end) of what goes from the distinct segments of a
    shard; whole anchors at a time, about SORTED symbols to a suffix array."""
    by = np.argsort(s["hash"], kind="stable")
    ends = np.cumsum(s["size"][by].astype(np.int64) + 1)
    groups = np.flatnonzero(np.r_[True, s["hash"][by][1:] != s["hash"][by][:-1], True])
    out, a = [], 0
    while a < len(groups) - 1:
        base = ends[groups[a]] - s["size"][by[groups[a]]] - 1
        b = max(a + 1, int(np.searchsorted(ends[groups[1:] - 1], base + SORTED, side="right")))
        some = by[groups[a]:groups[b]]
        segment, offset = repeated_windows(s[some], [texts[i] for i in some.tolist()])
        segment = some[segment]
        start = s["start"][segment].astype(np.int64) + offset
        out.append((segment, start, start + WIDTH))
        a = b
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 3


def _rows(schema: pa.Schema, rows: list[tuple]) -> pa.Table:
    return pa.table([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


ROUTED = pa.schema([("part", pa.int64()), ("file", pa.string()), ("blob", pa.binary())])
ROUTED_SQL = "part bigint, file string, blob binary"
SPANS = -1                  # part of rows that carry finished spans on


def duplicate_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         keep_bytes: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept]) per row.

    Earlier means smaller doc_id, or the same document and an earlier start;
    strings are judged on the input.  Only the two named columns are read.  A
    null text is empty (nothing removed, the digest of no bytes); rows with
    equal ids follow each other as they are read, rows without an id come
    last; an empty table gives an empty result.  With ``keep_bytes`` the bytes
    that stay come too (removal may cut inside a character).
    """
    spark = docs.sparkSession
    path = shared_folder(spark, "texts")
    rows = docs.select(docs[id_col].cast("bigint").alias("doc_id"),
                       F.encode(F.coalesce(docs[text_col].cast("string"), F.lit("")), "UTF-8").alias("text"),
                       F.monotonically_increasing_id().alias("row"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, math.ceil(total / 48_000_000))        # of anchors
    shards = max(1, math.ceil(total / 16_000_000))       # of segments

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = pafs.FileSystem.from_uri(path)
        system.create_dir(root, recursive=True)
        held: list[tuple[int | None, bytes, int]] = []
        size = 0

        def close() -> pa.RecordBatch:
            nonlocal held, size
            ids = [h[0] for h in held]
            file = TextFile(b"".join(h[1] for h in held), np.cumsum([len(h[1]) for h in held], dtype="<i8"),
                            np.array([i is None for i in ids]), np.array([i or 0 for i in ids], "<i8"),
                            np.array([h[2] for h in held], "<i8"))
            held, size = [], 0
            name = uuid.uuid4().hex
            file.save(system, posixpath.join(root, name))
            value, n = np.unique(file.segments()["hash"], return_counts=True)
            part = value % np.uint64(parts)
            out = [(SPANS, name, b"")]
            for p, mine in dealt(part):
                out.append((p, name, pack(value[mine], n[mine].astype("<i8"))))
            return _rows(ROUTED, out).combine_chunks().to_batches()[0]

        for batch in batches:
            for doc_id, text, row in zip(*(batch.column(i) for i in range(3)), strict=True):
                held.append((doc_id.as_py(), text.as_py(), row.as_py()))
                size += len(held[-1][1])
                if size >= FILE_BYTES:
                    yield close()
        if held:
            yield close()

    def open_file(name: str) -> TextFile:
        system, root = pafs.FileSystem.from_uri(path)
        return TextFile.load(system, posixpath.join(root, name))

    def find_shared(t: pa.Table) -> pa.Table:
        """By part: the anchors of each file that occur again."""
        names = t["file"].to_pylist()
        if t["part"][0].as_py() < 0:
            return _rows(ROUTED, [(SPANS, n, b"") for n in names])
        got = shared_hashes(t["blob"].to_pylist(), HOT)
        return _rows(ROUTED, [(0, n, pack(h, m)) for n, (h, m) in zip(names, got, strict=True) if len(h)])

    def find_segments(t: pa.Table) -> pa.Table:
        """By file: its segments of shared anchors, equal ones once, to the
        anchors' parts; the later copies inside the file as spans."""
        name = t["file"][0].as_py()
        again = [unpack(b, "<u8", "?") for b in t["blob"].to_pylist() if b]
        out = []
        spans = np.zeros(0, SPAN)
        if again:
            known = np.sort(np.concatenate([h for h, _ in again]))
            hot = np.sort(np.concatenate([h[m] for h, m in again]))
            s = open_file(name).segments(hot)
            s = spread(s[among(s["hash"], known)], hot)
            s = s[by_key(s)]
            first = firsts(s)
            x = s[~first]
            spans = merged(x["doc"], x["start"], x["start"] + x["size"])
            s = s[first]
            part = s["hash"] % np.uint64(parts)
            for p, mine in dealt(part):
                out.append((p, name, pack(s[mine])))
        out.append((SPANS - int(name[:6], 16) % parts, name, pack(spans)))
        return _rows(ROUTED, out)

    def find_firsts(t: pa.Table) -> pa.Table:
        """By part: equal segments of all files; the first stands for them and
        the others go.  Part 0 rows ask for the bytes of segments whose anchor
        has different ones."""
        names, blobs = t["file"].to_pylist(), t["blob"].to_pylist()
        if t["part"][0].as_py() < 0:
            return _rows(ROUTED, [(SPANS, n, b) for n, b in zip(names, blobs, strict=True)])
        got = [unpack(b, SEGMENT)[0] for b in blobs]
        s, owner = np.concatenate(got), np.repeat(np.arange(len(got)), list(map(len, got)))
        by = by_key(s)
        s, owner = s[by], owner[by]
        first = firsts(s)
        out = []
        x, o = s[~first], owner[~first]
        y, p = s[first], owner[first]
        other = np.r_[y["hash"][1:] == y["hash"][:-1], False] if len(y) else np.zeros(0, bool)
        asked = other | np.r_[False, other[:-1]] if len(y) else other
        y, p = y[asked], p[asked]
        for i, rows in dealt(o):
            mine = x[rows]
            out.append((SPANS, names[i], pack(merged(mine["doc"], mine["start"], mine["start"] + mine["size"]))))
        for i, rows in dealt(p):
            out.append((0, names[i], pack(y[rows])))
        return _rows(ROUTED, out)

    def cut_bytes(t: pa.Table) -> pa.Table:
        """By file: the bytes of the segments asked for, to their shards."""
        name = t["file"][0].as_py()
        s = np.concatenate([unpack(b, SEGMENT)[0] for b in t["blob"].to_pylist()])
        file = open_file(name)
        a = file.starts[s["doc"]] + s["start"]
        shard = (s["hash"] >> np.uint64(20)) % np.uint64(shards)
        out = []
        for k, mine in dealt(shard):
            text = b"".join(file.text[i:i + n] for i, n in zip(a[mine].tolist(), s["size"][mine].tolist(), strict=True))
            out.append((k, name, pack(s[mine], np.frombuffer(text, np.uint8))))
        return _rows(ROUTED, out)

    def sort_shard(t: pa.Table) -> pa.Table:
        """By shard: the spans that its suffix arrays find."""
        names = t["file"].to_pylist()
        got, texts = [], []
        for b in t["blob"].to_pylist():
            s, text = unpack(b, SEGMENT, np.uint8)
            ends = np.cumsum(s["size"].astype(np.int64)).tolist()
            text = text.tobytes()
            texts += [text[i:j] for i, j in zip([0, *ends[:-1]], ends, strict=True)]
            got.append(s)
        s, owner = np.concatenate(got), np.repeat(np.arange(len(got)), list(map(len, got)))
        segment, start, end = shard_spans(s, texts)
        out = []
        for i, mine in dealt(owner[segment]):
            out.append((SPANS, names[i], pack(merged(s["doc"][segment[mine]], start[mine], end[mine]))))
        return _rows(ROUTED, out)

    kept_kind = [("kept", pa.binary())] if keep_bytes else []
    result = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                        ("kept_sha256", pa.string()), *kept_kind])

    def finish(t: pa.Table) -> pa.Table:
        """By file: the documents without their spans."""
        file = open_file(t["file"][0].as_py())
        all_ = np.concatenate([np.zeros(0, SPAN), *[unpack(b, SPAN)[0] for b in t["blob"].to_pylist() if b]])
        spans = merged(all_["doc"], all_["start"], all_["end"])
        cut = np.searchsorted(spans["doc"], np.arange(len(file.ends) + 1)).tolist()
        start, end = spans["start"].tolist(), spans["end"].tolist()
        out = []
        for d, (a, b) in enumerate(zip(file.starts.tolist(), file.ends.tolist(), strict=True)):
            text, at, kept = file.text[a:b], 0, []
            for k in range(cut[d], cut[d + 1]):
                kept.append(text[at:start[k]])
                at = end[k]
            kept.append(text[at:])
            stay = b"".join(kept)
            out.append((None if file.id_null[d] else int(file.doc_id[d]), b - a, b - a - len(stay), cut[d + 1] - cut[d],
                        hashlib.sha256(stay).hexdigest(), stay))
        return _rows(result, out)

    def each(df: DataFrame, n: int, key: str, step: Callable[[pa.Table], pa.Table], schema: str = ROUTED_SQL) -> DataFrame:
        return df.repartition(n, key).groupBy(key).applyInArrow(step, schema)

    anchors = stored(rows.mapInArrow(write, ROUTED_SQL), "anchors")
    files = max(1, anchors.where(F.col("part") == SPANS).count())
    shared = each(anchors, parts + 1, "part", find_shared)
    segments = each(shared, files, "file", find_segments)
    routed = stored(each(segments, 2 * parts, "part", find_firsts), "firsts")
    asked = each(routed.where("part >= 0"), files, "file", cut_bytes)
    spans = each(asked, shards, "part", sort_shard).union(routed.where("part < 0"))
    sql = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    return each(spans, files, "file", finish, sql + (", kept binary" if keep_bytes else ""))
