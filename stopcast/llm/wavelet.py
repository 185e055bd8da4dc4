"""Token-id files as wavelet matrices, one compressed file per shard.

Documents in ascending id order are dealt to ranges; each task encodes its
range once and writes shards of about SHARD_TOKENS ids.  A shard file holds,
for every bit of an id from the highest down, one bit-plane over the shard's
positions (stably reordered after each plane: zeros first), with counts per
512 bits, so that rank and select answer from the planes alone: the id at a
position, how often an id occurs in a stretch, and where its k-th occurrence
is.  The ends and ids of the documents stand beside the planes.
"""

from __future__ import annotations

import json
import posixpath
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stopcast.llm.common import shared_folder, stored, worker_state
from stopcast.llm.token_counts import text_groups
from stopcast.llm.units import Rows, UnitCoder

SHARD_TOKENS = 2_000_000    # ids after which a shard file is closed
CACHE_UNITS = 1_000_000     # units whose ids a worker keeps; emptied beyond
RUN_WORDS = 20_000          # pre-tokens that the library is given as one text
MAGIC = b"WVM1"
BLOCK = 512                 # bits between stored counts


class Plane:
    """A bit vector with rank and select."""

    def __init__(self, packed: np.ndarray, n: int, counts: np.ndarray | None = None):
        words = -(-max(n, 1) // BLOCK) * (BLOCK // 64)
        self.words = np.zeros(words, "<u8")
        self.words.view(np.uint8)[:len(packed)] = packed
        self.n = n
        if counts is None:
            per = np.bitwise_count(self.words).reshape(-1, BLOCK // 64).sum(axis=1, dtype=np.int64)
            counts = np.r_[0, np.cumsum(per)].astype("<u4")
        self.counts = counts
        self.ones = int(counts[-1])

    def bits(self) -> np.ndarray:
        return np.unpackbits(self.words.view(np.uint8), count=self.n, bitorder="little").view(np.bool_)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) == 1

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        i = np.asarray(i, np.int64)
        block = np.minimum(i // BLOCK, len(self.counts) - 2)
        at = block[:, None] * (BLOCK // 64) + np.arange(BLOCK // 64)
        left = np.clip(i[:, None] - at * 64, 0, 64)
        mask = np.where(left == 64, ~np.uint64(0), (np.uint64(1) << np.minimum(left, 63).astype(np.uint64)) - np.uint64(1))
        return self.counts[block].astype(np.int64) + np.bitwise_count(self.words[at] & mask).sum(axis=1, dtype=np.int64)

    def select(self, k: np.ndarray, one: bool) -> np.ndarray:
        """Position of the k-th (from 0) one, or zero; k must exist."""
        low, high = np.zeros(len(k), np.int64), np.full(len(k), self.n, np.int64)
        while (high - low > 1).any():
            mid = (low + high) // 2
            before = self.rank(mid)
            over = (before if one else mid - before) > k
            low, high = np.where(over, low, mid), np.where(over, mid, high)
        return low


class WaveletMatrix:
    def __init__(self, planes: list[Plane], n: int):
        self.planes, self.n = planes, n

    @classmethod
    def build(cls, values: np.ndarray, bits: int) -> WaveletMatrix:
        n, planes = len(values), []
        for bit in range(bits - 1, -1, -1):
            b = (values >> values.dtype.type(bit) & values.dtype.type(1)).astype(np.bool_)
            planes.append(Plane(np.packbits(b, bitorder="little"), n))
            values = np.concatenate([values.take(np.flatnonzero(~b)), values.take(np.flatnonzero(b))])
        return cls(planes, n)

    def all(self) -> np.ndarray:
        """Every id, from the last plane back to the first order."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        values = np.zeros(self.n, kind)
        for level in range(len(self.planes) - 1, -1, -1):
            b = self.planes[level].bits()
            zeros = self.n - self.planes[level].ones
            out = np.empty(self.n, kind)
            out[np.flatnonzero(~b)] = values[:zeros]
            out[np.flatnonzero(b)] = values[zeros:] | kind(1 << (len(self.planes) - 1 - level))
            values = out
        return values

    def access(self, positions: np.ndarray) -> np.ndarray:
        at = np.asarray(positions, np.int64)
        out = np.zeros(len(at), np.int64)
        for p in self.planes:
            b, ones = p.get(at), p.rank(at)
            out = out << 1 | b
            at = np.where(b, self.n - p.ones + ones, at - ones)
        return out

    def _range(self, token: int, start: int, end: int) -> tuple[int, int]:
        if not 0 <= token < 1 << len(self.planes):
            return 0, 0
        for level, p in enumerate(self.planes):
            a, b = p.rank(np.array([start, end])).tolist()
            if token >> (len(self.planes) - 1 - level) & 1:
                start, end = self.n - p.ones + a, self.n - p.ones + b
            else:
                start, end = start - a, end - b
        return start, end

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        """Occurrences of ``token`` at positions start to end."""
        a, b = self._range(token, start, self.n if end is None else end)
        return b - a

    def occurrences(self, token: int, start: int = 0, end: int | None = None) -> np.ndarray:
        """Their positions, in ascending order."""
        a, b = self._range(token, start, self.n if end is None else end)
        at = np.arange(a, b)
        for level in range(len(self.planes) - 1, -1, -1):
            p = self.planes[level]
            one = bool(token >> (len(self.planes) - 1 - level) & 1)
            at = p.select(at - (self.n - p.ones) if one else at, one)
        return at


class TokenShard:
    """Documents (id or None, ids) of one file."""

    def __init__(self, matrix: WaveletMatrix, doc_ids: list[int | None], ends: np.ndarray):
        self.matrix, self.doc_ids, self.ends = matrix, doc_ids, ends

    def to_bytes(self) -> bytes:
        pack = zstandard.ZstdCompressor(level=1).compress
        parts = [pack(json.dumps(self.doc_ids).encode()), pack(self.ends.astype("<i8").tobytes())]
        for p in self.matrix.planes:
            parts += [pack(p.words.tobytes()), pack(p.counts.tobytes())]
        return MAGIC + struct.pack("<QII", self.matrix.n, len(self.matrix.planes), len(self.doc_ids)) \
            + struct.pack(f"<{len(parts)}Q", *map(len, parts)) + b"".join(parts)

    @classmethod
    def from_bytes(cls, data: bytes) -> TokenShard:
        if data[:4] != MAGIC:
            raise ValueError("not a token shard")
        n, bits, _ = struct.unpack_from("<QII", data, 4)
        sizes = struct.unpack_from(f"<{2 + 2 * bits}Q", data, 20)
        at, parts = 20 + 8 * len(sizes), []
        open_ = zstandard.ZstdDecompressor().decompress
        for s in sizes:
            parts.append(open_(data[at:at + s]))
            at += s
        planes = [Plane(np.frombuffer(w, np.uint8), n, np.frombuffer(c, "<u4"))
                  for w, c in zip(parts[2::2], parts[3::2], strict=True)]
        return cls(WaveletMatrix(planes, n), json.loads(parts[0]), np.frombuffer(parts[1], "<i8"))


class ByteEncoder:
    """Ids of whole texts by a byte-level tokenizer file (see ``UnitCoder``).
    A text that holds the string of a special token is given to the library
    whole."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec["pre_tokenizer"]
        if spec["normalizer"] is not None or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"]:
            raise ValueError(f"{path}: not a byte-level vocabulary without prefix space")
        self.tokenizer = Tokenizer.from_file(path)
        self.bits = max(1, (self.tokenizer.get_vocab_size(with_added_tokens=True) - 1).bit_length())
        self.kind = np.uint16 if self.bits <= 16 else np.uint32
        self.special = [t["content"] for t in spec["added_tokens"]]
        # a byte-level token has a character for each of its bytes
        self.size = np.zeros(1 << self.bits, np.int64)
        for token, i in spec["model"]["vocab"].items():
            self.size[i] = len(token)
        self.coder = UnitCoder(public_tokenizers.PATTERN, self.words, [self.kind], CACHE_UNITS)

    def words(self, words: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of pre-tokens, by the library in long runs: a word after a space
        is a pre-token of its own, so ids are told apart by their bytes."""
        run = [i for i, w in enumerate(words) if w[0] == " " and w[1:].isalnum()]
        known = set(run)
        apart = [i for i in range(len(words)) if i not in known]
        place = run + apart
        ids, lens = [], []
        for a in range(0, len(run), RUN_WORDS):
            some = [words[i] for i in run[a:a + RUN_WORDS]]
            got, = self.tokenizer.encode_batch_fast(["".join(some)], add_special_tokens=False)
            ids.append(np.array(got.ids, self.kind))
            ends = np.cumsum(np.fromiter(map(len, map(str.encode, some)), np.int64, len(some)))
            done = np.cumsum(self.size[ids[-1]])
            last = np.minimum(np.searchsorted(done, ends), len(done) - 1)
            if not np.array_equal(done[last], ends):
                raise ValueError("a token crosses two pre-tokens")
            lens.append(np.diff(last, prepend=-1))
        if apart:
            got = self.tokenizer.encode([words[i] for i in apart], is_pretokenized=True, add_special_tokens=False)
            ids.append(np.array(got.ids, self.kind))
            lens.append(np.bincount(np.array(got.word_ids, np.int64), minlength=len(apart)))
        rows = Rows(self.kind)
        rows.add(np.concatenate(ids), np.concatenate(lens))
        back = np.empty(len(words), np.int64)
        back[place] = np.arange(len(words))
        flat, starts = rows.gather(back)
        return [(flat, np.diff(starts))]

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of every text."""
        whole = [any(s in t for s in self.special) for t in texts]
        (ids, starts), = self.coder(["" if w else t for t, w in zip(texts, whole, strict=True)])
        cut = starts.tolist()
        return [np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, self.kind) if w else ids[a:b]
                for t, w, a, b in zip(texts, whole, cut, cut[1:], strict=False)]


FILES = "file string, first_id bigint, first_row bigint, n_tokens bigint"


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text, add ``end_id``, and write shards under
    ``path`` in ascending id order; returns (file, first_id, first_row,
    n_tokens, start): the files and the ids before each.

    Only the two named columns are read.  A null text is empty (its end id
    alone); null ids come first; rows with equal ids keep the order in which
    they are read.  A repeated attempt writes files of other names; only those
    of the attempt that Spark commits are listed.
    """
    rows = docs.select(docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].cast("string").alias("text"),
                       F.monotonically_increasing_id().alias("row"))
    ranged = rows.repartitionByRange("doc_id", "row").sortWithinPartitions("doc_id", "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = worker_state(("wavelet", tokenizer), lambda: ByteEncoder(tokenizer))
        end = np.array([end_id], encode.kind)
        system, root = pafs.FileSystem.from_uri(path)
        system.create_dir(root, recursive=True)
        ids: list[int | None] = []
        parts: list[np.ndarray] = []
        size, first = 0, None

        def close() -> pa.RecordBatch:
            nonlocal ids, parts, size, first
            ends = np.cumsum([len(p) + 1 for p in parts])
            flat = np.concatenate([x for p in parts for x in (p, end)])
            name = f"{uuid.uuid4().hex}.wvm"
            with system.open_output_stream(posixpath.join(root, name), compression=None) as f:
                f.write(TokenShard(WaveletMatrix.build(flat, encode.bits), ids, ends).to_bytes())
            out = pa.RecordBatch.from_arrays([pa.array([name]), pa.array([first[0]], pa.int64()), pa.array([first[1]], pa.int64()),
                                              pa.array([len(flat)], pa.int64())],
                                             names=["file", "first_id", "first_row", "n_tokens"])
            ids, parts, size, first = [], [], 0, None
            return out

        for batch in batches:
            doc_ids, texts, numbers = (batch.column(i).to_pylist() for i in range(3))
            texts = [t or "" for t in texts]
            for s in text_groups(texts):
                for i, got in zip(range(s.start, s.stop), encode(texts[s]), strict=True):
                    first = first or (doc_ids[i], numbers[i])
                    ids.append(doc_ids[i])
                    parts.append(got)
                    size += len(got) + 1
                    if size >= SHARD_TOKENS:
                        yield close()
        if ids:
            yield close()

    files = stored(ranged.mapInArrow(run, FILES), "token-files")
    # one row a file: its place among all is a running sum over the file list
    order = Window.orderBy(F.asc_nulls_first("first_id"), "first_row")
    return files.withColumn("start", F.sum("n_tokens").over(order) - F.col("n_tokens"))


def read_token_files(spark: SparkSession, files: DataFrame, path: str, keep_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of the listed files."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = pafs.FileSystem.from_uri(path)
        for batch in batches:
            for name, start in zip(*(batch.column(c).to_pylist() for c in ("file", "start")), strict=True):
                with system.open_input_file(posixpath.join(root, name)) as f:
                    shard = TokenShard.from_bytes(f.read())
                ids = shard.matrix.all().astype("<u4")
                starts = np.r_[0, shard.ends[:-1]].astype(np.int64)
                columns = [pa.array(shard.doc_ids, pa.int64()), pa.array(start + starts), pa.array(shard.ends - starts),
                           pa.array([zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), shard.ends.tolist(), strict=True)],
                                    pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if keep_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.r_[starts, len(ids)].astype(np.int32)),
                                                            pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    n = files.count()
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids array<int>" if keep_ids else "")
    return files.select("file", "start").repartition(max(1, min(n, 20_000))).mapInArrow(run, schema)


def token_file_round_trip(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Write the token files of ``docs`` in the shared folder and read every
    document back from them; an empty table gives an empty result."""
    spark = docs.sparkSession
    path = shared_folder(spark, "wavelet")
    return read_token_files(spark, write_token_files(docs, path, tokenizer, end_id), path)
