"""Byte-level BPE by DuckDB recursive queries, one small database per worker.

Spark deals the documents; inside a task, the distinct pre-tokens of a batch
become token-position rows (word, position, token).  A recursive query joins
neighbouring rows to the merge table and contracts, in every round, each
word's leftmost minimum-rank pair until no word has one left.  Decoding joins
token ids to their bytes and puts them together by an ordered aggregation.

Documents are map-only work: nothing is shuffled.  A text is cut at spaces
that a non-space follows, where the split pattern always starts a new match;
units and pre-tokens are encoded once per worker and reused (``UnitCoder``).
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import warnings
from array import array
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stopcast.llm.common import give_back, worker_state
from stopcast.llm.token_counts import batch_groups
from stopcast.llm.units import Rows, UnitCoder

SCHEMA = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
CACHE_UNITS = 300_000       # units kept by a worker; the cache is emptied beyond
LONG_UNIT = 50_000          # characters between two spaces beyond which a text is encoded by itself
LONG_BYTES = 2_000          # pre-tokens beyond are merged one by one, not in rounds
DECODE_IDS = 100_000        # ids of one ordered aggregation
CHUNK_BYTES = 200_000       # bytes of distinct pre-tokens in one recursive query
GROUP_BYTES = 2_000_000     # bytes of texts that are encoded together
SPARE = 2                   # a sparing worker has caches and queries smaller by this, groups by twice this

#: place = word << 24 | position; every word ends with a row of token -1, which
#: pairs with nothing.  The inner ORDER BY gives the windows their order.
ENCODE = """
WITH RECURSIVE s(place, tok, pair, best) AS (
  WITH n AS MATERIALIZED (
    SELECT place, tok, (m.rank << 24) | (place & 16777215) AS pair
    FROM (SELECT place, tok, lead(tok) OVER () AS nxt FROM (SELECT * FROM word_rows ORDER BY place))
    LEFT JOIN merges m ON m.both = tok * 4294967296 + nxt)
  SELECT n.place, n.tok, n.pair, b.best
  FROM n JOIN (SELECT place >> 24 AS w, min(pair) AS best FROM n GROUP BY 1) b ON b.w = n.place >> 24
 UNION ALL (
  WITH n AS MATERIALIZED (
    SELECT place, tok, (m.rank << 24) | (place & 16777215) AS pair FROM (
      SELECT place,
             CASE WHEN pair = best THEN best >> 24 ELSE tok END AS tok,
             CASE WHEN pair = best THEN lead(tok, 2) OVER o
                  WHEN lead(pair) OVER o = best THEN best >> 24
                  ELSE lead(tok) OVER o END AS nxt,
             lag(pair) OVER o IS NOT DISTINCT FROM best AS gone
      FROM (SELECT * FROM s WHERE best IS NOT NULL ORDER BY place) WINDOW o AS ())
    LEFT JOIN merges m ON m.both = tok * 4294967296 + nxt
    WHERE NOT gone)
  SELECT n.place, n.tok, n.pair, b.best
  FROM n JOIN (SELECT place >> 24 AS w, min(pair) AS best FROM n GROUP BY 1) b ON b.w = n.place >> 24))
SELECT place >> 24 AS w, tok FROM s WHERE best IS NULL AND tok >= 0 ORDER BY place
"""
DECODE = """
SELECT string_agg(t.hex, '' ORDER BY i.place) AS hex
FROM id_rows i JOIN tokens t ON t.id = i.tok GROUP BY i.place >> 24 ORDER BY i.place >> 24
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank of a rank file (base64 and number a line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def positions(lens: np.ndarray) -> np.ndarray:
    """row << 24 | position for rows of the given lengths (below 2**24)."""
    row = np.repeat(np.arange(len(lens)), lens)
    return row << 24 | (np.arange(int(lens.sum())) - np.repeat(np.cumsum(lens) - lens, lens))


class SqlBPE:
    """Encoder and decoder of one rank file; ``sparing``: with less memory."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, sparing: bool = False):
        self.ranks = ranks
        self.chunk_bytes = CHUNK_BYTES // SPARE if sparing else CHUNK_BYTES
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        #: rank of every pair of bytes, -1 without one
        self.pair_rank = np.array([ranks.get(bytes([a, b]), -1) for a in range(256) for b in range(256)], np.int32)
        both, rank = [], []
        for token, r in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    both.append(a << 32 | b)
                    rank.append(r)
        self.con = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "200MB", "temp_directory": ""})
        self._table("merges", both=pa.array(both, pa.int64()), rank=pa.array(rank, pa.int64()))
        self._table("tokens", id=pa.array(list(ranks.values()), pa.int64()),
                    hex=pa.array([t.hex() for t in ranks], pa.string()))
        self.coder = UnitCoder(pattern, self.words, [np.dtype("<u4"), np.uint8],
                               CACHE_UNITS // SPARE if sparing else CACHE_UNITS)

    def _table(self, name: str, **columns: pa.Array) -> None:
        self.con.register("given", pa.table(columns))
        self.con.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.con.unregister("given")

    def _run(self, sql: str, name: str, **columns: np.ndarray) -> pa.Table:
        self.con.register(name, pa.table(columns))
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            out = self.con.execute(sql).to_arrow_table()
        self.con.unregister(name)
        return out

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all (non-empty) words, and how many each has, by the recursive query."""
        ids, sizes = [np.zeros(0, "<u4")], [np.zeros(0, np.int64)]
        a = 0
        while a < len(words):
            b, size = a + 1, len(words[a])
            while b < len(words) and size + len(words[b]) <= self.chunk_bytes:
                size += len(words[b])
                b += 1
            lens = np.fromiter(map(len, words[a:b]), np.int64, b - a)
            tok = np.insert(self.byte_id[np.frombuffer(b"".join(words[a:b]), np.uint8)], np.cumsum(lens), -1)
            got = self._run(ENCODE, "word_rows", place=positions(lens + 1), tok=tok)
            ids.append(got["tok"].to_numpy().astype("<u4"))
            sizes.append(np.bincount(got["w"].to_numpy(), minlength=b - a))
            a = b
        return np.concatenate(ids), np.concatenate(sizes)

    def merge_long(self, word: bytes) -> np.ndarray:
        """Ids of one long pre-token.  A round of the query costs the whole
        word and contracts one pair, which a word of n bytes would pay n
        times; here pairs wait by rank and place: those of the word's bytes in
        one sorted array, those that merges bring about in a heap.  Some 40
        bytes of memory a byte."""
        n, ranks = len(word), self.ranks
        end, before = array("i", range(1, n + 1)), array("i", range(-1, n - 1))     # of the token that starts at a place
        alive = bytearray(b"\x01") * n

        def rank(at: int) -> int | None:
            nxt = end[at]
            return ranks.get(word[at:end[nxt]]) if nxt < n else None

        raw = np.frombuffer(word, np.uint8).astype(np.uint16)
        first = self.pair_rank[raw[:-1] << 8 | raw[1:]]
        place = np.flatnonzero(first >= 0)
        first = first[place].astype(np.int64) << 32 | place
        first.sort()
        del raw, place
        heap: list[int] = []
        at_first, mask = 0, (1 << 32) - 1
        waiting = int(first[0]) if len(first) else None
        while heap or waiting is not None:
            if waiting is not None and (not heap or waiting < heap[0]):
                pair = waiting
                at_first += 1
                waiting = int(first[at_first]) if at_first < len(first) else None
            else:
                pair = heapq.heappop(heap)
            r, i = pair >> 32, pair & mask
            if not alive[i] or rank(i) != r:
                continue
            gone = end[i]
            end[i], alive[gone] = end[gone], 0
            if end[i] < n:
                before[end[i]] = i
            for at in (before[i], i):
                if at >= 0 and (new := rank(at)) is not None:
                    heapq.heappush(heap, new << 32 | at)
        out, at = array("I"), 0
        while at < n:
            out.append(ranks[word[at:end[at]]])
            at = end[at]
        return np.array(out, "<u4")

    def decode_ids(self, ids: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        """Bytes of each (non-empty) run of ids, by the ordered aggregation.  Long
        runs are cut into pieces, whose bytes are joined, and a query gets
        DECODE_IDS ids at most."""
        pieces = -(-sizes // DECODE_IDS)
        if len(sizes) and int(pieces.max()) > 1:
            owner = np.repeat(np.arange(len(sizes)), pieces)
            nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            out: list[list[bytes]] = [[] for _ in range(len(sizes))]
            for i, x in zip(owner.tolist(), self._decoded(ids, np.minimum(DECODE_IDS, sizes[owner] - nth * DECODE_IDS)), strict=True):
                out[i].append(x)
            return [b"".join(x) for x in out]
        return self._decoded(ids, sizes)

    def _decoded(self, ids: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        ends = np.cumsum(sizes)
        out: list[bytes] = []
        a = 0
        while a < len(sizes):
            b = max(a + 1, int(np.searchsorted(ends, ends[a] - sizes[a] + 4 * DECODE_IDS, "right")))
            got = self._run(DECODE, "id_rows", place=positions(sizes[a:b]), tok=ids[ends[a] - sizes[a]:ends[b - 1]].astype(np.int64))
            out += map(bytes.fromhex, got["hex"].to_pylist())
            a = b
        return out

    def words(self, words: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of pre-tokens, and the bytes that these ids decode to."""
        raw = [w.encode() for w in words]
        rank = np.fromiter((self.ranks.get(w, -1) for w in raw), np.int64, len(raw))
        one = np.flatnonzero(rank >= 0)         # a pre-token that is a token
        rest = np.flatnonzero(rank < 0)
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        long, rest = rest[size[rest] > LONG_BYTES], rest[size[rest] <= LONG_BYTES]
        rows = Rows(np.dtype("<u4"))
        rows.add(rank[one].astype("<u4"), np.ones(len(one), np.int64))
        rows.add(*self.encode_words([raw[i] for i in rest.tolist()]))
        for i in long.tolist():
            ids = self.merge_long(raw[i])
            rows.add(ids, np.array([len(ids)]))
        back = np.empty(len(raw), np.int64)
        back[np.concatenate([one, rest, long])] = np.arange(len(raw))
        ids, starts = rows.gather(back)
        sizes = np.diff(starts)
        decoded = self.decode_ids(ids, sizes)
        return [(ids, sizes), (np.frombuffer(b"".join(decoded), np.uint8), np.fromiter(map(len, decoded), np.int64, len(decoded)))]


    def whole(self, text: str) -> tuple[np.ndarray, str]:
        """Ids of one text, and the digest of the bytes that they decode to, without
        the caches; a few pre-tokens at a time."""
        ids, digest, some, size = [np.zeros(0, "<u4")], hashlib.sha256(), [], 0
        for match in self.coder.split(text):
            if some and size + len(match) > CHUNK_BYTES:
                self._some(some, ids, digest)
                some, size = [], 0
            some.append(match)
            size += len(match)
        if some:
            self._some(some, ids, digest)
        return np.concatenate(ids), digest.hexdigest()

    def _some(self, words: list[str], ids: list[np.ndarray], digest: "hashlib._Hash") -> None:
        distinct = list(dict.fromkeys(words))
        (got, sizes), (decoded, lens) = self.words(distinct)
        number = {w: i for i, w in enumerate(distinct)}
        a, b = np.cumsum(sizes) - sizes, np.cumsum(lens) - lens
        for w in words:
            i = number[w]
            ids.append(got[a[i]:a[i] + sizes[i]])
            digest.update(decoded[b[i]:b[i] + lens[i]])


def unbroken(text: str) -> bool:
    """Whether a text has a run between spaces that is too long for the caches."""
    return len(text) > LONG_UNIT and max(map(len, text.split(" "))) > LONG_UNIT


def digests(values: np.ndarray, starts: np.ndarray) -> list[str]:
    cut = starts.tolist()
    return [hashlib.sha256(values[a:b]).hexdigest() for a, b in zip(cut, cut[1:], strict=False)]


def bpe_round_trip(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                   keep_ids: bool = False, sparing: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids]) for every row.

    Encodes each match of ``pattern`` by the ranks of ``rank_file`` (a path
    that every executor can open) and decodes the ids again; the digests are
    of the ids as little-endian uint32 and of the decoded bytes.  With
    ``keep_ids`` the ids come too, as array<int>.  Only the two named columns
    are read.  A null text counts as empty; repeated rows give repeated
    results; a null id stays null; an empty table gives an empty result.
    ``sparing`` is for executors whose heap earlier stages have filled: workers
    keep smaller caches, encode fewer texts at once and return what they free,
    for more CPU time and the same rows.
    Pre-tokens of over LONG_BYTES bytes are merged by a heap in place of the
    query, whose rounds would take the square of their length; texts without a
    space for LONG_UNIT characters bypass the caches.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = worker_state(("bpe_sql", rank_file, pattern, sparing), lambda: SqlBPE(read_ranks(rank_file), pattern, sparing))
        for batch in batches:
            for part in batch_groups(batch, 1, GROUP_BYTES // (2 * SPARE) if sparing else GROUP_BYTES):
                texts = [t or "" for t in part.column(1).to_pylist()]
                alone = {i: coder.whole(t) for i, t in enumerate(texts) if unbroken(t)}
                (ids, starts), (decoded, ends) = coder.coder(["" if i in alone else t for i, t in enumerate(texts)])
                decoded_sha = digests(decoded, ends)
                if alone:
                    runs = [alone[i][0] if i in alone else ids[starts[i]:starts[i + 1]] for i in range(len(texts))]
                    ids, starts = np.concatenate(runs), np.r_[0, np.cumsum([len(r) for r in runs])]
                    for i, (_, sha) in alone.items():
                        decoded_sha[i] = sha
                columns = [part.column(0), pa.array(np.diff(starts)),
                           pa.array(digests(ids, starts), pa.string()), pa.array(decoded_sha, pa.string())]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)
                if sparing:
                    give_back()

    return docs.select(docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].cast("string").alias("text")) \
        .mapInArrow(run, SCHEMA + (", ids array<int>" if keep_ids else ""))
