"""Conversation structure repair by a persistent audit DP.

A repaired conversation holds role initials ``(s?(ua)+)?``.  Every row is kept
(K, 0), gets the role that is due (R, 1) or is deleted (D, 2); an empty row of
the role that is due may be inserted anywhere (I, 5).  Blank and repeated rows
must go, and a truncated row that stays adds 5.  The cheapest edits win, of
equally cheap ones those with the ASCII-least audit (the edits' initials).

The DP has four states (nothing yet, after ``s``, after ``u``, after ``a``), each
with its cost and its audit so far.  Audits share their prefixes: an audit is a
node that links to the one before, with binary-lifting ancestors and a rolling
hash.  Ties are compared by a search for the longest common prefix; prefixes
that their hashes call equal are verified once and then linked.

A conversation may hold a third of all rows.  So the DP runs over pieces: the
rows, without texts, are range partitioned by conversation and order (equal rows
are one row with a count), and a piece gives the cheapest way from each state to
each.  The texts are dealt by conversation once, sorted, and streamed past the
audit that the pieces add up to.  That stream, one conversation after another in
bounded memory, is the only part a single conversation cannot be split in, since
a SHA-256 runs over its texts in order.  An audit is one value and is held whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopcast.llm.common import no_state, stored

BLANKS = " \t\n\x0b\x0c\r"
PIECE_ROWS = 16384          # rows of a piece, its audits are held at once
REMEMBERED = 20000          # short conversations whose audits a task remembers
MOD, BASE = (1 << 61) - 1, 1_000_003

NONE, AFTER_S, AFTER_U, AFTER_A = range(4)
INITIALS = "sua"
MUST_GO, TRUNCATED = 4, 8   # bits of a row's code beside its class (0 s, 1 u, 2 a, 3 other)
LEGAL = {(0, 1), (1, 2), (2, 1)}

PIECE = ("struct<n:bigint, blank:bigint, duplicate:bigint, truncated:bigint, illegal:bigint, first:int, last:int, "
         "low:bigint, high:bigint, turns:bigint, ways:array<struct<a:int, b:int, cost:bigint, audit:string>>>")
REPORT = ("conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
          "audit string, repaired_sha256 string")
ROWS = "conv_id bigint, position bigint, role string, text string"


class Audits:
    """Audits as linked nodes; node 0 is the empty one."""

    def __init__(self, base: int = BASE, mod: int = MOD):
        self.base, self.mod = base, mod
        self.char, self.depth, self.hash = [""], [0], [0]
        self.up: list[list[int]] = [[]]
        self.twin = [0]         # a node of the same audit (itself, or one verified)

    def add(self, node: int, char: str) -> int:
        up, jump = [node], node
        for k in range(64):
            if k >= len(self.up[jump]):
                break
            jump = self.up[jump][k]
            up.append(jump)
        self.char.append(char)
        self.depth.append(self.depth[node] + 1)
        self.hash.append((self.hash[node] * self.base + ord(char)) % self.mod)
        self.up.append(up)
        self.twin.append(len(self.twin))
        return len(self.twin) - 1

    def find(self, node: int) -> int:
        while self.twin[node] != node:
            self.twin[node] = self.twin[self.twin[node]]
            node = self.twin[node]
        return node

    def ancestor(self, node: int, depth: int) -> int:
        gap = self.depth[node] - depth
        while gap:
            k = gap.bit_length() - 1
            node = self.up[node][k]
            gap -= 1 << k
        return node

    def verified(self, a: int, b: int) -> bool:
        """Whether two nodes of one depth hold the same audit, character by character."""
        path, x, y = [], self.find(a), self.find(b)
        while x != y:
            if self.char[x] != self.char[y]:
                return False
            path.append((x, y))
            x, y = self.find(self.up[x][0]), self.find(self.up[y][0])
        for x, y in path:
            self.twin[self.find(max(x, y))] = self.find(min(x, y))
        return True

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self.char[node])
            node = self.up[node][0]
        return "".join(reversed(out))

    def less(self, a: int, b: int) -> bool:
        """Whether audit ``a`` comes before audit ``b``."""
        if self.find(a) == self.find(b):
            return False
        depth = min(self.depth[a], self.depth[b])
        x, y = self.ancestor(a, depth), self.ancestor(b, depth)
        if self.hash[x] == self.hash[y]:
            if self.verified(x, y):
                return self.depth[a] < self.depth[b]
            return self.text(a) < self.text(b)
        for k in reversed(range(depth.bit_length())):
            if k < len(self.up[x]) and self.hash[self.up[x][k]] != self.hash[self.up[y][k]]:
                x, y = self.up[x][k], self.up[y][k]
        if not self.verified(self.up[x][0], self.up[y][0]):
            return self.text(a) < self.text(b)
        return self.char[x] < self.char[y]


def ways(codes: bytes, start: int) -> list[tuple[int, int, int, str]]:
    """(start, state, cost, audit) of the cheapest edits from ``start`` to every state."""
    audits = Audits()

    def best(old: tuple[int, int, str] | None, new: tuple[int, int, str]) -> tuple[int, int, str]:
        """The cheaper of two (cost, node, next edit); of equal cost the lesser audit."""
        if old is None or new[0] < old[0]:
            return new
        if new[0] > old[0]:
            return old
        return new if audits.less(audits.add(new[1], new[2]), audits.add(old[1], old[2])) else old

    def insert(states: dict[int, tuple[int, int]]) -> None:
        """Insertions: to ``u`` from any other state, then from there to ``a``."""
        for to, sources in ((AFTER_U, (NONE, AFTER_S, AFTER_A)), (AFTER_A, (AFTER_U,))):
            got = None
            for s in sources:
                if s in states:
                    got = best(got, (states[s][0] + 5, states[s][1], "I"))
            if got is None or (to in states and states[to][0] < got[0]):
                continue
            node = audits.add(got[1], got[2])
            if to not in states or got[0] < states[to][0] or audits.less(node, states[to][1]):
                states[to] = (got[0], node)

    states = {start: (0, 0)}
    insert(states)
    for code in codes:
        kind, more = code & 3, 5 if code & TRUNCATED else 0
        found: dict[int, tuple[int, int, str]] = {}
        for s, (cost, node) in states.items():
            found[s] = best(found.get(s), (cost + 2, node, "D"))
            if code & MUST_GO:
                continue
            due = AFTER_A if s == AFTER_U else AFTER_U
            kept = kind == due - 1
            found[due] = best(found.get(due), (cost + more + (not kept), node, "K" if kept else "R"))
            if s == NONE and kind == 0:
                found[AFTER_S] = best(found.get(AFTER_S), (cost + more, node, "K"))
        states = {s: (cost, audits.add(node, char)) for s, (cost, node, char) in found.items()}
        insert(states)
    return [(start, s, cost, audits.text(node)) for s, (cost, node) in sorted(states.items())]


def _piece(codes: bytes, turns: list[int | None], faults: list[int], whole: bool, memo: dict) -> dict:
    """What a piece adds to its conversation; ``whole``: it starts the conversation."""
    key = (codes, whole)
    got = memo.get(key)
    if got is None:
        got = [w for s in ((NONE,) if whole else range(4)) for w in ways(codes, s)]
        if len(codes) <= 64:
            if len(memo) >= REMEMBERED:
                memo.clear()
            memo[key] = got
    kinds = [c & 3 for c in codes]
    known = [t for t in turns if t is not None]
    return {"n": len(codes), "blank": faults[0], "duplicate": faults[1], "truncated": faults[2],
            "illegal": sum(p not in LEGAL for p in zip(kinds, kinds[1:])), "first": kinds[0], "last": kinds[-1],
            "low": known[0] if known else None, "high": known[-1] if known else None, "turns": len(set(known)),
            "ways": [dict(zip(("a", "b", "cost", "audit"), w)) for w in got]}


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per piece of a conversation; rows come in order.  Only a
    partition's first conversation, and pieces after a first one, may go on from
    earlier rows."""
    no_state()
    memo: dict = {}
    schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("sha", pa.binary()),
                        ("piece", pa.struct([(k, pa.int64()) for k in ("n", "blank", "duplicate", "truncated", "illegal")]
                                            + [("first", pa.int32()), ("last", pa.int32())]
                                            + [(k, pa.int64()) for k in ("low", "high", "turns")]
                                            + [("ways", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()),
                                                                            ("cost", pa.int64()), ("audit", pa.string())])))]))])
    out: list[dict] = []
    conv, head, starts = None, None, False
    codes, turns, faults = bytearray(), [], [0, 0, 0]

    def close() -> None:
        nonlocal starts, head
        if codes:
            out.append({"conv_id": conv, **head, "piece": _piece(bytes(codes), list(turns), list(faults), starts, memo)})
            codes.clear()
            turns.clear()
            faults[:] = [0, 0, 0]
        starts, head = False, None

    fresh = True
    for batch in batches:
        for c, turn, role, sha, code, copies, first in zip(*(batch.column(n).to_pylist() for n in (
                "conv_id", "turn", "role", "sha", "code", "copies", "first")), strict=True):
            if fresh or c != conv:
                close()
                conv, starts, fresh = c, not fresh, False
            for n in range(copies):
                if len(codes) >= PIECE_ROWS:
                    close()
                if head is None:
                    head = {"turn": turn, "role": role, "sha": sha}
                fault = 0 if code & MUST_GO else 1 if n or not first else 2 if code & TRUNCATED else None
                codes.append(code & 3 | (MUST_GO if fault in (0, 1) else 0) | (TRUNCATED if fault == 2 else 0))
                turns.append(turn)
                if fault is not None:
                    faults[fault] += 1
        if len(out) >= 500:
            yield pa.RecordBatch.from_pylist(out, schema)
            out = []
    close()
    yield pa.RecordBatch.from_pylist(out, schema)


def _combined(pieces: list[dict]) -> dict:
    """Counts, cost and audit of a whole conversation."""
    states: dict[int, tuple[int, str]] = {NONE: (0, "")}
    out = {k: sum(p[k] for p in pieces) for k in ("blank", "duplicate", "truncated", "illegal")}
    out["illegal"] += sum((p["last"], q["first"]) not in LEGAL for p, q in zip(pieces, pieces[1:]))
    for p in pieces:
        found: dict[int, tuple[int, str]] = {}
        for w in p["ways"]:
            if w["a"] in states:
                cost, audit = states[w["a"]]
                new = (cost + w["cost"], audit + w["audit"])
                found[w["b"]] = min(found.get(w["b"], new), new)
        states = found
    known = [p for p in pieces if p["low"] is not None]
    turns = sum(p["turns"] for p in known) - sum(p["high"] == q["low"] for p, q in zip(known, known[1:]))
    out["gaps"] = known[-1]["high"] - known[0]["low"] + 1 - turns if known else 0
    out["cost"], out["audit"] = min(states[s] for s in (NONE, AFTER_A) if s in states)
    return out


class _Rewriter:
    """Applies an audit to the rows of its conversation, one after another."""

    def __init__(self, audit: str, put: Callable[[str, str], None]):
        self.audit, self.at, self.state, self.put, self.last = audit, 0, NONE, put, None

    def _due(self, text: str, role: str | None = None) -> None:
        self.state = AFTER_A if self.state == AFTER_U else AFTER_U
        self.put(role if role is not None else "user" if self.state == AFTER_U else "assistant", text)

    def inserts(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self._due("")
            self.at += 1

    def row(self, role: str, text: str, copies: int) -> None:
        for _ in range(copies):
            self.inserts()
            edit = self.audit[self.at]
            self.at += 1
            if edit == "R":
                self._due(text)
            elif edit == "K" and role[:1] == "s":
                self.state = AFTER_S
                self.put(role, text)
            elif edit == "K":
                self._due(text, role)


def _rewrite(rows: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Streams conversations, pieces before rows; gives reports, or the repaired rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        no_state()
        out: dict[str, list] = {}
        names = ["conv_id", "position", "role", "text"] if rows else [x.split()[0] for x in REPORT.split(", ")]
        conv, pieces, report, writer, digest, size = None, [], None, None, None, 0

        def put(role: str, text: str) -> None:
            nonlocal size
            if rows:
                for n, v in zip(names, (conv, size, role, text), strict=True):
                    out.setdefault(n, []).append(v)
            else:
                digest.update(((("\n" if size else "") + role + ":" + text)).encode("utf-8", "surrogatepass"))
            size += 1

        def begin() -> None:        # all pieces are read
            nonlocal report, writer, digest, size
            report = _combined(pieces) if pieces else {"audit": "", **dict.fromkeys(
                ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), 0)}
            digest, size = hashlib.sha256(), 0
            writer = _Rewriter(report["audit"], put)

        def end() -> None:
            if writer is None:
                begin()
            writer.inserts()
            if not rows:
                for n in names:
                    out.setdefault(n, []).append(conv if n == "conv_id" else digest.hexdigest() if n == "repaired_sha256"
                                                 else report[n])

        def flush() -> pa.RecordBatch:
            kinds = {"conv_id": pa.int64(), "role": pa.string(), "text": pa.string(), "audit": pa.string(),
                     "repaired_sha256": pa.string()}
            got = pa.RecordBatch.from_arrays([pa.array(out.get(n, []), kinds.get(n, pa.int64())) for n in names], names)
            out.clear()
            return got

        started = False
        for batch in batches:
            for c, kind, role, text, copies, piece in zip(*(batch.column(n).to_pylist() for n in (
                    "conv_id", "kind", "role", "text", "copies", "piece")), strict=True):
                if not started or c != conv:
                    if started:
                        end()
                    conv, pieces, writer, started = c, [], None, True
                if kind == 1:
                    pieces.append(piece)
                elif kind == 2:
                    if writer is None:
                        begin()
                    writer.row(role, text, copies)
            if out:
                yield flush()
        if started:
            end()
        yield flush()

    return run


def _prepared(conversations: DataFrame, copies: str | None) -> DataFrame:
    """(conv_id, turn, role, text, copies, sha, code); null roles and texts are one space."""
    text = F.coalesce(F.col("text"), F.lit(" "))
    role = F.coalesce(F.col("role"), F.lit(" "))
    d = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
                             role.alias("role"), text.alias("text"),
                             (F.col(copies) if copies else F.lit(1)).cast("bigint").alias("copies"))
    trimmed = F.rtrim("text", F.lit(BLANKS))
    first = F.substring("role", 1, 1)
    kind = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    code = (kind + F.when(trimmed == "", MUST_GO)
            .when(F.substring(trimmed, -1, 1).isin(".", "!", "?"), 0).otherwise(TRUNCATED))
    return d.select("*", F.unhex(F.sha2(F.col("text"), 256)).alias("sha"), code.cast("int").alias("code"))


def _order(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).asc_nulls_first()


KEY = ("conv_id", "turn", "role", "sha")


def _streamed(conversations: DataFrame, ids: DataFrame | None, copies: str | None) -> DataFrame:
    """Heads, pieces and rows of all conversations, dealt and sorted by conversation."""
    d = _prepared(conversations, copies)
    # equal rows are one row with a count, before anything is dealt by conversation
    light = d.groupBy(*KEY).agg(F.sum("copies").alias("copies"), F.max("code").alias("code"))
    seen = (light.groupBy("conv_id", "role", "sha").agg(F.min(F.struct(F.col("turn").isNotNull(), F.col("turn"))).alias("m"))
            .select(F.col("conv_id").alias("c"), F.col("m.turn").alias("t"), F.col("role").alias("r"), F.col("sha").alias("s"),
                    F.lit(True).alias("first")))
    # joined on all of a row's key, so that a text said a million times is no hot key
    marked = light.join(seen, F.col("conv_id").eqNullSafe(F.col("c")) & F.col("turn").eqNullSafe(F.col("t"))
                        & (F.col("role") == F.col("r")) & (F.col("sha") == F.col("s")), "left")
    marked = stored(marked.select(*KEY, "copies", "code", F.coalesce("first", F.lit(False)).alias("first")), "turns")
    keys = [_order(c) for c in KEY]
    pieces = (marked.repartitionByRange(*keys).sortWithinPartitions(*keys)
              .mapInArrow(_pieces, f"conv_id bigint, turn bigint, role string, sha binary, piece {PIECE}"))
    null = {"turn": "bigint", "role": "string", "sha": "binary", "text": "string", "copies": "bigint", "piece": PIECE}

    def part(df: DataFrame, kind: int) -> DataFrame:
        return df.select("conv_id", F.lit(kind).alias("kind"),
                         *[F.col(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in null.items()])

    heads = (ids if ids is not None else conversations).select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()
    every = part(heads, 0).union(part(pieces, 1)).union(part(d.drop("code"), 2))
    return every.repartition("conv_id").sortWithinPartitions(*[_order(c) for c in ("conv_id", "kind", "turn", "role", "sha")])


def reports(conversations: DataFrame, ids: DataFrame | None = None, copies: str | None = None) -> DataFrame:
    """One row per conversation: (conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256).

    ``conversations`` has (conv_id, turn, role, text); further columns are
    ignored.  Rows are ordered by turn (nulls first), then role, then the SHA-256
    of the text; what ties in all of them is equal.  ``copies`` names a column of
    how often a row stands there.  Null roles and texts are one space (a text that
    is blank, a role that cannot stay); rows without a conv_id are one
    conversation.  ``ids`` names conversations to report although they may hold
    no row: zeros, an empty audit and the hash of an empty string.  An empty table
    gives an empty result.
    """
    return _streamed(conversations, ids, copies).mapInArrow(_rewrite(rows=False), REPORT)


def repaired(conversations: DataFrame, copies: str | None = None) -> DataFrame:
    """The repaired conversations: (conv_id, position from 0, role, text)."""
    return _streamed(conversations, None, copies).mapInArrow(_rewrite(rows=True), ROWS)


def damaged(conversations: DataFrame) -> DataFrame:
    """Known damage for tests and the query: by crc32(``conv_id:turn``) % 20 a row
    is dropped (0), emptied (1), robbed of ``.!?`` (2), doubled (3, as ``copies``)
    or given the role user (4).  Nulls count as one space."""
    def known(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    code = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn")).cast("binary")) % 20
    text = F.when(code == 1, "").when(code == 2, F.translate(known("text"), ".!?", "")).otherwise(known("text"))
    return (conversations.select("conv_id", "turn", F.when(code == 4, "user").otherwise(known("role")).alias("role"),
                                 text.alias("text"), F.when(code == 3, 2).otherwise(1).alias("copies"), code.alias("damage"))
            .where("damage <> 0").drop("damage"))
