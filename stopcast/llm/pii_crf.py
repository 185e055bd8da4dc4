"""Personal data by fixed patterns and a skip-chain conditional random field.

The patterns give the base spans (email, ip, card, phone).  The field adds
mentions that the patterns miss: a document's tokens that hold a digit, an @ or a masked one
are nodes with a label each (the other tokens are O), neighbouring tokens
share a transition potential, and every token shares a potential with the next
one in the document that repeats it or is similar (same letters and digits,
same last or first digits, same mailbox name) and with the first such one that
the patterns match.  Loopy message passing over all
links makes the labels of a document agree: a number that is no phone number
by the pattern becomes one where the document gives it in full elsewhere.

The weights are learned here, by pseudo-likelihood, from documents with base
spans (at most TRAIN_DOCS, by hash) and altered repeats of their entities:
with the entity in the document they carry its label, without it they are O.
Documents are map-only work; the sample's tokens alone reach the driver.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from stopcast.llm.common import no_state

# The kinds in their order, and their patterns.
KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
MAILBOX = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

TRAIN_DOCS = 1200           # documents, at most, that the weights are fitted on ...
TRAIN_TOKENS, TRAIN_SPANS, TRAIN_CHARS = 500, 100, 200     # ... and of each, tokens, spans and characters of a token
MINIMUM = 0.7               # probability of a label that adds a span
ROUNDS = 1000               # of messages, where a document does not settle before
MARK, SPACE, DIGIT = re.compile(r"[0-9@]+"), re.compile(r"\s"), re.compile(r"[0-9]")
MASKED_AT = re.compile(r"[\[({]at[\])}]", re.IGNORECASE)
NODE = re.compile(f"{MARK.pattern}|{MASKED_AT.pattern}", re.IGNORECASE)
EDGE = ".,;:!?\"'<>[]{}|#$%&*=~^`_/\\-"

Span = tuple[int, int, int]     # kind, start, end


# ------------------------------------------------------------ patterns

def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses, from each @ outwards (a search from
    every position would take the square of a long word's length)."""
    done, at = 0, text.find("@")
    while at >= 0:
        a = at
        while a > done and text[a - 1] in MAILBOX:
            a -= 1
        if a < at and (m := DOMAIN.match(text, at + 1)):
            yield a, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def quads(text: str) -> Iterator[tuple[int, int]]:
    """Four numbers joined by dots, leftmost first; parts of up to 255 stay."""
    for m in DOTTED.finditer(text):
        parts = m.group().split(".")
        at = m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            size = sum(map(len, four)) + 3
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in (q.lstrip("0") for q in four)):
                yield at, at + size
            at += size + 1


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """All base spans, by kind and start."""
    out = [(0, a, b) for a, b in emails(text)]
    if not DIGIT.search(text):
        return out
    out += [(1, a, b) for a, b in quads(text)]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append((2, m.start(), m.end()))
    if "+" in text:
        out += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(DIGIT.findall(m.group())) <= 15]
    return out


# ------------------------------------------------------------ tokens

class Token:
    """A token with a digit, @ or masked @, what stands beside it, and its base label."""

    __slots__ = ("text", "before", "after", "joined", "label", "start", "end")

    def __init__(self, text: str, before: str, after: str, joined: bool, label: int, start: int = 0, end: int = 0):
        self.text, self.before, self.after, self.joined, self.label = text, before, after, joined, label
        self.start, self.end = start, end


def tokens(text: str, spans: list[Span]) -> list[Token]:
    """The nodes of a text; joined: nothing but white space before it since the last."""
    out: list[Token] = []
    done = 0
    order = sorted(spans, key=lambda s: s[1])
    k = 0
    for m in NODE.finditer(text):
        if m.start() < done:
            continue
        a = m.start()
        while a > done and not text[a - 1].isspace():
            a -= 1
        end = SPACE.search(text, m.end())
        b = end.start() if end else len(text)
        joined = bool(out) and not text[done:min(a, done + 20)].strip() and a - done < 20
        before, after = text[max(0, a - 30):a].split(), text[b:b + 30].split()
        while k < len(order) and order[k][2] <= a:
            k += 1
        label, i = 0, k
        while i < len(order) and order[i][1] < b:
            if order[i][2] > a and (not label or order[i][0] + 1 < label):
                label = order[i][0] + 1
            i += 1
        out.append(Token(text[a:b], before[-1] if before else "", after[0] if after else "", joined, label, a, b))
        done = b
    return out


def bucket(n: int, *edges: int) -> int:
    return sum(n >= e for e in edges)


def features(t: Token) -> list[int]:
    """Binary features, as numbers below FEATURES."""
    core = t.text.strip(EDGE)
    digits = DIGIT.findall(core)
    letters = sum(c.isalpha() for c in core)
    parts = re.split(r"[.-]", core)
    numbers = len(parts) == 4 and all(p.isdigit() and p.isascii() and len(p) <= 3 for p in parts)
    given = [0, 1 + bucket(len(digits), 1, 3, 4, 5, 7, 9, 12, 13, 20), 11 + bucket(letters, 1, 2, 6),
             15 + bucket(core.count("-"), 1, 2, 3), 19 + bucket(core.count("."), 1, 2, 3, 4)]
    flags = ["@" in core, bool(MASKED_AT.search(core)), core.startswith("+"), core.startswith("("), core.endswith(")"), numbers,
             numbers and "-" in core, numbers and max(map(int, parts)) <= 255, 13 <= len(digits) <= 19 and letters == 0,
             13 <= len(digits) <= 19 and luhn("".join(digits)), t.before.startswith("+"), t.before.startswith("("),
             bool(t.before) and t.before[0].isdigit(), bool(t.after) and t.after[:1].isdigit(), t.after.startswith("("),
             t.label > 0]
    given += [24 + i for i, f in enumerate(flags) if f]
    if t.label:
        given.append(24 + len(flags) + t.label - 1)
    return given


FEATURES = 24 + 16 + 4
LABELS = 1 + len(KINDS)


def likeness(t: Token) -> list[str]:
    """Keys that repeated and similar tokens share."""
    core = t.text.strip(EDGE).lower()
    digits = "".join(DIGIT.findall(core))
    plain = "".join(c for c in core if c.isalnum())
    keys = ["=" + plain] if len(plain) >= 4 else []
    if len(digits) >= 7:
        keys.append("<" + digits[-7:])
    if len(digits) >= 12:
        keys.append(">" + digits[:12])
    name = re.split(r"@|[\[({]at[\])}]", core, maxsplit=1)
    if len(name) == 2 and len(name[0]) >= 3:
        keys.append("@" + "".join(c for c in name[0] if c.isalnum()))
    return keys


def skip_links(ts: list[Token]) -> list[tuple[int, int]]:
    """Each token with the next that shares a key with it, and with the key's
    first one that has a base label (the first one where none has)."""
    keys = [likeness(t) for t in ts]
    hub: dict[str, int] = {}
    for i, t in enumerate(ts):
        for k in keys[i]:
            if k not in hub or t.label and not ts[hub[k]].label:
                hub[k] = i
    last: dict[str, int] = {}
    out = set()
    for i, some in enumerate(keys):
        for k in some:
            if k in last:
                out.add((last[k], i))
            if hub[k] != i:
                out.add((min(i, hub[k]), max(i, hub[k])))
            last[k] = i
    return sorted(out)


# ------------------------------------------------------------ the field

class Field:
    """Weights of the skip-chain field: features x labels, transitions, and
    the agreement of linked tokens (on O, and on a kind)."""

    def __init__(self, weights: np.ndarray, chain: np.ndarray, agree: np.ndarray):
        self.weights, self.chain, self.agree = weights, chain, agree

    def probabilities(self, docs: list[list[Token]]) -> list[np.ndarray]:
        """Label probabilities of every token, by loopy message passing over
        all links of all documents at once, each until it has converged."""
        own, one, two, kind, of = [], [], [], [], []
        base = 0
        for d, ts in enumerate(docs):
            for i, t in enumerate(ts):
                x = self.weights[features(t)].sum(axis=0)
                if not t.joined:
                    x = x + self.chain[0]               # an O token stands before
                else:
                    one.append(base + i - 1)
                    two.append(base + i)
                    kind.append(0)
                if i + 1 == len(ts) or not ts[i + 1].joined:
                    x = x + self.chain[:, 0]            # and one after
                own.append(x)
            for i, j in skip_links(ts):
                one.append(base + i)
                two.append(base + j)
                kind.append(1)
            of += [d] * (len(one) - len(of))
            base += len(ts)
        if not base:
            return [np.zeros((0, LABELS)) for _ in docs]
        own = np.array(own)
        belief = own.copy()
        if one:
            one, two = np.array(one), np.array(two)
            pair = np.stack([self.chain, np.diag(self.agree)])[np.array(kind)]
            there, back = np.zeros((len(one), LABELS)), np.zeros((len(one), LABELS))
            of = np.array(of)
            open_ = np.arange(len(of))          # links of documents that have not converged
            for _ in range(ROUNDS):
                i, j, t, b = one[open_], two[open_], there[open_], back[open_]
                belief = own.copy()
                np.add.at(belief, j, t)
                np.add.at(belief, i, b)
                new = _message(belief[i] - b, pair[open_])
                new_back = _message(belief[j] - t, pair[open_].transpose(0, 2, 1))
                moved = np.zeros(len(docs))
                np.maximum.at(moved, of[open_], np.maximum(np.abs(new - t).max(axis=1), np.abs(new_back - b).max(axis=1)))
                there[open_], back[open_] = 0.5 * (t + new), 0.5 * (b + new_back)
                open_ = open_[moved[of[open_]] >= 1e-4]
                if not len(open_):
                    break
            belief = own.copy()
            np.add.at(belief, two, there)
            np.add.at(belief, one, back)
        p = np.exp(belief - belief.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        return np.split(p, np.cumsum([len(ts) for ts in docs])[:-1])


def _message(from_: np.ndarray, pair: np.ndarray) -> np.ndarray:
    x = from_[:, :, None] + pair
    top = x.max(axis=1)
    out = top + np.log(np.exp(x - top[:, None, :]).sum(axis=1))
    return out - out.max(axis=1, keepdims=True)


def altered(kind: int, text: str, turn: random.Random) -> list[str] | None:
    """Tokens of a repeat that the patterns do not match."""
    digits = "".join(DIGIT.findall(text))
    if kind == 0:
        return [text.replace("@", turn.choice(["[at]", "(at)"]))]
    if kind == 1:
        return [text.replace(".", "-")]
    if kind == 2:
        return [digits[:-1] + str((int(digits[-1]) + turn.randint(1, 9)) % 10)]
    if len(digits) < 10:
        return None
    tail = digits[-10:]
    return turn.choice([[f"({tail[:3]})", f"{tail[3:6]}-{tail[6:]}"], [f"{tail[:3]}-{tail[3:6]}-{tail[6:]}"]])


def train(samples: list[list[Token]], entities: list[list[tuple[int, str]]], steps: int = 400, ridge: float = 1e-4) -> Field | None:
    """Weights by pseudo-likelihood: each token's label given its neighbours'."""
    turn = random.Random(0)
    docs: list[tuple[list[Token], list[int]]] = []
    for k, (ts, own) in enumerate(zip(samples, entities, strict=True)):
        docs.append((ts, [t.label for t in ts]))
        other = entities[k - 1]
        for found, mine in ((own, True), (other, False)):
            if not found or not mine and {e for _, e in found} & {e for _, e in own}:
                continue
            kind, text = found[turn.randrange(len(found))]
            words = altered(kind, text, turn)
            if words is None:
                continue
            add = [Token(w, words[i - 1] if i else "the", words[i + 1] if i + 1 < len(words) else "the", i > 0, 0)
                   for i, w in enumerate(words)]
            front = turn.random() < 0.5
            both = add + ts if front else ts + add
            labels = [t.label for t in ts]
            new = [kind + 1 if mine else 0] * len(add)
            docs.append((both, new + labels if front else labels + new))
        if ts and own:
            # any number may stand beside an entity
            at = turn.randrange(len(ts))
            number = "".join(turn.choice("0123456789") for _ in range(turn.choice([1, 2, 4, 5, 8, 10, 16])))
            beside = Token(number, ts[at].text, ts[at].after, True, 0)
            docs.append((ts[:at + 1] + [beside] + ts[at + 1:],
                         [t.label for t in ts[:at + 1]] + [0] + [t.label for t in ts[at + 1:]]))
    rows, y, before, after, same = [], [], [], [], []
    for ts, labels in docs:
        linked = np.zeros((len(ts), LABELS))
        for i, j in skip_links(ts):
            linked[i, labels[j]] += 1
            linked[j, labels[i]] += 1
        for i, t in enumerate(ts):
            x = np.zeros(FEATURES)
            x[features(t)] = 1
            rows.append(x)
            y.append(labels[i])
            before.append(labels[i - 1] if t.joined else 0)
            after.append(labels[i + 1] if i + 1 < len(ts) and ts[i + 1].joined else 0)
            same.append(linked[i])
    if not rows:
        return None
    x, y, before, after, same = np.array(rows), np.array(y), np.array(before), np.array(after), np.array(same)
    want, prev, follow = np.eye(LABELS)[y], np.eye(LABELS)[before], np.eye(LABELS)[after]
    w, chain, agree = np.zeros((FEATURES, LABELS)), np.zeros((LABELS, LABELS)), np.zeros(2)
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (w, chain, agree)]
    for step in range(1, steps + 1):
        per_label = np.r_[agree[0], np.full(LABELS - 1, agree[1])]
        score = x @ w + prev @ chain + follow @ chain.T + same * per_label
        p = np.exp(score - score.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        gap = (want - p) / len(y)
        linked = (gap * same).sum(axis=0)
        slopes = (x.T @ gap - ridge * w, prev.T @ gap + (follow.T @ gap).T - ridge * chain,
                  np.array([linked[0], linked[1:].sum()]) - ridge * agree)
        for value, slope, (m, v) in zip((w, chain, agree), slopes, state, strict=True):
            m += 0.1 * (slope - m)
            v += 0.01 * (slope ** 2 - v)
            value += 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return Field(w, chain, np.r_[agree[0], np.full(LABELS - 1, agree[1])])


def fit(docs: DataFrame, text_col: str = "text") -> Field | None:
    """The field of a corpus (None where no document has a base span).

    Weights come from a bounded sample: the TRAIN_DOCS documents with base spans that
    are first by hash, of each at most TRAIN_TOKENS nodes and TRAIN_SPANS spans, tokens
    cut to TRAIN_CHARS characters.  What the field is applied to is never cut."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        no_state()
        kept: dict[int, str] = {}
        heap: list[int] = []
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if not text or not (spans := base_spans(text)):
                    continue
                h = xxh64_intdigest(text) >> 1
                if h in kept or len(heap) >= TRAIN_DOCS and h >= -heap[0]:
                    continue
                ts = tokens(text, spans)[:TRAIN_TOKENS]
                kept[h] = json.dumps([[[t.text[:TRAIN_CHARS], t.before, t.after, t.joined, t.label] for t in ts],
                                      [[k, text[a:b][:TRAIN_CHARS]] for k, a, b in spans[:TRAIN_SPANS]]])
                heapq.heappush(heap, -h)
                if len(heap) > TRAIN_DOCS:
                    del kept[-heapq.heappop(heap)]
        yield pa.RecordBatch.from_arrays([pa.array(list(kept), pa.int64()), pa.array(list(kept.values()), pa.string())],
                                         names=["h", "sample"])

    got = docs.select(docs[text_col].cast("string").alias("text")).mapInArrow(run, "h bigint, sample string") \
        .groupBy("h").agg(F.min("sample").alias("sample")).orderBy("h").limit(TRAIN_DOCS).collect()
    samples, entities = [], []
    for r in got:
        ts, own = json.loads(r["sample"])
        samples.append([Token(*t) for t in ts])
        entities.append([(k, e) for k, e in own])
    return train(samples, entities)


def plausible(kind: int, text: str) -> bool:
    """What a span must hold, whatever the field says."""
    digits = len(DIGIT.findall(text))
    return (("@" in text or bool(MASKED_AT.search(text))) if kind == 0 else len(re.findall(r"[0-9]+", text)) >= 4 if kind == 1
            else digits >= 12 if kind == 2 else digits >= 7)


def added_spans(text: str, ts: list[Token], p: np.ndarray, base: list[Span]) -> list[Span]:
    """Runs of tokens of one kind that touch no base span."""
    out: list[list[int]] = []
    open_ = False
    for t, q in zip(ts, p, strict=True):
        kind = int(q.argmax()) - 1
        good = kind >= 0 and q[kind + 1] >= MINIMUM and not t.label
        if good and open_ and t.joined and out[-1][0] == kind:
            out[-1][2] = t.end
        elif good:
            out.append([kind, t.start, t.end])
        open_ = good
    found = []
    for kind, a, b in out:
        part = text[a:b]
        a += len(part) - len(part.lstrip(EDGE))
        b -= len(part) - len(part.rstrip(EDGE))
        if a < b and plausible(kind, text[a:b]):
            found.append((kind, a, b))
    return found


def find(texts: list[str], field: Field | None) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, all spans) of every text."""
    base = [base_spans(t) for t in texts]
    if field is None:
        return [(b, b) for b in base]
    nodes = [tokens(t, b) for t, b in zip(texts, base, strict=True)]
    found = []
    for text, ts, p, b in zip(texts, nodes, field.probabilities(nodes), base, strict=True):
        found.append((b, sorted(set(b + added_spans(text, ts, p, b)))))
    return found


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


GROUP = 200     # texts whose messages are passed together


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) per row.

    The counts and the digest are of the base spans; ``spans`` holds the base
    spans and those that the field adds (kind:start:end in code points).  Only
    the two named columns are read.  Null and empty texts have no spans;
    repeated rows give repeated results; a null id stays null; without any
    base span in the corpus no field is fitted and none are added; an empty
    table gives an empty result.
    """
    field = fit(docs, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            rows = []
            for a in range(0, len(texts), GROUP):
                for base, all_ in find(texts[a:a + GROUP], field):
                    n = [sum(k == i for k, _, _ in base) for i in range(len(KINDS))]
                    rows.append((*n, hashlib.sha256(written(base).encode()).hexdigest(), written(all_)))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.int64()) for c in columns[:4]], pa.array(columns[4], pa.string()),
                 pa.array(columns[5], pa.string())],
                names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    return docs.select(docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].cast("string").alias("text")).mapInArrow(
        run, "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string")


def masked(text: str, spans: list[Span]) -> str:
    """``text`` with every span replaced by its kind in brackets; of
    overlapping spans the first one, extended over the others."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{KINDS[kind].upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def mask(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """``docs`` with personal data masked in the text and the length column,
    if there is one, set anew; null texts stay null."""
    field = fit(docs, text_col)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            new: list[str | None] = []
            for a in range(0, len(texts), GROUP):
                some = texts[a:a + GROUP]
                found = find([t or "" for t in some], field)
                new += [None if t is None else masked(t, all_) for t, (_, all_) in zip(some, found, strict=True)]
            yield batch.set_column(at, batch.schema.names[at], pa.array(new, batch.column(at).type))

    out = docs.mapInArrow(run, docs.schema)
    if length_col in docs.columns:
        out = out.withColumn(length_col, F.length(text_col).cast(docs.schema[length_col].dataType))
    return out
