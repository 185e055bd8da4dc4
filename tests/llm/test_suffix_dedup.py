import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stopcast.llm import suffix_dedup
from stopcast.llm.suffix_array import common_prefixes, suffix_array

from llm_helpers import EDGES, documents, plain, words


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60) | st.lists(st.integers(0, 2000), max_size=60))
def test_suffix_array_is_the_sorted_order(text):
    got = suffix_array(np.array(text, np.int64)).tolist()
    assert got == sorted(range(len(text)), key=lambda i: text[i:])


def test_suffix_array_of_many_names():
    r = np.random.default_rng(1)
    text = r.integers(0, 4, 30_000)
    text[10_000:20_000] = text[:10_000]
    order = suffix_array(text)
    raw = bytes(text.astype(np.uint8).tolist())
    assert sorted(order.tolist()) == list(range(len(text)))
    some = r.integers(1, len(text), 3000)
    assert all(raw[order[i - 1]:] < raw[order[i]:] for i in some.tolist())


def test_common_prefixes():
    text = np.random.default_rng(2).integers(0, 2, 500)
    order = suffix_array(text)
    got = common_prefixes(text, order, np.array([0, 7, 300, 499]), 20)
    for i, j in zip(order[:-1].tolist(), order[1:].tolist(), strict=True):
        n = 0
        while n < 20 and max(i, j) + n < 500 and text[i + n] == text[j + n]:
            n += 1
        assert got[j] == n
    assert got[order[0]] == 0


def brute(rows):
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - 99):
            w = raw[i:i + 100]
            if w in seen:
                gone[i:i + 100] = True
            seen.add(w)
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((doc_id, len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [0, 1])
def test_against_brute_force(spark, seed):
    r = random.Random(seed)
    passages = [words(100 + i, 40) for i in range(5)]
    rows = [(i, words(i, r.randint(0, 50)) + r.choice(passages)[r.randint(0, 60):] + words(-i, r.randint(0, 50)) +
             (r.choice(passages) if r.random() < 0.4 else "")) for i in range(80)]
    rows += [(200 + i, rows[i][1]) for i in range(10)] + [(300, "x" * 700), (301, "x" * 100), (302, "x" * 99), (303, "ab" * 300),
             (304, rows[3][1] + "!"), (-5, rows[4][1])]
    rows.append((305, "".join(r.choice("ab") for _ in range(300_000))))
    r.shuffle(rows)
    got = suffix_dedup.duplicate_substrings(plain(spark, rows).repartition(3)).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_many_files(spark, monkeypatch):
    rows = [(i, words(i % 7, 60) + words(i, 30)) for i in range(60)]
    got = suffix_dedup.duplicate_substrings(plain(spark, rows).repartition(8)).collect()     # a file a partition at least
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_edges(spark):
    got = suffix_dedup.duplicate_substrings(documents(spark, EDGES), keep_bytes=True)
    rows = [tuple(r)[:5] for r in got.collect()]
    assert sorted(rows, key=str) == brute(EDGES)        # equal ids: as they are read
    assert suffix_dedup.duplicate_substrings(documents(spark, [])).count() == 0


def test_shards_split_by_anchor():
    r = random.Random(4)
    core = bytes(r.randrange(97, 100) for _ in range(150))
    texts = sorted({core[i:i + 120] for i in range(0, 30, 3)})
    s = np.zeros(len(texts), suffix_dedup.SEGMENT)
    s["size"], s["doc_id"] = [len(t) for t in texts], range(len(texts))
    segment, start, end = suffix_dedup.shard_spans(s, texts)
    seen, want = set(), set()
    for i, t in enumerate(texts):
        for o in range(len(t) - 99):
            if t[o:o + 100] in seen:
                want.add((i, o))
            seen.add(t[o:o + 100])
    assert set(zip(segment.tolist(), start.tolist(), strict=True)) == want and (end - start == 100).all()


def test_hot_anchor_is_split(spark, monkeypatch):
    r = random.Random(9)
    line = "We use cookies to make this site work, see our terms of use."
    rows = [(i, "".join(r.choice("abcdefgh ") for _ in range(90)) + line + "".join(r.choice("abcdefgh ") for _ in range(90)))
            for i in range(120)]
    rows += [(500 + i, rows[i][1][10:] + "z") for i in range(30)]
    raw = [t.encode() for _, t in rows]
    file = suffix_dedup.TextFile(b"".join(raw), np.cumsum([len(t) for t in raw]), np.zeros(len(raw), bool),
                                 np.arange(len(raw)), np.arange(len(raw)))
    value, n = np.unique(file.segments()["hash"], return_counts=True)
    (known, many), = suffix_dedup.shared_hashes([suffix_dedup.pack(value, n.astype("<i8"))], 20)
    hot = np.sort(known[many])
    assert n.max() >= 100 and len(hot)
    s = suffix_dedup.spread(file.segments(hot), hot)
    distinct = np.unique(s[["hash", "digest"]])
    assert np.unique(distinct["hash"], return_counts=True)[1].max() <= 20       # was all of the line's segments
    monkeypatch.setattr(suffix_dedup, "HOT", 20)
    got = suffix_dedup.duplicate_substrings(plain(spark, rows).repartition(3)).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_dealing_does_not_grow_with_the_files():
    """The same anchors from 2,000 files cost little more than from 50."""
    import time
    r = np.random.default_rng(0)
    anchors = r.integers(0, 200_000, 400_000).astype("<u8")

    def run(files):
        blobs = [suffix_dedup.pack(a, np.ones(len(a), "<i8")) for a in np.array_split(anchors, files)]
        best = 9.0
        for _ in range(3):
            start = time.process_time()
            got = suffix_dedup.shared_hashes(blobs, 3)
            best = min(best, time.process_time() - start)
        return best, got

    (few, a), (many, b) = run(50), run(2000)
    assert many < 1.5 * few + 0.05
    assert np.array_equal(np.sort(np.concatenate([h for h, _ in a])), np.sort(np.concatenate([h for h, _ in b])))
    value, n = np.unique(anchors, return_counts=True)
    shared = dict(zip(value.tolist(), n.tolist(), strict=True))
    for h, hot in b[:20]:
        assert all(shared[v] > 1 and (shared[v] > 3) == x for v, x in zip(h.tolist(), hot.tolist(), strict=True))


def test_dealt_keeps_the_order():
    key = np.array([3, 1, 3, 2, 1], np.uint64)
    assert [(k, rows.tolist()) for k, rows in suffix_dedup.dealt(key)] == [(1, [1, 4]), (2, [3]), (3, [0, 2])]
    assert suffix_dedup.dealt(np.zeros(0, np.int64)) == []
