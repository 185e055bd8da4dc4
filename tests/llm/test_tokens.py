import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stopcast.llm import bpe_sql, token_counts, wavelet

from llm_helpers import EDGES, documents, plain, words

WORD, BYTE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TEXTS = [words(i, 50) for i in range(20)] + [
    "", " ", "  ", "a  b", "a   b ", "\n foo", "foo\n \nbar", " \n  \n x ", "aaaaaaaaaaaaaaa b", "don't I'LL we'Ve 's'S", "''s ''ll",
    "a b c\x1cd\x85e​f 　 x", "한국어 日本語 🤖👩‍👩", "x" * 400, "1234567890" * 30, "😀" * 50, " é" * 99, "\x1c \x1c a \x85 b",
    "x<|endoftext|>y <|startoftext|>", "foo  <|endoftext|>  bar", "ΣΑΣ ΟΔΟΣ Σ İ", "ǅ ſ ẞ ß ﬁ Ω K ½ Ⅷ ४", "é ́a"]
TEXT = st.text(st.sampled_from("abcdeß 'stlI1\n\t é́<|>.Σ日"), max_size=60)


@pytest.fixture(scope="module")
def libraries():
    ranks = bpe_sql.read_ranks(RANKS)
    return (Tokenizer.from_file(WORD), Tokenizer.from_file(BYTE),
            tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}))


@pytest.fixture(scope="module")
def coders():
    return token_counts.Counter(WORD), wavelet.ByteEncoder(BYTE), bpe_sql.SqlBPE(bpe_sql.read_ranks(RANKS), public_tokenizers.PATTERN)


def check(texts, libraries, coders):
    assert coders[0](texts) == [len(libraries[0].encode(t, add_special_tokens=False).ids) for t in texts]
    (ids, starts), (decoded, ends) = coders[2].coder(texts)
    for i, (t, byte) in enumerate(zip(texts, coders[1](texts), strict=True)):
        assert byte.tolist() == libraries[1].encode(t, add_special_tokens=False).ids, t
        assert ids[starts[i]:starts[i + 1]].tolist() == libraries[2].encode_ordinary(t), t
        assert decoded[ends[i]:ends[i + 1]].tobytes() == t.encode()


def test_libraries_agree(libraries, coders):
    check(TEXTS, libraries, coders)


@settings(max_examples=60, deadline=None)
@given(st.lists(TEXT, max_size=4))
def test_any_text(texts):
    ranks = bpe_sql.read_ranks(RANKS)
    if not hasattr(test_any_text, "made"):
        test_any_text.made = (
            (Tokenizer.from_file(WORD), Tokenizer.from_file(BYTE),
             tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})),
            (token_counts.Counter(WORD), wavelet.ByteEncoder(BYTE), bpe_sql.SqlBPE(ranks, public_tokenizers.PATTERN)))
    check(texts, *test_any_text.made)


def test_caches_are_bounded(monkeypatch, libraries):
    monkeypatch.setattr(token_counts, "CACHE_UNITS", 30)
    monkeypatch.setattr(wavelet, "CACHE_UNITS", 30)
    monkeypatch.setattr(bpe_sql, "CACHE_UNITS", 30)
    made = token_counts.Counter(WORD), wavelet.ByteEncoder(BYTE), bpe_sql.SqlBPE(bpe_sql.read_ranks(RANKS), public_tokenizers.PATTERN)
    for t in TEXTS:
        check([t], libraries, made)


def test_sparing_workers_hold_less(libraries, monkeypatch):
    """Half the cached units and smaller queries, after any number of texts; the same ids and bytes."""
    monkeypatch.setattr(bpe_sql, "CACHE_UNITS", 60)
    monkeypatch.setattr(bpe_sql, "CHUNK_BYTES", 40)
    ranks = bpe_sql.read_ranks(RANKS)
    usual, sparing = bpe_sql.SqlBPE(ranks, public_tokenizers.PATTERN), bpe_sql.SqlBPE(ranks, public_tokenizers.PATTERN, sparing=True)
    held = []
    for t in [" ".join(f"q{i}z{j}" for j in range(20)) for i in range(6)]:
        (ids, _), (decoded, _) = sparing.coder([t])
        assert ids.tolist() == usual.coder([t])[0][0].tolist() == libraries[2].encode_ordinary(t) and decoded.tobytes() == t.encode()
        held.append((len(usual.coder.units.number), len(sparing.coder.units.number)))
    assert max(b for _, b in held) <= 30 < max(a for a, _ in held) <= 60 and sparing.chunk_bytes == 20


def test_sparing_round_trip(spark, monkeypatch):
    """The pipeline's stage asks for it; the rows are the same in any size of groups."""
    import corpus_pipeline
    asked = []
    monkeypatch.setattr(corpus_pipeline.bpe_sql, "bpe_round_trip", lambda *a, **k: asked.append(k))
    corpus_pipeline.token_stage(spark, None, "")
    assert asked == [dict(keep_ids=True, sparing=True)]
    monkeypatch.undo()
    rows = [(i, words(i, 30)) for i in range(40)] + [(None, None), (50, "z" * 60_000), (51, "")]
    df = plain(spark, rows).coalesce(1)
    usual = bpe_sql.bpe_round_trip(df, RANKS, public_tokenizers.PATTERN, keep_ids=True).collect()
    monkeypatch.setattr(bpe_sql, "GROUP_BYTES", 1_000)
    spare = bpe_sql.bpe_round_trip(df, RANKS, public_tokenizers.PATTERN, keep_ids=True, sparing=True).collect()
    assert sorted(map(str, usual)) == sorted(map(str, spare)) and len(spare) == len(rows)


def test_long_pre_tokens(libraries, coders):
    """Words without a break, merged by the heap and (shorter ones) by the query."""
    import random
    r = random.Random(0)
    texts = ["x" * 100_000, "".join(r.choice("abcdefgh") for _ in range(60_000)), "=" * 5_000, " " * 4_000 + "a",
             "é" * 1_500, "".join(r.choice("aeinrst") for _ in range(1_900)), "ab" * 1_100]
    ids, starts = coders[2].coder(texts)[0]
    for i, t in enumerate(texts):
        assert ids[starts[i]:starts[i + 1]].tolist() == libraries[2].encode_ordinary(t)
    for w in ("thenation", "ababab", "ing" * 5, "é日本" * 4, "a"):
        assert coders[2].merge_long(w.encode()).tolist() == libraries[2]._core_bpe.encode_single_piece(w.encode())


@pytest.mark.parametrize("kind", ["letters", "one", "mixed"])
def test_unbroken_texts(libraries, kind):
    """Texts of 1 MB and more without a space: the library's ids and bytes, in bounded memory."""
    import random
    import resource
    r = random.Random(1)
    text = {"letters": lambda: "".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=1_000_000)), "one": lambda: "x" * 3_000_000,
            "mixed": lambda: "".join(r.choices("etaoin é1.,", k=400_000)) + "a b " + "\u00e9" * 700_000}[kind]()
    assert bpe_sql.unbroken(text) or kind == "mixed"
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    ids, sha = bpe_sql.SqlBPE(bpe_sql.read_ranks(RANKS), public_tokenizers.PATTERN).whole(text)
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 900_000
    assert sha == hashlib.sha256(text.encode()).hexdigest()
    if kind == "letters":
        half = libraries[2].encode_ordinary(text[:300_000])
        assert ids[:len(half) - 20].tolist() == half[:-20]
    else:
        assert ids.tolist() == libraries[2].encode_ordinary(text)


def test_unbroken_texts_among_others(spark, libraries, monkeypatch):
    monkeypatch.setattr(bpe_sql, "DECODE_IDS", 7)
    rows = [(1, "ab cd"), (2, "z" * 60_000), (3, ""), (4, "é" * 55_000 + " tail"), (5, "end")]
    coder = bpe_sql.SqlBPE(bpe_sql.read_ranks(RANKS), public_tokenizers.PATTERN)
    for _, t in rows:
        ids, sha = coder.whole(t)
        assert ids.tolist() == libraries[2].encode_ordinary(t) and sha == hashlib.sha256(t.encode()).hexdigest()
    got = {r.doc_id: r for r in bpe_sql.bpe_round_trip(plain(spark, rows), RANKS, public_tokenizers.PATTERN, keep_ids=True).collect()}
    for i, t in rows:
        assert got[i].ids == libraries[2].encode_ordinary(t) and got[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
        assert got[i].n_tokens == len(got[i].ids) and got[i].ids_sha256 == hashlib.sha256(np.array(got[i].ids, "<u4").tobytes()).hexdigest()


def test_queries_on_edges(spark, libraries):
    df = documents(spark, EDGES)
    got = sorted(map(tuple, token_counts.token_counts(df, WORD, 100).collect()), key=str)
    want = []
    for i, t in EDGES:
        n = len(libraries[0].encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 100))
    assert got == sorted(want, key=str)
    got = sorted(map(tuple, bpe_sql.bpe_round_trip(df, RANKS, public_tokenizers.PATTERN).collect()), key=str)
    want = []
    for i, t in EDGES:
        ids = np.array(libraries[2].encode_ordinary(t or ""), "<u4")
        want.append((i, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    for out in (token_counts.token_counts(documents(spark, []), WORD),
                bpe_sql.bpe_round_trip(documents(spark, []), RANKS, public_tokenizers.PATTERN, keep_ids=True)):
        assert out.count() == 0


def test_token_files(spark, libraries):
    rows = [*EDGES, *[(50 + i, t) for i, t in enumerate(TEXTS)]]
    got = wavelet.token_file_round_trip(documents(spark, rows).repartition(3), BYTE).collect()
    start, want = 0, {}
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array(libraries[1].encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        want[start] = (i, len(ids), zlib.crc32(ids))
        start += len(ids)
    assert {r.start: (r.doc_id, r.n_tokens, r.ids_crc32) for r in got} == want
    assert wavelet.token_file_round_trip(documents(spark, []), BYTE).count() == 0


@pytest.mark.parametrize("n", [0, 1, 63, 512, 513, 3000])
def test_wavelet_matrix(n):
    r = np.random.default_rng(n)
    v = r.integers(0, 40, n).astype(np.uint16)
    shard = wavelet.TokenShard(wavelet.WaveletMatrix.build(v, 6), [None, 3], np.array([0, n]))
    m = wavelet.TokenShard.from_bytes(shard.to_bytes()).matrix
    assert (m.all() == v).all() and (m.access(np.arange(n)) == v).all()
    for t in (0, 7, 39, 63, 64):
        assert m.count(t) == (v == t).sum() and m.occurrences(t).tolist() == np.flatnonzero(v == t).tolist()
        assert m.count(t, n // 4, n // 2) == (v[n // 4:n // 2] == t).sum()
