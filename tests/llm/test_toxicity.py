import random
import zlib

import numpy as np

from stopcast.llm import toxicity

from llm_helpers import EDGES, documents, plain, words

RUDE = ["blargh", "snorkface", "gitwit"]


def corpus(n=600):
    r = random.Random(0)
    rows, labels = [], []
    for i in range(n):
        w = words(i, r.randint(5, 80)).split()
        toxic = i % 4 == 0
        if toxic:
            for _ in range(r.randint(1, 4)):
                w.insert(r.randrange(len(w)), r.choice(RUDE) + r.choice(["", "s", "ing", "!"]))
        rows.append((i, " ".join(w)))
        if i % 10 != 7:
            labels.append((i, 1, int(toxic)))
    return rows, labels


def marks(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    got = toxicity.scores(plain(spark, rows).repartition(3), marks(spark, labels)).collect()
    assert len(got) == len(rows)
    for x in got:
        assert x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 5 == 0)
        assert 0 <= x.score <= 1 and x.predicted == int(x.score >= 0.5)
    held = [x for x in got if x.held_out]
    assert sum(x.predicted == int(x.doc_id % 4 == 0) for x in held) > 0.97 * len(held)


def test_held_out_labels_change_nothing(spark):
    rows, labels = corpus(200)
    flipped = [(d, q, 1 - t) if zlib.crc32(str(d).encode()) % 5 == 0 else (d, q, t) for d, q, t in labels]
    a = {x.doc_id: x.score for x in toxicity.scores(plain(spark, rows), marks(spark, labels)).collect()}
    b = {x.doc_id: x.score for x in toxicity.scores(plain(spark, rows), marks(spark, flipped)).collect()}
    assert a == b


def test_edges(spark):
    rows, labels = corpus(100)
    labels += [(None, 1, 1), (5, None, None), (1, 1, 3), (999, 1, 1), (4, 0, 0), (4, 0, 1)]
    docs = documents(spark, [*EDGES, *[(100 + d, t) for d, t in rows]])
    got = toxicity.scores(docs, marks(spark, [(None if d is None else 100 + d, q, t) for d, q, t in labels])).collect()
    assert len(got) == len(EDGES) + 100 and all(0 <= x.score <= 1 for x in got)
    assert len({x.score for x in got if x.doc_id in (1, 2, 3)}) == 1
    for some in ([], [(100, 1, 0)], [(100, 1, 1)]):
        assert len(toxicity.scores(docs, marks(spark, some)).collect()) == len(EDGES) + 100
    assert toxicity.scores(documents(spark, []), marks(spark, labels)).count() == 0
    kept = toxicity.without_toxic(docs, marks(spark, []))
    assert kept.count() == len(EDGES) + 100 and kept.columns == docs.columns


def test_packed_expressions():
    key, row = toxicity.symbols(["ab", "", "日x!"])
    low = (1 << toxicity.BITS) - 1
    assert row.tolist() == [0, 0, 0, 1, 2, 2, 2]
    assert [int(k) & low for k in key][:4] == [ord("a"), ord("b"), 1, 1]
    assert int(key[1]) >> toxicity.BITS & low == ord("a") and int(key[0]) >> toxicity.BITS & low == 2
    assert (key < 1 << toxicity.BITS * toxicity.ORDER).all()


def test_unseen_words_say_nothing(spark):
    rows, labels = corpus(120)
    grams = toxicity.count_grams(plain(spark, rows).selectExpr("text", "cast(1 + doc_id % 2 as int) as part"))
    model = toxicity.Model(toxicity.model_tables(grams, ["toxic_fit"], ["plain_fit"]))
    assert np.allclose(model.evidence(["日本語", "中文"])[0:2], 0, atol=2)
    p = model.shared(toxicity.symbols(["river"])[0])
    assert ((p > 0) & (p <= 1)).all()


def test_counts_are_exact_beyond_any_table_size(spark):
    # symbols beyond the old 12 bits, and expressions that shared a slot of 2,097,143
    a, b = chr(3600), chr(3600 + 596)
    assert toxicity.symbols([a])[0][0] != toxicity.symbols([b])[0][0]
    rows = [(i, chr(0x4E00 + i) + chr(0x5E00 + i)) for i in range(2000)]
    got = toxicity.count_grams(plain(spark, rows).selectExpr("text", "cast(1 + doc_id % 2 as int) as part")).collect()
    assert len(got) == 3 * len(rows) and all(x.toxic_fit + x.plain_fit == 1 for x in got)


def test_evidence_is_that_of_one_table(spark, monkeypatch):
    rows, labels = corpus(200)
    want = {x.doc_id: x.score for x in toxicity.scores(plain(spark, rows), marks(spark, labels)).collect()}
    monkeypatch.setattr(toxicity, "PART_BYTES", 20_000)     # some parts, and a chunk a partition
    got = {x.doc_id: x.score for x in toxicity.scores(plain(spark, rows).repartition(5), marks(spark, labels)).collect()}
    assert got.keys() == want.keys() and all(abs(got[d] - want[d]) < 1e-6 for d in want)


def test_words_stay_with_their_parts(spark, tmp_path, monkeypatch):
    """The words are shuffled once, and what was written for that is gone when the parts have them."""
    rows, labels = corpus(200)
    monkeypatch.setattr(toxicity, "shared_folder", lambda s, name: f"{tmp_path}/{name}")
    monkeypatch.setattr(toxicity, "PART_BYTES", 20_000)
    docs = plain(spark, rows).repartition(3)
    path, chunks, _ = toxicity.fit(docs, marks(spark, labels), docs.doc_id)
    names = [r.chunk for r in chunks.select("chunk").collect()]
    assert len(names) == 3 and not (tmp_path / "words").exists()
    for name in names:
        codes, ends, home, *_ = toxicity.load(path, name)
        assert len(codes) == ends[-1] and set(codes.tolist()) == set(range(len(home)))
    of_parts = [f.name for f in (tmp_path / "chunks").iterdir() if f.name not in names]
    found = [toxicity.load_part(path, f) for f in of_parts]
    assert len(found) > 1 and all(sorted(f[1]) == sorted(set(f[1])) and set(f[1]) <= set(names) for f in found)
    every = [w for f in found for w in f[0]]
    assert sorted(every) == sorted({w for _, t in rows for w in toxicity.words_of(t)})


def test_numbers_survive_packing():
    for x in ([], [0], [5, 3, 2**32 - 1, 0, 70_000]):
        x = np.array(x, "<u4")
        assert (toxicity.from_planes(toxicity.planes(x)) == x).all() and (toxicity.from_steps(toxicity.steps(x)) == x).all()
        assert len(toxicity.from_steps(toxicity.steps(x))) == len(x)
