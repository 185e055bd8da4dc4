import random

import numpy as np
from pyspark.sql import functions as F

from stopcast.llm import lang_cnn

from llm_helpers import EDGES, documents

ALPHABETS = {"aa": "abdeiklmno", "bb": "eghrstuvwy", "cc": "éàçôûabmnr"}


def text(lang, seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice(ALPHABETS[lang]) for _ in range(r.randrange(2, 9))) for _ in range(n))


def held_out(df):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string, score string").repartition(3)


def test_gradients_are_those_of_the_loss(monkeypatch):
    monkeypatch.setattr(lang_cnn, "WINDOW", 12)
    r = np.random.default_rng(0)
    net = lang_cnn.Network(3)
    net.weights = {k: v.astype(float) for k, v in net.weights.items()}
    x, y = r.integers(0, 9, (6, 12)), r.integers(0, 3, 6)
    _, g = net.loss(x, y)
    for name, w in net.weights.items():
        for _ in range(6):
            at = tuple(r.integers(0, n) for n in w.shape)
            if name == "bytes":
                at = (int(r.integers(1, 9)), at[1])
            old, step = w[at], 1e-6
            w[at] = old + step
            up = net.loss(x, y)[0]
            w[at] = old - step
            down = net.loss(x, y)[0]
            w[at] = old
            assert abs((up - down) / (2 * step) - g[name][at]) < 1e-5, name


def test_tables_score_as_the_network():
    """Class scores by tables of byte pairs against the convolution written out."""
    net = lang_cnn.Network(3)
    windows = [b"short", text("cc", 1, 90).encode()[:lang_cnn.WINDOW], b"\x00\xff\n"]
    x, p = lang_cnn._matrix(windows), net.weights
    want = []
    for row in x:
        seen, pooled = p["bytes"][row], []
        for w in lang_cnn.WIDTHS:
            runs = [max(float((seen[i:i + w].ravel() * p[f"f{w}"][:, f]).sum()) for i in range(lang_cnn.WINDOW - w + 1))
                    + p[f"b{w}"][f] for f in range(lang_cnn.FILTERS)]
            pooled += [max(0.0, h) for h in runs]
        want.append(np.array(pooled) @ p["out"] + p["bias"])
    assert np.allclose(lang_cnn.Scorer(p).logits(x), want, atol=1e-4)


def test_windows_cover_every_run():
    for n in (0, 1, 4, 5, 255, 256, 257, 508, 509, 3000):
        raw = bytes(random.Random(n).randrange(256) for _ in range(n))
        pieces = lang_cnn.windows_of(raw)
        assert all(0 < len(p) <= lang_cnn.WINDOW for p in pieces)
        runs = {raw[i:i + 5] for i in range(max(0, n - 4))}
        assert runs <= {p[i:i + 5] for p in pieces for i in range(len(p))} and (n == 0) == (not pieces)


def test_held_out_accuracy(spark, monkeypatch):
    monkeypatch.setattr(lang_cnn, "TRAIN_DOCS", 300)
    rows = [(i, text(y, i, random.Random(i).choice([3, 20, 200])), y, "x", "x")
            for i, y in ((i, ["aa", "bb", "cc"][i % 3]) for i in range(900))]
    df = table(spark, rows)
    got = lang_cnn.predictions(df, ~held_out(df))
    assert got.dtypes == [("doc_id", "bigint"), ("lang_pred", "string"), ("score", "double")]
    out = [(r.doc_id, r.lang_pred, r.score) for r in got.collect()]
    crc = {r.doc_id for r in df.where(held_out(df)).select("doc_id").collect()}
    assert len(out) == 900 and all(0 <= s <= 1 for _, _, s in out)
    right = [p == ["aa", "bb", "cc"][i % 3] for i, p, _ in out if i in crc]
    assert len(right) > 100 and np.mean(right) > 0.97
    # what is held out teaches nothing: other labels there leave the scores as they are
    other = df.withColumn("lang", F.when(held_out(df), "zz").otherwise(F.col("lang")))
    again = [(r.doc_id, r.lang_pred, r.score) for r in lang_cnn.predictions(other, ~held_out(other)).collect()]
    assert sorted(again) == sorted(out)


def test_edges(spark, monkeypatch):
    monkeypatch.setattr(lang_cnn, "TRAIN_DOCS", 12)
    rows = [(100 + i, text(y, i, 30), y, "x", "x") for i in range(40) for y in ("aa", "bb")]
    odd = [(1, None), (2, ""), (3, " \n\t "), (4, "12 345 -- !"), (5, "é" * 400000), (5, "é" * 400000), (None, "abdei"), (6, "🤖 1"),
           (7, "word " * 200000), (8, "中"), (9, "\u0000a")]
    df = table(spark, rows + [(*o, None, "x", "x") for o in odd] + [(10, None, "zz", "x", "x"), (11, "", "zz", "x", "x")])
    got = {}
    for r in lang_cnn.predictions(df, F.col("doc_id") >= 2).collect():
        got.setdefault(r.doc_id, set()).add((r.lang_pred, r.score))
    assert all(got[d] == {("und", 0.0)} for d in (1, 2, 3, 4, 6, 10, 11))
    assert all(len(got[d]) == 1 and next(iter(got[d]))[0] in ("aa", "bb") for d in (5, None, 7, 8, 9))
    # nothing to learn from, and an empty table
    plain = documents(spark, EDGES).withColumn("lang", F.lit(None).cast("string"))
    assert {tuple(r)[1:] for r in lang_cnn.predictions(plain, F.lit(True)).collect()} == {("und", 0.0)}
    assert lang_cnn.predictions(plain.limit(0), F.lit(True)).collect() == []
    # clashing columns, and a third of all rows under one language
    clash = documents(spark, [(i, text("aa", i, 5)) for i in range(30)]).withColumn("lang", F.lit("aa"))
    assert {r.lang_pred for r in lang_cnn.predictions(clash, F.lit(True)).collect()} == {"aa"}
