import random

import numpy as np
import public_tokenizers
import tiktoken

import corpus_pipeline
from stopcast.llm import bpe_sql, decontam, pii_crf, queries, simhash_bk
from stopcast.llm.common import read

from llm_helpers import words

SF001 = "/root/testdata/sf0.001"


def test_registered():
    import __spark_entry__
    names = set(__spark_entry__.queries())
    assert {f"op{n}" for n in range(1, 14)} == {x.split("_")[0] for x in queries.QUERIES} and set(queries.QUERIES) | {"pipeline"} <= names


def tables(spark, tmp_path):
    r = random.Random(0)
    item = words(999, 30)
    rows = []
    for i in range(200):
        w = words(i, 80).split()
        if i % 5 == 0:
            w[10:10] = ["blargh", "snorkface"]
        if i % 7 == 1:
            w.append("mail me@host.example.com")
        if i % 9 == 2:
            w[5:5] = item.split()
        rows.append((i, " ".join(w), "en", f"s{r.randrange(3)}", 0))
    rows += [(300 + i, rows[i][1], "en", "s0", 0) for i in range(1, 20)] + [(None, None, None, None, None), (400, "", "en", "s", 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    sf = f"file://{tmp_path}"
    spark.createDataFrame(rows, schema).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(200) if i % 6], "doc_id long, quality int, toxic int") \
        .write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    return sf, rows


def test_stages_against_brute_force(spark, tmp_path):
    sf, rows = tables(spark, tmp_path)
    docs = read(spark, sf, "documents")
    columns = docs.columns
    texts = {r[0]: r[1] for r in rows}

    kept = [f for _, f in corpus_pipeline.STAGES]
    out = kept[0](spark, docs, sf)
    ids = {r.doc_id for r in out.collect()}
    assert out.columns == columns
    toxic = {d for d in texts if d is not None and texts[d] and "blargh" in texts[d]}
    assert len(ids & toxic) <= 1 and {None, 400} <= ids and len(set(texts) - toxic - ids) <= 1

    out = kept[1](spark, docs, sf)
    assert out.columns == columns
    prints = {d: simhash_bk.majority(simhash_bk.shingle_hashes(t or "", 3)) for d, t in texts.items()}
    order = sorted(texts, key=lambda d: (d is None, d or 0))
    stay = set()
    root = {d: d for d in order}
    while True:
        new = {d: min((root[e] for e in order if (prints[d] ^ prints[e]).bit_count() <= 3), key=order.index) for d in order}
        if new == root:
            break
        root = new
    stay = set(root.values())
    assert {r.doc_id for r in out.collect()} == stay

    out = kept[2](spark, docs, sf)
    item = " ".join(decontam.words_of(words(999, 30)))
    assert {r.doc_id for r in out.collect()} == {d for d, t in texts.items() if item not in " ".join(decontam.words_of(t or ""))}

    out = kept[3](spark, docs, sf)
    assert out.columns == columns
    for r in out.collect():
        t = texts[r.doc_id]
        assert r.text == (None if t is None else pii_crf.masked(t, pii_crf.base_spans(t)))
        assert r.n_chars == (None if t is None else len(r.text))

    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                            mergeable_ranks=bpe_sql.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))
    for r in kept[4](spark, docs, sf).collect():
        assert list(r.ids) == enc.encode_ordinary(texts[r.doc_id] or "") and r.n_tokens == len(r.ids)


def test_run(spark, tmp_path):
    sf, rows = tables(spark, tmp_path)
    got = corpus_pipeline.run(spark, sf).collect()
    assert 100 < len(got) < len(rows)
    ids = [r.doc_id for r in got]
    assert len(ids) == len(set(ids)) and not {300 + i for i in range(1, 20)} & set(ids)
    assert np.array([r.n_tokens for r in got if r.doc_id == 400]).tolist() in ([0], [])


def test_empty_tables(spark, tmp_path):
    sf = f"file://{tmp_path}"
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    assert corpus_pipeline.run(spark, sf).count() == 0
