import random

import numpy as np
from pyspark.sql import functions as F

from stopcast.llm import simhash_bk
from stopcast.llm.common import components

from llm_helpers import EDGES, documents, plain, words


def classes(rows):
    prints = [simhash_bk.majority(simhash_bk.shingle_hashes(t or "", 3)) for _, t in rows]
    root = list(range(len(rows)))
    own = [i for i, (d, _) in enumerate(rows) if d is not None]
    while True:
        new = [min((root[j] for j in own if (prints[i] ^ prints[j]).bit_count() <= 3), key=lambda k: rows[k][0], default=i)
               for i in range(len(rows))]
        new = [root[k] if rows[k][0] is not None else k for k in new]
        if new == root:
            return prints, root
        root = new


def test_hashes_are_spark_s(spark):
    text = "Ab  cd\tÉf\x0bgh IJ ab cd"
    got = simhash_bk.shingle_hashes(text, 3).astype(np.int64).tolist()
    tokens = ["ab", "cd", "Éf", "gh", "ij", "ab", "cd"]
    df = spark.createDataFrame([(" ".join(tokens[i:i + 3]),) for i in range(5)], "s string").select(F.xxhash64("s"))
    assert got == [r[0] for r in df.collect()]
    assert simhash_bk.majority(np.array([3, 1, 2], np.uint64)) == 3 and simhash_bk.majority(np.array([3, 1], np.uint64)) == 1


def test_classes_against_brute_force(spark):
    r = random.Random(0)
    base = [words(i, 120).split() for i in range(15)]
    rows = []
    for i in range(150):
        w = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 2, 5])):
            w[r.randrange(len(w))] = "changed"
        rows.append((i * 3, " ".join(w)))
    prints, root = classes(rows)
    got = {x.doc_id: (x.fingerprint, x.component_id) for x in simhash_bk.near_duplicates(plain(spark, rows).repartition(4)).collect()}
    assert got == {d: (f"{p:016x}", rows[k][0]) for (d, _), p, k in zip(rows, prints, root, strict=True)}


def test_edges(spark):
    got = [tuple(x) for x in simhash_bk.near_duplicates(documents(spark, EDGES)).collect()]
    assert len(got) == len(EDGES)
    named = {}
    for d, f, c in got:
        named.setdefault(d, set()).add((f, c))
    assert {named[i].pop() for i in (1, 2, 3)} == {("0" * 16, 1)}
    assert named[4] == {(f, 4) for f, _ in named[4]} and next(iter(named[5]))[1] == 4
    assert next(iter(named[None]))[1] is None and len(named[6]) == 1
    assert simhash_bk.near_duplicates(documents(spark, [])).count() == 0


def test_hot_shards_lose_no_link(spark, monkeypatch):
    """Fingerprints that agree on most bits, in shards that are cut again."""
    r = random.Random(1)
    values = sorted({sum(1 << r.randrange(20) for _ in range(r.randint(0, 3))) for _ in range(300)} |
                    {r.getrandbits(64) for _ in range(50)})
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    monkeypatch.setattr(simhash_bk, "HOT", 20)
    prints = spark.createDataFrame(list(zip(signed, range(len(values)), strict=True)), "print long, node long")
    got = dict(map(tuple, components(simhash_bk.links(prints)).collect()))
    root = list(range(len(values)))
    while True:
        new = [min(root[j] for j, w in enumerate(values) if (v ^ w).bit_count() <= 3) for v in values]
        if new == root:
            break
        root = new
    assert [got.get(i, i) for i in range(len(values))] == root


def test_tree_finds_what_a_scan_finds():
    r = random.Random(2)
    values = [r.getrandbits(12) for _ in range(400)]
    tree = simhash_bk.BKTree()
    for v in values:
        tree.add(v)
    for q in values[:50]:
        assert sorted(tree.within(q, 3)) == [i for i, v in enumerate(values) if (v ^ q).bit_count() <= 3]


def test_components_of_a_chain_and_a_hub(spark):
    pairs = [(i, i + 1) for i in range(300)] + [(1000, i) for i in range(1001, 1400)] + [(5000, 5000), (7, 3)]
    got = dict(map(tuple, components(spark.createDataFrame(pairs, "a long, b long")).collect()))
    assert got == {i: 0 for i in range(301)} | {i: 1000 for i in range(1000, 1400)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_of_each(spark, tmp_path):
    text = words(3, 80)
    rows = [(9, text), (4, text), (4, text), (None, text), (2, words(5, 80)), (None, None), (7, "")]
    path = f"file://{tmp_path}/t"
    documents(spark, rows).write.parquet(path)
    got = simhash_bk.one_of_each(spark.read.parquet(path))
    assert sorted([(r.doc_id, r.text) for r in got.collect()], key=str) == sorted([(4, text), (2, words(5, 80)), (7, "")], key=str)
    assert got.columns == documents(spark, []).columns
