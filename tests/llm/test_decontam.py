import random
from collections import Counter

from stopcast.llm import decontam

from llm_helpers import EDGES, documents, plain, words

ITEMS = [(i, words(1000 + i, 20 + i % 30)) for i in range(40)]


def items(spark, rows=ITEMS):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], "item_id long, text string, doc_id string")


def test_wand_finds_what_scoring_all_finds():
    index = decontam.Index([(i, *decontam.split_item(t)) for i, t in ITEMS])
    r = random.Random(0)
    for _ in range(200):
        terms = r.sample(range(len(index.terms)), r.randint(0, len(index.terms)))
        score = Counter()
        for t in terms:
            for i, x in zip(*index.postings[t], strict=True):
                score[i] += x
        for least in (0.2, 0.5, 0.8, 0.95):
            got = dict(index.search(terms, least))
            assert {i for i, x in score.items() if x >= least + 1e-9} <= set(got) <= {i for i, x in score.items() if x >= least - 1e-9}
            blocks = sorted({i // decontam.BLOCK for i in got})
            assert dict(index.search(terms, least, blocks)) == got


def test_planted_items_are_found_and_clean_texts_left(spark):
    r = random.Random(1)
    rows, want = [], set()
    for d in range(60):
        text = " ".join(r.choice(["foo", "bar", "the", "of", "baz"]) + str(r.randrange(500)) for _ in range(r.randint(0, 400))).split()
        if d % 3 == 0:
            i, t = r.choice(ITEMS)
            at = r.randint(0, len(text))
            text[at:at] = t.upper().split() if d % 2 else t.split()
            want.add((d, i))
        rows.append((d, " ".join(text)))
    got = {(x.doc_id, x.item_id) for x in decontam.contaminated(plain(spark, rows).repartition(3), items(spark)).collect()}
    assert got == want
    kept = decontam.without_contaminated(documents(spark, rows), items(spark))
    assert {x.doc_id for x in kept.collect()} == set(range(60)) - {d for d, _ in want}
    assert kept.columns == documents(spark, []).columns


def test_half_an_item_is_not_enough(spark):
    t = ITEMS[29][1].split()
    rows = [(1, " ".join(t[:len(t) // 2])), (2, " ".join(t[len(t) // 2:])), (3, " ".join(sorted(t))), (4, " ".join(t))]
    got = {(x.doc_id, x.item_id) for x in decontam.contaminated(plain(spark, rows), items(spark)).collect()}
    assert got == {(4, 29)}


def test_index_in_parts_finds_the_same(spark, monkeypatch):
    rows = [(i, t + " " + words(i, 30)) for i, t in ITEMS]

    def run():
        return {(x.doc_id, x.item_id): (round(x.score, 12), x.question_overlap, x.answer_overlap, x.at_word)
                for x in decontam.contaminated(plain(spark, rows), items(spark)).collect()}

    whole = run()
    monkeypatch.setattr(decontam, "INDEX_BYTES", 1500)
    assert len(decontam.indexes(items(spark))) > 2
    assert run() == whole and set(whole) == {(i, i) for i, _ in ITEMS}
    clean = [(100 + i, words(2000 + i, 60)) for i in range(20)]
    kept = decontam.without_contaminated(documents(spark, rows + clean), items(spark)).collect()
    assert {x.doc_id for x in kept} == {i for i, _ in clean}


def test_candidates_hold_every_item_that_scoring_all_finds():
    """Passages and blocks against the weights of every item for every passage."""
    index = decontam.Index([(i, *decontam.split_item(t)) for i, t in ITEMS])
    r = random.Random(4)
    texts = [(words(50 + d, r.randrange(120)) + " " + r.choice(ITEMS)[1] + " " + words(90 + d, r.randrange(90))).lower().split() for d in range(12)]
    for least in (0.3, 0.5, 0.8):
        found = {}
        for text, at, terms, blocks in index.candidates(texts, least):
            for item, score in index.search(terms, least, blocks):
                found[text, at, item] = score
        for d, raw in enumerate(texts):
            kept = [w for w in map(decontam.normal, raw) if w]
            for at in range(0, max(1, len(kept)), index.stride):
                some = {index.terms[w] for w in kept[at:at + 2 * index.stride] if w in index.terms}
                score = Counter()
                for t in some:
                    for i, x in zip(*index.postings[t], strict=True):
                        score[i] += x
                for i, x in score.items():
                    assert x < least + 1e-9 or abs(found[d, at, i] - x) < 1e-9
                    assert x > least - 1e-9 or (d, at, i) not in found


def test_edges(spark):
    bad = [(None, "no id"), (1, None), (2, ""), (3, "..."), (4, "word"), (4, "word")]
    got = decontam.contaminated(documents(spark, EDGES), items(spark, bad)).collect()
    assert [(x.doc_id, x.item_id) for x in got] == [(6, 4), (6, 4)]
    assert decontam.contaminated(documents(spark, []), items(spark)).count() == 0
    assert decontam.contaminated(documents(spark, EDGES), items(spark, [])).count() == 0
    assert decontam.without_contaminated(documents(spark, EDGES), items(spark, [])).count() == len(EDGES)


def test_question_and_answer_columns(spark):
    qa = spark.createDataFrame([(1, words(7, 15), words(8, 6))], "item_id long, q string, a string")
    rows = [(1, words(7, 15) + " " + words(8, 6)), (2, words(7, 15)), (3, words(8, 6))]
    got = decontam.contaminated(plain(spark, rows), qa, question_col="q", answer_col="a").collect()
    assert [x.doc_id for x in got] == [1]
