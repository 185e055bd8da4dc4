"""Small tables with nulls, ties, repeated rows and columns of clashing names."""

from __future__ import annotations

import random

CLASHING = ("n_tokens", "file", "part", "blob", "row", "print", "node", "component_id", "toxic", "fold", "score", "item_id", "ids",
            "shard", "uid")


def words(seed: int, n: int) -> str:
    r = random.Random(seed)
    stock = ["the", "of", "river", "stone", "lamp", "über", "señal", "cold", "winter", "seven", "eight", "glass", "train", "window",
             "music", "paper", "cloud", "orange", "table", "silver", "garden", "letter", "mountain", "eagle", "bread"]
    return " ".join(r.choice(stock) + r.choice(["", "", "", ".", ",", "s"]) for _ in range(n))


def documents(spark, rows):
    """``rows`` of (doc_id, text) with further columns that clash with names
    that operators use inside."""
    schema = "doc_id long, text string, " + ", ".join(f"{c} string" for c in CLASHING)
    return spark.createDataFrame([(*r, *(["x"] * len(CLASHING))) for r in rows], schema)


def plain(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


EDGES = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (None, "one two three four"), (6, "word " * 30000),
         (6, "word " * 30000), (7, "é" * 3000), (8, "a\u0000b   ć ﬁ 한국어 🤖"), (-9, "x<|endoftext|>  y  z")]
