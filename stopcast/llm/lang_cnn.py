"""Language identification by a byte convolutional network.

A text's UTF-8 bytes are cut into windows of fixed length that overlap by the
widest filter less one, so that every byte run a filter can see lies within one.  A
network of filters of several widths over byte vectors, max pooling over each
window and a softmax tells a window's language.  A document's probabilities are
the normalised product of its windows' (the mean of their logarithms), all of
them, from the first byte to the last.

The network is trained in numpy by Adam on windows of a bounded sample: of every
language the first documents in hash order, TRAIN_DOCS together, and of these at
most WINDOWS_DOC windows each, again in hash order over the whole text.  Scoring
is map-only work: a filter's answer at a byte is a sum of table entries, one for
each pair of neighbouring bytes, so a batch of windows costs a few table reads a
byte and filter.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stopcast.llm.common import stored, worker_state

WINDOW = 256                # bytes of a window
WIDTHS = (2, 3, 4, 5)       # filter widths
FILTERS = 16                # filters of a width
DEPTH = 8                   # numbers of a byte's vector
TRAIN_DOCS = 4000           # labelled documents that are read for training, at most (one a language at least) ...
LANG_DOCS = 1000            # ... and of one language (row limits up to this are applied before rows are dealt)
WINDOWS_DOC = 4             # windows of each, at most
EPOCHS, BATCH, RATE, DECAY = 6, 64, 0.004, 1e-4
SHORTENED = 0.3             # share of training windows that are cut at random, as short texts are
SEED = 13
GROUP = 1024                # windows scored at once
UNDETERMINED = "und"


def windows_of(text: bytes) -> list[bytes]:
    """Windows that cover the whole text; the last one may be shorter."""
    step = WINDOW - max(WIDTHS) + 1
    return [text[i:i + WINDOW] for i in range(0, max(1, len(text) - max(WIDTHS) + 1), step)] if text else []


def _matrix(windows: list[bytes]) -> np.ndarray:
    """Windows as rows of byte numbers 1 to 256; 0 fills up."""
    out = np.zeros((len(windows), WINDOW), np.int64)
    lens = np.array([len(w) for w in windows])
    out[np.arange(WINDOW) < lens[:, None]] = np.frombuffer(b"".join(windows), np.uint8).astype(np.int64) + 1
    return out


class Network:
    """Byte vectors, filters (width * DEPTH, FILTERS) by width, and the softmax."""

    def __init__(self, classes: int):
        r = np.random.default_rng(SEED)
        self.weights = {"bytes": r.normal(0, 0.3, (257, DEPTH)).astype(np.float32)}
        self.weights["bytes"][0] = 0
        for w in WIDTHS:
            self.weights[f"f{w}"] = r.normal(0, np.sqrt(2 / (w * DEPTH)), (w * DEPTH, FILTERS)).astype(np.float32)
            self.weights[f"b{w}"] = np.zeros(FILTERS, np.float32)
        n = FILTERS * len(WIDTHS)
        self.weights["out"] = r.normal(0, np.sqrt(1 / n), (n, classes)).astype(np.float32)
        self.weights["bias"] = np.zeros(classes, np.float32)

    def loss(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross entropy of windows ``x`` with classes ``y``, and its gradients."""
        p, g = self.weights, {k: np.zeros_like(v) for k, v in self.weights.items()}
        n, rows = len(x), np.arange(len(x))[:, None]
        seen = p["bytes"][x]
        pooled, places = [], []
        for w in WIDTHS:
            runs = np.lib.stride_tricks.sliding_window_view(seen, (w, DEPTH), axis=(1, 2)).reshape(n * (WINDOW - w + 1), w * DEPTH)
            h = (runs @ p[f"f{w}"]).reshape(n, WINDOW - w + 1, FILTERS)
            at = h.argmax(axis=1)
            places.append(at)
            pooled.append(h[rows, at, np.arange(FILTERS)] + p[f"b{w}"])
        h = np.concatenate(pooled, axis=1)
        active = np.maximum(h, 0)
        z = active @ p["out"] + p["bias"]
        z -= z.max(axis=1, keepdims=True)
        q = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
        loss = float(-np.log(np.maximum(q[np.arange(n), y], 1e-30)).mean())
        q[np.arange(n), y] -= 1
        q /= n
        g["out"], g["bias"] = active.T @ q, q.sum(axis=0)
        back = (q @ p["out"].T) * (h > 0)
        for k, w in enumerate(WIDTHS):
            d, at = back[:, k * FILTERS:(k + 1) * FILTERS], places[k]
            g[f"b{w}"] = d.sum(axis=0)
            filters, change = p[f"f{w}"].reshape(w, DEPTH, FILTERS), g[f"f{w}"].reshape(w, DEPTH, FILTERS)
            for i in range(w):      # only the run that won the pooling is concerned
                byte = x[rows, at + i]
                change[i] = np.einsum("nfd,nf->df", p["bytes"][byte], d)
                np.add.at(g["bytes"], byte, d[:, :, None] * filters[i].T[None])
        g["bytes"][0] = 0
        return loss, g

    def fit(self, x: np.ndarray, y: np.ndarray) -> None:
        """Adam in batches of a fixed order."""
        r = np.random.default_rng(SEED + 1)
        m, v = ({k: np.zeros_like(w) for k, w in self.weights.items()} for _ in range(2))
        step, steps = 0, EPOCHS * -(-len(x) // BATCH)
        for _ in range(EPOCHS):
            order = r.permutation(len(x))
            for i in range(0, len(x), BATCH):
                some = order[i:i + BATCH]
                end = np.where(r.random(len(some)) < SHORTENED, r.integers(8, WINDOW, len(some)), WINDOW)
                _, g = self.loss(np.where(np.arange(WINDOW) < end[:, None], x[some], 0), y[some])
                step += 1
                rate = RATE * (1 - step / (steps + 1)) * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
                for k, w in self.weights.items():
                    m[k] = 0.9 * m[k] + 0.1 * g[k]
                    v[k] = 0.999 * v[k] + 0.001 * g[k] * g[k]
                    w -= rate * m[k] / (np.sqrt(v[k]) + 1e-8) + (rate * DECAY) * w
                self.weights["bytes"][0] = 0


class Scorer:
    """A trained network as tables: a filter of width w is a sum over pairs of
    bytes (and one byte, if w is odd) of entries."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.out, self.bias = weights["out"], weights["bias"]
        pairs, singles = [], []
        for w in WIDTHS:
            f = weights[f"f{w}"].reshape(w, DEPTH, FILTERS)
            at = [weights["bytes"] @ f[i] for i in range(w)]
            for i in range(0, w - 1, 2):
                pairs.append((w, i, (at[i][:, None, :] + at[i + 1][None, :, :]).reshape(257 * 257, FILTERS)))
            if w % 2:
                singles.append((w, w - 1, at[w - 1]))
        self.pairs, self.singles = pairs, singles
        self.shift = {w: weights[f"b{w}"] for w in WIDTHS}

    def logits(self, x: np.ndarray) -> np.ndarray:
        """Class scores of windows."""
        n = len(x)
        pair = x[:, :-1] * 257 + x[:, 1:]
        pooled = {}
        for w in WIDTHS:
            length, h = WINDOW - w + 1, None
            for v, i, table in self.pairs:
                if v == w:
                    got = np.take(table, pair[:, i:i + length], axis=0)
                    h = got if h is None else np.add(h, got, out=h)
            for v, i, table in self.singles:
                if v == w:
                    h += np.take(table, x[:, i:i + length], axis=0)
            pooled[w] = h.max(axis=1) + self.shift[w]
        return np.maximum(np.concatenate([pooled[w] for w in WIDTHS], axis=1), 0).reshape(n, -1) @ self.out + self.bias

    def documents(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(class, its probability) of every text; -1 and 0 for empty ones."""
        classes = len(self.bias)
        total, count = np.zeros((len(texts), classes)), np.zeros(len(texts), np.int64)
        owner: list[int] = []
        held: list[bytes] = []

        def score() -> None:
            if not held:
                return
            z = self.logits(_matrix(held)).astype(float)
            z -= z.max(axis=1, keepdims=True)
            z -= np.log(np.exp(z).sum(axis=1, keepdims=True))
            who = np.array(owner)
            np.add.at(total, who, z)
            np.add.at(count, who, 1)
            owner.clear()
            held.clear()

        for i, text in enumerate(texts):
            for window in windows_of(text):
                owner.append(i)
                held.append(window)
                if len(held) >= GROUP:
                    score()
        score()
        z = total / np.maximum(count, 1)[:, None]
        z -= z.max(axis=1, keepdims=True, initial=-np.inf)
        q = np.exp(z)
        q /= q.sum(axis=1, keepdims=True)
        best = q.argmax(axis=1)
        found = q[np.arange(len(texts)), best]
        best[count == 0], found[count == 0] = -1, 0.0
        return best, found


def _encoded(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _train_windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The training windows of sampled documents: the first in hash order."""
    for batch in batches:
        lang, window = [], []
        for y, text in zip(batch["lang"], batch["text"], strict=True):
            some = [w for w in windows_of(_encoded(text)) if w.strip()]
            some = sorted(some, key=lambda w: (zlib.crc32(w), w))[:WINDOWS_DOC]
            lang += [y] * len(some)
            window += some
        yield pd.DataFrame({"lang": lang, "piece": window})


def learned(documents: DataFrame, train: Column) -> tuple[list[str], dict[str, np.ndarray]]:
    """(languages, weights) learned from rows with ``train``, a lang and a text.

    The sample: of L languages the first TRAIN_DOCS // L documents of each (one at
    least, LANG_DOCS at most) in the hash order of their texts, equal texts once.
    """
    docs = (documents.where(train).where("lang IS NOT NULL AND length(text) > 0")
            .select("lang", F.xxhash64("text").alias("h"), "text"))
    # hashes alone choose; the texts of those chosen are read in a second pass
    keys = stored(docs.select("lang", "h").distinct(), "keys")
    counts = stored(keys.groupBy("lang").agg(F.count("*").alias("n")), "languages")
    langs = counts.count()
    if not langs:
        return [], {}
    quota = min(LANG_DOCS, max(1, TRAIN_DOCS // langs))

    def bounded(df: DataFrame) -> DataFrame:
        """Tables of a row a language or a sampled document."""
        return F.broadcast(df) if langs <= TRAIN_DOCS else df

    # of a language with many documents only the low hashes are ranked: some eight times those wanted
    low = (F.col("h") / float(1 << 64) + 0.5) * F.col("n") <= 8.0 * quota + 64.0
    first = Window.partitionBy("lang").orderBy("h")
    chosen = (keys.join(bounded(counts), "lang").where(low).withColumn("n", F.row_number().over(first)).where(F.col("n") <= quota)
              .select(F.col("lang").alias("l"), F.col("h").alias("k")))
    chosen = bounded(stored(chosen, "sample"))
    sample = (docs.join(chosen, (F.col("lang") == F.col("l")) & (F.col("h") == F.col("k")))
              .groupBy("lang", "h").agg(F.min("text").alias("text")).select("lang", "text")
              .mapInPandas(_train_windows, "lang string, piece binary").distinct().toArrow())
    lang = sample["lang"].to_pylist()
    windows = [bytes(w) for w in sample["piece"].to_pylist()]
    order = sorted(range(len(lang)), key=lambda i: (lang[i], windows[i]))
    names = sorted(set(lang))
    if not names:
        return [], {}
    place = {y: i for i, y in enumerate(names)}
    net = Network(len(names))
    net.fit(_matrix([windows[i] for i in order]), np.array([place[lang[i]] for i in order]))
    return names, net.weights


def predictions(documents: DataFrame, train: Column) -> DataFrame:
    """(doc_id, lang_pred, score) of every row of ``documents``.

    The network learns from the rows for which ``train`` holds and which have a
    lang and a text.  ``lang_pred`` is a learned value, or ``und`` with score 0
    where the text is null or has no letter, or nothing was learned.  Only text is
    looked at for a prediction; other columns are ignored.  Repeated rows are
    predicted each, alike.  An empty table gives an empty result.
    """
    spark = documents.sparkSession
    names, weights = learned(documents, F.coalesce(train, F.lit(False)))
    # bounded: byte vectors, filters and one column a language
    sent = spark.sparkContext.broadcast((names, weights))
    return (documents.select(documents["doc_id"].cast("bigint").alias("doc_id"), F.col("text"))
            .mapInArrow(_predict(sent), "doc_id bigint, lang_pred string, score double"))


def _predict(sent) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    key = ("lang_cnn", uuid.uuid4().hex)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, weights = sent.value
        scorer = worker_state(key, lambda: Scorer(weights) if names else None)
        labels = np.array([*names, UNDETERMINED], dtype=object)
        for batch in batches:
            text = batch.column("text")
            letter = pc.fill_null(pc.match_substring_regex(text, r"\pL"), False).to_numpy(zero_copy_only=False)
            best, score = np.full(batch.num_rows, -1), np.zeros(batch.num_rows)
            if scorer is not None and letter.any():
                at = np.flatnonzero(letter)
                raw = text.cast(pa.binary()) if text.type != pa.large_string() else text.cast(pa.large_binary())
                best[at], score[at] = scorer.documents([raw[int(i)].as_py() for i in at])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(labels[best], pa.string()), pa.array(score)],
                                             ["doc_id", "lang_pred", "score"])
    return run
