"""Toxicity by class-conditional Kneser-Ney models.

A text is read word by word, a word as a run of symbols between boundary
marks.  Two models of order ORDER, one for toxic and one for ordinary labelled
texts, give each symbol a probability after its ORDER - 1 predecessors by
absolute discounting; what they take from seen expressions goes to one shared
lower-order model, whose Kneser-Ney continuation counts come from every
document.  Where neither class has seen an expression both fall back on the
same counts, and it says nothing about the class.

A document's evidence is the difference of the two log-likelihoods per word,
over the whole text and in its most toxic windows; a logistic curve, fitted on
labelled rows that these counts have not seen, turns it into a probability.

All counts are exact and keyed by the whole expression, so the model grows with
the corpus and nobody holds it whole.  Texts are read once: a chunk of documents
becomes a file of word numbers, and its distinct words go to parts by hash.  A
part counts the expressions of its words and keeps the words in a file, Spark adds
the counts up and computes every expression's evidence by joins, the parts fetch
what their words need, and the chunks get the evidence of their words back.  No key of these shuffles is hot: a
word is one entry a chunk, an expression one row a part and stretch of words.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from stopcast.llm.common import drop_folder, no_state, release, shared_folder, stored
from stopcast.llm.suffix_dedup import dealt, pack, unpack
from stopcast.llm.token_counts import batch_groups

ORDER = 5                   # symbols of an expression
BITS = 21                   # bits of a symbol: any code point
DISCOUNT = 0.75
WINDOWS = (4, 16, 64)       # words
BEST = (1, 3, 8)            # words of most evidence, each counted once
FEATURES = 2 + len(WINDOWS) + len(BEST)
LABELS_SENT = 1_000_000     # labelled rows up to which they are broadcast for the join
CURVE_ROWS = 200_000        # labelled rows, at most, that fit the logistic curve
CHUNK_BYTES = 6_000_000     # text of a chunk
PART_BYTES = 24_000_000     # text a part of the words
WORDS_LEVEL = 9             # of compression of the words that are dealt to the parts
STRETCH = 200_000           # words whose expressions are worked on at once
COUNTS = ("toxic_fit", "plain_fit", "toxic_cal", "plain_cal")
PUNCTUATION = ".,;:!?\"'()[]{}<>|/\\*&%$#@=+~^`_-"


def words_of(text: str) -> list[str]:
    return text.lower().split()


def packed(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expressions of every word (punctuation at its ends left out), one per
    symbol and one for its end: the first two symbols and the last three, each
    as an integer; and the word each belongs to."""
    words = [w.strip(PUNCTUATION) for w in words]
    lens = np.fromiter(map(len, words), np.int64, len(words)) + 1
    raw = np.frombuffer("\x01".join(words).encode("utf-32-le") + "\x01".encode("utf-32-le"), "<u4").astype(np.int64) \
        if words else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(words)), lens)
    place = np.arange(len(raw)) - np.repeat(np.cumsum(lens) - lens, lens)
    back = [raw]
    for n in range(1, ORDER):
        before = np.r_[np.zeros(min(n, len(raw)), np.int64), raw[:-n]]
        back.append(np.where(place >= n, before, 2))            # 2: before the word
    return back[3] | back[4] << BITS, back[0] | back[1] << BITS | back[2] << 2 * BITS, row


def symbols(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The expressions of ``packed`` as one (Python) integer each, and their words."""
    hi, lo, row = packed(words)
    return hi.astype(object) << 3 * BITS | lo.astype(object), row


# ------------------------------------------------------------ chunks and parts

WORDS_SQL = "part bigint, chunk string, blob binary"
GRAMS_SQL = "part bigint, hi bigint, lo bigint, " + ", ".join(f"{c} bigint" for c in COUNTS)
ASKED_SQL = GRAMS_SQL + ", file string"
FEATURED_SQL = "chunk string, blob binary, h bigint, toxic int, x array<double>"
HEAD = -1                   # part of the row that names a chunk


def planes(numbers: np.ndarray) -> np.ndarray:
    """32-bit numbers as all their low bytes, then all their next ones: small numbers pack well."""
    return np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).ravel()


def from_planes(raw: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").ravel()


def steps(numbers: np.ndarray) -> np.ndarray:
    """``planes`` of the differences, which are small where the numbers rise."""
    return planes(np.diff(numbers.astype(np.int64), prepend=0))


def from_steps(raw: np.ndarray) -> np.ndarray:
    return np.cumsum(from_planes(raw), dtype="<u4")


def write(path: str, name: str, blob: bytes) -> None:
    system, root = pafs.FileSystem.from_uri(path)
    system.create_dir(root, recursive=True)
    with system.open_output_stream(posixpath.join(root, name), compression=None) as f:
        f.write(blob)


def read(path: str, name: str) -> bytes:
    system, root = pafs.FileSystem.from_uri(path)
    with system.open_input_file(posixpath.join(root, name)) as f:
        return f.read()


def coded(rows: DataFrame, path: str, parts: int) -> DataFrame:
    """(part, chunk, blob) of ``rows(row, text, part, h)``: the distinct words
    of a chunk with their counts, by hash; part: 0 no label, 1 toxic fit, 2
    ordinary fit, 3 toxic for the curve, 4 ordinary for the curve.  The
    documents stay in the folder as word numbers, beside the struct ``row``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        no_state()

        def close(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            words, ends = [], []
            for piece in held:
                for text in piece.column(1).to_pylist():
                    words += words_of(text or "")
                    ends.append(len(words))
            column = pa.array(words, pa.large_string()).dictionary_encode()
            del words
            distinct, codes = column.dictionary.to_pylist(), column.indices.to_numpy()
            # numbered in order: neighbours share their beginnings, so lists of words take half the bytes
            order = sorted(range(len(distinct)), key=distinct.__getitem__)
            number = np.empty(len(order), "<u4")
            number[order] = np.arange(len(order))
            distinct, codes = [distinct[i] for i in order], number[codes] if len(codes) else np.zeros(0, "<u4")
            ends = np.array(ends, "<i8")
            kind = np.concatenate([p.column(2).to_numpy() for p in held]).astype("<i8")
            h = np.concatenate([p.column(3).fill_null(0).to_numpy() for p in held]).astype("<i8")
            of_word = np.repeat(kind, np.diff(np.r_[0, ends]))
            counts = [np.bincount(codes[of_word == k + 1], minlength=len(distinct)).astype("<i8") for k in range(len(COUNTS))]
            home = np.fromiter((xxh64_intdigest(w) % parts for w in distinct), "<u4", len(distinct))
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, pa.schema([held[0].schema.field(0)])) as out:
                for piece in held:
                    out.write_batch(piece.select([0]))
            name = uuid.uuid4().hex
            # the file numbers them anew, frequent ones first
            by = np.argsort(-np.bincount(codes, minlength=len(distinct)), kind="stable")
            rank = np.empty(len(by), "<u4")
            rank[by] = np.arange(len(by))
            write(path, name, pack(planes(rank[codes]), steps(by), ends, home, kind, h, np.frombuffer(sink.getvalue(), np.uint8)))
            found = [(HEAD, name, b"")]
            for p, mine in dealt(home):
                text = "\n".join([distinct[i] for i in mine.tolist()]).encode()
                found.append((p, name, pack(np.frombuffer(text, np.uint8), *[c[mine] for c in counts], level=WORDS_LEVEL)))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*found, strict=True), (pa.int64(), pa.string(), pa.binary()), strict=True)], names=["part", "chunk", "blob"])

        held, size = [], 0
        for batch in batches:
            for piece in batch_groups(batch, 1, CHUNK_BYTES):
                held.append(piece)
                size += piece.column(1).nbytes
                if size >= CHUNK_BYTES:
                    yield close(held)
                    held, size = [], 0
        if held:
            yield close(held)

    return rows.select("row", "text", F.col("part").cast("int").alias("part"), "h").mapInArrow(run, WORDS_SQL)


def load(path: str, name: str) -> list[np.ndarray]:
    ranks, by, *others = unpack(read(path, name), np.uint8, np.uint8, "<i8", "<u4", "<i8", "<i8", np.uint8)
    return [from_steps(by)[from_planes(ranks)], *others]


def part_words(blobs: list[bytes]) -> tuple[list[str], list[np.ndarray], list[np.ndarray]]:
    """The distinct words of a part in order, their counts, and each chunk's words as numbers."""
    got = [unpack(b, np.uint8, *["<i8"] * len(COUNTS)) for b in blobs]
    lists = [g[0].tobytes().decode().split("\n") for g in got]
    column = pa.array([w for words in lists for w in words], pa.large_string()).dictionary_encode()
    order = pc.sort_indices(column.dictionary)
    number = np.empty(len(order), np.int64)
    number[order.to_numpy()] = np.arange(len(order))
    distinct, codes = column.dictionary.take(order).to_pylist(), number[column.indices.to_numpy()]
    counts = []
    for k in range(len(COUNTS)):
        sums = np.zeros(len(distinct), np.int64)
        np.add.at(sums, codes, np.concatenate([g[1 + k] for g in got]))
        counts.append(sums)
    return distinct, counts, np.split(codes, np.cumsum(list(map(len, lists)))[:-1])


def asked_grams(words: DataFrame, path: str, parts: int) -> DataFrame:
    """(part, hi, lo, counts): the expressions of the words of each part.  Its words stay in
    the folder, so that they are shuffled once: a row with nothing else names the file."""
    schema = pa.schema([("part", pa.int64()), ("hi", pa.int64()), ("lo", pa.int64()), *((c, pa.int64()) for c in COUNTS), ("file", pa.string())])

    def ask(t: pa.Table) -> pa.Table:
        part = t["part"][0].as_py()
        blobs = t["blob"].to_pylist()
        distinct, counts, chunks = part_words(blobs)
        fits = [np.add(*unpack(b, np.uint8, *["<i8"] * len(COUNTS))[3:]) > 0 for b in blobs]
        name = uuid.uuid4().hex
        write(path, name, pack(np.frombuffer("\n".join(distinct).encode(), np.uint8), np.frombuffer("\n".join(t["chunk"].to_pylist()).encode(), np.uint8),
                               np.array(list(map(len, chunks)), "<i8"), steps(np.concatenate(chunks)), np.packbits(np.concatenate(fits)),
                               level=WORDS_LEVEL))
        nothing = [None] * (len(schema) - 2)
        out = [pa.table([pa.array([x], k) for x, k in zip((part, *nothing, name), schema.types, strict=True)], schema=schema)]
        for a in range(0, len(distinct), STRETCH):
            hi, lo, row = packed(distinct[a:a + STRETCH])
            by = np.lexsort((lo, hi))
            hi, lo, row = hi[by], lo[by], row[by]
            new = np.flatnonzero(np.r_[True, (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])])
            out.append(pa.table([np.full(len(new), part), hi[new], lo[new],
                                 *[np.add.reduceat(c[a:a + STRETCH][row], new) for c in counts], pa.nulls(len(new), pa.string())],
                                schema=schema))
        return pa.concat_tables(out)

    return words.where("part >= 0").repartition(parts, "part").groupBy("part").applyInArrow(ask, ASKED_SQL)


def load_part(path: str, name: str) -> tuple[list[str], list[str], list[np.ndarray], list[np.ndarray]]:
    """The words of a part; its chunks, and each one's words as numbers and which of them fit the curve."""
    text, names, lens, codes, fits = unpack(read(path, name), np.uint8, np.uint8, "<i8", np.uint8, np.uint8)
    cut = np.cumsum(lens)[:-1]
    return (text.tobytes().decode().split("\n"), names.tobytes().decode().split("\n"), np.split(from_steps(codes), cut),
            np.split(np.unpackbits(fits, count=int(lens.sum())).astype(bool), cut))


def count_grams(docs: DataFrame) -> DataFrame:
    """(hi, lo, counts) of the expressions of ``docs(text, part)``."""
    rows = docs.select(F.struct("text").alias("row"), "text", "part", F.lit(0).cast("bigint").alias("h"))
    path = shared_folder(docs.sparkSession, "chunks")
    words = stored(coded(rows, path, 1), "words")
    return summed(asked_grams(words, path, 1))


def summed(asked: DataFrame) -> DataFrame:
    return asked.where("file is null").groupBy("hi", "lo").agg(*[F.sum(c).alias(c) for c in COUNTS])


# ------------------------------------------------------------ the model

def ratios(grams: DataFrame, classes: list[tuple[list[str], list[str]]]) -> DataFrame:
    """(hi, lo, shared, r0, r1, ...) of every expression: the probability of its
    last symbol by the shared model, and for each pair of (toxic, ordinary)
    count columns the toxic less ordinary log-likelihood."""
    def keep(n: int) -> tuple[Column, Column]:
        """The last ``n`` symbols."""
        return ((F.col("hi").bitwiseAND(F.lit((1 << BITS * (n - 3)) - 1)) if n > 3 else F.lit(0).cast("bigint")).alias("hi"),
                F.col("lo").bitwiseAND(F.lit((1 << BITS * min(n, 3)) - 1)).alias("lo"))

    def context() -> tuple[Column, Column]:
        return F.col("hi").alias("c_hi"), F.shiftright("lo", BITS).alias("c_lo")

    def smoothed(n: str, total: str, kinds: str, base: str) -> Column:
        return (F.greatest(F.col(n) - DISCOUNT, F.lit(0.0)) + DISCOUNT * F.col(kinds) * F.col(base)) / F.col(total)

    below, lower = grams.select("hi", "lo"), {}
    for k in range(ORDER - 1, 0, -1):
        below = lower[k] = below.groupBy(*keep(k)).agg(F.count("*").alias("n"))
    total, kinds = lower[1].agg(F.sum("n"), F.count("*")).first()
    p = lower[1].select("hi", "lo", ((F.greatest(F.col("n") - DISCOUNT, F.lit(0.0)) + DISCOUNT * kinds / (1 << BITS))
                                     / F.lit(float(total or 1))).alias("p"))
    for k in range(2, ORDER):
        after = lower[k].groupBy(*context()).agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
        less = p.select(F.col("hi").alias("s_hi"), F.col("lo").alias("s_lo"), F.col("p").alias("base"))
        s_hi, s_lo = keep(k - 1)
        p = lower[k].select("hi", "lo", "n", *context(), s_hi.alias("s_hi"), s_lo.alias("s_lo")) \
            .join(after, ["c_hi", "c_lo"]).join(less, ["s_hi", "s_lo"]) \
            .select("hi", "lo", smoothed("n", "total", "kinds", "base").alias("p"))
    named = []
    for i, (toxic, plain) in enumerate(classes):
        named += [sum((F.col(c) for c in some), F.lit(0)).alias(f"{m}{i}") for m, some in (("t", toxic), ("o", plain))]
    marks = [f"{m}{i}" for i in range(len(classes)) for m in "to"]
    s_hi, s_lo = keep(ORDER - 1)
    top = grams.select("hi", "lo", *context(), s_hi.alias("s_hi"), s_lo.alias("s_lo"), *named)
    after = top.groupBy("c_hi", "c_lo").agg(*[F.sum(m).alias(f"total_{m}") for m in marks],
                                            *[F.sum((F.col(m) > 0).cast("int")).alias(f"kinds_{m}") for m in marks])
    less = p.select(F.col("hi").alias("s_hi"), F.col("lo").alias("s_lo"), F.greatest("p", F.lit(1e-12)).alias("shared"))

    def likely(m: str) -> Column:
        seen = F.when(F.col(f"total_{m}") > 0, smoothed(m, f"total_{m}", f"kinds_{m}", "shared")).otherwise(F.col("shared"))
        return F.log(F.greatest(seen, F.lit(1e-12)))

    return top.join(after, ["c_hi", "c_lo"]).join(less, ["s_hi", "s_lo"]) \
        .select("hi", "lo", "shared", *[(likely(f"t{i}") - likely(f"o{i}")).alias(f"r{i}") for i in range(len(classes))])


def model_tables(grams: DataFrame, toxic: list[str], plain: list[str]) -> pa.Table:
    """The model of a small corpus as one table (``scores`` never gathers it)."""
    return ratios(grams, [(toxic, plain)]).toArrow()


class Model:
    """Scores words by a table (hi, lo, shared, r0, ...) of their expressions."""

    def __init__(self, table: pa.Table):
        hi, lo = table["hi"].to_numpy(), table["lo"].to_numpy()
        self.his, self.los = np.unique(hi), np.unique(lo)
        key = np.searchsorted(self.his, hi) * len(self.los) + np.searchsorted(self.los, lo)
        self.keys, first = np.unique(key, return_index=True)
        self.values = np.c_[*[table[c].to_numpy()[first] for c in table.column_names if c not in ("hi", "lo")]]

    def look(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """The values of expressions, zero where the table has none."""
        out = np.zeros((len(hi), self.values.shape[1]))
        if len(self.keys) and len(hi):
            i = np.minimum(np.searchsorted(self.his, hi), len(self.his) - 1)
            j = np.minimum(np.searchsorted(self.los, lo), len(self.los) - 1)
            at = i * len(self.los) + j
            k = np.minimum(np.searchsorted(self.keys, at), len(self.keys) - 1)
            known = (self.his[i] == hi) & (self.los[j] == lo) & (self.keys[k] == at)
            out[known] = self.values[k[known]]
        return out

    def shared(self, key: np.ndarray) -> np.ndarray:
        """Probability of the last symbol by continuation counts of all documents."""
        low = (1 << 3 * BITS) - 1
        return np.maximum(self.look((key >> 3 * BITS).astype(np.int64), (key & low).astype(np.int64))[:, 0], 1e-12)

    def evidence(self, words: list[str]) -> np.ndarray:
        """Toxic less ordinary log-likelihood of every word, a column per class pair."""
        out = [np.zeros((0, self.values.shape[1] - 1))]
        for a in range(0, len(words), STRETCH):
            some = words[a:a + STRETCH]
            hi, lo, row = packed(some)
            found = self.look(hi, lo)[:, 1:]
            out.append(np.c_[*[np.bincount(row, x, len(some)) for x in found.T]])
        return np.concatenate(out)


def features(codes: np.ndarray, ends: np.ndarray, evidence: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Evidence per word of the chosen documents: of the whole text, of its best
    window of each size, of its most telling words; and the logarithm of its length."""
    out = np.zeros((len(chosen), FEATURES))
    starts = np.r_[0, ends[:-1]]
    for i, d in enumerate(chosen.tolist()):
        some = codes[starts[d]:ends[d]]
        if not len(some):
            continue
        x = evidence[some]
        total = np.r_[0.0, np.cumsum(x)]
        out[i, 0] = total[-1] / len(x)
        for j, w in enumerate(WINDOWS):
            n = min(w, len(x))
            out[i, 1 + j] = (total[n:] - total[:-n]).max() / w
        best = np.sort(evidence[np.unique(some)])[::-1][:BEST[-1]]
        for j, k in enumerate(BEST):
            out[i, 1 + len(WINDOWS) + j] = best[:k].sum() / k
        out[i, -1] = np.log1p(len(x))
    return out


class Curve:
    """Logistic curve of standardised features."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1e-3):
        self.prior = float(y.mean()) if len(y) else 0.0
        self.weights = None
        if len(y) and 0 < self.prior < 1:
            self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
            z = np.c_[np.ones(len(x)), (x - self.mean) / self.scale]
            w = np.zeros(z.shape[1])
            for _ in range(50):
                p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
                h = (z * (p * (1 - p))[:, None]).T @ z / len(y) + ridge * np.eye(len(w))
                step = np.linalg.solve(h, z.T @ (y - p) / len(y) - ridge * w)
                w += step
                if np.abs(step).max() < 1e-8:
                    break
            self.weights = w

    def __call__(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.prior)
        z = np.c_[np.ones(len(x)), (x - self.mean) / self.scale]
        return 1 / (1 + np.exp(-np.clip(z @ self.weights, -30, 30)))


def labelled(docs: DataFrame, labels: DataFrame, row: Column, id_col: str, text_col: str, label_id: str,
             label_col: str) -> DataFrame:
    """(doc_id, row, text, toxic, fold): the label joined on, by broadcast while
    there are few labels and by a shuffle beyond."""
    rows = docs.select(docs[id_col].cast("bigint").alias("doc_id"), row.alias("row"), docs[text_col].cast("string").alias("text"))
    marks = labels.select(labels[label_id].cast("bigint").alias("doc_id"), labels[label_col].cast("int").alias("toxic")) \
        .where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marks = stored(marks, "marks")
    if marks.count() <= LABELS_SENT:
        marks = F.broadcast(marks)
    return rows.join(marks, "doc_id", "left").withColumn("fold", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5)


def fit(docs: DataFrame, labels: DataFrame, row: Column, id_col: str = "doc_id", text_col: str = "text",
        label_id: str = "doc_id", label_col: str = "toxic") -> tuple[str, DataFrame, Curve]:
    """The folder of chunks (with ``row`` of every document), the features of
    each chunk's documents as (chunk, blob), and the curve.

    Fold 0 is held out: its labels are never read into a count or the curve.
    Folds 1 to 3 count for a first model, whose features of fold 4 (at most
    CURVE_ROWS of its rows, by hash) fit the curve; folds 1 to 4 count for
    the model that scores.  Both models share the passes.
    """
    spark = docs.sparkSession
    path = shared_folder(spark, "chunks")
    total = docs.agg(F.sum(F.octet_length(docs[text_col].cast("string")))).first()[0] or 0
    parts = 1 + total // PART_BYTES
    part = F.when(F.col("toxic").isNull() | (F.col("fold") == 0), 0) \
        .otherwise(F.when(F.col("fold") == 4, 3).otherwise(1) + F.when(F.col("toxic") == 1, 0).otherwise(1))
    rows = labelled(docs, labels, row, id_col, text_col, label_id, label_col)
    at = shared_folder(spark, "words")
    coded(rows.select("row", "text", part.alias("part"), F.xxhash64("doc_id").alias("h")), path, parts).write.parquet(at)
    words = spark.read.schema(WORDS_SQL).parquet(at)
    heads = stored(words.where(F.col("part") == HEAD), "heads")
    asked = stored(asked_grams(words, path, parts), "asked")
    drop_folder(spark, at)          # the parts have them
    release(spark)
    grams = stored(summed(asked), "grams")
    release(spark)
    model = ratios(grams, [(["toxic_fit"], ["plain_fit"]), (["toxic_fit", "toxic_cal"], ["plain_fit", "plain_cal"])])

    def answer(w: pa.Table, g: pa.Table) -> pa.Table:
        """By part: the evidence of each chunk's words; by the first model only that of
        words in documents that fit the curve."""
        distinct, names, chunks, fits = load_part(path, w["file"][0].as_py())
        found = Model(g.drop_columns(["part"])).evidence(distinct).astype("<f4")
        back = [pack(found[c, 1], found[c[fit], 0]) for c, fit in zip(chunks, fits, strict=True)]
        return pa.table([pa.array([w["own"][0].as_py()] * len(names), pa.int64()), pa.array(names, pa.string()), pa.array(back, pa.binary())],
                        names=["part", "chunk", "blob"])

    def measure(t: pa.Table) -> pa.Table:
        """By chunk: the features of its documents, and those that fit the curve."""
        name = t["chunk"][0].as_py()
        codes, ends, home, kind, h, _ = load(path, name)
        evidence, of_part = np.zeros((len(home), 2)), dict(dealt(home))
        fitting = np.zeros(len(home), bool)
        fitting[codes[np.repeat(kind > 2, np.diff(np.r_[0, ends]))]] = True
        for p, blob in zip(t["part"].to_pylist(), t["blob"].to_pylist(), strict=True):
            if p >= 0:
                at = of_part[p]
                evidence[at, 1], evidence[at[fitting[at]], 0] = unpack(blob, "<f4", "<f4")
        x = features(codes, ends, evidence[:, 1], np.arange(len(ends)))
        fits = np.flatnonzero(kind > 2)
        seen = features(codes, ends, evidence[:, 0], fits)
        none = [None] * len(fits)
        return pa.table([pa.array([name, *none], pa.string()), pa.array([pack(x), *none], pa.binary()),
                         pa.array([None, *h[fits].tolist()], pa.int64()),
                         pa.array([None, *(kind[fits] == 3).astype(int).tolist()], pa.int32()),
                         pa.array([None, *seen.tolist()], pa.list_(pa.float64()))],
                        names=["chunk", "blob", "h", "toxic", "x"])

    needed = asked.where("file is null").select("part", "hi", "lo").join(model, ["hi", "lo"]).select("part", "hi", "lo", "shared", "r0", "r1")
    files = asked.where("file is not null").select(F.col("part").alias("own"), "file")
    back = files.groupBy("own").cogroup(needed.groupBy("part")).applyInArrow(answer, WORDS_SQL)
    n = max(1, heads.count())
    measured = stored(back.union(heads).repartition(n, "chunk").groupBy("chunk").applyInArrow(measure, FEATURED_SQL), "features")
    chosen = measured.where("h is not null").select("h").orderBy("h").limit(CURVE_ROWS).agg(F.max("h")).first()[0]
    seen = measured.where(F.col("h") <= (chosen if chosen is not None else 0)).select("h", "toxic", "x").toArrow()
    x, y = np.array(seen["x"].to_pylist(), float).reshape(-1, FEATURES), seen["toxic"].to_numpy().astype(float)
    by = np.lexsort((*x.T, y, seen["h"].to_numpy()))
    return path, measured.where("chunk is not null").select("chunk", "blob"), Curve(x[by], y[by])


def each_chunk(path: str, curve: Curve, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """The rows of the chunks' documents, and their scores."""
    for batch in batches:
        for name, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            p = curve(unpack(blob, "<f8")[0].reshape(-1, FEATURES))
            at = 0
            for rows in pa.ipc.open_stream(load(path, name)[-1].tobytes()):
                yield pa.RecordBatch.from_struct_array(rows.column(0)), p[at:at + rows.num_rows]
                at += rows.num_rows


def scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **columns: str) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    Only the named columns are read.  Null and wordless texts have no evidence
    and the score that the curve gives none; repeated rows give repeated
    results; labels that are null, not 0 or 1, or of unknown documents are
    left out, and a document labelled both ways counts as toxic; a null doc_id
    has no label and held_out null.  Without labels of both kinds every score
    is the share of toxic ones (0 without any).  Empty tables give an empty
    result.
    """
    doc_id = docs[id_col].cast("bigint")
    row = F.struct(doc_id.alias("doc_id"), (F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0).alias("held_out"))
    path, chunks, curve = fit(docs, labels, row, id_col, text_col, **columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, p in each_chunk(path, curve, batches):
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                                             names=["doc_id", "held_out", "score", "predicted"])

    return chunks.mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int")


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  **columns: str) -> DataFrame:
    """Rows of ``docs``, all columns, whose score is below a half."""
    path, chunks, curve = fit(docs, labels, F.struct(*[docs[c] for c in docs.columns]), id_col, text_col, **columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, p in each_chunk(path, curve, batches):
            yield rows.filter(pa.array(p < 0.5))

    return chunks.mapInArrow(run, docs.schema)
