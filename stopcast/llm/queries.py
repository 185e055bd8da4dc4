"""Registered queries ``opN_<name>`` of the training-data operators.

Each applies its operator with production parameters to the whole table.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stopcast.llm import (
    bpe_sql,
    conversation_repair,
    decontam,
    hard_negatives,
    lang_cnn,
    pii_crf,
    simhash_bk,
    suffix_dedup,
    token_counts,
    topk,
    toxicity,
    warc,
    wavelet,
)
from stopcast.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of each document without 100-byte strings seen earlier."""
    return suffix_dedup.duplicate_substrings(read(spark, sf_dir, "documents"))


@query
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record and read back."""
    return warc.archive_round_trip(read(spark, sf_dir, "pages"))


ORACLES["op2_warc"] = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS hex,
         min(page_id) OVER (PARTITION BY sha1(payload)) AS first
  FROM p)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                1 + CAST(substr(bits, 1 + 5 * CAST(i AS INTEGER), 5)::BIT::INTEGER AS INTEGER), 1)), '') AS payload_digest,
       CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM (SELECT *, array_to_string(list_transform(range(40), lambda i:
        ['0000', '0001', '0010', '0011', '0100', '0101', '0110', '0111', '1000', '1001', '1010', '1011',
         '1100', '1101', '1110', '1111'][instr('0123456789abcdef', substr(hex, 1 + CAST(i AS INTEGER), 1))]), '') AS bits
      FROM d)
"""


@query
def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best inner products of every 20th embedding."""
    return topk.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64)


ORACLES["op3_exact_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM scored QUALIFY rank <= 20
"""


@query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole text under word_bpe_49k.json."""
    return token_counts.token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents."""
    return toxicity.scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op6_wavelet_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text written as wavelet matrices and read back."""
    return wavelet.token_file_round_trip(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every whole text."""
    return pii_crf.personal_data(read(spark, sf_dir, "documents"))


@query
def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE of every whole text and back."""
    return bpe_sql.bpe_round_trip(read(spark, sf_dir, "documents"),
                                  public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash classes of all documents: 3-word shingles, 3 bits."""
    return simhash_bk.near_duplicates(read(spark, sf_dir, "documents"), words=3, radius=3)


@query
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items that stand in each document."""
    return decontam.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged conversations repaired by their cheapest edits."""
    rows = read(spark, sf_dir, "conversations")
    return conversation_repair.reports(conversation_repair.damaged(rows), rows, "copies")


#: The DP as a fold over each conversation's rows; three steps a row: the row, then insertions to u and to a.
ORACLES["op11_conversation_repair"] = """
WITH keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
  FROM conversations),
coded AS (
  SELECT *, xor(list_reduce(list_transform(range(length(k)), lambda i: CAST(ascii(substr(k, 1 + CAST(i AS INTEGER), 1)) AS BIGINT)),
      lambda crc, b: list_reduce(range(8), lambda x, n: xor(x >> 1, 3988292384 * (x & 1)), xor(crc, b)),
      4294967295::BIGINT), 4294967295) % 20 AS code FROM keyed),
damaged AS (
  SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN code = 1 THEN '' WHEN code = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE WHEN code = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM coded WHERE code <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM damaged),
faulty AS (
  SELECT *, bare = '' AS blank, bare <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS duplicate,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before, left(role, 1) AS kind FROM placed),
flagged AS (
  SELECT *, NOT blank AND NOT duplicate AND right(bare, 1) NOT IN ('.', '!', '?') AS truncated FROM faulty),
steps AS (
  SELECT conv_id, list({'step': step, 'kind': kind, 'gone': blank OR duplicate,
                        'more': CASE WHEN truncated THEN 5::BIGINT ELSE 0::BIGINT END} ORDER BY i, step) AS steps
  FROM flagged, (SELECT unnest([0, 1, 2]) AS step) GROUP BY conv_id),
folded AS (
  SELECT conv_id, list_reduce(steps, lambda z, x: CASE x.step
    WHEN 0 THEN {
      'e': {'c': z.e.c + 2, 't': z.e.t || 'D'},
      's': least({'c': z.s.c + 2, 't': z.s.t || 'D'},
                 {'c': z.e.c + x.more + CASE WHEN x.gone OR x.kind <> 's' THEN 1000000000000 ELSE 0 END, 't': z.e.t || 'K'}),
      'u': least({'c': z.u.c + 2, 't': z.u.t || 'D'},
                 {'c': least(z.e, z.s, z.a).c + x.more + CASE WHEN x.gone THEN 1000000000000 WHEN x.kind = 'u' THEN 0 ELSE 1 END,
                  't': least(z.e, z.s, z.a).t || CASE WHEN x.kind = 'u' THEN 'K' ELSE 'R' END}),
      'a': least({'c': z.a.c + 2, 't': z.a.t || 'D'},
                 {'c': z.u.c + x.more + CASE WHEN x.gone THEN 1000000000000 WHEN x.kind = 'a' THEN 0 ELSE 1 END,
                  't': z.u.t || CASE WHEN x.kind = 'a' THEN 'K' ELSE 'R' END})}
    WHEN 1 THEN {'e': z.e, 's': z.s,
      'u': least(z.u, {'c': least(z.e, z.s, z.a).c + 5, 't': least(z.e, z.s, z.a).t || 'I'}), 'a': z.a}
    ELSE {'e': z.e, 's': z.s, 'u': z.u, 'a': least(z.a, {'c': z.u.c + 5, 't': z.u.t || 'I'})} END,
    {'e': {'c': 0::BIGINT, 't': ''}, 's': {'c': 1000000000000::BIGINT, 't': ''},
     'u': {'c': 5::BIGINT, 't': 'I'}, 'a': {'c': 10::BIGINT, 't': 'II'}}) AS z
  FROM steps),
audits AS (SELECT conv_id, least(z.e, z.a).c AS cost, least(z.e, z.a).t AS audit FROM folded),
edits AS (SELECT conv_id, unnest(range(1, 1 + length(audit))) AS j, audit FROM audits),
named AS (SELECT conv_id, j, substr(audit, CAST(j AS INTEGER), 1) AS edit FROM edits),
used AS (SELECT *, sum(CASE WHEN edit <> 'I' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY j) AS i FROM named),
held AS (
  SELECT n.conv_id, n.j, n.edit, r.role, r.text, row_number() OVER (PARTITION BY n.conv_id ORDER BY n.j) AS p,
         n.edit = 'K' AND r.kind = 's' AS opens
  FROM used n LEFT JOIN flagged r ON r.conv_id IS NOT DISTINCT FROM n.conv_id AND r.i = n.i WHERE n.edit <> 'D'),
due AS (SELECT *, p - max(CASE WHEN opens THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS q FROM held),
hashed AS (
  SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN q % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' ||
                             CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY j) AS whole
  FROM due GROUP BY conv_id),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE duplicate) AS duplicate,
         count(*) FILTER (WHERE truncated) AS truncated,
         count(*) FILTER (WHERE i > 1 AND before || kind NOT IN ('su', 'ua', 'au')) AS illegal
  FROM flagged GROUP BY conv_id)
SELECT o.conv_id, CAST(coalesce(n.gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(n.blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(n.duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(n.truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(n.illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(a.cost, 0) AS BIGINT) AS cost,
       coalesce(a.audit, '') AS audit, sha256(coalesce(h.whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted n ON n.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN audits a ON a.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN hashed h ON h.conv_id IS NOT DISTINCT FROM o.conv_id
"""


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives for the positives of every 50th embedding; every 7th row's label is shifted first."""
    id_ = F.col("vec_id")
    return hard_negatives.mine(read(spark, sf_dir, "embeddings"), id_ % 50 == 0,
                               label=F.when(id_ % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))


ORACLES["op12_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.x, c.x) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id
         ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank, n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""


@query
def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learned from four of five folds."""
    docs = read(spark, sf_dir, "documents")

    def fold(doc_id: Column) -> Column:
        return F.crc32(doc_id.cast("string").cast("binary")) % 5

    got = lang_cnn.predictions(docs, fold(F.col("doc_id")) != 0)
    return got.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "lang_pred", "score")
