"""Corpus pipeline over ``documents``: five stages, each by one operator of
``stopcast.llm``.  A stage works on all rows that the one before it kept, and
all but the last return the columns of ``documents``.

* toxicity: documents that the class-conditional models reject go;
* near_duplicates: of each SimHash class the document with the smallest id stays;
* decontamination: documents in which a benchmark item stands go;
* personal_data: pattern and field spans are masked in the text, n_chars is set anew;
* token_ids: byte-level BPE ids of the text, with digests of the ids and of the
  text decoded from them.

Null texts pass the filters as texts without evidence, empty tables give empty
results, repeated rows are copies (one stays), and further columns of
``documents`` are carried along up to the last stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from stopcast.llm import bpe_sql, decontam, pii_crf, simhash_bk, toxicity
from stopcast.llm.common import read, stored


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, read(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_bk.one_of_each(docs, words=3, radius=3)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.without_contaminated(docs, read(spark, sf_dir, "benchmark"))


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii_crf.mask(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe_sql.bpe_round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN,
                                  keep_ids=True, sparing=True)


STAGES = [("toxicity", toxicity_stage), ("near_duplicates", near_duplicate_stage),
          ("decontamination", decontamination_stage), ("personal_data", personal_data_stage), ("token_ids", token_stage)]

#: Trained models, hashes and merges are not SQL: tests/llm holds the stages
#: against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each written as a table and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
