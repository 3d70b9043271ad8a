"""Corpus pipeline: the training-data operators as stages over the documents table.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; the result of one
is the ``docs`` of the next.  All but the last return the columns of ``documents``.

* toxicity: drops documents that score 0.3 or more; learned from the labelled ones.
* language: drops documents without a letter, or like none of the languages that the
  documents' own ``lang`` column names.
* dedup: keeps one document of each SimHash component, the one with the least id.
* mix: takes each document as often as its source's weight asks for (0 to 2 times).
* encode: token counts and digests of the byte-level BPE ids, one row a document taken.

Empty tables give empty results.  Repeated rows count as copies and are reduced by the
dedup stage; null texts have no letter and go at the language stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm.bpe import with_bpe
from candlewick.llm.langid import keep_known_language
from candlewick.llm.mixing import take_mix
from candlewick.llm.queries import language_profiles, tokenizer_path, toxicity_model
from candlewick.llm.shared import table, written
from candlewick.llm.simhash import keep_one_of_each
from candlewick.llm.toxicity import drop_toxic

#: SQL can't express the learned stages, SimHash or BPE.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, toxicity_model(spark, sf_dir))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_known_language(docs, language_profiles(docs))


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return take_mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    encoded = with_bpe(docs.select("doc_id", "text"), tokenizer_path(), digest=True)
    return encoded.select("doc_id", F.col("__cw_bpe.*"))


STAGES = [("toxicity", toxicity), ("language", language), ("dedup", dedup), ("mix", mix), ("encode", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written once and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
