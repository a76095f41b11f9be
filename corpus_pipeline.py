"""The corpus pipeline: quality, exact dedup, near dedup, mixing to target weights, SentencePiece ids.

Each stage works on all that the one before kept, written as Parquet and read again. What a stage staged is
removed once its result is written.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tradewind.llm import exact_dedup, mixing, near_dedup, pieces, quality
from tradewind.llm.common import table
from tradewind.sources.stage import reads_staged, remove_staged, stage, staged_since, staged_so_far

_ended: list[str] = []      # staged by the stage that returned last


def owner(step):
    """A stage that first removes what the one before staged, if its documents were written outside and rest on no staged table."""
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if not reads_staged(docs, staged_since(0)):
            remove_staged(spark, _ended)
        mark = staged_so_far()
        out = step(spark, docs, sf_dir)
        _ended[:] = staged_since(mark)
        return out
    run.__name__, run.__doc__ = step.__name__, step.__doc__
    return run


@owner
def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on labelled ones of these, does not reject."""
    return quality.keep_good(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


@owner
def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_repeats(docs)


@owner
def different(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that near-duplicate links connect."""
    return near_dedup.drop_near_duplicates(docs)


@owner
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights."""
    return mixing.mix_documents(docs)


@owner
def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, SentencePiece ``ids`` of the text, and whether they decode to it."""
    return pieces.encode_ids(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [("quality", good), ("exact_dedup", distinct), ("near_dedup", different), ("mix", mixed), ("sentencepiece", encoded)]

#: The classifier and the tokenizer are beyond SQL; the tests check every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), []
    for name, step in STAGES[:-1]:
        mark = staged_so_far()
        docs = stage(step(spark, docs, sf_dir), name)
        *inner, result = staged_since(mark)
        remove_staged(spark, before + inner)
        _ended.clear()
        before = [result]
    return STAGES[-1][1](spark, docs, sf_dir)
