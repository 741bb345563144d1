"""Corpus pipeline: quality rules, line dedup, near-duplicate removal, source mix, tokens.

Each stage is a function (spark, docs, sf_dir) -> DataFrame on all that its predecessor kept; all
but the last return the columns of ``documents``.  The last returns one row per document of the
mix (repeats included) with its token ids.  NULL texts count as empty; a table without rows
passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from convoy.llm import bpe, line_dedup, mixing, quality_rules, simhash
from convoy.llm.common import col, staged, table
from convoy.llm.queries import PATTERN, VOCABULARY


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base conditions or a rule go."""
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose the lines that three or more documents share (one document keeps them)."""
    return line_dedup.dedup_lines(docs).select(*[col(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays, the one of smallest id."""
    return simhash.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source gets its target number of words; documents repeat or go whole."""
    return mixing.apply_mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and the hash of the text that they decode to."""
    return bpe.encode_documents(docs, VOCABULARY, PATTERN)


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("simhash", near_duplicates),
    ("mixing", mix),
    ("bpe", tokens),
]

#: The mix selects by a seeded hash and a dynamic programme, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
