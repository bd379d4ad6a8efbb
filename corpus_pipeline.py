"""The corpus pipeline: filter, clean, de-duplicate and pack ``documents``.

Every stage takes the documents that its predecessor kept, with all their columns, written
as Parquet and read again; the last one returns the packed pieces. A stage maps
(spark, docs, sf_dir) to a frame.

A text that loses lines keeps its row, with ``n_chars`` brought up to date; a text that loses
all of them stays as an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from touchline.llm import linededup, minhash, packing, quality, toxicity
from touchline.llm.common import ship, stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule or repeat themselves go."""
    ship(spark)
    return quality.keep_good(docs)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of 0.5 or more go."""
    labels = table(spark, sf_dir, "labels")
    return toxicity.keep_clean(docs, toxicity.train(docs, labels))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of three documents or more stay in the last one only."""
    ship(spark)
    return linededup.without_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    ship(spark)
    return minhash.drop_near_duplicates(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of the documents that are left."""
    ship(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", toxic),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("packing", pack),
]

#: Tokenizing and the learned model can't be told in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n + 1 < len(STAGES):
            docs = stored(docs, f"stage{n + 1}")
    return docs
