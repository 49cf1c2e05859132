"""The corpus pipeline: toxicity, line dedup, one document of each near-duplicate group, mixing to target weights, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet in the shared folder and read
again as the next stage's documents. All stages but the last return the columns of documents; the last one adds the ids of
the tokens. The stages are not expressible in SQL (dictionaries, hashing, BPE), so there is no ORACLE_SQL.

Defined cases are those of the operators: empty tables give empty results, null texts stay until mixing, which takes no
document without words, extra columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomlake.llm import bpe, jaccard, line_dedup, mixing, toxicity
from loomlake.llm.common import stored, table
from loomlake.llm.queries import vocabulary_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the toxicity classifier does not reject."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels")).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without later occurrences of repeated line chunks."""
    return line_dedup.without_repeats(docs)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id; rows may repeat an id."""
    return jaccard.representatives(docs).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents mixed to the target weights, in the order of the mix, repeats included."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the ids of their tokens."""
    return bpe.tokenized(docs, vocabulary_path())


STAGES = [("toxicity", drop_toxic), ("line_dedup", dedup_lines), ("jaccard", dedup_near), ("mixing", mix), ("bpe", encode)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, from the documents of sf_dir."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
