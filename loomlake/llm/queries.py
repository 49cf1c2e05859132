"""The queries of this subpackage and the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loomlake.llm import ann, bpe, fingerprint, importance, jaccard, line_dedup, mixing, quality, runs, suffix_dedup, toxicity, url_filters, warc
from loomlake.llm.common import table

#: The vocabulary that the queries encode with; operators take any path.
VOCABULARY = "word_bpe_49k.json"


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filters.filter_urls(url_filters.dated_captures(pages), url_filters.rule_entries(pages))


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.clustered(table(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary_path())


def op5_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited(table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.built(table(spark, sf_dir, "pages"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents"))


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digest(runs.with_loops(table(spark, sf_dir, "documents")))


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filters": op1_url_filters,
    "op2_jaccard": op2_jaccard,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_bpe": op4_bpe,
    "op5_fingerprint": op5_fingerprint,
    "op6_warc": op6_warc,
    "op7_line_dedup": op7_line_dedup,
    "op8_toxicity": op8_toxicity,
    "op9_nearest": op9_nearest,
    "op10_mixing": op10_mixing,
    "op11_importance": op11_importance,
    "op12_runs": op12_runs,
    "op13_quality": op13_quality,
}

ORACLES: dict[str, str] = {"op1_url_filters": url_filters.ORACLE, "op10_mixing": mixing.ORACLE, "op11_importance": importance.ORACLE}
