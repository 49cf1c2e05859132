"""Shards of rows and of tokens: names, and what a folder of them holds."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomlake.sources.binary import token_counts
from loomlake.sources.files import listed

#: Fixed value: tokens of a full shard.
SHARD_TOKENS = 5_000_000


def shard_files(files: list[dict], dataset: str) -> list[dict]:
    """Of a listing, the token files of one dataset: the old single file first, then its shards in order.

    Another dataset whose name begins with this one's is not meant.
    """
    single = [f for f in files if f["path"] in (f"{dataset}.npy", f"{dataset}.bin")]
    own = re.compile(re.escape(dataset) + r"-\d+\.(npy|bin)")
    return single + sorted((f for f in files if own.fullmatch(f["path"])), key=lambda f: f["path"])


def next_index(files: list[dict], dataset: str) -> int:
    """The number of the next shard of a dataset."""
    found = [re.fullmatch(re.escape(dataset) + r"-(\d+)\.\w+", f["path"]) for f in files]
    return max((int(m[1]) for m in found if m), default=-1) + 1


def tokens_in(spark: SparkSession, folder: str) -> DataFrame:
    """dataset, tokens of the shards in a folder, and the grand total with a null dataset; is_total tells it apart.

    Only headers are read.
    """
    name = F.regexp_extract("path", r"([^/]+?)(?:-\d+)?\.(?:npy|bin)$", 1)
    rows = spark.createDataFrame(token_counts(folder), "path string, n long").select(name.alias("dataset"), "n")
    return rows.rollup("dataset").agg(F.sum("n").alias("tokens"), F.count("*").alias("files"), F.grouping("dataset").cast("int").alias("is_total"))


def token_progress(files: list[dict], local: dict[str, int], dataset: str) -> int:
    """Tokens that a dataset has already: those of local shards by count, of others a full shard each but the last."""
    names = [f["path"] for f in shard_files(files, dataset)]
    here = [n for n in names if n in local]
    away = [n for n in names if n not in local]
    return sum(local[n] for n in here) + max(0, len(away) - 1) * SHARD_TOKENS


def folder_bytes(spark: SparkSession, folder: str) -> tuple[int, int]:
    """The bytes of all files below a folder and of the largest one."""
    sizes = [f["size"] for f in listed(spark, folder)]
    return sum(sizes), max(sizes, default=0)
