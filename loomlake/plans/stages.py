"""The second stage of a corpus: row shards become token shards, files that were tokenized before are left out."""

from __future__ import annotations

import hashlib
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from loomlake.functions.tokenizers import Tokenizer, tokenized
from loomlake.operators import cuts
from loomlake.session import scratch_folder
from loomlake.sources import sink

#: Rows of one file, and chunks of one file, at most.
ROW_BITS, CHUNK_BITS = 40, 20


def pending(raw: str, out: str) -> list[dict]:
    """The row shards below raw, in order, that no run has tokenized into out."""
    done = {name for note in sink.manifest(out)["notes"].values() for name in note["processed"]}
    return [s for s in sorted(sink.manifest(raw)["shards"], key=lambda s: (s["dataset"], s["index"])) if s["name"] not in done]


def _paths(raw: str, found: list[dict]) -> list[str]:
    """What to read for row shards: a dataset's folder if all of its shards are meant, which lists it at once, else each file."""
    every = Counter(s["dataset"] for s in sink.manifest(raw)["shards"])
    whole = {d for d, n in Counter(s["dataset"] for s in found).items() if n == every[d]}
    return [f"{raw.rstrip('/')}/{name}" for name in sorted({s["dataset"] if s["dataset"] in whole else s["name"] for s in found})]


def documents(spark: SparkSession, raw: str, found: list[dict], empty: bool = False) -> DataFrame:
    """dataset, file, row, place, text of row shards whose text is not empty (empty: not null); only that column is read."""
    rows = spark.read.parquet(*_paths(raw, found))
    rows = rows.select("text", F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+/[^/]+)$", 1).alias("name"), F.col("_metadata.row_index").alias("row")).where("text IS NOT NULL" if empty else "text IS NOT NULL AND text <> ''")
    ranks = spark.createDataFrame([(s["name"], s["dataset"], k) for k, s in enumerate(found)], "name string, dataset string, file long")
    # the file's address leaves a plus as it is, which decoding would take for a blank
    joined = rows.withColumn("name", F.url_decode(F.replace("name", F.lit("+"), F.lit("%2B")))).join(ranks, "name")
    return joined.select("dataset", "file", "row", F.shiftleft("file", ROW_BITS).bitwiseOR(F.col("row")).alias("place"), "text")


def across_files(rows: DataFrame, shard_tokens: int) -> DataFrame:
    """Shards of whole documents that close when they reach a size, whatever files the documents are from."""
    return cuts.with_shards(rows, "dataset", "place", "n", shard_tokens).select("dataset", "shard", "place", F.col("ids").alias("tokens"))


def by_file(rows: DataFrame, shard_tokens: int) -> DataFrame:
    """Shards of exactly a size of each file's tokens, its last one shorter; documents are cut where a shard ends."""
    before = F.coalesce(F.sum("n").over(W.partitionBy("file").orderBy("row").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    # a file is a row shard, whose size is bounded
    placed = rows.where("n > 0").withColumn("at", before)
    parts = placed.withColumn("chunk", F.explode(F.sequence(F.expr(f"at div {shard_tokens}L"), F.expr(f"(at + n - 1) div {shard_tokens}L"))))
    start = F.greatest(F.col("at"), F.col("chunk") * shard_tokens)
    end = F.least(F.col("at") + F.col("n"), (F.col("chunk") + 1) * shard_tokens)
    tokens = F.slice("ids", (start - F.col("at") + 1).cast("int"), (end - start).cast("int"))
    shard = F.shiftleft("file", CHUNK_BITS).bitwiseOR(F.col("chunk"))
    return parts.select("dataset", shard.alias("shard"), start.alias("place"), tokens.alias("tokens"))


def tokenize(spark: SparkSession, raw: str, out: str, tokenizer: Tokenizer, shard_tokens: int = 5_000_000, split: str = "across_files", empty: bool = False) -> dict[str, tuple[int, int]]:
    """Tokenize the row shards below raw that are new into token shards below out; docs and tokens of each dataset that has any.

    Each document ends with the end of text if the tokenizer has one; empty: a document whose text is empty is one too. Documents
    are tokenized once, into a table that the cut and the shards read. Shards, counts and the names of the row shards are committed together, so a run that is repeated, or that
    was lost at any point, neither leaves out nor repeats a document.
    """
    if split not in ("across_files", "by_file"):
        raise ValueError(f"unknown split {split!r}")
    found = pending(raw, out)
    if not found:
        return {}
    rows = tokenized(documents(spark, raw, found, empty), tokenizer).withColumn("n", F.size("ids").cast("long")).drop("text")
    folder = scratch_folder(spark)
    rows.write.mode("overwrite").option("compression", "zstd").parquet(folder)
    rows = spark.read.schema(rows.schema).parquet(folder)
    counts = {r["dataset"]: (r["docs"], r["tokens"]) for r in rows.groupBy("dataset").agg(F.count("*").alias("docs"), F.sum("n").alias("tokens")).collect()}
    old = sink.manifest(out)["notes"]
    notes = {}
    for dataset in {s["dataset"] for s in found}:
        before = old.get(dataset) or {"processed": [], "docs": 0, "tokens": 0}
        docs, tokens = counts.get(dataset, (0, 0))
        notes[dataset] = {"processed": sorted([*before["processed"], *(s["name"] for s in found if s["dataset"] == dataset)]), "docs": before["docs"] + docs, "tokens": before["tokens"] + tokens}
    run = "tokenize-" + hashlib.sha256("\n".join(s["name"] for s in found).encode()).hexdigest()[:16]
    shards = across_files(rows, shard_tokens) if split == "across_files" else by_file(rows, shard_tokens)
    sink.write_shards(shards, out, "npy", run, "place", notes)
    return counts
