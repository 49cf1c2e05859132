"""Tokenizing and packing as files arrive: a stream of files whose sequences go on where the last batch ended.

Every batch puts the tokens that were left over before its documents, packs them, and commits whole sequences as token shards
together with what is left over now and the number of the next sequence. A batch that is repeated after a failure finds its name
in the manifest and does nothing, so increments give what one run over all files would.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomlake.operators.packing import Packing
from loomlake.sources import sink

#: Rows of one file at most: a document's place is its file's place and its own.
FILE_BITS = 40


def _ordered(spark: SparkSession, source: str, schema, paths: list[str]) -> DataFrame:
    """The rows of some files of source with `place`: files in the order of paths, rows as they are in them.

    They are read as a table, so that each pass over them reads only the columns that it needs.
    """
    rows = spark.read.schema(schema).parquet(source).select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    named = F.array(*map(F.lit, paths)).cast("array<string>")
    ranks = spark.range(len(paths)).select(F.col("id").alias("_rank"), F.element_at(named, (F.col("id") + 1).cast("int")).alias("_file"))
    found = rows.where(F.col("_file").isin(paths)).join(F.broadcast(ranks), "_file")
    return found.withColumn("place", F.shiftleft("_rank", FILE_BITS).bitwiseOR(F.col("_row"))).drop("_file", "_row", "_rank")


def pack_batch(docs: DataFrame, folder: str, dataset: str, length: int, shard_sequences: int, run: str, place: str = "place", tokens: Column | None = None, n: Column | None = None) -> None:
    """Add the tokens of docs (place, tokens) to the sequences of a dataset in a folder of token shards, once for each run.

    tokens, n: instead of a column tokens, an expression of docs, and how many tokens it has; it is evaluated where the tokens
    are packed, so docs are shuffled, and nothing is held between the passes over them.
    """
    state = sink.manifest(folder)
    if run in state["runs"]:
        return
    note = state["notes"].get(dataset) or {"rest": [], "next": 0}
    rest = F.from_json(F.lit(json.dumps(note["rest"])), "array<int>")
    before = docs.sparkSession.range(1).select(F.lit(-1).cast("long").alias("place"), rest.alias("__rest"))
    if tokens is not None and n is not None:
        docs = docs.withColumn("place", F.col(place).cast("long")).withColumn("__rest", F.lit(None).cast("array<int>"))
        every = before.unionByName(docs, allowMissingColumns=True)
        many = F.when(F.col("__rest").isNotNull(), F.size("__rest")).otherwise(n)
        _commit(Packing(every, length, "place", F.coalesce("__rest", tokens.cast("array<int>")), many), folder, dataset, length, shard_sequences, run, note["next"])
        return
    found = F.col("tokens") if tokens is None else tokens
    # counted, packed and searched for the rest: one batch is tokenized once
    every = before.withColumnRenamed("__rest", "tokens").unionByName(docs.select(F.col(place).alias("place"), found.cast("array<int>").alias("tokens"))).persist()
    try:
        _commit(Packing(every, length, "place", "tokens"), folder, dataset, length, shard_sequences, run, note["next"])
    finally:
        every.unpersist()


def _commit(packing: Packing, folder: str, dataset: str, length: int, shard_sequences: int, run: str, first: int) -> None:
    rows = packing.sequences().select(F.lit(dataset).alias("dataset"), F.expr(f"seq div {shard_sequences}").alias("shard"), (F.col("seq") + first).alias("seq"), "tokens")
    after = {"rest": packing.rest(), "next": first + packing.total // length}
    sink.write_shards(rows, folder, "npy", run, "seq", {dataset: after})


def pack_new(spark: SparkSession, source: str, schema, tokens: Callable[[DataFrame], DataFrame] | Column, folder: str, dataset: str, length: int, checkpoint: str, shard_sequences: int = 1024, files: int = 1000, n: Column | None = None) -> None:
    """Pack the Parquet files of source that no earlier run has packed, some files at once, and stop.

    tokens: gives rows a column tokens and keeps their columns; or an expression of the rows, with n telling how many tokens it
    has where that is cheaper to tell than to make them.
    """
    # the stream tells which files are new; what is in them is read batch by batch
    new = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(source).select(F.col("_metadata.file_path").alias("_file"))

    def one(batch: DataFrame, number: int) -> None:
        rows = _ordered(batch.sparkSession, source, schema, sorted(r["_file"] for r in batch.distinct().collect()))  # the files of one batch
        made, made_of = (None, tokens(rows)) if callable(tokens) and not isinstance(tokens, Column) else (tokens, rows)
        pack_batch(made_of, folder, dataset, length, shard_sequences, f"{dataset}-{number}", tokens=made, n=n)

    run = new.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    run.awaitTermination()
