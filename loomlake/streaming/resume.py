"""Resumable runs: a file stream that processes only files not seen before and then stops."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def process_new(spark: SparkSession, source: str, schema, transform: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str, fmt: str = "parquet") -> None:
    """Apply transform to the files of source that no earlier run has committed; output and progress are atomic by batch."""
    rows = spark.readStream.schema(schema).format(fmt).load(source)
    run = transform(rows).writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    run.awaitTermination()
