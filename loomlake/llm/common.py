"""Helpers that the training-data operators share."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: a word is a run of bytes other than space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]"
#: Spark's setting that removes the shuffle files of a query once it has ended.
_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the cluster's setting; in local mode, where it is unset, one of our own."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="loomlake-")
        atexit.register(shutil.rmtree, named, True)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named


#: Spark's setting for the rows that a Python worker gets at once.
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _written(df: DataFrame, rows: int | None = None) -> tuple[DataFrame, str]:
    """df as a Parquet table in the shared folder, read again, and its path; the query's shuffle files go at once.

    rows: how many rows a Python worker gets at once, where rows are wide.
    """
    spark = df.sparkSession
    usual = spark.conf.get(_ROWS)
    if rows:
        spark.conf.set(_ROWS, str(rows))
    path = f"{checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    before = spark.conf.get(_TIDY, None)
    spark.conf.set(_TIDY, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_ROWS, usual)
        if before is None:
            spark.conf.unset(_TIDY)
        else:
            spark.conf.set(_TIDY, before)
    return spark.read.schema(df.schema).parquet(path), path


def stored(df: DataFrame) -> DataFrame:
    """df written in the shared folder and read again, for results that outlive the work on them."""
    return _written(df)[0]


class Scratch:
    """Tables in the shared folder that are needed only while a result is made: the end of `with` removes them."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.tables: list[tuple[DataFrame, str]] = []

    def stored(self, df: DataFrame, rows: int | None = None) -> DataFrame:
        self.tables.append(_written(df, rows))
        return self.tables[-1][0]

    def drop(self, *dropped: DataFrame) -> None:
        """Remove tables that nothing reads any more."""
        for df, path in [t for t in self.tables if any(t[0] is d for d in dropped)]:
            where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)
        self.tables = [t for t in self.tables if not any(t[0] is d for d in dropped)]

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self.drop(*[df for df, _ in self.tables])


def cut(df: DataFrame) -> DataFrame:
    """df with its lineage cut by a reliable checkpoint; for narrow tables."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def n_words(text: Column) -> Column:
    """Number of words of a text; null and empty texts have none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value evaluated once, however often body names it, inside lambdas too."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fresh(docs: DataFrame, name: str) -> str:
    """A column name like `name` that docs does not have."""
    had = {c.lower() for c in docs.columns}
    while name.lower() in had:
        name = "_" + name
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
