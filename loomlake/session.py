"""Session defaults for local runs and tests; a cluster brings its own session."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, app: str = "loomlake", **extra: str) -> SparkSession:
    """A local session with the settings that the tests and the benchmark share."""
    conf = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g",
        "spark.driver.host": "127.0.0.1",
    } | extra
    spark = SparkSession.builder.master(f"local[{cores}]").appName(app).config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


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


def scratch_folder(spark: SparkSession) -> str:
    """A new folder in the shared one, which goes when the session's driver ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/work-{uuid.uuid4().hex}"
    remove_at_end(spark, path)
    return path


def remove_at_end(spark: SparkSession, path: str) -> None:
    """Remove a file or folder when the driver ends."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = where.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(where)  # what is not there yet cannot be marked
    store.deleteOnExit(where)


def cut_lineage(df: DataFrame) -> DataFrame:
    """df behind a reliable checkpoint in the shared folder; for narrow tables."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
