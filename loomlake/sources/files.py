"""Readers of corpus files by format, and writers of rows and archives."""

from __future__ import annotations

import json
import re
import tarfile
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from pathlib import Path, PurePosixPath
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from loomlake.functions.text import strip
from loomlake.sources.binary import read_arrow

#: The file formats by ending.
FORMATS = ("parquet", "csv", "tsv", "jsonl", "json", "arrow")


def detect_format(path: str) -> str | None:
    """The format of a file by its ending, in any case; None for other files."""
    ending = PurePosixPath(path).suffix[1:].lower()
    return ending if ending in FORMATS else None


def listed(spark: SparkSession, root: str) -> list[dict[str, Any]]:
    """path (below root) and size of all files below a folder of any store that Spark reads, sorted by path; none if it is missing."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    top = jvm.org.apache.hadoop.fs.Path(root)
    fs = top.getFileSystem(conf)
    top = fs.makeQualified(top)
    if not fs.exists(top):
        return []
    found, files = [], fs.listFiles(top, True)
    while files.hasNext():
        f = files.next()
        found.append({"path": f.getPath().toString()[len(top.toString().rstrip("/")) + 1 :], "size": f.getLen()})
    return sorted(found, key=lambda f: f["path"])


def data_files(files: Iterable[Mapping[str, Any]], config: str | None = None, split: str = "train") -> list[dict[str, Any]]:
    """The files of a dataset's listing to read: those below the folder `config`, else those that name it.

    Of files other than Parquet only those whose names begin with the split, if there are any.
    """
    found = [dict(f) for f in files if detect_format(f["path"])]
    if config:
        found = [f for f in found if f["path"].startswith(config + "/")] or [f for f in found if config in f["path"]]
    columnar = [f for f in found if f["path"].endswith(".parquet")]
    others = [f for f in found if not f["path"].endswith(".parquet")]
    of_split = [f for f in others if re.match(re.escape(split) + r"[.-]", PurePosixPath(f["path"]).name)]
    return sorted(columnar + (of_split or others), key=lambda f: f["path"])


def _beginnings(spark: SparkSession, paths: list[str], many: int = 1) -> list[str]:
    """The first bytes of files, read by the driver side by side, as text; many lines where a number is negative."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def first(path: str) -> str:
        where = jvm.org.apache.hadoop.fs.Path(path)
        stream = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(where.getFileSystem(conf).open(where), "UTF-8"))
        try:
            if many < 0:
                return stream.readLine() or ""
            code = stream.read()
            return chr(code) if code >= 0 else ""
        finally:
            stream.close()

    with ThreadPoolExecutor(16) as pool:
        return list(pool.map(first, paths))


def _paths(spark: SparkSession, path: str | list[str], fmt: str) -> list[str]:
    """A list of files: that given, a file, or those of a format below a folder."""
    if not isinstance(path, str):
        return path
    if detect_format(path) == fmt:
        return [path]
    return [f"{path.rstrip('/')}/{f['path']}" for f in listed(spark, path) if detect_format(f["path"]) == fmt]


def read_rows(spark: SparkSession, path: str | list[str], fmt: str | None = None, schema=None, each: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Rows of files of one format, by default that of the ending; values of CSV and TSV are strings; a bad JSON line raises.

    Each JSON file is an array or lines by its own first character; CSV files may have different headers. Columns that some
    files lack are null there. One reader serves all files that look alike; `each` sees what it reads.
    """
    fmt = fmt or detect_format(path if isinstance(path, str) else path[0])
    if fmt == "parquet":
        return each(spark.read.option("mergeSchema", not isinstance(path, str)).parquet(*([path] if isinstance(path, str) else path)))
    if fmt in ("json", "jsonl"):
        reader = spark.read.option("mode", "FAILFAST")
        reader = reader.schema(schema) if schema is not None else reader
        if fmt == "jsonl":
            return each(reader.json(path))
        paths = _paths(spark, path, fmt)
        kinds = _beginnings(spark, paths)
        groups = [(whole, [p for p, c in zip(paths, kinds, strict=True) if (c == "[") == whole]) for whole in (True, False)]
        return union([each(reader.option("multiLine", whole).json(found)) for whole, found in groups if found])
    if fmt in ("csv", "tsv"):
        paths = _paths(spark, path, fmt)
        heads: dict[str, list[str]] = {}
        for p, line in zip(paths, _beginnings(spark, paths, -1), strict=True):
            heads.setdefault(line, []).append(p)
        reader = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').option("sep", "," if fmt == "csv" else "\t")
        return union([each(reader.csv(found)) for found in heads.values()])
    if fmt == "arrow":
        return read_arrow(spark, path)
    raise ValueError(f"unknown format {fmt!r}")


def mirrored(spark: SparkSession, root: str, config: str | None = None, split: str = "train", files: Iterable[str] | None = None) -> DataFrame:
    """Rows of a dataset's mirror in a folder, all of its files in one table; columns that a file lacks are null.

    Files of one format are read together.
    """
    chosen = [{"path": f} for f in files] if files else data_files(listed(spark, root), config, split)
    if not chosen:
        raise FileNotFoundError(root)
    groups: dict[str, list[str]] = {}
    for f in chosen:
        groups.setdefault(detect_format(f["path"]) or "", []).append(f"{root.rstrip('/')}/{f['path']}")
    return union([read_rows(spark, paths, fmt) for fmt, paths in groups.items()])


def union(parts: list[DataFrame]) -> DataFrame:
    """All rows of several tables; columns that a table lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def raw_texts(spark: SparkSession, path: str, more: Iterable[str] = ()) -> DataFrame:
    """text, and file and row that give the order of reading; only the text column and `more` are read and empty texts are dropped."""
    rows = spark.read.parquet(path).select("text", *more, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    return rows.where("text IS NOT NULL AND text <> ''")


def lines(spark: SparkSession, path: str, names: str = "*.json*") -> DataFrame:
    """file, line (counted from 1) and value of the lines of text files that are not blank; names: which files of a folder.

    A file may be read in any number of splits: the lines of each split are counted, the counts of the splits before it are added
    up, and a line's place in its split is the distance of its row number from the split's first one.
    """
    alone = path.endswith((".json", ".jsonl")) and any(not f["path"] for f in listed(spark, path))
    reader = spark.read if alone else spark.read.option("pathGlobFilter", names)
    at = F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    rows = reader.text(path).select(*at, "value").withColumn("number", F.monotonically_increasing_id())
    splits = rows.groupBy("file", "block").agg(F.min("number").alias("first"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    splits = splits.select("file", "block", (before - F.col("first") + 1).alias("shift"))
    numbered = rows.join(splits, ["file", "block"]).where(strip(F.col("value")) != "")
    return numbered.select("file", (F.col("number") + F.col("shift")).alias("line"), "value")


def conversation_records(spark: SparkSession, path: str, names: str = "*.json*") -> DataFrame:
    """file, line, messages, source of a file or folder of JSON lines; any row that is not valid raises and names file and line.

    A row without a source has its file's name; an explicit null stays.
    """
    from loomlake.operators.chat import MESSAGES, checked

    rows = lines(spark, path, names)
    where = F.concat_ws(":", "file", F.col("line").cast("string"))
    parsed = F.from_json("value", f"messages {MESSAGES}, source string")
    keys = F.coalesce(F.json_object_keys("value"), F.array().cast("array<string>"))
    named = F.when(F.array_contains(keys, "source"), parsed["source"]).otherwise(F.regexp_extract("file", r"([^/]*)$", 1))
    return rows.select("file", "line", checked(parsed["messages"], where).alias("messages"), named.alias("source"))


def row_count(spark: SparkSession, path: str) -> int:
    """How many lines of text files are not blank."""
    return spark.read.text(path).where(strip(F.col("value")) != "").count()


def write_jsonl(df: DataFrame, path: str, append: bool = False) -> None:
    df.write.mode("append" if append else "overwrite").json(path)


def write_archive(files: Iterable[str], path: str) -> None:
    """An uncompressed tar file of files in their order, with times set to 0."""
    with tarfile.open(path, "w") as tar:
        for name in files:
            info = tar.gettarinfo(name, arcname=Path(name).name)
            info.mtime = 0
            with open(name, "rb") as f:
                tar.addfile(info, f)


def write_archives(files: list[str], folder: str, prefix: str, batches: list[int]) -> list[str]:
    """One archive for each batch number, named by it; the files of a batch keep their order."""
    out = []
    for k in sorted(set(batches)):
        out.append(f"{folder}/{prefix}_{k:04d}.tar")
        write_archive([f for f, b in zip(files, batches) if b == k], out[-1])
    return out


def write_state(state: dict, path: str) -> None:
    """A manifest, replaced atomically."""
    new = Path(path + ".new")
    new.write_text(json.dumps(state, indent=1, sort_keys=True))
    new.replace(path)
