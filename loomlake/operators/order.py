"""Sampling order: files, row groups, rows, always the same for one seed and independent of the order of listing."""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterable, Iterator, Mapping
from functools import lru_cache
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from loomlake.sources.binary import read_arrow
from loomlake.sources.store import located

#: Fixed value: rows of a buffer in which files that are no tables are shuffled.
BUFFER = 4096


def stable_number(*parts: Any) -> int:
    """The first 32 bits of the SHA-256 of the parts joined by two colons."""
    return int(hashlib.sha256("::".join(map(str, parts)).encode()).hexdigest()[:8], 16)


def ordered_files(files: Iterable[Mapping[str, Any]], name: str, path: str, seed: int = 42, mode: str = "shuffled") -> list[dict[str, Any]]:
    """Files by path, and then in the seeded order unless the mode is 'sorted'."""
    if mode not in ("shuffled", "sorted"):
        raise ValueError(f"unknown file order {mode!r}")
    found = sorted((dict(f) for f in files), key=lambda f: f["path"])
    if mode == "shuffled":
        random.Random(stable_number(seed, name, path, "files")).shuffle(found)
    return found


def by_name(paths: Iterable[str]) -> list[str]:
    """Paths in the order of their names, then folders."""
    return sorted(paths, key=lambda p: (p.rpartition("/")[2], p))


def row_key(*of: Column, seed: int = 42, name: str = "", salt: str = "rows") -> Column:
    """A shuffling key of rows, 60 bits of a SHA-256, in the stead of a sequential shuffle: no prefix is preferred."""
    return F.conv(F.substring(F.sha2(F.concat_ws("::", F.lit(str(seed)), F.lit(name), F.lit(salt), *of), 256), 1, 15), 16, 10).cast("long")


def shuffled(n: int, seed: int) -> np.ndarray:
    """Of each of n rows, its place in their seeded order, which is that of the generator of the standard library."""
    order = list(range(n))
    random.Random(seed).shuffle(order)
    places = np.empty(n, np.int64)
    places[order] = np.arange(n)
    return places


def _modes(sampling: Mapping[str, Any]) -> tuple[int, bool, bool, int]:
    """The seed, whether row groups and rows are shuffled, and the rows of a buffer."""
    for key in ("row_group_order", "row_order"):
        if sampling.get(key, "shuffled") not in ("shuffled", "sorted"):
            raise ValueError(f"unknown {key} {sampling[key]!r}")
    return int(sampling.get("seed", 42)), sampling.get("row_group_order", "shuffled") == "shuffled", sampling.get("row_order", "shuffled") == "shuffled", int(sampling.get("json_shuffle_buffer", BUFFER))


def _row_groups(spark: SparkSession, paths: list[str]) -> dict[str, list[int]]:
    """The rows of each row group of Parquet files, from their footers, which tasks read."""
    import pyarrow.parquet as pq

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            sizes = []
            for path in part["path"]:
                store, at = located(path)
                with store.open_input_file(at) as f:
                    footer = pq.ParquetFile(f).metadata
                    sizes.append([footer.row_group(k).num_rows for k in range(footer.num_row_groups)])
            yield pd.DataFrame({"path": part["path"], "sizes": sizes})

    tasks = min(len(paths), 4 * spark.sparkContext.defaultParallelism)
    rows = spark.createDataFrame([(p,) for p in paths], "path string").repartition(tasks)
    return {r["path"]: r["sizes"] for r in rows.mapInPandas(run, "path string, sizes array<long>").collect()}


def _file_path() -> Column:
    """The file of a scanned row; local ones are named in several ways."""
    return F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "/").alias("_file")


def _numbered(rows: DataFrame) -> DataFrame:
    """rows with _file, and _row: their number in it, from a scan that may split files."""
    at = _file_path(), F.col("_metadata.file_block_start").alias("_block")
    numbered = rows.select("*", *at).withColumn("_number", F.monotonically_increasing_id())
    splits = numbered.groupBy("_file", "_block").agg(F.min("_number").alias("first"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("_file").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    splits = splits.select("_file", "_block", (before - F.col("first")).alias("_shift"))
    return numbered.join(splits, ["_file", "_block"]).withColumn("_row", F.col("_number") + F.col("_shift")).drop("_block", "_number", "_shift")


def placed_rows(spark: SparkSession, root: str, files: list[str], name: str, sampling: Mapping[str, Any] | None = None) -> DataFrame:
    """All rows of some files below root with `place`, their number in the sampling order: file by file, as the list has them.

    A Parquet file's row groups come in a seeded order and each group's rows in theirs; rows of CSV, TSV and JSON lines in the
    order of buffers of `json_shuffle_buffer` rows, each shuffled; JSON arrays and Arrow files are shuffled as wholes. The modes
    row_group_order and row_order may be 'sorted'. Each row computes its place where it is read: the seeded order of a group is
    made once by the task that reads it, and no row is moved.
    """
    from loomlake.sources.files import _beginnings, detect_format, read_rows, union

    seed, groups_shuffled, rows_shuffled, buffer = _modes(sampling or {})
    kinds: dict[str, list[str]] = {}
    whole = {f: f"{root.rstrip('/')}/{f}" for f in files}
    for f in files:
        kinds.setdefault(detect_format(f) or "", []).append(f)
    if "json" in kinds:
        first = _beginnings(spark, [whole[f] for f in kinds["json"]])
        arrays = [f for f, c in zip(kinds["json"], first, strict=True) if c == "["]
        rest = [f for f in kinds.pop("json") if f not in arrays]
        kinds |= {"json array": arrays} if arrays else {}
        kinds |= {"json": rest} if rest else {}

    def address(path: str) -> str:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        return re.sub("^file:/+", "/", at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toUri().toString())

    parts, sizes = [], {}
    for kind, found in kinds.items():
        paths = [whole[f] for f in found]
        if kind == "parquet":
            rows = read_rows(spark, paths, kind).select("*", _file_path(), F.col("_metadata.row_index").alias("_row"))
            groups = _row_groups(spark, paths)
            sizes |= {f: groups[whole[f]] for f in found}
        elif kind == "arrow":
            rows = read_arrow(spark, paths, places=True)
        else:
            rows = read_rows(spark, paths, kind.split()[0], each=_numbered)
        if kind != "parquet":
            counts = {r["_file"]: r["count"] for r in rows.groupBy("_file").count().collect()}
            sizes |= {f: [counts.get(located(whole[f])[1] if kind == "arrow" else address(whole[f]), 0)] for f in found}
        salt = {"parquet": "rows", "arrow": "arrow-rows", "json array": "json"}.get(kind, kind)
        width = buffer if kind in ("csv", "tsv", "jsonl", "json") else 0
        table = []
        for f in found:
            n = sizes[f]
            order = shuffled(len(n), stable_number(seed, name, f, "row-groups")) if kind == "parquet" and groups_shuffled else np.arange(len(n))
            ahead = np.zeros(len(n) + 1, np.int64)
            ahead[1:] = np.cumsum(np.array(n, np.int64)[np.argsort(order)]) if n else 0
            begins = [0, *np.cumsum(n).tolist()][: len(n)]
            key = located(whole[f])[1] if kind == "arrow" else address(whole[f])
            table.append((key, f, begins, [int(x) for x in n], [int(ahead[o]) for o in order], "csv" if salt == "tsv" else salt, width))
        parts.append((rows, table))

    start = np.cumsum([0, *[sum(sizes[f]) for f in files]])
    begins_at = dict(zip(files, start.tolist()[:-1], strict=True))

    @F.pandas_udf("long")
    def place(row: pd.Series, at: pd.DataFrame) -> pd.Series:
        held: dict[tuple, np.ndarray] = {}
        out = np.empty(len(row), np.int64)
        frame = at.assign(row=row.to_numpy(), k=np.arange(len(row)))
        for (path, group, salt, n), part in frame.groupby(["path", "group", "salt", "n"], sort=False):
            numbers = part["row"].to_numpy()
            if not rows_shuffled:
                out[part["k"]] = numbers
                continue
            key = path, group, salt, n
            if key not in held:
                label = salt if group < 0 else f"{salt}:{group}"
                held[key] = _remembered(n, stable_number(seed, name, path, label))
            out[part["k"]] = held[key][numbers]
        return pd.Series(out)

    made = []
    for rows, table in parts:
        columns = "_file string, _path string, _begins array<long>, _sizes array<long>, _ahead array<long>, _salt string, _width long, _base long"
        info = spark.createDataFrame([(*t, begins_at[t[1]]) for t in table], columns)
        joined = rows.join(info, "_file")
        # of a Parquet row, its row group; of other rows, their buffer
        group = F.when(F.col("_width") > 0, F.expr("_row div greatest(_width, 1)")).otherwise(F.size(F.filter("_begins", lambda b: b <= F.col("_row"))) - 1)
        joined = joined.withColumn("_group", group.cast("long"))
        buffered = F.col("_width") > 0
        inside = F.when(buffered, F.col("_row") % F.greatest("_width", F.lit(1))).otherwise(F.col("_row") - F.get("_begins", F.col("_group").cast("int")))
        count = F.when(buffered, F.least(F.col("_width"), F.get("_sizes", F.lit(0)) - F.col("_group") * F.col("_width"))).otherwise(F.get("_sizes", F.col("_group").cast("int")))
        ahead = F.when(buffered, F.col("_group") * F.col("_width")).otherwise(F.get("_ahead", F.col("_group").cast("int")))
        label = F.when(F.col("_salt").isin("arrow-rows", "json") & ~buffered, F.lit(-1)).otherwise(F.col("_group")).cast("long")
        at = F.struct(F.col("_path").alias("path"), label.alias("group"), F.col("_salt").alias("salt"), count.cast("long").alias("n"))
        joined = joined.withColumn("place", F.col("_base") + ahead + place(inside.cast("long"), at))
        made.append(joined.drop("_file", "_row", "_path", "_begins", "_sizes", "_ahead", "_salt", "_width", "_base", "_group"))
    return union(made)


@lru_cache(maxsize=8)
def _remembered(n: int, seed: int) -> np.ndarray:
    return shuffled(n, seed)
