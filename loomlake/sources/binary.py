"""Binary corpus files as Spark data sources whose partitions are parts of files: record batches and ranges of tokens.

The driver reads footers and headers alone; a task opens a file at its part, so files of any size are read by many tasks.
"""

from __future__ import annotations

import posixpath
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from loomlake.sources.store import files_in, located

#: Tokens that a task reads, in ranges of fewer if that is asked for, and files whose headers are read side by side.
TOKENS, SIDE_BY_SIDE = 4_000_000, 32


@dataclass
class Part(InputPartition):
    """A part of a file: a record batch by number, or a range of tokens by number and byte."""

    path: str
    start: int
    count: int = 1
    byte: int = 0
    kind: str = ""


@dataclass
class Parts(InputPartition):
    """Parts of files that one task reads, one after the other."""

    parts: list[Part]


def _files(folder: str, endings: tuple[str, ...]) -> list[str]:
    """The files of a folder, or those that a list of lines names."""
    if "\n" in folder:
        return [located(line)[1] for line in folder.split("\n") if line]
    store, path = located(folder)
    found = [f.path for f in files_in(store, path) if f.path.lower().endswith(endings) and not posixpath.basename(f.path).startswith((".", "_"))]
    if not found:
        raise FileNotFoundError(f"no files of {', '.join(endings)} in {folder}")
    return found


class ArrowFiles(DataSource):
    """Arrow files: one partition for each record batch; the schema is that of the first file.

    With the option places, rows also have the columns _file and _row, which tell where they are.
    """

    @classmethod
    def name(cls) -> str:
        return "arrow_files"

    def schema(self) -> StructType:
        from pyspark.sql.pandas.types import from_arrow_schema

        folder = self.options["path"]
        store, _ = located(folder.split("\n")[0])
        with store.open_input_file(_files(folder, (".arrow",))[0]) as f, pa.ipc.open_file(f) as reader:
            found = from_arrow_schema(reader.schema)
        return found.add("_file", "string").add("_row", "long") if self.options.get("places") else found

    def reader(self, schema: StructType) -> DataSourceReader:
        return _ArrowReader(self.options["path"], schema, bool(self.options.get("places")))


class _ArrowReader(DataSourceReader):
    def __init__(self, folder: str, schema: StructType, places: bool):
        self.folder, self.names, self.places = folder, schema.names, places

    def partitions(self) -> list[Part]:
        store, _ = located(self.folder.split("\n")[0])

        def batches(path: str) -> list[Part]:
            with store.open_input_file(path) as f, pa.ipc.open_file(f) as reader:
                # rows before a batch are known only by reading the batches before it, whose buffers stay untouched
                sizes = [reader.get_batch(k).num_rows if self.places else 0 for k in range(reader.num_record_batches)]
                return [Part(path, k, count=sum(sizes[:k])) for k in range(reader.num_record_batches)]

        with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
            return [p for found in pool.map(batches, _files(self.folder, (".arrow",))) for p in found]

    def read(self, part: Part) -> Iterator[pa.RecordBatch]:
        store, _ = located(self.folder.split("\n")[0])
        with store.open_input_file(part.path) as f, pa.ipc.open_file(f) as reader:
            batch = reader.get_batch(part.start)
            if self.places:
                n = batch.num_rows
                batch = pa.RecordBatch.from_arrays([*batch.columns, pa.array([part.path] * n, pa.string()), pa.array(range(part.count, part.count + n), pa.int64())], names=[*batch.schema.names, "_file", "_row"])
            yield batch.select(self.names) if batch.schema.names != self.names else batch


class TokenShards(DataSource):
    """Token shards, .npy and .bin: path, start and tokens of ranges of at most `tokens` tokens, 32-bit numbers."""

    @classmethod
    def name(cls) -> str:
        return "token_shards"

    def schema(self) -> str:
        return "path string, start long, tokens array<int>"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _TokenReader(self.options["path"], int(self.options.get("tokens", TOKENS)))


def header(store, path: str) -> tuple[str, int, int]:
    """The kind of numbers, the byte at which they begin, and how many there are, without reading them."""
    if path.lower().endswith(".bin"):
        return "<i4", 0, store.get_file_info(path).size // 4
    with store.open_input_file(path) as f:
        version = np.lib.format.read_magic(f)
        shape, _, kind = (np.lib.format.read_array_header_1_0 if version == (1, 0) else np.lib.format.read_array_header_2_0)(f)
        return kind.str, f.tell(), int(np.prod(shape, dtype=np.int64))


class _TokenReader(DataSourceReader):
    def __init__(self, folder: str, most: int):
        self.folder, self.most = folder, most

    def partitions(self) -> list[Part]:
        store, _ = located(self.folder.split("\n")[0])
        paths = _files(self.folder, (".npy", ".bin"))
        with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
            heads = list(pool.map(lambda p: header(store, p), paths))
        out, held = [], TOKENS
        for path, (kind, byte, n) in zip(paths, heads, strict=True):
            for at in range(0, n, self.most):
                part = Part(path, at, min(self.most, n - at), byte, kind)
                if held + part.count > TOKENS:
                    out.append(Parts([]))
                    held = 0
                out[-1].parts.append(part)
                held += part.count
        return out

    def read(self, task: Parts) -> Iterator[pa.RecordBatch]:
        store, _ = located(self.folder.split("\n")[0])
        for part in task.parts:
            with store.open_input_file(part.path) as f:
                f.seek(part.byte + part.start * np.dtype(part.kind).itemsize)
                values = np.frombuffer(f.read(part.count * np.dtype(part.kind).itemsize), part.kind).astype("<i4", copy=False)
            tokens = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array([part.path]), pa.array([part.start], pa.int64()), tokens], names=["path", "start", "tokens"])


def read_arrow(spark: SparkSession, path: str | list[str], places: bool = False) -> DataFrame:
    """Rows of an Arrow file, of a list of them in one store, or of all Arrow files below a folder; places: with _file and _row."""
    spark.dataSource.register(ArrowFiles)
    reader = spark.read.format("arrow_files")
    return (reader.option("places", "yes") if places else reader).option("path", path if isinstance(path, str) else "\n".join([*path, ""][: max(2, len(path))])).load()


def read_tokens(spark: SparkSession, path: str, tokens: int = TOKENS) -> DataFrame:
    """path, start, tokens of the token shards below a folder; by path and start they are the stream. None at all raises."""
    spark.dataSource.register(TokenShards)
    return spark.read.format("token_shards").option("tokens", tokens).load(path)


def token_counts(path: str) -> list[tuple[str, int]]:
    """path and tokens of each shard below a folder, from headers alone."""
    store, _ = located(path)
    paths = _files(path, (".npy", ".bin"))
    with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
        return [(p, n) for p, (_, _, n) in zip(paths, pool.map(lambda p: header(store, p), paths), strict=True)]
