"""A sink of numbered shards whose names, files and manifest are committed together.

Tasks write files under hidden names. When all are done the driver decides the final names, which go on after those of the
manifest, and puts them down in one small file: that is the commit. Moving the files and renewing the manifest only carries it
out, and whoever opens the folder next does so if the driver was lost in between. A run that fails removes its hidden files and
leaves the folder as it was; a run whose name the manifest has already adds nothing.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from loomlake.sources.store import files_in, get_json, located, put_json

#: Spark's setting that removes the shuffle files of a query once it has ended.
_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
MANIFEST, COMMIT = "_manifest.json", "_commit.json"
#: Fixed value: digits of a shard's number in its name.
DIGITS = 5


def shard_file(dataset: str, index: int, ending: str) -> str:
    """The name of a shard below its folder: rows are in a folder for each dataset, tokens are not."""
    name = f"{dataset}-{index:0{DIGITS}d}{ending}"
    return f"{dataset}/{name}" if ending == ".parquet" else name


def manifest(folder: str) -> dict:
    """shards (dataset, index, name, rows, tokens), runs and notes of a folder; a commit that was not carried out to its end is, first."""
    store, path = located(folder)
    state = get_json(store, f"{path}/{MANIFEST}") or {"shards": [], "runs": [], "notes": {}}
    commit = get_json(store, f"{path}/{COMMIT}")
    if commit is not None:
        if commit["run"] not in state["runs"]:
            for new, old in commit["moves"].items():
                store.create_dir(posixpath.dirname(f"{path}/{new}"), recursive=True)
                if store.get_file_info(f"{path}/{old}").is_file:
                    store.move(f"{path}/{old}", f"{path}/{new}")
            state = {"shards": state["shards"] + commit["shards"], "runs": [*state["runs"], commit["run"]], "notes": state["notes"] | commit["notes"]}
            put_json(store, f"{path}/{MANIFEST}", state)
        store.delete_file(f"{path}/{COMMIT}")
    return state


@dataclass
class Written(WriterCommitMessage):
    """The hidden files of a task: dataset, shard, file, rows, tokens."""

    files: list[tuple[str, int, str, int, int]]


class _Npy:
    """A file of 32-bit numbers that grows; its header, of fixed length, is right once it is closed."""

    LENGTH = 128

    def __init__(self, store, path: str):
        self.store, self.path, self.n, self.parts = store, path, 0, []

    def write(self, batch: pa.RecordBatch) -> None:
        values = batch.column(batch.schema.get_field_index("tokens")).flatten().to_numpy().astype("<i4", copy=False)
        self.parts.append(values.copy())
        self.n += len(values)

    def close(self) -> None:
        head = f"{{'descr': '<i4', 'fortran_order': False, 'shape': ({self.n},), }}".encode()
        with self.store.open_output_stream(self.path) as f:
            f.write(np.lib.format.magic(1, 0) + (self.LENGTH - 10).to_bytes(2, "little") + head.ljust(self.LENGTH - 11) + b"\n")
            for part in self.parts:
                f.write(part.tobytes())


class _Parquet:
    """A Parquet file that grows row group by row group."""

    def __init__(self, store, path: str, schema: pa.Schema):
        self.out, self.n = pq.ParquetWriter(path, schema, filesystem=store, compression="zstd"), 0

    def write(self, batch: pa.RecordBatch) -> None:
        self.out.write_batch(batch)
        if "tokens" in batch.schema.names and pa.types.is_integer(batch.schema.field("tokens").type):
            self.n += int(np.asarray(batch.column(batch.schema.get_field_index("tokens")).fill_null(0)).sum())

    def close(self) -> None:
        self.out.close()


class _Arrow:
    """An Arrow file that grows record batch by record batch."""

    def __init__(self, store, path: str, schema: pa.Schema):
        self.to = store.open_output_stream(path)
        self.out, self.n = pa.ipc.new_file(self.to, schema), 0

    def write(self, batch: pa.RecordBatch) -> None:
        self.out.write_batch(batch)

    def close(self) -> None:
        self.out.close()
        self.to.close()


class ShardSink(DataSource):
    """Options: path, kind (parquet, npy or arrow), run (a name that is written once), notes (JSON that is committed with the shards)."""

    @classmethod
    def name(cls) -> str:
        return "shards"

    def schema(self) -> str:
        return "dataset string, shard long"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return ShardWriter(self.options["path"], self.options.get("kind", "parquet"), self.options.get("run") or uuid.uuid4().hex, self.options.get("notes") or "{}")


class ShardWriter(DataSourceArrowWriter):
    """Writes rows that come by (dataset, shard): a file for each, without the column shard."""

    def __init__(self, folder: str, kind: str, run: str, notes: str):
        if kind not in ("parquet", "npy", "arrow"):
            raise ValueError(f"unknown kind of shards {kind!r}")
        self.folder, self.kind, self.run, self.notes, self.own = folder, kind, run, json.loads(notes), f".part-{uuid.uuid4().hex}"

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        store, path = located(self.folder)
        store.create_dir(path, recursive=True)
        now, out, files, rows = None, None, [], 0

        def close() -> None:
            if out is not None:
                out.close()
                files.append((*now, files_at, rows, out.n))

        files_at = ""
        for batch in batches:
            if not batch.num_rows:
                continue
            names, shards = (batch.column(batch.schema.get_field_index(c)) for c in ("dataset", "shard"))
            codes = names.fill_null("").dictionary_encode().indices.to_numpy()
            moved = (np.diff(codes) != 0) | (np.diff(shards.fill_null(-1).to_numpy()) != 0)
            cuts = [0, *(np.flatnonzero(moved) + 1).tolist(), batch.num_rows]
            rest = batch.drop_columns(["shard"])
            for a, b in zip(cuts, cuts[1:]):
                key = (names[a].as_py(), shards[a].as_py())
                if not key[0] or "/" in key[0] or key[1] is None:
                    raise ValueError(f"no file can be named after dataset {key[0]!r}, shard {key[1]}")
                if key != now:
                    close()
                    now, rows = key, 0
                    files_at = f"{self.own}-{uuid.uuid4().hex}"
                    made = f"{path}/{files_at}"
                    out = _Npy(store, made) if self.kind == "npy" else (_Parquet if self.kind == "parquet" else _Arrow)(store, made, rest.schema)
                out.write(rest.slice(a, b - a))
                rows += int(b - a)
        close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        store, path = located(self.folder)
        store.create_dir(path, recursive=True)
        state = manifest(self.folder)
        files = sorted(f for m in messages if m is not None for f in m.files)
        if len({f[:2] for f in files}) != len(files):
            self._clean()
            raise ValueError("the rows of a shard came to several tasks")
        if self.run not in state["runs"]:
            ending = f".{self.kind}"
            following: dict[str, int] = {}
            for s in state["shards"]:
                following[s["dataset"]] = max(following.get(s["dataset"], 0), s["index"] + 1)
            moves, shards = {}, []
            for dataset, _, old, rows, tokens in files:
                index = following[dataset] = following.get(dataset, 0)
                following[dataset] += 1
                name = shard_file(dataset, index, ending)
                moves[name] = old
                shards.append({"dataset": dataset, "index": index, "name": name, "rows": rows, "tokens": tokens})
            put_json(store, f"{path}/{COMMIT}", {"run": self.run, "moves": moves, "shards": shards, "notes": self.notes})
            manifest(self.folder)
        self._clean()

    def abort(self, messages: list[Written | None]) -> None:
        self._clean()

    def _clean(self) -> None:
        """Remove hidden files of this write, those of lost attempts too."""
        store, path = located(self.folder)
        for f in files_in(store, path, deep=False):
            if posixpath.basename(f.path).startswith(self.own):
                store.delete_file(f.path)


def write_shards(rows: DataFrame, folder: str, kind: str = "parquet", run: str | None = None, order: str | None = None, notes: dict | None = None, tokens: Column | None = None) -> None:
    """Write rows (dataset, shard and more) as shards named after their dataset and numbered on from those already there.

    Datasets have names, without slashes. A shard's rows come to one task, in the order of a column, and stream into its file. kind npy: tokens end to end.
    tokens: an expression of the rows that is written as `tokens`; it is made behind the shuffle, which moves what it is made of.
    """
    rows.sparkSession.dataSource.register(ShardSink)
    dealt = rows.withColumn("shard", F.col("shard").cast("long")).repartition("dataset", "shard").sortWithinPartitions("dataset", "shard", *([order] if order else []))
    dealt = dealt if tokens is None else dealt.select("dataset", "shard", tokens.alias("tokens"))
    out = dealt.write.format("shards").mode("append").option("path", folder).option("kind", kind).option("notes", json.dumps(notes or {}))
    conf = rows.sparkSession.conf
    before = conf.get(_TIDY, None)
    conf.set(_TIDY, "true")
    try:
        (out.option("run", run) if run else out).save()
    finally:
        conf.unset(_TIDY) if before is None else conf.set(_TIDY, before)


def counted(rows: DataFrame, accepted: str, tokens: str, datasets: list[str]) -> tuple[DataFrame, Observation]:
    """The accepted rows, and counts that are taken while they are written: documents, tokens and skipped of each dataset."""
    seen = Observation()
    ok = F.coalesce(F.col(accepted), F.lit(False))
    metrics = []
    for k, name in enumerate(datasets):
        here = F.col("dataset") == name
        metrics += [F.count(F.when(here & ok, 1)).alias(f"docs_{k}"), F.coalesce(F.sum(F.when(here & ok, F.col(tokens))), F.lit(0)).alias(f"tokens_{k}"), F.count(F.when(here & ~ok, 1)).alias(f"skipped_{k}")]
    return rows.observe(seen, *metrics).where(ok), seen


def counts(seen: Observation, datasets: list[str]) -> list[tuple[str, int, int, int]]:
    """dataset, docs, tokens, skipped of a write that has ended; zeros where Spark saw beforehand that there are no rows."""
    assert seen._jo is not None
    if not seen._jo.getRow().length():
        return [(name, 0, 0, 0) for name in datasets]
    got = seen.get
    return [(name, got[f"docs_{k}"], got[f"tokens_{k}"], got[f"skipped_{k}"]) for k, name in enumerate(datasets)]
