"""Recipes: which datasets a run reads, how it filters and samples them, and how much of each it takes."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomlake.functions.text import extracted, token_estimate
from loomlake.operators import chat, filters, sequence
from loomlake.operators.order import ordered_files, placed_rows
from loomlake.sources import sink
from loomlake.sources.files import data_files, listed, row_count, write_jsonl
from loomlake.sources.shards import SHARD_TOKENS

#: Other names of a dataset's settings.
ALIASES = {"source": "hf_path", "subset": "config", "text_field": "text_column"}


@dataclass(frozen=True)
class Dataset:
    """A dataset of a recipe with all defaults resolved."""

    name: str
    path: str | None = None
    config: str | None = None
    split: str = "train"
    text: tuple[str, ...] = ()
    join: bool = False
    text_fn: str | None = None
    filter: str | None = None
    filters: Mapping[str, Any] = field(default_factory=dict)
    sampling: Mapping[str, Any] = field(default_factory=dict)
    target: int = 0
    add_eos: bool = True
    min_doc_length: int = 50


def load(path: str) -> dict[str, Any]:
    """A recipe file, as YAML or JSON."""
    with open(path, encoding="utf-8") as f:
        if path.endswith(".json"):
            return json.load(f)
        import yaml

        return yaml.safe_load(f)


def resolved(entry: Mapping[str, Any], recipe: Mapping[str, Any], scale: float = 1.0) -> Dataset:
    """One dataset: aliases by their names, its own sampling over the recipe's, inline filters over the named ones."""
    own = dict(entry)
    for other, name in ALIASES.items():
        if own.get(other) is not None:
            own.setdefault(name, own[other])
    settings = filters.merged(own.get("filters") or {}, recipe.get("filters") or {}, own.get("filter"))
    columns = own.get("text_columns") or own.get("text_column") or ()
    return Dataset(
        name=own["name"], path=own.get("hf_path"), config=own.get("config"), split=own.get("split", "train"),
        text=(columns,) if isinstance(columns, str) else tuple(columns), join=bool(own.get("join_text_columns")), text_fn=own.get("text_fn"),
        filter=own.get("filter"), filters=settings, sampling={**(recipe.get("sampling") or {}), **(own.get("sampling") or {})},
        target=int(own.get("target_tokens", 0) * scale), add_eos=bool(own.get("add_eos", settings.get("add_eos", True))), min_doc_length=int(own.get("min_doc_length", 50)),
    )


def datasets(recipe: Mapping[str, Any], only: str | Iterable[str] | None = None, scale: float = 1.0) -> list[Dataset]:
    """The enabled datasets, of those named only (a list, or names between commas), with targets scaled."""
    wanted = {x.strip() for x in (only.split(",") if isinstance(only, str) else only)} if only else None
    found = [resolved(d, recipe, scale) for d in recipe["datasets"] if d.get("enabled", True) is not False]
    return [d for d in found if wanted is None or d.name in wanted]


def plan(spark: SparkSession, chosen: list[Dataset]) -> DataFrame:
    """name, target, shards, bytes of each dataset and, with is_total, of all: what a run would write."""
    rows = spark.createDataFrame([(d.name, d.target) for d in chosen], "name string, target long")
    rows = rows.withColumn("shards", F.expr(f"target div {SHARD_TOKENS}")).withColumn("bytes", F.col("target") * 4)
    return rows.rollup("name").agg(*[F.sum(c).alias(c) for c in ("target", "shards", "bytes")], F.grouping("name").cast("int").alias("is_total"))


def judged(rows: DataFrame, dataset: Dataset, named: Mapping[str, Any] | None = None, mode: str = "two_stage") -> DataFrame:
    """dataset, text, tokens (estimated), accepted (by the dataset's filters) and rows' columns."""
    if dataset.filter and dataset.filter not in filters.REGISTRY and dataset.filter not in (named or {}):
        raise ValueError(f"unknown filter {dataset.filter!r}")
    text = extracted(rows.columns, list(dataset.text), dataset.join, dataset.text_fn)
    registered = dataset.filter if dataset.filter in filters.REGISTRY else None
    ok = filters.accepted(dataset.filters, text, rows.columns, registered, None, mode, dataset.min_doc_length)
    others = [c for c in rows.columns if c not in ("dataset", "text", "tokens", "accepted")]
    return rows.select(F.lit(dataset.name).alias("dataset"), text.alias("text"), token_estimate(text).alias("tokens"), ok.alias("accepted"), *others)


def documents(rows: DataFrame, dataset: Dataset, named: Mapping[str, Any] | None = None, mode: str = "two_stage") -> DataFrame:
    """dataset, text, tokens (estimated) and rows' columns, of the rows that the dataset's filters accept."""
    return judged(rows, dataset, named, mode).where("accepted").drop("accepted")


def scanned(spark: SparkSession, dataset: Dataset, root: str) -> DataFrame:
    """All rows of a dataset's mirror below root with `place`, their number in the sampling order that its settings name."""
    base = f"{root.rstrip('/')}/{dataset.path}"
    found = data_files(listed(spark, base), dataset.config, dataset.split)
    if not found:
        raise FileNotFoundError(base)
    sampling = dataset.sampling
    files = ordered_files(found, dataset.name, dataset.path or "", int(sampling.get("seed", 42)), sampling.get("file_order", "shuffled"))
    return placed_rows(spark, base, [f["path"] for f in files], dataset.name, sampling)


def reached(spark: SparkSession, recipe: Mapping[str, Any], root: str, only: str | None = None, scale: float = 1.0, mode: str = "two_stage", done: Mapping[str, int] | None = None) -> DataFrame:
    """dataset, text, tokens, accepted, place of all rows that a run reads before each dataset's target is met.

    done: tokens that datasets have already; their targets are that much smaller.
    """
    parts = []
    for d in datasets(recipe, only, scale):
        rows = judged(scanned(spark, d, root), d, recipe.get("filters"), mode).select("dataset", "text", "tokens", "accepted", "place")
        rows = rows.withColumn("__n", F.when(F.col("accepted"), F.col("tokens")).otherwise(F.lit(0)))
        parts.append(sequence.budgeted(rows, "__n", "place", "place", d.target - (done or {}).get(d.name, 0)).drop("__n"))
    if not parts:
        raise ValueError("no dataset of the recipe is chosen")
    return reduce(DataFrame.unionByName, parts)


def run(spark: SparkSession, recipe: Mapping[str, Any], root: str, only: str | None = None, scale: float = 1.0, mode: str = "two_stage", dry: bool = False) -> DataFrame:
    """dataset, text, tokens, place of all datasets of a recipe, read from mirrors below root, in the sampling order by place.

    dry: only docs, tokens and skipped, the rows that filters rejected on the way, of each dataset.
    """
    rows = reached(spark, recipe, root, only, scale, mode)
    if not dry:
        return rows.where("accepted").drop("accepted")
    ok = F.col("accepted")
    return rows.groupBy("dataset").agg(F.count(F.when(ok, 1)).alias("docs"), F.coalesce(F.sum(F.when(ok, F.col("tokens"))), F.lit(0)).alias("tokens"), F.count(F.when(~ok, 1)).alias("skipped"))


def verifying(recipe: Mapping[str, Any], shard_tokens: int = SHARD_TOKENS) -> dict[str, Any]:
    """The recipe of a trial run: two shards of each dataset."""
    return {**recipe, "datasets": [{**d, "target_tokens": 2 * shard_tokens} for d in recipe["datasets"]]}


def write(spark: SparkSession, recipe: Mapping[str, Any], root: str, folder: str, shard_tokens: int, run_name: str, only: str | None = None, scale: float = 1.0, mode: str = "two_stage") -> list[tuple[str, int, int, int]]:
    """Write the documents of a recipe as row shards that close when they reach shard_tokens; dataset, docs, tokens, skipped.

    The counts are taken while rows are written: those of documents are the manifest's, those of skipped rows are observed, and may
    count a task twice that a lost executor made Spark repeat. What the folder's manifest has already counts towards the targets, and a run of
    a name that it has adds nothing.
    """
    names = [d.name for d in datasets(recipe, only, scale)]
    state = sink.manifest(folder)
    if run_name in state["runs"]:
        return [(name, 0, 0, 0) for name in names]
    done = {name: sum(s["tokens"] for s in state["shards"] if s["dataset"] == name) for name in names}
    rows, seen = sink.counted(reached(spark, recipe, root, only, scale, mode, done), "accepted", "tokens", names)
    narrow = reached(spark, recipe, root, only, scale, mode, done).where("accepted").select("dataset", "place", "tokens")
    cut = sequence.cut_by(narrow, "dataset", "place", "tokens", shard_tokens)
    sink.write_shards(rows.drop("accepted").join(cut.select("dataset", "place", "shard"), ["dataset", "place"]), folder, run=run_name, order="place")
    skipped = {name: n for name, _, _, n in sink.counts(seen, names)}
    new = [s for s in sink.manifest(folder)["shards"] if s not in state["shards"]]
    return [(name, *(sum(s[c] for s in new if s["dataset"] == name) for c in ("rows", "tokens")), skipped[name]) for name in names]


def conversations(spark: SparkSession, entry: Mapping[str, Any], root: str) -> DataFrame:
    """messages, source, key, place of the valid conversations of an entry: converted, filtered, in a seeded order by key, place."""
    d = resolved(entry, {})
    rows = scanned(spark, replace(d, sampling={"file_order": "sorted", "row_order": "sorted", "row_group_order": "sorted"}), root)
    found = rows.withColumn("messages", chat.converted(rows, entry.get("format", "messages"), entry)).where("messages IS NOT NULL")
    limits = entry.get("filters") or {}
    most = limits.get("max_chars")
    found = found.where(chat.passes(F.col("messages"), int(limits.get("min_chars") or 0), None if most is None else int(most), int(limits.get("min_assistant_chars") or 0)))
    key = sequence.seeded_key(F.lit(str(entry.get("seed", 42))), F.lit(d.name), F.col("place").cast("string")) if entry.get("shuffle", True) else F.col("place")
    return found.select("messages", F.lit(d.name).alias("source"), key.alias("key"), "place")


def write_conversations(spark: SparkSession, recipe: Mapping[str, Any], root: str, folder: str, only: str | None = None, fresh: bool = False) -> dict[str, int]:
    """Write the conversations of a recipe as JSON lines, a folder `{name}.jsonl` for each dataset; the new rows of each.

    A dataset goes on after the rows that its folder has, in the same order, up to its target_samples (0: all); fresh: anew.
    """
    wanted = {x.strip() for x in only.split(",")} if only else None
    written = {}
    for entry in recipe["datasets"]:
        if entry.get("enabled", True) is False or (wanted and entry["name"] not in wanted):
            continue
        path = f"{folder.rstrip('/')}/{entry['name']}.jsonl"
        existing = 0 if fresh or not listed(spark, path) else row_count(spark, path)
        target = int(entry.get("target_samples") or 0)
        if target and existing >= target:
            written[entry["name"]] = 0
            continue
        rows = conversations(spark, entry, root).withColumn("__one", F.lit(1))
        placed = sequence.running_before(rows, "__one", "key", "place", "__at", below=target or None, even=bool(entry.get("shuffle", True)))
        new = placed.where(F.col("__at") >= existing)
        new = new.where(F.col("__at") < target) if target else new
        # observed above the sort, whose sampling would count rows twice
        ordered = new.orderBy("__at").select("messages", "source", F.col("source").alias("dataset"), F.lit(True).alias("ok"), F.lit(0).alias("n"))
        kept, seen = sink.counted(ordered, "ok", "n", [entry["name"]])
        write_jsonl(kept.select("messages", "source"), path, append=not fresh)
        written[entry["name"]] = sink.counts(seen, [entry["name"]])[0][1]
    return written
