"""What a run remembers: processed files, published shards, checkpoints, free disk."""

from __future__ import annotations

import json
import re
import shutil
import time
from collections.abc import Callable, Iterable
from pathlib import Path
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomlake.sources.files import write_state


def not_done(work: DataFrame, done: DataFrame, key: str | list[str]) -> DataFrame:
    """The work that no earlier run has done: processed, tokenized or downloaded files, rows of any stable key."""
    return work.join(done, key, "left_anti")


def stable_id(path: str = "path", size: str = "size"):
    """Name and size of a file, which name it wherever it lies."""
    return F.concat_ws(":", F.regexp_extract(path, r"([^/]*)$", 1), F.col(size).cast("string"))


def not_packed(files: DataFrame, packed: DataFrame) -> DataFrame:
    """files (path, size) that no archive holds yet; packed: id of those that one does."""
    return not_done(files.withColumn("id", stable_id()), packed.select("id"), "id").drop("id")


def removable(local: DataFrame, remote: DataFrame, key: str = "name") -> DataFrame:
    """Local shards that are published already, which a run may delete."""
    return local.join(remote, key, "left_semi")


class Publisher(Protocol):
    """Where finished shards go."""

    def put(self, path: str) -> None: ...


class FolderPublisher:
    """Copies shards into a folder."""

    def __init__(self, folder: str):
        self.folder = Path(folder)
        self.folder.mkdir(parents=True, exist_ok=True)

    def put(self, path: str) -> None:
        part = self.folder / f".{Path(path).name}.part"
        shutil.copyfile(path, part)
        part.replace(self.folder / Path(path).name)


class Batches:
    """Collects shards and publishes them, `size` at a time; waits longer after each refusal; deletes what has arrived."""

    def __init__(self, to: Publisher, size: int = 50, tries: int = 20, base: float = 60.0, keep: bool = False, wait: Callable[[float], None] = time.sleep):
        self.to, self.size, self.tries, self.base, self.keep, self.wait = to, size, tries, base, keep, wait
        self.held: list[str] = []

    def add(self, path: str) -> None:
        self.held.append(path)
        if len(self.held) >= self.size:
            self.flush()

    def flush(self) -> None:
        for path in list(self.held):
            for k in range(self.tries):
                try:
                    self.to.put(path)
                    break
                except ConnectionError:
                    if k + 1 == self.tries:
                        raise
                    self.wait(min(self.base + 60 * k, 1800))
            self.held.remove(path)
            if not self.keep:
                Path(path).unlink()


def mirror(source: str, target: str) -> list[str]:
    """Copy the files of a folder that the target does not have in their size; their names."""
    to, new = FolderPublisher(target), []
    for f in sorted(Path(source).iterdir()):
        there = to.folder / f.name
        if f.is_file() and not (there.exists() and there.stat().st_size == f.stat().st_size):
            to.put(str(f))
            new.append(f.name)
    return new


def last_checkpoint(folder: str, needs: Iterable[str] = ()) -> str | None:
    """The checkpoint folder with the largest step, as a number, that has all the files it needs; None without one."""
    found = []
    for f in Path(folder).iterdir() if Path(folder).is_dir() else ():
        step = re.fullmatch(r"checkpoint-(\d+)", f.name)
        if step and f.is_dir() and all((f / n).exists() for n in needs):
            found.append((int(step[1]), str(f)))
    return max(found)[1] if found else None


def publish_checkpoint(folder: str, target: str, state: str, needs: Iterable[str] = ()) -> str | None:
    """Copy the newest complete checkpoint once: its name, or None if it was copied before. For a trigger or a loop."""
    found = last_checkpoint(folder, needs)
    done = json.loads(Path(state).read_text())["published"] if Path(state).exists() else None
    if found is None or Path(found).name == done:
        return None
    part, there = Path(target) / f".{Path(found).name}.part", Path(target) / Path(found).name
    shutil.rmtree(part, ignore_errors=True)
    shutil.copytree(found, part)
    shutil.rmtree(there, ignore_errors=True)
    part.rename(there)
    write_state({"published": Path(found).name}, state)
    return Path(found).name


def enough_disk(folder: str, incoming: int, cache: int = 0, least_free_gb: float = 80, most_cache_gb: float = 60) -> None:
    """Raise before a download that would leave too little free disk or fill the cache; gigabytes are decimal."""
    free = shutil.disk_usage(folder).free
    if free - incoming < least_free_gb * 1e9:
        raise OSError(f"{incoming} bytes would leave less than {least_free_gb} GB free")
    if cache + incoming > most_cache_gb * 1e9:
        raise OSError(f"{incoming} bytes would make the cache larger than {most_cache_gb} GB")


def restarted(run: Callable[[], None], attempts: int = 100, pause: float = 30.0, wait: Callable[[float], None] = time.sleep) -> int:
    """Run until it ends without an error; how many attempts that took."""
    for k in range(1, attempts + 1):
        try:
            run()
            return k
        except Exception:  # whatever stopped it, the next attempt resumes from what is committed
            if k == attempts:
                raise
            wait(pause)
    return attempts
