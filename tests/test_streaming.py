"""Increments against one run, and what runs remember."""

import numpy as np
import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomlake.operators.packing import Packing
from loomlake.sources import sink
from loomlake.streaming import packing, state


def stream_of(folder):
    found = sorted(folder.glob("*.npy"))
    return [int(t) for f in found for t in np.load(f)]


def test_increments_equal_one_run(spark, tmp_path):
    texts = [["abc", "", "de"], ["f" * 23, "g"], ["hijk", None, "lmnopq" * 9, "r"]]
    codes = lambda df: df.withColumn("tokens", F.transform(F.split(F.coalesce("text", F.lit("")), ""), lambda c: F.ascii(c)))
    flat = [ord(c) for part in texts for t in part for c in (t or "")]
    flat_empty = []
    for part in texts:
        for t in part:
            flat_empty += [ord(c) for c in t] if t else [0]  # the split of an empty text has one empty part
    step = lambda: packing.pack_new(spark, str(tmp_path / "in"), "text string", codes, str(tmp_path / "out"), "book", 10, str(tmp_path / "check"), 2)
    for k, part in enumerate(texts):
        spark.createDataFrame([(t,) for t in part], "text string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        step()
        step()  # nothing new
        note = sink.manifest(str(tmp_path / "out"))["notes"]["book"]
        so_far = sum(len(t) if t else 1 for p in texts[: k + 1] for t in p)
        assert note["next"] == so_far // 10 and len(note["rest"]) == so_far % 10
    got = stream_of(tmp_path / "out")
    assert got == flat_empty[: len(got)] and got + note["rest"] == flat_empty and len(flat) < len(flat_empty)
    shards = sink.manifest(str(tmp_path / "out"))["shards"]
    assert [s["index"] for s in shards] == list(range(len(shards))) and all(s["tokens"] in (10, 20) for s in shards)


def test_increments_that_make_tokens_where_they_pack(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(DataFrame, "persist", lambda *_: pytest.fail("a batch was held"))
    made = F.transform(F.split("text", ""), lambda c: F.ascii(c))
    step = lambda: packing.pack_new(spark, str(tmp_path / "in 1"), "text string, x int", made, str(tmp_path / "out"), "book", 10, str(tmp_path / "check"), 2, files=2, n=F.length("text"))
    (tmp_path / "in 1").mkdir()
    every = []
    for k in range(2):
        for name in ("a b%20", "c{d}", "e"):
            texts = [f"{k}{name}{j}" * (j + 1) for j in range(7)]
            one = tmp_path / f"{k}{name}"
            spark.createDataFrame([(t, k) for t in texts], "text string, x int").coalesce(1).write.parquet(str(one))
            next(one.glob("part*.parquet")).rename(tmp_path / "in 1" / f"{k}{name}.parquet")
            every += texts
        step()
        step()  # nothing new
    got, note = stream_of(tmp_path / "out"), sink.manifest(str(tmp_path / "out"))["notes"]["book"]
    rest = got + note["rest"]
    assert len(rest) == sum(map(len, every)) and note["next"] == len(rest) // 10
    # batches are the stream's; the rows of a file stay together and in order
    flat = "".join(map(chr, rest))
    assert all("".join(every[k : k + 7]) in flat for k in range(0, len(every), 7))
    assert [s["tokens"] for s in sink.manifest(str(tmp_path / "out"))["shards"]].count(20) > 10


def test_a_repeated_batch_adds_nothing(spark, tmp_path):
    docs = spark.createDataFrame([(1, [1, 2, 3]), (2, [4, 5])], "place long, tokens array<int>")
    for run in ("a", "a", "b", "a"):
        packing.pack_batch(docs, str(tmp_path), "d", 2, 1, run)
    assert stream_of(tmp_path) == [1, 2, 3, 4, 5, 1, 2, 3, 4, 5]
    packing.pack_batch(docs.limit(0), str(tmp_path), "d", 2, 1, "c")
    assert sink.manifest(str(tmp_path))["runs"] == ["a", "b", "c"]


def test_rest_of_a_stream(spark):
    docs = spark.createDataFrame([(k, [k] * 3) for k in range(9)], "doc_id long, ids array<int>")
    assert Packing(docs, 5).rest() == [8, 8] and Packing(docs, 27).rest() == [] and Packing(docs, 100).rest() == sorted([*range(9)] * 3)


def test_checkpoints(tmp_path):
    for step in (7, 40, 300):
        (tmp_path / f"checkpoint-{step}").mkdir()
        (tmp_path / f"checkpoint-{step}" / "weights").write_text(str(step))
    (tmp_path / "checkpoint-best").mkdir()
    (tmp_path / "checkpoint-300" / "weights").unlink()
    assert state.last_checkpoint(str(tmp_path)).endswith("-300") and state.last_checkpoint(str(tmp_path), ["weights"]).endswith("-40")
    publish = lambda: state.publish_checkpoint(str(tmp_path), str(tmp_path / "to"), str(tmp_path / "published.json"), ["weights"])
    assert publish() == "checkpoint-40" and publish() is None
    (tmp_path / "checkpoint-400").mkdir()
    (tmp_path / "checkpoint-400" / "weights").write_text("x")
    assert publish() == "checkpoint-400" and (tmp_path / "to" / "checkpoint-400" / "weights").read_text() == "x"
    # a name that begins another one's is published by itself
    for f in tmp_path.glob("checkpoint-4*"):
        (f / "weights").unlink()
    (tmp_path / "checkpoint-4").mkdir()
    (tmp_path / "checkpoint-7" / "weights").unlink()
    (tmp_path / "checkpoint-4" / "weights").write_text("y")
    assert publish() == "checkpoint-4" and not list((tmp_path / "to").glob(".*"))


def test_publishing_waits_and_gives_up(tmp_path):
    refusals, waits = [3], []

    class Moody(state.FolderPublisher):
        def put(self, path):
            if refusals[0]:
                refusals[0] -= 1
                raise ConnectionError
            super().put(path)

    (tmp_path / "a").write_text("1")
    patient = state.Batches(Moody(str(tmp_path / "there")), size=1, base=1700, wait=waits.append)
    patient.add(str(tmp_path / "a"))
    assert waits == [1700, 1760, 1800] and not (tmp_path / "a").exists() and state.mirror(str(tmp_path / "there"), str(tmp_path / "copy")) == ["a"]
    (tmp_path / "b").write_text("2")
    refusals[0] = 2
    with pytest.raises(ConnectionError):
        state.Batches(Moody(str(tmp_path / "there")), size=1, tries=2, wait=waits.append).add(str(tmp_path / "b"))
    assert (tmp_path / "b").exists()
