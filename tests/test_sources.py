"""Binary sources, text with line numbers, mixed mirrors, and the sink that commits shards, names and manifest together."""

import json

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from loomlake.sources import binary, files, shards, sink


def test_arrow_files_are_read_by_batch(spark, tmp_path):
    for k in range(3):
        table = pa.table({"id": pa.array(range(k * 100, k * 100 + 90), pa.int64()), "name": [f"n{i}" for i in range(90)]})
        with pa.ipc.new_file(str(tmp_path / f"f{k}.arrow"), table.schema) as f:
            f.write_table(table, max_chunksize=20)
    (tmp_path / "_other.txt").write_text("x")
    df = binary.read_arrow(spark, str(tmp_path))
    assert df.rdd.getNumPartitions() == 15 and df.count() == 270
    assert sorted(r.id for r in df.select("id").collect()) == sorted(k * 100 + i for k in range(3) for i in range(90))
    assert binary.read_arrow(spark, f"file://{tmp_path}/f1.arrow").count() == 90
    assert binary.read_arrow(spark, [str(tmp_path / "f1.arrow")]).count() == 90
    assert binary.read_arrow(spark, [str(tmp_path / f"f{k}.arrow") for k in (0, 2)]).count() == 180
    with pytest.raises(Exception, match="no files of .arrow"):
        binary.read_arrow(spark, str(tmp_path / "none")).count()


def test_tokens_are_read_by_range(spark, tmp_path):
    rng = np.random.default_rng(1)
    parts = {"b.npy": rng.integers(0, 9, 1000, "<i4"), "a.bin": rng.integers(0, 9, 70, "<i4"), "c.npy": rng.integers(0, 9, 50, "<i8"), "d.npy": np.empty(0, "<i4")}
    for name, values in parts.items():
        values.tofile(tmp_path / name) if name.endswith("bin") else np.save(tmp_path / name, values)
    df = binary.read_tokens(spark, str(tmp_path), 300)
    got = df.orderBy("path", "start").collect()
    assert [(r.path.rsplit("/")[-1], r.start, len(r.tokens)) for r in got] == [("a.bin", 0, 70), ("b.npy", 0, 300), ("b.npy", 300, 300), ("b.npy", 600, 300), ("b.npy", 900, 100), ("c.npy", 0, 50)]
    assert sum((r.tokens for r in got), []) == [*parts["a.bin"], *parts["b.npy"], *parts["c.npy"]]
    assert sorted(n for _, n in binary.token_counts(str(tmp_path))) == [0, 50, 70, 1000]
    totals = {(r.dataset, r.is_total): (r.tokens, r.files) for r in shards.tokens_in(spark, str(tmp_path)).collect()}
    assert totals[(None, 1)] == (1120, 4) and totals[("a", 0)] == (70, 1)


def test_line_numbers_over_splits(spark, tmp_path):
    good = {"messages": [{"role": "user", "content": "u"}, {"role": "assistant", "content": "a"}]}
    ends = ["\n", "\r\n", "\n \n", "\n\n"]
    places, text, at = [], "", 1
    for k in range(400):
        text += json.dumps(good | {"source": f"s{k}" + "é" * (k % 50)}) + ends[k % 4]
        places.append((f"s{k}" + "é" * (k % 50), at))
        at += ends[k % 4].count("\n")
    (tmp_path / "big.jsonl").write_bytes(text.encode())
    (tmp_path / "small.jsonl").write_text(json.dumps(good))
    usual = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        got = files.conversation_records(spark, str(tmp_path))
        assert files.lines(spark, str(tmp_path)).rdd.getNumPartitions() > 1
        rows = {r.source: (r.file.rsplit("/")[-1], r.line) for r in got.collect()}
        assert rows == {s: ("big.jsonl", n) for s, n in places} | {"small.jsonl": ("small.jsonl", 1)}
        (tmp_path / "bad.jsonl").write_bytes((text + "{broken\n").encode())
        with pytest.raises(Exception, match=f"bad.jsonl:{at}"):
            files.conversation_records(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", usual)


def test_files_that_differ_are_read_together(spark, tmp_path):
    (tmp_path / "array.json").write_text(json.dumps([{"a": 1}, {"a": 2, "b": "x"}], indent=1))
    (tmp_path / "lines.json").write_text('{"a": 3}\n{"a": 4, "c": "y"}\n')
    got = files.read_rows(spark, str(tmp_path), "json")
    assert sorted((r.a, r.b, r.c) for r in got.collect()) == [(1, None, None), (2, "x", None), (3, None, None), (4, None, "y")]
    for k in range(12):
        (tmp_path / f"train-{k}.csv").write_text("a,b\n5,6\n" if k % 2 else "b,a\n6,5\n")
        pq.write_table(pa.table({"a": ["7"], f"p{k % 2}": [k]}), str(tmp_path / f"{k}.parquet"))
    rows = files.mirrored(spark, str(tmp_path), files=[*(f"train-{k}.csv" for k in range(12)), *(f"{k}.parquet" for k in range(12))])
    assert sorted(rows.columns) == ["a", "b", "p0", "p1"]
    assert rows.where("a = '5' AND b = '6'").count() == 12 and rows.where("a = '7'").count() == 12
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 3


def written(folder):
    return {p.relative_to(folder).as_posix() for p in folder.rglob("*") if p.is_file() and not p.name.endswith(".crc")}


def test_shards_have_exact_names_and_go_on(spark, tmp_path):
    rows = [("math", k // 4, k, f"t{k}", 2) for k in range(10)] + [("a-b", 7, 1, "x", 3)]
    df = spark.createDataFrame(rows, "dataset string, shard int, place int, text string, tokens long").repartition(5)
    for run in ("one", "one", "two"):
        sink.write_shards(df, str(tmp_path), run=run, order="place")
    names = {f"math/math-{k:05d}.parquet" for k in range(6)} | {f"a-b/a-b-{k:05d}.parquet" for k in range(2)}
    assert written(tmp_path) == names | {sink.MANIFEST}
    first = pq.read_table(tmp_path / "math" / "math-00001.parquet")
    assert first.column_names == ["dataset", "place", "text", "tokens"] and first["place"].to_pylist() == [4, 5, 6, 7]
    state = sink.manifest(str(tmp_path))
    assert state["runs"] == ["one", "two"] and sum(s["rows"] for s in state["shards"]) == 22 and sum(s["tokens"] for s in state["shards"] if s["dataset"] == "math") == 40


def test_token_shards_come_back(spark, tmp_path):
    df = spark.createDataFrame([("d", 0, 1, [1, 2]), ("d", 0, 2, [3]), ("d", 1, 3, [4, 5, 6]), ("d", 1, 4, [])], "dataset string, shard long, place int, tokens array<int>")
    sink.write_shards(df, f"file://{tmp_path}", "npy", order="place")
    assert written(tmp_path) == {"d-00000.npy", "d-00001.npy", sink.MANIFEST}
    assert np.load(tmp_path / "d-00000.npy").tolist() == [1, 2, 3] and np.load(tmp_path / "d-00001.npy").dtype == np.int32
    found = [f for f in files.listed(spark, str(tmp_path)) if not f["path"].startswith(("_", "."))]
    assert shards.next_index(found, "d") == 2
    assert [r.tokens for r in binary.read_tokens(spark, str(tmp_path)).orderBy("path").collect()] == [[1, 2, 3], [4, 5, 6]]


def test_a_failing_write_leaves_nothing(spark, tmp_path):
    df = spark.range(100).select(F.lit("d").alias("dataset"), F.col("id").alias("shard"), F.when(F.col("id") == 77, F.raise_error(F.lit("broken"))).otherwise(F.col("id").cast("string")).alias("text"))
    sink.write_shards(df.where("id < 3"), str(tmp_path))
    before = written(tmp_path)
    with pytest.raises(Exception, match="broken"):
        sink.write_shards(df, str(tmp_path))
    assert written(tmp_path) == before
    for name in (None, "", "a/b"):
        with pytest.raises(Exception, match="named after"):
            sink.write_shards(spark.range(1).select(F.lit(name).cast("string").alias("dataset"), F.col("id").alias("shard")), str(tmp_path))
    assert written(tmp_path) == before


def test_a_commit_is_carried_out_later(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / ".part-1").write_text("x")
    (tmp_path / "d" / "d-00000.npy").write_text("moved before the driver was lost")
    shard = {"dataset": "d", "rows": 1, "tokens": 0}
    commit = {"run": "r", "moves": {"d/d-00000.npy": ".part-0", "d/d-00001.npy": ".part-1"}, "shards": [shard | {"index": k, "name": f"d/d-{k:05d}.npy"} for k in (0, 1)], "notes": {"n": 1}}
    (tmp_path / sink.COMMIT).write_text(json.dumps(commit))
    for _ in range(2):
        state = sink.manifest(str(tmp_path))
        assert state["runs"] == ["r"] and len(state["shards"]) == 2
        assert written(tmp_path) == {"d/d-00000.npy", "d/d-00001.npy", sink.MANIFEST}


def test_counts_are_taken_while_writing(spark, tmp_path):
    rows = spark.createDataFrame([("a", True, 5), ("a", False, 7), ("b", None, 1), ("a", True, None), ("c", True, 2)], "dataset string, ok boolean, n long")
    kept, seen = sink.counted(rows, "ok", "n", ["a", "b"])
    kept.write.parquet(str(tmp_path / "out"))
    assert sink.counts(seen, ["a", "b"]) == [("a", 2, 5, 1), ("b", 0, 0, 1)]
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_small_ranges_of_tokens_share_a_task(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(binary, "TOKENS", 100)
    for k in range(5):
        np.save(tmp_path / f"s{k}.npy", np.arange(k * 50, k * 50 + 50, dtype="<i4"))
    reader = binary._TokenReader(str(tmp_path), 30)
    tasks = reader.partitions()
    assert [[(p.start, p.count) for p in t.parts] for t in tasks] == [[(0, 30), (30, 20)] * 2] * 2 + [[(0, 30), (30, 20)]]
    assert [x for t in tasks for b in reader.read(t) for x in b.column(2)[0].as_py()] == [*range(250)]
