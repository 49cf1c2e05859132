"""The sampling order against its definition: files, row groups, rows, buffers, whole files."""

import csv
import hashlib
import json
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from loomlake.operators import order


def seeded(items, mode, *parts):
    items = list(items)
    if mode == "shuffled":
        digest = hashlib.sha256("::".join(map(str, parts)).encode()).digest()
        random.Random(int.from_bytes(digest[:4], "big")).shuffle(items)
    return items


def definition(folder, files, name, sampling):
    """The rows of files in the order in which a single reader would sample them."""
    seed, size = sampling.get("seed", 42), sampling.get("json_shuffle_buffer", 4096)
    groups, rows = sampling.get("row_group_order", "shuffled"), sampling.get("row_order", "shuffled")
    out = []

    def buffered(items, salt, path):
        for k in range(0, len(items), size):
            out.extend(seeded(items[k : k + size], rows, seed, name, path, f"{salt}:{k // size}"))

    for path in files:
        at, ending = folder / path, path.rsplit(".")[-1]
        if ending == "parquet":
            f = pq.ParquetFile(at)
            for g in seeded(range(f.metadata.num_row_groups), groups, seed, name, path, "row-groups"):
                out += seeded(f.read_row_group(g)["id"].to_pylist(), rows, seed, name, path, f"rows:{g}")
        elif ending in ("csv", "tsv"):
            with open(at, newline="") as f:
                buffered([int(r["id"]) for r in csv.DictReader(f, delimiter="," if ending == "csv" else "\t")], "csv", path)
        elif ending == "arrow":
            with pa.ipc.open_file(str(at)) as f:
                out += seeded(f.read_all()["id"].to_pylist(), rows, seed, name, path, "arrow-rows")
        elif at.read_text().startswith("["):
            out += seeded([r["id"] for r in json.loads(at.read_text())], rows, seed, name, path, "json")
        else:
            buffered([json.loads(line)["id"] for line in at.read_text().splitlines() if line.strip()], ending, path)
    return out


@pytest.fixture(scope="module")
def mirror(tmp_path_factory):
    folder = tmp_path_factory.mktemp("mirror")
    ids = iter(range(10_000))
    take = lambda n: [next(ids) for _ in range(n)]
    (folder / "part one").mkdir()
    pq.write_table(pa.table({"id": take(103), "extra": ["x"] * 103}), folder / "part one" / "a.parquet", row_group_size=20)
    pq.write_table(pa.table({"id": take(7)}), folder / "b.parquet", row_group_size=100)
    (folder / "c.jsonl").write_text("".join(json.dumps({"id": k}) + "\n" + "\n" * (k % 2) for k in take(57)))
    (folder / "d.json").write_text("\n".join(json.dumps({"id": k}) for k in take(23)))
    (folder / "e.json").write_text(json.dumps([{"id": k} for k in take(31)]))
    (folder / "f.csv").write_text("id,t\n" + "".join(f'{k},"a\nb"\n' for k in take(29)))
    (folder / "g.tsv").write_text("t\tid\n" + "".join(f"x\t{k}\n" for k in take(12)))
    (folder / "h.csv").write_text("t,id\n" + "".join(f"y,{k}\n" for k in take(5)))
    table = pa.table({"id": take(44)})
    with pa.ipc.new_file(str(folder / "i.arrow"), table.schema) as f:
        f.write_table(table, max_chunksize=9)
    return folder


FILES = ["h.csv", "part one/a.parquet", "e.json", "i.arrow", "c.jsonl", "b.parquet", "g.tsv", "d.json", "f.csv"]


@pytest.mark.parametrize("sampling", [{}, {"seed": 7, "json_shuffle_buffer": 10}, {"row_order": "sorted", "json_shuffle_buffer": 10}, {"row_group_order": "sorted"}])
def test_places_are_those_of_the_definition(spark, mirror, sampling):
    usual = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "400")
    try:
        rows = order.placed_rows(spark, str(mirror), FILES, "books", sampling).select("id", "place").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", usual)
    assert sorted(r.place for r in rows) == list(range(311))
    assert [int(r.id) for r in sorted(rows, key=lambda r: r.place)] == definition(mirror, FILES, "books", sampling)


def test_unknown_modes_raise(spark, mirror):
    for key in ("row_order", "row_group_order"):
        with pytest.raises(ValueError, match=key):
            order.placed_rows(spark, str(mirror), FILES, "books", {key: "random"})


def test_files_have_one_order_whatever_the_listing():
    listing = [{"path": f"shelf/{k}.csv", "size": k} for k in (3, 1, 2, 9, 8, 7, 5)]
    once = order.ordered_files(listing, "books", "library/shelf", 5)
    assert once == order.ordered_files(sorted(listing, key=lambda f: -f["size"]), "books", "library/shelf", 5)
    names = sorted(f["path"] for f in listing)
    assert [f["path"] for f in once] == seeded(names, "shuffled", 5, "books", "library/shelf", "files") != names
    assert [f["path"] for f in order.ordered_files(listing, "books", "library/shelf", mode="sorted")] == names
    with pytest.raises(ValueError):
        order.ordered_files(listing, "books", "library/shelf", mode="reversed")
