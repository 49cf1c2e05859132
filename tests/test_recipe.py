"""Recipes from mirrors to shards and conversation files, by the sampling order, with counts, targets and resuming."""

import json

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from loomlake.operators import chat, order
from loomlake.plans import recipe
from loomlake.sources import files, shards, sink

GARDEN = {
    "sampling": {"seed": 31, "json_shuffle_buffer": 8},
    "filters": {"tall": {"min_chars": 12, "max_length": 400}},
    "datasets": [
        {"name": "roses", "source": "shelf/roses", "subset": "red", "text_field": "petal", "target_tokens": 260, "filter": "tall"},
        {"name": "ferns", "source": "shelf/ferns", "text_columns": ["leaf", "stem"], "target_tokens": 290, "filters": {"max_chars": 60, "add_eos": False}, "sampling": {"row_order": "sorted", "file_order": "sorted"}},
        {"name": "weeds", "source": "shelf/weeds", "target_tokens": 7, "enabled": False},
    ],
}


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    root = tmp_path_factory.mktemp("garden")
    for name in ("roses/red", "roses/white", "ferns"):
        (root / "shelf" / name).mkdir(parents=True)
    for k in range(4):
        lines = [json.dumps({"petal": f"rose {k} {i} " + "p" * (i * 7 % 40)}) for i in range(30)]
        (root / "shelf" / "roses" / "red" / f"train-{k}.jsonl").write_text("\n".join(lines))
    (root / "shelf" / "roses" / "red" / "test.jsonl").write_text('{"petal": "never read"}')
    (root / "shelf" / "roses" / "white" / "train.jsonl").write_text('{"petal": "never read either"}')
    for k in range(2):
        (root / "shelf" / "ferns" / f"{k}.csv").write_text("stem,leaf\n" + "".join(f"stem {k} {i},{'leaf ' * (i % 20)}\n" for i in range(40)))
    return root


def in_order(root, d):
    """Texts, whether they pass, and tokens in the sampling order, by plain loops over the mirror."""
    from tests.test_order import seeded

    sampling = d.sampling
    base = root / d.path
    paths = [f.relative_to(base).as_posix() for f in sorted(base.rglob("*.*"))]
    paths = [p for p in paths if not d.config or (p.startswith(d.config + "/") and "train" in p)]
    for path in seeded(paths, sampling.get("file_order", "shuffled"), sampling["seed"], d.name, d.path, "files"):
        if path.endswith("csv"):
            rows = [(lambda stem, leaf: leaf or stem)(*line.split(",")) for line in (base / path).read_text().splitlines()[1:]]
            kind = "csv"
        else:
            rows, kind = [json.loads(line)["petal"] for line in (base / path).read_text().splitlines()], "jsonl"
        for k in range(0, len(rows), 8):
            for text in seeded(rows[k : k + 8], sampling.get("row_order", "shuffled"), sampling["seed"], d.name, path, f"{kind}:{k // 8}"):
                ok = text != "" and (12 <= len(text) <= 400 if d.name == "roses" else len(text) <= 60)
                yield text, ok, int(max(1, len(text) / 3.2)) if text else 0


def expected(root, d):
    taken, skipped, total = [], 0, 0
    for text, ok, n in in_order(root, d):
        if total >= d.target:
            break
        if ok:
            taken.append(text)
            total += n
        else:
            skipped += 1
    return taken, total, skipped


def test_settings_are_resolved():
    roses, ferns = recipe.datasets(GARDEN, scale=0.5)
    assert (roses.path, roses.config, roses.text, roses.target, roses.add_eos) == ("shelf/roses", "red", ("petal",), 130, True)
    assert roses.filters == {"min_length": 12, "max_length": 400} and roses.sampling == GARDEN["sampling"]
    assert ferns.sampling == {"seed": 31, "json_shuffle_buffer": 8, "row_order": "sorted", "file_order": "sorted"} and ferns.add_eos is False and ferns.filters["max_length"] == 60
    assert [d.name for d in recipe.datasets(GARDEN, "ferns, weeds")] == ["ferns"] and recipe.datasets(GARDEN, ["weeds"]) == []


def test_runs_take_documents_in_the_sampling_order(spark, root):
    rows = recipe.run(spark, GARDEN, str(root)).orderBy("dataset", "place").collect()
    counts = {r.dataset: (r.docs, r.tokens, r.skipped) for r in recipe.run(spark, GARDEN, str(root), dry=True).collect()}
    for d in recipe.datasets(GARDEN):
        taken, total, skipped = expected(root, d)
        assert [r.text for r in rows if r.dataset == d.name] == taken and len(taken) > 5
        assert counts[d.name] == (len(taken), total, skipped)
    assert counts["ferns"][2] > 0


def test_shards_and_counts_of_one_pass(spark, root, tmp_path):
    counts = recipe.write(spark, GARDEN, str(root), str(tmp_path), 50, "first")
    for d, (name, docs, tokens, skipped) in zip(recipe.datasets(GARDEN), counts, strict=True):
        taken, total, passed_over = expected(root, d)
        assert (name, docs, tokens, skipped) == (d.name, len(taken), total, passed_over)
        found = [pq.read_table(f) for f in sorted((tmp_path / name).glob("*.parquet"))]
        assert sum((t["text"].to_pylist() for t in found), []) == taken
        # every shard but the last reaches its size, and would not without its last row
        for t in found[:-1]:
            n = t["tokens"].to_pylist()
            assert sum(n) >= 50 > sum(n[:-1])
    before = sink.manifest(str(tmp_path))
    assert recipe.write(spark, GARDEN, str(root), str(tmp_path), 50, "first") == [("roses", 0, 0, 0), ("ferns", 0, 0, 0)]
    assert recipe.write(spark, GARDEN, str(root), str(tmp_path), 50, "second")[0][1] == 0 and sink.manifest(str(tmp_path))["shards"] == before["shards"]


def test_unknown_filters_and_missing_mirrors_raise(spark, root):
    wrong = {"datasets": [GARDEN["datasets"][0] | {"filter": "small"}]}
    with pytest.raises(ValueError, match="small"):
        recipe.run(spark, wrong, str(root))
    with pytest.raises(FileNotFoundError):
        recipe.run(spark, {"datasets": [{"name": "x", "source": "nowhere", "target_tokens": 1}]}, str(root))
    with pytest.raises(ValueError):
        recipe.run(spark, GARDEN, str(root), only="none of them")


def test_recipe_files(tmp_path):
    (tmp_path / "r.yaml").write_text("datasets:\n- {name: moss, target_tokens: 11}\n")
    (tmp_path / "r.json").write_text('{"datasets": [{"name": "moss", "target_tokens": 11}]}')
    assert [recipe.datasets(recipe.load(str(tmp_path / f)))[0].target for f in ("r.yaml", "r.json")] == [11, 11]


def test_listing(spark, tmp_path):
    names = ["en/validation.csv", "en/valid-2.csv", "en/9.parquet", "notes.md", "fr/valid.json", "fr/other.json"]
    found = [{"path": p, "size": 1} for p in names]
    chosen = lambda *a: [f["path"] for f in files.data_files(found, *a)]
    assert chosen("en", "valid") == ["en/9.parquet", "en/valid-2.csv"]
    assert chosen("r", "valid") == ["en/9.parquet", "fr/valid.json"] and chosen("fr", "train") == ["fr/other.json", "fr/valid.json"]
    (tmp_path / "deep" / "er").mkdir(parents=True)
    (tmp_path / "deep" / "er" / "x.tsv").write_text("12345")
    assert files.listed(spark, str(tmp_path)) == [{"path": "deep/er/x.tsv", "size": 5}] and shards.folder_bytes(spark, str(tmp_path)) == (5, 5)
    assert files.listed(spark, str(tmp_path / "none")) == []


TALKS = {
    "datasets": [
        {"name": "tea", "source": "tea", "format": "prompt_response", "prompt_field": "ask", "response_field": "say", "target_samples": 12, "seed": 8, "filters": {"min_chars": 9, "min_assistant_chars": 3}},
        {"name": "cups", "source": "cups", "format": "chosen_messages", "chosen_field": "best", "shuffle": False},
    ]
}


def test_conversations_from_recipe_to_file(spark, tmp_path):
    for name in ("tea", "cups"):
        (tmp_path / name).mkdir()
    (tmp_path / "tea" / "train.jsonl").write_text("\n".join(json.dumps({"ask": f"why {k}?", "say": "x" * (k % 6)}) for k in range(50)))
    talk = lambda k: [{"role": "user", "content": f" q{k} "}, {"role": "assistant" if k % 3 else "robot", "content": "a"}]
    (tmp_path / "cups" / "train.jsonl").write_text("\n".join(json.dumps({"best": talk(k)}) for k in range(9)))
    out = str(tmp_path / "out")
    assert recipe.write_conversations(spark, TALKS, str(tmp_path), out, only="tea") == {"tea": 12}
    first = [json.dumps(r.asDict(True), sort_keys=True) for r in spark.read.json(f"{out}/tea.jsonl").collect()]
    larger = {"datasets": [TALKS["datasets"][0] | {"target_samples": 20}, TALKS["datasets"][1]]}
    assert recipe.write_conversations(spark, larger, str(tmp_path), out) == {"tea": 8, "cups": 6}
    assert recipe.write_conversations(spark, larger, str(tmp_path), out) == {"tea": 0, "cups": 0}
    every = [json.dumps(r.asDict(True), sort_keys=True) for r in spark.read.json(f"{out}/tea.jsonl").collect()]
    assert len(set(every)) == 20 and set(first) < set(every)
    assert recipe.write_conversations(spark, larger, str(tmp_path), str(tmp_path / "at once"), only="tea") == {"tea": 20}
    assert {json.dumps(r.asDict(True), sort_keys=True) for r in spark.read.json(str(tmp_path / "at once" / "tea.jsonl")).collect()} == set(every)
    records = files.conversation_records(spark, f"{out}/cups.jsonl").select("source", chat.normalised(F.col("messages")).alias("m")).collect()
    assert {(r.source, r.m[0].content) for r in records} == {("cups", f"q{k}") for k in range(9) if k % 3}
    assert recipe.write_conversations(spark, TALKS, str(tmp_path), out, only="tea", fresh=True) == {"tea": 12}
    assert order.BUFFER == 4096
