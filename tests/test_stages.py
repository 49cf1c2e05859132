"""From row shards to token shards: both splits against loops, resuming, and files that are done."""

import numpy as np
import pytest

from loomlake.plans import recipe, stages
from loomlake.sources import sink


class Codes:
    eos_token_id, pad_token_id = 7, None

    def encode(self, text):
        return [ord(c) for c in text]

    def __len__(self):
        return 70_000


def rows(spark, first):
    texts = [("b", k // 5, k, "" if k % 7 == 0 else "x" * (k * 5 % 23) + str(first)) for k in range(23)] + [("a-b", 0, k, f"{k}é") for k in range(3)]
    return texts, spark.createDataFrame(texts, "dataset string, shard long, place long, text string")


def loops(texts, size, split):
    out = []
    for name in ("a-b", "b"):
        kept = [(s, [*map(ord, t), 7]) for d, s, _, t in texts if d == name and t]
        if split == "by_file":
            for s in sorted({s for s, _ in kept}):
                flat = sum((i for shard, i in kept if shard == s), [])
                out += [flat[k : k + size] for k in range(0, len(flat), size)]
        else:
            held = []
            for _, ids in kept:
                held += ids
                if len(held) >= size:
                    out.append(held)
                    held = []
            out += [held] if held else []
    return out


@pytest.mark.parametrize("split", ["across_files", "by_file"])
def test_stage_two(spark, tmp_path, split):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    texts, df = rows(spark, 1)
    sink.write_shards(df, raw, order="place")
    counts = stages.tokenize(spark, raw, out, Codes(), 40, split)
    assert counts == {d: (sum(bool(t) for x, _, _, t in texts if x == d), sum(len(t) + 1 for x, _, _, t in texts if x == d and t)) for d in ("a-b", "b")}
    read = lambda: [np.load(f).tolist() for f in sorted((tmp_path / "out").glob("*.npy"))]
    first = loops(texts, 40, split)
    assert read() == first
    assert stages.tokenize(spark, raw, out, Codes(), 40, split) == {} and read() == first
    more, df = rows(spark, 2)
    sink.write_shards(df, raw, order="place")
    stages.tokenize(spark, raw, out, Codes(), 40, split)
    found = {s["name"]: np.load(tmp_path / "out" / s["name"]).tolist() for s in sink.manifest(out)["shards"]}
    second = loops(more, 40, split)
    assert sorted(found.values()) == sorted(first + second) and len({s["index"] for s in sink.manifest(out)["shards"] if s["dataset"] == "b"}) == len([n for n in found if n.startswith("b-")])
    note = sink.manifest(out)["notes"]["b"]
    assert len(note["processed"]) == 10 and note["docs"] == 2 * counts["b"][0]
    with pytest.raises(ValueError):
        stages.tokenize(spark, raw, out, Codes(), 40, "odd")


def test_trial_recipes_take_two_shards():
    trial = recipe.verifying({"datasets": [{"name": "a", "target_tokens": 10**12}]}, 30)
    assert [d.target for d in recipe.datasets(trial)] == [60]
