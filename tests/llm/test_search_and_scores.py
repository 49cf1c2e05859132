"""Nearest neighbours against brute force and toxicity scores by held-out accuracy."""

import random
import zlib

import numpy as np
import pytest

from loomlake.llm import ann, toxicity


def brute(vectors, neighbours=20, every=20):
    known = {i: np.array(v, np.float32).astype(np.float64) for i, v in vectors}
    out = {}
    for i, v in known.items():
        if i % every == 0:
            scores = sorted((-(v * w).sum(), j) for j, w in known.items() if j != i)
            out[i] = [(j, -s) for s, j in scores[:neighbours]]
    return out


@pytest.mark.parametrize("kind", ["clustered", "copies", "few"])
def test_nearest(spark, kind):
    rng = np.random.default_rng(5)
    if kind == "few":
        data = rng.normal(size=(12, 4))
    else:
        centres = rng.normal(size=(8, 16))
        data = centres[rng.integers(0, 8, 900)] + 0.3 * rng.normal(size=(900, 16))
    if kind == "copies":
        data[::3] = data[0]
    rows = [(k, [float(np.float32(x)) for x in v]) for k, v in enumerate(data)]
    odd = [(2000, None), (2020, []), (2040, [0.0] * len(data[0])), (2060, [float("nan")] * len(data[0])), (2080, [None] * len(data[0])), (2100, [1.0] * (len(data[0]) + 1))]
    table = spark.createDataFrame([(i, v, 1, "x") for i, v in rows + odd + rows[:3]], "vec_id long, embedding array<float>, label int, extra string")
    got = {}
    for r in ann.nearest(table.repartition(3)).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r)
    want = brute(rows)
    assert got.keys() == want.keys()
    hits = total = 0
    for q, best in want.items():
        found = got[q]
        assert [r["rank"] for r in found] == list(range(1, len(best) + 1))
        assert [(-r["score"], r["vec_id"]) for r in found] == sorted((-r["score"], r["vec_id"]) for r in found)
        hits += len({j for j, _ in best} & {r["vec_id"] for r in found})
        total += len(best)
        for r in found:
            exact = float(np.dot(np.array(rows[q][1]), np.array(rows[r["vec_id"]][1])))
            assert r["score"] == pytest.approx(exact, abs=1e-9)
    assert hits >= 0.9 * total


def test_nearest_of_nothing(spark):
    assert ann.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


@pytest.fixture(scope="module")
def marked():
    """(doc_id, text, label) rows: toxic ones hold some invented insults between ordinary words."""
    rng = random.Random(8)
    usual = ["".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randrange(3, 9))) for _ in range(500)]
    insults = ["zwixhead", "grumfool", "vyrkscum", "jaxblight", "qoodlout"]
    out = []
    for k in range(600):
        words = [rng.choice(usual) for _ in range(rng.randrange(30, 300))]
        toxic = k % 4 == 0
        if toxic:
            for _ in range(6):
                words.insert(rng.randrange(len(words)), rng.choice(insults))
        out.append((k, " ".join(words), int(toxic)))
    return out


def test_toxicity_held_out(spark, marked):
    docs = spark.createDataFrame([(i, t, "s") for i, t, _ in marked] + [(9000, None, None), (9001, "", "s"), (None, marked[0][1], "s")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in marked] + [(None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    rows = {r.doc_id: r for r in toxicity.toxicity(docs.repartition(3), labels).collect()}
    assert len(rows) == len(marked) + 3
    right = [rows[i].predicted == y for i, _, y in marked if rows[i].held_out]
    assert len(right) > 80 and sum(right) >= 0.95 * len(right)
    for i, r in rows.items():
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (i is not None and zlib.crc32(str(i).encode()) % 5 == 0)
    assert rows[9000].score == rows[9001].score < 0.5
    assert rows[None].score == rows[0].score


def test_toxicity_without_labels(spark, marked):
    docs = spark.createDataFrame([(i, t) for i, t, _ in marked[:9]], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in toxicity.toxicity(docs, none).collect()} == {0.0}
    assert toxicity.toxicity(docs.limit(0), none).collect() == []


def test_toxicity_of_a_rare_language():
    rng = random.Random(3)
    tongues = [["".join(rng.choice(letters) for _ in range(rng.randrange(3, 9))) for _ in range(400)] for letters in ("abcdefghilm", "noprstuvwyz")]
    insults = [["zwixhead", "grumfool"], ["kkaqqul", "jjibqqox"]]

    def text(tongue, toxic):
        words = [rng.choice(tongues[tongue]) for _ in range(rng.randrange(30, 300))]
        for _ in range(6 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(insults[tongue]))
        return " ".join(words)

    # one toxic text in eight is in the second language
    model = toxicity.fit([(text(int(k % 32 < 4), int(k % 4 == 0)).encode(), int(k % 4 == 0)) for k in rng.sample(range(1600), 1600)])
    assert all(w.encode() in model.toxic for both in insults for w in both)
    score = model.scorer()
    for tongue in (0, 1):
        assert sum(score(text(tongue, 1)) >= 0.5 for _ in range(50)) >= 45
        assert sum(score(text(tongue, 0)) >= 0.5 for _ in range(50)) <= 5


def test_toxicity_learns_from_whole_texts(spark, marked):
    late = [(i, "plain words here " * 600 * y + t, y) for i, t, y in marked[:200]]
    docs = spark.createDataFrame([(i, t) for i, t, _ in late], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in late], "doc_id long, toxic int")
    assert b"zwixhead" in toxicity.learned(docs, labels).toxic
