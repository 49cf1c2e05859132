"""Importance resampling against plain loops: checksums, gains, noise and ranks, on tables with nulls, ties and repeated rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from loomlake.llm import importance

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def grams(text, n, buckets):
    w = words_of(text)
    return [zlib.crc32(" ".join(w[i : i + k]).encode()) % buckets for k in range(1, n + 1) for i in range(len(w) - k + 1)]


def plain(rows, target, n, buckets, percent=10):
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(grams(text, n, buckets))
    for text in target:
        t.update(grams(text, n, buckets))
    S, T = s.total(), t.total()
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in range(buckets)]
    out = []
    for i, text in rows:
        g = grams(text, n, buckets)
        weight = sum(gain[b] for b in g) // len(g) if g else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words_of(text)) >= 20])
    fit = sorted((r for r in out if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, r in enumerate(fit[: percent * len(fit) // 100]):
        r[4] = place + 1
    return [tuple(map(str, r[:5])) for r in out]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    make = lambda n, k=400: " ".join(rng.choice(("Wört", "w", "Ǆ")) + str(rng.randrange(k)) for _ in range(n))
    texts = [None, "", " \n", "a-b_c", "É\x00é", make(19), make(20), make(20000), "x" * 50_000] + [make(rng.randrange(10, 90)) for _ in range(150)]
    return [*enumerate(texts), *[(7, texts[7])] * 2, (None, texts[20]), (None, texts[20]), *[(9000, texts[30])] * 40]


@pytest.mark.parametrize("n,buckets,chunk", [(1, 10_000, 4 << 20), (3, 300, 5000)])
def test_scores_and_ranks(spark, rows, n, buckets, chunk, monkeypatch):
    monkeypatch.setattr(importance, "CHUNK_BYTES", chunk)
    target = [t for _, t in rows[9:40]] + [None, ""]
    schema = "doc_id long, text string, n_words string, counts int, rank int, score string"
    docs = spark.createDataFrame([(i, t, "x", 1, 2, "y") for i, t in rows], schema).repartition(5)
    benchmark = spark.createDataFrame([(t,) for t in target], "text string")
    got = [tuple(map(str, r)) for r in importance.resampled(docs, benchmark, n=n, buckets=buckets, percent=40).collect()]
    assert sorted(got) == sorted(plain(rows, target, n, buckets, 40))


def test_sample_returns_drawn_rows(spark, rows):
    unique = [(i, t) for i, t in enumerate(t for _, t in rows)]
    docs = spark.createDataFrame([(i, t, i * 2, "r") for i, t in unique], "doc_id long, text string, twice long, rank string")
    benchmark = docs.where("doc_id < 20").select("text")
    got = {str(r.doc_id): str(r["rank"]) for r in importance.sample(docs, benchmark).collect()}
    assert got == {r[0]: r[4] for r in plain(unique, [t for i, t in unique if i < 20], 1, 10_000) if r[4] != "None"}


def test_empty_tables(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    none = docs.limit(0)
    assert importance.resampled(none, docs).count() == 0
    got = [tuple(map(str, r)) for r in importance.resampled(docs, none).collect()]
    assert sorted(got) == sorted(plain(rows, [], 1, 10_000))
    assert importance.resampled(docs.where("doc_id < 3"), docs).where("rank IS NOT NULL").count() == 0
