"""Periodic runs against a brute-force search, and the query against its contract word for word."""

import hashlib
import random
import re
import zlib

import pytest

from loomlake.llm import runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words, least=24, times=3):
    """All runs: for each period the maximal stretches, of which those stay whose period is the smallest one."""
    n, found = len(words), {}
    for q in range(1, n // times + 1):
        start = 0
        while start + q < n:
            end = start
            while end + q < n and words[end] == words[end + q]:
                end += 1
            if end + q - start >= max(least, times * q):
                found.setdefault((start, end + q - start), q)
            start = end + 1
    return sorted((s, m, q) for (s, m), q in found.items())


def cases():
    rng = random.Random(11)
    yield from ([], [1] * 23, [1] * 24, [1, 2] * 12, [1] * 100, [1, 2, 3] * 8 + [1], [*range(8)] * 3, [*range(8)] * 2 + [*range(7)])
    fib = [[0], [0, 1]]
    while len(fib[-1]) < 300:
        fib.append(fib[-1] + fib[-2])
    yield fib[-1] * 3
    for _ in range(300):
        out = []
        while len(out) < rng.randrange(30, 250):
            root = [rng.randrange(rng.choice((2, 3, 50))) for _ in range(rng.choice((1, 2, 3, 5, 8, 9, 13, 16, 31)))]
            out += (root * 9)[: rng.randrange(1, len(root) * 6 + 1)]
        yield out


def test_lyndon_scan_finds_all_runs():
    for word in cases():
        assert runs.lyndon_runs(word) == brute(word), word
        assert runs.lyndon_runs(word, 4, 4) == brute(word, 4, 4), word


def test_equal_hashes_of_different_words_change_nothing(monkeypatch):
    monkeypatch.setattr(runs, "SPREAD", 0)
    for word in list(cases())[:60]:
        assert runs.lyndon_runs(word) == brute(word), word


def plain(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute(words)
    drop = {i for s, m, q in found for i in range(s + q, s + m)}
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2])) if found else (None, None, None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (str(doc_id), len(found), *best, 1000 * best[1] // best[2] if found else None,
            sha("".join(f"{s},{m},{q}\n" for s, m, q in found)), sha(" ".join(w for i, w in enumerate(words) if i not in drop)))


@pytest.mark.parametrize("size", [4 << 20, 2000])
def test_query(spark, size, monkeypatch):
    monkeypatch.setattr(runs, "CHUNK_BYTES", size)
    rng = random.Random(2)
    make = lambda n: " ".join(f"é{rng.randrange(300)}" for _ in range(n))
    texts = [None, "", " \n\t ", "a", "a " * 40, "x\x0by\r" * 30 + " z", make(40) + " b c d" * 20 + "\n" + make(30) + " e" * 24, make(3000)]
    loop = make(31)
    texts += [" ".join([make(9), loop, loop, loop, make(9), loop, loop, make(5), loop]), (make(700) + " ") * 3]
    texts += [make(rng.randrange(1, 400)) for _ in range(110)]
    rows = [*enumerate(texts), (9, texts[9]), (None, texts[9]), (None, texts[4])]
    docs = spark.createDataFrame([(i, t, 1, "old") for i, t in rows], "doc_id long, text string, n_runs int, runs string").repartition(3)
    got = runs.digest(runs.with_loops(docs)).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted([(str(r.doc_id), *r[1:]) for r in got], key=key) == sorted([plain(i, t) for i, t in rows], key=key)
    assert runs.collapsed(docs).columns == ["doc_id", "text", "n_runs", "runs", "collapsed"]


def test_empty_table_and_few_periods(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert runs.digest(docs).count() == 0
    with pytest.raises(ValueError):
        runs.collapsed(docs, times=2)
