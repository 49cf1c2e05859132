"""Quality rules against plain loops, with the hashes that Spark uses, and the verdict on clean and broken texts."""

import math
import random
import re
import struct
from collections import Counter

import pytest
import xxhash

from loomlake.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def signed(n):
    return n - (1 << 64) if n >> 63 else n


def word_hash(w):
    return signed(xxhash.xxh64_intdigest(w.encode(), seed=42))


def pair_hash(hashes):
    seed = 42
    for h in hashes:
        seed = xxhash.xxh64_intdigest(struct.pack("<q", h), seed=seed)
    return signed(seed)


def plain_base(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), again, len(covered)


def grams(text, buckets):
    hashes = [word_hash(w) for w in WORD.findall(text or "")]
    return [h % buckets for h in hashes] + [pair_hash(hashes[i : i + 2]) % buckets for i in range(len(hashes) - 1)]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    words = [f"wörd{k}" for k in range(60)]
    make = lambda n, of=words: " ".join(rng.choice(of) for _ in range(n))
    out = [None, "", " \n\t", "a", "one two three four five", " x y\x0bz\r\n", "a b c d e a b c d e", "w " * 4000]
    line = make(9)
    out += [f"{line}\n{make(12)}\n{line}\n\n \n{line} \n{line}", make(3000) + " 😀" * 3, " ".join(w + "##" for w in make(200).split())]
    out += [make(rng.randrange(5, 120)) for _ in range(60)] + [make(80, ["bad!!", "worse!!", "###"]) for _ in range(6)]
    return list(enumerate(out)) + [(5, out[9]), (None, out[9]), (20, out[20])]


@pytest.mark.parametrize("n", [1, 2])
def test_figures_and_verdicts(spark, texts, n):
    schema = "doc_id long, text string, n_words string, score int, bucket int, gain int"
    docs = spark.createDataFrame([(i, t, "x", 1, 2, 3) for i, t in texts], schema).repartition(4)
    good = set(range(11, 60))
    labels = spark.createDataFrame([(k, 1) for k in good] * 2 + [(1, 0), (None, 1), (61, None)], "doc_id long, quality int")
    buckets = 512
    raw, trusted = Counter(), Counter()
    per = [g if n == 2 else g[: (len(g) + 1) // 2] for g in (grams(t, buckets) for _, t in texts)]
    for (i, _), g in zip(texts, per, strict=True):
        raw.update(g)
        if i in good:
            trusted.update(g)
    S, T, a = raw.total(), trusted.total(), quality.SMOOTHING
    gain = [math.floor(1e6 * math.log((trusted[b] + a) * (S + a * buckets) / ((raw[b] + a) * (T + a * buckets)))) for b in range(buckets)]
    want = []
    for (i, t), g in zip(texts, per, strict=True):
        figures = plain_base(t)
        score = sum(gain[b] for b in g) / len(g) / 1e6 if g else 0.0
        failed = figures[0] < 10 or 100 * figures[4] > 20 * figures[0]
        want.append((str(i), *figures, failed, not failed and score >= quality.THRESHOLD, round(score, 9)))
    got = quality.judged(docs, labels, n=n, buckets=buckets).collect()
    mine = [(str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept, round(r.score, 9)) for r in got]
    key = lambda r: tuple(map(str, r))
    assert sorted(mine, key=key) == sorted(want, key=key)
    assert not any(r.kept for r in got if r.doc_id in range(71, 77))


def test_empty_tables_and_no_trusted_rows(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k l")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.judged(docs.limit(0), none).count() == 0
    row = quality.judged(docs, none).first()
    assert row.kept and row.score == 0


def test_trusted_sample_is_bounded(spark):
    labels = spark.createDataFrame([(k, 1) for k in range(50)], "doc_id long, quality int")
    first = [r.doc_id for r in quality.trusted_ids(labels, 7).collect()]
    assert len(first) == 7 and sorted(first) == sorted(r.doc_id for r in quality.trusted_ids(labels.repartition(5), 7).collect())
