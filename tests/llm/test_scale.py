"""Findings of runs on larger tables: what is shuffled, what the driver holds, what is done twice."""

from __future__ import annotations

import json
import os
import random
import time

import numpy as np
import pytest
import public_tokenizers
from pyspark.sql import functions as F

from loomlake.llm import ann, bpe, line_dedup, toxicity
from loomlake.llm.common import Scratch


def test_line_dedup_shuffles_no_text_of_chunks(spark, monkeypatch):
    seen = []
    real = Scratch.stored
    monkeypatch.setattr(Scratch, "stored", lambda self, df, rows=None: (seen.append(df.columns), real(self, df, rows))[1])
    docs = spark.createDataFrame([(k, "one line\nanother line\nthe third of them") for k in range(3)], "doc_id long, text string")
    got = {r.doc_id: r.kept_text for r in line_dedup.digest(docs).collect()}
    assert got[0] == "one line\nanother line\nthe third of them" and len(got[1]) < len(got[0]) and got[1] == got[2]
    assert seen and not any("text" in columns for columns in seen)


def test_toxicity_is_fitted_in_a_task(spark, monkeypatch):
    docs = spark.createDataFrame([(k, f"text {k}") for k in range(40)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    monkeypatch.setattr(toxicity, "fit", lambda rows, s, prior=None: toxicity.Model(s, b"", b"", (float(os.getpid()), float(len(rows)), prior or -1.0)))
    where, many, prior = toxicity.learned(docs, labels).weights
    assert where != os.getpid() and 20 < many < 40 and 0.3 < prior < 0.7


@pytest.fixture(scope="module")
def tokenizer():
    return bpe.Tokenizer(open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read())


def test_bpe_splits_what_is_known_only_once(tokenizer, monkeypatch):
    text = "Words, more words;\nand don't they\tcome again? <|endoftext|>"
    first = list(tokenizer.round_trips([text]))

    def fail(_):
        raise AssertionError("normalized or split again")

    monkeypatch.setattr(tokenizer, "split", fail)
    again = list(tokenizer.round_trips([text, None, "more  words;"]))
    assert again[0][0].tolist() == first[0][0].tolist() and again[0][1] == first[0][1] == tokenizer.decode(first[0][0].tolist())
    assert len(again[1][0]) == 0 and again[1][1] == ""


def test_bpe_of_odd_texts_equals_the_library(tokenizer):
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_padding()
    library.no_truncation()
    signs = [*" \n\t\r\x0b\x1c\x1f\x85\xa0   　́̈ͅaeEΣςİ'1٣!.,é中가😀‍<|>Å¨\x00ﬁ", "é", "'s", "'ll", "<|startoftext|>", "<|endoftext|>"]
    draw = random.Random(5)
    texts = ["".join(draw.choices(signs, k=draw.randrange(15))) for _ in range(5000)]
    for text, (ids, decoded) in zip(texts, tokenizer.round_trips(texts), strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want and decoded == library.decode(want, skip_special_tokens=False), repr(text)


@pytest.mark.parametrize("at_once", [1, 40])
def test_bpe_memory_that_starts_anew(tokenizer, monkeypatch, at_once):
    texts = [f"word{k} {k} Müteß, again\nand again" for k in range(40)]
    want = [ids.tolist() for ids in tokenizer._encode_words(texts)]
    monkeypatch.setattr(bpe, "REMEMBERED", 12)
    for _ in range(2):
        assert [ids.tolist() for ids in tokenizer.encode_batch(texts, at_once)] == want
        assert [ids.tolist() for ids, _ in tokenizer.round_trips(texts)] == want
        for k in range(0, 40, 8):
            assert [ids.tolist() for ids in tokenizer.encode_batch(texts[k : k + 8])] == want[k : k + 8]


def test_bpe_keeps_what_is_met_often(tokenizer, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 12)
    learned = []
    real = tokenizer.index.merge

    def merge(words):
        words = list(words)
        learned.extend(map(tuple, words))
        return real(words)

    monkeypatch.setattr(tokenizer.index, "merge", merge)
    for k in range(40):
        text = f"Quixotic, zephyrs new{'x' * k}a new{'x' * k}b new{'x' * k}c"
        ((ids, decoded),) = tokenizer.round_trips([text])
        assert ids.tolist() == next(tokenizer._encode_words([text])).tolist() and decoded == tokenizer.decode(ids.tolist())
    often = tuple(tokenizer._symbols("zephyrs"))
    assert learned.count(often) == 1
    for memory in (tokenizer.between, tokenizer.memory):
        assert all(len(column) < 24 for column in (*memory.columns, *memory.older))


def test_bpe_memory_of_long_stretches_is_bounded(tokenizer, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED_CHARS", 1000)
    texts = [f"{k}-" * 100 for k in range(100)]
    want = [ids.tolist() for ids in tokenizer._encode_words(texts)]
    assert [ids.tolist() for k in range(100) for ids, _ in tokenizer.round_trips(texts[k : k + 1])] == want
    assert sum(map(len, [*tokenizer.between.columns[0], *tokenizer.between.older[0]])) < 4000


def test_bpe_added_token_inside_a_word_equals_the_library():
    described = json.loads(open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read())
    described["added_tokens"].append(described["added_tokens"][0] | {"id": 49408, "content": "qzxv"})
    described = json.dumps(described)
    library = pytest.importorskip("tokenizers").Tokenizer.from_str(described)
    texts = ["say qzxvo", "otqzxvlo qzxv Qzxv", "nothing of it"]
    got = [(ids.tolist(), decoded) for ids, decoded in bpe.Tokenizer(described).round_trips(texts)]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert got == [(ids, library.decode(ids, skip_special_tokens=False)) for ids in want]


def _asked(spark, data, asks, h):
    """The blocks of a single part that holds all rows and queries."""
    rows = [(k, [float(x) for x in v], k % asks == 0) for k, v in enumerate(data)]
    entries = spark.createDataFrame(rows, "entry long, embedding array<float>, asks boolean").coalesce(2)
    return ann._dealt(entries, h, 1, np.ones(1, np.int64)).toArrow().combine_chunks()


def test_candidates_cost_ten_full_products_at_most(spark):
    """Many queries that visit many buckets: CPU seconds of a task beside those of scoring every pair, both in one worker."""
    rng = np.random.default_rng(9)
    data = rng.normal(size=(20_000, 64)).astype(np.float32)
    data /= np.linalg.norm(data, axis=1, keepdims=True)
    held = spark.sparkContext.broadcast((data, _asked(spark, data, 20, ann.made(64, 1.0, 8, 8, 2.1, 96, 3))))

    def full(rows):
        scores = rows[::20].astype(np.float64) @ rows.T.astype(np.float64)
        return [np.argpartition(-s, 30)[:30] for s in scores]

    def seconds(work, given):
        spent = []
        for _ in range(3):
            start = time.process_time()
            work(given)
            spent.append(time.process_time() - start)
        return min(spent)

    def both(_):
        rows, group = held.value
        yield seconds(ann._probed(21), group), seconds(full, rows)

    probed, whole = spark.sparkContext.parallelize([0], 1).mapPartitions(both).first()
    assert probed < 10 * whole


def test_short_lists_are_the_best_of_all_candidates(spark, monkeypatch):
    """Equal scores and small bounds included: each list is what plain loops over the query's buckets find."""
    for name, small in (("_BLOCKS", 1), ("_SCORES", 64), ("_GATHERED", 1)):
        monkeypatch.setattr(ann, name, small)
    rng = np.random.default_rng(4)
    data = rng.integers(-1, 2, size=(700, 8)).astype(np.float32)
    data[:, 0] = 1
    h = ann.made(8, float(np.linalg.norm(data, axis=1).max()), 3, 4, 0.8, 12, 3)
    keys, places = h.keys(np.floor(h.places(data, False))), h.places(data[::5], True)
    probes = h.keys(np.floor(places)[:, :, None, :] + h.steps(places))
    want = {}
    for q in range(len(probes[0])):
        near = sorted((-float(data[5 * q] @ data[k]), k) for k in range(len(data)) if any(keys[t, k] in probes[t, q] for t in range(3)))
        if near:
            want[5 * q] = near[:6]
    got = {r["query"]: [(x["less"], x["id"]) for x in r["found"]] for r in ann._probed(6)(_asked(spark, data, 5, h)).to_pylist()}
    assert got == want
