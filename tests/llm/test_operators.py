"""The training-data operators against brute force on small tables with nulls, empty and repeated rows and hot groups."""

import hashlib
import random
import re

import pytest

from loomlake.llm import bpe, fingerprint, jaccard, line_dedup, suffix_dedup, warc
from loomlake.llm.queries import vocabulary_path

SCHEMA = "doc_id long, text string, gid long, extra string"


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    words = [f"w{k}" for k in range(300)]
    make = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage = make(70)
    out = [None, "", " \n", "one two", "One two", make(200), "aé" * 300, "x" * 900]
    base = make(120)
    for _ in range(12):
        edited = base.split()
        edited[rng.randrange(len(edited))] = rng.choice(words)
        out.append(" ".join(edited))
    out += [base] * 5 + [make(30) + "\n" + passage + "\n" + make(20) for _ in range(6)]
    return list(enumerate(out)) + [(5, out[5]), (None, out[5])]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame([(i, t, 1, "z") for i, t in texts], SCHEMA).repartition(3)


def test_jaccard_components(docs, texts):
    word = re.compile(r"[^\x20\x09-\x0D]+")
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = []
    for _, t in texts:
        w = word.findall((t or "").translate(low))
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    label = list(range(len(sets)))
    for _ in sets:
        for a, x in enumerate(sets):
            for b, y in enumerate(sets):
                if x and y and 100 * len(x & y) >= 75 * len(x | y):
                    label[a] = label[b] = min(label[a], label[b])
    want = []
    for k, (i, _) in enumerate(texts):
        ids = [texts[j][0] for j in range(len(texts)) if label[j] == label[k] and texts[j][0] is not None]
        want.append((str(i), len(sets[k]), min(ids)))
    got = [(str(r.doc_id), r.n_shingles, r.component_id) for r in jaccard.clustered(docs).collect()]
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize("case", ["plain", "small blocks and shards", "frequent strings"])
def test_suffix_dedup(docs, texts, case, monkeypatch):
    for name, value in {"small blocks and shards": {"SHARD_BYTES": 500}, "frequent strings": {"FREQUENT": 3, "FREQUENT_SHARE": 1e-9}}.get(case, {}).items():
        monkeypatch.setattr(suffix_dedup, name, value)
    block = 300 if case == "small blocks and shards" else suffix_dedup.BLOCK
    data = [(t or "").encode() for _, t in texts]
    counts = {}
    for d in data:
        for k in range(len(d) - 199):
            counts[d[k : k + 200]] = counts.get(d[k : k + 200], 0) + 1
    want = []
    for (i, _), d in zip(texts, data):
        gone = bytearray(len(d))
        for k in range(len(d) - 199):
            if counts[d[k : k + 200]] > 1:
                gone[k : k + 200] = b"\1" * 200
        rest = bytes(c for c, g in zip(d, gone) if not g)
        want.append((str(i), len(d), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(rest).hexdigest()))
    got = [(str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.digests(docs, block=block).collect()]
    assert sorted(got) == sorted(want)


def test_suffix_arrays():
    rng = random.Random(1)
    for _ in range(300):
        letters = rng.choice([1, 2, 3, 26])
        texts = [bytes(rng.randrange(97, 97 + letters) for _ in range(rng.randrange(1, rng.choice([3, 10, 60])))) for _ in range(rng.randrange(1, 6))]
        texts += texts[:2] * rng.randrange(2)
        s, order = suffix_dedup.suffix_array(texts)
        borders = [i for i, c in enumerate(s) if c == 0]
        plain = [borders.index(i) if c == 0 else int(c) + 1000 for i, c in enumerate(s)]
        assert order.tolist() == sorted(range(len(plain)), key=lambda i: plain[i:])
        for width in (1, 3, 7):
            counts = {}
            for t in texts:
                for i in range(len(t) - width + 1):
                    counts[t[i : i + width]] = counts.get(t[i : i + width], 0) + 1
            want = [[counts[t[i : i + width]] > 1 for i in range(max(0, len(t) - width + 1))] for t in texts]
            assert [h.tolist() for h in suffix_dedup.repeated_starts(texts, width)] == want


def test_line_dedup_keeps_first_and_clean_documents(docs, texts):
    got = {r.doc_id: r for r in line_dedup.digest(docs).collect()}
    assert got[0].kept_text is None and got[3].kept_text == "one two"
    pasted = [r for i, r in got.items() if i is not None and i >= 25]
    assert sum(r.n_removed_chunks > 0 for r in pasted) == 5  # all but the first
    assert [r.n_removed_lines for r in pasted if r.doc_id == 25] == [0]


def test_fingerprints(docs):
    rows = fingerprint.edited(docs).collect()
    by = {}
    for r in rows:
        assert len(r.fingerprint) == 2 * 2**fingerprint.BIN_BITS and 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        by.setdefault(r.doc_id, r)
    assert by[20].fingerprint == by[24].fingerprint and set(by[1].fingerprint) == {"0"}


def test_bpe_equals_the_library(docs, texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary_path())
    t.no_padding()
    t.no_truncation()
    want = sorted((str(i), hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in t.encode(s or "", add_special_tokens=False).ids)).hexdigest()) for i, s in texts)
    assert sorted((str(r.doc_id), r.ids_sha256) for r in bpe.round_trip(docs, vocabulary_path()).collect()) == want


def test_fingerprints_against_plain_texts(docs, texts):
    word = re.compile(r"[^\x20\x09-\x0D]+")

    def shingles(t):
        w = word.findall(t)
        return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()

    unique = {i: t or "" for i, t in texts if i is not None and i != 5}
    rows = fingerprint.edited(docs.where("doc_id <> 5")).collect()
    assert len(rows) == len(unique)
    ids = sorted(unique, reverse=True)
    for r in rows:
        here, after = unique[r.doc_id], unique[ids[(ids.index(r.doc_id) + 1) % len(ids)]]
        cut = len(here) // 3
        edited = here[: len(here) - cut] + after[:cut]
        assert r.n_chars == len(here) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        for other, near in ((edited, r.near_edited), (after, r.near_next)):
            a, b = shingles(here), shingles(other)
            if a and b:
                assert abs(near - len(a & b) / len(a | b)) < 0.25
    every = fingerprint.edited(docs).collect()
    assert len(every) == len(texts)  # repeated and null ids too


def test_url_filters(spark):
    from datetime import date

    from loomlake.llm import url_filters

    day = date(2024, 1, 10)
    entries = [("a.com", "block", date(2024, 1, 5)), ("x.a.com.", "allow", date(2024, 1, 5)), ("x.a.com", "block", date(2024, 1, 11)), ("3.4", "block", date(2024, 1, 1)), ("[::1]", "block", date(2024, 1, 1)), ("b.com", "allow", day), ("b.com", "block", day), (None, "block", day), ("c.com", "block", None)]
    urls = ["http://a.com/", "http://u@X.A.com:80/p", "http://y.a.com./", "http://10.0.3.4/", "http://[::1]:8/", "http://b.com", "http://c.com", "nothing", None, "http://a.com/"]
    pages = spark.createDataFrame([(k, u, day, "e") for k, u in enumerate(urls)] + [(99, "http://a.com/", None, "e"), (98, "http://a.com/", date(2024, 1, 4), "e")], "page_id long, url string, fetched date, decision string")
    lists = spark.createDataFrame(entries, "pattern string, action string, listed date")
    got = {r.page_id: r.decision for r in url_filters.filter_urls(pages, lists).collect()}
    assert [got[k] for k in range(10)] == ["block", "allow", "block", "none", "block", "block", "none", "none", "none", "block"]
    assert got[99] == got[98] == "none"
    assert url_filters.filter_urls(pages.limit(0), lists).collect() == []


def test_bpe_round_trip_and_clashing_columns(docs, texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary_path())
    t.no_padding()
    t.no_truncation()
    want = sorted((str(i), hashlib.sha256(t.decode(t.encode(s or "", add_special_tokens=False).ids, skip_special_tokens=False).encode()).hexdigest()) for i, s in texts)
    assert sorted((str(r.doc_id), r.decoded_sha256) for r in bpe.round_trip(docs, vocabulary_path()).collect()) == want
    clash = docs.withColumnsRenamed({"gid": "ids", "extra": "gone"})
    rows = bpe.tokenized(clash, vocabulary_path())
    assert rows.columns == [*clash.columns, "_ids"] and rows.select("ids", "_ids").count() == len(texts)
    assert line_dedup.without_repeats(clash).columns == clash.columns and line_dedup.without_repeats(clash).count() == len(texts)
    assert bpe.tokenized(clash.limit(0), vocabulary_path()).collect() == []


def test_mixing_of_hard_tables(spark):
    from loomlake.llm import mixing

    rows = [(None, "a b c", "s"), (None, "a b c", "s"), (1, "x y", None), (1, "x y", None), (2, None, "t"), (3, "", "t"), (4, "w " * 50, "t"), (5, "v " * 9, "u")]
    docs = spark.createDataFrame([(i, t, s, 1, "z") for i, t, s in rows], "doc_id long, text string, source string, slice int, row string")
    plan = mixing.taken(docs.repartition(3)).collect()
    mix = mixing.mixed(docs.repartition(3))
    words = lambda t: len((t or "").split())
    assert len(plan) == len(rows) and all(r.taken <= 2 * r.size for r in plan)
    got = [words(r.text) for r in mix.collect()]
    assert sum(r.taken for r in plan) == sum(got) == int(sum({r.source_size: r.target for r in plan}.values()) + 0.5)
    assert mix.columns == docs.columns and 0 not in got
    again = sorted((str(r.doc_id), r.size, r.taken) for r in mixing.taken(docs.repartition(5)).collect())
    assert again == sorted((str(r.doc_id), r.size, r.taken) for r in plan)
    assert mixing.taken(docs.limit(0)).collect() == [] and mixing.mixed(docs.limit(0)).collect() == []


def test_warc_links(spark):
    pages = spark.createDataFrame([(1, "http://a.b/", "<title>T</title><p>x &amp; y</p>"), (2, None, None), (3, "http://a/\r\nWARC-Type: x", "y")], "page_id long, url string, html string")
    rows = warc.built(pages).collect()
    assert len(rows) == 6 and {r.block for r in rows if r.kind == "conversion"} == {"T\nx & y", "", "y"}
    for r in rows:
        ((headers, block),) = warc.parsed((r.headers + r.block + "\r\n\r\n").encode())
        assert headers["WARC-Refers-To"] == r.refers_to and block.decode() == r.block


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    for run in (jaccard.clustered, suffix_dedup.digests, line_dedup.digest, fingerprint.edited):
        assert run(none).collect() == []
