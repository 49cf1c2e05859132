"""Long texts, repeated rows and extra columns; line dedup and WARC records against plain loops."""

import gzip
import hashlib
import random

import numpy as np
import pytest
import xxhash
from tokenizers import Tokenizer

from loomlake.llm import ann, bpe, fingerprint, jaccard, line_dedup, mixing, suffix_dedup, toxicity, warc
from loomlake.llm.queries import vocabulary_path
from tests.llm.test_quality import pair_hash, word_hash


@pytest.fixture(scope="module")
def long_text():
    rng = random.Random(8)
    return " ".join(f"w{rng.randrange(9000)}" + "\n" * (k % 13 == 0) for k in range(60_000))


def plain_chunks(text, line_words=50):
    lines = text.split("\n")
    h = [word_hash(x) for x in lines]
    rolled = [None, *(pair_hash([h[i - 1], h[i]]) for i in range(1, len(h)))]
    wide = [len(x.split(" ")) >= line_words for x in lines]
    out, now = [], []
    for i, line in enumerate(lines):
        now.append(line)
        inner = 1 < i < len(lines) - 1
        least = inner and rolled[i] < rolled[i - 1] and rolled[i] < rolled[i + 1]
        if i == len(lines) - 1 or wide[i] or wide[i + 1] or least:
            out.append(now)
            now = []
    return out


def plain_dedup(rows):
    """n_removed_lines, n_removed_chunks, kept text of each row: the first place of a chunk's text stays."""
    places = {}
    for i, text in rows:
        for k, c in enumerate(plain_chunks(text) if text else []):
            if len(c) > 1 or len(c[0].split(" ")) >= 50:
                at = (i is not None, i or 0, word_hash(text), k)
                places["\n".join(c)] = min(places.get("\n".join(c), at), at)
    out = []
    for i, text in rows:
        if not text:
            out.append((str(i), 0, 0, text))
            continue
        kept, lines, gone = [], 0, 0
        for k, c in enumerate(plain_chunks(text)):
            first = places.get("\n".join(c))
            if first is not None and first != (i is not None, i or 0, word_hash(text), k):
                lines, gone = lines + len(c), gone + 1
            else:
                kept.append("\n".join(c))
        out.append((str(i), lines, gone, "\n".join(kept) if gone else text))
    return out


def test_line_dedup_against_loops(spark, long_text):
    rng = random.Random(1)
    line = lambda n: " ".join(str(rng.randrange(50)) for _ in range(n))
    passage = [line(6) for _ in range(12)]
    texts = [None, "", "\n", "a\n\nb", line(70), "\n".join([line(70)] * 2), long_text, long_text + "\nend"]
    for _ in range(25):
        own = [line(rng.randrange(1, 8)) for _ in range(rng.randrange(1, 20))]
        texts.append("\n".join(own[:3] + passage * rng.randrange(3) + own[3:]))
    rows = [*enumerate(texts), (9, texts[9]), (None, texts[10]), (3, texts[11])]
    docs = spark.createDataFrame([(i, t, "x", 5) for i, t in rows], "doc_id long, text string, gone string, n_removed_lines int").repartition(3)
    got = [(str(r.doc_id), r.n_removed_lines, r.n_removed_chunks, r.kept_text) for r in line_dedup.digest(docs).collect()]
    assert sorted(got, key=str) == sorted(plain_dedup(rows), key=str) and sum(r[2] for r in got) > 20


def test_long_texts(spark, long_text):
    rows = [(1, long_text), (2, long_text), (3, long_text[:200_000]), (4, "x" * 300_000)]
    docs = spark.createDataFrame([(i, t, "s", 0.5) for i, t in rows], "doc_id long, text string, source string, score double")
    words = [t.split() for _, t in rows]
    sets = [{tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for w in words]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.clustered(docs).collect()}
    assert got == {1: (len(sets[0]), 1), 2: (len(sets[1]), 1), 3: (len(sets[2]), 3), 4: (1, 4)}
    library = Tokenizer.from_file(vocabulary_path())
    coded = {r.doc_id: (r.n_tokens, r.decoded_sha256) for r in bpe.round_trip(docs, vocabulary_path()).collect()}
    for i, text in rows[1:]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert coded[i] == (len(ids), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    assert coded[1] == coded[2]
    prints = {r.doc_id: r for r in fingerprint.edited(docs).collect()}
    assert prints[1].fingerprint == prints[2].fingerprint and prints[1].n_chars == len(long_text)
    gone = {r.doc_id: (r.n_bytes, r.n_removed) for r in suffix_dedup.digests(docs).collect()}
    assert gone[1] == (len(long_text), len(long_text)) and gone[4] == (300_000, 300_000)
    taken = {r.doc_id: (r["size"], r.taken) for r in mixing.taken(docs).collect()}
    assert {i: n for i, (n, _) in taken.items()} == {i: len(w) for (i, _), w in zip(rows, words, strict=True)}
    assert abs(sum(n for _, n in taken.values()) - 1.5 * sum(map(len, words))) <= max(map(len, words))


def test_toxicity_keeps_clashing_columns_and_long_texts(spark, long_text):
    rng = random.Random(3)
    texts = [(k, " ".join(rng.choice(("idiot", "fool") if k % 4 == 0 and j % 9 == 0 else ("tree", "house", "river", "stone")) for j in range(80)), 7, "p") for k in range(240)]
    docs = spark.createDataFrame([*texts, (500, long_text, 7, "p"), (501, "fool idiot " * 40_000, 7, "p"), (502, None, 7, "p"), (0, texts[0][1], 7, "p")], "doc_id long, text string, score int, predicted string")
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(240)], "doc_id long, toxic int")
    kept = toxicity.without_toxic(docs, labels)
    ids = {r.doc_id for r in kept.collect()}
    assert kept.columns == docs.columns and 500 in ids and 502 in ids and 501 not in ids
    assert len(ids & set(range(0, 240, 4))) <= 6 and len(ids - set(range(0, 240, 4))) >= 175


def test_nearest_of_doubles(spark):
    rng = np.random.default_rng(2)
    data = rng.normal(size=(300, 6)) * 1e3 + 1e-7 * rng.normal(size=(300, 6))
    table = spark.createDataFrame([(k, [float(x) for x in v]) for k, v in enumerate(data)], "vec_id long, embedding array<double>")
    rows = ann.nearest(table).collect()
    assert len(rows) == 15 * 20
    for r in rows:
        assert r.score == pytest.approx(float(data[r.query_id] @ data[r.vec_id]), rel=1e-15)


def test_warc_files_are_read_back(spark, tmp_path, long_text):
    pages = [(1, "http://a/", "<title>A &amp; B</title><p>x</p>"), (2, "http://b/?q=ü x", long_text), (3, None, None), (1, "http://a/", "<title>A &amp; B</title><p>x</p>")]
    data = b""
    for i, url, page in pages:
        headers, head, payload = warc.response(i, url, page)
        headers["WARC-Date"] = f"2021-0{i}-02T03:04:05Z"
        data += warc.packed(headers, head + payload)
        data += warc.packed({"WARC-Type": "request", "WARC-Record-ID": "<urn:x>", "Content-Length": "3"}, b"GET")
    (tmp_path / "one.warc.gz").write_bytes(data)
    (tmp_path / "two.warc").write_bytes(gzip.decompress(data))
    records = warc.read_records(spark, [str(tmp_path / "one.warc.gz"), f"file://{tmp_path}/two.warc"])
    rows = records.orderBy("path", "number").collect()
    assert [r.type for r in rows] == ["response", "request"] * 8 and [r.number for r in rows] == [*range(8)] * 2
    assert rows[2].block.endswith(long_text.encode()) and rows[4].target_uri is None
    want = []
    for i, url, page in pages:
        headers, head, payload = warc.response(i, url, page)
        want += [(h, b.decode()) for h, b in warc.derivatives(headers | {"WARC-Date": f"2021-0{i}-02T03:04:05Z"}, head, payload)]
    got = warc.derived(records).collect()
    assert sorted((r.headers, r.block) for r in got) == sorted((warc.head_text(h), b) for h, b in want * 2)
    assert all(r.refers_to in r.headers for r in got)


def test_warc_files_do_not_depend_on_partitions(spark):
    pages = spark.createDataFrame([(k, f"http://h/{k}", f"<p>{k}</p>", "x") for k in range(40)] + [(1, "http://h/1", "<p>1</p>", "x")], "page_id long, url string, html string, block string")

    def made(parts):
        out = {}
        for r in warc.files(warc.built(pages.repartition(parts)), 4).collect():
            out[r.path] = out.get(r.path, b"") + bytes(r.data)
        return out

    first = made(1)
    assert first == made(7) and len(first) == 4 and sum(len(list(warc.parsed(d))) for d in first.values()) == 82


def test_warc_that_is_cut_short_raises(spark, tmp_path):
    headers, head, payload = warc.response(1, "http://a/", "x" * 1000)
    whole = gzip.decompress(warc.packed(headers, head + payload))
    for n in (20, len(whole) - 500):
        (tmp_path / "cut.warc").write_bytes(whole[:n])
        with pytest.raises(Exception, match="ends within"):
            warc.read_records(spark, [str(tmp_path / "cut.warc")]).collect()
