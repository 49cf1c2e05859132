"""The corpus pipeline against a plain Python version of its stages on a small corpus."""

import hashlib
import random
import re

import pytest
import xxhash

from loomlake.llm import toxicity
from loomlake.llm.queries import vocabulary_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, extra string"


def long_hash(value: int, seed: int) -> int:
    return xxhash.xxh64_intdigest(value.to_bytes(8, "little"), seed)


def chunked(text: str) -> list[list[str]]:
    lines = text.split("\n")
    last = len(lines) - 1
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in lines]
    wide = [len(x.split(" ")) >= 50 for x in lines]
    signed = lambda v: v - 2**64 if v >= 2**63 else v
    rolled = [None] + [signed(long_hash(hashes[i], long_hash(hashes[i - 1], 42))) for i in range(1, last + 1)] + [None]
    out = [[lines[0]]]
    for i in range(last):
        near = rolled[i - 1 : i + 2] if i else [None]
        if wide[i] or wide[i + 1] or (None not in near and near[1] < near[0] and near[1] < near[2]):
            out.append([])
        out[-1].append(lines[i + 1])
    return out


def without_later_chunks(docs: dict) -> dict:
    had, out = set(), {}
    for i, d in sorted(docs.items()):
        kept = []
        for c in chunked(d["text"] or ""):
            name = "\n".join(c)
            counts = len(c) > 1 or len(name.split(" ")) >= 50
            if not (counts and name in had):
                kept.append(name)
            if counts:
                had.add(name)
        text = "\n".join(kept) if d["text"] is not None else None
        out[i] = d | {"text": text, "n_chars": None if text is None else len(text)}
    return out


def one_of_each_group(docs: dict) -> dict:
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets, label = {}, {i: i for i in docs}
    for i, d in docs.items():
        w = WORD.findall((d["text"] or "").translate(low))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    changed = True
    while changed:
        changed = False
        for a, x in sets.items():
            for b, y in sets.items():
                if a < b and label[a] != label[b] and x and y and 100 * len(x & y) >= 75 * len(x | y):
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return {i: d for i, d in docs.items() if label[i] == i}


def targets_of(sizes: dict) -> dict:
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    left, full, target = 1.5 * sum(sizes.values()), set(), {}
    while True:
        open_ = [s for s in names if s not in full]
        if not open_:
            return target
        level = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if weight[s] * level > 2 * sizes[s]]
        if not over:
            return target | {s: weight[s] * level for s in open_}
        for s in over:
            full.add(s)
            target[s] = 2.0 * sizes[s]
            left -= target[s]


def mixed(docs: dict) -> list:
    words = {i: len(WORD.findall(d["text"] or "")) for i, d in docs.items()}
    sizes: dict = {}
    for i, d in docs.items():
        sizes[d["source"]] = sizes.get(d["source"], 0) + words[i]
    targets = targets_of(sizes)
    passes = []
    for source, target in targets.items():
        start = 0
        for i in sorted((i for i in docs if docs[i]["source"] == source), key=lambda i: hashlib.md5(str(i).encode()).hexdigest()) * 2:
            if words[i]:
                passes.append(((start + words[i]) / target, source is None, source or "", start, i))
                start += words[i]
    out, left = [], int(sum(targets.values()) + 0.5)
    for *_, i in sorted(passes):
        n = min(words[i], left)
        left -= n
        if n:
            text = docs[i]["text"]
            if n < words[i]:
                text = "".join(re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+", text)[:n])
            out.append(docs[i] | {"text": text, "n_chars": len(text), "doc_id": i})
    return out


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(11)
    usual = ["".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randrange(3, 9))) for _ in range(400)]
    line = lambda n: " ".join(rng.choice(usual) for _ in range(n))
    make = lambda k: "\n".join(line(rng.randrange(4, 12)) for _ in range(k))
    insults = ["zwixhead", "grumfool", "vyrkscum", "jaxblight"]
    passage, wide, texts, toxic = make(12), line(70), [], set()
    for k in range(160):
        t = make(rng.randrange(1, 12))
        if k % 5 == 0:
            toxic.add(k)
            words = t.split(" ")
            for _ in range(8):
                words.insert(rng.randrange(len(words) + 1), rng.choice(insults))
            t = " ".join(words)
        elif k % 5 == 1:
            t = t + "\n" + (passage if k % 2 else wide) + "\n" + make(2)
        texts.append(t)
    for k in range(160, 190):
        base = texts[2 + 5 * (k % 3)].split(" ")
        if k % 2:
            base[-1] = rng.choice(usual)
        texts.append(" ".join(base))
    texts += [None, "", " \n ", "Two words", "two WORDS"]
    docs = {i: {"text": t, "lang": "en", "source": (None, "b", "a", "c", "a")[i % 5 if i % 3 else 2], "n_chars": None if t is None else len(t), "extra": str(i)} for i, t in enumerate(texts)}
    return docs, toxic


def test_pipeline(spark, corpus, tmp_path):
    from tokenizers import Tokenizer

    import corpus_pipeline

    docs, toxic = corpus
    frame = spark.createDataFrame([(i, d["text"], d["lang"], d["source"], d["n_chars"], d["extra"]) for i, d in docs.items()], SCHEMA)
    labels = spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(160)], "doc_id long, quality int, toxic int")
    frame.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    score = toxicity.learned(frame, labels).scorer()
    clean = {i: d for i, d in docs.items() if score(d["text"]) < 0.5}
    assert len(toxic & clean.keys()) <= 2 and len(docs.keys() - toxic - clean.keys()) <= 2
    rows = mixed(one_of_each_group(without_later_chunks(clean)))
    t = Tokenizer.from_file(vocabulary_path())
    t.no_padding()
    t.no_truncation()
    want = sorted((d["doc_id"], d["text"], d["n_chars"], str(d["source"]), d["extra"], tuple(t.encode(d["text"], add_special_tokens=False).ids)) for d in rows)
    done = corpus_pipeline.run(spark, str(tmp_path))
    assert done.columns == [*frame.columns, "ids"]
    assert sorted((r.doc_id, r.text, r.n_chars, str(r.source), r.extra, tuple(r.ids)) for r in done.collect()) == want


def test_pipeline_of_empty_tables(spark, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_rows_that_repeat_an_id(spark):
    from loomlake.llm import jaccard, mixing

    line = lambda k: " ".join(f"w{k}x{i}" for i in range(40))
    # two equal rows, a near copy with their id, another text with their id, a copy without an id, and a lone row
    rows = [(1, line(1)), (1, line(1)), (1, line(1) + " more"), (1, line(2)), (None, line(1)), (2, line(3)), (3, None)]
    docs = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, source string")
    kept = [(r.doc_id, (r.text or "").split(" ")[0]) for r in jaccard.representatives(docs.repartition(3)).collect()]
    assert sorted(kept) == [(1, "w1x0"), (1, "w2x0"), (2, "w3x0"), (3, "")]
    got = [len(r.text.split(" ")) for r in mixing.mixed(docs.repartition(3), share=1.0).collect()]
    assert sum(got) == 241 and len(got) == 6
    got = [len(r.text.split(" ")) for r in mixing.mixed(docs.repartition(3)).collect()]
    assert sum(got) == round(1.5 * 241 + 1e-9)
