"""BPE encoding and decoding with an index of pair occurrences.

The words of a batch are laid out side by side as one list of symbols. An index maps each mergeable pair to all its
positions in the batch; the active ranks are applied in ascending order, each to all positions of its pair, and the lists
of the neighbouring pairs are updated. A merge can only create pairs of larger rank than its own or, where a vocabulary
is unordered, of smaller rank, which the heap of active ranks then brings forward; either way each word sees its own
merges in rank order, as if it were alone. Words repeat, so what a word became is remembered; encoding a text then is a
lookup for each of its words. Where no word crosses a blank, what stands between blanks is remembered, too, with its ids and
what they decode to, so a text is normalized and split where it says something new. A memory has two parts: once the newer
one is full, the older one is forgotten and the newer one takes its place, and what is met again moves to the newer part. So
what is met often is worked out once, and what is forgotten was not met while a whole part was filled.

The tokenizer file (the JSON form of the tokenizers library) is read by path on the driver and travels with the tasks
as broadcast data; its size is that of a vocabulary. Supported are models of type BPE with NFC, Lowercase and Replace
normalizers, Split and ByteLevel pre-tokenizers, added tokens, and a decoder that is absent or ByteLevel.

Defined cases: null is the empty text, with no ids; unpaired surrogates cannot occur in Spark strings; repeated rows are
encoded each; ids outside the vocabulary are skipped in decoding, as the library does; other columns are carried along.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import struct
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from loomlake.llm.common import fresh

#: Words in the newer part of a worker's memory before it becomes the older one; of stretches without a blank as many.
REMEMBERED = 300_000
#: Characters of those words or stretches, where they are long.
REMEMBERED_CHARS = 16 * REMEMBERED
#: Split patterns that neither match nor look at a space or line feed, and normalizers that treat what stands
#: between those alone, as space and line feed compose with nothing.
APART = ("'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+",)
LOCAL = ({"type": "NFC"}, {"type": "Lowercase"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "})


@functools.cache
def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else the next from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class PairIndex:
    """Merges the words of a batch through an index from each pair to its positions."""

    def __init__(self, merges: dict[tuple[int, int], tuple[int, int]]):
        #: pair of ids -> rank; by rank the pair and the id of the merged token
        self.ranks = {pair: rank for pair, (rank, _) in merges.items()}
        self.target = {rank: (*pair, merged) for pair, (rank, merged) in merges.items()}

    def merge(self, words: Iterable[list[int]]) -> list[list[int]]:
        """Each word's symbols after all merges."""
        symbols: list[int] = []
        ends = []
        for w in words:
            symbols.extend(w)
            symbols.append(-1)  # no pair crosses the end of a word
            ends.append(len(symbols) - 1)
        get, target, n = self.ranks.get, self.target, len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        at: dict[int, list[int]] = {}  # rank -> positions of the pair's left symbol
        for k, rank in enumerate(map(get, pairwise(symbols))):
            if rank is not None:
                if rank in at:
                    at[rank].append(k)
                else:
                    at[rank] = [k]
        active = list(at)
        heapq.heapify(active)
        while active:
            rank = heapq.heappop(active)
            places = at.pop(rank, None)
            if places is None:
                continue
            left, right, merged = target[rank]
            places.sort()
            for k in places:
                if symbols[k] != left:
                    continue  # it was merged away
                r = after[k]
                if r >= n or symbols[r] != right:
                    continue
                symbols[k], symbols[r] = merged, -2
                nxt = after[r]
                after[k] = nxt
                if nxt < n:
                    before[nxt] = k
                    b = symbols[nxt]
                    new = get((merged, b)) if b >= 0 else None
                    if new is not None:
                        if new in at:
                            at[new].append(k)
                        else:
                            at[new] = [k]
                            heapq.heappush(active, new)
                p = before[k]
                if p >= 0:
                    a = symbols[p]
                    new = get((a, merged)) if a >= 0 else None
                    if new is not None:
                        if new in at:
                            at[new].append(p)
                        else:
                            at[new] = [p]
                            heapq.heappush(active, new)
        out, begin = [], 0
        for end in ends:
            out.append([s for s in symbols[begin:end] if s >= 0])
            begin = end + 1
        return out


class Memory:
    """Values by text, in columns, of the texts that were met of late."""

    def __init__(self, columns: int):
        self.columns: list[dict] = [{} for _ in range(columns)]
        self.older: list[dict] = [{} for _ in range(columns)]
        self.chars = 0

    def new(self, texts: set[str]) -> set[str]:
        """Those of texts that it doesn't know; the others are in its newer part then. Call it once before texts are added."""
        if len(self.columns[0]) > REMEMBERED or self.chars > REMEMBERED_CHARS:
            self.older, self.columns, self.chars = self.columns, [{} for _ in self.columns], 0
        # (`texts - d.keys()` would walk through all of d)
        missing = texts.difference(self.columns[0])
        older = self.older[0]
        again = [x for x in missing if x in older]
        for newer, older in zip(self.columns, self.older):
            newer.update((x, older[x]) for x in again)  # not taken out of it: whoever still reads it finds all
        missing.difference_update(again)
        self.chars += sum(map(len, again)) + sum(map(len, missing))
        return missing


class Tokenizer:
    """A BPE tokenizer of a JSON description."""

    def __init__(self, description: str):
        d = json.loads(description)
        model = d["model"]
        if model["type"] != "BPE" or model.get("byte_fallback") or model.get("continuing_subword_prefix") or model.get("dropout"):
            raise ValueError("only plain BPE models are supported")
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.added = [(a["content"], a["id"]) for a in d.get("added_tokens") or []]
        if any(a["lstrip"] or a["rstrip"] or a["single_word"] or a["normalized"] for a in d.get("added_tokens") or []):
            raise ValueError("added tokens with matching options are not supported")
        self.splitter = regex.compile("(" + "|".join(regex.escape(c) for c, _ in self.added) + ")") if self.added else None
        pairs = [m if isinstance(m, list) else m.split(" ", 1) for m in model["merges"]]
        self.merges = {(self.vocab[a], self.vocab[b]): (k, self.vocab[a + b]) for k, (a, b) in enumerate(pairs)}
        self.index = PairIndex(self.merges)
        self.normalize = self._steps(d.get("normalizer"), "normalizers", self._normalizer)
        self.split = self._pre_tokenizer(d.get("pre_tokenizer"))
        decoder = (d.get("decoder") or {}).get("type")
        if decoder not in (None, "ByteLevel"):
            raise ValueError(f"decoder {decoder} is not supported")
        self.joins_bytes = decoder == "ByteLevel"
        self.token = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.added}
        self.special = dict(self.added)
        #: word -> its ids as little-endian bytes
        self.memory = Memory(1)
        #: what stands between blanks -> its ids and, in a second column once texts are decoded, too, what they decode to
        self.between = Memory(1)
        self.apart = self._apart(d)
        #: stretches that have white space of other kinds or an added token
        self.rough = regex.compile(r"\s|" + "|".join(regex.escape(c) for c, _ in self.added)) if self.added else regex.compile(r"\s")
        letters = byte_letters()
        self.byte_ids = [self.vocab.get(c) for c in letters]
        self.last_ids = [self.vocab.get(c + self.suffix) for c in letters]

    @staticmethod
    def _steps(spec, inner, make) -> list:
        if spec is None:
            return []
        return [make(s) for s in spec[inner]] if spec["type"] == "Sequence" else [make(spec)]

    @staticmethod
    def _normalizer(spec):
        kind = spec["type"]
        if kind in ("NFC", "NFD", "NFKC", "NFKD"):
            return functools.partial(unicodedata.normalize, kind)
        if kind == "Lowercase":
            # each character alone: str.lower() alone would look at neighbours of a final sigma
            return lambda t: t.lower() if "Σ" not in t else "".join(c.lower() for c in t)
        if kind == "Replace" and "Regex" in spec["pattern"]:
            return functools.partial(regex.compile(spec["pattern"]["Regex"]).sub, spec["content"].replace("\\", "\\\\"))
        raise ValueError(f"normalizer {kind} is not supported")

    def _pre_tokenizer(self, spec):
        steps = [] if spec is None else spec["pretokenizers"] if spec["type"] == "Sequence" else [spec]
        pattern = None
        for s in steps:
            if s["type"] == "Split" and s["behavior"] == "Removed" and s["invert"] and "Regex" in s["pattern"]:
                pattern = regex.compile(s["pattern"]["Regex"])
            elif s["type"] == "ByteLevel" and not s["add_prefix_space"]:
                if s.get("use_regex"):
                    pattern = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
            else:
                raise ValueError(f"pre-tokenizer {s['type']} is not supported")
        if not any(s["type"] == "ByteLevel" for s in steps):
            raise ValueError("only byte-level pre-tokenizers are supported")
        return pattern.findall if pattern else lambda t: [t] if t else []

    def _apart(self, d: dict) -> bool:
        """Whether what stands between blanks can be encoded and decoded by itself."""
        normalizer, split = d.get("normalizer"), d.get("pre_tokenizer")
        steps = [] if normalizer is None else normalizer["normalizers"] if normalizer["type"] == "Sequence" else [normalizer]
        words = split["pretokenizers"] if split["type"] == "Sequence" else [split]
        known = len(words) == 2 and words[0]["type"] == "Split" and words[0]["pattern"].get("Regex") in APART and words[1]["type"] == "ByteLevel" and not words[1].get("use_regex")
        return known and all(s in LOCAL for s in steps) and not self.joins_bytes and "" not in self.vocab and all(c and not c.isalpha() and " " not in c and "\n" not in c for c, _ in self.added)

    def _symbols(self, word: str) -> list[int]:
        raw, ids = word.encode(), self.byte_ids
        out = [ids[b] for b in raw]
        if raw:
            out[-1] = self.last_ids[raw[-1]]
        return out if None not in out else [i for i in out if i is not None]

    def _learn(self, words: set[str]) -> dict[str, bytes]:
        """The memory of words, with the ids of all of these."""
        fresh = list(self.memory.new(words))
        known = self.memory.columns[0]
        for w, ids in zip(fresh, self.index.merge(map(self._symbols, fresh))):
            known[w] = struct.pack(f"<{len(ids)}I", *ids)
        return known

    def pieces(self, text: str) -> list[str | int]:
        """Pre-tokens of a text; an added token is its id."""
        out: list[str | int] = []
        for k, part in enumerate(self.splitter.split(text) if self.splitter else [text]):
            if k % 2:
                out.append(self.special[part])
            elif part:
                for step in self.normalize:
                    part = step(part)
                out += self.split(part)
        return out

    def encode_batch(self, texts: Iterable[str | None], at_once: int = 2_000_000) -> Iterator[np.ndarray]:
        """Ids of each text; the pair index spans texts of up to `at_once` characters together, and any longer one alone."""
        for group in self._groups(texts, at_once):
            yield from self._encode(group)

    @staticmethod
    def _groups(texts: Iterable[str | None], at_once: int = 2_000_000) -> Iterator[list[str]]:
        group, size = [], 0
        for t in texts:
            group.append(t or "")
            size += len(group[-1])
            if size >= at_once:
                yield group
                group, size = [], 0
        yield group

    def _encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        if self.apart:
            split = self._stretches(texts)
            known = self.between.columns[0].__getitem__
            for stretches in split:
                yield np.frombuffer(b"".join(map(known, stretches)), "<u4")
        else:
            yield from self._encode_words(texts)

    def _encode_words(self, texts: list[str]) -> Iterator[np.ndarray]:
        split = [self.pieces(t) for t in texts]
        known = self._learn({w for ws in split for w in set(ws) if isinstance(w, str)})
        for ws in split:
            yield np.frombuffer(b"".join([known[w] if isinstance(w, str) else struct.pack("<I", w) for w in ws]), "<u4")

    def _stretches(self, texts: list[str]) -> list[list[str]]:
        """What stands between blanks in each text; the newer part of the memory has all of it then."""
        split = [t.replace("\n", " ").split(" ") for t in texts]
        fresh = self.between.new(set().union(*split))
        between, *said = self.between.columns
        rough = {x for x in fresh if not x.isalpha() and (not x or self.rough.search(x))}
        fresh = list(fresh - rough)
        joined = " ".join(fresh)
        for step in self.normalize:
            joined = step(joined)
        words = [[w] if w.isalpha() else [w[:-1], w[-1]] if w[-1] in ".,;:!?" and w[:-1].isalpha() else self.split(w) for w in joined.split(" ") if w]
        if len(words) != len(fresh):
            raise ValueError("a normalizer made or removed blanks")
        known = self._learn({w for ws in words for w in ws})
        between.update((x, known[ws[0]] if len(ws) == 1 else b"".join([known[w] for w in ws])) for x, ws in zip(fresh, words))
        for x, ids in zip(rough, self._encode_words(list(rough))):
            between[x] = ids.tobytes()
        token = self.token.__getitem__
        for column in said:
            for x in [*fresh, *rough]:
                column[x] = " ".join(map(token, memoryview(between[x]).cast("I")))
        return split

    def round_trips(self, texts: Iterable[str | None]) -> Iterator[tuple[np.ndarray, str]]:
        """Ids of each text, and what they decode to."""
        if not self.apart:
            for ids in self.encode_batch(texts):
                yield ids, self.decode(ids.tolist())
            return
        if len(self.between.columns) == 1:
            self.between = Memory(2)
        for group in self._groups(texts):
            split = self._stretches(group)
            known, said = (column.__getitem__ for column in self.between.columns)
            for stretches in split:
                yield np.frombuffer(b"".join(map(known, stretches)), "<u4"), " ".join(filter(None, map(said, stretches)))

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids; without a decoder tokens stand side by side with a space between."""
        token = self.token
        known = [token[i] for i in ids if i in token]
        if not self.joins_bytes:
            return " ".join(known)
        value = {c: b for b, c in enumerate(byte_letters())}
        raw = b"".join(bytes(value[c] for c in t) if all(c in value for c in t) else t.encode() for t in known)
        return raw.decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def _tokenizer(description: str) -> Tokenizer:
    return Tokenizer(description)


def read_description(spark: SparkSession, path: str) -> str:
    """The tokenizer file, by a path of the driver or, with a scheme, of any store that Spark reads."""
    if "://" in path:
        return spark.read.text(path, wholetext=True).first()[0]
    with open(path, encoding="utf-8") as f:
        return f.read()


def tokenized(docs: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """docs with the column `ids`: the ids of text, as an array of int; if docs has such a column, ours begins with _."""
    ids = fresh(docs, ids)
    held = docs.sparkSession.sparkContext.broadcast(read_description(docs.sparkSession, path))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _tokenizer(held.value)
        for whole in batches:
            for k in range(0, whole.num_rows, 256):
                batch = whole.slice(k, 256)
                got = list(t.encode_batch(batch.column(at).to_pylist()))
                offsets = np.cumsum([0, *map(len, got)]).astype("i4")
                flat = np.concatenate(got).astype("i4") if got else np.empty(0, "i4")
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(offsets, pa.array(flat))], names=[*batch.schema.names, ids])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(ids, ArrayType(IntegerType()))]))


def detokenized(rows: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """rows with the column `text`: what the ids decode to; null ids are none."""
    held = rows.sparkSession.sparkContext.broadcast(read_description(rows.sparkSession, path))
    at = rows.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _tokenizer(held.value)
        for batch in batches:
            got = pa.array([t.decode(x or ()) for x in batch.column(at).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, got], names=[*batch.schema.names, text])

    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField(text, StringType())]))


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: every text encoded and decoded in one pass, reduced to digests."""
    held = docs.sparkSession.sparkContext.broadcast(read_description(docs.sparkSession, path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _tokenizer(held.value)
        sha = hashlib.sha256
        for batch in batches:
            n, a, b = [], [], []
            for ids, decoded in t.round_trips(batch.column(1).to_pylist()):
                n.append(len(ids))
                a.append(sha(ids).hexdigest())
                b.append(sha(decoded.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = StructType([docs.schema["doc_id"], StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())])
    return docs.select("doc_id", F.col("text")).mapInArrow(run, schema)
