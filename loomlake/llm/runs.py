"""Periodic runs of words: where a text goes on repeating a stretch of words, and the text without the repetitions.

A run is a stretch with smallest period q, at least `LEAST` words and `TIMES` periods long, that no neighbouring word extends.
Runs come from Lyndon words: a stack of Lyndon factors is scanned from right to left, once under an order of the words and once
under its reverse; the factor that begins at a word is the root of a run if it can be extended to a run. Suffixes are compared
and roots extended by the longest common extension of two places: a binary search over rolling hashes of the words, and then the
words themselves are compared, so no answer rests on a hash.

A run of exponent 3 or more repeats windows of known sizes at its own period, the nearest distance at which they occur again. One
sort of the rolling hashes of a batch's windows therefore tells, without a miss, which stretches can hold runs at all, and only
these are scanned; equal windows have equal hashes, so a chance collision costs time only.

Documents never meet: each task treats its own rows, some megabytes at once, and nothing is shuffled, so neither hot groups nor
lost executors matter beyond a repeated task.

Defined cases: null, empty and blank texts have no words and no runs, their collapsed text is empty; texts of any length are
scanned whole; repeated rows give repeated results; empty tables give empty results; all columns are carried along, and a column
named runs or collapsed is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import gt, lt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from loomlake.llm.common import WORD, let

#: The least words and periods of a run.
LEAST, TIMES = 24, 3
#: Bytes of text that are treated at once.
CHUNK_BYTES = 4 << 20
#: The base of the rolling hash and the multipliers that spread words' numbers, odd numbers modulo 2**64.
BASE, SPREAD = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
_MASK = (1 << 64) - 1
RUNS = "array<struct<start:long,length:long,period:long>>"


class Extension:
    """Longest common extensions of two places of a list of words."""

    def __init__(self, word: list[int]):
        self.word, self.n = word, len(word)
        power, total, self.sums, self.powers = 1, 0, [0], [1]
        for c in word:
            total = (total + ((c + 1) * SPREAD) * power) & _MASK
            power = (power * BASE) & _MASK
            self.sums.append(total)
            self.powers.append(power)
        #: by distance: words from a to before b equal those at the distance, and the word at b does not or there is none
        self.known: dict[int, tuple[int, int]] = {}

    def _alike(self, i: int, j: int, length: int) -> bool:
        s = self.sums
        return ((s[i + length] - s[i]) * self.powers[j - i] - s[j + length] + s[j]) & _MASK == 0

    def _longest(self, most: int, alike) -> int:
        """The largest length up to `most` that is alike, by doubling and halving."""
        step = 1
        while step <= most and alike(step):
            step *= 2
        low, high = step // 2, min(step, most + 1)
        while high - low > 1:
            mid = (low + high) // 2
            if alike(mid):
                low = mid
            else:
                high = mid
        return low

    def right(self, i: int, j: int) -> int:
        """How many words from i on equal those from j on; i < j."""
        word = self.word
        if j == self.n or word[i] != word[j]:
            return 0
        d = j - i
        a, b = self.known.get(d, (0, 0))
        if a <= i < b:
            return b - i
        length = self._longest(self.n - j, lambda x: self._alike(i, j, x))
        # words that are known to be equal need no second look
        upto = a if i < a <= i + length and i + length == b else i + length
        if word[i:upto] != word[j : upto + d]:
            length = next(k for k in range(length) if word[i + k] != word[j + k])
        self.known[d] = i, i + length
        return length

    def left(self, i: int, j: int) -> int:
        """How many words before i equal those before j; i < j."""
        word = self.word
        length = self._longest(i, lambda x: self._alike(i - x, j - x, x))
        if word[i - length : i] != word[j - length : j]:
            length = next(k for k in range(length) if word[i - 1 - k] != word[j - 1 - k])
        return length


def lyndon_runs(word: list[int], least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """start, length, period of all runs of a list of words, in order; `times` is 3 or more."""
    at, n = Extension(word), len(word)
    found: dict[tuple[int, int], int] = {}
    for less in (lt, gt):
        stack: list[int] = []
        for i in range(n - 1, -1, -1):
            same = 0
            while stack:
                j = stack[-1]
                same = at.right(i, j)
                if j + same == n or not less(word[i + same], word[j + same]):
                    break
                stack.pop()
            else:
                same = 0
            j = stack[-1] if stack else n
            stack.append(i)
            period, end = j - i, j + same
            # the first root of a run begins in its first period
            if same > (times - 2) * period and (end, period) not in found:
                start = i - at.left(i, j)
                if end - start >= max(least, times * period):
                    found[end, period] = start
    return sorted((start, end - start, period) for (end, period), start in found.items())


def _within(codes: np.ndarray, owner: np.ndarray, ends: np.ndarray, least: int, times: int) -> list[tuple[int, int]]:
    """The stretches (begin, end) of a batch's words that hold all runs of its documents.

    owner: the document of each word; ends: the place after that document's last word.
    """
    n = len(codes)
    if n < least:
        return []
    with np.errstate(over="ignore"):
        powers = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, BASE, np.uint64))])
        back = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, pow(BASE, -1, 1 << 64), np.uint64))])
        values = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(SPREAD)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(values * powers[:n])])

        def windows(places: np.ndarray, size: int) -> np.ndarray:
            # windows of different documents differ by their owner
            return (sums[places + size] - sums[places]) * back[places] + owner[places].astype(np.uint64) * np.uint64(BASE)

        def again(places: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
            """Places whose windows occur again, and where next."""
            keys = windows(places, size)
            order = np.argsort(keys, kind="stable")
            equal = keys[order[1:]] == keys[order[:-1]]
            return places[order[:-1][equal]], places[order[1:][equal]]

        scales = []
        low = 1
        while times * low <= n:
            high = 2 * low - 1
            scales.append((low, high, max(least - high, (times - 1) * low)))
            low *= 2
        shortest = min(size for *_, size in scales)
        places = np.flatnonzero(ends - np.arange(n) >= shortest)
        first, second = again(places, shortest)
        same = owner[first] == owner[second]
        places = np.unique(np.concatenate([first[same], second[same]]))
        edges = []
        for low, high, size in scales:
            here = places[ends[places] - places >= size]
            if len(here) < 2:
                continue
            first, second = again(here, size)
            near = (second - first >= low) & (second - first <= high) & (owner[first] == owner[second])
            edges.append(np.stack([first[near], second[near] + size]))
    spans = np.concatenate(edges, axis=1) if edges else np.empty((2, 0), np.int64)
    if not spans.shape[1]:
        return []
    order = np.argsort(spans[0], kind="stable")
    begin, end = spans[0][order], np.maximum.accumulate(spans[1][order])
    # spans that meet are one; a document's last span never passes its end, but may touch the next document's first
    new = np.concatenate([[True], (begin[1:] >= end[:-1]) | (owner[begin[1:]] != owner[begin[:-1]])])
    heads = np.flatnonzero(new)
    return list(zip(begin[heads].tolist(), end[np.append(heads[1:], len(begin)) - 1].tolist(), strict=True))


def _treated(texts: pa.Array, least: int, times: int) -> tuple[pa.Array, pa.Array]:
    """runs and collapsed of some texts."""
    parts = pc.split_pattern_regex(texts.fill_null(""), r"[\x20\x09-\x0D]+")
    words = parts.flatten()
    some = pc.not_equal(words, "")
    counts = np.add.reduceat(np.append(some.to_numpy(zero_copy_only=False), False).astype(np.int64), parts.offsets.to_numpy()[:-1]) if len(parts) else np.empty(0, np.int64)
    words = words.filter(some)
    offsets = np.concatenate([[0], np.cumsum(counts)])
    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy().astype(np.int64)
    owner = np.repeat(np.arange(len(counts)), counts)
    keep, runs = np.ones(len(codes), bool), [[] for _ in counts]
    for begin, end in _within(codes, owner, np.repeat(offsets[1:], counts), least, times):
        of = owner[begin]
        for start, length, period in lyndon_runs(codes[begin:end].tolist(), least, times):
            keep[begin + start + period : begin + start + length] = False
            runs[of].append({"start": begin + start - int(offsets[of]), "length": length, "period": period})
    left = np.concatenate([[0], np.cumsum(keep)])[offsets]
    rest = words.filter(pa.array(keep)) if not keep.all() else words
    collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(left, pa.int32()), rest), " ")
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
    return pa.array(runs, kind), collapsed


def collapsed(docs: DataFrame, text: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """docs with runs (start, length, period by start, then period, counted in words) and collapsed.

    collapsed: the words, joined by one space, without those that a run has after its first period.
    """
    if times < 3:
        raise ValueError("runs of fewer than 3 periods are not searched for")
    docs = docs.drop("runs", "collapsed")
    at = docs.columns.index(text)
    kind = StructType([*docs.schema.fields, StructField("runs", docs.sparkSession.createDataFrame([], f"r {RUNS}").schema["r"].dataType), StructField("collapsed", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False))
            cuts = np.flatnonzero(np.diff(sizes // CHUNK_BYTES)) + 1
            for begin, end in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                part = batch.slice(begin, end - begin)
                if part.num_rows:
                    made = _treated(part.column(at).cast(pa.string()), least, times)
                    yield pa.RecordBatch.from_arrays([*part.columns, *made], names=[*part.schema.names, "runs", "collapsed"])

    return docs.mapInArrow(run, kind)


def with_loops(docs: DataFrame) -> DataFrame:
    """doc_id, text of docs, where the words at the end of every tenth text, by the checksum of its id, go round in a loop."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(0))

    def looped(w: Column) -> Column:
        n, g = F.size(w).cast("long"), F.floor(h / 10)
        from_ = F.pmod(g, n)
        period = 1 + F.floor((n - from_) / (3 + F.pmod(g, F.lit(8))))
        head = F.slice(w, F.lit(1), from_.cast("int"))
        tail = F.transform(F.sequence(F.lit(0).cast("long"), n - from_ - 1), lambda k: F.get(w, (from_ + F.pmod(k, period)).cast("int")))
        return F.when(n > 0, F.array_join(F.concat(head, tail), " ")).otherwise(F.lit(""))

    return docs.select("doc_id", F.when(F.pmod(h, F.lit(10)) == 0, let(words, looped)).otherwise(F.col("text")).alias("text"))


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, the number of runs, the run that repeats most with its exponent in thousandths, and digests of runs and text."""
    found = collapsed(docs.select("doc_id", "text")).drop("text")
    # fewer thousandths decide nothing: quotients are compared as products
    ahead = lambda a, b: (a["length"] * b["period"] > b["length"] * a["period"]) | ((a["length"] * b["period"] == b["length"] * a["period"]) & ((a["start"] < b["start"]) | ((a["start"] == b["start"]) & (a["period"] <= b["period"]))))
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda a, b: F.when(ahead(a, b), a).otherwise(b))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n"))), "")
    rows = found.withColumn("best", best)
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col("best")[c].alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
