"""Suffix-array dedup: every byte of a string of `width` bytes that starts anywhere else goes.

Segments. Each window of `width` bytes has an anchor, one of its 64-byte strings, chosen by the window's bytes alone: equal
windows have equal anchors. Runs of windows with one anchor are a segment. A segment whose anchor occurs once in the corpus
repeats nothing; one that occurs twice as a whole repeats in all its windows; only segments of one anchor that differ are
compared, each of them once.

Anchors are the least hashes of a window, but 64-byte strings with a large share of all positions come last. They are found
in counts of fixed size that every position enters. So a frequent passage is an anchor only to windows that hold nothing
else, which are the same everywhere, and no anchor has a large share of the segments that are compared.

Shards. The segments to compare are gathered by anchor, and a task concatenates many anchors' segments to shards of
`SHARD_BYTES`, or those of one anchor. Induced sorting builds a shard's suffix array: suffixes are classified as smaller or
larger than their right neighbour, the leftmost-smaller substrings are sorted and named, names are sorted by pairs of names
recursively until they differ, and they induce the whole array in two linear sweeps over the first bytes. Common prefixes
are permuted into text order, where only the irreducible ones are compared byte by byte, and tell the repeated windows.

Numpy works on whole buckets of bytes at once, so the cost is some hundred nanoseconds a byte of compared segments.

Defined cases: null texts are empty; texts shorter than `width` lose nothing; matches never cross documents; equal rows
match each other; overlapping spans count, also within one document; an empty table gives an empty result; other columns
are ignored. Long texts are read in blocks of `BLOCK` bytes, so memory does not grow with them beyond the text itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomlake.llm.common import Scratch, partitions, stored

WIDTH = 200
ANCHOR = 64
BLOCK = 1 << 20
#: Bytes of segments that are sorted together; an anchor with more is sorted alone.
SHARD_BYTES = 1 << 21
#: Buckets of the counts that find frequent strings, and the share and number of positions from which a bucket is frequent.
BUCKETS = 1 << 22
FREQUENT_SHARE = 4 / BUCKETS
FREQUENT = 1000
#: Postings that one task compares.
TASK_POSTINGS = 2_000_000

_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xD6E8FEB86659FD93)
_powers: list[np.ndarray] = []


# --- suffix arrays -------------------------------------------------------------------------------------------------


def _smaller(s: np.ndarray) -> np.ndarray:
    """Which suffixes of s are smaller than their right neighbour; zeros are borders, each smaller than all that follows."""
    n = len(s)
    differs = np.flatnonzero(np.r_[s[1:] != s[:-1], True])
    end = differs[np.searchsorted(differs, np.arange(n))]  # the last place of the run of equal numbers
    return (s == 0) | np.r_[s[1:], 0][end] > s[end]


def _scatter(order: np.ndarray, at: np.ndarray, s: np.ndarray, found: np.ndarray, step: int) -> None:
    """Put found, in its order, into the buckets of its numbers, at the places `at`, which move by step."""
    kinds = s[found]
    by = np.argsort(kinds, kind="stable")
    kinds, found = kinds[by], found[by]
    first = np.flatnonzero(np.r_[True, kinds[1:] != kinds[:-1]])
    sizes = np.diff(np.r_[first, len(kinds)])
    inside = np.arange(len(kinds)) - np.repeat(first, sizes)
    order[at[kinds] + step * inside] = found
    at[kinds[first]] += step * sizes


def _induced(s: np.ndarray, smaller: np.ndarray, seeds: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The order of all suffixes that the leftmost-smaller ones, in the order of seeds, induce."""
    n = len(s)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    order = np.full(n, -1, np.int64)
    kinds = s[seeds]
    seeds = seeds[np.argsort(kinds, kind="stable")]
    kinds = s[seeds]
    seed_at = np.searchsorted(kinds, np.arange(len(sizes) + 1))
    head = starts.copy()
    for c in np.flatnonzero(sizes):
        queue = order[starts[c] : head[c]] if c else np.zeros(0, np.int64)
        done = []
        while len(queue):  # those of the same byte come behind, which are one fewer of each run of that byte
            done.append(queue)
            left = queue[queue > 0] - 1
            queue = left[(s[left] == c) & ~smaller[left]]
            if len(queue):
                order[head[c] : head[c] + len(queue)] = queue
                head[c] += len(queue)
        every = np.concatenate([*done, seeds[seed_at[c] : seed_at[c + 1]]])
        left = every[every > 0] - 1
        left = left[(s[left] > c) & ~smaller[left]]
        if len(left):
            _scatter(order, head, s, left, 1)
    tail = ends - 1
    borders = int(sizes[0])
    for c in np.flatnonzero(sizes)[::-1]:
        if c == 0:
            break
        queue = order[tail[c] + 1 : ends[c]][::-1]
        done = []
        while len(queue):
            done.append(queue)
            left = queue[queue > 0] - 1
            queue = left[(s[left] == c) & smaller[left]]
            if len(queue):
                order[tail[c] + 1 - len(queue) : tail[c] + 1] = queue[::-1]
                tail[c] -= len(queue)
        every = np.concatenate([*done, order[starts[c] : head[c]][::-1]])
        left = every[every > 0] - 1
        left = left[(s[left] < c) & (s[left] > 0) & smaller[left]]
        if len(left):
            _scatter(order, tail, s, left, -1)
    order[:borders] = np.flatnonzero(s == 0)
    return order


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one number whose order is theirs."""
    wide = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    out = np.zeros(len(text), np.uint64)
    for k in range(8):
        out = (out << np.uint64(8)) | wide[k : k + len(text)]
    return out


def _same(words: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the `length` bytes from a and b on are the same."""
    ok = np.ones(len(a), bool)
    open_ = np.flatnonzero(length > 0)
    done = 0
    while len(open_):
        left = np.minimum(length[open_] - done, 8)
        shift = (8 * (8 - left)).astype(np.uint64)
        x, y = words[a[open_] + done], words[b[open_] + done]
        good = (x >> shift) == (y >> shift)
        ok[open_[~good]] = False
        done += 8
        open_ = open_[good & (length[open_] > done)]
    return ok


def suffix_array(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The joined texts, each with a border (0) behind it, as numbers from 1, and the order of their suffixes.

    Borders are smaller than all bytes and in the order of the texts.
    """
    s = np.concatenate([np.append(np.frombuffer(t, np.uint8).astype(np.int16) + 1, np.int16(0)) for t in texts])
    n = len(s)
    smaller = _smaller(s)
    sizes = np.bincount(s, minlength=257)
    seeds = np.flatnonzero(smaller & ~np.r_[True, smaller[:-1]])
    induced = _induced(s, smaller, seeds, sizes)
    rank = np.full(n, -1, np.int64)
    rank[seeds] = np.arange(len(seeds))
    sorted_ = rank[induced]
    sorted_ = sorted_[sorted_ >= 0]  # numbers of the seeds, by their substrings
    # names: substrings that end at the next seed are equal if their bytes are, unless they hold a border
    here = seeds[sorted_]
    ends = np.r_[seeds[1:], n - 1][sorted_]
    plain = (s[here] > 0) & (s[ends] > 0)
    length = ends - here + 1
    words = _words((s - 1).astype(np.uint8))
    pair = plain[1:] & plain[:-1] & (length[1:] == length[:-1])
    equal = np.zeros(len(here), bool)
    some = np.flatnonzero(pair)
    equal[some + 1] = _same(words, here[some], here[some + 1], length[some])
    names = np.empty(len(seeds), np.int64)
    names[sorted_] = np.cumsum(~equal) - 1
    # pairs of names, pairs of those, and so on: only names that are not alone yet are sorted again
    counts = np.bincount(names, minlength=len(names))
    open_ = np.flatnonzero(counts[names] > 1)
    names = (np.cumsum(counts) - counts)[names]  # a name leaves room for those that have it, too
    reach = 1
    while len(open_):
        follow = open_ + reach
        second = np.where(follow < len(names), names[np.minimum(follow, len(names) - 1)], -1)
        key = names[open_] * (len(names) + 1) + second + 1
        by = np.argsort(key)
        a, key = names[open_][by], key[by]
        group = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
        start = np.repeat(group, np.diff(np.r_[group, len(a)]))
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        sizes_of = np.diff(np.r_[first, len(key)])
        names[open_[by]] = a + np.repeat(first, sizes_of) - start
        open_ = np.sort(open_[by][np.repeat(sizes_of, sizes_of) > 1])
        reach *= 2
    return s, _induced(s, smaller, seeds[np.argsort(names)], sizes)


def repeated_starts(texts: list[bytes], width: int) -> list[np.ndarray]:
    """For each of the texts, which of its windows of `width` bytes also start elsewhere in the texts."""
    s, order = suffix_array(texts)
    n = len(s)
    before = np.empty(n, np.int64)
    before[order[1:]] = order[:-1]
    before[order[0]] = -1
    # bytes from each place to its text's border
    borders = np.flatnonzero(s == 0)
    left = borders[np.searchsorted(borders, np.arange(n))] - np.arange(n)
    # a common prefix is one shorter than that of the place before, unless the bytes before differ: then it is irreducible
    i = np.arange(n)
    reducible = (i > 0) & (before > 0)
    reducible[reducible] = (s[i[reducible] - 1] == s[before[reducible] - 1]) & (s[i[reducible] - 1] > 0)
    own = np.flatnonzero(~reducible & (before >= 0))
    words = _words((s - 1).astype(np.uint8))
    most = np.minimum(left[own], left[before[own]])
    length = np.zeros(len(own), np.int64)
    open_ = np.arange(len(own))
    done = 0
    while len(open_):
        x = words[np.minimum(own[open_] + done, n - 1)] ^ words[np.minimum(before[own[open_]] + done, n - 1)]
        high = np.where(x == 0, 8, 0)
        differing = np.flatnonzero(x)
        # equal leading bytes
        high[differing] = 7 - (np.frexp(x[differing].astype(np.float64))[1] - 1) // 8
        # rounding up to a power of two moves a byte's border
        check = differing[high[differing] < 7]
        k = high[check]
        wrong = (x[check] >> ((np.uint64(7) - k.astype(np.uint64)) * np.uint64(8))) == 0
        high[check[wrong]] += 1
        length[open_] = np.minimum(done + high, most[open_])
        done += 8
        open_ = open_[(high == 8) & (most[open_] > done)]
    last = np.full(n, -1, np.int64)
    last[own] = own
    last[before < 0] = np.flatnonzero(before < 0)
    last = np.maximum.accumulate(last)
    held = np.zeros(n, np.int64)
    held[own] = length
    common = held[last] - (i - last)
    long = np.flatnonzero((common >= width) & (before >= 0))
    hit = np.zeros(n, bool)
    hit[long] = True
    hit[before[long]] = True
    at = np.r_[0, borders + 1]
    return [hit[a : a + max(0, len(t) - width + 1)] for a, t in zip(at, texts)]


# --- anchors -------------------------------------------------------------------------------------------------------


def string_hashes(data: bytes, size: int = ANCHOR) -> np.ndarray:
    """The hash of each string of `size` bytes."""
    n = len(data)
    if not _powers or len(_powers[0]) <= n:
        _powers[:] = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            step = np.full(max(n + 1, BLOCK + WIDTH), base, np.uint64)
            step[0] = 1
            _powers.append(np.cumprod(step))
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)) * _powers[0][:n], out=total[1:])
    h = (total[size:] - total[:-size]) * _powers[1][: n - size + 1]
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29))


def _least(keys: np.ndarray, reach: int) -> np.ndarray:
    """The least of each `reach` adjacent keys."""
    n = len(keys)
    blocks = -(-n // reach)
    wide = np.full(blocks * reach, np.iinfo(np.uint64).max, np.uint64)
    wide[:n] = keys
    wide = wide.reshape(blocks, reach)
    ahead = np.minimum.accumulate(wide, 1).ravel()
    behind = np.minimum.accumulate(wide[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[: n - reach + 1], ahead[reach - 1 : n])


def segments(data: bytes, width: int, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the runs of window starts with one anchor, and the anchors' hashes."""
    anchor = min(ANCHOR, width)
    h = string_hashes(data, anchor)
    place_bits = np.uint64(21)
    mask = (np.uint64(1) << place_bits) - np.uint64(1)
    keys = (h >> np.uint64(1)) & ~mask | np.arange(len(h), dtype=np.uint64)
    keys |= frequent[(h % np.uint64(BUCKETS)).astype(np.int64)].astype(np.uint64) << np.uint64(63)
    place = (_least(keys, width - anchor + 1) & mask).astype(np.int64)
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    return first, np.r_[first[1:], len(place)], h[place[first]]


def _blocks(data: bytes, width: int, frequent: np.ndarray, block: int) -> Iterator[tuple]:
    """base, bytes, and the segments of each block of a text."""
    for base in range(0, max(0, len(data) - width + 1), block):
        part = data[base : base + block + width - 1]
        yield base, part, *segments(part, width, frequent)


def _batch(names: str, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns), names=names.split())


def _frequent(rows: DataFrame, width: int) -> np.ndarray:
    """Which buckets of strings hold frequent ones; every position of every text is counted."""
    anchor = min(ANCHOR, width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in batch.column(0):
                data = text.as_py()
                for base in range(0, max(0, len(data) - anchor + 1), BLOCK):
                    h = string_hashes(data[base : base + BLOCK + anchor - 1], anchor)
                    np.add.at(counts, (h % np.uint64(BUCKETS)).astype(np.int64), 1)
        many = np.flatnonzero(counts >= max(8, counts.sum() * FREQUENT_SHARE / 4))
        yield _batch("bucket n", pa.array(many), pa.array(counts[many]))

    counts = rows.select("data").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT)
    total = rows.agg(F.sum(F.greatest(F.lit(0), F.length("data") - (anchor - 1)))).first()[0] or 0
    out = np.zeros(BUCKETS, bool)
    # at most 1 / FREQUENT_SHARE buckets
    out[[r["bucket"] for r in counts.where(F.col("n") >= total * FREQUENT_SHARE).collect()]] = True
    return out


# --- the corpus ----------------------------------------------------------------------------------------------------

#: What is known of a segment: all of its windows repeat; it is compared; others are compared with it, too.
ALL, COMPARED, SHOWN = 1, 2, 3


def _digest(segment: bytes) -> int:
    return xxhash.xxh3_64_intdigest(segment)


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal keys, and the end."""
    n = len(keys[0])
    new = np.zeros(max(0, n - 1), bool)
    for k in keys:
        new |= k[1:] != k[:-1]
    return np.r_[0, np.flatnonzero(new) + 1, n] if n else np.zeros(1, np.int64)


def _dealt(part: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
    """The part and the bytes of the columns, for each part that occurs."""
    order = np.argsort(part, kind="stable")
    part, columns = part[order], [c[order] for c in columns]
    at = _runs(part)
    for a, b in zip(at[:-1], at[1:]):
        yield int(part[a]), *(c[a:b].tobytes() for c in columns)


def _spread(rid: np.ndarray, parts: int) -> np.ndarray:
    return ((rid.astype(np.uint64) * _MIX >> np.uint64(33)) % np.uint64(parts)).astype(np.int32)


_BLOBS = "part int, kind int, anchors binary, digests binary, rids binary"


def _marks(rows: DataFrame, width: int, frequent, parts: int, block: int) -> DataFrame:
    """rid, digests, flags, shown: what is known of segments of each document that has any to know of."""

    def blobs(kind: int, part: np.ndarray, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
        found = list(_dealt(part, *columns))
        for k in range(0, len(found), 512):
            p, a, d, r = zip(*found[k : k + 512])
            yield _batch("part kind anchors digests rids", pa.array(p, pa.int32()), pa.array([kind] * len(p), pa.int32()), *(pa.array(c, pa.binary()) for c in (a, d, r)))

    def posted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = np.unpackbits(frequent.value).astype(bool)
        for whole in batches:
            for k in range(0, whole.num_rows, 2048):
                anchors, digests, rids = [np.zeros(0, np.uint64)], [], [np.zeros(0, np.int64)]
                for rid, text in zip(*(c.to_pylist() for c in whole.slice(k, 2048).columns)):
                    for _, part, first, last, keys in _blocks(text, width, often, block):
                        anchors.append(keys)
                        digests += [_digest(part[a : b + width - 1]) for a, b in zip(first.tolist(), last.tolist())]
                        rids.append(np.full(len(keys), rid))
                a, d, r = np.concatenate(anchors), np.array(digests, np.uint64), np.concatenate(rids)
                order = np.lexsort((r, d, a))
                a, d, r = a[order], d[order], r[order]
                at = _runs(a, d)
                times = np.repeat(np.diff(at), np.diff(at))
                # what is here twice is known here; one posting tells others of it, with the complement of a document's number
                yield from blobs(1, _spread(r[times > 1], parts), np.full(int((times > 1).sum()), ALL, np.uint64), d[times > 1], r[times > 1])
                one = at[:-1]
                a, d, r = a[one], d[one], np.where(times[one] > 1, ~r[one], r[one])
                yield from blobs(0, (a % np.uint64(parts)).astype(np.int32), a, d, r)

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
        held: dict[int, list[list[bytes]]] = {0: [[], [], []], 1: [[], [], []]}
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(1, 5))):
                for into, data in zip(held[row[0]], row[1:]):
                    into.append(data)
        for kind in (0, 1):
            yield [np.frombuffer(b"".join(x), t) for x, t in zip(held[kind], ("<u8", "<u8", "<i8"))]

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (a, d, r), known = gathered(batches)
        order = np.lexsort((r, d, a))
        a, d, r = a[order], d[order], r[order]
        at = _runs(a, d)
        number = np.repeat(np.arange(len(at) - 1), np.diff(at))  # of the distinct segment of each posting
        times = np.bincount(number, np.where(r < 0, 2, 1), len(at) - 1) if len(a) else np.zeros(0)
        one = at[:-1]
        of = _runs(a[one])
        others = np.repeat(np.diff(of), np.diff(of)) > 1  # the anchor has other segments
        whole = (times[number] > 1) & (r >= 0)
        rep = np.where(r[one] < 0, ~r[one], r[one])
        flags = np.concatenate([known[0], np.full(int(whole.sum()), ALL, np.uint64), np.where(times[others] > 1, SHOWN, COMPARED).astype(np.uint64)])
        digests = np.concatenate([known[1], d[whole], d[one][others]])
        rids = np.concatenate([known[2], r[whole], rep[others]])
        yield from blobs(1, _spread(rids, parts), flags, digests, rids)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, (f, d, r) = gathered(batches)
        order = np.lexsort((f, d, r))
        f, d, r = f[order], d[order], r[order]
        at = _runs(r)
        for k in range(0, len(at) - 1, 2048):
            mine = at[k : k + 2049].tolist()
            pairs = list(zip(mine[:-1], mine[1:]))
            yield _batch("rid digests flags shown", pa.array(r[mine[:-1]]), pa.array([d[x:y].tobytes() for x, y in pairs], pa.binary()), pa.array([f[x:y].astype(np.uint8).tobytes() for x, y in pairs], pa.binary()), pa.array([bool((f[x:y] > ALL).any()) for x, y in pairs]))

    posts = rows.select("rid", "data").mapInArrow(posted, _BLOBS).repartitionById(parts, F.col("part"))
    known = posts.mapInArrow(compared, _BLOBS).repartitionById(parts, F.col("part"))
    return known.mapInArrow(listed, "rid long, digests binary, flags binary, shown boolean")


def _hits(rows: DataFrame, marks: DataFrame, width: int, frequent, block: int) -> DataFrame:
    """rid, digest, hits: of the compared segments, which windows start elsewhere, one byte each; those without any are left out."""

    def shown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = np.unpackbits(frequent.value).astype(bool)
        for whole in batches:
            for batch in (whole.slice(k, 256) for k in range(0, whole.num_rows, 256)):
                out: list[tuple] = []
                for rid, text, digests, flags in zip(*(c.to_pylist() for c in batch.columns)):
                    wanted = {d: f for d, f in zip(np.frombuffer(digests, "<u8").tolist(), flags) if f > ALL}
                    for _, part, first, last, keys in _blocks(text, width, often, block):
                        for a, b, key in zip(first.tolist(), last.tolist(), keys.view(np.int64).tolist()):
                            segment = part[a : b + width - 1]
                            if flag := wanted.pop(_digest(segment), None):
                                out.append((key, rid, flag == COMPARED, segment))
                columns = list(zip(*out)) if out else [()] * 4
                yield _batch("anchor rid compared segment", *(pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.bool_(), pa.binary()))))

    def sorted_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows come sorted by anchor; a shard ends between anchors
        held: list[tuple] = []
        size, last = 0, None

        def shard() -> pa.RecordBatch:
            found = [(r[1], _digest(r[3]), h.tobytes()) for r, h in zip(held, repeated_starts([r[3] for r in held], width)) if r[2] and h.any()] if held else []
            columns = list(zip(*found)) if found else [()] * 3
            return _batch("rid digest hits", pa.array(columns[0], pa.int64()), pa.array(np.array(columns[1], np.uint64).view(np.int64)), pa.array(columns[2], pa.binary()))

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[0] != last and size >= SHARD_BYTES:
                    yield shard()
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
                last = row[0]
        yield shard()

    found = rows.select("rid", "data").join(marks.where("shown").select("rid", "digests", "flags"), "rid").mapInArrow(shown, "anchor long, rid long, compared boolean, segment binary")
    return found.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(sorted_, "rid long, digest long, hits binary")


def spans(data: bytes, digests: bytes | None, flags: bytes | None, hits: list | None, width: int, often: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Which bytes of a text go."""
    edge = np.zeros(len(data) + 1, np.int32)
    known = {d for d, f in zip(np.frombuffer(digests or b"", "<u8").tolist(), flags or b"") if f == ALL}
    some = {h["digest"] & (2**64 - 1): np.frombuffer(h["hits"], bool) for h in hits or ()}
    for base, part, first, last, _ in _blocks(data, width, often, block) if known or some else ():
        for a, b in zip(first.tolist(), last.tolist()):
            digest = _digest(part[a : b + width - 1])
            if digest in known:
                edge[base + a] += 1
                edge[base + b + width - 1] -= 1
            elif digest in some:
                at = np.flatnonzero(some[digest]) + base + a
                np.add.at(edge, at, 1)
                np.add.at(edge, at + width, -1)
    return np.cumsum(edge[:-1]) > 0


def marked(docs: DataFrame, width: int, scratch: Scratch, block: int) -> tuple[DataFrame, object]:
    """doc_id, data (bytes), digests, flags, hits of each document of docs, and the broadcast buckets of frequent strings."""
    spark = docs.sparkSession
    data = F.encode(F.coalesce(F.col("text"), F.lit("")), "utf-8")
    rows = scratch.stored(docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), data.alias("data")))
    frequent = spark.sparkContext.broadcast(np.packbits(_frequent(rows, width)))
    size = rows.agg(F.sum(F.length("data"))).first()[0] or 0
    parts = max(partitions(spark), size // 40 // TASK_POSTINGS)
    marks = scratch.stored(_marks(rows, width, frequent, parts, block))
    hits = scratch.stored(_hits(rows, marks, width, frequent, block))
    found = hits.groupBy("rid").agg(F.collect_list(F.struct("digest", "hits")).alias("hits"))
    both = marks.drop("shown").join(found, "rid", "full")
    return rows.join(both, "rid", "left").select("doc_id", "data", "digests", "flags", "hits"), frequent


def digests(docs: DataFrame, width: int = WIDTH, block: int = BLOCK) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document of docs: doc_id, text."""
    with Scratch(docs.sparkSession) as scratch:
        rows, frequent = marked(docs, width, scratch, block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            often = np.unpackbits(frequent.value).astype(bool)
            for whole in batches:
                for batch in (whole.slice(k, 256) for k in range(0, whole.num_rows, 256)):
                    found = []
                    for data, *known in zip(*(batch.column(k).to_pylist() for k in range(1, 5))):
                        gone = spans(data, *known, width, often, block)
                        rest = np.frombuffer(data, np.uint8)[~gone].tobytes()
                        found.append((len(data), int(gone.sum()), int(np.count_nonzero(gone & ~np.r_[False, gone[:-1]])), hashlib.sha256(rest).hexdigest()))
                    columns = list(zip(*found)) or [()] * 4
                    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
                    yield _batch("doc_id n_bytes n_removed n_spans kept_sha256", batch.column(0), *(pa.array(c, t) for c, t in zip(columns, kinds)))

        return stored(rows.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"))


def without_repeats(docs: DataFrame, width: int = WIDTH, block: int = BLOCK) -> DataFrame:
    """doc_id and the remaining bytes of each document (a span may begin or end inside a character)."""
    with Scratch(docs.sparkSession) as scratch:
        rows, frequent = marked(docs, width, scratch, block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            often = np.unpackbits(frequent.value).astype(bool)
            for batch in batches:
                rest = [np.frombuffer(data, np.uint8)[~spans(data, *known, width, often, block)].tobytes() for data, *known in zip(*(batch.column(k).to_pylist() for k in range(1, 5)))]
                yield _batch("doc_id kept", batch.column(0), pa.array(rest, pa.binary()))

        return stored(rows.mapInArrow(run, "doc_id long, kept binary"))
