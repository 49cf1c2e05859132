"""N-gram Jaccard join over a token-group matrix.

Tokens are 64-bit hashes of word shingles; equal sets are one set, named by 128 bits. Of a set of n tokens the least
n - ceil(t * n) + l(n) are its prefix (t the threshold, the order that of the values). The prefixes of two linked sets hold
their least min(l(n), l(m)) common tokens both, whatever l is, and it only grows with n here. So:

1. Matrix. These tokens of every set are counted over the whole corpus. A set that shares fewer of them with other sets
   than any partner would is linked with nothing: nearly all documents that are no near copies end here, and only hashes were moved.
2. Groups. What is left is partitioned: sets that share two minimum hashes meet, and each joins the first leader it is
   similar enough to, so a group is always one component. A group stores the union of its tokens and a bit matrix that
   says which member has which of them.
3. Candidates. A set's shared tokens without as many of the commonest ones as any partner shares, less one, hold one of
   every partner's. Groups that share such a token are paired with one common centre for each token first, the largest
   group; what that connects is one component and is never paired again, so a cluster of near copies costs a pair for each
   group. Of all other groups with a common token every pair whose
   sizes and token bitmaps leave room for a link is a candidate.
4. Opening. Of a candidate pair, members whose overlap with the other group's union is below t of their own size are
   skipped; if any are left, the bit matrices are multiplied, which gives the exact overlaps.

Sizes: tokens with a large share of all occurrences are found in counts of fixed size, which every document enters; they
are known to be shared and are dealt by set instead of by token, so no token is hot. Groups are closed at `group_cells`
cells and meeting places are dealt into parts of `PLACE_SETS` sets, which makes more groups but loses no link. Components
are found by alternating star contraction on group edges. Everything stored on the way is removed at the end.

Defined cases: null and empty texts, and texts without words, have the empty set and are linked with nothing; fewer words
than a shingle are one token; rows with equal ids are each returned; null ids take part, and a component's id is the
smallest id that is not null; an empty table gives an empty result; other columns are ignored or carried along.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomlake.llm.common import Scratch, fresh, n_words, partitions, stored

SHINGLE = 5
#: Links are pairs with 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Buckets of the counts that find hot tokens, and the occurrences from which a bucket is hot: this many and this share.
BUCKETS = 1 << 20
HOT_ROWS = 10_000
HOT_SHARE = 1 / (1 << 15)
#: A group is closed at this many cells of its bit matrix; a meeting place is dealt into parts of about this many sets.
GROUP_CELLS = 250_000
#: Groups that a Python worker gets at once.
GROUP_ROWS = 128
#: Texts that a Python worker gets at once.
TEXT_ROWS = 2_000
PLACE_SETS = 2_000
#: Postings that one task of the matrix sorts.
TASK_POSTINGS = 4_000_000
#: Rounds in which groups meet a centre before all remaining pairs are made.
CENTRE_ROUNDS = 3

_ODD = [np.uint64(v | 1) for v in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
_BASE = 0x2545F4914F6CDD1D
_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
#: Bytes of text that are hashed at once.
_BLOCK = 1 << 18
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A fixed permutation of 64-bit numbers."""
    x = x ^ np.uint64(salt)
    x = (x ^ (x >> np.uint64(32))) * _ODD[3]
    x = (x ^ (x >> np.uint64(29))) * _ODD[0]
    return x ^ (x >> np.uint64(32))


def _power(n: int) -> list[np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2 ** 64."""
    if len(_powers[0]) < n:
        size = max(n, _BLOCK + 1)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            step = np.full(size, base, np.uint64)
            step[0] = 1
            _powers[k] = np.cumprod(step)
    return _powers


def _word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The starts and hashes of the words of data."""
    b = np.frombuffer(data, np.uint8)
    blank = np.concatenate([[True], _BLANK[b], [True]])
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    starts, ends = edges[0::2], edges[1::2]
    up, down = _power(len(b) + 1)
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[: len(b)], out=total[1:])
    return starts, mixed((total[ends] - total[starts]) * down[starts])


def token_sets(texts: list[str | None], n: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct tokens of each text."""
    out: list[np.ndarray] = []
    block: list[bytes] = []
    size = 0
    for text in texts:
        block.append((text or "").encode("utf-8", "surrogatepass").lower())
        size += len(block[-1]) + 1
        if size >= _BLOCK:
            out += _block_sets(block, n)
            block, size = [], 0
    return out + _block_sets(block, n)


def _block_sets(block: list[bytes], n: int) -> list[np.ndarray]:
    if not block:
        return []
    starts, h = _word_hashes(b"\n".join(block))
    first = np.searchsorted(starts, np.cumsum([0] + [len(x) + 1 for x in block]))
    salts = [_ODD[k % 5] + np.uint64(2 * (k // 5)) for k in range(n)]
    rolled = np.zeros(max(0, len(h) - n + 1), np.uint64)
    for k in range(n):
        rolled += h[k : k + len(rolled)] * salts[k]
    rolled = mixed(rolled, 1)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= n:
            out.append(np.unique(rolled[a : b - n + 1]))
        elif b > a:
            few = sum((h[a + k : a + k + 1] * salts[k] for k in range(b - a)), np.array([b - a], np.uint64))
            out.append(mixed(few, 2))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def extra(n):
    """l(n): how many tokens more than needed a prefix has; more of them select better, fewer of them move less."""
    return max(1, n // 2) if n <= 128 else max(64, n // 20)


def least_shared(n: int, percent: int = PERCENT) -> int:
    """How many tokens of its prefix a set of n tokens shares with any partner's prefix, at least."""
    return extra(ceil(n * percent / 100))


def prefix(t: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The least tokens of a set, which hold all that are compared in the matrix."""
    return t[: len(t) - ceil(len(t) * percent / 100) + extra(len(t))]


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether two sorted sets link."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(a) + len(b) - both)


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal keys, and the end."""
    n = len(keys[0])
    new = np.zeros(max(0, n - 1), bool)
    for k in keys:
        new |= k[1:] != k[:-1]
    return np.r_[0, np.flatnonzero(new) + 1, n] if n else np.zeros(1, np.int64)


def _batch(names: str, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns), names=names.split())


_SETS = "doc_id long, hash long, n long, sid long, sid2 long, place long, text string, bucket long"


def _sets(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """A row for each document: its key, size and set's name; the text where the task has not had the set before.

    Rows with a bucket hold counts of tokens instead (n): those of the task that could be hot.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        had, counts = set(), np.zeros(BUCKETS, np.int64)
        names = "doc_id hash n sid sid2 place text bucket"
        for whole in batches:
            for k in range(0, whole.num_rows, 512):
                part = whole.slice(k, 512)
                texts = part.column(2).to_pylist()
                found, name, place = token_sets(texts, n), [], []
                for j, t in enumerate(found):
                    if not len(t):
                        name.append((None, None))
                        place.append(None)
                        texts[j] = None
                        continue
                    digest = xxhash.xxh3_128_digest(t.tobytes())
                    name.append(tuple(np.frombuffer(digest, "<i8").tolist()))
                    place.append(int((mixed(t, 1).min() ^ mixed(mixed(t, 2).min(keepdims=True), 3)[0]).astype(np.int64)))
                    if digest in had:
                        texts[j] = None
                    else:
                        if len(had) < 1_000_000:
                            had.add(digest)
                        np.add.at(counts, (prefix(t, percent) % np.uint64(BUCKETS)).astype(np.int64), 1)
                long = lambda v: pa.array(v, pa.int64())
                yield _batch(names, part.column(0), part.column(1), long([len(t) for t in found]), long([x for x, _ in name]), long([y for _, y in name]), long(place), pa.array(texts, pa.string()), pa.nulls(len(found), pa.int64()))
        many = np.flatnonzero(counts >= max(8, counts.sum() * HOT_SHARE / 4))
        none = pa.nulls(len(many), pa.int64())
        yield _batch(names, none, none, pa.array(counts[many]), none, none, none, pa.nulls(len(many), pa.string()), pa.array(many))

    return docs.mapInArrow(run, _SETS)


def _dealt(part: np.ndarray, *columns: np.ndarray):
    """The part and the bytes of the columns, for each part that occurs."""
    order = np.argsort(part, kind="stable")
    part, columns = part[order], [c[order] for c in columns]
    at = _runs(part)
    for a, b in zip(at[:-1], at[1:]):
        yield int(part[a]), *(c[a:b].tobytes() for c in columns)


def _shared(firsts: DataFrame, hot: np.ndarray, parts: int, n: int, percent: int) -> DataFrame:
    """sid, k, tokens: the tokens of each set's prefix that other sets have in theirs, rarest first; sets without are left out."""
    held = firsts.sparkSession.sparkContext.broadcast(np.packbits(hot > 0)), firsts.sparkSession.sparkContext.broadcast(dict(zip(np.flatnonzero(hot).tolist(), hot[hot > 0].tolist())))

    def posted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_hot, names = np.unpackbits(held[0].value).astype(bool), "part kind tokens sids"
        for whole in batches:
            for k in range(0, whole.num_rows, 4096):
                rows = whole.slice(k, 4096)
                heads = [prefix(t, percent) for t in token_sets(rows.column(1).to_pylist(), n)]
                tokens = np.concatenate(heads)
                sids = np.repeat(rows.column(0).to_numpy(), [len(t) for t in heads])
                known = is_hot[(tokens % np.uint64(BUCKETS)).astype(np.int64)]
                out: list[tuple] = []
                for kind, chosen in ((0, ~known), (1, known)):
                    t, s = tokens[chosen], sids[chosen]
                    # hot tokens are dealt by their sets
                    part = (t >> np.uint64(20)) % np.uint64(parts) if kind == 0 else mixed(s.view(np.uint64), 5) % np.uint64(parts)
                    out += [(p, kind, a, b) for p, a, b in _dealt(part.astype(np.int32), t, s)]
                columns = list(zip(*out)) if out else [()] * 4
                yield _batch(names, pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.binary()), pa.array(columns[3], pa.binary()))

    def gathered(batches: Iterator[pa.RecordBatch], names: str, kinds: list) -> list[np.ndarray]:
        parts_of = [[] for _ in kinds]
        for batch in batches:
            for into, name in zip(parts_of, names.split()):
                into += [x for x in batch.column(name).to_pylist()]
        return [np.frombuffer(b"".join(x), kind) for x, kind in zip(parts_of, kinds)]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import itertools

        usual, bulk = [], []
        for batch in batches:
            kind = batch.column("kind").to_numpy()
            for k, into in ((0, usual), (1, bulk)):
                into.append(batch.filter(pa.array(kind == k)))
        t, s = gathered(usual, "tokens sids", ["<u8", "<i8"])
        order = np.lexsort((s, t))
        t, s = t[order], s[order]
        one = _runs(t, s)[:-1]  # a set that several tasks have had counts once
        t, s = t[one], s[one]
        at = _runs(t)
        freq = np.repeat(np.diff(at), np.diff(at))
        more = freq > 1
        t, s, freq = t[more], s[more], freq[more]
        ht, hs = gathered(bulk, "tokens sids", ["<u8", "<i8"])
        hf = np.array([held[1].value[b] for b in (ht % np.uint64(BUCKETS)).tolist()], np.int64)
        t, s, freq = np.concatenate([t, ht]), np.concatenate([s, hs]), np.concatenate([freq, hf])
        part = (mixed(s.view(np.uint64), 5) % np.uint64(parts)).astype(np.int32)
        for some in itertools.batched(_dealt(part, t, s, freq), 1024):
            columns = list(zip(*some))
            yield _batch("part tokens sids freqs", pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:]))

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, s, freq = gathered(batches, "tokens sids freqs", ["<u8", "<i8", "<i8"])
        order = np.lexsort((t, freq, s))
        t, s, freq = t[order], s[order], freq[order]
        one = _runs(s, freq, t)[:-1]
        t, s = t[one], s[one]
        at = _runs(s)
        for k in range(0, len(at) - 1, 4096):
            mine = at[k : k + 4097]
            lists = [t[a:b].tobytes() for a, b in zip(mine[:-1], mine[1:])]
            yield _batch("sid k tokens", pa.array(s[mine[:-1]]), pa.array(np.diff(mine)), pa.array(lists, pa.binary()))

    posts = firsts.select("sid", "text").mapInArrow(posted, "part int, kind int, tokens binary, sids binary")
    found = posts.repartitionById(parts, F.col("part")).mapInArrow(counted, "part int, tokens binary, sids binary, freqs binary")
    return found.repartitionById(parts, F.col("part")).mapInArrow(listed, "sid long, k long, tokens binary")


_GROUPS = "sids array<long>, sids2 array<long>, sizes array<int>, tokens binary, bits binary, posts binary"


def _groups(sets: DataFrame, scratch: Scratch, n: int, percent: int) -> DataFrame:
    """A row for each group of sets (sid, sid2, place, posts, text): members, union, bit matrix; the first member leads."""

    def group(found: dict) -> list[list]:
        """The most typical sets, whose tokens most other sets here have, lead."""
        if not found:
            return []
        if len(found) == 1:
            ((name, (t, posts)),) = found.items()
            return [[t, len(t), [(name, t, posts)]]]
        sets = list(found.items())
        known, at, counts = np.unique(np.concatenate([t for _, (t, _) in sets]), return_inverse=True, return_counts=True)
        del known
        ends = np.cumsum([len(t) for _, (t, _) in sets])
        typical = np.add.reduceat(counts[at], np.r_[0, ends[:-1]]) / np.diff(np.r_[0, ends])
        groups: list[list] = []  # leader, union's size, members: name, tokens, posts
        for k in sorted(range(len(sets)), key=lambda k: (-typical[k], sets[k][0])):
            name, (t, posts) = sets[k]
            fits = lambda g: (len(g[2]) + 1) * (g[1] + len(t)) <= GROUP_CELLS and linked(g[0], t, percent)
            home = next(filter(fits, groups), None)
            if home is None:
                groups.append([t, len(t), [(name, t, posts)]])
            else:
                home[1] += len(t) - len(np.intersect1d(home[0], t, assume_unique=True))
                home[2].append((name, t, posts))
        return groups

    def row(g: list) -> tuple:
        names, sets, posts = zip(*g[2])
        union = np.unique(np.concatenate(sets))
        bits = np.zeros((len(sets), len(union)), bool)
        for k, t in enumerate(sets):
            bits[k, np.searchsorted(union, t)] = True
        return [x for x, _ in names], [y for _, y in names], [len(t) for t in sets], union.tobytes(), np.packbits(bits, 1).tobytes(), np.unique(np.concatenate(posts)).tobytes()

    def batch_of(groups: list[list]) -> pa.RecordBatch:
        columns = list(zip(*map(row, groups))) if groups else [()] * 6
        kinds = [pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.binary()]
        return _batch("sids sids2 sizes tokens bits posts", *(pa.array(c, k) for c, k in zip(columns, kinds)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows come sorted by place and part, so a place's part is a run of rows
        key, found, done = None, {}, []
        for whole in batches:
            for k in range(0, whole.num_rows, 512):
                batch = whole.slice(k, 512)
                sid, sid2, place, part, posts, texts = (c.to_pylist() for c in batch.columns)
                for a, b, here, t in zip(zip(sid, sid2), zip(place, part), posts, token_sets(texts, n)):
                    if b != key:
                        done += group(found)
                        key, found = b, {}
                        if sum(g[1] for g in done) > 1_000_000:
                            yield batch_of(done)
                            done = []
                    found[a] = t, np.frombuffer(here, np.uint64)
        yield batch_of(done + group(found))

    busy = scratch.stored(sets.groupBy("place").agg(F.count("*").alias("here")).where(F.col("here") > PLACE_SETS))
    dealt = sets.join(busy, "place", "left").withColumn("part", F.pmod("sid", F.coalesce(F.ceil(F.col("here") / PLACE_SETS), F.lit(1))))
    return dealt.select("sid", "sid2", "place", "part", "posts", "text").repartition("place", "part").sortWithinPartitions("place", "part").mapInArrow(run, _GROUPS)


def _bitmap(tokens: np.ndarray, bits: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bitmaps of the buckets of tokens that all members have a token in, and that any member has."""
    at = (mixed(tokens, 7) % np.uint64(size)).astype(np.int64)
    cells = np.zeros((len(bits), size), bool)
    member, column = np.nonzero(bits)
    cells[member, at[column]] = True
    return np.packbits(cells.all(0)), np.packbits(cells.any(0))


def _matrix(sizes: list[int], tokens: bytes, bits: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    union = np.frombuffer(tokens, np.uint64)
    packed = np.frombuffer(bits, np.uint8).reshape(len(sizes), -1)
    return np.array(sizes), union, np.unpackbits(packed, axis=1, count=len(union)).astype(bool)


_POSTS = "token long, gid long, members int, least int, most int, every binary, some binary"


def _posts(groups: DataFrame) -> DataFrame:
    """A row for each of a group's tokens of which every partner has one, with the group's sizes and bitmaps of 512 bits.

    `some` is null where it is the same as `every`, as in groups of one set.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(k, 256) for k in range(0, whole.num_rows, 256)):
                columns: list[list] = [[] for _ in range(6)]
                posts = [np.frombuffer(x, np.int64) for x in batch.column("posts").to_pylist()]
                for gid, sizes, tokens, bits in zip(*(batch.column(c).to_pylist() for c in ("gid", "sizes", "tokens", "bits"))):
                    every, some = (x.tobytes() for x in _bitmap(*_matrix(sizes, tokens, bits)[1:], 512))
                    for c, v in zip(columns, (gid, len(sizes), min(sizes), max(sizes), every, None if some == every else some)):
                        c.append(v)
                kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
                at = pa.array(np.repeat(np.arange(len(posts)), [len(p) for p in posts]))
                yield _batch("token gid members least most every some", pa.array(np.concatenate(posts)), *(pa.array(c, k).take(at) for c, k in zip(columns, kinds)))

    return groups.select("gid", "sizes", "tokens", "bits", "posts").mapInArrow(run, _POSTS)


def _labelled(posts: DataFrame, known: DataFrame | None) -> DataFrame:
    """posts with the component that each group is known to be in."""
    rows = posts.withColumn("label", F.col("gid")) if known is None else posts.join(known.select(F.col("node").alias("gid"), F.col("label").alias("__l")), "gid", "left").withColumn("label", F.coalesce("__l", "gid")).drop("__l")
    return rows


#: Pairs of groups that a task counts before it hands them on.
PAIRS_HELD = 500_000


def _centred(rows: DataFrame) -> DataFrame:
    """a, b: for each group b the centre a it shares the most tokens with; a token's centre is the largest group that has it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = (None, 0, 0)
        held, counts, fresh_pairs = np.empty((2, 0), np.int64), np.empty(0, np.int64), []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            every = np.concatenate([held, *[p for p, _ in fresh_pairs]], 1)
            pairs, at = np.unique(every, axis=1, return_inverse=True)
            return pairs, np.bincount(at.reshape(-1), np.concatenate([counts, *[n for _, n in fresh_pairs]]), pairs.shape[1]).astype(np.int64)

        for batch in batches:
            token, label, gid = (batch.column(k).to_numpy() for k in range(3))
            if not len(token):
                continue
            start = np.maximum.accumulate(np.where(np.r_[token[0] != last[0], token[1:] != token[:-1]], np.arange(len(token)), -1))
            centre = np.where(start < 0, last[1], gid[start])
            home = np.where(start < 0, last[2], label[start])
            last = token[-1], centre[-1], home[-1]
            apart = home != label
            fresh_pairs.append(np.unique(np.stack([centre[apart], gid[apart]]), axis=1, return_counts=True))
            # a pair that shares many tokens of this task leaves it as one row
            if sum(len(n) for _, n in fresh_pairs) > PAIRS_HELD:
                held, counts = merged()
                fresh_pairs = []
                if len(counts) > PAIRS_HELD:
                    yield _batch("a b n", pa.array(held[0]), pa.array(held[1]), pa.array(counts))
                    held, counts = held[:, :0], counts[:0]
        held, counts = merged()
        if len(counts):
            yield _batch("a b n", pa.array(held[0]), pa.array(held[1]), pa.array(counts))

    rows = rows.select("token", "label", "gid", "members").repartition("token").sortWithinPartitions("token", F.desc("members"), "gid")
    pairs = rows.select("token", "label", "gid").mapInArrow(run, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
    return pairs.groupBy("b").agg(F.max(F.struct("n", "a"))["a"].alias("a")).select("a", "b")


def _possible(rows: DataFrame, percent: int, parts: int) -> DataFrame:
    """a, b: all pairs of groups of two components that share a token and that sizes and bitmaps leave room for a link."""
    t = percent / 100

    def pairs_of(label: np.ndarray, gid: np.ndarray, least: np.ndarray, most: np.ndarray, every: np.ndarray, some: np.ndarray) -> Iterator[np.ndarray]:
        for i in range(len(gid) - 1):
            there = int(np.searchsorted(label, label[i], "right"))
            there += np.flatnonzero((most[there:] >= t * least[i] - 1e-6) & (most[i] >= t * least[there:] - 1e-6))
            # what all members of one have and no member of the other has
            lost = np.bitwise_count(every[i] & ~some[there]).sum(-1, dtype=np.int64)
            there = there[lost * (1 + t) <= most[i] - t * least[there] + 1e-6]
            lost = np.bitwise_count(every[there] & ~some[i]).sum(-1, dtype=np.int64)
            there = there[lost * (1 + t) <= most[there] - t * least[i] + 1e-6]
            if len(there):
                yield np.stack([np.full(len(there), gid[i]), gid[there]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None  # rows of the last token so far
        out: list[np.ndarray] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            if out:
                a, b = np.unique(np.sort(np.concatenate(out, 1), 0), axis=1)
                part = (mixed(a.view(np.uint64), 5) % np.uint64(parts)).astype(np.int32)
                columns = list(zip(*_dealt(part, a, b)))
                yield _batch("part a b", pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.binary()))

        def runs(table: pa.Table) -> None:
            nonlocal size
            token, label, gid, least, most = (table.column(k).to_numpy() for k in range(5))
            at = _runs(token)
            at = [(x, y) for x, y in zip(at[:-1].tolist(), at[1:].tolist()) if y - x > 1 and label[x] != label[y - 1]]
            if not at:
                return
            every = table.column(5).to_pylist()
            some = [x if y is None else y for x, y in zip(every, table.column(6).to_pylist())]
            maps = [np.frombuffer(b"".join(m), np.uint64).reshape(len(token), -1) for m in (every, some)]
            for x, y in at:
                for pairs in pairs_of(*(v[x:y] for v in (label, gid, least, most, *maps))):
                    out.append(pairs)
                    size += pairs.shape[1]

        for batch in batches:
            here = pa.Table.from_batches([batch])
            held = here if held is None else pa.concat_tables([held, here])
            token = held.column(0).to_numpy()
            if not len(token) or token[0] == token[-1]:
                continue
            cut_at = int(np.searchsorted(token, token[-1]))
            runs(held.slice(0, cut_at))
            held = held.slice(cut_at)
            if size > 4_000_000:
                yield from flush()
                out, size = [], 0
        if held is not None and held.num_rows:
            runs(held)
        yield from flush()

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts_of: list[list[bytes]] = [[], []]
        for batch in batches:
            for into, name in zip(parts_of, "ab"):
                into += batch.column(name).to_pylist()
        pairs = np.unique(np.stack([np.frombuffer(b"".join(x), np.int64) for x in parts_of]), axis=1)
        for k in range(0, pairs.shape[1], 10_000):
            yield _batch("a b", pa.array(pairs[0, k : k + 10_000]), pa.array(pairs[1, k : k + 10_000]))

    ordered = rows.select("token", "label", "gid", "least", "most", "every", "some").repartition("token").sortWithinPartitions("token", "label", "gid")
    return ordered.mapInArrow(run, "part int, a binary, b binary").repartitionById(parts, F.col("part")).mapInArrow(merged, "a long, b long")


def _joined(pairs: DataFrame, side: DataFrame, scratch: Scratch) -> DataFrame:
    """pairs with the columns of both groups, those of a and then those of b."""
    names = [c for c in side.columns if c != "gid"]
    of = lambda k: side.select(F.col("gid").alias(k), *[F.col(c).alias(f"{c}_{k}") for c in names])
    return pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", *[f"{c}_a" for c in names], *[f"{c}_b" for c in names])


def _verified(pairs: DataFrame, groups: DataFrame, sketches: DataFrame, scratch: Scratch, percent: int) -> DataFrame:
    """The pairs a, b of groups between whose members there is a link."""
    t = percent / 100

    def roomy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, least_a, most_a, all_a, any_a, least_b, most_b, all_b, any_b = batch.columns
            wide = lambda c: np.frombuffer(b"".join(c.to_pylist()), np.uint8).reshape(batch.num_rows, -1)
            ok = np.ones(batch.num_rows, bool)
            for every, some, most, least in ((all_a, any_b, most_a, least_b), (all_b, any_a, most_b, least_a)):
                lost = np.bitwise_count(wide(every) & ~wide(some)).sum(1, dtype=np.int64) if batch.num_rows else np.zeros(0, np.int64)
                ok &= lost * (1 + t) <= most.to_numpy() - t * least.to_numpy() + 1e-6
            yield _batch("a b", a.filter(pa.array(ok)), b.filter(pa.array(ok)))

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 64):
                found = [(r["a"], r["b"]) for r in whole.slice(k, 64).to_pylist() if any_link(_matrix(r["sizes_a"], r["tokens_a"], r["bits_a"]), _matrix(r["sizes_b"], r["tokens_b"], r["bits_b"]), percent)]
                yield _batch("a b", pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64()))

    maybe = scratch.stored(_joined(pairs, sketches, scratch).mapInArrow(roomy, "a long, b long"))
    return _joined(maybe, groups.select("gid", "sizes", "tokens", "bits"), scratch).mapInArrow(opened, "a long, b long")


def any_link(first: tuple, second: tuple, percent: int = PERCENT) -> bool:
    """Whether a member of one group (sizes, union, bit matrix) links with a member of the other one."""
    (n, union, bits), (m, other, more) = first, second
    _, i, j = np.intersect1d(union, other, assume_unique=True, return_indices=True)
    bits, more = bits[:, i], more[:, j]
    # the overlap with the other group's union bounds that with its members
    a, b = (100 * x.sum(1) >= percent * size for x, size in ((bits, n), (more, m)))
    if not len(i) or not a.any() or not b.any():
        return False
    both = bits[a].astype(np.float32) @ more[b].astype(np.float32).T
    return bool(((both > 0) & (100 * both >= percent * (n[a][:, None] + m[b][None, :] - both))).any())


def _sketches(groups: DataFrame) -> DataFrame:
    """gid, least, most, every, some: sizes and bitmaps of 2048 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gid, sizes, tokens, bits = (c.to_pylist() for c in batch.columns)
            maps = [_bitmap(*_matrix(s, t, b)[1:], 2048) for s, t, b in zip(sizes, tokens, bits)]
            yield _batch("gid least most every some", batch.column(0), pa.array([min(s) for s in sizes], pa.int32()), pa.array([max(s) for s in sizes], pa.int32()), pa.array([x.tobytes() for x, _ in maps], pa.binary()), pa.array([y.tobytes() for _, y in maps], pa.binary()))

    return groups.select("gid", "sizes", "tokens", "bits").mapInArrow(run, "gid long, least int, most int, every binary, some binary")


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """node, label: the smallest node reachable, for every node of edges (a, b), by alternating star contraction."""
    edges = scratch.stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        both = edges.union(edges.select(F.col("b"), F.col("a")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lower, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        old, edges = edges, scratch.stored(small.where("a <> b").distinct())
        scratch.drop(old)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
        before = now


def _group_labels(groups: DataFrame, scratch: Scratch, percent: int, parts: int) -> DataFrame:
    """node, label of the groups that link with any other group."""
    posts, sketches = scratch.stored(_posts(groups), GROUP_ROWS), scratch.stored(_sketches(groups), GROUP_ROWS)
    edges = known = None
    rounds = 0
    while True:
        last = rounds >= CENTRE_ROUNDS
        rows = _labelled(posts, known)
        pairs = scratch.stored(_possible(rows, percent, parts) if last else _centred(rows))
        found = scratch.stored(_verified(pairs, groups, sketches, scratch, percent), GROUP_ROWS)
        any_yet = not found.isEmpty()
        if any_yet:
            edges = found if edges is None else edges.union(found)
            known = components(edges, scratch)
        if last:
            break
        rounds = rounds + 1 if any_yet else CENTRE_ROUNDS
    return known if known is not None else groups.sparkSession.createDataFrame([], "node long, label long")


def _least_shared(n: Column, percent: int) -> Column:
    """`least_shared` of a column."""
    m = F.expr(f"cast(ceil(n * {percent} / 100.0D) as long)") if percent != 75 else F.expr("(3 * n + 3) div 4")
    return F.when(m <= 128, F.greatest(F.lit(1), F.floor(m / 2))).otherwise(F.greatest(F.lit(64), F.floor(m / 20)))


def _classed(docs: DataFrame, scratch: Scratch, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, hash of the text, n, sid, sid2) of docs (doc_id, text), and of each set (sid, sid2) the first row of its component."""
    spark = docs.sparkSession
    every = scratch.stored(_sets(docs.selectExpr("cast(doc_id as long) doc_id", "xxhash64(text) hash", "text"), n, percent), TEXT_ROWS)
    sets = every.where("bucket IS NULL")
    firsts = sets.where("text IS NOT NULL")
    counts = every.where("bucket IS NOT NULL").groupBy("bucket").agg(F.sum("n").alias("n")).where(F.col("n") >= HOT_ROWS)
    total = firsts.agg(F.sum("n")).first()[0] or 0
    hot = np.zeros(BUCKETS, np.int64)
    # at most 4 / HOT_SHARE buckets
    for b, k in counts.where(F.col("n") >= total * (100 - percent) / 100 * HOT_SHARE).collect():
        hot[b] = k
    parts = max(partitions(spark), ceil(total * (120 - percent) / 100 / TASK_POSTINGS))
    shared = _shared(firsts, hot, parts, n, percent)
    one = firsts.select("sid", "sid2", "n", "place").dropDuplicates(["sid", "sid2"])
    left = one.join(shared, "sid").withColumn("least", _least_shared(F.col("n"), percent)).where("k >= least")
    left = scratch.stored(left.select("sid", "sid2", "place", F.expr("substring(tokens, 1, cast(8 * (k - least + 1) as int))").alias("posts")), TEXT_ROWS)
    texts = firsts.select("sid", "sid2", "text").join(left, ["sid", "sid2"])
    groups = scratch.stored(_groups(texts, scratch, n, percent).withColumn("gid", F.monotonically_increasing_id()), TEXT_ROWS)
    rows = scratch.stored(sets.select("doc_id", "hash", "n", "sid", "sid2"))
    scratch.drop(every, left)
    labels = _group_labels(groups, scratch, percent, parts)
    owners = groups.select("gid", F.explode(F.arrays_zip("sids", "sids2")).alias("s")).select("gid", F.col("s.sids").alias("sid"), F.col("s.sids2").alias("sid2"))
    owners = owners.join(labels, F.col("gid") == F.col("node"), "left").select("sid", "sid2", F.coalesce("label", "gid").alias("label"))
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash")
    by_set = rows.where("sid IS NOT NULL").groupBy("sid", "sid2").agg(F.min(first).alias("first")).join(owners, ["sid", "sid2"], "left")
    by_set = scratch.stored(by_set)
    best = scratch.stored(by_set.where("label IS NOT NULL").groupBy("label").agg(F.min("first").alias("best")))
    return rows, scratch.stored(by_set.join(best, "label", "left").select("sid", "sid2", F.coalesce("best", "first").alias("first")))


def clustered(docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id of every document of docs: doc_id, text."""
    with Scratch(docs.sparkSession) as scratch:
        rows, first = _classed(docs, scratch, n, percent)
        done = rows.join(first, ["sid", "sid2"], "left")
        return stored(done.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("sid").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("component_id")))


def representatives(docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """docs with one row of each component: one with the smallest id, or without an id if none has one.

    Rows without words are all kept. Rows are told apart by id and text, so rows that repeat an id count as any others.
    """
    with Scratch(docs.sparkSession) as scratch:
        _, first = _classed(docs, scratch, n, percent)
        name = fresh(docs, "__hash"), fresh(docs, "__id")
        kept = stored(first.select(F.col("first.doc_id").alias(name[1]), F.col("first.hash").alias(name[0])).distinct())
    rows = docs.withColumn(name[0], F.xxhash64("text"))
    same = rows[name[0]].eqNullSafe(kept[name[0]]) & rows["doc_id"].cast("long").eqNullSafe(kept[name[1]])
    chosen = rows.where(n_words(F.col("text")) > 0).join(kept, same, "left_semi").dropDuplicates(["doc_id", name[0]])
    return chosen.unionByName(rows.where(n_words(F.col("text")) == 0)).select(*docs.columns)
