"""Approximate nearest neighbours by multiprobe p-stable hashing.

Vectors are scaled by the largest norm and lifted by one coordinate to unit length, which turns the largest inner product
into the smallest distance. Each of `tables` hash tables has `width` functions floor((a.v + b) / step) with normal a; a
query visits its own bucket and `probes - 1` perturbed ones, in the order of their estimated success (perturbation sets
sorted by their expected squared distances to the bucket borders). Candidates of all tables are merged and ranked by their
exact inner products in double precision.

Parameters are fitted: for a bounded sample of queries (`sample_queries`) the true neighbours among all rows are found by a
scan, and the cheapest setting that finds `aim` of them is taken; costs are judged on a bounded sample of rows. Every row
is indexed.

Layout: equal vectors become one entry with its smallest ids (as many as a result could need), so copies cost nothing.
Entries are dealt by bucket key to parts, and a part with many entries to splits of bounded size, each of which sees the
part's queries; a task multiplies each bucket with all queries that visit it, keeps the best of each query as it goes
and sends on a short list for each query, so no row stands for a pair. Queries that found too few candidates are
answered by a scan in blocks.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components take no part, nor do those of
another dimension than the commonest one (the larger one on a tie), nor rows with a null id; rows with equal id and vector count once; a
query's candidates are all rows with another id; ties go to the smaller id; empty tables give an empty result; other
columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from loomlake.llm.common import cut, partitions


@dataclass(frozen=True)
class Settings:
    """Parameters of fit and layout."""

    aim: float = 0.97
    sample_queries: int = 48
    sample_rows: int = 4096
    split_entries: int = 100_000
    scan_queries: int = 2048
    seed: int = 20240229


@dataclass(frozen=True)
class Hashes:
    """The hash tables and the probing order."""

    scale: float
    planes: np.ndarray  # tables, width, dimension + 1
    shifts: np.ndarray  # tables, width
    step: float
    template: np.ndarray  # probes, 2 * width: members of each perturbation set by border rank
    mixers: np.ndarray  # tables, width

    def lifted(self, v: np.ndarray, query: bool) -> np.ndarray:
        v = v.astype(np.float64)
        if query:
            v = v / np.linalg.norm(v, axis=1, keepdims=True)
            return np.hstack([v, np.zeros((len(v), 1))])
        v = v / self.scale
        return np.hstack([v, np.sqrt(np.maximum(0, 1 - (v * v).sum(1, keepdims=True)))])

    def places(self, v: np.ndarray, query: bool) -> np.ndarray:
        """Real-valued bucket coordinates: tables, rows, width."""
        return (np.einsum("rd,lkd->lrk", self.lifted(v, query), self.planes) + self.shifts[:, None, :]) / self.step

    def keys(self, cells: np.ndarray) -> np.ndarray:
        """64-bit keys of integer cells (tables, ..., width)."""
        shape = (len(self.mixers),) + (1,) * (cells.ndim - 2) + (self.mixers.shape[1],)
        mixed = (cells.astype(np.int64).astype(np.uint64) * self.mixers.reshape(shape)).sum(-1, dtype=np.uint64)
        mixed ^= mixed >> np.uint64(29)
        return mixed * np.uint64(0xBF58476D1CE4E5B9)

    def steps(self, places: np.ndarray) -> np.ndarray:
        """Perturbations of each query in probing order: tables, rows, probes, width, of -1, 0 and 1."""
        inside = places - np.floor(places)
        borders = np.concatenate([inside, 1 - inside], -1)
        order = np.argsort(borders, -1, kind="stable")
        width = places.shape[-1]
        sign = np.where(order < width, -1, 1)
        out = np.zeros(places.shape[:2] + (len(self.template), width), np.int8)
        hot = (order % width)[..., None] == np.arange(width)  # tables, rows, 2 * width, width
        return np.einsum("ps,lrsk->lrpk", self.template.astype(np.int8), (hot * sign[..., None]).astype(np.int8), out=out)


def template(width: int, probes: int) -> np.ndarray:
    """The first `probes` perturbation sets over border ranks, the empty one first, by expected squared distance."""
    m = 2 * width
    rank = np.arange(1, m + 1)
    low = rank * (rank + 1) / (4 * (width + 1) * (width + 2))
    far = m + 1 - rank
    cost = np.where(rank <= width, low, 1 - far / (width + 1) + far * (far + 1) / (4 * (width + 1) * (width + 2)))
    found = [()]
    heap = [(float(cost[0]), (0,))]
    while heap and len(found) < probes:
        c, s = heapq.heappop(heap)
        if all(m - 1 - x not in s for x in s):
            found.append(s)
        last = s[-1]
        if last + 1 < m:
            heapq.heappush(heap, (c + float(cost[last + 1]), (*s, last + 1)))
            heapq.heappush(heap, (c + float(cost[last + 1] - cost[last]), (*s[:-1], last + 1)))
    out = np.zeros((len(found), m), bool)
    for k, s in enumerate(found):
        out[k, list(s)] = True
    return out


def made(dimension: int, scale: float, tables: int, width: int, step: float, probes: int, seed: int) -> Hashes:
    r = np.random.default_rng(seed)
    planes = r.normal(size=(tables, width, dimension + 1))
    shifts = r.uniform(0, step, (tables, width))
    mixers = r.integers(1, 2**62, (tables, width)).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    return Hashes(scale, planes, shifts, step, template(width, probes), mixers)


def fitted(rows: np.ndarray, queries: np.ndarray, neighbours: list[np.ndarray], scale: float, s: Settings) -> Hashes:
    """The cheapest hashes that find `aim` of the neighbours of the sample queries."""
    dimension = rows.shape[1]
    probe_counts, table_counts = (1, 8, 32, 96), (2, 4, 8)
    lift = made(dimension, scale, 1, 1, 1.0, 1, s.seed).lifted
    q, flat = lift(queries, True), np.vstack(neighbours)
    near = lift(flat, False)
    owner = np.repeat(np.arange(len(queries)), [len(n) for n in neighbours])
    typical = float(np.median(np.linalg.norm(q[owner] - near, axis=1))) or 1.0
    best = None
    for width in (3, 4, 6, 8, 10, 12):
        for factor in (1.0, 2.0, 3.5):
            h = made(dimension, scale, table_counts[-1], width, typical * factor, probe_counts[-1], s.seed)
            places = h.places(queries, True)
            code = (h.steps(places).astype(np.int64) + 1) @ (3 ** np.arange(width))  # tables, queries, probes
            base = np.floor(places)

            def ranks(cells, of):
                """Which probe of its query reaches each row, in each table; the number of probes if none does."""
                delta = cells - base[:, of]
                ok = (np.abs(delta) <= 1).all(-1)
                mine = (np.where(ok[..., None], delta, 0).astype(np.int64) + 1) @ (3 ** np.arange(width))
                hit = code[:, of] == mine[..., None]
                return np.where(ok & hit.any(-1), hit.argmax(-1), code.shape[-1])

            got = ranks(np.floor(h.places(flat, False)), owner)
            few = min(16, len(queries))
            cells = np.floor(h.places(rows[:1024], False))
            other = np.stack([ranks(cells, np.full(cells.shape[1], k)) for k in range(few)], 1)
            for tables in table_counts:
                for probes in probe_counts:
                    recall = (got[:tables] < probes).any(0).mean()
                    share = (other[:tables] < probes).any(0).mean()
                    cost = share + 2e-4 * tables + 2e-5 * tables * probes
                    key = (recall < s.aim, -recall if recall < s.aim else cost)
                    if best is None or key < best[0]:
                        best = (key, (tables, width, typical * factor, probes))
    tables, width, step, probes = best[1]
    return made(dimension, scale, tables, width, step, probes, s.seed)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding of the rows that take part."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("embedding", lambda x: x != 0)
    # vectors of floats stay floats, others are doubles: scores are exact on the original numbers
    kind = "array<float>" if dict(vectors.dtypes)["embedding"] == "array<float>" else "array<double>"
    rows = vectors.select("vec_id", F.col("embedding").cast(kind).alias("embedding")).where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(fine)
    sizes = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    return rows.where(F.size("embedding") == (sizes[0]["n"] if sizes else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of two lists of vectors, row by row, in double precision."""
    return (a.astype(np.float64) * b.astype(np.float64)).sum(-1)


def _best(ids: np.ndarray, scores: np.ndarray, n: int) -> np.ndarray:
    """Places of the n largest scores, ties to smaller ids."""
    if len(scores) > 4 * n:
        least = np.partition(scores, len(scores) - n)[len(scores) - n]
        keep = np.flatnonzero(scores >= least - 1e-9 * max(1.0, abs(least)))
    else:
        keep = np.arange(len(scores))
    return keep[np.lexsort((ids[keep], -scores[keep]))[:n]]


def _short_list(queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, places, n: int):
    """For each query the n best of its candidate places: (query place, ids, exact scores)."""
    wide = rows.astype(np.float64)
    for k, at in enumerate(places):
        if len(at):
            rough = wide[at] @ queries[k].astype(np.float64)
            top = _best(ids[at], rough, n + 8)
            exact = exact_products(rows[at[top]], queries[k])
            order = np.lexsort((ids[at[top]], -exact))[:n]
            yield k, ids[at[top]][order], exact[order]


_SHORT = "query long, found array<struct<less: double, id: long>>"


def _short_batch(parts) -> pa.RecordBatch:
    q, sizes, less, ids = [], [], [], []
    for query, i, score in parts:
        q.append(query)
        sizes.append(len(i))
        ids.append(i)
        less.append(-score)
    cat = lambda x, kind: np.concatenate(x) if x else np.empty(0, kind)
    values = pa.StructArray.from_arrays([pa.array(cat(less, "f8"), pa.float64()), pa.array(cat(ids, "i8"), pa.int64())], names=["less", "id"])
    found = pa.ListArray.from_arrays(np.cumsum([0, *sizes]).astype("i4"), values)
    return pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), found], names=["query", "found"])


def _merged(short: DataFrame, n: int) -> DataFrame:
    """query, found: the n best over all short lists of a query, each id once."""
    every = F.array_distinct(F.flatten(F.collect_list("found")))
    return short.groupBy("query").agg(F.slice(F.array_sort(every), 1, n).alias("found"))


def scanned(entries: DataFrame, ids: np.ndarray, queries: np.ndarray, n: int) -> DataFrame:
    """query, found: the n entries of largest inner product with each query, by a scan of all entries; a bounded set of queries."""
    held = entries.sparkSession.sparkContext.broadcast((ids, queries))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qi, qs = held.value
        for batch in batches:
            if batch.num_rows:
                own, rows = batch.column(0).to_numpy(), _matrix(batch.column(1))
                everything = np.arange(len(own))
                yield _short_batch([(qi[k], i, s) for k, i, s in _short_list(qs, own, rows, [everything] * len(qs), n)])

    return _merged(entries.select("entry", "embedding").mapInArrow(run, _SHORT), n)


def _dealt(entries: DataFrame, h: Hashes, parts: int, splits: np.ndarray | None) -> DataFrame:
    """part, split, kind, block: the entries and queries of each batch, packed by part. Without splits only part and n of the entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, rows, asks = batch.column(0).to_numpy(), _matrix(batch.column(1)), batch.column(2).to_numpy(zero_copy_only=False)
            keys = h.keys(np.floor(h.places(rows, False)))
            at = np.tile(np.arange(len(ids)), len(keys))
            flat = keys.ravel()
            part = (flat % np.uint64(parts)).astype(np.int64)
            if splits is None:
                count = np.bincount(part, minlength=parts)
                some = np.flatnonzero(count)
                yield pa.RecordBatch.from_arrays([pa.array(some.astype("i4")), pa.array(count[some].astype("i8"))], names=["part", "n"])
                continue
            out: tuple[list, list, list, list] = ([], [], [], [])
            split = (ids[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % splits[part]
            for p, c, chosen in _runs(part, split):
                _put(out, p, c, 0, _pack(flat[chosen], ids[at[chosen]], rows[at[chosen]]))
            for q0 in range(0, int(asks.sum()), 64):
                mine = np.flatnonzero(asks)[q0 : q0 + 64]
                places = h.places(rows[mine], True)
                cells = np.floor(places)[:, :, None, :] + h.steps(places)
                probes = h.keys(cells)  # tables, queries, probes
                who = np.broadcast_to(np.arange(len(mine))[None, :, None], probes.shape).ravel()
                flat_p = probes.ravel()
                part_p = (flat_p % np.uint64(parts)).astype(np.int64)
                for p, _, chosen in _runs(part_p, np.zeros_like(part_p)):
                    asking, place = np.unique(who[chosen], return_inverse=True)
                    block = _pack(flat_p[chosen], place, None) + _pack_vectors(ids[mine], rows[mine], asking)
                    for c in range(splits[p]):
                        _put(out, p, c, 1, block)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int32()), pa.array(out[3], pa.binary())], names=["part", "split", "kind", "block"])

    schema = "part int, n long" if splits is None else "part int, split int, kind int, block binary"
    return entries.select("entry", "embedding", "asks").mapInArrow(run, schema)


def _put(out, part, split, kind, block) -> None:
    for column, value in zip(out, (part, split, kind, block)):
        column.append(value)


def _runs(a: np.ndarray, b: np.ndarray):
    """The places of each distinct pair of values."""
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    cuts = np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1])) + 1
    starts = [0, *cuts.tolist()]
    for k, chosen in enumerate(np.split(order, cuts)):
        if len(chosen):
            yield int(a[starts[k]]), int(b[starts[k]]), chosen


def _numbers(rows: np.ndarray) -> bytes:
    return rows.astype("<f8" if rows.dtype == np.float64 else "<f4").tobytes()


def _vectors(data: bytes, n: int, d: int, at: int) -> np.ndarray:
    """n vectors from a byte on to the end, floats or doubles by their length."""
    return np.frombuffer(data, "<f8" if len(data) - at == 8 * n * d else "<f4", n * d, at).reshape(n, d)


def _pack(keys: np.ndarray, ids: np.ndarray, rows: np.ndarray | None) -> bytes:
    head = np.array([len(keys), 0 if rows is None else rows.shape[1]], "<i8").tobytes()
    return head + keys.astype("<u8").tobytes() + ids.astype("<i8").tobytes() + (b"" if rows is None else _numbers(rows))


def _pack_vectors(ids: np.ndarray, rows: np.ndarray, chosen: np.ndarray) -> bytes:
    return np.array([len(chosen), rows.shape[1]], "<i8").tobytes() + ids[chosen].astype("<i8").tobytes() + _numbers(rows[chosen])


def _unpack(block: bytes, vectors: bool):
    n, d = np.frombuffer(block, "<i8", 2)
    keys = np.frombuffer(block, "<u8", n, 16)
    ids = np.frombuffer(block, "<i8", n, 16 + 8 * n)
    at = 16 + 16 * n
    if not vectors:
        return keys, ids, _vectors(block, n, d, at)
    m, d = np.frombuffer(block, "<i8", 2, at)
    return keys, ids, np.frombuffer(block, "<i8", m, at + 16), _vectors(block, m, d, at + 16 + 8 * m)


#: Blocks of queries that a task takes at once, scores that it holds at once, and how many times its list's length a query's
#: candidates may be on average before the best are kept.
_BLOCKS, _SCORES, _GATHERED = 64, 1 << 18, 4


def _kept(who: np.ndarray, entry: np.ndarray, place: np.ndarray, rough: np.ndarray, n: int):
    """The n best rows of each query by rough scores, ties to smaller ids, each entry once, in the order of queries."""
    pair = np.unique(who * (int(entry.max(initial=0)) + 1) + entry, return_index=True)[1]  # an entry is in several buckets
    who, entry, place, rough = who[pair], entry[pair], place[pair], rough[pair]
    starts = np.flatnonzero(np.r_[True, who[1:] != who[:-1]][: len(who)])
    counts = np.diff(np.r_[starts, len(who)])
    order = np.argsort(-rough)
    order = order[np.argsort(who[order].astype(np.min_scalar_type(int(who.max(initial=0)))), kind="stable")]
    least = np.full(len(starts), -np.inf)
    least[counts >= n] = rough[order[starts[counts >= n] + n - 1]]
    keep = np.flatnonzero(rough >= np.repeat(least, counts))
    if len(keep) > np.minimum(counts, n).sum():  # equal scores at the end of a list
        keep = keep[np.lexsort((entry[keep], -rough[keep], who[keep]))]
        counts = np.bincount(who[keep])
        keep = keep[np.arange(len(keep)) - np.repeat(np.cumsum(counts) - counts, counts) < n]
    return who[keep], entry[keep], place[keep], rough[keep]


def _best_of_buckets(buckets, rows: np.ndarray, entry: np.ndarray, queries: np.ndarray, n: int):
    """The n best rows of each query among those of its buckets (first row, end, places of the queries), as _kept gives them.

    Every bucket is multiplied with all its queries at once; scores below the n-th best that a query has so far go at once.
    """
    wide = queries.astype(np.float64)
    floor = np.full(len(queries), -np.inf)
    found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
    gathered, full = 0, _GATHERED * n * len(queries)
    for begin, end, asking in buckets:
        for r in range(begin, end, 1024):
            block = rows[r : min(end, r + 1024)].astype(np.float64).T
            step = max(1, _SCORES // block.shape[1])
            for a in range(0, len(asking), step):
                some = asking[a : a + step]
                scores = wide[some] @ block
                good = np.flatnonzero(scores >= floor[some][:, None])
                if not len(good):
                    continue
                at, place = good // block.shape[1], r + good % block.shape[1]
                found.append((some[at], entry[place], place, scores.ravel()[good]))
                gathered += len(good)
                if gathered > full:
                    found = [_kept(*map(np.concatenate, zip(*found)), n)]
                    gathered = 0
                    who, _, _, rough = found[0]
                    starts = np.flatnonzero(np.r_[True, who[1:] != who[:-1]])
                    long = np.diff(np.r_[starts, len(who)]) == n
                    floor[who[starts[long]]] = np.minimum.reduceat(rough, starts)[long]
    return _kept(*map(np.concatenate, zip(*found)), n)


def _probed(n: int):
    """A function for the blocks of one split: the short list of each query."""

    def run(group: pa.Table) -> pa.Table:
        kinds, blocks = group.column("kind").to_pylist(), group.column("block").to_pylist()
        index = [_unpack(b, False) for k, b in zip(kinds, blocks) if k == 0]
        asked = [_unpack(b, True) for k, b in zip(kinds, blocks) if k == 1]
        if not index or not asked:
            return pa.Table.from_batches([_short_batch([])])
        keys, ids, rows = (np.concatenate([x[k] for x in index]) for k in range(3))
        order = np.argsort(keys, kind="stable")
        keys, rows = keys[order], rows[order]
        known, entry = np.unique(ids[order], return_inverse=True)
        begin = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        end, keys = np.r_[begin[1:], len(keys)], keys[begin]
        parts = []
        for some in (asked[k : k + _BLOCKS] for k in range(0, len(asked), _BLOCKS)):
            before = np.cumsum([0, *[len(x[2]) for x in some]])
            who = np.concatenate([x[1] + b for x, b in zip(some, before)])
            probes, qi, qs = (np.concatenate([x[k] for x in some]) for k in (0, 2, 3))
            bucket = np.minimum(np.searchsorted(keys, probes), len(keys) - 1)
            hit = np.flatnonzero(keys[bucket] == probes)
            bucket, who = bucket[hit], who[hit]
            asking = ((begin[b], end[b], who[chosen]) for b, _, chosen in _runs(bucket, np.zeros_like(bucket)))
            q, e, place, _ = _best_of_buckets(asking, rows, entry, qs, n + 8)
            cuts = np.flatnonzero(np.r_[True, q[1:] != q[:-1]][: len(q)]).tolist()
            for x, y in zip(cuts, [*cuts[1:], len(q)]):
                mine, exact = known[e[x:y]], exact_products(rows[place[x:y]], qs[q[x]])
                best = np.lexsort((mine, -exact))[:n]
                parts.append((qi[q[x]], mine[best], exact[best]))
        return pa.Table.from_batches([_short_batch(parts)])

    return run


def nearest(vectors: DataFrame, neighbours: int = 20, every: int = 20, s: Settings = Settings()) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest found of each row whose vec_id is divisible by `every`."""
    spark, n = vectors.sparkSession, neighbours + 1
    rows = usable(vectors).distinct()
    numbered = rows.withColumn("k", F.row_number().over(W.partitionBy("embedding").orderBy("vec_id"))).where(F.col("k") <= n)
    asked = rows.where(F.col("vec_id") % every == 0)
    kept = numbered.groupBy("embedding").agg(F.min("vec_id").alias("entry"), F.array_sort(F.collect_list("vec_id")).alias("ids"))
    entries = cut(kept.join(asked.groupBy("embedding").agg(F.lit(True).alias("asks")), "embedding", "left").select("entry", "embedding", F.coalesce("asks", F.lit(False)).alias("asks"), "ids"))
    facts = entries.agg(F.count("*").alias("n"), F.max(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x)).alias("square"), F.max(F.size("embedding")).alias("d")).first()
    empty = "query_id long, rank int, vec_id long, score double"
    if not facts["n"]:
        return spark.createDataFrame([], empty)
    sample = entries.orderBy(F.md5(F.col("entry").cast("string"))).limit(s.sample_rows).select("entry", "embedding").toArrow()
    own, held = sample.column(0).to_numpy(), _matrix(sample.column(1).combine_chunks())
    few = min(s.sample_queries, len(own))
    truth = scanned(entries, own[:few], held[:few], n).select("query", F.explode("found.id").alias("entry")).where("query <> entry").join(entries, "entry").select("query", "embedding").toArrow()
    by_query: dict[int, list] = {}
    for q, v in zip(truth.column(0).to_pylist(), truth.column(1).to_pylist()):
        by_query.setdefault(q, []).append(v)
    known = [k for k in range(few) if int(own[k]) in by_query]
    if known:
        h = fitted(held, held[known], [np.array(by_query[int(own[k])]) for k in known], math.sqrt(facts["square"]), s)
        parts = max(partitions(spark), math.ceil(facts["n"] * len(h.mixers) / s.split_entries))
        counts = _dealt(entries, h, parts, None).groupBy("part").agg(F.sum("n").alias("n")).collect()
        splits = np.ones(parts, np.int64)
        for r in counts:
            splits[r["part"]] = max(1, math.ceil(r["n"] / s.split_entries))
        short = _dealt(entries, h, parts, splits).groupBy("part", "split").applyInArrow(_probed(n), _SHORT)
        found = cut(_merged(short, n))
    else:
        found = cut(spark.createDataFrame([], _SHORT))
    # as many ids as a result can need for each query entry
    few_found = entries.where("asks").select("entry").join(found.select(F.col("query").alias("entry"), F.size("found").alias("m")), "entry", "left").where(F.coalesce("m", F.lit(0)) < min(n, facts["n"]))
    rest = cut(few_found.select("entry"))
    done = found.join(rest, found["query"] == rest["entry"], "left_anti") if rest.limit(1).count() else found
    last = None
    while block := rest.where(F.lit(True) if last is None else F.col("entry") > last).orderBy("entry").limit(s.scan_queries).join(entries, "entry").orderBy("entry").select("entry", "embedding").toArrow():
        if not block.num_rows:
            break
        ids = block.column(0).to_numpy()
        last = int(ids[-1])
        done = done.unionByName(scanned(entries, ids, _matrix(block.column(1).combine_chunks()), n))
    pairs = done.select("query", F.explode("found").alias("f")).select("query", F.col("f.less").alias("less"), F.col("f.id").alias("entry"))
    wide = pairs.join(entries.select("entry", "ids"), "entry").select("query", F.transform("ids", lambda i: F.struct(F.col("less").alias("less"), i.alias("id"))).alias("some"))
    lists = wide.groupBy("query").agg(F.slice(F.array_sort(F.flatten(F.collect_list("some"))), 1, n).alias("best"))
    who = asked.join(entries.select("embedding", "entry"), "embedding").select(F.col("vec_id").alias("query_id"), F.col("entry").alias("query"))
    best = F.slice(F.filter("best", lambda x: x["id"] != F.col("query_id")), 1, neighbours)
    ranked = who.join(lists, "query").select("query_id", F.posexplode(best).alias("at", "x"))
    return ranked.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), (-F.col("x.less")).alias("score"))
