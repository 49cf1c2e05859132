"""Toxicity by compression distance: which of two zstandard dictionaries makes a window shorter?

Two dictionaries are trained by zstandard's trainer: one on ordinary text, one on toxic text. A toxic document is ordinary
text for the most part, so the toxic dictionary is trained on the stretches that make it toxic: runs of pieces of `piece`
bytes that are significantly commoner in toxic documents than in ordinary ones, at a false discovery rate over all pieces,
without what merely stands beside them. There is no list of words, pieces may be parts of words, and a rare language's
pieces enter as any others; each document's stretches are one sample for the trainer. The toxic dictionary stands behind the ordinary one, and as many bytes that match nothing stand behind the ordinary one alone,
so what both know cancels out and offsets cost the same. Every window starts with bytes that both know, so zstandard never
stores it raw, and literals are not entropy-coded: a window's distance is the bytes that toxic matches save.

A document's evidence is its largest two distances, its number of windows and how many windows reach each distance; a
logistic model turns it into a score, and 0.5 is the calibrated threshold. It is fitted to the evidence of each half of
the labelled documents by dictionaries of the other half; scoring takes dictionaries of both.

Learning reads a bounded sample: at most `per_class` labelled rows of each class (the smallest MD5 of their ids), with
their whole texts, which one task holds; the driver gets the model alone. Scoring reads every byte of every document, window by window; windows overlap,
so no passage of up to `overlap` bytes is split. Memory is bounded by one Arrow batch.

Defined cases: null and empty texts have no window and the score of evidence 0; without labelled rows of both classes
every score is the share of toxic labels (0 without labels); rows with a null label or id teach nothing; repeated rows
are scored each; other columns are ignored or, in `without_toxic`, carried along.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from loomlake.llm.common import fresh


@dataclass(frozen=True)
class Settings:
    """Parameters; all of them documented limits of the fit or fixed window sizes."""

    per_class: int = 3000
    window: int = 128
    overlap: int = 32
    dictionary_bytes: int = 8192
    #: Bytes of a piece, the shortest match; pieces are toxic if over `ratio` times as common in toxic texts, at this false discovery rate.
    piece: int = 5
    false_rate: float = 0.01
    ratio: float = 50.0


#: Bytes that both dictionaries begin with and that begin every window that is compressed.
LEAD = bytes(range(1, 33))


@dataclass(frozen=True)
class Model:
    """What scoring needs: two dictionaries and the weights of the features."""

    settings: Settings
    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]

    def scorer(self):
        """text (str or None) -> score; one pair of compressors for the caller."""
        if not self.toxic:
            prior = self.weights[0]
            return lambda text: prior
        s = self.settings
        compress = [_compressor(d, s.piece).compress for d in (self.ordinary, self.toxic)]

        def score(text: str | None) -> float:
            found = evidence(text.encode("utf-8", "replace") if text else b"", s, *compress)
            z = sum(w * x for w, x in zip(self.weights, features(*found)))
            return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))

        return score


def _compressor(content: bytes, piece: int) -> zstandard.ZstdCompressor:
    # the fast strategy with a target length leaves literals as they are
    how = zstandard.ZstdCompressionParameters(window_log=17, hash_log=16, chain_log=16, search_log=1, min_match=piece, target_length=1, strategy=zstandard.STRATEGY_FAST, write_content_size=False, write_checksum=False, write_dict_id=False)
    held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    held.precompute_compress(compression_params=how)
    return zstandard.ZstdCompressor(dict_data=held, compression_params=how)


def evidence(data: bytes, s: Settings, ordinary, toxic) -> tuple[int, int, list[int]]:
    """The two largest window distances of data, at least 0, and the numbers of windows by distance, 0 to 8 and more."""
    most = second = 0
    counts = [0] * 9
    step = s.window - s.overlap
    low = data.lower()
    for at in range(0, max(1, len(low) - s.window + step) if low else 0, step):
        piece = LEAD + low[at : at + s.window]
        distance = len(ordinary(piece)) - len(toxic(piece))
        counts[max(0, min(8, distance))] += 1
        if distance > second:
            most, second = (distance, most) if distance > most else (most, distance)
    return most, second, counts


def features(most: int, second: int, counts: list[int]) -> tuple[float, ...]:
    windows = sum(counts)
    reached = [sum(counts[k:]) for k in range(9)]
    shares = (reached[k] / (windows + 1) for k in (1, 2, 4, 8))
    return 1.0, math.log1p(windows), min(most, 16), min(second, 16), *(math.log1p(n) for n in reached[1:]), *shares


def _pieces(text: bytes, n: int) -> np.ndarray:
    """The numbers of all pieces of n bytes of a text."""
    b = np.frombuffer(text, np.uint8).astype(np.uint64)
    out = np.zeros(max(0, len(b) - n + 1), np.uint64)
    for k in range(n):
        out = (out << np.uint64(8)) | b[k : k + len(out)]
    return out


def _distinct(texts: list[bytes]) -> list[bytes]:
    """One text of those with one ending, as copies have."""
    return list({t[-64:]: t for t in texts}.values())


@cache
def _chance(k: int, n: int, q: float) -> float:
    """The probability that k or more of n texts are toxic if each is with probability q."""
    log = lambda j: math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * math.log(q) + (n - j) * math.log1p(-q)
    return math.fsum(math.exp(log(j)) for j in range(k, min(n, k + 400) + 1))


def _telling(toxic: list[bytes], ordinary: list[bytes], s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """The sorted pieces that are significantly commoner in toxic texts, by the step-up rule over all pieces of two texts or more.

    With the number of toxic texts that have each.
    """

    def counted(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return np.unique(np.concatenate([np.zeros(0, np.uint64), *(np.unique(_pieces(t, s.piece)) for t in texts)]), return_counts=True)

    (found, k), (usual, m) = counted(toxic), counted(ordinary)
    at = np.minimum(np.searchsorted(usual, found), max(0, len(usual) - 1))
    other = np.where(usual[at] == found, m[at], 0) if len(usual) else np.zeros(len(found), np.int64)
    tested = int((k + other > 1).sum()) + int((~np.isin(usual, found) & (m > 1)).sum())
    some = np.flatnonzero((k > 1) & (k / len(toxic) > s.ratio * other / len(ordinary)))
    share = len(toxic) / (len(toxic) + len(ordinary))
    chances = np.array([_chance(int(a), int(a + b), share) for a, b in zip(k[some], other[some])])
    order = np.argsort(chances, kind="stable")
    passed = np.flatnonzero(chances[order] <= s.false_rate * np.arange(1, len(order) + 1) / max(1, tested))
    chosen = np.sort(some[order[: passed[-1] + 1]]) if len(passed) else some[:0]
    return found[chosen], k[chosen]


def _stretches(text: bytes, telling: np.ndarray, counts: np.ndarray, n: int) -> list[bytes]:
    """The runs of a text that telling pieces cover; a piece that is much rarer than one it overlaps only stands beside it."""
    pieces = _pieces(text, n)
    if not len(pieces) or not len(telling):
        return []
    at = np.minimum(np.searchsorted(telling, pieces), len(telling) - 1)
    known = np.where(telling[at] == pieces, counts[at], 0)
    wide = np.concatenate([np.zeros(n - 1, known.dtype), known, np.zeros(n - 1, known.dtype)])
    near = np.lib.stride_tricks.sliding_window_view(wide, 2 * n - 1).max(1)
    hit = np.concatenate([np.zeros(n, bool), (known > 0) & (2 * known >= near), np.zeros(n, bool)])
    covered = np.lib.stride_tricks.sliding_window_view(hit, n).any(1)
    edges = np.flatnonzero(covered[1:] != covered[:-1])
    return [text[a:b] for a, b in zip(edges[0::2], edges[1::2])]


def _trained(samples: list[bytes], size: int) -> bytes:
    """What zstandard's trainer finds worth keeping of samples; the samples themselves if they are too few to train on."""
    try:
        held = zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[-size:]
    return held


def _dictionaries(toxic: list[bytes], ordinary: list[bytes], s: Settings) -> tuple[bytes, bytes]:
    """The ordinary dictionary and the toxic one, each behind the same lead."""
    toxic, ordinary = _distinct([t.lower() for t in toxic]), _distinct([t.lower() for t in ordinary])
    usual = [t[k : k + 256] for t in ordinary for k in range(0, len(t), 256)]
    base = LEAD + _trained(usual, s.dictionary_bytes)
    telling = _telling(toxic, ordinary, s)
    samples = [x for t in toxic if (x := b"\0".join([*_stretches(t, *telling, s.piece), b""]))]
    own = _trained(samples, s.dictionary_bytes) if samples else b""
    return base + bytes(len(own)), base + own


def _logistic(xs: list[tuple[float, ...]], ys: list[int]) -> tuple[float, ...]:
    """Ridge logistic regression by Newton steps; the first feature is the constant."""
    x, y = np.array(xs, float), np.array(ys, float)
    ridge, w = np.full(x.shape[1], 1e-2), np.zeros(x.shape[1])
    ridge[0] = 0
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w = w + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge + 1e-6), x.T @ (y - p) - ridge * w)
    return tuple(float(v) for v in w)


def fit(rows: list[tuple[bytes, int]], s: Settings = Settings(), prior: float | None = None) -> Model:
    """A model of (text in UTF-8, label) rows: each half calibrates the dictionaries of the other one.

    prior: the share of toxic ones among all labelled rows, if the sample of the classes was uneven.
    """
    share = sum(y for _, y in rows) / len(rows) if rows else 0.0
    prior = share if prior is None else prior
    halves = [[r for r in rows[k::2] if r[0]] for k in (0, 1)]
    if any(len({y for _, y in half}) < 2 for half in halves):
        return Model(s, b"", b"", (prior,))
    built = lambda part: _dictionaries(*([t for t, y in part if y == k] for k in (1, 0)), s)
    xs, ys = [], []
    for build, calibrate in (halves, halves[::-1]):
        compress = [_compressor(d, s.piece).compress for d in built(build)]
        xs += [features(*evidence(t, s, *compress)) for t, _ in calibrate]
        ys += [y for _, y in calibrate]
    constant, *weights = _logistic(xs, ys)
    odds = lambda q: math.log(q / (1 - q))
    return Model(s, *built([r for r in rows if r[0]]), (constant + odds(prior) - odds(sum(ys) / len(ys)), *weights))


def held_out(doc_id: Column) -> Column:
    """True for the rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learned(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> Model:
    """The model of the labelled rows of docs that are not held out."""
    known = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(~held_out(F.col("doc_id"))).select("doc_id", "toxic").distinct()
    order = [F.md5(F.col("doc_id").cast("string")), F.col("toxic")]
    # top-k queries: each is bounded by per_class rows
    chosen = known.where("toxic = 1").orderBy(*order).limit(s.per_class).unionByName(known.where("toxic = 0").orderBy(*order).limit(s.per_class))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    prior = counts[1] / sum(counts.values()) if all(counts.get(k) for k in (0, 1)) else None
    rows = docs.where("text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.encode("text", "utf-8").alias("data"))
    rows = rows.join(F.broadcast(chosen), "doc_id").select("doc_id", "data", F.col("toxic").cast("int").alias("toxic"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = sorted((r["doc_id"], r["data"], r["toxic"]) for batch in batches for r in batch.to_pylist())
        m = fit([(t, y) for _, t, y in found], s, prior)
        yield pa.RecordBatch.from_pydict({"ordinary": [m.ordinary], "toxic": [m.toxic], "weights": [list(m.weights)]}, schema=pa.schema([("ordinary", pa.binary()), ("toxic", pa.binary()), ("weights", pa.list_(pa.float64()))]))

    # one task holds the sample, the driver gets the model alone; one row in any case, as an empty partition is a task too
    got = rows.repartition(1).mapInArrow(run, "ordinary binary, toxic binary, weights array<double>").collect()
    return Model(s, bytes(got[0]["ordinary"]), bytes(got[0]["toxic"]), tuple(got[0]["weights"])) if got else fit([], s, prior)


def scored(docs: DataFrame, model: Model, out: str = "score") -> DataFrame:
    """docs with the score of each text in the column `out`."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = model.scorer()
        for batch in batches:
            scores = pa.array([score(t) for t in batch.column(at).to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], names=[*batch.schema.names, out])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(out, DoubleType())]))


def toxicity(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    model = learned(docs, labels, s)
    rows = scored(docs.select("doc_id", "text"), model).drop("text")
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The rows of docs that the classifier does not reject, with docs' columns."""
    model = learned(docs, labels, s)
    name = fresh(docs, "score")
    return scored(docs, model, name).where(F.col(name) < 0.5).select(*docs.columns)
