"""Packing: documents' tokens end to end, cut into sequences of one length.

A narrow pass over keys and token counts divides the documents into ranges of their key and tells where each range begins in the
stream of tokens. The documents are then shuffled once, to the task of their range, where a stream of Arrow batches is cut. The
last sequence of a range goes on in the next one: the few documents at the head of a range that it needs are sent to both.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from loomlake.operators.ranges import borders, range_of

#: Documents of a range, which one task tokenizes and packs, of smaller inputs.
PACK_ROWS = 500


class Packing:
    """Where the tokens of documents are in their stream.

    docs: key and whatever `tokens` is made of; n: how many tokens a document has, where that is cheaper to tell than to make
    them. Documents come in the order of key, a number; those of one key by their other columns, so repeated ids lose nothing.
    """

    def __init__(self, docs: DataFrame, length: int, key: str = "doc_id", tokens: str | Column = "ids", n: Column | None = None):
        self.length, self.key = length, key
        self.tokens = F.col(tokens) if isinstance(tokens, str) else tokens
        self.at = borders(docs.select(key), key, PACK_ROWS)
        many = (F.size(self.tokens) if n is None else n).cast("long")
        self.docs = docs.withColumn("__n", many).where("__n > 0").withColumn("__range", range_of(key, self.at))
        self.tie = F.xxhash64(*[F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind])
        before = F.coalesce(F.sum("__n").over(W.partitionBy("__range").orderBy(key).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        narrow = self.docs.select(key, "__n", "__range").withColumn("__before", before)
        # a sequence that began before needs fewer tokens than a whole one
        head = F.max(F.when(F.col("__before") < length, F.col(key)))
        found = narrow.groupBy("__range").agg(F.sum("__n").alias("n"), head.alias("head")).collect()  # at most RANGES rows
        #: of each range: its number, where it begins, its tokens, and the last key that another range may need
        self.ranges: list[tuple[int, int, int, int]] = []
        self.total = 0
        for r in sorted(found, key=lambda r: r["__range"]):
            self.ranges.append((r["__range"], self.total, r["n"], r["head"]))
            self.total += r["n"]

    def _owner(self, base: int, offset: int, length: int) -> int | None:
        """The range in which the sequence begins that goes on at `base`."""
        start = offset + (base - offset) // length * length
        if start < offset or start == base:
            return None
        return next(number for number, begin, n, _ in self.ranges if begin <= start < begin + n)

    def sequences(self, offset: int = 0, most: int | None = None) -> DataFrame:
        """seq, tokens: the whole sequences from token `offset` on, numbered from 0, that end within `most` tokens."""
        if offset < 0 or offset > self.total:
            raise ValueError(f"the offset must be between 0 and {self.total}")
        return self._cut(offset, self.total if most is None else min(self.total, offset + most), self.length)

    def rest(self) -> list[int]:
        """The tokens behind the last whole sequence, fewer than one has."""
        many = self.total % self.length
        row = self._cut(self.total - many, self.total, many).first() if many else None
        return list(row["tokens"]) if row else []

    def _cut(self, offset: int, end: int, length: int) -> DataFrame:
        """seq, tokens: sequences of a length, at most the usual one, from token `offset` to `end`."""
        begins = {number: (base, base + n) for number, base, n, _ in self.ranges if base < end and base + n > offset}
        rows = [(number, self._owner(base, offset, length), head) for number, base, _, head in self.ranges if number in begins]
        spark = self.docs.sparkSession
        kinds = f"__range int, __owner int, __head {dict(self.docs.dtypes)[self.key]}"
        # at most RANGES rows
        found = self.docs.join(F.broadcast(spark.createDataFrame(rows, kinds)), "__range")
        own, guest = F.struct(F.col("__range").alias("part"), F.lit(0).alias("guest")), F.struct(F.col("__owner").alias("part"), F.lit(1).alias("guest"))
        places = F.when(F.col("__owner").isNotNull() & (F.col(self.key) <= F.col("__head")), F.array(own, guest)).otherwise(F.array(own))
        dealt = found.withColumn("__tie", self.tie).withColumn("__place", F.explode(places)).withColumns({"__part": F.col("__place.part"), "__guest": F.col("__place.guest")})
        dealt = dealt.repartitionById(len(self.at) + 1, F.col("__part")) if self.at else dealt.repartition(1)
        ordered = dealt.sortWithinPartitions("__part", "__guest", self.key, "__tie").select("__part", "__guest", self.tokens.cast("array<int>").alias("tokens"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part, held, at, stop, own_left = None, np.empty(0, np.int32), 0, 0, 0
            for batch in batches:
                parts, guests = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1), batch.num_rows]
                for a, b in zip(cuts, cuts[1:]):
                    if part != parts[a]:
                        if own_left:
                            raise ValueError("documents do not have as many tokens as n tells")
                        part = parts[a]
                        base, stop = begins[int(part)]
                        held, at, own_left = np.empty(0, np.int32), base, stop - base
                    lists = batch.column(2).slice(a, b - a)
                    own_left -= int(np.diff(lists.offsets.to_numpy())[guests[a:b] == 0].sum())
                    flat = np.concatenate([held, lists.flatten().to_numpy()])
                    # the first place from which a sequence begins
                    skip = min(len(flat), max(0, offset - at) if at < offset else -(at - offset) % length)
                    flat, at = flat[skip:], at + skip
                    many = 0 if at < offset or (at - offset) % length else max(0, min(len(flat) // length, -(-(stop - at) // length), (end - at) // length))
                    if many:
                        values = pa.array(flat[: many * length], pa.int32())
                        tokens = pa.ListArray.from_arrays(pa.array(np.arange(0, (many + 1) * length, length), pa.int32()), values)
                        first = (at - offset) // length
                        yield pa.RecordBatch.from_arrays([pa.array(range(first, first + many), pa.int64()), tokens], names=["seq", "tokens"])
                    held, at = flat[many * length :], at + many * length
            if own_left:
                raise ValueError("documents do not have as many tokens as n tells")

        return ordered.mapInArrow(run, "seq long, tokens array<int>")


def packed(docs: DataFrame, length: int, key: str = "doc_id", tokens: str | Column = "ids", n: Column | None = None) -> DataFrame:
    """seq, tokens: the concatenation of all documents' tokens, in order, cut into sequences of one length; the tail goes."""
    return Packing(docs, length, key, tokens, n).sequences()


def sub_stream(docs: DataFrame, length: int, offset: int = 0, most: int | None = None, key: str = "doc_id", tokens: str | Column = "ids", n: Column | None = None) -> DataFrame:
    """seq, tokens: the sequences that begin at token `offset` and end before `most` more tokens, numbered from 0."""
    return Packing(docs, length, key, tokens, n).sequences(offset, most)


def tail_split(total: int, length: int, share: float, most: int | None = None) -> tuple[int, int]:
    """Tokens of the training part and of the validation part, both whole sequences; validation follows training."""
    if not 0 <= share < 1:
        raise ValueError("the share must be in [0, 1)")
    held = int(total * share)
    held = min(held, most) if most is not None else held
    held -= held % length
    return (total - held) // length * length, held


def sequence_at(sequences: DataFrame, count: int, place: int) -> DataFrame:
    """The sequence at a place, which is counted from 0; others, negative ones too, raise."""
    if not 0 <= place < count:
        raise IndexError(place)
    return sequences.where(F.col("seq") == place)


def chunks(df: DataFrame, length: int, tokens: str = "ids") -> DataFrame:
    """df exploded into chunk, part: slices of a fixed length of each row's tokens."""
    rows = df.where(F.size(tokens) > 0).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.expr(f"(size({tokens}) - 1) div {length}").cast("int"))))
    return rows.withColumn("part", F.slice(tokens, F.col("chunk") * length + 1, F.lit(length)))
