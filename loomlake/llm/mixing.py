"""Mixing sources to target weights by weighted fair queueing.

Every source is a flow whose documents wait in a shuffled, reproducible order (the MD5 of the id, then id, size and text);
a second pass over a source follows the first one. A document's virtual finish time is its source's cumulative size, up to
and including it, divided by the source's target. The mix is all documents sorted by finish time (then source, then place
in the source's queue) and cut where their sizes reach the budget, which is the sum of the targets; of the document there
the first words are taken. Sources are not cut one by one: flows reach their targets together, at virtual time 1, and a
source differs from its target by what its document in service there is too long or too short.

Sums are two-level. In a source: sums of pieces (1/4096th of the shuffled order each), a running sum over those, and one
inside each piece, so no task holds a source. Over all: virtual time is dealt into equal slices, which hold about equally
many words whatever the sources are, so the slice of the cut follows from the slices' sums, and only that slice is summed
row by row. The cut is then one place in the order, and every row is compared with it. The mix is range-sorted by the same
slices. Sources are ranked by ranges, too, so there may be many.

Defined cases: null text has size 0; the null source is a source of its own, sorted last; documents of size 0 are never
taken; rows with one id, size and text are interchangeable; rows may repeat ids; an empty table gives an empty result;
other columns are ignored or, in `mixed`, carried along.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from loomlake.llm.common import BLANK, WORD, Scratch, n_words, partitions, stored

#: Leading hexadecimal digits of the shuffle key that name a piece of a source: 16 ** 3 pieces.
PIECE_DIGITS = 3
#: Slices of virtual time in which the place of the cut is searched, and documents for each slice of larger inputs.
SLICES = 4096
SLICE_ROWS = 100_000


def running(df: DataFrame, order: Sequence[Column], sums: dict[str, Column], scratch: Scratch) -> DataFrame:
    """df with the sum of each expression over all rows that come before in the order; every range of rows is one task's."""
    rows = df.withColumns({f"__{k}": v for k, v in sums.items()}).repartitionByRange(partitions(df.sparkSession), *order)
    rows = scratch.stored(rows.withColumn("__range", F.spark_partition_id()))
    totals = rows.groupBy("__range").agg(*[F.sum(f"__{k}").alias(k) for k in sums])
    before = W.orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    bases = totals.select("__range", *[F.coalesce(F.sum(k).over(before), F.lit(0)).alias(f"__base_{k}") for k in sums])
    inside = W.partitionBy("__range").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    # a row for each partition
    both = rows.withColumns({k: F.coalesce(F.sum(f"__{k}").over(inside), F.lit(0)) for k in sums}).join(F.broadcast(bases), "__range")
    return both.select(*df.columns, *[(F.col(k) + F.col(f"__base_{k}")).alias(k) for k in sums])


def source_targets(per_source: DataFrame, weights: Sequence[float], share: float, limit: float, scratch: Scratch) -> DataFrame:
    """Targets of sources: shares of share * all sizes by weight, none above limit * the source's size.

    per_source: source, source_size, one row for each source. What a source cannot take is dealt to the others by weight
    until none is above its limit; that is the level at which the sum of min(limit * size, weight * level) is the
    budget: sources are full in the order of limit * size / weight, so the first one that is not tells the level.
    """
    by_name = F.col("source").asc_nulls_last()
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    rows = running(per_source, [by_name], {"at": F.lit(1)}, scratch)
    rows = rows.withColumn("weight", F.element_at(cycle, (F.pmod("at", F.lit(len(weights))) + 1).cast("int")))
    rows = scratch.stored(rows.withColumn("most", F.col("source_size") * F.lit(float(limit))).drop("at"))
    all_size, all_weight = rows.agg(F.sum("source_size"), F.sum("weight")).first()
    budget, all_weight = float(all_size or 0) * share, float(all_weight or 0)
    by_level = [(F.col("most") / F.col("weight")).asc(), by_name]
    rows = scratch.stored(running(rows, by_level, {"full_before": F.col("most"), "weight_before": F.col("weight")}, scratch))
    # the level if all sources before this one are full and this one is not
    level = (F.lit(budget) - F.col("full_before")) / (F.lit(all_weight) - F.col("weight_before"))
    first = rows.where(level * F.col("weight") <= F.col("most")).agg(F.min(F.struct("full_before", level.alias("level")))["level"]).first()[0]
    target = F.col("most") if first is None else F.least(F.col("most"), F.col("weight") * F.lit(first))
    return rows.select("source", "source_size", target.alias("target"))


class Mix:
    """What is known of the whole corpus: each source's pieces with their sums and targets, and where the mix is cut."""

    def __init__(self, docs: DataFrame, weights: Sequence[float], share: float, limit: float, scratch: Scratch):
        self.limit = limit
        sized = scratch.stored(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("hash")))
        pieces = scratch.stored(sized.groupBy("source", _piece().alias("piece")).agg(F.sum("size").alias("piece_size")))
        self.targets = scratch.stored(source_targets(pieces.groupBy("source").agg(F.sum("piece_size").alias("source_size")), weights, share, limit, scratch))
        earlier = W.partitionBy("source").orderBy("piece").rowsBetween(W.unboundedPreceding, -1)
        pieces = pieces.withColumn("piece_before", F.coalesce(F.sum("piece_size").over(earlier), F.lit(0)))
        known = pieces.alias("p").join(self.targets.alias("t"), F.col("p.source").eqNullSafe(F.col("t.source")))
        self.pieces = stored(known.select(_named(F.col("p.source")).alias("__k"), "piece", "piece_before", "source_size", "target"))
        self.queue = scratch.stored(self.queued(sized))
        self.cut = self._cut(scratch)

    def queued(self, rows: DataFrame) -> DataFrame:
        """rows (doc_id, source, size, hash and more) with source_size, target and before: the size that waits before each."""
        inside = W.partitionBy("__k", "piece").orderBy(F.md5(_text_id()), "doc_id", "size", "hash").rowsBetween(W.unboundedPreceding, -1)
        both = rows.withColumn("__k", _named(F.col("source"))).withColumn("piece", _piece()).join(self.pieces, ["__k", "piece"])
        return both.withColumn("before", F.col("piece_before") + F.coalesce(F.sum("size").over(inside), F.lit(0))).select(*rows.columns, "source_size", "target", "before")

    def passes(self, queue: DataFrame) -> DataFrame:
        """queue with a row for each pass over a document: start (the size before it), finish."""
        count = max(1, int(-(-self.limit // 1)))
        rows = queue.where("size > 0 AND target > 0").withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(count - 1))))
        rows = rows.withColumn("start", F.col("before") + F.col("pass") * F.col("source_size"))
        return rows.withColumn("finish", (F.col("start") + F.col("size")).cast("double") / F.col("target"))

    def _cut(self, scratch: Scratch) -> tuple | None:
        """The place in the order at which the budget is used up, and the words that are left for the document there."""
        count, total = self.queue.agg(F.count("*"), F.sum("size")).first()
        if not total:
            return None
        budget = int(self.targets.agg(F.sum("target")).first()[0] + 0.5)
        slices = max(SLICES, count // SLICE_ROWS)
        rows = self.passes(self.queue).withColumn("slice", F.least(F.floor(F.col("finish") * slices), F.lit(2 * slices)))
        sums = rows.groupBy("slice").agg(F.sum("size").alias("n"))
        before = F.sum("n").over(W.orderBy("slice").rowsBetween(W.unboundedPreceding, -1))
        there = sums.withColumn("b", F.coalesce(before, F.lit(0))).where((F.col("b") < budget) & (F.col("b") + F.col("n") >= budget)).first()
        if there is None:  # all passes together do not reach the budget
            return None
        # one slice: about as many rows as any other slice
        inside = F.sum("size").over(W.orderBy(F.col("finish"), F.col("source").asc_nulls_last(), F.col("start")).rowsBetween(W.unboundedPreceding, -1))
        left = F.lit(budget - there["b"]) - F.coalesce(inside, F.lit(0))
        last = rows.where(F.col("slice") == there["slice"]).select("finish", "source", "start", left.alias("left"), "size").where("left > 0 AND left <= size").first()
        return last["finish"], last["source"], last["start"], last["left"]

    def served(self, finish: Column, start: Column) -> Column:
        """The words of a pass over a document (source, size) that the mix takes."""
        if self.cut is None:
            return F.col("size")
        at, source, begun, left = self.cut
        mine, there = F.col("source"), F.lit(source).cast("string")
        # null is last
        before = F.when(mine.isNull(), F.lit(False)).otherwise(F.lit(True) if source is None else mine < there)
        same = mine.eqNullSafe(there)
        earlier = (finish < at) | ((finish == at) & (before | (same & (start < begun))))
        here = (finish == at) & same & (start == begun)
        return F.when(earlier, F.col("size")).when(here, F.lit(left)).otherwise(F.lit(0)).cast("long")


def _text_id() -> Column:
    return F.coalesce(F.col("doc_id").cast("string"), F.lit(""))


def _piece() -> Column:
    return F.substring(F.md5(_text_id()), 1, PIECE_DIGITS)


def _named(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def taken(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, limit: float = 2.0) -> DataFrame:
    """One row for each document: doc_id, size, source_size, target and taken, the words of it that the mix takes."""
    with Scratch(docs.sparkSession) as scratch:
        mix = Mix(docs.select("doc_id", "source", "text"), weights, share, limit, scratch)
        total = F.lit(0).cast("long")
        for k in range(max(1, int(-(-limit // 1)))):
            start = F.col("before") + k * F.col("source_size")
            finish = F.try_divide((start + F.col("size")).cast("double"), F.col("target"))
            total += F.when((F.col("size") > 0) & (F.col("target") > 0), mix.served(finish, start)).otherwise(F.lit(0)).cast("long")
        return stored(mix.queue.select("doc_id", "size", "source_size", "target", total.alias("taken")))


def mixed(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, limit: float = 2.0) -> DataFrame:
    """The mix itself: docs' rows and columns, once for each pass that takes them, range-sorted by virtual finish time.

    The document at the cut keeps its first words, and n_chars is its length where there is such a column.
    """
    spark = docs.sparkSession
    with Scratch(spark) as scratch:
        mix = Mix(docs.select("doc_id", "source", "text"), weights, share, limit, scratch)
    all_columns = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = mix.queued(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("hash"), all_columns))
    rows = mix.passes(rows).withColumn("served", mix.served(F.col("finish"), F.col("start"))).where("served > 0")
    slices = partitions(spark)
    rows = rows.withColumn("slice", F.least(F.floor(F.col("finish") * slices), F.lit(slices - 1)).cast("int"))
    rows = rows.repartitionById(slices, F.col("slice")).sortWithinPartitions("finish", F.col("source").asc_nulls_last(), "start")
    words = F.regexp_extract_all(F.col("row.text"), F.lit(BLANK + "*" + WORD), F.lit(0))
    head = F.array_join(F.slice(words, F.lit(1), F.col("served").cast("int")), "")
    text = F.when(F.col("served") < F.col("size"), head).otherwise(F.col("row.text"))
    out = {c: F.col("row").getField(c) for c in docs.columns} | {"text": text}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(F.col("served") < F.col("size"), F.length(text).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("row.n_chars"))
    return rows.select(*[out[c].alias(c) for c in docs.columns])


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, text, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
per_source AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT source, source_size, source_size * 2.0::DOUBLE AS most,
         [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT] AS weight FROM per_source),
levels AS (
  SELECT *, (sum(source_size) OVER ()) * 1.5::DOUBLE AS budget,
         coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS full_before,
         sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS weight_left FROM weighed),
leveled AS (SELECT *, (budget - full_before) / weight_left AS level FROM levels),
chosen AS (SELECT arg_min(level, full_before) AS final_level FROM leveled WHERE level * weight <= most),
targets AS (SELECT source, source_size, CASE WHEN final_level IS NULL THEN most ELSE least(most, weight * final_level) END AS target FROM leveled CROSS JOIN chosen),
placed AS (
  SELECT row_number() OVER () AS k, doc_id, s.source, size, source_size, target,
         coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY md5(coalesce(doc_id::VARCHAR, '')), doc_id, size, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
passes AS (
  SELECT k, source, size, before + p * source_size AS start, (before + p * source_size + size)::DOUBLE / target AS finish
  FROM placed, (VALUES (0), (1)) v(p) WHERE size > 0 AND target > 0),
sorted AS (SELECT k, size, coalesce(sum(size) OVER (ORDER BY finish, source NULLS LAST, start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier FROM passes),
budget AS (SELECT floor(sum(target) + 0.5) AS budget FROM targets),
got AS (SELECT k, sum(greatest(0, least(size, budget - earlier)))::BIGINT AS taken FROM sorted, budget GROUP BY k)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken FROM placed LEFT JOIN got USING (k)
"""
