"""Ranges of an order key: what running sums, budgets, cuts and packing share, so that no global order meets in one task.

Rows are dealt to ranges between quantiles of their key; the ranges' sums, at most `RANGES` rows for each group, are summed up in
order, and a window inside each range does the rest. Rows with one key are in one range: keys are ids or hashes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

RANGES = 1024
#: Rows for each range of smaller inputs.
RANGE_ROWS = 50_000
#: Bits of `seeded_key`, and how many of them number the ranges of keys that are known to be even.
KEY_BITS, EVEN_BITS = 60, 10


def seeded_key(*parts: Column) -> Column:
    """A shuffling order key that does not depend on the order of the input: 60 bits of a SHA-256."""
    return F.conv(F.substring(F.sha2(F.concat_ws("::", *parts), 256), 1, KEY_BITS // 4), 16, 10).cast("long")


def borders(df: DataFrame, key: str, rows: int | None = None) -> list[int]:
    """Quantiles of a key that divide df into ranges of about `rows` rows, at most `RANGES`; outliers and gaps do no harm."""
    ranges = max(1, min(RANGES, -(-df.count() // (rows or RANGE_ROWS))))
    found = df.stat.approxQuantile(key, [k / ranges for k in range(1, ranges)], 0.25 / ranges) if ranges > 1 else []
    return sorted({int(b) for b in found})


def range_of(key: str, at: Sequence[int]) -> Column:
    """The number of the borders that a key reaches, found by halving."""

    def halved(low: int, high: int) -> str:
        if low == high:
            return str(low)
        mid = (low + high) // 2
        return f"CASE WHEN `{key}` < {at[mid]}L THEN {halved(low, mid)} ELSE {halved(mid + 1, high)} END"

    return F.expr(halved(0, len(at))).cast("int")


def group_name(by: str | None) -> Column:
    """A group as a text that is never null, so that rows without a group are one too."""
    return F.coalesce(F.concat(F.lit("="), F.col(f"`{by}`").cast("string")), F.lit("")) if by else F.lit("")


def running_before(df: DataFrame, value: str, key: str, tie: str, out: str = "before", by: str | None = None, below: int | None = None, even: bool = False) -> DataFrame:
    """df with the sum of value over all rows (of the same `by`, null being a group) with a smaller (key, tie); key is a number.

    below: only rows whose sum is less are needed; ranges that begin at it or later are left out before anything is sorted.
    even: keys are those of `seeded_key`, so their upper bits give even ranges and need no quantiles.
    """
    number = F.shiftright(F.col(key), KEY_BITS - EVEN_BITS).cast("int") if even else range_of(key, borders(df, key))
    rows = df.withColumn("__set", group_name(by)).withColumn("__range", number)
    ahead = W.unboundedPreceding, -1
    sums = rows.groupBy("__set", "__range").agg(F.sum(value).alias("__sum"))
    before = F.coalesce(F.sum("__sum").over(W.partitionBy("__set").orderBy("__range").rowsBetween(*ahead)), F.lit(0))
    sums = sums.select("__set", "__range", before.alias("__base"))
    sums = sums if below is None else sums.where(F.col("__base") < below)
    # at most RANGES rows of each group
    found = rows.join(sums if by else F.broadcast(sums), ["__set", "__range"])
    inside = F.coalesce(F.sum(value).over(W.partitionBy("__set", "__range").orderBy(key, tie).rowsBetween(*ahead)), F.lit(0))
    return found.withColumn(out, inside + F.col("__base")).drop("__set", "__range", "__base")


def budgeted(df: DataFrame, value: str, key: str, tie: str, target: int, by: str | None = None, even: bool = False) -> DataFrame:
    """The rows (of each `by`) before the budget is reached; the row that reaches it is included.

    A histogram of the key's ranges comes first, and only rows of ranges that begin before the budget are shuffled and sorted.
    """
    return running_before(df, value, key, tie, "__before", by, target, even).where(F.col("__before") < target).drop("__before")
