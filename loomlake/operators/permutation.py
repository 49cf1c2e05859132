"""A permutation of 0 to n - 1 that each row computes for itself: a Feistel network over the next power of four, walked until the
place is below n. It is a bijection, so exactly k rows have places below k, whatever n and the partitioning are."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Rounds of the network, and the most walks, of which each ends below n with a chance of a quarter at least.
ROUNDS, WALKS = 6, 400


def _round(half: Column, number: int, seed: int, mask: int) -> Column:
    """A half mixed with the seed: the first digits of a checksum."""
    text = F.concat(F.lit(f"{seed}:{number}:"), half.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long").bitwiseAND(F.lit(mask))


def place_of(place: Column, n: int, seed: int) -> Column:
    """Where the permutation of 0 to n - 1 that a seed names puts a place."""
    bits = max(1, -(-(n - 1).bit_length() // 2))
    if bits > 32:
        raise ValueError("more places than the network has")
    mask = (1 << bits) - 1

    def walk(x: Column) -> Column:
        def turned(k: int):
            return lambda s: F.struct(s["r"].alias("l"), s["l"].bitwiseXOR(_round(s["r"], k, seed, mask)).alias("r"))

        step = F.struct(F.shiftright(x, bits).alias("l"), x.bitwiseAND(F.lit(mask)).alias("r"))
        for k in range(ROUNDS):
            # each round sees the last one's halves once
            step = F.get(F.transform(F.array(step), turned(k)), F.lit(0))
        return F.get(F.transform(F.array(step), lambda s: F.shiftleft(s["l"], bits).bitwiseOR(s["r"])), F.lit(0))

    start = F.struct(place.cast("long").alias("at"), F.lit(False).alias("done"))
    on = lambda s, _: F.when(s["done"], s).otherwise(F.get(F.transform(F.array(walk(s["at"])), lambda x: F.struct(x.alias("at"), (x < n).alias("done"))), F.lit(0)))
    end = F.aggregate(F.sequence(F.lit(1), F.lit(WALKS)), start, on)
    return F.when(end["done"], end["at"]).otherwise(F.raise_error(F.lit("the permutation was not walked to its end")).cast("long"))


def place_sql(place: str, n: str, bits: str, seed: int) -> str:
    """DuckDB SQL of `place_of` for columns of places, of n and of the bits of a half.

    The state of the walk is a place once it is below n, before that -1 minus the place.
    """
    mask = f"((1::BIGINT << {bits}) - 1)"
    mixed = f"(('0x' || substr(md5('{seed}:' || c[1] || ':' || a[2]), 1, 8))::BIGINT & {mask})"
    rounds = ", ".join(f"[{k}::BIGINT]" for k in range(ROUNDS))
    halves = f"list_reduce([[(-1 - b) >> {bits}, (-1 - b) & {mask}], {rounds}], lambda a, c: [a[2], xor(a[1], {mixed})])"
    value = f"list_transform([{halves}], lambda h: (h[1] << {bits}) | h[2])[1]"
    step = f"CASE WHEN b >= 0 THEN b ELSE list_transform([{value}], lambda v: CASE WHEN v < {n} THEN v ELSE -1 - v END)[1] END"
    return f"list_reduce(list_prepend(-1 - {place}, range({WALKS})), lambda b, c0: {step})"
