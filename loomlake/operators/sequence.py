"""Order-dependent operators by their names: running sums and budgets, cuts, packing, resuming."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomlake.operators.cuts import GREEDY, NEXT_FIT, cut_by, greedy_shards, next_fit, with_shards
from loomlake.operators.packing import Packing, chunks, packed, sequence_at, sub_stream, tail_split
from loomlake.operators.ranges import budgeted, running_before, seeded_key

__all__ = ["GREEDY", "NEXT_FIT", "Packing", "budgeted", "chunks", "cut_by", "greedy_shards", "next_fit", "packed", "resumed", "running_before", "seeded_key", "sequence_at", "sub_stream", "tail_split", "with_shards"]


def resumed(valid: DataFrame, existing: int, order: Sequence[str]) -> DataFrame:
    """The valid rows after the first `existing` ones, in a stable order of long keys."""
    rows = running_before(valid.withColumn("__one", F.lit(1)), "__one", order[0], order[-1], "__place")
    return rows.where(F.col("__place") >= existing).drop("__one", "__place")
