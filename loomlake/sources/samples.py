"""Small made-up sources for smoke runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The size of the token stream, its vocabulary, and the multipliers and offsets of its pattern.
TOKENS, VOCABULARY, STEPS, OFFSETS = 4096, 256, (1, 3, 5, 7), 32
#: The conversations of the smoke run.
CONVERSATIONS = [
    [("system", "You are a concise assistant."), ("user", "Say hello."), ("assistant", "Hello.")],
    [("user", "What is 2 plus 2?"), ("assistant", "2 plus 2 equals 4.")],
    [("user", "Name one primary color."), ("assistant", "Red is one primary color.")],
    [("user", "Return the word done."), ("assistant", "done")],
]


def token_stream(spark: SparkSession) -> DataFrame:
    """pos, token: for each offset its multiples, again and again."""
    offset = F.expr(f"(id % {OFFSETS * len(STEPS)}) div {len(STEPS)} + 1")
    step = F.element_at(F.array(*map(F.lit, STEPS)), (F.col("id") % len(STEPS) + 1).cast("int"))
    return spark.range(TOKENS).select(F.col("id").alias("pos"), (offset * step % VOCABULARY).cast("int").alias("token"))


def conversation_rows(spark: SparkSession) -> DataFrame:
    """messages, source."""
    return spark.createDataFrame([(m, "local_smoke") for m in CONVERSATIONS], "messages array<struct<role:string,content:string>>, source string")
