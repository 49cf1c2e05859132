"""What the query modules share: the registry, readers and pieces of SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomlake.functions import text as T
from loomlake.operators import chat, sequence

LENGTH = 2048
BUDGET = 100_000
CHAT_LENGTH = 512

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

IDS = r"list_transform(regexp_extract_all({t}, '(?s)<\|im_start\|>|<\|im_end\|>|.'), lambda c: CASE c WHEN '<|im_start|>' THEN 2 WHEN '<|im_end|>' THEN 3 ELSE 4 + unicode(c) % 252 END)"
SHARE = "(CASE WHEN length(text) > 0 THEN len(regexp_extract_all(text, '[e]'))::DOUBLE / length(text) ELSE 0 END)"
EST = "(CASE WHEN length(text) > 0 THEN greatest(1, floor(length(text) / 3.2::DOUBLE))::BIGINT ELSE 0 END)"
KEY = "('0x' || substr(sha256('42::' || doc_id), 1, 15))::BIGINT"
CONV = "conv AS (SELECT conv_id, list(struct_pack(role := role, content := text) ORDER BY turn, role, text) AS ms FROM conversations GROUP BY conv_id)"

FLAT = f"flat AS (SELECT row_number() OVER (ORDER BY doc_id, i) - 1 AS pos, id FROM (SELECT doc_id, unnest(ids) AS id, generate_subscripts(ids, 1) AS i FROM (SELECT doc_id, list_append({IDS.format(t='text')}, 1) AS ids FROM documents)))"
VALID = f"{CONV}, valid AS (SELECT conv_id, list_transform(ms, lambda m: struct_pack(role := m.role, content := trim(m.content))) AS ms FROM conv WHERE len(list_filter(ms, lambda m: m.role IN ('system', 'user', 'assistant') AND trim(m.content) <> '')) = len(ms) AND len(list_filter(ms, lambda m: m.role = 'assistant')) > 0)"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def with_ids(docs: DataFrame) -> DataFrame:
    ids = F.concat(T.character_ids(F.coalesce("text", F.lit(""))), F.array(F.lit(T.EOS)))
    return docs.select("doc_id", ids.alias("ids"), (T.character_count(F.col("text")) + 1).cast("long").alias("n_ids"))


def flat(xs: Column) -> Column:
    """A digest of an array of numbers."""
    return F.md5(F.array_join(xs.cast("array<string>"), ","))


def normal(spark, sf_dir):
    return chat.conversations(read(spark, sf_dir, "conversations")).withColumn("messages", chat.normalised(F.col("messages"))).where("messages IS NOT NULL")


def packing_of(spark, sf_dir):
    """Texts are shuffled and tokenized where they are packed."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    ids = F.concat(T.character_ids(F.coalesce("text", F.lit(""))), F.array(F.lit(T.EOS)))
    return sequence.Packing(docs, LENGTH, tokens=ids, n=T.character_count(F.col("text")) + 1)
